"""The documents' way from raw text to packed sequences, a stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taxaweave.llm import stages
from taxaweave.llm.steps import written

#: Each stage gets the documents its predecessor left; the last gives packed sequences.
STAGES = [
    ("quality_rules", stages.quality_rules),
    ("ngram_jaccard", stages.near_duplicates),
    ("secret_scan", stages.secret_scan),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

#: No stage but the first two can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
