"""Stages of the corpus pipeline: each applies one operator and lets its decisions take effect."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave.llm import line_rules, ngram_join, secret_spans
from taxaweave.llm import mixing as mixing_
from taxaweave.llm import packing as packer
from taxaweave.llm.queries import TARGETS, domain
from taxaweave.llm.steps import written

VOCABULARY = "byte_bpe_50k.json"


def row_key() -> Column:
    """A number for every different row: verdicts are joined by it, so that repeated or missing ids do not matter."""
    return F.xxhash64("doc_id", "text", "source")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the rest go.

    Rows of one id are judged each by itself; equal rows alike; a null text fails, as an empty one; an empty table stays empty.
    """
    verdicts = line_rules.quality(docs.select(row_key().alias("doc_id"), "text", "source"))
    bad = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("bad_key")).distinct()
    return docs.join(bad, row_key() == F.col("bad_key"), "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    A row without id stays only if no other of its group has one. Of rows with the smallest id but different texts one stays
    (the smaller hash), of equal rows one. Texts without words are in no group: they all stay. An empty table stays empty.
    """
    names = docs.select(row_key().alias("row_key"), "doc_id")
    groups = ngram_join.components(docs.select(row_key().alias("doc_id"), "text")).where("n_shingles > 0")
    groups = groups.groupBy("doc_id").agg(F.min("component_id").alias("component"), F.count(F.lit(1)).alias("rows"))
    groups = written(groups.withColumnRenamed("doc_id", "row_key").join(names.distinct(), "row_key"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    first = groups.groupBy("component").agg(F.min(order).alias("first")).select("component", F.col("first.row_key").alias("first_key"))
    gone = groups.join(first, "component").where("row_key <> first_key").select(F.col("row_key").alias("gone_key"))
    left = docs.join(gone, row_key() == F.col("gone_key"), "left_anti").select(*docs.columns)
    again = groups.where("rows > 1").select(F.col("row_key").alias("again_key"))
    if again.isEmpty():
        return left
    # Rows that stand there several times: one stays.
    single = left.join(again, row_key() == F.col("again_key"), "left_anti").select(*docs.columns)
    several = left.join(again, row_key() == F.col("again_key"), "left_semi").select(*docs.columns)
    return single.unionByName(several.dropDuplicates(["doc_id", "text", "source"]))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets masked; ``n_chars`` follows the text. A null text stays null; repeated rows stay."""
    clean = secret_spans.mask_secrets(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate says; what the mixture wants none of goes.

    Equal rows get equal numbers of copies, each; rows of one id with different texts their own. A null text has no tokens, and
    goes or stays by its posterior. An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = mixing_.mix(docs, labels, domain(), TARGETS, row_key())
    copies = found.groupBy("row_key").agg(F.max("copies").alias("copies")).where("copies > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("copies")))
    times = copies.select(F.col("row_key").alias("mixed_key"), again.alias("mixed_copy"))
    return docs.join(times, row_key() == F.col("mixed_key")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences of what is left. A null text is an empty one, of one closing token; repeated rows are packed each."""
    return packer.pack(docs, public_tokenizers.path(VOCABULARY))
