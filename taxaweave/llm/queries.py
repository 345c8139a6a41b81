"""Queries of the training-data operators on the sample tables, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave.llm import (
    block_lloyd,
    ftrl,
    hnsw,
    languages,
    line_rules,
    mixing,
    ngram_join,
    packing,
    rule_ensemble,
    secret_spans,
    shards,
    stripes,
    text_statistics,
    token_counts,
)
from taxaweave.llm.steps import written

QUERIES = {}
SQL: dict[str, str] = {}
VOCABULARY = "byte_bpe_50k.json"


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: chooses the held-out rows."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def held_out(divisor: int, wanted: int) -> Column:
    """Whether a row is held out; one without id is not, and never teaches either."""
    return F.coalesce(remainder(divisor) == wanted, F.lit(False))


@query()
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    rows = written(text_statistics.statistics(table(spark, folder, "documents")))
    taught = rows.join(labels.where(remainder(5) != 0), "doc_id")
    score = rule_ensemble.fit(taught, "quality").score()
    return rows.select(
        "doc_id", held_out(5, 0).alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted")
    )


@query()
def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_spans.secret_spans(table(spark, folder, "documents"))


@query()
def op4_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.nearest(table(spark, folder, "embeddings"))


@query()
def op5_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    dictionaries = languages.learn(docs.where(remainder(4) != 2))
    return languages.identify(docs, dictionaries).select(
        "doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "margin", "reliable"
    )


@query()
def op6_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    return shards.place(table(spark, folder, "documents"))


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS set FROM w),
e AS (SELECT doc_id, len(set) AS n, unnest(set) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r(x, y) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.x, p.y FROM r JOIN p ON p.x = r.y)
SELECT s.doc_id, CAST(len(set) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON m.x = s.doc_id
"""


@query(OP7_SQL)
def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.components(table(spark, folder, "documents"), width=4, percent=85)


@query()
def op8_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.quality(table(spark, folder, "documents")).drop("host")


@query()
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def domain() -> Column:
    """The domain of a labelled row; null where a label is missing."""
    return F.when(F.col("quality") == 0, "junk").when((F.col("quality") == 1) & (F.col("toxic") == 1), "toxic").when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), "clean")


#: Wanted shares of the tokens.
TARGETS = {"clean": 0.95, "toxic": 0.03, "junk": 0.02}


@query()
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "labels"), domain(), TARGETS)


@query(block_lloyd.reference_sql())
def op11_block_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    return block_lloyd.cluster(table(spark, folder, "embeddings"))


@query(stripes.reference_sql())
def op12_stripes(spark: SparkSession, folder: str) -> DataFrame:
    return stripes.collocations(table(spark, folder, "documents"))


@query()
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = ftrl.learn(docs, table(spark, folder, "labels").where(remainder(4) != 2), "toxic")
    scored = ftrl.score(docs, model)
    return scored.select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
