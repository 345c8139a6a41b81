"""Record filters, metadata edits and individuals on the sample tables.

Documents stand for records: the text is the sequence and the share of the
letter ``e`` its ambiguous share. Orders stand for sequences of a gene
(priority) from an individual (customer).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaweave.functions import letter_share, quality_score
from taxaweave.operators import clean, individuals
from taxaweave.plans.registry import query, table

SHARE = "(length(text) - length(replace(text, 'e', '')))::DOUBLE / length(text)"


def scored_documents(spark, d):
    share = letter_share(F.col("text"), "e")
    return table(spark, d, "documents").select(
        "doc_id", "lang", "source", F.length("text").alias("length"), share.alias("share"),
        quality_score(F.length("text"), share).alias("score"),
    )


@query(f"""
SELECT doc_id, length(text)::BIGINT AS length, round({SHARE}, 6) AS share,
       round(length(text) * (1 - {SHARE}), 4) AS score
FROM documents WHERE {SHARE} < 0.1 AND length(text) > 500
""")
def length_n_filter(spark, d):
    return scored_documents(spark, d).where("share < 0.1 AND length > 500").select(
        "doc_id", F.col("length").cast("long").alias("length"), F.round("share", 6).alias("share"),
        F.round("score", 4).alias("score"),
    )


@query("""
SELECT lang, count(*) FILTER (WHERE n_chars >= 1000)::BIGINT AS at_least,
       count(*) FILTER (WHERE n_chars > 1000)::BIGINT AS more_than
FROM documents GROUP BY lang
""")
def min_length_inclusive(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(
        F.count_if(F.col("n_chars") >= 1000).alias("at_least"),
        F.count_if(F.col("n_chars") > 1000).alias("more_than"),
    )


@query("SELECT DISTINCT p_type FROM part WHERE nullif(p_type, 'empty') IS NOT NULL")
def distinct_entries(spark, d):
    parts = table(spark, d, "part").withColumn("p_type", F.nullif("p_type", F.lit("empty")))
    return clean.distinct_values(parts, "p_type")


@query("""
SELECT 'l_partkey' AS "column", 'l_suppkey' AS also_in, l_orderkey, l_partkey AS value, l_suppkey AS other_value
FROM lineitem WHERE l_partkey IN (SELECT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL)
UNION ALL
SELECT 'l_suppkey', 'l_partkey', l_orderkey, l_suppkey, l_partkey
FROM lineitem WHERE l_suppkey IN (SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL)
""")
def shared_values(spark, d):
    return clean.shared_values(table(spark, d, "lineitem"), "l_orderkey", ["l_partkey", "l_suppkey"])


@query("""
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN '3-MEDIUM' WHEN '2-HIGH' THEN '3-MEDIUM'
            WHEN '4-NOT SPECIFIED' THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def change_values(spark, d):
    # Each priority moves to the next lower one in use; the first two lines chain.
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    changes = spark.createDataFrame(
        [(1, "1-URGENT", "2-HIGH"), (2, "2-HIGH", "3-MEDIUM"), (3, "4-NOT SPECIFIED", "5-LOW")],
        "line int, old string, new string",
    )
    return clean.change_values(orders, "o_orderpriority", changes)


@query("""
SELECT d.doc_id, d.lang, coalesce('quality-' || l.quality, d.source) AS source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def update_by_key(spark, d):
    updates = table(spark, d, "labels").select(
        "doc_id", F.concat(F.lit("quality-"), F.col("quality").cast("string")).alias("source")
    )
    return clean.update_by_key(table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id", updates)


@query("""
SELECT doc_id, lang, n_chars FROM documents d WHERE NOT EXISTS (
  SELECT 1 FROM labels l JOIN documents x ON l.doc_id = x.doc_id
  WHERE l.toxic = 1 AND x.lang = d.lang AND x.n_chars = d.n_chars)
""")
def remove_entries(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    toxic = table(spark, d, "labels").where("toxic = 1").join(documents, "doc_id")
    return clean.remove_matching(documents, toxic, ["lang", "n_chars"])


@query("""
SELECT p_partkey, p_name FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = p_partkey)
""")
def unused_changes(spark, d):
    lines = table(spark, d, "part").select("p_partkey", "p_name")
    return clean.unused_lines(lines, table(spark, d, "lineitem"), {"p_partkey": "l_suppkey"})


@query("""
WITH r AS (SELECT doc_id, lang AS cond, md5(text) AS k1, source || '/' || n_chars AS k2 FROM documents),
g1 AS (SELECT cond, k1, row_number() OVER (ORDER BY cond, k1) AS ind FROM r GROUP BY cond, k1 HAVING count(*) > 1),
a1 AS (SELECT r.*, g1.ind FROM r LEFT JOIN g1 USING (cond, k1)),
m1 AS (SELECT coalesce(max(ind), 0) AS m FROM g1),
g2 AS (SELECT cond, k2, min(ind) AS lo, max(ind) AS hi FROM a1 GROUP BY cond, k2 HAVING count(*) > 1),
n2 AS (SELECT cond, k2, m + row_number() OVER (ORDER BY cond, k2) AS ind FROM g2, m1 WHERE lo IS NULL
       UNION ALL SELECT cond, k2, lo FROM g2 WHERE lo = hi),
a2 AS (SELECT a1.doc_id, coalesce(a1.ind, n2.ind) AS ind FROM a1 LEFT JOIN n2 USING (cond, k2)),
m2 AS (SELECT greatest((SELECT m FROM m1), coalesce(max(ind), 0)) AS m FROM n2)
SELECT doc_id, 'Ind_' || coalesce(ind, m + row_number() OVER (PARTITION BY ind IS NULL ORDER BY doc_id)) AS individual
FROM a2, m2
""")
def define_individuals(spark, d):
    records = table(spark, d, "documents").select(
        "doc_id", "lang", F.md5("text").alias("voucher"),
        F.concat_ws("/", "source", F.col("n_chars").cast("string")).alias("isolate"),
    )
    return individuals.define_individuals(records, "doc_id", ["voucher", "isolate"], "lang")


@query("""
SELECT user_id, event_type, value FROM events
WHERE (user_id, event_type, value) IN (
  SELECT (user_id, event_type, value) FROM events GROUP BY user_id, event_type, value HAVING count(*) = 1)
""")
def singletons(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type", "value").agg(
        F.count(F.lit(1)).alias("n")
    ).where("n = 1").drop("n")


@query("""
SELECT l_orderkey, l_linenumber, min(l_suppkey) AS lowest, max(l_suppkey) AS highest
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_suppkey) > 1
""")
def individual_conflict(spark, d):
    return individuals.conflicting_groups(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_suppkey")


@query("""
SELECT max(regexp_extract(c_name, '#([0-9]+)$', 1)::BIGINT) + 1 AS next_number FROM customer
""")
def next_number(spark, d):
    number = F.regexp_extract("c_name", "#([0-9]+)$", 1).cast("long")
    return table(spark, d, "customer").agg((F.max(number) + 1).alias("next_number"))
