"""Block filters and outlier statistics on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaweave.operators import blocks, outliers
from taxaweave.plans.registry import query, table
from taxaweave.session import cut_lineage


@query("""
WITH m AS (SELECT l_returnflag, median(l_extendedprice) AS med FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, round(min(med), 4) AS median, round(median(abs(l_extendedprice - med)), 4) AS mad
FROM lineitem JOIN m USING (l_returnflag) GROUP BY l_returnflag
""")
def mad_outlier(spark, d):
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice")
    return outliers.median_deviation(lines, ["l_returnflag"], "l_extendedprice").select(
        "l_returnflag", F.round("median", 4).alias("median"), F.round("mad", 4).alias("mad")
    )


@query("""
SELECT l_returnflag, round(avg(l_extendedprice / (l_quantity - 1)), 4) AS ratio FROM lineitem WHERE l_quantity - 1 > 0
GROUP BY l_returnflag
""")
def distance_ratio(spark, d):
    return table(spark, d, "lineitem").where("l_quantity - 1 > 0").groupBy("l_returnflag").agg(
        F.round(F.avg(F.col("l_extendedprice") / (F.col("l_quantity") - 1)), 4).alias("ratio")
    )


@query("""
SELECT count(*)::BIGINT AS n, round(avg(o_totalprice), 2) AS mean, round(avg(ln(o_totalprice)), 6) AS mean_log,
       round(avg(o_totalprice) * avg(o_totalprice) / var_pop(o_totalprice), 4) AS shape FROM orders WHERE o_totalprice > 0
""")
def gamma_moments(spark, d):
    return outliers.gamma_moments(table(spark, d, "orders"), "o_totalprice").select(
        "n", F.round("mean", 2).alias("mean"), F.round("mean_log", 6).alias("mean_log"), F.round("shape", 4).alias("shape")
    )


@query()
def gamma_tail(spark, d):
    documents = table(spark, d, "documents").select("doc_id", F.col("n_chars").cast("double").alias("length"))
    cut_off = outliers.tail_cut_off(documents, "length", "doc_id")
    return documents.where(F.col("length") > cut_off).withColumn("cut_off", F.lit(cut_off))


@query("""
WITH c AS (SELECT event_type, user_id, count(*)::BIGINT AS n FROM events GROUP BY event_type, user_id)
SELECT event_type, user_id, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS rn FROM c)
WHERE rn = 1
""")
def taxon_outlier_keep_largest(spark, d):
    return outliers.largest_cluster(table(spark, d, "events"), ["event_type"], "user_id")


# Each text is a row of its language's alignment, with gaps after its end; letters
# count as one of two bases, so that sites agree, and every ninth site has gaps only.
ALIGNED = """
t AS (SELECT doc_id, lang AS gene, regexp_replace(regexp_replace(regexp_replace(text, '[qxz-]', 'C', 'g'), '[^ .\\nC]', 'A', 'g'),
        '(.{{8}}).', '\\1-', 'gs') AS s FROM documents),
l AS (SELECT gene, max(length(s)) AS len, count(*) AS n FROM t GROUP BY gene),
e AS (SELECT gene, unnest(string_split(s, '')) AS base, unnest(range(1, length(s) + 1)) AS pos FROM t),
b AS (SELECT gene, pos, base, count(*) AS k FROM e WHERE base <> '-' GROUP BY ALL),
q0 AS (SELECT gene, pos, max(k) AS top, sum(k) AS present FROM b GROUP BY ALL),
q AS (SELECT gene, pos, coalesce(top, 0) AS top, coalesce(present, 0) AS present
      FROM (SELECT gene, unnest(range(1, len + 1)) AS pos FROM l) LEFT JOIN q0 USING (gene, pos)),
v AS (SELECT q.gene, pos, false AS gapped, top >= n // 2 + 1 AS strong, top >= ceil(n * 0.85) AS best
      FROM q JOIN l ON q.gene = l.gene),
c AS (SELECT gene, pos, gapped, NOT gapped AND strong AS ok, NOT gapped AND strong AND best AS high FROM v)
"""


@query(f"""
WITH {ALIGNED},
w1 AS (SELECT *, pos - row_number() OVER (PARTITION BY gene ORDER BY pos) AS g FROM c WHERE NOT ok),
w2 AS (SELECT gene, pos, count(*) OVER (PARTITION BY gene, g) AS n FROM w1),
k1 AS (SELECT c.* FROM c LEFT JOIN (SELECT * FROM w2 WHERE n > 8) x USING (gene, pos) WHERE x.n IS NULL),
k2 AS (SELECT *, pos - row_number() OVER (PARTITION BY gene ORDER BY pos) AS g FROM k1),
k3 AS (SELECT *, min(pos) FILTER (WHERE high) OVER (PARTITION BY gene, g) AS f,
         max(pos) FILTER (WHERE high) OVER (PARTITION BY gene, g) AS z FROM k2),
k4 AS (SELECT gene, pos, gapped, ok, pos - row_number() OVER (PARTITION BY gene ORDER BY pos) AS g FROM k3 WHERE pos BETWEEN f AND z),
k5 AS (SELECT *, count(*) OVER (PARTITION BY gene, g) AS n FROM k4),
k6 AS (SELECT gene, pos, gapped, ok FROM k5 WHERE n >= 10),
r1 AS (SELECT *, pos - row_number() OVER (PARTITION BY gene ORDER BY pos) AS g FROM k6 WHERE NOT ok),
r2 AS (SELECT gene, pos, bool_or(gapped) OVER (PARTITION BY gene, g) AS bad FROM r1),
k7 AS (SELECT k6.* FROM k6 LEFT JOIN r2 USING (gene, pos) WHERE NOT coalesce(r2.bad, false)),
k8 AS (SELECT gene, pos, pos - row_number() OVER (PARTITION BY gene ORDER BY pos) AS g FROM k7),
k9 AS (SELECT gene, pos, count(*) OVER (PARTITION BY gene, g) AS n FROM k8)
SELECT gene, pos::BIGINT AS pos FROM k9 WHERE n >= 10
""")
def block_filter(spark, d):
    letters = F.regexp_replace(F.regexp_replace("text", "[qxz-]", "C"), r"[^ .\nC]", "A")
    letters = F.regexp_replace(letters, r"(?s)(.{8}).", "$1-")
    documents = table(spark, d, "documents").select(F.col("lang").alias("gene"), letters.alias("sequence"))
    sites = cut_lineage(blocks.site_counts(documents))
    return blocks.conserved_sites(sites, gaps="a").select("gene", F.col("pos").cast("long").alias("pos"))
