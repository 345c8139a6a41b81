"""Gene regions on the sample tables.

Order lines stand for profile hits on the document with the order's number:
the return flag is the gene and the line number picks the position.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaweave.functions import reverse_complement
from taxaweave.operators import genes
from taxaweave.plans.registry import query, table

# Position named by each line number.
POSITIONS = ("start", "beginning", "middle", "between", "end", "stop", "whole")

HITS = """
h AS (SELECT l_orderkey AS accno, l_returnflag AS gene,
  ['start', 'beginning', 'middle', 'between', 'end', 'stop', 'whole'][l_linenumber] AS position,
  l_partkey AS model, l_quantity::INT AS hit_start, (l_quantity + floor(l_extendedprice / 100))::INT AS hit_end,
  l_discount + l_tax AS evalue FROM lineitem)
"""
BEST = """
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accno, gene, position
        ORDER BY evalue, model, hit_start, hit_end) AS rn FROM h) WHERE rn = 1),
v AS (SELECT accno, gene, min(evalue) FILTER (WHERE position <> 'whole') AS parts,
        min(evalue) FILTER (WHERE position = 'whole') AS whole FROM b GROUP BY accno, gene),
r AS (SELECT b.* FROM b JOIN v USING (accno, gene)
      WHERE (b.position = 'whole') = coalesce(v.whole < v.parts, v.whole IS NOT NULL))
"""
INTERVALS = """
i AS (SELECT accno, gene,
  max(hit_start) FILTER (WHERE position IN ('start', 'beginning', 'whole')) AS "start",
  max(hit_start) FILTER (WHERE position IN ('middle', 'between')) AS middle,
  max(hit_end) FILTER (WHERE position IN ('end', 'stop', 'whole')) AS "end", min(evalue) AS evalue
  FROM r GROUP BY accno, gene)
"""


def hits(spark, d):
    names = F.array(*[F.lit(p) for p in POSITIONS])
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("accno"), F.col("l_returnflag").alias("gene"),
        F.try_element_at(names, F.col("l_linenumber")).alias("position"), F.col("l_partkey").alias("model"),
        F.col("l_quantity").cast("int").alias("hit_start"),
        (F.col("l_quantity") + F.floor(F.col("l_extendedprice") / 100)).cast("int").alias("hit_end"),
        (F.col("l_discount") + F.col("l_tax")).alias("evalue"),
    )


@query("SELECT doc_id, translate(reverse(text), 'ACGTRYWSKMBDHVNacgtrywskmbdhvn', 'TGCAYRWSMKVHDBNTGCAYRWSMKVHDBN') AS sequence FROM documents")
def reverse_complements(spark, d):
    return table(spark, d, "documents").select("doc_id", reverse_complement(F.col("text")).alias("sequence"))


@query(f"WITH {HITS}, {BEST} SELECT accno, gene, position, model, hit_start, hit_end, round(evalue, 6) AS evalue FROM r")
def best_hit(spark, d):
    return genes.resolve_hits(hits(spark, d)).withColumn("evalue", F.round("evalue", 6))


@query(f"""
WITH {HITS}, {BEST}, {INTERVALS},
s AS (SELECT lower(i.gene) AS gene, i.accno, CASE
  WHEN "start" IS NOT NULL AND "end" IS NOT NULL THEN
    CASE WHEN "end" > "start" THEN substring(text, "start", "end" - "start" + 1) END
  WHEN "start" IS NOT NULL THEN
    CASE WHEN "start" < length(text) THEN substring(text, "start", length(text) - "start" + 1) END
  WHEN "end" IS NOT NULL THEN substring(text, 1, "end")
  WHEN middle IS NOT NULL THEN text END AS sequence
  FROM i JOIN documents ON i.accno = doc_id)
SELECT * FROM s WHERE sequence IS NOT NULL
""")
def interval_slices(spark, d):
    found = genes.intervals(genes.resolve_hits(hits(spark, d)))
    records = table(spark, d, "documents").select(F.col("doc_id").alias("accno"), F.col("text").alias("sequence"))
    return genes.slices(found, records)


@query(f"""
WITH {HITS}, {BEST}, {INTERVALS},
g AS (SELECT accno, 'AN' AS gene, max("end" + 1) FILTER (WHERE gene = 'A') AS "start",
        max("start" - 1) FILTER (WHERE gene = 'N') AS "end" FROM i GROUP BY accno)
SELECT accno, gene, "start", middle, "end" FROM i
UNION ALL SELECT accno, gene, "start", NULL, "end" FROM g WHERE "start" > 0 OR "end" > 0
""")
def intergene(spark, d):
    found = genes.intervals(genes.resolve_hits(hits(spark, d)))
    between = spark.createDataFrame([("AN", "A", "N")], "gene string, lead_gene string, trail_gene string")
    return genes.add_intergenes(found, between).select("accno", "gene", "start", "middle", "end")
