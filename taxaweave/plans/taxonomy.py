"""Lineage queries on the sample tables.

A customer's lineage reads region; nation; market segment; balance band.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaweave.functions import in_lineage
from taxaweave.operators import taxonomy
from taxaweave.plans.registry import query, table

LINEAGES = """
c AS (SELECT c_custkey, c_mktsegment, n_name, r_name,
  r_name || '; ' || n_name || '; ' || c_mktsegment || '; b' || floor(c_acctbal / 1000)::BIGINT AS taxon_string
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
PARENTS = """
t AS (SELECT DISTINCT string_split(taxon_string, '; ') AS l FROM c),
x AS (SELECT unnest(l) AS child, unnest(list_prepend('o', l[1:len(l) - 1])) AS parent FROM t),
n AS (SELECT child, parent, count(*)::BIGINT AS n FROM x GROUP BY child, parent)
"""
MAJORITY = """
m AS (SELECT child, parent FROM (SELECT *, row_number() OVER (PARTITION BY child ORDER BY n DESC, parent) AS rn
      FROM n WHERE child <> parent) WHERE rn = 1)
"""


def lineages(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    band = F.concat(F.lit("b"), F.floor(F.col("c_acctbal") / 1000).cast("string"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name",
        F.concat_ws("; ", "r_name", "n_name", "c_mktsegment", band).alias("taxon_string"),
    )


@query(f"WITH {LINEAGES} SELECT c_custkey, taxon_string FROM c WHERE list_contains(string_split(taxon_string, '; '), 'ASIA')")
def lineage_member(spark, d):
    return lineages(spark, d).where(in_lineage(F.col("taxon_string"), "ASIA")).select("c_custkey", "taxon_string")


@query(f"WITH {LINEAGES}, {PARENTS}, {MAJORITY} SELECT child, parent FROM m")
def parent_majority(spark, d):
    return taxonomy.majority_parents(taxonomy.parent_counts(lineages(spark, d)))


@query(f"""
WITH {LINEAGES}, {PARENTS}
SELECT child, parent, n FROM n WHERE child <> parent
AND child IN (SELECT child FROM n WHERE child <> parent GROUP BY child HAVING count(*) > 1)
""")
def parent_conflict(spark, d):
    return taxonomy.parent_conflicts(taxonomy.parent_counts(lineages(spark, d)))


@query(f"""
WITH RECURSIVE {LINEAGES}, {PARENTS}, {MAJORITY},
w AS (SELECT child AS taxon, [child] AS path, parent AS up FROM m
      UNION ALL SELECT w.taxon, list_prepend(w.up, w.path), m.parent FROM w JOIN m ON w.up = m.child
      WHERE NOT list_contains(w.path, w.up)),
f AS (SELECT taxon, arg_max(path, len(path)) AS path FROM w GROUP BY taxon),
s AS (SELECT DISTINCT taxon_string AS old, string_split(taxon_string, '; ') AS l FROM c),
k AS (SELECT *, CASE WHEN l[-1] IN ('b0', 'b1') THEN len(l) - 1 ELSE len(l) END AS cut FROM s)
SELECT old, array_to_string(list_concat(f.path, l[cut + 1:]), '; ') AS "new" FROM k JOIN f ON f.taxon = l[cut]
""")
def rebuild_lineage(spark, d):
    return taxonomy.rebuild_lineages(lineages(spark, d), ["b0", "b1"])


@query(f"""
WITH {LINEAGES}
SELECT c_mktsegment || '/' || r_name AS taxon,
       CASE WHEN count(DISTINCT n_name) > 1 THEN r_name ELSE r_name || '; ' || min(n_name) || '; ' || c_mktsegment
       END AS lineage
FROM c GROUP BY c_mktsegment, r_name
""")
def lineage_common_prefix(spark, d):
    members = lineages(spark, d).select(F.concat_ws("/", "c_mktsegment", "r_name").alias("taxon"), "taxon_string")
    return taxonomy.common_lineage(members)


@query(f"""
WITH {LINEAGES}, u AS (SELECT c_mktsegment AS gene, [r_name, n_name, 'b' || c_custkey] AS l FROM c
  UNION SELECT c_mktsegment, [r_name] FROM c),
k AS (SELECT gene, l, CASE WHEN l[-1] SIMILAR TO '[a-z].*' THEN len(l) - 1 ELSE len(l) END AS p FROM u),
a AS (SELECT DISTINCT gene, unnest(l[1:p - 1]) AS taxon FROM k)
SELECT DISTINCT k.gene, replace(k.l[k.p], ' ', '_') AS taxon FROM k
WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.gene = k.gene AND a.taxon = k.l[k.p])
""")
def alignment_groups(spark, d):
    base = lineages(spark, d)
    leaf = F.concat(F.lit("b"), F.col("c_custkey").cast("string"))
    full = base.select(F.col("c_mktsegment").alias("gene"), F.concat_ws("; ", "r_name", "n_name", leaf).alias("taxon_string"))
    upper = base.select(F.col("c_mktsegment").alias("gene"), F.col("r_name").alias("taxon_string"))
    return taxonomy.alignment_groups(full.unionByName(upper))


@query(f"""
WITH {LINEAGES} SELECT n_name AS taxon, count(DISTINCT taxon_string)::BIGINT AS n FROM c
GROUP BY n_name HAVING count(DISTINCT taxon_string) > 1
""")
def mixed_taxa(spark, d):
    base = lineages(spark, d)
    above = base.select(F.col("n_name").alias("taxon"), F.concat_ws("; ", "r_name", "n_name").alias("taxon_string"))
    return taxonomy.mixed_taxa(base.select(F.col("n_name").alias("taxon"), "taxon_string").unionByName(above))
