"""Queries of alignment along guide trees and of the order in which groups are aligned."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaweave.operators import align, guided, matrix
from taxaweave.plans.alignment import BASES, HEX
from taxaweave.plans.registry import query, table
from taxaweave.session import cut_lineage

# How many bases of a part's digests are its sequence, and the part types' tree.
BASES_SQL = f"substr(translate(md5(p_name) || md5(p_type), '{HEX}', '{BASES}'), 1, 20 + p_size)"


def part_cells(spark, d):
    """(tree, label, sequence): parts by brand, digests of unequal length spelled in bases."""
    digests = F.translate(F.concat(F.md5("p_name"), F.md5("p_type")), HEX, BASES)
    return table(spark, d, "part").select(
        F.col("p_brand").alias("tree"), F.col("p_partkey").cast("string").alias("label"),
        F.substring(digests, F.lit(1), F.lit(20) + F.col("p_size")).alias("sequence"),
    )


def part_type_trees(spark, d):
    """One tree per brand: the words of the part type are inner nodes, parts are tips."""
    parts = table(spark, d, "part").select("p_brand", "p_partkey", "p_type", F.split("p_type", " ").alias("w"))
    none = F.lit(None).cast("string")
    steps = [F.concat_ws(" ", F.slice("w", 1, k)) for k in (1, 2)] + [F.col("p_type")]
    levels = [F.col("p_brand"), *[F.concat_ws(":", F.lit(str(k)), s) for k, s in enumerate(steps)], F.concat(F.lit("tip"), F.col("p_partkey").cast("string"))]
    nodes = None
    for k, level in enumerate(levels):
        rows = parts.select(
            F.col("p_brand").alias("tree"), level.alias("node"), (levels[k - 1] if k else none).alias("parent"),
            F.lit(1.0).alias("length"), (F.col("p_partkey").cast("string") if k == 4 else none).alias("label"),
        ).distinct()
        nodes = rows if nodes is None else nodes.unionByName(rows)
    return nodes


@query(f"""
WITH c AS (SELECT p_brand AS tree, CAST(p_partkey AS VARCHAR) AS label, {BASES_SQL} AS bases FROM part)
SELECT tree, label, bases, 1::BIGINT AS widths FROM c
""")
def guided_alignment(spark, d):
    """Parts of a brand aligned along the tree of their types: gaps taken away, the input is left, and a tree has one width."""
    found = cut_lineage(guided.align_along(part_cells(spark, d), part_type_trees(spark, d)))
    widths = found.groupBy("tree").agg(F.count_distinct(F.length("sequence")).alias("widths"))
    return found.join(widths, "tree").select("tree", "label", F.replace("sequence", F.lit("-"), F.lit("")).alias("bases"), "widths")


@query(f"""
WITH c AS (SELECT p_brand AS tree, CAST(p_partkey AS VARCHAR) AS label, {BASES_SQL} AS bases FROM part)
SELECT tree, label, bases, 1::BIGINT AS widths, CAST(label AS BIGINT) % 2 = 0 AS added FROM c
""")
def added_sequences(spark, d):
    """Every second part added to the alignment of the others of its brand."""
    cells = part_cells(spark, d)
    odd = F.col("label").cast("long") % 2 == 1
    front = cut_lineage(align.align(cells.where(odd), ["tree"], "label"))
    found = cut_lineage(guided.add_sequences(front, cells.where(~odd), ["tree"]))
    widths = found.groupBy("tree").agg(F.count_distinct(F.length("sequence")).alias("widths"))
    return found.join(widths, "tree").select(
        "tree", "label", F.replace("sequence", F.lit("-"), F.lit("")).alias("bases"), "widths", (~odd).alias("added"))


@query(f"""
WITH c AS (SELECT p_brand AS tree, translate(md5(p_name), '{HEX}', '{BASES}') AS s FROM part),
l AS (SELECT tree, unnest(range(1, 33)) AS pos, unnest(string_split(s, '')) AS letter FROM c)
SELECT tree, CAST(pos AS INTEGER) AS pos, letter, count(*)::BIGINT AS n FROM l GROUP BY ALL
""")
def column_profiles(spark, d):
    """Letters in each column of the parts' digests, by brand."""
    rows = table(spark, d, "part").select(
        F.col("p_brand").alias("tree"), F.translate(F.md5("p_name"), HEX, BASES).alias("sequence"))
    return guided.profile_counts(guided.profiles(rows, ["tree"]), ["tree"])


def _spread_rows(spark, d):
    names = table(spark, d, "part").select(
        F.col("p_brand").alias("gene"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("grp"),
        F.col("p_partkey").alias("accno"), F.concat("p_name", F.repeat(F.col("p_type"), F.col("p_size") % 3)).alias("sequence"))
    return names


LIMIT = 0.05


@query(f"""
WITH c AS (SELECT p_brand AS gene, split_part(p_type, ' ', 1) AS grp, p_partkey AS accno, p_name || repeat(p_type, p_size % 3) AS sequence FROM part),
s AS (SELECT *, row_number() OVER (PARTITION BY gene, grp ORDER BY length(sequence) DESC, accno) AS r FROM c),
d AS (SELECT a.gene, a.grp, levenshtein(a.sequence, b.sequence)::DOUBLE / greatest(length(a.sequence), length(b.sequence), 1) AS p
  FROM s a JOIN s b ON a.gene = b.gene AND a.grp = b.grp AND b.r = 1 AND a.r > 1),
j AS (SELECT gene, grp, CASE WHEN 1 - p * 4.0 / 3 > 0 THEN -0.75 * ln(1 - p * 4.0 / 3) ELSE -0.75 * ln(1 - 0.749 * 4.0 / 3) END AS x FROM d),
m AS (SELECT gene, grp, median(x) AS median FROM j GROUP BY ALL),
e AS (SELECT gene, grp, median(abs(x - median)) AS mad FROM j JOIN m USING (gene, grp) GROUP BY ALL),
n AS (SELECT gene, grp, count(*)::BIGINT AS n FROM c GROUP BY ALL)
SELECT gene, grp, n, round(median, 6) AS median, round(mad, 6) AS mad, CASE WHEN coalesce(mad, 0) <= {LIMIT} THEN 1 ELSE 0 END AS alignable
FROM n LEFT JOIN m USING (gene, grp) LEFT JOIN e USING (gene, grp)
""")
def alignability(spark, d):
    """Whether the parts of a brand and type are alike enough to be aligned without a guide."""
    return guided.alignability(_spread_rows(spark, d), LIMIT).select(
        "gene", "grp", "n", F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad"), "alignable")


def _guide_cells(spark, d):
    """(taxon, gene, grp): customers by the priority of their orders, in groups by nation or segment."""
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("taxon"), F.col("o_orderpriority").alias("gene")).distinct()
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("taxon"), F.col("c_nationkey").cast("string").alias("nation"), "c_mktsegment")
    number = F.substring("gene", 1, 1).cast("int")
    return orders.join(customer, "taxon").select("taxon", "gene", number.alias("place"), F.when(
        number % 2 == 1, F.col("nation")).otherwise(F.concat_ws(" ", "c_mktsegment", F.col("nation").cast("int") % 3)).alias("grp"))


LEAST = 12


def _guide_sql(rounds: int = 8) -> str:
    parts = ["""
c AS MATERIALIZED (SELECT DISTINCT o_custkey AS taxon, o_orderpriority AS gene, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS place,
  CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 2 = 1 THEN CAST(c_nationkey AS VARCHAR) ELSE c_mktsegment || ' ' || CAST(c_nationkey % 3 AS VARCHAR) END AS grp
  FROM orders JOIN customer ON o_custkey = c_custkey)""", """
g AS MATERIALIZED (SELECT DISTINCT gene, grp, CASE WHEN place = 1 AND CAST(grp AS INTEGER) % 4 = 0 THEN 1 ELSE 0 END AS alignable FROM c)""", """
w AS MATERIALIZED (SELECT a.gene, a.grp, b.gene AS guide, b.grp AS guide_grp, b.place, count(DISTINCT a.taxon) AS shared
  FROM c a JOIN c b ON a.taxon = b.taxon AND abs(a.place - b.place) = 1 AND a.place < 5 AND b.place < 5 GROUP BY ALL)""", """
r0 AS MATERIALIZED (SELECT gene, grp, 0 AS round, CAST(NULL AS VARCHAR) AS guide FROM g WHERE alignable = 1)"""]
    for k in range(1, rounds + 1):
        parts.append(f"""
x{k} AS MATERIALIZED (SELECT gene, grp, guide, place FROM w WHERE (guide, guide_grp) IN (SELECT (gene, grp) FROM r{k - 1})
  AND (gene, grp) NOT IN (SELECT (gene, grp) FROM r{k - 1}) GROUP BY ALL HAVING sum(shared) >= {LEAST}),
r{k} AS MATERIALIZED (SELECT * FROM r{k - 1} UNION ALL SELECT gene, grp, {k}, arg_max(guide, place) FROM x{k} GROUP BY gene, grp)""")
    return "WITH " + ",".join(parts) + f"""
SELECT gene, grp, CAST(round AS INTEGER) AS round, guide FROM g LEFT JOIN r{rounds} USING (gene, grp)"""


@query(_guide_sql())
def guide_order(spark, d):
    """Rounds in which customers' groups become ready, from a few alignable ones on; neighbouring priorities guide each other."""
    cells = cut_lineage(_guide_cells(spark, d))
    alignable = ((F.col("place") == 1) & (F.col("grp").try_cast("int") % 4 == 0)).cast("int")
    groups = cells.select("gene", "grp", F.coalesce(alignable, F.lit(0)).alias("alignable")).distinct()
    one, two = cells.alias("a"), cells.alias("b")
    needs = one.join(two, (F.col("a.taxon") == F.col("b.taxon")) & (F.abs(F.col("a.place") - F.col("b.place")) == 1)).where(
        "a.place < 5 AND b.place < 5").groupBy(
        "a.gene", "a.grp", F.col("b.gene").alias("guide"), F.col("b.grp").alias("guide_grp"), "b.place"
    ).agg(F.count_distinct("a.taxon").alias("shared"))
    return guided.guide_rounds(groups, needs, LEAST)


@query("""
WITH b AS (SELECT c_nationkey, c_custkey, c_name AS first, c_mktsegment || c_name AS second FROM customer),
s AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('1/' || c_custkey), c_custkey) AS r FROM b),
p AS (SELECT a.c_nationkey, levenshtein(a.first, b.first)::DOUBLE / greatest(length(a.first), length(b.first)) AS p1,
  levenshtein(a.second, b.second)::DOUBLE / greatest(length(a.second), length(b.second)) AS p2
  FROM s a JOIN s b ON a.c_nationkey = b.c_nationkey AND a.r < b.r AND b.r <= 10),
j AS (SELECT c_nationkey, CASE WHEN 1 - p1 * 4.0 / 3 > 0 THEN -0.75 * ln(1 - p1 * 4.0 / 3) END AS d1,
  CASE WHEN 1 - p2 * 4.0 / 3 > 0 THEN -0.75 * ln(1 - p2 * 4.0 / 3) END AS d2 FROM p),
q AS (SELECT CAST(c_nationkey AS VARCHAR) AS tree, avg(d2 / d1) AS ratio FROM j WHERE d1 > 0 AND d2 IS NOT NULL GROUP BY ALL)
SELECT CAST(c_nationkey AS VARCHAR) AS tree, CAST(c_custkey AS VARCHAR) AS label, round(2.0 * coalesce(ratio, 1), 6) AS length
FROM customer LEFT JOIN q ON tree = CAST(c_nationkey AS VARCHAR)
""")
def scaled_branches(spark, d):
    """Branches of the customers of a nation, in the measure of another text."""
    customer = table(spark, d, "customer")
    tree = F.col("c_nationkey").cast("string").alias("tree")
    pairs = customer.select(tree, F.col("c_custkey").alias("taxon"), F.col("c_name").alias("first"), F.concat("c_mktsegment", "c_name").alias("second"))
    label = F.col("c_custkey").cast("string")
    nodes = customer.select(tree, label.alias("node"), F.col("c_nationkey").cast("string").alias("parent"), F.lit(2.0).alias("length"), label.alias("label"))
    return guided.scale_branches(nodes, matrix.distance_ratios(pairs)).select("tree", "label", F.round("length", 6).alias("length"))
