"""Linking genes into taxa on the sample tables.

An order is a sequence of the gene named by its priority, from the individual
who is its customer; its price is both length and score. Orders of one gene,
date, status and price band form a cluster.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaweave.operators import clusters, linking, matching
from taxaweave.plans.registry import query, table
from taxaweave.session import cut_lineage

SEQUENCES = """
o AS (SELECT 'p' || substring(o_orderpriority, 1, 1) AS gene, o_orderkey AS accno, o_custkey AS individual,
        o_totalprice AS score, o_orderdate, o_orderstatus, floor(o_totalprice / 20000) AS band FROM orders),
s AS (SELECT *, first_value(accno) OVER (PARTITION BY gene, o_orderdate, o_orderstatus, band
        ORDER BY score DESC, accno) AS lead FROM o)
"""
COUNTERPARTS = """
c AS (SELECT individual, gene, lead AS accno FROM (SELECT *, row_number() OVER (PARTITION BY individual, gene
        ORDER BY (lead <> accno), score DESC, accno) AS rn FROM s) WHERE rn = 1)
"""


def sequences(spark, d):
    orders = table(spark, d, "orders").select(
        F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)).alias("gene"), F.col("o_orderkey").alias("accno"),
        F.col("o_custkey").alias("individual"), F.col("o_totalprice").alias("length"),
        F.col("o_totalprice").alias("score"), "o_orderdate", "o_orderstatus",
        F.floor(F.col("o_totalprice") / 20000).alias("band"),
    )
    return clusters.with_leads(orders, ["gene", "o_orderdate", "o_orderstatus", "band"], "accno", F.col("score"))


@query(f"""
WITH {SEQUENCES}, {COUNTERPARTS}
SELECT s.gene, s.accno, c.gene AS other_gene, c.accno AS other_accno
FROM s JOIN c ON s.individual = c.individual AND s.gene <> c.gene WHERE s.lead = s.accno
""")
def match_by_individual(spark, d):
    return linking.match_by_individual(sequences(spark, d))


@query(f"""
WITH {SEQUENCES}, f AS (SELECT * FROM s WHERE lead <> accno AND score >= 50000)
SELECT individual, gene, accno FROM (SELECT *, row_number() OVER (PARTITION BY individual, gene
  ORDER BY score DESC, accno) AS rn FROM f) WHERE rn = 1
""")
def alternative_accno(spark, d):
    rows = sequences(spark, d)
    taken = rows.where("lead = accno").select("gene", "accno")
    return linking.alternatives(rows, taken, 50000)


@query(f"""
WITH RECURSIVE {SEQUENCES}, {COUNTERPARTS},
g AS (SELECT gene, row_number() OVER (ORDER BY count(*) DESC, gene) AS r FROM s
      WHERE lead = accno AND score > 50000 GROUP BY gene),
e1 AS (SELECT s.accno AS u, c.accno AS v FROM s JOIN c ON s.individual = c.individual AND s.gene <> c.gene
       WHERE s.lead = s.accno AND s.score > 50000),
e AS (SELECT u, v FROM e1 UNION SELECT v, u FROM e1
      UNION SELECT accno, accno FROM s WHERE lead = accno AND score > 50000 UNION SELECT v, v FROM e1),
w AS (SELECT u AS node, u AS reach FROM e UNION SELECT w.node, e.v FROM w JOIN e ON w.reach = e.u),
k AS (SELECT node, min(reach) AS comp FROM w GROUP BY node),
m AS (SELECT k.comp, s.gene, s.accno, s.score, g.r FROM k JOIN s ON k.node = s.accno JOIN g ON g.gene = s.gene),
f AS (SELECT comp, row_number() OVER (ORDER BY r, accno) AS taxon FROM (
        SELECT *, row_number() OVER (PARTITION BY comp ORDER BY r, accno) AS q FROM m) WHERE q = 1),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY comp, gene ORDER BY score DESC, accno) AS q FROM m) WHERE q = 1)
SELECT f.taxon, b.gene, b.accno FROM b JOIN f ON b.comp = f.comp
""")
def link_genes_maximised(spark, d):
    return linking.link_maximised(sequences(spark, d), 50000)


@query()
def link_genes_conservative(spark, d):
    return linking.link_conservative(sequences(spark, d), 50000)


def _sides(spark, d, columns):
    """All orders on both sides: customers against order dates."""
    orders = table(spark, d, "orders")
    left = orders.select(F.col("o_custkey").alias("unit"), *columns)
    right = orders.select(F.datediff("o_orderdate", F.lit("1970-01-01")).cast("long").alias("unit"), *columns)
    return left, right


def _edge_query(kind, columns):
    """Edge scores of one kind between classes of customers and classes of dates."""
    number = "count(*)" if kind == "a" else "1"
    score = {
        "o": "2.0", "a": "2.0 * m", "e": "CASE WHEN m = t THEN 2.0 ELSE 0 END",
        "h": "CASE WHEN m = t THEN 2.0 ELSE 1.0 END",
    }[kind]

    def side(letter, unit):
        values = " UNION ALL ".join(
            f"SELECT {unit} AS unit, {i} AS col, {c} AS value, {number} AS n FROM orders GROUP BY ALL" for i, c in enumerate(columns))
        return f"""
{letter}1 AS (SELECT *, sum(n) OVER (PARTITION BY unit, col) AS total FROM ({values})),
{letter}2 AS (SELECT unit, string_agg(col || value || n, ',' ORDER BY col, value) AS sig FROM {letter}1 GROUP BY unit),
{letter}3 AS (SELECT sig, min(unit) AS class, count(*) AS units FROM {letter}2 GROUP BY sig),
{letter} AS (SELECT class, units, col, value, n, total FROM {letter}3 JOIN {letter}1 ON {letter}1.unit = {letter}3.class)"""

    sql = f"""
WITH {side('l', 'o_custkey')}, {side('r', "(o_orderdate::DATE - DATE '1970-01-01')::BIGINT")},
p AS (SELECT l.class AS src, r.class AS dst, l.units AS src_units, r.units AS dst_units, l.col,
        sum(l.n * r.n) AS m, max(l.total * r.total) AS t FROM l JOIN r ON l.value = r.value AND l.col = r.col GROUP BY ALL)
SELECT src, dst, src_units::BIGINT AS src_units, dst_units::BIGINT AS dst_units, sum({score})::DOUBLE AS weight
FROM p GROUP BY ALL HAVING sum({score}) > 0
"""

    def run(spark, d):
        left, right = _sides(spark, d, columns)
        kinds = [kind] * len(columns)
        values1, units1 = linking.profile_classes(left, "unit", columns, kinds)
        values2, units2 = linking.profile_classes(right, "unit", columns, kinds)
        edges = linking.edge_scores(values1, values2, kinds, [2] * len(columns))
        sizes1 = units1.groupBy(F.col("class").alias("src")).agg(F.count(F.lit(1)).alias("src_units"))
        sizes2 = units2.groupBy(F.col("class").alias("dst")).agg(F.count(F.lit(1)).alias("dst_units"))
        return edges.join(sizes1, "src").join(sizes2, "dst").select("src", "dst", "src_units", "dst_units", "weight")

    query(sql, name=f"edge_scores_{kind}")(run)


# Counts per value make nearly every unit a class of its own: one column for them, two for the others.
for _kind in "oeh":
    _edge_query(_kind, ["o_orderstatus", "o_orderpriority"])
_edge_query("a", ["o_orderstatus"])


def _order_classes(spark, d):
    """(edges, sizes of both sides) between classes of customers and of order dates, over all orders, linked by status and by priority."""
    orders, columns, kinds = table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], ["h", "h"]
    left = orders.select(F.col("o_custkey").alias("unit"), *columns)
    right = orders.select(F.datediff("o_orderdate", F.lit("1970-01-01")).cast("long").alias("unit"), *columns)
    values1, units1 = linking.profile_classes(left, "unit", columns, kinds)
    values2, units2 = linking.profile_classes(right, "unit", columns, kinds)
    edges = linking.edge_scores(values1, values2, kinds, [2, 2])
    return edges, (
        units1.groupBy(F.col("class").alias("src")).agg(F.count(F.lit(1)).alias("n")),
        units2.groupBy(F.col("class").alias("dst")).agg(F.count(F.lit(1)).alias("n")),
    )


@query()
def max_matching(spark, d):
    return matching.max_weight_matching(*_order_classes(spark, d))


@query("""
SELECT count(DISTINCT o_custkey)::BIGINT AS customers, count(DISTINCT o_orderdate::DATE)::BIGINT AS dates,
  true AS within, true AS covered, true AS greatest FROM orders
""")
def matching_certificate(spark, d):
    """The matching of all orders keeps to the sizes of its classes, and prices prove that none has more weight."""
    edges, sizes = _order_classes(spark, d)
    edges, sizes = cut_lineage(edges), tuple(cut_lineage(s) for s in sizes)
    flows = cut_lineage(matching.max_weight_matching(edges, sizes))
    left, right = (cut_lineage(p) for p in matching.dual_prices(edges, flows, sizes))
    used = flows.groupBy("src").agg(F.sum("units").alias("k")).join(sizes[0], "src").select((F.col("k") <= F.col("n")).alias("ok")).unionByName(
        flows.groupBy("dst").agg(F.sum("units").alias("k")).join(sizes[1], "dst").select((F.col("k") <= F.col("n")).alias("ok")))
    sums = edges.join(left.select("src", F.col("price").alias("u")), "src").join(right.select("dst", F.col("price").alias("v")), "dst").agg(
        F.coalesce(F.min(F.col("u") + F.col("v") - F.col("weight")) >= -1e-6, F.lit(True)).alias("covered"))
    priced = left.select((F.col("n") * F.col("price")).alias("x")).unionByName(right.select((F.col("n") * F.col("price")).alias("x"))).agg(F.sum("x").alias("priced"))
    weighed = flows.join(edges, ["src", "dst"]).agg(F.sum(F.col("units") * F.col("weight")).alias("weighed"))
    count = lambda df, name: df.agg(F.sum("n").cast("long").alias(name))
    # One row each on the broadcast side.
    out = count(sizes[0], "customers")
    for one in (count(sizes[1], "dates"), used.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("within")), sums, priced, weighed):
        out = out.crossJoin(F.broadcast(one))
    return out.select("customers", "dates", "within", "covered", (F.abs(F.col("priced") - F.col("weighed")) < 1e-6).alias("greatest"))


@query()
def multimotu_taxa(spark, d):
    nation = table(spark, d, "customer").select(F.col("c_custkey").alias("individual"), "c_nationkey")
    rows = sequences(spark, d).join(nation, "individual").withColumn(
        "voucher", F.concat_ws("/", F.to_date("o_orderdate").cast("string"), F.col("c_nationkey").cast("string"))
    )
    return linking.multimotu(rows, ["voucher"], ["h"], [2])


@query("""
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY p_partkey) AS taxon, p_partkey AS lead
FROM part WHERE p_partkey NOT IN (SELECT l_suppkey FROM lineitem)
""")
def unlinked_new_taxa(spark, d):
    from taxaweave.operators.ranking import number_rows

    highest = table(spark, d, "customer").agg(F.max("c_custkey").alias("h"))
    rest = table(spark, d, "part").select("p_partkey").join(
        table(spark, d, "lineitem"), F.col("p_partkey") == F.col("l_suppkey"), "left_anti"
    )
    # One row on the broadcast side.
    return number_rows(rest, ["p_partkey"], name="n").crossJoin(F.broadcast(highest)).select(
        (F.col("h") + F.col("n")).alias("taxon"), F.col("p_partkey").alias("lead")
    )
