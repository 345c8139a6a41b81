"""Alignment and tree queries on the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaweave.operators import align, matrix, trees, treeparts
from taxaweave.plans.registry import query, table
from taxaweave.session import cut_lineage

# Fixed value: base that each hexadecimal digit stands for, four digits per base.
HEX, BASES = "0123456789abcdef", "ACGTACGTACGTACGT"
# Fixed value: bootstrap replicates, as many as the default of ``concat_phylo_method``.
REPLICATES = 100


@query()
def star_alignment(spark, d):
    """Names of the parts of a brand, aligned letter by letter."""
    parts = table(spark, d, "part").select(
        F.col("p_brand").alias("gene"), F.col("p_partkey").alias("accno"),
        F.regexp_replace(F.concat("p_name", "p_type"), "[^A-Za-z]", "").alias("sequence"),
    )
    return align.align(parts, ["gene"])


@query()
def merged_alignment(spark, d):
    """Alignments of each part type, merged into one per brand."""
    parts = table(spark, d, "part").select(
        F.col("p_brand").alias("gene"), F.col("p_type").alias("grp"), F.col("p_partkey").alias("accno"),
        F.regexp_replace("p_name", "[^A-Za-z]", "").alias("sequence"),
    )
    return align.merge_groups(cut_lineage(align.align(parts, ["gene", "grp"])), ["gene"], "grp")


def _part_rows(spark, d):
    """Parts of a brand as aligned rows: digests spelled in bases."""
    return table(spark, d, "part").select(
        F.col("p_brand").alias("tree"), F.col("p_partkey").cast("string").alias("taxon"),
        F.translate(F.concat(F.md5("p_name"), F.md5("p_type"), F.md5(F.col("p_size").cast("string"))), HEX, BASES).alias("sequence"),
    )


@query()
def distance_trees(spark, d):
    return trees.to_newick(trees.build_trees(_part_rows(spark, d)))


@query()
def bootstrap_support(spark, d):
    rows = cut_lineage(_part_rows(spark, d))
    replicates = cut_lineage(trees.build_trees(trees.resample(rows, REPLICATES)))
    nodes = cut_lineage(trees.build_trees(rows))
    of = F.split_part("tree", F.lit("/"), F.lit(1))
    return trees.support(nodes, replicates, of).where("support IS NOT NULL")


@query()
def bounded_tree_parts(spark, d):
    """Trees of the parts of a brand, cut into parts of at most six tips."""
    return treeparts.bounded_parts(cut_lineage(trees.build_trees(_part_rows(spark, d))), 6)


TIPS = """
t AS (SELECT DISTINCT r_name AS tree, n_name AS up, n_name || '_' || c_mktsegment AS tip, c_mktsegment
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def _newick_sql(source, tip="tip"):
    return f"""
u AS (SELECT tree, up, CASE WHEN count(*) > 1 THEN '(' || string_agg({tip}, ',' ORDER BY {tip}) || ')' ELSE min({tip}) END AS s,
        min({tip}) AS f FROM {source} GROUP BY tree, up),
w AS (SELECT tree, CASE WHEN count(*) > 1 THEN '(' || string_agg(s, ',' ORDER BY f) || ')' ELSE min(s) END || ';' AS newick
      FROM u GROUP BY tree)
"""


def region_trees(spark, d):
    """One tree per region: nations are inner nodes, their market segments tips."""
    places = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("tree"), F.col("n_name").alias("up"), "c_mktsegment"
    ).distinct()
    nothing = F.lit(None)
    label = F.concat_ws("_", "up", "c_mktsegment")
    tips = places.select("tree", label.alias("node"), F.col("up").alias("parent"), nothing.cast("double").alias("length"), label.alias("label"))
    inner = places.select("tree", F.col("up").alias("node"), F.col("tree").alias("parent"), nothing.cast("double").alias("length"), nothing.cast("string").alias("label")).distinct()
    roots = places.select("tree", F.col("tree").alias("node"), nothing.cast("string").alias("parent"), nothing.cast("double").alias("length"), nothing.cast("string").alias("label")).distinct()
    return tips.unionByName(inner).unionByName(roots)


@query(f"WITH {TIPS}, {_newick_sql('t')} SELECT tree, newick FROM w")
def newick_export(spark, d):
    return trees.to_newick(region_trees(spark, d))


@query(f"WITH {TIPS}, {_newick_sql('t')} SELECT tree, newick FROM w", name="newick_round_trip")
def newick_round_trip(spark, d):
    text = cut_lineage(trees.to_newick(region_trees(spark, d)))
    return trees.to_newick(trees.parse_newick(text))


@query(f"""
WITH {TIPS}, k AS (SELECT * FROM t WHERE c_mktsegment NOT IN ('FURNITURE', 'MACHINERY', 'HOUSEHOLD', 'BUILDING') OR up LIKE 'NATION_1%'),
{_newick_sql('k')} SELECT tree, newick FROM w
""")
def pruned_trees(spark, d):
    nodes = cut_lineage(region_trees(spark, d))
    drop = trees.tips(nodes).where("label NOT LIKE 'NATION_1%' AND label RLIKE '_(FURNITURE|MACHINERY|HOUSEHOLD|BUILDING)$'")
    return trees.to_newick(trees.prune(nodes, drop))


@query(f"WITH {TIPS}, k AS (SELECT *, 'x' || md5(tip) AS renamed FROM t), {_newick_sql('k', 'renamed')} SELECT tree, newick FROM w")
def renamed_tips(spark, d):
    nodes = region_trees(spark, d)
    names = trees.tips(nodes).select("label", F.concat(F.lit("x"), F.md5("label")).alias("name"))
    return trees.to_newick(trees.rename_tips(nodes, names))


@query(f"""
WITH {TIPS}, n AS (SELECT DISTINCT n_name || '_' || 'BUILDING' AS label FROM nation UNION SELECT n_name FROM nation)
SELECT tip AS label, 'superfluous' AS status FROM t WHERE tip NOT IN (SELECT label FROM n)
UNION ALL SELECT label, 'missing' FROM n WHERE label NOT IN (SELECT tip FROM t)
""")
def tip_differences(spark, d):
    nation = table(spark, d, "nation")
    names = nation.select(F.concat_ws("_", "n_name", F.lit("BUILDING")).alias("label")).union(nation.select("n_name"))
    return trees.tip_differences(region_trees(spark, d), names)


@query("""
WITH x AS (SELECT DISTINCT o_custkey AS taxon, o_orderpriority AS gene FROM orders),
k AS (SELECT taxon, row_number() OVER (ORDER BY taxon) AS rank FROM x GROUP BY taxon),
n AS (SELECT count(*) AS n FROM k),
w AS (SELECT DISTINCT i AS draw, ('0x' || substr(md5('1/' || i || '/' || j), 1, 12))::BIGINT % n + 1 AS rank
      FROM range(1000) a(i), range(1, 5) b(j), n),
s AS (SELECT draw, count(*) AS size FROM w GROUP BY draw),
g AS (SELECT draw, gene, count(*) AS c FROM w JOIN k USING (rank) JOIN x USING (taxon) GROUP BY draw, gene),
m AS (SELECT draw, max(c) AS most FROM g GROUP BY draw)
SELECT count(*)::BIGINT AS draws, count(*) FILTER (WHERE most = size)::BIGINT AS decisive FROM s JOIN m USING (draw)
""")
def decisiveness(spark, d):
    cells = table(spark, d, "orders").select(F.col("o_custkey").alias("taxon"), F.col("o_orderpriority").alias("gene"))
    return matrix.decisiveness(cells)


@query("""
WITH b AS (SELECT doc_id AS taxon, source AS s1, lang || n_chars AS s2 FROM documents),
s AS (SELECT * FROM b ORDER BY md5('1/' || taxon), taxon LIMIT 10),
p AS (SELECT levenshtein(a.s1, b.s1)::DOUBLE / greatest(length(a.s1), length(b.s1)) AS p1,
        levenshtein(a.s2, b.s2)::DOUBLE / greatest(length(a.s2), length(b.s2)) AS p2 FROM s a JOIN s b ON a.taxon < b.taxon),
j AS (SELECT CASE WHEN 1 - p1 * 4.0 / 3 > 0 THEN -0.75 * ln(1 - p1 * 4.0 / 3) END AS d1,
        CASE WHEN 1 - p2 * 4.0 / 3 > 0 THEN -0.75 * ln(1 - p2 * 4.0 / 3) END AS d2 FROM p)
SELECT round(avg(d2 / d1), 6) AS ratio, count(*)::BIGINT AS pairs FROM j WHERE d1 > 0 AND d2 IS NOT NULL
""")
def sampled_distance_ratio(spark, d):
    documents = table(spark, d, "documents")
    cells = documents.select(F.col("doc_id").alias("taxon"), F.lit("a").alias("gene"), F.col("source").alias("sequence")).union(
        documents.select("doc_id", F.lit("b"), F.concat("lang", F.col("n_chars").cast("string")))
    )
    return matrix.distance_ratio(cells, "a", "b").withColumn("ratio", F.round("ratio", 6))
