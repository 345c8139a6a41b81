"""Connected components by alternating star contraction.

Each round points every node at the smallest label among its neighbours. Only
minima are shuffled per node (pre-aggregated before the shuffle), so a node
with very many neighbours costs no more than any other; the joins that spread
the minima are plain equi joins that adaptive execution splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.session import cut_lineage


def stars(df: DataFrame, keys: list[str], node: str) -> DataFrame:
    """Edges that link all nodes sharing a key, one per row instead of one per pair."""
    centre = df.groupBy(*keys).agg(F.min(node).alias("dst"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        df.select(*keys, F.col(node).alias("src")).join(centre.drop("n"), keys)
        .where(F.col("src") != F.col("dst")).select("src", "dst").distinct()
    )


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node of each component, for nodes on an edge."""
    links = cut_lineage(
        edges.select(
            F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")
        ).where("u <> v").distinct()
    )
    while not _all_stars(links):
        links = cut_lineage(_small_star(_large_star(links)))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()


def _all_stars(links: DataFrame) -> bool:
    """Whether every node links straight to one node that links no further."""
    several = links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    if not several.isEmpty():
        return False
    return links.select("u").join(links.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest label in its neighbourhood."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()


def label_all(nodes: DataFrame, node: str, edges: DataFrame) -> DataFrame:
    """Add ``component`` to every row of ``nodes``; unlinked nodes are their own."""
    found = connected_components(edges)
    return (
        nodes.join(found.withColumnRenamed("node", node), node, "left")
        .withColumn("component", F.coalesce("component", F.col(node)))
    )
