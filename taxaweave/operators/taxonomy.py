"""Operators on lineages such as ``Kingdom; Order; Genus``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.functions import lineage
from taxaweave.session import cut_lineage

# Fixed value: parent of a taxon that heads its lineage.
ROOT = "o"


def parent_counts(records: DataFrame, column: str = "taxon_string") -> DataFrame:
    """(child, parent, n): in how many distinct lineages the parent precedes the child."""
    distinct = records.select(lineage(F.col(column)).alias("l")).where("l IS NOT NULL").distinct()
    pairs = distinct.select(
        F.explode(F.arrays_zip(
            F.col("l").alias("child"),
            F.concat(F.array(F.lit(ROOT)), F.slice("l", F.lit(1), F.size("l") - 1)).alias("parent"),
        )).alias("p")
    )
    return pairs.groupBy(F.col("p.child").alias("child"), F.col("p.parent").alias("parent")).agg(
        F.count(F.lit(1)).alias("n")
    )


def majority_parents(counts: DataFrame) -> DataFrame:
    """(child, parent): the most frequent parent other than the child itself."""
    best = counts.where("child <> parent").groupBy("child").agg(
        F.min_by("parent", F.struct(-F.col("n"), F.col("parent"))).alias("best")
    )
    return counts.select("child").distinct().join(best, "child", "left").select(
        "child", F.coalesce("best", F.lit(ROOT)).alias("parent")
    )


def parent_conflicts(counts: DataFrame) -> DataFrame:
    """(child, parent, n) for every child with more than one possible parent."""
    others = counts.where("child <> parent")
    several = others.groupBy("child").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("child")
    return others.join(several, "child", "left_semi")


def root_paths(parents: DataFrame) -> DataFrame:
    """(taxon, path) from the root down, however deep; a cycle ends where it would repeat a taxon."""
    current = parents.select(F.col("child").alias("taxon"), F.array("child").alias("path"), F.lit(True).alias("open"))
    current = cut_lineage(current)
    while True:
        head = F.element_at("path", 1)
        step = current.where("open").withColumn("child", head).join(parents, "child", "left")
        onward = F.col("parent").isNotNull() & (F.col("parent") != ROOT) & ~F.array_contains("path", F.col("parent"))
        moved = step.select(
            "taxon",
            F.when(onward, F.concat(F.array("parent"), F.col("path"))).otherwise(F.col("path")).alias("path"),
            F.coalesce(onward, F.lit(False)).alias("open"),
        )
        current = cut_lineage(moved.unionByName(current.where("NOT open")))
        if current.where("open").isEmpty():
            break
    return current.select("taxon", "path")


def rebuild_lineages(records: DataFrame, ignored: Sequence[str] = (), column: str = "taxon_string") -> DataFrame:
    """(old, new) lineage text: leaf names in ``ignored`` kept, the rest by majority parents."""
    paths = root_paths(majority_parents(parent_counts(records, column)))
    skip = F.array(*[F.lit(name) for name in ignored]) if ignored else F.array().cast("array<string>")
    distinct = records.select(F.col(column).alias("old")).where("old IS NOT NULL").distinct()
    split = distinct.withColumn("l", lineage(F.col("old")))
    kept = F.transform(
        "l", lambda name, i: F.when(F.array_contains(skip, name), F.lit(0)).otherwise(i + 1)
    )
    marked = split.withColumn("cut", F.array_max(kept)).withColumn(
        "taxon", F.when(F.col("cut") > 0, F.try_element_at("l", F.col("cut")))
    )
    joined = marked.join(paths, "taxon", "left")
    tail = F.slice("l", F.col("cut") + 1, F.size("l") - F.col("cut"))
    new = F.concat(F.coalesce("path", F.array().cast("array<string>")), tail)
    return joined.select("old", F.concat_ws("; ", new).alias("new"))


def alignment_groups(gene_lineages: DataFrame, lowest: bool = True) -> DataFrame:
    """(gene, taxon) to align together: one rank per lineage, never an ancestor of another pick.

    Names that start in lower case are passed over from the leaf when the
    lowest rank is asked for.
    """
    split = gene_lineages.select("gene", lineage(F.col("taxon_string")).alias("l")).distinct()
    if lowest:
        named = F.transform("l", lambda name, i: F.when(name.rlike("^[a-z]"), F.lit(0)).otherwise(i + 1))
        split = split.withColumn("p", F.array_max(named)).where("p > 0")
    else:
        split = split.withColumn("p", F.lit(1))
    picked = split.select("gene", F.element_at("l", F.col("p")).alias("taxon")).distinct()
    above = split.select("gene", F.explode(F.slice("l", F.lit(1), F.col("p") - 1)).alias("taxon")).distinct()
    return picked.join(above, ["gene", "taxon"], "left_anti").withColumn(
        "taxon", F.regexp_replace("taxon", r"\s", "_")
    )


def common_lineage(members: DataFrame, key: str = "taxon", column: str = "taxon_string") -> DataFrame:
    """(key, lineage): longest lineage prefix shared by all members of each taxon.

    Works on per-rank minima and maxima, so no taxon's members are gathered.
    """
    counted = members.select(key, lineage(F.col(column)).alias("l"))
    total = counted.groupBy(key).agg(F.count(F.lit(1)).alias("total"))
    ranks = counted.select(key, F.posexplode("l").alias("pos", "name")).groupBy(key, "pos").agg(
        F.min("name").alias("low"), F.max("name").alias("high"), F.count(F.lit(1)).alias("n")
    )
    judged = ranks.join(total, key).withColumn(
        "same", (F.col("low") == F.col("high")) & (F.col("n") == F.col("total"))
    )
    # One row per rank of the taxonomy: short lists by construction.
    listed = judged.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("pos", "low", "same"))).alias("r")
    )
    stop = F.coalesce(
        F.array_min(F.transform(F.filter("r", lambda x: ~x["same"]), lambda x: x["pos"])), F.size("r")
    )
    prefix = F.transform(F.filter("r", lambda x: x["pos"] < stop), lambda x: x["low"])
    shared = listed.select(key, F.concat_ws("; ", prefix).alias("lineage"))
    return total.select(key).join(shared, key, "left").withColumn("lineage", F.coalesce("lineage", F.lit("")))


def mixed_taxa(members: DataFrame, key: str = "taxon", column: str = "taxon_string") -> DataFrame:
    """(key, n): taxa whose lineages do not all lie on one path from the root."""
    distinct = members.select(key, lineage(F.col(column)).alias("l")).distinct()
    above = distinct.where(F.size("l") > 1).select(
        key,
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.slice("l", F.lit(1), i)
        )).alias("l"),
    ).distinct()
    ends = distinct.join(above, [key, "l"], "left_anti")
    return ends.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
