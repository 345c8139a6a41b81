"""Search for rogue taxa: taxa without which the replicate trees agree better.

A tree is the set of splits of its taxa, each a bit per taxon for the side without the first taxon. The score of the replicates is
the sum of the counts of all splits that more than half of them have. Without a taxon, two splits that differ in nothing else fall
together; such pairs are found by a join of the splits with one bit turned to all splits, and the gain of a taxon is a sum over
its pairs. Only splits that more than a quarter of the replicates have can be in a pair that passes a half, so no others are
tried. In greedy rounds the taxon with the highest gain goes, in all sets of replicates at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.operators.guided import binary, fold_up
from taxaweave.operators.ranking import number_rows
from taxaweave.session import cut_lineage, forget


def _bits(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")


def _bytes(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def canonical(side: np.ndarray, active: np.ndarray) -> np.ndarray:
    """The side, among active taxa, without the first of them."""
    first = int(active.argmax())
    return (active & ~side & 1) if side[first] else side & active


@F.pandas_udf(T.BinaryType())
def _tip_bits(rank: pd.Series, n: pd.Series) -> pd.Series:
    def one(at, size):
        bits = np.zeros(int(size), np.uint8)
        bits[int(at) - 1] = 1
        return _bytes(bits)

    return pd.Series([one(*pair) for pair in zip(rank, n, strict=True)])


def _joined(one, two):
    if two is None:
        return one[0], 0.0, one[0], None
    both = np.frombuffer(one[0], np.uint8) | np.frombuffer(two[0], np.uint8)
    return both.tobytes(), 0.0, one[0], two[0]


@F.pandas_udf(T.StructType([T.StructField("split", T.BinaryType()), T.StructField("size", T.IntegerType())]))
def _canonical(side: pd.Series, active: pd.Series) -> pd.DataFrame:
    out = []
    for a, b in zip(side, active, strict=True):
        bits, live = _bits(a), _bits(b)
        bits = canonical(bits, live)
        size = int(bits.sum())
        out.append((_bytes(bits), min(size, int(live.sum()) - size)))
    return pd.DataFrame(out, columns=["split", "size"])


def tree_splits(replicates: DataFrame, of: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((base, rep, split) of every replicate, (base, active) with the bits of all its taxa, (base, label, rank)).

    ``of`` tells from ``tree`` which base a replicate belongs to. The replicates of a base must have the same taxa, each once.
    """
    base = of if of is not None else F.lit("")
    rows = cut_lineage(replicates.select(base.cast("string").alias("base"), "tree", "node", "parent", "length", "label"))
    names = cut_lineage(number_rows(rows.where("label IS NOT NULL").select("base", "label").distinct(), ["label"], ["base"], "rank"))
    sizes = names.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    two = cut_lineage(binary(rows.select("tree", "node", "parent", "length", "label")))
    # Joints that :func:`binary` puts in are no branches of the tree.
    own = rows.where("label IS NULL AND parent IS NOT NULL").select("base", "tree", "node")
    tips = rows.where("label IS NOT NULL").join(names, ["base", "label"]).join(sizes, "base").select(
        "tree", "node", _tip_bits("rank", "n").alias("state"), F.lit(0.0).alias("score"))
    _, sides = fold_up(tips, two, _joined, "binary")

    @F.pandas_udf(T.BinaryType())
    def full(n: pd.Series) -> pd.Series:
        return n.map(lambda x: _bytes(np.ones(int(x), np.uint8)))

    active = cut_lineage(sizes.select("base", full("n").alias("active")))
    found = sides.join(own, ["tree", "node"]).join(active, "base").select(
        "base", F.col("tree").alias("rep"), _canonical("kept", "active").alias("c"))
    splits = found.where("c.size > 1").select("base", "rep", "c.split").distinct()
    reps = rows.select("base", "tree").distinct().groupBy("base").agg(F.count(F.lit(1)).alias("reps"))
    return cut_lineage(splits), cut_lineage(active.join(reps, "base")), names


def _tried(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For every split and taxon: the split without the taxon, whether it still divides taxa, and the split with the taxon on the other side."""
    for batch in batches:
        out = []
        for base, split, n, reps, active in zip(batch["base"], batch["split"], batch["n"], batch["reps"], batch["active"], strict=True):
            bits, live = _bits(split), _bits(active)
            for t in np.flatnonzero(live).tolist():
                less = live.copy()
                less[t] = 0
                rest = canonical(bits & less, less)
                size = int(rest.sum())
                flipped = bits.copy()
                flipped[t] ^= 1
                divides = min(size, int(less.sum()) - size) > 1
                out.append((base, t + 1, split, n, reps, _bytes(rest), divides, _bytes(canonical(flipped, live))))
        yield pd.DataFrame(out, columns=["base", "rank", "split", "n", "reps", "key", "divides", "partner"])


def tip_gains(splits: DataFrame, bases: DataFrame) -> DataFrame:
    """(base, rank, gain): how much the sum of the majority splits' counts grows without each taxon; taxa that change nothing are left out."""
    counted = cut_lineage(splits.groupBy("base", "split").agg(F.count(F.lit(1)).alias("n")))
    major = lambda n: F.when(2 * n > F.col("reps"), n).otherwise(0)
    heavy = counted.join(bases, "base").where(4 * F.col("n") > F.col("reps"))
    tried = cut_lineage(heavy.select("base", "split", "n", "reps", "active").mapInPandas(
        _tried, "base string, rank int, split binary, n long, reps long, key binary, divides boolean, partner binary"))
    other = counted.select("base", F.col("split").alias("partner"), F.col("n").alias("m"))
    pairs = cut_lineage(
        tried.join(other, ["base", "partner"])
        .withColumn("low", F.least("split", "partner")).withColumn("high", F.greatest("split", "partner"))
        .withColumn("nl", F.when(F.col("split") == F.col("low"), F.col("n")).otherwise(F.col("m")))
        .withColumn("nh", F.when(F.col("split") == F.col("low"), F.col("m")).otherwise(F.col("n")))
        .select("base", "rank", "reps", "divides", "low", "high", "nl", "nh").distinct()
    )
    both = (
        pairs.select("base", "rank", "low", "high").join(splits.withColumnRenamed("split", "low"), ["base", "low"])
        .join(splits.withColumnRenamed("split", "high"), ["base", "high", "rep"])
        .groupBy("base", "rank", "low", "high").agg(F.count(F.lit(1)).alias("both"))
    )
    union = F.col("nl") + F.col("nh") - F.coalesce("both", F.lit(0))
    gained = pairs.join(both, ["base", "rank", "low", "high"], "left").select(
        "base", "rank", (F.when(F.col("divides"), major(union)).otherwise(0) - major(F.col("nl")) - major(F.col("nh"))).alias("gain"))
    lost = tried.where("NOT divides").join(other, ["base", "partner"], "left_anti").select("base", "rank", (-major(F.col("n"))).alias("gain"))
    return gained.unionByName(lost).groupBy("base", "rank").agg(F.sum("gain").cast("long").alias("gain"))


@F.pandas_udf(T.BinaryType())
def _without(data: pd.Series, rank: pd.Series) -> pd.Series:
    def one(x, at):
        bits = _bits(x).copy()
        bits[int(at) - 1] = 0
        return _bytes(bits)

    return pd.Series([one(*pair) for pair in zip(data, rank, strict=True)])


def rogue_taxa(replicates: DataFrame, of: Column | None = None, most: int | None = None) -> DataFrame:
    """(base, round, label, gain): taxa to take away, in order, as long as each lets the score grow.

    Ties go to the smaller label. At most ``most`` rounds.
    """
    splits, bases, names = tree_splits(replicates, of)
    found, step = [], 0
    while most is None or step < most:
        step += 1
        gains = tip_gains(splits, bases)
        best = cut_lineage(
            gains.where("gain > 0").join(names, ["base", "rank"]).groupBy("base").agg(
                F.min(F.struct((-F.col("gain")).alias("g"), "label", "rank")).alias("b"))
            .select("base", F.lit(step).alias("round"), "b.label", "b.rank", (-F.col("b.g")).alias("gain"))
        )
        if best.isEmpty():
            break
        gone = best.select("base", F.col("rank").alias("t"))
        # Bases that lose nothing more are done.
        before = bases
        bases = cut_lineage(bases.join(gone, "base").select("base", _without("active", "t").alias("active"), "reps"))
        after = splits.join(gone, "base").join(bases.select("base", "active"), "base").select(
            "base", "rep", _canonical(_without("split", "t"), "active").alias("c"))
        old, splits = splits, cut_lineage(after.where("c.size > 1").select("base", "rep", "c.split").distinct())
        forget(old)
        forget(before)
        found.append(best.select("base", "round", "label", "gain"))
    if not found:
        return replicates.sparkSession.createDataFrame([], "base string, round int, label string, gain long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
