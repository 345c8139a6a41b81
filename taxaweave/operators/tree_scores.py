"""Scores of given trees, and taxa placed on them: parsimony and likelihood.

Columns of an alignment that are the same in all tips are one pattern with a count. Parsimony keeps a set of
bases per pattern as bits, likelihood four numbers per pattern; both go up the node tables level by level (``guided.fold_up``), in all
trees at once, so that a task holds two children of a node. Gaps and other letters stand for any base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.operators.guided import BASES, CODES, binary, fold_up
from taxaweave.operators.ranking import number_rows
from taxaweave.session import cut_lineage

# Fixed value: bits of the bases, and of letters that may be any.
ANY = (1 << len(BASES)) - 1
# Columns of one summed piece of an alignment's pattern hashes.
PIECE = 1024
# Taxa that are placed in one block, and factors that are tried at once.
BLOCK = 64
FACTORS = tuple(2.0 ** (k / 2) for k in range(-8, 9))


def masks(sequence: str) -> np.ndarray:
    """Set of bases at every position, as bits."""
    code = CODES[np.frombuffer(sequence.encode("ascii", "replace"), np.uint8)]
    return np.where(code < len(BASES), 1 << np.minimum(code, len(BASES) - 1), ANY).astype(np.uint8)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def site_columns(cells: DataFrame) -> DataFrame:
    """(tree, data): a 64-bit hash of every column of a tree's alignment, as bytes.

    Sums of hashes of taxon and base; tasks sum their own rows, and the sums meet per piece of ``PIECE`` columns.
    """
    schema = "tree string, piece int, data binary"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for tree, salt, sequence in zip(batch["tree"], batch["salt"], batch["sequence"], strict=True):
                own = _mixed(_mixed(np.uint64(salt & (1 << 64) - 1) + masks(sequence).astype(np.uint64)))
                if tree in sums and len(sums[tree]) != len(own):
                    raise ValueError("rows of a tree differ in width")
                sums[tree] = own if tree not in sums else sums[tree] + own
        yield pd.DataFrame(
            [(tree, k // PIECE, total[k : k + PIECE].tobytes()) for tree, total in sums.items() for k in range(0, max(len(total), 1), PIECE)],
            columns=["tree", "piece", "data"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, np.uint64) for x in rows["data"]]
        if len({len(p) for p in parts}) > 1:
            raise ValueError("rows of a tree differ in width")
        first = rows.iloc[[0]].copy()
        first["data"] = [sum(parts[1:], parts[0]).tobytes()]
        return first

    pieces = cells.where("sequence IS NOT NULL").select("tree", F.xxhash64("label").alias("salt"), "sequence").mapInPandas(count, schema)
    summed = pieces.groupBy("tree", "piece").applyInPandas(add, schema)
    # As many pieces as the alignment is wide.
    listed = F.array_sort(F.collect_list(F.struct("piece", "data")))
    return summed.groupBy("tree").agg(F.aggregate(listed, F.lit(b""), lambda a, x: F.concat(a, x["data"])).alias("data"))


def site_patterns(cells: DataFrame) -> DataFrame:
    """(tree, places, weights): one place of every different column of a tree's alignment, and how many columns are like it.

    Places stand in the order of the columns' hashes.
    """
    @F.pandas_udf("places array<int>, weights array<int>")
    def unique(data: pd.Series) -> pd.DataFrame:
        out = [np.unique(np.frombuffer(x, np.uint64), return_index=True, return_counts=True) for x in data]
        return pd.DataFrame({"places": [x[1].tolist() for x in out], "weights": [x[2].tolist() for x in out]})

    return site_columns(cells).select("tree", unique("data").alias("u")).select("tree", "u.places", "u.weights")


def _pack(weights: np.ndarray, state: np.ndarray) -> bytes:
    return weights.astype("<i4").tobytes() + np.ascontiguousarray(state).tobytes()


def _set_parts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 5
    return np.frombuffer(data, "<i4", n), np.frombuffer(data, np.uint8, n, 4 * n)


@F.pandas_udf(T.BinaryType())
def _tip_sets(sequence: pd.Series, places: pd.Series, weights: pd.Series) -> pd.Series:
    def one(text, at, count):
        at, count = np.asarray(at, np.int64), np.asarray(count, np.int32)
        own = masks(text)[at] if isinstance(text, str) else np.full(len(at), ANY, np.uint8)
        return _pack(count, own)

    return pd.Series([one(*row) for row in zip(sequence, places, weights, strict=True)])


def joined_sets(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bases that both sides allow, otherwise those of either; and where a change is needed."""
    both = one & two
    return np.where(both > 0, both, one | two), both == 0


def _merge_sets(one, two):
    if two is None:
        return one[0], one[1], one[0], None
    weights, a = _set_parts(one[0])
    _, b = _set_parts(two[0])
    state, change = joined_sets(a, b)
    return _pack(weights, state), one[1] + two[1] + float(weights[change].sum()), one[0], two[0]


def _tips(cells: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Binary node table, and its tips with sequence and patterns. Tips without sequence may be anything."""
    two = cut_lineage(binary(nodes.select("tree", "node", "parent", "length", "label")))
    named = two.where("label IS NOT NULL").select("tree", "node", "label")
    # As many names as tips: never broadcast, so that they do not go through the driver.
    rows = cells.select("tree", "label", "sequence").join(named.hint("merge"), ["tree", "label"], "left_semi")
    found = cut_lineage(site_patterns(rows))
    return two, cut_lineage(named.join(rows.hint("merge"), ["tree", "label"], "left").join(found, "tree"))


def parsimony(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, changes): fewest base changes on each tree, for aligned ``cells`` (tree, label, sequence).

    Nodes of more than two children are resolved as :func:`guided.binary` does; three at the root change nothing.
    """
    two, tips = _tips(cells, nodes)
    states = tips.select("tree", "node", _tip_sets("sequence", "places", "weights").alias("state"), F.lit(0.0).alias("score"))
    roots, _ = fold_up(states, two, _merge_sets, "binary")
    return roots.select("tree", F.col("score").cast("long").alias("changes"))


def branch_change(partial: np.ndarray, length: float, factors: np.ndarray) -> np.ndarray:
    """Partial likelihoods (factor, pattern, base) seen over a branch, by the Jukes-Cantor model."""
    stay = np.exp(-4.0 * length * factors / 3.0)[:, None, None]
    return stay * partial + (1.0 - stay) * partial.mean(axis=2, keepdims=True)


def _likelihood_parts(data: bytes, factors: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // (4 + 8 * 5 * factors)
    numbers = np.frombuffer(data, "<f8", 5 * n * factors, 4 * n)
    return np.frombuffer(data, "<i4", n), numbers[: n * factors].reshape(factors, n), numbers[n * factors :].reshape(factors, n, 4)


def _tip_likelihoods(factors: int):
    @F.pandas_udf(T.BinaryType())
    def tip(sets: pd.Series) -> pd.Series:
        def one(data):
            weights, own = _set_parts(data)
            partial = (own[:, None] >> np.arange(4) & 1).astype(np.float64)
            return _pack(weights, np.concatenate([np.zeros(factors * len(own)), np.tile(partial.ravel(), factors)]))

        return sets.map(one)

    return tip


def _merge_likelihoods(factors: np.ndarray):
    def merge(one, two):
        weights, scale, partial = _likelihood_parts(one[0], len(factors))
        partial = branch_change(partial, one[2], factors)
        if two is not None:
            _, scale_too, partial_too = _likelihood_parts(two[0], len(factors))
            scale, partial = scale + scale_too, partial * branch_change(partial_too, two[2], factors)
        # The largest of a pattern's four is brought to 1, and its logarithm kept.
        top = partial.max(axis=2)
        scale, partial = scale + np.log(top), partial / top[:, :, None]
        return _pack(weights, np.concatenate([scale.ravel(), partial.ravel()])), 0.0, None, None

    return merge


def _root_likelihoods(factors: int):
    @F.pandas_udf("array<double>")
    def root(state: pd.Series) -> pd.Series:
        def one(data):
            weights, scale, partial = _likelihood_parts(data, factors)
            return ((np.log(partial.mean(axis=2)) + scale) * weights).sum(axis=1).tolist()

        return state.map(one)

    return root


def _logs(two: DataFrame, sets: DataFrame, factors: tuple[float, ...]) -> DataFrame:
    states = sets.select("tree", "node", _tip_likelihoods(len(factors))("state").alias("state"), F.lit(0.0).alias("score"))
    roots, _ = fold_up(states, two, _merge_likelihoods(np.array(factors)), "binary")
    return roots.select("tree", _root_likelihoods(len(factors))("state").alias("logs"))


def likelihood(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, log_likelihood) of aligned ``cells`` on each tree with its branch lengths, by the Jukes-Cantor model."""
    two, tips = _tips(cells, nodes)
    sets = tips.select("tree", "node", _tip_sets("sequence", "places", "weights").alias("state"))
    return _logs(two, sets, (1.0,)).select("tree", F.element_at("logs", 1).alias("log_likelihood"))


def fitted_likelihood(cells: DataFrame, nodes: DataFrame, rounds: int = 3) -> DataFrame:
    """(tree, scale, log_likelihood): the factor of all branch lengths of a tree with the best likelihood.

    A grid of factors is tried at once around the best so far, in each round at a quarter of the spacing.
    """
    two, tips = _tips(cells, nodes)
    sets = cut_lineage(tips.select("tree", "node", _tip_sets("sequence", "places", "weights").alias("state")))
    best = cut_lineage(tips.select("tree").distinct().withColumn("scale", F.lit(1.0)))
    power = 1.0
    for _ in range(rounds):
        factors = tuple(f**power for f in FACTORS)
        scaled = two.join(best, "tree").select("tree", "node", "parent", (F.col("length") * F.col("scale")).alias("length"), "label")
        logs = _logs(cut_lineage(scaled), sets, factors)
        top = F.array_max(F.arrays_zip(F.col("logs").alias("log"), F.lit(list(factors)).alias("factor")))
        best = cut_lineage(
            logs.select("tree", top.alias("top")).join(best.select("tree", "scale"), "tree")
            .select("tree", (F.col("scale") * F.col("top.factor")).alias("scale"), F.col("top.log").alias("log_likelihood"))
        )
        power /= 4
    return best


def _branch_sets(two: DataFrame, tips: DataFrame) -> DataFrame:
    """(tree, node, branch): the sets that a taxon would meet on the branch above each node.

    Down the tree from the root, a round per level: what a node's branch sees of the rest is joined from the parent's rest and the sibling.
    """
    states = tips.select("tree", "node", _tip_sets("sequence", "places", "weights").alias("state"), F.lit(0.0).alias("score"))
    _, kept = fold_up(states, two, _merge_sets, "binary")
    kept = cut_lineage(kept.select("tree", "node", "up", F.col("kept").alias("own")))
    # At most two children a node.
    one, other = kept.alias("a"), kept.alias("b").hint("merge")
    pairs = cut_lineage(one.join(other, (F.col("a.tree") == F.col("b.tree")) & (F.col("a.up") == F.col("b.up")) & (F.col("a.node") != F.col("b.node")), "left").select(
        "a.tree", "a.node", "a.up", "a.own", F.col("b.own").alias("sibling")))

    @F.pandas_udf(T.BinaryType())
    def meet(one: pd.Series, two: pd.Series) -> pd.Series:
        def join(a, b):
            if a is None or b is None:
                return b if a is None else a
            weights, x = _set_parts(a)
            return _pack(weights, joined_sets(x, _set_parts(b)[1])[0])

        return pd.Series([join(*pair) for pair in zip(one, two, strict=True)])

    roots = two.where("parent IS NULL").select("tree", F.col("node").alias("up"), F.lit(None).cast("binary").alias("rest"))
    level, levels = cut_lineage(roots), []
    while True:
        now = cut_lineage(pairs.join(level, ["tree", "up"]).select("tree", "node", "own", meet("rest", "sibling").alias("rest")))
        if now.isEmpty():
            break
        levels.append(now.select("tree", "node", meet("own", "rest").alias("branch")))
        level = now.select("tree", F.col("node").alias("up"), "rest")
    found = levels[0] if levels else pairs.select("tree", "node", F.col("own").alias("branch"))
    for more in levels[1:]:
        found = found.unionByName(more)
    return found


def placements(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, label, node, added): for every taxon of ``cells`` that is no tip, the branch above which node adds fewest changes.

    ``cells``: aligned (tree, label, sequence) of tips and missing taxa. The number of changes is exact: the tree with the taxon on that branch
    needs so many more. Ties go to the smaller node. Missing taxa are scored in blocks; a task keeps the best branch of each only.
    """
    named = nodes.where("label IS NOT NULL").select("tree", "label").distinct()
    two, tips = _tips(cells, nodes)
    branches = cut_lineage(_branch_sets(two, tips))
    patterns = tips.select("tree", "places", "weights").dropDuplicates(["tree"])
    missing = cells.where("sequence IS NOT NULL").select("tree", "label", "sequence").join(named.hint("merge"), ["tree", "label"], "left_anti")
    # All columns of a missing taxon are kept; the branch's patterns are spread over them.
    sets = missing.join(nodes.select("tree").distinct(), "tree", "left_semi").select("tree", "label", "sequence")
    numbered = number_rows(sets, ["label"], ["tree"], "_r")
    blocks = numbered.groupBy("tree", F.floor((F.col("_r") - 1) / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("label", "sequence"))).alias("taxa"))
    columns = cut_lineage(_columns(cells.join(named.hint("merge"), ["tree", "label"], "left_semi"), patterns))
    ready = branches.join(columns, "tree").join(blocks, "tree").select("tree", "node", "branch", "column", "taxa")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[tuple[str, str], tuple[int, str]] = {}
        for batch in batches:
            for tree, node, branch, column, taxa in batch.itertuples(index=False):
                own = _set_parts(branch)[1][np.frombuffer(column, "<i4")]
                grid = np.array([masks(t["sequence"]) for t in taxa])
                added = (grid & own == 0).sum(axis=1)
                for taxon, n in zip(taxa, added.tolist(), strict=True):
                    key = tree, taxon["label"]
                    best[key] = min(best.get(key, (n, node)), (n, node))
        yield pd.DataFrame([(*key, node, n) for key, (n, node) in best.items()], columns=["tree", "label", "node", "added"])

    return ready.mapInPandas(score, "tree string, label string, node string, added long").groupBy("tree", "label").agg(
        F.min(F.struct("added", "node")).alias("best")).select("tree", "label", "best.node", "best.added")


def _columns(cells: DataFrame, patterns: DataFrame) -> DataFrame:
    """(tree, column): number of the pattern of every column, in the order of ``places``.

    Computed from the same hashes as the patterns.
    """
    hashed = site_columns(cells)

    @F.pandas_udf(T.BinaryType())
    def number(data: pd.Series, places: pd.Series) -> pd.Series:
        def one(x, at):
            whole = np.frombuffer(x, np.uint64)
            return np.searchsorted(whole[np.asarray(at, np.int64)], whole).astype("<i4").tobytes()

        return pd.Series([one(*pair) for pair in zip(data, places, strict=True)])

    return hashed.join(patterns, "tree").select("tree", number("data", "places").alias("column"))


def insert_tips(nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """``nodes`` with the tips of ``placed`` (tree, label, node) hung on the branch above their node.

    Several on one branch hang one above the other in the order of labels; the branch is divided evenly, the new tips get no length.
    """
    numbered = number_rows(placed.select("tree", "label", "node"), ["label"], ["tree", "node"], "_r")
    counts = placed.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("_k"))
    hung = cut_lineage(numbered.join(counts, ["tree", "node"]).join(nodes.select("tree", "node", "parent", F.col("length").alias("_l")), ["tree", "node"]))
    inner = lambda r: F.concat_ws("+", "node", r.cast("string"))
    share = F.col("_l") / (F.col("_k") + 1)
    rank = F.col("_r")
    none = F.lit(None)
    joints = hung.select(
        "tree", inner(rank).alias("node"), F.when(rank == F.col("_k"), F.col("parent")).otherwise(inner(rank + 1)).alias("parent"),
        share.alias("length"), none.cast("string").alias("label"))
    tips = hung.select("tree", F.concat_ws("+", "node", rank.cast("string"), F.lit("tip")).alias("node"), inner(rank).alias("parent"),
                       none.cast("double").alias("length"), "label")
    first = counts.select("tree", "node", "_k")
    old = nodes.join(first, ["tree", "node"], "left").select(
        "tree", "node", F.when(F.col("_k").isNotNull(), F.concat_ws("+", "node", F.lit("1"))).otherwise(F.col("parent")).alias("parent"),
        F.when(F.col("_k").isNotNull(), F.col("length") / (F.col("_k") + 1)).otherwise(F.col("length")).alias("length"), "label")
    return old.unionByName(joints).unionByName(tips)
