"""Alignment along a guide tree, and the order in which groups wait for their guides.

A node of a guide tree stands for its rows by a profile: how often each letter stands in each column. Profiles of
two children are aligned to each other and added; the parent keeps the profile, and each child a path that tells which of the
parent's columns are its own. A round merges every pair of children that is ready, in all trees at once. Paths are then
joined end to end, doubling their reach each round, until every tip knows its columns at the root. No task holds a group:
the largest value is a profile or a path, as long as the alignment is wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.operators.align import EQUAL, GAP, UNEQUAL, _spread, blocks, by_first, dealt
from taxaweave.operators.outliers import median_deviation
from taxaweave.operators.ranking import number_rows
from taxaweave.session import cut_lineage, forget

# Columns of a profile are the four bases, other letters, and gaps.
BASES, OTHER, NONE = "ACGT", 4, 5
KINDS = 6
# Columns of one summed piece of a profile.
PIECE = 1024
# Taxa that a guide tree has at least.
LEAST_SHARED = 5
# Median absolute deviation of the distances to a group's centre up to which the group counts as alignable.
MAX_SPREAD = 0.05


def _pair_scores() -> np.ndarray:
    scores = np.full((KINDS, KINDS), UNEQUAL, np.int64)
    np.fill_diagonal(scores, EQUAL)
    scores[OTHER, :], scores[:, OTHER] = 0, 0
    scores[NONE, :], scores[:, NONE] = GAP, GAP
    scores[NONE, NONE] = 0
    return scores


SCORES = _pair_scores()


def _codes() -> np.ndarray:
    codes = np.full(256, OTHER, np.int64)
    for k, base in enumerate(BASES):
        codes[[ord(base), ord(base.lower())]] = k
    codes[[ord("U"), ord("u")]] = BASES.index("T")
    codes[ord("-")] = NONE
    return codes


CODES = _codes()


def letters_of(sequence: str) -> np.ndarray:
    """Column kind of every letter."""
    return CODES[np.frombuffer(sequence.encode("ascii", "replace"), np.uint8)]


def profile_of(sequence: str) -> np.ndarray:
    """Profile of one sequence: a row per position."""
    return np.eye(KINDS, dtype=np.int64)[letters_of(sequence)]


def align_profiles(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the merged columns are columns of ``p``, and which of ``q``.

    The best sum over all pairs of rows, in whole numbers; on ties columns are
    matched, then ``p`` goes on alone.
    """
    rows_p, rows_q = int(p[0].sum()) if len(p) else 0, int(q[0].sum()) if len(q) else 0
    match = p @ SCORES @ q.T
    alone_p = (rows_p - p[:, NONE]) * rows_q * GAP
    alone_q = (rows_q - q[:, NONE]) * rows_p * GAP
    steps = np.concatenate([[0], np.cumsum(alone_q)])
    row = steps.copy()
    back = np.zeros((len(p) + 1, len(q) + 1), np.int8)
    back[0, :], back[:, 0] = 2, 1
    for i in range(1, len(p) + 1):
        diagonal = row[:-1] + match[i - 1]
        above = row + alone_p[i - 1]
        best = above.copy()
        best[1:] = np.maximum(diagonal, above[1:])
        row = np.maximum.accumulate(best - steps) + steps
        back[i, 1:] = np.where(row[1:] == diagonal, 0, np.where(row[1:] == above[1:], 1, 2))
    i, j, moves = len(p), len(q), []
    while i or j:
        step = int(back[i, j]) if i and j else (1 if i else 2)
        moves.append(step)
        i, j = i - (step != 2), j - (step != 1)
    moves = np.array(moves[::-1], np.int8)
    return moves != 2, moves != 1


def merged_profile(p: np.ndarray, q: np.ndarray, own_p: np.ndarray, own_q: np.ndarray) -> np.ndarray:
    """Sum of two profiles over their merged columns."""
    total = np.zeros((len(own_p), KINDS), np.int64)
    for profile, own in ((p, own_p), (q, own_q)):
        total[own] += profile
        total[~own, NONE] += int(profile[0].sum()) if len(profile) else 0
    return total


def _packed(profile: np.ndarray) -> bytes:
    return np.ascontiguousarray(profile, "<i8").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(-1, KINDS)


def _state(profile: np.ndarray) -> bytes:
    """A profile as a node keeps it: counts of the fewest bytes that hold them, that number of bytes first."""
    size = next(n for n in (1, 2, 4, 8) if not len(profile) or int(profile.max()) < 1 << (8 * n - 1))
    return bytes([size]) + np.ascontiguousarray(profile, f"<i{size}").tobytes()


def _state_profile(data: bytes) -> np.ndarray:
    """The profile behind :func:`_state`; a single sequence is kept as its letters, after a 0."""
    if data[0] == 0:
        return np.eye(KINDS, dtype=np.int64)[np.frombuffer(data, np.uint8, offset=1)]
    return np.frombuffer(data, f"<i{data[0]}", offset=1).reshape(-1, KINDS).astype(np.int64)


def _path(own: np.ndarray) -> bytes:
    """A path as bits, after the number of bits that the last byte lacks."""
    return bytes([-len(own) % 8]) + np.packbits(own).tobytes()


def _path_columns(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8, offset=1), count=8 * (len(data) - 1) - data[0]).astype(bool)


@F.pandas_udf(T.BinaryType())
def _profiles(sequence: pd.Series) -> pd.Series:
    return sequence.map(lambda s: bytes(1) + letters_of(s if isinstance(s, str) else "").astype(np.uint8).tobytes())


@F.pandas_udf(T.BinaryType())
def _composed(lower: pd.Series, upper: pd.Series) -> pd.Series:
    """A path over a node's columns as one over the columns of the node above."""
    def one(own, above):
        if above is None:
            return own
        out = _path_columns(above)
        out[out] = _path_columns(own)
        return _path(out)

    return pd.Series([one(*pair) for pair in zip(lower, upper, strict=True)])


@F.pandas_udf(T.StringType())
def _spelled(sequence: pd.Series, path: pd.Series) -> pd.Series:
    def one(text, own):
        if own is None:
            return text
        columns = _path_columns(own)
        out = np.full(len(columns), ord("-"), "<u4")
        out[columns] = np.array([ord(c) for c in text or ""], "<u4")
        return out.tobytes().decode("utf-32-le")

    return pd.Series([one(*pair) for pair in zip(sequence, path, strict=True)])


def binary(nodes: DataFrame) -> DataFrame:
    """Node tables whose nodes have at most two children: neighbours in the order of names are paired, at length 0."""
    current, step = nodes, 0
    while True:
        many = current.where("parent IS NOT NULL").groupBy("tree", "parent").agg(F.count(F.lit(1)).alias("_k")).where("_k > 2")
        many = cut_lineage(many)
        if many.isEmpty():
            return current
        numbered = number_rows(current.join(many, ["tree", "parent"]), ["node"], ["tree", "parent"], "_r")
        pair = F.floor((F.col("_r") - 1) / 2)
        alone = (F.col("_r") == F.col("_k")) & (F.col("_k") % 2 == 1)
        named = cut_lineage(numbered.withColumn(
            "_up", F.when(~alone, F.concat_ws("~", "parent", F.lit(str(step)), pair.cast("string")))))
        fresh = named.where("_up IS NOT NULL").select(
            "tree", F.col("_up").alias("node"), "parent", F.lit(0.0).alias("length"), F.lit(None).cast("string").alias("label")
        ).distinct()
        moved = named.select("tree", "node", F.coalesce("_up", "parent").alias("parent"), "length", "label")
        rest = current.join(many, ["tree", "parent"], "left_anti").select("tree", "node", "parent", "length", "label")
        current, step = cut_lineage(rest.unionByName(moved).unionByName(fresh)), step + 1


def fold_up(tips: DataFrame, nodes: DataFrame, merge, extra: str) -> tuple[DataFrame, DataFrame]:
    """Merge the states of children into their parents', level by level, in all trees at once.

    ``tips``: (tree, node, state, score) with binary states; ``nodes`` has at most two children a node.
    ``merge`` takes the two (state, score, length) of a pair and gives (state, score, left, right); ``left`` and ``right``
    (of SQL type ``extra``) are kept with the children. Returns the roots' (tree, node, state, score) and (tree, node, up, kept).
    """
    above = nodes.select("tree", "node", F.col("parent").alias("up"), F.coalesce("length", F.lit(0.0)).alias("length"))
    arity = above.where("up IS NOT NULL").groupBy("tree", "up").agg(F.count(F.lit(1)).alias("k"))
    # Every node with the number of its siblings, itself included; joins here are never broadcasts, so that nothing goes through the driver.
    above = cut_lineage(above.join(arity.hint("merge"), ["tree", "up"], "left").select("tree", "node", "up", "length", "k"))
    current = cut_lineage(tips.join(above.hint("merge"), ["tree", "node"]))
    open_ = above.join(arity.select("tree", F.col("up").alias("node")).hint("merge"), ["tree", "node"], "left_semi")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tree, up, k, children in zip(batch["tree"], batch["up"], batch["k"], batch["children"], strict=True):
                if len(children) != k:
                    # These wait for the others.
                    out += [(tree, c["node"], c["state"], c["score"], None, None, None, None, up, c["length"], k) for c in children]
                    continue
                parts = [(c["state"], c["score"], c["length"]) for c in children]
                state, score, left, right = merge(*parts) if len(parts) == 2 else merge(parts[0], None)
                out.append((
                    tree, up, state, score, children[0]["node"], left, children[1]["node"] if len(parts) == 2 else None, right, None, None, None))
            yield pd.DataFrame(out, columns=names).astype({"k": "Int64"})

    schema = (
        f"tree string, node string, state binary, score double, one string, kept_one {extra}, two string, kept_two {extra}, "
        "up string, length double, k long")
    names = [part.split()[0] for part in schema.split(", ")]
    row = ["tree", "node", "up", "length", "k", "state", "score"]
    kept, roots = [], [current.where("up IS NULL").select("tree", "node", "state", "score")]
    while True:
        # At most two children each.
        groups = current.where("up IS NOT NULL").groupBy("tree", "up", "k").agg(
            F.array_sort(F.collect_list(F.struct("node", "state", "score", "length"))).alias("children"))
        solved = cut_lineage(groups.mapInPandas(solve, schema))
        merged, waiting = solved.where("one IS NOT NULL"), solved.where("one IS NULL").select(*row)
        if merged.isEmpty():
            break
        # Nodes still open shrink from round to round: each finds its state once.
        found = cut_lineage(open_.join(merged.select("tree", "node", "state", "score").hint("merge"), ["tree", "node"], "left"))
        open_ = found.where("state IS NULL").select("tree", "node", "up", "length", "k")
        fresh = found.where("state IS NOT NULL").select(*row)
        roots.append(fresh.where("up IS NULL").select("tree", "node", "state", "score"))
        current = waiting.unionByName(fresh)
        kept += [
            merged.select("tree", F.col("one").alias("node"), F.col("node").alias("up"), F.col("kept_one").alias("kept")),
            merged.where("two IS NOT NULL").select("tree", F.col("two").alias("node"), F.col("node").alias("up"), F.col("kept_two").alias("kept")),
        ]
    if not kept:
        spark = nodes.sparkSession
        return current.select("tree", "node", "state", "score"), spark.createDataFrame([], f"tree string, node string, up string, kept {extra}")
    top = roots[0]
    for more in roots[1:]:
        top = top.unionByName(more)
    paths = kept[0]
    for more in kept[1:]:
        paths = paths.unionByName(more)
    return top, cut_lineage(paths)


def _merge_profiles(one, two):
    p = _state_profile(one[0])
    if two is None:
        return one[0], 0.0, _path(np.ones(len(p), bool)), None
    q = _state_profile(two[0])
    own_p, own_q = align_profiles(p, q)
    return _state(merged_profile(p, q, own_p, own_q)), 0.0, _path(own_p), _path(own_q)


def align_along(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, label, sequence): the sequences of each tree's tips, aligned along the tree.

    ``cells`` has one row (tree, label, sequence) per tip; a tip without sequence takes no
    part, and a sequence whose label is no tip of its tree is left out. Joined nodes are merged from the tips to the root.
    """
    two = binary(nodes.select("tree", "node", "parent", "length", "label"))
    tips = cut_lineage(two.where("label IS NOT NULL").select("tree", "node", "label").join(
        cells.select("tree", "label", "sequence").hint("merge"), ["tree", "label"], "left"))
    states = tips.select("tree", "node", _profiles("sequence").alias("state"), F.lit(0.0).alias("score"))
    _, paths = fold_up(states, two, _merge_profiles, "binary")
    current = paths
    while True:
        further = current.select("tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("kept").alias("_kept")).hint("merge")
        if current.join(further, ["tree", "up"], "left_semi").isEmpty():
            break
        before = current
        current = cut_lineage(
            current.join(further, ["tree", "up"], "left").select(
                "tree", "node", F.coalesce("_up", "up").alias("up"), _composed("kept", "_kept").alias("kept"))
        )
        forget(before)
    return tips.where("sequence IS NOT NULL").join(current.select("tree", "node", "kept").hint("merge"), ["tree", "node"], "left").select(
        "tree", "label", _spelled("sequence", "kept").alias("sequence")
    )


def profiles(aligned: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, profile): how often each letter stands in each column of a group's rows.

    Tasks sum their own rows; the sums meet per piece of ``PIECE`` columns.
    """
    fields = aligned.select(*keys).schema.fields
    schema = T.StructType([*fields, T.StructField("piece", T.IntegerType()), T.StructField("data", T.BinaryType())])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                key, own = tuple(row[:-1]), profile_of(row[-1])
                if key not in sums:
                    sums[key] = own
                elif len(sums[key]) == len(own):
                    sums[key] += own
                else:
                    raise ValueError("rows of a group differ in width")
        out = [(*key, k // PIECE, _packed(total[k : k + PIECE])) for key, total in sums.items() for k in range(0, len(total), PIECE)]
        yield pd.DataFrame(out, columns=[*keys, "piece", "data"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        first, parts = rows.iloc[[0]].copy(), [_unpacked(x) for x in rows["data"]]
        if len({len(p) for p in parts}) > 1:
            raise ValueError("rows of a group differ in width")
        first["data"] = [_packed(sum(parts))]
        return first

    pieces = aligned.where("sequence IS NOT NULL").select(*keys, "sequence").mapInPandas(count, schema)
    summed = pieces.groupBy(*keys, "piece").applyInPandas(add, schema)
    # As many pieces as the alignment is wide.
    listed = F.array_sort(F.collect_list(F.struct("piece", "data")))
    return summed.groupBy(*keys).agg(F.aggregate(listed, F.lit(b""), lambda a, x: F.concat(a, x["data"])).alias("profile"))


def profile_counts(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, letter, n): the counts of :func:`profiles`, a row each; other letters are ``N``."""
    fields = found.select(*keys).schema.fields
    schema = T.StructType([
        *fields, T.StructField("pos", T.IntegerType()), T.StructField("letter", T.StringType()), T.StructField("n", T.LongType())])

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                profile = _unpacked(row[-1])
                for at, kind in zip(*np.nonzero(profile), strict=True):
                    out.append((*row[:-1], int(at) + 1, f"{BASES}N-"[kind], int(profile[at, kind])))
            yield pd.DataFrame(out, columns=schema.names)

    return found.select(*keys, "profile").mapInPandas(spell, schema)


def letters_along(data: bytes | None, texts: list[str]) -> list[str]:
    """Each text along a profile as :func:`align_profiles` places it: capitals in the profile's columns, small letters between."""
    if data is None:
        return [text.upper() for text in texts]
    p, codes = _unpacked(data), [letters_of(text) for text in texts]
    scores, rows = p @ SCORES, int(p[0].sum()) if len(p) else 0
    out = [""] * len(texts)
    for block in blocks([len(c) for c in codes], len(p)):
        width = len(codes[block[-1]])
        # Cells beyond the end of a shorter text are filled too, but no path comes from there.
        b = np.full((len(block), width), NONE)
        for k, at in enumerate(block):
            b[k, : len(codes[at])] = codes[at]
        one = np.array([len(codes[at]) > 0 for at in block], np.int64)
        steps = np.zeros((len(block), width + 1), np.int64)
        np.cumsum((b != NONE) * rows * GAP, axis=1, out=steps[:, 1:])
        row = steps.copy()
        back = np.zeros((len(block), len(p) + 1, width + 1), np.int8)
        back[:, 0, :], back[:, :, 0] = 2, 1
        for i in range(1, len(p) + 1):
            diagonal = row[:, :-1] + scores[i - 1][b]
            above = row + (one * (rows - int(p[i - 1, NONE])) * GAP)[:, None]
            best = above.copy()
            best[:, 1:] = np.maximum(diagonal, above[:, 1:])
            row = np.maximum.accumulate(best - steps, axis=1) + steps
            back[:, i, 1:] = np.where(row[:, 1:] == diagonal, 0, np.where(row[:, 1:] == above[:, 1:], 1, 2))
        for k, at in enumerate(block):
            out[at] = _placed(back[k].tobytes(), width + 1, len(p), texts[at])
    return out


def _placed(back: bytes, width: int, i: int, text: str) -> str:
    j, out = len(text), []
    while i or j:
        step = back[i * width + j] if i and j else (1 if i else 2)
        i, j = i - (step != 2), j - (step != 1)
        out.append("-" if step == 1 else text[j].upper() if step == 0 else text[j].lower())
    return "".join(reversed(out))


@F.pandas_udf(T.StringType())
def _along_profile(profile: pd.Series, sequence: pd.Series) -> pd.Series:
    return by_first(profile, sequence, letters_along)


def add_sequences(aligned: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """``aligned`` with the rows of ``extra`` (same columns, letters without gaps) added to their group's alignment.

    Each is aligned to the profile of the whole group; the group's own columns stay together as they are, and letters
    that fit none of them get columns in between. A group that has no rows yet must get one row only.
    """
    known = profiles(aligned, keys)
    # Rows find the profile of their group where they are dealt to, so that no task gets a group for itself.
    spread = dealt(extra.where("sequence IS NOT NULL"), *[c for c in extra.columns if c != "sequence"])
    placed = spread.join(known, keys, "left").withColumn("path", _along_profile("profile", "sequence"))
    placed = cut_lineage(placed.drop("profile", "sequence"))
    paths = aligned.withColumn("path", F.upper("sequence")).drop("sequence").unionByName(placed)
    return _spread(paths, keys).select(*aligned.columns)


def alignability(cells: DataFrame, limit: float = MAX_SPREAD) -> DataFrame:
    """(gene, grp, n, median, mad, alignable) of every group of sequences (gene, grp, accno, sequence).

    Distances are those to the group's longest sequence (ties: smallest record), so that a group of n rows has n - 1 of
    them; where they scatter (median absolute deviation above ``limit``) the group is not alignable by itself.
    """
    from taxaweave.functions import jukes_cantor
    from taxaweave.operators.clusters import best_by

    keys = ["gene", "grp"]
    rows = cells.where("sequence IS NOT NULL").select(*keys, "accno", "sequence")
    lead = rows.groupBy(*keys).agg(best_by("accno", F.length("sequence")).alias("accno"))
    centre = rows.join(lead, [*keys, "accno"], "left_semi").select(*keys, F.col("accno").alias("_a"), F.col("sequence").alias("_s"))
    share = F.levenshtein("sequence", "_s") / F.greatest(F.length("sequence"), F.length("_s"), F.lit(1))
    # Beyond three quarters Jukes and Cantor know no distance: the farthest they know.
    far = jukes_cantor(F.lit(0.749))
    distances = cut_lineage(rows.join(centre, keys).where("accno <> _a").select(*keys, F.coalesce(jukes_cantor(share), far).alias("distance")))
    spread = median_deviation(distances, keys, "distance")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(spread, keys, "left").select(
        *keys, "n", "median", "mad", (F.coalesce("mad", F.lit(0.0)) <= limit).cast("int").alias("alignable")
    )


def guide_rounds(groups: DataFrame, needs: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """(gene, grp, round, guide): when each group is aligned, and along the tree of which gene.

    ``groups``: (gene, grp, alignable). ``needs``: (gene, grp, guide, guide_grp, place, shared): so many taxa of the group have
    their sequence of ``guide`` in ``guide_grp``. Alignable groups are settled in round 0. A group is settled in the first
    round in which, over the settled groups of a guide, ``least`` of its taxa or more are aligned, by the guide with the highest place among those (ties: larger name).
    Groups that wait for each other, or have no guide, are aligned without one: round and guide are null.
    """
    names = groups.select("gene", "grp", "alignable").dropDuplicates(["gene", "grp"])
    settled = cut_lineage(names.where("alignable = 1").select("gene", "grp", F.lit(0).alias("round"), F.lit(None).cast("string").alias("guide")))
    open_ = names.where("coalesce(alignable, 0) <> 1").select("gene", "grp")
    waits = cut_lineage(needs.join(open_, ["gene", "grp"], "left_semi").where("guide <> gene"))
    step = 0
    while True:
        step += 1
        done = settled.select(F.col("gene").alias("guide"), F.col("grp").alias("guide_grp"))
        ready = (
            waits.join(settled, ["gene", "grp"], "left_anti").join(done, ["guide", "guide_grp"])
            .groupBy("gene", "grp", "guide", "place").agg(F.sum("shared").alias("shared")).where(F.col("shared") >= least)
            .groupBy("gene", "grp").agg(F.max_by("guide", F.struct("place", "guide")).alias("guide"))
        )
        now = cut_lineage(ready.select("gene", "grp", F.lit(step).alias("round"), "guide"))
        if now.isEmpty():
            break
        settled = cut_lineage(settled.unionByName(now))
    rest = names.select("gene", "grp").join(settled, ["gene", "grp"], "left_anti")
    return settled.unionByName(rest.select("gene", "grp", F.lit(None).cast("int").alias("round"), F.lit(None).cast("string").alias("guide")))


def scale_branches(nodes: DataFrame, ratios: DataFrame) -> DataFrame:
    """Branch lengths times the ratio of their tree (tree, ratio); trees without one stay."""
    return nodes.join(ratios.select("tree", "ratio"), "tree", "left").select(
        "tree", "node", "parent", (F.col("length") * F.coalesce("ratio", F.lit(1.0))).alias("length"), "label"
    )
