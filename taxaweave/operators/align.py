"""Multiple alignment around a centre sequence, as joins and aggregates.

Every sequence is aligned to the centre of its group on its own (the only
step that runs in Python, a block of pairs at a time). The pairs are then merged: the
widest insertion before each centre position, an aggregate over the group,
fixes the columns, and each row is spelled out by itself. No task ever holds
a whole group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.operators.clusters import best_by
from taxaweave.session import cut_lineage

# Scores of equal and unequal bases and of a gap position.
EQUAL, UNEQUAL, GAP = 5, -4, -6
# Fixed value: cells of the tables that are filled together.
CELLS = 1 << 20


def path_to_centre(centre: str, sequence: str) -> str:
    """``sequence`` along ``centre``: capitals and gaps at centre positions, insertions in small letters.

    Both are letters; ``*`` marks a column that is a gap, ``.`` an inserted one.
    """
    return paths_to_centre(centre, [sequence])[0]


def blocks(lengths: list[int], height: int) -> Iterator[list[int]]:
    """Places of ``lengths``, those of like length together, so that a block of tables of that ``height`` has about ``CELLS`` cells."""
    order = sorted(range(len(lengths)), key=lengths.__getitem__)
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and (end + 1 - start) * (height + 1) * (lengths[order[end]] + 1) <= CELLS:
            end += 1
        yield order[start:end]
        start = end


def paths_to_centre(centre: str, sequences: list[str]) -> list[str]:
    """:func:`path_to_centre` of many sequences; the tables of a block are filled together."""
    a = np.frombuffer(centre.encode("ascii", "replace"), dtype=np.uint8)
    codes = [np.frombuffer(s.encode("ascii", "replace"), dtype=np.uint8) for s in sequences]
    out = [""] * len(sequences)
    for block in blocks([len(c) for c in codes], len(a)):
        width = len(codes[block[-1]])
        # Cells beyond the end of a shorter sequence are filled too, but no path comes from there.
        b = np.zeros((len(block), width), dtype=np.uint8)
        for k, at in enumerate(block):
            b[k, : len(codes[at])] = codes[at]
        steps = np.arange(width + 1) * GAP
        row = np.repeat(steps[None, :], len(block), axis=0)
        back = np.zeros((len(block), len(a) + 1, width + 1), dtype=np.int8)
        back[:, 0, :], back[:, :, 0] = 2, 1
        best = np.empty_like(row)
        for i in range(1, len(a) + 1):
            diagonal = row[:, :-1] + np.where(b == a[i - 1], EQUAL, UNEQUAL)
            above = row[:, 1:] + GAP
            best[:, 0] = i * GAP
            np.maximum(diagonal, above, out=best[:, 1:])
            row = np.maximum.accumulate(best - steps, axis=1) + steps
            back[:, i, 1:] = np.where(row[:, 1:] == diagonal, 0, np.where(row[:, 1:] == above, 1, 2))
        for k, at in enumerate(block):
            out[at] = _walked(back[k].tobytes(), width + 1, len(a), sequences[at])
    return out


def _walked(back: bytes, width: int, i: int, sequence: str) -> str:
    j, out = len(sequence), []
    while i or j:
        step = back[i * width + j] if i and j else (1 if i else 2)
        if step == 0:
            i, j = i - 1, j - 1
            out.append(sequence[j].upper())
        elif step == 1:
            i -= 1
            out.append("-")
        else:
            j -= 1
            out.append("." if sequence[j] == "*" else sequence[j].lower())
    return "".join(reversed(out))


def by_first(first: pd.Series, second: pd.Series, solve) -> pd.Series:
    """``solve(x, [y, ...])`` for the pairs of two columns: each distinct pair once, all of one x together."""
    wanted: dict = {}
    for x, y in zip(first, second, strict=True):
        wanted.setdefault(x, {})[y] = None
    found = {x: dict(zip(ys, solve(x, list(ys)), strict=True)) for x, ys in wanted.items()}
    return pd.Series([found[x][y] for x, y in zip(first, second, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def _paths(centre: pd.Series, sequence: pd.Series) -> pd.Series:
    return by_first(centre, sequence, paths_to_centre)


def dealt(df: DataFrame, *by: Column | str) -> DataFrame:
    """``df`` over all shuffle partitions: few bytes may be much work, and partitions are merged by their bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


@F.pandas_udf(T.StringType())
def _follow(path: pd.Series, sequence: pd.Series) -> pd.Series:
    """Columns of ``sequence`` moved as ``path`` moves those of its group."""
    def one(p, s):
        letters = iter(s)
        # ``.`` stands for a gap inside an insertion.
        return "".join(
            "-" if c == "-" else (lambda x: x.upper() if c.isupper() or c == "*" else x.lower().replace("-", "."))(next(letters))
            for c in p
        )

    return pd.Series([one(p, s) for p, s in zip(path, sequence)])


def _spread(paths: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``path`` to rows with an aligned ``sequence`` of one width per group."""
    pattern = F.lit(r"([a-z.]*)([A-Z*|-])")
    marked = F.concat("path", F.lit("|"))
    cut = paths.withColumn("_ins", F.regexp_extract_all(marked, pattern, F.lit(1))).withColumn(
        "_base", F.regexp_extract_all(marked, pattern, F.lit(2))
    )
    wide = cut.select(*keys, F.posexplode(F.transform("_ins", F.length)).alias("pos", "w")).where("w > 0").groupBy(
        *keys, "pos"
    ).agg(F.max("w").alias("w"))
    # One list per group, no longer than its centre.
    layout = wide.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("pos", "w"))).alias("_wide"))
    joined = cut.join(layout, keys, "left")

    def column(pair: Column, at: Column) -> Column:
        width = F.coalesce(F.try_element_at(F.col("_wide"), at), F.lit(0))
        return F.concat(
            F.rpad(F.translate(F.upper(pair["ins"]), ".", "-"), width, "-"),
            F.translate(pair["base"], "|*", ""),
        )

    zipped = F.arrays_zip(F.col("_ins").alias("ins"), F.col("_base").alias("base"))
    return joined.withColumn("sequence", F.concat_ws("", F.transform(zipped, column))).drop(
        "path", "_ins", "_base", "_wide"
    )


def align(cells: DataFrame, keys: list[str], identifier: str = "accno") -> DataFrame:
    """Align the sequences of each group; a lone sequence is passed through."""
    score = F.length("sequence")
    centres = cells.groupBy(*keys).agg(best_by(identifier, score).alias("_centre"))
    centre_rows = cells.join(
        centres.withColumnRenamed("_centre", identifier), [*keys, identifier], "left_semi"
    ).select(*keys, F.col("sequence").alias("_c"))
    paired = dealt(cells.join(centre_rows, keys), *keys, identifier)
    # The paths are read twice.
    paths = cut_lineage(paired.withColumn("path", _paths("_c", "sequence")).drop("_c", "sequence"))
    return _spread(paths, keys).select(*cells.columns)


def merge_groups(aligned: DataFrame, keys: list[str], group: str, identifier: str = "accno") -> DataFrame:
    """Join the aligned groups of each key into one alignment, columns kept together.

    The centre row of each group is aligned to the longest of them; the other
    rows of the group move along with it.
    """
    bases = F.length(F.replace("sequence", F.lit("-"), F.lit("")))
    fronts = aligned.groupBy(*keys, group).agg(
        F.min_by(F.col("sequence"), F.struct((-bases).alias("b"), F.col(identifier).alias("i"))).alias("_front")
    )
    front = F.translate("_front", "-", "*")
    centre = fronts.groupBy(*keys).agg(
        F.min_by(front, F.struct((-F.length("_front")).alias("b"), F.col(group).alias("g"))).alias("_c")
    )
    moves = dealt(fronts.join(centre, keys), *keys, group).select(*keys, group, _paths("_c", front).alias("_path"))
    together = dealt(aligned.join(moves, [*keys, group]), *keys, identifier)
    moved = cut_lineage(together.withColumn("path", _follow("_path", "sequence")).drop("_path", "sequence"))
    return _spread(moved, keys).select(*aligned.columns)


def merge_by_lineage(aligned: DataFrame, keys: list[str], group: str, path: str, identifier: str = "accno") -> DataFrame:
    """Join the aligned groups of each key from the tips of the taxonomy to its root.

    ``path`` is the group's lineage from the root down, the same for all of its rows.
    Groups below one taxon are merged before the taxon is merged with its
    neighbours, so that each merge joins what is most alike. A group without
    lineage joins at the root.
    """
    columns = aligned.columns
    current = cut_lineage(aligned.withColumn("_at", F.coalesce(path, F.array().cast("array<string>"))))
    depth = current.agg(F.max(F.size("_at")).alias("n")).first()["n"] or 0
    for level in range(depth - 1, -1, -1):
        # Everything below a taxon at this level meets; what stands higher waits.
        below = F.size("_at") > level
        if level == 0:
            below = F.lit(True)
        node = F.slice("_at", F.lit(1), F.lit(level))
        placed = current.withColumn("_node", F.when(below, node)).withColumn("_own", F.col(group))
        counts = placed.where(below).groupBy(*keys, "_node").agg(F.count_distinct("_own").alias("_k")).where("_k > 1")
        meeting = placed.where(below).join(counts.drop("_k"), [*keys, "_node"], "left_semi")
        rest = placed.where(below).join(counts.drop("_k"), [*keys, "_node"], "left_anti").unionByName(placed.where(~below))
        first = meeting.groupBy(*keys, "_node").agg(F.min("_own").alias("_name"))
        merged = merge_groups(meeting, [*keys, "_node"], "_own", identifier).join(first, [*keys, "_node"])
        merged = merged.withColumn(group, F.col("_name")).withColumn("_at", F.col("_node")).drop("_name")
        waiting = rest.withColumn("_at", F.when(below, node).otherwise(F.col("_at")))
        current = cut_lineage(merged.unionByName(waiting).drop("_node", "_own"))
    return current.select(*columns)
