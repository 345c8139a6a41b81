"""Inspect and edit record metadata: distinct values, shared values, change lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.session import cut_lineage


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def shared_values(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows whose value in one column also occurs in another, for every ordered pair."""
    parts = []
    for one, other in permutations(columns, 2):
        values = df.select(F.col(other).alias("value")).where("value IS NOT NULL").distinct()
        rows = df.select(
            F.lit(one).alias("column"), F.lit(other).alias("also_in"), F.col(key),
            F.col(one).alias("value"), F.col(other).alias("other_value"),
        )
        # Only a partition's distinct values are held; the rows go past them and are never sorted.
        parts.append(rows.join(values.hint("shuffle_hash"), "value", "left_semi").select(*rows.columns))
    return reduce(DataFrame.unionByName, parts)


def close_changes(changes: DataFrame) -> DataFrame:
    """(old, new) after applying the rows of (line, old, new) in file order.

    A value changed by one line is changed again by a later line that names
    its new form, so chains are followed until no later line applies.
    """
    first = changes.groupBy("old").agg(F.min_by(F.struct("line", "new"), "line").alias("c"))
    current = cut_lineage(first.select("old", "c.line", "c.new"))
    steps = changes.select(F.col("line").alias("l2"), F.col("old").alias("o2"), F.col("new").alias("n2"))
    while True:
        onward = (
            current.join(steps, (F.col("new") == F.col("o2")) & (F.col("l2") > F.col("line")))
            .groupBy("old").agg(F.min_by(F.struct("l2", "n2"), "l2").alias("c"))
            .select("old", "c.l2", "c.n2")
        )
        onward = cut_lineage(onward)
        if onward.isEmpty():
            return current.select("old", "new")
        current = cut_lineage(
            current.join(onward, "old", "left").select(
                "old", F.coalesce("l2", "line").alias("line"), F.coalesce("n2", "new").alias("new")
            )
        )


def change_values(df: DataFrame, column: str, changes: DataFrame) -> DataFrame:
    """Replace values of ``column`` by the (line, old, new) list."""
    closed = close_changes(changes)
    return (
        df.join(closed, F.col(column) == F.col("old"), "left")
        .withColumn(column, F.when(F.col("old").isNotNull(), F.col("new")).otherwise(F.col(column)))
        .select(*df.columns)
    )


def update_by_key(df: DataFrame, key: str, updates: DataFrame, line: str | None = None) -> DataFrame:
    """Set the other columns of ``updates`` on rows with the same key; later lines win."""
    columns = [c for c in updates.columns if c not in (key, line)]
    values = F.struct(*[F.col(c).alias(f"new_{c}") for c in columns])
    if line:
        last = updates.groupBy(key).agg(F.max_by(values, line).alias("u"))
    else:
        last = updates.select(key, values.alias("u"))
    joined = df.join(last, key, "left")
    for column in columns:
        joined = joined.withColumn(column, F.coalesce(F.col(f"u.new_{column}"), F.col(column)))
    return joined.select(*df.columns)


def remove_matching(df: DataFrame, removals: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.join(removals.select(*columns).distinct(), list(columns), "left_anti")


def unused_lines(lines: DataFrame, df: DataFrame, on: dict[str, str]) -> DataFrame:
    """Lines that match no row; ``on`` maps line columns to data columns."""
    present = df.select(*[F.col(c).alias(f"d_{c}") for c in on.values()]).distinct()
    condition = reduce(
        lambda a, b: a & b, [F.col(mine) == F.col(f"d_{theirs}") for mine, theirs in on.items()]
    )
    return lines.join(present, condition, "left_anti")
