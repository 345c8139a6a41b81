"""Row numbers and medians that never need one task per group.

A window function gathers each group in one task. That is fine while the
largest group is known to be small; for larger groups the order is cut into
ranges, rows are numbered inside each range, and the counts of the earlier
ranges are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Largest group numbered by a plain window in one task.
ROWS_PER_TASK = 2_000_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Size of the largest group: one pre-aggregated pass."""
    if not keys:
        return df.count()
    row = df.groupBy(*keys).count().agg(F.max("count").alias("n")).first()
    return row["n"] or 0


def _range_of(df: DataFrame, order: Column, ranges: int) -> Column:
    """Range number of each row, from at most ``4 * ranges`` sampled order values.

    The sample only places the range bounds; every row is numbered.
    """
    sample = (
        df.select(order.alias("v"))
        .groupBy(F.pmod(F.xxhash64("v"), F.lit(4 * ranges)).alias("slot"))
        .agg(F.min_by("v", F.xxhash64("v", F.lit(1))).alias("v"))
        .select("v").distinct().orderBy("v")
    )
    dtype = sample.schema["v"].dataType
    values = [row["v"] for row in sample.collect()]
    step = max(1, len(values) // ranges)
    bounds = [F.lit(None).cast(dtype) if v is None else _literal(v, dtype) for v in values[step::step]]

    def choose(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(order < bounds[middle], choose(low, middle)).otherwise(choose(middle + 1, high))

    return choose(0, len(bounds))


def _ranges(df: DataFrame, rows_per_task: int) -> int:
    """As many ranges as hold a quarter of ``rows_per_task`` rows each on average."""
    return max(64, -(-4 * df.count() // max(1, rows_per_task)))


def _literal(value, dtype) -> Column:
    if hasattr(dtype, "fields"):
        return F.struct(*[
            F.lit(value[i]).cast(f.dataType).alias(f.name) for i, f in enumerate(dtype.fields)
        ]).cast(dtype)
    return F.lit(value).cast(dtype)


def number_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    groups: Sequence[str] = (),
    name: str = "rank",
    rows_per_task: int = ROWS_PER_TASK,
    ranges: int | None = None,
) -> DataFrame:
    """``row_number`` over ``groups`` by ascending ``order`` (which must be total)."""
    groups = list(groups)
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    if largest_group(df, groups) <= rows_per_task:
        # The bound was just measured: no group exceeds ``rows_per_task``.
        window = Window.partitionBy(*groups).orderBy(*by)
        return df.withColumn(name, F.row_number().over(window).cast("long"))

    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)])
    ranged = df.withColumn("_range", _range_of(df, key, ranges or _ranges(df, rows_per_task)))
    counts = ranged.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    local = Window.partitionBy(*groups, "_range").orderBy(*by)
    numbered = ranged.withColumn("_local", F.row_number().over(local))
    on = [F.col(f"r.{g}").eqNullSafe(F.col(f"f.{g}")) for g in groups]
    on.append(F.col("r._range") == F.col("f._range"))
    joined = numbered.alias("r").join(offsets.alias("f"), on=_all(on), how="inner")
    return joined.select(
        *[F.col(f"r.{c}") for c in df.columns],
        (F.col("f._before") + F.col("r._local")).cast("long").alias(name),
    )


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def join_groups(df: DataFrame, per_group: DataFrame, groups: Sequence[str], how: str = "inner") -> DataFrame:
    """Add the columns of ``per_group`` to the rows of each group; a missing key is a group too."""
    renamed = per_group.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], *[c for c in per_group.columns if c not in groups]
    )
    on = _all([F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)])
    return df.join(renamed, on, how).drop(*[f"_g{i}" for i in range(len(groups))])


def exact_median(
    df: DataFrame, groups: Sequence[str], value: str, name: str = "median",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exact median of ``value`` per group, from value counts rather than rows."""
    groups = list(groups)
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    totals = counted.groupBy(*groups).agg(F.sum("_n").alias("_total"))
    cumulative = running_sum(counted, "_n", [value], groups, "_upto", rows_per_task)
    # Without groups the totals are one row.
    joined = join_groups(cumulative, totals, groups) if groups else cumulative.crossJoin(F.broadcast(totals))
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.floor((F.col("_total") + 2) / 2)
    before = F.col("_upto") - F.col("_n")
    holds_low = (before < low) & (F.col("_upto") >= low)
    holds_high = (before < high) & (F.col("_upto") >= high)
    return joined.groupBy(*groups).agg(
        ((F.max(F.when(holds_low, F.col(value))) + F.max(F.when(holds_high, F.col(value)))) / 2).alias(name)
    )


def running_sum(
    df: DataFrame, value: str, order: Sequence[str], groups: Sequence[str] = (),
    name: str = "running", rows_per_task: int = ROWS_PER_TASK, ranges: int | None = None,
) -> DataFrame:
    """Cumulative sum per group in ``order``, with the same range split as ``number_rows``."""
    groups = list(groups)
    by = [F.col(c) for c in order]
    if largest_group(df, groups) <= rows_per_task:
        window = Window.partitionBy(*groups).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(value).over(window))
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)])
    ranged = df.withColumn("_range", _range_of(df, key, ranges or _ranges(df, rows_per_task)))
    sums = ranged.groupBy(*groups, "_range").agg(F.sum(value).alias("_s"))
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_before", F.coalesce(F.sum("_s").over(earlier), F.lit(0))).drop("_s")
    local = Window.partitionBy(*groups, "_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_local", F.sum(value).over(local))
    on = [F.col(f"r.{g}").eqNullSafe(F.col(f"f.{g}")) for g in groups]
    on.append(F.col("r._range") == F.col("f._range"))
    joined = summed.alias("r").join(offsets.alias("f"), on=_all(on), how="inner")
    return joined.select(
        *[F.col(f"r.{c}") for c in df.columns], (F.col("f._before") + F.col("r._local")).alias(name)
    )
