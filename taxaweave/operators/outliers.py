"""Unlikely values: median deviation, gamma tail, distant clusters."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.operators.ranking import exact_median, join_groups, number_rows
from taxaweave.session import cut_lineage


def median_deviation(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, median, mad): exact median and median absolute deviation."""
    # Read twice: the median is computed once.
    centre = cut_lineage(exact_median(df, groups, value, "median"))
    spread = join_groups(df, centre, list(groups)).withColumn("_d", F.abs(F.col(value) - F.col("median")))
    return join_groups(centre, exact_median(spread, groups, "_d", "mad"), list(groups))


def gamma_moments(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Count, mean, mean logarithm and moment estimates of a gamma distribution."""
    positive = df.where(F.col(value) > 0)
    return positive.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.avg(F.ln(value)).alias("mean_log"),
        F.var_pop(value).alias("variance"),
    ).withColumn("shape", F.try_divide(F.col("mean") * F.col("mean"), F.col("variance")))


def fit_shape(mean: float, mean_log: float, low: float = 1e-6, high: float = 3.0) -> float:
    """Maximum-likelihood gamma shape in (low, high) with scale = mean / shape.

    The likelihood depends on the data only through the two means, so the
    data are summed by Spark and only two numbers reach the driver.
    """
    def slope(shape: float) -> float:
        step = 1e-5 * max(shape, 1e-3)
        digamma = (math.lgamma(shape + step) - math.lgamma(shape - step)) / (2 * step)
        return math.log(shape) - digamma - (math.log(mean) - mean_log)

    if slope(high) > 0:
        return high
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    return (low + high) / 2


def gamma_cdf(x: np.ndarray, shape, scale) -> np.ndarray:
    """Lower regularised incomplete gamma function by its power series; arguments may be arrays."""
    z, shape = np.broadcast_arrays(np.asarray(x, dtype=float) / scale, np.asarray(shape, dtype=float))
    term = 1.0 / shape
    total = term.copy()
    for k in range(1, 2000):
        term = term * z / (shape + k)
        total += term
        if not np.any(term > total * 1e-15):
            break
    log_gamma = np.vectorize(math.lgamma, otypes=[float])(shape)
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        value = total * np.exp(-z + shape * np.log(z) - log_gamma)
    return np.where(z <= 0, 0.0, np.where(z > shape + 700, 1.0, np.minimum(value, 1.0)))


@F.pandas_udf(T.DoubleType())
def _shape(mean: pd.Series, mean_log: pd.Series) -> pd.Series:
    return pd.Series([fit_shape(a, b) for a, b in zip(mean, mean_log)])


@F.pandas_udf(T.DoubleType())
def _cdf(x: pd.Series, shape: pd.Series, scale: pd.Series) -> pd.Series:
    if x.empty:
        return pd.Series(dtype=float)
    return pd.Series(gamma_cdf(x.to_numpy(), shape.to_numpy(), scale.to_numpy()))


def tail_cut_offs(
    df: DataFrame, groups: Sequence[str], value: str, identifier: str, alpha: float = 0.05
) -> DataFrame:
    """(groups, cut_off): length beyond which values are unlikely under a fitted gamma distribution.

    From the longest value down, a value is rejected while its probability
    exceeds one less alpha over its rank; the cut-off lies halfway between the
    longest value kept and the shortest one rejected. A group without positive
    values keeps them all.
    """
    groups = list(groups)
    rows = df.where(F.col(value).isNotNull()).select(*groups, value, identifier)
    fitted = gamma_moments(rows, value, groups).select(
        *groups, "mean", _shape("mean", "mean_log").alias("_shape")
    ).withColumn("_scale", F.col("mean") / F.col("_shape"))
    ranked = number_rows(rows, [value, identifier], groups, "_rank")
    judged = cut_lineage(join_groups(ranked, fitted, groups, "left"))
    fit = judged.where("_shape IS NOT NULL")
    likely = fit.where(_cdf(value, "_shape", "_scale") <= 1.0 - F.lit(alpha) / F.col("_rank")).select(*groups, value, "_rank")
    free = judged.where("_shape IS NULL").select(*groups, value, "_rank")
    last = likely.unionByName(free).groupBy(*groups).agg(F.max("_rank").alias("_last"), F.max_by(value, "_rank").alias("_kept"))
    every = join_groups(judged.select(*groups, value, "_rank"), last, groups, "left")
    beyond = F.min(F.when(F.col("_rank") == F.col("_last") + 1, F.col(value)))
    return every.groupBy(*groups).agg(F.max("_kept").alias("_kept"), beyond.alias("_next")).select(
        *groups,
        F.when(F.col("_kept").isNull(), F.lit(0.0)).otherwise(
            F.coalesce((F.col("_kept") + F.col("_next")) / 2, F.col("_kept") + 1.0)
        ).alias("cut_off"),
    )


def tail_cut_off(df: DataFrame, value: str, identifier: str, alpha: float = 0.05) -> float:
    """The cut-off of all rows together."""
    row = tail_cut_offs(df.withColumn("_all", F.lit(0)), ["_all"], value, identifier, alpha).first()
    return row["cut_off"] if row else 1.0


def largest_cluster(members: DataFrame, groups: Sequence[str], cluster: str) -> DataFrame:
    """(groups, cluster, n): the largest cluster of each group, smallest name on ties."""
    sizes = members.groupBy(*groups, cluster).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(*groups).agg(
        F.min_by(cluster, F.struct(-F.col("n"), F.col(cluster))).alias(cluster), F.max("n").alias("n")
    )
