"""Resolve records to individuals by shared specimen identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.operators.ranking import number_rows
from taxaweave.session import cut_lineage

PREFIX = "Ind_"


def define_individuals(
    records: DataFrame, key: str, columns: Sequence[str], condition: str | None = None
) -> DataFrame:
    """(key, individual) for every record.

    For each identifying column in turn, records that agree on it (and on
    ``condition``) form a group of two or more. A group takes over the one
    individual its records already have, gets a new one when they have none,
    and is left alone when they disagree. What remains is numbered singly.
    Only identifiers travel through the loop, never sequences.
    """
    kept = list(dict.fromkeys([key, *columns, *([condition] if condition else [])]))
    if "individual" in records.columns:
        number = F.regexp_extract("individual", f"^{PREFIX}([0-9]+)$", 1)
        known = F.when(number != "", number.cast("long"))
    else:
        known = F.lit(None).cast("long")
    current = records.select(*kept, known.alias("_ind"))
    highest = 0
    if "individual" in records.columns:
        highest = current.agg(F.max("_ind")).first()[0] or 0

    for column in columns:
        keys = [condition, column] if condition else [column]
        groups = cut_lineage(
            current.dropna(subset=keys).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_ind").alias("_low"), F.max("_ind").alias("_high"))
            .where("_n > 1")
        )
        fresh = number_rows(groups.where("_low IS NULL"), keys, name="_rank").select(
            *keys, (F.col("_rank") + F.lit(highest)).alias("_new")
        )
        reused = groups.where("_low = _high").select(*keys, F.col("_low").alias("_new"))
        highest += groups.where("_low IS NULL").count()
        current = cut_lineage(
            current.join(fresh.unionByName(reused), keys, "left")
            .select(*kept, F.coalesce("_ind", "_new").alias("_ind"))
        )

    single = number_rows(current.where("_ind IS NULL").select(key), [key], name="_rank").select(
        key, (F.col("_rank") + F.lit(highest)).alias("_ind")
    )
    grouped = current.where("_ind IS NOT NULL").select(key, "_ind")
    return grouped.unionByName(single).select(
        key, F.concat(F.lit(PREFIX), F.col("_ind").cast("string")).alias("individual")
    )


def conflicting_groups(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Groups whose rows disagree on ``value``."""
    return (
        df.groupBy(*keys).agg(F.min(value).alias("lowest"), F.max(value).alias("highest"))
        .where("lowest <> highest")
    )
