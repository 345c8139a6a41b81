"""Readable names for taxa."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.functions import safe_name
from taxaweave.operators.ranking import number_rows


def majority_names(members: DataFrame, taxon: str = "taxon", accno: str = "accno", name: str = "species") -> DataFrame:
    """(taxon, name): most frequent name over the distinct sequences of each taxon."""
    counted = (
        members.select(taxon, accno, name).where(F.col(name).isNotNull()).distinct()
        .groupBy(taxon, name).agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy(taxon).agg(F.min_by(name, F.struct(-F.col("n"), F.col(name))).alias(name))


def numbered_names(names: DataFrame, taxon: str = "taxon", name: str = "species", out: str = "species_name") -> DataFrame:
    """Clean each name and number the taxa that share it."""
    cleaned = names.withColumn("_clean", safe_name(F.col(name)))
    numbered = number_rows(cleaned, [taxon], ["_clean"], "_n")
    return numbered.withColumn(out, F.concat_ws("_", "_clean", F.col("_n").cast("string"))).drop("_clean", "_n")
