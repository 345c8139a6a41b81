"""Line-oriented text sources: FASTA, change lists, name lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, sequence): one row per entry, wrapped lines joined.

    The entry mark is the record separator, so large files are split by Spark.
    """
    entries = spark.read.option("lineSep", "\n>").text(path)
    cleaned = entries.select(F.regexp_replace("value", r"^\s*>?", "").alias("e")).where("e RLIKE '\\\\S'")
    return cleaned.select(
        F.trim(F.regexp_extract("e", r"^([^\r\n]*)", 1)).alias("name"),
        F.regexp_replace(F.regexp_replace("e", r"^[^\r\n]*", ""), r"\s", "").alias("sequence"),
    )


def split_aligned(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): entries with any base, and names whose row is empty or all gaps."""
    has_base = F.col("sequence").rlike("[^-]")
    return entries.where(has_base), entries.where(~has_base).select("name")


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a key that sorts in file order."""
    lines = spark.read.text(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"),
    )
    return lines.select(place.alias("line"), "value").where("value <> ''")


def _header(lines: DataFrame) -> list[str]:
    first = lines.agg(F.min_by("value", "line").alias("v")).first()["v"]
    return [name for name in (first or "").rstrip("\r").split("\t") if name]


def read_changes(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Columns and (line, column, old, new) of a list of old and new values per column."""
    lines = _numbered_lines(spark, path)
    columns = _header(lines)
    body = _body(lines)
    pairs = F.array(*[
        F.struct(
            F.lit(name).alias("column"), F.try_element_at("v", F.lit(2 * i + 1)).alias("old"),
            F.try_element_at("v", F.lit(2 * i + 2)).alias("new"),
        ) for i, name in enumerate(columns)
    ])
    return columns, body.select("line", F.explode(pairs).alias("p")).select("line", "p.*").where(
        "old IS NOT NULL AND new IS NOT NULL"
    )


def read_rows(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Columns and rows (with ``line``) of a tab-separated list with a header."""
    lines = _numbered_lines(spark, path)
    columns = _header(lines)
    body = _body(lines)
    return columns, body.select(
        "line", *[F.try_element_at("v", F.lit(i + 1)).alias(name) for i, name in enumerate(columns)]
    )


def _body(lines: DataFrame) -> DataFrame:
    first = lines.agg(F.min("line").alias("_first"))
    # One row on the broadcast side.
    return lines.crossJoin(F.broadcast(first)).where("line > _first").select(
        "line", F.split(F.regexp_replace("value", r"\r$", ""), "\t").alias("v")
    )
