"""Read GenBank files as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave.sources.genbank import DEFAULT_MAX_LENGTH, parse, short_enough


def stream_genbank(spark: SparkSession, folder: str, max_length: int = DEFAULT_MAX_LENGTH) -> DataFrame:
    """Streaming records; the parser is the same as for whole files."""
    texts = spark.readStream.option("lineSep", "\n//").text(folder).where(F.col("value").contains("ACCESSION"))
    return short_enough(parse(texts), max_length)
