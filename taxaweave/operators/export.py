"""Text forms of sequences and alignments, row by row; ``sinks`` writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fasta(name: Column, sequence: Column) -> Column:
    return F.concat(F.lit(">"), name.cast("string"), F.lit("\n"), sequence)


def padded(name: Column, width: Column) -> Column:
    """The name, padded so that all sequences start in one column."""
    return F.rpad(name.cast("string"), width + 1, " ")


def phylip(df: DataFrame, name: str, sequence: str) -> DataFrame:
    """(name, line): relaxed PHYLIP rows, names padded to the longest."""
    width = df.agg(F.max(F.length(F.col(name).cast("string"))).alias("_w"))
    # The width is one row.
    return df.crossJoin(F.broadcast(width)).select(
        name, F.concat(padded(F.col(name), F.col("_w")), F.upper(sequence)).alias("line")
    )


def interleaved(df: DataFrame, name: str, sequence: str, per_row: int, keep_names: bool = False) -> DataFrame:
    """(block, name, line): sequences cut into rows of ``per_row`` letters.

    Names stand on the first block only, unless ``keep_names``.
    """
    width = df.agg(F.max(F.length(F.col(name).cast("string"))).alias("_w"))
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.length(sequence), F.lit(1)) - 1) / per_row).cast("int"))
    cut = df.crossJoin(F.broadcast(width)).select(
        name, "_w", sequence, F.explode(starts).alias("block")
    )
    chunk = F.substring(F.col(sequence), F.col("block") * per_row + 1, F.lit(per_row))
    shown = F.lit(True) if keep_names else F.col("block") == 0
    label = F.when(shown, padded(F.col(name), F.col("_w"))).otherwise(F.repeat(F.lit(" "), F.col("_w") + 1))
    return cut.select("block", name, F.concat(label, F.upper(chunk)).alias("line"))


def partition_lines(parts: DataFrame, nexus: bool = False) -> DataFrame:
    """(position, line): one line per gene of a partition list."""
    span = F.concat(F.col("gene"), F.lit(" = "), F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string"))
    line = F.concat(F.lit("    charset "), span, F.lit(";")) if nexus else F.concat(F.lit("DNA, "), span)
    return parts.select("position", line.alias("line"))
