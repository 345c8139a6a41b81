"""Write sequences, alignments, partitions, trees and reports as text.

Rows are sorted by range and written by many tasks as ordered part files;
header and footer lines are part of the sort order, so nothing passes through
the driver. Concatenating the part files in name order gives the document.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.functions import null_to_empty
from taxaweave.operators import export, matrix


def write_lines(lines: DataFrame, order: Sequence[str], path: str) -> None:
    """Write the column ``line``, sorted by ``order``."""
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def write_fasta(df: DataFrame, name: str, sequence: str, path: str) -> None:
    df.select(F.col(name).alias("k"), export.fasta(F.col(name), F.col(sequence)).alias("line")).orderBy(
        "k"
    ).select("line").write.mode("overwrite").text(path)


def _line(spark, part: int, text: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(part).alias("part"), F.lit(0).alias("block"), F.lit("").alias("name"), F.lit(text).alias("line")
    )


def alignment_lines(
    cells: DataFrame, genes: Sequence[str], taxon: str = "taxon", form: str = "phylip",
    interleave: int | str | None = None, partitions: bool = True,
) -> DataFrame:
    """(part, block, name, line) of a concatenated alignment.

    ``form`` is phylip, nexus or fasta; ``interleave`` is a row length or
    ``genes`` for one gene per block. FASTA is never interleaved.
    """
    if form not in ("phylip", "nexus", "fasta"):
        raise ValueError(f"unknown alignment format {form}")
    if form == "fasta" and interleave:
        import warnings

        warnings.warn("FASTA cannot be interleaved; writing whole sequences", stacklevel=2)
        interleave = None
    spark = cells.sparkSession
    rows = matrix.concatenate(cells, genes, taxon).select(F.col(taxon).cast("string").alias("name"), "sequence")
    spans = matrix.partitions(cells, genes)

    if form == "fasta":
        body = rows.select(
            F.lit(1).alias("part"), F.lit(0).alias("block"), "name", export.fasta(F.col("name"), F.upper("sequence")).alias("line")
        )
    elif interleave == "genes":
        spelled = rows.crossJoin(F.broadcast(rows.agg(F.max(F.length("name")).alias("_w"))))
        # One row per gene on the broadcast side.
        cut = spelled.crossJoin(F.broadcast(spans)).withColumn(
            "chunk", F.substring(F.col("sequence"), F.col("first").cast("int"), (F.col("last") - F.col("first") + 1).cast("int"))
        )
        head = F.min("position").over(_window())
        shown = F.lit(form == "nexus") | (F.col("position") == head)
        label = F.when(shown, export.padded(F.col("name"), F.col("_w"))).otherwise(F.repeat(F.lit(" "), F.col("_w") + 1))
        body = cut.select(
            F.lit(1).alias("part"), F.col("position").cast("int").alias("block"), "name",
            F.concat(label, F.upper("chunk")).alias("line"),
        )
    elif interleave:
        body = export.interleaved(rows, "name", "sequence", int(interleave), form == "nexus").select(
            F.lit(1).alias("part"), "block", "name", "line"
        )
    else:
        body = export.phylip(rows, "name", "sequence").select(F.lit(1).alias("part"), F.lit(0).alias("block"), "name", "line")

    pieces = [body]
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.length("sequence")), F.lit(0)).alias("len"))
    count, length = F.col("n").cast("string"), F.col("len").cast("string")
    if form != "fasta":
        head = F.concat(count, F.lit(" "), length)
        if form == "nexus":
            yes = "YES" if interleave else "NO"
            head = F.concat(
                F.lit("#NEXUS\nBEGIN DATA;\nDIMENSIONS  NTAX="), count, F.lit(" NCHAR="), length,
                F.lit(f";\nFORMAT DATATYPE=DNA MISSING=N GAP=- INTERLEAVE={yes};\n\nMATRIX"),
            )
        pieces.append(size.select(F.lit(0).alias("part"), F.lit(0).alias("block"), F.lit("").alias("name"), head.alias("line")))
    if form == "nexus":
        pieces.append(_line(spark, 2, ";\n\nEND;"))
        if partitions:
            pieces.append(_line(spark, 3, "\nBEGIN MRBAYES;\n"))
            pieces.append(export.partition_lines(spans, nexus=True).select(
                F.lit(4).alias("part"), F.col("position").cast("int").alias("block"), F.lit("").alias("name"), "line"
            ))
            pieces.append(_line(spark, 5, "\nEND;"))
    return reduce(DataFrame.unionByName, pieces)


def _window():
    from pyspark.sql.window import Window

    return Window.partitionBy("name")


def write_alignment(cells: DataFrame, genes: Sequence[str], path: str, partitions: bool = True, **options) -> None:
    """Alignment under ``path``; the partition list beside it unless it is inside."""
    lines = alignment_lines(cells, genes, partitions=partitions, **options)
    write_lines(lines, ["part", "block", "name"], path)
    if partitions and options.get("form", "phylip") != "nexus":
        spans = export.partition_lines(matrix.partitions(cells, genes))
        write_lines(spans, ["position"], f"{path}.partitions")


def write_trees(trees: DataFrame, path: str, taxon: str, genes: Sequence[str] | None = None) -> DataFrame:
    """Trees of ``taxon``, one folder per gene; returns the genes that have none."""
    wanted = trees.where(F.col("taxon") == taxon)
    if genes:
        wanted = wanted.where(F.col("gene").isin(*genes))
    shown = wanted.where(F.col("tree").contains("("))
    shown.select("gene", "tree").write.mode("overwrite").partitionBy("gene").text(path)
    return wanted.select("gene").distinct().join(shown.select("gene").distinct(), "gene", "left_anti")


def write_table(df: DataFrame, path: str) -> None:
    """Tab-separated report with a header line per part file."""
    filled = df.select(*[null_to_empty(F.col(c).cast("string")).alias(c) for c in df.columns])
    filled.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
