"""Well-aligned blocks of an alignment, by site conservation (Castresana 2000).

The sequences are reduced to one row per site first; what follows works on
site rows, whose number is bounded by the alignment length of a gene.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def site_counts(cells: DataFrame) -> DataFrame:
    """(gene, pos, rows, top, gaps): most frequent base and gaps per site, pos from 1.

    Only bases are exploded; gaps, also those after the end of a shorter row,
    are what is missing from the number of rows. Sites where no row has a base
    are there too, so that runs of sites stay together across them.
    """
    rows = cells.groupBy("gene").agg(F.count(F.lit(1)).alias("rows"), F.max(F.length("sequence")).alias("last"))
    every = rows.where("last > 0").select("gene", "rows", F.explode(F.sequence(F.lit(0), F.col("last") - 1)).alias("i"))
    sites = cells.select("gene", F.posexplode(F.split("sequence", "")).alias("i", "base"))
    letters = sites.where("base <> '' AND base <> '-'").groupBy("gene", "i", "base").agg(F.count(F.lit(1)).alias("n"))
    per_site = letters.groupBy("gene", "i").agg(F.max("n").alias("top"), F.sum("n").alias("bases"))
    return every.join(per_site, ["gene", "i"], "left").select(
        "gene", (F.col("i") + 1).alias("pos"), "rows", F.coalesce("top", F.lit(0)).alias("top"),
        (F.col("rows") - F.coalesce("bases", F.lit(0))).alias("gaps"),
    )


def _blocks(sites: DataFrame) -> DataFrame:
    """Number runs of consecutive positions."""
    order = Window.partitionBy("gene").orderBy("pos")
    return sites.withColumn("block", F.col("pos") - F.row_number().over(order))


def _long_enough(sites: DataFrame, least: int) -> DataFrame:
    sized = _blocks(sites).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("gene", "block")))
    return sized.where(F.col("_n") >= least).drop("_n", "block")


def conserved_sites(
    sites: DataFrame, min_initial: int = 10, conserved: int = 0, flank: int = 0,
    max_nonconserved: int = 8, min_block: int = 10, gaps: str = "n",
) -> DataFrame:
    """(gene, pos) of the sites to keep.

    ``conserved`` and ``flank`` are numbers of sequences; 0 means half plus one
    and 85 percent. ``gaps`` is n (none), h (up to half) or a (all).
    """
    least = F.lit(conserved) if conserved else F.floor(F.col("rows") / 2) + 1
    high = F.lit(flank) if flank else F.ceil(F.col("rows") * F.lit(0.85))
    gapped = {"n": F.col("gaps") > 0, "h": F.col("gaps") * 2 > F.col("rows"), "a": F.lit(False)}[gaps]
    level = sites.select(
        "gene", "pos",
        gapped.alias("gapped"),
        (~gapped & (F.col("top") >= least)).alias("ok"),
        (~gapped & (F.col("top") >= F.greatest(high, least))).alias("high"),
    )

    weak = _blocks(level.where("NOT ok")).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy("gene", "block"))
    ).where(F.col("_n") > max_nonconserved).select("gene", "pos")
    kept = level.join(weak, ["gene", "pos"], "left_anti")

    block = Window.partitionBy("gene", "block")
    trimmed = (
        _blocks(kept)
        .withColumn("_first", F.min(F.when(F.col("high"), F.col("pos"))).over(block))
        .withColumn("_last", F.max(F.when(F.col("high"), F.col("pos"))).over(block))
        .where("pos BETWEEN _first AND _last").drop("_first", "_last", "block")
    )
    trimmed = _long_enough(trimmed, min_initial)

    # A gapped site goes together with the nonconserved sites that touch it.
    runs = _blocks(trimmed.where("NOT ok")).withColumn(
        "_gap", F.max("gapped").over(Window.partitionBy("gene", "block"))
    ).where("_gap").select("gene", "pos")
    cleaned = trimmed.join(runs, ["gene", "pos"], "left_anti")
    return _long_enough(cleaned, min_block).select("gene", "pos")


def keep_sites(cells: DataFrame, sites: DataFrame, kept: DataFrame, min_length: int = 0) -> DataFrame:
    """Cells cut down to the ``kept`` of all ``sites``.

    Rows that are all gaps or not longer than ``min_length`` go. The mask of a
    gene is one row, as long as its alignment.
    """
    last = sites.groupBy("gene").agg(F.max("pos").alias("_last"))
    every = last.select("gene", F.explode(F.sequence(F.lit(1), F.col("_last"))).alias("pos"))
    flagged = every.join(kept.withColumn("_keep", F.lit(True)), ["gene", "pos"], "left")
    mask = flagged.groupBy("gene").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.col("_keep").isNotNull().alias("k")))).alias("_mask")
    )
    letters = F.split("sequence", "")
    # Sites beyond the mask hold no base in any row.
    cut = cells.join(mask, "gene").withColumn(
        "sequence",
        F.concat_ws("", F.zip_with(letters, "_mask", lambda c, m: F.when(m["k"], F.coalesce(c, F.lit("-"))).otherwise(F.lit("")))),
    ).drop("_mask")
    return cut.where((F.length("sequence") > min_length) & F.col("sequence").rlike("[^-]"))
