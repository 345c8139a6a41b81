"""Cut records into gene regions from profile hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Position words a profile name may carry.
STARTS = ("start", "beginning", "whole", "full")
MIDDLES = ("middle", "between")
ENDS = ("stop", "end", "whole", "full")
WHOLES = ("whole", "full")
# Fixed value: profile names read gene, position, identifier.
MODEL_NAME = r"^([A-Za-z0-9]+)[_.]([A-Za-z0-9]+)[_.]([A-Za-z0-9]+)"


def name_parts(hits: DataFrame) -> DataFrame:
    """Add gene and position from the model name; other names are dropped."""
    return (
        hits.where(F.col("model").rlike(MODEL_NAME))
        .withColumn("gene", F.regexp_extract("model", MODEL_NAME, 1))
        .withColumn("position", F.regexp_extract("model", MODEL_NAME, 2))
    )


def resolve_hits(hits: DataFrame) -> DataFrame:
    """Best hit per record, gene and position; a whole-gene hit competes with all parts.

    The whole-gene hit stays alone when it beats every part, and goes otherwise.
    """
    spot = F.when(F.col("position").isin(*WHOLES), F.lit("whole")).otherwise(F.col("position"))
    best = (
        hits.withColumn("spot", spot).groupBy("accno", "gene", "spot")
        .agg(F.min(F.struct("evalue", "model", "hit_start", "hit_end")).alias("h"))
        .select("accno", "gene", "spot", "h.*")
    )
    parts = F.min(F.when(F.col("spot") != "whole", F.col("evalue"))).alias("parts")
    whole = F.min(F.when(F.col("spot") == "whole", F.col("evalue"))).alias("whole")
    rivals = best.groupBy("accno", "gene").agg(parts, whole)
    wins = F.coalesce(F.col("whole") < F.col("parts"), F.col("whole").isNotNull())
    return (
        best.join(rivals, ["accno", "gene"]).where((F.col("spot") == "whole") == wins)
        .select("accno", "gene", F.col("spot").alias("position"), "model", "hit_start", "hit_end", "evalue")
    )


def intervals(hits: DataFrame) -> DataFrame:
    """Start, middle and end of every gene found on a record; NULL where unknown."""
    def at(words, column):
        return F.max(F.when(F.col("position").isin(*words), F.col(column)))

    return hits.groupBy("accno", "gene").agg(
        at(STARTS, "hit_start").alias("start"),
        at(MIDDLES, "hit_start").alias("middle"),
        at(ENDS, "hit_end").alias("end"),
        F.min("evalue").alias("evalue"),
    )


def add_intergenes(found: DataFrame, between: DataFrame) -> DataFrame:
    """Add regions that lie between two genes; ``between`` has gene, lead_gene, trail_gene."""
    after = found.where("end IS NOT NULL").select("accno", F.col("gene").alias("lead_gene"), "end", "evalue").join(
        between, "lead_gene"
    ).select("accno", "gene", (F.col("end") + 1).alias("start"), F.lit(None).cast("int").alias("end"), "evalue")
    before = found.where("start IS NOT NULL").select("accno", F.col("gene").alias("trail_gene"), "start", "evalue").join(
        between, "trail_gene"
    ).select("accno", "gene", F.lit(None).cast("int").alias("start"), (F.col("start") - 1).alias("end"), "evalue")
    inner = after.unionByName(before).groupBy("accno", "gene").agg(
        F.max("start").alias("start"), F.lit(None).cast("int").alias("middle"),
        F.max("end").alias("end"), F.min("evalue").alias("evalue"),
    ).where("start > 0 OR end > 0")
    kept = found.join(inner, ["accno", "gene"], "left_anti")
    return kept.unionByName(inner)


def slices(found: DataFrame, records: DataFrame) -> DataFrame:
    """(gene, accno, sequence): the stretch of each record that holds the gene.

    Both ends known: the stretch between, if the end lies after the start.
    One end known: from the start on, or up to the end. Only a middle: all.
    """
    joined = found.join(records.select("accno", "sequence"), "accno")
    start, end, seq = F.col("start"), F.col("end"), F.col("sequence")
    piece = (
        F.when(start.isNotNull() & end.isNotNull(), F.when(end > start, F.substring(seq, start, end - start + 1)))
        .when(start.isNotNull(), F.when(start < F.length(seq), F.substring(seq, start, F.length(seq) - start + 1)))
        .when(end.isNotNull(), F.substring(seq, F.lit(1), end))
        .when(F.col("middle").isNotNull(), seq)
    )
    return joined.select(F.lower("gene").alias("gene"), "accno", piece.alias("sequence")).where("sequence IS NOT NULL")
