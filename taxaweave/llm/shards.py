"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At every level each child draws -ln(u) / weight, with u a hash of the document's id and the
child's name, and the smallest draw wins; a child's chance is its share of the weight. A draw depends on
nothing but id, name and weight, so that a changed weight moves documents only into or out of
the subtrees on the way to it. A new shard comes as a region of its own: documents move only into it.

Nulls and odd rows: a null id draws like the text ``null``; a null text has no bytes; repeated rows
go to the same shard with a slot each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shards of the tree before growth, in racks of two and regions of two racks.
PLANNED, PER_RACK, PER_REGION = 8, 2, 4
#: Rows of a shard that are numbered in one group (about).
GROUP = 500


@dataclass(frozen=True)
class Shard:
    """A leaf: its number, its way from the root, its weight."""

    number: int
    region: str
    rack: str
    weight: float = 1.0


def tree(shards: int, planned: int = PLANNED) -> list[Shard]:
    """``shards`` leaves of weight 1: the planned ones in racks and regions, later ones each in its own region."""
    out = []
    for k in range(shards):
        region, rack = (f"g{k // PER_REGION}", f"r{k // PER_RACK}") if k < planned else (f"added{k}", f"added{k}")
        out.append(Shard(k, region, rack))
    return out


def _draw(key: Column, name: str, weight: float) -> Column:
    """An exponential draw with rate ``weight``; 52 bits of a hash make u, never 0."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 12)
    return -F.log((bits.cast("double") + 1.0) / float(1 << 52)) / F.lit(weight)


def _least(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """What belongs to the child with the smallest draw; ties go to the child named first."""
    if len(children) == 1:
        return children[0][2]
    drawn = [F.struct(_draw(key, name, w).alias("draw"), F.lit(k).alias("k")) for k, (name, w, _) in enumerate(children)]
    winner = F.least(*drawn)["k"]
    chosen = children[-1][2]
    for k, (_, _, value) in reversed(list(enumerate(children[:-1]))):
        chosen = F.when(winner == k, value).otherwise(chosen)
    return chosen


def shard_of(key: Column, leaves: list[Shard]) -> Column:
    """The shard of ``key``: descend region, rack and shard by weighted draws."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    live = [s for s in leaves if s.weight > 0]
    regions: dict[str, dict[str, list[Shard]]] = {}
    for s in live:
        regions.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    weight = lambda found: sum(s.weight for s in found)
    region_children = []
    for region, racks in regions.items():
        rack_children = [
            (f"{region}/{rack}", weight(own), _least(key, [(f"{region}/{rack}/{s.number}", s.weight, F.lit(s.number)) for s in own]))
            for rack, own in racks.items()
        ]
        region_children.append((region, sum(w for _, w, _ in rack_children), _least(key, rack_children)))
    return _least(key, region_children).cast("int")


def place(docs: DataFrame, shards: int = PLANNED, group: int = GROUP) -> DataFrame:
    """Shard, slot and the shard after growth by one of every document.

    Slots are numbered in groups by the hash of the id; a shard's groups follow
    one another, by their counts.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    ).withColumn("shard", shard_of(F.col("doc_id"), tree(shards))).withColumn("grown_shard", shard_of(F.col("doc_id"), tree(shards + 1)))
    # The tables are read for their number of rows only.
    groups = max(1, docs.select(F.lit(1)).count() // (shards * group))
    # Equal ids are told apart by their texts, equal rows by nothing: any order of them gives the same rows.
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", F.lit("slot"), "text_crc32"), F.lit(groups)))
    counts = rows.groupBy("shard", "group").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "group", F.coalesce(before, F.lit(0)).alias("earlier"))
    within = F.row_number().over(Window.partitionBy("shard", "group").orderBy("doc_id", "text_crc32", "size"))
    return (
        rows.withColumn("nth", within - 1).join(starts, ["shard", "group"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("earlier") + F.col("nth")).cast("long").alias("slot"), "grown_shard")
    )
