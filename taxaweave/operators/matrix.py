"""The taxon by gene table: wide form, presence filters, coverage, gene blocks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.functions import gap_fill, ungapped_length


def to_wide(taxon_genes: DataFrame, genes: Sequence[str], taxon: str = "taxon", value: str = "accno") -> DataFrame:
    """One row per taxon and one column per gene."""
    return taxon_genes.groupBy(taxon).pivot("gene", list(genes)).agg(F.min(value))


def present(genes: Sequence[str], anchors: Sequence[str] = (), every_anchor: bool = True) -> Column:
    """Rows with any of ``genes`` and with every (or any) anchor gene."""
    def name(gene):
        return F.col(f"`{gene}`").isNotNull()

    condition = reduce(lambda a, b: a | b, map(name, genes))
    if anchors:
        joined = reduce((lambda a, b: a & b) if every_anchor else (lambda a, b: a | b), map(name, anchors))
        condition = condition & joined
    return condition


def gene_counts(df: DataFrame, gene: str = "gene") -> DataFrame:
    return df.groupBy(gene).agg(F.count(F.lit(1)).alias("n"))


def gene_patterns(taxon_genes: DataFrame, taxon: str = "taxon") -> DataFrame:
    """(genes, taxa): how many taxa have exactly this set of genes."""
    sets = taxon_genes.groupBy(taxon).agg(F.array_sort(F.collect_set("gene")).alias("genes"))
    return sets.groupBy("genes").agg(F.count(F.lit(1)).alias("taxa"))


def gene_pairs(taxon_genes: DataFrame, taxon: str = "taxon") -> DataFrame:
    """(gene1, gene2, taxa) for pairs found together in a taxon.

    Taxa are first counted by their gene set, so pairs are only formed once
    per distinct set and not per taxon.
    """
    patterns = gene_patterns(taxon_genes, taxon)
    first = patterns.select("genes", "taxa", F.posexplode("genes").alias("i", "gene1"))
    pairs = first.select("gene1", "taxa", F.explode(F.slice("genes", F.col("i") + 2, F.size("genes"))).alias("gene2"))
    return pairs.groupBy("gene1", "gene2").agg(F.sum("taxa").alias("taxa"))


def largest_block(taxon_genes: DataFrame, shared: int, taxon: str = "taxon") -> DataFrame:
    """Genes of the largest block joined by pairs that share at least ``shared`` taxa."""
    from taxaweave.operators.components import label_all

    edges = gene_pairs(taxon_genes, taxon).where(F.col("taxa") >= shared).select(
        F.col("gene1").alias("src"), F.col("gene2").alias("dst")
    )
    blocks = label_all(taxon_genes.select("gene").distinct(), "gene", edges)
    sizes = blocks.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    best = sizes.agg(F.min_by("component", F.struct(-F.col("n"), F.col("component"))).alias("component"))
    return blocks.join(best, "component").select("gene")


def coverage(taxon_genes: DataFrame, genes: Sequence[str], taxon: str = "taxon") -> DataFrame:
    """Taxa, taxa with every gene, and gene coverage as a share of filled cells."""
    per_taxon = (
        taxon_genes.where(F.col("gene").isin(*genes)).select(taxon, "gene").distinct()
        .groupBy(taxon).agg(F.count(F.lit(1)).alias("k"))
    )
    return per_taxon.agg(
        F.count(F.lit(1)).alias("taxa"),
        F.count_if(F.col("k") == len(genes)).alias("complete"),
        F.try_divide(F.sum("k").cast("double"), F.count(F.lit(1)) * F.lit(len(genes))).alias("gene_coverage"),
    )


def alignment_statistics(cells: DataFrame, taxon: str = "taxon") -> DataFrame:
    """Per gene and overall (gene NULL) statistics of aligned cells.

    ``cells`` has taxon, gene, aligned sequence and is_lead.
    """
    taxa = cells.select(taxon).distinct().agg(F.count(F.lit(1)).alias("taxa"))
    per_gene = cells.groupBy("gene").agg(
        F.count(F.lit(1)).alias("present"),
        F.max(F.length("sequence")).cast("long").alias("aligned_length"),
        F.sum(ungapped_length(F.col("sequence"))).cast("long").alias("bases"),
        F.count_if(~F.col("is_lead")).alias("non_lead"),
    ).crossJoin(F.broadcast(taxa))
    # A single row of totals on each side of the cross joins.
    whole = per_gene.agg(
        F.sum("present").alias("present"), F.sum("aligned_length").alias("aligned_length"),
        F.sum("bases").alias("bases"), F.sum("non_lead").alias("non_lead"), F.max("taxa").alias("taxa"),
        F.count(F.lit(1)).alias("genes"),
    ).select(F.lit(None).cast("string").alias("gene"), "*")
    both = per_gene.withColumn("genes", F.lit(1).cast("long")).unionByName(whole)
    return both.select(
        "gene", "taxa", "present", "aligned_length", "bases", "non_lead",
        (F.col("present") / (F.col("taxa") * F.col("genes"))).alias("gene_coverage"),
        F.try_divide(F.col("bases").cast("double"), F.col("taxa") * F.col("aligned_length")).alias("base_coverage"),
        (F.col("non_lead") / F.col("present")).alias("non_lead_share"),
    )


def with_anchors(cells: DataFrame, anchors: Sequence[str], taxon: str = "taxon") -> DataFrame:
    """Cells of the taxa that have every anchor gene; all cells without anchors."""
    if not anchors:
        return cells
    have = cells.where(F.col("gene").isin(*anchors)).select(taxon, "gene").distinct().groupBy(taxon).agg(
        F.count(F.lit(1)).alias("_k")
    )
    return cells.join(have.where(F.col("_k") == len(set(anchors))).select(taxon), taxon, "left_semi")


def without(cells: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Cells whose ``key`` is not in ``gone``: removed records, or rogue taxa."""
    return cells.join(gone.select(key), key, "left_anti")


def most_frequent(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n): the most frequent value of each group, the smallest on ties."""
    counted = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(group).agg(
        F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n")
    )


def guide_genes(cells: DataFrame, taxon: str = "taxon") -> DataFrame:
    """(taxon, guide): the last gene by name among those that each taxon has."""
    return cells.groupBy(taxon).agg(F.max("gene").alias("guide"))


def taxon_listing(cells: DataFrame, mixed: DataFrame, taxon: str = "taxon") -> DataFrame:
    """Per taxon: each gene with its record, whether that leads its cluster, and its bases; whether taxa are mixed.

    ``cells`` has taxon, gene, accno, sequence and is_lead; ``mixed`` names the mixed taxa.
    """
    entry = F.struct("gene", "accno", "is_lead", ungapped_length(F.col("sequence")).cast("long").alias("bases"))
    # One entry per gene: lists as short as the number of genes.
    listed = cells.groupBy(taxon).agg(F.array_sort(F.collect_list(entry)).alias("genes"))
    flagged = mixed.select(taxon).distinct().withColumn("mixed", F.lit(True))
    return listed.join(flagged, taxon, "left").withColumn("mixed", F.coalesce("mixed", F.lit(False)))


def concatenate(cells: DataFrame, genes: Sequence[str], taxon: str = "taxon") -> DataFrame:
    """(taxon, sequence): genes in order, absent ones filled with gaps."""
    lengths = cells.groupBy("gene").agg(F.max(F.length("sequence")).alias("len"))
    wide_lengths = lengths.agg(*[
        F.coalesce(F.max(F.when(F.col("gene") == g, F.col("len"))), F.lit(0)).alias(f"_len{i}")
        for i, g in enumerate(genes)
    ])
    wide = to_wide(cells, genes, taxon, "sequence")
    # The lengths are one row.
    joined = wide.where(present(genes)).crossJoin(F.broadcast(wide_lengths))
    filled = [gap_fill(F.col(f"`{g}`"), F.col(f"_len{i}")) for i, g in enumerate(genes)]
    return joined.select(taxon, F.concat(*filled).alias("sequence"))


def partitions(cells: DataFrame, genes: Sequence[str]) -> DataFrame:
    """(gene, position, first, last): where each gene lies in the concatenation."""
    from pyspark.sql.window import Window

    order = F.array_position(F.array(*[F.lit(g) for g in genes]), F.col("gene"))
    lengths = cells.where(F.col("gene").isin(*genes)).groupBy("gene").agg(
        F.max(F.length("sequence")).cast("long").alias("len")
    ).where("len > 0").withColumn("position", order)
    # One row per gene.
    upto = F.sum("len").over(Window.partitionBy(F.lit(0)).orderBy("position"))
    return lengths.withColumn("last", upto).select(
        "gene", "position", (F.col("last") - F.col("len") + 1).alias("first"), "last"
    )


def decisiveness(taxon_genes: DataFrame, draws: int = 1000, seed: int = 1, size: int = 4, taxon: str = "taxon") -> DataFrame:
    """(draws, decisive): how many random sets of ``size`` taxa share a gene.

    The sample is the operator: a fixed number of draws, each naming taxa by
    rank through a hash of seed, draw and place, so a run can be repeated.
    """
    from taxaweave.operators.ranking import number_rows

    cells = taxon_genes.select(taxon, "gene").distinct()
    ranked = number_rows(cells.select(taxon).distinct(), [taxon], name="rank")
    spark = cells.sparkSession
    total = ranked.agg(F.count(F.lit(1)).alias("_n"))
    number = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(seed), "draw", "k")), 1, 12), 16, 10).cast("long")
    drawn = spark.range(draws).select(
        F.col("id").alias("draw"), F.explode(F.sequence(F.lit(1), F.lit(size))).alias("k")
    ).crossJoin(F.broadcast(total)).select(
        "draw", (number % F.col("_n") + 1).alias("rank")
    ).distinct()
    sizes = drawn.groupBy("draw").agg(F.count(F.lit(1)).alias("size"))
    shared = drawn.join(ranked, "rank").join(cells, taxon).groupBy("draw", "gene").agg(F.count(F.lit(1)).alias("n"))
    most = shared.groupBy("draw").agg(F.max("n").alias("most"))
    return sizes.join(most, "draw").agg(
        F.count(F.lit(1)).alias("draws"), F.count_if(F.col("most") == F.col("size")).alias("decisive")
    )


def distance_ratio(
    cells: DataFrame, first: str, second: str, pairs_of: int = 10, seed: int = 1, taxon: str = "taxon"
) -> DataFrame:
    """(ratio, pairs): mean distance in gene ``second`` over that in ``first``.

    Compared are all pairs of a sample of ``pairs_of`` taxa that have both
    genes; identical sequences of the first gene are left out.
    """
    from taxaweave.functions import jukes_cantor

    both = cells.where(F.col("gene").isin(first, second)).groupBy(taxon).agg(
        F.min(F.when(F.col("gene") == first, F.col("sequence"))).alias("s1"),
        F.min(F.when(F.col("gene") == second, F.col("sequence"))).alias("s2"),
    ).where("s1 IS NOT NULL AND s2 IS NOT NULL")
    order = F.md5(F.concat_ws("/", F.lit(seed), F.col(taxon).cast("string")))
    # At most ``pairs_of`` rows, hence a bounded number of pairs.
    sample = both.orderBy(order, taxon).limit(pairs_of)
    left, right = sample.alias("a"), sample.alias("b")

    def distance(name):
        one, two = F.col(f"a.{name}"), F.col(f"b.{name}")
        share = F.levenshtein(one, two).cast("double") / F.greatest(F.length(one), F.length(two))
        return jukes_cantor(share).alias(f"d_{name}")

    compared = left.join(right, F.col(f"a.{taxon}") < F.col(f"b.{taxon}")).select(distance("s1"), distance("s2"))
    return compared.where("d_s1 > 0 AND d_s2 IS NOT NULL").agg(
        F.avg(F.col("d_s2") / F.col("d_s1")).alias("ratio"), F.count(F.lit(1)).alias("pairs")
    )


def distance_ratios(pairs: DataFrame, pairs_of: int = 10, seed: int = 1, taxon: str = "taxon") -> DataFrame:
    """(tree, ratio, pairs): mean distance of ``second`` over that of ``first`` in each tree.

    ``pairs``: (tree, taxon, first, second) sequences of two genes. Compared are all pairs of a sample of ``pairs_of``
    taxa a tree, chosen by a hash; identical sequences of the first gene are left out, and trees without any pair.
    """
    from taxaweave.functions import jukes_cantor
    from taxaweave.operators.ranking import number_rows

    order = F.md5(F.concat_ws("/", F.lit(seed), F.col(taxon).cast("string")))
    # At most ``pairs_of`` rows a tree, hence a bounded number of pairs.
    sample = number_rows(pairs.where("first IS NOT NULL AND second IS NOT NULL"), [order, taxon], ["tree"], "_r").where(F.col("_r") <= pairs_of)
    left, right = sample.alias("a"), sample.alias("b")

    def distance(name):
        one, two = F.col(f"a.{name}"), F.col(f"b.{name}")
        share = F.levenshtein(one, two).cast("double") / F.greatest(F.length(one), F.length(two), F.lit(1))
        return jukes_cantor(share).alias(f"d_{name}")

    compared = left.join(right, (F.col("a.tree") == F.col("b.tree")) & (F.col("a._r") < F.col("b._r"))).select(
        F.col("a.tree").alias("tree"), distance("first"), distance("second"))
    return compared.where("d_first > 0 AND d_second IS NOT NULL").groupBy("tree").agg(
        F.avg(F.col("d_second") / F.col("d_first")).alias("ratio"), F.count(F.lit(1)).alias("pairs")
    )
