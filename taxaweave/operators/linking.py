"""Link the clusters of different genes into taxa.

``sequences`` has gene, accno, individual, length, score and lead (the accno
of the cluster's representative, NULL when unclustered). Taxa are kept long,
one row per taxon and gene, so a taxon without sequences simply vanishes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.operators.components import connected_components
from taxaweave.operators.matching import EDGES_PER_TASK, max_weight_matching
from taxaweave.operators.ranking import number_rows, running_sum
from taxaweave.session import cut_lineage

PREFIX = "Taxon_"
# Matched units spelled out from one row at a time.
UNITS_PER_STEP = 10_000


def gene_order(sequences: DataFrame, min_length: int) -> list[str]:
    """Genes by number of leads, most first; one row per gene reaches the driver."""
    leads = sequences.where((F.col("lead") == F.col("accno")) & (F.col("length") > min_length))
    rows = leads.groupBy("gene").count().orderBy(F.desc("count"), "gene").collect()
    return [row["gene"] for row in rows]


def counterparts(sequences: DataFrame) -> DataFrame:
    """(individual, gene, accno): the sequence that stands for an individual in a gene.

    Its own lead if it has one, otherwise the lead of its best clustered sequence.
    """
    clustered = sequences.where("lead IS NOT NULL AND individual IS NOT NULL")
    order = F.struct((F.col("lead") != F.col("accno")).alias("f"), (-F.col("score")).alias("s"), F.col("accno").alias("a"))
    return clustered.groupBy("individual", "gene").agg(F.min_by("lead", order).alias("accno"))


def match_by_individual(sequences: DataFrame) -> DataFrame:
    """(gene, accno, other_gene, other_accno) for every lead and every other gene."""
    leads = sequences.where("lead = accno").select("individual", "gene", "accno")
    other = counterparts(sequences).select(
        "individual", F.col("gene").alias("other_gene"), F.col("accno").alias("other_accno")
    )
    return leads.join(other, "individual").where("gene <> other_gene").drop("individual")


def alternatives(sequences: DataFrame, taken: DataFrame, min_length: int) -> DataFrame:
    """(individual, gene, accno): best sequence of an individual not yet in a taxon."""
    free = sequences.where(F.col("length") >= min_length).join(taken, ["gene", "accno"], "left_anti")
    order = F.struct((-F.col("score")).alias("s"), F.col("accno").alias("a"))
    return free.groupBy("individual", "gene").agg(F.min_by("accno", order).alias("accno"))


def link_maximised(sequences: DataFrame, min_length: int) -> DataFrame:
    """(taxon, gene, accno): everything connected through individuals is one taxon.

    Each taxon keeps the best sequence per gene.
    """
    genes = gene_order(sequences, min_length)
    leads = sequences.where((F.col("lead") == F.col("accno")) & (F.col("length") > min_length))
    matched = match_by_individual(sequences).join(leads.select("gene", "accno"), ["gene", "accno"], "left_semi")
    links = matched.select(
        F.struct("gene", "accno").alias("src"),
        F.struct(F.col("other_gene").alias("gene"), F.col("other_accno").alias("accno")).alias("dst"),
    )
    found = connected_components(links).select("node.gene", "node.accno", F.col("component").alias("c"))
    lone = leads.select("gene", "accno").join(found, ["gene", "accno"], "left_anti").select(
        "gene", "accno", F.struct("gene", "accno").alias("c")
    )
    rank = F.array_position(F.array(*[F.lit(g) for g in genes]), F.col("gene"))
    members = found.unionByName(lone).join(sequences.select("gene", "accno", "score"), ["gene", "accno"])
    best = members.groupBy("c", "gene").agg(
        F.min_by("accno", F.struct(-F.col("score"), F.col("accno"))).alias("accno")
    )
    first = members.groupBy("c").agg(F.min(F.struct(rank.alias("r"), F.col("accno").alias("a"))).alias("o"))
    numbered = number_rows(first.select("c", "o.r", "o.a"), ["r", "a"], name="taxon")
    return best.join(numbered.select("c", "taxon"), "c").select("taxon", "gene", "accno")


def link_conservative(sequences: DataFrame, min_length: int) -> DataFrame:
    """(taxon, gene, accno): one pass per gene, most leads first.

    A new lead joins the taxon that holds its individual's sequence in another
    gene and lacks this gene; otherwise it founds a taxon. A sequence wanted by
    several taxa goes to its own individual's taxon, or stays where it is; the
    others get the best unused sequence of their individual, or none.
    """
    genes = gene_order(sequences, min_length)
    sequences = cut_lineage(sequences.select("gene", "accno", "individual", "length", "score", "lead"))
    pairs = cut_lineage(counterparts(sequences))
    scores = sequences.select("gene", "accno", "score")
    spark = sequences.sparkSession
    accno_type = dict(sequences.dtypes)["accno"]
    taxa = spark.createDataFrame([], f"taxon long, gene string, accno {accno_type}")
    founded = 0
    rank = F.array_position(F.array(*[F.lit(g) for g in genes]), F.col("gene"))
    for gene in genes:
        new = sequences.where(
            (F.col("gene") == gene) & (F.col("lead") == F.col("accno")) & (F.col("length") > min_length)
        ).select("accno", "individual").join(
            taxa.where(F.col("gene") == gene).select("accno"), "accno", "left_anti"
        ).withColumnRenamed("accno", "new")
        wanted = cut_lineage(
            new.join(pairs.where(F.col("gene") != gene), "individual").select("new", "individual", "gene", "accno")
        )
        joined = _join_taxa(wanted, taxa, gene, rank)
        fresh = number_rows(new.select("new").join(joined.select("new"), "new", "left_anti"), ["new"], name="n")
        fresh = cut_lineage(fresh.select("new", (F.col("n") + F.lit(founded)).alias("taxon")))
        founded += fresh.count()
        places = cut_lineage(joined.unionByName(fresh).join(new, "new"))
        taxa = cut_lineage(_settle(places, wanted, taxa, sequences, scores, gene, min_length))
    return taxa


def _join_taxa(wanted: DataFrame, taxa: DataFrame, gene: str, rank) -> DataFrame:
    """(new, taxon): each new lead takes the last open taxon that no earlier lead takes."""
    full = taxa.where(F.col("gene") == gene).select("taxon")
    open_taxa = wanted.join(taxa, ["gene", "accno"]).join(full, "taxon", "left_anti").groupBy("new", "taxon").agg(
        F.max(rank).alias("r")
    )
    open_taxa = cut_lineage(open_taxa)
    taken = None
    while not open_taxa.isEmpty():
        choice = open_taxa.groupBy("new").agg(F.max(F.struct("r", "taxon")).alias("x")).select("new", "x.taxon")
        won = cut_lineage(choice.groupBy("taxon").agg(F.min("new").alias("new")).select("new", "taxon"))
        taken = won if taken is None else cut_lineage(taken.unionByName(won))
        open_taxa = cut_lineage(
            open_taxa.join(won.select("new"), "new", "left_anti").join(won.select("taxon"), "taxon", "left_anti")
        )
    return taken if taken is not None else open_taxa.select("new", "taxon")


def _settle(places, wanted, taxa, sequences, scores, gene, min_length):
    """The taxa after placing the new leads of ``gene`` and settling contested sequences."""
    held = taxa.select("taxon", "gene", F.col("accno").alias("held"))
    asked = (
        places.select("taxon", "new").join(wanted, "new").join(held, ["taxon", "gene"], "left")
        .join(scores.withColumnRenamed("score", "s_new"), ["gene", "accno"])
        .join(scores.select("gene", F.col("accno").alias("held"), F.col("score").alias("s_held")), ["gene", "held"], "left")
    )
    claims = cut_lineage(
        asked.where("held IS NULL OR (held <> accno AND s_held < s_new)")
        .join(sequences.select("gene", "accno", F.col("individual").alias("owner")), ["gene", "accno"])
        .select("taxon", "new", "individual", "gene", "accno", (F.col("owner") == F.col("individual")).alias("own"))
    )
    contested = claims.select("gene", "accno").distinct()
    holders = cut_lineage(taxa.join(contested, ["gene", "accno"], "left_semi"))
    verdict = claims.groupBy("gene", "accno").agg(
        F.max(F.when(F.col("own"), F.col("new"))).alias("owner_new"), F.min("new").alias("first_new")
    ).join(holders.groupBy("gene", "accno").agg(F.count(F.lit(1)).alias("h")), ["gene", "accno"], "left")
    winner = F.when(F.col("owner_new").isNotNull(), F.col("owner_new")).when(F.col("h").isNull(), F.col("first_new"))
    judged = cut_lineage(verdict.select("gene", "accno", winner.alias("winner")))
    claimed = claims.join(judged, ["gene", "accno"])
    won = claimed.where("new = winner").select("taxon", "gene", "accno")

    this_gene = taxa.where(F.col("gene") == gene).select("taxon", F.col("accno").alias("mine")).join(
        sequences.where(F.col("gene") == gene).select(F.col("accno").alias("mine"), "individual"), "mine"
    ).select("taxon", "individual")
    ousted = holders.join(judged.where("winner IS NOT NULL").select("gene", "accno"), ["gene", "accno"], "left_semi")
    ousted = ousted.join(won.select("taxon", "gene", "accno"), ["taxon", "gene", "accno"], "left_anti")
    losers = claimed.where("winner IS NULL OR new <> winner").select("taxon", "individual", "gene", "accno").unionByName(
        ousted.join(this_gene, "taxon", "left").select("taxon", "individual", "gene", "accno")
    )
    losers = cut_lineage(losers)
    kept = taxa.join(ousted.select("taxon", "gene"), ["taxon", "gene"], "left_anti")
    kept = kept.join(won.select("taxon", "gene"), ["taxon", "gene"], "left_anti").unionByName(won)
    kept = cut_lineage(kept.unionByName(places.select("taxon", F.lit(gene).alias("gene"), F.col("new").alias("accno"))))

    # Losers of one individual share out its unused sequences, best first.
    seeking = losers.where("individual IS NOT NULL")
    free = sequences.where(F.col("length") >= min_length).join(
        seeking.select("individual", "gene").distinct(), ["individual", "gene"], "left_semi"
    ).join(kept.select("gene", "accno"), ["gene", "accno"], "left_anti").withColumn("_s", -F.col("score"))
    offered = number_rows(free, ["_s", "accno"], ["individual", "gene"], "k").select(
        "individual", "gene", "k", F.col("accno").alias("other")
    )
    lined = number_rows(seeking, ["taxon", "accno"], ["individual", "gene"], "k")
    replaced = lined.join(offered, ["individual", "gene", "k"]).where("other <> accno").select(
        "taxon", "gene", F.col("other").alias("accno")
    )
    replaced = cut_lineage(replaced)
    return kept.join(replaced.select("taxon", "gene"), ["taxon", "gene"], "left_anti").unionByName(replaced)


def profile_classes(members: DataFrame, unit: str, columns: Sequence[str], kinds: Sequence[str]):
    """Classes of units with the same column values: (values, units).

    ``values`` has class, column, value, n and total; ``units`` has unit and
    class. Units of one class score alike against anything, so pairs need to
    be formed only once per pair of classes. Missing values equal each other.
    """
    stacked = members.select(
        unit,
        F.explode(F.array(*[
            F.struct(
                F.lit(i).alias("col"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value"),
                F.col(c).isNull().alias("missing"),
            ) for i, c in enumerate(columns)
        ])).alias("x"),
    ).groupBy(unit, "x.col", "x.value", "x.missing").agg(F.count(F.lit(1)).alias("n"))
    additive = [i for i, kind in enumerate(kinds) if kind == "a"]
    counted = stacked.withColumn(
        "n", F.when(F.col("col").isin(*additive), F.col("n")).otherwise(F.lit(1)) if additive else F.lit(1).cast("long")
    )
    counted = cut_lineage(counted)

    def total(seed):
        return F.sum(F.xxhash64("col", "value", "missing", "n", F.lit(seed)).cast("decimal(38,0)"))

    signed = counted.groupBy(unit).agg(total(1).alias("h1"), total(2).alias("h2"), F.count(F.lit(1)).alias("k"))
    named = signed.groupBy("h1", "h2", "k").agg(F.min(unit).alias("class"))
    units = cut_lineage(signed.join(named, ["h1", "h2", "k"]).select(unit, "class"))
    values = counted.join(
        units.select("class").distinct().withColumnRenamed("class", unit), unit, "left_semi"
    ).withColumnRenamed(unit, "class")
    totals = values.groupBy("class", "col").agg(F.sum("n").alias("total"))
    return values.join(totals, ["class", "col"]), units


def edge_scores(left: DataFrame, right: DataFrame, kinds: Sequence[str], scores: Sequence[float]) -> DataFrame:
    """(src, dst, weight) between the classes of two sides.

    Over all pairs of records of the two classes, with ``m`` equal and ``t``
    compared: o scores once, a per match, e only if all match, h half if some do.
    """
    matched = left.alias("l").join(
        right.alias("r"),
        (F.col("l.col") == F.col("r.col")) & (F.col("l.value") == F.col("r.value"))
        & (F.col("l.missing") == F.col("r.missing")),
    ).groupBy(F.col("l.class").alias("src"), F.col("r.class").alias("dst"), F.col("l.col").alias("col")).agg(
        F.sum(F.col("l.n") * F.col("r.n")).alias("m"), F.max(F.col("l.total") * F.col("r.total")).alias("t")
    )
    weight = F.lit(None).cast("double")
    for i, (kind, score) in enumerate(zip(kinds, scores)):
        score = F.lit(float(score))
        value = {
            "o": score,
            "a": score * F.col("m"),
            "e": F.when(F.col("m") == F.col("t"), score).otherwise(F.lit(0.0)),
            "h": F.when(F.col("m") == F.col("t"), score).otherwise(score / 2),
        }[kind]
        weight = F.when(F.col("col") == i, value).otherwise(weight)
    return matched.groupBy("src", "dst").agg(F.sum(weight).alias("weight")).where("weight > 0")


def match_units(left_units: DataFrame, right_units: DataFrame, edges: DataFrame, left: str, right: str,
                edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(left, right): matched units, from the matching of their classes."""
    sizes = (
        left_units.groupBy("class").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("class", "src"),
        right_units.groupBy("class").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("class", "dst"),
    )
    flows = cut_lineage(max_weight_matching(edges, sizes, edges_per_task))
    spread = running_sum(flows, "units", ["dst"], ["src"], "upto1")
    spread = cut_lineage(running_sum(spread, "units", ["src"], ["dst"], "upto2"))
    # One row per matched unit, spread in steps so that a large flow is no single array.
    steps = F.sequence(F.lit(0).cast("long"), F.floor((F.col("units") - 1) / UNITS_PER_STEP))
    stepped = spread.select("*", F.explode(steps).alias("_step")).repartition("src", "dst", "_step")
    first = F.col("_step") * UNITS_PER_STEP
    within = F.sequence(first, F.least(first + UNITS_PER_STEP, F.col("units")) - 1)
    slots = stepped.select("*", F.explode(within).alias("_at")).select(
        "src", "dst", (F.col("upto1") - F.col("_at")).alias("k1"), (F.col("upto2") - F.col("_at")).alias("k2")
    )
    ranked_left = number_rows(left_units, [left], ["class"], "k1").withColumnRenamed("class", "src")
    ranked_right = number_rows(right_units, [right], ["class"], "k2").withColumnRenamed("class", "dst")
    return slots.join(ranked_left, ["src", "k1"]).join(ranked_right, ["dst", "k2"]).select(left, right)


def multimotu(
    sequences: DataFrame, columns: Sequence[str], kinds: Sequence[str], scores: Sequence[float],
    edges_per_task: int = EDGES_PER_TASK,
) -> DataFrame:
    """(taxon, gene, accno): clusters linked gene by gene by maximum-weight matching.

    ``sequences`` has gene, accno, lead and the compared record columns. Each
    cluster of the first gene is a taxon; the clusters of every further gene
    are matched to the taxa they share most with, or become new taxa.
    """
    clustered = cut_lineage(sequences.where("lead IS NOT NULL").select("gene", "accno", "lead", *columns))
    genes = [row["gene"] for row in clustered.select("gene").distinct().orderBy("gene").collect()]
    leads = clustered.where("lead = accno").select("gene", "accno")
    taxa = number_rows(leads.where(F.col("gene") == genes[0]), ["accno"], name="taxon").select("taxon", "gene", "accno")
    taxa = cut_lineage(taxa)
    for gene in genes[1:]:
        members = taxa.join(clustered.withColumnRenamed("accno", "member"), (
            (taxa["gene"] == clustered["gene"]) & (taxa["accno"] == clustered["lead"])
        )).select("taxon", *columns)
        clusters = clustered.where(F.col("gene") == gene).select("lead", *columns)
        values1, units1 = profile_classes(members, "taxon", columns, kinds)
        values2, units2 = profile_classes(clusters, "lead", columns, kinds)
        edges = edge_scores(values1, values2, kinds, scores)
        links = cut_lineage(match_units(units1, units2, edges, "taxon", "lead", edges_per_task))
        linked = links.select("taxon", F.lit(gene).alias("gene"), F.col("lead").alias("accno"))
        rest = units2.select("lead").join(links.select("lead"), "lead", "left_anti")
        highest = taxa.agg(F.max("taxon")).first()[0] or 0
        fresh = number_rows(rest, ["lead"], name="n").select(
            (F.col("n") + F.lit(highest)).alias("taxon"), F.lit(gene).alias("gene"), F.col("lead").alias("accno")
        )
        taxa = cut_lineage(taxa.unionByName(linked).unionByName(fresh))
    return taxa
