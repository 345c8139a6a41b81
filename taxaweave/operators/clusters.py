"""Clusters of redundant sequences and the best representative of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.operators.components import connected_components
from taxaweave.operators.ranking import join_groups
from taxaweave.session import cut_lineage


def best_by(identifier: str, score: Column) -> Column:
    """Aggregate: the identifier with the highest score, smallest on ties."""
    return F.min_by(identifier, F.struct((-score).alias("s"), F.col(identifier).alias("i")))


def elect_leads(df: DataFrame, keys: Sequence[str], identifier: str, score: Column) -> DataFrame:
    """One row per group: lead, number of members and the lead's score."""
    return df.groupBy(*keys).agg(
        best_by(identifier, score).alias("lead"),
        F.count(F.lit(1)).alias("members"),
        F.max(score).alias("score"),
    )


def with_leads(df: DataFrame, keys: Sequence[str], identifier: str, score: Column) -> DataFrame:
    """Every row with the lead of its group; the join is split when a group is hot."""
    leads = elect_leads(df, keys, identifier, score).select(*keys, "lead")
    return join_groups(df, leads, list(keys))


def leads_or_all(df: DataFrame, keys: Sequence[str], is_lead: Column) -> DataFrame:
    """Leads of groups that have any, otherwise every row of the group."""
    flagged = df.withColumn("_lead", F.coalesce(is_lead, F.lit(False)))
    has = flagged.groupBy(*keys).agg(F.max("_lead").alias("_any"))
    return join_groups(flagged, has, list(keys)).where("_lead OR NOT _any").select(*df.columns)


def merge_clusters(sequences: DataFrame, links: DataFrame) -> DataFrame:
    """Merge clusters along ``links`` and elect the lead of each merged cluster.

    ``sequences`` has gene, accno, score and lead (NULL when unclustered);
    ``links`` has gene, src, dst. Members of an existing cluster stay together;
    only leads and unclustered sequences may become the new lead, so a member
    counts with its lead's score. Sequences on no link keep their state.
    """
    node = F.struct("gene", "accno")
    existing = sequences.where("lead IS NOT NULL AND lead <> accno").select(
        node.alias("src"), F.struct("gene", F.col("lead").alias("accno")).alias("dst")
    )
    new = links.select(
        F.struct("gene", F.col("src").alias("accno")).alias("src"),
        F.struct("gene", F.col("dst").alias("accno")).alias("dst"),
    )
    found = connected_components(existing.unionByName(new)).select(
        "node.gene", "node.accno", F.col("component.accno").alias("component")
    )
    joined = sequences.join(found, ["gene", "accno"], "left")
    eligible = joined.where("component IS NOT NULL AND (lead IS NULL OR lead = accno)")
    leads = eligible.groupBy("gene", "component").agg(best_by("accno", F.col("score")).alias("_new"))
    return joined.join(leads, ["gene", "component"], "left").select(
        *[c for c in sequences.columns if c != "lead"],
        F.coalesce("_new", "lead").alias("lead"),
    )


def cluster_individuals(sequences: DataFrame, min_length: int) -> DataFrame:
    """Cluster the long enough sequences of one gene and individual.

    ``sequences`` has gene, accno, individual, length, score and lead. A record
    without individual leads its own cluster, in the first run as in later ones.
    """
    long_enough = sequences.where(F.col("length") >= min_length)
    if sequences.where("lead IS NOT NULL").isEmpty():
        leads = elect_leads(
            long_enough, ["gene", "individual"], "accno", F.col("score")
        ).select("gene", "individual", F.col("lead").alias("_new"))
        joined = sequences.join(leads, ["gene", "individual"], "left")
        return joined.withColumn(
            "lead", F.when(F.col("length") >= min_length, F.coalesce("_new", "accno"))
        ).select(*sequences.columns)
    first = long_enough.groupBy("gene", "individual").agg(F.min("accno").alias("dst"))
    links = (
        long_enough.select("gene", "individual", F.col("accno").alias("src"))
        .join(first, ["gene", "individual"]).where("src <> dst").select("gene", "src", "dst")
    )
    merged = merge_clusters(sequences, links)
    return merged.withColumn(
        "lead", F.coalesce("lead", F.when(F.col("length") >= min_length, F.col("accno")))
    )


def greedy_clusters(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Longest-first greedy clusters: (gene, accno, lead).

    ``nodes`` has gene, accno, length; ``edges`` has gene, src, dst and joins
    sequences that are similar enough. A sequence leads when no longer similar
    sequence leads; the others follow the longest lead they resemble. Each
    round settles every sequence that has no undecided longer neighbour, so
    the outcome equals the one-by-one order without running one by one.
    """
    rank = F.struct((-F.col("length")).alias("l"), F.col("accno").alias("a"))
    ranked = nodes.select("gene", "accno", rank.alias("rank"))
    # Both directions from one pass over the edges, which may have been costly to find.
    turned = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = edges.select("gene", F.explode(turned).alias("e")).select("gene", "e.src", "e.dst").distinct()
    better = cut_lineage(
        both.join(ranked.select("gene", F.col("accno").alias("src"), F.col("rank").alias("mine")), ["gene", "src"])
        .join(ranked.select("gene", F.col("accno").alias("dst"), F.col("rank").alias("theirs")), ["gene", "dst"])
        .where("theirs < mine").select("gene", "src", "dst", "theirs")
    )
    undecided = cut_lineage(ranked.select("gene", "accno"))
    leads = None
    while not undecided.isEmpty():
        waiting = better.join(
            undecided.select("gene", F.col("accno").alias("dst")), ["gene", "dst"], "left_semi"
        ).select("gene", F.col("src").alias("accno")).distinct()
        chosen = cut_lineage(undecided.join(waiting, ["gene", "accno"], "left_anti"))
        followers = better.join(
            chosen.select("gene", F.col("accno").alias("dst")), ["gene", "dst"], "left_semi"
        ).select("gene", F.col("src").alias("accno")).distinct()
        leads = chosen if leads is None else cut_lineage(leads.unionByName(chosen))
        undecided = cut_lineage(
            undecided.join(chosen, ["gene", "accno"], "left_anti")
            .join(followers, ["gene", "accno"], "left_anti")
        )
    if leads is None:
        return nodes.select("gene", "accno", F.col("accno").alias("lead"))
    followed = (
        better.join(leads.select("gene", F.col("accno").alias("dst")), ["gene", "dst"], "left_semi")
        .groupBy("gene", F.col("src").alias("accno")).agg(F.min_by("dst", "theirs").alias("_lead"))
    )
    own = leads.withColumn("_own", F.col("accno"))
    return (
        nodes.select("gene", "accno").join(own, ["gene", "accno"], "left")
        .join(followed, ["gene", "accno"], "left")
        .select("gene", "accno", F.coalesce("_own", "_lead").alias("lead"))
    )
