"""Run named modules in order on the tables of one database.

Every module reads tables, derives new ones with the operators, and replaces
them whole; nothing is updated in place. Tables live in the Spark catalog.
"""

from __future__ import annotations

import re
import sys
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave import config
from taxaweave.config import Settings
from taxaweave.functions import quality_score
from taxaweave.functions.columns import cut_off_for, cut_offs
from taxaweave.operators import (
    align, blocks, clean, clusters, genes, guided, individuals, linkage, linking, matrix, naming, outliers,
    profile_scan, similarity, taxonomy, tree_scores, treeparts, trees,
)
from taxaweave.operators import rogues as rogue_search
from taxaweave.operators.components import stars
from taxaweave.session import cut_lineage
from taxaweave.sinks import text as sink
from taxaweave.sinks.single import join_parts
from taxaweave.sources import genbank, text
from taxaweave.sources.profiles import read_profiles

# Fixed value: leaf names that carry no classification.
VAGUE_TAXA = ("environmental samples", "mycorrhizal samples")


class Database:
    """Named tables of one catalog database."""

    def __init__(self, spark: SparkSession, name: str):
        if not re.fullmatch(r"\w+", name):
            raise ValueError("a database name must be given (letters, digits and _)")
        self.spark, self.name = spark, name
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.name}.{table}")

    def read(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise ValueError(f"no table {table} in {self.name}; run the module that makes it first")
        return self.spark.table(f"{self.name}.{table}")

    def replace(self, table: str, df: DataFrame) -> None:
        """Write the new version beside the old one, then take its place.

        The old version is dropped last, so that a run that breaks off loses nothing.
        """
        mark = uuid.uuid4().hex[:8]
        fresh, old = f"{self.name}.{table}_{mark}", f"{self.name}.{table}_{mark}_old"
        df.write.saveAsTable(fresh)
        had = self.exists(table)
        if had:
            self.spark.sql(f"ALTER TABLE {self.name}.{table} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {self.name}.{table}")
        if had:
            self.spark.sql(f"DROP TABLE {old}")

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.name))

    def backup(self, suffix: str) -> str:
        """Copy all tables to a new database that no earlier backup uses."""
        base, number = f"{self.name}_{suffix}", 0
        name = base
        while self.spark.catalog.databaseExists(name):
            number += 1
            name = f"{base}_{number}"
        self.spark.sql(f"CREATE DATABASE {name}")
        for table in self.tables():
            self.read(table).write.saveAsTable(f"{name}.{table}")
        return name


def _genes(db: Database, wanted) -> list[str]:
    """Gene names asked for, ``all`` of them, or the largest ``max_block_N``."""
    cells = db.read("alignments") if db.exists("alignments") else db.read("gene_sequences")
    block = re.fullmatch(r"max_block_([0-9]+)", wanted[0]) if wanted else None
    if block:
        found = matrix.largest_block(db.read("alignments").where("sequence IS NOT NULL"), int(block.group(1)))
        return sorted(r["gene"] for r in found.collect())
    known = sorted(r["gene"] for r in cells.select("gene").distinct().collect())
    if not wanted or wanted[0] == "all":
        return known
    return [g for g in wanted if g in known]


def scored(db: Database) -> DataFrame:
    """Gene sequences with length, quality score and individual of their record."""
    records = db.read("gb_data")
    if "individual" not in records.columns:
        records = records.withColumn("individual", F.lit(None).cast("string"))
    return db.read("gene_sequences").join(
        records.select("accno", "individual", "species", "taxon_string", F.col("proportion_N").alias("share")), "accno"
    ).withColumn("length", F.length("sequence")).withColumn(
        "score", quality_score(F.length("sequence"), F.coalesce("share", F.lit(0.0)))
    )


def _store_leads(db: Database, clustered: DataFrame) -> None:
    kept = db.read("gene_sequences").select("gene", "accno", "sequence")
    db.replace("gene_sequences", kept.join(clustered.select("gene", "accno", "lead"), ["gene", "accno"], "left"))


def gb_parser(db, s):
    records = genbank.read_genbank(db.spark, s.gb_file, s.max_seq_length)
    db.replace("gb_data", genbank.require_unique(records))
    skipped = genbank.skipped_count(db.spark, s.gb_file, s.max_seq_length)
    if skipped:
        warnings.warn(f"{skipped} records longer than {s.max_seq_length} were left out", stacklevel=2)
    # The report: lineage lines that were not understood.
    return genbank.odd_lineage_lines(genbank.entries(db.spark, s.gb_file))


def check_taxonomy(db, s):
    records = db.read("gb_data")
    conflicts = taxonomy.parent_conflicts(taxonomy.parent_counts(records))
    if s.only_show:
        return conflicts
    # Written out, as the table it reads is replaced.
    conflicts = cut_lineage(conflicts)
    new = taxonomy.rebuild_lineages(records, VAGUE_TAXA)
    joined = records.join(new, F.col("taxon_string") == F.col("old"), "left")
    db.replace("gb_data", joined.withColumn("taxon_string", F.coalesce("new", "taxon_string")).select(*records.columns))
    return conflicts


def change_entries(db, s):
    if not s.changes_files:
        raise ValueError("change_entries needs changes_files")
    option = s.change_option.lower()[:1]
    unused = None
    for path in s.changes_files:
        records = db.read("gb_data")
        if option == "c":
            columns, lines = text.read_changes(db.spark, path)
            changed = records
            for column in columns:
                mine = lines.where(F.col("column") == column).drop("column")
                idle = clean.unused_lines(mine.drop("line"), records, {"old": column}).select("old")
                unused = idle if unused is None else unused.unionByName(idle)
                changed = clean.change_values(changed, column, mine)
        else:
            columns, lines = text.read_rows(db.spark, path)
            on = columns if option == "r" else columns[:1]
            idle = clean.unused_lines(lines.drop("line"), records, {c: c for c in on}).select(F.concat_ws("\t", *on).alias("old"))
            unused = idle if unused is None else unused.unionByName(idle)
            changed = (
                clean.remove_matching(records, lines, columns) if option == "r"
                else clean.update_by_key(records, columns[0], lines, "line")
            )
        unused = cut_lineage(unused)
        db.replace("gb_data", changed)
    first = unused.agg(F.min("old").alias("old"), F.count(F.lit(1)).alias("n")).first()
    if first["n"]:
        warnings.warn(f"{first['n']} change lines matched nothing, such as {first['old']!r}", stacklevel=2)
    return unused


def define_individuals(db, s):
    if not s.individual_columns:
        raise ValueError("define_individuals needs individual_columns")
    records = db.read("gb_data")
    found = individuals.define_individuals(records, "accno", s.individual_columns, s.individual_condition or None)
    db.replace("gb_data", records.drop("individual").join(found, "accno"))


def gene_parser(db, s):
    profiles = read_profiles(db.spark, s.hmm_database)
    records = db.read("gb_data")
    fit = records.where((F.col("proportion_N") < s.n_cut_off) & (F.length("sequence") > s.min_seq_length_gene))
    hits = cut_lineage(profile_scan.scan(fit, profiles, s.e_value_cut_off))
    turned = cut_lineage(profile_scan.turn_records(records, hits))
    between = db.spark.createDataFrame(
        config.intergenes(s.inter_genes), "gene string, lead_gene string, trail_gene string"
    )
    found = genes.intervals(genes.resolve_hits(genes.name_parts(hits)))
    pieces = genes.slices(genes.add_intergenes(found, between), turned)
    db.replace("gb_data", turned)
    db.replace("gene_sequences", pieces.withColumn("lead", F.lit(None).cast("string")))
    if s.print_non_match:
        rest = fit.select("accno").join(db.read("gene_sequences").select("accno"), "accno", "left_anti")
        rest.write.mode("overwrite").text(f"{s.out_file_name}.non_match")


def cluster_individuals(db, s):
    _store_leads(db, clusters.cluster_individuals(scored(db), s.min_seq_length_gene))


def _open_sequences(db, s):
    """Sequences to cluster: the leads of genes that have any, otherwise all."""
    rows = scored(db).where(F.col("length") >= s.min_seq_length_gene)
    return clusters.leads_or_all(rows, ["gene"], F.col("lead") == F.col("accno"))


def _merge(db, s, links):
    merged = clusters.merge_clusters(scored(db), cut_lineage(links))
    # A long enough sequence in no cluster leads its own.
    alone = F.when(F.col("length") >= s.min_seq_length_gene, F.col("accno"))
    _store_leads(db, merged.withColumn("lead", F.coalesce("lead", alone)))


def _similar(rows, s):
    limit = cut_off_for(F.col("gene"), cut_offs(s.sim_cut_off))
    texts = similarity.distinct_texts(rows, "gene", "accno", "sequence")
    copies = similarity.copy_links(rows, "gene", "accno", "sequence")
    return texts, similarity.similar_pairs(texts, limit), copies


def similarity_cluster(db, s):
    _, pairs, copies = _similar(_open_sequences(db, s), s)
    pairs = cut_lineage(pairs)
    _merge(db, s, pairs.select("gene", "src", "dst").unionByName(copies))
    distances = similarity.pair_distances(pairs)
    db.replace("distance_spread", outliers.median_deviation(distances.where("distance IS NOT NULL"), ["gene"], "distance"))


def cd_hit_cluster(db, s):
    texts, pairs, copies = _similar(_open_sequences(db, s), s)
    greedy = clusters.greedy_clusters(texts.select("gene", "accno", F.length("sequence").alias("length")), pairs)
    links = greedy.where("lead <> accno").select("gene", F.col("accno").alias("src"), F.col("lead").alias("dst"))
    _merge(db, s, links.unionByName(copies))


def tree_clustering(db, s):
    rows = _open_sequences(db, s).withColumn("tree", F.concat_ws("|", "gene", "taxon_string"))
    kind = s.tree_clust_type.lower()
    both = kind.startswith("b")
    sizes = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(rows.join(sizes, "tree").select("tree", "gene", "accno", "sequence", "species", "n"))
    few, many = rows.where("n <= 3"), rows.where("n > 3")
    limit = cut_off_for(F.col("gene"), cut_offs(s.sim_cut_off))
    links = []
    if both or kind.startswith("sp"):
        same = stars(few.where("species IS NOT NULL"), ["tree", "gene", "species"], "accno")
        links.append(same)
    if both or kind.startswith("si"):
        texts = similarity.distinct_texts(few, "tree", "accno", "sequence").withColumn("gene", F.split_part("tree", F.lit("|"), F.lit(1)))
        links.append(similarity.similar_pairs(texts, limit, "tree").select("src", "dst"))
        links.append(similarity.copy_links(few, "tree", "accno", "sequence").select("src", "dst"))
    nodes = cut_lineage(trees.build_trees(align.align(many.select("tree", "accno", "sequence"), ["tree"]), "accno"))
    if both or kind.startswith("si"):
        gene = F.split_part("tree", F.lit("|"), F.lit(1))
        near = treeparts.short_branch_clusters(nodes, 1 - cut_off_for(gene, cut_offs(s.sim_cut_off)))
        links.append(stars(near, ["part"], "label"))
    if both or kind.startswith("sp"):
        values = many.select("tree", F.col("accno").alias("label"), F.col("species").alias("value"))
        links.append(stars(treeparts.same_value_clades(nodes, values), ["part"], "label"))
    joined = links[0].select("src", "dst")
    for more in links[1:]:
        joined = joined.unionByName(more.select("src", "dst"))
    named = joined.join(rows.select("gene", F.col("accno").alias("src")), "src").join(
        rows.select("gene", F.col("accno").alias("dst")), ["gene", "dst"]
    )
    _merge(db, s, named.select("gene", "src", "dst").distinct())


def alignment_groups(db, s):
    leads = scored(db).where("lead = accno")
    lineages = leads.select("gene", "taxon_string").where("taxon_string IS NOT NULL")
    found = cut_lineage(taxonomy.alignment_groups(lineages, s.group_on_genera))
    placed = _place(db, leads.select("gene", "accno", "sequence"), found)
    spread = guided.alignability(cut_lineage(placed.select("gene", "grp", "accno", "sequence")))
    marked = found.join(spread.select("gene", F.col("grp").alias("taxon"), "alignable"), ["gene", "taxon"], "left")
    alignable = F.coalesce("alignable", F.lit(1))
    if db.exists("distance_spread"):
        # A gene whose clustered sequences scatter widely is not alignable in any group.
        marked = marked.join(db.read("distance_spread").select("gene", F.col("mad").alias("gene_mad")), "gene", "left")
        alignable = F.when(F.col("gene_mad") > guided.MAX_SPREAD, 0).otherwise(alignable)
    db.replace("alignment_groups", cut_lineage(marked.select(*found.columns, alignable.cast("int").alias("alignable"))))


def _store_taxa(db, taxa):
    cells = taxa.select(F.concat(F.lit(linking.PREFIX), F.col("taxon").cast("string")).alias("taxon"), "gene", "accno")
    db.replace("alignments", cells.withColumn("sequence", F.lit(None).cast("string")))


def link_genes(db, s):
    link = linking.link_maximised if s.maximize_linking else linking.link_conservative
    _store_taxa(db, link(scored(db), s.min_seq_length_gene))


def multimotu(db, s):
    rows = db.read("gene_sequences").select("gene", "accno", "lead").join(
        db.read("gb_data").select("accno", *s.comp_columns), "accno"
    )
    _store_taxa(db, linking.multimotu(rows, s.comp_columns, s.comp_kind, [float(x) for x in s.comp_score]))


def latin_names(db, s):
    members = db.read("alignments").select("taxon", "accno").join(db.read("gb_data").select("accno", "species"), "accno")
    number = F.regexp_extract("taxon", "([0-9]+)$", 1).cast("long")
    names = naming.majority_names(members).withColumn("n", number)
    db.replace("taxon_names", naming.numbered_names(names, "n").select("taxon", "species_name"))


def _group_cells(db):
    """Cells to align: (taxon, gene, accno, sequence, grp); a cell in no group is its own."""
    cells = db.read("alignments").select("taxon", "gene", "accno").join(
        db.read("gene_sequences").select("gene", "accno", "sequence"), ["gene", "accno"]
    )
    return _place(db, cells, db.read("alignment_groups"))


def _place(db, cells, groups):
    """``cells`` with their group ``grp`` and their lineage down to it."""
    lineages = db.read("gb_data").select("accno", F.explode(F.split("taxon_string", r"\s*;\s*")).alias("name"))
    grouped = lineages.withColumn("grp", F.regexp_replace("name", r"\s", "_")).join(
        groups.select("gene", F.col("taxon").alias("grp")), "grp"
    ).groupBy("gene", "accno").agg(F.min("grp").alias("grp"))
    # Down to the group, or to the record where it has none.
    names = F.transform(F.split("taxon_string", r"\s*;\s*"), lambda name: F.regexp_replace(name, r"\s", "_"))
    whole = db.read("gb_data").select("accno", names.alias("names"))
    placed = cells.join(grouped, ["gene", "accno"], "left").join(whole, "accno", "left")
    upto = F.when(F.col("grp").isNull(), F.size("names")).otherwise(F.array_position("names", F.col("grp")).cast("int"))
    return placed.withColumn("ranks", F.slice("names", F.lit(1), F.greatest(upto, F.lit(0)))).withColumn(
        "grp", F.coalesce("grp", F.concat(F.lit("\t"), "accno"))
    ).drop("names")


def _align_cells(cells):
    if "ranks" not in cells.columns:
        cells = cells.withColumn("ranks", F.lit(None).cast("array<string>"))
    grouped = align.align(cells.select("gene", "grp", "ranks", "taxon", "accno", "sequence"), ["gene", "grp"], "taxon")
    return align.merge_by_lineage(grouped, ["gene"], "grp", "ranks", "taxon").drop("grp", "ranks")


# Fixed value: what the name of a tree method may begin with. The last two choose what refinement makes small.
TREE_METHODS = ("distance", "linkage", "likelihood", "parsimony")


def _build(method, rows):
    """Trees of ``rows`` (tree, taxon, sequence): neighbour joining, or with ``linkage_<similarity>`` along the spanning forest."""
    name, _, rest = method.partition("_")
    if name not in TREE_METHODS:
        warnings.warn(f"tree method {name} is not known; distance trees are built", stacklevel=2)
    if name != "linkage":
        return trees.build_trees(rows)
    number = re.match(r"0?\.[0-9]+", rest)
    return linkage.similarity_trees(rows, float(number.group()) if number else 0.8)


def _gene_trees(cells, s):
    return _build(s.phylo_method, cells.select(F.col("gene").alias("tree"), "taxon", "sequence"))


def _drop_outliers(cells, nodes):
    """Cells without taxa that hang on unlikely long branches of their gene's tree."""
    cuts = outliers.tail_cut_offs(nodes.where("length IS NOT NULL"), ["tree"], "length", "node")
    marked = cut_lineage(nodes.join(cuts, "tree", "left"))
    found = cut_lineage(treeparts.short_branch_clusters(marked, F.coalesce("cut_off", F.lit(float("inf")))))
    best = outliers.largest_cluster(found, ["tree"], "part").select("tree", "part")
    lost = found.join(best, ["tree", "part"], "left_anti").select(F.col("tree").alias("gene"), F.col("label").alias("taxon"))
    return cut_lineage(cells.join(lost, ["gene", "taxon"], "left_anti"))


def _store_trees(db, nodes, taxon, method, names=None, support=None):
    """Replace the stored trees of the same gene and taxon."""
    fresh = trees.to_newick(nodes, support).select(
        (F.lit(names) if names else F.col("tree")).alias("gene"), F.lit(taxon).alias("taxon"),
        F.col("newick").alias("tree"), F.lit(method).alias("tree_method"),
    )
    fresh = cut_lineage(fresh)
    if db.exists("trees"):
        fresh = db.read("trees").join(fresh.select("gene", "taxon"), ["gene", "taxon"], "left_anti").unionByName(fresh)
    db.replace("trees", fresh)


def _replicates(method):
    found = re.search(r"_bootstrap_([0-9]+)", method)
    return int(found.group(1)) if found else 0


def _align_guided(db, s, cells):
    """Align what is alignable by itself, then the other groups in turn, each along the tree of a gene that is linked to its own."""
    groups = db.read("alignment_groups")
    known = cells.join(groups.select("gene", F.col("taxon").alias("grp"), "alignable"), ["gene", "grp"], "left").withColumn(
        "alignable", F.coalesce("alignable", F.lit(1)))
    known = cut_lineage(known)
    if known.where("alignable <> 1").isEmpty():
        return _align_cells(cells)
    links = [(a, b, place) for group in config.gene_groups(s.linked_genes, _genes(db, ["all"])) for a in group for place, b in enumerate(group) if a != b]
    linked = db.spark.createDataFrame(links, "gene string, guide string, place int")
    at = known.select("taxon", "gene", "grp")
    # One row a gene and one it is linked to: sent to all tasks.
    needs = at.join(F.broadcast(linked), "gene").join(
        at.select("taxon", F.col("gene").alias("guide"), F.col("grp").alias("guide_grp")), ["taxon", "guide"]
    ).groupBy("gene", "grp", "guide", "guide_grp", "place").agg(F.count_distinct("taxon").alias("shared"))
    rounds = cut_lineage(guided.guide_rounds(known.select("gene", "grp", "alignable"), needs))
    columns = ["gene", "grp", "ranks", "taxon", "accno", "sequence"]
    placed = cut_lineage(known.join(rounds, ["gene", "grp"]).select(*columns, "round", "guide"))
    # Groups without a guide are aligned like the alignable ones, but guide none.
    aligned = cut_lineage(align.align(placed.where("round = 0").select(*columns), ["gene", "grp"], "taxon"))
    last = rounds.agg(F.max("round").alias("n")).first()["n"] or 0
    for number in range(1, last + 1):
        now = placed.where(F.col("round") == number).withColumn("tree", F.concat_ws("|", "gene", "grp"))
        ready = cut_lineage(align.merge_by_lineage(aligned, ["gene"], "grp", "ranks", "taxon"))
        guides = now.select("tree", "guide", "taxon").join(
            ready.select(F.col("gene").alias("guide"), "taxon", "sequence"), ["guide", "taxon"])
        nodes = cut_lineage(trees.build_trees(guides.select("tree", "taxon", "sequence")))
        nodes = _scaled(now, guides, nodes)
        _store_trees(db, nodes, "guide", "distance")
        tips_ = trees.tips(nodes).withColumnRenamed("label", "taxon")
        inside = now.join(tips_, ["tree", "taxon"], "left_semi")
        guided_rows = guided.align_along(inside.select("tree", F.col("taxon").alias("label"), "sequence"), nodes)
        done = cut_lineage(inside.drop("sequence").join(guided_rows.withColumnRenamed("label", "taxon"), ["tree", "taxon"]).select(*columns))
        outside = now.join(tips_, ["tree", "taxon"], "left_anti").select(*columns)
        aligned = cut_lineage(aligned.unionByName(guided.add_sequences(done, outside, ["gene", "grp"])))
    late = align.align(placed.where("round IS NULL").select(*columns), ["gene", "grp"], "taxon")
    aligned = cut_lineage(aligned.unionByName(late))
    return align.merge_by_lineage(aligned, ["gene"], "grp", "ranks", "taxon").drop("grp", "ranks")


def _scaled(now, guides, nodes):
    """Guide trees with their branches in the measure of the gene they guide."""
    pairs = now.select("tree", "taxon", F.col("sequence").alias("second")).join(
        guides.select("tree", "taxon", F.translate("sequence", "-", "").alias("first")), ["tree", "taxon"])
    return cut_lineage(guided.scale_branches(nodes, matrix.distance_ratios(pairs)))


def align_sequences(db, s):
    cells = _align_guided(db, s, cut_lineage(_group_cells(db)))
    if s.create_gene_trees:
        nodes = cut_lineage(_gene_trees(cells, s))
        if s.remove_outliers:
            cells = _drop_outliers(cells, nodes)
            left = cells.select(F.col("gene").alias("tree"), F.col("taxon").alias("label"))
            drop = trees.tips(nodes).join(left, ["tree", "label"], "left_anti")
            if not drop.isEmpty():
                nodes = cut_lineage(_gene_trees(cells, s))
        support = None
        count = _replicates(s.phylo_method)
        if count:
            rows = cut_lineage(cells.select(F.col("gene").alias("tree"), "taxon", "sequence"))
            replicates = cut_lineage(_build(s.phylo_method, trees.resample(rows, count)))
            if s.store_boot_trees:
                db.replace("gene_boot_trees", trees.to_newick(replicates))
            # A gene's name may hold the mark that divides it from the number of the replicate.
            base = F.regexp_replace("tree", "/[0-9]+$", "")
            nodes, support = cut_lineage(trees.support(nodes, replicates, base)), "support"
        _store_trees(db, nodes, "combined", "distance", support=support)
    db.replace("alignments", cells.select("taxon", "gene", "accno", "sequence"))


def _combined(cells, genes):
    return matrix.concatenate(cells.where("sequence IS NOT NULL"), genes).withColumn("tree", F.lit("combined"))


def _align_whole_tree(raw, nodes):
    """Every gene's sequences along one tree; taxa that the tree lacks are added to the end result."""
    genes = raw.select("gene").distinct()
    # One copy of the tree for each gene of the group.
    copies = cut_lineage(nodes.drop("tree").crossJoin(F.broadcast(genes)).withColumnRenamed("gene", "tree"))
    rows = raw.select(F.col("gene").alias("tree"), F.col("taxon").alias("label"), "sequence")
    done = guided.align_along(rows, copies).select(F.col("tree").alias("gene"), F.col("label").alias("taxon"), "sequence")
    named = cut_lineage(raw.drop("sequence").join(done, ["gene", "taxon"]).select("taxon", "gene", "accno", "sequence"))
    outside = raw.join(named.select("gene", "taxon"), ["gene", "taxon"], "left_anti").select("taxon", "gene", "accno", "sequence")
    return guided.add_sequences(named, outside, ["gene"])


def _badness(s, rows, nodes):
    """What refinement makes small: the length of the tree, its changes, or minus its log-likelihood, as ``phylo_method`` begins."""
    cells = rows.select("tree", F.col("taxon").alias("label"), "sequence")
    if s.phylo_method.startswith("likelihood"):
        return -tree_scores.fitted_likelihood(cells, nodes).first()["log_likelihood"]
    if s.phylo_method.startswith("parsimony"):
        return tree_scores.parsimony(cells, nodes).first()["changes"]
    return trees.tree_length(nodes).first()["total"]


def _start_tree(db, s, rows, name):
    """The stored tree of these genes, without taxa that have no row, and with those placed that it lacks; otherwise a fresh one."""
    rows = cut_lineage(rows)
    stored = db.read("trees").where((F.col("gene") == name) & (F.col("taxon") == "combined")) if db.exists("trees") else None
    if stored is None or stored.isEmpty():
        return cut_lineage(trees.build_trees(rows))
    nodes = cut_lineage(trees.parse_newick(stored.select(F.lit("combined").alias("tree"), F.col("tree").alias("newick"))))
    nodes = cut_lineage(trees.keep_tips(nodes, rows.select(F.col("taxon").alias("label"))))
    if trees.tips(nodes).limit(4).count() < 4:
        return cut_lineage(trees.build_trees(rows))
    cells = rows.select("tree", F.col("taxon").alias("label"), "sequence")
    placed = cut_lineage(tree_scores.placements(cells, nodes))
    return nodes if placed.isEmpty() else cut_lineage(tree_scores.insert_tips(nodes, placed))


def refine_alignments(db, s):
    """Realign along the current tree; keep rounds that make the tree better."""
    kind, _, number = s.stop_criterion.partition("_")
    limit = int(number or 3)
    for group in config.gene_groups(s.linked_genes, _genes(db, s.use_genes)):
        raw = db.read("alignments").where(F.col("gene").isin(*group)).select("taxon", "gene", "accno").join(
            db.read("gene_sequences").select("gene", "accno", "sequence"), ["gene", "accno"]
        )
        raw = cut_lineage(raw)
        if raw.select("taxon").distinct().limit(4).count() < 4:
            continue
        aligned = cut_lineage(db.read("alignments").where(F.col("gene").isin(*group) & F.col("sequence").isNotNull()))
        if aligned.isEmpty():
            aligned = _align_cells(raw.withColumn("grp", F.lit("all")))
        nodes = _start_tree(db, s, _combined(aligned, group), ",".join(group))
        best, best_cells, best_nodes = _badness(s, _combined(aligned, group), nodes), aligned, nodes
        rounds = since = 0
        while (rounds if kind.startswith("it") else since) < limit:
            if s.use_guide_tree:
                cells = _align_whole_tree(raw, nodes)
            else:
                parts = treeparts.bounded_parts(nodes, s.max_alignment_group_size).select(F.col("label").alias("taxon"), F.col("part").alias("grp"))
                cells = _align_cells(raw.join(parts, "taxon"))
            nodes = cut_lineage(trees.build_trees(_combined(cells, group)))
            total = _badness(s, _combined(cells, group), nodes)
            rounds, since = rounds + 1, since + 1
            if total < best:
                best, best_cells, best_nodes, since = total, cells, nodes, 0
        others = db.read("alignments").where(~F.col("gene").isin(*group))
        db.replace("alignments", others.unionByName(best_cells.select("taxon", "gene", "accno", "sequence")))
        _store_trees(db, best_nodes, "combined", "distance", ",".join(group))


def gblocks(db, s):
    wanted = _genes(db, s.use_genes)
    every = db.read("alignments")
    cells = every.where(F.col("gene").isin(*wanted) & F.col("sequence").isNotNull())
    sites = cut_lineage(blocks.site_counts(cells))
    kept = blocks.conserved_sites(
        sites, s.b0 if s.b0 > 2 else 10, s.b1, s.b2, s.b3 or 8, s.b4 if s.b4 > 1 else 10, s.b5
    )
    cut = blocks.keep_sites(cells, sites, kept, s.min_seq_length_gene)
    rest = every.where(~F.col("gene").isin(*wanted))
    db.replace("alignments", rest.unionByName(cut.select(*every.columns)))


def concatenated_tree(db, s):
    wanted = _genes(db, s.use_genes)
    cells = db.read("alignments").where(F.col("sequence").isNotNull() & F.col("gene").isin(*wanted))
    enough = [r["gene"] for r in matrix.gene_counts(cells).where("n > 3").orderBy("gene").collect()]
    if not enough:
        raise ValueError("no gene has more than three sequences")
    if s.anchor_gene:
        anchors = cells.where(F.col("gene").isin(*s.anchor_gene)).groupBy("taxon").agg(F.countDistinct("gene").alias("k"))
        cells = cells.join(anchors.where(F.col("k") == len(s.anchor_gene)).select("taxon"), "taxon", "left_semi")
    rows = cut_lineage(_combined(cells, enough))
    nodes = cut_lineage(_build(s.concat_phylo_method, rows))
    count = _replicates(s.concat_phylo_method)
    if count:
        replicates = cut_lineage(_build(s.concat_phylo_method, trees.resample(rows, count)))
        if s.store_boot_trees:
            db.replace("boot_trees", trees.to_newick(replicates))
        nodes = cut_lineage(trees.support(nodes, replicates))
    _store_trees(db, nodes, "combined", "distance", "combined", "support" if count else None)


def _rogues(db, s):
    """Taxa listed in ``rogue_file`` (tab-separated, third column), or those found in the bootstrap trees."""
    if s.rogue_file:
        lines = db.spark.read.option("sep", "\t").csv(s.rogue_file)
        names = F.trim(lines[lines.columns[2]])
        return lines.select(names.alias("label")).where("label IS NOT NULL AND NOT label IN ('taxon', 'NA')").distinct()
    if not db.exists("boot_trees"):
        raise ValueError("exclude_rogues needs rogue_file, or the bootstrap trees that concatenated_tree stores with store_boot_trees")
    found = cut_lineage(rogue_search.rogue_taxa(trees.parse_newick(db.read("boot_trees"))))
    db.replace("rogue_report", found)
    return found.select("label")


def exclude_rogues(db, s):
    """Remove rogue taxa where asked: those of ``rogue_file``, or without it those found by search."""
    rogues = cut_lineage(_rogues(db, s))
    stored = db.read("trees").where("taxon = 'combined' AND gene = 'combined'").select(F.col("gene").alias("tree"), F.col("tree").alias("newick"))
    nodes = cut_lineage(trees.prune(trees.parse_newick(stored), rogues))
    support = None
    if db.exists("boot_trees"):
        replicates = cut_lineage(trees.prune(trees.parse_newick(db.read("boot_trees")), rogues))
        nodes, support = cut_lineage(trees.support(nodes, replicates)), "support"
    if s.print_rogues:
        rogues.orderBy("label").write.mode("overwrite").text(f"{s.out_file_name}.rogues")
    if s.output_no_rogues_tree:
        trees.to_newick(nodes, support).select("newick").write.mode("overwrite").text(f"{s.out_file_name}.no_rogues.tree")
    if s.rm_rogues_from_ml_tree:
        _store_trees(db, nodes, "combined", "distance", "combined", support)
    if s.rm_rogues_from_alignment:
        kept = db.read("alignments").join(rogues.withColumnRenamed("label", "taxon"), "taxon", "left_anti")
        db.replace("alignments", kept)


def load_alignment(db, s):
    """Take the aligned sequences of one gene from a FASTA file, ``gene,path``; names are taxa or records. Rows of gaps only go."""
    gene, _, path = s.alignment_file.partition(",")
    if not path:
        raise ValueError("load_alignment needs alignment_file, as gene,path")
    kept, dropped = text.split_aligned(text.read_fasta(db.spark, path))
    cells = db.read("alignments")
    own = cells.where(F.col("gene") == gene).drop("sequence")
    # A taxon's name counts before a record's.
    by_taxon = own.join(kept.withColumnRenamed("name", "taxon"), "taxon")
    by_record = own.join(by_taxon.select("taxon"), "taxon", "left_anti").join(kept.withColumnRenamed("name", "accno"), "accno")
    loaded = cut_lineage(by_taxon.select("taxon", "gene", "accno", "sequence").unionByName(by_record.select("taxon", "gene", "accno", "sequence")))
    widths = loaded.select(F.length("sequence").alias("n")).distinct().limit(2).count()
    if widths > 1:
        raise ValueError(f"the sequences of {gene} in {path} differ in length")
    gone = dropped.withColumnRenamed("name", "accno")
    rest = matrix.without(cells.where(F.col("gene") == gene).join(loaded.select("taxon"), "taxon", "left_anti"), gone, "accno")
    names = loaded.select(F.col("taxon").alias("name")).union(loaded.select("accno"))
    strange = kept.select("name").join(names, "name", "left_anti").count()
    if strange:
        warnings.warn(f"{strange} sequences of {path} belong to no taxon or record of {gene}", stacklevel=2)
    db.replace("alignments", cells.where(F.col("gene") != gene).unionByName(loaded).unionByName(rest.select(*loaded.columns)))


def load_tree(db, s):
    """Store the tree of a Newick file (``tree_file``) for the genes in ``use_genes`` and the taxon in ``get_taxon``."""
    stored = db.spark.read.text(s.tree_file, wholetext=True).select(F.lit("tree").alias("tree"), F.col("value").alias("newick"))
    nodes = cut_lineage(trees.parse_newick(stored))
    if nodes.isEmpty():
        raise ValueError(f"no tree in {s.tree_file}")
    _store_trees(db, nodes, s.get_taxon, "file", ",".join(s.use_genes) if s.use_genes[0] != "all" else "combined")


def get_distinct_entries(db, s):
    for column in s.column_name:
        sink.write_table(clean.distinct_values(db.read("gb_data"), column).orderBy(column), f"{s.out_file_name}_{column}")


def get_shared_values(db, s):
    sink.write_table(clean.shared_values(db.read("gb_data"), "accno", s.column_name), f"{s.out_file_name}_shared")


def _named(db, s):
    """Aligned cells under the taxon name asked for."""
    cells = db.read("alignments").where("sequence IS NOT NULL")
    if s.sequence_name_column != "species_name":
        return cells
    return cells.join(db.read("taxon_names"), "taxon").drop("taxon").withColumnRenamed("species_name", "taxon")


def get_alignments(db, s):
    wanted = _genes(db, s.use_genes)
    cells = _named(db, s).where(F.col("gene").isin(*wanted))
    if s.anchor_gene:
        anchors = cells.where(F.col("gene").isin(*s.anchor_gene)).groupBy("taxon").agg(F.countDistinct("gene").alias("k"))
        cells = cells.join(anchors.where(F.col("k") == len(s.anchor_gene)).select("taxon"), "taxon", "left_semi")
    row = "genes" if s.bases_per_row.startswith("gene") else s.bases_per_row
    path = f"{s.out_file_name}.alignment"
    sink.write_alignment(
        cells, wanted, path, partitions=s.partition_file, form=s.alignment_format, interleave=row if s.interleaved else None,
    )
    # The same as single documents.
    join_parts(db.spark, path, f"{path}.{s.alignment_format}")
    if s.partition_file and s.alignment_format != "nexus":
        join_parts(db.spark, f"{path}.partitions", f"{path}.partitions.txt")


def get_trees(db, s):
    if s.only_show:
        return db.read("trees").select("gene", "taxon", "tree_method").orderBy("gene", "taxon")
    wanted = None if s.use_genes[0] == "all" else s.use_genes
    return sink.write_trees(db.read("trees"), f"{s.out_file_name}.trees", s.get_taxon, wanted)


def switch_tip_names(db, s):
    if s.tree_infile:
        stored = db.spark.read.text(s.tree_file, wholetext=True).select(F.lit("tree").alias("tree"), F.col("value").alias("newick"))
    else:
        gene, taxon = s.tree_file.split(",")
        stored = db.read("trees").where((F.col("gene") == gene) & (F.col("taxon") == taxon)).select(
            F.col("gene").alias("tree"), F.col("tree").alias("newick")
        )
    nodes = cut_lineage(trees.parse_newick(stored))
    kinds = trees.tips(nodes).agg(
        F.count_if(F.col("label").contains(linking.PREFIX)).alias("taxa"),
        F.count_if(F.col("label").rlike("^[A-Z_]{2,3}[0-9]+")).alias("accnos"),
    ).first()
    if kinds["taxa"] == kinds["accnos"]:
        raise ValueError("cannot tell whether the tips are taxa or accession numbers")
    if kinds["taxa"] > kinds["accnos"]:
        names = db.read("taxon_names").select(F.col("taxon").alias("label"), F.col("species_name").alias("name"))
    else:
        names = db.read("gb_data").select(F.col("accno").alias("label"), F.concat_ws("_", "accno", "species").alias("name"))
    plain = names.withColumn("name", F.regexp_replace("name", r"""[ '"()\[\]{}:;]""", "_"))
    renamed = trees.rename_tips(nodes, plain)
    trees.to_newick(renamed).select("newick").write.mode("overwrite").text(f"{s.out_file_name}.switched_names.tree")


def get_otu_taxonomy(db, s):
    wanted = _genes(db, s.use_genes)
    cells = db.read("alignments").where(F.col("gene").isin(*wanted))
    if s.anchor_gene:
        cells = cells.join(cells.where(F.col("gene").isin(*s.anchor_gene)).select("taxon").distinct(), "taxon", "left_semi")
    members = cells.join(db.read("gb_data").select("accno", "taxon_string"), "accno").where("taxon_string IS NOT NULL")
    return taxonomy.common_lineage(members)


def stats(db, s):
    wanted = _genes(db, s.use_genes)
    if s.stats_type.startswith("c"):
        species = db.read("gb_data").select("accno", "species")
        rows = db.read("gene_sequences").where(F.col("gene").isin(*wanted) & F.col("lead").isNotNull())
        return rows.select("gene", "lead", "accno").join(species, "accno").orderBy("gene", "lead", "accno")
    cells = db.read("alignments").where(F.col("gene").isin(*wanted) & F.col("sequence").isNotNull())
    cells = matrix.with_anchors(cells, s.anchor_gene)
    leads = db.read("gene_sequences").select("gene", "accno", F.coalesce(F.col("lead") == F.col("accno"), F.lit(False)).alias("is_lead"))
    cells = cut_lineage(cells.join(leads, ["gene", "accno"]).select("taxon", "gene", "accno", "sequence", "is_lead"))
    members = cells.join(db.read("gb_data").select("accno", "taxon_string"), "accno").where("taxon_string IS NOT NULL")
    mixed = taxonomy.mixed_taxa(members)
    if s.stats_type.startswith("d"):
        return matrix.taxon_listing(cells, mixed).orderBy("taxon")
    # One row each: what holds for the whole stands on the row without gene.
    whole = matrix.coverage(cells, wanted).select("complete").crossJoin(F.broadcast(matrix.decisiveness(cells))).crossJoin(
        F.broadcast(mixed.agg(F.count(F.lit(1)).alias("mixed_taxa")))
    )
    rows = matrix.alignment_statistics(cells).crossJoin(F.broadcast(whole))
    on_whole = lambda c: F.when(F.col("gene").isNull(), F.col(c)).alias(c)
    extra = ("complete", "draws", "decisive", "mixed_taxa")
    return rows.select(*[c for c in rows.columns if c not in extra], *[on_whole(c) for c in extra])


# Module names, what runs, and the suffix of the backup taken after it.
MODULES = {
    "gb_parser": (gb_parser, "gb"),
    "check_taxonomy": (check_taxonomy, "taxonomy"),
    "change_entries": (change_entries, "changed"),
    "define_individuals": (define_individuals, "ind"),
    "gene_parser": (gene_parser, "gene"),
    "cluster_individuals": (cluster_individuals, "ind_clust"),
    "tree_clustering": (tree_clustering, "tree_clust"),
    "CD_hit_cluster": (cd_hit_cluster, "CD_clust"),
    "similarity_cluster": (similarity_cluster, "sim_clust"),
    "alignment_groups": (alignment_groups, "align_gr"),
    "link_genes": (link_genes, "linked"),
    "multimotu": (multimotu, "multimotu"),
    "latin_names": (latin_names, "names"),
    "align_sequences": (align_sequences, "aligned"),
    "refine_alignments": (refine_alignments, "refined"),
    "gblocks": (gblocks, "gblocks"),
    "concatenated_tree": (concatenated_tree, "tree"),
    "exclude_rogues": (exclude_rogues, "no_rogues"),
    "load_alignment": (load_alignment, "loaded"),
    "load_tree": (load_tree, "tree_loaded"),
    "get_distinct_entries": (get_distinct_entries, None),
    "get_shared_values": (get_shared_values, None),
    "get_alignments": (get_alignments, None),
    "get_trees": (get_trees, None),
    "switch_tip_names": (switch_tip_names, None),
    "get_otu_taxonomy": (get_otu_taxonomy, None),
    "stats": (stats, None),
}
# Tables each module needs before it can run, and those it makes.
NEEDS = {
    "gene_parser": ("gb_data",), "cluster_individuals": ("gb_data", "gene_sequences"),
    "tree_clustering": ("gene_sequences",), "CD_hit_cluster": ("gene_sequences",),
    "similarity_cluster": ("gene_sequences",), "alignment_groups": ("gene_sequences",),
    "link_genes": ("gene_sequences",), "multimotu": ("gene_sequences",), "latin_names": ("alignments",),
    "align_sequences": ("alignments", "alignment_groups"), "refine_alignments": ("alignments",),
    "gblocks": ("alignments",), "concatenated_tree": ("alignments",), "exclude_rogues": ("trees",),
    "load_alignment": ("alignments",), "load_tree": (),
    "get_alignments": ("alignments",), "get_trees": ("trees",), "get_otu_taxonomy": ("alignments",),
}
MAKES = {
    "gb_parser": ("gb_data",), "gene_parser": ("gene_sequences",), "alignment_groups": ("alignment_groups",),
    "link_genes": ("alignments",), "multimotu": ("alignments",), "latin_names": ("taxon_names",),
    "load_tree": ("trees",), "align_sequences": ("trees",), "refine_alignments": ("trees",), "concatenated_tree": ("trees",),
}


def validate(db: Database, settings: Settings) -> None:
    """Fail before any work when a module's table will be missing when its turn comes."""
    if not settings.modules:
        raise ValueError("no modules given")
    will_be: set[str] = set()
    for module in settings.modules:
        for table in NEEDS.get(module, ("gb_data",) if module != "gb_parser" else ()):
            if table not in will_be and not db.exists(table):
                raise ValueError(f"{module} needs the table {table}")
        will_be.update(MAKES.get(module, ()))
    config.intergenes(settings.inter_genes)


def run(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """Run the modules in order; reports come back as DataFrames by module name."""
    db = Database(spark, settings.database)
    validate(db, settings)
    reports = {}
    for module in settings.modules:
        if module not in MODULES:
            warnings.warn(f"unknown module {module}", stacklevel=2)
            continue
        function, suffix = MODULES[module]
        report = function(db, settings)
        if report is not None:
            # Written out, as later modules may replace the tables it reads.
            reports[module] = cut_lineage(report)
        if suffix and ({module, "all"} & set(settings.backup)):
            db.backup(suffix)
    return reports


def main(arguments=None) -> None:
    from taxaweave.session import build_session

    settings = config.read_arguments(sys.argv[1:] if arguments is None else arguments)
    if settings.print_batch_file:
        print(config.write_batch(settings), end="")
    for module, report in run(build_session(), settings).items():
        print(f"## {module}")
        print("\t".join(report.columns))
        # Row by row: a report may be longer than the driver's memory.
        for row in report.toLocalIterator():
            print("\t".join("" if value is None else str(value) for value in row))


if __name__ == "__main__":
    main()
