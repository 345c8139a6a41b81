"""All modules, end to end, on a small invented record file."""

import random
import warnings

import pytest
from test_alignment_trees import evolve, profile_text, written

from taxaweave import config, runner
from taxaweave.operators import trees

SPECIES = [f"Genus{'AB'[i // 4]} sp{i}" for i in range(8)]


def records_text():
    rng = random.Random(11)
    ends = ["".join(rng.choice("ACGT") for _ in range(30)) for _ in range(4)]
    out, number = [], 0
    for gene, (head, tail) in {"its": ends[:2], "lsu": ends[2:]}.items():
        bodies = evolve(random.Random(gene), [f"{i}" for i in range(8)], 120)
        for i, species in enumerate(SPECIES):
            for copy in range(2):
                number += 1
                body = bodies[str(i)] if copy == 0 else bodies[str(i)][:-3]
                sequence = "TTTT" + head + body + tail + "GGG"
                if number % 3 == 0:
                    sequence = sequence[::-1].translate(str.maketrans("ACGT", "TGCA"))
                out.append(
                    f"LOCUS       AB{number:06d}\nACCESSION   AB{number:06d}\n  ORGANISM  {species}\n"
                    f"            Fungi; Order; {species.split()[0]}.\nFEATURES             Location/Qualifiers\n"
                    f'                     /specimen_voucher="V{i}"\nORIGIN\n        1 {sequence.lower()}\n//\n'
                )
    profiles = "".join(profile_text(n, e) for n, e in zip(("its_start_1", "its_end_1", "lsu_start_1", "lsu_end_1"), ends))
    return "".join(out), profiles


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("project")
    records, profiles = records_text()
    (folder / "r.gb").write_text(records)
    (folder / "p.hmm").write_text(profiles)
    (folder / "batch").write_text(
        f"# a run\ndatabase proj\ngb_file {folder}/r.gb\nhmm_database {folder}/p.hmm\nindividual_columns voucher\n"
        f"e_value_cut_off 1e-3\nout_file_name {folder}/out\nconcat_phylo_method distance_bootstrap_4\nstore_boot_trees\n"
        "min_seq_length_gene 50 # bases\nstop_criterion iterations_1\n"
    )
    yield folder
    for name in spark.catalog.listDatabases():
        if name.name.startswith("proj"):
            spark.sql(f"DROP DATABASE {name.name} CASCADE")


def run(spark, project, modules, *more):
    settings = config.read_arguments(["-f", str(project / "batch"), "-o", modules, *more])
    return runner.run(spark, settings)


def test_needs_tables(spark, project):
    with pytest.raises(ValueError, match="needs the table"):
        run(spark, project, "gene_parser")
    with pytest.raises(ValueError, match="no modules"):
        runner.run(spark, config.read_batch(["database proj"]))


def test_records_to_clusters(spark, project):
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        run(spark, project, "gb_parser,check_taxonomy,define_individuals,gene_parser,nonsense,cluster_individuals", "-b", "gb_parser")
    assert any("nonsense" in str(w.message) for w in caught)
    assert spark.catalog.tableExists("proj_gb.gb_data")
    pieces = spark.table("proj.gene_sequences")
    assert {r["gene"]: r["count"] for r in pieces.groupBy("gene").count().collect()} == {"its": 16, "lsu": 16}
    leads = pieces.where("lead = accno").groupBy("gene").count().collect()
    assert {r["gene"]: r["count"] for r in leads} == {"its": 8, "lsu": 8}
    individuals = spark.table("proj.gb_data").select("individual").distinct().count()
    assert individuals == 8


@pytest.mark.parametrize("module", ["similarity_cluster", "CD_hit_cluster", "tree_clustering"])
def test_other_clusterings_keep_leads(spark, project, module):
    run(spark, project, module, "-s", "all,0.97")
    rows = spark.table("proj.gene_sequences").where("lead IS NOT NULL").collect()
    leads = {(r["gene"], r["accno"]) for r in rows if r["lead"] == r["accno"]}
    assert {(r["gene"], r["lead"]) for r in rows} == leads and len(leads) == 16


def test_link_align_tree(spark, project):
    run(spark, project, "link_genes,latin_names,alignment_groups,align_sequences,gblocks", "-b1", "5", "-b2", "5", "-b4", "2", "-b0", "3", "-b5", "a")
    cells = spark.table("proj.alignments")
    assert cells.select("taxon").distinct().count() == 8 and cells.count() == 16
    widths = cells.selectExpr("gene", "length(sequence) n").distinct().collect()
    assert len(widths) == 2
    names = {r["species_name"] for r in spark.table("proj.taxon_names").collect()}
    assert names == {s.replace(" ", "_") + "_1" for s in SPECIES}

    run(spark, project, "refine_alignments,concatenated_tree")
    stored = {(r["gene"], r["taxon"]): r["tree"] for r in spark.table("proj.trees").collect()}
    assert ("combined", "combined") in stored and ("its", "combined") in stored
    assert stored["combined", "combined"].count("Taxon_") == 8
    assert spark.table("proj.boot_trees").count() == 4


def test_reports(spark, project):
    reports = run(spark, project, "stats,get_otu_taxonomy,get_trees", "-O")
    whole = reports["stats"].where("gene IS NULL").first()
    assert whole["taxa"] == 8 and whole["gene_coverage"] == 1.0
    assert (whole["complete"], whole["draws"], whole["decisive"], whole["mixed_taxa"]) == (8, 1000, 1000, 0)
    assert all(r["complete"] is None for r in reports["stats"].where("gene IS NOT NULL").collect())
    detailed = run(spark, project, "stats", "--stats_type", "detailed", "-Q", "its,lsu")["stats"].collect()
    assert len(detailed) == 8 and all({g["gene"] for g in r["genes"]} >= {"its", "lsu"} and not r["mixed"] for r in detailed)
    conflicts = run(spark, project, "check_taxonomy", "-O")["check_taxonomy"]
    assert conflicts.columns == ["child", "parent", "n"]
    assert {r["lineage"] for r in reports["get_otu_taxonomy"].collect()} == {"Fungi; Order; GenusA", "Fungi; Order; GenusB"}
    assert reports["get_trees"].count() >= 3
    listing = run(spark, project, "stats", "--stats_type", "cluster")["stats"].collect()
    assert len(listing) == 32


def test_files(spark, project):
    run(spark, project, "get_alignments,get_trees,switch_tip_names,get_distinct_entries,get_shared_values", "-U", "species,voucher", "-a", "fasta", "-S", "species_name")
    assert written(project / "out.alignment").count(">Genus") == 8
    tree = written(project / "out.switched_names.tree")
    assert tree.count("Genus") == 8 and "Taxon" not in tree
    assert (project / "out_species").is_dir() and (project / "out_shared").is_dir()


def test_rogues_and_changes(spark, project):
    (project / "rogues").write_text("num\trank\ttaxon\n0\tx\tNA\n1\tx\tTaxon_1\n2\tx\tTaxon_5\n")
    run(spark, project, "exclude_rogues", "--rogue_file", str(project / "rogues"), "-z", "y", "-q", "y", "-x", "y")
    stored = spark.table("proj.trees").where("gene = 'combined' AND taxon = 'combined'").first()["tree"]
    assert stored.count("Taxon_") == 6 and "Taxon_5" not in stored
    assert spark.table("proj.alignments").select("taxon").distinct().count() == 6
    (project / "change").write_text("species\nGenusA sp0\tRenamed\nabsent\tx\n")
    with pytest.warns(UserWarning, match="absent"):
        run(spark, project, "change_entries", "-H", str(project / "change"))
    assert spark.table("proj.gb_data").where("species = 'Renamed'").count() == 4


def test_multimotu(spark, project):
    run(spark, project, "multimotu")
    assert spark.table("proj.alignments").count() == 16
    assert spark.table("proj.alignments").select("taxon").distinct().count() == 8


def test_batch_file_round_trip(project):
    settings = config.read_arguments(["-f", str(project / "batch"), "-o", "gb_parser,catenated_tree", "-e", "1e-9", "-i", "a,b;c"])
    assert settings.modules == ["gb_parser", "concatenated_tree"] and settings.e_value_cut_off == 1e-9
    again = config.read_batch(config.write_batch(settings).splitlines())
    assert again.values == settings.values
    assert config.intergenes("a,b;c") == [("a", "b", "c")]
    assert config.read_arguments(["-d", "x", "-Q", "n"]).anchor_gene == []
    assert config.read_arguments(["-d", "x", "-Q", "its,lsu"]).anchor_gene == ["its", "lsu"]
    with pytest.raises(ValueError):
        config.intergenes("a,b")
    with pytest.raises(ValueError):
        config.read_arguments(["-nope", "x"])


def test_linked_genes():
    assert config.gene_groups("a;b;x,d;e", ["a", "b", "c", "d"]) == [["a", "b"], ["d"], ["c"]]


def test_groups_that_need_a_guide(spark, project):
    """A gene marked as not alignable is aligned along the tree of the gene it is linked to."""
    groups = spark.table("proj.alignment_groups").selectExpr("*").toPandas()
    assert set(groups["alignable"]) <= {0, 1}
    db = runner.Database(spark, "proj")
    marked = spark.table("proj.alignment_groups").selectExpr("gene", "taxon", "if(gene = 'lsu', 0, 1) AS alignable")
    from taxaweave.session import cut_lineage

    db.replace("alignment_groups", cut_lineage(marked))
    run(spark, project, "align_sequences", "-k", "its;lsu", "-p", "distance_bootstrap_2", "-Y", "n", "-G", "n")
    cells = spark.table("proj.alignments")
    assert cells.selectExpr("gene", "length(sequence) n").distinct().count() == cells.select("gene").distinct().count()
    raw = {(r.gene, r.accno): r.sequence for r in spark.table("proj.gene_sequences").collect()}
    assert all(r.sequence.replace("-", "").upper() == raw[r.gene, r.accno].upper() for r in cells.collect())
    methods = {(r.taxon, r.gene.split("|")[0]) for r in spark.table("proj.trees").collect()}
    assert ("combined", "lsu") in methods


def test_loaded_alignment_and_tree(spark, project):
    """A FASTA file and a Newick file take the place of what the tables hold; documents are single files."""
    cells = spark.table("proj.alignments").where("gene = 'its'").orderBy("taxon").collect()
    width = len(cells[0].sequence)
    lines = [f">{r.taxon if k % 2 else r.accno}\n{r.sequence.lower()}A" for k, r in enumerate(cells[:-1])]
    (project / "its.fst").write_text("\n".join([*lines, f">{cells[-1].accno}\n{'-' * (width + 1)}", ">nobody\n" + "A" * (width + 1)]) + "\n")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        run(spark, project, "load_alignment", "--alignment_file", f"its,{project}/its.fst")
    assert any("1 sequences" in str(w.message) for w in caught)
    found = {r.taxon: r.sequence for r in spark.table("proj.alignments").where("gene = 'its'").collect()}
    assert found == {r.taxon: r.sequence.lower() + "A" for r in cells[:-1]}
    (project / "t.tree").write_text("((Taxon_1:1,Taxon_2:1):1,Taxon_3:2);\n")
    run(spark, project, "load_tree", "-R", str(project / "t.tree"), "-u", "its", "-t", "mine")
    stored = {(r.gene, r.taxon): (r.tree, r.tree_method) for r in spark.table("proj.trees").collect()}
    assert stored["its", "mine"] == ("((Taxon_1:1,Taxon_2:1):1,Taxon_3:2);", "file")
    run(spark, project, "get_alignments", "-a", "phylip")
    text = (project / "out.alignment.phylip").read_text().splitlines()
    count, length = map(int, text[0].split())
    assert len(text) == count + 1 and all(len(x.split()[1]) == length for x in text[1:])
    parts = (project / "out.alignment.partitions.txt").read_text().splitlines()
    assert len(parts) == 2 and parts[-1].endswith(f"-{length}")
    run(spark, project, "get_alignments", "-a", "nexus")
    nexus = (project / "out.alignment.nexus").read_text()
    assert nexus.startswith("#NEXUS") and nexus.count("END;") == 2 and f"NTAX={count}" in nexus
    assert not [p for p in project.iterdir() if p.name.startswith("out.alignment.phylip.")]
