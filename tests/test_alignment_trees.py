import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaweave.operators import align, profile_scan, trees
from taxaweave.sinks import text as sink
from taxaweave.sources.profiles import parse_profiles


def aligned_ok(rows, originals):
    assert len({len(s) for s in rows.values()}) == 1
    assert {k: s.replace("-", "") for k, s in rows.items()} == originals


def test_alignment(spark):
    sequences = {"a": "ACGTACGTTTGACC", "b": "ACGTACGTTGACC", "c": "ACGGTACGTTTGACC", "d": "ACGTACGTTTGA"}
    df = spark.createDataFrame([("g", "x", k, s) for k, s in sequences.items()] + [("g", "lone", "z", "ACGT")], "gene string, grp string, accno string, sequence string")
    rows = align.align(df, ["gene", "grp"]).collect()
    aligned_ok({r["accno"]: r["sequence"] for r in rows if r["grp"] == "x"}, sequences)
    assert [r["sequence"] for r in rows if r["grp"] == "lone"] == ["ACGT"]
    merged = align.merge_groups(align.align(df, ["gene", "grp"]), ["gene"], "grp").collect()
    aligned_ok({r["accno"]: r["sequence"] for r in merged}, {**sequences, "z": "ACGT"})


def test_merge_keeps_group_columns(spark):
    df = spark.createDataFrame([
        ("g", "x", "a", "AC-GTACGT"), ("g", "x", "b", "ACTGTACGT"), ("g", "y", "c", "ACGTA--CGTTT"), ("g", "y", "d", "ACGTAGGCGTTT"),
    ], "gene string, grp string, accno string, sequence string")
    rows = {r["accno"]: r["sequence"] for r in align.merge_groups(df, ["gene"], "grp").collect()}
    aligned_ok(rows, {"a": "ACGTACGT", "b": "ACTGTACGT", "c": "ACGTACGTTT", "d": "ACGTAGGCGTTT"})


def test_neighbours_in_strips(monkeypatch):
    draw = random.Random(3)
    sequences = ["".join(draw.choices("ACGT", k=60)) for _ in range(25)]
    sequences += sequences[:5]
    names, distance = [str(k) for k in range(30)], trees._distances(sequences)
    whole = trees._join_neighbours("", names, distance)
    for cached in (1, 70, 450):
        monkeypatch.setattr(trees, "CACHED", cached)
        assert trees._join_neighbours("", names, distance) == whole


def test_trees_of_many_taxa(spark):
    draw = random.Random(4)
    df = spark.createDataFrame([("t", str(k), "".join(draw.choices("ACGT", k=12))) for k in range(3_001)], "tree string, taxon string, sequence string")
    nodes = trees.build_trees(df)
    assert nodes.where("label IS NOT NULL").count() == 3_001


def test_joining_does_not_read_the_whole_table_at_each_step():
    draw = random.Random(6)
    n = 1500
    distance = trees._distances(["".join(draw.choices("ACGT", k=96)) for _ in range(n)])
    start = time.perf_counter()
    for _ in range(3):
        np.multiply(distance, 2.0).argmin()
    once = (time.perf_counter() - start) / 3
    start = time.perf_counter()
    rows = trees._join_neighbours("", [str(k) for k in range(n)], distance)
    # The tables of all steps are n / 3 times the first one.
    assert time.perf_counter() - start < n / 3 * once * 0.8
    assert len(rows) == 2 * n - 2


def test_equal_pairs_are_joined_by_age():
    # Two pairs of equal sums and distances, and copies without any distance between them.
    names = list("abcd")
    rows = {r[3]: r[1] for r in trees._join_neighbours("", names, np.array([[0, 1, 3, 3], [1, 0, 3, 3], [3, 3, 0, 1], [3, 3, 1, 0]], float)) if r[3]}
    assert rows["a"] == rows["b"] == "i0"
    rows = trees._join_neighbours("", [str(k) for k in range(40)], np.zeros((40, 40)))
    assert {r[3] for r in rows if r[1] == "i0"} == {"0", "1"} and len(rows) == 78
    assert all(r[2] is None or r[2] == 0 for r in rows)


def test_splits_of_small_trees_take_no_rounds(spark, monkeypatch):
    nodes = newick(spark, "((a:1,b:1):1,(c:1,(d:1,e:1):5):1,f:9);")
    extra = spark.createDataFrame([(None, "n0", None, None, None), (None, "n1", "n0", 1.0, "a")], nodes.schema)
    in_rounds = sorted(trees.clades(nodes.unionByName(extra), 0).collect())
    monkeypatch.setattr(trees, "subtree_totals", lambda *_: pytest.fail("in rounds"))
    found = trees.clades(nodes.unionByName(extra))
    assert found.schema["split"].dataType.simpleString() == "decimal(38,0)"
    assert len(in_rounds) == 3 and sorted(found.collect()) == in_rounds


def plain_path(centre, sequence):
    """One pair by the plain table; equal letters first, then a gap in the sequence, then an inserted letter."""
    best = {}
    for i in range(len(centre) + 1):
        for j in range(len(sequence) + 1):
            ways = [(0, 0)] if not i and not j else []
            if i and j:
                ways.append((best[i - 1, j - 1][0] + (align.EQUAL if centre[i - 1] == sequence[j - 1] else align.UNEQUAL), 0))
            if i:
                ways.append((best[i - 1, j][0] + align.GAP, -1))
            if j:
                ways.append((best[i, j - 1][0] + align.GAP, -2))
            best[i, j] = max(ways)
    i, j, out = len(centre), len(sequence), ""
    while i or j:
        step = best[i, j][1]
        i, j = i - (step != -2), j - (step != -1)
        out = ("-" if step == -1 else sequence[j] if step == 0 else sequence[j].lower()) + out
    return out


def test_paths_in_blocks(monkeypatch):
    draw = random.Random(8)
    sequences = ["".join(draw.choices("ACGT", k=draw.randint(0, 12))) for _ in range(60)]
    for cells in (align.CELLS, 400, 1):
        monkeypatch.setattr(align, "CELLS", cells)
        for centre in ["", "ACGTTGCA", "GG"]:
            assert align.paths_to_centre(centre, sequences) == [plain_path(centre, s) for s in sequences]


def test_rows_are_aligned_in_many_tasks(spark):
    rows = [("g", k, "ACGT" * (1 + k % 3)) for k in range(200)]
    df = spark.createDataFrame(rows, "gene string, accno int, sequence string").coalesce(1)
    assert sum(n > 0 for n in align.dealt(df, "accno").rdd.glom().map(len).collect()) > 1
    assert align.align(df, ["gene"]).rdd.getNumPartitions() > 1


TREE = "((a:1,b:2)95:1,(c:1,('d e':1,e:1):2):3,f:4);"


def newick(spark, *texts):
    return trees.parse_newick(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "tree string, newick string"))


def test_newick_round_trip(spark):
    nodes = newick(spark, TREE, "(x:1,y:2);")
    assert {r["label"] for r in trees.tips(nodes).collect()} == {"a", "b", "c", "d e", "e", "f", "x", "y"}
    again = trees.parse_newick(trees.to_newick(nodes))
    text = {r["tree"]: r["newick"] for r in trees.to_newick(again).collect()}
    assert text["0"] == "((a:1,b:2):1,(c:1,(d e:1,e:1):2):3,f:4);"
    total = {r["tree"]: r["total"] for r in trees.tree_length(nodes).collect()}
    assert total == {"0": 16.0, "1": 3.0}


def test_prune_and_rename(spark):
    nodes = newick(spark, TREE)
    drop = spark.createDataFrame([("c",), ("e",), ("f",)], "label string")
    pruned = trees.to_newick(trees.prune(nodes, drop)).first()["newick"]
    assert pruned == "((a:1,b:2):1,d e:6);"
    kept = trees.keep_tips(nodes, spark.createDataFrame([("a",), ("e",), ("f",)], "label string"))
    assert trees.to_newick(kept).first()["newick"] == "(a:2,e:6,f:4);"
    names = spark.createDataFrame([("a", "Alpha")], "label string, name string")
    assert "Alpha:1" in trees.to_newick(trees.rename_tips(nodes, names)).first()["newick"]
    status = {r["label"]: r["status"] for r in trees.tip_differences(nodes, spark.createDataFrame([("a",), ("q",)], "label string")).collect()}
    assert status["q"] == "missing" and status["b"] == "superfluous" and "a" not in status


def test_support_ignores_rooting(spark):
    reference = newick(spark, "((a,b),(c,d),e);")
    replicates = newick(spark, "(((c,d),e),a,b);", "((a,b),c,(d,e));", "((a,c),b,(d,e));", "((a,b),(c,d),e);")
    scored = trees.support(reference, replicates).where("support IS NOT NULL").collect()
    assert sorted(r["support"] for r in scored) == [50, 75]


def evolve(rng, names, length=300):
    """Sequences on a balanced tree: neighbours in ``names`` are close relatives."""
    def change(s, rate):
        return "".join(rng.choice("ACGT") if rng.random() < rate else c for c in s)

    def grow(s, part):
        if len(part) == 1:
            return {part[0]: s}
        half = len(part) // 2
        return {**grow(change(s, 0.08), part[:half]), **grow(change(s, 0.08), part[half:])}

    return grow("".join(rng.choice("ACGT") for _ in range(length)), names)


@pytest.mark.parametrize("parts", [1, 5])
def test_distance_tree(spark, parts):
    names = [f"t{i:02d}" for i in range(16)]
    data = evolve(random.Random(2), names)
    df = spark.createDataFrame([("g", k, s) for k, s in data.items()], "tree string, taxon string, sequence string")
    with pytest.raises(ValueError, match="max_taxa"):
        trees.build_trees(df, max_taxa=15)
    nodes = trees.build_trees(df.repartition(parts)).cache()
    rows = nodes.collect()
    assert sorted(r["label"] for r in rows if r["label"]) == names
    assert sum(r["parent"] is None for r in rows) == 1
    known = {r["node"] for r in rows}
    assert all(r["parent"] is None or r["parent"] in known for r in rows)
    text = trees.to_newick(nodes).first()["newick"]
    again = trees.parse_newick(spark.createDataFrame([("g", text)], "tree string, newick string"))
    found = {r["split"] for r in trees.clades(again).collect()}
    halves = newick(spark, "((" + ",".join(names[:8]) + "),(" + ",".join(names[8:]) + "));")
    assert {r["split"] for r in trees.clades(halves).collect()} <= found


def test_tree_parts(spark):
    from taxaweave.operators import treeparts

    nodes = newick(spark, "((a:1,b:1):1,(c:1,(d:1,e:1):5):1,f:9);")
    near = {r["label"]: r["part"] for r in treeparts.short_branch_clusters(nodes, F.lit(4.0)).collect()}
    assert near["a"] == near["b"] == near["c"] != near["d"] == near["e"] and near["f"] not in (near["a"], near["d"])
    values = spark.createDataFrame([("0", x, v) for x, v in zip("abcdef", "xxyyyx")], "tree string, label string, value string")
    clades = {r["label"]: r["part"] for r in treeparts.same_value_clades(nodes, values).collect()}
    assert clades["a"] == clades["b"] and clades["c"] == clades["d"] == clades["e"]
    assert len({clades["a"], clades["c"], clades["f"]}) == 3
    assert set(treeparts.bounded_parts(nodes, 2).collect()) == set(treeparts.bounded_parts(nodes, 2, 0).collect())
    sizes = treeparts.bounded_parts(nodes, 2).groupBy("part").count().collect()
    assert max(r["count"] for r in sizes) <= 2 and sum(r["count"] for r in sizes) == 6


def test_resample_draws_same_columns(spark):
    df = spark.createDataFrame([("g", "a", "ACGTACGT"), ("g", "b", "ACGTACGT"), ("g", "c", "TTTTTTTT")], "tree string, taxon string, sequence string")
    rows = trees.resample(df, 3, seed=5).collect()
    drawn = {(r["tree"], r["taxon"]): r["sequence"] for r in rows}
    assert len(drawn) == 9 and len({drawn[f"g/{i}", "a"] for i in (1, 2, 3)}) > 1
    assert all(drawn[f"g/{i}", "a"] == drawn[f"g/{i}", "b"] and len(drawn[f"g/{i}", "c"]) == 8 for i in (1, 2, 3))


def profile_text(name, consensus):
    lines = ["HMMER3/f", f"NAME  {name}", f"LENG  {len(consensus)}", "ALPH  DNA", "STATS LOCAL VITERBI -8.0 0.71",
             "HMM          A        C        G        T   ", "            m->m     m->i     m->d     i->m     i->i     d->m     d->d",
             "  COMPO   1.38 1.38 1.38 1.38", "   1.38 1.38 1.38 1.38", "   0.006 5.7 5.7 1.46 0.26 0.0 *"]
    for i, base in enumerate(consensus, 1):
        last = i == len(consensus)
        lines.append(f"  {i} " + " ".join("0.03" if base == b else "4.6" for b in "ACGT") + f" {i} {base} - - -")
        lines.append("   1.38 1.38 1.38 1.38")
        lines.append("   0.003 6.0 * 1.46 0.26 0.0 *" if last else "   0.006 5.7 5.7 1.46 0.26 1.09 0.40")
    return "\n".join(lines) + "\n//\n"


def test_matches_together_are_those_alone():
    from taxaweave.operators.profile_scan import _Packed, best_matches

    rng = random.Random(4)
    ends = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (12, 30)]
    packed = _Packed(parse_profiles("".join(profile_text(f"g_start_{k}", e) for k, e in enumerate(ends))))
    rows = ["".join(rng.choice("ACGTN") for _ in range(rng.randint(1, 60))) + rng.choice(["", *ends]) for _ in range(30)]
    assert best_matches(rows, packed) == [best_matches([r], packed)[0] for r in rows]


def test_profile_scan(spark):
    rng = random.Random(9)

    def noise(n):
        return "".join(rng.choice("ACGT") for _ in range(n))

    first, second = noise(40), noise(36)
    profiles = parse_profiles(profile_text("its_start_1", first) + profile_text("its_end_1", second))
    assert [p.name for p in profiles] == ["its_start_1", "its_end_1"] and len(profiles[0].match) == 40
    whole = noise(30) + first + noise(50) + second + noise(20)
    gap = noise(10) + first[:15] + first[17:] + noise(5)
    cut = first[6:] + noise(60)
    turned = whole[::-1].translate(str.maketrans("ACGT", "TGCA"))
    records = spark.createDataFrame([("whole", whole), ("turned", turned), ("gap", gap), ("cut", cut), ("none", noise(200))], "accno string, sequence string")
    hits = profile_scan.scan(records, profiles, 1e-4)
    got = {(r["accno"], r["model"]): (r["hit_start"], r["hit_end"], r["reverse"]) for r in hits.collect()}
    assert got["whole", "its_start_1"] == (31, 70, False)
    assert got["whole", "its_end_1"] == (121, 156, False)
    assert got["turned", "its_start_1"] == (31, 70, True)
    assert got["gap", "its_start_1"][:2] == (11, 48)
    assert got["cut", "its_start_1"][0] == 1
    assert not [k for k in got if k[0] == "none"]
    fixed = {r["accno"]: r["sequence"] for r in profile_scan.turn_records(records, hits).collect()}
    assert fixed["turned"] == whole and fixed["whole"] == whole


def cells(spark):
    return spark.createDataFrame([("t1", "a", "ACGTA"), ("t1", "b", "GG-"), ("taxon2", "b", "cc-"), ("t3", "a", "TTTTT")], "taxon string, gene string, sequence string")


def written(path):
    import glob

    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*.txt")))


def test_alignment_files(spark, tmp_path):
    sink.write_alignment(cells(spark), ["a", "b"], str(tmp_path / "x"))
    assert written(tmp_path / "x") == "3 8\nt1     ACGTAGG-\nt3     TTTTT---\ntaxon2 -----CC-\n"
    assert written(tmp_path / "x.partitions") == "DNA, a = 1-5\nDNA, b = 6-8\n"
    sink.write_alignment(cells(spark), ["a", "b"], str(tmp_path / "f"), form="fasta")
    assert written(tmp_path / "f").startswith(">t1\nACGTAGG-\n>t3\n")
    sink.write_alignment(cells(spark), ["a", "b"], str(tmp_path / "i"), interleave=5)
    assert written(tmp_path / "i") == "3 8\nt1     ACGTA\nt3     TTTTT\ntaxon2 -----\n       GG-\n       ---\n       CC-\n"
    sink.write_alignment(cells(spark), ["a", "b"], str(tmp_path / "n"), form="nexus", interleave="genes")
    text = written(tmp_path / "n")
    assert "DIMENSIONS  NTAX=3 NCHAR=8;" in text and "INTERLEAVE=YES" in text
    assert "t1     ACGTA\nt3     TTTTT\ntaxon2 -----\nt1     GG-\n" in text
    assert text.endswith("BEGIN MRBAYES;\n\n    charset a = 1-5;\n    charset b = 6-8;\n\nEND;\n")


def test_tree_files(spark, tmp_path):
    rows = [("a", "combined", "(x,y);"), ("b", "combined", "none"), ("c", "other", "(x,y);")]
    df = spark.createDataFrame(rows, "gene string, taxon string, tree string")
    missing = sink.write_trees(df, str(tmp_path / "t"), "combined")
    assert [r["gene"] for r in missing.collect()] == ["b"]
    assert [p.name for p in (tmp_path / "t").iterdir() if p.is_dir()] == ["gene=a"]


def test_merge_by_lineage(spark):
    names = [f"t{i:02d}" for i in range(8)]
    data = evolve(random.Random(4), names, 60)
    # Two orders of two genera each; one record hangs on its order, one has no lineage.
    paths = {n: ["r", f"o{i // 4}", f"g{i // 2}"] for i, n in enumerate(names)}
    paths["t03"], paths["t07"] = ["r", "o0"], None
    rows = [("g", n, s.replace("A", "", int(n[1:])), paths[n], "/".join(paths[n] or [n])) for n, s in data.items()]
    df = spark.createDataFrame(rows, "gene string, accno string, sequence string, ranks array<string>, grp string")
    merged = align.merge_by_lineage(align.align(df, ["gene", "grp"]), ["gene"], "grp", "ranks")
    assert merged.columns == df.columns
    found = {r["accno"]: r["sequence"] for r in merged.collect()}
    assert len({len(s) for s in found.values()}) == 1
    assert {n: s.replace("-", "") for n, s in found.items()} == {r[1]: r[2] for r in rows}
    assert align.merge_by_lineage(df.limit(0), ["gene"], "grp", "ranks").count() == 0


def test_bootstrap_query_has_a_hundred_replicates(spark):
    from taxaweave.plans import QUERIES

    found = {r["support"] for r in QUERIES["bootstrap_support"](spark, "/root/testdata/sf0.001").select("support").collect()}
    # Two replicates give 0, 50 and 100 alone; a hundred give every whole per cent.
    assert all(0 <= x <= 100 for x in found) and len(found - {0, 50, 100}) > 10 and any(x % 5 for x in found)
