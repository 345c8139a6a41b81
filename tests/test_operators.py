import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxaweave import functions as X
from taxaweave.functions.columns import cut_off_for, cut_offs
from taxaweave.operators import blocks, clean, clusters, genes, individuals, matrix, naming, outliers, similarity, taxonomy


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).first()["r"]


def test_reverse_complement(spark):
    assert one(spark, X.reverse_complement(F.col("s")), s="ACGTRYN") == "NRYACGT"
    for text in ("ACGTRYWSKMBDHVN", "acgt-n"):
        twice = X.reverse_complement(X.reverse_complement(F.col("s")))
        assert one(spark, twice, s=text) == text.upper()


def test_scalar_functions(spark):
    assert one(spark, X.safe_name(F.col("s")), s="Agaricus cf. testus (L.) Fr.") == "Agaricus_cf_testus_Fr_"
    assert one(spark, X.letter_share(F.col("s"), "N"), s="ANNA") == 0.5
    assert one(spark, X.letter_share(F.col("s"), "N"), s="") is None
    assert one(spark, X.jukes_cantor(F.col("p")), p=0.3) == pytest.approx(-0.75 * math.log(1 - 0.4))
    assert one(spark, X.jukes_cantor(F.col("p")), p=0.75) is None
    assert one(spark, X.in_lineage(F.col("s"), "B"), s="A; B; C") is True
    assert one(spark, X.in_lineage(F.col("s"), "B"), s="A; BB") is False


def test_cut_offs(spark):
    df = spark.createDataFrame([("its",), ("lsu",)], "gene string")
    got = df.select("gene", cut_off_for(F.col("gene"), cut_offs("its,0.97,default,0.99")).alias("c")).collect()
    assert {r["gene"]: r["c"] for r in got} == {"its": 0.97, "lsu": 0.99}
    with pytest.raises(Exception, match="no cut-off"):
        df.select(cut_off_for(F.col("gene"), cut_offs("its,0.97"))).collect()


def test_best_representative_and_ties(spark):
    df = spark.createDataFrame([("g", "a", 90.0), ("g", "b", 100.0), ("g", "c", 90.0), ("h", "z", 5.0), ("h", "y", 5.0)], "g string, id string, s double")
    got = {r["g"]: r["lead"] for r in clusters.elect_leads(df, ["g"], "id", F.col("s")).collect()}
    assert got == {"g": "b", "h": "y"}


def test_missing_keys_are_groups(spark):
    df = spark.createDataFrame([("a", "x", 1.0), (None, "y", 2.0), (None, "z", 3.0)], "g string, id string, s double")
    got = {r["id"]: r["lead"] for r in clusters.with_leads(df, ["g"], "id", F.col("s")).collect()}
    assert got == {"x": "x", "y": "z", "z": "z"}
    rows = clusters.leads_or_all(df, ["g"], F.col("id") == "y").collect()
    assert sorted(r["id"] for r in rows) == ["x", "y"]
    spread = {r["g"]: (r["median"], r["mad"]) for r in outliers.median_deviation(df, ["g"], "s").collect()}
    assert spread == {"a": (1.0, 0.0), None: (2.5, 0.5)}


def test_individuals(spark):
    rows = [
        ("1", "v1", None, None), ("2", "v1", "s1", None), ("3", None, "s1", None), ("4", None, None, None),
        ("5", "v5", None, "Ind_7"), ("6", "v5", None, None), ("7", "v7", "s7", "Ind_3"), ("8", "v7", "s7", "Ind_4"), ("9", "v7", None, None),
    ]
    df = spark.createDataFrame(rows, "accno string, voucher string, strain string, individual string")
    for parts in (1, 4):
        got = {r["accno"]: r["individual"] for r in individuals.define_individuals(df.repartition(parts), "accno", ["voucher", "strain"]).collect()}
        assert got["1"] == got["2"] == got["3"] == "Ind_8"
        assert got["5"] == got["6"] == "Ind_7" and got["7"] == "Ind_3" and got["8"] == "Ind_4"
        assert (got["4"], got["9"]) == ("Ind_9", "Ind_10")


def test_individual_condition(spark):
    df = spark.createDataFrame([("1", "v", "a"), ("2", "v", "b"), ("3", "v", "a")], "accno string, voucher string, species string")
    got = {r["accno"]: r["individual"] for r in individuals.define_individuals(df, "accno", ["voucher"], "species").collect()}
    assert got["1"] == got["3"] != got["2"]


def test_hits_to_slices(spark):
    hits = spark.createDataFrame([
        ("r1", "its_start_1", 5, 9, 1e-9), ("r1", "its_start_2", 6, 9, 1e-20), ("r1", "its_end_1", 30, 40, 1e-9),
        ("r1", "lsu_start_1", 61, 70, 1e-9), ("r2", "its_end_1", 1, 12, 1e-8), ("r3", "its_middle_1", 4, 9, 1e-8),
        ("r4", "its_whole_1", 3, 20, 1e-30), ("r4", "its_start_1", 9, 12, 1e-9), ("r5", "its_start_1", 20, 25, 1e-9),
        ("r5", "its_end_1", 2, 9, 1e-9), ("r6", "junk", 1, 2, 1e-9),
    ], "accno string, model string, hit_start int, hit_end int, evalue double")
    found = genes.intervals(genes.resolve_hits(genes.name_parts(hits)))
    between = spark.createDataFrame([("gap", "its", "lsu")], "gene string, lead_gene string, trail_gene string")
    records = spark.createDataFrame([(f"r{i}", "".join(chr(65 + k % 26) for k in range(80))) for i in range(1, 7)], "accno string, sequence string")
    text = records.first()["sequence"]
    got = {(r["accno"], r["gene"]): r["sequence"] for r in genes.slices(genes.add_intergenes(found, between), records).collect()}
    assert got == {
        ("r1", "its"): text[5:40], ("r1", "lsu"): text[60:], ("r1", "gap"): text[40:60], ("r2", "its"): text[:12],
        ("r2", "gap"): text[12:], ("r3", "its"): text, ("r4", "its"): text[2:20], ("r4", "gap"): text[20:],
        ("r5", "gap"): text[9:],
    }


def test_majority_parent_and_rebuild(spark):
    df = spark.createDataFrame([("A; B; c",), ("A; B; d",), ("X; B; e",), ("A; F; B; g",), ("S; S",)], "taxon_string string")
    parents = {r["child"]: r["parent"] for r in taxonomy.majority_parents(taxonomy.parent_counts(df)).collect()}
    assert parents["B"] == "A" and parents["A"] == "o" and parents["S"] == "o"
    new = {r["old"]: r["new"] for r in taxonomy.rebuild_lineages(df, ["e"]).collect()}
    assert new["X; B; e"] == "A; B; e" and new["A; F; B; g"] == "A; B; g"


def test_rebuild_stops_at_cycles(spark):
    df = spark.createDataFrame([("P; Q",), ("Q; P",)], "taxon_string string")
    assert taxonomy.rebuild_lineages(df).count() == 2


def test_common_lineage_and_mixed(spark):
    df = spark.createDataFrame([(1, "A; B; C"), (1, "A; B; D"), (2, "A; B"), (2, "A; B; C"), (3, "X"), (3, "Y")], "taxon int, taxon_string string")
    assert {r["taxon"]: r["lineage"] for r in taxonomy.common_lineage(df).collect()} == {1: "A; B", 2: "A; B", 3: ""}
    assert {r["taxon"]: r["n"] for r in taxonomy.mixed_taxa(df).collect()} == {1: 2, 3: 2}


def test_alignment_groups(spark):
    df = spark.createDataFrame([("g", "F; Ag; Am; sp"), ("g", "F; Ag"), ("g", "F; Bo x"), ("h", "F; Ag")], "gene string, taxon_string string")
    got = {(r["gene"], r["taxon"]) for r in taxonomy.alignment_groups(df).collect()}
    assert got == {("g", "Am"), ("g", "Bo_x"), ("h", "Ag")}
    assert {r["taxon"] for r in taxonomy.alignment_groups(df, lowest=False).collect()} == {"F"}


def test_blocks_and_coverage(spark):
    cells = [(t, g) for t, gs in {1: "ab", 2: "ab", 3: "bc", 4: "bc", 5: "d"}.items() for g in gs]
    df = spark.createDataFrame(cells, "taxon int, gene string")
    assert sorted(r["gene"] for r in matrix.largest_block(df, 2).collect()) == ["a", "b", "c"]
    row = matrix.coverage(df, ["a", "b"]).first()
    assert (row["taxa"], row["complete"], row["gene_coverage"]) == (4, 2, 0.75)


def test_shared_values_hold_distinct_values_only(spark):
    rows = spark.createDataFrame([(1, 7, 8), (2, 8, 9), (3, None, 7), (3, None, 7), (4, 5, None)], "k int, a long, b long")
    found = clean.shared_values(rows, "k", ["a", "b"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert sorted(map(tuple, found.collect())) == [
        ("a", "b", 1, 7, 8), ("a", "b", 2, 8, 9), ("b", "a", 1, 8, 7), ("b", "a", 3, 7, None), ("b", "a", 3, 7, None)]


def test_names(spark):
    df = spark.createDataFrame([(1, "x1", "A b"), (1, "x1", "A b"), (1, "x2", "B c"), (1, "x3", "B c"), (2, "y", "B c")], "taxon int, accno string, species string")
    names = naming.numbered_names(naming.majority_names(df))
    assert {r["taxon"]: r["species_name"] for r in names.collect()} == {1: "B_c_1", 2: "B_c_2"}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("seed,similarity_,q,alphabet", [(1, 0.9, 3, "ACGT"), (2, 0.75, 2, "ACGT"), (3, 0.8, 4, "AB"), (4, 0.6, 3, "ABC")])
def test_similar_pairs_equal_all_pairs(spark, seed, similarity_, q, alphabet):
    rng = random.Random(seed)
    texts = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 24))) for _ in range(25)}
    for text in list(texts)[:20]:
        changed = list(text)
        for _ in range(rng.randrange(1, 4)):
            changed[rng.randrange(len(changed))] = rng.choice(alphabet)
        texts.add("".join(changed) + rng.choice(["", "A"]))
    rows = [("g", f"{i:03d}", t) for i, t in enumerate(sorted(texts))]
    df = spark.createDataFrame(rows, "gene string, accno string, sequence string")
    got = {(r["src"], r["dst"]): r["edits"] for r in similarity.similar_pairs(df, similarity_, q=q).collect()}
    want = {}
    for i, (_, a, s) in enumerate(rows):
        for _, b, t in rows[i + 1:]:
            longest = max(len(s), len(t))
            edits = levenshtein(s, t)
            if edits <= math.floor((1 - similarity_) * longest + 1e-9):
                want[a, b] = edits
    assert got == want and want


@pytest.mark.parametrize("rows", [2, 5_000])
def test_similar_pairs_meet_once(spark, monkeypatch, rows):
    # Frequent grams are dealt into blocks; no candidate but those that signatures allow leaves a task, each once.
    monkeypatch.setattr(similarity, "KEY_ROWS", rows)
    rng = random.Random(7)
    texts = sorted({f"https://www.example.org/{rng.choice('abc')}/{rng.randrange(300)}" for _ in range(60)})
    df = spark.createDataFrame([(g, k, t) for g in "gh" for k, t in enumerate(texts)], "gene string, accno int, sequence string")
    got = [(r["gene"], r["src"], r["dst"], r["edits"]) for r in similarity.similar_pairs(df, 0.92).collect()]
    want = {
        (g, a, b, levenshtein(s, t)) for g in "gh" for a, s in enumerate(texts) for b, t in list(enumerate(texts))[a + 1:]
        if levenshtein(s, t) <= math.floor((1 - 0.92) * max(len(s), len(t)) + 1e-9)}
    assert len(got) == len(set(got)) and set(got) == want and want


def test_greedy_clusters_read_edges_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    nodes = spark.createDataFrame([("g", "a", 9), ("g", "b", 8), ("g", "c", 7), ("g", "d", 5)], "gene string, accno string, length int")
    edges = spark.createDataFrame([("g", "b", "a"), ("g", "b", "c")], "gene string, src string, dst string").mapInPandas(count, "gene string, src string, dst string")
    found = {r["accno"]: r["lead"] for r in clusters.greedy_clusters(nodes, edges).collect()}
    assert found == {"a": "a", "b": "a", "c": "c", "d": "d"} and seen.value == 2


def test_signatures_change_little_by_an_edit(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(80):
        text = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 20)))
        at, way = rng.randrange(len(text)), rng.randrange(3)
        pairs.append((text, text[:at] + ["", "G", "T" + text[at]][way] + text[at + 1:] or "A"))
    found = spark.createDataFrame(pairs, "a string, b string").select(similarity.signature(F.col("a")).alias("a"), similarity.signature(F.col("b")).alias("b"))
    apart = [sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(r["a"], r["b"], strict=True)) for r in found.collect()]
    assert 0 < max(apart) <= 4


def test_block_filter(spark):
    rows = ["ACGTACGTACGTACGTACGT", "ACGTACGTACGTAAGTACGT", "ACGTACGTACGTACGT-CGT", "ACGTACGTACGTTCGTACGT"]
    cells = spark.createDataFrame([("g", i, r) for i, r in enumerate(rows)] + [("g", 9, "-" * 20)][:0], "gene string, taxon int, sequence string")
    sites = blocks.site_counts(cells)
    kept = blocks.conserved_sites(sites, min_initial=3, min_block=3)
    positions = sorted(r["pos"] for r in kept.collect())
    # Position 17 has a gap; 13 and 14 stay as they lie between conserved sites.
    assert positions == [p for p in range(1, 21) if p != 17]
    cut = blocks.keep_sites(cells, sites, kept).collect()
    assert {r["taxon"]: r["sequence"] for r in cut}[2] == "ACGTACGTACGTACGTCGT"


def test_gamma(spark):
    x = [0.01, 0.1, 0.5, 1.0, 2.0, 5.0]
    values = outliers.gamma_cdf(x, 1.0, 1.0)
    assert values == pytest.approx([1 - math.exp(-v) for v in x])
    grid = outliers.gamma_cdf([0.1 * i for i in range(200)], 2.5, 0.3)
    assert all(b >= a - 1e-12 for a, b in zip(grid, grid[1:]))
    rng = random.Random(3)
    data = [rng.gammavariate(1.5, 2.0) for _ in range(4000)]
    mean = sum(data) / len(data)
    shape = outliers.fit_shape(mean, sum(map(math.log, data)) / len(data))
    assert shape == pytest.approx(1.5, rel=0.1)


def test_tail_cut_off(spark):
    rng = random.Random(5)
    data = [(i, rng.gammavariate(2.0, 0.1)) for i in range(300)] + [(900, 9.0), (901, 11.0)]
    df = spark.createDataFrame(data, "id int, length double")
    cut = outliers.tail_cut_off(df, "length", "id")
    assert max(v for i, v in data if i < 900) < cut < 9.0
    both = df.selectExpr("'a' g", "*").union(df.where("id < 900").selectExpr("'b' g", "*")).union(
        df.where("id < 3").selectExpr("'c' g", "id", "0D length"))
    cuts = {r["g"]: r["cut_off"] for r in outliers.tail_cut_offs(both, ["g"], "length", "id").collect()}
    assert cuts["a"] == pytest.approx(cut) and cuts["b"] > max(v for _, v in data[:300]) and cuts["c"] == 1.0
    calm = spark.createDataFrame(data[:300], "id int, length double")
    assert outliers.tail_cut_off(calm, "length", "id") > max(v for _, v in data[:300])


@settings(max_examples=30, deadline=None)
@given(st.text("ACGT", min_size=1, max_size=15), st.text("ACGT", min_size=1, max_size=15))
def test_path_spells_both(a, b):
    from taxaweave.operators.align import path_to_centre

    path = path_to_centre(a, b)
    assert path.replace("-", "").upper() == b
    assert sum(1 for c in path if c.isupper() or c == "-") == len(a)


def test_first_met_pairs_by_bits():
    import random

    import numpy as np
    import pandas as pd

    from taxaweave.operators import similarity

    draw = random.Random(2)
    lists = [np.array(draw.sample(range(-400, 400), draw.randint(0, 12)), np.int64) for _ in range(120)]
    bits = similarity._key_bits(similarity._earlier(pd.Series(lists)))
    x, y = np.triu_indices(len(lists), 1)
    found = set(similarity._first_met(bits, x, y).tolist())
    assert len(bits) > 2
    assert found == {k for k in range(len(x)) if not set(lists[x[k]]) & set(lists[y[k]])}
    assert similarity._earlier(pd.Series([np.array([], np.int64)] * 2)).shape == (0, 2)
