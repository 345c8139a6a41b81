import itertools
import random

import pytest

from taxaweave.operators.linking import edge_scores, link_conservative, link_maximised, multimotu, profile_classes
from taxaweave.operators.matching import max_weight_matching


def brute_force(edges):
    best = 0
    for k in range(len(edges) + 1):
        for chosen in itertools.combinations(edges, k):
            if len({e[0] for e in chosen}) == k and len({e[1] for e in chosen}) == k:
                best = max(best, sum(e[2] for e in chosen))
    return best


def weight(edges, rows):
    weights = {(s, d): w for s, d, w in edges}
    used = [(r["src"], r["dst"]) for r in rows for _ in range(r["units"])]
    assert len({s for s, _ in used}) == len(used) == len({d for _, d in used})
    return sum(weights[p] for p in used)


def test_small_example(spark):
    edges = [("2", "1", 14.0), ("2", "3", 18.0)]
    got = max_weight_matching(spark.createDataFrame(edges, "src string, dst string, weight double")).collect()
    assert [(r["src"], r["dst"], r["units"]) for r in got] == [("2", "3", 1)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(f"t{i}", f"c{j}", float(rng.randrange(1, 9))) for i in range(4) for j in range(4) if rng.random() < 0.7]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    assert weight(edges, max_weight_matching(df).collect()) == brute_force(edges)


def test_auction_equals_brute_force(spark):
    edges = [("t0", "c0", 4.0), ("t0", "c1", 3.5), ("t1", "c0", 3.0), ("t2", "c0", 3.5), ("t2", "c1", 2.0)]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    assert weight(edges, max_weight_matching(df, edges_per_task=0).collect()) == brute_force(edges)


@pytest.mark.parametrize("bound", [20_000, 0])
def test_fine_weights(spark, bound):
    edges = [("a", "x", 0.0004), ("a", "y", 0.0001), ("b", "x", 0.0001)]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    assert weight(edges, max_weight_matching(df, edges_per_task=bound).collect()) == brute_force(edges)


def test_weights_too_fine_are_refused(spark):
    df = spark.createDataFrame([("a", "x", 1e-9)], "src string, dst string, weight double")
    with pytest.raises(ValueError, match="decimals"):
        max_weight_matching(df)


def test_capacities(spark):
    edges = spark.createDataFrame([("a", "x", 2.0), ("a", "y", 1.0), ("b", "x", 2.0)], "src string, dst string, weight double")
    left = spark.createDataFrame([("a", 5), ("b", 2)], "src string, n long")
    right = spark.createDataFrame([("x", 4), ("y", 9)], "dst string, n long")
    rows = max_weight_matching(edges, (left, right)).collect()
    # x is full either way; a fills y with what is left, so b takes its two places in x.
    assert {(r["src"], r["dst"]): r["units"] for r in rows} == {("a", "x"): 2, ("a", "y"): 3, ("b", "x"): 2}


@pytest.mark.parametrize("kind,half,full", [("o", 2, 2), ("a", 2, 4), ("e", 0, 2), ("h", 1, 2)])
def test_edge_kinds(spark, kind, half, full):
    taxa = spark.createDataFrame([(1, "x"), (2, "x")], "u int, c string")
    groups = spark.createDataFrame([(7, "x"), (7, "y"), (8, "x"), (8, "x")], "u int, c string")
    left, left_units = profile_classes(taxa, "u", ["c"], [kind])
    right, right_units = profile_classes(groups, "u", ["c"], [kind])
    assert left_units.select("class").distinct().count() == 1
    got = {r["dst"]: r["weight"] for r in edge_scores(left, right, [kind], [2]).collect()}
    assert got.get(7, 0) == half and got[8] == full


COLUMNS = "gene string, accno string, individual string, length int, score double, lead string"


def taxa_of(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["taxon"], {})[r["gene"]] = r["accno"]
    return {n: found[n] for n in sorted(found)}


def test_linking_by_individual(spark):
    rows = [
        ("its", "i1", "I1", 100, 100.0, "i1"), ("its", "i2", "I2", 100, 90.0, "i2"), ("its", "i3", "I3", 100, 80.0, "i3"),
        ("lsu", "l1", "I1", 100, 100.0, "l1"), ("lsu", "l2", "I2", 100, 90.0, "l2"), ("lsu", "l9", "I9", 100, 50.0, "l9"),
        ("cox", "c3", "I3", 100, 70.0, "c3"), ("cox", "c9", "I9", 40, 70.0, "c9"),
    ]
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    want = [{"its": "i1", "lsu": "l1"}, {"its": "i2", "lsu": "l2"}, {"cox": "c3", "its": "i3"}, {"cox": "c9", "lsu": "l9"}]
    for link in (link_conservative, link_maximised):
        assert sorted(map(str, ({k: t[k] for k in sorted(t)} for t in taxa_of(link(df, 50)).values()))) == sorted(map(str, want))


def test_shared_cluster_policies(spark):
    # Both individuals' second gene clusters under l1, which belongs to I1.
    rows = [
        ("its", "i1", "I1", 100, 100.0, "i1"), ("its", "i2", "I2", 100, 90.0, "i2"),
        ("lsu", "l1", "I1", 100, 100.0, "l1"), ("lsu", "l2", "I2", 100, 60.0, "l1"),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    # Conservative: l1 stays with its own individual, I2 gets its unused sequence.
    assert list(taxa_of(link_conservative(df, 50)).values()) == [{"its": "i1", "lsu": "l1"}, {"its": "i2", "lsu": "l2"}]
    # Maximised: one taxon with the best sequence of each gene.
    assert list(taxa_of(link_maximised(df, 50)).values()) == [{"its": "i1", "lsu": "l1"}]


def test_multimotu(spark):
    rows = [
        ("a", "a1", "a1", "sp1"), ("a", "a2", "a2", "sp2"), ("a", "a3", "a3", "sp2"),
        ("b", "b1", "b1", "sp2"), ("b", "b2", "b2", "sp3"), ("b", "b3", "b1", "sp2"), ("b", "b4", "b4", "sp1"),
    ]
    df = spark.createDataFrame(rows, "gene string, accno string, lead string, species string")
    got = taxa_of(multimotu(df, ["species"], ["h"], [2]))
    assert got == {1: {"a": "a1", "b": "b4"}, 2: {"a": "a2", "b": "b1"}, 3: {"a": "a3"}, 4: {"b": "b2"}}


def test_matching_query_reads_every_priority(spark, tmp_path):
    from taxaweave.plans import QUERIES

    # Two customers and two dates without an urgent or high order; each pair agrees in status and priority.
    rows = [(1, 7, "O", "3-MEDIUM", "1995-01-01"), (2, 8, "F", "5-LOW", "1995-01-02")]
    spark.createDataFrame(
        rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate string"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    found = {tuple(r[:2]) for r in QUERIES["max_matching"](spark, str(tmp_path)).select("src", "dst").collect()}
    assert found == {(7, 9131), (8, 9132)}


@pytest.mark.parametrize("bound", [20_000, 0])
def test_prices_prove_the_matching(spark, bound):
    from taxaweave.operators.matching import dual_prices

    rng, most = random.Random(11), 3 if bound else 1
    edges = [(f"t{i}", f"c{j}", rng.choice([0.5, 1.0, 1.5, 2.5, 4.0])) for i in range(6) for j in range(5) if rng.random() < (0.6 if bound else 0.15)]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    sizes = (
        spark.createDataFrame([(f"t{i}", rng.randrange(1, most + 1)) for i in range(6)], "src string, n long"),
        spark.createDataFrame([(f"c{j}", rng.randrange(1, most + 1)) for j in range(5)], "dst string, n long"),
    )
    flows = max_weight_matching(df, sizes, edges_per_task=bound)
    left, right = ({r[0]: (r["n"], r["price"]) for r in side.collect()} for side in dual_prices(df, flows, sizes))
    assert all(p >= 0 for _, p in [*left.values(), *right.values()])
    assert all(left[s][1] + right[d][1] >= w - 1e-9 for s, d, w in edges)
    weights = {(s, d): w for s, d, w in edges}
    total = sum(weights[r["src"], r["dst"]] * r["units"] for r in flows.collect())
    assert sum(n * p for n, p in [*left.values(), *right.values()]) == pytest.approx(total)
    with pytest.raises(ValueError, match="greatest weight"):
        dual_prices(df, spark.createDataFrame([], "src string, dst string, units long"), sizes)
