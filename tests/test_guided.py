"""Alignment along guide trees against plain versions."""

import random

import numpy as np
import pytest

from taxaweave.operators import guided

NODES = "tree string, node string, parent string, length double, label string"


def best_total(p, q):
    """Best sum over all pairs of rows, by the plain table."""
    n, m = int(p[0].sum()), int(q[0].sum())
    table = np.zeros((len(p) + 1, len(q) + 1), np.int64)
    up = [(n - c[guided.NONE]) * m * guided.GAP for c in p]
    left = [(m - c[guided.NONE]) * n * guided.GAP for c in q]
    for i in range(len(p) + 1):
        for j in range(len(q) + 1):
            if i or j:
                ways = []
                if i and j:
                    ways.append(table[i - 1, j - 1] + int(p[i - 1] @ guided.SCORES @ q[j - 1]))
                if i:
                    ways.append(table[i - 1, j] + up[i - 1])
                if j:
                    ways.append(table[i, j - 1] + left[j - 1])
                table[i, j] = max(ways)
    return int(table[-1, -1])


def total_of(p, q, own_p, own_q):
    n, m = int(p[0].sum()), int(q[0].sum())
    wide_p, wide_q = (np.zeros((len(own_p), guided.KINDS), np.int64) for _ in range(2))
    for wide, part, own, rows in ((wide_p, p, own_p, n), (wide_q, q, own_q, m)):
        wide[own] = part
        wide[~own, guided.NONE] = rows
    return int(np.einsum("ia,ab,ib->", wide_p, guided.SCORES, wide_q))


def test_profiles_are_aligned_best():
    draw = random.Random(4)
    for _ in range(60):
        parts = []
        for _ in range(2):
            rows = ["".join(draw.choices("ACGTN-", weights=[5, 5, 5, 5, 1, 2], k=draw.randint(1, 9)))]
            rows += ["".join(draw.choices("ACGT-", k=len(rows[0]))) for _ in range(draw.randint(0, 3))]
            parts.append(sum(guided.profile_of(r) for r in rows))
        own_p, own_q = guided.align_profiles(*parts)
        assert own_p.sum() == len(parts[0]) and own_q.sum() == len(parts[1]) and (own_p | own_q).all()
        assert total_of(*parts, own_p, own_q) == best_total(*parts)
    empty = guided.profile_of("")
    own_p, own_q = guided.align_profiles(empty, guided.profile_of("AC"))
    assert not own_p.any() and own_q.all()


def test_letters_along_a_profile(monkeypatch):
    draw = random.Random(6)
    texts = ["".join(draw.choices("ACGTN", k=draw.randint(0, 10))) for _ in range(40)]
    profile = sum(guided.profile_of(x) for x in ("ACGT-TGCA", "AC-TTTGCA", "GCGT-TG-A"))
    want = []
    for text in texts:
        own, mine = guided.align_profiles(profile, guided.profile_of(text))
        letters = iter(text)
        want.append("".join((x.upper() if kept else x.lower()) for kept, x in ((k, next(letters) if has else "-") for k, has in zip(own, mine, strict=True))))
    assert guided.letters_along(guided._packed(profile), texts) == want
    assert guided.letters_along(None, ["acG"]) == ["ACG"]


def plain_along(tree, cells):
    """The same bottom-up merges in plain Python, for a tree as nested pairs of labels."""
    if isinstance(tree, str):
        return [(tree, cells[tree])]
    left, right = plain_along(tree[0], cells), plain_along(tree[1], cells)
    p, q = (sum(guided.profile_of(s) for _, s in side) for side in (left, right))
    own_p, own_q = guided.align_profiles(p, q)

    def spread(sequence, own):
        letters = iter(sequence)
        return "".join(next(letters) if x else "-" for x in own)

    return [(k, spread(s, own_p)) for k, s in left] + [(k, spread(s, own_q)) for k, s in right]


def test_states_and_paths_are_small():
    text = "ACGTN-acgU"
    tip = bytes(1) + guided.letters_of(text).astype(np.uint8).tobytes()
    assert len(tip) == len(text) + 1 and (guided._state_profile(tip) == guided.profile_of(text)).all()
    for most in (1, 127, 128, 40_000, 1 << 40):
        profile = guided.profile_of(text) * most
        assert (guided._state_profile(guided._state(profile)) == profile).all()
    assert len(guided._state(guided.profile_of(text) * 127)) == 6 * len(text) + 1
    assert guided._state_profile(guided._state(guided.profile_of(""))).shape == (0, guided.KINDS)
    for n in range(20):
        own = np.arange(n) % 3 > 0
        assert (guided._path_columns(guided._path(own)) == own).all() and len(guided._path(own)) == 1 + -(-n // 8)


def test_fold_up_sends_no_nodes_to_the_driver(spark, monkeypatch):
    plans, write = [], guided.cut_lineage

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    # A comb: at every joint a tip waits for all that is below the other side.
    nodes = [("x", f"i{k}", f"i{k - 1}" if k else None, 1.0, None) for k in range(4)]
    nodes += [("x", f"t{k}", f"i{min(k, 3)}", 1.0, f"t{k}") for k in range(5)]
    nodes = spark.createDataFrame(nodes, "tree string, node string, parent string, length double, label string")
    tips = spark.createDataFrame([("x", f"t{k}", str(k).encode(), float(k)) for k in range(5)], "tree string, node string, state binary, score double")

    def merge(one, two):
        return one[0] + two[0], one[1] + two[1], one[0], two[0]

    monkeypatch.setattr(guided, "cut_lineage", watched)
    roots, kept = guided.fold_up(tips, nodes, merge, "binary")
    assert [(r["node"], sorted(bytes(r["state"]).decode()), r["score"]) for r in roots.collect()] == [("i0", list("01234"), 10.0)]
    found = {r["node"]: (r["up"], sorted(bytes(r["kept"]).decode())) for r in kept.collect()}
    assert found == {
        **{f"t{k}": (f"i{min(k, 3)}", [str(k)]) for k in range(5)},
        "i3": ("i2", list("34")), "i2": ("i1", list("234")), "i1": ("i0", list("1234"))}
    assert plans and not any("Broadcast" in p for p in plans)


def test_align_along(spark):
    draw = random.Random(9)
    base = "".join(draw.choices("ACGT", k=40))
    cells = {}
    for k in "abcdef":
        s = list(base)
        for _ in range(5):
            at = draw.randrange(len(s))
            s[at : at + draw.choice([1, 3])] = draw.choices("ACGT", k=draw.choice([0, 1, 2]))
        cells[k] = "".join(s)
    rows = [
        ("t", "r", None, None, None), ("t", "x", "r", 1.0, None), ("t", "y", "x", 1.0, None), ("t", "z", "r", 1.0, None),
        *[("t", f"n{k}", up, 1.0, k) for k, up in zip("abcdef", ["y", "y", "x", "z", "z", "z"], strict=True)],
        ("one", "n", None, None, "a"), ("gap", "g", None, None, None), ("gap", "ga", "g", 1.0, "a"), ("gap", "gb", "g", 1.0, "none"),
    ]
    nodes = spark.createDataFrame(rows, NODES)
    given = [("t", k, s) for k, s in cells.items()] + [("one", "a", "ACGT"), ("gap", "a", "AC"), ("t", "stranger", "AC")]
    found = {(r.tree, r.label): r.sequence for r in guided.align_along(
        spark.createDataFrame(given, "tree string, label string, sequence string"), nodes).collect()}
    assert found.pop(("one", "a")) == "ACGT" and found.pop(("gap", "a")) == "AC"
    assert {k: s.replace("-", "") for (_, k), s in found.items()} == cells
    assert len({len(s) for s in found.values()}) == 1
    assert all(any(s[i] != "-" for s in found.values()) for i in range(len(next(iter(found.values())))))
    two = [("p", "r", None, None, None), ("p", "m", "r", 1.0, None), ("p", "na", "m", 1.0, "a"), ("p", "nb", "m", 1.0, "b"), ("p", "nc", "r", 1.0, "c")]
    got = {r.label: r.sequence for r in guided.align_along(
        spark.createDataFrame([("p", k, cells[k]) for k in "abc"], "tree string, label string, sequence string"), spark.createDataFrame(two, NODES)).collect()}
    assert got == dict(plain_along((("a", "b"), "c"), cells))


def test_binary_keeps_tips(spark):
    rows = [("t", "r", None, None, None), *[("t", f"n{k}", "r", 1.0, f"l{k}") for k in range(7)]]
    found = guided.binary(spark.createDataFrame(rows, NODES)).collect()
    children = {}
    for r in found:
        children.setdefault(r.parent, []).append(r.node)
    assert max(len(c) for p, c in children.items() if p) == 2
    assert sorted(r.label for r in found if r.label) == [f"l{k}" for k in range(7)]
    assert len(found) == 2 * 7 - 1


def test_added_sequences_leave_columns_together(spark):
    schema = "gene string, label string, sequence string"
    front = spark.createDataFrame([("g", "a", "AC-GT"), ("g", "b", "ACCGT"), ("h", "x", "TT")], schema)
    extra = spark.createDataFrame([("g", "c", "ACGGTTA"), ("g", "d", "CG"), ("new", "y", "acgt"), ("g", "no", None)], schema)
    found = {(r.gene, r.label): r.sequence for r in guided.add_sequences(front, extra, ["gene"]).collect()}
    own = [k for k in found if k[0] == "g"]
    assert {k: found[k].replace("-", "") for k in own} == {("g", "a"): "ACGT", ("g", "b"): "ACCGT", ("g", "c"): "ACGGTTA", ("g", "d"): "CG"}
    assert len({len(found[k]) for k in own}) == 1 and found["new", "y"] == "ACGT" and found["h", "x"] == "TT"
    kept = [i for i in range(len(found["g", "a"])) if found["g", "a"][i] != "-" or found["g", "b"][i] != "-"]
    assert "".join(found["g", "a"][i] for i in kept) == "AC-GT" and "".join(found["g", "b"][i] for i in kept) == "ACCGT"
    uneven = spark.createDataFrame([("g", "a", "AC"), ("g", "b", "A")], schema)
    with pytest.raises(Exception, match="differ in width"):
        guided.profiles(uneven, ["gene"]).collect()


def test_groups_that_wait_for_each_other(spark):
    groups = spark.createDataFrame([("a", "x", 1), ("b", "x", 0), ("c", "x", 0), ("d", "x", 0), ("e", "x", 0)], "gene string, grp string, alignable int")
    needs = spark.createDataFrame(
        [("b", "x", "a", "x", 0, 9), ("c", "x", "b", "x", 0, 5), ("d", "x", "e", "x", 0, 9), ("e", "x", "d", "x", 0, 9), ("c", "x", "a", "x", 1, 4)],
        "gene string, grp string, guide string, guide_grp string, place int, shared int")
    found = {r.gene: (r.round, r.guide) for r in guided.guide_rounds(groups, needs).collect()}
    assert found == {"a": (0, None), "b": (1, "a"), "c": (2, "b"), "d": (None, None), "e": (None, None)}
