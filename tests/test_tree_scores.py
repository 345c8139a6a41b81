"""Scores of trees, placed taxa and rogue search against plain versions."""

import itertools
import math
import random

import pytest

from taxaweave.operators import rogues, tree_scores, trees

NODES = "tree string, node string, parent string, length double, label string"
CELLS = "tree string, label string, sequence string"
PLACE = {"A": 1, "C": 2, "G": 4, "T": 8}


def random_tree(draw, labels):
    """Node rows of a random binary tree, and the same as nested pairs (with the lengths of both sides)."""
    parts = [(f"n{x}", x) for x in labels]
    rows, lengths = {}, {}
    for name, label in parts:
        rows[name] = label
    number = itertools.count()
    while len(parts) > 1:
        draw.shuffle(parts)
        (a, x), (b, y) = parts.pop(), parts.pop()
        up = f"i{next(number):02d}"
        lengths[a], lengths[b] = (up, round(draw.uniform(0.01, 0.6), 3)), (up, round(draw.uniform(0.01, 0.6), 3))
        rows[up] = None
        parts.append((up, ((x, lengths[a][1]), (y, lengths[b][1]))))
    out = [(node, *(lengths.get(node, (None, None))), label) for node, label in rows.items()]
    return out, parts[0][1]


def fitch(tree, column):
    if isinstance(tree, str):
        return PLACE.get(column[tree], 15), 0
    (a, m), (b, n) = (fitch(side, column) for side, _ in tree)
    return (a & b, m + n) if a & b else (a | b, m + n + 1)


def partial(tree, column, scale):
    if isinstance(tree, str):
        mask = PLACE.get(column[tree], 15)
        return [float(mask >> k & 1) for k in range(4)]
    out = [1.0] * 4
    for side, length in tree:
        below, stay = partial(side, column, scale), math.exp(-4 * length * scale / 3)
        for k in range(4):
            out[k] *= stay * below[k] + (1 - stay) * sum(below) / 4
    return out


def made(seed, n=9, width=60):
    draw = random.Random(seed)
    labels = [f"t{k}" for k in range(n)]
    rows, nested = random_tree(draw, labels)
    cells = {x: "".join(draw.choices("ACGTN-", weights=[6, 6, 6, 6, 1, 1], k=width)) for x in labels}
    return rows, nested, cells


def columns_of(cells):
    return [{x: s[i] for x, s in cells.items()} for i in range(len(next(iter(cells.values()))))]


def tables(spark, parts):
    nodes = [(f"x{k}", *row) for k, (rows, _, _) in enumerate(parts) for row in rows]
    cells = [(f"x{k}", x, s) for k, (_, _, own) in enumerate(parts) for x, s in own.items()]
    return spark.createDataFrame(cells, CELLS), spark.createDataFrame(nodes, NODES)


def test_scores_equal_plain_versions(spark):
    parts = [made(1), made(2, 2), made(3, 14, 2100)]
    cells, nodes = tables(spark, parts)
    found = {r.tree: r.changes for r in tree_scores.parsimony(cells, nodes).collect()}
    logs = {r.tree: r.log_likelihood for r in tree_scores.likelihood(cells, nodes).collect()}
    fitted = {r.tree: (r.scale, r.log_likelihood) for r in tree_scores.fitted_likelihood(cells, nodes).collect()}
    for k, (_, nested, own) in enumerate(parts):
        assert found[f"x{k}"] == sum(fitch(nested, c)[1] for c in columns_of(own))
        plain = lambda scale: sum(math.log(sum(partial(nested, c, scale)) / 4) for c in columns_of(own))  # noqa: B023, E731
        assert logs[f"x{k}"] == pytest.approx(plain(1.0), abs=1e-6)
        scale, best = fitted[f"x{k}"]
        assert best == pytest.approx(plain(scale), abs=1e-6) and best >= max(plain(1.0), plain(scale * 1.1), plain(scale / 1.1)) - 1e-3


def test_patterns_count_all_columns(spark):
    _, _, own = made(5, 6, 3000)
    found = tree_scores.site_patterns(spark.createDataFrame([("x", k, s) for k, s in own.items()], CELLS)).first()
    kinds = {}
    for c in columns_of(own):
        key = tuple(PLACE.get(c[x], 15) for x in sorted(c))
        kinds[key] = kinds.get(key, 0) + 1
    assert sorted(found.weights) == sorted(kinds.values())


def test_placements_add_fewest_changes(spark):
    rows, nested, own = made(7, 8, 40)
    extra = {"new1": own["t3"][:30] + "A" * 10, "new2": own["t5"]}
    cells, nodes = tables(spark, [(rows, nested, own)])
    every = cells.unionByName(spark.createDataFrame([("x0", k, s) for k, s in extra.items()], CELLS))
    found = {r.label: r for r in tree_scores.placements(every, nodes).collect()}
    before = sum(fitch(nested, c)[1] for c in columns_of(own))

    def ways(tree):
        """The nested tree with a new tip above each node in turn."""
        yield ((tree, 0), ("new", 0))
        if not isinstance(tree, str):
            (a, x), (b, y) = tree
            for w in ways(a):
                yield ((w, x), (b, y))
            for w in ways(b):
                yield ((a, x), (w, y))

    for name, sequence in extra.items():
        with_new = columns_of(own | {"new": sequence})
        want = min(sum(fitch(t, c)[1] for c in with_new) for t in ways(nested)) - before
        assert found[name].added == want
    grown = tree_scores.insert_tips(nodes, tree_scores.placements(every, nodes))
    assert {r.label for r in trees.tips(grown).collect()} == set(own) | set(extra)
    one = tree_scores.insert_tips(nodes, tree_scores.placements(every.where("label <> 'new1'"), nodes))
    assert tree_scores.parsimony(every.where("label <> 'new1'"), one).first().changes == before + found["new2"].added


def newick(groups):
    return "(" + ",".join(groups) + ");"


def test_planted_rogues_come_first(spark):
    rng, rows = random.Random(3), []
    for k in range(20):
        groups = [["a1", "a2", "a3"], ["b1", "b2", "b3"], ["c1", "c2", "c3"]]
        rng.choice(groups).append("rogue")
        rows.append((f"one/{k}", newick("(" + ",".join(g) + ")" for g in groups)))
        rows.append((f"two/{k}", "((p,q),(r,s),t);"))
    nodes = trees.parse_newick(spark.createDataFrame(rows, "tree string, newick string"))
    from pyspark.sql import functions as F

    of = F.split_part("tree", F.lit("/"), F.lit(1))
    found = [(r.base, r.round, r.label) for r in rogues.rogue_taxa(nodes, of).collect()]
    assert found == [("one", 1, "rogue")]
    # Gains of all taxa against trying each.
    splits, bases, names = rogues.tree_splits(nodes, of)
    got = {(r.base, r.label): r.gain for r in names.join(rogues.tip_gains(splits, bases), ["base", "rank"]).collect()}

    def score(base, gone=None):
        counts = {}
        for name, text in rows:
            if name.split("/")[0] == base:
                sets = [set(part.strip("(),;").split(",")) - {gone} for part in text[1:-2].split("),(")] if base == "one" else [{"p", "q"} - {gone}, {"r", "s"} - {gone}]
                every = set("a1 a2 a3 b1 b2 b3 c1 c2 c3 rogue".split() if base == "one" else "pqrst") - {gone}
                for side in {min(frozenset(s), frozenset(every - s), key=lambda x: min(every) in x) for s in sets if 1 < len(s) < len(every) - 1}:
                    counts[side] = counts.get(side, 0) + 1
        return sum(n for n in counts.values() if 2 * n > 20)

    for base, taxa in (("one", "a1 a2 a3 b1 b2 b3 c1 c2 c3 rogue".split()), ("two", list("pqrst"))):
        for t in taxa:
            assert got.get((base, t), 0) == score(base, t) - score(base), (base, t)
