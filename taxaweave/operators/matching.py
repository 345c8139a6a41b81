"""Maximum-weight matching between two sides of a weighted bipartite graph.

Nodes may stand for several interchangeable units (a capacity). The graph
falls apart into connected components. A component with a bounded number of
edges is solved in one task; larger ones are solved by an auction whose every
round is a join and two aggregates over all bidders at once.
"""

from __future__ import annotations

from collections import deque
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.operators.components import connected_components
from taxaweave.session import cut_lineage

# Most edges of a component that one task solves.
EDGES_PER_TASK = 20_000
# Decimals of a weight that are told apart; weights that need more are refused.
DECIMALS = 6


def max_weight_matching(
    edges: DataFrame, capacities: tuple[DataFrame, DataFrame] | None = None,
    edges_per_task: int = EDGES_PER_TASK,
) -> DataFrame:
    """(src, dst, units): how many units of each pair are matched.

    ``edges`` has src, dst, weight, with src and dst on different sides.
    ``capacities`` are (src, n) and (dst, n); without them every node counts once.
    """
    positive = edges.where("weight > 0").groupBy("src", "dst").agg(F.max("weight").cast("double").alias("weight"))
    if capacities:
        positive = positive.join(capacities[0].withColumnRenamed("n", "n1"), "src").join(
            capacities[1].withColumnRenamed("n", "n2"), "dst"
        )
    else:
        positive = positive.withColumn("n1", F.lit(1).cast("long")).withColumn("n2", F.lit(1).cast("long"))
    positive = cut_lineage(_whole(positive).select("src", "dst", "weight", "n1", "n2"))

    left = F.struct(F.lit(0).alias("side"), F.col("src").cast("string").alias("id"))
    right = F.struct(F.lit(1).alias("side"), F.col("dst").cast("string").alias("id"))
    found = connected_components(positive.select(left.alias("src"), right.alias("dst")))
    found = found.where("node.side = 0").select(
        F.col("node.id").alias("_id"), F.to_json("component").alias("component")
    )
    labelled = positive.join(found, F.col("src").cast("string") == F.col("_id")).drop("_id")
    sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("edges"))
    labelled = cut_lineage(labelled.join(sizes, "component"))

    types = dict(positive.dtypes)
    schema = f"src {types['src']}, dst {types['dst']}, units long"
    single = labelled.where("edges = 1").select("src", "dst", F.least("n1", "n2").alias("units"))
    # Components of bounded size share a task up to the same bound; the filter
    # on the measured size is what keeps a task small.
    bounded = labelled.where((F.col("edges") > 1) & (F.col("edges") <= edges_per_task))
    tasks = 1 + 4 * bounded.count() // max(1, edges_per_task)
    small = bounded.withColumn("task", F.pmod(F.xxhash64("component"), F.lit(tasks))).groupBy("task").applyInPandas(
        _solve_all, schema
    )
    large = labelled.where(F.col("edges") > max(1, edges_per_task))
    found = single.unionByName(small)
    if large.isEmpty():
        return found
    return found.unionByName(_by_auction(large).select("src", "dst", "units"))


def _whole(edges: DataFrame) -> DataFrame:
    """``edges`` with whole-numbered weights in the finest decimal unit that any of them has.

    Sums of whole numbers are exact in every order, so all ways of solving agree
    on the total.
    """
    def unit_fits(k: int) -> Column:
        scaled = F.col("weight") * float(10**k)
        return F.max(F.abs(scaled - F.round(scaled)) > 1e-9 * F.abs(scaled)).alias(f"u{k}")

    facts = edges.agg(F.max("weight").alias("most"), *[unit_fits(k) for k in range(DECIMALS + 1)]).first()
    fit = [k for k in range(DECIMALS + 1) if not facts[f"u{k}"]]
    if not fit or (facts["most"] or 0) * 10 ** fit[0] > 2**40:
        raise ValueError(f"weights need at most {DECIMALS} decimals and must not exceed 2^40 of their unit")
    return edges.withColumn("weight", F.round(F.col("weight") * float(10 ** fit[0])).cast("long"))


def _solve_all(rows: pd.DataFrame) -> pd.DataFrame:
    """Solve the components of one task, one after the other."""
    rows = rows.sort_values(["component", "src", "dst"])
    columns = [rows[c].tolist() for c in ("component", "src", "dst", "weight", "n1", "n2")]
    flows = []
    for _, edges in groupby(zip(*columns), key=itemgetter(0)):
        flows += _solve([edge[1:] for edge in edges])
    return pd.DataFrame(flows, columns=["src", "dst", "units"]).astype({"units": "int64"})


def _solve(edges: list[tuple]) -> list[tuple]:
    """Send units along the best augmenting paths until none gains weight."""
    left = {v: i for i, v in enumerate(dict.fromkeys(e[0] for e in edges))}
    right = {v: i + len(left) for i, v in enumerate(dict.fromkeys(e[1] for e in edges))}
    free = {left[e[0]]: e[3] for e in edges}
    free.update({right[e[1]]: e[4] for e in edges})
    ahead: dict[int, dict[int, int]] = {i: {} for i in left.values()}
    back: dict[int, dict[int, int]] = {j: {} for j in right.values()}
    for s, t, w, _, _ in edges:
        ahead[left[s]][right[t]] = w
    while True:
        gain = {i: 0 for i in ahead if free[i] > 0}
        came: dict[int, int] = {}
        queue, queued = deque(gain), set(gain)
        while queue:
            node = queue.popleft()
            queued.discard(node)
            if node in ahead:
                steps = ((j, w) for j, w in ahead[node].items())
            else:
                steps = ((i, -ahead[i][node]) for i, n in back[node].items() if n > 0)
            for other, weight in steps:
                value = gain[node] + weight
                if value > gain.get(other, float("-inf")):
                    gain[other], came[other] = value, node
                    if other not in queued:
                        queue.append(other)
                        queued.add(other)
        best = max(((gain[j], -j) for j in back if j in gain and free[j] > 0), default=(0, 0))
        if best[0] <= 0:
            break
        end = -best[1]
        path = [end]
        while path[-1] in came:
            path.append(came[path[-1]])
        path.reverse()
        amount = min(free[path[0]], free[end])
        for a, b in zip(path, path[1:]):
            if a in back:
                amount = min(amount, back[a][b])
        for a, b in zip(path, path[1:]):
            if a in ahead:
                back[b][a] = back[b].get(a, 0) + amount
            else:
                back[a][b] -= amount
        free[path[0]] -= amount
        free[end] -= amount
    names = {i: v for v, i in left.items()}
    others = {j: v for v, j in right.items()}
    return [(names[i], others[j], n) for j, m in back.items() for i, n in m.items() if n > 0]


def _by_auction(edges: DataFrame) -> DataFrame:
    """Exact matching by an auction with shrinking bid steps.

    The graph is doubled so that everyone finds a partner: each node may also
    take its own mirror image for nothing. Prices carry over between phases;
    the last step is below one unit over the number of nodes, which makes the
    outcome optimal for whole weights.
    """
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n1")))
    units = edges.select("src", "dst", "weight", "n2", copies.alias("i")).select(
        "src", "dst", "weight", "i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n2"))).alias("j")
    )

    def node(side, name, number):
        return F.struct(F.lit(side).alias("side"), F.col(name).cast("string").alias("id"), F.col(number).alias("u"))

    whole = units.select(
        node(0, "src", "i").alias("t"), node(1, "dst", "j").alias("c"), F.col("weight").alias("w")
    )
    nodes = whole.select(F.col("t").alias("v")).union(whole.select(F.col("c").alias("v"))).distinct()
    count = nodes.count()
    doubled = (
        whole.select(F.struct(F.lit(0).alias("m"), F.col("t").alias("v")).alias("b"),
                     F.struct(F.lit(0).alias("m"), F.col("c").alias("v")).alias("o"), "w")
        .union(whole.select(F.struct(F.lit(1).alias("m"), F.col("c").alias("v")).alias("b"),
                            F.struct(F.lit(1).alias("m"), F.col("t").alias("v")).alias("o"), "w"))
        .union(nodes.select(
            F.struct(F.when(F.col("v.side") == 0, F.lit(0)).otherwise(F.lit(1)).alias("m"), F.col("v")).alias("b"),
            F.struct(F.when(F.col("v.side") == 0, F.lit(1)).otherwise(F.lit(0)).alias("m"), F.col("v")).alias("o"),
            F.lit(0).cast("long").alias("w"),
        ))
    )
    scaled = cut_lineage(doubled.withColumn("w", F.col("w") * F.lit(2 * count + 1)))
    bidders = cut_lineage(scaled.select("b").distinct())
    prices = cut_lineage(scaled.select("o").distinct().withColumn("p", F.lit(0).cast("long")))
    step = max(1, (scaled.agg(F.max("w")).first()[0] or 1) // 4)
    while True:
        owned = None
        waiting = bidders
        while not waiting.isEmpty():
            offers = scaled.join(waiting, "b", "left_semi").join(prices, "o").select(
                "b", "o", "p", (F.col("w") - F.col("p")).alias("v")
            )
            best = offers.groupBy("b").agg(F.max(F.struct("v", "o", "p")).alias("x"))
            rest = offers.join(best, "b").where("o <> x.o").groupBy("b").agg(F.max("v").alias("v2"))
            bids = best.join(rest, "b", "left").select(
                F.col("x.o").alias("o"), "b",
                (F.col("x.p") + F.col("x.v") - F.coalesce("v2", F.col("x.v")) + F.lit(step)).alias("bid"),
            )
            won = cut_lineage(bids.groupBy("o").agg(F.max(F.struct("bid", "b")).alias("y")).select("o", "y.bid", "y.b"))
            prices = cut_lineage(prices.join(won.select("o", "bid"), "o", "left").select("o", F.coalesce("bid", "p").alias("p")))
            mine = won.select("o", "b")
            owned = cut_lineage(
                mine if owned is None else owned.join(mine.select("o"), "o", "left_anti").unionByName(mine)
            )
            waiting = cut_lineage(bidders.join(owned.select("b"), "b", "left_anti"))
        if step == 1:
            break
        step = max(1, step // 8)
    pairs = owned.where("b.m = 0 AND o.m = 0 AND b.v.side = 0 AND o.v.side = 1").select(
        F.col("b.v.id").alias("_s"), F.col("o.v.id").alias("_d")
    ).groupBy("_s", "_d").agg(F.count(F.lit(1)).alias("units"))
    return edges.select("src", "dst").join(
        pairs, (F.col("src").cast("string") == F.col("_s")) & (F.col("dst").cast("string") == F.col("_d"))
    )


def dual_prices(
    edges: DataFrame, flows: DataFrame, capacities: tuple[DataFrame, DataFrame] | None = None, rounds: int = 10_000,
) -> tuple[DataFrame, DataFrame]:
    """Prices ((src, n, price), (dst, n, price)) that prove a matching to be of greatest weight.

    ``flows`` are the units of :func:`max_weight_matching`. No price is below zero, the prices at the ends of an edge are together no less than
    its weight, and the prices of all units add up to the weight that is matched, so that nothing can match more.
    They are the longest ways through what the matching leaves open, found by joins and maxima in rounds; a
    matching that can be bettered has no end of them and is refused.
    """
    plain = edges.where("weight > 0").groupBy("src", "dst").agg(F.max("weight").cast("double").alias("weight"))
    whole = cut_lineage(_whole(plain).join(flows.select("src", "dst", "units"), ["src", "dst"], "left").withColumn("units", F.coalesce("units", F.lit(0))))
    unit = plain.join(whole.select("src", "dst", F.col("weight").alias("w")), ["src", "dst"]).agg(F.max(F.col("w") / F.col("weight"))).first()[0] or 1.0

    def side(name, given):
        used = whole.groupBy(name).agg(F.sum("units").alias("used"))
        sized = used.withColumn("n", F.lit(1).cast("long")) if given is None else used.join(given, name)
        return sized.select(name, F.col("n").cast("long").alias("n"), "used")

    left = side("src", capacities and capacities[0]).withColumn("p", F.when(F.col("used") < F.col("n"), F.lit(0).cast("long")))
    right = side("dst", capacities and capacities[1]).withColumn("q", F.when(F.col("used") > 0, F.lit(0).cast("long")))
    left, right = cut_lineage(left), cut_lineage(right)
    for _ in range(rounds):
        ahead = whole.join(left.where("p IS NOT NULL").select("src", "p"), "src").groupBy("dst").agg(F.max(F.col("p") + F.col("weight")).alias("_q"))
        after = cut_lineage(right.join(ahead, "dst", "left").withColumn("q", F.greatest("q", "_q")).drop("_q"))
        back = whole.where("units > 0").join(after.where("q IS NOT NULL").select("dst", "q"), "dst").groupBy("src").agg(F.max(F.col("q") - F.col("weight")).alias("_p"))
        before = cut_lineage(left.join(back, "src", "left").withColumn("p", F.greatest("p", "_p")).drop("_p"))
        if not before.where("used < n AND p > 0").isEmpty() or not after.where("used < n AND q > 0").isEmpty():
            raise ValueError("the matching is not of greatest weight")
        same = before.join(left.select("src", F.col("p").alias("_p")), "src").where("NOT p <=> _p").isEmpty()
        left, right = before, after
        if same:
            break
    return (
        left.select("src", "n", (-F.col("p") / unit).alias("price")),
        right.select("dst", "n", (F.greatest(F.coalesce("q", F.lit(0)), F.lit(0)) / unit).alias("price")),
    )
