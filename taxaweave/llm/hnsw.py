"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are one point. Points are dealt to shards by hash; a task builds the graph of its shard as flat
neighbour arrays, one per layer, and searches it for all queries, a batch at a time;
the shards' results are merged and scored anew in double precision on the original vectors.
The graph works on vectors that a further component brings to one length, so that the largest inner
product is the nearest point.

Nulls and odd rows: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do those of another length than most; ties go to the smaller vec_id; repeated rows of
one vec_id count once, and of different vectors under one vec_id the smallest in order counts; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaweave.llm.steps import written

NEIGHBOURS, BUILD_WIDTH, SEARCH_WIDTH = 16, 96, 160
#: Points of a shard at most (about), shards at least.
SHARD_POINTS, LEAST_SHARDS = 50_000, 8
BATCH = 256


@dataclass
class Graph:
    """Neighbours of every layer as one array: ``layers[l][point]`` holds their numbers, -1 where there are none."""

    vectors: np.ndarray
    layers: list[np.ndarray]
    entry: int

    def beam(self, queries: np.ndarray, starts: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` best found of each query (numbers and products, best first), all queries in step.

        Every round expands each query's best point that is not expanded; a query is done
        when all of its points are.
        """
        links, vectors, b = self.layers[layer], self.vectors, len(queries)
        ids = np.full((b, width), -1, np.int64)
        near = np.full((b, width), -np.inf, np.float32)
        open_ = np.zeros((b, width), bool)
        seen = np.zeros((b, len(vectors)), bool)
        k = starts.shape[1]
        ids[:, :k], open_[:, :k] = starts, starts >= 0
        near[:, :k] = np.where(starts >= 0, np.einsum("bd,bkd->bk", queries, vectors[starts]), -np.inf)
        np.put_along_axis(seen, np.maximum(starts, 0), True, axis=1)
        live = np.arange(b)
        while len(live):
            best = np.where(open_[live], near[live], -np.inf)
            at = best.argmax(axis=1)
            going = best[np.arange(len(live)), at] > -np.inf
            live, at = live[going], at[going]
            if not len(live):
                break
            open_[live, at] = False
            around = links[ids[live, at]]
            fresh = (around >= 0) & ~seen[live[:, None], around]
            seen[live[:, None], np.where(around >= 0, around, ids[live, at][:, None])] = True
            products = np.einsum("bd,bkd->bk", queries[live], vectors[around])
            products[~fresh] = -np.inf
            all_near = np.concatenate([near[live], products], axis=1)
            all_ids = np.concatenate([ids[live], around], axis=1)
            all_open = np.concatenate([open_[live], fresh], axis=1)
            top = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            near[live] = np.take_along_axis(all_near, top, axis=1)
            ids[live] = np.take_along_axis(all_ids, top, axis=1)
            open_[live] = np.take_along_axis(all_open, top, axis=1) & (near[live] > -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        ids = np.where(near > -np.inf, ids, -1)
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)

    def descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """Starts of every query in layer ``to``: the best point met on the way down from the top."""
        starts = np.full((len(queries), 1), self.entry, np.int64)
        for layer in range(len(self.layers) - 1, to, -1):
            starts = self.beam(queries, starts, layer, 4)[0][:, :1]
        return starts

    def search(self, queries: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        ids, near = self.beam(queries, self.descend(queries, 0), 0, max(k, width))
        return ids[:, :k], near[:, :k]


def _spread_choice(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, m: int) -> np.ndarray:
    """Of each row's candidates (best first) up to ``m`` that are nearer to the row than to those chosen before; then the rest by nearness."""
    b, c = ids.shape
    ok = ids >= 0
    points = vectors[np.maximum(ids, 0)]
    between = np.einsum("bcd,bed->bce", points, points)
    chosen = np.zeros((b, c), bool)
    for k in range(c):
        closest = np.where(chosen, between[:, k, :], -np.inf).max(axis=1)
        chosen[:, k] = ok[:, k] & (near[:, k] > closest) & (chosen.sum(axis=1) < m)
    rank = np.where(chosen, 0, np.where(ok, 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, axis=1)[:, :m]
    out = np.take_along_axis(np.where(ok, ids, -1), order, axis=1)
    return out if out.shape[1] == m else np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)


def build(vectors: np.ndarray, seed: int = 1, m: int = NEIGHBOURS, width: int = BUILD_WIDTH) -> Graph:
    """Insert the points batch by batch; a batch also sees its own points."""
    n = len(vectors)
    levels = np.minimum((-np.log(1 - np.random.default_rng(seed).random(n)) / math.log(m)).astype(np.int64), 8)
    order = np.argsort(-levels, kind="stable")  # higher points first: every layer is there when it is needed
    top = int(levels.max())
    layers = [np.full((n, 2 * m if layer == 0 else m), -1, np.int64) for layer in range(top + 1)]
    graph = Graph(vectors, layers, int(order[0]))
    done, size = 1, 1
    while done < n:
        batch = order[done : done + size]
        batch = batch[levels[batch] == levels[batch[0]]]
        own, level = vectors[batch], int(levels[batch[0]])
        starts = graph.descend(own, level)
        among = own @ own.T
        np.fill_diagonal(among, -np.inf)
        for layer in range(level, -1, -1):
            ids, near = graph.beam(own, starts, layer, width)
            starts = ids[:, :1]
            peers = np.argsort(-among, axis=1)[:, : min(width // 2, len(batch) - 1)]
            both_ids = np.concatenate([ids, batch[peers]], axis=1)
            both_near = np.concatenate([near, np.take_along_axis(among, peers, axis=1)], axis=1)
            best = np.argsort(-both_near, axis=1, kind="stable")[:, :64]
            links = _spread_choice(vectors, np.take_along_axis(both_ids, best, axis=1), np.take_along_axis(both_near, best, axis=1), m)
            layers[layer][batch, :m] = links
            _link_back(vectors, layers[layer], batch, links)
        done += len(batch)
        size = min(BATCH, max(1, done // 4))
    return graph


def _link_back(vectors: np.ndarray, table: np.ndarray, batch: np.ndarray, links: np.ndarray) -> None:
    """Let the chosen neighbours know; those with too many choose anew."""
    source, target = np.repeat(batch, links.shape[1]), links.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    points, first, count = np.unique(target, return_index=True, return_counts=True)
    room = table.shape[1]
    widest = room + int(count.max()) if len(count) else room
    new = np.full((len(points), widest), -1, np.int64)
    new[:, :room] = table[points]
    row = np.repeat(np.arange(len(points)), count)
    new[row, room + np.arange(len(target)) - np.repeat(first, count)] = source
    near = np.einsum("bd,bkd->bk", vectors[points], vectors[np.maximum(new, 0)])
    # A link there already is no second one.
    same = np.sort(np.where(new >= 0, new, -1), axis=1)
    repeated = ((same[:, 1:] == same[:, :-1]) & (same[:, 1:] >= 0)).any(axis=1)
    for r in np.flatnonzero(repeated):
        _, keep = np.unique(new[r], return_index=True)
        gone = np.setdiff1d(np.arange(widest), keep)
        new[r, gone] = -1
    near[new < 0] = -np.inf
    full = (new >= 0).sum(axis=1) > room
    order = np.argsort(-near, axis=1, kind="stable")
    new, near = np.take_along_axis(new, order, axis=1), np.take_along_axis(near, order, axis=1)
    table[points[~full]] = new[~full][:, :room]
    over = np.flatnonzero(full)
    for k in range(0, len(over), BATCH):
        part = over[k : k + BATCH]
        table[points[part]] = _spread_choice(vectors, new[part], near[part], room)


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    fine = (
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["dims"] if sizes else 0))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, width: int = SEARCH_WIDTH) -> DataFrame:
    """The ``k`` nearest found of every row whose id is divisible by ``every``, itself left out."""
    spark = vectors.sparkSession
    # Of equal vectors, k + 1 ids are all that a list of k can show besides the query itself.
    ranked = F.row_number().over(Window.partitionBy("point").orderBy("vec_id"))
    rows = written(valid(vectors).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("point", F.xxhash64("v")))
    members = written(rows.withColumn("n", ranked).where(F.col("n") <= k + 1))
    points = members.where("n = 1").select("point", "v")
    facts = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("most")).collect()[0]
    shards, longest = max(LEAST_SHARDS, math.ceil(facts["n"] / SHARD_POINTS)), float(facts["most"] or 0.0)
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    # Points of a shard stand together, after them the queries, in batches, once for each shard.
    laid = points.select(
        F.pmod(F.hash("point", F.lit("shard")), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), F.col("point").alias("id"), "v"
    ).unionByName(
        queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), F.col("query_id").alias("id"), F.col("q").alias("v"))
    ).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "kind", "id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, kept, names, graph = None, [], [], None
        for batch in batches:
            own = batch.column("shard").to_numpy()
            kind, ids = batch.column("kind").to_numpy(), batch.column("id").to_numpy()
            flat = batch.column("v").flatten().to_numpy()
            table = flat.reshape(len(ids), -1)
            cuts = np.flatnonzero((np.diff(own) != 0) | (np.diff(kind) != 0)) + 1
            for part in np.split(np.arange(len(ids)), cuts):
                if own[part[0]] != shard:
                    shard, kept, names, graph = own[part[0]], [], [], None
                if kind[part[0]] == 0:
                    kept.append(table[part])
                    names.append(ids[part])
                    continue
                if not kept:
                    continue
                if graph is None:
                    plain = np.concatenate(kept)
                    rest = np.sqrt(np.maximum(longest - (plain * plain).sum(axis=1), 0.0))
                    scale = 1 / math.sqrt(longest)
                    graph = build((np.column_stack([plain, rest]) * scale).astype(np.float32))
                    named, kept = np.concatenate(names), [plain[:1]]
                for k in range(0, len(part), BATCH):
                    some = part[k : k + BATCH]
                    q = np.column_stack([table[some], np.zeros(len(some))])
                    q = (q / np.linalg.norm(q, axis=1, keepdims=True)).astype(np.float32)
                    found, _ = graph.search(q, min(k_wanted, len(named)), width)
                    who, what = np.repeat(ids[some], found.shape[1]), found.ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(who[what >= 0]), pa.array(named[what[what >= 0]])], names=["query_id", "point"]
                    )

    k_wanted = k + 1
    found = laid.mapInArrow(search, "query_id long, point long").distinct()
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = (
        found.join(queries, "query_id").join(members.select("point", "vec_id", "v"), "point").where("query_id <> vec_id")
        .select("query_id", "vec_id", product.alias("score"))
    )
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
