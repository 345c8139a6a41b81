"""Centroid clustering in whole numbers: Lloyd's rounds with the dimensions dealt to shards.

Vectors are scaled to integers and cut into row groups of at most ``GROUP`` vectors and into blocks of
columns; a shard holds one block of columns. In a round, the tasks of a shard take the exact partial squared
distances of their row groups to their slice of the centroids; ``reduceByKey`` adds the shards' blocks
of a row group and takes the nearest centroid. The assignments go back to the shards, and each
sums its own columns per cluster and moves its own slice. Only slices (clusters times dimensions) reach
the driver. Every number is an integer, so the result does not depend on the partitioning.

Nulls and odd rows: vectors that are null, of another length, or hold a null or non-finite component take no part;
repeated vectors count each; a null id is clustered as any other, but is no starting centroid unless
others are too few; of equal ids the vector that is smaller in order starts first; with fewer vectors than clusters each
vector starts one; an empty table gives an empty result. Components beyond ``LARGEST`` after
scaling are refused with an error, since a squared distance would not fit 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.steps import written

#: Vectors of a row group, and columns of a block.
GROUP, WIDTH = 4096, 16
LARGEST = 1 << 27
EXACT = 1 << 53


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), refused beyond ``LARGEST``."""
    out = np.floor(values * float(scale))
    if len(out) and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is larger than {LARGEST // scale} in absolute value")
    return out.astype(np.int64)


def _column_blocks(dims: int, scale: int):
    """Row groups of a task's vectors, each as one record a block of columns; the ids stand with the first."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            table = scaled(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
            for first in range(0, len(table), GROUP):
                rows, ids = table[first : first + GROUP].astype("<i4"), batch.column("vec_id").slice(first, GROUP)
                places = range(0, dims, WIDTH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(places), pa.int64()), pa.array(range(len(places)), pa.int32()),
                     pa.array([np.ascontiguousarray(rows[:, k : k + WIDTH]).tobytes() for k in places], pa.binary()),
                     pa.array([ids.to_pylist() if k == 0 else None for k in places], pa.list_(pa.int64()))],
                    names=["rows", "block", "data", "ids"],
                )
                number += 1

    return cut


def partial_distances(data: bytes, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of a block's rows to the same columns of the centroids, in four bytes where up to 128 blocks add up within them."""
    width = centroids.shape[1]
    x = np.frombuffer(data, "<i4").reshape(-1, width)
    top = 2 * max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if width * top * top < EXACT else np.int64
    x, c = x.astype(kind), centroids.astype(kind)
    out = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    return out.astype(np.int32 if width * top * top < 1 << 24 else np.int64)


def nearest(distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number (ties: the smaller) and distance of the nearest centroid of every row."""
    label = distances.argmin(axis=1)
    return label.astype(np.int32), distances[np.arange(len(label)), label].astype(np.int64)


def cluster_sums(data: bytes, labels: np.ndarray, clusters: int, width: int) -> np.ndarray:
    """Per cluster the sums of a block's columns, and in a last column the number of rows."""
    x = np.frombuffer(data, "<i4").reshape(-1, width)
    out = np.zeros((clusters, width + 1), np.int64)
    for k in range(width):
        # Sums of at most GROUP numbers below LARGEST are exact in doubles.
        out[:, k] = np.bincount(labels, weights=x[:, k], minlength=clusters).astype(np.int64)
    out[:, -1] = np.bincount(labels, minlength=clusters)
    return out


def moved(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """A slice after its clusters' rows are averaged (rounded down); empty clusters stay."""
    counts = sums[:, -1:]
    return np.where(counts > 0, sums[:, :-1] // np.maximum(counts, 1), centroids)


def _assigned(blocks, slices: list[np.ndarray]):
    """(rows, (labels, distances)) of every row group."""
    return (
        blocks.map(lambda r: (r["rows"], partial_distances(r["data"], slices[r["block"]])))
        .reduceByKey(np.add).mapValues(nearest)
    )


def _one_round(blocks, slices: list[np.ndarray]) -> list[np.ndarray]:
    many, clusters = len(slices), len(slices[0])
    labels = _assigned(blocks, slices).flatMap(lambda x: [((x[0], b), x[1][0]) for b in range(many)])
    own = blocks.map(lambda r: ((r["rows"], r["block"]), bytes(r["data"])))
    found = (
        own.join(labels)
        .map(lambda x: (x[0][1], cluster_sums(x[1][0], x[1][1], clusters, slices[x[0][1]].shape[1])))
        .reduceByKey(np.add).map(lambda x: (x[0], moved(slices[x[0]], x[1]))).collectAsMap()
    )
    return [found[b] for b in range(many)]


def cluster(
    vectors: DataFrame, clusters: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    The first centroids are the vectors with the smallest sha256 of ``seed:id``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    usual = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.where((F.size("vector") == dims) & usual)
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = rows.withColumn("draw", draw).orderBy(F.col("draw").asc_nulls_last(), "vector").limit(clusters).collect()
    schema = "vec_id long, cluster int, distance long"
    if start:
        centroids = scaled(np.array([r["vector"] for r in start]), scale)
        slices = [centroids[:, k : k + WIDTH] for k in range(0, dims, WIDTH)]
        table = written(rows.mapInArrow(_column_blocks(dims, scale), "rows long, block int, data binary, ids array<long>"))
        blocks = table.select("rows", "block", "data").rdd
        for _ in range(rounds):
            slices = _one_round(blocks, slices)
        labelled = spark.createDataFrame(
            _assigned(blocks, slices).map(lambda x: (x[0], x[1][0].tolist(), x[1][1].tolist())),
            "rows long, cluster array<int>, distance array<long>",
        )
        found = written(
            labelled.join(table.where("block = 0").select("rows", "ids"), "rows")
            .select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("x"))
            .select(F.col("x.ids").alias("vec_id"), F.col("x.cluster").alias("cluster"), F.col("x.distance").alias("distance"))
        )
        final = np.concatenate(slices, axis=1)
        names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final.tolist()]
    else:
        found, names = spark.createDataFrame([], schema), []
    hashes = spark.createDataFrame(list(enumerate(names)), "cluster int, centroid_sha256 string")
    # One row a cluster: sent to all tasks.
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(F.broadcast(hashes), "cluster")
    total = found.agg(F.sum("distance").alias("inertia"))
    return found.join(F.broadcast(sums), "cluster").crossJoin(F.broadcast(total)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def reference_sql(clusters: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> str:
    """The same in SQL, a few table expressions a round, over a table ``embeddings``."""
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings "
        f"WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS k, x AS c FROM "
        f"(SELECT x, sha256('{seed}:' || vec_id) AS h FROM v ORDER BY h, x LIMIT {clusters}))",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, x, min(struct_pack(d := d, k := k)) AS m FROM (SELECT vec_id, x, k, "
            f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d FROM v CROSS JOIN c{r}) GROUP BY vec_id, x)")
        if r < rounds:
            parts.append(
                f"s{r} AS MATERIALIZED (SELECT k, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM ("
                f"SELECT m.k AS k, i, CAST(sum(x[i]) AS BIGINT) AS t, count(*) AS n FROM a{r} CROSS JOIN range(1, {dims + 1}) AS g(i) GROUP BY m.k, i) GROUP BY k)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(s{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN s{r} ON s{r}.k = c{r}.k)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.vec_id, a.m.k AS "cluster", CAST(a.m.d AS BIGINT) AS distance,
  CAST(sum(a.m.d) OVER (PARTITION BY a.m.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a ON a.vec_id = v.vec_id AND a.x = v.x JOIN c{rounds} c ON c.k = a.m.k"""
