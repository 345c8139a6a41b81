"""Mixing to target weights: soft membership of domains, and document rates by projected gradients.

A classifier learned from a labelled table gives every document a posterior over domains. Each
document gets a rate r >= 0, its expected number of copies, so that the expected tokens
of every domain, the sum of r * tokens * posterior, are the wanted shares of all tokens.
The least-squares misfit of the totals (in the metric of the domains' own Gram matrix) is driven
down by projected gradient steps from r = 1. A document's steps depend on its posterior and the few
misfits so far only, so every task replays them from the misfits, and a round moves one small vector per task.

Tokens are words. The classifier is a softmax over statistics of the form and over the words that tell the
domains apart best; it is fitted on at most ``SAMPLE`` labelled rows.

Nulls and odd rows: a null text has no tokens, and a posterior as an empty one; without any tokens all rates are 1; labels that are null do not teach;
labelled rows of fewer than two domains give every document that domain (or the first) with certainty; a domain that no document
belongs to, or that no labelled row names (its posterior is 0), cannot be reached: its target stays a misfit, while the others reach
theirs; repeated rows get equal rates; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.scan import chunks
from taxaweave.llm.steps import written
from taxaweave.llm.text_statistics import NAMES, chunk_statistics

#: Labelled rows that the classifier is fitted on (at most), chosen by the hash of the id.
SAMPLE = 12_000
#: Buckets that words are hashed to, and how many of them the classifier reads.
BUCKETS, READ = 1 << 16, 128
ROUNDS, STEP, ENOUGH = 40, 0.9, 1e-7


@dataclass
class Classifier:
    """Softmax weights over scaled statistics and the presence of telling words."""

    domains: list[str]
    column: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def posteriors(self, features: np.ndarray) -> np.ndarray:
        if len(self.domains) == 1 or not self.weights.size:
            return np.eye(len(self.domains))[np.zeros(len(features), int)]
        z = np.column_stack([(features - self.mean) / self.scale, np.ones(len(features))]) @ self.weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _features(chunk, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and presence of the telling words of every row, and its words."""
    table, rows, hashes, n_words = chunk_statistics(chunk)
    at = column[(hashes >> np.uint64(48)).astype(np.int64)]
    presence = np.zeros((chunk.rows, int(column.max()) + 1))
    presence[rows[at >= 0], at[at >= 0]] = 1
    return np.column_stack([table, presence]), n_words


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each domain that hold a bucket, summed within the task."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        domain = np.array(batch.column("domain").to_pylist(), object)
        for chunk in chunks(batch.column("text")):
            _, rows, hashes, _ = chunk_statistics(chunk)
            own = np.unique(rows * BUCKETS + (hashes >> np.uint64(48)).astype(np.int64))
            names = domain[chunk.first : chunk.first + chunk.rows]
            for name in set(names):
                held = own[names[own // BUCKETS] == name] % BUCKETS
                counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                counts[name] += np.bincount(held, minlength=BUCKETS)
    for name, table in counts.items():
        some = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(table[some])], names=["domain", "bucket", "n"]
        )


def _softmax_fit(x: np.ndarray, y: np.ndarray, k: int, rounds: int = 300, penalty: float = 1e-3) -> np.ndarray:
    """Weights (last row: intercepts) by accelerated gradient descent."""
    x = np.column_stack([x, np.ones(len(x))])
    step = 4 / (np.linalg.eigvalsh(x.T @ x / len(x)).max() + penalty)
    target = np.eye(k)[y]
    w = v = np.zeros((x.shape[1], k))
    for t in range(rounds):
        z = x @ v
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = x.T @ (z / z.sum(axis=1, keepdims=True) - target) / len(x) + penalty * v
        new = v - 0.5 * step * g
        v, w = new + t / (t + 3) * (new - w), new
    return w


def learn(docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str], sample: int = SAMPLE) -> Classifier:
    """Fit the classifier of ``domain`` (an expression over ``labels``) on at most ``sample`` labelled rows."""
    none = np.full(BUCKETS, -1, np.int64)
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain")).where("domain is not null and doc_id is not null")
        .orderBy(F.xxhash64("doc_id", F.lit("mixing")), "doc_id", "domain").limit(sample)
    )
    # At most ``sample`` rows of an id and a domain: small enough to be sent to all tasks.
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(written(chosen)), "doc_id").select("text", "domain"))
    names = sorted(r["domain"] for r in rows.select("domain").distinct().collect())
    order = [d for d in domains if d in names]
    if len(order) < 2:
        return Classifier(domains, none, np.zeros(0), np.zeros(0), np.zeros((0, 0))) if not order else Classifier(
            [order[0], *[d for d in domains if d != order[0]]], none, np.zeros(0), np.zeros(0), np.zeros((0, 0)))
    sums = rows.mapInArrow(_bucket_counts, "domain string, bucket long, n long").groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toPandas()
    totals = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = np.zeros((len(order), BUCKETS))
    for k, name in enumerate(order):
        own = sums[sums["domain"] == name]
        held[k, own["bucket"].to_numpy(np.int64)] = own["n"].to_numpy(np.float64)
    column = none.copy()
    for place, bucket in enumerate(telling(held, np.array([totals[n] for n in order], float), READ)):
        column[bucket] = place

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                table, _ = _features(chunk, column)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("domain").slice(chunk.first, chunk.rows), pa.array(list(table.astype(np.float32)), pa.list_(pa.float32()))],
                    names=["domain", "x"],
                )

    taught = rows.mapInArrow(features, "domain string, x array<float>").toPandas()
    x = np.stack(taught["x"].to_numpy()).astype(np.float64)
    y = taught["domain"].map({n: k for k, n in enumerate(order)}).to_numpy()
    sort = np.lexsort((*x.T[:4], y))  # the order of rows changes sums in their last digits
    x, y = x[sort], y[sort]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    presence = np.arange(x.shape[1]) >= len(NAMES)
    mean, scale = np.where(presence, 0.0, mean), np.where(presence, 1.0, scale)
    return Classifier(order, column, mean, scale, _softmax_fit((x - mean) / scale, y, len(order)))


def telling(held: np.ndarray, totals: np.ndarray, most: int) -> np.ndarray:
    """Buckets whose presence says most about the domain (mutual information), the best first."""
    n = totals.sum()
    value = np.zeros(held.shape[1])
    for part in (held, totals[:, None] - held):
        share = part.sum(axis=0, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            value += np.where(part > 0, part / n * np.log(part * n / (share * totals[:, None])), 0).sum(axis=0)
    value = np.round(value, 9)
    best = np.argsort(-value, kind="stable")[:most]
    return best[value[best] > 0]


def posteriors(docs: DataFrame, classifier: Classifier, *more: str) -> DataFrame:
    """``doc_id``, ``tokens`` and ``posterior`` (in the order of the classifier's domains) of every document, and its columns ``more``."""
    names = ["doc_id", *more]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                table, n_words = _features(chunk, classifier.column)
                p = classifier.posteriors(table)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(chunk.first, chunk.rows) for c in names), pa.array(n_words), pa.array(list(p), pa.list_(pa.float64()))],
                    names=[*names, "tokens", "posterior"],
                )

    types = dict(rows.dtypes)
    return rows.mapInArrow(scan, ", ".join(f"{c} {types[c]}" for c in names) + ", tokens long, posterior array<double>")


def _table(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("posterior").flatten().to_numpy().reshape(batch.num_rows, -1)


def replay(p: np.ndarray, moves: list[np.ndarray]) -> np.ndarray:
    """Rates after the steps so far: each subtracts its product with the posterior and stays at 0 or above."""
    r = np.ones(len(p))
    for move in moves:
        r = np.maximum(r - p @ move, 0.0)
    return r


def rates(members: DataFrame, targets: np.ndarray) -> tuple[DataFrame, list[np.ndarray]]:
    """``members`` with ``rate``, and the expected share of every domain after each round.

    ``targets``: wanted tokens of each domain as shares of all tokens there are.
    """
    k = len(targets)

    def totals(moves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(k * k + k + 1)
            for batch in batches:
                p, w = _table(batch), batch.column("tokens").to_numpy().astype(np.float64)
                live = replay(p, moves)
                out[:k] += (w * live) @ p
                out[k : k + k * k] += ((p * (w * (live > 0))[:, None]).T @ p).ravel()
                out[-1] += w.sum()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int32()), pa.array(out)], names=["place", "value"])

        found = {r["place"]: r["value"] for r in members.mapInArrow(sums, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()}
        out = np.array([found.get(j, 0.0) for j in range(k * k + k + 1)]) / max(found.get(k * k + k, 0.0), 1.0)
        return out[:k], out[k:-1].reshape(k, k)

    moves: list[np.ndarray] = []
    history = []
    for _ in range(ROUNDS):
        got, gram = totals(moves)
        history.append(got)
        misfit = got - targets
        if np.abs(misfit).max() < ENOUGH or not got.any():  # without tokens nothing can be reached: rates stay at 1
            break
        moves.append(STEP * np.linalg.pinv(gram + 1e-9 * np.eye(k), rcond=1e-6) @ misfit)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(replay(_table(batch), moves))], names=[*batch.schema.names, "rate"]
            )

    schema = ", ".join(f"{name} {kind}" for name, kind in members.dtypes)
    return members.mapInArrow(final, f"{schema}, rate double"), history


def mix(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], key: Column | None = None) -> DataFrame:
    """(doc_id, tokens, a posterior ``p_`` of every target, rate, copies) of every document.

    ``copies`` is the rate rounded up or down by a hash of the id, so that its expectation is the rate.
    With ``key``, a number per document, the result has it as ``row_key``.
    """
    classifier = learn(docs, labels, domain, list(targets))
    order = classifier.domains
    more = [] if key is None else ["row_key"]
    found = written(posteriors(docs if key is None else docs.select("doc_id", key.alias("row_key"), "text"), classifier, *more))
    total = sum(targets.values())
    rated, _ = rates(found, np.array([targets[d] / total for d in order]))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    shown = F.map_from_arrays(F.array(*[F.lit(d) for d in order]), F.col("posterior"))
    return rated.select(
        "doc_id", *more, "tokens", *[F.coalesce(F.try_element_at(shown, F.lit(d)), F.lit(0.0)).alias(f"p_{d}") for d in targets], "rate",
        F.floor(F.col("rate") + draw).cast("int").alias("copies"),
    )
