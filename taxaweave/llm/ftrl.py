"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its words, pairs of neighbours, and pairs with one word between them, each hashed to 64 bits.
A feature counts 1 / sqrt(number of taught texts that hold it), so that chance moves every feature alike and one L1
strength serves rare and common ones. Texts are dealt to batches; in a round the tasks sum the gradients of one batch per feature
under the present weights, and each coordinate then takes its own FTRL step, with a rate that falls with its own
squared gradients and a weight of zero until its sum passes the L1 strength. The intercept is fixed at the log odds of toxic texts,
so that few weights are needed to tell clean ones. The weights that are not zero are the model.

Features that can be learned are found first, by counting: those that ``LEAST`` toxic texts hold and whose first gradient
passes ``SCREEN`` of the L1 strength. The model is fitted on at most ``SAMPLE`` labelled rows, chosen by the hash of the id;
gradients are summed as whole numbers, so that the fit does not depend on the partitioning. Every text is scored whole.

Nulls and odd rows: a null text scores as an empty one (the share of toxic texts, about); null labels and labels without
a document do not teach, nor do rows without id; repeated rows teach each; labels of one kind only give that kind's share (or 0.5 without
labels) as every score; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.scan import Chunk, chunks, mix, span_hashes
from taxaweave.llm.steps import discard, written

SAMPLE = 24_000
LEAST, SCREEN = 4, 0.7
#: Batches, passes over them, and the parameters of the steps.
BATCHES, PASSES = 4, 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 1.2, 0.001
#: Bits of the sieve of features that enough toxic texts hold.
SIEVE = 1 << 22
#: Gradients are summed in units of this part.
UNIT = 1 << 30


def text_features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every feature, repeats included. Words are runs of letters, in lower case."""
    code = chunk.code
    upper = (code >= 0x41) & (code <= 0x5A) | (code >= 0xC0) & (code <= 0xDE) & (code != 0xD7)
    lower = np.where(upper, code + 0x20, code)
    letter = (lower >= 0x61) & (lower <= 0x7A) | (lower >= 0xDF) & (lower != 0xF7)
    starts, ends = chunk.spans(letter)
    words, row = span_hashes(chunk.prefix(lower), starts, ends), chunk.row_of(starts)
    rows, hashes = [row], [words]
    for gap in (1, 2):
        pair = mix(words[:-gap] * np.uint64(0xC2B2AE3D27D4EB4F) + words[gap:] + np.uint64(gap)) if len(words) > gap else words[:0]
        same = row[: len(pair)] == row[gap : gap + len(pair)]
        rows.append(row[: len(pair)][same])
        hashes.append(pair[same])
    return np.concatenate(rows), np.concatenate(hashes)


def held_once(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once a row."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


class Places:
    """Place of a hash in a sorted array; a bitmap answers most questions."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, place) of those that stand in the array."""
        at = np.flatnonzero(self.bits[(hashes >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), max(len(self.hashes) - 1, 0))
        good = self.hashes[place] == hashes[at] if len(at) else np.zeros(0, bool)
        return at[good], place[good]


@dataclass
class State:
    """Sums of gradients (z) and of their squares (n) of every coordinate. ``value``: what a feature counts where it is held."""

    value: np.ndarray
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.z, self.n = np.zeros(len(self.value)), np.zeros(len(self.value))

    def weights(self) -> np.ndarray:
        rate = (BETA + np.sqrt(self.n)) / ALPHA + L2
        return np.where(np.abs(self.z) > L1, -(self.z - np.sign(self.z) * L1) / rate, 0.0)

    def step(self, total: np.ndarray, squares: np.ndarray) -> None:
        """Take the sums over a batch of the texts' gradients, and of their squares, at the present weights."""
        w, g, s = self.weights(), total * self.value, squares * self.value**2
        sigma = (np.sqrt(self.n + s) - np.sqrt(self.n)) / ALPHA
        self.z += g - sigma * w
        self.n += s


def probabilities(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40)))


def gradients(labels: np.ndarray, offsets: np.ndarray, places: np.ndarray, points: np.ndarray, intercept: float) -> tuple[np.ndarray, np.ndarray]:
    """Sums over texts of gradients and of their squares per feature, in units of 1 / UNIT.

    ``points``: what holding a feature adds to the margin.
    """
    text = np.repeat(np.arange(len(labels)), np.diff(offsets))
    margin = intercept + np.bincount(text, weights=points[places], minlength=len(labels))
    g = np.rint((probabilities(margin) - labels) * UNIT)
    square = np.rint(g * g / UNIT)
    # Whole numbers below 2^53.
    return tuple(np.bincount(places, weights=x[text], minlength=len(points)) for x in (g, square))


@dataclass
class Model:
    """Hashes (sorted) of the features with a weight, what each adds to the margin, and the intercept."""

    hashes: np.ndarray
    points: np.ndarray
    intercept: float

    def scores(self, chunk: Chunk, places: Places) -> np.ndarray:
        rows, hashes = text_features(chunk)
        at, place = places.found(hashes)
        margin = np.full(chunk.rows, self.intercept)
        if len(at):
            one = np.unique(rows[at] * len(self.hashes) + place)
            margin += np.bincount(one // len(self.hashes), weights=self.points[one % len(self.hashes)], minlength=chunk.rows)
        return probabilities(margin)


def _taught(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(text, label, batch) of at most ``sample`` labelled rows."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("label in (0, 1) and doc_id is not null")
        .orderBy(F.xxhash64("doc_id", F.lit("toxicity")), "doc_id", "label").limit(sample)
    )
    # At most ``sample`` ids and labels: small enough to be sent to all tasks.
    return written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(written(chosen)), "doc_id")
        .select("text", "label", F.pmod(F.xxhash64("doc_id", F.lit("batch")), F.lit(BATCHES)).cast("int").alias("batch"))
    )


def _counts(sieve):
    """(feature, toxic, held): texts that hold a feature, summed within the task. ``sieve``: features to count, or all."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sieve.value, np.uint64) if sieve is not None else None
        for batch in batches:
            label = batch.column("label").to_numpy()
            for chunk in chunks(batch.column("text")):
                rows, hashes = text_features(chunk)
                if bits is not None:
                    place = hashes & np.uint64(SIEVE - 1)
                    some = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
                    rows, hashes = rows[some], hashes[some]
                rows, hashes = held_once(rows, hashes)
                keys, inverse = np.unique(hashes, return_inverse=True)
                toxic = np.bincount(inverse, weights=label[chunk.first + rows], minlength=len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array(np.bincount(inverse, minlength=len(keys)))],
                    names=["feature", "toxic", "held"],
                )

    return count


COUNTED = "feature long, toxic long, held long"


def _candidates(rows: DataFrame, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Hash (sorted) and number of taught texts of every feature that can be learned."""
    summed = lambda df: df.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("held").alias("held")).where(F.col("toxic") >= LEAST)
    often = summed(rows.where("label = 1").mapInArrow(_counts(None), COUNTED))
    place = F.col("feature").bitwiseAND(F.lit(SIEVE - 1))
    found = (
        often.select(F.shiftright(place, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(feature & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    ).toPandas()
    bits = np.zeros(SIEVE // 64, np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    sieve = rows.sparkSession.sparkContext.broadcast(bits.tobytes())
    first = F.abs(F.col("toxic") - F.col("held") * share) / F.sqrt("held")
    found = summed(rows.mapInArrow(_counts(sieve), COUNTED)).where(first > SCREEN * L1).select("feature", "held").toPandas()
    hashes = found["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["held"].to_numpy(np.float64)[order]


def _sparse(hashes: np.ndarray):
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(hashes)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                rows, features = text_features(chunk)
                at, place = places.found(features)
                one = np.unique(rows[at] * max(len(hashes), 1) + place)
                offsets = np.searchsorted(one // max(len(hashes), 1), np.arange(chunk.rows + 1))
                own = slice(chunk.first, chunk.first + chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label")[own], batch.column("batch")[own],
                     pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array((one % max(len(hashes), 1)).astype(np.int32)))],
                    names=["label", "batch", "places"],
                )

    return sparse


def _round(texts: DataFrame, points: np.ndarray, intercept: float) -> tuple[np.ndarray, np.ndarray]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = np.zeros(len(points)), np.zeros(len(points))
        for batch in batches:
            places = batch.column("places")
            offsets = np.concatenate([[0], np.cumsum(places.value_lengths().to_numpy(zero_copy_only=False))])
            one, two = gradients(batch.column("label").to_numpy(), offsets, places.flatten().to_numpy(), points, intercept)
            total += one
            squares += two
        some = np.flatnonzero(squares)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64)), pa.array(squares[some].astype(np.int64))],
            names=["place", "g", "s"],
        )

    found = (
        texts.mapInArrow(sums, "place int, g long, s long").groupBy("place").agg(F.sum("g").alias("g"), F.sum("s").alias("s"))
    ).toPandas()
    out = np.zeros((2, len(points)))
    out[:, found["place"].to_numpy(np.int64)] = found[["g", "s"]].to_numpy(np.float64).T / UNIT
    return out[0], out[1]


def learn(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of ``labels`` (doc_id and a 0/1 ``label``) with the texts of ``docs``."""
    rows = _taught(docs, labels, label, sample)
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    none = np.zeros(0)
    share = kinds.get(1, 0) / sum(kinds.values()) if kinds else 0.5
    start = math.log((share + 1e-6) / (1 - share + 1e-6))
    if len(kinds) < 2:
        return Model(none.astype(np.uint64), none, start)
    hashes, held = _candidates(rows, share)
    texts = written(rows.mapInArrow(_sparse(hashes), "label int, batch int, places array<int>"))
    discard(rows)
    state = State(1.0 / np.sqrt(held))
    for _ in range(PASSES):
        for batch in range(BATCHES):
            state.step(*_round(texts.where(F.col("batch") == batch), state.weights() * state.value, start))
    points = state.weights() * state.value
    some = np.flatnonzero(points)
    return Model(hashes[some], points[some], start)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every text."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(model.hashes)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(chunk.first, chunk.rows), pa.array(model.scores(chunk, places))], names=["doc_id", "score"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, score double")
