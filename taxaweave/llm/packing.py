"""Best-fit packing by minimum bin slack, on the counts of lengths.

Only lengths matter for a packing, so it is made on the histogram of piece
lengths: at most ``width`` counts, however large the corpus. For each bin the longest piece left is taken,
and a bitset of reachable sums over the lengths that are left finds the fullest bin
with it; that combination is removed as often as the counts allow at once. Pieces are then numbered within
their length by counts per part of a written table, and a number tells the bin and the place in it.

Nulls and odd rows: a null text is empty and takes one token (the separator);
repeated rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaweave.llm.pretokens import pieces
from taxaweave.llm.scan import Chunk, chunks, span_hashes, worker_cache
from taxaweave.llm.steps import written
from taxaweave.llm.token_counts import byte_letters

WIDTH = 2048
SEPARATOR = 0
#: Pieces of text a worker remembers the identifiers of, and identifiers in all of them.
REMEMBERED = 2_000_000


class Encoder:
    """Identifiers of texts by the vocabulary's library, each different piece of text encoded once."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content: k for k, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.forget()

    def forget(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lengths, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        spell, tokenize = self.letters.__getitem__, self.model.tokenize
        found = [[t.id for t in tokenize("".join(map(spell, w.encode("utf-8", "replace"))))] for w in words]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for x in found for i in x), np.uint32, int(lengths.sum()))
        if len(self.keys) + len(keys) > REMEMBERED or len(self.ids) + len(ids) > 4 * REMEMBERED:
            self.forget()
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at = np.insert(self.keys, place, keys), np.insert(self.at, place, starts)
        self.lengths, self.ids = np.insert(self.lengths, place, lengths), np.append(self.ids, ids)

    def chunk(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of a chunk's rows one after another, and the bounds of the rows."""
        starts, ends = pieces(chunk)
        distinct, first, inverse = np.unique(
            span_hashes(chunk.prefix(), starts, ends), return_index=True, return_inverse=True
        )
        place = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[place] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(new):
            code = chunk.code
            words = [code[starts[i] : ends[i]].tobytes().decode("utf-32-le", "replace") for i in first[new].tolist()]
            before = len(self.keys)
            self._learn(distinct[new], words)
            if len(self.keys) < before + len(new):  # forgotten: learn the rest of this chunk again
                return self.chunk(chunk)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(chunk.rows + 1, np.int64)
        at = np.searchsorted(self.keys, distinct)[inverse]
        lengths = self.lengths[at]
        out_ends = np.cumsum(lengths)
        source = np.repeat(self.at[at] - (out_ends - lengths), lengths) + np.arange(out_ends[-1])
        bounds = np.concatenate([[0], out_ends])[np.searchsorted(starts, chunk.bounds)]
        return self.ids[source], bounds

    def text(self, text: str) -> np.ndarray:
        """Identifiers of a text that holds special strings."""
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(path: str) -> Encoder:
    cache = worker_cache()
    if getattr(cache, "encoder_path", None) != path:
        cache.encoder, cache.encoder_path = Encoder(path), path
    return cache.encoder


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def text_pieces(docs: DataFrame, vocabulary: str, width: int = WIDTH) -> DataFrame:
    """Tokenised pieces of at most ``width`` (a separator ends each document), numbered within part and length.

    Only documents longer than ``width`` are cut; their first piece takes what the full ones leave.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, coder = TaskContext.get().partitionId(), encoder(vocabulary)
        seen = np.zeros(width + 1, np.int64)
        for batch in batches:
            column = batch.column("text").fill_null("")
            odd = np.zeros(len(column), bool)
            for special in coder.special:
                odd |= pc.match_substring(column, special).to_numpy(zero_copy_only=False)
            doc_ids = batch.column("doc_id").to_pylist()
            for chunk in chunks(column):
                ids, bounds = coder.chunk(chunk)
                out: list[tuple] = []
                for row in range(chunk.rows):
                    at = chunk.first + row
                    own = coder.text(column[at].as_py()) if odd[at] else ids[bounds[row] : bounds[row + 1]]
                    own = np.append(own, np.uint32(SEPARATOR)).astype("<u4", copy=False)
                    n, head = len(own), len(own) % width or min(len(own), width)
                    for piece, start in enumerate((0, *range(head, n, width))):
                        length = head if piece == 0 else width
                        out.append((doc_ids[at], piece, start, length, zlib.crc32(own[start : start + length].tobytes()), seen[length]))
                        seen[length] += 1
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array([part] * len(out), pa.int32())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "number", "part"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, PIECE + ", number long, part int"
    )


def fullest(counts: dict[int, int], lengths: list[int], width: int) -> list[tuple[int, int]]:
    """The longest length left with those others that fill ``width`` best, as (length, how often).

    ``lengths``: those with a count, longest first. One bitset per length tells the sums
    that it and the longer ones can make.
    """
    seed = lengths[0]
    room = width - seed
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        left = min(counts[length] - (length == seed), room // length)
        before, power = reach, 1
        while left > 0:  # take 1, 2, 4 ... of them: every number up to what is left
            take = min(power, left)
            reach |= (reach << (take * length)) & full
            left, power = left - take, power * 2
        if reach != before:
            steps.append((length, before))
        if reach >> room & 1:
            break
    target = reach.bit_length() - 1
    chosen = {seed: 1}
    for length, before in reversed(steps):
        n = 0
        while not before >> target & 1:
            target, n = target - length, n + 1
        if n:
            chosen[length] = chosen.get(length, 0) + n
    return sorted(chosen.items(), reverse=True)


def plan(counts: dict[int, int], width: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """All bins as (how many alike, their content)."""
    left = {n: k for n, k in counts.items() if k > 0}
    lengths = sorted(left, reverse=True)
    bins = []
    while lengths:
        content = fullest(left, lengths, width)
        times = min(left[n] // k for n, k in content)
        bins.append((times, content))
        for n, k in content:
            left[n] -= times * k
            if not left[n]:
                del left[n]
        lengths = [n for n in lengths if n in left]
    return bins


def _segments(bins: list[tuple[int, list[tuple[int, int]]]], width: int) -> list[np.ndarray]:
    """Per length: rows (first number, how many in a bin, first sequence, place of the first in the bin)."""
    rows: list[list[tuple[int, int, int, int]]] = [[] for _ in range(width + 1)]
    used, sequence = [0] * (width + 1), 0
    for times, content in bins:
        place = 0
        for length, k in content:
            rows[length].append((used[length], k, sequence, place))
            used[length] += times * k
            place += length * k
        sequence += times
    return [np.array(r, np.int64).reshape(-1, 4) for r in rows]


def pack(docs: DataFrame, vocabulary: str, width: int = WIDTH) -> DataFrame:
    """Every piece with the sequence it is in and its place there."""
    cut = written(text_pieces(docs, vocabulary, width))
    parts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # At most ``width`` counts come to the driver.
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments = docs.sparkSession.sparkContext.broadcast(_segments(plan(counts, width), width))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("length", "part", F.coalesce(before, F.lit(0)).alias("earlier"))
    numbered = cut.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("earlier")).alias("number")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = segments.value
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length).tolist():
                own = np.flatnonzero(length == one)
                found = table[one][np.searchsorted(table[one][:, 0], number[own], "right") - 1]
                nth = number[own] - found[:, 0]
                sequence[own] = found[:, 2] + nth // found[:, 1]
                offset[own] = found[:, 3] + nth % found[:, 1] * one
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return numbered.mapInArrow(place, PIECE + ", sequence_id long, offset long")
