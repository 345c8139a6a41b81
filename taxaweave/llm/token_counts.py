"""Token counts by merging byte pairs with a heap and a linked list; no identifiers are emitted.

A piece starts as its bytes. The adjacent pair of the lowest rank is popped from
a heap and merged in a doubly linked list, its new neighbours are pushed, until no
pair of the vocabulary is left. The count is the number of initial symbols less the
number of merges. Different pieces are counted once while a worker remembers them;
the memory is bounded and starts anew when full.

Nulls and odd rows: null is an empty text of no tokens; a special string in a
text is one token, as the vocabulary's library has it; repeated rows are counted
each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.pretokens import pieces
from taxaweave.llm.scan import Chunk, chunks, span_hashes, sums_by_row, worker_cache

REMEMBERED = 4_000_000


def byte_letters() -> dict[int, str]:
    """How the vocabulary file spells each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class Merges:
    """Ranks of the vocabulary's merges, and the strings that stand for special tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [x["content"] for x in spec["added_tokens"] if x["special"]]
        ids: dict[bytes, int] = {}
        spelled = {c: b for b, c in byte_letters().items()}
        number = lambda text: ids.setdefault(bytes(spelled[c] for c in text), len(ids))
        for byte in range(256):
            ids[bytes([byte])] = byte
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = number(left), number(right)
            self.rank[a << 20 | b] = rank
            self.made.append(number(left + right))

    def count(self, word: bytes) -> int:
        """Symbols left when no pair of ``word`` can be merged."""
        n = len(word)
        if n < 2:
            return n
        get, made, symbol = self.rank.get, self.made, list(word)
        heap, left = [], symbol[0]
        for i, right in enumerate(symbol[1:]):
            rank = get(left << 20 | right)
            if rank is not None:
                heap.append(rank << 32 | i)
            left = right
        if not heap:
            return n
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heapq.heapify(heap)
        merges, pop, push = 0, heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j, a = after[i], symbol[i]
            if j < 0 or a < 0 or get(a << 20 | symbol[j]) != rank:
                continue  # one of the two has been merged meanwhile
            merges += 1
            symbol[i] = new = made[rank]
            symbol[j] = -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                rank = get(new << 20 | symbol[k])
                if rank is not None:
                    push(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = get(symbol[h] << 20 | new)
                if rank is not None:
                    push(heap, rank << 32 | h)
        return n - merges


class Known:
    """Counts by the hash of a piece, sorted by hash; forgotten when more than ``most``."""

    def __init__(self, most: int = REMEMBERED) -> None:
        self.most = most
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted ``keys``, -1 where unknown."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], -1)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        if len(self.keys) + len(keys) > self.most:
            self.keys, self.counts = keys, counts
            return
        at = np.searchsorted(self.keys, keys)
        self.keys, self.counts = np.insert(self.keys, at, keys), np.insert(self.counts, at, counts)


def _merges(path: str) -> Merges:
    cache = worker_cache()
    if getattr(cache, "merges_path", None) != path:
        cache.merges, cache.merges_path, cache.counted = Merges(path), path, Known()
    return cache.merges


def chunk_counts(chunk: Chunk, merges: Merges, known: Known) -> np.ndarray:
    """Tokens of each row of a chunk without special strings."""
    starts, ends = pieces(chunk)
    hashes = span_hashes(chunk.prefix(), starts, ends)
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    counts, code = known.look_up(distinct), chunk.code
    new = np.flatnonzero(counts < 0)
    for k in new.tolist():
        i = first[k]
        counts[k] = merges.count(code[starts[i] : ends[i]].tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "replace"))
    known.add(distinct[new], counts[new])
    return sums_by_row(counts[inverse], chunk.row_of(starts), chunk.rows)


def text_counts(column: pa.Array, merges: Merges, known: Known) -> np.ndarray:
    """Tokens of each text of a column (null: none)."""
    out = np.zeros(len(column), np.int64)
    for chunk in chunks(column):
        out[chunk.first : chunk.first + chunk.rows] = chunk_counts(chunk, merges, known)
    for special in merges.special:
        holds = pc.match_substring(column.fill_null(""), special).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(holds):
            parts = column[int(i)].as_py().split(special)
            out[i] = len(parts) - 1 + int(text_counts(pa.array(parts, pa.string()), merges, known).sum())
    return out


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(vocabulary)
        known = worker_cache().counted
        for batch in batches:
            counts = text_counts(batch.column("text"), merges, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts)], names=["doc_id", "n_bytes", "n_tokens"]
            )

    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    ).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
