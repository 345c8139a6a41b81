"""Vectorised scans of text columns inside tasks.

A batch of texts becomes one array of code points with the bounds of its rows.
Words, lines and their hashes are then found for all rows at once, so that no
operator loops over words in Python. Texts are handled in chunks of about a
quarter of a million characters; one longer text is a chunk of its own, at some
fifty bytes of memory a character.

Hashes have 64 bits: two different strings of a corpus share one with a
probability of about (number of strings)^2 / 4e19.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def worker_cache() -> types.ModuleType:
    """A place that lives as long as the Python worker, across its tasks."""
    name = "taxaweave_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i below n."""
    cache = worker_cache()
    if not hasattr(cache, "powers") or len(cache.powers[0]) < n:
        size = max(n, CHUNK + 4096)
        both = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        if size > CHUNK + 4096:  # of one very long text: not kept
            return both[0], both[1]
        cache.powers = tuple(both)
    return cache.powers


def _letters() -> np.ndarray:
    """A random-looking number for every code point."""
    cache = worker_cache()
    if not hasattr(cache, "letters"):
        cache.letters = mix(np.arange(1, 0x110001, dtype=np.uint64))
    return cache.letters


@dataclass
class Chunk:
    """Rows ``first`` to ``first + rows`` of a batch as code points."""

    first: int
    code: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, "right") - 1

    def row_starts(self) -> np.ndarray:
        """True at the first character of every row that has one; one place more than characters."""
        marks = np.zeros(len(self.code) + 1, bool)
        marks[self.bounds] = True
        return marks

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of True, none longer than its row."""
        n = len(inside)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = self.row_starts()
        before = np.empty(n, bool)
        before[0], before[1:] = False, inside[:-1]
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, inside[1:]
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        return starts, ends

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs without the white space characters 09 to 0D and 20."""
        code = self.code
        return self.spans((code != 0x20) & ((code < 0x09) | (code > 0x0D)))

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Pieces between line feeds, empty ones included; an empty row has one."""
        breaks = np.flatnonzero(self.code == 0x0A)
        starts = np.sort(np.concatenate([self.bounds[:-1], breaks + 1]))
        ends = np.sort(np.concatenate([breaks, self.bounds[1:]]))
        return starts, ends

    def prefix(self, code: np.ndarray | None = None) -> np.ndarray:
        """Sums from which :func:`span_hashes` reads the hash of any span."""
        values = _letters()[self.code if code is None else code]
        values *= _powers(len(values))[0][: len(values)]
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``width`` following words of a row, and the place of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(rows[:n] == rows[width - 1 :])
    total = np.zeros(len(first), np.uint64)
    for k in range(width):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[first + k]
    return mix(total), first


def sums_by_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def counts_by_row(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """Cut a batch's text column (null: empty) into chunks of whole rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        raw = data[offsets[first] : offsets[last]]
        ends = offsets[first : last + 1] - offsets[first]
        lead = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
        bounds = lead[ends]
        code = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), "<u4")
        if len(code) != bounds[-1]:  # bytes that are not UTF-8: row by row
            texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
            code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
            bounds = np.cumsum([0, *map(len, texts)])
        yield Chunk(first, code, bounds)
        first = last
