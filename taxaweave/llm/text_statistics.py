"""Statistics of a text's form, for classifiers: shares of words or characters, found for whole chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.scan import Chunk, chunks, counts_by_row, mix, span_hashes, sums_by_row, windows

NAMES = (
    "log_words", "word_length", "symbol_words", "symbol_chars", "upper_chars", "upper_words", "mark_words", "bar_words",
    "digit_words", "distinct_words", "same_as_before", "repeated_windows", "repeated_lines", "top_word", "short_words",
)
#: Fixed values.
SYMBOLS, MARKS = "#*$%&<>@~^=+\\{}[]", "!?"


def _distinct(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Different keys of each row."""
    own = mix(keys ^ mix(rows.astype(np.uint64) + np.uint64(3)))
    _, first = np.unique(own, return_index=True)
    return counts_by_row(rows[first], n)


def chunk_statistics(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(one row of statistics per text, rows of words, hashes of words in lower case, words per text)."""
    code, n = chunk.code, chunk.rows
    starts, ends = chunk.words()
    rows = chunk.row_of(starts)
    upper = (code >= 0x41) & (code <= 0x5A) | (code >= 0xC0) & (code <= 0xDE) & (code != 0xD7)
    lower = np.where(upper, code + 0x20, code)
    symbol = np.isin(code, [ord(c) for c in SYMBOLS])
    letter = upper | (code >= 0x61) & (code <= 0x7A) | (code >= 0xDF)

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(code) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums

    def within(mask: np.ndarray) -> np.ndarray:
        sums = total(mask)
        return sums[ends] - sums[starts]

    def per_row(mask: np.ndarray) -> np.ndarray:
        sums = total(mask)
        return sums[chunk.bounds[1:]] - sums[chunk.bounds[:-1]]

    n_words, letters = counts_by_row(rows, n), within(letter)
    # Words without what stands after their last letter: their form in a list of words.
    last = np.maximum.accumulate(np.where(letter, np.arange(1, len(code) + 1), 0)) if len(code) else np.zeros(0, np.int64)
    stem_ends = np.where(letters > 0, last[ends - 1], ends) if len(ends) else ends
    hashes = span_hashes(chunk.prefix(lower), starts, stem_ends)
    share = lambda mask: sums_by_row(mask, rows, n) / np.maximum(n_words, 1)
    n_chars = np.maximum(sums_by_row(ends - starts, rows, n), 1)
    same = np.zeros(len(rows), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    own = mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(3)))
    keys, first, count = np.unique(own, return_index=True, return_counts=True)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, rows[first], count)
    three, at = windows(hashes, rows, 3)
    n_three = np.maximum(counts_by_row(rows[at], n), 1)
    line_starts, line_ends = chunk.lines()
    full = line_ends > line_starts
    line_rows = chunk.row_of(line_starts[full])
    lines = span_hashes(chunk.prefix(lower), line_starts[full], line_ends[full])
    n_lines = np.maximum(counts_by_row(line_rows, n), 1)
    short = ends - starts <= 3
    columns = [
        np.log1p(n_words), sums_by_row(ends - starts, rows, n) / np.maximum(n_words, 1), share(within(symbol) > 0),
        per_row(symbol) / n_chars, per_row(upper) / np.maximum(per_row(letter), 1), share((within(upper) == letters) & (letters > 1)),
        share(within(np.isin(code, [ord(c) for c in MARKS])) > 0), share(within(code == 0x7C) > 0),
        share(within((code >= 0x30) & (code <= 0x39)) > 0), counts_by_row(rows[first], n) / np.maximum(n_words, 1), share(same),
        1 - _distinct(three, rows[at], n) / n_three * (counts_by_row(rows[at], n) > 0) - (counts_by_row(rows[at], n) == 0),
        1 - _distinct(lines, line_rows, n) / n_lines * (counts_by_row(line_rows, n) > 0) - (counts_by_row(line_rows, n) == 0),
        top / np.maximum(n_words, 1), share(short),
    ]
    return np.column_stack(columns).astype(np.float64), rows, hashes, n_words


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every text (null: those of an empty one)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                table, *_ = chunk_statistics(chunk)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(chunk.first, chunk.rows), *(pa.array(c) for c in table.T)], names=["doc_id", *NAMES]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, "doc_id long, " + ", ".join(f"{x} double" for x in NAMES)
    )
