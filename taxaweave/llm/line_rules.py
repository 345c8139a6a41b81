"""Quality rules: base counts of each text, and the lines that many documents of a host share.

Every line is normalised (ASCII letters to lower case, digits to 0, words joined
by one space) and hashed. Per host, the documents that hold a line are counted;
copies of one document count once: documents are told apart by a 64-bit hash
of all their normalised words in order. Texts that differ in one word are
different documents, so near copies count each: line by line, a group of them
is the same as documents that are mostly boilerplate. Lines held by more documents than the limit are boilerplate and
are removed; a document that keeps too few of its words is rejected.

The limit is a number of different documents (``MOST``), whatever the size of
the host: a line that stands in more of them goes, in a host of fifty documents
as in one of millions.

Nulls and odd rows: a null text is an empty one; a null host is a host of its
own; repeated rows are separate documents with equal verdicts; a document
without words fails the base rules; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaweave.llm.scan import Chunk, chunks, counts_by_row, mix, span_hashes, sums_by_row, windows
from taxaweave.llm.steps import written

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Fixed value: different documents of a host that may hold a line.
MOST = 10

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SCANNED = f"doc_id long, host string, {BASE}, whole long, lines array<long>, line_words array<int>"


def _repeats(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether the same key stands elsewhere in the same row."""
    if not len(keys):
        return np.zeros(0, bool)
    own = mix(keys ^ mix(rows.astype(np.uint64) + np.uint64(11)))
    _, inverse, count = np.unique(own, return_inverse=True, return_counts=True)
    return count[inverse] > 1


def _normal(code: np.ndarray) -> np.ndarray:
    code = np.where((code >= 0x41) & (code <= 0x5A), code + 0x20, code)
    return np.where((code >= 0x30) & (code <= 0x39), 0x30, code)


def scan_chunk(chunk: Chunk) -> dict[str, object]:
    """Base counts per row, and the normalised lines with words of each."""
    n, code = chunk.rows, chunk.code
    starts, ends = chunk.words()
    rows = chunk.row_of(starts)
    hashes = span_hashes(chunk.prefix(), starts, ends)
    n_words = counts_by_row(rows, n)

    _, first = trigrams = windows(hashes, rows, 3)
    twice = first[_repeats(trigrams[0], rows[first])]
    covered = np.zeros(len(rows) + 2, bool)
    for k in range(3):
        covered[twice + k] = True
    repeat_words = counts_by_row(rows[np.flatnonzero(covered[: len(rows)])], n)

    # Lines by their own characters, for the base count.
    line_starts, line_ends = chunk.lines()
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_rows = chunk.row_of(line_starts)
    exact = mix(span_hashes(chunk.prefix(), line_starts, line_ends) ^ mix(line_rows.astype(np.uint64) + np.uint64(7)))
    _, kept = np.unique(exact, return_index=True)
    dup_lines = counts_by_row(line_rows, n) - counts_by_row(line_rows[kept], n)

    # The same lines normalised: sums over the hashes of their words, each with its place in the line.
    plain = span_hashes(chunk.prefix(_normal(code)), starts, ends)
    line_of_word = np.searchsorted(line_starts, starts, "right") - 1
    first_word = np.searchsorted(starts, line_starts)
    place = np.arange(len(starts)) - first_word[line_of_word] if len(starts) else np.zeros(0, np.int64)
    placed = mix(plain + mix(place.astype(np.uint64)))
    lines = np.zeros(len(line_starts), np.uint64)
    np.add.at(lines, line_of_word, placed)
    line_words = counts_by_row(line_of_word, len(line_starts))

    # The whole text the same way, each word with its place in the row.
    row_place = np.arange(len(starts)) - np.searchsorted(starts, chunk.bounds)[rows]
    whole = np.zeros(n, np.uint64)
    np.add.at(whole, rows, mix(plain + mix(row_place.astype(np.uint64))))
    whole = mix(whole + mix(n_words.astype(np.uint64)))

    return {
        "n_words": n_words, "word_chars": sums_by_row(ends - starts, rows, n),
        "n_symbols": counts_by_row(chunk.row_of(np.flatnonzero(np.isin(code, [ord(c) for c in SYMBOLS]))), n),
        "n_dup_lines": dup_lines, "n_repeat_words": repeat_words, "whole": whole.view(np.int64),
        "lines": lines.view(np.int64), "line_words": line_words, "per_row": counts_by_row(line_rows, n),
    }


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            out = scan_chunk(chunk)
            ids = batch.column("doc_id").slice(chunk.first, chunk.rows)
            host = batch.column("host").slice(chunk.first, chunk.rows)
            offsets = pa.array(np.concatenate([[0], np.cumsum(out["per_row"])]).astype(np.int32))
            flat = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "whole"]
            yield pa.RecordBatch.from_arrays(
                [ids, host, *(pa.array(out[k]) for k in flat),
                 pa.ListArray.from_arrays(offsets, pa.array(out["lines"])),
                 pa.ListArray.from_arrays(offsets, pa.array(out["line_words"].astype(np.int32)))],
                names=["doc_id", "host", *flat, "lines", "line_words"],
            )


def scan(docs: DataFrame, host: str = "source") -> DataFrame:
    """Base counts, hash of the whole text and normalised lines of every document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col(host).cast("string").alias("host")
    ).mapInArrow(_scan, SCANNED)


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent)


def common_lines(scanned: DataFrame, most: int = MOST) -> DataFrame:
    """(host, line, n): lines held by more than ``most`` different documents of a host.

    A line of a host is first reduced to its different documents, so that no
    count gathers the rows of one line.
    """
    return (
        scanned.select("host", "whole", F.explode("lines").alias("line")).distinct()
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    )


def quality(
    docs: DataFrame, host: str = "source", most: int = MOST, keep_share: float = 0.5,
    min_words: int = 50, repeat_percent: int = 50,
) -> DataFrame:
    """Per document: base counts, words left after removal of common lines, verdict.

    ``kept`` is false if the base rules fail, or if fewer than ``keep_share`` of
    the words, or fewer than ``min_words`` / 2 words, are left.
    """
    # Rows are numbered, so that repeated ids stay apart.
    scanned = written(scan(docs, host).withColumn("row", F.monotonically_increasing_id()))
    common = common_lines(scanned, most)
    lines = scanned.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select(
        "row", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words")
    )
    lost = (
        lines.alias("a").join(
            common.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.line") == F.col("b.line"))
        ).groupBy("a.row").agg(F.sum("words").alias("lost_words"), F.count(F.lit(1)).alias("lost_lines"))
    )
    left = F.col("n_words") - F.col("lost_words")
    return (
        scanned.join(lost, "row", "left")
        .withColumn("lost_words", F.coalesce("lost_words", F.lit(0)).cast("long"))
        .withColumn("lost_lines", F.coalesce("lost_lines", F.lit(0)).cast("long"))
        .withColumn("base_failed", base_failed(min_words, repeat_percent))
        .withColumn("depleted", (left < F.col("n_words") * keep_share) | (left * 2 < min_words))
        .withColumn("kept", ~F.col("base_failed") & ~((F.col("lost_words") > 0) & F.col("depleted")))
        .drop("row", "whole", "lines", "line_words")
    )
