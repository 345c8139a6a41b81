"""Secret scans: keywords by Aho-Corasick, anchored expressions at their hits, checksums at last.

One automaton finds all keywords of a text (ASCII letters in either case). Only at
a hit is the kind's expression tried, anchored there, from left to right and never
inside an earlier match of the kind. Runs of hexadecimal digits have no keyword;
a sieve that looks at every sixteenth character finds the texts that may hold one.
Tokens that carry their own checksum count only if it is right.

Nulls and odd rows: a null text is empty and has no spans; repeated rows give
equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in order, the keywords that announce them, and their expressions.
KINDS = ("assign", "access", "hex", "signed")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_WORD = "akia"
SIGNED_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
SIGNED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
STEP = LEAST_HEX // 2


def checksum(body: str) -> str:
    """The six letters that such a token ends with: CRC-32 of its body to base 62."""
    value, out = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        out = ALPHABET[digit] + out
    return out.rjust(6, "0")


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_WORDS), ("access", (ACCESS_WORD,)), ("signed", SIGNED_WORDS)):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


IS_HEX = np.zeros(256, bool)
IS_HEX[list(b"0123456789abcdef")] = True


def may_hold_hex(data: bytes) -> bool:
    """False only if no run of 32 such bytes exists: a run covers two following marks of sixteen."""
    marks = IS_HEX[np.frombuffer(data, np.uint8)[::STEP]]
    return len(marks) > 1 and bool((marks[1:] & marks[:-1]).any())


def find(text: str, keywords) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, in code points, by start and then kind."""
    data = text.encode("utf-8", "surrogatepass")
    lowered = data.lower().decode("utf-8", "surrogatepass")  # ASCII letters only: as long as the text
    starts: dict[str, list[int]] = {}
    for last, (kind, length) in keywords.iter(lowered):
        starts.setdefault(kind, []).append(last - length + 1)
    spans = []
    for kind, expression, good in (
        ("assign", ASSIGN, lambda m: len(m[2]) >= LEAST_ASSIGN),
        ("access", ACCESS, lambda m: m.end() - m.start() >= LEAST_ACCESS),
        ("signed", SIGNED, lambda m: checksum(m[1]) == m[2]),
    ):
        end = 0
        for start in sorted(set(starts.get(kind, ()))):
            if start >= end and (match := expression.match(text, start)):
                end = match.end()
                if good(match):
                    spans.append((start, end, kind))
    if may_hold_hex(data):
        spans += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def masked(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """``text`` with every covered stretch replaced by ``mark``."""
    out, place = [], 0
    for start, end, _ in spans:
        if start >= place:
            out += [text[place:start], mark]
        place = max(place, end)
    return "".join(out) + text[place:]


def _join(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


FOUND = "n_assign long, n_access long, n_hex long, n_signed long, base_sha256 string, spans string"


def secret_spans(docs: DataFrame) -> DataFrame:
    """Counts by kind, the base spans' digest and all spans of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_signed", "base_sha256", "spans")}
            for text in batch.column("text"):
                spans = find(text.as_py() or "", keywords)
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s[2] == kind for s in spans))
                out["base_sha256"].append(hashlib.sha256(_join([s for s in spans if s[2] != "signed"]).encode()).hexdigest())
                out["spans"].append(_join(spans))
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, t) for v, t in zip(out.values(), types, strict=True))], names=["doc_id", *out]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, " + FOUND)


def mask_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced (null stays null)."""
    text_at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            clean = [None if t is None else masked(t, find(t, keywords), mark) for t in texts]
            columns = list(batch.columns)
            columns[text_at] = pa.array(clean, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(scan, docs.schema)
