"""Language identification by compression with per-language dictionaries.

Each language has a zstandard dictionary of raw content, cut from a bounded sample of
its labelled texts. A text is brought to lower-case letters and encoded, piece by piece,
with every dictionary; the language whose dictionary gives the fewest bytes is chosen, and
the choice counts as unreliable when the margin to the next is narrow. A letter is a character of the Unicode categories L,
in learning as in identifying: digits, fractions and letter-like numbers (as Roman ones) are none.

Nulls and odd rows: a null text, or one without letters, is ``und`` with score 0 and
unreliable; without any labelled text every text is ``und``; ties go to the smaller name;
repeated rows get equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDECIDED = "und"
#: Labelled texts sampled per language (about), characters taken from each, bytes of a dictionary.
SAMPLE, WINDOW, DICTIONARY = 160, 1200, 112_640
PIECE, LEVEL = 4096, 12
NARROW = 0.004
#: ASCII bytes that are no letters become spaces.
TABLE = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def plain(text: str) -> bytes:
    """Lower-case letters of ``text`` with single spaces between."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(TABLE).split())


def learn(labelled: DataFrame, sample: int = SAMPLE) -> dict[str, bytes]:
    """Dictionary of every language in ``lang``, from a sample chosen by the hash of the id.

    About ``sample`` texts a language come to the driver, and of each a stretch
    of WINDOW characters at a place that the hash chooses.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("languages")), F.lit(1 << 30)) / float(1 << 30)
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, max(1.0, sample) / n)])
    room = F.greatest(F.lit(1), F.length("text") - WINDOW)
    start = (F.pmod(F.xxhash64("doc_id", F.lit("place")), room) + 1).cast("int")
    rows = (
        labelled.where(draw < F.element_at(shares, F.col("lang")))
        .select("lang", F.substring("text", start, F.lit(WINDOW)).alias("stretch"), F.xxhash64("doc_id").alias("order")).collect()
    )
    found: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["order"])):
        found.setdefault(row["lang"], []).append(plain(row["stretch"]))
    return {lang: b" ".join(dict.fromkeys(parts))[-DICTIONARY:] for lang, parts in sorted(found.items())}


def sizes_with(dictionaries: dict[str, bytes]):
    """A function from plain bytes to the encoded size with each dictionary, in the order of names."""
    import zstandard

    coders = []
    for content in dictionaries.values():
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=LEVEL)
        coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_dict_id=False))

    def measure(data: bytes) -> list[int]:
        pieces = [data[k : k + PIECE] for k in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in coders]

    return measure


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, margin, reliable) of every text."""
    names = list(dictionaries)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import math

        measure = sizes_with(dictionaries)
        for batch in batches:
            lang, score, margin = [], [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                if not names or text is None or not any(map(str.isalpha, text)):
                    lang.append(UNDECIDED), score.append(0.0), margin.append(0.0)
                    continue
                sizes = measure(plain(text) or text.encode("utf-8", "replace"))
                order = sorted(range(len(sizes)), key=sizes.__getitem__)
                best = sizes[order[0]]
                # Bytes saved against each other dictionary, on the scale of one per cent of the text.
                rest = sum(math.exp(-(sizes[k] - best) / (1 + 0.01 * best)) for k in order[1:])
                lang.append(names[order[0]])
                score.append(1 / (1 + rest))
                margin.append((sizes[order[1]] - best) / best if len(order) > 1 else 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())],
                names=["doc_id", "lang_pred", "score", "margin"],
            )

    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(decide, "doc_id long, lang_pred string, score double, margin double")
        .withColumn("reliable", F.col("margin") >= NARROW)
    )
