"""GenBank flat files as a table of records, parsed by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave.functions import letter_share
from taxaweave.model import RECORDS, TEXT_COLUMNS

# Column and qualifier name of the source annotations.
QUALIFIERS = {
    "voucher": "specimen_voucher", "strain": "strain", "isolate": "isolate", "country": "country",
    "collected_by": "collected_by", "identified_by": "identified_by", "host": "host",
    "sub_species": "sub_species", "variety": "variety",
}
# Fixed value: line heads that open another part of a record.
HEADS = r"(?=^(?:ORIGIN|ACCESSION|FEATURES|REFERENCE|\s*ORGANISM)|\z)"
# Fixed value: suffix that is not part of a species name.
BELOW_SPECIES = r" (var\.|f\.|ssp.) \w+$"
# Fixed value: form of a coordinate pair.
LAT_LON = r"^([0-9.]+)\s+([NnSs])\s+([0-9.]+)\s+([EeWw])"
DEFAULT_MAX_LENGTH = 10_000


def entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; the end mark is the separator, so large files are split."""
    return spark.read.option("lineSep", "\n//").text(path).where(F.col("value").contains("ACCESSION"))


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _lineage_lines(text: Column) -> Column:
    block = F.regexp_extract(text, r"(?ms)^\s*ORGANISM[^\n]*\n(.*?)" + HEADS, 1)
    lines = F.transform(F.split(block, "\n"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    return F.filter(lines, lambda s: s != "")


def _lineage(text: Column) -> Column:
    lines = _lineage_lines(text)
    closing = F.array_position(F.transform(lines, lambda s: s.endswith(".")), True)
    upto = F.slice(lines, F.lit(1), F.when(closing > 0, closing).otherwise(F.size(lines)).cast("int"))
    fitting = F.filter(upto, lambda s: s.rlike(r"^[\w ]+;|\.$"))
    return F.nullif(F.regexp_replace(F.concat_ws(" ", fitting), r"\.$", ""), F.lit(""))


def _reference(text: Column) -> Column:
    block = F.regexp_extract(text, r"(?ms)^REFERENCE[ \t]+1(?![0-9])[^\n]*\n(.*?)(?=^\S|^\s*ORGANISM|\z)", 1)
    known = F.regexp_extract(block, r"(?s)^.*?(\s+(?:AUTHORS|TITLE|JOURNAL)\s.*)$", 1)
    lines = F.filter(F.split(known, "\r?\n"), lambda s: s.rlike(r"\S"))
    marked = F.transform(
        lines,
        lambda s: F.when(s.rlike(r"^\s+AUTHORS\s"), F.regexp_replace(s, r"^\s+AUTHORS\s+", ""))
        .when(s.rlike(r"^\s+TITLE\s"), F.regexp_replace(s, r"^\s+TITLE\s+", " "))
        .when(s.rlike(r"^\s+JOURNAL\s"), F.regexp_replace(s, r"^\s+JOURNAL\s+", ". "))
        .otherwise(F.regexp_replace(s, r"^\s+", " ")),
    )
    return F.nullif(F.concat_ws("", marked), F.lit(""))


def parse(texts: DataFrame) -> DataFrame:
    """Records from ``entries``. Works on static and on streaming input."""
    text = F.col("value")
    features = F.regexp_extract(text, r"(?ms)^FEATURES(.*?)(?=^ORIGIN|\z)", 1)
    place = F.regexp_extract(features, r'/lat_lon="([^"\r\n]+)', 1)
    bases = F.when(
        text.rlike(r"(?m)^ORIGIN"),
        F.upper(F.regexp_replace(F.regexp_extract(text, r"(?ms)^ORIGIN[^\n]*\n(.*)\z", 1), "[^a-zA-Z]", "")),
    )
    sign_lat = F.when(F.upper(F.regexp_extract(place, LAT_LON, 2)) == "S", F.lit(-1)).otherwise(F.lit(1))
    sign_lon = F.when(F.upper(F.regexp_extract(place, LAT_LON, 4)) == "W", F.lit(-1)).otherwise(F.lit(1))
    columns = {
        "accno": _first(text, r"(?m)^ACCESSION[ \t]+(\w+)"),
        "species": F.regexp_replace(
            F.regexp_replace(_first(text, r"(?m)^\s*ORGANISM[ \t]+([^\r\n]+)"), r"\s+$", ""), BELOW_SPECIES, ""
        ),
        "taxon_string": _lineage(text),
        "reference": _reference(text),
        "environmental_sample": features.contains("/environmental_sample"),
        "latitude": sign_lat * _first(place, LAT_LON, 1).try_cast("double"),
        "longitude": sign_lon * _first(place, LAT_LON, 3).try_cast("double"),
        "sequence": F.nullif(bases, F.lit("")),
    }
    for column, name in QUALIFIERS.items():
        found = F.regexp_extract_all(features, F.lit(rf'/{name}="([^"\r\n]+)'), F.lit(1))
        columns[column] = F.try_element_at(found, F.lit(-1))
    for column in TEXT_COLUMNS:
        columns[column] = F.replace(columns[column], F.lit("`"), F.lit(""))
    parsed = texts.select(*[columns[f.name].alias(f.name) for f in RECORDS.fields if f.name != "proportion_N"])
    return parsed.withColumn("proportion_N", letter_share(F.col("sequence"), "N"))


def read_genbank(spark: SparkSession, path: str, max_length: int = DEFAULT_MAX_LENGTH) -> DataFrame:
    """Records no longer than ``max_length``."""
    return short_enough(parse(entries(spark, path)), max_length)


def short_enough(records: DataFrame, max_length: int) -> DataFrame:
    return records.where(F.col("sequence").isNull() | (F.length("sequence") <= max_length))


def skipped(spark: SparkSession, path: str, max_length: int = DEFAULT_MAX_LENGTH) -> DataFrame:
    """(skipped): how many records are longer than ``max_length``. Only their bases are looked at."""
    return parse(entries(spark, path)).where(F.length("sequence") > max_length).agg(F.count(F.lit(1)).alias("skipped"))


def skipped_count(spark: SparkSession, path: str, max_length: int = DEFAULT_MAX_LENGTH) -> int:
    """The number of :func:`skipped`."""
    return skipped(spark, path, max_length).first()["skipped"]


def odd_lineage_lines(texts: DataFrame) -> DataFrame:
    """(accno, line): lines under the organism that do not look like part of a lineage."""
    lines = _lineage_lines(F.col("value"))
    closing = F.array_position(F.transform(lines, lambda s: s.endswith(".")), True)
    upto = F.slice(lines, F.lit(1), F.when(closing > 0, closing).otherwise(F.size(lines)).cast("int"))
    return texts.select(
        _first(F.col("value"), r"(?m)^ACCESSION[ \t]+(\w+)").alias("accno"),
        F.explode(F.filter(upto, lambda s: ~s.rlike(r"^[\w ]+;|\.$"))).alias("line"),
    )


def require_unique(records: DataFrame, key: str = "accno") -> DataFrame:
    """``records``, or an error when a key occurs twice."""
    twice = records.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate {key}: {twice[0][key]}")
    return records
