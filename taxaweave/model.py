"""Schemas of the tables the operators exchange.

Missing text is NULL inside the engine. The text forms ``empty``, ``lead`` and
``Yes``/``No`` exist only at the import and export boundary.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT_COLUMNS = (
    "species", "sub_species", "variety", "voucher", "isolate", "strain",
    "taxon_string", "country", "collected_by", "identified_by", "host", "reference",
)

RECORDS = T.StructType(
    [T.StructField("accno", T.StringType(), False)]
    + [T.StructField(name, T.StringType()) for name in TEXT_COLUMNS]
    + [
        T.StructField("environmental_sample", T.BooleanType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("sequence", T.StringType()),
        T.StructField("proportion_N", T.DoubleType()),
    ]
)

GENE_SEQUENCES = T.StructType([
    T.StructField("gene", T.StringType(), False),
    T.StructField("accno", T.StringType(), False),
    T.StructField("sequence", T.StringType()),
    T.StructField("lead", T.StringType()),
])

TAXON_GENES = T.StructType([
    T.StructField("taxon", T.LongType(), False),
    T.StructField("gene", T.StringType(), False),
    T.StructField("accno", T.StringType(), False),
])

TREES = T.StructType([
    T.StructField("gene", T.StringType(), False),
    T.StructField("taxon", T.StringType(), False),
    T.StructField("tree", T.StringType()),
    T.StructField("tree_method", T.StringType()),
])

HITS = T.StructType([
    T.StructField("accno", T.StringType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("hit_start", T.IntegerType()),
    T.StructField("hit_end", T.IntegerType()),
    T.StructField("evalue", T.DoubleType()),
    T.StructField("reverse", T.BooleanType()),
])
