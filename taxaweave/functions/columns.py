"""Column expressions: everything here stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nucleotide codes (IUPAC) and their complements.
BASES = "ACGTRYWSKMBDHVN"
COMPLEMENTS = "TGCAYRWSMKVHDBN"
# Fixed value: the text that stands for a missing value outside the engine.
EMPTY = "empty"
# Fixed value: the text that marks the representative of a cluster outside the engine.
LEAD = "lead"


def empty_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(EMPTY))


def null_to_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(EMPTY))


def letter_share(text: Column, letter: str) -> Column:
    """Share of ``letter`` in ``text``; NULL for an empty text."""
    rest = F.length(F.replace(text, F.lit(letter), F.lit("")))
    return F.try_divide((F.length(text) - rest).cast("double"), F.length(text).cast("double"))


def quality_score(length: Column, share: Column) -> Column:
    """Number of informative letters: the length less its ambiguous share."""
    return length * (F.lit(1.0) - share)


def reverse_complement(sequence: Column) -> Column:
    return F.translate(F.reverse(sequence), BASES + BASES.lower(), COMPLEMENTS * 2)


def lineage(taxon_string: Column) -> Column:
    return F.split(taxon_string, r"\s*;\s*")


def in_lineage(taxon_string: Column, taxon: str | Column) -> Column:
    return F.array_contains(lineage(taxon_string), taxon)


def cluster_label(identifier: Column, lead: Column) -> Column:
    """External form of a cluster membership: ``lead``, the lead's id, or ``empty``."""
    return (
        F.when(lead.isNull(), F.lit(EMPTY))
        .when(lead == identifier, F.lit(LEAD))
        .otherwise(lead.cast("string"))
    )


def safe_name(name: Column) -> Column:
    """A name fit for tree and alignment files."""
    name = F.regexp_replace(name, r"\s", "_")
    name = F.regexp_replace(name, r"\(.*\)", "")
    name = F.regexp_replace(name, r"""[-,:;'".\\/]""", "_")
    return F.replace(name, F.lit("__"), F.lit("_"))


def ungapped_length(sequence: Column) -> Column:
    return F.length(F.replace(sequence, F.lit("-"), F.lit("")))


def gap_fill(sequence: Column, length: Column) -> Column:
    return F.coalesce(sequence, F.repeat(F.lit("-"), length))


def jukes_cantor(share_different: Column) -> Column:
    """Jukes-Cantor distance; NULL once the sequences are saturated."""
    inside = F.lit(1.0) - share_different * F.lit(4.0 / 3.0)
    return F.when(inside > 0, F.lit(-0.75) * F.ln(inside))


def cut_offs(text: str) -> Mapping[str, float]:
    """``all,0.99`` or ``its,0.97,default,0.99`` as a mapping."""
    parts = text.split(",")
    return {name: float(value) for name, value in zip(parts[::2], parts[1::2])}


def cut_off_for(gene: Column, settings: Mapping[str, float]) -> Column:
    """Cut-off of each gene: ``all`` wins, then the gene's own, then ``default``."""
    if "all" in settings:
        return F.lit(settings["all"])
    own = F.lit(settings.get("default")).cast("double")
    for name, value in settings.items():
        if name != "default":
            own = F.when(gene == name, F.lit(value)).otherwise(own)
    return F.when(own.isNotNull(), own).otherwise(
        F.raise_error(F.concat(F.lit("no cut-off for gene "), gene)).cast("double")
    )
