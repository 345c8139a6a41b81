from taxaweave.functions.columns import (  # noqa: F401
    cluster_label,
    empty_to_null,
    gap_fill,
    in_lineage,
    jukes_cantor,
    letter_share,
    lineage,
    null_to_empty,
    quality_score,
    reverse_complement,
    safe_name,
    ungapped_length,
)
