from taxaweave.plans import (  # noqa: F401
    alignment,
    guided,
    invariants,
    linking,
    matrix,
    outliers,
    records,
    regions,
    representatives,
    sources,
    taxonomy,
    tree_scores,
)
from taxaweave.plans.registry import QUERIES, SQL  # noqa: F401
