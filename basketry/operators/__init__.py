from basketry.operators.lookup import fits, lookup_join, measure
from basketry.operators.parallel import spread
from basketry.operators.quality import (
    dataset_stats,
    duplicate_ratio,
    quality_gate,
    require_rows,
    sample_documents,
)
from basketry.operators.versioned import expire, latest_version, version_stamp

__all__ = [
    "dataset_stats",
    "duplicate_ratio",
    "expire",
    "fits",
    "latest_version",
    "lookup_join",
    "measure",
    "quality_gate",
    "require_rows",
    "sample_documents",
    "spread",
    "version_stamp",
]
