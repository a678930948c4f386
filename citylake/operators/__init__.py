"""DataFrame-in, DataFrame-out operators."""

from citylake.operators.aggregate import count_by, mean_by
from citylake.operators.dedup import dedup_first, dedup_first_window, duplicate_count
from citylake.operators.quality import observe_counts, quality_report
from citylake.operators.rank import global_rank, rank_bucket, tercile
from citylake.operators.reconcile import extend_lookup, reconcile, reconcile_with_fallback
from citylake.operators.shape import (
    all_null_columns,
    drop_all_null,
    drop_columns,
    flatten_first,
    flatten_struct,
    rename,
    unnest_envelope,
)
from citylake.operators.upsert import check_unique, upsert

__all__ = [
    "all_null_columns", "check_unique", "count_by", "dedup_first", "dedup_first_window",
    "drop_all_null", "drop_columns", "duplicate_count", "extend_lookup", "flatten_first", "flatten_struct",
    "global_rank", "mean_by", "observe_counts", "quality_report", "rank_bucket", "reconcile",
    "reconcile_with_fallback", "rename", "tercile", "unnest_envelope", "upsert",
]
