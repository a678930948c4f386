"""Column-level helpers (built-in Spark expressions only; nothing here runs Python per row)."""

from citylake.functions.columns import (
    array_count,
    first_element,
    safe_ratio,
    snapshot_date,
    to_double,
    year_text,
)

__all__ = ["array_count", "first_element", "safe_ratio", "snapshot_date", "to_double", "year_text"]
