"""Column expressions (all built-in Spark functions, no UDFs)."""

from tidemark.functions.columns import (
    changed,
    iso_duration_seconds,
    key_match,
    link_key,
    null_safe_equal,
    row_hash,
    with_processed_at,
)
from tidemark.functions.calendar import calendar_fields

__all__ = [
    "calendar_fields",
    "changed",
    "iso_duration_seconds",
    "key_match",
    "link_key",
    "null_safe_equal",
    "row_hash",
    "with_processed_at",
]
