"""Scalar helpers: hashing, change predicates, ISO durations, processing time.

Everything returns a ``Column`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROCESSED_COLUMN = "processed_dttm"

# Fixed values that must equal the reference behaviour: the separator used to
# join hashed columns and the stand-in text for NULL before hashing.
HASH_SEPARATOR = "||"
HASH_NULL_TEXT = "none"

# Fixed value: ISO-8601 time-only duration accepted by the duration parser,
# hours / minutes / seconds each optional ("PT" alone means zero seconds).
ISO_DURATION_PATTERN = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?$"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(columns: Iterable[str | Column], exact: bool = False) -> Column:
    """md5 over the text of ``columns``; NULL is hashed as the text ``'none'``.

    This is the change detector of the versioning operators.  With the default
    NULL and the literal text ``'none'`` hash alike (kept on purpose: it is the
    reference behaviour).  ``exact=True`` tags every value with a null marker so
    the two can no longer collide.
    """
    cols = [_as_col(c) for c in columns]
    if not cols:
        return F.md5(F.lit(""))
    if exact:
        parts = [
            F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c.cast("string")))
            for c in cols
        ]
        return F.md5(F.to_json(F.array(*parts)))
    parts = [F.coalesce(c.cast("string"), F.lit(HASH_NULL_TEXT)) for c in cols]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def link_key(*columns: str | Column) -> Column:
    """Link hash key: md5 of the columns joined by ``'||'``; NULLs are skipped."""
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[_as_col(c).cast("string") for c in columns]))


def null_safe_equal(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def key_match(left: DataFrame | str, right: DataFrame | str, columns: Sequence[str]) -> Column:
    """Plain ``=`` over key columns (NULL keys never match), like a MERGE ON clause."""
    if not columns:
        raise ValueError("key columns must not be empty")
    lhs = (lambda c: left[c]) if isinstance(left, DataFrame) else (lambda c: F.col(f"{left}.{c}"))
    rhs = (lambda c: right[c]) if isinstance(right, DataFrame) else (lambda c: F.col(f"{right}.{c}"))
    return reduce(lambda acc, c: acc & (lhs(c) == rhs(c)), columns[1:], lhs(columns[0]) == rhs(columns[0]))


def changed(left: DataFrame | str, right: DataFrame | str, columns: Sequence[str]) -> Column:
    """True when some column differs null-safely (NULL vs NULL is equal)."""
    if not columns:
        raise ValueError("compare columns must not be empty")
    lhs = (lambda c: left[c]) if isinstance(left, DataFrame) else (lambda c: F.col(f"{left}.{c}"))
    rhs = (lambda c: right[c]) if isinstance(right, DataFrame) else (lambda c: F.col(f"{right}.{c}"))
    same = reduce(lambda acc, c: acc & lhs(c).eqNullSafe(rhs(c)), columns[1:],
                  lhs(columns[0]).eqNullSafe(rhs(columns[0])))
    return ~same


def iso_duration_seconds(column: str | Column) -> Column:
    """``PT#H#M#S`` to seconds; anything else (``P0D``, ``P1DT2H``, NULL) is NULL.

    ``try_cast`` keeps this valid under ANSI mode, where an empty capture group
    would otherwise raise.
    """
    c = _as_col(column)

    def part(group: int) -> Column:
        return F.coalesce(F.regexp_extract(c, ISO_DURATION_PATTERN, group).try_cast("int"), F.lit(0))

    return F.when(c.rlike(ISO_DURATION_PATTERN), part(1) * 3600 + part(2) * 60 + part(3))


def processed_at(value: _dt.datetime | str | None = None) -> Column:
    """Processing time: ``current_timestamp()`` or a fixed value (tests, replays)."""
    if value is None:
        return F.current_timestamp()
    return F.lit(value).cast("timestamp")


def with_processed_at(df: DataFrame, value: _dt.datetime | str | None = None) -> DataFrame:
    return df.withColumn(PROCESSED_COLUMN, processed_at(value))
