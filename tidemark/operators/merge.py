"""Key-based SCD1 merges as pure functions: change set and new table content.

A merge never sees the whole target in one task: the target is joined to the
incoming rows on the key columns (Catalyst prunes columns, pushes filters and,
for tables partitioned by a key column such as ``calendar_dt``, prunes whole
partitions at run time).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import PROCESSED_COLUMN, processed_at
from tidemark.session import materialize

OPERATION = "_operation"
INSERT, UPDATE = "insert", "update"
WRITE_MODES = ("insert", "upsert", "rewrite")


def validate_write_mode(mode: str) -> None:
    if mode not in WRITE_MODES:
        raise ValueError(f"rows are written in one of the modes {list(WRITE_MODES)}, not {mode!r}")


def validate_no_duplicate_keys(df: DataFrame, key_columns: Sequence[str]) -> None:
    """Raise if a non-NULL key occurs twice in a merge input (one job, partial aggregate).

    Two input rows for one stored row would make a MERGE fail; rows with a
    NULL key never match anything and are simply inserted.
    """
    keys = list(key_columns)
    all_set = reduce(lambda acc, c: acc & F.col(c).isNotNull(), keys[1:], F.col(keys[0]).isNotNull())
    dup = df.where(all_set).groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"merge input has duplicate keys {keys}: {dict((k, dup[0][k]) for k in keys)}")


def compare_columns(df: DataFrame, key_columns: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in key_columns and c != PROCESSED_COLUMN]


def scd1_changes(target: DataFrame, source: DataFrame, key_columns: Sequence[str],
                 processed: _dt.datetime | str | None = None) -> DataFrame:
    """Rows an upsert really writes, tagged ``insert`` or ``update``.

    Match on plain ``=`` over the keys (a NULL key never matches, so it is
    inserted).  A matched row is updated only if some non-key column differs
    null-safely; a table of keys only is never updated.
    """
    if not key_columns:
        raise ValueError("key columns must not be empty")
    keys = list(key_columns)
    cols = [c for c in source.columns if c != PROCESSED_COLUMN]
    values = compare_columns(source.select(*cols), keys)
    t = target.select(*keys, *values, F.lit(True).alias("__matched"))
    t = t.select(*keys, "__matched", *[F.col(c).alias(f"__t_{c}") for c in values])
    joined = source.select(*cols).join(t, keys, "left")
    matched = F.coalesce(F.col("__matched"), F.lit(False))
    if values:
        differs = reduce(lambda acc, c: acc | ~F.col(c).eqNullSafe(F.col(f"__t_{c}")), values[1:],
                         ~F.col(values[0]).eqNullSafe(F.col(f"__t_{values[0]}")))
        op = F.when(~matched, F.lit(INSERT)).when(differs, F.lit(UPDATE))
    else:
        op = F.when(~matched, F.lit(INSERT))
    return (joined.withColumn(OPERATION, op)
            .where(F.col(OPERATION).isNotNull())
            .select(*cols, F.lit(None).cast("timestamp").alias(PROCESSED_COLUMN), OPERATION)
            .withColumn(PROCESSED_COLUMN, processed_at(processed)))


def apply_scd1(target: DataFrame, changes: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    keys = list(key_columns)
    untouched = target.join(changes.where(F.col(OPERATION) == UPDATE).select(*keys), keys, "left_anti")
    return untouched.unionByName(changes.select(*target.columns))


def scd1_upsert(target: DataFrame, source: DataFrame, key_columns: Sequence[str],
                processed: _dt.datetime | str | None = None) -> DataFrame:
    """New table content after an upsert; unchanged rows keep their old processing time.

    The change set (at most the size of the input) is stored once since it is
    read twice.
    """
    changes = materialize(scd1_changes(target, source, key_columns, processed))
    return apply_scd1(target, changes, key_columns)


def scd1_insert(target: DataFrame, source: DataFrame, processed: _dt.datetime | str | None = None) -> DataFrame:
    """Append without dedupe."""
    new = source.drop(PROCESSED_COLUMN).withColumn(PROCESSED_COLUMN, processed_at(processed))
    return target.unionByName(new.select(*target.columns))


def scd1_rewrite(source: DataFrame, processed: _dt.datetime | str | None = None) -> DataFrame:
    """Replace the whole content."""
    return source.drop(PROCESSED_COLUMN).withColumn(PROCESSED_COLUMN, processed_at(processed))
