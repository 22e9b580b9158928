"""Write-mode dispatch for SCD1 and SCD2 tables of a ``CatalogTables`` store.

``insert`` appends, ``rewrite`` replaces the whole content, ``upsert`` merges a
change set (by the provider's MERGE where it has one; else only the affected
partitions are rewritten).  Every call validates the mode and that the output exists; SCD2
calls also validate the keys, the uniqueness of the input keys and, for
``upsert``, that the built columns equal the table's.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.functions.columns import PROCESSED_COLUMN, processed_at
from tidemark.operators import history as h
from tidemark.operators import merge as m
from tidemark.sources.tables import CatalogTables, scd1_merge_clauses, scd2_merge_clauses


def write_scd1(tables: CatalogTables, name: str, rows: DataFrame, key_columns: Sequence[str], mode: str,
               processed: _dt.datetime | str | None = None) -> None:
    m.validate_write_mode(mode)
    tables.require(name)
    keys = list(key_columns)
    if mode == "insert":
        tables.append(name, rows.drop(PROCESSED_COLUMN).withColumn(PROCESSED_COLUMN, processed_at(processed)))
    elif mode == "rewrite":
        tables.replace(name, m.scd1_rewrite(rows, processed))
    else:
        m.validate_no_duplicate_keys(rows, keys)
        current = tables.read_matching(name, rows, keys)
        changes = m.scd1_changes(current, rows, keys, processed)
        tables.merge(name, changes.select(*current.columns, m.OPERATION), lambda t, c: m.apply_scd1(t, c, keys), keys=keys,
                     clauses=lambda t: scd1_merge_clauses(t, current.columns, keys))


def write_scd2(tables: CatalogTables, name: str, rows: DataFrame, business_key: str, key_columns: Sequence[str],
               mode: str, rebuild: str = "no", processed: _dt.datetime | str | None = None,
               bucket_seconds: float | None = None) -> None:
    m.validate_write_mode(mode)
    h.validate_key_columns(business_key, key_columns)
    h.validate_unique_keys(rows, key_columns)
    tables.require(name)
    keys = list(key_columns)
    if mode in ("insert", "rewrite"):
        versions = h.scd2_versions(rows, business_key, keys, processed)
        if mode == "insert":
            tables.append(name, versions)
        else:
            tables.replace(name, versions)
        return
    h.validate_rebuild_mode(rebuild)
    current = tables.read(name)
    h.validate_columns([*[c for c in rows.columns if c not in h.TECHNICAL], h.VALID_TO, PROCESSED_COLUMN],
                       current.columns, name)
    changes = h.scd2_changes(current, rows, business_key, keys, rebuild, processed, bucket_seconds=bucket_seconds)
    tables.merge(name, changes, lambda t, c: h.apply_changes(t, c, keys), keys=keys,
                 clauses=lambda t: scd2_merge_clauses(t, current.columns, keys))
