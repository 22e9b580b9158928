"""Incremental shapes built from the primitives: deltas, re-aggregation,
disappearance detection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.history import VALID_FROM, VALID_TO
from tidemark.operators.ordered import latest_per_key, with_previous


def day_over_day(df: DataFrame, key: str, date: str, measures: Sequence[str],
                 suffix: str = "_delta") -> DataFrame:
    """``m - lag(m)`` per key in date order for each measure; NULL on a key's first day."""
    prev = {f"__prev_{m}": m for m in measures}
    out = with_previous(df, [key], [date], prev)
    for m in measures:
        out = out.withColumn(f"{m}{suffix}", F.col(m) - F.col(f"__prev_{m}"))
    return out.drop(*prev)


def incremental_delta(existing: DataFrame, slice_: DataFrame, key: str, date: str,
                      measures: Sequence[str], delta_names: Sequence[str] | None = None,
                      refresh_next: bool = False) -> DataFrame:
    """Deltas for the slice rows only, seeded by the last already-loaded row.

    For every key the last row of ``existing`` before the key's first slice date
    is added as a helper, the lag difference is taken, and only slice rows are
    returned.  The helper row is picked with a partial aggregate and filtered
    out by a carried flag (no second join).

    With ``refresh_next`` the stored rows after the key's first slice date also
    take part, and a stored row whose predecessor is now a slice row (the day
    after a late day) is returned too, with its delta recomputed.
    """
    names = list(delta_names or [f"{m}_delta" for m in measures])
    cols = slice_.columns
    boundary = slice_.groupBy(key).agg(F.min(date).alias("__boundary"))
    stored = existing.select(*cols).join(boundary, key, "inner")
    before = stored.where(F.col(date) < F.col("__boundary")).drop("__boundary")
    helper = latest_per_key(before, [key], date).withColumn("__in_slice", F.lit(False))
    united = slice_.withColumn("__in_slice", F.lit(True)).unionByName(helper)
    if refresh_next:
        slice_keys = slice_.select(key, date).withColumn("__hit", F.lit(True))
        after = (stored.where(F.col(date) >= F.col("__boundary")).drop("__boundary")
                 .join(slice_keys, [key, date], "left_anti")
                 .withColumn("__in_slice", F.lit(False)))
        united = united.unionByName(after)
    prev = {f"__prev_{m}": m for m in measures}
    prev["__prev_in_slice"] = "__in_slice"
    out = with_previous(united, [key], [date], prev)
    for m, n in zip(measures, names):
        out = out.withColumn(n, F.col(m) - F.col(f"__prev_{m}"))
    keep = F.col("__in_slice")
    if refresh_next:
        keep = keep | F.coalesce(F.col("__prev_in_slice"), F.lit(False))
    return out.where(keep).drop("__in_slice", *prev)


# ------------------------------------------------------------- state of the last rows

def last_rows(df: DataFrame, key: str, date: str, measures: Sequence[str]) -> DataFrame:
    """The state an incremental delta goes on from: the last row of each key."""
    return latest_per_key(df.select(key, date, *measures), [key], date)


def late_keys(state: DataFrame, slice_: DataFrame, key: str, date: str) -> DataFrame:
    """Keys with a slice row that is not after their last loaded one; the state does not
    hold the row before it, so these go through ``incremental_delta``."""
    last = state.select(key, F.col(date).alias("__last"))
    return slice_.groupBy(key).agg(F.min(date).alias("__first")).join(last, key).where(F.col("__first") <= F.col("__last")).select(key)


def delta_from_state(state: DataFrame, slice_: DataFrame, key: str, date: str, measures: Sequence[str],
                     delta_names: Sequence[str] | None = None) -> DataFrame:
    """Deltas of slice rows that come after their key's last loaded row, which ``state`` holds
    (``last_rows``).  The loaded table itself is not read."""
    names = list(delta_names or [f"{m}_delta" for m in measures])
    touched = slice_.select(key).distinct()
    seeds = state.join(touched, key, "left_semi").withColumn("__loaded", F.lit(True))
    both = slice_.withColumn("__loaded", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    out = with_previous(both, [key], [date], {f"__prev_{m}": m for m in measures}).where(~F.col("__loaded"))
    for m, n in zip(measures, names):
        out = out.withColumn(n, F.col(m) - F.col(f"__prev_{m}"))
    return out.select(*slice_.columns, *names)


# ------------------------------------------------------------------ totals of groups

def group_totals(rows: DataFrame, group_keys: Sequence[str], sums: Sequence[str], sign: Column | int = 1) -> DataFrame:
    """Totals that contributions can be taken off again: ``n_rows``, and for each summed
    column ``{c}_sum`` with ``{c}_n``, the number of its values (no value: the sum is NULL)."""
    sign = F.lit(sign) if isinstance(sign, int) else sign
    aggregates = [F.sum(sign).cast("bigint").alias("n_rows")]
    for c in sums:
        aggregates += [F.coalesce(F.sum(F.col(c) * sign), F.lit(0).cast(rows.schema[c].dataType)).alias(f"{c}_sum"),
                       F.coalesce(F.sum(F.when(F.col(c).isNotNull(), sign)), F.lit(0)).cast("bigint").alias(f"{c}_n")]
    return rows.groupBy(*group_keys).agg(*aggregates)


def retract_and_add(totals: DataFrame, added: DataFrame, retracted: DataFrame, group_keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """New ``group_totals`` of the groups that rows come to or leave.

    ``retracted`` are the rows as they counted so far, ``added`` as they count now (a
    changed row is in both, perhaps in different groups).  Only these and the stored totals are
    read, never the rows of the groups.  A group without rows comes back with ``n_rows`` 0.
    """
    keys = list(group_keys)
    both = (added.select(*keys, *sums, F.lit(1).alias("__sign"))
            .unionByName(retracted.select(*keys, *sums, F.lit(-1).alias("__sign"))))
    moved = group_totals(both, keys, sums, F.col("__sign"))
    values = [c for c in moved.columns if c not in keys]
    stored = totals.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"__old_{c}") for c in values])
    same = reduce(lambda acc, x: acc & x, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return moved.join(stored, same, "left").select(*keys, *[(F.col(c) + F.coalesce(f"__old_{c}", F.lit(0))).cast(moved.schema[c].dataType).alias(c) for c in values])


def sum_or_null(column: str) -> Column:
    """The sum a plain aggregate gives, out of ``group_totals``."""
    return F.when(F.col(f"{column}_n") > 0, F.col(f"{column}_sum"))


def _in_range_of(df: DataFrame, column: str, rows: DataFrame) -> DataFrame:
    """``df`` cut to the range of ``column`` in ``rows``: one row of bounds, as a literal
    filter that prunes partitions.  The caller's own join does the exact test."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.where(F.lit(False))
    kind = df.schema[column].dataType
    return df.where(F.col(column).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))


def reaggregate_affected(base: DataFrame, slice_: DataFrame, group_keys: Sequence[str],
                         aggregates: Sequence[Column], prune_on: str | None = None) -> DataFrame:
    """Re-aggregate, from ``base``, only the groups that occur in ``slice_``.

    ``prune_on`` names a group key that is also a partition column of
    ``base`` (e.g. the day): only the partitions in the slice's range are read.
    Where sums and counts are enough, ``retract_and_add`` does not read ``base`` at all.
    """
    keys = list(group_keys)
    affected = slice_.select(*keys).distinct()
    if prune_on:
        base = _in_range_of(base, prune_on, slice_)
    return base.join(affected, keys, "left_semi").groupBy(*keys).agg(*aggregates)


# ------------------------------------------------------------------ disappearance

def presence(rows: DataFrame, entity: str, date: str) -> DataFrame:
    """On which days each entity was seen: (entity, ``word``, ``days``), a row for every 64 days,
    ``days`` a bitmap of them.  Rows of this form are merged by ``merge_presence``."""
    day = F.unix_date(F.col(date).cast("date"))
    return (rows.select(entity, F.floor(day / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(64))).alias("bit"))
            .groupBy(entity, "word").agg(F.bit_or("bit").alias("days")))


def merge_presence(stored: DataFrame, more: DataFrame, entity: str) -> DataFrame:
    return stored.unionByName(more).groupBy(entity, "word").agg(F.bit_or("days").alias("days"))


def disappeared(
    slice_: DataFrame,
    seen: DataFrame,
    links: DataFrame,
    hubs: DataFrame,
    versions: DataFrame,
    entity: str,
    parent: str,
    date: str,
    created_at: str = "created_at",
    available: str = "is_available",
    time_type: str = "timestamp_ntz",
) -> DataFrame:
    """Unavailable copies of the open versions of entities missing from a slice.

    A parent present in the slice is dated to its first slice day.  Known
    entities of that parent (``links``) that are absent from every snapshot
    date of the slice, that already existed by that day (``hubs``) and whose
    open version is still available get a copy of that version with
    ``is_available = false`` and ``valid_from`` = that day.

    ``seen`` is the ``presence`` of all snapshots (the slice's included): the slice's days
    are tested as bits, 64 a word, and no snapshot is read.
    """
    parents = slice_.groupBy(parent).agg(F.min(F.col(date).cast(time_type)).alias("__missing_from"))
    wanted = presence(slice_.select(F.lit(0).alias("__all"), date).distinct(), "__all", date).select("word", F.col("days").alias("__wanted"))
    present = (seen.join(wanted, "word").where(F.col("days").bitwiseAND(F.col("__wanted")) != 0).select(entity).distinct())
    known = (links.select(entity, parent)
             .join(parents, parent, "inner")
             .join(present, entity, "left_anti")
             .join(hubs.select(entity, created_at), entity, "inner")
             .where(F.col(created_at) <= F.col("__missing_from"))
             .select(entity, "__missing_from"))
    current = versions.where(F.col(VALID_TO).isNull() & F.col(available))
    value_cols = [c for c in versions.columns if c not in (entity, VALID_FROM, VALID_TO, available, "processed_dttm")]
    return (known.join(current, entity, "inner")
            .select(entity, *value_cols, F.lit(False).alias(available),
                    F.col("__missing_from").alias(VALID_FROM)))
