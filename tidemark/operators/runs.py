"""Runs of equal rows per key, found with one shuffle of the rows.

A run is a maximal stretch of a key's rows, in order, with one hash.  Rows are
windowed per ``(key, bucket)``; a bucket is then described by four values: the hash
and the start of its first row, the hash of its last row, and the start of its second
run.  That summary is all a neighbour needs, so two small windows over the summaries of
a key (one row a bucket) tell every bucket which hash precedes it and when the next run
after it starts.  Joined back on ``(key, bucket)`` this gives, in one pass, which rows
start a run and when the run ends.

Both readers of the windowed rows (the summary and the join) read the same shuffle:
the summary orders its last row by all columns, so that Spark prunes none in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import BUCKET

HASH, KEEP, NEXT, OUTSIDE = "__hash", "__keep", "__next", "__outside"


def _all_columns(df: DataFrame, first: Sequence[str]) -> Column:
    """Every column that can be ordered, ``first`` ones first."""
    def ordered(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.ArrayType):
            return ordered(dtype.elementType)
        if isinstance(dtype, T.StructType):
            return all(ordered(f.dataType) for f in dtype.fields)
        return not isinstance(dtype, (T.MapType, T.VariantType))

    rest = [f.name for f in df.schema.fields if f.name not in first and ordered(f.dataType)]
    return F.struct(*[F.col(c) for c in (*first, *rest)])


def with_runs(df: DataFrame, keys: Sequence[str], start: str, order: Sequence[tuple[str, bool]],
              member: str | None = None, before_scope: str | None = None) -> DataFrame:
    """Add ``__keep`` (the row starts a run) and ``__next`` (``start`` of the key's next run).

    ``df`` has ``__bucket`` (a coarse slice of ``start``) and ``__hash``; ``order`` sorts the
    rows of a bucket, as (column, descending), and begins with ``start``.  Rows whose boolean ``member`` is false take
    no part: ``__keep`` is false for them.  ``before_scope`` is a boolean that holds for rows
    in front of the key's scope; of the buckets that have such rows only the last one takes
    part, and the rows of the earlier ones get ``__outside``.
    """
    keys = list(keys)
    takes_part = F.col(member) if member else F.lit(True)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*[F.desc(c) if down else F.asc(c) for c, down in order])
    if member:
        previous = F.last(F.when(takes_part, F.col(HASH)), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    else:
        previous = F.lag(HASH).over(inside)
    rows = df.select("*", previous.alias("__previous"))
    first = takes_part & F.col("__previous").isNull()
    starts = takes_part & F.col("__previous").isNotNull() & (F.col(HASH) != F.col("__previous"))

    described = [F.max(F.when(first, F.col(HASH))).alias("__first_hash"), F.min(F.when(first, F.col(start))).alias("__first_start"),
                 F.max_by(HASH, F.when(takes_part, _all_columns(df, [c for c, down in order if not down]))).alias("__last_hash"),
                 F.min(F.when(starts, F.col(start))).alias("__second_start"), *([F.max(before_scope).alias("__pre")] if before_scope else [])]
    summary = rows.groupBy(*keys, BUCKET).agg(*described).where(F.col("__first_hash").isNotNull())
    if before_scope:
        last_pre = F.max(F.when(F.col("__pre"), F.col(BUCKET))).over(Window.partitionBy(*keys))
        summary = summary.select("*", last_pre.alias("__last_pre")).where(~F.col("__pre") | (F.col(BUCKET) == F.col("__last_pre")))
    by_key = [F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)]
    before = F.lag("__last_hash").over(Window.partitionBy(*keys).orderBy(BUCKET))
    back = Window.partitionBy(*[f"__k_{i}" for i in range(len(keys))]).orderBy(F.desc("__k_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    new_run = F.col("__before").isNull() | (F.col("__before") != F.col("__first_hash"))
    run = F.when(new_run, F.col("__first_start")).otherwise(F.col("__second_start"))
    carry = (summary.select(*by_key, F.col(BUCKET).alias("__k_bucket"), "__first_hash", "__first_start", "__second_start", before.alias("__before"))
             .select(*[f"__k_{i}" for i in range(len(keys))], "__k_bucket", "__before", F.last(run, ignorenulls=True).over(back).alias("__after")))

    later = Window.partitionBy(*keys, BUCKET).orderBy(*[F.asc(c) if down else F.desc(c) for c, down in order]).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", F.last(F.when(starts, F.col(start)), ignorenulls=True).over(later).alias("__later"))
    # Rows with a NULL key all share one bucket (see ``add_bucket``): none meets a carry or needs one.
    match = F.col(BUCKET) == F.col("__k_bucket")
    for i, k in enumerate(keys):
        match = match & (F.col(k) == F.col(f"__k_{i}"))
    outside = F.col(before_scope) & F.col("__k_bucket").isNull() if before_scope else F.lit(False)
    opens = F.col("__before").isNull() | (F.col("__before") != F.col(HASH))
    return rows.join(carry, match, "left").select(
        *[F.col(c) for c in df.columns], outside.alias(OUTSIDE), (~outside & F.when(first, opens).otherwise(starts)).alias(KEEP),
        F.coalesce("__later", "__after").alias(NEXT))
