"""Exact ``lag`` and carry-forward per key that never put one whole key in one task.

``Window.partitionBy(key)`` sends every row of a key to a single task; a key that
holds a third of the table would then be sorted and buffered by one executor.
Here rows are windowed per ``(key, bucket)``, where ``bucket`` is a coarse slice
of the order column (a time range by default).  Only the first row of a bucket
needs a value from outside it: that value comes from a per-bucket summary
(one row per key and bucket, built with a partial aggregate) shifted by one
bucket.  The big side is shuffled once on ``(key, bucket)``; the summary is
small and its own windows run per key over at most ``#buckets`` rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "__bucket"

# Default width of an ordering bucket: 31 days.  Daily snapshots give at most
# 31 rows per key and bucket; a hot key is spread over one task per month.
DEFAULT_BUCKET_SECONDS = 31 * 24 * 3600


def bucket_column(df: DataFrame, order_col: str, width: float | None = None) -> Column:
    """A coarse, monotone slice of ``order_col`` (time range or numeric range).

    Seconds since the epoch are taken without any time-zone conversion
    (``timestamp_ntz`` is measured against an NTZ epoch), so the bucket never
    runs backwards inside a daylight-saving gap of the session zone.
    """
    dtype = df.schema[order_col].dataType
    c = F.col(order_col)
    seconds = int(width or DEFAULT_BUCKET_SECONDS)
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.floor(F.timestamp_diff("SECOND", epoch, c) / F.lit(seconds))
    if isinstance(dtype, T.TimestampType):
        return F.floor(F.unix_seconds(c) / F.lit(seconds))
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(c).cast("bigint") * F.lit(86400) / F.lit(seconds))
    if isinstance(dtype, T.NumericType):
        return F.floor(c / F.lit(width or 1024))
    raise TypeError(f"cannot bucket order column {order_col} of type {dtype.simpleString()}")


def add_bucket(df: DataFrame, keys: Sequence[str], order_col: str, bucket: Column | None = None,
               width: float | None = None) -> DataFrame:
    """Add the ordering bucket; rows with a NULL key all share bucket 0.

    A NULL key cannot receive a carry through the equality join, so its rows
    are kept in one bucket where the window alone is exact.
    """
    b = bucket if bucket is not None else bucket_column(df, order_col, width)
    any_null = reduce(lambda acc, k: acc | F.col(k).isNull(), keys[1:], F.col(keys[0]).isNull())
    return df.withColumn(BUCKET, F.when(any_null, F.lit(0)).otherwise(b))


def _carried(rows: DataFrame, keys: Sequence[str], summary: DataFrame) -> DataFrame:
    """Join a (key, bucket) summary's ``__carry`` back to the rows.

    Plain equality keeps the (key, bucket) partitioning of a window, so the
    big side is not shuffled again (NULL keys sit in bucket 0 and need none).
    """
    carry = (summary.where(F.col("__carry").isNotNull())
             .select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(BUCKET).alias("__k_bucket"), "__carry"))
    match = reduce(lambda acc, k: acc & (F.col(k) == F.col(f"__k_{k}")), keys, F.col(BUCKET) == F.col("__k_bucket"))
    return rows.join(carry, match, "left").drop("__k_bucket", *[f"__k_{k}" for k in keys])


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str,
                  values: Mapping[str, str], bucket: Column | None = None) -> DataFrame:
    """Add ``out = lag(src)`` per key in ``order`` for each ``out: src``; exact.

    Per (key, bucket) the last row, a partial aggregate of the input, shifted by
    one non-empty bucket, is what the next bucket's first row needs.
    """
    order = [order] if isinstance(order, str) else list(order)
    if not keys:
        raise ValueError("at least one key column is required")
    if not order:
        raise ValueError("at least one order column is required")
    keep_bucket = BUCKET in df.columns
    base = df if keep_bucket else add_bucket(df, keys, order[0], bucket)
    sources = list(dict.fromkeys(values.values()))
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    rows = base.withColumn("__edge", F.lag(F.lit(True)).over(inside).isNull())
    for out, src in values.items():
        rows = rows.withColumn(out, F.lag(src).over(inside))
    last = F.max_by(F.struct(*[F.col(c).alias(c) for c in sources]), F.struct(*[F.col(c) for c in order]))
    across = Window.partitionBy(*keys).orderBy(BUCKET)
    summary = base.groupBy(*keys, BUCKET).agg(last.alias("__last")).withColumn("__carry", F.lag("__last").over(across))
    rows = _carried(rows, keys, summary)
    for out, src in values.items():
        rows = rows.withColumn(out, F.when(F.col("__edge"), F.col(f"__carry.{src}")).otherwise(F.col(out)))
    return rows.drop("__edge", "__carry", *([] if keep_bucket else [BUCKET]))


def with_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                bucket: Column | None = None) -> DataFrame:
    """Add ``out``: the last non-NULL ``value`` of the key up to the row, itself included.

    ``order`` begins with the column that is bucketed.  Inside a bucket it is a window; what
    a bucket starts with is the last value of the buckets before it, one row per key and
    bucket.  Rows are never copied and shuffled once.
    """
    base = add_bucket(df, keys, order[0], bucket)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = base.withColumn(out, F.last(value, ignorenulls=True).over(inside))
    position = F.when(F.col(value).isNotNull(), F.struct(*[F.col(c) for c in order]))
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    summary = (base.groupBy(*keys, BUCKET).agg(F.max_by(value, position).alias("__last"))
               .withColumn("__carry", F.last("__last", ignorenulls=True).over(before)))
    return _carried(rows, keys, summary).withColumn(out, F.coalesce(out, "__carry")).drop("__carry", BUCKET)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` per key, as a partial aggregate.

    Equivalent to ``row_number() over (partition by keys order by order desc) = 1``
    for unique ``(keys, order)``, but combined map-side, so a hot key costs one
    row per task instead of one task for the whole key.
    """
    others = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("__row"))
    return latest.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*df.columns)
