"""Generated calendar source (one row per day, both ends included)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_fields

# Default span of the calendar dimension.
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2035-01-01"


def calendar_days(spark: SparkSession, start: str | Column = CALENDAR_START,
                  end: str | Column = CALENDAR_END) -> DataFrame:
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    return spark.range(1).select(F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias("calendar_dt"))


def calendar_dimension(days: DataFrame, date_col: str = "calendar_dt") -> DataFrame:
    return days.select(*calendar_fields(date_col))


def calendar_between(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Calendar over bounds computed by Spark (a one-row DataFrame)."""
    days = bounds.select(F.explode(F.sequence(F.col(start_col), F.col(end_col), F.expr("interval 1 day")))
                         .alias("calendar_dt"))
    return calendar_dimension(days)
