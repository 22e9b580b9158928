"""Calendar attributes of a date column (ISO week, Monday = 1 weekday)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_fields(date_col: str = "calendar_dt") -> list[Column]:
    d = F.col(date_col)
    weekday = (F.weekday(d) + 1).cast("int")
    return [
        d.alias("calendar_dt"),
        F.dayofmonth(d).cast("int").alias("monthday"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("int").alias("quarter"),
        F.year(d).cast("int").alias("year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        weekday.alias("weekday"),
        F.date_format(d, "EEEE").alias("day_name"),
        (weekday > 5).alias("is_weekend"),
    ]
