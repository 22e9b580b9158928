"""Inputs of the registered queries, derived from the driver's tables.

Every scenario reads the given parquet tables (mostly ``events`` through the
daily snapshot), so its work grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.history import VALID_FROM, build_versions
from tidemark.sources import fixtures as fx
from tidemark.session import materialize

# Fixed values of the scenarios (days of the 30-day event window).
LATE_DAYS = (8, 12)          # days held back and loaded late
LATE_TARGET_LAST_DAY = 30    # target of the late-days scenario: days 1..30 minus the late days
IN_ORDER_SPLIT_DAY = 20      # in-order load: days <= 20, then days > 20
LINK_SPLIT_DAY = 10          # links of days 1..10 exist, later days bring new ones
SCD1_TARGET_DAYS = (1, 18)
SCD1_SOURCE_DAYS = (14, 30)
WATERMARK = "2024-01-20 00:00:00"
DISAPPEAR_DAY = 29
DELTA_SPLIT_DAY = 20
REAGGREGATE_AFTER_DAY = 28
LATE_DELTA_DAY = 15          # loaded after every other day
HUB_SPLIT_DATE = "1996-01-01"
FIXED_PROCESSED = "2024-02-01 00:00:00"


class Scenario:
    """Lazily derived inputs over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._snap: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return fx.table(self.spark, self.sf_dir, name)

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    def snap(self, where: Column | None = None) -> DataFrame:
        """Daily snapshot, optionally restricted by ``where`` (on ``day``).

        The snapshot stands for a stored bronze table: it is derived from
        ``events`` once per scenario and stored under the checkpoint folder;
        every branch of a query then reads (and filters) the stored rows.
        """
        if self._snap is None:
            self._snap = materialize(fx.snapshot(self.events).withColumn("day", fx.day_number()))
        return self._snap if where is None else self._snap.where(where)

    def versions_input(self, where: Column | None = None, available: bool = False) -> DataFrame:
        out = fx.snapshot_versions_input(self.snap(where))
        if available:
            out = out.withColumn("is_available", F.lit(True)).select("user_id", "attr", "is_available", VALID_FROM)
        return out

    def versions(self, where: Column | None = None, available: bool = False) -> DataFrame:
        return build_versions(self.versions_input(where, available), "user_id")

    def pair_counts(self, first_day: int, last_day: int) -> DataFrame:
        e = self.events.where(fx.ts_in_days(first_day, last_day))
        return e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("cnt"))


def days(first: int, last: int) -> Column:
    """Snapshot rows of days ``first..last``."""
    return (F.col("day") >= first) & (F.col("day") <= last)


def from_day(first: int) -> Column:
    return F.col("day") >= first
