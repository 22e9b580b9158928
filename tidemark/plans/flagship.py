"""The flagship query: snapshot -> versions -> as-of join -> day-over-day delta."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.history import VALID_FROM, VALID_TO
from tidemark.operators.joins import as_of_join
from tidemark.operators.shapes import day_over_day
from tidemark.plans.scenarios import Scenario


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Scenario(spark, sf_dir)
    stats = day_over_day(s.snap().select("user_id", "calendar_dt", "v"), "user_id", "calendar_dt", ["v"])
    versions = s.versions().select("user_id", "attr", VALID_FROM, VALID_TO)
    return as_of_join(stats, versions, "user_id", "calendar_dt").select(
        "user_id", "calendar_dt", "attr", "v", "v_delta")
