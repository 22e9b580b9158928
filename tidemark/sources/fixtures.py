"""Daily snapshots derived from the driver's ``events`` table.

``snapshot``: one row per ``(user_id, calendar_dt)``; ``attr`` is the event type
of the day's last event (ties broken by ``event_id``), ``v`` the day's value in
cents, ``n`` the number of events.  Stand-ins: a user is an entity, the cohort
``user_id % 10`` its parent, ``attr`` its versioned attribute / category, ``v``
its counter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: number of cohorts (parents) the users are spread over.
COHORTS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def snapshot(events: DataFrame, *more: F.Column) -> DataFrame:
    """The snapshot; ``more`` are further aggregates of the day's events, taken in the same pass."""
    return (events
            .groupBy("user_id", F.to_date("ts").alias("calendar_dt"))
            .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("attr"),
                 F.sum(F.round(F.col("value") * 100)).cast("bigint").alias("v"),
                 F.count(F.lit(1)).alias("n"), *more))


def day_number(date_col: str = "calendar_dt") -> F.Column:
    """Day of the 30-day event window: 2024-01-01 is day 1."""
    return F.datediff(F.col(date_col), F.lit("2024-01-01").cast("date")) + 1


def day_start(day: int) -> F.Column:
    """Start of day ``day`` of the window as a ``timestamp_ntz`` literal."""
    import datetime as _dt

    start = _dt.datetime(2024, 1, 1) + _dt.timedelta(days=day - 1)
    return F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def ts_in_days(first: int, last: int, ts_col: str = "ts") -> F.Column:
    """``ts`` within days ``first..last`` as a range test Parquet can push down."""
    c = F.col(ts_col)
    return (c >= day_start(first)) & (c < day_start(last + 1))


def snapshot_versions_input(snap: DataFrame) -> DataFrame:
    """SCD2 input shape of a snapshot: entity, attribute, validity start."""
    return snap.select("user_id", "attr", F.col("calendar_dt").cast("timestamp_ntz").alias("valid_from_dttm"))


def cohort(col: str = "user_id") -> F.Column:
    return (F.col(col) % COHORTS).alias("cohort_id")


def raw_day(events: DataFrame, day: int) -> dict[str, DataFrame]:
    """Raw envelopes of one ingestion day derived from ``events``.

    Videos are users (channel = cohort), categories are event types; counters
    are cumulative up to the day, the title carries the day's last event type,
    so titles change (new versions) and users without events that day vanish
    from the snapshot (disappearance) and may come back later.
    """
    from tidemark.sources.raw import to_envelopes

    date = (F.lit("2024-01-01").cast("date") + F.lit(day - 1)).cast("string")
    today = snapshot(events.where(ts_in_days(day, day)))
    upto = events.where(F.col("ts") < day_start(day + 1))
    totals = upto.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("views"),
        F.count_if(F.col("event_type") == "purchase").alias("likes"),
        F.count_if(F.col("event_type") == "click").alias("comments"),
        F.min("ts").alias("first_ts"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    v = today.join(totals, "user_id").withColumn("cohort", F.col("user_id") % COHORTS)
    video = F.struct(
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("id"),
        F.struct(iso(F.col("first_ts")).alias("publishedAt"),
                 F.concat(F.lit("c"), F.col("cohort").cast("string")).alias("channelId"),
                 F.concat(F.lit("video "), F.col("user_id").cast("string"), F.lit(" "), F.col("attr")).alias("title"),
                 F.col("attr").alias("description"),
                 F.col("attr").alias("categoryId"),
                 F.lit("none").alias("liveBroadcastContent"),
                 F.lit("en").alias("defaultLanguage")).alias("snippet"),
        F.struct(F.concat(F.lit("PT"), F.col("n").cast("string"), F.lit("M"),
                          F.pmod(F.col("v"), F.lit(60)).cast("string"), F.lit("S")).alias("duration"),
                 F.lit("2d").alias("dimension"),
                 F.when(F.col("n") > 3, "hd").otherwise("sd").alias("definition"),
                 F.when(F.col("n") % 2 == 0, "true").otherwise("false").alias("caption"),
                 F.lit("true").alias("licensedContent"),
                 F.when(F.col("attr") == "error", F.create_map(F.lit("ytRating"), F.lit("ytAgeRestricted")))
                 .otherwise(F.create_map().cast("map<string,string>")).alias("contentRating"),
                 F.lit("rectangular").alias("projection")).alias("contentDetails"),
        F.struct(F.col("views").cast("string").alias("viewCount"), F.col("likes").cast("string").alias("likeCount"),
                 F.lit("0").alias("favoriteCount"),
                 F.col("comments").cast("string").alias("commentCount")).alias("statistics"),
        F.struct(F.lit("public").alias("privacyStatus"), F.lit("processed").alias("uploadStatus")).alias("status"))
    videos = to_envelopes(v.withColumn("ingestion_date", date)
                          .withColumn("channel_id", F.concat(F.lit("c"), F.col("cohort").cast("string"))),
                          ["ingestion_date", "channel_id"], video, "user_id")

    seen = (upto.groupBy((F.col("user_id") % COHORTS).alias("cohort"))
            .agg(F.countDistinct("user_id").alias("subs")))
    c = v.select("cohort").distinct().join(seen, "cohort")
    channel = F.struct(
        F.concat(F.lit("c"), F.col("cohort").cast("string")).alias("id"),
        F.struct(F.concat(F.lit("channel "), F.col("cohort").cast("string"),
                          F.when((F.col("cohort") == 1) & F.lit(day >= 2), F.lit(" renamed")).otherwise(F.lit("")))
                 .alias("title"),
                 F.lit("synthetic channel").alias("description"),
                 F.concat(F.lit("@c"), F.col("cohort").cast("string")).alias("customUrl"),
                 F.lit("2023-12-01T00:00:00Z").alias("publishedAt"),
                 F.lit("US").alias("country")).alias("snippet"),
        F.struct(F.col("subs").cast("string").alias("subscriberCount")).alias("statistics"))
    channels = to_envelopes(c.withColumn("ingestion_date", date)
                            .withColumn("channel_id", F.concat(F.lit("c"), F.col("cohort").cast("string"))),
                            ["ingestion_date", "channel_id"], channel, "cohort")

    t = events.where(ts_in_days(day, day)).select("event_type").distinct() \
        .withColumn("rank", F.xxhash64("event_type"))
    category = F.struct(F.col("event_type").alias("id"),
                        F.struct(F.upper("event_type").alias("title"),
                                 (F.col("event_type") != "error").alias("assignable")).alias("snippet"))
    categories = to_envelopes(t.withColumn("ingestion_date", date).withColumn("one", F.lit(0)),
                              ["ingestion_date"], category, "one")
    return {"videos": videos, "channels": channels, "categories": categories}


def write_raw_day(events: DataFrame, day: int, root: str) -> None:
    from tidemark.sources.raw import write_envelopes

    parts = raw_day(events, day)
    write_envelopes(parts["videos"], f"{root}/videos", ["ingestion_date", "channel_id"])
    write_envelopes(parts["channels"], f"{root}/channels", ["ingestion_date", "channel_id"])
    write_envelopes(parts["categories"], f"{root}/categories", ["ingestion_date"])
