"""The layered tables as registered queries: one for each builder of ``layers``.

Raw envelopes of all thirty days are derived from ``events`` (videos are users,
channels their cohorts, categories event types), parsed by the library's reader
and passed through the same builders the warehouse runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.history import build_versions
from tidemark.plans import layers as L
from tidemark.sources import fixtures as fx
from tidemark.sources.raw import parse_envelopes, to_envelopes

SPLIT = "2024-01-10"      # keys of days up to here are known, later days are the slice
LAST_DAY = "2024-01-30"   # the slice of the disappearance
TOTALS_AFTER = "2024-01-28"


class Raw:
    """Parsed raw items of every day."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        events = fx.table(spark, sf_dir, "events")
        days = fx.snapshot(events, F.count_if(F.col("event_type") == "purchase").alias("p"),
                           F.count_if(F.col("event_type") == "click").alias("c"), F.min("ts").alias("t0"))
        so_far = Window.partitionBy("user_id").orderBy("calendar_dt")
        total = lambda c: F.sum(c).over(so_far).cast("string")
        self.days = days.where(F.col("user_id").isNotNull() & F.col("calendar_dt").isNotNull()).select(
            "*", total("n").alias("views"), total("p").alias("likes"), total("c").alias("comments"), F.min("t0").over(so_far).alias("first_ts"),
            F.concat(F.lit("c"), (F.col("user_id") % fx.COHORTS).cast("string")).alias("channel_id"), F.col("calendar_dt").cast("string").alias("ingestion_date"))

    def _items(self, rows: DataFrame, keys: list[str], item, order: str, schema) -> DataFrame:
        return parse_envelopes(to_envelopes(rows, keys, item, order), "envelope", schema, keep=["ingestion_date"])

    def videos(self) -> DataFrame:
        d, name = self.days, F.concat(F.lit("v"), F.col("user_id").cast("string"))
        minutes = F.concat(F.lit("PT"), F.col("n").cast("string"), F.lit("M"), F.pmod("v", F.lit(60)).cast("string"), F.lit("S"))
        rating = F.when(F.col("attr") == "error", F.create_map(F.lit("ytRating"), F.lit("ytAgeRestricted"))).otherwise(F.create_map().cast("map<string,string>"))
        item = F.struct(
            name.alias("id"),
            F.struct(F.date_format("first_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"), F.col("channel_id").alias("channelId"),
                     F.concat(F.lit("video "), F.col("user_id").cast("string"), F.lit(" "), F.col("attr")).alias("title"), F.col("attr").alias("description"),
                     F.col("attr").alias("categoryId"), F.lit("none").alias("liveBroadcastContent"), F.lit("en").alias("defaultLanguage")).alias("snippet"),
            F.struct(minutes.alias("duration"), F.lit("2d").alias("dimension"), F.when(F.col("n") > 3, "hd").otherwise("sd").alias("definition"),
                     F.when(F.col("n") % 2 == 0, "true").otherwise("false").alias("caption"), F.lit("true").alias("licensedContent"),
                     rating.alias("contentRating"), F.lit("rectangular").alias("projection")).alias("contentDetails"),
            F.struct(F.col("views").alias("viewCount"), F.col("likes").alias("likeCount"), F.lit("0").alias("favoriteCount"), F.col("comments").alias("commentCount")).alias("statistics"),
            F.struct(F.lit("public").alias("privacyStatus"), F.lit("processed").alias("uploadStatus")).alias("status"))
        return L.build_bronze_videos(self._items(d, ["ingestion_date", "channel_id"], item, "user_id", L.VIDEO_ITEM))

    def channels(self) -> DataFrame:
        d = self.days
        new = d.groupBy("user_id", "channel_id").agg(F.min("ingestion_date").alias("ingestion_date")).groupBy("channel_id", "ingestion_date").agg(F.count("*").alias("new"))
        present = d.select("channel_id", "ingestion_date").distinct().join(new, ["channel_id", "ingestion_date"], "left")
        seen = F.sum(F.coalesce("new", F.lit(0))).over(Window.partitionBy("channel_id").orderBy("ingestion_date"))
        renamed = F.when((F.col("channel_id") == "c1") & (F.col("ingestion_date") >= "2024-01-02"), " renamed").otherwise("")
        item = F.struct(
            F.col("channel_id").alias("id"),
            F.struct(F.concat(F.lit("channel "), F.substring("channel_id", 2, 9), renamed).alias("title"), F.lit("synthetic channel").alias("description"),
                     F.concat(F.lit("@"), "channel_id").alias("customUrl"), F.lit("2023-12-01T00:00:00Z").alias("publishedAt"), F.lit("US").alias("country")).alias("snippet"),
            F.struct(F.col("subs").cast("string").alias("subscriberCount")).alias("statistics"))
        rows = present.withColumn("subs", seen).withColumn("one", F.lit(0))
        return L.build_bronze_channels(self._items(rows, ["ingestion_date", "channel_id"], item, "one", L.CHANNEL_ITEM))

    def categories(self) -> DataFrame:
        item = F.struct(F.col("attr").alias("id"), F.struct(F.upper("attr").alias("title"), (F.col("attr") != "error").alias("assignable")).alias("snippet"))
        rows = self.days.select("ingestion_date", "attr").distinct().withColumn("one", F.lit(0))
        return L.build_bronze_categories(self._items(rows, ["ingestion_date", "attr"], item, "one", L.CATEGORY_ITEM))

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], L.SCHEMAS[table])


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, for comparison."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


def _known(df: DataFrame) -> DataFrame:
    return df.where(F.col("calendar_dt") <= SPLIT)


def _slice(df: DataFrame) -> DataFrame:
    return df.where(F.col("calendar_dt") > SPLIT)


def _h_channel(r: Raw) -> DataFrame:
    c = r.channels()
    return L.build_h_channel(_slice(c), L.build_h_channel(_known(c), r.empty("silver.h_channel")))


def _h_video(r: Raw) -> DataFrame:
    v = r.videos()
    return L.build_h_video(_slice(v), L.build_h_video(_known(v), r.empty("silver.h_video")))


def _l_video_channel(r: Raw) -> DataFrame:
    v = r.videos()
    return L.build_l_video_channel(_slice(v), L.build_l_video_channel(_known(v), r.empty("silver.l_video_channel")))


def _s_channel(r: Raw) -> DataFrame:
    return build_versions(L.build_s_channel(r.channels()), "channel_id")


def _video_versions(videos: DataFrame) -> DataFrame:
    return build_versions(L._video_attributes(videos), "video_id")


def _all_links(r: Raw, videos: DataFrame) -> DataFrame:
    return L.build_l_video_channel(videos, r.empty("silver.l_video_channel"))


def _s_video(r: Raw) -> DataFrame:
    videos = r.videos()
    before = videos.where(F.col("calendar_dt") < LAST_DAY)
    hub = L.build_h_video(before, r.empty("silver.h_video"))
    return L.build_s_video(videos.where(F.col("calendar_dt") == LAST_DAY), L.video_days(videos), hub, _all_links(r, before), _video_versions(before))


def _dim_channel(r: Raw) -> DataFrame:
    return L.build_dim_channel(L.build_h_channel(r.channels(), r.empty("silver.h_channel")), _s_channel(r))


def _dim_video(r: Raw) -> DataFrame:
    videos = r.videos()
    hub = L.build_h_video(videos, r.empty("silver.h_video"))
    return L.build_dim_video(hub, _video_versions(videos), _all_links(r, videos), L.build_ref_category(r.categories()))


def _fct_channel_daily(r: Raw) -> DataFrame:
    videos = r.videos()
    facts = L.build_fct_video_daily(_all_links(r, videos), L.build_s_video_stats(videos), _video_versions(videos), L.last_video_rows(r.empty("gold.fct_video_daily")))
    return L.build_fct_channel_daily(facts, facts.where(F.col("calendar_dt") > TOTALS_AFTER), L.build_s_channel_stats(r.channels()))


BUILDERS = {
    "layer_bronze_categories": lambda r: r.categories(),
    "layer_bronze_channels": lambda r: r.channels(),
    "layer_bronze_videos": lambda r: r.videos(),
    "layer_h_channel": _h_channel,
    "layer_h_video": _h_video,
    "layer_l_video_channel": _l_video_channel,
    "layer_ref_category": lambda r: L.build_ref_category(r.categories()),
    "layer_s_channel": _s_channel,
    "layer_s_channel_stats": lambda r: L.build_s_channel_stats(r.channels()),
    "layer_s_video": _s_video,
    "layer_s_video_stats": lambda r: L.build_s_video_stats(r.videos()),
    "layer_dim_category": lambda r: L.build_dim_category(L.build_ref_category(r.categories())),
    "layer_dim_channel": _dim_channel,
    "layer_dim_video": _dim_video,
    "layer_fct_channel_daily": _fct_channel_daily,
}

QUERIES = {name: (lambda spark, sf_dir, build=build: _plain(build(Raw(spark, sf_dir)))) for name, build in BUILDERS.items()}

RAW = """
dd AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, ts) AS attr, CAST(sum(round(value * 100)) AS BIGINT) AS v, count(*) AS n,
              count(*) FILTER (event_type = 'purchase') AS p, count(*) FILTER (event_type = 'click') AS c, min(ts) AS t0
       FROM events GROUP BY ALL),
days AS (SELECT *, CAST(sum(n) OVER w AS BIGINT) AS views, CAST(sum(p) OVER w AS BIGINT) AS likes, CAST(sum(c) OVER w AS BIGINT) AS comments,
                date_trunc('second', min(t0) OVER w) AS published, 'v' || user_id AS video_id, 'c' || (user_id % 10) AS channel_id
         FROM dd WINDOW w AS (PARTITION BY user_id ORDER BY d)),
att AS (SELECT video_id, channel_id, d, published, 'video ' || user_id || ' ' || attr AS title, attr AS description, attr AS category_id,
               'none' AS live_broadcast_content, 'en' AS default_language, CAST(n * 60 + (v % 60 + 60) % 60 AS INTEGER) AS duration_sec, '2d' AS dimension,
               CASE WHEN n > 3 THEN 'hd' ELSE 'sd' END AS definition, n % 2 = 0 AS caption, true AS license,
               CASE WHEN attr = 'error' THEN '{"ytRating":"ytAgeRestricted"}' ELSE '{}' END AS content_rating, 'rectangular' AS projection,
               'public' AS privacy_status, 'processed' AS upload_status, CAST(d AS TIMESTAMP) AS valid_from_dttm FROM days),
newc AS (SELECT channel_id, d, count(*) AS k FROM (SELECT video_id, channel_id, min(d) AS d FROM days GROUP BY ALL) GROUP BY ALL),
chan AS (SELECT channel_id, d, CAST(sum(coalesce(k, 0)) OVER (PARTITION BY channel_id ORDER BY d) AS BIGINT) AS subs,
                'channel ' || substr(channel_id, 2) || CASE WHEN channel_id = 'c1' AND d >= DATE '2024-01-02' THEN ' renamed' ELSE '' END AS title
         FROM (SELECT DISTINCT channel_id, d FROM days) LEFT JOIN newc USING (channel_id, d)),
cat AS (SELECT DISTINCT attr AS category_id, upper(attr) AS category_name, attr <> 'error' AS is_assignable FROM days)"""

ATTRIBUTES = """title, description, category_id, live_broadcast_content, default_language, duration_sec, dimension, definition, caption, license,
       content_rating, projection, privacy_status, upload_status"""
CHANNEL_ROWS = "'synthetic channel' AS description, '@' || channel_id AS custom_url, 'US' AS country"
S_CHANNEL = f"""
sc AS (SELECT channel_id, title, {CHANNEL_ROWS}, CAST(d AS TIMESTAMP) AS valid_from_dttm,
              lead(CAST(d AS TIMESTAMP)) OVER (PARTITION BY channel_id ORDER BY d) AS valid_to_dttm
       FROM (SELECT *, lag(title) OVER (PARTITION BY channel_id ORDER BY d) AS prev FROM chan) WHERE prev IS NULL OR prev <> title)"""

ORACLE = {name: f"WITH {RAW}{sql}" for name, sql in {
    "layer_bronze_categories": " SELECT DISTINCT attr AS id, d AS calendar_dt, upper(attr) AS title, attr <> 'error' AS assignable FROM days",
    "layer_bronze_channels": """ SELECT channel_id AS id, d AS calendar_dt, title, 'synthetic channel' AS description, '@' || channel_id AS "customUrl",
       TIMESTAMP '2023-12-01' AS "publishedAt", 'US' AS country, CAST(subs AS INTEGER) AS "subscriberCount" FROM chan""",
    "layer_bronze_videos": """ SELECT a.video_id AS id, a.d AS calendar_dt, a.published AS "publishedAt", a.channel_id AS "channelId", title, description, category_id AS "categoryId",
       live_broadcast_content AS "liveBroadcastContent", default_language AS "defaultLanguage", 'PT' || n || 'M' || ((v % 60 + 60) % 60) || 'S' AS duration, dimension, definition,
       CAST(caption AS VARCHAR) AS caption, 'true' AS "licensedContent", content_rating AS "contentRating", projection, views AS "viewCount", likes AS "likeCount",
       CAST(0 AS BIGINT) AS "favoriteCount", comments AS "commentCount", privacy_status AS "privacyStatus", upload_status AS "uploadStatus" FROM att a JOIN days USING (video_id, d)""",
    "layer_h_channel": f""" SELECT DISTINCT channel_id, TIMESTAMP '2023-12-01' AS created_at FROM days WHERE d > DATE '{SPLIT}'
       AND channel_id NOT IN (SELECT channel_id FROM days WHERE d <= DATE '{SPLIT}')""",
    "layer_h_video": f""" SELECT video_id, min(published) AS created_at FROM days WHERE d > DATE '{SPLIT}'
       AND video_id NOT IN (SELECT video_id FROM days WHERE d <= DATE '{SPLIT}') GROUP BY ALL""",
    "layer_l_video_channel": f""" SELECT md5(video_id || '||' || channel_id) AS link_id, video_id, channel_id, min(published) AS created_at FROM days WHERE d > DATE '{SPLIT}'
       AND video_id NOT IN (SELECT video_id FROM days WHERE d <= DATE '{SPLIT}') GROUP BY ALL""",
    "layer_ref_category": " SELECT * FROM cat",
    "layer_s_channel": f", {S_CHANNEL} SELECT * FROM sc",
    "layer_s_channel_stats": " SELECT channel_id, d AS calendar_dt, subs AS subscribers_cnt FROM chan",
    "layer_s_video": f""" SELECT video_id, {ATTRIBUTES}, true AS is_available, valid_from_dttm FROM att WHERE d = DATE '{LAST_DAY}'
       UNION ALL SELECT video_id, {ATTRIBUTES}, false, TIMESTAMP '{LAST_DAY}' FROM (
         SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY d DESC) AS r FROM att WHERE d < DATE '{LAST_DAY}') a
       WHERE r = 1 AND channel_id IN (SELECT channel_id FROM days WHERE d = DATE '{LAST_DAY}') AND video_id NOT IN (SELECT video_id FROM days WHERE d = DATE '{LAST_DAY}')""",
    "layer_s_video_stats": " SELECT video_id, d AS calendar_dt, views AS views_cnt, likes AS likes_cnt, CAST(0 AS BIGINT) AS favorites_cnt, comments AS comments_cnt FROM days",
    "layer_dim_category": " SELECT category_id, category_name FROM cat",
    "layer_dim_channel": f", {S_CHANNEL} SELECT channel_id, TIMESTAMP '2023-12-01' AS created_at, title, description, custom_url, country, valid_from_dttm FROM sc",
    "layer_dim_video": f""", k AS (SELECT *, lag(title || duration_sec) OVER (PARTITION BY video_id ORDER BY d) AS prev FROM att)
       SELECT video_id, channel_id, min(published) OVER (PARTITION BY video_id) AS created_at, {ATTRIBUTES}, category_name, true AS is_available, valid_from_dttm
       FROM k JOIN cat USING (category_id) WHERE prev IS NULL OR prev <> title || duration_sec""",
    "layer_fct_channel_daily": f""", f AS (SELECT *, views - lag(views) OVER w AS dv, likes - lag(likes) OVER w AS dl, comments - lag(comments) OVER w AS dc
         FROM days WINDOW w AS (PARTITION BY video_id ORDER BY d))
       SELECT channel_id, d AS calendar_dt, any_value(subs) AS subscribers_cnt, count(*) AS videos_cnt, CAST(sum(views) AS BIGINT) AS views_total, CAST(sum(likes) AS BIGINT) AS likes_total,
       CAST(0 AS BIGINT) AS favorites_total, CAST(sum(comments) AS BIGINT) AS comments_total, CAST(sum(dv) AS BIGINT) AS views_delta, CAST(sum(dl) AS BIGINT) AS likes_delta,
       CAST(sum(dc) AS BIGINT) AS comments_delta FROM f JOIN chan USING (channel_id, d) WHERE d > DATE '{TOTALS_AFTER}' GROUP BY ALL""",
}.items()}
