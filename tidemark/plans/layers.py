"""The seventeen layered tables (bronze / silver / gold) as pure functions.

Each ``build_*`` takes DataFrames (raw items, slices, current tables) and
returns the rows to load; ``tidemark.plans.runner`` reads slices, calls them
and merges the result.  Nothing here writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import iso_duration_seconds, link_key
from tidemark.operators.history import VALID_FROM, VALID_TO
from tidemark.operators.joins import as_of_carried, new_keys
from tidemark.operators.ordered import latest_per_key
from tidemark.operators.shapes import delta_from_state, disappeared, incremental_delta, last_rows, presence, reaggregate_affected
from tidemark.sources.calendar import calendar_days, calendar_dimension

S = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


# Raw item schemas (declared, never inferred).  Everything arrives as text
# except ``assignable`` and the ``contentRating`` map.
CATEGORY_ITEM = _struct(id=S, snippet=_struct(title=S, assignable=T.BooleanType()))
CHANNEL_ITEM = _struct(
    id=S,
    snippet=_struct(title=S, description=S, customUrl=S, publishedAt=S, country=S),
    statistics=_struct(subscriberCount=S),
)
VIDEO_ITEM = _struct(
    id=S,
    snippet=_struct(publishedAt=S, channelId=S, title=S, description=S, categoryId=S,
                    liveBroadcastContent=S, defaultLanguage=S),
    contentDetails=_struct(duration=S, dimension=S, definition=S, caption=S, licensedContent=S,
                           contentRating=T.MapType(S, S), projection=S),
    statistics=_struct(viewCount=S, likeCount=S, favoriteCount=S, commentCount=S),
    status=_struct(privacyStatus=S, uploadStatus=S),
)

# Table schemas (``processed_dttm`` is added by the writer), keys and
# partition columns.  Fixed values: table and column names of the model.
SCHEMAS = {
    "bronze.categories": "id string, calendar_dt date, title string, assignable boolean",
    "bronze.channels": ("id string, calendar_dt date, title string, description string, customUrl string, "
                        "publishedAt timestamp, country string, subscriberCount int"),
    "bronze.videos": ("id string, calendar_dt date, publishedAt timestamp, channelId string, title string, "
                      "description string, categoryId string, liveBroadcastContent string, defaultLanguage string, "
                      "duration string, dimension string, definition string, caption string, licensedContent string, "
                      "contentRating string, projection string, viewCount bigint, likeCount bigint, "
                      "favoriteCount bigint, commentCount bigint, privacyStatus string, uploadStatus string"),
    "silver.h_channel": "channel_id string, created_at timestamp",
    "silver.h_video": "video_id string, created_at timestamp",
    "silver.l_video_channel": "link_id string, video_id string, channel_id string, created_at timestamp",
    "silver.ref_category": "category_id string, category_name string, is_assignable boolean",
    "silver.s_channel": ("channel_id string, title string, description string, custom_url string, country string, "
                         "valid_from_dttm timestamp, valid_to_dttm timestamp"),
    "silver.s_channel_stats": "channel_id string, calendar_dt date, subscribers_cnt bigint",
    "silver.s_video": ("video_id string, title string, description string, category_id string, "
                       "live_broadcast_content string, default_language string, duration_sec int, dimension string, "
                       "definition string, caption boolean, license boolean, content_rating string, projection string, "
                       "privacy_status string, upload_status string, is_available boolean, "
                       "valid_from_dttm timestamp, valid_to_dttm timestamp"),
    "silver.s_video_stats": ("video_id string, calendar_dt date, views_cnt bigint, likes_cnt bigint, "
                             "favorites_cnt bigint, comments_cnt bigint"),
    "gold.dim_calendar": ("calendar_dt date, monthday int, month int, month_name string, quarter int, year int, "
                          "year_month string, week_of_year int, iso_year int, weekday int, day_name string, "
                          "is_weekend boolean"),
    "gold.dim_category": "category_id string, category_name string",
    "gold.dim_channel": ("channel_id string, created_at timestamp, title string, description string, "
                         "custom_url string, country string, valid_from_dttm timestamp, valid_to_dttm timestamp"),
    "gold.dim_video": ("video_id string, channel_id string, created_at timestamp, title string, description string, "
                       "category_id string, category_name string, live_broadcast_content string, "
                       "default_language string, duration_sec int, dimension string, definition string, "
                       "caption boolean, license boolean, content_rating string, projection string, "
                       "privacy_status string, upload_status string, is_available boolean, "
                       "valid_from_dttm timestamp, valid_to_dttm timestamp"),
    "gold.fct_video_daily": ("video_id string, channel_id string, category_id string, calendar_dt date, "
                             "views_cnt bigint, likes_cnt bigint, favorites_cnt bigint, comments_cnt bigint, "
                             "views_delta bigint, likes_delta bigint, comments_delta bigint"),
    "gold.fct_channel_daily": ("channel_id string, calendar_dt date, subscribers_cnt bigint, videos_cnt bigint, "
                               "views_total bigint, likes_total bigint, favorites_total bigint, comments_total bigint, "
                               "views_delta bigint, likes_delta bigint, comments_delta bigint"),
}


# ------------------------------------------------------------------ bronze

def _ts(c: str) -> F.Column:
    return F.try_to_timestamp(F.col(c))


def build_bronze_categories(items: DataFrame) -> DataFrame:
    return items.select(F.col("i.id"), F.to_date("ingestion_date").alias("calendar_dt"),
                        F.col("i.snippet.title"), F.col("i.snippet.assignable"))


def build_bronze_channels(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("i.id"), F.to_date("ingestion_date").alias("calendar_dt"),
        F.col("i.snippet.title"), F.col("i.snippet.description"), F.col("i.snippet.customUrl"),
        _ts("i.snippet.publishedAt").alias("publishedAt"), F.col("i.snippet.country"),
        F.col("i.statistics.subscriberCount").try_cast("int").alias("subscriberCount"))


def build_bronze_videos(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("i.id"), F.to_date("ingestion_date").alias("calendar_dt"),
        _ts("i.snippet.publishedAt").alias("publishedAt"),
        *[F.col(f"i.snippet.{c}").alias(c) for c in
          ("channelId", "title", "description", "categoryId", "liveBroadcastContent", "defaultLanguage")],
        *[F.col(f"i.contentDetails.{c}").alias(c) for c in
          ("duration", "dimension", "definition", "caption", "licensedContent")],
        F.to_json("i.contentDetails.contentRating").alias("contentRating"),
        F.col("i.contentDetails.projection").alias("projection"),
        *[F.col(f"i.statistics.{c}").try_cast("bigint").alias(c) for c in
          ("viewCount", "likeCount", "favoriteCount", "commentCount")],
        F.col("i.status.privacyStatus").alias("privacyStatus"),
        F.col("i.status.uploadStatus").alias("uploadStatus"))


# ------------------------------------------------------------------ silver

def build_h_channel(channels_slice: DataFrame, hub: DataFrame) -> DataFrame:
    inc = channels_slice.select(F.col("id").alias("channel_id"), F.col("publishedAt").alias("created_at"))
    return new_keys(inc, hub, "channel_id", "created_at")


def build_h_video(videos_slice: DataFrame, hub: DataFrame) -> DataFrame:
    inc = videos_slice.select(F.col("id").alias("video_id"), F.col("publishedAt").alias("created_at"))
    return new_keys(inc, hub, "video_id", "created_at")


def build_l_video_channel(videos_slice: DataFrame, links: DataFrame) -> DataFrame:
    pairs = (videos_slice.groupBy(F.col("id").alias("video_id"), F.col("channelId").alias("channel_id"))
             .agg(F.min("publishedAt").alias("created_at"))
             .withColumn("link_id", link_key("video_id", "channel_id")))
    return pairs.join(links.select("link_id"), "link_id", "left_anti").select(
        "link_id", "video_id", "channel_id", "created_at")


def build_ref_category(categories_slice: DataFrame) -> DataFrame:
    """Latest day of each category in the slice (a multi-day slice holds one id per day)."""
    latest = latest_per_key(categories_slice.select("id", "calendar_dt", "title", "assignable"), ["id"], "calendar_dt")
    return latest.select(F.col("id").alias("category_id"), F.col("title").alias("category_name"),
                         F.col("assignable").alias("is_assignable"))


def build_s_channel(channels_slice: DataFrame) -> DataFrame:
    return channels_slice.select(
        F.col("id").alias("channel_id"), "title", "description", F.col("customUrl").alias("custom_url"), "country",
        F.col("calendar_dt").cast("timestamp").alias(VALID_FROM))


def build_s_channel_stats(channels_slice: DataFrame) -> DataFrame:
    return channels_slice.select(F.col("id").alias("channel_id"), "calendar_dt",
                                 F.col("subscriberCount").cast("bigint").alias("subscribers_cnt"))


def _video_attributes(videos: DataFrame) -> DataFrame:
    return videos.select(
        F.col("id").alias("video_id"), "title", "description",
        F.col("categoryId").alias("category_id"),
        F.col("liveBroadcastContent").alias("live_broadcast_content"),
        F.col("defaultLanguage").alias("default_language"),
        iso_duration_seconds("duration").alias("duration_sec"),
        "dimension", "definition",
        F.col("caption").try_cast("boolean").alias("caption"),
        F.col("licensedContent").try_cast("boolean").alias("license"),
        F.col("contentRating").alias("content_rating"), "projection",
        F.col("privacyStatus").alias("privacy_status"),
        F.col("uploadStatus").alias("upload_status"),
        F.lit(True).alias("is_available"),
        F.col("calendar_dt").cast("timestamp").alias(VALID_FROM))


def video_days(videos: DataFrame) -> DataFrame:
    """On which days each video was seen, as bitmaps."""
    return presence(videos.select(F.col("id").alias("video_id"), "calendar_dt"), "video_id", "calendar_dt")


def build_s_video(videos_slice: DataFrame, seen: DataFrame, h_video: DataFrame,
                  l_video_channel: DataFrame, s_video: DataFrame) -> DataFrame:
    """Video attributes of the slice plus unavailable copies for videos that vanished.

    ``seen`` is ``video_days`` of all snapshots, the slice's included."""
    present = _video_attributes(videos_slice)
    slice_ = videos_slice.select(F.col("channelId").alias("channel_id"), "calendar_dt")
    gone = disappeared(slice_, seen, l_video_channel, h_video, s_video.drop("processed_dttm"),
                       "video_id", "channel_id", "calendar_dt", time_type="timestamp")
    return present.unionByName(gone.select(*present.columns))


def build_s_video_stats(videos_slice: DataFrame) -> DataFrame:
    return videos_slice.select(
        F.col("id").alias("video_id"), "calendar_dt",
        F.col("viewCount").alias("views_cnt"), F.col("likeCount").alias("likes_cnt"),
        F.col("favoriteCount").alias("favorites_cnt"), F.col("commentCount").alias("comments_cnt"))


# ------------------------------------------------------------------ gold

def build_dim_calendar(spark) -> DataFrame:
    return calendar_dimension(calendar_days(spark))


def build_dim_category(ref_slice: DataFrame) -> DataFrame:
    return ref_slice.select("category_id", "category_name")


def build_dim_channel(h_channel: DataFrame, s_channel_slice: DataFrame) -> DataFrame:
    return h_channel.select("channel_id", "created_at").join(
        s_channel_slice.drop(VALID_TO, "processed_dttm"), "channel_id", "inner").select(
        "channel_id", "created_at", "title", "description", "custom_url", "country", VALID_FROM)


DIM_VIDEO_COLS = ["video_id", "channel_id", "created_at", "title", "description", "category_id", "category_name",
                  "live_broadcast_content", "default_language", "duration_sec", "dimension", "definition",
                  "caption", "license", "content_rating", "projection", "privacy_status", "upload_status",
                  "is_available", VALID_FROM]


def build_dim_video(h_video: DataFrame, s_video_slice: DataFrame, l_video_channel: DataFrame,
                    ref_category: DataFrame) -> DataFrame:
    return (h_video.select("video_id", "created_at")
            .join(s_video_slice.drop(VALID_TO, "processed_dttm"), "video_id", "inner")
            .join(l_video_channel.select("video_id", "channel_id"), "video_id", "left")
            .join(ref_category.select("category_id", "category_name"), "category_id", "left")
            .select(*DIM_VIDEO_COLS))


FACT_GRAIN = ["video_id", "channel_id", "category_id", "calendar_dt"]
FACT_MEASURES = ["views_cnt", "likes_cnt", "favorites_cnt", "comments_cnt"]


DELTAS = {"views_cnt": "views_delta", "likes_cnt": "likes_delta", "comments_cnt": "comments_delta"}


def build_fct_video_daily(l_video_channel: DataFrame, stats_slice: DataFrame, s_video: DataFrame,
                          last: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Slice stats with the category valid that day and the differences to the day before.

    ``last`` holds the last loaded row of each video (``last_video_rows``).  A video with
    slice rows that are not after it needs ``loaded``, the fact as it is stored.
    """
    stats = l_video_channel.select("video_id", "channel_id").join(
        stats_slice.drop("processed_dttm"), "video_id", "inner")
    versions = s_video.select("video_id", "category_id", VALID_FROM, VALID_TO)
    load = as_of_carried(stats, versions, "video_id", "calendar_dt").select(*FACT_GRAIN, *FACT_MEASURES)
    if loaded is not None:
        return incremental_delta(loaded.select(*FACT_GRAIN, *FACT_MEASURES), load, "video_id", "calendar_dt",
                                 list(DELTAS), list(DELTAS.values()))
    return delta_from_state(last, load, "video_id", "calendar_dt", list(DELTAS), list(DELTAS.values()))


def last_video_rows(fct_video_daily: DataFrame) -> DataFrame:
    return last_rows(fct_video_daily, "video_id", "calendar_dt", list(DELTAS))


def build_fct_channel_daily(fct_video_daily: DataFrame, fct_slice: DataFrame,
                            s_channel_stats: DataFrame) -> DataFrame:
    measures = [
        F.count("video_id").alias("videos_cnt"),
        F.sum("views_cnt").alias("views_total"),
        F.sum("likes_cnt").alias("likes_total"),
        F.sum("favorites_cnt").alias("favorites_total"),
        F.sum("comments_cnt").alias("comments_total"),
        F.sum("views_delta").alias("views_delta"),
        F.sum("likes_delta").alias("likes_delta"),
        F.sum("comments_delta").alias("comments_delta"),
    ]
    # the fact is partitioned by day: read only the days the slice touches
    totals = reaggregate_affected(fct_video_daily, fct_slice, ["channel_id", "calendar_dt"], measures,
                                  prune_on="calendar_dt")
    return totals.join(s_channel_stats.select("channel_id", "calendar_dt", "subscribers_cnt"),
                       ["channel_id", "calendar_dt"], "inner").select(
        "channel_id", "calendar_dt", "subscribers_cnt", "videos_cnt", "views_total", "likes_total",
        "favorites_total", "comments_total", "views_delta", "likes_delta", "comments_delta")
