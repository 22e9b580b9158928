"""Runs the layered builds against a table store, one slice at a time.

Every silver / gold step reads its input by the ``processed_dttm`` watermark,
builds the rows with ``tidemark.plans.layers`` and merges them; the watermark
is committed only after the write, so a failed step is simply rerun (merges
are idempotent).  Bronze steps read one ``ingestion_date`` of raw JSON.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import PROCESSED_COLUMN
from tidemark.operators import quality as dq
from tidemark.operators.history import VALID_FROM, VALID_TO
from tidemark.operators.shapes import late_keys, merge_presence
from tidemark.operators.slices import Slicer, Watermarks
from tidemark.plans import layers as L
from tidemark.session import materialize, scratch_scope
from tidemark.sources.raw import read_envelopes
from tidemark.sources.tables import CatalogTables
from tidemark.sources.writers import write_scd1, write_scd2

# Partition layout: identity on the day, or a hidden transform of a timestamp
# (built lazily: a Column needs an active session).  Versioned tables are
# partitioned by the day a version was closed: closed history never changes,
# and a load rewrites the open versions plus the days it really touches.
PARTITIONS = {
    "bronze.categories": ("calendar_dt", None),
    "bronze.channels": ("calendar_dt", None),
    "bronze.videos": ("calendar_dt", None),
    "silver.h_channel": ("created_year", lambda: F.year("created_at")),
    "silver.h_video": ("created_year", lambda: F.year("created_at")),
    "silver.l_video_channel": ("created_year", lambda: F.year("created_at")),
    "silver.s_channel": ("valid_to_day", lambda: F.to_date(VALID_TO)),
    "silver.s_channel_stats": ("calendar_dt", None),
    "silver.s_video": ("valid_to_day", lambda: F.to_date(VALID_TO)),
    "silver.s_video_stats": ("calendar_dt", None),
    "gold.dim_channel": ("valid_to_day", lambda: F.to_date(VALID_TO)),
    "gold.dim_video": ("valid_to_day", lambda: F.to_date(VALID_TO)),
    "gold.fct_video_daily": ("calendar_dt", None),
    "gold.fct_channel_daily": ("calendar_dt", None),
}

# What loads go on from instead of reading history again: on which days a video was
# seen, and its last fact row.  Schema, partition column.
STATE = {
    "state.video_days": ("video_id string, word int, days bigint", "word"),
    "state.video_last": ("video_id string, calendar_dt date, views_cnt bigint, likes_cnt bigint, comments_cnt bigint", None),
}

# Data-quality declarations of the model: key, non-negative measures, business
# key of versioned tables and foreign keys (fixed values).
SPECS: tuple[dq.TableSpec, ...] = (
    dq.TableSpec("bronze.categories", ("id", "calendar_dt")),
    dq.TableSpec("bronze.channels", ("id", "calendar_dt"), ("subscriberCount",)),
    dq.TableSpec("bronze.videos", ("id", "calendar_dt"), ("viewCount", "likeCount", "favoriteCount", "commentCount")),
    dq.TableSpec("silver.h_channel", ("channel_id",)),
    dq.TableSpec("silver.h_video", ("video_id",)),
    dq.TableSpec("silver.l_video_channel", ("link_id",),
                 references=(("video_id", "silver.h_video"), ("channel_id", "silver.h_channel"))),
    dq.TableSpec("silver.ref_category", ("category_id",)),
    dq.TableSpec("silver.s_channel", ("channel_id", "valid_from_dttm"), business_key="channel_id",
                 references=(("channel_id", "silver.h_channel"),)),
    dq.TableSpec("silver.s_channel_stats", ("channel_id", "calendar_dt"), ("subscribers_cnt",),
                 references=(("channel_id", "silver.h_channel"),)),
    dq.TableSpec("silver.s_video", ("video_id", "valid_from_dttm"), business_key="video_id",
                 references=(("video_id", "silver.h_video"),)),
    dq.TableSpec("silver.s_video_stats", ("video_id", "calendar_dt"),
                 ("views_cnt", "likes_cnt", "favorites_cnt", "comments_cnt"),
                 references=(("video_id", "silver.h_video"),)),
    dq.TableSpec("gold.dim_calendar", ("calendar_dt",)),
    dq.TableSpec("gold.dim_category", ("category_id",)),
    dq.TableSpec("gold.dim_channel", ("channel_id", "valid_from_dttm"), business_key="channel_id"),
    dq.TableSpec("gold.dim_video", ("video_id", "valid_from_dttm"), business_key="video_id",
                 references=(("channel_id", "gold.dim_channel"), ("category_id", "gold.dim_category"))),
    dq.TableSpec("gold.fct_video_daily", ("video_id", "calendar_dt"),
                 ("views_cnt", "likes_cnt", "favorites_cnt", "comments_cnt"),
                 references=(("video_id", "gold.dim_video"), ("channel_id", "gold.dim_channel"),
                             ("category_id", "gold.dim_category"), ("calendar_dt", "gold.dim_calendar"))),
    dq.TableSpec("gold.fct_channel_daily", ("channel_id", "calendar_dt"),
                 ("subscribers_cnt", "videos_cnt", "views_total", "likes_total", "favorites_total", "comments_total"),
                 references=(("channel_id", "gold.dim_channel"), ("calendar_dt", "gold.dim_calendar"))),
)


class Warehouse:
    """The seventeen tables in a Parquet warehouse, loaded slice by slice."""

    def __init__(self, spark: SparkSession, warehouse: str, raw_root: str,
                 processed: _dt.datetime | str | None = None):
        self.spark = spark
        self.tables = CatalogTables(spark, warehouse)
        self.raw_root = raw_root.rstrip("/")
        self.marks_path = f"{warehouse.rstrip('/')}/_watermarks"
        self.processed = processed
        for ns in ("bronze", "silver", "gold"):
            self.tables.create_namespace(ns)
        for name, ddl in L.SCHEMAS.items():
            part, expr = PARTITIONS.get(name, (None, None))
            self.tables.create(name, f"{ddl}, {PROCESSED_COLUMN} timestamp", part, expr() if expr else None)
        for name, (ddl, part) in STATE.items():
            self.tables.create(name, f"{ddl}, {PROCESSED_COLUMN} timestamp", part)

    # ----------------------------------------------------------------- writes
    def upsert1(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        """SCD1 upsert; skipped when there is nothing to load.  The built rows are
        stored first, so their plan runs once.  Keys include the partition column
        where there is one, so only the partitions of the incoming rows are read."""
        rows = materialize(rows)
        if rows.isEmpty():
            return
        write_scd1(self.tables, name, rows, keys, "upsert", self.processed)

    def upsert2(self, name: str, rows: DataFrame, business_key: str, mode: str = "from_dt") -> None:
        """SCD2 upsert with the given rebuild mode; skipped when there is nothing to load."""
        rows = materialize(rows)
        if rows.isEmpty():
            return
        write_scd2(self.tables, name, rows, business_key, [business_key, VALID_FROM], "upsert", mode, self.processed)

    # ----------------------------------------------------------------- slices
    def _slice(self, pipeline: str, table: str) -> tuple[Slicer, DataFrame]:
        slicer = Slicer(Watermarks(self.spark, pipeline, self.marks_path), table, PROCESSED_COLUMN)
        return slicer, slicer.run(self.tables.read(table))

    def _raw(self, entity: str, item, date: str) -> DataFrame:
        base = f"{self.raw_root}/{entity}"
        return read_envelopes(self.spark, f"{base}/ingestion_date={date}", item, base_path=base, multi_line=True)

    # ------------------------------------------------------------------ state
    def _state(self, name: str, history, more: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
        """A state table without its processing time, and ``more`` to merge into it: built from
        ``history`` where it is still empty (a warehouse loaded before it kept state)."""
        stored = self.tables.read(name).drop(PROCESSED_COLUMN)
        return stored, (history() if stored.isEmpty() else more)

    def _see_videos(self, videos_slice: DataFrame) -> DataFrame:
        """Merge the slice into the days videos were seen; returns them."""
        name = "state.video_days"
        stored, more = self._state(name, lambda: L.video_days(self.tables.read("bronze.videos")), L.video_days(videos_slice))
        more = materialize(more)
        touched = stored.join(more.select("video_id", "word"), ["video_id", "word"], "left_semi")
        self.upsert1(name, merge_presence(touched, more, "video_id"), ["video_id", "word"])
        return self.tables.read(name)

    def _video_facts(self, stats: DataFrame) -> DataFrame:
        """Fact rows of the slice, from the last loaded rows; the fact itself is read only
        where a video's slice rows are not behind its last one."""
        t = self.tables
        links, versions, loaded = t.read("silver.l_video_channel"), t.read("silver.s_video"), t.read("gold.fct_video_daily")
        last, first = self._state("state.video_last", lambda: L.last_video_rows(loaded), None)
        last = last if first is None else first
        late = late_keys(last, stats, "video_id", "calendar_dt")
        if late.isEmpty():
            return L.build_fct_video_daily(links, stats, versions, last)
        late = materialize(late)
        on_time = L.build_fct_video_daily(links, stats.join(late, "video_id", "left_anti"), versions, last)
        behind = L.build_fct_video_daily(links, stats.join(late, "video_id", "left_semi"), versions, last, loaded.join(late, "video_id", "left_semi"))
        return on_time.unionByName(behind)

    def _remember_facts(self, rows: DataFrame) -> None:
        """Keep the last row of each video of a load, where it is behind the one kept."""
        name = "state.video_last"
        stored, more = self._state(name, lambda: L.last_video_rows(self.tables.read("gold.fct_video_daily")), L.last_video_rows(rows))
        kept = stored.select("video_id", F.col("calendar_dt").alias("__kept"))
        newer = more.join(kept, "video_id", "left").where(F.col("__kept").isNull() | (F.col("calendar_dt") >= F.col("__kept"))).drop("__kept")
        self.upsert1(name, newer, ["video_id"])

    # ----------------------------------------------------------------- bronze
    def load_bronze(self, date: str) -> None:
        self.upsert1("bronze.categories", L.build_bronze_categories(self._raw("categories", L.CATEGORY_ITEM, date)),
                     ["id", "calendar_dt"])
        self.upsert1("bronze.channels", L.build_bronze_channels(self._raw("channels", L.CHANNEL_ITEM, date)),
                     ["id", "calendar_dt"])
        self.upsert1("bronze.videos", L.build_bronze_videos(self._raw("videos", L.VIDEO_ITEM, date)),
                     ["id", "calendar_dt"])

    # ----------------------------------------------------------------- silver
    def load_silver(self) -> None:
        t = self.tables
        s, ch = self._slice("silver.h_channel", "bronze.channels")
        self.upsert1("silver.h_channel", L.build_h_channel(ch, t.read("silver.h_channel")), ["channel_id"])
        s.commit()
        s, v = self._slice("silver.h_video", "bronze.videos")
        self.upsert1("silver.h_video", L.build_h_video(v, t.read("silver.h_video")), ["video_id"])
        s.commit()
        s, v = self._slice("silver.l_video_channel", "bronze.videos")
        self.upsert1("silver.l_video_channel", L.build_l_video_channel(v, t.read("silver.l_video_channel")),
                     ["link_id"])
        s.commit()
        s, c = self._slice("silver.ref_category", "bronze.categories")
        self.upsert1("silver.ref_category", L.build_ref_category(c), ["category_id"])
        s.commit()
        s, ch = self._slice("silver.s_channel", "bronze.channels")
        self.upsert2("silver.s_channel", L.build_s_channel(ch), "channel_id")
        s.commit()
        s, ch = self._slice("silver.s_channel_stats", "bronze.channels")
        self.upsert1("silver.s_channel_stats", L.build_s_channel_stats(ch), ["channel_id", "calendar_dt"])
        s.commit()
        s, v = self._slice("silver.s_video_stats", "bronze.videos")
        self.upsert1("silver.s_video_stats", L.build_s_video_stats(v), ["video_id", "calendar_dt"])
        s.commit()
        s, v = self._slice("silver.s_video", "bronze.videos")
        rows = L.build_s_video(v, self._see_videos(v), t.read("silver.h_video"),
                               t.read("silver.l_video_channel"), t.read("silver.s_video"))
        self.upsert2("silver.s_video", rows, "video_id")
        s.commit()

    # ----------------------------------------------------------------- gold
    def load_gold(self) -> None:
        t = self.tables
        self.upsert1("gold.dim_calendar", L.build_dim_calendar(self.spark), ["calendar_dt"])
        s, r = self._slice("gold.dim_category", "silver.ref_category")
        self.upsert1("gold.dim_category", L.build_dim_category(r), ["category_id"])
        s.commit()
        s, sc = self._slice("gold.dim_channel", "silver.s_channel")
        self.upsert2("gold.dim_channel", L.build_dim_channel(t.read("silver.h_channel"), sc), "channel_id")
        s.commit()
        s, sv = self._slice("gold.dim_video", "silver.s_video")
        self.upsert2("gold.dim_video", L.build_dim_video(t.read("silver.h_video"), sv, t.read("silver.l_video_channel"),
                                                         t.read("silver.ref_category")), "video_id")
        s.commit()
        s, st = self._slice("gold.fct_video_daily", "silver.s_video_stats")
        rows = materialize(self._video_facts(st))
        self.upsert1("gold.fct_video_daily", rows, ["video_id", "calendar_dt"])
        self._remember_facts(rows)
        s.commit()
        s, fs = self._slice("gold.fct_channel_daily", "gold.fct_video_daily")
        rows = L.build_fct_channel_daily(t.read("gold.fct_video_daily"), fs, t.read("silver.s_channel_stats"))
        self.upsert1("gold.fct_channel_daily", rows, ["channel_id", "calendar_dt"])
        s.commit()

    def resync_dimensions(self) -> None:
        """Rebuild the versioned gold dimensions from all of silver.

        Incremental loads read silver by watermark, so a silver version that a
        later load deleted never reaches gold; this full rewrite removes such
        stale versions (an optional, heavier step).
        """
        t = self.tables
        with scratch_scope(self.spark):
            write_scd2(t, "gold.dim_channel", L.build_dim_channel(t.read("silver.h_channel"), t.read("silver.s_channel")),
                       "channel_id", ["channel_id", VALID_FROM], "rewrite", processed=self.processed)
            rows = L.build_dim_video(t.read("silver.h_video"), t.read("silver.s_video"), t.read("silver.l_video_channel"),
                                     t.read("silver.ref_category"))
            write_scd2(t, "gold.dim_video", rows, "video_id", ["video_id", VALID_FROM], "rewrite", processed=self.processed)

    def load_day(self, date: str) -> None:
        for step in (lambda: self.load_bronze(date), self.load_silver, self.load_gold):
            with scratch_scope(self.spark):  # what a layer stores in between is gone when it is written
                step()

    # ----------------------------------------------------------------- quality
    def quality(self, names: list[str] | None = None) -> DataFrame:
        specs = dq.select_specs(SPECS, names)
        parts = []
        for spec in specs:
            if not self.tables.exists(spec.name):
                parts.append(dq.missing_table(self.spark, spec.name))
                continue
            parents = {p: self.tables.read(p) for _, p in spec.references}
            parts.append(dq.check(self.tables.read(spec.name), spec, parents))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
