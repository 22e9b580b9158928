"""Registered queries that load the layered tables as the warehouse does, in several slices
through the stored tables, and their oracles: the versioned tables, whole replacement, raw
files, pinned slices and the declared quality checks over all seventeen tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.operators.history import VALID_FROM, build_versions
from tidemark.operators.shapes import merge_presence
from tidemark.operators.slices import Slicer, Watermarks
from tidemark.plans import layers as L
from tidemark.plans.layer_queries import CHANNEL_ROWS, RAW, S_CHANNEL, SPLIT, ATTRIBUTES, Raw, _plain
from tidemark.plans.runner import PARTITIONS, SPECS
from tidemark.plans.writes import _root
from tidemark.session import materialize
from tidemark.sources import fixtures as fx
from tidemark.sources.calendar import calendar_between
from tidemark.sources.raw import CORRUPT, read_envelopes, to_envelopes, write_envelopes
from tidemark.sources.tables import CatalogTables
from tidemark.sources.writers import write_scd1, write_scd2


def _tables(spark: SparkSession, *names: str) -> CatalogTables:
    tables = CatalogTables(spark, _root(spark))
    for name in names:
        part, expr = PARTITIONS.get(name, (None, None))
        tables.create(name, f"{L.SCHEMAS[name]}, processed_dttm timestamp", part, expr() if expr else None)
    return tables


def _slices(df: DataFrame) -> list[DataFrame]:
    return [df.where(F.col("calendar_dt") <= SPLIT), df.where(F.col("calendar_dt") > SPLIT)]


def _without_processed(df: DataFrame) -> DataFrame:
    return _plain(df.drop("processed_dttm"))


def _loaded(tables: CatalogTables, name: str, key: str, slices: list[DataFrame]) -> DataFrame:
    for rows in slices:
        write_scd2(tables, name, materialize(rows), key, [key, VALID_FROM], "upsert", "from_dt")
    return tables.read(name)


# ------------------------------------------------------------ versioned tables

def load_s_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = materialize(Raw(spark, sf_dir).channels())
    tables = _tables(spark, "silver.s_channel")
    return _without_processed(_loaded(tables, "silver.s_channel", "channel_id", [L.build_s_channel(x) for x in _slices(channels)]))


def load_s_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slices; videos of a channel that the second one lacks become unavailable in it."""
    raw = Raw(spark, sf_dir)
    videos = materialize(raw.videos())
    hub = materialize(L.build_h_video(videos, raw.empty("silver.h_video")))
    links = materialize(L.build_l_video_channel(videos, raw.empty("silver.l_video_channel")))
    tables = _tables(spark, "silver.s_video")
    seen = None
    for slice_ in _slices(videos):
        days = L.video_days(slice_)
        seen = materialize(days if seen is None else merge_presence(seen, days, "video_id"))
        rows = L.build_s_video(slice_, seen, hub, links, tables.read("silver.s_video"))
        _loaded(tables, "silver.s_video", "video_id", [rows])
    return _without_processed(tables.read("silver.s_video"))


def load_dim_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Raw(spark, sf_dir)
    channels = materialize(raw.channels())
    hub = L.build_h_channel(channels, raw.empty("silver.h_channel"))
    tables = _tables(spark, "gold.dim_channel")
    slices = [L.build_dim_channel(hub, build_versions(L.build_s_channel(x), "channel_id")) for x in _slices(channels)]
    return _without_processed(_loaded(tables, "gold.dim_channel", "channel_id", slices))


def load_dim_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slices.  What both of them read is stored: days, hub, links and categories.

    The dimension joins the hub by video, which leaves out versions without one.  They are left out
    before the versions are built, because a filter that Spark derives from the join reaches only one of
    the two readers of the versions' shuffle, which is then made twice."""
    raw = Raw(spark, sf_dir)
    raw.days = materialize(raw.days)
    videos = materialize(raw.videos())
    hub = materialize(L.build_h_video(videos, raw.empty("silver.h_video")))
    links = materialize(L.build_l_video_channel(videos, raw.empty("silver.l_video_channel")))
    categories = materialize(L.build_ref_category(raw.categories()))
    tables = _tables(spark, "gold.dim_video")
    attributes = [L._video_attributes(x).where(F.col("video_id").isNotNull()) for x in _slices(videos)]
    slices = [L.build_dim_video(hub, build_versions(x, "video_id"), links, categories) for x in attributes]
    return _without_processed(_loaded(tables, "gold.dim_video", "video_id", slices))


def replace_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by day, first loaded with every day, then replaced by a rewrite that reads
    it: doubled counts of the days after the split; the other days' partitions are empty."""
    stats = Raw(spark, sf_dir).days.select("user_id", "calendar_dt", "n")
    tables = CatalogTables(spark, _root(spark))
    tables.create("s.days", "user_id bigint, calendar_dt date, n bigint, processed_dttm timestamp", partition_by="calendar_dt")
    write_scd1(tables, "s.days", stats, ["user_id", "calendar_dt"], "insert")
    later = tables.read("s.days").where(F.col("calendar_dt") > SPLIT).withColumn("n", F.col("n") * 2)
    write_scd1(tables, "s.days", later.drop("processed_dttm"), ["user_id", "calendar_dt"], "rewrite")
    return tables.read("s.days").select("user_id", "calendar_dt", "n")


# ------------------------------------------------------------------ raw files

RAW_ITEM = "struct<id:bigint,user:bigint>"
BROKEN = 29  # of every so many envelopes one is cut short, as a broken upload is


def raw_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files by day and channel through the sink, half of them arrays of envelopes, read
    back by the scan: items, their ids' sum and broken records of every folder."""
    events = fx.table(spark, sf_dir, "events").withColumn("ingestion_date", F.to_date("ts").cast("string")).withColumn(
        "channel_id", F.concat(F.lit("c"), (F.col("user_id") % fx.COHORTS).cast("string")))
    item = F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("user"))
    keys = ["ingestion_date", "channel_id"]
    pages = to_envelopes(events, keys, item, "event_id")
    text = F.when(F.col("__page") % BROKEN == 0, F.expr("left(envelope, length(envelope) - 3)")).otherwise(F.col("envelope"))
    text = F.when((F.col("__page") % 2 == 0) & (F.col("__page") % BROKEN != 0), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    root = _root(spark)
    write_envelopes(pages.withColumn("envelope", text), f"{root}/raw", keys)
    back = read_envelopes(spark, f"{root}/raw", RAW_ITEM, base_path=f"{root}/raw", multi_line=False, keep_corrupt=True)
    return back.groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date"), "channel_id").agg(
        F.count("i").alias("items"), F.coalesce(F.sum("i.id"), F.lit(0)).alias("ids"), F.count(CORRUPT).alias("broken"))


def slicer_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice is taken of the first twenty days; before it is read the table gets all later
    days and its files are replaced."""
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    root = _root(spark)
    tables = CatalogTables(spark, root)
    tables.create("s.events", "event_id bigint, ts timestamp_ntz", None)
    tables.append("s.events", events.where(fx.ts_in_days(1, 20)))
    slicer = Slicer(Watermarks(spark, "slicer_pinned", f"{root}/marks"), "events", "ts")
    rows = slicer.run(tables.read("s.events"), pinned=True)
    tables.append("s.events", events.where(fx.ts_in_days(21, 30)))
    tables.replace("s.events", tables.read("s.events").withColumn("event_id", -F.col("event_id")))
    moved = slicer.commit()
    left = Slicer(Watermarks(spark, "slicer_pinned", f"{root}/marks"), "events", "ts").run(tables.read("s.events"), pinned=True)
    return rows.select("event_id", F.lit(moved).alias("first")).unionByName(left.select("event_id", F.lit(False).alias("first")))


# -------------------------------------------------------------------- quality

def _all_tables(raw: Raw, store: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Every table of the model, loaded whole from the raw days.  ``store`` writes a table,
    given its name, and returns it as it is read back; later tables are built from that."""
    t: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> None:
        t[name] = store(name, df)

    keep("bronze.categories", raw.categories())
    keep("bronze.channels", raw.channels())
    keep("bronze.videos", raw.videos())
    channels, videos = t["bronze.channels"], t["bronze.videos"]
    keep("silver.h_channel", L.build_h_channel(channels, raw.empty("silver.h_channel")))
    keep("silver.h_video", L.build_h_video(videos, raw.empty("silver.h_video")))
    keep("silver.l_video_channel", L.build_l_video_channel(videos, raw.empty("silver.l_video_channel")))
    keep("silver.ref_category", L.build_ref_category(t["bronze.categories"]))
    keep("silver.s_channel", build_versions(L.build_s_channel(channels), "channel_id"))
    keep("silver.s_channel_stats", L.build_s_channel_stats(channels))
    keep("silver.s_video", build_versions(L._video_attributes(videos), "video_id"))
    keep("silver.s_video_stats", L.build_s_video_stats(videos))
    span = videos.agg(F.min("calendar_dt").alias("a"), F.max("calendar_dt").alias("b"))
    keep("gold.dim_calendar", calendar_between(span, "a", "b"))
    keep("gold.dim_category", L.build_dim_category(t["silver.ref_category"]))
    keep("gold.dim_channel", build_versions(L.build_dim_channel(t["silver.h_channel"], t["silver.s_channel"]), "channel_id"))
    keep("gold.dim_video", build_versions(L.build_dim_video(t["silver.h_video"], t["silver.s_video"], t["silver.l_video_channel"], t["silver.ref_category"]), "video_id"))
    facts = L.build_fct_video_daily(t["silver.l_video_channel"], t["silver.s_video_stats"], t["silver.s_video"], L.last_video_rows(raw.empty("gold.fct_video_daily")))
    keep("gold.fct_video_daily", facts)
    keep("gold.fct_channel_daily", L.build_fct_channel_daily(t["gold.fct_video_daily"], t["gold.fct_video_daily"], t["silver.s_channel_stats"]))
    return t


def dq_seventeen_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks over all tables, with damage done to three of them: hub rows
    missing, versions of a channel twice, counters below zero.  Each table is written
    under observation as it is built, the damaged ones again; the checks read it once."""
    raw = Raw(spark, sf_dir)
    raw.days = materialize(raw.days)
    specs, watches = {s.name: s for s in SPECS}, {}

    def store(name: str, df: DataFrame) -> DataFrame:
        df, watches[name] = dq.observed(df, specs[name])
        return materialize(df)

    stored = _all_tables(raw, store)
    views = F.col("views_cnt")
    damaged = {
        "silver.h_video": stored["silver.h_video"].where(~F.col("video_id").endswith("3")),
        "silver.s_channel": stored["silver.s_channel"].unionByName(stored["silver.s_channel"].where("channel_id = 'c1'")),
        "gold.fct_video_daily": stored["gold.fct_video_daily"].withColumn("views_cnt", F.when(views % 7 == 0, -views).otherwise(views)),
    }
    stored.update({name: store(name, df) for name, df in damaged.items()})
    results = [dq.check(stored[s.name], s, {p: stored[p] for _, p in s.references}, watches[s.name]) for s in SPECS]
    return reduce(DataFrame.unionByName, results).select("table_name", "check_name", "violations", "passed")


QUERIES = {
    "load_s_channel": load_s_channel,
    "load_s_video": load_s_video,
    "load_dim_channel": load_dim_channel,
    "load_dim_video": load_dim_video,
    "replace_whole_table": replace_whole_table,
    "raw_round_trip": raw_round_trip,
    "slicer_pinned": slicer_pinned,
    "dq_seventeen_tables": dq_seventeen_tables,
}

CHANGED = "title || '|' || duration_sec || '|' || content_rating || '|' || definition || '|' || caption"
VERSIONS = """lead(valid_from_dttm) OVER (PARTITION BY video_id ORDER BY valid_from_dttm) AS valid_to_dttm"""
VIDEO_VERSIONS = f"k AS (SELECT *, lag({CHANGED}) OVER (PARTITION BY video_id ORDER BY d) AS prev, {CHANGED} AS now FROM att), kept AS (SELECT * FROM k WHERE prev IS NULL OR prev <> now)"


def _checks() -> str:
    """The declared checks as rows; those that the damage breaks have their count as SQL."""
    broken = {
        ("silver.l_video_channel", "no_orphans[video_id]"): "SELECT count(DISTINCT video_id) FROM days WHERE video_id LIKE '%3'",
        ("silver.s_video", "no_orphans[video_id]"): "SELECT count(*) FROM kept WHERE video_id LIKE '%3'",
        ("silver.s_video_stats", "no_orphans[video_id]"): "SELECT count(*) FROM days WHERE video_id LIKE '%3'",
        ("silver.s_channel", "no_duplicates"): "SELECT count(*) FROM sc WHERE channel_id = 'c1'",
        ("silver.s_channel", "single_open_version"): "SELECT count(DISTINCT channel_id) FROM sc WHERE channel_id = 'c1'",
        ("gold.fct_video_daily", "no_negative"): "SELECT count(*) FROM days WHERE views % 7 = 0",
    }
    rows = []
    for spec in SPECS:
        names = ["not_empty", "no_duplicates", "no_nulls_in_key"] + ["no_negative"] * bool(spec.measure_columns)
        names += ["single_open_version"] * bool(spec.business_key) + [f"no_orphans[{c}]" for c, _ in spec.references]
        rows += [f"SELECT '{spec.name}' AS table_name, '{n}' AS check_name, CAST(({broken.get((spec.name, n), 'SELECT 0')}) AS BIGINT) AS violations" for n in names]
    return " UNION ALL ".join(rows)


ORACLE = {
    "load_s_channel": f"WITH {RAW}, {S_CHANNEL} SELECT * FROM sc",
    "load_s_video": f"""WITH {RAW},
first_day AS (SELECT channel_id, min(d) AS d FROM days WHERE d > DATE '{SPLIT}' GROUP BY channel_id),
gone AS (SELECT a.* REPLACE (CAST(f.d AS TIMESTAMP) AS valid_from_dttm, f.d AS d) FROM att a JOIN first_day f USING (channel_id)
         WHERE a.d <= DATE '{SPLIT}' AND a.video_id NOT IN (SELECT video_id FROM days WHERE d > DATE '{SPLIT}')
         QUALIFY row_number() OVER (PARTITION BY a.video_id ORDER BY a.d DESC) = 1),
both_ AS (SELECT *, true AS is_available FROM att UNION ALL SELECT *, false FROM gone),
k AS (SELECT *, lag({CHANGED} || is_available) OVER (PARTITION BY video_id ORDER BY d) AS prev, {CHANGED} || is_available AS now FROM both_),
kept AS (SELECT * FROM k WHERE prev IS NULL OR prev <> now)
SELECT video_id, {ATTRIBUTES}, is_available, valid_from_dttm, {VERSIONS} FROM kept""",
    "load_dim_channel": f"""WITH {RAW}, {S_CHANNEL}
SELECT channel_id, TIMESTAMP '2023-12-01' AS created_at, title, {CHANNEL_ROWS}, valid_from_dttm, valid_to_dttm FROM sc""",
    "load_dim_video": f"""WITH {RAW}, {VIDEO_VERSIONS}, born AS (SELECT video_id, min(published) AS created_at FROM days GROUP BY video_id)
SELECT video_id, channel_id, created_at, {ATTRIBUTES}, category_name, true AS is_available, valid_from_dttm, {VERSIONS}
FROM kept JOIN cat USING (category_id) JOIN born USING (video_id)""",
    "replace_whole_table": f"WITH {RAW} SELECT user_id, d AS calendar_dt, n * 2 AS n FROM days WHERE d > DATE '{SPLIT}'",
    "raw_round_trip": f"""WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS ingestion_date, 'c' || (user_id % 10) AS channel_id, event_id // 50 AS page, event_id FROM events),
p AS (SELECT ingestion_date, channel_id, page, page % {BROKEN} = 0 AS cut, count(*) AS n, sum(event_id) AS ids FROM e GROUP BY ALL)
SELECT ingestion_date, channel_id, CAST(coalesce(sum(n) FILTER (NOT cut), 0) AS BIGINT) AS items, CAST(coalesce(sum(ids) FILTER (NOT cut), 0) AS BIGINT) AS ids,
       count(*) FILTER (cut) AS broken FROM p GROUP BY ALL""",
    "slicer_pinned": "SELECT CASE WHEN ts < TIMESTAMP '2024-01-21' THEN event_id ELSE -event_id END AS event_id, ts < TIMESTAMP '2024-01-21' AS first FROM events",
    "dq_seventeen_tables": f"WITH {RAW}, {S_CHANNEL}, {VIDEO_VERSIONS}, r AS ({_checks()}) SELECT *, violations = 0 AS passed FROM r",
}
