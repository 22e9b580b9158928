"""Registered queries: one per operator family, each over the driver's tables.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names equal those of the matching oracle SQL (``tidemark.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import iso_duration_seconds, link_key
from tidemark.operators import quality as dq
from tidemark.operators.history import (
    OPERATION,
    VALID_FROM,
    VALID_TO,
    collapse,
    scd2_changes,
    scd2_upsert,
)
from tidemark.operators.joins import as_of_carried, as_of_join, new_keys
from tidemark.operators.merge import scd1_changes, scd1_insert, scd1_rewrite, scd1_upsert
from tidemark.operators.shapes import day_over_day, disappeared, group_totals, incremental_delta, presence, reaggregate_affected, retract_and_add, sum_or_null
from tidemark.operators.slices import rows_after
from tidemark.plans import scenarios as sc
from tidemark.session import materialize
from tidemark.sources import fixtures as fx
from tidemark.sources.calendar import calendar_between
from tidemark.sources.raw import parse_envelopes, to_envelopes

Query = Callable[[SparkSession, str], DataFrame]
VERSION_COLS = ["user_id", "attr", VALID_FROM, VALID_TO]


# ------------------------------------------------------------------ hubs/links

def hub_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sc.Scenario(spark, sf_dir).events
    return new_keys(ev, None, "user_id", "ts", alias="created_at")


def hub_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_id"), "o_orderdate")
    split = F.lit(sc.HUB_SPLIT_DATE + " 00:00:00").cast("timestamp_ntz")
    hub = new_keys(orders.where(F.col("o_orderdate") < split), None, "customer_id", "o_orderdate")
    incoming = orders.where(F.col("o_orderdate") >= split)
    return new_keys(incoming, hub, "customer_id", "o_orderdate", alias="created_at")


def _links(events: DataFrame) -> DataFrame:
    pairs = events.groupBy("user_id", "event_type").agg(F.min("ts").alias("created_at"))
    return pairs.withColumn("link_id", link_key("user_id", "event_type")).select(
        "link_id", "user_id", "event_type", "created_at")


def link_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(sc.Scenario(spark, sf_dir).events)


def link_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sc.Scenario(spark, sf_dir).events
    existing = _links(ev.where(fx.ts_in_days(1, sc.LINK_SPLIT_DAY)))
    incoming = _links(ev.where(F.col("ts") >= fx.day_start(sc.LINK_SPLIT_DAY + 1)))
    return incoming.join(existing.select("link_id"), "link_id", "left_anti")


def ref_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sc.Scenario(spark, sf_dir).events
    return ev.select(F.col("event_type").alias("category_id"),
                     F.upper("event_type").alias("category_name"),
                     (F.col("event_type") != "error").alias("is_assignable")).distinct()


# ------------------------------------------------------------------ raw / scalar

ITEM_SCHEMA = "struct<id:bigint,snippet:struct<userId:bigint,eventType:string>,props:string>"


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sc.Scenario(spark, sf_dir).events
    item = F.struct(F.col("event_id").alias("id"),
                    F.struct(F.col("user_id").alias("userId"), F.col("event_type").alias("eventType")).alias("snippet"),
                    F.col("props").alias("props"))
    env = to_envelopes(ev.withColumn("calendar_dt", F.to_date("ts")), ["user_id", "calendar_dt"], item, "event_id")
    items = parse_envelopes(env, "envelope", ITEM_SCHEMA)
    return items.select(F.col("i.id").alias("event_id"),
                        F.col("i.snippet.userId").alias("user_id"),
                        F.col("i.snippet.eventType").alias("event_type"),
                        F.get_json_object("i.props", "$.k").try_cast("bigint").alias("k"))


RAW_ITEM_SCHEMA = ("struct<id:string,snippet:struct<publishedAt:string,channelId:string,title:string>,"
                   "contentDetails:struct<duration:string,caption:string,contentRating:map<string,string>>,"
                   "statistics:struct<viewCount:string>>")
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def bronze_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw envelopes (all text but a map) -> explicit schema -> typed bronze row."""
    ev = sc.Scenario(spark, sf_dir).events
    item = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.date_format("ts", ISO_SECONDS).alias("publishedAt"),
                 F.concat(F.lit("c"), (F.col("user_id") % 10).cast("string")).alias("channelId"),
                 F.col("event_type").alias("title")).alias("snippet"),
        F.struct(F.concat(F.lit("PT"), F.floor("value").cast("string"), F.lit("S")).alias("duration"),
                 F.when(F.col("event_type") == "click", "true").when(F.col("event_type") == "view", "false")
                 .otherwise("maybe").alias("caption"),
                 F.when(F.col("event_type") == "error",
                        F.create_map(F.lit("k"), F.get_json_object("props", "$.k")))
                 .otherwise(F.create_map().cast("map<string,string>")).alias("contentRating")).alias("contentDetails"),
        F.struct(F.when(F.col("event_type") == "signup", F.lit("n/a"))
                 .otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string")).alias("viewCount"))
        .alias("statistics"))
    env = to_envelopes(ev.withColumn("ingestion_date", F.to_date("ts")), ["user_id", "ingestion_date"], item,
                       "event_id")
    items = parse_envelopes(env, "envelope", RAW_ITEM_SCHEMA, keep=["ingestion_date"])
    published = F.col("i.snippet.publishedAt")
    return items.select(
        F.col("i.id").alias("id"),
        F.col("ingestion_date").alias("calendar_dt"),
        F.when(published.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"),
               F.to_timestamp_ntz(published, F.lit(ISO_SECONDS))).alias("published_at"),
        F.col("i.snippet.channelId").alias("channel_id"),
        F.col("i.snippet.title").alias("title"),
        iso_duration_seconds("i.contentDetails.duration").alias("duration_sec"),
        F.col("i.contentDetails.caption").try_cast("boolean").alias("caption"),
        F.to_json("i.contentDetails.contentRating").alias("content_rating"),
        F.col("i.statistics.viewCount").try_cast("bigint").alias("view_count"))


def _duration_text() -> F.Column:
    k, s = F.col("p_partkey"), F.col("p_size")
    m = F.pmod(k, F.lit(6))
    txt = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    return (F.when(m == 0, txt("PT", F.pmod(s, F.lit(3)).cast("string"), "H", s.cast("string"), "M",
                               F.pmod(k, F.lit(60)).cast("string"), "S"))
            .when(m == 1, txt("PT", s.cast("string"), "M"))
            .when(m == 2, txt("P", F.pmod(s, F.lit(4)).cast("string"), "D"))
            .when(m == 3, F.lit("PT"))
            .when(m == 4, txt("P1DT", F.pmod(s, F.lit(24)).cast("string"), "H")))


def duration_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fx.table(spark, sf_dir, "part").select("p_partkey", _duration_text().alias("duration"))
    return part.select("p_partkey", "duration", iso_duration_seconds("duration").alias("duration_sec"))


# ------------------------------------------------------------------ stats

EVENT_TYPES = ("view", "click", "purchase", "signup", "error")


def stats_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sc.Scenario(spark, sf_dir).events
    cents = F.round(F.col("value") * 100)
    typed = [F.sum(F.when(F.col("event_type") == t, cents)).cast("bigint").alias(f"{t}_total") for t in EVENT_TYPES]
    return (ev.groupBy("user_id", F.to_date("ts").alias("calendar_dt"))
            .agg(F.count("event_id").alias("events_cnt"), F.sum(cents).cast("bigint").alias("value_total"), *typed))


# ------------------------------------------------------------------ history

def collapse_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    inp = sc.Scenario(spark, sf_dir).versions_input()
    return collapse(inp, ["user_id"], ["attr"])


def scd2_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.Scenario(spark, sf_dir).versions().select(*VERSION_COLS)


def _late_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = sc.Scenario(spark, sf_dir)
    first, last = sc.LATE_DAYS
    target_days = sc.days(1, sc.LATE_TARGET_LAST_DAY) & ~sc.days(first, last)
    target = s.versions(target_days).withColumn("processed_dttm", F.lit(sc.FIXED_PROCESSED).cast("timestamp"))
    source = s.versions_input(sc.days(first, last))
    # The target of a merge is a stored table: store it once.
    target = materialize(target)
    return target, source


def _scd2_upsert(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        target, source = _late_days(spark, sf_dir)
        return scd2_upsert(target, source, "user_id", ["user_id", VALID_FROM], mode).select(*VERSION_COLS)

    run.__name__ = f"scd2_upsert_{mode}"
    return run


def _scd2_changes(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        target, source = _late_days(spark, sf_dir)
        ch = scd2_changes(target, source, "user_id", ["user_id", VALID_FROM], mode)
        return ch.select(*VERSION_COLS, OPERATION)

    run.__name__ = f"scd2_changes_{mode}"
    return run


def scd2_in_order_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sc.Scenario(spark, sf_dir)
    target = materialize(s.versions(sc.days(1, sc.IN_ORDER_SPLIT_DAY)))
    source = s.versions_input(sc.from_day(sc.IN_ORDER_SPLIT_DAY + 1))
    return scd2_upsert(target, source, "user_id", ["user_id", VALID_FROM], "from_dt").select(*VERSION_COLS)


# ------------------------------------------------------------------ SCD1

def _scd1_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = sc.Scenario(spark, sf_dir)
    target = s.pair_counts(*sc.SCD1_TARGET_DAYS).withColumn(
        "processed_dttm", F.lit(sc.FIXED_PROCESSED).cast("timestamp"))
    source = s.pair_counts(*sc.SCD1_SOURCE_DAYS)
    return target, source


def scd1_upsert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _scd1_inputs(spark, sf_dir)
    state = scd1_upsert(target, source, ["user_id", "event_type"])
    return state.select("user_id", "event_type", "cnt",
                        (F.col("processed_dttm") != F.lit(sc.FIXED_PROCESSED).cast("timestamp")).alias("refreshed"))


def scd1_changes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _scd1_inputs(spark, sf_dir)
    return scd1_changes(target, source, ["user_id", "event_type"]).select("user_id", "event_type", "cnt", OPERATION)


def scd1_insert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _scd1_inputs(spark, sf_dir)
    return scd1_insert(target, source).select("user_id", "event_type", "cnt")


def scd1_rewrite_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, source = _scd1_inputs(spark, sf_dir)
    return scd1_rewrite(source).select("user_id", "event_type", "cnt")


# ------------------------------------------------------------------ slices

def slice_after_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = sc.Scenario(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type")
    return rows_after(ev, "ts", sc.WATERMARK)


# ------------------------------------------------------------------ disappearance

def _cohort_snap(s: sc.Scenario, where) -> DataFrame:
    return s.snap(where).withColumn("cohort_id", fx.cohort())


def _disappear_inputs(s: sc.Scenario):
    hist = _cohort_snap(s, sc.days(1, sc.DISAPPEAR_DAY - 1))
    links = hist.select("user_id", "cohort_id").distinct()
    hubs = hist.groupBy("user_id").agg(F.min(F.col("calendar_dt").cast("timestamp_ntz")).alias("created_at"))
    versions = s.versions(sc.days(1, sc.DISAPPEAR_DAY - 1), available=True)
    return links, hubs, versions


def _missing(s: sc.Scenario, first: int, last: int, links, hubs, versions) -> DataFrame:
    slice_ = _cohort_snap(s, sc.days(first, last))
    everything = _cohort_snap(s, None)
    return disappeared(slice_, presence(everything, "user_id", "calendar_dt"), links, hubs, versions, "user_id", "cohort_id", "calendar_dt")


def disappeared_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sc.Scenario(spark, sf_dir)
    links, hubs, versions = _disappear_inputs(s)
    return _missing(s, sc.DISAPPEAR_DAY, sc.DISAPPEAR_DAY, links, hubs, versions).select(
        "user_id", "attr", "is_available", VALID_FROM)


def disappeared_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sc.Scenario(spark, sf_dir)
    links, hubs, versions = _disappear_inputs(s)
    return _missing(s, sc.DISAPPEAR_DAY, sc.DISAPPEAR_DAY + 1, links, hubs, versions).select(
        "user_id", "attr", "is_available", VALID_FROM)


def reappeared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 25 then day 26 loaded through disappearance + SCD2 ``from_dt``."""
    s = sc.Scenario(spark, sf_dir)
    links, hubs, state = _disappear_inputs(s)
    state = materialize(state)
    key = ["user_id", VALID_FROM]
    for day in (sc.DISAPPEAR_DAY, sc.DISAPPEAR_DAY + 1):
        present = s.versions_input(sc.days(day, day), available=True)
        gone = _missing(s, day, day, links, hubs, state).select(*present.columns)
        # Each load reads the previous state: cut the lineage between loads with a
        # reliable checkpoint (spark.checkpoint.dir), as a table write would.
        state = scd2_upsert(state, present.unionByName(gone), "user_id", key, "from_dt").checkpoint()
    day26 = fx.day_start(sc.DISAPPEAR_DAY + 1)
    back = state.where((F.col(VALID_FROM) == day26) & F.col("is_available"))
    before = state.where((F.col(VALID_TO) == day26) & ~F.col("is_available")).select("user_id")
    return back.join(before, "user_id", "left_semi").select("user_id", "attr", VALID_FROM)


# ------------------------------------------------------------------ facts

def as_of_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sc.Scenario(spark, sf_dir)
    stats = s.snap().select("user_id", "calendar_dt", "v")
    versions = s.versions().select("user_id", "attr", VALID_FROM, VALID_TO)
    return as_of_join(stats, versions, "user_id", "calendar_dt").select("user_id", "calendar_dt", "v", "attr")


def daily_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = sc.Scenario(spark, sf_dir).snap().select("user_id", "calendar_dt", "v")
    return day_over_day(snap, "user_id", "calendar_dt", ["v"])


def incremental_delta_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sc.Scenario(spark, sf_dir)
    loaded = day_over_day(s.snap(sc.days(1, sc.DELTA_SPLIT_DAY)).select("user_id", "calendar_dt", "v"),
                          "user_id", "calendar_dt", ["v"])
    slice_ = s.snap(sc.from_day(sc.DELTA_SPLIT_DAY + 1)).select("user_id", "calendar_dt", "v")
    return incremental_delta(loaded, slice_, "user_id", "calendar_dt", ["v"])


def late_delta_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 15 arrives after the rest: its deltas, and the refreshed delta of the next loaded day."""
    s = sc.Scenario(spark, sf_dir)
    late = sc.LATE_DELTA_DAY
    stored = materialize(day_over_day(s.snap(~sc.days(late, late)).select("user_id", "calendar_dt", "v"),
                                      "user_id", "calendar_dt", ["v"]))
    slice_ = s.snap(sc.days(late, late)).select("user_id", "calendar_dt", "v")
    return incremental_delta(stored, slice_, "user_id", "calendar_dt", ["v"], refresh_next=True)


def reaggregate_affected_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sc.Scenario(spark, sf_dir)
    fact = day_over_day(s.snap().select("user_id", "calendar_dt", "v"), "user_id", "calendar_dt", ["v"]) \
        .withColumn("cohort_id", fx.cohort())
    slice_ = fact.where(F.col("calendar_dt") > F.date_add(F.lit("2024-01-01").cast("date"), sc.REAGGREGATE_AFTER_DAY - 1))
    totals = reaggregate_affected(fact, slice_, ["cohort_id", "calendar_dt"], [
        F.count("user_id").alias("users_cnt"),
        F.sum("v").alias("v_total"),
        F.sum("v_delta").alias("v_delta_total"),
    ])
    cohort_stats = (s.events.groupBy(fx.cohort(), F.to_date("ts").alias("calendar_dt"))
                    .agg(F.count(F.lit(1)).alias("events_cnt")))
    return totals.join(cohort_stats, ["cohort_id", "calendar_dt"], "inner")


def as_of_carried_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sc.Scenario(spark, sf_dir)
    stats = s.snap().select("user_id", "calendar_dt", "v")
    versions = s.versions().select("user_id", "attr", VALID_FROM, VALID_TO)
    return as_of_carried(stats, versions, "user_id", "calendar_dt").select("user_id", "calendar_dt", "v", "attr")


def totals_by_retraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day totals of cohorts after the last days were sent again: every third user's value
    doubled, every seventh user gone, every fifth user in another cohort."""
    s = sc.Scenario(spark, sf_dir)
    fact = day_over_day(s.snap().select("user_id", "calendar_dt", "v"), "user_id", "calendar_dt", ["v"]).withColumn("cohort_id", fx.cohort())
    keys, sums = ["cohort_id", "calendar_dt"], ["v", "v_delta"]
    totals = materialize(group_totals(fact, keys, sums))
    before = fact.where(F.col("calendar_dt") > F.date_add(F.lit("2024-01-01").cast("date"), sc.REAGGREGATE_AFTER_DAY - 1))
    after = (before.where(F.col("user_id") % 7 != 0)
             .withColumn("v", F.when(F.col("user_id") % 3 == 0, F.col("v") * 2).otherwise(F.col("v")))
             .withColumn("cohort_id", F.when(F.col("user_id") % 5 == 0, (F.col("cohort_id") + 1) % fx.COHORTS).otherwise(F.col("cohort_id"))))
    now = retract_and_add(totals, after, before, keys, sums).where("n_rows > 0")
    return now.select(*keys, F.col("n_rows").alias("users_cnt"), sum_or_null("v").alias("v_total"), sum_or_null("v_delta").alias("v_delta_total"))


def fct_video_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily video fact (T16) loaded in two slices: days 1..20, then the rest."""
    from tidemark.plans import layers as L

    s = sc.Scenario(spark, sf_dir)
    links = s.snap().select(F.col("user_id").alias("video_id"),
                            (F.col("user_id") % fx.COHORTS).cast("string").alias("channel_id")).distinct()
    versions = s.versions().select(F.col("user_id").alias("video_id"), F.col("attr").alias("category_id"),
                                   VALID_FROM, VALID_TO)

    def stats(where):
        return s.snap(where).select(F.col("user_id").alias("video_id"), "calendar_dt",
                                    F.col("v").alias("views_cnt"), F.col("n").alias("likes_cnt"),
                                    F.lit(0).cast("bigint").alias("favorites_cnt"),
                                    (F.col("n") * 2).alias("comments_cnt"))

    nothing = L.last_video_rows(spark.createDataFrame([], L.SCHEMAS["gold.fct_video_daily"]))
    first = L.build_fct_video_daily(links, stats(sc.days(1, sc.DELTA_SPLIT_DAY)), versions, nothing)
    last = materialize(L.last_video_rows(first))  # the state the first load leaves behind
    later = stats(sc.from_day(sc.DELTA_SPLIT_DAY + 1))
    return L.build_fct_video_daily(links, later, versions, last)


def dim_denormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sc.Scenario(spark, sf_dir)
    versions = s.versions()
    hubs = new_keys(s.events, None, "user_id", "ts", alias="created_at")
    links = s.snap().select("user_id", fx.cohort()).distinct()
    categories = ref_category(spark, sf_dir).select(F.col("category_id").alias("attr"), "category_name")
    return (hubs.join(versions, "user_id", "inner")
            .join(links, "user_id", "left")
            .join(categories, "attr", "left")
            .select("user_id", "cohort_id", "created_at", "attr", "category_name", VALID_FROM, VALID_TO))


def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    bounds = orders.agg(F.min(F.to_date("o_orderdate")).alias("s"), F.max(F.to_date("o_orderdate")).alias("e"))
    return calendar_between(bounds, "s", "e")


# ------------------------------------------------------------------ quality

LINEITEM = dq.TableSpec("lineitem", ("l_orderkey", "l_linenumber"), ("l_quantity", "l_extendedprice"),
                        references=(("l_orderkey", "orders"),))
CUSTOMER = dq.TableSpec("customer", ("c_custkey",), ("c_acctbal",), references=(("c_nationkey", "nation"),))
REGION = dq.TableSpec("region", ("r_regionkey",))
DOC_LABELS = dq.TableSpec("documents_labeled", ("doc_id", "quality"), references=(("doc_id", "labels"),))
RESULT_COLS = ["table_name", "check_name", "violations", "passed"]


def _parents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    nation = fx.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"))
    return {"orders": orders, "nation": nation}


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = _parents(spark, sf_dir)
    parts = [dq.check(fx.table(spark, sf_dir, spec.name), spec, parents) for spec in (REGION, LINEITEM, CUSTOMER)]
    return reduce(DataFrame.unionByName, parts)


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir).select(*RESULT_COLS)


def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir).where(F.col("check_name") == "not_empty").select(*RESULT_COLS)


def dq_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.table(spark, sf_dir, "lineitem")
    return dq.no_duplicates(df, LINEITEM).withColumn("passed", F.col("violations") == 0).select(*RESULT_COLS)


def _labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    labels = fx.table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left")


def dq_no_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = dq.basic_checks(_labeled(spark, sf_dir), DOC_LABELS)
    return res.where(F.col("check_name") == "no_nulls_in_key").withColumn(
        "passed", F.col("violations") == 0).select(*RESULT_COLS)


def dq_no_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = dq.basic_checks(fx.table(spark, sf_dir, "customer"), CUSTOMER)
    return res.where(F.col("check_name") == "no_negative").withColumn(
        "passed", F.col("violations") == 0).select(*RESULT_COLS)


def dq_single_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _scd2_upsert("from_dt")(spark, sf_dir)
    spec = dq.TableSpec("scd2_upsert_from_dt", ("user_id", VALID_FROM), business_key="user_id")
    return dq.single_open_version(state, spec).withColumn("passed", F.col("violations") == 0).select(*RESULT_COLS)


def dq_no_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    labels = fx.table(spark, sf_dir, "labels")
    lineitem = fx.table(spark, sf_dir, "lineitem")
    a = dq.no_orphans(docs, "doc_id", labels, "labels", "documents")
    b = dq.no_orphans(lineitem, "l_orderkey", _parents(spark, sf_dir)["orders"], "orders", "lineitem")
    return a.unionByName(b).withColumn("passed", F.col("violations") == 0).select(*RESULT_COLS)


QUERIES: dict[str, Query] = {
    "hub_first_seen": hub_first_seen,
    "hub_new_keys": hub_new_keys,
    "link_md5": link_md5,
    "link_new": link_new,
    "ref_category": ref_category,
    "json_props": json_props,
    "duration_seconds": duration_seconds,
    "bronze_typed": bronze_typed,
    "stats_daily": stats_daily,
    "collapse_versions": collapse_versions,
    "scd2_build": scd2_build,
    "scd2_upsert_no": _scd2_upsert("no"),
    "scd2_upsert_from_dt": _scd2_upsert("from_dt"),
    "scd2_upsert_full": _scd2_upsert("full"),
    "scd2_changes_no": _scd2_changes("no"),
    "scd2_changes_from_dt": _scd2_changes("from_dt"),
    "scd2_changes_full": _scd2_changes("full"),
    "scd2_in_order_equals_full": scd2_in_order_equals_full,
    "scd1_upsert": scd1_upsert_q,
    "scd1_changes": scd1_changes_q,
    "scd1_insert": scd1_insert_q,
    "scd1_rewrite": scd1_rewrite_q,
    "slice_after_watermark": slice_after_watermark,
    "disappeared": disappeared_q,
    "reappeared": reappeared,
    "disappeared_two_days": disappeared_two_days,
    "as_of_join": as_of_join_q,
    "as_of_carried": as_of_carried_q,
    "totals_by_retraction": totals_by_retraction,
    "daily_delta": daily_delta,
    "incremental_delta": incremental_delta_q,
    "late_delta_refresh": late_delta_refresh,
    "reaggregate_affected": reaggregate_affected_q,
    "fct_video_daily": fct_video_daily,
    "dim_denormalised": dim_denormalised,
    "calendar_dim": calendar_dim,
    "dq_not_empty": dq_not_empty,
    "dq_summary": dq_summary,
    "dq_no_duplicates": dq_no_duplicates,
    "dq_no_nulls": dq_no_nulls,
    "dq_no_negative": dq_no_negative,
    "dq_single_open": dq_single_open,
    "dq_no_orphans": dq_no_orphans,
}
