"""Registered queries that write stored tables and read them back, and their oracles.

Every store lives in a fresh folder under the checkpoint folder; the inputs are
derived from the given tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.history import VALID_FROM, VALID_TO, build_versions, scd2_upsert
from tidemark.operators.shapes import day_over_day
from tidemark.operators.slices import Slicer, Watermarks
from tidemark.plans import scenarios as sc
from tidemark.plans.oracle import RESENT, SNAP, _scd2_upsert_sql
from tidemark.session import checkpoint_dir, materialize
from tidemark.sources import fixtures as fx
from tidemark.sources.tables import CatalogTables
from tidemark.sources.writers import write_scd1, write_scd2

VERSION_COLS = ["user_id", "attr", VALID_FROM, VALID_TO]


def _root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-store-{uuid.uuid4().hex}"


# ---------------------------------------------------------- hot and late keys

def hot_key_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of lineitem's flag by ship date; one key holds a third of the orders."""
    li = fx.table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_orderkey"))
    rows = li.groupBy(key.alias("k"), F.col("l_shipdate").cast("timestamp_ntz").alias(VALID_FROM)).agg(F.max("l_returnflag").alias("attr"))
    return build_versions(rows, "k").select("k", "attr", VALID_FROM, VALID_TO)


def delta_after_2038(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-over-day difference of dates twenty years on."""
    snap = sc.Scenario(spark, sf_dir).snap().select("user_id", F.date_add("calendar_dt", 7305).alias("calendar_dt"), "v")
    return day_over_day(snap, "user_id", "calendar_dt", ["v"]).select("user_id", "calendar_dt", "v", "v_delta")


# ---------------------------------------------------------------- SCD1 writes

def _last_seen(spark: SparkSession, sf_dir: str, first: int, last: int) -> DataFrame:
    e = fx.table(spark, sf_dir, "events").where(fx.ts_in_days(first, last))
    return e.groupBy("user_id").agg(F.max("ts").cast("timestamp_ntz").alias("seen_at"), F.count("*").alias("cnt"))


def scd1_write_moved_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts of a table stored by the day of ``seen_at``, which moves with every load."""
    t = CatalogTables(spark, _root(spark))
    t.create("s.seen", "user_id bigint, seen_at timestamp_ntz, cnt bigint, processed_dttm timestamp",
             partition_by="seen_day", partition_expr=F.to_date("seen_at"))
    for first, last in ((1, 15), (10, 30)):
        write_scd1(t, "s.seen", _last_seen(spark, sf_dir, first, last), ["user_id"], "upsert")
    return t.read("s.seen").select("user_id", "seen_at", "cnt")


def scd1_write_foreign_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a table whose plain partition column is no part of the key."""
    t = CatalogTables(spark, _root(spark))
    t.create("s.seen", "user_id bigint, cnt bigint, seen_day date, processed_dttm timestamp", partition_by="seen_day")
    for first, last in ((1, 15), (10, 30)):
        rows = _last_seen(spark, sf_dir, first, last).select("user_id", "cnt", F.to_date("seen_at").alias("seen_day"))
        write_scd1(t, "s.seen", rows, ["user_id"], "upsert")
    return t.read("s.seen").select("user_id", "cnt", "seen_day")


SEEN = """
a AS (SELECT user_id, max(ts) AS seen_at, count(*) AS cnt FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id),
b AS (SELECT user_id, max(ts) AS seen_at, count(*) AS cnt FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-31' GROUP BY user_id),
seen AS (SELECT * FROM b UNION ALL SELECT * FROM a WHERE user_id NOT IN (SELECT user_id FROM b))"""


# ---------------------------------------------------------------- SCD2 writes

def scd2_write_from_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late days merged into a stored table that is kept by closing day."""
    s = sc.Scenario(spark, sf_dir)
    first, last = sc.LATE_DAYS
    t = CatalogTables(spark, _root(spark))
    t.create("s.versions", f"user_id bigint, attr string, {VALID_FROM} timestamp_ntz, {VALID_TO} timestamp_ntz, processed_dttm timestamp",
             partition_by="valid_to_day", partition_expr=F.to_date(VALID_TO))
    keys = ["user_id", VALID_FROM]
    write_scd2(t, "s.versions", s.versions_input(~sc.days(first, last)), "user_id", keys, "insert")
    write_scd2(t, "s.versions", s.versions_input(sc.days(first, last)), "user_id", keys, "upsert", "from_dt")
    return t.read("s.versions").select(*VERSION_COLS)


def scd2_write_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a table laid out by the hash of its business key: the join of the
    stored versions with the touched keys moves no stored row."""
    s = sc.Scenario(spark, sf_dir)
    first, last = sc.LATE_DAYS
    t = CatalogTables(spark, _root(spark))
    t.create("s.versions", f"user_id bigint, attr string, {VALID_FROM} timestamp_ntz, {VALID_TO} timestamp_ntz, processed_dttm timestamp",
             bucket_by=("user_id", 8))
    keys = ["user_id", VALID_FROM]
    write_scd2(t, "s.versions", s.versions_input(~sc.days(first, last)), "user_id", keys, "insert")
    write_scd2(t, "s.versions", s.versions_input(sc.days(first, last)), "user_id", keys, "upsert", "full")
    return t.read("s.versions").select(*VERSION_COLS)


def _resent(mode: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = sc.Scenario(spark, sf_dir)
        target = materialize(s.versions().withColumn("processed_dttm", F.lit(sc.FIXED_PROCESSED).cast("timestamp")))
        snap = s.snap(sc.days(*sc.LATE_DAYS))
        attr = F.when(F.col("day") == 10, F.lit("x")).otherwise(F.concat(F.lower("attr"), F.expr("cast(day div 2 as string)")))
        source = snap.select("user_id", attr.alias("attr"), F.col("calendar_dt").cast("timestamp_ntz").alias(VALID_FROM))
        return scd2_upsert(target, source, "user_id", ["user_id", VALID_FROM], mode).select(*VERSION_COLS)

    run.__name__ = f"scd2_resent_{mode}"
    return run


# --------------------------------------------------------------------- slices

def slicer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sliced runs over a growing table: up to day 20, all of it, all of it again."""
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    marks = Watermarks(spark, "slicer_runs", f"{_root(spark)}/marks")
    out = None
    for run, table in enumerate((events.where(fx.ts_in_days(1, 20)), events, events), 1):
        slicer = Slicer(marks, "events", "ts")
        rows = materialize(slicer.run(table)).select("event_id", F.lit(run).alias("run"))
        slicer.commit()
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {
    "hot_key_versions": hot_key_versions,
    "delta_after_2038": delta_after_2038,
    "scd1_write_moved_partition": scd1_write_moved_partition,
    "scd1_write_foreign_partition": scd1_write_foreign_partition,
    "scd2_write_from_dt": scd2_write_from_dt,
    "scd2_write_bucketed": scd2_write_bucketed,
    **{f"scd2_resent_{mode}": _resent(mode) for mode in ("no", "from_dt", "full")},
    "slicer_runs": slicer_runs,
}

ORACLE = {
    "hot_key_versions": """WITH r AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_orderkey END AS k, CAST(l_shipdate AS TIMESTAMP) AS valid_from_dttm, max(l_returnflag) AS attr
  FROM lineitem GROUP BY ALL),
p AS (SELECT *, lag(attr) OVER (PARTITION BY k ORDER BY valid_from_dttm) AS prev FROM r)
SELECT k, attr, valid_from_dttm, lead(valid_from_dttm) OVER (PARTITION BY k ORDER BY valid_from_dttm) AS valid_to_dttm
FROM p WHERE prev IS NULL OR prev <> attr""",
    "delta_after_2038": f"""WITH {SNAP}
SELECT user_id, calendar_dt + 7305 AS calendar_dt, v, v - lag(v) OVER (PARTITION BY user_id ORDER BY calendar_dt) AS v_delta FROM snap""",
    "scd1_write_moved_partition": f"WITH {SEEN} SELECT user_id, seen_at, cnt FROM seen",
    "scd1_write_foreign_partition": f"WITH {SEEN} SELECT user_id, cnt, CAST(seen_at AS DATE) AS seen_day FROM seen",
    "scd2_write_from_dt": _scd2_upsert_sql("from_dt"),
    "scd2_write_bucketed": _scd2_upsert_sql("full"),
    **{f"scd2_resent_{mode}": _scd2_upsert_sql(mode, "true", RESENT) for mode in ("no", "from_dt", "full")},
    "slicer_runs": "SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS run FROM events",
}
