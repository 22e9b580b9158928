"""Streaming slice, raw envelopes, table store and the layered builds end to end."""

from __future__ import annotations

import json
import os
import tempfile

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tidemark.sources import fixtures as fx
from tidemark.sources.raw import read_envelopes
from tidemark.sources.tables import CatalogTables
from tidemark.streaming import merge_new_files


def test_available_now_stream_merges_only_new_files(spark):
    root = tempfile.mkdtemp(prefix="stream-")
    src, ckpt = f"{root}/in", f"{root}/ckpt"
    ev = fx.table(spark, SF001, "events").select("event_id", "user_id", "event_type")
    ev.where("event_id < 100").coalesce(1).write.parquet(f"{src}/a")
    tables = CatalogTables(spark, f"{root}/wh")
    tables.create("t.events", "event_id bigint, user_id bigint, event_type string, processed_dttm timestamp")
    schema = "event_id bigint, user_id bigint, event_type string"
    merge_new_files(spark, f"{src}/*", schema, tables, "t.events", ["event_id"], ckpt)
    assert tables.read("t.events").count() == 100
    ev.where("event_id >= 100 and event_id < 150").coalesce(1).write.parquet(f"{src}/b")
    merge_new_files(spark, f"{src}/*", schema, tables, "t.events", ["event_id"], ckpt)
    assert tables.read("t.events").count() == 150
    # nothing new: the checkpoint is the watermark
    merge_new_files(spark, f"{src}/*", schema, tables, "t.events", ["event_id"], ckpt)
    assert tables.read("t.events").count() == 150


def test_raw_envelope_files(spark):
    from pyspark.sql import types as T

    root = tempfile.mkdtemp(prefix="raw-")
    day = f"{root}/videos/ingestion_date=2024-01-01/channel_id=c1"
    os.makedirs(day)
    with open(f"{day}/video.json", "w") as fh:  # a top-level array of envelopes
        json.dump([{"items": [{"id": "a"}, {"id": "b"}]}, {"kind": "no items"}, {"items": [{"id": "c"}]}], fh)
    item = T.StructType([T.StructField("id", T.StringType())])
    out = read_envelopes(spark, f"{root}/videos/ingestion_date=2024-01-01", item, base_path=f"{root}/videos")
    got = sorted((r["i"]["id"], str(r["ingestion_date"]), r["channel_id"]) for r in out.collect())
    assert got == [("a", "2024-01-01", "c1"), ("b", "2024-01-01", "c1"), ("c", "2024-01-01", "c1")]
    ddl = read_envelopes(spark, f"{root}/videos/ingestion_date=2024-01-01", "struct<id:string>",
                         base_path=f"{root}/videos")
    assert sorted(r["i"]["id"] for r in ddl.collect()) == ["a", "b", "c"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_envelopes(spark, f"{root}/videos/ingestion_date=2024-01-09", item, base_path=f"{root}/videos").count()


def test_table_store_partition_merge_empties_a_partition(spark):
    from tidemark.operators.merge import OPERATION

    root = tempfile.mkdtemp(prefix="store-")
    tables = CatalogTables(spark, root)
    tables.create("ns.t", "k int, day date, v int", partition_by="day")
    tables.append("ns.t", spark.createDataFrame([(1, None, 1)], "k int, day string, v int")
                  .withColumn("day", F.lit("2024-01-01").cast("date")))
    tables.append("ns.t", spark.createDataFrame([(2, "2024-01-02", 2)], "k int, day string, v int")
                  .withColumn("day", F.col("day").cast("date")))
    changes = spark.createDataFrame([(1, "2024-01-01", None, "delete")], f"k int, day string, v int, {OPERATION} string") \
        .withColumn("day", F.col("day").cast("date"))
    tables.merge("ns.t", changes, lambda t, c: t.join(c.select("k", "day"), ["k", "day"], "left_anti"))
    assert [(r.k, r.v) for r in tables.read("ns.t").collect()] == [(2, 2)]
    assert tables.namespaces() == ["ns"]


@pytest.fixture(scope="module")
def warehouse(spark):
    from tidemark.plans.runner import Warehouse

    root = tempfile.mkdtemp(prefix="e2e-")
    ev = fx.table(spark, SF001, "events")
    for day in (1, 2, 3):
        fx.write_raw_day(ev, day, f"{root}/raw")
    m = Warehouse(spark, f"{root}/wh", f"{root}/raw")
    for day in (1, 2, 3):
        m.load_day(f"2024-01-0{day}")
    return m


def test_layers_end_to_end_quality(warehouse):
    res = warehouse.quality()
    failed = [(r.table_name, r.check_name, r.violations) for r in res.where("not passed").collect()]
    assert failed == []
    assert res.count() == 75


def test_layers_end_to_end_content(warehouse):
    t = warehouse.tables
    assert t.read("bronze.videos").count() == t.read("silver.s_video_stats").count()
    assert t.read("gold.fct_video_daily").count() == t.read("silver.s_video_stats").count()
    s_video = t.read("silver.s_video")
    # a video missing on a day of its channel gets an unavailable version
    assert s_video.where("not is_available").count() > 0
    # channel 1 was renamed on day 2: two versions, intervals tile
    ch = t.read("silver.s_channel").where("channel_id = 'c1'").orderBy("valid_from_dttm").collect()
    assert [r.title for r in ch] == ["channel 1", "channel 1 renamed"]
    assert ch[0].valid_to_dttm == ch[1].valid_from_dttm and ch[1].valid_to_dttm is None
    # deltas: sum of deltas = last - first per video
    f = t.read("gold.fct_video_daily")
    agg = f.groupBy("video_id").agg(F.sum("views_delta").alias("d"), F.min_by("views_cnt", "calendar_dt").alias("a"),
                                    F.max_by("views_cnt", "calendar_dt").alias("b"))
    assert agg.where("coalesce(d, 0) != b - a").count() == 0


def test_resync_dimensions(warehouse):
    t = warehouse.tables
    before = sorted((r.video_id, r.valid_from_dttm) for r in t.read("gold.dim_video").collect())
    warehouse.resync_dimensions()
    after = sorted((r.video_id, r.valid_from_dttm) for r in t.read("gold.dim_video").collect())
    assert after == before  # nothing was deleted in silver, so nothing changes
    assert warehouse.quality(["gold.dim_video", "gold.dim_channel"]).where("not passed").count() == 0


def test_rerun_same_day_is_noop(warehouse):
    before = warehouse.tables.read("silver.s_video").select("video_id", "valid_from_dttm", "processed_dttm").collect()
    warehouse.load_day("2024-01-03")
    after = warehouse.tables.read("silver.s_video").select("video_id", "valid_from_dttm", "processed_dttm").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))


def test_quality_selection(warehouse):
    res = warehouse.quality(["gold.dim_calendar"])
    assert res.count() == 3
    with pytest.raises(ValueError):
        warehouse.quality(["silver.s_vidoe"])


def test_merge_clause_builders_reject_empty():
    from tidemark.sources.tables import assignments, scd1_merge_clauses

    with pytest.raises(ValueError):
        assignments([])
    with pytest.raises(ValueError):
        scd1_merge_clauses("ns.t", ["a"], [])


def test_read_matching_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="prune-")
    tables = CatalogTables(spark, root)
    tables.create("ns.f", "k int, calendar_dt date, v int", partition_by="calendar_dt")
    data = spark.createDataFrame([(1, "2024-01-01", 1), (1, "2024-01-02", 2)], "k int, calendar_dt string, v int") \
        .withColumn("calendar_dt", F.col("calendar_dt").cast("date"))
    tables.append("ns.f", data)
    rows = data.where("v = 2")
    got = tables.read_matching("ns.f", rows, ["k", "calendar_dt"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(calendar_dt" in plan and "dynamicpruning" in plan and got.count() == 1
    # a partition column outside the key says nothing about where a match is stored
    assert tables.read_matching("ns.f", rows, ["k"]).count() == 2


def test_declared_quality_columns_exist():
    from tidemark.plans.layers import SCHEMAS
    from tidemark.plans.runner import SPECS

    cols = {name: {c.split()[0] for c in ddl.split(",")} | {"processed_dttm"} for name, ddl in SCHEMAS.items()}
    assert {s.name for s in SPECS} == set(SCHEMAS)
    for spec in SPECS:
        used = set(spec.key_columns) | set(spec.measure_columns) | {c for c, _ in spec.references}
        if spec.business_key:
            used |= {spec.business_key, "valid_to_dttm"}
        assert used <= cols[spec.name], (spec.name, used - cols[spec.name])
        for column, parent in spec.references:
            assert column in cols[parent], (spec.name, column, parent)


def test_watermark_commits_only_after_the_write(spark, warehouse, monkeypatch):
    from tidemark.operators.slices import Watermarks

    marks = Watermarks(spark, "gold.fct_channel_daily", warehouse.marks_path)
    before = marks.read("gold.fct_video_daily")
    assert before is not None
    # an empty slice leaves the mark where it is
    warehouse.load_gold()
    assert marks.read("gold.fct_video_daily") == before
    # force new rows into the input, then fail the write: the mark must not move
    fct = warehouse.tables.read("gold.fct_video_daily")
    warehouse.tables.append("gold.fct_video_daily", fct.limit(1).withColumn("views_cnt", F.lit(10**9))
                            .withColumn("processed_dttm", F.current_timestamp()))

    real_merge = warehouse.tables.merge

    def boom(name, *args, **kwargs):
        if name == "gold.fct_channel_daily":
            raise RuntimeError("write failed")
        return real_merge(name, *args, **kwargs)

    monkeypatch.setattr(warehouse.tables, "merge", boom)
    with pytest.raises(RuntimeError):
        warehouse.load_gold()
    assert marks.read("gold.fct_video_daily") == before
    monkeypatch.undo()
    warehouse.load_gold()
    assert marks.read("gold.fct_video_daily") > before


def test_raw_sink_rerun_replaces_the_day(spark):
    root = tempfile.mkdtemp(prefix="rawsink-")
    ev = fx.table(spark, SF001, "events")
    fx.write_raw_day(ev, 1, root)
    fx.write_raw_day(ev, 2, root)
    fx.write_raw_day(ev, 1, root)  # rerun of day 1
    from tidemark.plans.layers import VIDEO_ITEM

    items = read_envelopes(spark, f"{root}/videos", VIDEO_ITEM, multi_line=False)
    per_day = {str(r["ingestion_date"]): r["count"] for r in items.groupBy("ingestion_date").count().collect()}
    expected = fx.snapshot(ev.where(fx.ts_in_days(1, 1))).count()
    assert per_day["2024-01-01"] == expected and set(per_day) == {"2024-01-01", "2024-01-02"}


def test_failed_batch_is_replayed(spark):
    from tidemark.operators.merge import apply_scd1, scd1_changes
    from tidemark.streaming import run_available_now

    root = tempfile.mkdtemp(prefix="replay-")
    src, ckpt = f"{root}/in", f"{root}/ckpt"
    fx.table(spark, SF001, "events").select("event_id", "event_type").where("event_id < 40") \
        .coalesce(1).write.parquet(f"{src}/a")
    tables = CatalogTables(spark, f"{root}/wh")
    tables.create("t.e", "event_id bigint, event_type string, processed_dttm timestamp")
    calls = {"n": 0}

    def handle(batch, epoch_id):
        calls["n"] += 1
        current = tables.read("t.e")
        changes = scd1_changes(current, batch, ["event_id"])
        tables.merge("t.e", changes.select(*current.columns, "_operation"),
                     lambda t, c: apply_scd1(t, c, ["event_id"]))
        if calls["n"] == 1:
            raise RuntimeError("executor lost after the write")

    with pytest.raises(Exception):
        run_available_now(spark, f"{src}/*", "event_id bigint, event_type string", handle, ckpt)
    run_available_now(spark, f"{src}/*", "event_id bigint, event_type string", handle, ckpt)
    assert calls["n"] == 2  # the failed batch was replayed, not skipped
    assert tables.read("t.e").count() == 40  # and the replay did not duplicate rows


def test_envelope_items_are_written_alone_and_sorted_without_a_function(spark):
    from tidemark.sources.raw import to_envelopes

    df = spark.createDataFrame([("a", 49, "é \"q\" \\ ,", 1), ("a", 3, None, 2), ("a", 50, "x", None), ("b", 7, "]}", 4), (None, 1, "n", 5)], "g string, o int, s string, v int")
    whole = lambda item: {(g, page): text for g, page, text in df.withColumn("p", F.floor(F.col("o") / 50)).orderBy("o").coalesce(1)
                          .groupBy("g", "p").agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct("o", item.alias("i"))))["i"].alias("items")))).collect()}
    for item in (F.struct("s", F.struct("v").alias("more")), F.col("o"), F.when(F.col("v") != 4, F.struct("s", "v"))):
        got = to_envelopes(df, ["g"], item, "o")
        assert {(r["g"], r["__page"]): r["envelope"] for r in got.collect()} == whole(item)
        assert "lambda" not in got._jdf.queryExecution().executedPlan().toString()


def test_raw_days_read_the_events_once(spark):
    from tidemark.plans.layer_queries import Raw

    plan = Raw(spark, SF001).days._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_raw_days_leave_out_events_without_user_or_time(spark, tmp_path):
    from tidemark.plans.layer_queries import Raw

    spark.sql("""SELECT * FROM VALUES (1L, TIMESTAMP_NTZ'2024-01-01 01:00:00', 7L, 'click', 1.5D), (2L, TIMESTAMP_NTZ'2024-01-01 02:00:00', 7L, 'purchase', 2D),
                 (3L, TIMESTAMP_NTZ'2024-01-03 01:00:00', 7L, 'click', 1D), (4L, NULL, 7L, 'click', 1D), (5L, TIMESTAMP_NTZ'2024-01-01 01:00:00', NULL, 'click', 1D)
                 AS t(event_id, ts, user_id, event_type, value)""").write.parquet(str(tmp_path / "events.parquet"))
    got = Raw(spark, str(tmp_path)).days.orderBy("calendar_dt").select("user_id", "attr", "v", "n", "views", "likes", "comments", "channel_id").collect()
    assert [tuple(r) for r in got] == [(7, "purchase", 350, 2, "2", "1", "1", "c7"), (7, "click", 100, 1, "3", "1", "2", "c7")]


def test_versions_of_the_video_dimension_share_the_shuffle(spark, monkeypatch):
    import re

    from tidemark.plans import loads

    built, build = [], loads.L.build_dim_video
    monkeypatch.setattr(loads.L, "build_dim_video", lambda *a: built.append(build(*a)) or built[-1])
    loads.load_dim_video(spark, SF001)
    assert len(built) == 2
    for df in built:
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        moved = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(video_id#\d+, __bucket", line)]
        assert sorted("ReusedExchange" in line for line in moved) == [False, True]


def test_load_s_video_derives_hub_and_links_once(spark, monkeypatch):
    from tidemark.plans import loads

    given, build = [], loads.L.build_s_video
    monkeypatch.setattr(loads.L, "build_s_video", lambda *a: given.append(a[2:4]) or build(*a))
    loads.load_s_video(spark, SF001)
    assert len(given) == 2
    for df in (x for pair in given for x in pair):
        assert "Aggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_dq_writes_every_table_once_and_damaged_ones_again(spark, monkeypatch):
    from tidemark.plans import loads

    written, materialize = [], loads.materialize
    monkeypatch.setattr(loads, "materialize", lambda df: written.append(df.columns) or materialize(df))
    got = {(r["table_name"], r["check_name"]): r["violations"] for r in loads.dq_seventeen_tables(spark, SF001).collect()}
    assert len(written) == 1 + len(loads.SPECS) + 3  # the days, the tables, the damaged tables
    assert got["gold.fct_video_daily", "no_negative"] > 0 and got["silver.s_channel", "no_duplicates"] > 0
    assert got["silver.s_video", "no_orphans[video_id]"] > 0 and got["gold.fct_channel_daily", "no_negative"] == 0
