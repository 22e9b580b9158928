"""SCD1 merges, as-of join, deltas, disappearance, re-aggregation."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import d, rows
from pyspark.sql import functions as F

from tidemark.operators.joins import as_of_carried, as_of_join, new_keys
from tidemark.operators.merge import scd1_changes, scd1_insert, scd1_rewrite, scd1_upsert
from tidemark.operators.shapes import (
    day_over_day,
    delta_from_state,
    disappeared,
    group_totals,
    incremental_delta,
    last_rows,
    late_keys,
    merge_presence,
    presence,
    reaggregate_affected,
    retract_and_add,
    sum_or_null,
)

OLD = "2020-01-01 00:00:00"
NEW = "2024-06-01 00:00:00"


def kv(spark, data, processed=None):
    df = spark.createDataFrame(data, "id int, v string")
    return df.withColumn("processed_dttm", F.lit(processed).cast("timestamp")) if processed else df


def test_scd1_upsert(spark):
    t = kv(spark, [(1, "x"), (2, None)], OLD)
    s = kv(spark, [(1, "x"), (2, "y"), (3, "z")])
    out = {r["id"]: (r["v"], str(r["processed_dttm"])[:10]) for r in scd1_upsert(t, s, ["id"], NEW).collect()}
    assert out == {1: ("x", "2020-01-01"), 2: ("y", "2024-06-01"), 3: ("z", "2024-06-01")}
    ch = scd1_changes(t, s, ["id"], NEW)
    assert rows(ch, "id", "_operation") == [(2, "update"), (3, "insert")]


def test_scd1_null_equals_null_and_null_key_inserts(spark):
    t = kv(spark, [(1, None), (None, "a")], OLD)
    s = kv(spark, [(1, None), (None, "a")])
    assert rows(scd1_changes(t, s, ["id"]), "id", "_operation") == [(None, "insert")]


def test_scd1_keys_only_table(spark):
    t = spark.createDataFrame([(1,), (2,)], "id int").withColumn("processed_dttm", F.lit(OLD).cast("timestamp"))
    s = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(scd1_changes(t, s, ["id"]), "id", "_operation") == [(3, "insert")]
    assert rows(scd1_upsert(t, s, ["id"]), "id") == [(1,), (2,), (3,)]


def test_scd1_insert_and_rewrite(spark):
    t = kv(spark, [(1, "x")], OLD)
    s = kv(spark, [(1, "x"), (2, "y")])
    assert len(scd1_insert(t, s).collect()) == 3
    assert rows(scd1_rewrite(s), "id", "v") == [(1, "x"), (2, "y")]


def test_scd1_requires_keys(spark):
    with pytest.raises(ValueError):
        scd1_changes(kv(spark, [(1, "x")]), kv(spark, [(1, "x")]), [])


def test_new_keys_pre_aggregates(spark):
    inc = spark.createDataFrame([(1, d(3)), (1, d(2)), (2, d(5)), (3, d(1))], "k int, ts timestamp_ntz")
    old = spark.createDataFrame([(3,)], "k int")
    assert rows(new_keys(inc, old, "k", "ts", alias="created_at")) == [(1, d(2)), (2, d(5))]


def test_as_of_join(spark):
    versions = spark.createDataFrame([("v", "A", d(1), d(3)), ("v", "B", d(3), None)],
                                     "k string, attr string, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz")
    stats = spark.createDataFrame([("v", dt.date(2023, 12, 31)), ("v", d(1).date()), ("v", d(2).date()),
                                   ("v", d(3).date()), ("v", d(9).date()), ("w", d(2).date())], "k string, day date")
    out = as_of_join(stats, versions, "k", "day")
    assert rows(out, "k", "day", "attr") == [
        ("v", dt.date(2023, 12, 31), None), ("v", d(1).date(), "A"), ("v", d(2).date(), "A"),
        ("v", d(3).date(), "B"), ("v", d(9).date(), "B"), ("w", d(2).date(), None)]


def test_as_of_join_copies_a_version_to_fact_buckets_only(spark):
    far = dt.datetime(9999, 12, 31)
    versions = spark.createDataFrame([("v", "A", dt.datetime(1, 1, 1), far), ("w", "B", d(1), far)],
                                     "k string, attr string, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz")
    facts = spark.createDataFrame([("v", d(5).date()), ("v", d(6).date()), ("w", dt.date(2039, 5, 1))], "k string, day date")
    out = as_of_join(facts, versions, "k", "day")
    assert rows(out, "k", "day", "attr") == [("v", d(5).date(), "A"), ("v", d(6).date(), "A"), ("w", dt.date(2039, 5, 1), "B")]
    plan = out._jdf.queryExecution().toString()
    assert "__first_bucket" in plan and "__last_bucket" in plan  # clipped at both ends


def test_as_of_join_long_history_crosses_buckets(spark):
    versions = spark.createDataFrame([("v", "A", d(1), d(200)), ("v", "B", d(200), None)],
                                     "k string, attr string, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz")
    stats = spark.createDataFrame([("v", d(n).date()) for n in range(1, 400, 7)], "k string, day date")
    out = {r["day"]: r["attr"] for r in as_of_join(stats, versions, "k", "day").collect()}
    assert all(a == ("A" if day < d(200).date() else "B") for day, a in out.items())
    assert len(out) == len(range(1, 400, 7))


def test_day_over_day_and_incremental(spark):
    sch = "k string, day date, v bigint"
    full = spark.createDataFrame([("k", d(1).date(), 10), ("k", d(2).date(), 15), ("k", d(4).date(), 12)], sch)
    assert rows(day_over_day(full, "k", "day", ["v"]), "day", "v_delta") == [
        (d(1).date(), None), (d(2).date(), 5), (d(4).date(), -3)]
    loaded = day_over_day(full.where(F.col("day") < d(3).date()), "k", "day", ["v"])
    slice_ = full.where(F.col("day") >= d(3).date())
    assert rows(incremental_delta(loaded, slice_, "k", "day", ["v"]), "day", "v_delta") == [(d(4).date(), -3)]


def test_reaggregate_affected(spark):
    fact = spark.createDataFrame([("c", 1, 5), ("c", 1, 6), ("c", 2, 7), ("e", 1, 1)], "g string, day int, v int")
    slice_ = fact.where("g = 'c' and day = 1")
    out = reaggregate_affected(fact, slice_, ["g", "day"], [F.sum("v").alias("t")])
    assert rows(out) == [("c", 1, 11)]
    pruned = reaggregate_affected(fact, slice_, ["g", "day"], [F.sum("v").alias("t")], prune_on="day")
    assert rows(pruned) == [("c", 1, 11)]


VSCHEMA = "e string, attr string, is_available boolean, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz"


def _disappear(spark, snap_rows, versions_rows, hubs_rows, slice_days):
    snaps = spark.createDataFrame(snap_rows, "e string, p string, day date")
    links = snaps.select("e", "p").distinct()
    hubs = spark.createDataFrame(hubs_rows, "e string, created_at timestamp_ntz")
    versions = spark.createDataFrame(versions_rows, VSCHEMA)
    slice_ = snaps.where(F.col("day").isin([d(n).date() for n in slice_days]))
    return disappeared(slice_, presence(snaps, "e", "day"), links, hubs, versions, "e", "p", "day")


def test_disappeared(spark):
    snap = [("e1", "c", d(1).date()), ("e2", "c", d(1).date()), ("e1", "c", d(3).date())]
    v = [("e1", "A", True, d(1), None), ("e2", "B", True, d(1), None)]
    hubs = [("e1", d(1)), ("e2", d(1))]
    out = _disappear(spark, snap, v, hubs, [3])
    assert rows(out, "e", "attr", "is_available", "valid_from_dttm") == [("e2", "B", False, d(3))]
    # already unavailable, created later, parent absent, present on another slice date
    v2 = [("e1", "A", True, d(1), None), ("e2", "B", False, d(1), None)]
    assert _disappear(spark, snap, v2, hubs, [3]).count() == 0
    assert _disappear(spark, snap, v, [("e1", d(1)), ("e2", d(5))], [3]).count() == 0
    assert _disappear(spark, snap + [("x", "z", d(4).date())], v, hubs, [4]).count() == 0
    snap2 = snap + [("e2", "c", d(4).date())]
    assert _disappear(spark, snap2, v, hubs, [3, 4]).count() == 0


def test_incremental_delta_refresh_next(spark):
    sch = "k string, day date, v bigint"
    loaded = day_over_day(spark.createDataFrame(
        [("k", d(1).date(), 10), ("k", d(2).date(), 15), ("k", d(4).date(), 12)], sch), "k", "day", ["v"])
    late = spark.createDataFrame([("k", d(3).date(), 20)], sch)
    assert rows(incremental_delta(loaded, late, "k", "day", ["v"]), "day", "v_delta") == [(d(3).date(), 5)]
    out = incremental_delta(loaded, late, "k", "day", ["v"], refresh_next=True)
    assert rows(out, "day", "v_delta") == [(d(3).date(), 5), (d(4).date(), -8)]


def test_scd1_upsert_refuses_duplicate_keys(spark):
    import tempfile

    from tidemark.sources.tables import CatalogTables
    from tidemark.sources.writers import write_scd1

    t = CatalogTables(spark, tempfile.mkdtemp(prefix="dup-"))
    t.create("n.t", "id int, v string, processed_dttm timestamp")
    with pytest.raises(ValueError, match="duplicate keys"):
        write_scd1(t, "n.t", kv(spark, [(1, "a"), (1, "b")]), ["id"], "upsert")
    write_scd1(t, "n.t", kv(spark, [(None, "a"), (None, "b"), (2, "c")]), ["id"], "upsert")
    assert t.read("n.t").count() == 3


def test_disappeared_reads_no_snapshot(spark, tmp_path):
    snaps = spark.createDataFrame([("e1", "c", d(1).date()), ("e2", "c", d(1).date()), ("e1", "c", d(3).date())], "e string, p string, day date")
    snaps.write.partitionBy("day").parquet(f"{tmp_path}/snapshots")
    stored = spark.read.parquet(f"{tmp_path}/snapshots")
    slice_ = stored.where(F.col("day") == d(3).date())
    # what was seen is merged load by load
    seen = merge_presence(presence(stored.where(F.col("day") < d(3).date()), "e", "day"), presence(slice_, "e", "day"), "e")
    seen.write.parquet(f"{tmp_path}/seen")
    links = spark.createDataFrame([("e1", "c"), ("e2", "c")], "e string, p string")
    v = spark.createDataFrame([("e1", "A", True, d(1), None), ("e2", "B", True, d(1), None)], VSCHEMA)
    hubs = spark.createDataFrame([("e1", d(1)), ("e2", d(1))], "e string, created_at timestamp_ntz")
    out = disappeared(slice_, spark.read.parquet(f"{tmp_path}/seen"), links, hubs, v, "e", "p", "day")
    assert rows(out, "e") == [("e2",)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    import re

    reads = re.findall(r"FileScan parquet.*?PartitionFilters: \[(.*?)\]", plan)
    # every read of the snapshots is a read of the slice's day
    assert reads and all("2024-01-03" in r for r in reads if "day" in r), plan


def test_presence_over_many_days(spark):
    import datetime as dt

    days = [dt.date(1969, 12, 30) + dt.timedelta(days=i) for i in range(0, 400, 7)]
    seen = presence(spark.createDataFrame([("a", x) for x in days] * 2, "e string, day date"), "e", "day").collect()
    got = sorted(r.word * 64 + b for r in seen for b in range(64) if (r.days >> b) & 1)
    assert got == [(x - dt.date(1970, 1, 1)).days for x in days]


def test_delta_from_state(spark):
    sch = "k string, day date, v bigint"
    rows_ = [("a", d(1).date(), 10), ("a", d(2).date(), 15), ("b", d(1).date(), 1), (None, d(1).date(), 5)]
    state = last_rows(spark.createDataFrame(rows_, sch), "k", "day", ["v"])
    slice_ = spark.createDataFrame([("a", d(4).date(), 12), ("a", d(5).date(), 20), ("c", d(4).date(), 7)], sch)
    out = delta_from_state(state, slice_, "k", "day", ["v"])
    assert rows(out, "k", "day", "v", "v_delta") == [("a", d(4).date(), 12, -3), ("a", d(5).date(), 20, 8), ("c", d(4).date(), 7, None)]
    assert late_keys(state, slice_, "k", "day").isEmpty()
    late = spark.createDataFrame([("a", d(2).date(), 12), ("b", d(3).date(), 20)], sch)
    assert rows(late_keys(state, late, "k", "day")) == [("a",)]


def test_retraction_equals_aggregating_again(spark):
    import random

    rng = random.Random(4)
    base = [(i, rng.choice("xyz") if rng.random() < 0.9 else None, rng.choice([None, rng.randrange(9)])) for i in range(200)]
    changed = {i: (i, rng.choice("xyzw"), rng.choice([None, rng.randrange(9)])) for i in rng.sample(range(200), 60)}
    gone = set(rng.sample(sorted(changed), 20))
    sch = "id int, g string, v int"
    frame = lambda data: spark.createDataFrame(list(data), sch)
    now = retract_and_add(group_totals(frame(base), ["g"], ["v"]), frame(r for i, r in changed.items() if i not in gone),
                          frame(r for r in base if r[0] in changed), ["g"], ["v"])
    after = frame([changed.get(r[0], r) for r in base if r[0] not in gone])
    want = {r.g: (r.n, r.s) for r in after.groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    got = {r.g: (r.n_rows, r.s) for r in now.select("g", "n_rows", sum_or_null("v").alias("s")).collect()}
    assert {g: got[g] for g in got if got[g][0]} == {g: want[g] for g in got if g in want} and {g for g in got if not got[g][0]}.isdisjoint(want)
    touched = {r[1] for i, r in changed.items() if i not in gone} | {r[1] for r in base if r[0] in changed}
    assert set(got) == touched


def test_as_of_carried_equals_the_interval_join(spark):
    facts = spark.createDataFrame([(k, d(n).date(), n) for k in ("a", "b", None) for n in (1, 2, 5, 40, 80, 200)], "k string, day date, n int")
    versions = spark.createDataFrame([("a", "A", d(2), d(5)), ("a", "B", d(5), d(60)), ("a", "C", d(100), None), (None, "N", d(1), None), ("c", "X", d(1), None)],
                                     "k string, attr string, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz")
    got = as_of_carried(facts, versions, "k", "day")
    want = as_of_join(facts, versions, "k", "day")
    assert got.columns == ["k", "day", "n", "attr", "valid_from_dttm", "valid_to_dttm"]
    assert rows(got, "k", "day", "n", "attr") == rows(want, "k", "day", "n", "attr")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" in plan


def test_rebuild_stores_nothing_and_shares_the_shuffle(spark, monkeypatch, tmp_path):
    import re

    from tidemark import session
    from tidemark.operators.history import VALID_FROM, scd2_upsert

    t = spark.createDataFrame([("k", "A", d(1), d(5)), ("k", "B", d(5), None)], "k string, attr string, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz")
    s = spark.createDataFrame([("k", "C", d(3))], "k string, attr string, valid_from_dttm timestamp_ntz")
    before = [len(x) for x in session._SCOPES]
    for mode in ("no", "from_dt", "full"):
        out = scd2_upsert(t, s, "k", ["k", VALID_FROM], mode)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        moved = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(k#\d+, __bucket", line)]
        assert sorted("ReusedExchange" in line for line in moved) == [False, True], mode
    assert [len(x) for x in session._SCOPES] == before
