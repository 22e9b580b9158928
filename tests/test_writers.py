"""Write modes over the Parquet table store, and their validation errors."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from conftest import d, rows
from pyspark.sql import functions as F

from tidemark.functions import changed, key_match, link_key
from tidemark.sources.tables import CatalogTables
from tidemark.sources.writers import write_scd1, write_scd2

SCD2_DDL = "k string, attr string, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz, processed_dttm timestamp"


@pytest.fixture()
def tables(spark):
    t = CatalogTables(spark, tempfile.mkdtemp(prefix="writers-"))
    t.create("s.one", "id int, day date, v string, processed_dttm timestamp", partition_by="day")
    t.create("s.two", SCD2_DDL, partition_by="valid_from_day", partition_expr=F.to_date("valid_from_dttm"))
    t.create("s.three", SCD2_DDL, partition_by="valid_to_day", partition_expr=F.to_date("valid_to_dttm"))
    return t


def _one(spark, data):
    return spark.createDataFrame(data, "id int, day string, v string").withColumn("day", F.col("day").cast("date"))


def _two(spark, data):
    return spark.createDataFrame([(k, a, d(n)) for k, a, n in data], "k string, attr string, valid_from_dttm timestamp_ntz")


def test_scd1_modes(spark, tables):
    write_scd1(tables, "s.one", _one(spark, [(1, "2024-01-01", "a"), (2, "2024-01-02", "b")]), ["id", "day"], "insert")
    write_scd1(tables, "s.one", _one(spark, [(2, "2024-01-02", "B"), (3, "2024-01-03", "c")]), ["id", "day"], "upsert")
    assert rows(tables.read("s.one"), "id", "v") == [(1, "a"), (2, "B"), (3, "c")]
    write_scd1(tables, "s.one", _one(spark, [(9, "2024-01-09", "z")]), ["id", "day"], "rewrite")
    assert rows(tables.read("s.one"), "id", "v") == [(9, "z")]


@pytest.mark.parametrize("table", ["s.two", "s.three"])
def test_scd2_modes(spark, tables, table):
    write_scd2(tables, table, _two(spark, [("k", "A", 1), ("k", "A", 2), ("k", "B", 3)]), "k",
               ["k", "valid_from_dttm"], "insert")
    assert rows(tables.read(table), "valid_from_dttm", "attr", "valid_to_dttm") == [
        (d(1), "A", d(3)), (d(3), "B", None)]
    write_scd2(tables, table, _two(spark, [("k", "C", 2)]), "k", ["k", "valid_from_dttm"], "upsert", "from_dt")
    assert rows(tables.read(table), "valid_from_dttm", "attr", "valid_to_dttm") == [
        (d(1), "A", d(2)), (d(2), "C", d(3)), (d(3), "B", None)]
    # equal to its predecessor: the version of day 3 is deleted, an emptied folder removed
    write_scd2(tables, table, _two(spark, [("k", "C", 3)]), "k", ["k", "valid_from_dttm"], "upsert", "from_dt")
    assert rows(tables.read(table), "valid_from_dttm", "attr", "valid_to_dttm") == [
        (d(1), "A", d(2)), (d(2), "C", None)]
    # of the partitions that lost all rows only a marker is left
    stored = spark.table(tables.catalog_name(table))
    part = tables.partition_of(table)
    emptied = {str(r[part]) for r in stored.where("__gone").collect()}
    assert emptied == ({"2024-01-03"} if table == "s.two" else {"2024-01-03"})
    write_scd2(tables, table, _two(spark, [("k", "Z", 5)]), "k", ["k", "valid_from_dttm"], "rewrite")
    assert rows(tables.read(table), "valid_from_dttm", "attr") == [(d(5), "Z")]


def test_write_errors(spark, tables):
    with pytest.raises(ValueError, match="written in one of the modes"):
        write_scd1(tables, "s.one", _one(spark, [(1, "2024-01-01", "a")]), ["id"], "merge")
    with pytest.raises(ValueError, match="does not exist"):
        write_scd1(tables, "s.none", _one(spark, [(1, "2024-01-01", "a")]), ["id"], "upsert")
    with pytest.raises(ValueError, match="NULL or repeated"):
        write_scd2(tables, "s.two", _two(spark, [("k", "A", 1), ("k", "B", 1)]), "k", ["k", "valid_from_dttm"], "upsert")
    with pytest.raises(ValueError, match="differ in columns"):
        extra = _two(spark, [("k", "A", 1)]).withColumn("extra", F.lit(1))
        write_scd2(tables, "s.two", extra, "k", ["k", "valid_from_dttm"], "upsert")
    with pytest.raises(ValueError, match="history can be rebuilt"):
        write_scd2(tables, "s.two", _two(spark, [("k", "A", 1)]), "k", ["k", "valid_from_dttm"], "upsert", "some")
    with pytest.raises(ValueError, match="namespace.table"):
        tables.path("justname")


def test_predicate_builders(spark):
    a = spark.createDataFrame([(1, None, "x")], "k int, v string, w string").alias("a")
    b = spark.createDataFrame([(1, None, "y")], "k int, v string, w string").alias("b")
    j = a.join(b, key_match("a", "b", ["k"]))
    assert j.select(changed("a", "b", ["v"]).alias("c1"), changed("a", "b", ["v", "w"]).alias("c2")).first() == (False, True)
    with pytest.raises(ValueError):
        key_match("a", "b", [])
    with pytest.raises(ValueError):
        changed("a", "b", [])
    assert spark.range(1).select(link_key(F.lit("v1"), F.lit("c1"))).first()[0] == \
        spark.range(1).select(F.md5(F.lit("v1||c1"))).first()[0]


def test_default_calendar_span(spark):
    from tidemark.sources.calendar import calendar_days, calendar_dimension

    cal = calendar_dimension(calendar_days(spark))
    assert cal.count() == 7306
    r = cal.where("calendar_dt = date'2035-01-01'").first()
    assert (r.weekday, r.day_name, r.year_month, r.quarter) == (1, "Monday", "2035-01", 1)


def test_a_key_that_changes_partition_keeps_one_row(spark):
    t = CatalogTables(spark, tempfile.mkdtemp(prefix="writers-"))
    t.create("s.hub", "id string, created_at timestamp_ntz, processed_dttm timestamp", partition_by="year", partition_expr=F.year("created_at"))
    hub = lambda at: spark.createDataFrame([("a", dt.datetime(at, 5, 1))], "id string, created_at timestamp_ntz")
    write_scd1(t, "s.hub", hub(2020), ["id"], "upsert")
    write_scd1(t, "s.hub", hub(2021), ["id"], "upsert")
    assert rows(t.read("s.hub"), "id", "created_at") == [("a", dt.datetime(2021, 5, 1))]


def test_a_partition_column_outside_the_key(spark, tables):
    write_scd1(tables, "s.one", _one(spark, [(1, "2024-01-01", "a")]), ["id"], "upsert")
    write_scd1(tables, "s.one", _one(spark, [(1, "2024-01-02", "b")]), ["id"], "upsert")
    assert rows(tables.read("s.one"), "id", "v") == [(1, "b")]


def test_a_stream_batch_with_a_repeated_key_is_refused(spark, tables, tmp_path):
    from tidemark.streaming.incremental import merge_new_files

    _one(spark, [(1, "2024-01-01", "a"), (1, "2024-01-01", "b")]).write.parquet(f"{tmp_path}/in")
    with pytest.raises(Exception, match="duplicate keys"):
        merge_new_files(spark, f"{tmp_path}/in", "id int, day date, v string", tables, "s.one", ["id", "day"], f"{tmp_path}/c")
    assert tables.read("s.one").isEmpty()


def test_a_replacement_that_fails_leaves_the_old_table(spark, tables):
    write_scd1(tables, "s.one", _one(spark, [(1, "2024-01-01", "a"), (2, "2024-01-02", "a")]), ["id", "day"], "insert")
    with pytest.raises(Exception, match="boom"):
        tables.replace("s.one", tables.read("s.one").withColumn("v", F.raise_error(F.lit("boom")).cast("string")))
    assert rows(tables.read("s.one"), "id", "v") == [(1, "a"), (2, "a")]
    tables.replace("s.one", tables.read("s.one").where("id = 1").withColumn("v", F.lit("b")))
    assert rows(tables.read("s.one"), "id", "v") == [(1, "b")]


@pytest.mark.parametrize("value", ["a:b", "a/b", "50%", "k=v", "#x", "ü ß", "2024-01-01 10:00:00"])
def test_a_row_that_leaves_an_escaped_partition_is_not_kept_twice(spark, value):
    t = CatalogTables(spark, tempfile.mkdtemp(prefix="writers-"))
    t.create("s.p", "id int, p string, v int, processed_dttm timestamp", partition_by="p")
    row = lambda p, v: spark.createDataFrame([(1, p, v)], "id int, p string, v int")
    write_scd1(t, "s.p", row(value, 1), ["id"], "upsert")
    assert rows(t.read("s.p"), "id", "p", "v") == [(1, value, 1)]
    write_scd1(t, "s.p", row("c", 2), ["id"], "upsert")
    assert rows(t.read("s.p"), "id", "p", "v") == [(1, "c", 2)]
    write_scd1(t, "s.p", row(None, 3), ["id"], "upsert")
    assert rows(t.read("s.p"), "id", "p", "v") == [(1, None, 3)]
    write_scd1(t, "s.p", row(value, 4), ["id"], "upsert")
    assert rows(t.read("s.p"), "id", "p", "v") == [(1, value, 4)]


def test_a_table_is_found_again_by_another_store(spark):
    root = tempfile.mkdtemp(prefix="writers-")
    ddl = "id int, day date, v string, processed_dttm timestamp"
    first = CatalogTables(spark, root)
    first.create("s.one", ddl, partition_by="day")
    write_scd1(first, "s.one", _one(spark, [(1, "2024-01-01", "a"), (2, None, "b")]), ["id", "day"], "insert")
    spark.sql(f"DROP TABLE {first.catalog_name('s.one')}")  # as a session with an empty catalog sees it
    again = CatalogTables(spark, root)
    assert not again.exists("s.one")
    again.create("s.one", ddl, partition_by="day")
    assert rows(again.read("s.one"), "id", "v") == [(1, "a"), (2, "b")] and again.namespaces() == ["s"]


def test_a_provider_with_row_level_operations_gets_a_merge(spark, tables, monkeypatch):
    calls = []

    class Builder:
        def whenMatched(self, condition=None):
            calls.append("matched")
            return self

        def whenNotMatched(self, condition=None):
            calls.append("not matched")
            return self

        def update(self, assignments):
            calls.append(sorted(assignments))
            return self

        def insert(self, assignments):
            return self.update(assignments)

        def delete(self):
            return self.update({})

        def merge(self):
            calls.append("merge")

    from pyspark.sql import DataFrame
    write_scd1(tables, "s.one", _one(spark, [(1, "2024-01-01", "a")]), ["id", "day"], "insert")
    monkeypatch.setattr(tables, "provider", "iceberg")
    monkeypatch.setattr(type(tables.read("s.one")), "mergeInto", lambda self, table, on: Builder())
    write_scd1(tables, "s.one", _one(spark, [(1, "2024-01-01", "b")]), ["id", "day"], "upsert")
    assert calls == ["matched", ["processed_dttm", "v"], "not matched", ["day", "id", "processed_dttm", "v"], "merge"]
    assert isinstance(tables.read("s.one"), DataFrame)
    calls.clear()
    write_scd2(tables, "s.two", _two(spark, [("k", "C", 2)]), "k", ["k", "valid_from_dttm"], "upsert", "from_dt")
    assert calls[-1] == "merge" and calls.count("matched") == 3


def test_bucketed_versions_are_not_shuffled_for_the_touched_keys(spark):
    from tidemark.operators.history import _history

    t = CatalogTables(spark, tempfile.mkdtemp(prefix="writers-"))
    t.create("s.v", SCD2_DDL, bucket_by=("k", 8))
    write_scd2(t, "s.v", _two(spark, [(f"k{i}", "A", 1) for i in range(40)]), "k", ["k", "valid_from_dttm"], "insert")
    source = _two(spark, [(f"k{i}", "B", 3) for i in range(0, 40, 2)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mode in ("from_dt", "full"):
            plan = _history(t.read("s.v"), source, "k", mode)._jdf.queryExecution().executedPlan().toString().splitlines()
            scan = next(i for i, line in enumerate(plan) if "FileScan" in line)
            join = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line)
            assert "Bucketed: true" in plan[scan] and not any("Exchange" in line for line in plan[join:scan]), mode
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    write_scd2(t, "s.v", source, "k", ["k", "valid_from_dttm"], "upsert", "from_dt")
    assert t.read("s.v").count() == 60 and t.read("s.v").where("valid_to_dttm is null").count() == 40
