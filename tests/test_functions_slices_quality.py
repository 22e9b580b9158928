"""Scalar functions, watermarks and data-quality checks."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import calendar_fields, iso_duration_seconds, link_key, row_hash
from tidemark.operators import quality as dq
from tidemark.operators.slices import Slicer, Watermarks, parse_watermark, rows_after


def test_iso_duration(spark):
    df = spark.createDataFrame([("PT1H2M3S",), ("PT5M",), ("PT",), ("P0D",), ("P1DT2H",), (None,)], "s string")
    got = [r[0] for r in df.select(iso_duration_seconds("s")).collect()]
    assert got == [3723, 300, 0, None, None, None]


def test_hashes(spark):
    df = spark.createDataFrame([("a", None), ("a", "none")], "x string, y string")
    h = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert h[0] == h[1]
    lk = df.select(link_key("x", "y")).collect()
    assert lk[0][0] != lk[1][0]  # concat_ws skips NULL


def test_calendar_fields(spark):
    df = spark.createDataFrame([("2024-01-07",)], "d string").select(F.col("d").cast("date").alias("calendar_dt"))
    r = df.select(*calendar_fields()).first()
    assert (r.weekday, r.day_name, r.is_weekend, r.week_of_year, r.iso_year, r.month_name) == (
        7, "Sunday", True, 1, 2024, "January")


def test_watermarks(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="wm-"), "marks")
    marks = Watermarks(spark, "p", path)
    assert marks.read("t") is None
    assert marks.advance("t", "2024-01-05 00:00:00")
    assert not marks.advance("t", "2024-01-05 00:00:00")
    assert not marks.advance("t", "2024-01-04 00:00:00")
    assert marks.read("t") == "2024-01-05 00:00:00"
    marks.reset("t", "2024-01-01 00:00:00")
    assert marks.read("t") == "2024-01-01 00:00:00"
    marks.reset("t")
    assert marks.read("t") is None
    marks.advance("u", "2024-02-01 00:00:00")
    assert marks.compact() == 2
    assert marks.read("t") is None and marks.read("u") == "2024-02-01 00:00:00"

    df = spark.createDataFrame([(1, "2024-01-05 00:00:00"), (2, "2024-01-06 00:00:00")], "id int, ts string") \
        .select("id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    marks.reset("t", "2024-01-05 00:00:00")
    sl = Slicer(marks, "t", "ts")
    assert rows(sl.run(df), "id") == [(2,)]
    sl.commit()
    assert marks.read("t").startswith("2024-01-06")
    empty = Slicer(marks, "t", "ts")
    assert empty.run(df).count() == 0
    empty.commit()
    assert marks.read("t").startswith("2024-01-06")


def test_slice_mark_is_zone_stable(spark):
    """The committed mark is Spark's own text of the max, in the session zone."""
    path = os.path.join(tempfile.mkdtemp(prefix="wmz-"), "marks")
    marks = Watermarks(spark, "p", path)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([(1, "2024-01-05 10:00:00")], "id int, ts string") \
            .select("id", F.col("ts").cast("timestamp").alias("ts"))
        sl = Slicer(marks, "t", "ts")
        assert sl.run(df).count() == 1
        sl.commit()
        assert marks.read("t") == "2024-01-05 10:00:00"
        assert Slicer(marks, "t", "ts").run(df).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_watermark_errors(spark):
    with pytest.raises(ValueError, match="as a time"):
        parse_watermark("yesterday", "t")
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="no column"):
        Slicer(Watermarks(spark, "p", tempfile.mkdtemp()), "t", "TS").run(df)
    assert rows_after(df, "id", None).count() == 1


def test_quality_checks(spark):
    df = spark.createDataFrame([(None, None, 1), (None, None, -2)], "a int, b int, m int")
    spec = dq.TableSpec("t", ("a", "b"), ("m",))
    res = {r["check_name"]: r["violations"] for r in dq.check(df, spec).collect()}
    assert res == {"not_empty": 0, "no_nulls_in_key": 4, "no_negative": 1, "no_duplicates": 1}


def test_quality_open_versions_and_orphans(spark):
    v = spark.createDataFrame([("x", None), ("y", None), ("y", None), ("z", "2024-01-01")],
                              "k string, valid_to_dttm string")
    spec = dq.TableSpec("v", ("k",), business_key="k")
    assert dq.single_open_version(v, spec).first()["violations"] == 2
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "fk int")
    assert dq.no_orphans(child, "fk", parent, "p", "c").first()["violations"] == 2


def test_quality_selection_and_missing(spark):
    specs = [dq.TableSpec("a", ("k",)), dq.TableSpec("b", ("k",))]
    assert [s.name for s in dq.select_specs(specs, None)] == ["a", "b"]
    with pytest.raises(ValueError, match="no checks are declared for c"):
        dq.select_specs(specs, ["c"])
    assert dq.missing_table(spark, "x").first()["check_name"] == "table_exists"
    n, f = dq.summarize(dq.missing_table(spark, "x"))
    assert (n, f) == (1, 1)


def test_materialize_and_release(spark):
    import os

    from tidemark.session import materialize, release_scratch, scratch_scope

    release_scratch(spark)
    df = materialize(spark.range(10).withColumnRenamed("id", "x"))
    assert df.count() == 10
    path = df.inputFiles()[0].split("/part-")[0].removeprefix("file:")
    assert os.path.isdir(path)
    assert release_scratch(spark) == 1
    assert not os.path.exists(path)

    # a scope deletes its own folders and no others
    outer = materialize(spark.range(4).withColumnRenamed("id", "x"))
    with scratch_scope(spark):
        inner = materialize(spark.range(5).withColumnRenamed("id", "x"))
        inner_path = inner.inputFiles()[0].split("/part-")[0].removeprefix("file:")
        assert inner.count() == 5
    assert not os.path.exists(inner_path) and outer.count() == 4
    assert release_scratch(spark) == 1


def test_marks_of_two_writers_never_go_back(spark, tmp_path):
    a, b = (Watermarks(spark, "p", str(tmp_path / "marks")) for _ in range(2))
    a._write("t", "2024-01-10", False)
    b._write("t", "2024-01-07", False)  # both had read an older mark; the later clock has the lesser mark
    assert a.read("t") == b.read("t") == "2024-01-10"
    a.reset("t", "2024-01-02")
    assert a.read("t") == "2024-01-02" and a.advance("t", "2024-01-03") and not b.advance("t", "2024-01-03")
    assert a.compact() == 1 and b.read("t") == "2024-01-03"
    a.reset("t")
    assert b.read("t") is None and b.advance("t", "2023-01-01") and a.read("t") == "2023-01-01"


def test_a_mark_keeps_its_zone_offset(spark):
    rows_ = spark.sql("select timestamp'2024-01-20 00:30:00' as ts union all select timestamp'2024-01-19 23:59:00'")
    assert [str(r.ts) for r in rows_after(rows_, "ts", "2024-01-20T03:00:00+03:00").collect()] == ["2024-01-20 00:30:00"]
    ntz = rows_.select(F.col("ts").cast("timestamp_ntz"))
    assert rows_after(ntz, "ts", "2024-01-20T03:00:00+03:00").count() == 1


def test_marks_of_mixed_formats_are_ordered_as_times(spark, tmp_path):
    from tidemark.operators.slices import Watermarks

    marks = Watermarks(spark, "p", f"{tmp_path}/marks")
    assert marks.advance("o", "2024-01-02 00:00:00")
    assert not marks.advance("o", "2024-01-01T23:00:00")  # greater as text up to the day, earlier as a time
    assert marks.advance("o", "2024-01-02T10:00:00")
    assert not marks.advance("o", "2024-01-02 09:00:00")
    assert marks.read("o") == "2024-01-02T10:00:00"


def test_the_writer_with_the_smaller_mark_is_told(spark, tmp_path, monkeypatch):
    from tidemark.operators.slices import Watermarks

    a, b = (Watermarks(spark, "p", f"{tmp_path}/marks") for _ in range(2))
    write = a._write

    def late(obj, value, is_reset):  # the other writer comes in between
        b.advance("o", "2024-01-05 00:00:00")
        write(obj, value, is_reset)

    monkeypatch.setattr(a, "_write", late)
    assert not a.advance("o", "2024-01-03 00:00:00")
    assert b.read("o") == "2024-01-05 00:00:00"


def test_checks_of_a_table_written_under_observation(spark, tmp_path):
    from tidemark.operators import quality as dq

    spec = dq.TableSpec("t", ("k", "d"), ("m",), business_key="k", references=(("p", "parents"),))
    df = spark.createDataFrame([(1, "a", -5, None, 7), (1, "a", 1, "2024-01-01", 8), (None, "b", 2, None, None), (2, "c", 3, "x", 9)],
                               "k int, d string, m int, valid_to_dttm string, p int")
    parents = {"parents": spark.createDataFrame([(7,), (None,)], "p int")}
    watched, watch = dq.observed(df, spec)
    watched.write.parquet(f"{tmp_path}/t")
    got = {r.check_name: r.violations for r in dq.check(spark.read.parquet(f"{tmp_path}/t"), spec, parents, watch).collect()}
    assert got == {"not_empty": 0, "no_duplicates": 1, "no_nulls_in_key": 1, "no_negative": 1, "single_open_version": 1, "no_orphans[p]": 2}
    assert got == {r.check_name: r.violations for r in dq.check(df, spec, parents).collect()}
    apart = dq.no_duplicates(df, spec).unionByName(dq.single_open_version(df, spec)).unionByName(dq.no_orphans(df, "p", parents["parents"], "parents", "t"))
    assert {r.check_name: r.violations for r in apart.collect()}.items() <= got.items()
    assert {(r.table_name, r.check_name, r.detail) for r in apart.collect()} <= {(r.table_name, r.check_name, r.detail) for r in dq.check(df, spec, parents).collect()}
