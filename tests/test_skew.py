"""A key holding a third of the rows: exact results, and the work is spread."""

from __future__ import annotations

from conftest import SF01
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import with_previous
from tidemark.sources import fixtures as fx


def _skewed(spark):
    li = fx.table(spark, SF01, "lineitem")
    # one hot key takes every third order; the rest keep their own key
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_orderkey"))
    return li.select(key.alias("k"), "l_shipdate", "l_linenumber", "l_quantity")


def test_hot_key_lag_is_exact_and_spread(spark):
    df = _skewed(spark)
    total = df.count()
    hot = df.where("k = -1").count()
    assert hot * 4 > total  # the hot key holds about a third of the rows

    order = ["l_shipdate", "l_linenumber", "l_quantity"]
    got = with_previous(df, ["k"], order, {"prev_q": "l_quantity"})
    w = Window.partitionBy("k").orderBy(*order)
    ref = df.withColumn("prev_q", F.lag("l_quantity").over(w))
    assert got.exceptAll(ref).isEmpty() and ref.exceptAll(got).isEmpty()

    # the hot key's rows are windowed in many tasks, not one (AQE would merge
    # these tiny partitions, so coalescing is off while we look)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def tasks_of(windowed):
            # prev_q is consumed, so the windowed stage is not pruned away
            hot_rows = windowed.withColumn("p", F.spark_partition_id()).where("k = -1")
            return len(hot_rows.groupBy("p").agg(F.sum("prev_q").alias("s")).collect())

        tasks = tasks_of(with_previous(df, ["k"], order, {"prev_q": "l_quantity"}))
        plain = tasks_of(ref)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert plain == 1 and tasks > 1
