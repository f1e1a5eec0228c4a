"""Distributed key assignment and NTILE: equal to the one-partition windows."""

import random

from pyspark.sql import Window, functions as F

from martflow.operators.keys import assign_keys, ntile_distributed


def test_assign_keys_dense_and_ordered(spark):
    rows = [(i % 7, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, k int").repartition(5)
    out = assign_keys(df, ["g", "k"], start=10, key="id", num_partitions=4).orderBy("id").collect()
    assert [r.id for r in out] == list(range(10, 210))
    assert [(r.g, r.k) for r in out] == sorted(rows)


def test_assign_keys_plan_has_no_single_partition_exchange(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 13)
    plan = assign_keys(df, ["x", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_ntile_matches_window_with_ties_and_sizes(spark):
    random.seed(1)
    for n, buckets in [(1, 5), (3, 5), (17, 5), (101, 5), (250, 10)]:
        rows = [(i, random.randint(0, 5)) for i in range(n)]
        df = spark.createDataFrame(rows, "id int, v int")
        mine = {r.id: r.b for r in ntile_distributed(df, buckets, [F.col("v").desc(), "id"], "b").collect()}
        ref = {r.id: r.b for r in df.select("id", F.ntile(buckets).over(
            Window.orderBy(F.col("v").desc(), "id")).alias("b")).collect()}
        assert mine == ref
        sizes = [list(mine.values()).count(b) for b in set(mine.values())]
        assert max(sizes) - min(sizes) <= 1


def test_scale_settings_sizes_partitions():
    from martflow.session import scale_settings
    s = scale_settings(100 * 2**40, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_settings(10 * 2**20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_assign_keys_broadcast_offsets_and_empty_ranges(spark):
    rows = [(i,) for i in range(40)]
    df = spark.createDataFrame(rows, "k int")
    out = assign_keys(df, ["k"], num_partitions=64).orderBy("id").collect()  # more ranges than rows
    assert [(r.id, r.k) for r in out] == [(i + 1, i) for i in range(40)]
