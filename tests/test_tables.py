"""Table maintenance: upsert family, slices, NOT IN, validity ranges (§5.2)."""

import datetime as dt

from decimal import Decimal as D

from pyspark.sql import functions as F

from martflow.operators.tables import (by_slice, close_missing, delete_where_in, differing, insert_if_absent, not_in, open_validity,
                                       read_slices, replace_slice, update_from_lookup, upsert, versioned_upsert,
                                       write_slices)
from martflow.session import scratch_path

T0 = dt.datetime(2024, 1, 1)
SENT = dt.datetime(2099, 12, 31)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_upsert_last_wins_and_null_wins(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, v int")
    source = spark.createDataFrame([(2, "x", 1, 1), (2, None, 2, 2), (3, "c", 3, 3)],
                                   "id int, name string, v int, seq int")
    out = upsert(target, source, ["id"], [F.col("seq")]).select("id", "name", "v")
    assert rows(out) == [(1, "a", 10), (2, None, 2), (3, "c", 3)]
    # idempotent: applying the same batch again changes nothing
    again = upsert(out, source, ["id"], [F.col("seq")]).select("id", "name", "v")
    assert rows(again) == rows(out)


def test_upsert_partial_keeps_other_columns(spark):
    target = spark.createDataFrame([("k1", "v1", T0)], "object_id string, object_value string, update_ts timestamp_ntz")
    later = T0 + dt.timedelta(days=1)
    source = spark.createDataFrame([("k1", "v2", later), ("k2", "w", later)],
                                   "object_id string, object_value string, update_ts timestamp_ntz")
    out = upsert(target, source, ["object_id"], [F.col("update_ts")], update_cols=["object_value"])
    assert rows(out) == [("k1", "v2", T0), ("k2", "w", later)]


def test_insert_if_absent_first_wins_idempotent(spark):
    target = spark.createDataFrame([(1, "keep")], "id int, v string")
    source = spark.createDataFrame([(1, "no", 0), (2, "first", 1), (2, "second", 2)], "id int, v string, seq int")
    out = insert_if_absent(target, source, ["id"], [F.col("seq")])
    assert rows(out) == [(1, "keep"), (2, "first")]
    assert rows(insert_if_absent(out, source, ["id"], [F.col("seq")])) == rows(out)


def test_update_from_lookup_keeps_old_when_missing(spark):
    dim = spark.createDataFrame([(1, "old1"), (2, "old2")], "item_id int, item_name string")
    lk = spark.createDataFrame([(1, "new1")], "item_id int, item_name string")
    assert rows(update_from_lookup(dim, lk, "item_id", "item_name")) == [(1, "new1"), (2, "old2")]  # B8


def test_not_in_null_rules(spark):
    probe = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    empty = spark.createDataFrame([], "v int")
    with_null = spark.createDataFrame([(1,), (None,)], "v int")
    plain = spark.createDataFrame([(1,)], "v int")
    assert sorted(not_in(probe, "k", empty, "v").collect(), key=str) == sorted([(1,), (2,), (None,)], key=str)
    assert not_in(probe, "k", with_null, "v").count() == 0
    assert rows(not_in(probe, "k", plain, "v")) == [(2,)]


def test_delete_where_in(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "date_id int, v string")
    keys = spark.createDataFrame([(2,), (2,), (9,)], "date_id int")
    assert rows(delete_where_in(t, keys, "date_id")) == [(1, "a"), (3, "c")]


def test_close_missing_touches_open_rows_only(spark):
    closed_at = dt.datetime(2023, 6, 1)
    dim = spark.createDataFrame([("c1", T0, SENT), ("c2", T0, SENT), ("c3", T0, closed_at)],
                                "courier_id string, active_from timestamp_ntz, active_to timestamp_ntz")
    src = spark.createDataFrame([("c1",)], "object_id string")
    out = close_missing(dim, src, "courier_id", "object_id", "2024-02-01 00:00:00")
    assert rows(out) == [("c1", T0, SENT), ("c2", T0, dt.datetime(2024, 2, 1)), ("c3", T0, closed_at)]


def test_versioned_upsert(spark):
    dim = open_validity(spark.createDataFrame([("r1", "A", T0), ("r2", "B", T0)],
                                              "rid string, name string, active_from timestamp_ntz"),
                        F.col("active_from"))
    src = spark.createDataFrame([("r1", "A"), ("r2", "B2"), ("r3", "C")], "rid string, name string")
    asof = dt.datetime(2024, 2, 1)
    out = versioned_upsert(dim, src, "rid", ["name"], "2024-02-01 00:00:00")
    assert rows(out) == [("r1", "A", T0, SENT), ("r2", "B", T0, asof), ("r2", "B2", asof, SENT),
                         ("r3", "C", asof, SENT)]
    # applying the same snapshot again is a no-op
    assert rows(versioned_upsert(out, src, "rid", ["name"], "2024-02-01 00:00:00")) == rows(out)
    # a snapshot listing r2 twice is reduced to its last row first
    dup = spark.createDataFrame([("r2", "B3", 1), ("r2", "B4", 2)], "rid string, name string, seq int")
    v = versioned_upsert(out, dup, "rid", ["name"], "2024-03-01 00:00:00", order=[F.col("seq")])
    opened = [r.name for r in v.filter("rid = 'r2' AND active_to = TIMESTAMP_NTZ'2099-12-31 00:00:00'").collect()]
    assert opened == ["B4"]


def test_replace_slice_idempotent_and_empty_increment(spark):
    target = spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int")
    inc = spark.createDataFrame([("d2", 20)], "day string, v int")
    once = replace_slice(target, inc, F.col("day"), ["d2"])
    twice = replace_slice(once, inc, F.col("day"), ["d2"])
    assert rows(once) == rows(twice) == [("d1", 1), ("d2", 20)]
    empty = spark.createDataFrame([], "day string, v int")
    assert rows(replace_slice(target, empty, F.col("day"), ["d2"])) == [("d1", 1)]


def test_differing_counts_rows_and_copies_as_except_all(spark):
    ddl = "a string, b string, t timestamp_ntz, n decimal(9,2), day string"
    t = dt.datetime(2024, 1, 1, 5, 6, 7, 8)
    a = [("x", None, T0, 1, "d"), ("x", None, T0, 1, "d"), (None, "x", T0, 1, "d"), ("1:a", "", t, None, "d"), ("n", "null,", None, 2, "e")]
    b = [("x", None, T0, 1, "d"), (None, "x", T0, 1, "d"), ("1:a", "", t.replace(microsecond=9), None, "d"), ("nnull,", None, None, 2, "e")]
    a, b = (spark.createDataFrame([(*r[:3], None if r[3] is None else D(r[3]), r[4]) for r in x], ddl) for x in (a, b))
    assert differing(a, b) == a.exceptAll(b).unionByName(b.exceptAll(a)).count() == 5
    assert differing(a, a) == differing(a.limit(0), b.limit(0)) == 0


def test_clustered_slices_are_written_without_another_shuffle(spark):
    df = by_slice(spark.createDataFrame([(f"d{i % 3}", i) for i in range(30)], "day string, v int"), "day")
    path, again = scratch_path(spark, "t_cluster"), scratch_path(spark, "t_cluster")
    write_slices(df, path, "day", ["d0", "d1", "d2", "d3"], clustered=True)
    write_slices(df, again, "day")
    assert rows(read_slices(spark, path, "day"), "day", "v") == rows(read_slices(spark, again, "day"), "day", "v") == rows(df)


def test_write_slices_dynamic_overwrite_and_empty_day(spark):
    path = scratch_path(spark, "test_slices")
    base = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)], "day string, v int")
    write_slices(base, path, "day")
    write_slices(spark.createDataFrame([("2024-01-02", 22)], "day string, v int"), path, "day", ["2024-01-02"])
    # empty increment for 01-03 must clear that day (dynamic overwrite alone would keep it)
    write_slices(spark.createDataFrame([], "day string, v int"), path, "day", ["2024-01-03"])
    got = rows(read_slices(spark, path, "day").select(F.col("day").cast("string"), "v"))
    assert got == [("2024-01-01", 1), ("2024-01-02", 22)]


def test_backfill_equals_daily(spark):
    days = [("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-03", 4)]
    df = spark.createDataFrame(days, "day string, v int")
    daily = scratch_path(spark, "test_daily")
    for d in ["2024-01-01", "2024-01-02", "2024-01-03"]:
        write_slices(df.filter(F.col("day") == d), daily, "day", [d])
    back = scratch_path(spark, "test_backfill")
    write_slices(df, back, "day")
    a = rows(read_slices(spark, daily, "day").select(F.col("day").cast("string"), "v"))
    b = rows(read_slices(spark, back, "day").select(F.col("day").cast("string"), "v"))
    assert a == b == sorted(days)


def test_a_run_takes_its_intermediates_with_it(spark):
    from martflow.operators.tables import path_exists, publish
    from martflow.session import scratch_path, scratch_run
    with scratch_run(spark):
        inside = scratch_path(spark, "x")
        spark.range(3).write.parquet(inside)
        assert publish(spark.range(5), "y").count() == 5 and path_exists(spark, inside)
    assert not path_exists(spark, inside) and not path_exists(spark, inside.rsplit("/", 1)[0])
    assert "/run-" not in scratch_path(spark, "z")
