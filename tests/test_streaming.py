"""Structured Streaming operators: incremental tail, cross-batch dedupe,
idempotent micro-batch upsert (T1-T3)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from martflow.session import scratch_path
from martflow.streaming import outbox as S

DDL = "id long, event_ts timestamp_ntz, event_type string, event_value string"
T = dt.datetime(2024, 1, 1, 12)


def _drop(spark, path, rows):
    spark.createDataFrame(rows, DDL).write.mode("append").parquet(path)


def test_tail_delivers_only_new_files_and_nothing_on_rerun(spark):
    base = scratch_path(spark, "t_tail")
    src, ck, sink = f"{base}/src", f"{base}/ck", f"{base}/sink"
    _drop(spark, src, [(1, T, "a", "{}"), (2, T, "b", "{}")])
    S.tail(spark, src, DDL, ck, sink, "1")
    _drop(spark, src, [(3, T, "c", "{}")])
    S.tail(spark, src, DDL, ck, sink, "2")
    S.tail(spark, src, DDL, ck, sink, "3")  # nothing new
    out = spark.read.parquet(sink)
    got = {r.run: sorted(x.id for x in out.filter(F.col("run") == r.run).collect())
           for r in out.select("run").distinct().collect()}
    assert {str(k): v for k, v in got.items()} == {"1": [1, 2], "2": [3]}


def test_dedupe_across_batches_however_late(spark):
    base = scratch_path(spark, "t_dedupe")
    src, ck, sink = f"{base}/src", f"{base}/ck", f"{base}/sink"
    _drop(spark, src, [(1, T, "a", "{}"), (2, T, "a", "{}")])
    S.dedupe(spark, src, DDL, ck, sink, ["id"], [F.col("event_ts")])
    # id 1 again much later is a copy; id 3 is new although its stamp is days old
    _drop(spark, src, [(1, T + dt.timedelta(days=10), "a", "{}"), (3, T - dt.timedelta(days=30), "a", "{}")])
    S.dedupe(spark, src, DDL, ck, sink, ["id"], [F.col("event_ts")])
    ids = sorted(r.id for r in spark.read.parquet(sink).collect())
    assert ids == [1, 2, 3]


def test_upsert_stream_touches_only_batch_buckets_and_replays(spark):
    from martflow.operators.tables import read_buckets, read_pointer, upsert_buckets
    ddl = "object_id string, object_value string, update_ts timestamp_ntz"
    base = scratch_path(spark, "t_upsert")
    src, ck, table = f"{base}/src", f"{base}/ck", f"{base}/table"
    order = [F.col("update_ts"), F.col("object_value")]
    rows = [(f"k{i}", "v1", T) for i in range(50)]
    spark.createDataFrame(rows, ddl).write.parquet(src)
    S.upsert_stream(spark, src, ddl, ck, table, ["object_id"], order, buckets=16)
    later = T + dt.timedelta(1)
    spark.createDataFrame([("k1", "v2", later), ("k1", "v3", later + dt.timedelta(1)), ("new", "w", T)], ddl) \
        .write.mode("append").parquet(src)
    before = read_pointer(spark, table)
    S.upsert_stream(spark, src, ddl, ck, table, ["object_id"], order, buckets=16)
    got = {r.object_id: (r.object_value, r.update_ts) for r in read_buckets(spark, table, ddl).collect()}
    assert len(got) == 51 and got["k1"] == ("v3", later + dt.timedelta(1)) and got["k7"] == ("v1", T)
    # replaying the second batch (as after a failure before its commit) changes nothing
    batch = spark.createDataFrame([("k1", "v2", later), ("k1", "v3", later + dt.timedelta(1)), ("new", "w", T)], ddl)
    upsert_buckets(table, batch, ["object_id"], order, ddl, buckets=16)
    again = {r.object_id: (r.object_value, r.update_ts) for r in read_buckets(spark, table, ddl).collect()}
    assert again == got
    # only the buckets of the two keys have other folders
    now = read_pointer(spark, table)
    assert before["buckets"] == now["buckets"] == 16
    assert 1 <= sum(now["folders"][b] != f for b, f in before["folders"].items()) <= 2


def test_upsert_is_switched_at_once_and_skips_published_batches(spark, monkeypatch):
    from martflow.operators import tables as M
    ddl = "k string, v string"
    table = scratch_path(spark, "t_pointer")
    rows = lambda: sorted(map(tuple, M.read_buckets(spark, table, ddl).collect()))
    up = lambda data, **how: M.upsert_buckets(table, spark.createDataFrame(data, ddl), ["k"], [F.col("v")], ddl, **how)
    up([(f"k{i}", "a") for i in range(20)], buckets=4, batch_id=("s", 0))
    first = rows()
    write = M._write_pointer
    monkeypatch.setattr(M, "_write_pointer", lambda *a: (_ for _ in ()).throw(OSError("lost between write and switch")))
    with pytest.raises(OSError):
        up([("k1", "b"), ("new", "b")], batch_id=("s", 1))
    assert rows() == first                       # the table is as it was
    monkeypatch.setattr(M, "_write_pointer", write)
    up([("k1", "b"), ("new", "b")], batch_id=("s", 1))   # the replay
    assert len(rows()) == 21 and ("k1", "b") in rows()
    up([("k1", "never")], batch_id=("s", 1))             # published already
    up([("k1", "c")], batch_id=("other", 0))             # another stream has its own numbers
    assert ("k1", "c") in rows()
    with pytest.raises(ValueError):
        up([("k1", "d")], buckets=8)
    assert M.retire_buckets(spark, table) > 0 and len(rows()) == 21


def test_dedupe_by_state_reads_no_stored_event(spark):
    base = scratch_path(spark, "t_state")
    src, ck = f"{base}/src", f"{base}/ck"
    run = lambda sink: (S.dedupe_by_state(spark, src, DDL, ck, f"{base}/{sink}", ["id"], [F.col("event_ts")]),
                        sorted((r.id, r.event_type) for r in spark.read.schema(DDL).parquet(f"{base}/{sink}").collect()))[1]
    _drop(spark, src, [(1, T + dt.timedelta(1), "late copy", "{}"), (1, T, "first", "{}"), (2, T, "a", "{}")])
    assert run("one") == [(1, "first"), (2, "a")]
    # another folder for the second run: what is stored is known from the state alone
    _drop(spark, src, [(1, T - dt.timedelta(9), "copy", "{}"), (3, T - dt.timedelta(30), "new and old", "{}")])
    assert run("two") == [(3, "new and old")]
    assert run("two") == [(3, "new and old")]  # nothing new: nothing written


def test_release_gives_the_same_in_any_order_of_arrival(spark):
    rows = {"orders": [("o1", "a", "x"), ("o2", "b", "x"), ("o3", "a", "none")], "rests": [("a", "A"), ("b", "B")], "users": [("x", "X")]}
    ddl = {"orders": "o string, rest string, user string", "rests": "id string, name string", "users": "uid string, login string"}
    got = set()
    for order in [("orders", "rests", "users"), ("users", "rests", "orders")]:
        base = scratch_path(spark, "t_release")
        for name in rows:
            spark.createDataFrame([], ddl[name]).write.parquet(f"{base}/{name}")
        for name in (*order, "rests"):  # the restaurants come twice
            spark.createDataFrame(rows[name], ddl[name]).write.mode("append").parquet(f"{base}/{name}")
            stream = {n: spark.readStream.schema(d).parquet(f"{base}/{n}") for n, d in ddl.items()}
            S.release(stream["orders"], {"rest": stream["rests"], "user": stream["users"]}, f"{base}/ck", f"{base}/sink")
        got.add(tuple(sorted(tuple(r) for r in spark.read.schema(f"{ddl['orders']}, name string, login string").parquet(f"{base}/sink")
                             .select("o", "rest", "user", "name", "login").collect())))
    assert got == {(("o1", "a", "x", "A", "X"), ("o2", "b", "x", "B", "X"))}
