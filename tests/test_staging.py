"""M15/M16 staging loads on inline fixtures."""

import datetime as dt

from martflow.operators.cursor import cursor_get, empty_state
from martflow.session import scratch_path
from martflow.plans.staging import EVENTS_WF, copy_collection, load_bonus_users, load_events, load_ranks

T = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ranks_users_events(spark):
    staged_r = spark.createDataFrame([(1, "bronze", 1)], "id int, name string, pct int")
    ranks = spark.createDataFrame([(1, "silver", 2), (2, "gold", 3)], "id int, name string, pct int")
    assert rows(load_ranks(staged_r, ranks)) == [(1, "silver", 2), (2, "gold", 3)]
    staged_u = spark.createDataFrame([(1, "u-old")], "id int, order_user_id string")
    users = spark.createDataFrame([(1, "u-new"), (2, "u2")], "id int, order_user_id string")
    assert rows(load_bonus_users(staged_u, users)) == [(1, "u-old"), (2, "u2")]
    ddl = "id long, event_ts timestamp_ntz, event_type string, event_value string"
    outbox = spark.createDataFrame([(i, T, "user_rank", "{}") for i in range(1, 6)], ddl)
    path = scratch_path(spark, "t_stg_events")
    spark.createDataFrame([], ddl).write.parquet(path)
    state = empty_state(spark)
    for source in (outbox.filter("id <= 3"), outbox, outbox):  # the last run has nothing new
        new_rows, state = load_events(spark.read.schema(ddl).parquet(path), source, state)
        new_rows.write.mode("append").parquet(path)  # insert-only: append, never rewrite
    assert [r.id for r in spark.read.schema(ddl).parquet(path).orderBy("id").collect()] == [1, 2, 3, 4, 5]
    assert cursor_get(state, EVENTS_WF) == 5


DOC_DDL = "_id string, name string, update_ts timestamp_ntz"


def test_copy_collection_limit_and_partial_refresh(spark):
    docs = spark.createDataFrame([(f"d{i}", f"n{i}", T + dt.timedelta(hours=i)) for i in range(5)], DOC_DDL)
    staged = spark.createDataFrame([("d0", '{"old":1}', T - dt.timedelta(days=1))],
                                   "object_id string, object_value string, update_ts timestamp_ntz")
    table, state = copy_collection(staged, docs, empty_state(spark), limit=3)
    out = {r.object_id: r for r in table.collect()}
    assert sorted(out) == ["d0", "d1", "d2"]                    # the 3 oldest documents
    assert out["d0"].update_ts == T - dt.timedelta(days=1)      # payload refreshed, stamp kept (B18)
    assert out["d0"].object_value == '{"_id":"d0","name":"n0","update_ts":"2024-01-01 00:00:00"}'
    later, state = copy_collection(staged, docs, state, limit=3)
    assert sorted(r.object_id for r in later.collect()) == ["d0", "d3", "d4"]
    same, after = copy_collection(staged, docs, state, limit=3)  # nothing left: the cursor stays
    assert rows(after) == rows(state) and same.count() == 1


def test_sessions_lose_no_ties_and_never_stall(spark):
    # five documents on one stamp, two without, one staged already with an old stamp that stays
    docs = spark.createDataFrame([(f"d{i}", "n", None if i > 5 else T) for i in range(1, 8)], DOC_DDL)
    staged = spark.createDataFrame([("d3", "{}", T - dt.timedelta(days=9))], "object_id string, object_value string, update_ts timestamp_ntz")
    state, seen = empty_state(spark), []
    for _ in range(5):
        staged, state = copy_collection(staged, docs, state, limit=2)
        seen.append(staged.count())
    assert seen == [3, 5, 6, 7, 7]
    assert all("name" in r.object_value for r in staged.collect())


def test_copy_collection_into_bucketed_table(spark):
    from martflow.operators.tables import read_buckets
    from martflow.plans.staging import STAGED_DOC_DDL, copy_collection_into
    docs = spark.createDataFrame([(f"d{i}", f"n{i}", T + dt.timedelta(hours=i)) for i in range(5)], DOC_DDL)
    table, state = scratch_path(spark, "t_staged_docs"), empty_state(spark)
    state = copy_collection_into(table, docs, state, limit=3, buckets=8)
    copy_collection_into(table, docs, state, limit=3)
    got = {r.object_id: r.update_ts for r in read_buckets(spark, table, STAGED_DOC_DDL).collect()}
    assert sorted(got) == ["d0", "d1", "d2", "d3", "d4"] and got["d4"] == T + dt.timedelta(hours=4)


def test_a_session_is_copied_by_its_last_key_and_not_by_a_limit(spark):
    from martflow.plans.staging import _doc_rows
    docs = spark.createDataFrame([(f"d{i}", f"n{i}", T + dt.timedelta(hours=i // 3)) for i in range(9)], DOC_DDL)
    page = _doc_rows(docs, "_id", "update_ts", 4, ("2024-01-01 00:00:00", "d0"))
    assert sorted(r.object_id for r in page.collect()) == ["d1", "d2", "d3", "d4"]
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "TakeOrdered" not in plan
    assert _doc_rows(docs, "_id", "update_ts", 1 << 31, None).count() == 9
