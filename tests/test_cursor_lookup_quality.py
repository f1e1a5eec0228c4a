"""Cursors (K11, B17), lookups (J10, J11) and quality rules (CHECK with NULL)."""

import pytest
from pyspark.sql import functions as F

from martflow.operators.cursor import cursor_advance, cursor_get, empty_state, run_log
from martflow.operators.lookup import UnresolvedLookup, all_or_nothing, require_resolved
from martflow.operators.quality import orphans, row_predicates, unique


def test_cursor_default_empty_batch_and_split(spark):
    st = empty_state(spark)
    assert cursor_get(st, "wf") == -1
    batch = spark.createDataFrame([(i,) for i in range(1, 11)], "id long")
    one = cursor_advance(st, batch, "id", F.lit("wf"))
    assert cursor_get(one, "wf") == 10
    # empty batch keeps the cursor
    assert cursor_get(cursor_advance(one, batch.limit(0), "id", F.lit("wf")), "wf") == 10
    # cursor split at any point = one batch
    for cut in [1, 4, 9]:
        s = cursor_advance(st, batch.filter(F.col("id") <= cut), "id", F.lit("wf"))
        c = cursor_get(s, "wf")
        s = cursor_advance(s, batch.filter(F.col("id") > c), "id", F.lit("wf"))
        assert cursor_get(s, "wf") == 10


def test_run_log_empty_payload_fails(spark):
    a = spark.createDataFrame([(1,)], "x int")
    out = {r.workflow_key: r.status for r in run_log({"a": a, "b": a.limit(0)}, "2024-01-01 00:00:00").collect()}
    assert out == {"a": "SUCCESS", "b": "FAILED"}


def test_all_or_nothing_drops_event_with_one_unknown_product(spark):
    lines = spark.createDataFrame([(1, "p1", 10), (1, "p2", None), (2, "p1", 10)], "event_id int, product_id string, sk int")
    out = all_or_nothing(lines, "event_id", F.col("sk").isNotNull())
    assert sorted(r.event_id for r in out.collect()) == [2]


def test_require_resolved_aborts(spark):
    df = spark.createDataFrame([(1, None)], "a int, restaurant_id int")
    with pytest.raises(UnresolvedLookup):
        require_resolved(df, "restaurant_id", "menu item")


def test_check_null_passes_and_unique_orphans(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (2, -1)], "k int, price int")
    r = {x.rule: x.violations for x in row_predicates(df, "t", {"p": F.col("price") >= 0}).collect()}
    assert r == {"check:p": 1}
    assert unique(df, "t", ["k"]).first().violations == 1
    nulls = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert unique(nulls, "t", ["k"]).first().violations == 0  # NULL keys never conflict
    parent = spark.createDataFrame([(1,)], "id int")
    assert orphans(df, "t", "k", parent, "id").first().violations == 2


def test_load_batch_observes_and_advances_once(spark):
    from martflow.operators.cursor import load_batch
    staged = spark.createDataFrame([(i, f"v{i}") for i in range(1, 8)], "id long, v string")
    st = empty_state(spark)
    out, st, log = load_batch(staged.filter("id <= 4"), st, "wf", "t1")
    assert out.count() == 4 and cursor_get(st, "wf") == 4 and log.first().row_count == 4
    out, st, log = load_batch(staged, st, "wf", "t2")
    assert sorted(r.id for r in out.collect()) == [5, 6, 7] and cursor_get(st, "wf") == 7
    out, st, log = load_batch(staged, st, "wf", "t3")  # nothing new: cursor kept, run logged as FAILED
    assert out.count() == 0 and cursor_get(st, "wf") == 7 and log.first().status == "FAILED"


def test_mart_rules_use_natural_and_foreign_keys(spark):
    from martflow.operators.quality import check_marts
    dim = spark.createDataFrame([(1, 7, "a"), (2, 7, "b")], "id long, customer_id long, first_name string")
    fact = spark.createDataFrame([(1, 5, 7), (1, 5, 8)], "date_id int, item_id int, customer_id long")
    got = {(r.table_name, r.rule): r.violations for r in check_marts({"d_customer": dim, "f_daily_sales": fact}).collect()}
    assert got[("d_customer", "unique:customer_id")] == 1 and got[("d_customer", "unique:id")] == 0
    assert got[("f_daily_sales", "fk:customer_id")] == 1


def test_all_rules_of_a_table_in_one_scan(spark, tmp_path):
    from pyspark.sql import functions as F
    from martflow.operators import quality as Q
    rows = [(1, "a", 5), (1, "a", None), (None, "b", -1), (2, None, -2), (2, "c", 7), (3, "c", None), (1, "a", 5)]
    spark.createDataFrame(rows, "k int, s string, v int").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    checks = {"positive": F.col("v") > 0, "short": Q.max_length("s", 3)}
    apart = Q.union_all([Q.not_null(df, "t", ["k", "v"]), Q.unique(df, "t", ["k"]), Q.unique(df, "t", ["k", "s"]), Q.row_predicates(df, "t", checks)])
    once = Q.in_one_scan(df, "t", ["k", "v"], [["k"], ["k", "s"]], checks)
    assert once._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1  # the plan before it is run
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, apart.collect()))
    assert {r.violations for r in Q.in_one_scan(df.limit(0), "t", ["k"], [["k"]]).collect()} == {0}
