"""Entry B: two incremental DDS runs equal one run over everything, and a
late restaurant releases its pending orders (T5, B14, B15)."""

from pyspark.sql import functions as F

from martflow import adapters as A
from martflow.operators.cursor import cursor_get
from martflow.plans.dds import DdsRun
from martflow.session import scratch_path
from martflow.sources.tables import Tables


def _nat(run):
    """DDS content by natural keys (surrogate ids differ between runs)."""
    t = run.tables
    o = (t["dm_orders"].join(t["dm_restaurants"].select(F.col("id").alias("restaurant_id"),
                                                         F.col("restaurant_id").alias("rk")), "restaurant_id")
         .select("order_key", "order_status", "rk"))
    f = (t["fct_product_sales"].join(t["dm_products"].select(F.col("id").alias("product_id"),
                                                            F.col("product_id").alias("pk")), "product_id")
         .join(t["dm_orders"].select(F.col("id").alias("order_id"), "order_key"), "order_id")
         .select("order_key", "pk", "count", "total_sum", "event_id"))
    return sorted(map(tuple, o.collect())), sorted(map(tuple, f.collect()))


def test_two_runs_equal_one(spark, sf_small, monkeypatch):
    t = Tables(spark, sf_small)
    n = A.n_suppliers(t)
    users = A.v_user_docs(t).withColumn("id", F.col("object_id").cast("long"))
    rest_all = A.v_rest_docs(t, n, min_acctbal=None)
    orders = A.v_order_docs(t)
    events = A.v_payment_events(t)
    first_rest = rest_all.filter(F.col("id") % 3 != 0)    # every third restaurant arrives one run later
    # staging numbers rows on arrival, so the late ones get ids above the cursor
    late = rest_all.filter(F.col("id") % 3 == 0).withColumn("id", F.col("id") + 1_000_000)
    cut = orders.agg(F.percentile_approx("id", 0.5)).first()[0]

    base = scratch_path(spark, "t_dds")
    run1 = DdsRun(spark, {"users": users, "restaurants": first_rest, "orders": orders.filter(F.col("id") <= cut),
                          "events": events.filter(F.col("id") <= cut)}, base)
    assert run1.pending.count() > 0 and run1.pending_events.count() > 0
    run2 = DdsRun(spark, {"users": users, "restaurants": first_rest.unionByName(late), "orders": orders,
                          "events": events}, base)  # all it knows of run 1 is the folder
    one = DdsRun(spark, {"users": users, "restaurants": rest_all, "orders": orders, "events": events}, scratch_path(spark, "t_dds_one"))
    assert _nat(run2) == _nat(one)
    assert cursor_get(run2.state, DdsRun.WF["orders"]) == orders.agg(F.max("id")).first()[0]
    # a third run with nothing new changes nothing
    run3 = DdsRun(spark, {"users": users, "restaurants": first_rest.unionByName(late), "orders": orders,
                          "events": events}, base)
    assert _nat(run3) == _nat(run2)
    # replaying run 2 from run 1's state (as after a failure before its state was
    # published) stores nothing twice in the append-only tables
    monkeypatch.setattr(DdsRun, "_last_run", lambda self: 1)
    again = DdsRun(spark, {"users": users, "restaurants": first_rest.unionByName(late), "orders": orders,
                           "events": events}, base)
    assert _nat(again) == _nat(one)
    assert again.tables["dm_orders"].count() == again.tables["dm_orders"].select("order_key").distinct().count()


def test_dds_constraints(spark, sf_small):
    from martflow.operators.quality import check_marts
    t = Tables(spark, sf_small)
    n = A.n_suppliers(t)
    run = DdsRun(spark, {"users": A.v_user_docs(t).withColumn("id", F.col("object_id").cast("long")),
                         "restaurants": A.v_rest_docs(t, n), "orders": A.v_order_docs(t),
                         "events": A.v_payment_events(t)}, scratch_path(spark, "t_dds_rules"))
    res = {(r.table_name, r.rule): r.violations for r in check_marts(run.tables).collect()}
    assert res[("fct_product_sales", "check:count_non_negative")] == 0
    assert res[("dm_products", "check:price_non_negative")] == 0
    assert all(v == 0 for (tbl, rule), v in res.items() if rule.startswith("unique"))
    # the test data's timestamps are 1995-2001, outside the DDL's 2020-2499 range: reported, not dropped
    assert res[("dm_timestamps", "check:year_2020_2499")] == run.tables["dm_timestamps"].count()


def _docs(spark, rows):
    return spark.createDataFrame([(i, str(i), v, None) for i, v in enumerate(rows, 1)],
                                 "id long, object_id string, object_value string, update_ts timestamp_ntz")


def test_an_event_without_lines_is_done(spark):
    menu = '{"_id":"r1","name":"R","update_ts":"2024-01-01 00:00:00","menu":[]}'
    order = '{"_id":"o1","restaurant":{"id":"r1"},"user":{"id":"u1"},"date":"2024-01-02 00:00:00","final_status":"CLOSED"}'
    events = spark.createDataFrame([(1, None, "bonus_transaction", '{"order_id":"o1","product_payments":[]}'),
                                    (2, None, "bonus_transaction", '{"order_id":"o2","product_payments":[]}')],
                                   "id long, event_ts timestamp_ntz, event_type string, event_value string")
    run = DdsRun(spark, {"users": _docs(spark, ['{"_id":"u1","name":"U","login":"u"}']), "restaurants": _docs(spark, [menu]),
                         "orders": _docs(spark, [order]), "events": events}, scratch_path(spark, "t_dds_empty"))
    assert [r.id for r in run.pending_events.collect()] == [2] and run.tables["fct_product_sales"].count() == 0


def test_malformed_documents_stop_the_load_or_go_to_quarantine(spark):
    import pytest
    from martflow.plans.dds import USER_DOC, dm_users, split_malformed
    docs = _docs(spark, ['{"_id":"u1","name":"U","login":"u"}', '{"_id":"u2", broken', None])
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        dm_users(docs).collect()
    good, bad = split_malformed(docs, USER_DOC)
    assert [r.user_id for r in dm_users(good).collect()] == ["u1"] and sorted(r.id for r in bad.collect()) == [2, 3]
