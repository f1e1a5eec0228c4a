"""A DDS run moves keys and ids to the dimensions and back, not the events."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martflow.catalog import QUERIES
from martflow.plans import dds
from martflow.session import scratch_path, shared_dir

EVENT = "id long, event_ts timestamp_ntz, event_type string, event_value string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, str(i), v, None) for i, v in enumerate(rows, 1)], "id long, object_id string, object_value string, update_ts timestamp_ntz")


def _order(key):
    return f'{{"_id":"{key}","restaurant":{{"id":"r1"}},"user":{{"id":"u1"}},"date":"2024-01-02 00:00:00","final_status":"CLOSED"}}'


def _event(key, order, *products):
    pays = ",".join(f'{{"product_id":"{p}","product_name":"n","price":1.5,"quantity":{q},"product_cost":3,"bonus_payment":0.1,"bonus_grant":0.2}}' for p, q in products)
    return (key, None, "bonus_transaction", f'{{"user_id":1,"order_id":"{order}","order_date":"x","product_payments":[{pays}]}}')


def _staged(spark, products, orders, events):
    menu = ",".join(f'{{"_id":"{p}","name":"n","price":1.5}}' for p in products)
    rests = [f'{{"_id":"r1","name":"R","update_ts":"2024-01-01 00:00:00","menu":[{menu}]}}']
    return {"users": _docs(spark, ['{"_id":"u1","name":"U","login":"u"}']), "restaurants": _docs(spark, rests),
            "orders": _docs(spark, map(_order, orders)), "events": spark.createDataFrame(events, EVENT)}


def _facts(run):
    x = run.tables
    got = dds.by_natural_keys(x["fct_product_sales"], x["dm_products"], x["dm_orders"], run.buckets)
    return sorted((r.event_id, r.order_key, r.product_key, r["count"]) for r in got.collect())


def _first_and_second(spark, base):
    events = [_event(1, "o1", ("p1", 1), ("p2", 2), ("p1", 3)), _event(2, "o2", ("p1", 4)), _event(3, "o1", ("p1", 5), ("p9", 6)),
              _event(4, "o1", ("p1", 7)), _event(4, "o1", ("p1", 7)), _event(5, "o1", ("p1", 8)), _event(5, "o9", ("p2", 9)), _event(6, "o1")]
    first = dds.DdsRun(spark, _staged(spark, ["p1", "p2"], ["o1"], events), base)
    got = [_facts(first), sorted(r.id for r in first.pending_events.collect())]
    staged = _staged(spark, ["p1", "p2"], ["o1", "o2"], events)
    late = _staged(spark, ["p9"], [], events)["restaurants"].withColumn("id", F.col("id") + 1)
    second = dds.DdsRun(spark, staged | {"restaurants": staged["restaurants"].unionByName(late)}, base)
    return [*got, _facts(second), sorted(r.id for r in second.pending_events.collect())]


ONE = [(1, "o1", "p1", 1), (1, "o1", "p1", 3), (1, "o1", "p2", 2), (4, "o1", "p1", 7), (4, "o1", "p1", 7), (5, "o1", "p1", 8)]
TWO = sorted([*ONE, (2, "o2", "p1", 4), (3, "o1", "p1", 5), (3, "o1", "p9", 6)])


@pytest.mark.parametrize("few", [64, 1])
def test_unknown_orders_and_products_wait(spark, monkeypatch, few):
    monkeypatch.setattr(dds, "FEW", few)
    assert _first_and_second(spark, scratch_path(spark, "t_moves")) == [ONE, [2, 3], TWO, []]


def test_the_number_of_files_belongs_to_the_folder(spark):
    base, n = scratch_path(spark, "t_files"), spark.conf.get("spark.sql.shuffle.partitions")
    events = [_event(i, "o1" if i % 2 else "o2", ("p1", i)) for i in range(1, 40)]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        dds.DdsRun(spark, _staged(spark, ["p1"], ["o1"], events[:30]), base)
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        run = dds.DdsRun(spark, _staged(spark, ["p1"], ["o1", "o2"], events), base)
        assert run.buckets == 3 and [r[0] for r in _facts(run)] == list(range(1, 40))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)


def test_malformed_payments_stop_the_load_before_their_order_is_known(spark):
    bad = (1, None, "bonus_transaction", '{"order_id":"o9","product_payments":[{"product_id":"p1","quantity":"many"}]}')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        dds.DdsRun(spark, _staged(spark, ["p1"], ["o1"], [bad]), scratch_path(spark, "t_broken"))


def test_measures_are_not_shuffled_and_intermediates_go(spark, sf_small):
    t = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    left = Path(shared_dir(spark).removeprefix("file:"), "martflow")
    before = set(left.glob("*"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = QUERIES["dds_two_runs"](spark, sf_small)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", t)
    exchanges = [part for part in plan.split("\n\n") if part.strip().split("\n")[0].endswith("Exchange")]
    assert len(exchanges) >= 4 and not any("total_sum" in e for e in exchanges)
    assert not [p for p in set(left.glob("*")) - before if p.name.startswith(("events_", "orders_", "keys", "fct_"))]
