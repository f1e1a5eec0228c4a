"""First/last per key with PostgreSQL NULL ordering and ties."""

import datetime as dt

from martflow.plans.shipping import status


def test_status_null_stamp_is_latest_and_ties_total(spark):
    t1, t2 = dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 2)
    rows = [
        (1, t1, "in_progress", "booked"), (1, t2, "finished", "recieved"),   # plain
        (2, t1, "in_progress", "booked"), (2, None, "in_progress", "lost"),  # NULL stamp: DESC NULLS FIRST
        (3, t2, "finished", "a"), (3, t2, "finished", "b"), (3, t1, "x", "y"),  # tie on the latest stamp
    ]
    log = spark.createDataFrame(rows, "shippingid int, state_datetime timestamp_ntz, status string, state string")
    got = {r.shippingid: tuple(r)[1:] for r in status(log).collect()}
    assert got[1] == ("finished", "recieved", t1, t2)
    assert got[2] == ("in_progress", "lost", t1, None)
    assert got[3] == ("finished", "b", t1, t2)  # one row per shipment, ties broken by (status, state)
    assert status(log).count() == 3


def test_latest_item_name_intended_vs_literal(spark):
    from martflow.plans.sales import last_value_default_frame, latest_item_names
    t1, t2 = dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 2)
    # newer name appears earlier in file order
    stage = spark.createDataFrame([(7, t2, "new"), (7, t1, "old")], "item_id int, date_time timestamp_ntz, item_name string")
    assert [tuple(r) for r in latest_item_names(stage).collect()] == [(7, "new")]
    literal = sorted(tuple(r) for r in last_value_default_frame(stage).collect())
    assert literal == [(7, "new"), (7, "old")]  # B7: both names survive the literal query
