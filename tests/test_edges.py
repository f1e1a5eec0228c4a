"""Edge rows of FIXTURES.md on the marts (inline fixtures)."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

D = dt.datetime


def test_rfm_never_buyers_get_one_and_5_is_best(spark):
    from martflow.plans.rfm import rfm_segments
    users = spark.createDataFrame([(i,) for i in range(1, 11)], "id long")
    orders = spark.createDataFrame(
        [(100 + i, D(2021, 1, i), i, i * 10, 4) for i in range(1, 10)] + [(200, D(2021, 2, 1), 9, 1, 5)],
        "order_id long, order_ts timestamp_ntz, user_id long, payment int, status int") \
        .withColumn("payment", F.col("payment").cast("decimal(19,5)"))
    seg = {r.user_id: (r.recency, r.frequency, r.monetary_value) for r in rfm_segments(users, orders).collect()}
    assert seg[10] == (1, 1, 1)                 # user without orders
    assert seg[9][0] == 5 and seg[9][2] == 5    # most recent and richest buyer
    assert all(1 <= v <= 5 for t in seg.values() for v in t)


def test_d_customer_two_spellings_emit_id_twice(spark):
    from martflow.plans.sales import d_customer
    stage = spark.createDataFrame([(1, "Ann", "Lee", 5), (1, "Anne", "Lee", 3), (2, "Bo", "Ng", 7)],
                                  "customer_id long, first_name string, last_name string, city_id int")
    out = d_customer(stage).collect()
    assert sorted((r.customer_id, r.first_name, r.city_id) for r in out) == [(1, "Ann", 5), (1, "Anne", 3),
                                                                              (2, "Bo", 7)]   # B9 literal
    assert sorted(r.id for r in out) == [1, 2, 3]


def test_country_with_two_rates_fans_out_and_check_catches_it(spark):
    from martflow.operators.quality import unique
    from martflow.plans.shipping import Model
    t = D(2021, 1, 1)
    rows = [(1, 1, Dec("10"), t, "finished", "x", t, "1p:car", Dec("0.001"), "Peru", Dec("0.010"), "1:vsp-1:0.01:0.023"),
            (2, 1, Dec("20"), t, "finished", "x", t, "1p:car", Dec("0.001"), "Peru", Dec("0.020"), "1:vsp-1:0.01:0.023")]
    log = spark.createDataFrame(rows, "shippingid long, vendorid long, payment_amount decimal(14,2), "
                                "state_datetime timestamp_ntz, status string, state string, "
                                "shipping_plan_datetime timestamp_ntz, shipping_transfer_description string, "
                                "shipping_transfer_rate decimal(14,3), shipping_country string, "
                                "shipping_country_base_rate decimal(14,3), vendor_agreement_description string")
    m = Model(log)
    assert m.info.count() == 4  # literal join by country name only: each shipment twice (B5)
    assert unique(m.country, "country", ["shipping_country"]).first().violations == 1


def test_malformed_descriptor_quarantine_and_ansi_raise(spark):
    from martflow.plans.shipping import agreements, quarantine_descriptors
    log = spark.createDataFrame([("1:vsp-1:0.01:0.023",), ("2::vsp-2:0.02:0.023",), ("x:vsp:0.1:0.2",), ("3:vsp",)],
                                "vendor_agreement_description string")
    bad = sorted(r[0] for r in quarantine_descriptors(log).collect())
    assert bad == ["3:vsp", "x:vsp:0.1:0.2"]
    with pytest.raises(Exception):
        agreements(log).collect()  # ANSI cast of 'x' to BIGINT raises, as the database does


def test_retention_refund_only_and_mixed_weeks(spark):
    from martflow.plans.sales import customer_retention, retention_base
    from martflow.sources.calendar import calendar
    cal = calendar(spark, "2021-01-04", 14)  # two ISO weeks (1 and 2)
    fact = spark.createDataFrame([
        (1, 10, 1, "refunded", 5.0), (2, 10, 2, "shipped", 7.0), (3, 10, 2, "shipped", 3.0),   # week 1
        (8, 10, 3, "refunded", 4.0), (9, 10, 3, "shipped", 6.0),                                # week 2
    ], "date_id int, item_id int, customer_id long, status string, payment_amount double") \
        .withColumn("payment_amount", F.col("payment_amount").cast("decimal(10,2)"))
    out = {r.period_id: r for r in customer_retention(retention_base(fact, cal)).collect()}
    w1, w2 = out[1], out[2]
    assert (w1.new_customers_count, w1.returning_customers_count, w1.refunded_customer_count) == (1, 1, 1)
    assert float(w1.new_customers_revenue) == -5.0 and float(w1.returning_customers_revenue) == 10.0
    assert (w2.returning_customers_count, w2.customers_refunded) == (1, 1)
    assert float(w2.returning_customers_revenue) == 2.0


def test_courier_vanishes_then_returns(spark):
    from martflow.operators.tables import versioned_upsert
    from martflow.plans.courier import close_missing_couriers, dm_couriers
    def payload(ids, ts):
        return spark.createDataFrame([(i, '{"_id":"%s","name":"n%s"}' % (i, i), ts) for i in ids],
                                     "object_id string, object_value string, update_ts timestamp_ntz")
    d1 = dm_couriers(None, payload(["a", "b"], D(2024, 1, 1)))
    d2 = close_missing_couriers(d1, payload(["a"], D(2024, 1, 2)), "2024-01-02 00:00:00")
    closed = {r.courier_id: r.active_to for r in d2.collect()}
    assert closed["b"] == D(2024, 1, 2) and closed["a"] == D(2099, 12, 31)
    # literal insert-if-absent does not reopen a returning courier ...
    d3 = dm_couriers(d2, payload(["a", "b"], D(2024, 1, 3)))
    assert d3.filter("courier_id = 'b'").count() == 1
    # ... the versioned operator opens a new version for it
    snap = spark.createDataFrame([("a", "na"), ("b", "nb")], "courier_id string, courier_name string")
    v = versioned_upsert(d2, snap, "courier_id", ["courier_name"], "2024-01-03 00:00:00")
    assert v.filter("courier_id = 'b' AND active_to = TIMESTAMP_NTZ'2099-12-31 00:00:00'").count() == 1


def test_shipping_tables_keep_their_primary_keys(spark, sf_small):
    from martflow import adapters as A
    from martflow.operators.quality import check_marts
    from martflow.plans.shipping import Model
    from martflow.sources.tables import Tables
    m = Model(A.v_shipping(Tables(spark, sf_small)))
    marts = {"shipping_info": m.info, "shipping_status": m.status, "shipping_agreement": m.agreement,
             "shipping_country_rates": m.country, "shipping_transfer": m.transfer}
    assert all(r.violations == 0 for r in check_marts(marts).collect())
