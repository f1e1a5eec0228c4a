"""Test tables -> the input shapes the reference's jobs read.

Each adapter is a lazy DataFrame over the given parquet tables, so every
query that uses it scales with them.  The matching DuckDB text lives in
``martflow.oracle`` and is written independently from the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martflow.constants import (BONUS_GRANT_RATE, EVENT_BONUS_TRANSACTION, SHIPPING_FINISHED, STATUS_REFUNDED,
                                STATUS_SHIPPED)
from martflow.sources.tables import Tables

MONEY = "decimal(19,5)"


def _money(c: str | Column, t: str = MONEY) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(t)


# ---------------------------------------------------------------- P1: RFM / orders

def v_orders(t: Tables) -> DataFrame:
    """orders -> (order_id, order_ts, user_id, payment, status 4/5/3)."""
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("payment"),
        F.when(F.col("o_orderstatus") == "F", 4)
        .when(F.col("o_orderstatus") == "P", 5)
        .when(F.col("o_orderstatus") == "O", 3)
        .alias("status"),
    )


def v_users(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.col("c_mktsegment"), F.col("c_custkey").cast("string")).alias("login"),
    )


def v_status_log(t: Tables) -> DataFrame:
    """lineitem -> order status log (order_id, status_id, dttm)."""
    li = t.lineitem
    return (
        li.select(
            F.col("l_orderkey").alias("order_id"),
            (F.lit(1) + F.col("l_linenumber") % 5).alias("status_id"),
            F.col("l_shipdate"),
        )
        .groupBy("order_id", "status_id")
        .agg(F.max("l_shipdate").alias("dttm"))
    )


def v_order_items(t: Tables) -> DataFrame:
    """lineitem + part -> order items with exact decimal prices."""
    li, p = t.lineitem, t.part
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("p_name").alias("name"),
        _money("p_retailprice").alias("price"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount_rate"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


# ---------------------------------------------------------------- P2: shipping log

def v_shipping(t: Tables) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation -> the denormalised shipping log."""
    li, o, c, n = t.lineitem, t.orders, t.customer, t.nation
    ck = F.col("o_custkey")
    v = F.col("l_orderkey") % 50
    nk = F.col("n_nationkey")
    transfer = F.concat_ws(
        ":",
        F.when(ck % 2 == 0, "1p").otherwise("3p"),
        F.when(ck % 3 == 0, "car").when(ck % 3 == 1, "train").otherwise("ship"),
    )
    agreement = F.concat_ws(
        ":", v.cast("string"), F.concat(F.lit("vsp-"), v.cast("string")),
        F.concat(F.lit("0.0"), (v % 10).cast("string")), F.lit("0.023"),
    )
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # nation: 25 rows, fixed
        .select(
            F.col("l_orderkey").alias("shippingid"),
            v.alias("vendorid"),
            _money("o_totalprice", "decimal(14,2)").alias("payment_amount"),
            F.col("l_shipdate").alias("state_datetime"),
            F.when(F.col("l_linestatus") == "F", SHIPPING_FINISHED).otherwise("in_progress").alias("status"),
            F.when(F.col("l_returnflag") == "R", "returned")
            .when(F.col("l_returnflag") == "A", "recieved")
            .otherwise("booked").alias("state"),
            (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("shipping_plan_datetime"),
            transfer.alias("shipping_transfer_description"),
            ((F.lit(1) + ck % 2 * 3 + ck % 3).cast("decimal(4,0)") * F.lit(0.001).cast("decimal(4,3)"))
            .cast("decimal(14,3)").alias("shipping_transfer_rate"),
            F.col("n_name").alias("shipping_country"),
            ((F.lit(1) + nk).cast("decimal(4,0)") * F.lit(0.01).cast("decimal(3,2)"))
            .cast("decimal(14,3)").alias("shipping_country_base_rate"),
            agreement.alias("vendor_agreement_description"),
        )
    )


# ---------------------------------------------------------------- P3: sales feed

def v_feed(t: Tables) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ part -> stage.user_orders_log."""
    li, o, c, p = t.lineitem, t.orders, t.customer, t.part
    # the customers join the orders, which are fewer than the lines: lines are
    # shuffled by part and by order only, and without the customers' columns
    ordered = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderdate", "o_custkey", "c_mktsegment", "c_name")
    return (
        li.join(p, li.l_partkey == p.p_partkey)
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_orderdate").alias("date_time"),
            F.col("l_suppkey").cast("int").alias("city_id"),
            F.concat(F.lit("city-"), F.col("l_suppkey").cast("string")).alias("city_name"),
            F.col("o_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.col("l_partkey").cast("int").alias("item_id"),
            F.concat_ws(" ", F.col("p_name"), F.col("l_returnflag")).alias("item_name"),
            F.col("l_quantity").cast("long").alias("quantity"),
            _money("l_extendedprice", "decimal(14,2)").alias("payment_amount"),
            F.when(F.col("l_returnflag") == "R", STATUS_REFUNDED).otherwise(STATUS_SHIPPED).alias("status"),
        )
    )


# ---------------------------------------------------------------- P4: outbox and documents

def v_outbox(t: Tables) -> DataFrame:
    """events -> outbox (id, event_ts, event_type, event_value JSON)."""
    e = t.events
    return e.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("event_ts"),
        F.col("event_type"),
        F.col("props").alias("event_value"),
        F.col("user_id"),
    )


TS_FMT = "yyyy-MM-dd HH:mm:ss"


def v_user_docs(t: Tables, update_ts: str = "2024-02-01 00:00:00") -> DataFrame:
    """Staged user documents (object_id, object_value, update_ts)."""
    u = v_users(t)
    return u.select(
        F.col("id").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("id").cast("string").alias("_id"), F.col("name"), F.col("login"),
        )).alias("object_value"),
        F.lit(update_ts).cast("timestamp_ntz").alias("update_ts"),
    )


def n_suppliers(t: Tables) -> int:
    """Row count of supplier: one scalar, used to spread parts over menus."""
    return t.supplier.count()


def v_rest_docs(t: Tables, n_sup: int | None = None, min_acctbal: float | None = 0.0) -> DataFrame:
    """Restaurant documents: suppliers (by default those with a non-negative
    balance), each with its menu = parts p where p_partkey % #suppliers = s_suppkey.

    A menu holds about parts/suppliers items, a ratio fixed by the table
    generator, so the nested array per document stays bounded.
    """
    s, p = t.supplier, t.part
    n_sup = n_sup or n_suppliers(t)
    menu = (
        p.select(
            (F.col("p_partkey") % n_sup).alias("rest_key"),
            F.col("p_partkey"),
            F.struct(
                F.col("p_partkey").cast("string").alias("_id"),
                F.col("p_name").alias("name"),
                _money("p_retailprice").alias("price"),
            ).alias("item"),
        )
        .groupBy("rest_key")
        .agg(F.sort_array(F.collect_list(F.struct("p_partkey", "item"))).alias("m"))
        .select("rest_key", F.transform("m", lambda x: x["item"]).alias("menu"))
    )
    rest = s if min_acctbal is None else s.filter(F.col("s_acctbal") >= min_acctbal)
    upd = F.date_format(rest_update_ts(F.col("s_suppkey")), TS_FMT)
    return rest.join(menu, rest.s_suppkey == menu.rest_key, "left").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_suppkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("s_suppkey").cast("string").alias("_id"),
            F.col("s_name").alias("name"),
            upd.alias("update_ts"),
            F.coalesce(F.col("menu"), F.array().cast(
                "array<struct<_id:string,name:string,price:decimal(19,5)>>")).alias("menu"),
        )).alias("object_value"),
        upd.cast("timestamp_ntz").alias("update_ts"),
    )


def rest_update_ts(suppkey: Column) -> Column:
    """Restaurant version time: 2024-01-01 plus (suppkey % 24) hours."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(
        hours=(suppkey % 24).cast("int"))


ORDER_STATUS_TEXT = {"F": "CLOSED", "P": "CANCELLED", "O": "OPEN"}


def _status_text(c: Column) -> Column:
    out = None
    for k, v in ORDER_STATUS_TEXT.items():
        out = (F.when(c == k, v) if out is None else out.when(c == k, v))
    return out


def order_restaurant(t: Tables) -> DataFrame:
    """Restaurant of an order = smallest supplier among its lines (partial agg)."""
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("rest_key"))


def v_order_docs(t: Tables) -> DataFrame:
    """Staged order documents; orders without lines carry restaurant.id = null."""
    o = t.orders
    r = order_restaurant(t)
    return o.join(r, o.o_orderkey == r.l_orderkey, "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("o_orderkey").cast("string").alias("_id"),
            F.struct(F.col("rest_key").cast("string").alias("id")).alias("restaurant"),
            F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
            F.date_format("o_orderdate", TS_FMT).alias("date"),
            _status_text(F.col("o_orderstatus")).alias("final_status"),
        ), {"ignoreNullFields": "false"}).alias("object_value"),
        F.col("o_orderdate").alias("update_ts"),
    )


def v_payment_events(t: Tables) -> DataFrame:
    """One bonus_transaction outbox event per order with lines.

    product_payments lists the order's lines (bounded by the generator's
    lines-per-order limit), sorted by line number.
    """
    li, o, p = t.lineitem, t.orders, t.part
    # lines travel to their parts and orders with the columns read; what is derived is made there
    line = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_retailprice", "l_quantity", "l_discount").repartition("l_orderkey")
    price, quantity, disc = _money("p_retailprice"), F.col("l_quantity").cast("int"), F.col("l_discount").cast("decimal(4,2)")
    cost = price * quantity
    bonus = cost * disc
    payment = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        price.alias("price"),
        quantity.alias("quantity"),
        cost.cast(MONEY).alias("product_cost"),
        bonus.cast(MONEY).alias("bonus_payment"),
        ((cost - bonus) * F.lit(BONUS_GRANT_RATE).cast("decimal(3,2)")).cast(MONEY).alias("bonus_grant"),
    ).alias("pp")
    per_order = line.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", payment))).alias("pps"))
    return per_order.join(o, per_order.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("event_ts"),
        F.lit(EVENT_BONUS_TRANSACTION).alias("event_type"),
        F.to_json(F.struct(
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.date_format("o_orderdate", TS_FMT).alias("order_date"),
            F.transform("pps", lambda x: x["pp"]).alias("product_payments"),
        )).alias("event_value"),
    )


def v_courier_docs(t: Tables, as_of: str, min_acctbal: float | None = None) -> DataFrame:
    """Courier API payload landed in staging: suppliers as couriers."""
    s = t.supplier
    if min_acctbal is not None:
        s = s.filter(F.col("s_acctbal") >= min_acctbal)
    return s.select(
        F.col("s_suppkey").cast("string").alias("object_id"),
        F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("_id"),
                           F.col("s_name").alias("name"))).alias("object_value"),
        F.lit(as_of).cast("timestamp_ntz").alias("update_ts"),
    )


def v_delivery_docs(t: Tables, as_of: str) -> DataFrame:
    """Delivery API payload: one document per order with lines."""
    li, o = t.lineitem, t.orders
    per = li.groupBy("l_orderkey").agg(
        F.max("l_suppkey").alias("courier"),
        F.max("l_shipdate").alias("delivered"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    total = _money("o_totalprice", "decimal(14,2)")
    return per.join(o, per.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.date_format("o_orderdate", TS_FMT).alias("order_ts"),
            F.concat(F.lit("d"), F.col("o_orderkey").cast("string")).alias("delivery_id"),
            F.col("courier").cast("string").alias("courier_id"),
            F.concat(F.lit("street "), F.col("o_custkey").cast("string")).alias("address"),
            F.date_format("delivered", TS_FMT).alias("delivery_ts"),
            total.alias("sum"),
            F.least(F.col("n_lines"), F.lit(5)).cast("int").alias("rate"),
            (total * F.lit(0.05).cast("decimal(3,2)")).cast("decimal(14,2)").alias("tip_sum"),
        )).alias("object_value"),
        F.lit(as_of).cast("timestamp_ntz").alias("update_ts"),
    )
