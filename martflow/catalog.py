"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the given tables (through the adapters) so its work
grows with them.  Keys match ``martflow.oracle.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow import adapters as A
from martflow.operators.keys import ntile_distributed
from martflow.sources.calendar import bounded
from martflow.plans import orders as P_orders, rfm as P_rfm
from martflow.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ P1: RFM and orders

@query("rfm_user_stats")
def q_rfm_user_stats(spark, sf):
    return P_rfm.user_stats(A.v_orders(Tables(spark, sf)))


@query("rfm_ntile_literal")
def q_rfm_ntile_literal(spark, sf):
    return P_rfm.rfm_ntile_literal(A.v_orders(Tables(spark, sf)))


@query("rfm_segments")
def q_rfm_segments(spark, sf):
    t = Tables(spark, sf)
    return P_rfm.rfm_segments(A.v_users(t), A.v_orders(t))


@query("rfm_bucket_balance")
def q_rfm_bucket_balance(spark, sf):
    t = Tables(spark, sf)
    return P_rfm.bucket_balance(P_rfm.rfm_segments(A.v_users(t), A.v_orders(t)))


@query("ntile_distributed")
def q_ntile_distributed(spark, sf):
    li = Tables(spark, sf).lineitem
    order = [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
             "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    out = ntile_distributed(li, 10, order, "decile")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "decile")


def _orders_table(t):
    """The orders table with its eight columns."""
    bonus, grant = F.lit(0.1).cast("decimal(2,1)"), F.lit(0.01).cast("decimal(3,2)")
    return A.v_orders(t).select(
        "order_id", "order_ts", "user_id", (F.col("payment") * bonus).cast("decimal(19,5)").alias("bonus_payment"), "payment",
        (F.col("payment") + F.col("payment") * bonus).cast("decimal(19,5)").alias("cost"),
        (F.col("payment") * grant).cast("decimal(19,5)").alias("bonus_grant"), "status")


@query("orders_final_status")
def q_orders_final_status(spark, sf):
    t = Tables(spark, sf)
    return P_orders.orders_final_status(_orders_table(t), A.v_status_log(t))


@query("orders_latest_status")
def q_orders_latest_status(spark, sf):
    t = Tables(spark, sf)
    return P_orders.orders_latest_status(_orders_table(t), A.v_status_log(t))


@query("layer_views")
def q_layer_views(spark, sf):
    """The analysis layer reads production only through pass-through views."""
    from martflow.sources.views import register_layer
    t = Tables(spark, sf)
    items = A.v_order_items(t)
    statuses = A.v_status_log(t).select(F.col("status_id").alias("id")).distinct()
    names = register_layer(spark, "production", {
        "orders": _orders_table(t), "users": A.v_users(t), "orderstatuslog": A.v_status_log(t), "orderitems": items,
        "products": items.select("product_id", "name", "price").distinct(), "orderstatuses": statuses})
    views = register_layer(spark, "analysis", {k: spark.table(v) for k, v in names.items()})
    # every row of every view, counted through it
    keys = {"orders": "order_id", "users": "id", "orderstatuslog": "order_id", "orderitems": "order_id", "products": "product_id", "orderstatuses": "id"}
    out = [spark.table(v).agg(F.count("*").alias("rows"), F.sum(F.col(keys[k]).cast("long")).alias("key_sum")).select(F.lit(k).alias("view"), "rows", "key_sum")
           for k, v in views.items()]
    for o in out[1:]:
        out[0] = out[0].unionByName(o)
    return out[0]


@query("order_amounts")
def q_order_amounts(spark, sf):
    return P_orders.order_amounts(A.v_order_items(Tables(spark, sf)))


@query("merge_lines")
def q_merge_lines(spark, sf):
    return P_orders.merge_lines(A.v_order_items(Tables(spark, sf)))


# ------------------------------------------------------------------ P2: shipping

def _ship(spark, sf, materialize=True):
    """The shipping model over the adapted log; the log (a 4-way join) is
    written once only for targets that read it more than twice."""
    from martflow.plans import shipping as S
    return S, S.Model(A.v_shipping(Tables(spark, sf)), materialize=materialize)


@query("split_descriptor")
def q_split_descriptor(spark, sf):
    S, m = _ship(spark, sf, materialize=False)
    return S.descriptors(m.log)


@query("age_day_part")
def q_age_day_part(spark, sf):
    """X6 on every line: ship date vs order date shifted by line-number hours."""
    from martflow.functions.scalars import age_day_part
    t = Tables(spark, sf)
    li, o = t.lineitem, t.orders
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")).alias("a_ts"),  # every third line has no stamp
        (F.col("o_orderdate") + F.make_interval(hours=F.col("l_linenumber"), mins=F.lit(30))).alias("b_ts"))
    return j.select("l_orderkey", "l_linenumber", "a_ts", "b_ts",
                    age_day_part("a_ts", "b_ts").alias("day_ab"), age_day_part("b_ts", "a_ts").alias("day_ba"))


@query("distinct_dims")
def q_distinct_dims(spark, sf):
    log = A.v_shipping(Tables(spark, sf))
    return log.select("shipping_country", "shipping_country_base_rate", "shipping_transfer_description",
                      "shipping_transfer_rate").distinct()


@query("shipping_country_rates")
def q_shipping_country_rates(spark, sf):
    return _ship(spark, sf, materialize=False)[1].country


@query("shipping_agreement")
def q_shipping_agreement(spark, sf):
    return _ship(spark, sf, materialize=False)[1].agreement


@query("shipping_transfer")
def q_shipping_transfer(spark, sf):
    return _ship(spark, sf, materialize=False)[1].transfer


@query("shipping_info")
def q_shipping_info(spark, sf):
    return _ship(spark, sf)[1].info


@query("shipping_info_latest_rate")
def q_shipping_info_latest_rate(spark, sf):
    """Rates rise over the years, so countries and transfer models have
    several; shipments are looked up by the latest."""
    S, m = _ship(spark, sf, materialize=False)
    risen = (F.year("state_datetime") - 1990).cast("decimal(14,3)") / 1000
    m = S.Model(m.log.withColumns({c: (F.col(c) + F.coalesce(risen, F.lit(0))).cast("decimal(14,3)") for c in ("shipping_country_base_rate", "shipping_transfer_rate")}),
                materialize=True)
    return S.info_by_latest_rate(m.log, m.country, m.agreement, m.transfer)


@query("shipping_status")
def q_shipping_status(spark, sf):
    return _ship(spark, sf, materialize=False)[1].status


@query("shipping_datamart")
def q_shipping_datamart(spark, sf):
    return _ship(spark, sf)[1].datamart()


@query("shipping_cost_by_country")
def q_shipping_cost_by_country(spark, sf):
    S, m = _ship(spark, sf)
    return S.cost_by_country(m)


@query("shipping_finished_last_week")
def q_shipping_finished_last_week(spark, sf):
    S, m = _ship(spark, sf)
    return S.finished_last_week(m)


@query("vendor_tariffs")
def q_vendor_tariffs(spark, sf):
    S, m = _ship(spark, sf)
    return S.vendor_tariffs(m)


# ------------------------------------------------------------------ P3: sales and retention

SPLIT_TS = "1998-01-01 00:00:00"  # stage rows before this are the earlier load


def _feed(spark, sf):
    return A.v_feed(Tables(spark, sf))


def _fact(spark, sf):
    import datetime as _dt

    from martflow.plans import sales as P
    from martflow.sources.calendar import calendar, days_between
    stage = _feed(spark, sf)
    lo, hi = stage.agg(F.min(F.to_date("date_time")), F.max(F.to_date("date_time"))).first()
    start, end = _dt.date(lo.year, 1, 1).isoformat(), _dt.date(hi.year, 12, 31).isoformat()
    cal = calendar(spark, start, days_between(start, end))
    fact = P.f_daily_sales(spark, stage, cal, lo.isoformat(), (hi + _dt.timedelta(days=1)).isoformat())
    return P, stage, cal, fact


@query("calendar_dim")
def q_calendar_dim(spark, sf):
    from martflow.sources.calendar import calendar_covering
    return calendar_covering(_feed(spark, sf), "date_time")


@query("f_daily_sales")
def q_f_daily_sales(spark, sf):
    return _fact(spark, sf)[3]


@query("f_daily_sales_slice")
def q_f_daily_sales_slice(spark, sf):
    """Named bounds inside the data; only rows from the first to before the second are dated."""
    from martflow.plans import sales as P
    P, stage, cal, _ = _fact(spark, sf)
    return P.f_daily_sales(spark, stage, cal, "1994-03-01", "1995-06-15")


@query("retention_base")
def q_retention_base(spark, sf):
    P, _, cal, fact = _fact(spark, sf)
    return P.retention_base(fact, cal)


@query("customer_retention")
def q_customer_retention(spark, sf):
    P, _, cal, fact = _fact(spark, sf)
    return P.customer_retention(P.retention_base(fact, cal))


@query("customer_retention_by_year")
def q_customer_retention_by_year(spark, sf):
    P, _, cal, fact = _fact(spark, sf)
    return P.customer_retention(P.retention_base(fact, cal, by_year=True), by_year=True)


@query("retention_increments")
def q_retention_increments(spark, sf):
    """The mart kept up by runs over parts of the days: all but three
    of them, those three with wrong amounts and one of them empty, then again
    as they are."""
    from martflow.operators.tables import publish
    from martflow.session import scratch_path
    P, stage, cal, fact = _fact(spark, sf)
    fact = publish(fact.join(bounded(cal.select("date_id", F.date_format("full_date", "yyyy-MM-dd").alias("day"))), "date_id"), "fact")
    days = sorted(r[0] for r in fact.select("day").distinct().collect())
    base, again = scratch_path(spark, "retention"), days[::max(1, len(days) // 3)][:3]
    some = fact.filter(F.col("day").isin(*again))
    P.refresh_retention(spark, base, fact.filter(~F.col("day").isin(*again)).drop("day"), [d for d in days if d not in again], cal)
    P.refresh_retention(spark, base, some.filter(F.col("day") != again[0]).withColumn("payment_amount", F.col("payment_amount") * 2).drop("day"), again, cal)
    return P.refresh_retention(spark, base, some.drop("day"), again, cal)


EARLY_TS = "1995-06-01 00:00:00"  # the first months of the feed, loaded by an earlier run


@query("d_customer")
def q_d_customer(spark, sf):
    from martflow.plans import sales as P
    from martflow.operators.tables import publish
    stage = _feed(spark, sf)
    early = publish(P.d_customer(stage.filter(F.col("date_time") < F.lit(EARLY_TS).cast("timestamp_ntz"))), "d_customer_early")
    top = early.agg(F.max("id")).first()[0] or 0
    return early.unionByName(P.d_customer(stage, early, start_id=top + 1))


@query("d_customer_one_per_id")
def q_d_customer_one_per_id(spark, sf):
    """B9 fixed: names vary with the order's priority; each id keeps its latest."""
    from martflow.plans import sales as P
    stage = _feed(spark, sf).withColumn("first_name", F.concat_ws("-", "first_name", F.col("item_id") % 3))
    return P.d_customer(stage, one_per_id=True)


@query("d_item_increment")
def q_d_item_increment(spark, sf):
    """The dim of the earlier rows after the later ones arrive; ids stay."""
    from martflow.operators.tables import publish
    from martflow.plans import sales as P
    stage = _feed(spark, sf)
    split = F.lit(EARLY_TS).cast("timestamp_ntz")
    early = publish(P.d_item(stage.filter(F.col("date_time") < split)), "d_item_early")
    return P.d_item_increment(early, stage.filter(F.col("date_time") >= split))


@query("f_daily_sales_midnight")
def q_f_daily_sales_midnight(spark, sf):
    """B12 as written: rows of every third item carry a time of day and drop out."""
    from martflow.plans import sales as P
    P, stage, cal, _ = _fact(spark, sf)
    shifted = stage.withColumn("date_time", F.when(F.col("item_id") % 3 == 0, F.col("date_time") + F.expr("INTERVAL 5 HOURS")).otherwise(F.col("date_time")))
    return P.f_daily_sales(spark, shifted, cal, "0001-01-01", "9999-12-31", midnight_only=True)


@query("d_item")
def q_d_item(spark, sf):
    from martflow.plans import sales as P
    return P.d_item(_feed(spark, sf))


@query("last_value_default_frame")
def q_last_value_default_frame(spark, sf):
    from martflow.plans import sales as P
    return P.last_value_default_frame(_feed(spark, sf))


@query("d_item_update")
def q_d_item_update(spark, sf):
    """U4: the dim loaded from the earlier stage rows, then renamed from the
    whole stage's latest names."""
    from martflow.operators.tables import update_from_lookup
    from martflow.plans import sales as P
    stage = _feed(spark, sf)
    existing = P.d_item(stage.filter(F.col("date_time") < F.lit(SPLIT_TS).cast("timestamp_ntz")))
    return update_from_lookup(existing, P.latest_item_names(stage), "item_id", "item_name")


@query("not_in_null_aware")
def q_not_in_null_aware(spark, sf):
    """Feed customers NOT IN the customers with a non-negative balance."""
    from martflow.operators.tables import not_in
    t = Tables(spark, sf)
    feed = A.v_feed(t).withColumn("customer_id", F.when(F.col("customer_id") % 7 != 0, F.col("customer_id")))
    known = t.customer.filter(F.col("c_acctbal") >= 0).select("c_custkey")
    with_null = t.customer.select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("c_custkey"))
    lists = {"plain": known, "with_null": with_null, "empty": known.filter(F.col("c_custkey") < 0)}
    out = [not_in(feed, "customer_id", v, "c_custkey").select(F.lit(k).alias("list"), "customer_id", "first_name", "last_name").distinct()
           for k, v in lists.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("append_with_defaults")
def q_append_with_defaults(spark, sf):
    """K2: the later feed rows arrive without ``status`` and take the default."""
    from martflow.operators.tables import append_with_defaults
    stage = _feed(spark, sf)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    inc = stage.filter(F.col("date_time") >= split).drop("status")
    from martflow.constants import STATUS_SHIPPED
    return append_with_defaults(stage.filter(F.col("date_time") < split), inc, {"status": STATUS_SHIPPED})


@query("replace_slice")
def q_replace_slice(spark, sf):
    """K4: stage written per day with a stale copy of the latest day, then
    that day's slice is replaced by the fresh increment."""
    from martflow.operators.tables import publish, read_slices, write_slices
    from martflow.plans.sales import day_of
    from martflow.session import scratch_path
    stage = publish(_feed(spark, sf).withColumn("day", day_of()), "feed")
    last_day = stage.agg(F.max("day")).first()[0]
    stale = stage.withColumn("quantity", F.when(F.col("day") == last_day, F.col("quantity") * 2)
                             .otherwise(F.col("quantity")))
    path = scratch_path(spark, "stage_user_orders_log")
    write_slices(stale, path, "day")
    write_slices(stage.filter(F.col("day") == last_day), path, "day", [last_day])
    return read_slices(spark, path, "day", schema=stage.schema).drop("day")


@query("backfill_equals_daily")
def q_backfill_equals_daily(spark, sf):
    """T4: the whole feed loaded in batches (the last three days one by one,
    the days before by year; the oldest batch and one day twice) and all at
    once; all rows with the number of rows in which the two loads differ."""
    from martflow.operators.tables import by_slice, clustered_slices, differing, publish, read_slices, write_slices
    from martflow.plans.sales import day_of
    from martflow.session import scratch_path
    stage = _feed(spark, sf).withColumn("day", day_of())
    inc = publish(by_slice(stage, "day").sortWithinPartitions("day"), "increment")
    days = sorted(r[0] for r in inc.select("day").distinct().collect())
    last, years = days[-3:], {}
    for d in days[:-3]:
        years.setdefault(str(d)[:4], []).append(d)
    batches = [*years.values(), *([d] for d in last)]
    daily, backfill = scratch_path(spark, "stage_daily"), scratch_path(spark, "stage_backfill")
    with clustered_slices():
        for batch in [*batches, batches[0], last[:1]]:
            write_slices(inc.filter(F.col("day").between(batch[0], batch[-1])), daily, "day", batch)
        write_slices(inc, backfill, "day", days)
    a, b = (read_slices(spark, p, "day", schema=stage.schema) for p in (daily, backfill))
    return a.drop("day").withColumn("differing", F.lit(differing(a, b)).cast("long"))


@query("delete_where_in")
def q_delete_where_in(spark, sf):
    """Fact rows dated on any day of the latest year's increment are deleted."""
    from martflow.operators.tables import delete_where_in
    P, stage, cal, fact = _fact(spark, sf)
    last_year = stage.agg(F.max(F.year("date_time"))).first()[0]
    inc = stage.filter(F.year("date_time") == last_year)
    days = inc.join(bounded(cal), cal.full_date == F.to_date(inc.date_time)).select("date_id")
    return delete_where_in(fact, days, "date_id")


# ------------------------------------------------------------------ P4a: staging, cursors, outbox

EVENTS_WF = "stage:events"
PREV_RUN_TS = "2024-01-15 00:00:00"  # time of the previous outbox load
RUN_TS = "2024-02-01 00:00:00"       # fixed as-of for keys that stamp a run time


def _prev_cursor(outbox) -> int:
    """Cursor saved by the previous run: max id loaded before PREV_RUN_TS."""
    from martflow.operators.cursor import cursor_advance, cursor_get, empty_state
    prev = outbox.filter(F.col("event_ts") < F.lit(PREV_RUN_TS).cast("timestamp_ntz"))
    state = cursor_advance(empty_state(outbox.sparkSession), prev, "id", F.lit(EVENTS_WF))
    return cursor_get(state, EVENTS_WF)


@query("upsert_all")
def q_upsert_all(spark, sf):
    """Customer balances (non-negative ones staged) upserted from the
    order stream; the last order per customer wins, NULL names included."""
    from martflow.operators.tables import upsert
    t = Tables(spark, sf)
    target = t.customer.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("decimal(19,5)").alias("balance"))
    source = t.orders.select(
        F.col("o_custkey").alias("id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("name"),
        F.col("o_totalprice").cast("decimal(19,5)").alias("balance"),
        F.col("o_orderkey"))
    return upsert(target, source.withColumnRenamed("o_orderkey", "_seq"), ["id"], [F.col("_seq")]).select(
        "id", "name", "balance")


@query("insert_if_absent")
def q_insert_if_absent(spark, sf):
    """Bonus users; the first order per unseen customer is inserted."""
    from martflow.operators.tables import insert_if_absent
    t = Tables(spark, sf)
    target = t.customer.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("order_user_id"))
    source = t.orders.select(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("order_user_id"),
        F.col("o_orderkey").alias("_seq"))
    return insert_if_absent(target, source, ["id"], [F.col("_seq")])


@query("upsert_partial")
def q_upsert_partial(spark, sf):
    """Staged order documents; a new copy refreshes the payload only and
    keeps the stored update_ts (B18); unseen documents are inserted whole."""
    from martflow.operators.tables import upsert
    o = Tables(spark, sf).orders

    def docs(df, version, shift_days):
        return df.select(
            F.col("o_orderkey").cast("string").alias("object_id"),
            F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("_id"),
                               F.lit(version).alias("v"))).alias("object_value"),
            (F.col("o_orderdate") + F.make_interval(days=F.lit(shift_days))).alias("update_ts"),
        )
    target = docs(o.filter(F.col("o_orderstatus") != "F"), 1, 0)
    source = docs(o.filter(F.col("o_orderstatus") != "O"), 2, 1)
    return upsert(target, source, ["object_id"], [F.col("update_ts")], update_cols=["object_value"])


@query("cursor_advance")
def q_cursor_advance(spark, sf):
    """One cursor per event type; the previous run's state is
    advanced by the batch read after it."""
    from martflow.operators.cursor import cursor_advance, empty_state
    ob = A.v_outbox(Tables(spark, sf))
    wf = F.concat(F.lit("outbox_"), F.col("event_type"))
    prev = ob.filter(F.col("event_ts") < F.lit(PREV_RUN_TS).cast("timestamp_ntz"))
    state = cursor_advance(empty_state(spark), prev, "id", wf)
    # of the later batch only the clicks are read, so the other cursors stay where the first run left them
    cut = _prev_cursor(ob)
    return cursor_advance(state, ob.filter((F.col("id") > cut) & (F.col("event_type") == "click")), "id", wf)


@query("run_log")
def q_run_log(spark, sf):
    """One status row per landed payload (couriers, restaurants, deliveries)."""
    from martflow.operators.cursor import run_log
    t = Tables(spark, sf)
    return run_log({"stg.couriers": A.v_courier_docs(t, RUN_TS),
                    "stg.restaurants": A.v_rest_docs(t, min_acctbal=None),
                    "stg.deliveries": A.v_delivery_docs(t, RUN_TS)}, RUN_TS)


@query("assign_keys")
def q_assign_keys(spark, sf):
    """Dense ids over customers in (segment, key) order."""
    from martflow.operators.keys import assign_keys
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    return assign_keys(c, ["c_mktsegment", "c_custkey"], start=1, key="id")


@query("docs_oldest_k")
def q_docs_oldest_k(spark, sf):
    from martflow.sources.staged import oldest_k
    ob = A.v_outbox(Tables(spark, sf)).drop("user_id")
    return oldest_k(ob, 500, ts_col="event_ts")


@query("copy_collection_sessions")
def q_copy_collection_sessions(spark, sf):
    """Stamps tie by the day, some stamps and ids are missing, a
    session copies a third of the documents, and sessions go on until the
    cursor stands still."""
    from martflow.operators.cursor import empty_state, settings_get
    from martflow.operators.tables import publish
    from martflow.plans import staging as P
    docs = publish(A.v_outbox(Tables(spark, sf)).select(
        F.when(F.col("id") % 13 != 0, F.col("id")).alias("_id"), "event_type",  # every 13th document has no id
        F.when(F.col("id") % 11 != 0, F.date_trunc("day", "event_ts").cast("timestamp_ntz")).alias("update_ts")), "documents")
    limit = max(1, docs.count() // 3)
    staged, state, before = spark.createDataFrame([], P.STAGED_DOC_DDL), empty_state(spark), None
    while True:
        for end in [*P.session_ends(docs, state, limit=limit), None]:
            staged, state = P.copy_collection(staged, docs, state, limit=limit, end=end)
            staged = publish(staged, "staged_documents")
        now = settings_get(state, P.COPY_WF, "last_ts", "last_id")
        if now == before:
            return staged
        before = now


@query("keys_at_ranks")
def q_keys_at_ranks(spark, sf):
    """The last line of every tenth of the lines by falling price (a
    third of the prices are NULL, ties go by order, line and ship date)."""
    from martflow.operators.selection import Key, keys_at
    li = Tables(spark, sf).lineitem.select(
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_extendedprice").cast("decimal(14,2)")).alias("price"), "l_orderkey", "l_linenumber",
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipped"))
    n = li.count()
    found = keys_at(li, [Key("price", desc=True), Key("l_orderkey"), Key("l_linenumber"), Key("shipped")], [n * i // 10 for i in range(1, 11)], bound=1000)
    return spark.createDataFrame([(r, *v) for r, v in found.items()], "rank long, price decimal(14,2), l_orderkey long, l_linenumber long, shipped timestamp_ntz")


@query("staged_since")
def q_staged_since(spark, sf):
    from martflow.sources.staged import read_since
    ob = A.v_outbox(Tables(spark, sf)).drop("user_id")
    return read_since(ob, _prev_cursor(ob))


@query("events_typed_since")
def q_events_typed_since(spark, sf):
    from martflow.sources.staged import read_events
    ob = A.v_outbox(Tables(spark, sf)).drop("user_id")
    return read_events(ob, "purchase", _prev_cursor(ob))


# Payload shape per event type of the test outbox.
# "error" has none: its events stay, unparsed.
EVENT_SHAPES = {"purchase": "k long", "signup": "k long", "click": "k long", "view": "k long"}


@query("events_by_type")
def q_events_by_type(spark, sf):
    from martflow.sources.staged import events_by_type
    ob = A.v_outbox(Tables(spark, sf))
    parsed = events_by_type(ob, EVENT_SHAPES)
    return parsed.select("id", "event_type", F.coalesce(*[F.col(f"{t}.k") for t in EVENT_SHAPES]).alias("k"))


# ------------------------------------------------------------------ P4b: snowflake DDS

class _Dds:
    """The DDS built from the document adapters of one table directory."""

    def __init__(self, spark, sf):
        from martflow.plans import dds as D
        self.D = D
        t = self.t = Tables(spark, sf)
        self.n_sup = A.n_suppliers(t)
        self.rest_docs = A.v_rest_docs(t, self.n_sup)
        self.order_docs = A.v_order_docs(t)

    # dimensions are built on first use (each one checkpoints its keyed rows)
    @cached_property
    def users(self):
        return self.D.dm_users(A.v_user_docs(self.t))

    @cached_property
    def restaurants(self):
        return self.D.dm_restaurants(self.rest_docs)

    @cached_property
    def timestamps(self):
        return self.D.dm_timestamps(self.order_docs)

    def products(self):
        return self.D.dm_products(self.rest_docs, self.restaurants)

    def orders(self):
        return self.D.dm_orders(self.order_docs, self.restaurants, self.timestamps, self.users)


@query("dm_users")
def q_dm_users(spark, sf):
    from martflow.plans import dds as D
    return D.dm_users(A.v_user_docs(Tables(spark, sf)))


@query("dm_restaurants")
def q_dm_restaurants(spark, sf):
    from martflow.plans import dds as D
    return D.dm_restaurants(A.v_rest_docs(Tables(spark, sf), min_acctbal=None))


@query("dm_products")
def q_dm_products(spark, sf):
    from martflow.plans import dds as D
    docs = A.v_rest_docs(Tables(spark, sf), min_acctbal=None)
    return D.dm_products(docs, D.dm_restaurants(docs))


@query("dm_timestamps")
def q_dm_timestamps(spark, sf):
    from martflow.plans import dds as D
    return D.dm_timestamps(A.v_order_docs(Tables(spark, sf)))


@query("dm_orders")
def q_dm_orders(spark, sf):
    return _Dds(spark, sf).orders()


@query("dm_orders_versions")
def q_dm_orders_versions(spark, sf):
    """Every restaurant has two versions in the dim; an order still comes
    out once, with the first one."""
    d = _Dds(spark, sf)
    first = d.restaurants
    again = first.select((F.col("id") + 1_000_000).alias("id"), "restaurant_id", "restaurant_name",
                         (F.col("active_from") + F.expr("INTERVAL 1 DAYS")).alias("active_from"), "active_to")
    return d.D.dm_orders(d.order_docs, first.unionByName(again), d.timestamps, d.users)


@query("dds_two_runs")
def q_dds_two_runs(spark, sf):
    """The earlier and the later half of the orders and events in two
    runs that share only a folder; the fact by natural keys."""
    from martflow.plans.dds import DdsRun, by_natural_keys
    from martflow.session import scratch_path
    t = Tables(spark, sf)
    orders, events = A.v_order_docs(t), A.v_payment_events(t)
    cut = t.orders.agg(F.percentile_approx("o_orderkey", 0.5)).first()[0]
    fixed = {"users": A.v_user_docs(t).withColumn("id", F.col("object_id").cast("long")), "restaurants": A.v_rest_docs(t, min_acctbal=None)}
    base = scratch_path(spark, "dds")
    DdsRun(spark, fixed | {"orders": orders.filter(F.col("id") > cut), "events": events.filter(F.col("id") <= cut)}, base, clustered=True)
    late = orders.filter(F.col("id") <= cut).withColumn("id", F.col("id") + 1_000_000_000)
    run = DdsRun(spark, fixed | {"orders": orders.unionByName(late), "events": events}, base, clustered=True)
    x = run.tables
    return by_natural_keys(x["fct_product_sales"], x["dm_products"], x["dm_orders"], run.buckets)


@query("fct_product_sales")
def q_fct_product_sales(spark, sf):
    d = _Dds(spark, sf)
    return d.D.fct_product_sales(A.v_payment_events(d.t), d.products(), d.orders())


@query("retry_unresolved")
def q_retry_unresolved(spark, sf):
    """T5: orders whose restaurant is missing wait in a pending set and load
    once the restaurant arrives in the next batch (no row is lost, B15)."""
    d = _Dds(spark, sf)
    D = d.D
    parsed = D.parse_orders(d.order_docs)
    ok1, pending = D.resolve_orders(parsed, d.restaurants, d.timestamps, d.users)
    restaurants2 = D.dm_restaurants(A.v_rest_docs(d.t, d.n_sup, min_acctbal=None))
    ok2, _still_pending = D.resolve_orders(pending, restaurants2, d.timestamps, d.users)
    cols = [F.col("order_key"), F.col("order_status"), F.col("rest_key").alias("restaurant_key"),
            F.col("user_key"), F.col("ts")]
    return ok1.select(*cols, F.lit(1).alias("batch")).unionByName(ok2.select(*cols, F.lit(2).alias("batch")))


@query("versioned_dim")
def q_versioned_dim(spark, sf):
    """Restaurants renamed in a later snapshot get a closed old version and
    an open new one; unchanged members keep their single open version."""
    from martflow.operators.tables import versioned_upsert
    s = Tables(spark, sf).supplier
    dim = s.select(F.col("s_suppkey").cast("string").alias("restaurant_id"),
                   F.col("s_name").alias("restaurant_name"),
                   A.rest_update_ts(F.col("s_suppkey")).alias("active_from"))
    from martflow.operators.tables import open_validity
    dim = open_validity(dim, F.col("active_from"))
    snap = s.select(F.col("s_suppkey").cast("string").alias("restaurant_id"),
                    F.when(F.col("s_acctbal") < 0, F.concat(F.col("s_name"), F.lit(" (renamed)")))
                    .otherwise(F.col("s_name")).alias("restaurant_name"))
    return versioned_upsert(dim, snap, "restaurant_id", ["restaurant_name"], RUN_TS)


def _priorities(t):
    """Order priorities as changes of their customers, in two batches: the odd
    orders, then the even ones, which are late for most customers."""
    from martflow.operators.temporal import merge_versions
    changes = t.orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("priority"),
                              F.col("o_orderdate").cast("timestamp_ntz").alias("changed"), "o_orderkey")
    empty = t.spark.createDataFrame([], "customer_id long, priority string, active_from timestamp_ntz, active_to timestamp_ntz")
    merged = lambda history, some: merge_versions(history, changes.filter(some), "customer_id", ["priority"], "changed", [F.col("o_orderkey")])
    return merged(merged(empty, F.col("o_orderkey") % 2 == 1), F.col("o_orderkey") % 2 == 0)


@query("versions_merged")
def q_versions_merged(spark, sf):
    """Histories with several versions a batch and late ones that split
    intervals; versions that say the same made one."""
    from martflow.operators.temporal import compacted
    return compacted(_priorities(Tables(spark, sf)), "customer_id", ["priority"])


@query("lines_as_of")
def q_lines_as_of(spark, sf):
    """Each line with its customer's priority at its ship date."""
    from martflow.operators.temporal import as_of_join
    t = Tables(spark, sf)
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("customer_id"), F.date_sub("l_shipdate", 60).cast("timestamp_ntz").alias("seen"))
    return as_of_join(lines, _priorities(t), "customer_id", "seen", ["priority"])


# ------------------------------------------------------------------ P4c: couriers and deliveries

EARLIER_RUN_TS = "2024-01-01 00:00:00"  # as-of of the earlier courier load


@query("json_fields")
def q_json_fields(spark, sf):
    from martflow.plans import courier as C
    return C.json_fields(A.v_delivery_docs(Tables(spark, sf), RUN_TS))


@query("json_nested_fields")
def q_json_nested_fields(spark, sf):
    """Documents in which the wanted keys also stand deeper down, inside
    strings, under escapes and twice; numbers with zeros at the end and 19 digits."""
    from martflow.functions.json_raw import checked_members, member_text
    o = Tables(spark, sf).orders
    key, total = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    docs = o.select("o_orderkey", F.concat(
        F.lit('{"inner": {"sum": 1.50, "list": [{"sum": '), key, F.lit('}, 2]}, "sum": 7, "note": "say \\"sum\\": '), key, F.lit(', {ok}" ,\n "s\\u0075m" : '),
        total, F.lit('0, "long": 1234567890'), F.lpad(key, 9, "0"), F.lit('.10, "none": null, "list": [ '), key, F.lit(', "]" ], "sums": "x"}')).alias("doc"))
    doc = docs.select("o_orderkey", checked_members("doc").alias("d"))
    return doc.select("o_orderkey", *[member_text(F.col("d"), k).alias(f"v_{k}") for k in ("sum", "inner", "note", "long", "none", "list", "absent")])


@query("deliveries_set_aside")
def q_deliveries_set_aside(spark, sf):
    """Every seventh document is cut off, every eleventh has no
    delivery_id; those wait in quarantine and the others load."""
    from martflow.plans import courier as C
    number = F.col("object_id").cast("long")
    docs = A.v_delivery_docs(Tables(spark, sf), RUN_TS).withColumn("object_value", F.when(number % 7 == 0, F.expr("left(object_value, 30)"))
           .when(number % 11 == 0, F.replace("object_value", F.lit('"delivery_id"'), F.lit('"other_id"'))).otherwise(F.col("object_value")))
    good, aside = C.split_deliveries(docs)
    return C.dm_tips(None, good).select("delivery_id", "tip_sum", F.lit(False).alias("set_aside")).unionByName(
        aside.select(F.concat(F.lit("d"), "object_id").alias("delivery_id"), F.lit(None).cast("decimal(14,2)").alias("tip_sum"), F.lit(True).alias("set_aside")))


@query("dm_couriers")
def q_dm_couriers(spark, sf):
    """Couriers already loaded earlier are kept; the new payload
    only adds the unseen ones."""
    from martflow.plans import courier as C
    t = Tables(spark, sf)
    first = C.dm_couriers(None, A.v_courier_docs(t, EARLIER_RUN_TS, min_acctbal=0.0))
    return C.dm_couriers(first, A.v_courier_docs(t, RUN_TS))


@query("close_missing")
def q_close_missing(spark, sf):
    """Couriers absent from the latest payload are closed at the run time."""
    from martflow.plans import courier as C
    t = Tables(spark, sf)
    dim = C.dm_couriers(None, A.v_courier_docs(t, EARLIER_RUN_TS))
    return C.close_missing_couriers(dim, A.v_courier_docs(t, RUN_TS, min_acctbal=0.0), RUN_TS)


def _every_other(docs):
    """The deliveries that an earlier run has stored."""
    return docs.filter(F.col("object_id").cast("long") % 2 == 0)


def _stored(dim):
    """A dimension as that run leaves it: a table, read by the next one."""
    from martflow.operators.tables import publish
    return publish(dim, "stored")


@query("api_restaurants")
def q_api_restaurants(spark, sf):
    """Stored restaurants are kept, new ones added, and those
    that the latest payload lacks are closed."""
    from martflow.plans import courier as C
    t = Tables(spark, sf)
    stored = C.dm_restaurants(None, A.v_courier_docs(t, EARLIER_RUN_TS, min_acctbal=0.0))
    later = A.v_courier_docs(t, RUN_TS).filter(F.col("object_id").cast("long") % 5 != 0)
    return C.close_missing_restaurants(C.dm_restaurants(stored, later), later, RUN_TS)


@query("dm_deliveries")
def q_dm_deliveries(spark, sf):
    from martflow.plans import courier as C
    docs = A.v_delivery_docs(Tables(spark, sf), RUN_TS)
    stored = _stored(C.dm_deliveries(None, _every_other(docs))).withColumn("address", F.lit("as stored"))
    return C.dm_deliveries(stored, docs)


@query("dm_rate")
def q_dm_rate(spark, sf):
    from martflow.plans import courier as C
    docs = A.v_delivery_docs(Tables(spark, sf), RUN_TS)
    return C.dm_rate(_stored(C.dm_rate(None, _every_other(docs))).withColumn("rate", F.lit(0).cast("smallint")), docs)


@query("dm_tips")
def q_dm_tips(spark, sf):
    from martflow.plans import courier as C
    docs = A.v_delivery_docs(Tables(spark, sf), RUN_TS)
    return C.dm_tips(_stored(C.dm_tips(None, _every_other(docs))).withColumn("tip_sum", F.lit(0).cast("decimal(14,2)")), docs)


# ------------------------------------------------------------------ file sources and documents

PAGE_SIZE = 50  # records per landed API page


@query("scan_csv_plain")
def q_scan_csv_plain(spark, sf):
    """The product menu as a headerless ';' file, read back with its DDL."""
    from martflow.session import scratch_path
    from martflow.sources import files as Fl
    p = Tables(spark, sf).part.select(F.col("p_partkey").cast("int").alias("id"), F.col("p_name").alias("name"),
                                      F.col("p_retailprice").cast("decimal(19,5)").alias("price"))
    path = scratch_path(spark, "menu_csv")
    Fl.write_csv(p, path, sep=";", header=False)
    return Fl.read_csv_plain(spark, path, "id int, name string, price decimal(19,5)")


ORDERS_DDL = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(14,2), "
              "o_orderdate timestamp_ntz, o_orderpriority string")


@query("scan_csv_header")
def q_scan_csv_header(spark, sf):
    """Orders as comma CSV with a header, read with the declared schema."""
    from martflow.session import scratch_path
    from martflow.sources import files as Fl
    o = Fl.conform(Tables(spark, sf).orders, ORDERS_DDL)
    path = scratch_path(spark, "orders_csv")
    Fl.write_csv(o, path)
    return Fl.read_csv_header(spark, path, ORDERS_DDL)


CUSTOMER_DDL = "c_custkey long, c_name string, c_nationkey int, c_acctbal decimal(12,2), c_mktsegment string"


@query("scan_csv_inferred")
def q_scan_csv_inferred(spark, sf):
    """A feed with a leading row id; types inferred, first column
    dropped, columns inserted by name into the typed stage table."""
    from martflow.session import scratch_path
    from martflow.sources import files as Fl
    c = Tables(spark, sf).customer
    feed = c.select(F.concat(F.lit("row-"), F.col("c_custkey").cast("string")).alias("uniq_id"), *c.columns)
    path = scratch_path(spark, "customer_csv")
    Fl.write_csv(feed, path)
    return Fl.conform(Fl.drop_leading(Fl.read_csv_inferred(spark, path), 1), CUSTOMER_DDL)


@query("land_json")
def q_land_json(spark, sf):
    """Courier API pages (JSON arrays of PAGE_SIZE records) landed as
    staging rows; pages are bounded, so no page gathers an unbounded group."""
    from martflow.session import scratch_path
    from martflow.sources import files as Fl
    s = Tables(spark, sf).supplier
    rec = F.struct(F.col("s_suppkey").cast("string").alias("_id"), F.col("s_name").alias("name"))
    pages = (s.groupBy(F.floor(F.col("s_suppkey") / PAGE_SIZE).alias("page"))
             .agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("s_suppkey").alias("k"), rec.alias("r"))))
                            .getField("r")).alias("value")))
    path = scratch_path(spark, "couriers_api")
    pages.select("value").write.text(path)
    records = Fl.read_json_records(spark, path, "_id string, name string")
    return Fl.land_json(records, "_id", RUN_TS)


@query("normalise_docs")
def q_normalise_docs(spark, sf):
    """Order documents with stamps and a nullable field -> JSON text."""
    from martflow.sources import files as Fl
    o = Tables(spark, sf).orders
    docs = o.select(
        F.col("o_orderkey").cast("string").alias("_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("update_ts"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return Fl.normalise_docs(docs, "_id", "update_ts")


@query("normalise_nested_docs")
def q_normalise_nested_docs(spark, sf):
    """Ids and stamps in lists of documents three levels down, in maps, and
    as twelve bytes."""
    from martflow.sources import files as Fl
    li = Tables(spark, sf).lineitem
    oid = F.unhex(F.lpad(F.hex("l_partkey"), 24, "0"))
    seen = F.struct(F.col("l_shipdate").cast("timestamp_ntz").alias("at"), F.struct(F.col("l_suppkey").alias("id"), oid.alias("oid")).alias("supplier"))
    docs = li.select(
        F.concat(F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("_id"), F.col("l_linenumber").cast("int").alias("number"),
        F.array(F.struct(F.col("l_partkey").alias("id"), F.array(seen, F.when(F.col("l_linenumber") > 1, seen)).alias("seen"))).alias("parts"),
        F.create_map(F.lit("order"), F.struct(F.col("l_orderkey").alias("_id"), F.lit(None).cast("string").alias("note"))).alias("of"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("update_ts"))
    return Fl.normalise_docs(docs, "_id", "update_ts")


# ------------------------------------------------------------------ data quality

@query("dq_not_null")
def q_dq_not_null(spark, sf):
    from martflow.operators import quality as Q
    t = Tables(spark, sf)
    return Q.union_all([Q.not_null(t.orders, "orders"), Q.not_null(t.lineitem, "lineitem"),
                        Q.not_null(t.customer, "customer")])


@query("dq_unique")
def q_dq_unique(spark, sf):
    from martflow.operators import quality as Q
    t = Tables(spark, sf)
    return Q.union_all([Q.unique(t.orders, "orders", ["o_orderkey"]),
                        Q.unique(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"]),
                        Q.unique(t.customer, "customer", ["c_custkey"]),
                        Q.unique(t.part, "part", ["p_partkey"])])


@query("dq_orphans")
def q_dq_orphans(spark, sf):
    from martflow.operators import quality as Q
    t = Tables(spark, sf)
    return Q.union_all([
        Q.orphans(t.orders, "orders", "o_custkey", t.customer, "c_custkey"),
        Q.orphans(t.lineitem, "lineitem", "l_orderkey", t.orders, "o_orderkey"),
        Q.orphans(t.lineitem, "lineitem", "l_partkey", t.part, "p_partkey"),
        Q.orphans(t.lineitem, "lineitem", "l_suppkey", t.supplier, "s_suppkey"),
        Q.orphans(t.customer, "customer", "c_nationkey", t.nation, "n_nationkey"),
    ])


@query("dq_row_predicates")
def q_dq_row_predicates(spark, sf):
    from martflow.operators import quality as Q
    t = Tables(spark, sf)
    items = A.v_order_items(t)
    disc = F.col("price") * F.col("discount_rate")
    yr = F.year("o_orderdate")
    return Q.union_all([
        Q.row_predicates(t.part, "part", {"price_non_negative": F.col("p_retailprice") >= 0}),
        Q.row_predicates(t.lineitem, "lineitem", {"quantity_positive": F.col("l_quantity") > 0,
                                                  "discount_rate_0_1": F.col("l_discount").between(0, 1)}),
        Q.row_predicates(items, "order_items", {"discount_0_to_price": (disc >= 0) & (disc <= F.col("price"))}),
        Q.row_predicates(t.customer, "customer", {"name_varchar_25": Q.max_length("c_name", 25)}),
        Q.row_predicates(t.orders, "orders", {"ts_year_2020_2499": (yr >= 2020) & (yr < 2500),
                                              "ts_month_le_12": F.month("o_orderdate") <= 12}),
    ])


@query("dq_one_scan")
def q_dq_one_scan(spark, sf):
    """Q1 / Q2 / Q4 / Q8: all rules of lines, and of orders, from one scan each;
    every fifth line lacks its ship date, and lines are also keyed by part."""
    from martflow.operators import quality as Q
    t = Tables(spark, sf)
    li = t.lineitem.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_shipdate")))
    return Q.union_all([
        Q.in_one_scan(li, "lineitem", ["l_orderkey", "l_shipdate"], [["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey"], ["l_shipdate"]],
                      {"quantity_below_40": F.col("l_quantity") < 40, "discount_rate_0_1": F.col("l_discount").between(0, 1)}),
        Q.in_one_scan(t.orders, "orders", ["o_custkey"], [["o_orderkey"], ["o_custkey"]], {"status_varchar_1": Q.max_length("o_orderstatus", 1)})])


@query("dq_accepted")
def q_dq_accepted(spark, sf):
    """Q5: order status domain; only Closed (4) and Cancelled (5) are accepted."""
    from martflow.operators import quality as Q
    from martflow.constants import FINAL_STATUSES
    return Q.accepted_values(A.v_orders(Tables(spark, sf)), "status", list(FINAL_STATUSES))


@query("dq_rank_thresholds")
def q_dq_rank_thresholds(spark, sf):
    """The threshold's own CHECK beside that of the percentage; customers as ranks."""
    from martflow.operators import quality as Q
    ranks = Tables(spark, sf).customer.select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") - 2).alias("bonus_percent"),
                                              F.col("c_acctbal").cast("decimal(19,5)").alias("min_payment_threshold"))
    return Q.row_predicates(ranks, "ranks", Q.rank_rules())


@query("dq_reconcile")
def q_dq_reconcile(spark, sf):
    """Q6: orders whose payment differs from the sum of price * quantity."""
    from martflow.operators import quality as Q
    t = Tables(spark, sf)
    return Q.reconcile(A.v_orders(t), "order_id", "payment", A.v_order_items(t), "order_id",
                       F.col("price") * F.col("quantity"))


# ------------------------------------------------------------------ streaming

OUTBOX_DDL = "id long, event_ts timestamp_ntz, event_type string, event_value string"


def _arrive(df, path):
    """Land one batch of files into a watched folder (one write = one arrival)."""
    df.write.mode("append").parquet(path)


@query("stream_outbox_tail")
def q_stream_outbox_tail(spark, sf):
    """The outbox arrives in two drops; the second run of the stream
    delivers exactly the rows of the second drop."""
    from martflow.session import scratch_path
    from martflow.streaming import outbox as S
    ob = A.v_outbox(Tables(spark, sf)).drop("user_id")
    base = scratch_path(spark, "outbox_tail")
    src, ckpt, sink = f"{base}/source", f"{base}/checkpoint", f"{base}/sink"
    prev = F.col("event_ts") < F.lit(PREV_RUN_TS).cast("timestamp_ntz")
    _arrive(ob.filter(prev), src)
    S.tail(spark, src, OUTBOX_DDL, ckpt, sink, "1")
    _arrive(ob.filter(~prev), src)
    S.tail(spark, src, OUTBOX_DDL, ckpt, sink, "2")
    return spark.read.schema(OUTBOX_DDL + ", run string, batch long").parquet(sink).filter(
        F.col("run") == "2").select("id", "event_ts", "event_type", "event_value")


@query("stream_dedupe")
def q_stream_dedupe(spark, sf):
    """Every outbox event is delivered twice; each id comes out once."""
    from martflow.session import scratch_path
    from martflow.streaming import outbox as S
    ob = A.v_outbox(Tables(spark, sf)).drop("user_id")
    base = scratch_path(spark, "outbox_dedupe")
    src = f"{base}/source"
    _arrive(ob, src)
    _arrive(ob, src)
    S.dedupe(spark, src, OUTBOX_DDL, f"{base}/checkpoint", f"{base}/sink", ["id"], [F.col("event_ts")])
    return spark.read.parquet(f"{base}/sink").select("id", "event_ts", "event_type", "event_value")


@query("stream_dedupe_late")
def q_stream_dedupe_late(spark, sf):
    """The later events arrive first, then the earlier ones with copies of
    all; none is lost and each id comes out once."""
    from martflow.session import scratch_path
    from martflow.streaming import outbox as S
    ob = A.v_outbox(Tables(spark, sf)).drop("user_id")
    base = scratch_path(spark, "outbox_late")
    src = f"{base}/source"
    prev = F.col("event_ts") < F.lit(PREV_RUN_TS).cast("timestamp_ntz")
    for drop in (ob.filter(~prev), ob):
        _arrive(drop, src)
        S.dedupe(spark, src, OUTBOX_DDL, f"{base}/checkpoint", f"{base}/sink", ["id"], [F.col("event_ts")])
    return spark.read.parquet(f"{base}/sink").select("id", "event_ts", "event_type", "event_value")


@query("stream_dedupe_state")
def q_stream_dedupe_state(spark, sf):
    """T3 on a state store: the later events with copies, then all events, then
    copies alone, each in a run of its own."""
    from martflow.session import scratch_path
    from martflow.streaming import outbox as S
    ob = A.v_outbox(Tables(spark, sf)).drop("user_id")
    base = scratch_path(spark, "outbox_state")
    src = f"{base}/source"
    later = ob.filter(F.col("event_ts") >= F.lit(PREV_RUN_TS).cast("timestamp_ntz"))
    copies = later.withColumns({"event_ts": F.col("event_ts") + F.expr("INTERVAL 3 DAYS"), "event_value": F.lit("copy")})
    for drop in (later.unionByName(copies), ob.unionByName(copies), copies):
        _arrive(drop, src)
        S.dedupe_by_state(spark, src, OUTBOX_DDL, f"{base}/checkpoint", f"{base}/sink", ["id"], [F.col("event_ts")])
    return spark.read.parquet(f"{base}/sink").select("id", "event_ts", "event_type", "event_value")


@query("stream_release")
def q_stream_release(spark, sf):
    """T5 as state: half of the orders arrive before any restaurant or user,
    restaurants in two drops, the other orders in between."""
    from martflow.plans import dds as D
    from martflow.session import scratch_path
    from martflow.streaming import outbox as S
    t = Tables(spark, sf)
    base = scratch_path(spark, "release")
    orders = D.parse_orders(A.v_order_docs(t)).drop("staged_id")
    users = t.customer.select(F.col("c_custkey").cast("string").alias("user_id"), F.col("c_name").alias("user_name"))
    rests = t.supplier.select(F.col("s_suppkey").cast("string").alias("restaurant_id"), F.col("s_name").alias("restaurant_name"))
    odd = lambda c: F.col(c).cast("long") % 2 == 1
    drops = [{"orders": orders.filter(odd("order_key"))}, {"rests": rests.filter(odd("restaurant_id")), "users": users},
             {"orders": orders.filter(~odd("order_key")), "rests": rests.filter(odd("restaurant_id")).withColumn("restaurant_name", F.lit("a later copy"))},
             {"rests": rests.filter(~odd("restaurant_id"))}]
    for name, df in (("orders", orders), ("rests", rests), ("users", users)):
        _arrive(df.limit(0), f"{base}/{name}")
    for drop in drops:
        for name, df in drop.items():
            _arrive(df, f"{base}/{name}")
        stream = lambda name, df: spark.readStream.schema(df.schema).parquet(f"{base}/{name}")
        S.release(stream("orders", orders), {"rest_key": stream("rests", rests), "user_key": stream("users", users)}, f"{base}/checkpoint", f"{base}/sink")
    return spark.read.parquet(f"{base}/sink").select("order_key", "order_status", "rest_key", "restaurant_name", "user_key", "user_name", "ts")


DOC_DDL = "object_id string, object_value string, update_ts timestamp_ntz"


@query("stream_upsert")
def q_stream_upsert(spark, sf):
    """Order documents arrive in two drops (a new version of most orders
    in the second); each micro-batch is upserted into the staged table."""
    from martflow.session import scratch_path
    from martflow.streaming import outbox as S
    o = Tables(spark, sf).orders

    def docs(df, version, shift_days):
        return df.select(
            F.col("o_orderkey").cast("string").alias("object_id"),
            F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("_id"),
                               F.lit(version).alias("v"))).alias("object_value"),
            (F.col("o_orderdate") + F.make_interval(days=F.lit(shift_days))).alias("update_ts"))
    base = scratch_path(spark, "docs_upsert")
    src, ckpt, table = f"{base}/source", f"{base}/checkpoint", f"{base}/table"
    order = [F.col("update_ts"), F.col("object_value")]
    _arrive(docs(o.filter(F.col("o_orderstatus") != "F"), 1, 0), src)
    S.upsert_stream(spark, src, DOC_DDL, ckpt, table, ["object_id"], order)
    _arrive(docs(o.filter(F.col("o_orderstatus") != "O"), 2, 1), src)
    S.upsert_stream(spark, src, DOC_DDL, ckpt, table, ["object_id"], order)
    from martflow.operators.tables import read_buckets
    return read_buckets(spark, table, DOC_DDL)


@query("dm_deliveries_date_literal")
def q_dm_deliveries_date_literal(spark, sf):
    """B22 as written: ``::date`` casts drop the time of day before the
    TIMESTAMP columns store them."""
    from martflow.plans import courier as C
    return C.dm_deliveries(None, A.v_delivery_docs(Tables(spark, sf), RUN_TS), keep_time=False)
