"""Staged JSON documents -> snowflake DDS.

The reference parses one document at a time and looks each dimension up
with a query per row.  Here every loader is set-based: ``from_json`` with a
declared schema, ``inline`` for nested arrays, and equi-joins to dimensions
reduced to one row per natural key.  Surrogate ids follow the natural key
through the distributed ``assign_keys``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martflow.constants import EVENT_BONUS_TRANSACTION
from martflow.functions.scalars import parse_doc_ts, sentinel, time_text
from martflow.operators.keys import assign_keys
from martflow.operators.lookup import require_resolved

USER_DOC = "_id string, name string, login string"
MENU_ITEM = "struct<_id:string,name:string,price:decimal(19,5)>"
RESTAURANT_DOC = f"_id string, name string, update_ts string, menu array<{MENU_ITEM}>"
ORDER_DOC = "_id string, restaurant struct<id:string>, user struct<id:string>, date string, final_status string"
MOST_BUCKETS = 10_000  # Spark takes up to 100,000
FEW = 64  # different keys of an event that its lines look through; those of larger events are joined one by one
PAYMENT = "price:decimal(19,5),quantity:int,product_cost:decimal(19,5),bonus_payment:decimal(19,5),bonus_grant:decimal(19,5)"
PAYMENT_DOC = ("user_id long, order_id string, order_date string, product_payments array<struct<"
               f"product_id:string,product_name:string,{PAYMENT}>>")
PAYMENTS = f"product_payments array<struct<product_id:string,{PAYMENT}>>"


def _doc(staged: DataFrame, schema: str) -> DataFrame:
    """Parsed documents; a malformed one stops the load, as it must not
    become a member full of NULLs (``split_malformed`` sets such rows aside)."""
    return staged.select("*", F.from_json("object_value", schema, {"mode": "FAILFAST"}).alias("d"))


def split_malformed(staged: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(documents that parse, documents that don't): the second for a
    quarantine table.  A NULL document doesn't parse."""
    parsed = F.from_json("object_value", f"{schema}, _mf_broken string", {"columnNameOfCorruptRecord": "_mf_broken"})
    j = staged.withColumn("_mf_d", parsed)
    broken = F.col("_mf_d").isNull() | F.col("_mf_d._mf_broken").isNotNull()
    return j.filter(~broken).drop("_mf_d"), j.filter(broken).drop("_mf_d")


def one_per_key(dim: DataFrame, key: str, as_key: str, as_id: str) -> DataFrame:
    """A dimension as a lookup, one row per natural key: the member
    with the smallest id, the first match of the reference's queries."""
    return dim.groupBy(F.col(key).alias(as_key)).agg(F.min("id").alias(as_id))


def dm_users(user_docs: DataFrame) -> DataFrame:
    """Users dimension."""
    u = _doc(user_docs, USER_DOC).select(
        F.col("d._id").alias("user_id"), F.col("d.name").alias("user_name"), F.col("d.login").alias("user_login"))
    return assign_keys(u, ["user_id"], key="id").select("id", "user_id", "user_name", "user_login")


def dm_restaurants(rest_docs: DataFrame) -> DataFrame:
    """Restaurants valid from their update_ts to the sentinel."""
    r = _doc(rest_docs, RESTAURANT_DOC).select(
        F.col("d._id").alias("restaurant_id"), F.col("d.name").alias("restaurant_name"),
        parse_doc_ts("d.update_ts").alias("active_from"), sentinel().alias("active_to"))
    return assign_keys(r, ["restaurant_id", "active_from"], key="id").select(
        "id", "restaurant_id", "restaurant_name", "active_from", "active_to")


def menu_items(rest_docs: DataFrame, restaurants: DataFrame, abort_on_miss: bool = True) -> DataFrame:
    """Menu items of each restaurant document.

    Each item needs its restaurant's surrogate id; as in the reference a
    missing restaurant aborts the load (checked before anything is published).
    """
    items = _doc(rest_docs, RESTAURANT_DOC).select(
        F.col("d._id").alias("rest_key"), parse_doc_ts("d.update_ts").alias("active_from"),
        F.inline("d.menu"))
    items = items.select(
        "rest_key", "active_from", F.col("_id").alias("product_id"), F.col("name").alias("product_name"),
        F.col("price").alias("product_price"))
    dim = one_per_key(restaurants, "restaurant_id", "rest_key", "restaurant_id")
    j = items.join(dim, "rest_key", "left")
    if abort_on_miss:
        require_resolved(j, "restaurant_id", "menu item without restaurant")
    p = j.filter(F.col("restaurant_id").isNotNull()).select(
        "product_id", "product_name", "product_price", "active_from", sentinel().alias("active_to"),
        "restaurant_id")
    return p


def dm_products(rest_docs: DataFrame, restaurants: DataFrame, abort_on_miss: bool = True) -> DataFrame:
    """The menu items, numbered."""
    return assign_keys(menu_items(rest_docs, restaurants, abort_on_miss), ["product_id", "restaurant_id"], key="id").select(
        "id", "product_id", "product_name", "product_price", "active_from", "active_to", "restaurant_id")


def order_times(order_docs: DataFrame) -> DataFrame:
    """One row per distinct order time."""
    ts = _doc(order_docs, ORDER_DOC).select(parse_doc_ts("d.date").alias("ts")).distinct()
    ts = ts.select(
        "ts", F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"),
        time_text("ts").alias("time"), F.to_date("ts").alias("date"))
    return ts


def dm_timestamps(order_docs: DataFrame) -> DataFrame:
    """The order times, numbered."""
    return assign_keys(order_times(order_docs), ["ts"], key="id").select("id", "ts", "year", "month", "day", "time", "date")


def parse_orders(order_docs: DataFrame) -> DataFrame:
    return _doc(order_docs, ORDER_DOC).select(
        F.col("id").alias("staged_id"),
        F.col("d._id").alias("order_key"), F.col("d.final_status").alias("order_status"),
        F.col("d.restaurant.id").alias("rest_key"), F.col("d.user.id").alias("user_key"),
        parse_doc_ts("d.date").alias("ts"))


def resolve_orders(orders: DataFrame, restaurants: DataFrame, timestamps: DataFrame,
                   users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Look up restaurant, timestamp and user; returns (resolved,
    unresolved).  Left joins keep the misses so they can be retried (T5)."""
    return split_resolved(look_up_orders(orders, restaurants, timestamps, users), orders.columns)


def look_up_orders(orders: DataFrame, restaurants: DataFrame, timestamps: DataFrame, users: DataFrame) -> DataFrame:
    """All orders with the ids of their members, NULL where there is none."""
    r = one_per_key(restaurants, "restaurant_id", "rest_key", "restaurant_id")
    t = one_per_key(timestamps, "ts", "ts", "timestamp_id")
    u = one_per_key(users, "user_id", "user_key", "user_id")
    # the users, who are many, come first: what they are shuffled with is narrower then
    return orders.join(u, "user_key", "left").join(r, "rest_key", "left").join(t, "ts", "left")


def split_resolved(looked_up: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(orders with all three members, the others with ``columns``)."""
    ok = F.col("restaurant_id").isNotNull() & F.col("timestamp_id").isNotNull() & F.col("user_id").isNotNull()
    return looked_up.filter(ok), looked_up.filter(~ok).select(*columns)


def dm_orders(order_docs: DataFrame, restaurants: DataFrame, timestamps: DataFrame, users: DataFrame) -> DataFrame:
    """Orders whose three dimensions resolve (the rest are skipped)."""
    ok, _ = resolve_orders(parse_orders(order_docs), restaurants, timestamps, users)
    o = ok.select("order_key", "order_status", "restaurant_id", "timestamp_id", "user_id")
    return assign_keys(o, ["order_key"], key="id").select(
        "id", "order_key", "order_status", "restaurant_id", "timestamp_id", "user_id")


def payment_docs(payment_events: DataFrame) -> DataFrame:
    """The bonus_transaction events parsed: event_id, order_key, product_payments."""
    ev = payment_events.filter(F.col("event_type") == EVENT_BONUS_TRANSACTION)
    parsed = ev.select(F.col("id").alias("event_id"), F.from_json("event_value", PAYMENT_DOC, {"mode": "FAILFAST"}).alias("d"))
    return parsed.select("event_id", F.col("d.order_id").alias("order_key"), "d.product_payments")


def with_order_key(payment_events: DataFrame) -> DataFrame:
    """Events with their order's key; a malformed one stops the load."""
    return payment_events.withColumn("order_key", F.from_json("event_value", PAYMENT_DOC, {"mode": "FAILFAST"})["order_id"])


def parsed_once(payment_events: DataFrame, *others: str) -> DataFrame:
    """The payments of events that :func:`with_order_key` has checked, without
    the product names, which no fact has; and ``others`` of their columns."""
    return payment_events.select(F.col("id").alias("event_id"), *others, F.from_json("event_value", PAYMENTS, {"mode": "FAILFAST"})["product_payments"].alias("product_payments"))


def lines_of(docs: DataFrame) -> DataFrame:
    """One row per product line of the parsed events."""
    return docs.select("event_id", "order_key", F.inline("product_payments"))


def payment_lines(payment_events: DataFrame) -> DataFrame:
    """One row per product line of the bonus_transaction events."""
    return lines_of(payment_docs(payment_events))


def unresolved_events(lines: DataFrame, products: DataFrame) -> DataFrame:
    """(event_id) of events with a line whose product is unknown."""
    known = products.select("product_id").distinct()
    return lines.select("event_id", "product_id").join(known, "product_id", "left_anti").select("event_id").distinct()


def fct_product_sales(payment_events: DataFrame, products: DataFrame, orders: DataFrame,
                      cursor: int = -1) -> DataFrame:
    """Product lines of bonus_transaction events.

    An event whose lines name any unknown product is dropped whole (found
    from narrow keys, before the wide lines are joined); the product
    dictionary is last-wins per natural id; an event whose order is not in
    the DDS yet is skipped.  Events are read with ``id > cursor``.
    """
    return facts_of(payment_lines(payment_events.filter(F.col("id") > F.lit(cursor))), products, orders)


def facts_of(lines: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """The fact rows of parsed lines (see :func:`fct_product_sales`)."""
    pdict = products.groupBy("product_id").agg(F.max("id").alias("product_sk"))
    o = one_per_key(orders, "order_key", "order_key", "order_sk")
    whole = lines.join(unresolved_events(lines, products), "event_id", "left_anti")
    return whole.join(pdict, "product_id").join(o, "order_key").select(
        F.col("product_sk").alias("product_id"), F.col("order_sk").alias("order_id"),
        F.col("quantity").alias("count"), "price", F.col("product_cost").alias("total_sum"),
        "bonus_payment", "bonus_grant", "event_id")


# ---------------------------------------------------------------- lookups that move keys only


def by_event(rows: DataFrame, n: int | None, **found) -> DataFrame:
    """What was found for the keys of each event, as one row an event that the
    event joins without leaving its place."""
    dealt = rows.repartition(n, "event_id") if n else rows
    return dealt.groupBy("event_id").agg(*[c.alias(name) for name, c in found.items()])


def found_map(key: str, value: str) -> Column:
    """key -> value of a group's rows, in which a key has one value."""
    return F.map_from_entries(F.collect_set(F.when(F.col(key).isNotNull(), F.struct(key, value))))


def joined_by(rows: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``few`` has one slim row for each key: hashed, so that wide rows aren't sorted."""
    return rows.join(few.hint("shuffle_hash"), key, how)


def known_orders(keys: DataFrame, orders: DataFrame, n: int | None = None) -> DataFrame:
    """(event_id, order_sks) of events with a known order, from (event_id, order_key)."""
    hits = keys.join(one_per_key(orders, "order_key", "order_key", "order_sk"), "order_key")
    return by_event(hits, n, order_sks=found_map("order_key", "order_sk"))


def known_products(docs: DataFrame, products: DataFrame, n: int | None = None) -> DataFrame:
    """(event_id, product_sks, whole) of parsed events with lines; ``whole`` if
    every line's product is known.  Of a product's members the last counts."""
    pdict = products.groupBy("product_id").agg(F.max("id").alias("product_sk"))
    asked = docs.select("event_id", F.explode("product_payments.product_id").alias("product_id"))
    return by_event(asked.join(pdict, "product_id", "left"), n, product_sks=found_map("product_id", "product_sk"),
                    whole=F.every(F.col("product_sk").isNotNull()))


def facts_by_event(docs: DataFrame, products_of: DataFrame) -> DataFrame:
    """The fact rows (see :func:`fct_product_sales`) of parsed events with
    their order's id, from the products found for each event."""
    docs, whole = docs.filter(F.col("order_sk").isNotNull()), products_of.filter("whole").drop("whole")
    few = F.size("product_sks") <= FEW
    lines = joined_by(docs, whole.filter(few), "event_id").select("event_id", "order_sk", "product_sks", F.inline("product_payments"))
    lines = lines.withColumn("product_sk", F.try_element_at("product_sks", "product_id")).drop("product_sks")
    if not (many := whole.filter(~few)).isEmpty():
        each = many.select("event_id", F.explode("product_sks").alias("product_id", "product_sk"))
        large = joined_by(docs, many.select("event_id"), "event_id", "left_semi").select("event_id", "order_sk", F.inline("product_payments"))
        lines = lines.unionByName(large.join(each, ["event_id", "product_id"]))
    return lines.select(
        F.col("product_sk").alias("product_id"), F.col("order_sk").alias("order_id"),
        F.col("quantity").alias("count"), "price", F.col("product_cost").alias("total_sum"),
        "bonus_payment", "bonus_grant", "event_id")


def by_natural_keys(facts: DataFrame, products: DataFrame, orders: DataFrame, n: int | None = None) -> DataFrame:
    """The fact inner joined with products and orders, for the natural keys of
    its ids; both have one row for each id."""
    products = products.select(F.col("id").alias("product_id"), F.col("product_id").alias("product_key"))
    orders = orders.select(F.col("id").alias("order_id"), "order_key")
    columns = ["event_id", "order_key", "product_key", "count", "price", "total_sum", "bonus_payment", "bonus_grant"]
    large = facts.groupBy("event_id").agg(F.count(F.lit(1)).alias("lines")).filter(F.col("lines") > FEW).select("event_id")
    plain = None
    if not large.isEmpty():
        plain = joined_by(facts, large, "event_id", "left_semi").join(products, "product_id").join(orders, "order_id").select(*columns)
        facts = joined_by(facts, large, "event_id", "left_anti")
    p = by_event(facts.select("event_id", "product_id").distinct().join(products, "product_id"), n, product_keys=found_map("product_id", "product_key"))
    o = by_event(facts.select("event_id", "order_id").distinct().join(orders, "order_id"), n, order_keys=found_map("order_id", "order_key"))
    keyed = joined_by(joined_by(facts, p, "event_id"), o, "event_id").filter(
        F.map_contains_key("product_keys", F.col("product_id")) & F.map_contains_key("order_keys", F.col("order_id")))
    keyed = keyed.withColumns({"product_key": F.try_element_at("product_keys", "product_id"),
                               "order_key": F.try_element_at("order_keys", "order_id")}).select(*columns)
    return keyed if plain is None else keyed.unionByName(plain)


# ---------------------------------------------------------------- entry B: incremental DDS runs

def new_members(existing: DataFrame | None, new: DataFrame, natural_key: list[str], order: list[str],
                key: str = "id") -> DataFrame:
    """Members of ``new`` (one row per natural key) not yet in the dimension
    (insert-if-absent on the natural key), numbered after the current largest id."""
    if existing is None:
        return assign_keys(new, order, key=key).select(key, *new.columns)
    fresh = new.join(existing.select(*natural_key), natural_key, "left_anti")
    top = existing.agg(F.max(key)).first()[0] or 0
    return assign_keys(fresh, order, start=top + 1, key=key).select(key, *new.columns)


def append_members(existing: DataFrame | None, new: DataFrame, natural_key: list[str], order: list[str],
                   key: str = "id") -> DataFrame:
    """Existing members plus the new ones (see :func:`new_members`)."""
    fresh = new_members(existing, new, natural_key, order, key)
    return fresh if existing is None else existing.select(key, *new.columns).unionByName(fresh)


class DdsRun:
    """One run of the document -> DDS workflows over staged tables.

    ``staged`` maps 'users', 'restaurants', 'orders' to staged document
    frames (id, object_id, object_value, update_ts) and 'events' to the
    outbox.  ``base`` is the folder of the DDS in the shared storage; all
    that a later run needs is there, so any process can start the next one.
    Each workflow reads only rows with id above its cursor; orders whose
    dimensions are missing wait in ``pending`` and events whose order or
    products are missing wait in ``pending_events`` (B15); an event whose
    order is known and whose products are all known is done, also one without
    a line.  The fact cursor is an *event* id (B14).

    The DDS tables are append-only folders: a run writes only its new rows.
    A replayed run is harmless: new dimension members are anti-joined against
    the stored ones, and fact rows of events already stored are skipped (only
    the fact's rows from the first event to do are looked at).  A run's
    cursors and pending rows are published together, after every table.

    New and waiting events, parsed ones and facts are dealt to files by the hash
    of the event id, so they stay where they are written: only keys and ids
    travel to the dimensions and back.  ``clustered`` says that the events come
    dealt by id already; else they are once.  The number of files belongs to
    the folder.  What a run writes for itself goes when it ends.
    """

    WF = {"users": "dds:users", "restaurants": "dds:restaurants", "products": "dds:products",
          "timestamps": "dds:timestamps", "orders": "dds:orders", "facts": "dds:facts"}

    def __init__(self, spark, staged: dict[str, DataFrame], base: str, clustered: bool = False):
        from martflow.session import scratch_run, short_shuffles
        self.spark, self.base = spark, base
        with scratch_run(spark), short_shuffles(spark):
            self._run(staged, clustered)

    def _run(self, staged: dict[str, DataFrame], clustered: bool) -> None:
        from martflow.operators.cursor import cursor_advance, cursor_get, empty_state
        from martflow.operators.tables import append_hashed, path_exists, publish, read_hashed
        spark, base = self.spark, self.base
        last = self._last_run()
        n = self.buckets = self._buckets()
        before = f"{base}/runs/{last:09d}" if last else None
        state = spark.read.parquet(f"{before}/state") if last else empty_state(spark)

        def since(name, df):
            return df.filter(F.col("id") > F.lit(cursor_get(state, self.WF[name])))

        def advance(st, name, batch):
            return cursor_advance(st, batch, "id", F.lit(self.WF[name]))

        def stored(name):
            return spark.read.parquet(f"{base}/{name}") if path_exists(spark, f"{base}/{name}") else None

        def append(name, rows):
            rows.write.mode("append").option("compression", "zstd").parquet(f"{base}/{name}")
            return stored(name)

        def hashed(path, like, key):
            return read_hashed(spark, path, like.schema, key, n) if n else spark.read.schema(like.schema).parquet(path)

        def either(per_part):  # new and waiting events lie in two folders
            return reduce(DataFrame.unionByName, map(per_part, ev_todo))

        def add_members(name, new, natural_key):
            return append(name, new_members(stored(name), new, natural_key, natural_key))

        t = {}
        users_b = since("users", staged["users"])
        u = _doc(users_b, USER_DOC).select(F.col("d._id").alias("user_id"), F.col("d.name").alias("user_name"),
                                            F.col("d.login").alias("user_login"))
        t["dm_users"] = add_members("dm_users", u, ["user_id"])

        rest_b = since("restaurants", staged["restaurants"])
        r = _doc(rest_b, RESTAURANT_DOC).select(
            F.col("d._id").alias("restaurant_id"), F.col("d.name").alias("restaurant_name"),
            parse_doc_ts("d.update_ts").alias("active_from"), sentinel().alias("active_to"))
        t["dm_restaurants"] = add_members("dm_restaurants", r, ["restaurant_id", "active_from"])

        prod_b = since("products", staged["restaurants"])
        t["dm_products"] = add_members("dm_products", menu_items(prod_b, t["dm_restaurants"]), ["product_id", "restaurant_id"])

        # new orders and events are written once: each has several readers
        ord_b = publish(since("orders", staged["orders"]), "orders_new", compression="zstd")
        t["dm_timestamps"] = add_members("dm_timestamps", order_times(ord_b), ["ts"])

        todo = parse_orders(ord_b)
        if last:
            todo = todo.unionByName(spark.read.parquet(f"{before}/pending"))
        looked_up = publish(look_up_orders(todo, t["dm_restaurants"], t["dm_timestamps"], t["dm_users"]), "orders_looked_up", compression="zstd")
        ok, waiting = split_resolved(looked_up, todo.columns)
        o = ok.select("order_key", "order_status", "restaurant_id", "timestamp_id", "user_id")
        t["dm_orders"] = add_members("dm_orders", o, ["order_key"])

        # facts: new events plus the ones still waiting from earlier runs
        new = with_order_key(since("facts", staged["events"].filter(F.col("event_type") == EVENT_BONUS_TRANSACTION)))
        ev_new = publish(new if clustered or not n else new.repartition(n, "id"), "events_new", buckets=("id", n), compression="zstd")
        ev_todo = [ev_new]
        if last:
            waited = hashed(f"{before}/pending_events", ev_new, "id")
            ev_todo.append(waited if n else with_order_key(waited))
        known = known_orders(either(lambda ev: ev.select(F.col("id").alias("event_id"), "order_key")), t["dm_orders"], n)
        known = publish(known, "events_known", buckets=("event_id", n), compression="zstd")
        # payments are parsed once for the facts and for their products; an event whose order is unknown has no fact
        docs = either(lambda ev: parsed_once(
            joined_by(ev, known.withColumnRenamed("event_id", "id"), "id").withColumn("order_sk", F.try_element_at("order_sks", "order_key")), "order_sk"))
        docs = publish(docs, "events_parsed", buckets=("event_id", n), compression="zstd")
        products_of = publish(known_products(docs, t["dm_products"], n), "events_products", buckets=("event_id", n), compression="zstd")
        facts = facts_by_event(docs, products_of)
        fact_path = f"{base}/fct_product_sales"
        first = either(lambda ev: ev.agg(F.min("id").alias("id"))).agg(F.min("id")).first()[0]
        if path_exists(spark, fact_path) and first is not None:  # a replayed run does not store an event twice
            old = hashed(fact_path, facts, "event_id").filter(F.col("event_id") >= first).select("event_id").distinct()
            facts = joined_by(facts, old, "event_id", "left_anti").select(*facts.columns)
        t["fct_product_sales"] = append_hashed(facts, fact_path, "event_id", n) if n else append("fct_product_sales", facts)
        bad = products_of.filter(~F.col("whole")).select("event_id")
        done = joined_by(known.select("event_id"), bad, "event_id", "left_anti").withColumnRenamed("event_id", "id")
        waiting_events = either(lambda ev: joined_by(ev, done, "id", "left_anti"))

        st = state
        for name, batch in (("users", users_b), ("restaurants", rest_b), ("products", prod_b), ("timestamps", ord_b),
                            # B14 fixed: the fact cursor is the largest *event* id read
                            ("orders", ord_b), ("facts", ev_new)):
            st = advance(st, name, batch)
        run = f"{base}/runs/{last + 1:09d}"
        if n:
            append_hashed(waiting_events, f"{run}/pending_events", "id", n, overwrite=True)
        else:
            waiting_events.write.mode("overwrite").option("compression", "zstd").parquet(f"{run}/pending_events")
        for name, df in (("pending", waiting), ("state", st)):  # the state last
            df.write.mode("overwrite").parquet(f"{run}/{name}")
        self.tables = t
        self.pending_events = hashed(f"{run}/pending_events", ev_new, "id")
        self.pending, self.state = (spark.read.parquet(f"{run}/{name}") for name in ("pending", "state"))

    def _buckets(self) -> int | None:
        """How many files events and facts are dealt to, noted before the first
        is written; None for a folder from before they were."""
        from martflow.operators.tables import path_exists
        noted = f"{self.base}/buckets"
        if not path_exists(self.spark, f"{noted}/_SUCCESS"):
            if path_exists(self.spark, f"{self.base}/fct_product_sales"):
                return None
            n = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
            self.spark.range(n, n + 1).write.mode("overwrite").parquet(noted)
        return self.spark.read.parquet(noted).first()[0]

    def _last_run(self) -> int:
        """The newest run whose state is complete; 0 before the first."""
        from martflow.operators.tables import path_exists
        n = 0
        while path_exists(self.spark, f"{self.base}/runs/{n + 1:09d}/state/_SUCCESS"):
            n += 1
        return n
