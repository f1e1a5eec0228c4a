"""DuckDB SQL oracles: for each query key, the same result written as plain
SQL over the base tables (views region, nation, customer, supplier, part,
orders, lineitem, events are pre-registered by the checker).

The adapters of SURVEY §7.4 are restated here as SQL, independently of the
DataFrame code in ``martflow.adapters``.
"""

from __future__ import annotations

# ------------------------------------------------------------------ adapters as SQL

V_ORDERS = """v_orders AS (
  SELECT o_orderkey AS order_id, o_orderdate AS order_ts, o_custkey AS user_id,
         CAST(o_totalprice AS DECIMAL(19,5)) AS payment,
         CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'P' THEN 5 WHEN 'O' THEN 3 END AS status
  FROM orders)"""

V_USERS = """v_users AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment || CAST(c_custkey AS VARCHAR) AS login
  FROM customer)"""

V_STATUS_LOG = """v_status_log AS (
  SELECT l_orderkey AS order_id, 1 + l_linenumber % 5 AS status_id, max(l_shipdate) AS dttm
  FROM lineitem GROUP BY 1, 2)"""

V_ORDER_ITEMS = """v_order_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_no, p_name AS name,
         CAST(p_retailprice AS DECIMAL(19,5)) AS price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount_rate,
         CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

V_SHIPPING = """v_shipping AS (
  SELECT l_orderkey AS shippingid,
         l_orderkey % 50 AS vendorid,
         CAST(o_totalprice AS DECIMAL(14,2)) AS payment_amount,
         l_shipdate AS state_datetime,
         CASE WHEN l_linestatus = 'F' THEN 'finished' ELSE 'in_progress' END AS status,
         CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'recieved' ELSE 'booked' END AS state,
         o_orderdate + INTERVAL 30 DAY AS shipping_plan_datetime,
         (CASE WHEN o_custkey % 2 = 0 THEN '1p' ELSE '3p' END) || ':' ||
         (CASE o_custkey % 3 WHEN 0 THEN 'car' WHEN 1 THEN 'train' ELSE 'ship' END)
           AS shipping_transfer_description,
         CAST((1 + (o_custkey % 2) * 3 + o_custkey % 3) * 0.001 AS DECIMAL(14,3)) AS shipping_transfer_rate,
         n_name AS shipping_country,
         CAST((1 + n_nationkey) * 0.01 AS DECIMAL(14,3)) AS shipping_country_base_rate,
         CAST(l_orderkey % 50 AS VARCHAR) || ':vsp-' || CAST(l_orderkey % 50 AS VARCHAR) || ':0.0'
           || CAST(l_orderkey % 10 AS VARCHAR) || ':0.023' AS vendor_agreement_description
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

V_FEED = """v_feed AS (
  SELECT o_orderdate AS date_time, CAST(l_suppkey AS INTEGER) AS city_id,
         'city-' || CAST(l_suppkey AS VARCHAR) AS city_name,
         o_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name,
         CAST(l_partkey AS INTEGER) AS item_id, p_name || ' ' || l_returnflag AS item_name,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS payment_amount,
         CASE WHEN l_returnflag = 'R' THEN 'refunded' ELSE 'shipped' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""

V_OUTBOX = """v_outbox AS (
  SELECT event_id AS id, ts AS event_ts, event_type, props AS event_value, user_id FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ------------------------------------------------------------------ P1: RFM and orders

_USER_STATS = """closed AS (FROM v_orders WHERE status = 4), user_stats AS (
  SELECT user_id, arg_max(order_ts, order_ts) AS most_recent_order, count(order_id) AS total_num_orders,
         CAST(sum(payment) AS DECIMAL(29,5)) AS total_revenue
  FROM closed GROUP BY ALL)"""

oracle("rfm_user_stats", with_(V_ORDERS, _USER_STATS) + "FROM user_stats")


def _fifths(place: str) -> str:
    """Which of five buckets a place among n users falls into: the first n % 5
    buckets have one user more than the others."""
    larger = "((n % 5) * (n // 5 + 1))"
    return (f"CAST(1 + CASE WHEN {place} <= {larger} THEN ({place} - 1) // (n // 5 + 1) "
            f"ELSE n % 5 + ({place} - 1 - {larger}) // greatest(n // 5, 1) END AS INTEGER)")


oracle("rfm_ntile_literal", with_(V_ORDERS, _USER_STATS, """placed AS (
  SELECT user_stats.*, count(*) OVER () AS n, row_number() OVER newest AS by_date, row_number() OVER most AS by_count, row_number() OVER richest AS by_sum
  FROM user_stats
  WINDOW newest AS (ORDER BY most_recent_order DESC NULLS LAST, user_id), most AS (ORDER BY total_num_orders DESC NULLS LAST, user_id),
         richest AS (ORDER BY total_revenue DESC NULLS LAST, user_id))""") + f"""
SELECT user_id, most_recent_order, total_num_orders, total_revenue, {_fifths('by_date')} AS recency, {_fifths('by_count')} AS frequency,
       {_fifths('by_sum')} AS monetary_value
FROM placed""")

_RFM_SEGMENTS = with_(V_ORDERS, V_USERS, _USER_STATS, """base AS (
  SELECT u.id AS user_id, s.most_recent_order AS mr, coalesce(s.total_num_orders, 0) AS n,
         coalesce(s.total_revenue, 0) AS m, s.total_num_orders IS NULL AS never
  FROM v_users u LEFT JOIN user_stats s ON s.user_id = u.id)""", """seg AS (
  SELECT user_id,
    CAST(CASE WHEN never THEN 1 ELSE NTILE(5) OVER (ORDER BY mr ASC NULLS FIRST, user_id) END AS SMALLINT) AS recency,
    CAST(CASE WHEN never THEN 1 ELSE NTILE(5) OVER (ORDER BY n, user_id) END AS SMALLINT) AS frequency,
    CAST(CASE WHEN never THEN 1 ELSE NTILE(5) OVER (ORDER BY m, user_id) END AS SMALLINT) AS monetary_value
  FROM base)""")

oracle("rfm_segments", _RFM_SEGMENTS + "SELECT * FROM seg")

oracle("rfm_bucket_balance", _RFM_SEGMENTS + """
SELECT metric, bucket, count(*) AS users FROM (
  SELECT 'recency' AS metric, recency AS bucket FROM seg
  UNION ALL SELECT 'frequency', frequency FROM seg
  UNION ALL SELECT 'monetary_value', monetary_value FROM seg) GROUP BY 1, 2""")

oracle("ntile_distributed", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       CAST(NTILE(10) OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                       l_shipdate, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS INTEGER) AS decile
FROM lineitem""")

oracle("orders_final_status", with_(V_ORDERS, V_STATUS_LOG) + """
SELECT o.order_id, o.order_ts, o.user_id, CAST(o.payment * 0.1 AS DECIMAL(19,5)) AS bonus_payment, o.payment,
       CAST(o.payment + o.payment * 0.1 AS DECIMAL(19,5)) AS cost, CAST(o.payment * 0.01 AS DECIMAL(19,5)) AS bonus_grant, f.final_status AS status
FROM v_orders o JOIN (SELECT order_id, max(status_id) AS final_status FROM v_status_log GROUP BY 1) f
  ON f.order_id = o.order_id""")

oracle("orders_latest_status", with_(V_ORDERS, V_STATUS_LOG) + """
SELECT o.order_id, o.order_ts, o.user_id, CAST(o.payment * 0.1 AS DECIMAL(19,5)) AS bonus_payment, o.payment,
       CAST(o.payment + o.payment * 0.1 AS DECIMAL(19,5)) AS cost, CAST(o.payment * 0.01 AS DECIMAL(19,5)) AS bonus_grant, coalesce(l.status_id, o.status) AS status
FROM v_orders o LEFT JOIN (
  SELECT order_id, status_id FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY dttm DESC NULLS LAST, status_id DESC) AS rn
    FROM v_status_log) WHERE rn = 1) l ON l.order_id = o.order_id""")

oracle("layer_views", with_(V_ORDERS, V_USERS, V_STATUS_LOG, V_ORDER_ITEMS) + """
SELECT 'orders' AS view, count(*) AS rows, CAST(sum(order_id) AS BIGINT) AS key_sum FROM v_orders
UNION ALL SELECT 'users', count(*), CAST(sum(id) AS BIGINT) FROM v_users
UNION ALL SELECT 'orderstatuslog', count(*), CAST(sum(order_id) AS BIGINT) FROM v_status_log
UNION ALL SELECT 'orderitems', count(*), CAST(sum(order_id) AS BIGINT) FROM v_order_items
UNION ALL SELECT 'products', count(*), CAST(sum(product_id) AS BIGINT) FROM (SELECT DISTINCT product_id, name, price FROM v_order_items)
UNION ALL SELECT 'orderstatuses', count(*), CAST(sum(status_id) AS BIGINT) FROM (SELECT DISTINCT status_id FROM v_status_log)""")

oracle("order_amounts", with_(V_ORDER_ITEMS) + """
SELECT order_id,
  CAST(sum(price * quantity) AS DECIMAL(19,5)) AS cost,
  CAST(sum(price * quantity * discount_rate) AS DECIMAL(19,5)) AS bonus_payment,
  CAST(sum(price * quantity) - sum(price * quantity * discount_rate) AS DECIMAL(19,5)) AS payment,
  CAST((sum(price * quantity) - sum(price * quantity * discount_rate)) * 0.01 AS DECIMAL(19,5)) AS bonus_grant
FROM v_order_items GROUP BY order_id""")

oracle("merge_lines", with_(V_ORDER_ITEMS) + """
SELECT order_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM v_order_items GROUP BY 1, 2""")


# ------------------------------------------------------------------ P2: shipping

oracle("split_descriptor", with_(V_SHIPPING) + """
SELECT shippingid, state_datetime,
  CAST(string_split_regex(vendor_agreement_description, ':+')[1] AS BIGINT) AS agreementid,
  string_split_regex(vendor_agreement_description, ':+')[2] AS agreement_number,
  CAST(string_split_regex(vendor_agreement_description, ':+')[3] AS DECIMAL(14,3)) AS agreement_rate,
  CAST(string_split_regex(vendor_agreement_description, ':+')[4] AS DECIMAL(14,3)) AS agreement_commission,
  string_split_regex(shipping_transfer_description, ':+')[1] AS transfer_type,
  string_split_regex(shipping_transfer_description, ':+')[2] AS transfer_model,
  string_split_regex(vendor_agreement_description, ':+')[5] AS agreement_extra
FROM v_shipping""")

oracle("age_day_part", """
WITH p AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_shipdate END AS a_ts,
         o_orderdate + to_hours(l_linenumber) + INTERVAL 30 MINUTE AS b_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, a_ts, b_ts,
  CAST(date_part('day', age(a_ts, b_ts)) AS INTEGER) AS day_ab,
  CAST(date_part('day', age(b_ts, a_ts)) AS INTEGER) AS day_ba
FROM p""")

oracle("distinct_dims", with_(V_SHIPPING) + """
SELECT DISTINCT shipping_country, shipping_country_base_rate, shipping_transfer_description, shipping_transfer_rate
FROM v_shipping""")

_SHIP_DIMS = with_(V_SHIPPING, """country AS (
  SELECT shipping_country, shipping_country_base_rate,
         row_number() OVER (ORDER BY shipping_country, shipping_country_base_rate) AS shipping_country_id
  FROM (SELECT DISTINCT shipping_country, shipping_country_base_rate FROM v_shipping))""", """agreement AS (
  SELECT DISTINCT
    CAST(split_part(vendor_agreement_description, ':', 1) AS BIGINT) AS agreementid,
    split_part(vendor_agreement_description, ':', 2) AS agreement_number,
    CAST(split_part(vendor_agreement_description, ':', 3) AS DECIMAL(14,3)) AS agreement_rate,
    CAST(split_part(vendor_agreement_description, ':', 4) AS DECIMAL(14,3)) AS agreement_commission
  FROM v_shipping)""", """transfer AS (
  SELECT transfer_type, transfer_model, shipping_transfer_rate,
         row_number() OVER (ORDER BY transfer_type, transfer_model, shipping_transfer_rate) AS transfer_type_id
  FROM (SELECT DISTINCT split_part(shipping_transfer_description, ':', 1) AS transfer_type,
                        split_part(shipping_transfer_description, ':', 2) AS transfer_model,
                        shipping_transfer_rate FROM v_shipping))""", """pieces AS (
  SELECT *, string_split(vendor_agreement_description, ':') AS agreed, string_split(shipping_transfer_description, ':') AS carried
  FROM v_shipping)""", """info AS (
  SELECT DISTINCT shippingid, vendorid, payment_amount, shipping_plan_datetime, transfer_type_id, shipping_country_id, agreementid
  FROM transfer JOIN pieces ON carried[1] = transfer_type AND carried[2] = transfer_model
  JOIN country USING (shipping_country) JOIN agreement ON CAST(agreed[1] AS BIGINT) = agreementid)""", """status AS (
  SELECT shippingid, newest['status'] AS status, newest['state'] AS state, earliest AS shipping_start_fact_datetime,
         newest['stamp'] AS shipping_end_fact_datetime
  FROM (SELECT shippingid, min(state_datetime) AS earliest,
               max({'unstamped': state_datetime IS NULL, 'stamp': state_datetime, 'status': status, 'state': state}) AS newest
        FROM v_shipping GROUP BY shippingid))""", """joined AS (
  SELECT *, shipping_end_fact_datetime > shipping_plan_datetime AS late
  FROM info JOIN status USING (shippingid) JOIN agreement USING (agreementid)
  JOIN country USING (shipping_country_id) JOIN transfer USING (transfer_type_id))""", """dm AS (
  SELECT shippingid, vendorid, transfer_type,
    CAST(date_part('day', age(shipping_end_fact_datetime, shipping_start_fact_datetime)) AS INTEGER) AS full_day_at_shipping,
    late AS is_delay, status = 'finished' AS is_shipping_finish,
    CAST(if(late, date_part('day', age(shipping_end_fact_datetime, shipping_plan_datetime)), 0) AS INTEGER) AS delay_day_at_shipping,
    payment_amount,
    CAST((agreement_rate + shipping_transfer_rate + shipping_country_base_rate) * payment_amount AS DECIMAL(31,5)) AS vat,
    CAST(agreement_commission * payment_amount AS DECIMAL(29,5)) AS profit
  FROM joined)""")

oracle("shipping_country_rates", _SHIP_DIMS + "SELECT * FROM country")
oracle("shipping_agreement", _SHIP_DIMS + "SELECT * FROM agreement")
oracle("shipping_transfer", _SHIP_DIMS + "SELECT * FROM transfer")
oracle("shipping_info", _SHIP_DIMS + "SELECT * FROM info")
oracle("shipping_info_latest_rate", with_(V_SHIPPING.replace("v_shipping AS (", "plain_shipping AS (", 1), """v_shipping AS (
  SELECT * REPLACE (CAST(shipping_country_base_rate + coalesce(year(state_datetime) - 1990, 0) / 1000.0 AS DECIMAL(14,3)) AS shipping_country_base_rate,
                    CAST(shipping_transfer_rate + coalesce(year(state_datetime) - 1990, 0) / 1000.0 AS DECIMAL(14,3)) AS shipping_transfer_rate)
  FROM plain_shipping)""") + _SHIP_DIMS[_SHIP_DIMS.index(",\ncountry AS ("):].rstrip() + """, newest_country AS (
  SELECT shipping_country, max({'dated': state_datetime IS NOT NULL, 'at': state_datetime, 'rate': shipping_country_base_rate})['rate'] AS rate
  FROM v_shipping GROUP BY ALL), newest_transfer AS (
  SELECT carried[1] AS transfer_type, carried[2] AS transfer_model,
         max({'dated': state_datetime IS NOT NULL, 'at': state_datetime, 'rate': shipping_transfer_rate})['rate'] AS rate
  FROM pieces GROUP BY ALL)
SELECT DISTINCT shippingid, vendorid, payment_amount, shipping_plan_datetime, transfer_type_id, shipping_country_id, agreementid
FROM pieces p JOIN newest_country nc USING (shipping_country)
JOIN country c ON c.shipping_country = p.shipping_country AND c.shipping_country_base_rate = nc.rate
JOIN newest_transfer nt ON nt.transfer_type = carried[1] AND nt.transfer_model = carried[2]
JOIN transfer t ON t.transfer_type = nt.transfer_type AND t.transfer_model = nt.transfer_model AND t.shipping_transfer_rate = nt.rate
JOIN agreement ON CAST(agreed[1] AS BIGINT) = agreementid""")
oracle("shipping_status", _SHIP_DIMS + "SELECT * FROM status")
oracle("shipping_datamart", _SHIP_DIMS + "SELECT * FROM dm")
oracle("shipping_cost_by_country", _SHIP_DIMS + """
SELECT c.shipping_country, count(*) AS shipments,
  CAST(sum(dm.payment_amount) AS DECIMAL(24,2)) AS total_payment,
  CAST(sum(vat) AS DECIMAL(38,5)) AS total_vat,
  CAST(sum(CAST(is_delay AS INTEGER)) AS BIGINT) AS delayed
FROM dm JOIN info i ON i.shippingid = dm.shippingid
JOIN country c ON c.shipping_country_id = i.shipping_country_id
GROUP BY c.shipping_country""")
oracle("shipping_finished_last_week", _SHIP_DIMS + """
SELECT s.shippingid, i.vendorid, s.shipping_end_fact_datetime, i.payment_amount
FROM status s JOIN info i ON i.shippingid = s.shippingid
WHERE s.status = 'finished'
  AND s.shipping_end_fact_datetime > (SELECT max(shipping_end_fact_datetime) FROM status WHERE status = 'finished')
      - INTERVAL 7 DAY
  AND s.shipping_end_fact_datetime <= (SELECT max(shipping_end_fact_datetime) FROM status WHERE status = 'finished')""")
oracle("vendor_tariffs", _SHIP_DIMS + """
SELECT dm.vendorid, a.agreementid, a.agreement_number, a.agreement_rate, a.agreement_commission,
  count(*) AS shipments, CAST(sum(dm.payment_amount) AS DECIMAL(24,2)) AS total_payment,
  CAST(sum(dm.profit) AS DECIMAL(38,5)) AS total_profit
FROM dm JOIN info i ON i.shippingid = dm.shippingid JOIN agreement a ON a.agreementid = i.agreementid
GROUP BY ALL""")


# ------------------------------------------------------------------ P3: sales and retention

_CAL = """bounds AS (
  SELECT make_date(year(min(date_time)), 1, 1) AS d0, make_date(year(max(date_time)), 12, 31) AS d1 FROM v_feed)""", \
    """cal AS (
  SELECT CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
         CAST(day(d) AS SMALLINT) AS day_num, CAST(month(d) AS SMALLINT) AS month_num,
         rpad(lower(strftime(d, '%B')), 9, ' ') AS month_name, CAST(year(d) AS SMALLINT) AS year_num,
         CAST(week(d) AS SMALLINT) AS week_num, CAST(isoyear(d) AS SMALLINT) AS iso_year
  FROM (SELECT unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS d FROM bounds))"""

_FACT = with_(V_FEED, *_CAL, """fact AS (
  SELECT DISTINCT dc.date_id, s.item_id, s.customer_id, s.quantity,
         CAST(s.payment_amount AS DECIMAL(10,2)) AS payment_amount, s.status
  FROM v_feed s JOIN cal dc ON dc.day_num = day(s.date_time) AND dc.month_num = month(s.date_time)
                           AND dc.year_num = year(s.date_time))""")

oracle("calendar_dim", with_(V_FEED, *_CAL) + "SELECT * FROM cal")
oracle("f_daily_sales", _FACT + "SELECT * FROM fact")

oracle("f_daily_sales_slice", _FACT.replace("year(s.date_time))", "year(s.date_time)\n  WHERE s.date_time >= TIMESTAMP '1994-03-01 00:00:00' AND s.date_time < TIMESTAMP '1995-06-15 00:00:00')", 1) + "SELECT * FROM fact")

_RET_BASE = """SELECT {keys}, customer_id, count(*) AS num_transactions,
    count(*) FILTER (status = 'refunded') AS num_returns,
    CAST(coalesce(sum(payment_amount) FILTER (status <> 'refunded'), 0)
         - coalesce(sum(payment_amount) FILTER (status = 'refunded'), 0) AS DECIMAL(20,2)) AS total_revenue
  FROM cal JOIN fact USING (date_id) GROUP BY {keys}, customer_id"""

oracle("retention_base", _FACT + _RET_BASE.format(keys="week_num"))

_RET = """
SELECT 'weekly' AS period_name, CAST({period} AS INTEGER) AS period_id,
  CAST(count(*) FILTER (num_transactions = 1) AS INTEGER) AS new_customers_count,
  CAST(count(*) FILTER (num_transactions > 1) AS INTEGER) AS returning_customers_count,
  CAST(count(*) FILTER (num_returns > 0) AS INTEGER) AS refunded_customer_count,
  CAST(sum(num_returns) AS INTEGER) AS customers_refunded,
  CAST(coalesce(sum(total_revenue) FILTER (num_transactions = 1), 0) AS DECIMAL(14,2)) AS new_customers_revenue,
  CAST(coalesce(sum(total_revenue) FILTER (num_transactions > 1), 0) AS DECIMAL(14,2)) AS returning_customers_revenue
FROM ({base}) GROUP BY {keys}"""

oracle("customer_retention", _FACT + _RET.format(
    period="week_num", keys="week_num", base=_RET_BASE.format(keys="week_num")))
ORACLE["retention_increments"] = ORACLE["customer_retention"]

oracle("customer_retention_by_year", _FACT + _RET.format(
    period="CAST(iso_year AS INTEGER) * 100 + week_num", keys="iso_year, week_num",
    base=_RET_BASE.format(keys="iso_year, week_num")))

oracle("d_customer", with_(V_FEED) + """
SELECT row_number() OVER (ORDER BY later, customer_id, first_name, last_name) AS id, * EXCLUDE (later) FROM (
  SELECT false AS later, customer_id, first_name, last_name, min(city_id) AS city_id
  FROM v_feed WHERE date_time < TIMESTAMP '1995-06-01 00:00:00' GROUP BY ALL
  UNION ALL SELECT true, customer_id, first_name, last_name, min(city_id) FROM v_feed
  WHERE customer_id NOT IN (SELECT customer_id FROM v_feed WHERE date_time < TIMESTAMP '1995-06-01 00:00:00') GROUP BY ALL)""")

oracle("d_customer_one_per_id", with_(V_FEED) + """
SELECT row_number() OVER (ORDER BY customer_id) AS id, customer_id, s['a'] AS first_name, s['b'] AS last_name, city_id FROM (
  SELECT customer_id, max({'t': date_time, 'a': first_name || '-' || CAST(item_id % 3 AS VARCHAR), 'b': last_name}) AS s,
         min(city_id) AS city_id FROM v_feed GROUP BY customer_id)""")

oracle("f_daily_sales_midnight", _FACT.replace("FROM v_feed s JOIN cal dc", "FROM (SELECT * FROM v_feed WHERE item_id % 3 <> 0 AND date_time = CAST(date_time AS DATE)) s JOIN cal dc") + """
SELECT * FROM fact""")

_LATEST_NAME = """latest AS (
  SELECT item_id, item_name FROM (
    SELECT item_id, item_name,
           row_number() OVER (PARTITION BY item_id ORDER BY date_time DESC, item_name DESC) AS rn
    FROM {src}) WHERE rn = 1)"""

oracle("d_item", with_(V_FEED, _LATEST_NAME.format(src="v_feed")) + """
SELECT row_number() OVER (ORDER BY item_id) AS id, item_id, item_name FROM latest""")

oracle("d_item_increment", with_(
    V_FEED,
    "early AS (SELECT * FROM v_feed WHERE date_time < TIMESTAMP '1995-06-01 00:00:00')",
    _LATEST_NAME.format(src="v_feed")) + """
SELECT row_number() OVER (ORDER BY item_id NOT IN (SELECT item_id FROM early), item_id) AS id, item_id, item_name
FROM latest""")

oracle("last_value_default_frame", with_(V_FEED) + """
SELECT DISTINCT item_id,
  -- the last peer of the stamp; of several names the greatest, as any could be the last
  max(item_name) OVER (PARTITION BY item_id, date_time) AS name
FROM v_feed""")

oracle("d_item_update", with_(
    V_FEED,
    "early AS (SELECT * FROM v_feed WHERE date_time < TIMESTAMP '1998-01-01 00:00:00')",
    _LATEST_NAME.format(src="early").replace("latest AS", "old_latest AS"),
    _LATEST_NAME.format(src="v_feed")) + """
SELECT row_number() OVER (ORDER BY o.item_id) AS id, o.item_id, coalesce(n.item_name, o.item_name) AS item_name
FROM old_latest o LEFT JOIN latest n ON n.item_id = o.item_id""")

oracle("not_in_null_aware", with_(V_FEED) + """
SELECT DISTINCT 'plain' AS list, customer_id, first_name, last_name
FROM (SELECT * REPLACE (CASE WHEN customer_id % 7 <> 0 THEN customer_id END AS customer_id) FROM v_feed)
WHERE customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT DISTINCT 'with_null', customer_id, first_name, last_name
FROM (SELECT * REPLACE (CASE WHEN customer_id % 7 <> 0 THEN customer_id END AS customer_id) FROM v_feed)
WHERE customer_id NOT IN (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END FROM customer)
UNION ALL SELECT DISTINCT 'empty', customer_id, first_name, last_name
FROM (SELECT * REPLACE (CASE WHEN customer_id % 7 <> 0 THEN customer_id END AS customer_id) FROM v_feed)""")

oracle("append_with_defaults", with_(V_FEED) + """
SELECT * REPLACE (CASE WHEN date_time < TIMESTAMP '1998-01-01 00:00:00' THEN status ELSE 'shipped' END AS status)
FROM v_feed""")

oracle("replace_slice", with_(V_FEED) + "SELECT * FROM v_feed")
oracle("backfill_equals_daily", with_(V_FEED) + """
SELECT *, CAST(0 AS BIGINT) AS differing FROM v_feed""")

oracle("delete_where_in", _FACT + """
SELECT * FROM fact WHERE date_id NOT IN (
  SELECT DISTINCT c.date_id FROM v_feed s JOIN cal c ON c.full_date = CAST(s.date_time AS DATE)
  WHERE year(s.date_time) = (SELECT max(year(date_time)) FROM v_feed))""")


# ------------------------------------------------------------------ P4a: staging, cursors, outbox

_PREV_CURSOR = "(SELECT coalesce(max(event_id), -1) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')"

oracle("upsert_all", """
WITH t AS (SELECT c_custkey AS id, c_name AS name, CAST(c_acctbal AS DECIMAL(19,5)) AS balance
           FROM customer WHERE c_acctbal >= 0),
s AS (SELECT id, name, balance FROM (
        SELECT o_custkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS name,
               CAST(o_totalprice AS DECIMAL(19,5)) AS balance,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1)
SELECT coalesce(s.id, t.id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN s.id IS NOT NULL THEN s.balance ELSE t.balance END AS balance
FROM t FULL OUTER JOIN s ON s.id = t.id""")

oracle("insert_if_absent", """
SELECT c_custkey AS id, c_name AS order_user_id FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT o_custkey, 'order-' || CAST(min(o_orderkey) AS VARCHAR) FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
GROUP BY o_custkey""")

oracle("upsert_partial", """
SELECT CAST(o_orderkey AS VARCHAR) AS object_id,
       json_object('_id', CAST(o_orderkey AS VARCHAR), 'v', CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END)::VARCHAR
         AS object_value,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS update_ts
FROM orders""")

oracle("cursor_advance", """
SELECT 'outbox_' || event_type AS workflow_key,
       '{"last_loaded_id":' || CAST(max(event_id) AS VARCHAR) || '}' AS workflow_settings
FROM events WHERE event_type = 'click' OR ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY event_type""")

oracle("run_log", """
SELECT workflow_key, CASE WHEN row_count > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status, row_count,
       TIMESTAMP '2024-02-01 00:00:00' AS run_ts
FROM (SELECT 'stg.couriers' AS workflow_key, count(*) AS row_count FROM supplier
      UNION ALL SELECT 'stg.restaurants', count(*) FROM supplier
      UNION ALL SELECT 'stg.deliveries', count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))""")

oracle("assign_keys", """
SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS id FROM customer""")

oracle("docs_oldest_k", with_(V_OUTBOX) + """
SELECT id, event_ts, event_type, event_value FROM v_outbox ORDER BY event_ts, id LIMIT 500""")

oracle("copy_collection_sessions", """
WITH d AS (SELECT CASE WHEN event_id % 13 <> 0 THEN event_id END AS id, event_type,
                  CASE WHEN event_id % 11 <> 0 THEN date_trunc('day', ts) END AS stamp FROM events)
SELECT CAST(id AS VARCHAR) AS object_id,
       json_object('_id', id, 'event_type', event_type, 'update_ts', strftime(stamp, '%Y-%m-%d %H:%M:%S'))::VARCHAR AS object_value,
       CAST(stamp AS TIMESTAMP) AS update_ts FROM d""")

oracle("keys_at_ranks", """
WITH li AS (
  SELECT CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_extendedprice AS DECIMAL(14,2)) END AS price, l_orderkey,
         CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_shipdate AS TIMESTAMP) AS shipped FROM lineitem
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY price DESC NULLS LAST, l_orderkey, l_linenumber, shipped) AS rank, count(*) OVER () AS n FROM li
)
SELECT rank, price, l_orderkey, l_linenumber, shipped FROM numbered
WHERE rank IN (SELECT (SELECT count(*) FROM li) * i // 10 FROM range(1, 11) r(i))""")

oracle("staged_since", with_(V_OUTBOX) + f"""
SELECT id, event_ts, event_type, event_value FROM v_outbox WHERE id > {_PREV_CURSOR}""")

oracle("events_typed_since", with_(V_OUTBOX) + f"""
SELECT id, event_ts, event_type, event_value FROM v_outbox
WHERE event_type = 'purchase' AND id > {_PREV_CURSOR}""")

oracle("events_by_type", """
SELECT event_id AS id, event_type, CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
FROM events""")


# ------------------------------------------------------------------ P4b: snowflake DDS

_STATUS_TEXT = "CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'P' THEN 'CANCELLED' WHEN 'O' THEN 'OPEN' END"

_DDS = with_("""rest_dim AS (
  SELECT row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR),
           TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(s_suppkey % 24 AS INTEGER))) AS id,
         CAST(s_suppkey AS VARCHAR) AS restaurant_id, s_name AS restaurant_name,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(s_suppkey % 24 AS INTEGER)) AS active_from,
         TIMESTAMP '2099-12-31 00:00:00' AS active_to, s_suppkey
  FROM supplier WHERE s_acctbal >= 0)""", """prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CAST(p_retailprice AS DECIMAL(19,5)) AS product_price, r.active_from,
         TIMESTAMP '2099-12-31 00:00:00' AS active_to, r.id AS restaurant_id
  FROM part JOIN rest_dim r ON r.s_suppkey = p_partkey % (SELECT count(*) FROM supplier))""", """prod_dim AS (
  SELECT row_number() OVER (ORDER BY product_id, restaurant_id) AS id, * FROM prod)""", """ts_dim AS (
  SELECT row_number() OVER (ORDER BY ts) AS id, ts, CAST(year(ts) AS INTEGER) AS year,
         CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
         strftime(ts, '%H:%M:%S') AS time, CAST(ts AS DATE) AS date
  FROM (SELECT DISTINCT o_orderdate AS ts FROM orders))""", """user_dim AS (
  SELECT row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS id, CAST(c_custkey AS VARCHAR) AS user_id,
         c_name AS user_name, c_mktsegment || CAST(c_custkey AS VARCHAR) AS user_login
  FROM customer)""", """ord_rest AS (SELECT l_orderkey, min(l_suppkey) AS rest_key FROM lineitem GROUP BY 1)""",
  f"""ord_dim AS (
  SELECT row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS id, CAST(o_orderkey AS VARCHAR) AS order_key,
         {_STATUS_TEXT} AS order_status, r.id AS restaurant_id, t.id AS timestamp_id, u.id AS user_id
  FROM orders o JOIN ord_rest orr ON orr.l_orderkey = o.o_orderkey
  JOIN rest_dim r ON r.restaurant_id = CAST(orr.rest_key AS VARCHAR)
  JOIN ts_dim t ON t.ts = o.o_orderdate
  JOIN user_dim u ON u.user_id = CAST(o.o_custkey AS VARCHAR))""")

oracle("dm_users", _DDS + "SELECT * FROM user_dim")
_DDS_ALL = _DDS.replace("FROM supplier WHERE s_acctbal >= 0)", "FROM supplier)")  # every restaurant
oracle("dm_restaurants", _DDS_ALL + "SELECT id, restaurant_id, restaurant_name, active_from, active_to FROM rest_dim")
oracle("dm_products", _DDS_ALL + "SELECT * FROM prod_dim")
oracle("dm_timestamps", _DDS + "SELECT * FROM ts_dim")
oracle("dm_orders", _DDS + "SELECT * FROM ord_dim")
oracle("dm_orders_versions", _DDS + "SELECT * FROM ord_dim")
oracle("dds_two_runs", """
SELECT l_orderkey AS event_id, CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_partkey AS VARCHAR) AS product_key,
       CAST(l_quantity AS INTEGER) AS count, CAST(p_retailprice AS DECIMAL(19,5)) AS price,
       CAST(CAST(p_retailprice AS DECIMAL(19,5)) * CAST(l_quantity AS INTEGER) AS DECIMAL(19,5)) AS total_sum,
       CAST(CAST(p_retailprice AS DECIMAL(19,5)) * CAST(l_quantity AS INTEGER) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(19,5)) AS bonus_payment,
       CAST((CAST(p_retailprice AS DECIMAL(19,5)) * CAST(l_quantity AS INTEGER)
             - CAST(p_retailprice AS DECIMAL(19,5)) * CAST(l_quantity AS INTEGER) * CAST(l_discount AS DECIMAL(4,2))) * 0.01 AS DECIMAL(19,5)) AS bonus_grant
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
WHERE p_partkey % (SELECT count(*) FROM supplier) IN (SELECT s_suppkey FROM supplier) AND l_orderkey NOT IN (
  SELECT l_orderkey FROM lineitem WHERE l_partkey % (SELECT count(*) FROM supplier) NOT IN (SELECT s_suppkey FROM supplier))""")
oracle("fct_product_sales", _DDS + """, lines AS (
  SELECT l_orderkey AS event_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(p_retailprice AS DECIMAL(19,5)) AS price, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_discount AS DECIMAL(4,2)) AS disc
  FROM lineitem JOIN part ON p_partkey = l_partkey),
pd AS (SELECT product_id, max(id) AS product_sk FROM prod_dim GROUP BY 1),
good AS (SELECT event_id FROM lines LEFT JOIN pd USING (product_id) GROUP BY event_id
         HAVING bool_and(pd.product_sk IS NOT NULL))
SELECT pd.product_sk AS product_id, od.id AS order_id, quantity AS count, price,
       CAST(price * quantity AS DECIMAL(19,5)) AS total_sum,
       CAST(price * quantity * disc AS DECIMAL(19,5)) AS bonus_payment,
       CAST((price * quantity - price * quantity * disc) * 0.01 AS DECIMAL(19,5)) AS bonus_grant,
       event_id
FROM lines JOIN pd USING (product_id) JOIN good USING (event_id)
JOIN ord_dim od ON od.order_key = CAST(event_id AS VARCHAR)""")

oracle("retry_unresolved", f"""
WITH ord_rest AS (SELECT l_orderkey, min(l_suppkey) AS rest_key FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, {_STATUS_TEXT} AS order_status,
       CAST(orr.rest_key AS VARCHAR) AS restaurant_key, CAST(o_custkey AS VARCHAR) AS user_key, o_orderdate AS ts,
       CASE WHEN s.s_acctbal >= 0 THEN 1 ELSE 2 END AS batch
FROM orders o JOIN ord_rest orr ON orr.l_orderkey = o.o_orderkey JOIN supplier s ON s.s_suppkey = orr.rest_key""")

oracle("versioned_dim", """
SELECT CAST(s_suppkey AS VARCHAR) AS restaurant_id, s_name AS restaurant_name,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(s_suppkey % 24 AS INTEGER)) AS active_from,
       CASE WHEN s_acctbal < 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2099-12-31 00:00:00' END
         AS active_to
FROM supplier
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name || ' (renamed)', TIMESTAMP '2024-02-01 00:00:00',
       TIMESTAMP '2099-12-31 00:00:00'
FROM supplier WHERE s_acctbal < 0""")


# ------------------------------------------------------------------ P4c: couriers and deliveries

_DELIV = """deliv AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_ts,
         'd' || CAST(o_orderkey AS VARCHAR) AS delivery_id, CAST(max(l_suppkey) AS VARCHAR) AS courier_id,
         'street ' || CAST(o_custkey AS VARCHAR) AS address, max(l_shipdate) AS delivery_ts,
         CAST(o_totalprice AS DECIMAL(14,2)) AS sum, CAST(least(count(*), 5) AS INTEGER) AS rate,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.05 AS DECIMAL(14,2)) AS tip_sum
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_orderdate, o_custkey, o_totalprice)"""

oracle("json_fields", with_(_DELIV) + """
SELECT order_id AS object_id, order_id, strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts, delivery_id,
       courier_id, address, strftime(delivery_ts, '%Y-%m-%d %H:%M:%S') AS delivery_ts,
       CAST(sum AS VARCHAR) AS sum, CAST(rate AS VARCHAR) AS rate, CAST(tip_sum AS VARCHAR) AS tip_sum
FROM deliv""")

_PRIORITIES = """changes AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS changed,
         coalesce(max_by(o_orderpriority, o_orderkey) FILTER (o_orderkey % 2 = 0), max_by(o_orderpriority, o_orderkey)) AS priority
  FROM orders GROUP BY ALL
)"""

oracle("versions_merged", with_(_PRIORITIES) + """
SELECT customer_id, priority, changed AS active_from, coalesce(lead(changed) OVER (PARTITION BY customer_id ORDER BY changed), TIMESTAMP '2099-12-31 00:00:00') AS active_to
FROM (SELECT *, lag(priority) OVER (PARTITION BY customer_id ORDER BY changed) AS before FROM changes) WHERE priority IS DISTINCT FROM before""")

oracle("lines_as_of", with_(_PRIORITIES, """lines AS (
  SELECT l_orderkey, l_linenumber, o_custkey AS customer_id, CAST(l_shipdate AS DATE) - INTERVAL 60 DAY AS seen
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
)""") + """
SELECT lines.*, priority FROM lines ASOF LEFT JOIN changes ON lines.customer_id = changes.customer_id AND lines.seen >= changes.changed""")

oracle("json_nested_fields", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) || '0' AS v_sum,
       '{"sum": 1.50, "list": [{"sum": ' || o_orderkey || '}, 2]}' AS v_inner, 'say "sum": ' || o_orderkey || ', {ok}' AS v_note,
       '1234567890' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.10' AS v_long, CAST(NULL AS VARCHAR) AS v_none,
       '[ ' || o_orderkey || ', "]" ]' AS v_list, CAST(NULL AS VARCHAR) AS v_absent
FROM orders""")

oracle("deliveries_set_aside", with_(_DELIV) + """
SELECT delivery_id, if(aside, NULL, tip_sum) AS tip_sum, aside AS set_aside
FROM (SELECT *, CAST(order_id AS BIGINT) % 7 = 0 OR CAST(order_id AS BIGINT) % 11 = 0 AS aside FROM deliv)""")

oracle("dm_couriers", """
SELECT CAST(s_suppkey AS VARCHAR) AS courier_id, s_name AS courier_name,
       CASE WHEN s_acctbal >= 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END
         AS active_from,
       TIMESTAMP '2099-12-31 00:00:00' AS active_to
FROM supplier""")

oracle("close_missing", """
SELECT CAST(s_suppkey AS VARCHAR) AS courier_id, s_name AS courier_name,
       TIMESTAMP '2024-01-01 00:00:00' AS active_from,
       CASE WHEN s_acctbal >= 0 THEN TIMESTAMP '2099-12-31 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END
         AS active_to
FROM supplier""")

oracle("api_restaurants", """
SELECT CAST(s_suppkey AS VARCHAR) AS restaurant_id, s_name AS restaurant_name,
       CASE WHEN s_acctbal >= 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS active_from,
       CASE WHEN s_suppkey % 5 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2099-12-31 00:00:00' END AS active_to
FROM supplier WHERE s_acctbal >= 0 OR s_suppkey % 5 <> 0""")

# even orders are stored already and stay as they are
oracle("dm_deliveries", with_(_DELIV) + """
SELECT order_id, order_ts, delivery_id, courier_id, if(CAST(order_id AS BIGINT) % 2 = 0, 'as stored', address) AS address,
       delivery_ts, sum FROM deliv""")
oracle("dm_rate", with_(_DELIV) + """
SELECT delivery_id, CAST(if(CAST(order_id AS BIGINT) % 2 = 0, 0, rate) AS SMALLINT) AS rate FROM deliv""")
oracle("dm_tips", with_(_DELIV) + """
SELECT delivery_id, CAST(if(CAST(order_id AS BIGINT) % 2 = 0, 0, tip_sum) AS DECIMAL(14,2)) AS tip_sum FROM deliv""")


# ------------------------------------------------------------------ file sources and documents

oracle("scan_csv_plain", """
SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, CAST(p_retailprice AS DECIMAL(19,5)) AS price FROM part""")

oracle("scan_csv_header", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, o_orderdate,
       o_orderpriority FROM orders""")

oracle("scan_csv_inferred", """
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer""")

oracle("land_json", """
SELECT CAST(s_suppkey AS VARCHAR) AS object_id,
       json_object('_id', CAST(s_suppkey AS VARCHAR), 'name', s_name)::VARCHAR AS object_value,
       TIMESTAMP '2024-02-01 00:00:00' AS update_ts
FROM supplier""")

oracle("normalise_docs", """
SELECT CAST(o_orderkey AS VARCHAR) AS object_id,
       json_object('_id', CAST(o_orderkey AS VARCHAR), 'user_id', o_custkey,
                   'update_ts', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
                   'priority', CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END)::VARCHAR
         AS object_value,
       o_orderdate AS update_ts
FROM orders""")


oracle("normalise_nested_docs", """
WITH d AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, l_linenumber AS number, l_orderkey, l_partkey, CAST(l_shipdate AS TIMESTAMP) AS ts,
         json_object('at', strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), 'supplier',
                     json_object('id', CAST(l_suppkey AS VARCHAR), 'oid', lpad(lower(to_hex(l_partkey)), 24, '0'))) AS seen
  FROM lineitem)
SELECT id AS object_id,
       json_object('_id', id, 'number', CAST(number AS INTEGER),
                   'parts', json_array(json_object('id', CAST(l_partkey AS VARCHAR), 'seen', json_array(seen, CASE WHEN number > 1 THEN seen END))),
                   'of', json_object('order', json_object('_id', CAST(l_orderkey AS VARCHAR), 'note', NULL)),
                   'update_ts', strftime(ts, '%Y-%m-%d %H:%M:%S'))::VARCHAR AS object_value,
       ts AS update_ts
FROM d""")


# ------------------------------------------------------------------ data quality

def _nn(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, 'not_null:{c}' AS rule, count(*) - count({c}) AS violations FROM {table}"
        for c in cols)


oracle("dq_not_null", " UNION ALL ".join([
    _nn("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]),
    _nn("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]),
    _nn("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
]))

oracle("dq_unique", """
SELECT 'orders' AS table_name, 'unique:o_orderkey' AS rule, count(o_orderkey) - count(DISTINCT o_orderkey) AS violations
FROM orders
UNION ALL SELECT 'lineitem', 'unique:l_orderkey,l_linenumber', count(*) - count(DISTINCT (l_orderkey, l_linenumber))
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
UNION ALL SELECT 'customer', 'unique:c_custkey', count(c_custkey) - count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'part', 'unique:p_partkey', count(p_partkey) - count(DISTINCT p_partkey) FROM part""")

oracle("dq_orphans", """
SELECT 'orders' AS table_name, 'fk:o_custkey' AS rule, count(*) AS violations FROM orders
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'lineitem', 'fk:l_orderkey', count(*) FROM lineitem
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL SELECT 'lineitem', 'fk:l_partkey', count(*) FROM lineitem
WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
UNION ALL SELECT 'lineitem', 'fk:l_suppkey', count(*) FROM lineitem
WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)
UNION ALL SELECT 'customer', 'fk:c_nationkey', count(*) FROM customer
WHERE c_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey)""")

oracle("dq_row_predicates", with_(V_ORDER_ITEMS) + """
SELECT 'part' AS table_name, 'check:price_non_negative' AS rule,
       count(*) FILTER (WHERE NOT (p_retailprice >= 0)) AS violations FROM part
UNION ALL SELECT 'lineitem', 'check:quantity_positive', count(*) FILTER (WHERE NOT (l_quantity > 0)) FROM lineitem
UNION ALL SELECT 'lineitem', 'check:discount_rate_0_1', count(*) FILTER (WHERE NOT (l_discount BETWEEN 0 AND 1))
FROM lineitem
UNION ALL SELECT 'order_items', 'check:discount_0_to_price',
       count(*) FILTER (WHERE NOT (price * discount_rate >= 0 AND price * discount_rate <= price)) FROM v_order_items
UNION ALL SELECT 'customer', 'check:name_varchar_25', count(*) FILTER (WHERE NOT (length(c_name) <= 25)) FROM customer
UNION ALL SELECT 'orders', 'check:ts_year_2020_2499',
       count(*) FILTER (WHERE NOT (year(o_orderdate) >= 2020 AND year(o_orderdate) < 2500)) FROM orders
UNION ALL SELECT 'orders', 'check:ts_month_le_12', count(*) FILTER (WHERE NOT (month(o_orderdate) <= 12)) FROM orders""")

oracle("dq_one_scan", """
WITH li AS (SELECT * REPLACE (CASE WHEN l_orderkey % 5 <> 0 THEN l_shipdate END AS l_shipdate) FROM lineitem)
SELECT 'lineitem' AS table_name, 'not_null:l_orderkey' AS rule, count(*) - count(l_orderkey) AS violations FROM li
UNION ALL SELECT 'lineitem', 'not_null:l_shipdate', count(*) - count(l_shipdate) FROM li
UNION ALL SELECT 'lineitem', 'check:quantity_below_40', count(*) FILTER (l_quantity >= 40) FROM li
UNION ALL SELECT 'lineitem', 'check:discount_rate_0_1', count(*) FILTER (l_discount NOT BETWEEN 0 AND 1) FROM li
UNION ALL SELECT 'lineitem', 'unique:l_orderkey,l_linenumber', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM li
UNION ALL SELECT 'lineitem', 'unique:l_orderkey,l_partkey', count(*) - count(DISTINCT (l_orderkey, l_partkey)) FROM li
UNION ALL SELECT 'lineitem', 'unique:l_shipdate', count(l_shipdate) - count(DISTINCT l_shipdate) FROM li
UNION ALL SELECT 'orders', 'not_null:o_custkey', count(*) - count(o_custkey) FROM orders
UNION ALL SELECT 'orders', 'check:status_varchar_1', count(*) FILTER (length(o_orderstatus) > 1) FROM orders
UNION ALL SELECT 'orders', 'unique:o_orderkey', count(o_orderkey) - count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'orders', 'unique:o_custkey', count(o_custkey) - count(DISTINCT o_custkey) FROM orders""")

oracle("dq_accepted", with_(V_ORDERS) + """
SELECT status, count(*) AS rows, status IN (4, 5) AS accepted FROM v_orders GROUP BY status""")

oracle("dq_rank_thresholds", """
SELECT 'ranks' AS table_name, 'check:bonus_percent' AS rule, count(*) FILTER (c_nationkey - 2 < 0) AS violations FROM customer
UNION ALL SELECT 'ranks', 'check:min_payment_threshold', count(*) FILTER (c_acctbal < 0) FROM customer""")

oracle("dq_reconcile", with_(V_ORDERS, V_ORDER_ITEMS) + """
SELECT o.order_id, o.payment AS header_total, s.lines_total FROM v_orders o
LEFT JOIN (SELECT order_id, sum(price * quantity) AS lines_total FROM v_order_items GROUP BY 1) s
  ON s.order_id = o.order_id
WHERE s.lines_total IS NULL OR s.lines_total <> o.payment""")


# ------------------------------------------------------------------ streaming

oracle("stream_outbox_tail", with_(V_OUTBOX) + """
SELECT id, event_ts, event_type, event_value FROM v_outbox WHERE event_ts >= TIMESTAMP '2024-01-15 00:00:00'""")

oracle("stream_dedupe", with_(V_OUTBOX) + "SELECT id, event_ts, event_type, event_value FROM v_outbox")
oracle("stream_dedupe_late", with_(V_OUTBOX) + "SELECT id, event_ts, event_type, event_value FROM v_outbox")

oracle("stream_dedupe_state", with_(V_OUTBOX) + "SELECT id, event_ts, event_type, event_value FROM v_outbox")

oracle("stream_release", f"""
WITH ord_rest AS (SELECT l_orderkey, min(l_suppkey) AS rest_key FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, {_STATUS_TEXT} AS order_status, CAST(s_suppkey AS VARCHAR) AS rest_key, s_name AS restaurant_name,
       CAST(c_custkey AS VARCHAR) AS user_key, c_name AS user_name, o_orderdate AS ts
FROM orders JOIN ord_rest ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = rest_key JOIN customer ON c_custkey = o_custkey""")

oracle("stream_upsert", """
SELECT CAST(o_orderkey AS VARCHAR) AS object_id,
       json_object('_id', CAST(o_orderkey AS VARCHAR), 'v', CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END)::VARCHAR
         AS object_value,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END AS update_ts
FROM orders""")

oracle("dm_deliveries_date_literal", with_(_DELIV) + """
SELECT order_id, CAST(CAST(order_ts AS DATE) AS TIMESTAMP) AS order_ts, delivery_id, courier_id, address,
       CAST(CAST(delivery_ts AS DATE) AS TIMESTAMP) AS delivery_ts, sum FROM deliv""")
