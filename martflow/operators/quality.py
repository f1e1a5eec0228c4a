"""Data-quality rules as Spark jobs.

The reference's table constraints (NOT NULL, UNIQUE, FK, CHECK, varchar
length) are not enforced by parquet tables; each becomes a check that
returns ``(table_name, rule, violations)`` rows.  Several rules on one table
run in a single aggregation; a CHECK predicate that is NULL passes, as in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

RESULT_COLS = ["table_name", "rule", "violations"]


def _unpivot(agg: DataFrame, table: str, names: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").cast("long").alias("violations"))
                      for n in names])
    return agg.select(F.lit(table).alias("table_name"), F.inline(pairs))


def not_null(df: DataFrame, table: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Q1: NULL count per column, all columns in one pass."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in cols])
    return _unpivot(agg, table, [f"not_null:{c}" for c in cols])


def unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key (0 when ``count = count distinct``).
    As for a UNIQUE constraint, rows with a NULL in the key never conflict
    (NOT NULL is rule Q1).  Grouping combines map-side, so a hot key costs
    no more than a cold one."""
    name = "unique:" + ",".join(key)
    complete = F.lit(True)
    for k in key:
        complete = complete & F.col(k).isNotNull()
    per_key = df.filter(complete).groupBy(*key).agg(F.count(F.lit(1)).alias("_mf_n"))
    agg = per_key.agg(F.coalesce(F.sum(F.col("_mf_n") - 1), F.lit(0)).alias(name))
    return _unpivot(agg, table, [name])


def in_one_scan(df: DataFrame, table: str, required: Sequence[str] = (), keys: Sequence[Sequence[str]] = (),
                checks: Mapping[str, Column] | None = None) -> DataFrame:
    """Q1, Q2, Q4 and Q8 of one table from a single scan and a single shuffle:
    every row gives one entry per key (its values) and one per rule that it
    breaks, entries are counted map-side first, and the counts make the
    violations of all rules.  Results as from the separate rules."""
    rules: list[tuple[str, Column, Column | None]] = [(f"not_null:{c}", F.col(c).isNull(), None) for c in required]
    rules += [(f"check:{name}", ~pred, None) for name, pred in (checks or {}).items()]
    for key in keys:
        complete = F.lit(True)
        for k in key:
            complete = complete & F.col(k).isNotNull()
        rules.append(("unique:" + ",".join(key), complete, F.to_json(F.struct(*[F.col(k) for k in key]))))
    none = F.lit(None).cast("string")
    entries = F.array(*[F.when(when, F.struct(F.lit(i).alias("rule"), (none if value is None else value).alias("key"))) for i, (_, when, value) in enumerate(rules)])
    per = df.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).groupBy("e.rule", "e.key").agg(F.count(F.lit(1)).alias("n"))
    agg = per.agg(*[F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("n") - (0 if value is None else 1))), F.lit(0)).alias(name) for i, (name, _, value) in enumerate(rules)])
    return _unpivot(agg, table, [name for name, _, _ in rules])


def orphans(child: DataFrame, table: str, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    name = f"fk:{child_col}"
    keys = parent.select(F.col(parent_col).alias("_mf_p")).distinct()
    miss = child.filter(F.col(child_col).isNotNull()).join(keys, F.col(child_col) == F.col("_mf_p"), "left_anti")
    return _unpivot(miss.agg(F.count(F.lit(1)).alias(name)), table, [name])


def row_predicates(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Q4 / Q8: rows where a CHECK predicate is false (NULL passes)."""
    agg = df.agg(*[F.count_if(~pred).alias(f"check:{name}") for name, pred in rules.items()])
    return _unpivot(agg, table, [f"check:{n}" for n in rules])


def rank_rules() -> dict[str, Column]:
    """The CHECKs of the bonus ranks, each column under its own rule."""
    return {"bonus_percent": F.col("bonus_percent") >= 0, "min_payment_threshold": F.col("min_payment_threshold") >= 0}


def max_length(col: str, n: int) -> Column:
    """Q8: varchar(n) as a predicate."""
    return F.length(F.col(col)) <= n


def accepted_values(df: DataFrame, col: str, accepted: Sequence) -> DataFrame:
    """Each distinct value with its row count and whether it is accepted."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("rows")).select(
        col, "rows", F.col(col).isin(*accepted).alias("accepted"))


def reconcile(headers: DataFrame, key: str, header_total: str, lines: DataFrame, line_key: str,
              line_amount: Column) -> DataFrame:
    """Headers whose total differs from the sum of their lines
    (a header without lines counts as a difference)."""
    sums = lines.groupBy(F.col(line_key).alias(key)).agg(F.sum(line_amount).alias("lines_total"))
    j = headers.select(key, F.col(header_total).alias("header_total")).join(sums, key, "left")
    return j.filter(F.col("lines_total").isNull() | (F.col("lines_total") != F.col("header_total"))).select(
        key, "header_total", "lines_total")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# The marts' own constraints, re-aimed as rules run on the published frames.
def _rfm(df: DataFrame) -> list[DataFrame]:
    rng = {c: F.col(c).between(1, 5) for c in ("recency", "frequency", "monetary_value")}
    return [not_null(df, "dm_rfm_segments"), unique(df, "dm_rfm_segments", ["user_id"]),
            row_predicates(df, "dm_rfm_segments", rng)]


def _fact(df: DataFrame) -> list[DataFrame]:
    # PK (date_id, item_id, customer_id): the DISTINCT load can keep rows that
    # differ only in quantity/status (B13) -- reported here, never dropped
    return [not_null(df, "f_daily_sales", ["date_id", "item_id", "customer_id"]),
            unique(df, "f_daily_sales", ["date_id", "item_id", "customer_id"])]


def _timestamps(df: DataFrame) -> list[DataFrame]:
    return [unique(df, "dm_timestamps", ["id"]), row_predicates(df, "dm_timestamps", {
        "year_2020_2499": (F.col("year") >= 2020) & (F.col("year") < 2500),
        "month_0_12": F.col("month").between(0, 12), "day_0_31": F.col("day").between(0, 31)})]


def _keyed(table: str, key: str):
    return lambda df: [unique(df, table, [key]), not_null(df, table, [key])]


def _member(table: str, natural: list[str]):
    """A dimension: its surrogate id and its natural key, neither twice."""
    return lambda df: [unique(df, table, ["id"]), unique(df, table, natural), not_null(df, table, ["id", *natural])]


def _products(df: DataFrame) -> list[DataFrame]:
    return [*_member("dm_products", ["product_id", "restaurant_id"])(df),
            row_predicates(df, "dm_products", {"price_non_negative": F.col("product_price") >= 0})]


def _product_sales(df: DataFrame) -> list[DataFrame]:
    cols = ["count", "price", "total_sum", "bonus_payment", "bonus_grant"]
    return [not_null(df, "fct_product_sales", ["product_id", "order_id"]),
            row_predicates(df, "fct_product_sales", {f"{c}_non_negative": F.col(c) >= 0 for c in cols})]


MART_RULES = {
    "shipping_info": _keyed("shipping_info", "shippingid"),
    "shipping_status": _keyed("shipping_status", "shippingid"),
    "shipping_agreement": _keyed("shipping_agreement", "agreementid"),
    "shipping_country_rates": _keyed("shipping_country_rates", "shipping_country_id"),
    "shipping_transfer": _keyed("shipping_transfer", "transfer_type_id"),
    "dm_products": _products,
    "fct_product_sales": _product_sales,
    "dm_orders": _member("dm_orders", ["order_key"]),
    "dm_users": _member("dm_users", ["user_id"]),
    "dm_restaurants": _member("dm_restaurants", ["restaurant_id", "active_from"]),
    "dm_rfm_segments": _rfm,
    "f_daily_sales": _fact,
    "dm_timestamps": _timestamps,
    "d_customer": _member("d_customer", ["customer_id"]),  # B9 shows here
    "d_item": _member("d_item", ["item_id"]),
    "customer_retention": _keyed("customer_retention", "period_id"),
}


# foreign keys between marts: (child, column, parent, column)
MART_KEYS = [
    ("fct_product_sales", "product_id", "dm_products", "id"), ("fct_product_sales", "order_id", "dm_orders", "id"),
    ("dm_orders", "restaurant_id", "dm_restaurants", "id"), ("dm_orders", "timestamp_id", "dm_timestamps", "id"),
    ("dm_orders", "user_id", "dm_users", "id"), ("dm_products", "restaurant_id", "dm_restaurants", "id"),
    ("f_daily_sales", "date_id", "d_calendar", "date_id"), ("f_daily_sales", "customer_id", "d_customer", "customer_id"),
    ("f_daily_sales", "item_id", "d_item", "item_id"),
    ("shipping_info", "shipping_country_id", "shipping_country_rates", "shipping_country_id"),
    ("shipping_info", "agreementid", "shipping_agreement", "agreementid"),
    ("shipping_info", "transfer_type_id", "shipping_transfer", "transfer_type_id"),
]


def check_marts(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Run each known mart's constraint rules, and the foreign keys between
    marts that are both given; one (table, rule, violations) row per rule."""
    frames = [f for name, df in marts.items() if name in MART_RULES for f in MART_RULES[name](df)]
    frames += [orphans(marts[child], child, col, marts[parent], parent_col)
               for child, col, parent, parent_col in MART_KEYS if child in marts and parent in marts]
    return union_all(frames)
