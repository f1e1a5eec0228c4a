"""Courier API payloads in staging -> DDS couriers, restaurants,
deliveries, rates and tips with insert-if-absent and close-out (M22, M23).

``now()`` in the reference becomes an explicit ``as_of`` argument (X11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martflow.functions.json_raw import checked_members, is_json, json_members, member_text
from martflow.functions.scalars import parse_doc_ts, sentinel
from martflow.operators.tables import close_missing, insert_if_absent

DELIVERY_FIELDS = ["order_id", "order_ts", "delivery_id", "courier_id", "address", "delivery_ts", "sum", "rate",
                   "tip_sum"]


def json_fields(staged: DataFrame, fields=DELIVERY_FIELDS) -> DataFrame:
    """``object_value::JSON ->> key`` for each key, as the document has it
    (numbers digit for digit, only the outermost key), all keys in one pass
    over the text.  A document that is no JSON object stops the load."""
    doc = staged.select("object_id", checked_members("object_value").alias("d"))
    return doc.select("object_id", *[member_text(F.col("d"), k).alias(k) for k in fields])


def _members(existing: DataFrame | None, staged: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Insert members not yet in the dim (first staged row per id wins),
    open-ended validity (the missing ``active_to`` of B21 gets the sentinel)."""
    src = staged.withColumn("d", checked_members("object_value")).select(
        F.col("object_id").alias(id_col), member_text(F.col("d"), "name").alias(name_col),
        F.col("update_ts").alias("active_from"), sentinel().alias("active_to"), "update_ts")
    if existing is None:
        existing = src.limit(0).drop("update_ts")
    return insert_if_absent(existing, src, [id_col], [F.col("update_ts"), F.col(name_col)])


def dm_restaurants(existing: DataFrame | None, staged: DataFrame) -> DataFrame:
    """Restaurants of the API payload."""
    return _members(existing, staged, "restaurant_id", "restaurant_name")


def close_missing_restaurants(dim: DataFrame, staged: DataFrame, as_of: str) -> DataFrame:
    """Restaurants that vanished from the latest payload are closed."""
    return close_missing(dim, staged, "restaurant_id", "object_id", as_of)


def dm_couriers(existing: DataFrame | None, staged: DataFrame) -> DataFrame:
    """Couriers of the API payload."""
    return _members(existing, staged, "courier_id", "courier_name")


def close_missing_couriers(dim: DataFrame, staged: DataFrame, as_of: str) -> DataFrame:
    """Couriers that vanished from the latest payload are closed."""
    return close_missing(dim, staged, "courier_id", "object_id", as_of)


def _deliveries(staged: DataFrame, *fields: str) -> DataFrame:
    """The wanted fields of the delivery documents; one that is no JSON
    object or has no delivery_id stops the load, as it must not become a
    delivery full of NULLs (:func:`split_deliveries` sets such rows aside)."""
    d = json_fields(staged, ["delivery_id", *fields])
    missing = F.raise_error(F.concat(F.lit("delivery without delivery_id: "), F.col("object_id"))).cast("string")
    return d.withColumn("delivery_id", F.coalesce("delivery_id", missing))


def split_deliveries(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that load, documents that don't): the second for a
    quarantine table.  A NULL document doesn't load."""
    members = F.when(is_json("object_value"), json_members("object_value"))
    j = staged.withColumn("_mf_d", members)
    loads = member_text(F.col("_mf_d"), "delivery_id").isNotNull()
    return j.filter(loads).drop("_mf_d"), j.filter(~loads).drop("_mf_d")


def dm_deliveries(existing: DataFrame | None, staged: DataFrame, keep_time: bool = True) -> DataFrame:
    """Deliveries keyed by delivery_id, insert-if-absent.

    ``keep_time=False`` reproduces the reference's ``::date`` casts, which
    drop the time of day before storing into TIMESTAMP columns (B22).
    """
    d = _deliveries(staged, "order_ts", "courier_id", "address", "delivery_ts", "sum")

    def stamp(c):
        ts = parse_doc_ts(c)
        return ts if keep_time else F.to_date(ts).cast("timestamp_ntz")

    src = d.select(
        F.col("object_id").alias("order_id"), stamp("order_ts").alias("order_ts"),
        "delivery_id", "courier_id",
        "address", stamp("delivery_ts").alias("delivery_ts"),
        F.col("sum").cast("decimal(14,2)").alias("sum"))
    if existing is None:
        existing = src.limit(0)
    return insert_if_absent(existing, src, ["delivery_id"], [F.col("order_id")])


def dm_rate(existing: DataFrame | None, staged: DataFrame) -> DataFrame:
    """Rating per delivery (``::smallint``)."""
    src = _deliveries(staged, "rate").select("delivery_id", F.col("rate").cast("smallint").alias("rate"), "object_id")
    if existing is None:
        existing = src.limit(0).drop("object_id")
    return insert_if_absent(existing, src, ["delivery_id"], [F.col("object_id")])


def dm_tips(existing: DataFrame | None, staged: DataFrame) -> DataFrame:
    """Tip per delivery (``::numeric`` into NUMERIC(14,2))."""
    src = _deliveries(staged, "tip_sum").select("delivery_id", F.col("tip_sum").cast("decimal(14,2)").alias("tip_sum"), "object_id")
    if existing is None:
        existing = src.limit(0).drop("object_id")
    return insert_if_absent(existing, src, ["delivery_id"], [F.col("object_id")])
