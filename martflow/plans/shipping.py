"""Normalise the denormalised shipping log into dimensions and entity
tables, then the datamart and the analyst questions on top (M3-M8, M24).

Surrogate ids (SERIAL in the reference) follow a stated total order via the
distributed ``assign_keys``.  Dimensions are small distinct sets; Spark's
adaptive execution broadcasts them when their measured size is under the
broadcast threshold and falls back to a shuffle join otherwise.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from martflow.constants import SHIPPING_FINISHED
from martflow.functions.scalars import age_day_part, part, split_descriptor
from martflow.operators.keys import assign_keys
from martflow.operators.latest import order_key


def split_agreement(c: str) -> list:
    arr = split_descriptor(c)
    return [
        part(arr, 1).cast("long").alias("agreementid"),
        part(arr, 2).cast("string").alias("agreement_number"),
        part(arr, 3).cast("decimal(14,3)").alias("agreement_rate"),
        part(arr, 4).cast("decimal(14,3)").alias("agreement_commission"),
    ]


def split_transfer(c: str) -> list:
    arr = split_descriptor(c)
    return [part(arr, 1).alias("transfer_type"), part(arr, 2).alias("transfer_model")]


def quarantine_descriptors(log: DataFrame) -> DataFrame:
    """X3 quarantine path: log rows whose agreement descriptor does not parse
    (too few parts, or a part that is not a number where one is required).
    The main path keeps ANSI casts, which raise on such rows as the database
    cast does; this finds them beforehand with ``try_cast``."""
    arr = split_descriptor("vendor_agreement_description")
    bad = (
        part(arr, 4).isNull()
        | part(arr, 1).try_cast("long").isNull()
        | part(arr, 3).try_cast("decimal(14,3)").isNull()
        | part(arr, 4).try_cast("decimal(14,3)").isNull()
    )
    return log.filter(bad)


def descriptors(log: DataFrame) -> DataFrame:
    """X1-X3 on every log row (5th element shows the NULL out-of-range rule)."""
    return log.select(
        "shippingid", "state_datetime",
        *split_agreement("vendor_agreement_description"),
        *split_transfer("shipping_transfer_description"),
        part(split_descriptor("vendor_agreement_description"), 5).alias("agreement_extra"),
    )


def country_rates(log: DataFrame) -> DataFrame:
    """Distinct (country, base rate) with ids in (country, rate) order."""
    d = log.select("shipping_country", "shipping_country_base_rate").distinct()
    return assign_keys(d, ["shipping_country", "shipping_country_base_rate"], key="shipping_country_id")


def agreements(log: DataFrame) -> DataFrame:
    """M4: distinct raw descriptor first (small shuffle), then split and cast."""
    d = log.select("vendor_agreement_description").distinct()
    return d.select(*split_agreement("vendor_agreement_description"))


def transfers(log: DataFrame) -> DataFrame:
    """M5: distinct (descriptor, rate), split, ids in (type, model, rate) order."""
    d = log.select("shipping_transfer_description", "shipping_transfer_rate").distinct()
    d = d.select(*split_transfer("shipping_transfer_description"), "shipping_transfer_rate")
    return assign_keys(d, ["transfer_type", "transfer_model", "shipping_transfer_rate"],
                       key="transfer_type_id")


def info(log: DataFrame, country: DataFrame, agreement: DataFrame, transfer: DataFrame) -> DataFrame:
    """M6 / J2 as written (B5): country by name only, agreement by the split
    id, transfer by (type, model); DISTINCT result."""
    s = log.select(
        "shippingid", "vendorid", "payment_amount", "shipping_plan_datetime", "shipping_country",
        "vendor_agreement_description", "shipping_transfer_description",
    ).distinct()  # collapse the log before splitting and joining
    s = s.select(
        "shippingid", "vendorid", "payment_amount", "shipping_plan_datetime", "shipping_country",
        part(split_descriptor("vendor_agreement_description"), 1).cast("long").alias("agreement_key"),
        *split_transfer("shipping_transfer_description"),
    )
    j = (
        s.join(country.select("shipping_country", "shipping_country_id"), "shipping_country")
        .join(agreement.select("agreementid"), F.col("agreementid") == F.col("agreement_key"))
        .join(transfer.select("transfer_type", "transfer_model", "transfer_type_id"),
              ["transfer_type", "transfer_model"])
    )
    return j.select(
        "shippingid", "vendorid", "payment_amount", "shipping_plan_datetime",
        "transfer_type_id", "shipping_country_id", "agreementid",
    ).distinct()


def latest_rates(log: DataFrame, dim: DataFrame, keys: list[str], rate: str, key_columns: list | None = None) -> DataFrame:
    """Of a dimension keyed with its rate, the member with each key's latest
    rate: that of the log's newest row (the greatest rate where rows tie; rows
    without a stamp are the oldest).  One row per key, by a partial aggregation."""
    newest = log.select(*(key_columns or keys), rate, "state_datetime").groupBy(*keys).agg(
        F.max_by(rate, F.struct(F.col("state_datetime").isNotNull().alias("dated"), "state_datetime", rate)).alias("_mf_rate"))
    return dim.join(newest, keys).filter(F.col(rate).eqNullSafe(F.col("_mf_rate"))).drop("_mf_rate")


def info_by_latest_rate(log: DataFrame, country: DataFrame, agreement: DataFrame, transfer: DataFrame) -> DataFrame:
    """M6 / J2 with B5 mended: country and transfer are looked up by their
    latest rate, so a shipment has one row however many rates there were."""
    return info(log, latest_rates(log, country, ["shipping_country"], "shipping_country_base_rate"), agreement,
                latest_rates(log, transfer, ["transfer_type", "transfer_model"], "shipping_transfer_rate",
                             split_transfer("shipping_transfer_description")))


def status(log: DataFrame) -> DataFrame:
    """M7: first/last state per shipment in one partial aggregation.

    start = FIRST_VALUE(ts ORDER BY ts) -> smallest non-NULL stamp;
    end/status/state = FIRST_VALUE(.. ORDER BY ts DESC) -> a NULL stamp comes
    first (PostgreSQL DESC is NULLS FIRST); ties broken by status, state (B6).
    """
    ts, st, state = F.col("state_datetime"), F.col("status"), F.col("state")
    last = F.max_by(F.struct(st.alias("status"), state.alias("state"), ts.alias("end")),
                    order_key([ts, st, state], nulls_win=True))
    agg = log.groupBy("shippingid").agg(F.min(ts).alias("shipping_start_fact_datetime"), last.alias("_last"))
    return agg.select(
        "shippingid", F.col("_last.status").alias("status"), F.col("_last.state").alias("state"),
        "shipping_start_fact_datetime", F.col("_last.end").alias("shipping_end_fact_datetime"))


def datamart(st: DataFrame, inf: DataFrame, transfer: DataFrame, country: DataFrame,
             agreement: DataFrame) -> DataFrame:
    """The shipping_datamart view as a lazy frame, with boolean
    output columns (F5), CASE for the delay (F6), AGE day parts (X6) and
    decimal arithmetic (X10)."""
    j = (
        st.join(inf, "shippingid")
        .join(transfer, "transfer_type_id")
        .join(country, "shipping_country_id")
        .join(agreement, "agreementid")
    )
    end, start, plan = (F.col("shipping_end_fact_datetime"), F.col("shipping_start_fact_datetime"),
                        F.col("shipping_plan_datetime"))
    rates = F.col("shipping_country_base_rate") + F.col("agreement_rate") + F.col("shipping_transfer_rate")
    return j.select(
        "shippingid", "vendorid", "transfer_type",
        age_day_part(end, start).alias("full_day_at_shipping"),
        (end > plan).alias("is_delay"),
        (F.col("status") == SHIPPING_FINISHED).alias("is_shipping_finish"),
        F.when(end > plan, age_day_part(end, plan)).otherwise(F.lit(0)).alias("delay_day_at_shipping"),
        "payment_amount",
        (F.col("payment_amount") * rates).cast("decimal(31,5)").alias("vat"),
        (F.col("payment_amount") * F.col("agreement_commission")).cast("decimal(29,5)").alias("profit"),
    )


class Model:
    """All P2 tables from one log.

    With ``materialize`` (for a log that is itself a computed frame) the log
    is written once to the shared folder as parquet; every target then reads
    it with column pruning instead of recomputing the log once per target.
    A log that is already a stored table is used as is.
    """

    def __init__(self, log: DataFrame, materialize: bool = False):
        if materialize:
            from martflow.operators.tables import publish
            log = publish(log, "shipping_log")
        self.log = log

    # each table is built on first use, so a query pays only for what it reads
    @cached_property
    def country(self) -> DataFrame:
        return country_rates(self.log)

    @cached_property
    def agreement(self) -> DataFrame:
        return agreements(self.log)

    @cached_property
    def transfer(self) -> DataFrame:
        return transfers(self.log)

    @cached_property
    def info(self) -> DataFrame:
        return info(self.log, self.country, self.agreement, self.transfer)

    @cached_property
    def status(self) -> DataFrame:
        return status(self.log)

    def datamart(self) -> DataFrame:
        return datamart(self.status, self.info, self.transfer, self.country, self.agreement)


def cost_by_country(m: Model) -> DataFrame:
    """Delivery cost per country (VAT and payments)."""
    dm = m.datamart()
    j = dm.join(m.info.select("shippingid", "shipping_country_id"), "shippingid").join(
        m.country.select("shipping_country_id", "shipping_country"), "shipping_country_id")
    return j.groupBy("shipping_country").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("payment_amount").cast("decimal(24,2)").alias("total_payment"),
        F.sum("vat").cast("decimal(38,5)").alias("total_vat"),
        F.sum(F.col("is_delay").cast("int")).cast("long").alias("delayed"),
    )


def finished_last_week(m: Model, as_of=None) -> DataFrame:
    """Shipments finished in the 7 days up to ``as_of`` (default: the
    latest finish in the data, one scalar)."""
    st = m.status.filter(F.col("status") == SHIPPING_FINISHED)
    if as_of is None:
        as_of = st.agg(F.max("shipping_end_fact_datetime")).first()[0]
    lo = F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS")
    recent = st.filter((F.col("shipping_end_fact_datetime") > lo)
                       & (F.col("shipping_end_fact_datetime") <= F.lit(as_of).cast("timestamp_ntz")))
    return recent.join(m.info.select("shippingid", "vendorid", "payment_amount"), "shippingid").select(
        "shippingid", "vendorid", "shipping_end_fact_datetime", "payment_amount")


def vendor_tariffs(m: Model) -> DataFrame:
    """Each vendor's agreement terms with its shipment volume and profit."""
    dm = m.datamart().select("shippingid", "vendorid", "payment_amount", "profit")
    j = dm.join(m.info.select("shippingid", "agreementid"), "shippingid").join(m.agreement, "agreementid")
    return j.groupBy("vendorid", "agreementid", "agreement_number", "agreement_rate",
                     "agreement_commission").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("payment_amount").cast("decimal(24,2)").alias("total_payment"),
        F.sum("profit").cast("decimal(38,5)").alias("total_profit"),
    )
