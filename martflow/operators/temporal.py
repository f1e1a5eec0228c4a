"""Validity intervals (U7, J9): histories with several and with late versions,
and the lookup of the version that was valid at a row's own time.

A history is (key, attributes, active_from, active_to): half-open intervals,
the open one ending at the far-future sentinel.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from martflow.functions.scalars import sentinel

BUCKETS = 64                 # time buckets that the as-of join deals a key into


def merge_versions(history: DataFrame, changes: DataFrame, key: str, attrs: Sequence[str], at: str, order: Sequence[Column] = ()) -> DataFrame:
    """The history after ``changes`` (key, attrs, ``at``): each sets the
    attributes from its time until the next known version of the member.

    A batch may change a member several times, and a change may be older than
    versions already stored: the interval it falls into is split.  Changes at
    one time are reduced to the last by ``order`` and replace a version that
    starts at it.  A version that says the same as the one before it is kept,
    so batches give the same history in every order of arrival
    (:func:`compacted` joins such versions).  A member that was closed stays so
    until its next change.  Only members with changes are rebuilt.
    """
    row = lambda present, cols: F.struct(F.lit(present).alias("present"), *cols)
    named = [F.col(a) for a in attrs]
    types = dict(history.dtypes)
    blank = [F.lit(None).cast(types[a]).alias(a) for a in attrs]
    last = F.max_by(row(True, [F.col(a).cast(types[a]).alias(a) for a in attrs]), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)] or [F.lit(0).alias("o")]))
    new = changes.groupBy(key, F.col(at).alias("at")).agg(last.alias("v")).withColumn("rank", F.lit(2))
    keys = new.select(key).distinct()
    old = history.join(keys, key, "left_semi")
    events = (old.select(key, F.col("active_from").alias("at"), row(True, named).alias("v"), F.lit(1).alias("rank"))
              .unionByName(old.filter(F.col("active_to") < sentinel()).select(key, F.col("active_to").alias("at"), row(False, blank).alias("v"), F.lit(0).alias("rank")))
              .unionByName(new))
    events = events.groupBy(key, "at").agg(F.max_by("v", "rank").alias("v"))
    of = Window.partitionBy(key).orderBy("at")
    rebuilt = events.withColumn("active_to", F.coalesce(F.lead("at").over(of), sentinel())).filter("v.present").select(
        key, *[F.col(f"v.{a}").alias(a) for a in attrs], F.col("at").alias("active_from"), "active_to")
    return history.join(keys, key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)


def compacted(history: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """The history with versions that follow each other without a gap and say
    the same made one."""
    of = Window.partitionBy(key).orderBy("active_from")
    value = F.struct(*[F.col(a) for a in attrs])
    goes_on = (F.lag("active_to").over(of) == F.col("active_from")) & F.lag(value).over(of).eqNullSafe(value)
    part = F.sum(F.when(F.coalesce("_mf_goes_on", F.lit(False)), 0).otherwise(1)).over(of)
    marked = history.withColumn("_mf_goes_on", goes_on).withColumn("_mf_part", part)
    return marked.groupBy(key, *attrs, "_mf_part").agg(F.min("active_from").alias("active_from"), F.max("active_to").alias("active_to")).drop("_mf_part")


def as_of_join(facts: DataFrame, history: DataFrame, key: str, at: str, attrs: Sequence[str], how: str = "left", buckets: int = BUCKETS) -> DataFrame:
    """``facts`` with the attributes of the version valid at ``facts.at``
    (NULL where there is none, or no row with ``how="inner"``).

    Both sides meet on the key and a bucket of time: a version stands in each
    bucket that it covers, at most ``buckets`` of them over the facts' own
    span, so the facts of a hot key are dealt to as many tasks and no key's
    history is gathered anywhere.
    """
    lo, hi = facts.agg(F.min(at), F.max(at)).first()
    if lo is None:
        lo = hi = dt.datetime(1970, 1, 1)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    first = micros(F.lit(lo).cast("timestamp_ntz"))
    width = F.greatest(F.ceil((micros(F.lit(hi).cast("timestamp_ntz")) - first + 1) / F.lit(buckets)).cast("long"), F.lit(1))
    bucket = lambda c: ((micros(c) - first - F.pmod(micros(c) - first, width)) / width).cast("int")
    low, high = F.greatest("active_from", F.lit(lo).cast("timestamp_ntz")), F.least("active_to", F.lit(hi).cast("timestamp_ntz"))
    versions = history.filter((F.col("active_from") <= F.lit(hi).cast("timestamp_ntz")) & (F.col("active_to") > F.lit(lo).cast("timestamp_ntz"))).select(
        F.col(key).alias("_mf_key"), F.col("active_from").alias("_mf_from"), F.col("active_to").alias("_mf_to"),
        *[F.col(a).alias(f"_mf_v_{a}") for a in attrs], F.explode(F.sequence(bucket(low), bucket(high))).alias("_mf_slot"))
    rows = facts.withColumn("_mf_bucket", bucket(F.col(at)))
    valid = (F.col(key) == F.col("_mf_key")) & (F.col("_mf_bucket") == F.col("_mf_slot")) & (F.col(at) >= F.col("_mf_from")) & (F.col(at) < F.col("_mf_to"))
    return rows.join(versions, valid, how).select(*facts.columns, *[F.col(f"_mf_v_{a}").alias(a) for a in attrs])
