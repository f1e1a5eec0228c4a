"""M1: RFM customer segmentation (recency, frequency, monetary value).

``rfm_segments`` is the intended mart: 5 = best, every user present,
never-buyers get 1 on all three, optional depth limit ``since``.
``rfm_ntile_literal`` keeps the reference query's descending buckets (1 = best)
over buyers only.  Both break NTILE ties by ``user_id`` so results are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martflow.constants import RFM_BUCKETS as BUCKETS, STATUS_CLOSED as CLOSED
from martflow.operators.selection import Key, ntile


def user_stats(orders: DataFrame, since: str | None = None) -> DataFrame:
    """Per-user last closed order time, closed order count and revenue."""
    closed = orders.filter(F.col("status") == CLOSED)
    if since is not None:
        closed = closed.filter(F.col("order_ts") >= F.lit(since).cast("timestamp_ntz"))
    return closed.groupBy("user_id").agg(
        F.max("order_ts").alias("most_recent_order"),
        F.count("order_id").alias("total_num_orders"),
        F.sum("payment").cast("decimal(29,5)").alias("total_revenue"),
    )


def rfm_ntile_literal(orders: DataFrame) -> DataFrame:
    """F2 + W1 as written: every statistic in five buckets, the best first."""
    return _scored(user_stats(orders), {"recency": Key("most_recent_order", desc=True), "frequency": Key("total_num_orders", desc=True),
                                        "monetary_value": Key("total_revenue", desc=True)})


def _scored(stats: DataFrame, scores: dict[str, Key]) -> DataFrame:
    """A bucket column per score.  The statistics are kept only while the
    bucket limits are searched; nothing is written."""
    kept, out = stats.persist(), stats
    try:
        for name, key in scores.items():
            out = ntile(kept, BUCKETS, [key, Key("user_id")], name, onto=out)
    finally:
        kept.unpersist()
    return out


def rfm_segments(users: DataFrame, orders: DataFrame, since: str | None = None) -> DataFrame:
    """Intended mart: ascending buckets over all users (B1, B2)."""
    s = user_stats(orders, since)
    base = users.select(F.col("id").alias("user_id")).join(s, "user_id", "left").select(
        "user_id",
        "most_recent_order",
        F.coalesce("total_num_orders", F.lit(0)).alias("n"),
        F.coalesce("total_revenue", F.lit(0).cast("decimal(29,5)")).alias("m"),
        F.col("total_num_orders").isNull().alias("never"),
    )
    base = _scored(base, {"r": Key("most_recent_order"), "f": Key("n"), "mv": Key("m")})

    def bucket(c: str):
        return F.when(F.col("never"), F.lit(1)).otherwise(F.col(c)).cast("smallint")

    return base.select(
        "user_id", bucket("r").alias("recency"), bucket("f").alias("frequency"),
        bucket("mv").alias("monetary_value"),
    )


def bucket_balance(segments: DataFrame) -> DataFrame:
    """Q7: users per bucket for each of the three scores."""
    long = segments.select(
        F.explode(F.array(
            F.struct(F.lit("recency").alias("metric"), F.col("recency").alias("bucket")),
            F.struct(F.lit("frequency").alias("metric"), F.col("frequency").alias("bucket")),
            F.struct(F.lit("monetary_value").alias("metric"), F.col("monetary_value").alias("bucket")),
        )).alias("x")
    ).select("x.metric", "x.bucket")
    return long.groupBy("metric", "bucket").agg(F.count(F.lit(1)).alias("users"))
