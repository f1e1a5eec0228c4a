"""Calendar dimension from a generated day series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.functions.scalars import month_name_padded


def calendar(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days`` consecutive dates from ``start`` with date_id 1..days.

    ``spark.range`` spreads the series over tasks (no single exploded array);
    the row count is the stated parameter, so the table's size is known up
    front and it can be broadcast safely.
    """
    d0 = dt.date.fromisoformat(start)
    day = F.date_add(F.lit(d0), F.col("id").cast("int"))
    return spark.range(0, days).select(
        (F.col("id") + 1).cast("int").alias("date_id"),
        day.alias("full_date"),
    ).select(
        "date_id", "full_date",
        F.dayofmonth("full_date").cast("smallint").alias("day_num"),
        F.month("full_date").cast("smallint").alias("month_num"),
        month_name_padded("full_date").alias("month_name"),
        F.year("full_date").cast("smallint").alias("year_num"),
        F.weekofyear("full_date").cast("smallint").alias("week_num"),
        F.expr("extract(YEAROFWEEK FROM full_date)").cast("smallint").alias("iso_year"),
    )


BROADCAST_DAYS = 100_000     # 273 years


def bounded(cal: DataFrame) -> DataFrame:
    """A calendar to join with: sent to every task while it has at most
    ``BROADCAST_DAYS`` days; a longer one (data with a stray year makes it so)
    meets the rows in whatever join Spark picks from its size."""
    return F.broadcast(cal) if cal.count() <= BROADCAST_DAYS else cal


def days_between(start: str, end: str) -> int:
    """Inclusive day count from start to end (both 'YYYY-MM-DD')."""
    return (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1


def calendar_covering(df: DataFrame, col: str) -> DataFrame:
    """Calendar of whole years spanning ``df[col]`` (two scalars from one
    aggregate), so the dimension follows the data it dates."""
    lo, hi = df.agg(F.min(F.to_date(col)), F.max(F.to_date(col))).first()
    start = dt.date(lo.year, 1, 1).isoformat()
    end = dt.date(hi.year, 12, 31).isoformat()
    return calendar(df.sparkSession, start, days_between(start, end))
