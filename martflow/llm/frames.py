"""DataFrame helpers of the operators: written intermediates and row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martflow.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder under the shared folder and read back: cuts
    lineage, survives lost executors, and gives later plans true sizes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(col: Column) -> Column:
    """UTF-8 length; null counts as empty."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


def digest(col: Column) -> Column:
    """SHA-256 of a text (null: of the empty text), as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(col, F.lit("")).cast("binary"), 256))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (names are matched without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name = "_" + name
    return name


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
