"""External database tables over JDBC.

Not registered as queries: they need a database server, and none may be
started here.  The readers are plain ``spark.read.jdbc`` calls: a numeric
partition column splits the read into parallel range queries, and the cursor
predicate is a DataFrame filter that Spark pushes into the source query's
WHERE clause (visible as ``PushedFilters`` in the plan).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Whole-table read, optionally split into ``num_partitions`` range reads."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def read_since(spark: SparkSession, url: str, table: str, key: str, cursor: int,
               properties: Mapping[str, str] | None = None, **partitioning) -> DataFrame:
    """``key > cursor`` on the source table, pushed down to the database."""
    return read_table(spark, url, table, properties, **partitioning).filter(F.col(key) > F.lit(cursor))
