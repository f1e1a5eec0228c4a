"""Dense surrogate keys (K13) and NTILE without a one-partition window.

A global ``row_number()``/``ntile()`` window with no PARTITION BY moves every
row into one task.  Here the rows are range-partitioned on the order keys,
numbered within each partition, and shifted by per-partition offsets.  The
offsets table has one row per partition, so broadcasting it is bounded.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martflow.session import scratch_path

OrderSpec = Sequence[str | Column]


def assign_keys(df: DataFrame, order: OrderSpec, start: int = 1, key: str = "id",
                num_partitions: int | None = None) -> DataFrame:
    """Number rows start, start+1, ... following ``order``.

    ``order`` must be a total order (end it with a unique column), otherwise
    tied rows get an arbitrary but still dense numbering.
    The ranged and sorted rows are written once to the shared folder so the
    counting pass and the numbering pass see the same rows, and an executor
    loss re-reads them instead of re-sampling the ranges.
    """
    # Without an explicit count the range exchange starts from the session's
    # shuffle partition count (size it for the data) and AQE may coalesce
    # neighbouring ranges; coalesced ranges stay contiguous and ordered.
    by_range = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = (
        by_range
        .sortWithinPartitions(*order)
        .withColumn("_mf_pid", F.spark_partition_id())
        .withColumn("_mf_mid", F.monotonically_increasing_id())
    )
    # Materialise once as a table in the shared folder: the partition id and
    # in-partition index are columns now, so the counting pass (one pruned
    # column) and the numbering pass read the same rows, and a lost executor
    # re-reads files instead of re-sampling the ranges.
    path = scratch_path(df.sparkSession, "keys")
    ranged.write.option("compression", "zstd").parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    # one row per partition (a bounded set): turn counts into start offsets
    counts = dict((r[0], r[1]) for r in ranged.groupBy("_mf_pid").agg(F.count(F.lit(1))).collect())
    offsets, run = [], 0
    for pid in range(max(counts, default=-1) + 1):  # empty ranges count 0
        offsets.append((pid, run))
        run += counts.get(pid, 0)
    local_index = F.col("_mf_mid") - F.shiftleft(F.col("_mf_pid").cast("long"), 33)
    # one row per range partition, so the broadcast is bounded by the partition count
    offsets_df = df.sparkSession.createDataFrame(offsets, "_mf_pid int, _mf_off long")
    return (
        ranged.join(F.broadcast(offsets_df), "_mf_pid")
        .withColumn(key, F.lit(start).cast("long") + F.col("_mf_off") + local_index)
        .drop("_mf_pid", "_mf_mid", "_mf_off")
    )


def ntile_column(rank: Column, total: int, buckets: int) -> Column:
    """NTILE bucket of a 0-based rank among ``total`` rows: the first
    ``total % buckets`` buckets hold one extra row, as SQL NTILE does."""
    q, r = divmod(total, buckets)
    big = r * (q + 1)
    first = F.floor(rank / F.lit(q + 1)) + 1
    rest = F.lit(r) + F.floor((rank - F.lit(big)) / F.lit(max(q, 1))) + 1
    return F.when(rank < F.lit(big), first).otherwise(rest).cast("int")


def ntile_distributed(df: DataFrame, buckets: int, order: OrderSpec, out: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``ntile(buckets) OVER (ORDER BY order)`` as a two-pass distributed rank."""
    ranked = assign_keys(df, order, start=0, key="_mf_rank", num_partitions=num_partitions)
    total = ranked.count()
    return ranked.withColumn(out, ntile_column(F.col("_mf_rank"), total, buckets)).drop("_mf_rank")
