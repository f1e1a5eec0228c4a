"""The polled loaders re-expressed with Structured Streaming.

- ``tail``: an ``availableNow`` file-source run delivers only the files that
  arrived since the last run; progress lives in the checkpoint, so a rerun
  or a lost executor never re-delivers or skips a file.
- ``dedupe``: the outbox's primary key, held against the stored ids, so an
  event that arrives late is stored like any other.
- ``dedupe_by_state``: the same from a state store keyed by the event id, so a
  batch costs what it holds, however many events are stored.
- ``release``: rows that wait for members of dimensions are state, too, and
  come out when the last member that they need arrives.
- ``upsert``: ``foreachBatch`` reduces each micro-batch to the latest row per
  key and rewrites only the hash buckets of the table that the batch
  touches, as new folders that one pointer then names; a batch that the
  pointer already holds is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

def read_stream(spark: SparkSession, source_dir: str, schema: str, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(source_dir)


def run_available(stream: DataFrame, checkpoint: str, batch_fn: Callable[[DataFrame, int], None]) -> int:
    """Process everything available now in micro-batches; returns the last batch id."""
    q = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(batch_fn).trigger(availableNow=True).start())
    q.awaitTermination()
    last = q.lastProgress
    return -1 if last is None else int(last["batchId"])


def tail(spark: SparkSession, source_dir: str, schema: str, checkpoint: str, sink_dir: str, run_tag: str) -> None:
    """Append the rows of newly arrived files, tagged with the run, to a
    parquet sink.  Each batch writes its own folder (overwrite on replay)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_dir}/run={run_tag}/batch={batch_id}")
    run_available(read_stream(spark, source_dir, schema), checkpoint, write)


def dedupe(spark: SparkSession, source_dir: str, schema: str, checkpoint: str, sink_dir: str,
           key: Sequence[str], order: Sequence[Column]) -> None:
    """Each key lands once, the first copy by ``order``, however late its
    copies (or a new key's only row) arrive: every micro-batch is reduced to
    the keys that earlier batches haven't stored.  A replayed batch rewrites
    its own folder and looks only at the batches before it."""
    from martflow.operators.tables import path_exists, rows_if_absent

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = spark.createDataFrame([], batch.schema)
        if path_exists(spark, sink_dir):
            stored = spark.read.schema(f"{schema}, batch long").parquet(sink_dir).filter(F.col("batch") < batch_id)
        rows_if_absent(stored.select(*batch.columns), batch, key, order).write.mode("overwrite").parquet(
            f"{sink_dir}/batch={batch_id}")
    run_available(read_stream(spark, source_dir, schema), checkpoint, write)


@contextmanager
def _state_on_disk(spark: SparkSession):
    """State stores of queries started inside are RocksDB: they don't have to fit in memory."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def dedupe_by_state(spark: SparkSession, source_dir: str, schema: str, checkpoint: str, sink_dir: str,
                    key: Sequence[str], order: Sequence[Column]) -> None:
    """As :func:`dedupe`, but what has been stored is known from a state
    store in the checkpoint: per key its first copy and the first and last
    batch that brought it.  Only the keys of a batch are looked up, no stored
    event is read; a key whose first batch is this one is new.  A replayed
    batch has the same batch time and rewrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.filter("first = last").select("row.*").write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")

    events = read_stream(spark, source_dir, schema)
    rows = events.withColumn("_mf_at", F.current_timestamp())
    state = rows.groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in events.columns]), F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])).alias("row"),
                                   F.min("_mf_at").alias("first"), F.max("_mf_at").alias("last"))
    with _state_on_disk(spark):
        q = (state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(write).trigger(availableNow=True).start())
        q.awaitTermination()


def release(rows: DataFrame, members: dict[str, DataFrame], checkpoint: str, sink_dir: str) -> None:
    """T5: streaming ``rows`` joined with streaming members of dimensions (one
    frame per key column of ``rows``, whose first column is the natural key;
    the first arrival of a key counts).  A row waits in the state of the join
    until all its members are there, whichever comes first, and is written
    once; a run takes what has arrived, and the next goes on from the
    checkpoint."""
    spark, out = rows.sparkSession, rows
    for column, dim in members.items():
        natural, rest = dim.columns[0], dim.columns[1:]
        dim = dim.dropDuplicates([natural]).select(F.col(natural).alias(f"_mf_{column}"), *rest)
        out = out.join(dim, F.col(column) == F.col(f"_mf_{column}")).drop(f"_mf_{column}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")

    with _state_on_disk(spark):
        q = (out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .foreachBatch(write).trigger(availableNow=True).start())
        q.awaitTermination()


def upsert_stream(spark: SparkSession, source_dir: str, schema: str, checkpoint: str, table_dir: str,
                  key: Sequence[str], order: Sequence[Column], update_cols: Sequence[str] | None = None,
                  buckets: int | None = None) -> None:
    """Micro-batch upsert into a table kept as hash buckets of the key
    (``upsert_buckets``): a batch costs O(touched buckets), and a replayed
    one is recognised by its checkpoint and batch id and skipped."""
    from martflow.operators.tables import upsert_buckets

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_buckets(table_dir, batch, key, order, schema, update_cols, buckets, batch_id=(checkpoint, batch_id))
    run_available(read_stream(spark, source_dir, schema), checkpoint, apply)
