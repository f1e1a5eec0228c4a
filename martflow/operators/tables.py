"""Table maintenance: pure functions ``(target, source, ...) ->
new_target`` plus writers.  Built-in parquet tables reject MERGE/DELETE, so
an update is a set-based rewrite published as a new snapshot, or, for day
slices, a dynamic partition overwrite that touches only the named days.
Appends (K1) are ``unionByName``; the reference has no other set operation
(O4).  Existence tests (F7) are semi/anti joins: J6 ``not_in``, J7
``close_missing``, J8 ``delete_where_in``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from martflow.functions.scalars import sentinel
from martflow.session import scratch_path

# ---------------------------------------------------------------- appends / slices

BITS = 32_768  # of one bitmap
_CLUSTERED: ContextVar[bool] = ContextVar("martflow_clustered", default=False)


def append_with_defaults(target: DataFrame, source: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """K2: batch insert by column name; a column absent from the source takes
    its declared default (e.g. ``status`` -> 'shipped')."""
    src = source
    for name, value in defaults.items():
        if name not in src.columns:
            dtype = dict(target.dtypes).get(name)
            lit = F.lit(value)
            src = src.withColumn(name, lit.cast(dtype) if dtype else lit)
    return target.unionByName(src, allowMissingColumns=True)


def replace_slice(target: DataFrame, increment: DataFrame, slice_col: Column, slices: Sequence) -> DataFrame:
    """K4 as a pure function: drop the requested slices, insert the increment's
    rows for them.  An empty increment clears its slice, as DELETE+INSERT does."""
    wanted = [F.lit(s) for s in slices]
    keep = target.filter(~slice_col.isin(*wanted))
    return keep.unionByName(increment.filter(slice_col.isin(*wanted)))


@contextmanager
def clustered_slices() -> Iterator[None]:
    """Inside, :func:`write_slices` takes every frame as ``clustered``."""
    token = _CLUSTERED.set(True)
    try:
        yield
    finally:
        _CLUSTERED.reset(token)


def write_slices(df: DataFrame, path: str, slice_col: str, slices: Sequence[str] | None = None,
                 clustered: bool = False) -> None:
    """K4 physical writer: dynamic partition overwrite of ``slice_col`` values.

    Only the partitions present in ``df`` are replaced.  A requested slice with
    no incoming rows is removed explicitly, because dynamic overwrite would
    leave the old day in place.  Which slices have rows is noted by the write
    itself, one bit for each, so no folder is listed.  ``clustered`` says that
    each slice of ``df`` lies in few partitions (:func:`by_slice`): its rows
    are not shuffled again.
    """
    spark, columns = df.sparkSession, df.columns
    wanted = [str(s) for s in slices or ()]
    seen = Observation()
    if wanted:
        # as many rows as the caller names slices
        listed = spark.createDataFrame(list(zip(wanted, range(len(wanted)))), "_mf_slice string, _mf_no int")
        df = df.join(F.broadcast(listed), F.col(slice_col).cast("string") == F.col("_mf_slice"), "left")
        df = df.observe(seen, *[F.bitmap_construct_agg(F.when(F.col("_mf_no").between(lo, lo + BITS - 1), F.col("_mf_no") - lo)).alias(f"b{lo}")
                                for lo in range(0, len(wanted), BITS)]).select(*columns)
    (df if clustered or _CLUSTERED.get() else by_slice(df, slice_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(slice_col).parquet(path)
    if wanted:
        bits = _noted(seen, df)
        for i, name in enumerate(wanted):
            if not bits or not bits[f"b{i // BITS * BITS}"][i % BITS // 8] >> i % 8 & 1:
                _remove_partition(spark, f"{path}/{slice_col}={name}")


def by_slice(df: DataFrame, slice_col: str) -> DataFrame:
    """REBALANCE clusters each slice into few partitions; AQE still splits a hot slice."""
    return df.hint("rebalance", slice_col)


def differing(a: DataFrame, b: DataFrame) -> int:
    """Rows of one frame that the other lacks, copies counted (both EXCEPT ALL
    added up), from one grouping of the rows of both.  Rows are told apart by
    the SHA-256 of all their values as text, each with its length, so that wide
    rows aren't shuffled; no two texts with the same one are known.  For columns
    of plain types; floats are told apart by how they are written."""
    values = [F.col(c).cast("string") for c in a.columns]
    text = F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("null,")) for v in values])
    row = F.unhex(F.sha2(text, 256)).alias("_mf_row")
    both = a.select(row, F.lit(1).alias("_mf_n")).unionByName(b.select(row, F.lit(-1).alias("_mf_n")))
    per_row = both.groupBy("_mf_row").agg(F.sum("_mf_n").alias("_mf_n"))
    return per_row.agg(F.sum(F.abs("_mf_n"))).first()[0] or 0


def _noted(seen: Observation, df: DataFrame) -> dict:
    """The metrics; Spark drops them from a plan that it knows to be empty."""
    try:
        return seen.get
    except Py4JJavaError:
        if not df.isEmpty():
            raise
        return {}


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _remove_partition(spark: SparkSession, part_path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(part_path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)  # false where there is none


def read_slices(spark: SparkSession, path: str, slice_col: str, schema=None) -> DataFrame:
    """Read a slice-partitioned table; a declared schema (including the slice
    column) skips schema and partition-type inference over every slice."""
    r = spark.read.option("basePath", path)
    if schema:
        r = r.schema(schema)
    return r.parquet(path)


def delete_where_in(target: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """DELETE .. WHERE key IN (subquery) as an anti join on distinct keys."""
    cols = [on] if isinstance(on, str) else list(on)
    return target.join(keys.select(*cols).distinct(), cols, "left_anti")


def not_in(probe: DataFrame, probe_col: str, values: DataFrame, value_col: str) -> DataFrame:
    """SQL ``probe_col NOT IN (SELECT value_col ...)`` with its NULL rules,
    without Spark's broadcast-only null-aware anti join (the list may be big):
    a NULL in the list gives no rows; a NULL probe survives only an empty list."""
    lst = values.select(F.col(value_col).alias("_mf_v"))
    flags = lst.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_mf_v").isNull()).alias("nulls")).first()
    if flags["n"] == 0:
        return probe
    if flags["nulls"] > 0:
        return probe.limit(0)
    return probe.filter(F.col(probe_col).isNotNull()).join(
        lst.distinct(), F.col(probe_col) == F.col("_mf_v"), "left_anti")


# ---------------------------------------------------------------- keyed updates


def _one_per_key(source: DataFrame, key: Sequence[str], order: Sequence[Column], last: bool) -> DataFrame:
    """Reduce a batch to one row per key: the last (or first) by ``order``.
    A partial aggregation, so a hot key is combined before the shuffle."""
    payload = [c for c in source.columns if c not in key]
    pick_struct = F.struct(*[F.col(c) for c in payload])
    order_struct = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    pick = (F.max_by if last else F.min_by)(pick_struct, order_struct)
    return source.groupBy(*key).agg(pick.alias("_mf_row")).select(*key, *[F.col(f"_mf_row.{c}").alias(c)
                                                                         for c in payload])


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[Column],
           update_cols: Sequence[str] | None = None, null_keys: bool = False) -> DataFrame:
    """U1 (all columns) / U3 (``update_cols`` only): INSERT .. ON CONFLICT DO
    UPDATE with the batch applied row by row in ``order``: the last row per
    key sets the updated columns, a new key keeps its first row's other
    columns, and a matched source value wins even if it is NULL.

    Written without a full outer join: the target is only anti- or
    left-joined to the (reduced) batch, so when the batch is small AQE
    broadcasts it and the target is scanned, never shuffled; a large batch
    falls back to shuffle joins on the key.  With ``null_keys`` batch rows
    that lack part of the key are all inserted, as NULLs never conflict.
    """
    key = list(key)
    if null_keys:
        whole = F.lit(True)
        for k in key:
            whole = whole & F.col(k).isNotNull()
        return upsert(target, source.filter(whole), key, order, update_cols).unionByName(source.filter(~whole).select(*target.columns))
    if update_cols is None:
        # every column is overwritten by each later row: the last row wins
        src = _one_per_key(source, key, order, last=True)
        keep = target.join(src.select(*key), key, "left_anti")
        return keep.unionByName(src.select(*target.columns))
    # A key new to the target is inserted by its first row; later rows of
    # the batch only overwrite the updated columns.  One aggregation takes
    # the last row's updated columns and the first row's other columns.
    upd = [c for c in update_cols if c not in key]
    rest = [c for c in target.columns if c not in key and c not in upd]
    okey = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    src = source.groupBy(*key).agg(
        F.max_by(F.struct(*[F.col(c) for c in upd]), okey).alias("_mf_last"),
        *([F.min_by(F.struct(*[F.col(c) for c in rest]), okey).alias("_mf_first")] if rest else []),
    )
    vals = src.select(*key, *[F.col(f"_mf_last.{c}").alias(f"_mf_s_{c}") for c in upd], F.lit(True).alias("_mf_src"))
    merged = target.join(vals, key, "left").select(*[
        F.when(F.col("_mf_src").isNotNull(), F.col(f"_mf_s_{c}")).otherwise(F.col(c)).alias(c) if c in upd
        else F.col(c) for c in target.columns])
    inserted = src.join(target.select(*key), key, "left_anti").select(*[
        F.col(c) if c in key else F.col(f"_mf_last.{c}").alias(c) if c in upd else F.col(f"_mf_first.{c}").alias(c)
        for c in target.columns])
    return merged.unionByName(inserted)


def rows_if_absent(target: DataFrame, source: DataFrame, key: Sequence[str],
                   order: Sequence[Column]) -> DataFrame:
    """U2, the rows to add: the first source row per key, for keys not in the
    target.  For an insert-only table append these instead of rewriting it."""
    key = list(key)
    src = _one_per_key(source, key, order, last=False).select(*target.columns)
    return src.join(target.select(*key), key, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, key: Sequence[str],
                     order: Sequence[Column]) -> DataFrame:
    """INSERT .. ON CONFLICT DO NOTHING; the first source row per key wins."""
    return target.unionByName(rows_if_absent(target, source, key, order))


def update_from_lookup(target: DataFrame, lookup: DataFrame, key: str, col: str) -> DataFrame:
    """UPDATE t SET col = (SELECT ..) keeping the old value when the
    lookup has no row (B8)."""
    lk = lookup.select(key, F.col(col).alias("_mf_new"))
    return target.join(lk, key, "left").withColumn(col, F.coalesce("_mf_new", col)).drop("_mf_new") \
        .select(*target.columns)


DEFAULT_BUCKETS = 64
BUCKET_COL = "_bucket"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_pointer(spark: SparkSession, table_dir: str) -> dict | None:
    """The newest state of a bucketed table: its bucket count, the folder of
    each bucket, and the last batch of each stream; None before the first."""
    fs, folder = _fs(spark, f"{table_dir}/_pointers")
    if not fs.exists(folder):
        return None
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    names = sorted(n for n in names if n.endswith(".json"))
    if not names:
        return None
    text = spark.read.text(f"{table_dir}/_pointers/{names[-1]}", wholetext=True).first()[0]
    return json.loads(text) | {"seq": int(names[-1].removesuffix(".json"))}


def _write_pointer(spark: SparkSession, table_dir: str, pointer: dict, seq: int) -> None:
    """One small file, complete before its rename makes it the newest."""
    fs, part = _fs(spark, f"{table_dir}/_pointers/.{seq:012d}-{uuid.uuid4().hex}")
    out = fs.create(part)
    out.write(bytearray(json.dumps(pointer).encode()))
    out.close()
    if not fs.rename(part, _fs(spark, f"{table_dir}/_pointers/{seq:012d}.json")[1]):
        raise RuntimeError(f"another writer has changed {table_dir}")


def upsert_buckets(table_dir: str, batch: DataFrame, key: Sequence[str], order: Sequence[Column],
                   schema, update_cols: Sequence[str] | None = None, buckets: int | None = None,
                   batch_id: tuple[str, int] | None = None, null_keys: bool = False) -> None:
    """U1/U3 applied to a table stored as hash buckets of the key.

    Only the buckets that the batch touches are read and upserted; they are
    written as new folders, and one pointer file then names the folder of
    every bucket.  A crash before the pointer leaves the table as it was, and
    a replay starts from it; ``batch_id`` (stream, number) is kept in the
    pointer, and a batch at or below it is skipped.  The bucket count belongs
    to the table: it is stored with it, size it for the table (a bucket is
    one task's work), and another count is refused.
    """
    spark = batch.sparkSession
    key = list(key)
    pointer = read_pointer(spark, table_dir)
    if pointer is None:
        pointer = {"buckets": buckets or DEFAULT_BUCKETS, "folders": {}, "batches": {}, "seq": 0}
    elif buckets not in (None, pointer["buckets"]):
        raise ValueError(f"{table_dir} has {pointer['buckets']} buckets, not {buckets}")
    if batch_id is not None and pointer["batches"].get(batch_id[0], -1) >= batch_id[1]:
        return
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(pointer["buckets"])).cast("int")
    b = batch.withColumn(BUCKET_COL, bucket)
    touched = [r[0] for r in b.select(BUCKET_COL).distinct().collect()]  # at most the bucket count
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    cols = struct.fieldNames()
    if touched:
        folders = [pointer["folders"][str(t)] for t in touched if str(t) in pointer["folders"]]
        current = spark.read.schema(struct).parquet(*folders) if folders else spark.createDataFrame([], struct)
        merged = upsert(current, b.drop(BUCKET_COL), key, order, update_cols, null_keys).select(*cols).withColumn(BUCKET_COL, bucket)
        version = f"{table_dir}/data/{uuid.uuid4().hex}"
        merged.repartition(BUCKET_COL).write.partitionBy(BUCKET_COL).parquet(version)
        pointer["folders"].update({str(t): f"{version}/{BUCKET_COL}={t}" for t in touched})
    if batch_id is not None:
        pointer["batches"][batch_id[0]] = batch_id[1]
    seq = pointer.pop("seq") + 1
    _write_pointer(spark, table_dir, pointer, seq)


def read_buckets(spark: SparkSession, table_dir: str, schema) -> DataFrame:
    """The current rows of a table kept by :func:`upsert_buckets`."""
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    pointer = read_pointer(spark, table_dir)
    if pointer is None or not pointer["folders"]:
        return spark.createDataFrame([], struct)
    return spark.read.schema(struct).parquet(*pointer["folders"].values())


def retire_buckets(spark: SparkSession, table_dir: str) -> int:
    """Delete the bucket folders that the newest pointer no longer names (when
    no reader of an older state is left); returns how many."""
    pointer = read_pointer(spark, table_dir)
    fs, data = _fs(spark, f"{table_dir}/data")
    if pointer is None or not fs.exists(data):
        return 0
    live = {"/".join(f.rsplit("/", 2)[1:]) for f in pointer["folders"].values()}
    gone = 0
    for version in fs.listStatus(data):
        for part in fs.listStatus(version.getPath()):
            name = part.getPath().getName()
            if name.startswith(BUCKET_COL) and f"{version.getPath().getName()}/{name}" not in live:
                fs.delete(part.getPath(), True)
                gone += 1
    return gone


# ---------------------------------------------------------------- validity ranges


def open_validity(df: DataFrame, active_from: Column, from_col: str = "active_from",
                  to_col: str = "active_to") -> DataFrame:
    """New member valid from ``active_from`` to the far-future sentinel."""
    return df.withColumns({from_col: active_from, to_col: sentinel()})


def close_missing(dim: DataFrame, source_keys: DataFrame, dim_key: str, source_key: str,
                  as_of: str, to_col: str = "active_to") -> DataFrame:
    """``active_to = as_of`` for open members whose key is not in the
    source (NOT EXISTS); rows already closed keep their end (B21)."""
    present = source_keys.select(F.col(source_key).alias("_mf_k")).distinct().withColumn("_mf_seen", F.lit(True))
    j = dim.join(present, F.col(dim_key) == F.col("_mf_k"), "left")
    is_open = F.col(to_col) == sentinel()
    new_to = F.when(F.col("_mf_seen").isNull() & is_open, F.lit(as_of).cast("timestamp_ntz")).otherwise(F.col(to_col))
    return j.withColumn(to_col, new_to).select(*dim.columns)


def versioned_upsert(dim: DataFrame, source: DataFrame, key: str, attrs: Sequence[str], as_of: str,
                     from_col: str = "active_from", to_col: str = "active_to",
                     order: Sequence[Column] | None = None) -> DataFrame:
    """Compare the source with the open version of each member; a changed
    member gets its open version closed at ``as_of`` and a new version opened;
    new members are opened; closed history and unchanged members stay.
    With ``order`` a snapshot holding a member twice is first reduced to its
    last row per key (otherwise the snapshot must be unique per key)."""
    ts = F.lit(as_of).cast("timestamp_ntz")
    if order is not None:
        source = _one_per_key(source, [key], order, last=True)
    is_open = F.col(to_col) == sentinel()
    hist = dim.filter(~is_open)
    cur = dim.filter(is_open)
    src = source.select(key, *[F.col(a).alias(f"_mf_n_{a}") for a in attrs]).withColumn("_mf_src", F.lit(True))
    j = cur.join(src, key, "full_outer")
    changed = F.lit(False)
    for a in attrs:
        changed = changed | ~F.col(a).eqNullSafe(F.col(f"_mf_n_{a}"))
    has_cur, has_src = F.col(to_col).isNotNull(), F.col("_mf_src").isNotNull()
    replaced = has_cur & has_src & changed
    # one pass: each joined row gives its old version (closed if replaced) and/or a new one
    old = F.struct(*[(F.when(replaced, ts).otherwise(F.col(c)) if c == to_col else F.col(c)).alias(c) for c in dim.columns])
    values = {from_col: ts, to_col: sentinel(), key: F.col(key)} | {a: F.col(f"_mf_n_{a}") for a in attrs}
    new = F.struct(*[values.get(c, F.lit(None)).cast(dict(dim.dtypes)[c]).alias(c) for c in dim.columns])
    rows = F.filter(F.array(F.when(has_cur, old), F.when(has_src & (~has_cur | changed), new)), lambda r: r.isNotNull())
    return hist.unionByName(j.select(F.inline(rows)))


# ---------------------------------------------------------------- publish


def publish(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
            buckets: tuple[str, int | None] | None = None, compression: str | None = None) -> DataFrame:
    """Write a new snapshot under the shared folder and return it re-read.

    Writing to a fresh path avoids overwriting a table that the plan still
    reads; the re-read frame has a short lineage (a task retry re-reads files).
    ``buckets`` (column, number) stores it as :func:`append_hashed` does; without a
    number it isn't applied.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if buckets and buckets[1]:
        return append_hashed(df, path, *buckets)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    w.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- hashed tables


DENSE = "compression 'zstd', `parquet.compression.codec.zstd.level` '9'"


@contextmanager
def _in_catalog(spark: SparkSession, path: str, schema: StructType, key: str, n: int) -> Iterator[str]:
    """The folder under a name, as Spark takes buckets from its catalog only;
    the name goes afterwards, the files and the frames read by it stay."""
    name = f"spark_catalog.default.martflow_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS ({DENSE}) CLUSTERED BY (`{key}`) INTO {n} BUCKETS LOCATION '{path}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def append_hashed(df: DataFrame, path: str, key: str, n: int, overwrite: bool = False) -> DataFrame:
    """Append to (or replace) a folder whose rows are dealt to ``n`` files by
    the hash of ``key``, and read it: joins and groupings by ``key`` shuffle no
    row of it.  Rows of ``df`` that come dealt by ``key`` aren't shuffled for
    it; others should be, or every task writes up to ``n`` files."""
    spark = df.sparkSession
    with _in_catalog(spark, path, df.schema, key, n) as name:
        df.write.insertInto(name, overwrite=overwrite)
    return read_hashed(spark, path, df.schema, key, n)


def read_hashed(spark: SparkSession, path: str, schema: StructType, key: str, n: int) -> DataFrame:
    """A folder written by :func:`append_hashed` with the same key and number;
    the schema is given, as there is no file where there was no row."""
    with _in_catalog(spark, path, schema, key, n) as name:
        return spark.table(name)
