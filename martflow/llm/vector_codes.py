"""Vector codes: each vector is cut into parts, and each part is stored as the
number of its nearest codebook entry.

The codebooks are made by member-resident Lloyd rounds.  The parts of all
vectors lie in partitions by (position, entry, salt), the owners of an entry's
members.  In each round the owners sum up the members that reside with them,
the sums of an entry's owners meet in one small row, and the new entries
(parts x entries rows, a fixed number) go to all tasks.  A part whose nearest
entry is still the same stays where it is; only those that change entry
migrate to their new owner in the next shuffle, and are united with the
residents of the same partitioning, which don't move.

The salt follows the batch of the input that a part comes from, so an entry
that draws most parts has owners in all partitions; equal parts of a batch are
one member with a weight.  Members carry no ids: the vectors are encoded at
the end in one pass over the table with the final codebooks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from martflow.llm.frames import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 28              # integers beyond it are taken as it: squares and their sums stay exact
HELD = 1 << 16               # migrating parts that a task holds before it passes them on
LABELS = 100_000             # labels whose sums are sent to every task; more of them meet their rows in a shuffle

Key = tuple[int, int, int]
Block = tuple[bytes, bytes]
Codebooks = list[np.ndarray]


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * vectors), -LIMIT, LIMIT).astype(np.int64)


def cuts(dim: int, parts: int) -> list[int]:
    """Edges of the parts; all equal where ``parts`` divides ``dim``."""
    return [dim * i // parts for i in range(parts + 1)]


def nearest(values: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the nearest entry (the lowest of equal ones) and its squared distance."""
    off = (codebook * codebook).sum(axis=1)[None, :] - 2 * (values @ codebook.T)
    entry = off.argmin(axis=1)
    return entry, off[np.arange(len(values)), entry] + (values * values).sum(axis=1)


def _packed(values: np.ndarray, weights: np.ndarray) -> Block:
    return values.astype(np.int32).tobytes(), weights.astype(np.int64).tobytes()


def _unpacked(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    weights = np.frombuffer(block[1], dtype=np.int64)
    return np.frombuffer(block[0], dtype=np.int32).reshape(len(weights), width).astype(np.int64), weights


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dim)


def _owner(key: Key) -> int:
    position, entry, salt = key
    return position * 1009 + entry * 31 + salt


def _first_members(kept: DataFrame, codebooks: Codebooks, partitions: int) -> DataFrame:
    """Blocks of parts under the first codebooks: position, entry, salt, parts, weights."""
    dim = sum(c.shape[1] for c in codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() * 7919
        for b in batches:
            if not len(b.column(0)):
                continue
            values, at, rows = integers(_matrix(b.column(0), dim)), 0, []
            for position, codebook in enumerate(codebooks):
                width = codebook.shape[1]
                part, weights = np.unique(values[:, at:at + width], axis=0, return_counts=True) if width else (values[:1, :0], np.array([len(values)]))
                at += width
                entry, _ = nearest(part, codebook)
                rows += [(position, int(e), salt % partitions, *_packed(part[entry == e], weights[entry == e])) for e in np.unique(entry)]
            salt += 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["position", "entry", "salt", "parts", "weights"])

    return kept.select("vector").mapInArrow(run, "position long, entry long, salt long, parts binary, weights binary")


def _sums(codebooks: Codebooks):
    """Per partition: number and component sums of the members of each entry."""
    def run(members: Iterator[tuple[Key, Block]]) -> Iterator[tuple[tuple[int, int], tuple[int, list[int]]]]:
        held: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for (position, entry, _), block in members:
            values, weights = _unpacked(block, codebooks[position].shape[1])
            new = (int(weights.sum()), (weights @ values).tolist())
            held[position, entry] = _added(held[position, entry], new) if (position, entry) in held else new
        yield from held.items()

    return run


def _added(a: tuple[int, list[int]], b: tuple[int, list[int]]) -> tuple[int, list[int]]:
    return a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]


def _staying(codebooks: Codebooks):
    """The members that the new codebooks leave with their owner."""
    def run(members: Iterator[tuple[Key, Block]]) -> Iterator[tuple[Key, Block]]:
        for key, block in members:
            values, weights = _unpacked(block, codebooks[key[0]].shape[1])
            stay = nearest(values, codebooks[key[0]])[0] == key[1]
            if stay.all():
                yield key, block
            elif stay.any():
                yield key, _packed(values[stay], weights[stay])

    return run


def _leaving(codebooks: Codebooks):
    """The members that change entry, in blocks for their new owners."""
    def run(members: Iterator[tuple[Key, Block]]) -> Iterator[tuple[Key, Block]]:
        held: dict[tuple[int, int], list] = {}
        n = salt = 0

        def out():
            for (position, entry), blocks in held.items():
                yield (position, entry, salt), _packed(*(np.concatenate(x) for x in zip(*blocks)))

        for key, block in members:
            position, old, salt = key
            values, weights = _unpacked(block, codebooks[position].shape[1])
            entry, _ = nearest(values, codebooks[position])
            for e in np.unique(entry[entry != old]).tolist():
                some = entry == e
                held.setdefault((position, e), []).append((values[some], weights[some]))
                n += int(some.sum())
            if n >= HELD:
                yield from out()
                held, n = {}, 0
        yield from out()

    return run


def _updated(codebooks: Codebooks, members: RDD) -> Codebooks:
    """Entries replaced by the mean of their resident members, rounded down."""
    new = [c.copy() for c in codebooks]
    sums = members.mapPartitions(_sums(codebooks)).reduceByKey(_added, min(members.getNumPartitions(), 128))
    for (position, entry), (count, total) in sums.collect():  # one row per position and entry
        new[position][entry] = [x // count for x in total]
    return new


def trained(kept: DataFrame, codebooks: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after ``rounds`` rounds over the vectors of ``kept`` (vector)."""
    partitions = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = _first_members(kept, codebooks, partitions).rdd.map(
        lambda r: ((r.position, r.entry, r.salt), (bytes(r.parts), bytes(r.weights))))
    members = first.partitionBy(partitions, _owner).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for i in range(rounds):
            if i:
                movers = members.mapPartitions(_leaving(codebooks)).partitionBy(partitions, _owner)
                stayers = members.mapPartitions(_staying(codebooks), preservesPartitioning=True)
                before, members = members, stayers.union(movers).persist(StorageLevel.MEMORY_AND_DISK)
                codebooks = _updated(codebooks, members)
                before.unpersist()
            else:
                codebooks = _updated(codebooks, members)
    finally:
        members.unpersist()
    return codebooks


def _encoded(kept: DataFrame, codebooks: Codebooks) -> DataFrame:
    dim = sum(c.shape[1] for c in codebooks)
    digits = 2 if all(len(c) <= 256 for c in codebooks) else 8
    schema = StructType([kept.schema["vec_id"], kept.schema["label"], StructField("code", StringType()), StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([f"{i:0{digits}x}" for i in range(max(map(len, codebooks)))])
        for b in batches:
            values, at = integers(_matrix(b.column(2), dim)), 0
            code, error = np.full(len(values), "", dtype=f"U{digits * len(codebooks)}"), np.zeros(len(values), np.int64)
            for codebook in codebooks:
                entry, off = nearest(values[:, at:at + codebook.shape[1]], codebook)
                at += codebook.shape[1]
                code = np.char.add(code, names[entry])
                error += off
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code.tolist(), pa.string()), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    return kept.select("vec_id", "label", "vector").mapInArrow(run, schema)


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """((vec_id, label, code, error, label_error), codebooks): one row per vector kept.

    Rows whose vector is null or holds null, NaN or infinite components go,
    and so do those of another length than the smallest id's.  The codebooks
    start as the parts of the ``entries`` smallest ids (null ids last, equal
    ids by vector; fewer rows make fewer entries).  A length that ``parts``
    doesn't divide gives parts that differ by one component; components
    beyond 65,536 count as 65,536.  Repeated rows and ids come back
    repeated, each row counting by itself; null labels are one label; other
    columns aren't read; an empty table gives an empty result and no
    codebooks.
    """
    numbers = F.col(vector_col).cast("array<double>")
    sound = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = vectors.where(F.col(vector_col).isNotNull()).where(sound).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), numbers.alias("vector"))
    order = F.col("vec_id").asc_nulls_last(), F.col("vector")
    seeds = kept.orderBy(*order).limit(entries).collect()
    if not seeds:
        return _with_label_errors(kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))), []
    dim = len(seeds[0].vector)
    kept = kept.where(F.size("vector") == dim)
    if any(len(r.vector) != dim for r in seeds):
        seeds = kept.orderBy(*order).limit(entries).collect()
    values, edges = integers(np.array([r.vector for r in seeds], dtype=np.float64).reshape(len(seeds), dim)), cuts(dim, parts)
    codebooks = trained(kept, [values[:, a:e].copy() for a, e in zip(edges, edges[1:])], rounds)
    return _with_label_errors(written(_encoded(kept, codebooks), "codes")), codebooks


def _with_label_errors(rows: DataFrame) -> DataFrame:
    sums = written(rows.groupBy(F.col("label").alias("sum_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    sums = F.broadcast(sums) if sums.count() <= LABELS else sums
    return rows.join(sums, F.col("label").eqNullSafe(F.col("sum_label"))).drop("sum_label")


def listed(codebooks: Codebooks) -> str:
    """All components by part, entry and position within the part."""
    return ",".join(str(x) for c in codebooks for entry in c.tolist() for x in entry)
