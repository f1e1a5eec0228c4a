"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components.

Fingerprints that differ in at most d bits agree in at least B - d of B
blocks, so each distinct fingerprint is dealt out under the C(B, d) choices
of B - d blocks and compared only with those that share one.  B follows from
the number of distinct fingerprints, so that chance companions per
fingerprint stay bounded; every B gives the same links.  Copies collapse to
one fingerprint before anything is dealt, a group's links come out as a star
(never as all pairs), and a group above ``GROUP_ROWS`` is linked through the
words half-way between two fingerprints instead, which spreads it over all
tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm.components import components
from martflow.llm.frames import digest, written

SEED = 42
GROUP_ROWS = 4096            # largest group compared in one task
COMPANIONS = 1024            # chance companions per fingerprint and deal
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())),
                             dtype=np.uint64, count=len(starts))
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[lo:lo + (1 << 16)].astype("<u8")).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; a null or blank text has fp 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """The bits that a pair within ``distance`` shares under one of these masks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def blocks_for(n: int, distance: int) -> int:
    """Fewest blocks that keep the expected chance companions within bounds."""
    for blocks in range(distance + 1, 64):
        masks = block_masks(blocks, distance)
        narrowest = min(m.bit_count() for m in masks)
        if n * len(masks) / 2.0 ** narrowest <= COMPANIONS:
            return blocks
    return 64


def _as_long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _group_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of one group as stars: each member to the least of its component."""
    m = len(fps)
    near = np.zeros(m, dtype=bool)
    step = max(1, (1 << 20) // m)
    for lo in range(0, m, step):
        close = np.bitwise_count(fps[lo:lo + step, None] ^ fps[None, :]) <= distance
        near[lo:lo + step] = close.sum(axis=1) > 1
    left = np.sort(fps[near])
    out: list[tuple[int, int]] = []
    while len(left):
        root, frontier, left = int(left[0]), left[:1], left[1:]
        while len(frontier) and len(left):
            hit = np.zeros(len(left), dtype=bool)
            step = max(1, (1 << 20) // len(left))
            for lo in range(0, len(frontier), step):
                hit |= (np.bitwise_count(frontier[lo:lo + step, None] ^ left[None, :]) <= distance).any(axis=0)
            frontier, left = left[hit], left[~hit]
            out += [(int(f), root) for f in frontier]
    return out


def _link_groups(distance: int):
    """Per partition sorted by (k, fp): the links of each run of equal k."""
    def emit(keys: np.ndarray, fps: np.ndarray) -> Iterator[tuple[int, int]]:
        cuts = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
        for g in np.flatnonzero(ends - starts > 1):
            yield from _group_links(np.unique(fps[starts[g]:ends[g]]), distance)

    def table(links: list[tuple[int, int]]) -> pa.RecordBatch:
        pair = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for b in batches:
            keys = np.concatenate((keys, np.asarray(b.column(0))))
            fps = np.concatenate((fps, np.asarray(b.column(1)).view(np.uint64)))
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last group may go on
            if cut:
                yield table(list(emit(keys[:cut], fps[:cut])))
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield table(list(emit(keys, fps)))

    return run


def _flips(radius: int) -> list[int]:
    return [_as_long(sum(1 << i for i in bits)) for r in range(radius + 1) for bits in combinations(range(64), r)]


def half_way_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links among ``fps`` (fp) without comparing pairs: two fingerprints are
    within d bits exactly if some word is within d // 2 bits of one and within
    the rest of the other.  All that reach a word are tied to the least of
    those that are at most d // 2 from it."""
    near, far = distance // 2, distance - distance // 2
    masks = F.array(*[F.lit(m) for m in _flips(far)])
    n_near = len(_flips(near))
    reach = fps.select("fp", F.posexplode(masks).alias("i", "mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("word"), (F.col("i") < n_near).alias("near"))
    hubs = reach.groupBy("word").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.count("*").alias("n"))
    hubs = hubs.where("n > 1 and hub is not null").select("word", "hub")
    return reach.join(hubs, "word").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def links(fps: DataFrame, distance: int, group_rows: int = GROUP_ROWS, blocks: int | None = None) -> DataFrame:
    """(a, b) longs: links whose components are those of all pairs of distinct
    ``fps`` (fp) that differ in at most ``distance`` bits."""
    blocks = blocks or blocks_for(fps.count(), distance)
    keys: list[Column] = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_as_long(m))))
                          for i, m in enumerate(block_masks(blocks, distance))]
    dealt = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k", "fp")
    hot = written(dealt.groupBy("k").count().where(F.col("count") > group_rows).select("k"), "hot-blocks")
    crowded = bool(hot.take(1))
    some = dealt.join(hot, "k", "left_anti") if crowded else dealt
    found = some.repartition("k").sortWithinPartitions("k", "fp").mapInArrow(_link_groups(distance), "a long, b long")
    if crowded:
        found = found.unionByName(half_way_links(dealt.join(hot, "k", "left_semi").select("fp").distinct(), distance))
    return found


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most
    ``distance`` differing bits, the row's own included.  Null and blank
    texts have fingerprint 0 and link like any other; a null doc_id is never
    the smallest; repeated rows come back repeated; extra columns are not
    read.
    """
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    comps = components(links(distinct.select("fp"), distance, group_rows))
    rooted = distinct.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = written(rooted, "rooted")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the
    smallest doc_id (of rows that share it, the smallest text digest, then the
    smallest row).

    Rows are told apart by id and text, so different texts under one id stay
    unless they are duplicates themselves; rows without a doc_id are kept as
    they are, null and blank texts are one group; an empty table stays empty;
    other columns stay as they are.
    """
    named = docs.where(F.col(id_col).isNotNull())
    key = [F.col(id_col).cast("long").alias("keep_id"), digest(F.col(text_col)).alias("keep_text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["keep_id", "keep_text", "fp"])

    rows = written(named.select(*key, F.col(text_col).alias("text")).mapInArrow(run, "keep_id long, keep_text binary, fp long"), "fingerprints")
    distinct = written(rows.select("fp").distinct(), "distinct-fingerprints")
    comps = components(links(distinct, distance)).withColumnRenamed("node", "fp")
    rooted = rows.join(comps, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    one = F.min(F.struct("keep_id", "keep_text"))
    keep = written(rooted.groupBy("root").agg(one.alias("k")).select("k.*"), "kept-rows")
    kept = named.select(*key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(keep, ["keep_id", "keep_text"], "left_semi")
    # rows that agree in id and text count as one
    repeated = written(rows.join(keep, ["keep_id", "keep_text"], "left_semi").groupBy("keep_id", "keep_text").count().where("count > 1"), "repeated-rows")
    if repeated.take(1):
        once = kept.join(repeated, ["keep_id", "keep_text"], "left_anti")
        again = kept.join(repeated, ["keep_id", "keep_text"], "left_semi").groupBy("keep_id", "keep_text").agg(F.min("row").alias("row"))
        kept = once.unionByName(again)
    return kept.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
