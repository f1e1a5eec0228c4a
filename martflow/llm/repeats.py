"""Removal of repeated byte strings (suffix-array deduplication).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
earlier (smaller doc_id, or same document and earlier start).

Every window of ``LENGTH`` bytes has an anchor, the ``GRAM`` bytes in it with
the least hash, so equal windows have equal anchors.  Runs of windows with
one anchor in common are segments; equal segments are equal windows
throughout, so all but the first of them are repeats as they are, without a
look at their text.  The first segments that share an anchor and differ may
still share windows: their texts are fetched, and deep-shallow sorting puts
equal windows side by side, where all but the first are repeats.

Copies fold in the task that finds them before anything is shuffled.  An
anchor in more than ``CROWD`` of all segments is no key to deal by: windows
around it are dealt one by one under the hash of the whole window.  Where
more than ``GROUP`` different first segments still share an anchor, whatever
share of the input that is, their windows are compared by grouping equal ones
instead of in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martflow.llm.frames import written
from martflow.llm.suffix_sort import deep_shallow
from martflow.llm.textops import SubstringHash, mix, signed, U64

LENGTH = 100
GRAM = 32
FOLD = 400_000               # segments folded at once
CROWD = 2e-5
CROWD_LEAST = 1000
GROUP = 50_000               # first segments around one anchor that a task sorts
SORT_BYTES = 4 << 20         # texts sorted at once
TOGETHER = 512 << 10         # texts hashed at once
PIECE = 1 << 20              # a longer text is cut into overlapping pieces
_POS = 24
_SEGMENT = "key long, class long, doc long, start long, size long"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, by doubling."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _segments(data: np.ndarray, row: np.ndarray, length: int, gram: int, crowded: np.ndarray):
    """(key, class, first window, number of windows, anchor after it) of the
    segments of one chunk; windows stay inside a row."""
    n = len(data) - length + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z.astype(U64), z.astype(U64), z, z, z
    hashes = SubstringHash(data)
    p = np.arange(len(data) - gram + 1)
    grams = hashes.of(p, p + gram)
    packed = (grams >> U64(_POS) << U64(_POS)) | p.astype(U64)
    anchor = (_least(packed, length - gram + 1) & U64((1 << _POS) - 1)).astype(np.int64)
    inside = row[:n] == row[length - 1:]
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    end = inside.copy()  # last window of a segment
    end[:-1] &= (anchor[1:] != anchor[:-1]) | ~inside[1:]
    count = np.flatnonzero(end) - start + 1
    key = grams[anchor[start]]
    after = anchor[start] - start
    if len(crowded):
        at = np.minimum(np.searchsorted(crowded, key), len(crowded) - 1)
        hot = crowded[at] == key
        many = count[hot]
        single = np.repeat(start[hot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        own = hashes.of(single, single + length)
        start, count, after = (np.concatenate((x[~hot], y)) for x, y in (
            (start, single), (count, np.ones(len(single), np.int64)), (after, np.zeros(len(single), np.int64))))
        key = np.concatenate((key[~hot], mix(own + U64(0xA0761D6478BD642F))))
    return key, hashes.of(start, start + count + length - 1), start, count, after


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, row of each byte, doc per row, offset of each row in its text)"""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def out():
        row = np.repeat(np.arange(len(held)), [len(x[2]) for x in held])
        data = np.frombuffer(b"".join(x[2] for x in held), dtype=np.uint8)
        return data, row, np.array([x[0] for x in held], np.int64), np.array([x[1] for x in held], np.int64)

    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = text.as_py() or b""
        for lo in range(0, max(len(text) - length + 1, 0), PIECE):
            held.append((doc, lo, text[lo:lo + PIECE + length - 1]))
            size += len(held[-1][2])
            if size >= TOGETHER:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _pack(start: np.ndarray, count: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return start, count << 16 | after


def _folded(batches: Iterator[pa.RecordBatch], length: int, gram: int, crowded: np.ndarray):
    """(firsts, others): the segments of up to ``FOLD`` at a time as arrays
    (key, class, doc, start, count, after); others equal an earlier first."""
    parts: list[list[np.ndarray]] = []
    held = 0

    def fold():
        key, cls, doc, start, count, after = (np.concatenate(x) for x in zip(*parts))
        code = mix(key + cls * U64(0x9E3779B97F4A7C15))
        order = np.lexsort((start, doc, code))
        same = np.zeros(len(order), dtype=bool)
        k, c = key[order], cls[order]  # both words: two segments with one code by chance stay apart
        same[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
        rows = lambda some: tuple(x[some] for x in (key, cls, doc, start, count, after))
        return rows(order[~same]), rows(order[same])

    for b in batches:
        for data, row, docs, offset in _pieces(b, length):
            key, cls, start, count, after = _segments(data, row, length, gram, crowded)
            first = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(docs)))))
            mine = row[start]
            parts.append([key, cls, docs[mine], start - first[mine] + offset[mine], count, after])
            held += len(key)
            if held >= FOLD:
                yield fold()
                parts, held = [], 0
    if parts:
        yield fold()


def _covered(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans with those that touch or overlap in one document made one."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    new_doc = np.concatenate(([True], doc[1:] != doc[:-1]))
    # running maximum of stop within a document
    rank = np.cumsum(new_doc)
    base = rank * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + base) - base
    new = new_doc.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], start[at], reach[np.concatenate((at[1:] - 1, [len(doc) - 1]))]


def _crowded(texts: DataFrame, length: int, gram: int, crowd: float, least: int) -> np.ndarray:
    """Anchors of more than ``crowd`` of all different segments, sorted.

    A task reports an anchor with its share of half of ``crowd`` or more; an
    anchor of that share of all segments has at least half of it in such
    reports, so none is missed, and at most 2 / crowd are kept.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, *_), _others in _folded(batches, length, gram, np.zeros(0, U64)):
            keys, n = np.unique(key, return_counts=True)
            some = n >= max(2, crowd / 2 * len(key))
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys[some])), pa.array(n[some]), pa.array(np.zeros(int(some.sum()), np.int64))],
                                             names=["key", "n", "total"])
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([0], pa.int64()), pa.array([len(key)], pa.int64())],
                                             names=["key", "n", "total"])

    counts = written(texts.mapInArrow(run, "key long, n long, total long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "anchors")
    total = counts.agg(F.sum("total")).first()[0] or 0
    kept = counts.where(F.col("n") >= max(least, crowd / 2 * total)).select("key").toPandas()["key"]
    return np.sort(kept.to_numpy(np.int64).view(np.uint64))


def _dealt(texts: DataFrame, length: int, gram: int, crowded: np.ndarray) -> DataFrame:
    """First segments of each task (size > 0) and, with size -1 and the stop
    for a class, spans already known to repeat."""
    sent = texts.sparkSession.sparkContext.broadcast(crowded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _SEGMENT.split(", ")]
        for (key, cls, doc, start, count, after), (_, _, doc2, start2, count2, _) in _folded(batches, length, gram, sent.value):
            start, size = _pack(start, count, after)
            yield pa.RecordBatch.from_arrays([pa.array(signed(x)) for x in (key, cls)] + [pa.array(x) for x in (doc, start, size)], names=names)
            doc, start, stop = _covered(doc2, start2, start2 + count2 + length - 1)
            spread = mix(doc.view(np.uint64) + start.view(np.uint64))  # any partition will do
            yield pa.RecordBatch.from_arrays([pa.array(signed(spread)), pa.array(stop), pa.array(doc), pa.array(start),
                                              pa.array(np.full(len(doc), -1))], names=names)

    return texts.mapInArrow(run, _SEGMENT)


def _runs(columns: int):
    """Whole runs of equal first column out of sorted batches, as arrays."""
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        held: list[np.ndarray] | None = None
        for b in batches:
            new = [np.asarray(b.column(i)) for i in range(columns)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if not len(held[0]):
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield [x[:cut] for x in held]
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield held
    return groups


def _resolved(dealt: DataFrame, length: int) -> DataFrame:
    """(doc, start, stop, key, size): spans that repeat (key null), and the
    first segments whose anchor other first segments have too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, cls, doc, start, size in _runs(5)(batches):
            segment = size >= 0
            known = doc[~segment], start[~segment], cls[~segment]
            key, cls, doc, start, size = (x[segment] for x in (key, cls, doc, start, size))
            new_key = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
            first = new_key.copy()
            if len(key):
                first[1:] |= cls[1:] != cls[:-1]
            again = ~first
            spans = [np.concatenate(x) for x in zip(known, (doc[again], start[again], start[again] + (size[again] >> 16) + length - 1))]
            of = np.cumsum(new_key) - 1
            shared = first & (np.bincount(of, first)[of] > 1) if len(key) else first
            spans = _covered(*spans)
            n = len(spans[0])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((spans[0], doc[shared]))), pa.array(np.concatenate((spans[1], start[shared]))),
                pa.array(np.concatenate((spans[2], start[shared] + (size[shared] >> 16) + length - 1))),
                pa.array(np.concatenate((np.zeros(n, np.int64), key[shared])), mask=np.arange(n + int(shared.sum())) < n),
                pa.array(np.concatenate((np.zeros(n, np.int64), size[shared])))], names=["doc", "start", "stop", "key", "size"])

    ordered = dealt.repartition("key").sortWithinPartitions("key", "class", "doc", "start")
    return written(ordered.mapInArrow(run, "doc long, start long, stop long, key long, size long"), "segments")


def _sorted_repeats(length: int):
    def find(key: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, texts: list[bytes]):
        count, after = size >> 16, size & 0xFFFF
        base = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1]))
        data = np.frombuffer(b"".join(texts) + bytes(16), dtype=np.uint8)
        segment = np.repeat(np.arange(len(key)), count)
        j = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
        # equal windows have their anchor at the same distance
        number = np.cumsum(np.concatenate(([0], np.diff(key) != 0)))[segment]
        order, run = deep_shallow(data, base[segment] + j, number << 17 | (after[segment] - j + (1 << 16)), length)
        seg = segment[order]
        at = start[seg] + j[order]
        least = np.lexsort((at, doc[seg], run))
        repeat = np.zeros(len(run), dtype=bool)
        repeat[least[1:]] = run[least[1:]] == run[least[:-1]]
        return _covered(doc[seg[repeat]], at[repeat], at[repeat] + length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        size = 0

        def out():
            spans = find(*(np.array(x, dtype=np.int64) for x in held[:4]), held[4])
            return pa.RecordBatch.from_arrays([pa.array(x) for x in spans], names=["doc", "start", "stop"])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(5))):
                if size >= SORT_BYTES and row[0] != held[0][-1]:
                    yield out()
                    held, size = [[], [], [], [], []], 0
                for x, v in zip(held, row):
                    x.append(v)
                size += len(row[4])
        if held[0]:
            yield out()

    return run


def _windows(length: int):
    """(key, doc, start, size, piece) to every window (window, doc, start) of the pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, start, piece in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(4).to_pylist()):
                n = len(piece) - length + 1
                yield pa.RecordBatch.from_arrays([pa.array([piece[i:i + length] for i in range(n)], pa.binary()), pa.array(np.full(n, doc)),
                                                  pa.array(np.arange(start, start + n))], names=["window", "doc", "start"])

    return run


def _equal_windows(pieces: DataFrame, length: int) -> DataFrame:
    """(doc, start, stop): windows of the pieces that an earlier one equals."""
    windows = written(pieces.mapInArrow(_windows(length), "window binary, doc long, start long"), "crowded-windows")
    first = windows.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = windows.join(first.select("window", "first"), "window").where(F.struct("doc", "start") != F.col("first"))
    return again.select("doc", "start", (F.col("start") + length).alias("stop"))


def _repeats(texts: DataFrame, length: int, gram: int, crowd: float, least: int, group: int) -> DataFrame:
    """(doc, start, stop): spans that cover exactly the bytes to remove."""
    found = _resolved(_dealt(texts, length, gram, _crowded(texts, length, gram, crowd, least)), length)
    large = written(found.where("key is not null").groupBy("key").count().where(F.col("count") > group).select("key"), "crowded-anchors")
    asked = found.where("key is not null").withColumnRenamed("doc", "asked")
    piece = texts.join(asked, F.col("doc") == F.col("asked")).select(
        "key", "doc", "start", "size", F.substr("body", (F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int")).alias("piece"))
    crowded = bool(large.take(1))
    few = piece.join(large, "key", "left_anti") if crowded else piece
    compared = few.repartition("key").sortWithinPartitions("key", "doc", "start").mapInArrow(
        _sorted_repeats(length), "doc long, start long, stop long")
    if crowded:
        compared = compared.unionByName(_equal_windows(piece.join(large, "key", "left_semi"), length))
    return found.where("key is null").select("doc", "start", "stop").unionByName(compared)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for doc, body, spans in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            body, spans = body.as_py() or b"", spans.as_py() or []
            one = np.zeros(len(spans), np.int64)
            _, start, stop = _covered(one, np.array([s["start"] for s in spans], np.int64), np.array([s["stop"] for s in spans], np.int64))
            kept, at = [], 0
            for a, e in zip(start.tolist(), stop.tolist()):
                kept.append(body[at:a])
                at = e
            kept.append(body[at:])
            rest = b"".join(kept)
            for x, v in zip(out, (doc, len(body), len(body) - len(rest), len(start), hashlib.sha256(rest).hexdigest())):
                x.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(),) * 4 + (pa.string(),))],
                                         names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_bytes(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: float = CROWD, least: int = CROWD_LEAST,
                   group: int = GROUP) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept_sha256) of ``texts`` (doc long,
    body binary), whose ``doc`` is unique and gives the order."""
    # an inner join would add this to its own side only, and the two shuffles of the texts couldn't be one
    texts = texts.where("doc is not null")
    spans = _repeats(texts, length, gram, crowd, least, group).groupBy("doc").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")).withColumnRenamed("doc", "of")
    joined = texts.join(spans, F.col("doc") == F.col("of"), "left").select("doc", "body", "spans")
    return joined.mapInArrow(_removed, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null texts are empty ones; texts shorter than the length lose nothing.
    Rows that share an id come in the order of their texts, equal ones one
    after the other, so all but the first of equal rows go whole; rows
    without an id come first.  Other columns aren't read; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    shared = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not shared:
        return repeated_bytes(rows.withColumnRenamed("doc_id", "doc"), **how).withColumnRenamed("doc", "doc_id")
    from martflow.operators.keys import assign_keys
    # equal rows fold before the shuffle; the numbers follow id and text
    folded = written(rows.groupBy("doc_id", F.sha2("body", 256).alias("digest")).agg(F.min("body").alias("body"), F.count("*").alias("n")), "folded")
    ids = assign_keys(folded.select("doc_id", "digest"), [F.col("doc_id").asc_nulls_first(), "digest"], key="doc")
    ids = ids.select("doc", F.col("doc_id").alias("id2"), F.col("digest").alias("digest2"))
    named = written(folded.join(ids, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("digest2")))
                    .select("doc", "doc_id", "body", "n"), "numbered")
    found = repeated_bytes(named.select("doc", "body"), **how).withColumnRenamed("doc", "of")
    length = how.get("length", LENGTH)
    gone = (F.col("copy") > 1) & (F.col("n_bytes") >= length)
    each = named.drop("body").join(found, F.col("doc") == F.col("of")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select("doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
                       F.when(gone, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
                       F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))
