"""Benchmark decontamination by winnowing.

Both sides keep the least k-gram hash of every window of w k-grams (the
rightmost of equal ones), so any span of t = w + k - 1 shared words has a
fingerprint that both sides keep.  A span of t words around a fingerprint
reaches at most t - k words beyond it; those words travel with the
fingerprint, which is extended in each way in which a span can lie around it.
Fingerprints join on their hash together with the extended text, so a phrase
that many items share makes no candidates: what joins is a shared span.
Items shorter than t words are one window of their own length, looked up at
every position of the documents.

Before the join, documents' fingerprints pass a bitmap of the benchmark's
hash prefixes.  The bitmap has a fixed size and only spares rows: nothing it
lets through wrongly survives the join, nothing it stops could have joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm.frames import digest, written
from martflow.llm.textops import SubstringHash, chunks, fill_text, lower, mix, signed, sliding_min_positions, word_spans, U64

SPAN = 10                    # words of a window: the guaranteed span
GRAM = 5
PREFIX_BITS = 22
BROADCAST_ROWS = 50_000      # fingerprint contexts of the benchmark sent to every task

_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = True
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True
_HIT = "struct<h: long, at: int, size: int, before: array<string>, gram: string, after: array<string>>"
_HITS = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("before", pa.list_(pa.string())),
                            ("gram", pa.string()), ("after", pa.list_(pa.string()))]))
_ROWS = f"uid long, id long, n_words long, hits array<{_HIT}>"


def _gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    if n <= 0:
        return words[:0]
    h = np.full(n, size, dtype=U64)
    for j in range(size):
        h = h * U64(0x100000001B3) + words[j:j + n]
    return mix(h)


def _scan(span: int, gram: int, short: list[int], whole_short: bool, passes: np.ndarray | None):
    """Rows with their kept fingerprints.  ``whole_short``: rows of fewer than
    ``span`` words give one fingerprint, the whole (the benchmark's side);
    else every run of a length in ``short`` is one (the documents' side)."""
    reach = span - gram

    def positions(words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(words of a gram, words to carry beside it, positions, hashes)"""
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        inside = lambda at, size: row[at] == row[at + size - 1]
        h = _gram_hashes(words, gram)
        at = sliding_min_positions(h, span - gram + 1)
        if len(at):
            at = np.unique(at[inside(np.arange(len(at)), span)])
            yield gram, reach, at, h[at]
        if whole_short:
            for size in range(1, span):
                at = first[:-1][np.diff(first) == size]
                if len(at):
                    yield size, 0, at, ~_gram_hashes(words, size)[at]
        else:
            for size in short:
                h = ~_gram_hashes(words, size)
                at = np.arange(len(h))
                at = at[inside(at, size)] if len(h) else at
                yield size, 0, at, h[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for b in batches:
            for lo, hi, data, offsets in chunks(fill_text(b.column(1))):
                data = lower(data)
                starts, ends, first = word_spans(_WORD[data], offsets)
                hits: list[list[dict]] = [[] for _ in range(hi - lo)]
                raw = data.tobytes()
                word = lambda i: raw[starts[i]:ends[i]].decode()
                for size, side, at, h in positions(SubstringHash(data).of(starts, ends), first):
                    if passes is not None:
                        some = passes[(h >> U64(64 - PREFIX_BITS)).astype(np.int64)]
                        at, h = at[some], h[some]
                    rows = np.searchsorted(first, at, side="right") - 1
                    for i, r, x in zip(at.tolist(), rows.tolist(), signed(h).tolist()):
                        hits[r].append({
                            "h": x, "at": i - int(first[r]), "size": size,
                            "before": [word(j) for j in range(i - 1, max(i - 1 - side, int(first[r]) - 1), -1)],
                            "gram": " ".join(word(j) for j in range(i, i + size)),
                            "after": [word(j) for j in range(i + size, min(i + size + side, int(first[r + 1])))]})
                n = hi - lo
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + n)), b.column(0).slice(lo, n),
                                                  pa.array(np.diff(first)), pa.array(hits, _HITS)],
                                                 names=["uid", "id", "n_words", "hits"])
                uid += n

    return run


def scanned(df: DataFrame, id_col: str, text_col: str, short: list[int] | None = None, passes=None,
            span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(uid, id, n_words, hits) per row, written."""
    run = _scan(span, gram, short or [], short is None, passes)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(run, _ROWS), "winnowed")


def _extended(marks: DataFrame, span: int, *keep: str) -> DataFrame:
    """Rows (h, size, before, gram, after) to one row per span of ``span`` words
    around them: ``keep``, h, lead (words before the gram) and the span's text.
    A gram without words beside it is a short item's."""
    around = """
        if(size(before) + size(after) = 0, array(named_struct('lead', 0, 'text', gram)),
           transform(filter(sequence(0, {span} - size), l -> l <= size(before) and {span} - size - l <= size(after)),
                     l -> named_struct('lead', l, 'text', concat_ws(' ', reverse(slice(before, 1, l)), gram, slice(after, 1, {span} - size - l)))))
    """.format(span=span)
    return marks.select(*keep, "h", F.explode(F.expr(around)).alias("w")).select(*keep, "h", "w.lead", "w.text")


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", span: int = SPAN, gram: int = GRAM, key: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, spans, members): ``rows`` (uid, id, n_words) has each row of
    ``docs``; ``spans`` (uid, start, stop, cls) the shared word spans found,
    stop exclusive; ``members`` (cls, item_id) the items with that passage.
    ``key`` takes the place of the id."""
    spark = docs.sparkSession
    test = scanned(items, item_col, item_text_col, span=span, gram=gram)
    marks = test.select(F.col("id").alias("item_id"), F.explode("hits").alias("x")).select("item_id", "x.*")
    windows = _extended(marks, span, "item_id").withColumn("cls", F.sha2("text", 256))
    members = windows.select("cls", "item_id").distinct()
    classes = written(windows.select("cls", "h", "lead", "text").distinct(), "passages")
    # a gram of an item of a whole span has words beside it; one without is a short item
    short = [r[0] for r in marks.where("size(before) + size(after) = 0").select("size").distinct().collect()]
    # at most 2**PREFIX_BITS values, whatever the benchmark's size
    prefixes = classes.select(F.shiftrightunsigned("h", 64 - PREFIX_BITS).cast("int").alias("p")).distinct().toPandas()["p"]
    passes = np.zeros(1 << PREFIX_BITS, dtype=bool)
    passes[prefixes.to_numpy(dtype=np.int64)] = True
    sent = spark.sparkContext.broadcast(np.packbits(passes))

    def run(batches):
        return _scan(span, gram, short, False, np.unpackbits(sent.value).astype(bool))(batches)

    rows = docs.select((F.col(id_col).cast("long") if key is None else key).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = written(rows.mapInArrow(run, _ROWS.replace("id long, n_words", f"id {kind}, n_words")), "winnowed")
    hits = rows.where(F.size("hits") > 0).select("uid", F.explode("hits").alias("x")).select("uid", "x.*")
    side = F.broadcast(classes) if classes.count() <= BROADCAST_ROWS else classes
    # the same span lies around the gram of both sides in the same way
    found = _extended(hits, span, "uid", "at").join(side, ["h", "lead", "text"])
    words = F.size(F.split("text", " "))
    start = F.col("at") - F.col("lead")
    spans = found.select("uid", start.alias("start"), (start + words).alias("stop"), "cls").distinct()
    return rows.drop("hits"), written(spans, "shared-spans"), members


def contamination(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence
    of a window), n_items, items_sha256, contaminated.

    Null and empty texts have no words; a null or empty item has no window; a
    null item_id counts as no item; equal items count each; repeated
    documents come back repeated; an empty benchmark leaves all clean.
    """
    rows, spans, members = matches(docs, items, **columns)
    hit = spans.select("uid", F.explode(F.sequence("start", F.col("stop") - 1)).alias("at")).distinct().groupBy("uid").agg(F.count("*").alias("n_hit"))
    seen = spans.select("uid", "cls").distinct().join(members, "cls").select("uid", "item_id").distinct().where("item_id is not null")
    held = seen.groupBy("uid").agg(F.count("*").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(F.col("item_id").cast("string")))), 256).alias("items_sha256"))
    zero = F.lit(0).cast("long")
    return rows.join(hit, "uid", "left").join(held, "uid", "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """``docs`` without the contaminated documents.

    Rows are judged by id and text, so a clean text stays whatever other rows
    share its id or have none.  Null and empty texts have no words and stay;
    an empty table or benchmark changes nothing; repeated rows stay or go
    together; other columns stay as they are.
    """
    key = F.struct(F.col(id_col).cast("long").alias("id"), digest(F.col(text_col)).alias("text"))
    rows, spans, _ = matches(docs, items, id_col, text_col, key=key, **columns)
    bad = rows.join(spans.select("uid").distinct(), "uid", "left_semi").select(F.col("id.id").alias("bad_id"), F.col("id.text").alias("bad_text")).distinct()
    bad = written(bad, "contaminated")
    same = docs[id_col].cast("long").eqNullSafe(bad["bad_id"]) & (digest(docs[text_col]) == bad["bad_text"])
    return docs.join(bad, same, "left_anti")
