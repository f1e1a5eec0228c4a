"""Quality rules: per-document statistics and cross-document line frequency.

A normalised line (A-Z lower-cased, runs of white space as one space) is
common when more different documents of its host hold it than the host's
limit: ``max(min_docs, share * different documents of the host)``.  Copies of
one document are not different documents: documents are told apart by a digest
of their whole normalised text, so that a group of copies doesn't make its own
lines common, while documents that share any line or passage count each by
itself.  Common lines are removed, and depleted documents are rejected:
those that lose more than ``max_removed`` of their words, or keep fewer than
``MIN_WORDS`` (the rule for whole documents).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from martflow.llm.frames import digest, written
from martflow.llm.textops import SubstringHash, chunks, fill_text, mix, signed, word_spans, U64

MIN_WORDS = 50
MAX_REPEAT = 0.5
MIN_DOCS = 20
SHARE = 0.001
MAX_REMOVED = 0.5

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_ROWS = ("uid long, doc_id long, host long, digest binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
         "n_repeat_words long, signature long, lines array<struct<line: long, words: int>>")
_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))


def normalised(line: bytes) -> bytes:
    return b" ".join(line.split()).lower()


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    inside = np.zeros(len(words), dtype=bool)
    for i, w in enumerate(windows):
        if seen[w] > 1:
            inside[i:i + 3] = True
    return int(inside.sum())


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 33
    for b in batches:
        texts = fill_text(b.column(3))
        for lo, hi, data, offsets in chunks(texts):
            starts, ends, first = word_spans(_WORD[data], offsets)
            per_row = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offsets])
            word_chars = per_row(_WORD[data] & ((data & 0xC0) != 0x80))
            symbols = per_row(_SYMBOL[data])
            exact = SubstringHash(data).of(starts, ends)
            raw = data.tobytes()
            out = {"dup": [], "rep": [], "sig": [], "lines": []}
            for i in range(hi - lo):
                body = raw[offsets[i]:offsets[i + 1]]
                mine = slice(first[i], first[i + 1])
                dup, rep, lines, seen = 0, 0, {}, set()
                host = (b.column(1)[lo + i].as_py() or 0).to_bytes(8, "little", signed=True)
                for line in body.split(b"\n"):
                    if key := normalised(line):
                        dup += line in seen
                        seen.add(line)
                        h = _line_hash(host, key)
                        lines[h] = lines.get(h, 0) + key.count(b" ") + 1
                told = _windows(exact[mine])
                if len(told) and len(np.unique(told)) < len(told):
                    rep = repeated_words(body.split())
                out["dup"].append(dup)
                out["rep"].append(rep)
                out["sig"].append(xxhash.xxh64_intdigest(normalised(body)))
                out["lines"].append([{"line": h, "words": w} for h, w in lines.items()])
            n = hi - lo
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(uid, uid + n)), b.column(0).slice(lo, n), b.column(1).slice(lo, n), b.column(2).slice(lo, n),
                pa.array(np.diff(first)), pa.array(word_chars), pa.array(symbols), pa.array(out["dup"], pa.int64()),
                pa.array(out["rep"], pa.int64()), pa.array(signed(np.array(out["sig"], dtype=np.uint64))),
                pa.array(out["lines"], _LINES)], names=[f.split()[0] for f in _ROWS.split(", ")[:11]])
            uid += n


def _windows(words: np.ndarray) -> np.ndarray:
    if len(words) < 3:
        return words[:0]
    return mix(words[:-2] + words[1:-1] * U64(0x9E3779B97F4A7C15) + words[2:] * U64(0xC2B2AE3D27D4EB4F))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per row of ``docs``, written: ``uid`` tells the rows apart."""
    rows = docs.select(*_row_key(docs, id_col, text_col, host_col), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(_statistics, _ROWS), "quality-rows")


def common_lines(rows: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """(line) of the lines above their host's limit, written."""
    lines = rows.select("host", "signature", F.explode("lines").alias("l")).select("host", "signature", "l.line")
    # rows per line bound the documents per line from above: few lines remain
    many = written(lines.groupBy("line").count().where(F.col("count") > min_docs).select("line"), "frequent-lines")
    docs = lines.join(many, "line").distinct().groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    hosts = rows.select("host", "signature").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    above = docs.where(F.col("n_docs") > min_docs).join(hosts, "host").where(F.col("n_docs") > F.col("host_docs") * share)
    return written(above.select("line"), "common-lines")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
           min_docs: int = MIN_DOCS, share: float = SHARE, max_removed: float = MAX_REMOVED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_removed (words in common lines), base_failed, kept.

    A null text is an empty one (no words, so base_failed); a null host is a
    host of its own; repeated rows come back repeated and equal; other
    columns are not read; an empty table gives an empty result.
    """
    rows = statistics(docs, id_col, text_col, host_col)
    return _verdicts(rows, common_lines(rows, min_docs, share), max_removed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed", "base_failed", "kept")


def _verdicts(rows: DataFrame, common: DataFrame, max_removed: float) -> DataFrame:
    removed = (rows.select("uid", F.explode("lines").alias("l")).select("uid", "l.line", "l.words")
               .join(common, "line").groupBy("uid").agg(F.sum("words").alias("n_removed")))
    out = rows.drop("lines").join(removed, "uid", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEAT) * F.col("n_words"))
    depleted = (F.col("n_removed") > F.col("n_words") * max_removed) | ((F.col("n_removed") > 0) & (F.col("n_words") - F.col("n_removed") < MIN_WORDS))
    return out.withColumns({"base_failed": failed, "kept": ~failed & ~depleted})


def _line_hash(host: bytes, line: bytes) -> int:
    return xxhash.xxh64_intdigest(host + line) - (1 << 63)


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, host, gone, row) to (text, row): texts without the lines whose hashes are in ``gone``."""
    for b in batches:
        texts, gone = b.column(0).to_pylist(), b.column(2)
        for i in np.flatnonzero(np.asarray(gone.is_valid())).tolist():
            host, drop = b.column(1)[i].as_py().to_bytes(8, "little", signed=True), set(gone[i].as_py())
            keep = [x for x in texts[i].encode().split(b"\n") if not (k := normalised(x)) or _line_hash(host, k) not in drop]
            texts[i] = b"\n".join(keep).decode()
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), b.column(3)], names=["text", "row"])


def _row_key(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> list:
    """What tells rows apart for a verdict: id, host and text; rows that agree
    in all three get the same one."""
    host = F.xxhash64(F.coalesce(F.col(host_col).cast("string"), F.lit("")))
    return [F.col(id_col).cast("long").alias("doc_id"), host.alias("host"), digest(F.col(text_col)).alias("digest")]


def _cleaned(docs: DataFrame, changes: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``docs`` without the rows that ``changes`` (doc_id, host, digest, kept,
    gone) doesn't keep, and without the lines that are ``gone`` in it."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*_row_key(docs, id_col, text_col, host_col), F.col(text_col).alias("text"), F.struct(*names).alias("row"))
    same = F.lit(True)
    for c in ("doc_id", "host", "digest"):
        same = same & rows[c].eqNullSafe(changes[c])
    found = rows.join(changes, same, "left").where(F.coalesce(changes["kept"], F.lit(True))).select("text", rows["host"], "gone", "row")
    out = found.mapInArrow(_without_lines, T.StructType([T.StructField("text", T.StringType()), T.StructField("row", found.schema["row"].dataType)]))
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _changes(docs: DataFrame, rows: DataFrame, common: DataFrame, max_removed: float) -> DataFrame:
    """(doc_id, host, digest, kept, gone) of the rows that go or lose lines."""
    gone = (rows.select("uid", F.explode("lines").alias("l")).select("uid", "l.line").join(common, "line")
            .groupBy("uid").agg(F.collect_set("line").alias("gone")))  # distinct lines of one document
    verdicts = _verdicts(rows, common, max_removed).select("uid", "doc_id", "host", "digest", "kept")
    changed = verdicts.join(gone, "uid", "left").where(~F.col("kept") | F.col("gone").isNotNull())
    return written(changed.groupBy("doc_id", "host", "digest").agg(F.first("kept").alias("kept"), F.first("gone").alias("gone")), "quality-changes")


def without_common_lines(docs: DataFrame, common: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` with the lines of ``common`` taken out of their texts.  Null
    texts stay null, empty ones empty; repeated rows come back repeated, an
    empty table empty; other columns stay as they are."""
    rows = statistics(docs, id_col, text_col, host_col)
    changes = _changes(docs, rows, common, 1.0).withColumn("kept", F.lit(True))
    return _cleaned(docs, changes, id_col, text_col, host_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS,
              share: float = SHARE, max_removed: float = MAX_REMOVED) -> DataFrame:
    """``docs`` without the documents that the rules reject, and without the
    common lines of those that stay.

    Every row is judged by itself, whatever other rows share its id or have
    none.  Null and empty texts have no words and go; an empty table stays
    empty; repeated rows stay or go together; other columns stay as they are.
    """
    rows = statistics(docs, id_col, text_col, host_col)
    return _cleaned(docs, _changes(docs, rows, common_lines(rows, min_docs, share), max_removed), id_col, text_col, host_col)
