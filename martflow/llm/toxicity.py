"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios.

A document's features are the character n-grams (bytes, A-Z lower-cased) that
it holds once, twice or four times at least, hashed to 2**BITS buckets; each
is scaled by the log ratio of the shares of toxic and other training
documents that have it.  Buckets whose
ratio could be chance (likelihood ratio against the number of buckets seen)
are left out.  Logistic regression with an L2 penalty weights the rest.

The classifier is fitted on at most ``sample`` labelled texts of each class.
Copies (A-Z lower-cased) count once, and are folded before that bound is
applied, so a group of copies takes one place in it and doesn't pass for a
rule.  Scoring reads whole texts of all documents and moves none of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm.frames import digest, written
from martflow.llm.textops import SubstringHash, chunks, fill_text, lower

SIZES = (4, 6, 8)
BITS = 20
LEVELS = (1, 2, 4)           # a bucket is one feature for each number of occurrences it reaches
WIDTH = 1 << (BITS + 2)
SAMPLE = 10_000              # training texts of each class at most
THRESHOLD = 0.7
CHUNK = 1 << 20              # entries of the training matrix worked on at once


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram inside a row, one array pair per size."""
    hashes = SubstringHash(lower(data))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in SIZES:
        at = np.arange(max(len(data) - n + 1, 0))
        at = at[row[at] == row[at + n - 1]] if len(at) else at
        yield row[at], (hashes.of(at, at + n) >> np.uint64(64 - BITS)).astype(np.int64)


def _present(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs by row; only those of buckets that are
    ``wanted``.  A feature is a bucket and a level of its count."""
    pairs = []
    for row, bucket in _grams(data, offsets):
        if wanted is not None:
            some = wanted[bucket]
            row, bucket = row[some], bucket[some]
        pairs.append(row << BITS | bucket)
    pairs, n = np.unique(np.concatenate(pairs), return_counts=True)
    row, bucket = pairs >> BITS, pairs & ((1 << BITS) - 1)
    reached = [n >= level for level in LEVELS]
    row = np.concatenate([row[x] for x in reached])
    feature = np.concatenate([i << BITS | bucket[x] for i, x in enumerate(reached)])
    order = np.argsort(row, kind="stable")
    return row[order], feature[order]


def _buckets_of(values: np.ndarray) -> np.ndarray:
    """Per bucket, whether any level of it has a value."""
    return values.reshape(-1, 1 << BITS).any(axis=0)


def _by_feature(features: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values as an array over all features, made in the task that needs it."""
    out = np.zeros(WIDTH, dtype=np.float32)
    out[features] = values
    return out


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray      # regression weight times log-count ratio
    bias: float

    def scorer(self):
        """(bytes, offsets) -> score per row."""
        weights = _by_feature(self.features, self.weights)
        wanted = _buckets_of(weights)

        def scores(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
            row, feature = _present(data, offsets, wanted)
            z = self.bias + np.bincount(row, weights[feature], minlength=len(offsets) - 1)
            return 1 / (1 + np.exp(-np.clip(z, -700, 700)))

        return scores


def bucket_counts(sample: DataFrame) -> DataFrame:
    """(bucket, toxic, other): documents of each class that hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, WIDTH), dtype=np.int32)
        for b in batches:
            toxic = np.asarray(b.column(1)).astype(bool)
            for lo, hi, data, offsets in chunks(fill_text(b.column(0))):
                row, bucket = _present(data, offsets, None)
                side = toxic[lo:hi][row]
                n[1] += np.bincount(bucket[side], minlength=WIDTH).astype(np.int32)
                n[0] += np.bincount(bucket[~side], minlength=WIDTH).astype(np.int32)
        held = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[1][held], pa.int64()), pa.array(n[0][held], pa.int64())], names=["bucket", "toxic", "other"])

    counts = sample.select("text", "toxic").mapInArrow(run, "bucket long, toxic long, other long")
    return counts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def log_ratios(counts: DataFrame, n_toxic: int, n_other: int) -> DataFrame:
    """(bucket, ratio): log-count ratios of the buckets that are hardly chance."""
    seen = counts.count()
    if not seen or not n_toxic or not n_other:
        return counts.limit(0).select("bucket", F.lit(0.0).alias("ratio"))
    t, o = F.col("toxic"), F.col("other")
    ratio = F.log((t + 1) / (n_toxic + 2)) - F.log((o + 1) / (n_other + 2))
    both = (t + o) / (n_toxic + n_other)

    def part(k: Column, expected: Column) -> Column:
        return k * F.log(F.greatest(k, F.lit(1e-9)) / F.greatest(expected, F.lit(1e-9)))

    g = 2 * (part(t, n_toxic * both) + part(n_toxic - t, n_toxic * (1 - both)) + part(o, n_other * both) + part(n_other - o, n_other * (1 - both)))
    return counts.where(g >= 2 * math.log(seen) + 4).select("bucket", ratio.alias("ratio"))


class _Sums:
    """Sums over the entries of a sparse matrix by row or by column: entries
    sorted by ``by`` once, then added up a piece at a time."""

    def __init__(self, by: np.ndarray, other: np.ndarray, value: np.ndarray, size: int):
        order = np.argsort(by, kind="stable") if (np.diff(by) < 0).any() else slice(None)
        by, self.other, self.value, self.size = by[order], other[order], value[order], size
        self.starts = np.flatnonzero(np.diff(by, prepend=-1))
        self.of = by[self.starts]
        # pieces of whole groups of about CHUNK entries
        self.cuts = np.unique(np.append(np.searchsorted(self.starts, np.arange(0, len(by), CHUNK)), len(self.starts)))

    def __call__(self, factors: np.ndarray | None) -> np.ndarray:
        """Per group, the sum of value * factors[other] (None: of value squared)."""
        out = np.zeros(self.size)
        ends = np.append(self.starts, len(self.value))
        for a, e in zip(self.cuts[:-1], self.cuts[1:]):
            part = slice(ends[a], ends[e])
            value = self.value[part].astype(float)
            out[self.of[a:e]] = np.add.reduceat(value * (value if factors is None else factors[self.other[part]]), self.starts[a:e] - ends[a])
        return out


def regress(row: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray, n_features: int,
            penalty: float = 1.0, rounds: int = 500, tolerance: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps, until no weight
    changes by more than ``tolerance`` of the largest one."""
    n = max(len(label), 1)
    # both classes weigh the same
    toxic = label.mean() if len(label) else 0.0
    each = np.where(label > 0, 0.5 / toxic, 0.5 / (1 - toxic)) if 0 < toxic < 1 else np.ones(len(label))
    w, bias = np.zeros(n_features), 0.0
    ahead, ahead_bias, t = w, bias, 1.0
    by_row, by_feature = _Sums(row, feature, value, n), _Sums(feature, row, value, n_features)
    # the curvature is at most a quarter of the mean squared length of a row
    step = 4 / (np.average(1 + by_row(None), weights=each if len(label) else None) + penalty / n)
    for _ in range(rounds):
        off = each * (1 / (1 + np.exp(-np.clip(ahead_bias + by_row(ahead), -700, 700))) - label)
        new = ahead - step * (by_feature(off) + penalty * ahead) / n
        new_bias = ahead_bias - step * off.sum() / n
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_bias = new + (t - 1) / after * (new - w), new_bias + (t - 1) / after * (new_bias - bias)
        still = len(new) == 0 or np.abs(new - w).max() <= tolerance * np.abs(new).max()
        w, bias, t = new, new_bias, after
        if still:
            break
    return w, float(bias)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """(text, toxic): at most ``sample`` labelled documents of each class, by a
    hash of their ids, none of them held out; written.  Rows that share an id
    are toxic if one is."""
    ids = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("sample_id")).agg(
        (F.max(label_col) > 0).alias("toxic")).where(~held_out(F.col("sample_id")))
    rows = docs.select(F.col(id_col).cast("long").alias("sample_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # one id per class and text, from narrow rows; the same text in both classes stands in both
    named = rows.select("sample_id", digest(low).alias("copy")).join(ids, "sample_id")
    texts = written(named.groupBy("toxic", "copy").agg(F.min("sample_id").alias("sample_id")), "labelled-texts")
    order = F.xxhash64("sample_id")
    some = texts.where("toxic").orderBy(order, "sample_id").limit(sample).unionByName(
        texts.where("not toxic").orderBy(order, "sample_id").limit(sample))
    # at most 2 * sample ids; a repeated id may have other texts
    found = rows.join(F.broadcast(some), "sample_id").where(digest(low) == F.col("copy"))
    return written(found.groupBy("toxic", "copy").agg(F.min("text").alias("text")).select("text", "toxic"), "labelled")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **columns) -> Model:
    """The classifier; without labelled documents every score is 0.5, with one
    class only the rate of toxic documents decides."""
    rows = training_sample(docs, labels, sample, **columns)
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    counts = written(bucket_counts(rows), "buckets")
    clear = log_ratios(counts, sizes.get(True, 0), sizes.get(False, 0)).orderBy("bucket").toPandas()  # at most WIDTH rows
    features, ratios = clear["bucket"].to_numpy(np.int64), clear["ratio"].to_numpy(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _by_feature(*sent.value) != 0
        wanted = _buckets_of(known)
        for b in batches:
            for lo, hi, data, offsets in chunks(fill_text(b.column(0))):
                row, bucket = _present(data, offsets, wanted)
                row, bucket = row[known[bucket]], bucket[known[bucket]]
                cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                held = [bucket[a:e].astype("<i4").tobytes() for a, e in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(lo, hi - lo), pa.array(held, pa.binary())], names=["toxic", "held"])

    sent = docs.sparkSession.sparkContext.broadcast((features, ratios))
    # at most 2 * sample rows of packed buckets, in a defined order, so that
    # sums of doubles are the same in every run
    found = rows.mapInArrow(run, "toxic boolean, held binary").collect()
    if not found:
        return Model(features[:0], ratios[:0], 0.0)
    found.sort(key=lambda x: (x.toxic, x.held))
    at = np.concatenate([np.searchsorted(features, np.frombuffer(x.held, dtype="<i4")).astype(np.int32) for x in found])
    row = np.repeat(np.arange(len(found), dtype=np.int32), [len(x.held) // 4 for x in found])
    label = np.array([x.toxic for x in found], dtype=float)
    del found
    w, bias = regress(row, at, ratios[at], label, len(features))
    return Model(features, (w * ratios).astype(np.float32), bias)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Null texts are empty ones and get the score of no feature; repeated rows
    come back repeated; other columns aren't read; an empty table gives an
    empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = sent.value.scorer()
        for b in batches:
            for lo, hi, data, offsets in chunks(fill_text(b.column(1))):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(scores(data, offsets))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **columns) -> DataFrame:
    """``scored`` by a classifier fitted on the same documents' labels."""
    return scored(docs, fit(docs, labels, sample, **columns), **columns)
