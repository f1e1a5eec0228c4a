"""Cross-entropy difference between a target and a background bigram model.

Both models are counted over whole texts, the background over all documents
and the target over those that a predicate names.  They match: one
vocabulary, one smoothing.  Every word and bigram counts, at every size:

    p(w | h) = L c(h, w) / c(h) + (1 - L) (c(w) + 1) / (N + V + 2)

(only the second part, with L = 0, after a history that the model hasn't).

Documents travel in batches of about ``BATCH_BYTES`` of text.  A batch asks
for the counts of its distinct words, then of its distinct bigrams: it sends
its own counts to the partitions that own them, packed in one block for each,
and the owner adds up what all batches sent and answers.  An answer leaves out
bigrams that no other batch holds.  So a word or bigram that stands in every
document is one row per batch, and nothing that grows with the input is
gathered or sent to all tasks.  Owners number their words by falling
frequency (rank * owners + owner), so bigrams are pairs of exact, small numbers.

RDDs hold the batches because both answers have to come back to a batch that
stays where it is: batches and answers share one partitioner, and their union
moves neither.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm.textops import SubstringHash, U64, chunks, fill_text, lower, mix, word_spans

WEIGHT = 0.7                 # L: of the bigram against the single word
BATCH_BYTES = 4 << 20        # of text in a batch; a longer text is a batch of its own
START = U64(1)               # hash in place of the word before a text's first

_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = True
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True

_SCHEMA = "doc_id long, n_tokens long, ce_target double, ce_background double"


def _packed(*arrays: np.ndarray) -> bytes:
    """Unsigned integers, each array in the bytes that its largest one needs, byte plane by byte plane."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a, dtype="<u8")
        width = max(1, -(-int(a.max()).bit_length() // 8)) if len(a) else 1
        out += [len(a).to_bytes(5, "little"), bytes([width]), a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    return zlib.compress(b"".join(out), 1)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    raw, at, out = np.frombuffer(zlib.decompress(blob), dtype=np.uint8), 0, []
    while at < len(raw):
        n, width = int.from_bytes(raw[at:at + 5].tobytes(), "little"), int(raw[at + 5])
        a = np.zeros((n, 8), dtype=np.uint8)
        a[:, :width] = raw[at + 6:at + 6 + n * width].reshape(width, n).T
        out.append(a.reshape(-1).view("<u8"))
        at += 6 + n * width
    return out


def _ints(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


class Batch:
    """Some documents as numbers of the batch's own sorted vocabulary, of which
    one entry is ``START``."""

    def __init__(self, blob: bytes):
        ids, self.known_id, self.target, self.length, self.words, vocabulary = _unpacked(blob)
        self.ids, self.length, self.words = _ints(ids), _ints(self.length), _ints(self.words)
        self.vocabulary = vocabulary
        self.row = np.repeat(np.arange(len(self.length)), self.length)
        self.before = np.empty_like(self.words)
        self.before[1:] = self.words[:-1]
        first = (np.cumsum(self.length) - self.length)[self.length > 0]
        self.before[first] = np.searchsorted(vocabulary, START)

    def counts(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Times that each number of ``at`` (one per word) occurs, in all documents and in the target's."""
        mine = self.target[self.row] > 0
        return np.bincount(at, minlength=size), np.bincount(at[mine], minlength=size)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigrams as (word before, word) numbers, and the bigram of each word."""
        keys, at = np.unique(self.before << 32 | self.words, return_inverse=True)
        return keys >> 32, keys & 0xFFFFFFFF, at


def _batches(batch_bytes: int):
    """Rows (doc_id, target, text) to packed batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def out():
            nonlocal number
            ids, known, target, length, hashes = (np.concatenate(x) for x in zip(*held))
            vocabulary, at = np.unique(np.append(hashes, START), return_inverse=True)
            blob = _packed(ids.view(U64), known, target, length, at[:-1], vocabulary)
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([blob], pa.binary())], names=["batch", "blob"])

        for b in batches:
            ids = b.column(0).fill_null(0).to_numpy()
            known, target = np.asarray(b.column(0).is_valid()), np.asarray(b.column(1))
            for lo, hi, data, offsets in chunks(fill_text(b.column(2))):
                if held and size + len(data) > batch_bytes:
                    yield out()
                    held, size = [], 0
                data = lower(data)
                starts, ends, first = word_spans(_WORD[data], offsets)
                held.append((ids[lo:hi], known[lo:hi], target[lo:hi], np.diff(first), SubstringHash(data).of(starts, ends)))
                size += len(data)
        if held:
            yield out()

    return run


def _sent(keys: tuple[np.ndarray, ...], counts: tuple[np.ndarray, ...], to: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(owner, block) of the rows, in each block in the order that ``_blocks`` finds again."""
    for owner, at in _blocks(to):
        yield owner, _packed(*(x[at] for x in keys + counts))


def _blocks(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        yield int(to[at[0]]), at


def _owner_of_words(vocabulary: np.ndarray, owners: int) -> np.ndarray:
    return _ints(mix(vocabulary) % U64(owners))


def _owner_of_bigrams(a: np.ndarray, b: np.ndarray, owners: int) -> np.ndarray:
    return _ints(mix(a.astype(U64) * U64(0x9E3779B97F4A7C15) + b.astype(U64)) % U64(owners))


def _word_requests(owners: int):
    def run(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, tuple[int, bytes]]]:
        for number, (_, _, blob) in rows:
            batch = Batch(blob)
            size = len(batch.vocabulary)
            counts = batch.counts(batch.words, size) + batch.counts(batch.before, size)
            for owner, block in _sent((batch.vocabulary,), counts, _owner_of_words(batch.vocabulary, owners)):
                yield owner, (number, block)

    return run


class Owned:
    """What all batches sent to one owner: distinct keys with the sums of their counts."""

    def __init__(self, rows: Iterator[tuple[int, tuple[int, bytes]]], n_keys: int, steps: bool = False):
        self.batches, blocks, self.owner = [], [], 0
        for self.owner, (number, block) in rows:
            self.batches.append(number)
            first, *rest = _unpacked(block)
            blocks.append((np.cumsum(first) if steps else first, *rest))
        self.cuts = np.cumsum([0] + [len(b[0]) for b in blocks])
        columns = [np.concatenate(x) for x in zip(*blocks)] if blocks else [np.zeros(0, U64)] * (n_keys + 1)
        self.keys, self.sent = columns[:n_keys], [_ints(x) for x in columns[n_keys:]]
        order = np.lexsort(self.keys)
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        for key in self.keys:
            new[1:] |= np.diff(key[order]) != 0
        self.first = order[new]
        self.at = np.empty(len(order), dtype=np.int64)
        self.at[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        self.sums = [np.add.reduceat(x[order], starts) if len(starts) else x for x in self.sent]

    def answers(self) -> Iterator[tuple[int, slice]]:
        for number, a, e in zip(self.batches, self.cuts[:-1], self.cuts[1:]):
            yield number, slice(a, e)


def _word_answers(owners: int):
    """Number and counts of every word that a batch asked for."""
    def run(rows: Iterator) -> Iterator[tuple[int, tuple[str, int, bytes]]]:
        own = Owned(rows, 1)
        rank = np.empty(len(own.first), dtype=np.int64)
        rank[np.lexsort((own.keys[0][own.first], -own.sums[0]))] = np.arange(len(rank))
        number = rank * owners + own.owner
        for batch, part in own.answers():
            at = own.at[part]
            yield batch, ("words", own.owner, _packed(number[at], *(x[at] for x in own.sums)))

    return run


def _totals(rows: Iterator) -> Iterator[tuple[int, int, int]]:
    """Distinct words, words, words of the target."""
    own = Owned(rows, 1)
    if own.batches:
        yield int((own.sums[0] > 0).sum()), int(own.sums[0].sum()), int(own.sums[1].sum())


class Numbered:
    """A batch with the owners' numbers and counts of its words."""

    def __init__(self, blob: bytes, answers: dict[int, bytes], owners: int):
        self.batch = Batch(blob)
        self.number, *self.counts = (np.zeros(len(self.batch.vocabulary), dtype=np.int64) for _ in range(5))
        for owner, at in _blocks(_owner_of_words(self.batch.vocabulary, owners)):
            for mine, values in zip((self.number, *self.counts), _unpacked(answers[owner])):
                mine[at] = _ints(values)
        self.a, self.b, self.at = self.batch.bigrams()
        self.pair_counts = self.batch.counts(self.at, len(self.a))
        # by the numbers, so that an owner's block is sorted and packs well
        order = np.lexsort((self.number[self.b], self.number[self.a]))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.a, self.b, self.at = self.a[order], self.b[order], place[self.at]
        self.pair_counts = tuple(x[order] for x in self.pair_counts)

    def owners_of_bigrams(self, owners: int) -> np.ndarray:
        return _owner_of_bigrams(self.number[self.a], self.number[self.b], owners)


def _gathered(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, bytes, dict[str, dict[int, bytes]]]]:
    """The batches of a partition with their answers."""
    blobs: dict[int, bytes] = {}
    answers: dict[int, dict[str, dict[int, bytes]]] = defaultdict(lambda: defaultdict(dict))
    for number, (kind, owner, blob) in rows:
        if kind == "batch":
            blobs[number] = blob
        else:
            answers[number][kind][owner] = blob
    for number, blob in blobs.items():
        yield number, blob, answers.pop(number, {})


def _bigram_requests(owners: int):
    def run(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, tuple[int, bytes]]]:
        for number, blob, answers in _gathered(rows):
            x = Numbered(blob, answers.get("words", {}), owners)
            a, b = x.number[x.a], x.number[x.b]
            for owner, at in _blocks(x.owners_of_bigrams(owners)):
                # the first of each pair as steps from the one before
                yield owner, (number, _packed(np.diff(a[at], prepend=0), b[at], *(n[at] for n in x.pair_counts)))

    return run


def _bigram_answers(rows: Iterator) -> Iterator[tuple[int, tuple[str, int, bytes]]]:
    """Counts of the bigrams that a batch asked for and doesn't hold alone."""
    own = Owned(rows, 2, steps=True)
    for batch, part in own.answers():
        at = own.at[part]
        other = np.flatnonzero(own.sums[0][at] != own.sent[0][part])
        yield batch, ("bigrams", own.owner, _packed(np.diff(other, prepend=0), *(x[at[other]] for x in own.sums)))


def _scored(owners: int, weight: float, totals: tuple[int, int, int]):
    """Per batch one Arrow file of its documents' losses."""
    size, *words = totals

    def run(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple[bytearray]]:
        for _, blob, answers in _gathered(rows):
            x = Numbered(blob, answers.get("words", {}), owners)
            counts = [n.copy() for n in x.pair_counts]
            found = answers.get("bigrams", {})
            for owner, at in _blocks(x.owners_of_bigrams(owners)):
                steps, *sums = _unpacked(found[owner])
                for mine, n in zip(counts, sums):
                    mine[at[np.cumsum(_ints(steps))]] = _ints(n)
            n_words, docs = x.batch.length, len(x.batch.length)
            means = []
            for i in (1, 0):  # target, background
                single, history = x.counts[i][x.b], x.counts[2 + i][x.a]
                left = np.where(history > 0, 1 - weight, 1.0)
                p = weight * counts[i] / np.maximum(history, 1) + left * (single + 1) / float(words[i] + size + 2)
                means.append(np.bincount(x.batch.row, -np.log(p)[x.at], minlength=docs) / np.maximum(n_words, 1))
            none = n_words == 0
            table = pa.RecordBatch.from_arrays([pa.array(x.batch.ids, mask=x.batch.known_id == 0), pa.array(n_words), *(pa.array(m, mask=none) for m in means)],
                                               names=["doc_id", "n_tokens", "ce_target", "ce_background"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_batch(table)
            yield (bytearray(sink.getvalue().to_pybytes()),)

    return run


def _rows_of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for blob in b.column(0):
            yield from pa.ipc.open_stream(blob.as_buffer())


def _by_number(number: int) -> int:
    return number ^ number >> 32


def cross_entropies(docs: DataFrame, target: Column, id_col: str = "doc_id", text_col: str = "text", weight: float = WEIGHT,
                    threshold: float = 0.0, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ce_target, ce_background (mean
    loss per word), score (their difference; the lower, the more like the
    target) and selected (score below ``threshold``).

    A null ``target`` is no target.  Null and empty texts have no words: null
    losses and score, not selected.  Repeated rows count and come back
    repeated; a null id changes nothing; other columns aren't read; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(target, F.lit(False)).alias("target"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // batch_bytes))
    batches: RDD = (rows.mapInArrow(_batches(batch_bytes), "batch long, blob binary").rdd
                    .map(lambda r: (r.batch, ("batch", 0, bytes(r.blob)))).partitionBy(owners, _by_number))
    asked = batches.mapPartitions(_word_requests(owners)).partitionBy(owners)
    totals = asked.mapPartitions(_totals).fold((0, 0, 0), lambda a, b: tuple(x + y for x, y in zip(a, b)))
    words = asked.mapPartitions(_word_answers(owners)).partitionBy(owners, _by_number)
    numbered = batches.union(words)
    bigrams = numbered.mapPartitions(_bigram_requests(owners)).partitionBy(owners).mapPartitions(_bigram_answers).partitionBy(owners, _by_number)
    files = numbered.union(bigrams).mapPartitions(_scored(owners, weight, totals))
    out = spark.createDataFrame(files, "file binary").mapInArrow(_rows_of_files, _SCHEMA)
    out = out.withColumn("score", F.col("ce_target") - F.col("ce_background"))
    return out.withColumn("selected", F.coalesce(F.col("score") < threshold, F.lit(False)))
