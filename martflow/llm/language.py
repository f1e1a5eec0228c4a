"""Language of texts: multinomial naive Bayes over hashed character n-grams.

A text's features are the byte n-grams of its words (A-Z lower-cased, other
ASCII characters than letters read as blanks, n-grams of blanks alone left
out), hashed to 2**BITS buckets.  Each language's bucket counts are summed
over all documents that may be learnt from, with a map-side fold, and become
one matrix of log probabilities with add-``SMOOTH`` smoothing.  The matrix
goes to every task in groups of ``LANGUAGES`` rows: a fixed number of bytes
each, whatever the number of languages.  A batch of texts is scored as a
sparse matrix of bucket counts times that matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martflow.llm.frames import written
from martflow.llm.textops import SubstringHash, chunks, fill_text

SIZES = (1, 2, 3, 4)
BITS = 15
SMOOTH = 0.5
LANGUAGES = 64               # languages whose probabilities are sent out together (16 MB)
HELD = 32                    # languages that a counting task holds before it passes them on
UNKNOWN = "und"

_BLANK = 0x20
_LETTERS = np.full(256, _BLANK, dtype=np.uint8)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, times) of the n-grams inside the rows, by row and bucket."""
    data = _LETTERS[data]
    hashes = SubstringHash(data)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    letters = np.concatenate(([0], np.cumsum(data != _BLANK)))
    pairs = []
    for n in SIZES:
        at = np.arange(max(len(data) - n + 1, 0))
        if len(at):
            at = at[(row[at] == row[at + n - 1]) & (letters[at + n] > letters[at])]
        pairs.append(row[at] << BITS | (hashes.of(at, at + n) >> np.uint64(64 - BITS)).astype(np.int64))
    pairs, times = np.unique(np.concatenate(pairs), return_counts=True)
    return pairs >> BITS, pairs & ((1 << BITS) - 1), times


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows (lang, text); bucket -1 counts the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out():
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at - 1), pa.array(n[at])], names=["lang", "bucket", "n"])

        for b in batches:
            coded = b.column(0).dictionary_encode()
            names, which = coded.dictionary.to_pylist(), np.asarray(coded.indices)
            for lo, hi, data, offsets in chunks(fill_text(b.column(1))):
                row, bucket, times = grams(data, offsets)
                lang = which[lo:hi]
                for i in np.unique(lang).tolist():
                    n = held.setdefault(names[i], np.zeros(1 + (1 << BITS), dtype=np.int64))
                    mine = lang[row] == i
                    n[1:] += np.bincount(bucket[mine], times[mine], minlength=1 << BITS).astype(np.int64)
                    n[0] += int((lang == i).sum())
                    if len(held) > HELD:
                        yield from out()
                        held.clear()
        yield from out()

    counts = rows.select("lang", "text").mapInArrow(run, "lang string, bucket long, n long")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Log probabilities of the buckets for some languages, and of the languages."""
    languages: list[str]
    matrix: np.ndarray       # bucket x language
    prior: np.ndarray

    def likelihoods(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Row x language: log prior plus log likelihood."""
        row, bucket, times = grams(data, offsets)
        n = len(offsets) - 1
        out = np.empty((n, len(self.languages)))
        for i in range(len(self.languages)):
            out[:, i] = self.prior[i] + np.bincount(row, times * self.matrix[bucket, i], minlength=n)
        return out


def models(counts: DataFrame, languages: int = LANGUAGES) -> Iterator[Model]:
    """Models of ``languages`` languages at a time, in the order of their names,
    from written counts (lang, bucket, n)."""
    total = counts.where("bucket < 0").agg(F.sum("n")).first()[0]
    last = None
    while True:
        rest = counts.where("bucket < 0") if last is None else counts.where((F.col("bucket") < 0) & (F.col("lang") > last))
        some = [(r.lang, r.n) for r in rest.orderBy("lang").limit(languages).collect()]
        if not some:
            return
        names, last = [x for x, _ in some], some[-1][0]
        found = counts.where((F.col("bucket") >= 0) & F.col("lang").between(names[0], last)).toPandas()  # languages * 2**BITS rows at most
        n = np.zeros((1 << BITS, len(names)))
        n[found["bucket"].to_numpy(np.int64), found["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(np.int64)] = found["n"].to_numpy(float)
        yield Model(names, np.log((n + SMOOTH) / (n.sum(axis=0) + SMOOTH * (1 << BITS))), np.log(np.array([c / total for _, c in some])))


def _best(rows: DataFrame, model: Model) -> DataFrame:
    """rows (row, text) -> (row, lang, best, rest): the likeliest of the model's
    languages, its log likelihood, and the log of the sum over all of them."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(sent.value.languages, dtype=object)
        for b in batches:
            for lo, hi, data, offsets in chunks(fill_text(b.column(1))):
                each = sent.value.likelihoods(data, offsets)
                at = each.argmax(axis=1)
                best = each[np.arange(len(at)), at]
                rest = best + np.log(np.exp(each - best[:, None]).sum(axis=1))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(names[at].tolist(), pa.string()), pa.array(best), pa.array(rest)],
                                                 names=["row", "lang", "best", "rest"])

    row = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "text").mapInArrow(run, f"row {row}, lang string, best double, rest double")


def _over_groups(asked: DataFrame, groups: Iterator[Model]) -> DataFrame:
    """More languages than one broadcast holds: each group of them scores all
    rows, and a row's best is taken over the groups (the first of equal ones)."""
    asked = written(asked.select(F.struct(F.monotonically_increasing_id().alias("uid"), "row.*").alias("row"), "text"), "language-rows")
    parts = [written(_best(asked, model).withColumn("turn", F.lit(-i)), "languages") for i, model in enumerate(groups)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.groupBy("row").agg(F.max(F.struct("best", "turn", "lang")).alias("top"), F.max("rest").alias("most"), F.collect_list("rest").alias("rests"))
    rest = F.col("most") + F.log(F.aggregate("rests", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("most"))))
    return found.select("row.doc_id", "row.letters", "top.lang", F.exp(F.col("top.best") - rest).alias("score"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", at_once: int = LANGUAGES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``.

    Learnt from all rows with text and language whose id isn't null or held
    out; score is the probability of lang_pred given the text.  Texts that
    are null or have no letter (of any script) are ``und`` with score 1.0; if
    there is nothing to learn from, every text is ``und`` with score 0.0.
    Equal probabilities go to the smaller name.  Repeated rows count and come
    back repeated; other columns aren't read; an empty table gives an empty
    result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    learnt = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = written(bucket_counts(learnt), "language-counts")
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    asked = rows.select(F.struct("doc_id", letters.alias("letters")).alias("row"), "text")
    known = counts.where("bucket < 0").count()
    if not known:
        found = asked.select("row.*", F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    elif known <= at_once:
        found = _best(asked, next(models(counts, at_once))).select("row.*", "lang", F.exp(F.col("best") - F.col("rest")).alias("score"))
    else:
        found = _over_groups(asked, models(counts, at_once))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.when(F.col("letters"), F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"),
                        F.when(F.col("letters"), F.least("score", F.lit(1.0))).otherwise(1.0).alias("score"))
