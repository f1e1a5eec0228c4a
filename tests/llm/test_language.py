import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import language as L


def out_of_training(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def plain_grams(text):
    """bucket -> times, n-gram by n-gram; buckets named by the operator's hash of a lone n-gram."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 97 <= b <= 122 else 32 for b in text.encode())
    out = {}
    for n in L.SIZES:
        for i in range(len(raw) - n + 1):
            g = raw[i:i + n]
            if g.strip(b" "):
                out[g] = out.get(g, 0) + 1
    buckets = {}
    for g, k in out.items():
        data = np.frombuffer(g, dtype=np.uint8)
        b = int(L.SubstringHash(data).of(np.array([0]), np.array([len(g)]))[0] >> np.uint64(64 - L.BITS))
        buckets[b] = buckets.get(b, 0) + k
    return buckets


def plain(rows):
    """rows (doc_id, text, lang) -> [(doc_id, held_out, lang_pred, score)]"""
    counts, docs = {}, {}
    for i, text, lang in rows:
        if i is not None and text is not None and lang is not None and not out_of_training(i):
            docs[lang] = docs.get(lang, 0) + 1
            mine = counts.setdefault(lang, {})
            for b, k in plain_grams(text).items():
                mine[b] = mine.get(b, 0) + k
    out = []
    for i, text, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            out.append((i, out_of_training(i), "und", 1.0))
            continue
        grams = plain_grams(text)
        logs = {}
        for lang, mine in sorted(counts.items()):
            size = sum(mine.values()) + L.SMOOTH * (1 << L.BITS)
            logs[lang] = math.log(docs[lang] / sum(docs.values())) + sum(k * math.log((mine.get(b, 0) + L.SMOOTH) / size) for b, k in grams.items())
        best = max(logs.values())
        out.append((i, out_of_training(i), max(logs, key=logs.get), 1 / sum(math.exp(x - best) for x in logs.values())))
    return out


def check(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-6, abs=1e-9)


def test_query_against_plain_counts(spark, sf_small):
    from martflow.llm.queries import QUERIES
    got = QUERIES["op13_language_id"](spark, sf_small)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    check(got.collect(), plain([(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    right, n = rows.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right / n > 0.98


ODD = [(0, None, "en"), (1, "", "en"), (2, "123 !?", "de"), (3, "the cat and the dog", "en"), (4, "der hund und die katze", "de"), (5, "THE dog", None),
       (6, "die Katze", "de"), (None, "the the the", "de"), (None, None, None), (8, "x" * 40_000, "en"), (3, "the cat and the dog", "en"), (9, "ж", "ru"),
       (10, "le chat", "fr"), (11, "el gato", "es"), (12, "the end", "en"), (13, "ª٠", "en")]


def test_odd_rows_and_language_groups(spark):
    df = spark.createDataFrame([(i, t, lang, "x", 1) for i, t, lang in ODD], "doc_id long, text string, lang string, bucket string, row int")
    want = plain(ODD)
    check(L.languages(df).collect(), want)
    check(L.languages(df, at_once=2).collect(), want)


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string, lang string"
    assert L.languages(spark.createDataFrame([], schema)).count() == 0
    rows = L.languages(spark.createDataFrame([(1, "a", None), (2, None, "en"), (3, "1", None)], schema)).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in rows} == {1: ("und", 0.0), 2: ("und", 1.0), 3: ("und", 1.0)}
