import hashlib
import random

from martflow.llm import repeats as R


def plain(docs, length):
    """docs in order: (bytes) -> (n_bytes, n_removed, n_spans, sha) each."""
    seen, out = set(), []
    for body in docs:
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            w = body[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(b for b, g in zip(body, gone) if not g)
        out.append((len(body), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def check(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.without_repeats(df, **how).collect()}
    want = plain([(t or "").encode() for t in texts], how.get("length", R.LENGTH))
    assert [got[i] for i in range(len(texts))] == want
    return want


def made(rng, n, alphabet):
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(8)]
    out = []
    for _ in range(n):
        t = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, len(t))
            t = t[:a] + rng.choice(["", "x", rng.choice(base)[:150]]) + t[a + rng.randint(0, 2):]
        out.append(t)
    return out


def test_random_texts(spark):
    rng = random.Random(1)
    check(spark, made(rng, 60, "abcdefgh é"))
    check(spark, made(rng, 40, "ab"))
    check(spark, made(rng, 40, "ab"), length=40, gram=8)


def test_every_anchor_crowded(spark):
    rng = random.Random(2)
    assert any(w[1] for w in check(spark, made(rng, 50, "abcdef"), crowd=0.0, least=1))
    line = "the same line of more than thirty-two bytes in all"
    check(spark, [f"{''.join(rng.choice('abc') for _ in range(80))}{line}{''.join(rng.choice('abc') for _ in range(80))}" for _ in range(60)], least=5)


def test_large_groups_around_one_anchor(spark):
    rng = random.Random(6)
    assert any(w[1] for w in check(spark, made(rng, 50, "abcdef"), group=1))
    line = "one line of more than thirty-two bytes, the same in all"
    check(spark, [f"{rng.choice(['q' * 90, ''.join(rng.choice('abc') for _ in range(90))])}{line}{''.join(rng.choice('abc') for _ in range(90))}" for _ in range(60)], group=20)


def test_odd_texts(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefghij klmnop") for _ in range(60_000))
    texts = [None, "", "x" * 99, "x" * 100, "x" * 101, " " * 500, "ab" * 300, long, long[1000:3000], "é" * 120, long, "x" * 100, "ab" * 50]
    check(spark, texts)
    check(spark, [])


def test_pieces_and_folds(spark, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(R, "PIECE", 700)
    monkeypatch.setattr(R, "TOGETHER", 350)
    monkeypatch.setattr(R, "FOLD", 50)
    monkeypatch.setattr(R, "SORT_BYTES", 500)
    texts = made(rng, 30, "abcd") + ["".join(made(rng, 20, "abcd"))]
    import pyarrow as pa
    import numpy as np
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts])], names=["doc", "body"])
    parts = list(R._folded(iter([rows]), 100, 32, np.zeros(0, np.uint64)))
    windows = sum(int(x[4].sum()) for part in parts for x in part)
    assert windows == sum(max(len(t.encode()) - 99, 0) for t in texts) and len(parts) > 3


def test_repeated_ids(spark):
    rng = random.Random(5)
    a, b = ("".join(rng.choice("abcdefgh") for _ in range(300)) for _ in range(2))
    df = spark.createDataFrame([(7, a, 1), (7, a, 1), (7, a, 2), (None, b, 0), (3, b + a, 0), (3, None, 0), (3, None, 1)], "doc_id long, text string, body int")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in R.without_repeats(df).collect())
    assert got == [(0, 300, 0), (3, 0, 0), (3, 0, 0), (3, 600, 300), (7, 300, 300), (7, 300, 300), (7, 300, 300)]


def test_query_against_plain(spark, sf_small):
    from martflow.llm.queries import QUERIES
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op2_suffix_dedup"](spark, sf_small).collect()}
    assert [got[d.doc_id] for d in docs] == plain([d.text.encode() for d in docs], 100)
    assert any(g[1] for g in got.values())
