import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import language_model as L


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, weight=0.7):
    """docs: (id, text, target) -> [(id, n, ce_target, ce_background)]."""
    tokens = [(i, words_of(t), x) for i, t, x in docs]
    pairs_of = lambda ws: list(zip(["<s>"] + ws, ws))
    size = len({w for _, ws, _ in tokens for w in ws}) + 2
    counts = []
    for only in (False, True):
        c2, c1, h = {}, {}, {}
        for _, ws, x in tokens:
            if x or not only:
                for a, b in pairs_of(ws):
                    c2[a, b] = c2.get((a, b), 0) + 1
                    c1[b] = c1.get(b, 0) + 1
                    h[a] = h.get(a, 0) + 1
        counts.append((c2, c1, h))

    sums = [sum(c[1].values()) for c in counts]
    assert sums[0] == sum(len(ws) for _, ws, _ in tokens)
    memo = {}

    def loss(m, a, b):
        if (m, a, b) not in memo:
            c2, c1, h = counts[m]
            single = (c1.get(b, 0) + 1) / (sums[m] + size)
            memo[m, a, b] = -math.log(weight * c2.get((a, b), 0) / h[a] + (1 - weight) * single if a in h else single)
        return memo[m, a, b]

    return [(i, len(ws), *(sum(loss(m, a, b) for a, b in pairs_of(ws)) / len(ws) if ws else None for m in (1, 0))) for i, ws, _ in tokens]


def made(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        pool = ["the", "cat", "sat", "On", "mat", "ünd"] if i % 2 else ["der", "hund", "lag", "im", "7", "garten"]
        out.append((i, " ".join(rng.choice(pool) + rng.choice(["", ".", ","]) for _ in range(rng.randint(0, 40))), bool(i % 2)))
    return out + [(1000, None, True), (1001, "", False), (1002, "zyx " + "q w" * 3, None)]


def scores(spark, rows, **kwargs):
    # columns that clash with the operator's own
    df = spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "doc_id long, text string, target boolean, score string, batch int, blob binary")
    return L.cross_entropies(df.repartition(3), F.col("target"), **kwargs).collect()


def check(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens)), sorted(want, key=key)
    assert [(r.doc_id, r.n_tokens) for r in got] == [w[:2] for w in want]
    for r, (_, n, t, b) in zip(got, want):
        if n:
            assert (r.ce_target, r.ce_background, r.score) == pytest.approx((t, b, t - b), abs=1e-9)
            assert r.selected == (r.score < 0)
        else:
            assert r.ce_target is None and r.score is None and not r.selected


def test_against_plain_in_batches_of_any_size(spark):
    rows = made(60) + [(1, "the cat", True), (1, "the cat", True), (None, "a cat", False), (None, None, None), (1003, "cat " * 30_000, False)]
    want = plain(rows)
    for batch_bytes in (15_000, L.BATCH_BYTES):
        check(scores(spark, rows, batch_bytes=batch_bytes), want)


def test_blocks_come_back_as_they_were():
    rng = np.random.default_rng(1)
    arrays = [np.zeros(0, np.uint64), np.zeros(3, np.uint64), rng.integers(0, 300, 50).astype(np.uint64), rng.integers(0, 2 ** 63, 50).astype(np.uint64)]
    assert [x.tolist() for x in L._unpacked(L._packed(*arrays))] == [x.tolist() for x in arrays]


def test_target_documents_score_lower(spark):
    got = {r.doc_id: r for r in scores(spark, made(100))}
    known = [(got[i].score, t) for i, x, t in made(100) if t is not None and got[i].n_tokens > 5 and i < 1000]
    assert max(s for s, t in known if t) < min(s for s, t in known if not t)


def test_empty_table_and_no_target(spark):
    df = spark.createDataFrame([(1, "a b")] * 3 + [(None, "a"), (2, "")], "doc_id long, text string")
    empty = L.cross_entropies(df.limit(0), F.lit(True))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ce_target", "ce_background", "score", "selected"]
    check(L.cross_entropies(df, F.lit(False)).collect(), plain([(1, "a b", False)] * 3 + [(None, "a", False), (2, "", False)]))


def test_query_against_plain(spark, sf_small):
    from martflow.llm.queries import QUERIES
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = QUERIES["op9_lm_scoring"](spark, sf_small).collect()
    check(rows, plain([(i, d.text, d.lang == "en") for i, d in docs.items()]))
    got = {r.doc_id: r for r in rows}
    english = [got[i].score for i, d in docs.items() if d.lang == "en" and got[i].n_tokens > 20]
    others = [got[i].score for i, d in docs.items() if d.lang != "en" and got[i].n_tokens > 20]
    assert np.median(english) < np.median(others)


def test_rare_words_count_at_every_size(spark, tmp_path):
    # at 300,000 words a share of 1e-5 would drop words seen once or twice
    from martflow.llm.queries import QUERIES
    rows = made(60) + [(2000, "cat " * 300_000, False), (2001, "rare words stand here", True), (2002, "rare words fall there", False)]
    docs = [(i, t, "en" if x else None if x is None else "de") for i, t, x in rows] * 2 + [(None, "rare", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    check(QUERIES["op9_lm_scoring"](spark, str(tmp_path)).collect(), plain([(i, t, x == "en") for i, t, x in docs]))
