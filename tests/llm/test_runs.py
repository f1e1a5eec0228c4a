import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from martflow.llm import runs as R


def plain_runs(words):
    """Every period by itself: stretches of words that equal the one a period back."""
    ids = {}
    words = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    out = {}
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate(([False], words[q:] == words[:-q], [False]))
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for a, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            start, length = a, e - a + q
            if length >= max(6, 4 * q):
                # a multiple of a smaller period covers the same stretch
                out.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda x: (x[0], x[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (len(runs), *first, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 7), st.integers(0, 40), st.lists(st.integers(0, 2), max_size=8))
def test_runs_against_every_period(head, period, length, tail):
    middle = [(head + [3])[i % min(period, len(head) + 1)] for i in range(length)]
    words = head + middle + tail
    assert sorted(R.runs_of(words), key=lambda x: (x[0], x[2])) == plain_runs(words)


def test_long_nested_runs():
    block = [0, 0, 0, 0, 0, 0, 1]
    for words in (block * 5, [0] * 300, (block * 4 + [2]) * 6, [0, 1] * 50 + [0, 1, 2] * 40):
        assert sorted(R.runs_of(words), key=lambda x: (x[0], x[2])) == plain_runs(words)


def test_query_against_every_period(spark, sf_small):
    from martflow.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    assert len(got) == len(docs)
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    for d in docs:
        assert tuple(got[d.doc_id][c] for c in columns) == plain_row(d.doc_id, d.text), d.doc_id
    assert sum(r.n_runs > 0 for r in got.values()) > 5


def test_odd_rows(spark, tmp_path):
    from martflow.llm.queries import QUERIES
    rng = random.Random(4)
    long = " ".join(rng.choice("ab") for _ in range(3000)) + " x y z" * 2000
    texts = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "Ä\x0bÄ\tÄ\fÄ\rÄ\nÄ", "a b " * 3, "a b " * 4, long, "  " * 9, "q r s t " * 4 + "q r s t"]
    rows = [(i, t, "x", [1]) for i, t in enumerate(texts)]
    rows += [(i, "w%d v u " % (i % 3) * 15 + "end", "y", [2]) for i in range(20, 90)]
    rows += [(5, "a " * 7, "z", [3]), (5, "a " * 7, "z", [3]), (None, "a " * 8, "z", [3]), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed array<int>")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted((repr(r.doc_id), *(r[c] for c in columns[5:])) for r in got) == sorted((repr(i), *plain_row(i, t)[5:]) for i, t, *_ in rows)
    by_id = {r.doc_id: r for r in got}
    for i in (0, 1, 4, 9, 10, *range(20, 90)):
        assert tuple(by_id[i][c] for c in columns) == plain_row(i, dict((x[0], x[1]) for x in rows)[i])


def test_collapsed_text_and_empty_table(spark, docs_of):
    row = R.periodic_runs(docs_of(["so  la la la la la la end"])).first()
    assert (row.n_words, row.collapsed) == (8, "so la end")
    assert [tuple(x) for x in row.runs] == [(1, 6, 1)]
    assert R.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
