import hashlib
import random
import re

from martflow.llm import decontaminate as D


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words_of(text)
        size = min(span, len(w))
        if size and item is not None:
            for i in range(len(w) - size + 1):
                windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, got = words_of(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i:i + size])):
                    hit.update(range(i, i + size))
                    got |= found
        sha = hashlib.sha256(",".join(sorted(map(str, got))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(got), sha, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in D.contamination(d, b).collect()), key=str)


def test_query_against_plain(spark, sf_small):
    from martflow.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op8_decontamination"](spark, sf_small).collect()), key=str)
    assert got == plain(docs, items) and any(r[-1] for r in got)


def test_random_spans_of_a_small_vocabulary(spark, monkeypatch):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "Ünder", "7"])
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(20)]
    docs = []
    for i in range(120):
        parts = [word() for _ in range(rng.randint(0, 25))]
        if i % 2:
            parts += items[rng.randrange(20)][1].split()[rng.randint(0, 5):][:rng.randint(5, 14)] + [word()]
        docs.append((i, ",".join(parts)))
    want = plain(docs, items)
    assert run(spark, docs, items) == want
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert run(spark, docs, items) == want


def test_odd_rows(spark):
    items = [(1, "one two three"), (1, "one two three"), (2, None), (3, " .;"), (None, "four five six"), (4, "UNO"), (5, " ".join("abcde")),
             (6, " ".join(f"w{i}" for i in range(10)))]
    docs = [(1, None), (2, ""), (3, "x ONE, two\nthree x"), (3, "x ONE, two\nthree x"), (None, "uno"), (4, "a b c d e a b c d"),
            (5, " ".join(f"w{i}" for i in range(9))), (6, "w0 " * 30_000 + " ".join(f"w{i}" for i in range(10))), (7, "one two"), (8, "three")]
    assert run(spark, docs, items) == plain(docs, items)
    assert run(spark, docs, []) == plain(docs, [])
    assert run(spark, [], items) == []
    clean = D.keep_clean(spark.createDataFrame([(i or 0, t, "k") for i, t in docs], "doc_id long, text string, cls string"),
                         spark.createDataFrame(items, "item_id long, text string"))
    assert sorted({r.doc_id for r in clean.collect()}) == [1, 2, 5, 7, 8] and clean.columns == ["doc_id", "text", "cls"]


def test_clean_rows_stay_whatever_shares_their_id(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    items = spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string")
    rows = [(1, f"x {passage} y", 1), (1, "clean", 2), (None, passage, 3), (None, "clean", 4), (None, None, 5), (2, "", 6), (1, f"x {passage} y", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bad_id int")
    kept = D.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.bad_id for r in kept.collect()) == [2, 4, 5, 6]
    assert D.keep_clean(docs.limit(0), items).count() == 0 and D.keep_clean(docs, items.limit(0)).count() == 7


def test_a_phrase_of_many_items_joins_only_within_a_shared_span(spark):
    phrase = "five words that all share"
    around = lambda tag, n=8: " ".join(f"{tag}{i}" for i in range(n))
    items = [(k, f"{around(f'a{k}x')} {phrase} {around(f'b{k}x')}") for k in range(40)]
    docs = [(i, f"{around(f'c{i}x')} {phrase} {around(f'd{i}x')}") for i in range(60)]
    docs += [(100, f"a7x5 a7x6 a7x7 {phrase} b7x0 b7x1 end"), (101, f"a7x7 {phrase} b7x0 b7x1 b7x2"), (102, f"z {phrase} b9x0 b9x1 b9x2 b9x3 b9x4")]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in D.contamination(df, it).collect() if r.contaminated}
    assert got == {r[0]: (r[2], r[3]) for r in plain(docs, items) if r[-1]}
    assert set(got) == {100, 102}
    rows, spans, _ = D.matches(df, it)
    assert spans.count() == sum(1 for i in (100, 102) for _ in range(got[i][0] - 9))
