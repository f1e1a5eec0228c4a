import random
import zlib

import numpy as np

from martflow.llm import toxicity as X
from martflow.llm.queries import QUERIES


def made(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(n):
        words, toxic = [word() for _ in range(rng.randint(5, 120))], i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randint(0, len(words)), rng.choice(["moron", "Stupid", "vermin"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")


def test_held_out_accuracy_of_made_texts(spark):
    rows = made(900)
    got = {r.doc_id: r for r in X.toxicity(*frames(spark, rows)).collect()}
    assert len(got) == 900
    held = [(got[i].predicted, t) for i, _, t in rows if got[i].held_out]
    assert 200 < len(held) and np.mean([p == t for p, t in held]) > 0.97
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_held_out_labels_change_nothing(spark):
    rows = made(300)
    turned = [(i, t, 1 - x if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, t, x in rows]
    a, b = ({r.doc_id: r.score for r in X.toxicity(*frames(spark, r)).collect()} for r in (rows, turned))
    assert a == b


def test_odd_tables(spark):
    rows = made(200)
    docs, labels = frames(spark, rows)
    odd = docs.unionByName(spark.createDataFrame([(None, None), (500, ""), (501, "moron"), (501, "moron"), (502, "a" * 300_000), (503, "moron " * 40_000)], "doc_id long, text string"))
    odd = odd.selectExpr("*", "1 AS toxic", "'z' AS score")
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (500, None), (0, 0), (999, 1)], "doc_id long, toxic int"))
    got = X.toxicity(odd, labels).collect()
    assert len(got) == 206 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[501] > by[500] == by[None]
    assert X.toxicity(docs.limit(0), labels).count() == 0
    assert {round(r.score, 6) for r in X.toxicity(docs, labels.limit(0)).collect()} == {0.5}
    one_class = X.toxicity(docs, labels.where("toxic = 0")).collect()
    assert all(r.predicted == 0 for r in one_class)


def test_sample_is_bounded(spark):
    rows = made(300)
    sample = X.training_sample(*frames(spark, rows), sample=20)
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    assert set(sizes) == {True, False} and all(15 <= n <= 20 for n in sizes.values())


def test_copies_count_once(spark):
    rows = made(200) + [(1000 + i, "one and the same harmless text that is marked toxic, over and over", 1) for i in range(200)]
    docs, labels = frames(spark, rows)
    assert X.training_sample(docs, labels).where("text LIKE 'one and the same%'").count() == 1


def test_ratios_and_regression(spark):
    counts = spark.createDataFrame([(3, 40, 0), (5, 10, 10), (9, 1, 30)], "bucket long, toxic long, other long")
    r = {x.bucket: x.ratio for x in X.log_ratios(counts, 50, 50).collect()}
    assert set(r) == {3, 9} and r[3] > 2 and r[9] < -2
    w, bias = X.regress(np.array([0, 1]), np.array([0, 0]), np.array([1.0, 1.0]), np.array([1.0, 1.0, 0.0, 0.0]), 1, penalty=0.01)
    assert w[0] > 1 and bias < 0


def _mixed(h, m):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & m
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & m
    return h ^ h >> 31


def plain_features(text, memo):
    """Level and bucket of every n-gram of a text, reached by its count there."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    times = {}
    for n in X.SIZES:
        for i in range(len(raw) - n + 1):
            g = raw[i:i + n]
            if g not in memo:
                m = (1 << 64) - 1
                memo[g] = _mixed((sum(int(X.SubstringHash.VALUES[b]) * pow(X.SubstringHash.BASE, k, 1 << 64) for k, b in enumerate(g)) + n) & m, m) >> 64 - X.BITS
            times[memo[g]] = times.get(memo[g], 0) + 1
    return {level << X.BITS | b for b, n in times.items() for level, least in enumerate(X.LEVELS) if n >= least}


def plain_scores(docs, labels):
    """docs: id -> text; labels: id -> toxic -> id -> score."""
    memo, seen = {}, {}
    for i in sorted(labels):
        if i in docs and zlib.crc32(str(i).encode()) % 3 != 1:
            seen.setdefault((bool(labels[i]), bytes(b + 32 if 65 <= b <= 90 else b for b in (docs[i] or "").encode())), i)
    train = [(toxic, plain_features(docs[i], memo)) for (toxic, _), i in seen.items()]
    sizes = [sum(1 for t, _ in train if t == side) for side in (False, True)]
    counts = {}
    for toxic, held in train:
        for f in held:
            counts.setdefault(f, [0, 0])[toxic] += 1

    def part(k, expected):
        return k * np.log(max(k, 1e-9) / max(expected, 1e-9))

    ratio = {}
    for f, (o, t) in counts.items():
        both = (t + o) / sum(sizes)
        g = 2 * (part(t, sizes[1] * both) + part(sizes[1] - t, sizes[1] * (1 - both)) + part(o, sizes[0] * both) + part(sizes[0] - o, sizes[0] * (1 - both)))
        if g >= 2 * np.log(len(counts)) + 4:
            ratio[f] = np.float32(np.log((t + 1) / (sizes[1] + 2)) - np.log((o + 1) / (sizes[0] + 2)))
    features = sorted(ratio)
    place = {f: j for j, f in enumerate(features)}
    value = np.array([ratio[f] for f in features], dtype=float)
    held = [sorted(place[f] for f in fs if f in place) for _, fs in train]
    row, at = np.repeat(np.arange(len(train)), [len(h) for h in held]), np.array([j for h in held for j in h], dtype=int)
    w, bias = X.regress(row, at, value[at], np.array([t for t, _ in train], dtype=float), len(features))
    return {i: 1 / (1 + np.exp(-(bias + sum(w[place[f]] * ratio[f] for f in plain_features(t, memo) if f in place)))) for i, t in docs.items()}


def test_query_against_plain_counts_and_scores(spark, tmp_path):
    # a part of sf0.01 with labels of both classes
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    some = {i: t for i, t in docs.items() if i in labels and len(t or "") < 3000}
    spark.createDataFrame(list(some.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, labels[i]) for i in some], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = plain_scores(some, {i: labels[i] for i in some})
    got = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, str(tmp_path)).collect()}
    assert set(got) == set(want) and len({round(x, 3) for x in want.values()}) > 10
    for i, x in want.items():
        assert abs(got[i].score - x) < 1e-4 and got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_query(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = QUERIES["op7_toxicity"](spark, sf_small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
