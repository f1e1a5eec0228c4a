import random

import xxhash
from pyspark.sql import functions as F

from martflow.llm import simhash as S


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(pairs, distance):
    """pairs: (doc_id, fp) -> {row index: least doc_id reachable}."""
    parent = list(range(len(pairs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= distance:
                parent[find(i)] = find(j)
    out = {}
    for i in range(len(pairs)):
        out.setdefault(find(i), []).append(pairs[i][0])
    return [min(out[find(i)]) for i in range(len(pairs))]


def test_fingerprints_of_odd_texts(docs_of):
    texts = [None, "", " \t\n", "One", "one TWO three", "ÄÖ über\x0bx\x0cy z w", "a b c d", "a b c d e " * 50, "Ab cD eF gH iJ"]
    rows = S.fingerprints(docs_of(texts)).collect()
    assert {r.doc_id: r.fp % (1 << 64) for r in rows} == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_every_link_shares_a_mask():
    rng = random.Random(1)
    for blocks in (5, 6, 7):
        masks = S.block_masks(blocks, 4)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
            assert any(not diff & m for m in masks)
    assert S.blocks_for(1000, 4) == 5 < S.blocks_for(50_000_000, 4) < S.blocks_for(10 ** 10, 4)


def _planted(rng, n, centres):
    fps = []
    for _ in range(centres):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, n)):
            fps.append(f)
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6)))
    return fps


def test_links_give_the_components_of_all_pairs(spark):
    rng = random.Random(3)
    fps = list(dict.fromkeys(_planted(rng, 12, 40)))
    want = plain_components([(f, f) for f in fps], 4)
    df = spark.createDataFrame([(S._as_long(f),) for f in fps], "fp long")
    for kwargs in ({}, {"blocks": 6}, {"group_rows": 1}):
        comps = {r.node: r.root for r in S.components(S.links(df, 4, **kwargs)).collect()}
        got = {}
        for f in fps:
            got.setdefault(comps.get(S._as_long(f), S._as_long(f)), set()).add(f)
        expected = {}
        for f, c in zip(fps, want):
            expected.setdefault(c, set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_odd_distance_half_way(spark):
    rng = random.Random(5)
    fps = list(dict.fromkeys(_planted(rng, 6, 8)))
    df = spark.createDataFrame([(S._as_long(f),) for f in fps], "fp long")
    for r in S.half_way_links(df, 3).collect():
        assert 0 < ((r.a ^ r.b) % (1 << 64)).bit_count() <= 3
    comps = {r.node: r.root for r in S.components(S.half_way_links(df, 3)).collect()}
    want = plain_components([(f, f) for f in fps], 3)
    groups = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(comps.get(S._as_long(f), S._as_long(f)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({x for g in groups.values() for x in g}) == len(groups)


def test_query_against_all_pairs(spark, sf_small):
    from martflow.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op5_simhash_near_dedup"](spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    fps = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    for (i, fp), c in zip(fps, plain_components(fps, 4)):
        assert (got[i].fingerprint, got[i].component_id) == (f"{fp:016x}", c)
    assert len(got) == len(docs)


def test_empty_repeated_and_extra_columns(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(4, "a b c d e", "x"), (4, "a b c d e", "x"), (None, "a b c d e", "y"), (9, None, None)],
                               "doc_id long, text string, fp string")
    rows = S.near_duplicates(df).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in rows) == [(-1, 4), (4, 4), (4, 4), (9, 9)]
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 4, 9]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(chain + star + [(5, 5), (None, 7), (1001, 1000)], "a long, b long")
    got = {r.node: r.root for r in S.components(df).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert S.components(df.where("a = -1")).agg(F.count("*")).first()[0] == 0


def test_different_texts_under_one_id_stay(spark):
    long = " ".join(f"a{i}" for i in range(40))
    other = " ".join(f"b{i}" for i in range(40))
    rows = [(1, long, 1), (1, other, 2), (2, long, 3), (3, other, 4), (3, other, 4), (4, None, 5), (5, "", 6), (None, long, 7), (None, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = S.keep_one(df)
    assert kept.columns == df.columns and sorted(r.row for r in kept.collect()) == [1, 2, 5, 7, 8]
    assert S.keep_one(df.where("doc_id > 2")).count() == 2  # the repeated row once, one of the blank texts
    assert S.keep_one(df.limit(0)).count() == 0
