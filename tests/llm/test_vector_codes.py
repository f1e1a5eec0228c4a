import hashlib
import math
import random

from martflow.llm import vector_codes as V


def plain(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label) -> list of (vec_id, code, error, label_error), digest."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(4096 * x) for x in r[1]] for r in rows]
    w = len(ints[0]) // parts if ints else 0
    part = [[v[p * w:(p + 1) * w] for p in range(parts)] for v in ints]
    books = [[part[i][p] for i in range(min(entries, len(rows)))] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for v in part:
                members.setdefault(near(p, v[p])[1], []).append(v[p])
            for e, xs in members.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, sums = [], {}
    for r, v in zip(rows, part):
        found = [near(p, v[p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
        sums[r[2]] = sums.get(r[2], 0) + out[-1][3]
    text = ",".join(str(x) for b in books for c in b for x in c)
    return [(i, code, err, sums[label]) for i, label, code, err in out], hashlib.sha256(text.encode()).hexdigest()


def test_query_against_plain_rounds(spark, sf_small):
    from martflow.llm.queries import QUERIES
    got = QUERIES["op11_vector_codes"](spark, sf_small).collect()
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    want, digest = plain([(r.vec_id, list(r.embedding), r.label) for r in rows])
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(want)
    assert {r.codebooks_sha256 for r in got} == {digest}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code int, sum_label string")


def test_hot_vectors_ties_nulls_and_repeats(spark):
    rng = random.Random(2)
    hot = [0.5] * 16
    rows = [(i, hot if i % 3 == 0 else [round(rng.uniform(-1, 1), 1) for _ in range(16)], None if i % 5 == 0 else i % 2, 7, "s") for i in range(400)]
    rows += [(1000, None, 1, 7, "s"), (1001, [None] + [0.0] * 15, 1, 7, "s"), (1002, [float("nan")] * 16, 1, 7, "s"), (1003, [float("inf")] * 16, 1, 7, "s"),
             (None, [0.25] * 16, None, 7, "s"), (3, [-0.00001] * 16, 0, 7, "s"), (3, [-0.00001] * 16, 0, 7, "s")]
    out, books = V.vector_codes(_frame(spark, rows).repartition(7))
    want, digest = plain(rows)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in out.collect()), key=key) == sorted(want, key=key)
    assert hashlib.sha256(V.listed(books).encode()).hexdigest() == digest


def test_few_rows_other_lengths_and_empty_tables(spark):
    rows = [(5, [1.0] * 8, 0, 1, ""), (2, [2.0] * 8, 0, 1, ""), (9, [1.0] * 24, 1, 1, ""), (4, [], 1, 1, "")]
    out, books = V.vector_codes(_frame(spark, rows))
    assert sorted((r.vec_id, r.error) for r in out.collect()) == [(2, 0), (5, 0)]
    assert [b.tolist() for b in books] == [[[8192], [4096]]] * 8
    odd, books = V.vector_codes(_frame(spark, [(1, [0.5, 1e30, -1e30], None, 1, "")]))
    assert [b.shape[1] for b in books].count(1) == 3 and odd.first().error == 0
    none, books = V.vector_codes(_frame(spark, [(1, [], 2, 1, "")]))
    assert none.first().error == 0 and V.listed(books) == ""
    empty, books = V.vector_codes(_frame(spark, []))
    assert (empty.count(), books) == (0, []) and empty.columns == out.columns


def test_residents_keep_their_partition(spark):
    """Union of the staying and the migrated parts is no new shuffle."""
    members = spark.sparkContext.parallelize([((0, i % 4, i), V._packed(V.np.array([[i]]), V.np.array([1]))) for i in range(50)])
    members = members.partitionBy(5, V._owner)
    books = [V.np.array([[0], [10], [20], [30]])]
    stay = members.mapPartitions(V._staying(books), preservesPartitioning=True)
    moved = members.mapPartitions(V._leaving(books)).partitionBy(5, V._owner)
    both = stay.union(moved)
    assert both.getNumPartitions() == 5 and both.partitioner == members.partitioner
    at = both.mapPartitionsWithIndex(lambda p, rows: [(p, k) for k, _ in rows]).collect()
    assert all(V._owner(k) % 5 == p for p, k in at)
    values = both.flatMap(lambda kv: [(kv[0][1], int(v)) for v in V._unpacked(kv[1], 1)[0][:, 0]]).collect()
    assert sorted(v for _, v in values) == list(range(50)) and all(e == V.nearest(V.np.array([[v]]), books[0])[0][0] for e, v in values)
