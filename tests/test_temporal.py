import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martflow.operators.temporal import as_of_join, compacted, merge_versions

T0, END = dt.datetime(2024, 1, 1), dt.datetime(2099, 12, 31)
DDL = "k string, a string, b int, active_from timestamp_ntz, active_to timestamp_ntz"


def at(h):
    return T0 + dt.timedelta(hours=h)


def plain_merge(history, changes):
    """Change after change into lists of (from, to, value) per key."""
    out = {}
    for k, a, b, lo, hi in history:
        out.setdefault(k, []).append((lo, hi, (a, b)))
    for k, a, b, t, _ in sorted(changes, key=lambda c: c[4]):
        rows = sorted(out.get(k, []), key=lambda r: r[0])
        later = [r[0] for r in rows if r[0] > t]
        inside = [r for r in rows if r[0] <= t < r[1]]
        stop = min(later + ([inside[0][1]] if inside else []) + [END])
        rows = [r for r in rows if not r[0] <= t < r[1]] + [(r[0], t, r[2]) for r in inside if r[0] < t] + [(t, stop, (a, b))]
        out[k] = rows
    return {(k, *v, lo, hi) for k, rows in out.items() for lo, hi, v in rows}


def plain_compacted(rows):
    out = []
    for k, a, b, lo, hi in sorted(rows, key=lambda r: (r[0], r[3])):
        if out and out[-1][:3] == (k, a, b) and out[-1][4] == lo:
            out[-1] = (*out[-1][:4], hi)
        else:
            out.append((k, a, b, lo, hi))
    return set(out)


@pytest.mark.parametrize("seed", range(3))
def test_histories_against_row_by_row_changes(spark, seed):
    r = random.Random(seed)
    value = lambda: (r.choice(["x", "y", None]), r.choice([1, 2]))
    history = []
    for k in "abcdef":
        h = 0
        for _ in range(r.randint(0, 3)):
            lo = h + r.randint(0, 3) * 10
            h = lo + r.randint(1, 4) * 10
            history.append((k, *value(), at(lo), END if r.random() < 0.2 else at(h)))
            if history[-1][-1] == END:
                break
    df = spark.createDataFrame(history, DDL)
    for _ in range(2):
        changes = [(r.choice("abcdexyz"), *value(), at(r.randint(0, 13) * 10), i) for i in range(15)]
        new = spark.createDataFrame(changes, "k string, a string, b int, t timestamp_ntz, i int")
        got = merge_versions(df, new, "k", ["a", "b"], "t", [F.col("i")])
        rows = {tuple(x) for x in got.collect()}
        assert rows == plain_merge(history, changes)
        assert {tuple(x) for x in compacted(got, "k", ["a", "b"]).collect()} == plain_compacted(rows)
        history, df = sorted(rows, key=str), spark.createDataFrame(sorted(rows, key=str), DDL)


def test_as_of_join_takes_the_valid_version(spark):
    history = spark.createDataFrame([("a", "x", 1, at(0), at(10)), ("a", "y", 2, at(10), at(500)), ("a", "z", 3, at(600), END), ("b", None, 4, at(5), END)], DDL)
    facts = [(i, k, at(h)) for i, (k, h) in enumerate([("a", -1), ("a", 0), ("a", 9), ("a", 10), ("a", 499), ("a", 500), ("a", 600), ("a", 99_999), ("b", 4), ("b", 5), ("c", 7)])]
    facts += [(90, None, at(3)), (91, "a", None)]
    df = spark.createDataFrame(facts, "i int, k string, t timestamp_ntz")
    want = {0: None, 1: 1, 2: 1, 3: 2, 4: 2, 5: None, 6: 3, 7: 3, 8: None, 9: 4, 10: None, 90: None, 91: None}
    for n in (1, 3, 64):
        assert {r.i: r.b for r in as_of_join(df, history, "k", "t", ["a", "b"], buckets=n).collect()} == want
    assert as_of_join(df, history, "k", "t", ["b"], how="inner").count() == 7
    assert as_of_join(df.limit(0), history, "k", "t", ["b"]).count() == 0
