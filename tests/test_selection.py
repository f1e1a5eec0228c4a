import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martflow.operators import selection as S

KINDS = {
    "n": ("long", lambda r: r.choice([None, *range(-5, 6), 2 ** 62])),
    "d": ("decimal(29,5)", lambda r: r.choice([None, Decimal("1.50000"), Decimal("-7.25000"), Decimal("99999999999999999.00001"), Decimal(r.randrange(9))])),
    "t": ("timestamp_ntz", lambda r: r.choice([None, dt.datetime(1969, 12, 31, 23), dt.datetime(2024, 1, r.randint(1, 9))])),
    "s": ("string", lambda r: r.choice([None, "", "a", "b", "ä"])),
}


def ordered(rows, order):
    """Rows by the order, key by key from the last (sorts are stable)."""
    names = list(KINDS) + ["u"]
    for key in reversed(order):
        at = names.index(key.name)
        value = lambda r: r[at].encode() if isinstance(r[at], str) else r[at]
        some = sorted((r for r in rows if r[at] is not None), key=value, reverse=key.desc)
        none = [r for r in rows if r[at] is None]
        rows = none + some if key.null_leads else some + none
    return rows, [names.index(k.name) for k in order]


@pytest.mark.parametrize("seed", range(3))
def test_keys_at_ranks_against_sorting(spark, seed, monkeypatch):
    monkeypatch.setattr(S, "SPLITS", 3)
    r = random.Random(seed)
    rows = [tuple(make(r) for _, make in KINDS.values()) + (i,) for i in range(120)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} {t}" for k, (t, _) in KINDS.items()) + ", u long").repartition(3)
    names = r.sample(list(KINDS), 2)
    order = [S.Key(n, desc=r.random() < 0.5, nulls_first=r.choice([None, True, False])) for n in names] + [S.Key("u")]
    want, at = ordered(rows, order)
    ranks = [0, 1, 2, 40, 41, 119, 120, 121]
    for bound in (9, 1000):
        got = S.keys_at(df, order, ranks, bound=bound)
        assert got == {k: tuple(want[k - 1][i] for i in at) for k in ranks if 0 < k <= 120}
        assert df.filter(S.after(order, got[40])).count() == 80
    out = {x.u: x.b for x in S.ntile(df, 7, order, "b", bound=9).collect()}
    q, rest = divmod(120, 7)
    sizes = [q + (i < rest) for i in range(7)]
    assert [out[row[-1]] for row in want] == [b + 1 for b, size in enumerate(sizes) for _ in range(size)]


def test_ntile_of_equal_rows_and_of_few(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(None,)] * 3, "x long")
    counts = {r.b: r["count"] for r in S.ntile(df, 4, [S.Key("x")], "b", bound=2).groupBy("b").count().collect()}
    assert counts == {1: 4, 2: 3, 3: 3, 4: 3}
    assert [r.b for r in S.ntile(df.limit(2), 5, [S.Key("x")], "b").orderBy("b").collect()] == [1, 2]
    assert S.ntile(df.limit(0), 5, [S.Key("x")], "b").count() == 0 and S.keys_at(df.limit(0), [S.Key("x")], [1]) == {}


def test_selection_moves_no_rows(spark):
    """Counting plans hold partial aggregates only: no sort, no exchange of rows."""
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("x"))
    assert S.keys_at(df, [S.Key("x")], [50_000], bound=100)[50_000] == (sorted(i * 7919 % 100_003 for i in range(100_000))[49_999],)


def test_sessions_that_end_on_a_missing_id_lose_nothing(spark):
    from martflow.operators.cursor import empty_state
    from martflow.plans import staging as P
    rows = [(None, "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:00:00", 2), ("b", "2024-01-01 00:00:00", 3), (None, None, 4), (None, "2024-01-02 00:00:00", 5), ("a", "2024-01-03 00:00:00", 6)]
    docs = spark.createDataFrame(rows, "_id string, ts string, v int").selectExpr("_id", "cast(ts as timestamp_ntz) as update_ts", "v")
    staged, state = spark.createDataFrame([], P.STAGED_DOC_DDL), empty_state(spark)
    ends = P.session_ends(docs, state, limit=1)
    assert [e[1] for e in ends] == [None, None, "a", "b", None, "a"]
    for _ in range(7):
        staged, state = P.copy_collection(staged, docs, state, limit=1)
    import json
    got = sorted(json.loads(r.object_value)["v"] for r in staged.collect())
    assert got == [1, 3, 4, 5, 6]  # "a" was refreshed by its later copy
