"""Upsert family against a row-at-a-time simulation of ON CONFLICT on
random fixtures (duplicate keys in a batch, NULL payloads, new and old keys)."""

import random

from pyspark.sql import functions as F

from martflow.operators.tables import insert_if_absent, upsert


def _fixture(rnd, n_target=30, n_batch=60):
    target = {k: (f"t{k}", rnd.randint(0, 9)) for k in rnd.sample(range(60), n_target)}
    batch = [(rnd.randint(0, 79), rnd.choice([None, f"s{i}"]), rnd.randint(0, 9), i) for i in range(n_batch)]
    rnd.shuffle(batch)
    return target, batch


def test_upsert_equals_sequential_on_conflict(spark):
    rnd = random.Random(3)
    for _ in range(3):
        target, batch = _fixture(rnd)
        # DO UPDATE all columns, rows applied in seq order
        expect_all = dict(target)
        for k, name, v, _seq in sorted(batch, key=lambda r: r[3]):
            expect_all[k] = (name, v)
        # DO UPDATE SET name only (v kept; inserted rows take their own v)
        expect_part = dict(target)
        for k, name, v, _seq in sorted(batch, key=lambda r: r[3]):
            expect_part[k] = (name, expect_part[k][1]) if k in expect_part else (name, v)
        # DO NOTHING, rows applied in seq order: the first new row per key wins
        expect_none = dict(target)
        for k, name, v, _seq in sorted(batch, key=lambda r: r[3]):
            expect_none.setdefault(k, (name, v))

        t = spark.createDataFrame([(k, *v) for k, v in target.items()], "k int, name string, v int")
        b = spark.createDataFrame(batch, "k int, name string, v int, seq int")
        order = [F.col("seq")]

        def as_dict(df):
            return {r.k: (r.name, r.v) for r in df.collect()}

        assert as_dict(upsert(t, b, ["k"], order)) == expect_all
        assert as_dict(upsert(t, b, ["k"], order, update_cols=["name"])) == expect_part
        assert as_dict(insert_if_absent(t, b, ["k"], order)) == expect_none
        # idempotent: the same batch applied twice equals once
        once = upsert(t, b, ["k"], order)
        assert as_dict(upsert(once, b, ["k"], order)) == expect_all
        once = upsert(t, b, ["k"], order, update_cols=["name"])
        assert as_dict(upsert(once, b, ["k"], order, update_cols=["name"])) == expect_part
        once = insert_if_absent(t, b, ["k"], order)
        assert as_dict(insert_if_absent(once, b, ["k"], order)) == expect_none
