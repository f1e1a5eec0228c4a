"""X6 against a plain-Python statement of PostgreSQL's AGE rule (field-wise
difference, negative fields borrow from the next larger unit; a negative day
count borrows the length of the month of the earlier stamp), on random pairs."""

import calendar
import datetime as dt
import random

from martflow.functions.scalars import age_day_part


def pg_age_day_part(a: dt.datetime, b: dt.datetime) -> int:
    """Symbolic a - b: subtract every field, flip so the difference is
    positive, carry negative fields upward (a negative day count takes the
    length of the earlier stamp's month), flip back, return the day field."""
    f = [a.microsecond - b.microsecond, a.second - b.second, a.minute - b.minute, a.hour - b.hour,
         a.day - b.day, a.month - b.month, a.year - b.year]
    neg = a < b
    if neg:
        f = [-x for x in f]
    lo = a if neg else b
    limits = [1_000_000, 60, 60, 24]
    for i, lim in enumerate(limits):  # usec -> sec -> min -> hour -> day
        while f[i] < 0:
            f[i] += lim
            f[i + 1] -= 1
    while f[4] < 0:  # day -> month
        f[4] += calendar.monthrange(lo.year, lo.month)[1]
        f[5] -= 1
    while f[5] < 0:  # month -> year
        f[5] += 12
        f[6] -= 1
    return -f[4] if neg else f[4]


def test_age_day_part_matches_rule_on_random_pairs(spark):
    rnd = random.Random(7)
    base = dt.datetime(2019, 1, 1)
    pairs = []
    for _ in range(3000):
        a = base + dt.timedelta(seconds=rnd.randint(0, 4 * 365 * 86400), microseconds=rnd.randint(0, 999_999))
        b = base + dt.timedelta(seconds=rnd.randint(0, 4 * 365 * 86400), microseconds=rnd.randint(0, 999_999))
        pairs.append((a, b))
    # month ends and equal times of day
    for d1, d2 in [((2021, 1, 31), (2021, 3, 5)), ((2020, 2, 29), (2020, 3, 31)), ((2021, 12, 31), (2022, 1, 1))]:
        pairs.append((dt.datetime(*d1), dt.datetime(*d2)))
        pairs.append((dt.datetime(*d2), dt.datetime(*d1)))
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", age_day_part("a", "b").alias("d")).collect()
    bad = [(r.a, r.b, r.d, pg_age_day_part(r.a, r.b)) for r in got if r.d != pg_age_day_part(r.a, r.b)]
    assert bad == []
