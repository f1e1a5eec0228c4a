"""Scalar functions: edge rows of FIXTURES.md (descriptors, ages, month names)."""

import datetime as dt

from pyspark.sql import functions as F

from martflow.functions.scalars import (age_day_part, month_name_padded, parse_doc_ts, part,
                                        split_descriptor, time_text)


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_split_descriptor_doubled_and_short(spark):
    df = spark.createDataFrame([("12:vsp-34:0.02:0.023",), ("1p::car",), ("3p",), ("a:b:",)], "d string")
    arr = split_descriptor("d")
    rows = df.select(part(arr, 1).alias("a"), part(arr, 2).alias("b"), part(arr, 5).alias("e")).collect()
    assert [tuple(r) for r in rows] == [("12", "vsp-34", None), ("1p", "car", None), ("3p", None, None),
                                        ("a", "b", None)]


def test_age_day_part_month_end_and_borrow(spark):
    # (a, b, expected DATE_PART('day', AGE(a, b)))
    cases = [
        (ts("2021-03-05 00:00:00"), ts("2021-01-31 00:00:00"), 5),    # 1 mon 5 days (Feb borrowed? no)
        (ts("2021-03-01 00:00:00"), ts("2021-01-31 00:00:00"), 1),    # 1 mon 1 day
        (ts("2021-03-05 10:00:00"), ts("2021-03-04 12:00:00"), 0),    # 22 hours
        (ts("2021-02-01 00:00:00"), ts("2021-01-31 12:00:00"), 0),
        (ts("2021-03-01 00:00:00"), ts("2021-02-28 00:00:00"), 1),
        (ts("2021-01-31 00:00:00"), ts("2021-03-05 00:00:00"), -5),   # negative mirror
        (ts("2020-03-30 00:00:00"), ts("2020-02-29 00:00:00"), 1),    # leap year
        (ts("2021-05-15 00:00:00"), ts("2021-04-20 00:00:00"), 25),   # borrow April's 30 days
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(age_day_part("a", "b")).collect()]
    assert got == [c[2] for c in cases]


def test_month_name_padded(spark):
    df = spark.createDataFrame([(dt.date(2021, 5, 1),), (dt.date(2021, 9, 1),)], "d date")
    assert [r[0] for r in df.select(month_name_padded("d")).collect()] == ["may      ", "september"]


def test_parse_doc_ts_and_time(spark):
    df = spark.createDataFrame([("2022-01-02 03:04:05",)], "s string")
    r = df.select(parse_doc_ts("s").alias("t")).select("t", time_text("t").alias("tt")).first()
    assert r.t == ts("2022-01-02 03:04:05") and r.tt == "03:04:05"


def test_iso_week_year_end(spark):
    from martflow.sources.calendar import calendar
    cal = calendar(spark, "2020-12-28", 10).filter(F.col("full_date").isin(
        dt.date(2021, 1, 1), dt.date(2021, 1, 4))).orderBy("full_date").collect()
    assert [(r.week_num, r.iso_year) for r in cal] == [(53, 2020), (1, 2021)]


def test_age_day_part_of_null_is_null(spark):
    from pyspark.sql import functions as F
    from martflow.functions.scalars import age_day_part
    T = __import__("datetime").datetime(2024, 1, 1)
    rows = spark.createDataFrame([(None, T), (T, None), (None, None), (T, T)], "a timestamp_ntz, b timestamp_ntz").select(age_day_part("a", "b").alias("d")).collect()
    assert [r.d for r in rows] == [None, None, None, 0]


def test_shared_dir_refuses_a_cluster_without_a_shared_folder():
    import pytest
    from martflow.session import shared_dir

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        shared_dir(Session())


DOCS = {
    '{"a":8268.70,"b":1234567890.12,"c": 1234567890123456789.10,"d":"8.50","e":null,"f":true,"g":"x \\"a\\": 5"}':
        ["8268.70", "1234567890.12", "1234567890123456789.10", "8.50", None, "true", 'x "a": 5', None],
    # the same key deeper down, twice, and written with an escape
    '{"z": {"a": 1, "b": [{"a": 2}]}, "a": 3.0, "\\u0061": 4.00, "b" :\t[1, {"b": "}"}] , "c": "", "d":"\\u00e4\\\\", "e": {}, "f": -1.5E+10}':
        ["4.00", '[1, {"b": "}"}]', "", "\u00e4\\", "{}", "-1.5E+10", None, None],
    "{}": [None] * 8,
}


def test_json_text_is_the_outermost_value_as_written(spark):
    from martflow.functions.json_raw import json_text
    df = spark.createDataFrame([(d,) for d in [*DOCS, None]], "v string").select("v", *[json_text("v", k).alias(k) for k in "abcdefgh"])
    assert {r[0]: list(r)[1:] for r in df.collect()} == DOCS | {None: [None] * 8}


FLAT_DOCS = {
    '{"a" : 8268.70 ,\n "b":"x, }{\\"b\\": 1"}': ["8268.70", 'x, }{"b": 1'],
    ' { } ': [None, None],
    '{"a":1,"a":null,"b":0012e5}': None,  # no JSON
    '{"\\u0061":"it\'s","b":true}': ["it's", "true"],
    '{"a":"' + 'x\\"' * 20_000 + '","b":-0.10}': ['x"' * 20_000, "-0.10"],
    '{"a":1,"a":2}': ["2", None],
    '{"a":[1, {"a": 5}],"b":"["}': ['[1, {"a": 5}]', "["],
}


def test_documents_without_nested_values_are_cut_by_one_pattern(spark):
    from martflow.functions.json_raw import is_json, json_members, json_text
    assert "rlike" in str(json_members("v")).lower()
    df = spark.createDataFrame([(d,) for d in FLAT_DOCS], "v string")
    good = df.filter(is_json("v")).select("v", json_text("v", "a"), json_text("v", "b"))
    assert {r[0]: list(r)[1:] for r in good.collect()} == {k: v for k, v in FLAT_DOCS.items() if v}


def test_broken_documents_stop_the_load_or_go_aside(spark):
    import pytest
    from martflow.plans import courier as C
    rows = [("o1", '{"delivery_id": "d1", "rate": 5, "x": {"rate": 1}}'), ("o2", "{broken"), ("o3", '{"rate": 4}'), ("o4", None), ("o5", '["delivery_id"]')]
    staged = spark.createDataFrame(rows, "object_id string, object_value string")
    good, aside = C.split_deliveries(staged)
    assert [tuple(r) for r in C.dm_rate(None, good).collect()] == [("d1", 5)]
    assert sorted(r.object_id for r in aside.collect()) == ["o2", "o3", "o4", "o5"]
    for bad in ("o2", "o3", "o4", "o5"):
        with pytest.raises(Exception, match="delivery without delivery_id|not a JSON object"):
            C.dm_rate(None, staged.filter(f"object_id = '{bad}'")).collect()
