"""File sources: FAILFAST on bad values, header checked against the schema,
inferred feeds inserted by name, JSON arrays landed one row per record."""

import decimal

import pytest

from martflow.session import scratch_path
from martflow.sources.files import (conform, drop_leading, land_json, read_csv_header, read_csv_inferred,
                                    read_csv_plain, read_json_records)


def _text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_plain_csv_bad_decimal_raises(spark):
    path = scratch_path(spark, "t_csv_plain")
    _text(spark, path, ["1;Pasta;12.50", "2;Soup;not-a-price"])
    with pytest.raises(Exception):
        read_csv_plain(spark, path, "id int, name string, price decimal(19,5)").collect()
    ok = scratch_path(spark, "t_csv_plain_ok")
    _text(spark, ok, ["1;Pasta;12.5"])
    assert [tuple(r) for r in read_csv_plain(spark, ok, "id int, name string, price decimal(19,5)").collect()] \
        == [(1, "Pasta", decimal.Decimal("12.50000"))]


def test_header_csv_checks_names(spark):
    path = scratch_path(spark, "t_csv_header")
    _text(spark, path, ["a,b", "1,x"])
    with pytest.raises(Exception):
        read_csv_header(spark, path, "a int, c string").collect()
    assert read_csv_header(spark, path, "a int, b string").first().b == "x"


def test_inferred_feed_drops_row_id_and_inserts_by_name(spark):
    path = scratch_path(spark, "t_csv_inferred")
    _text(spark, path, ["uniq_id,qty,item", "u1,3,apple", "u2,4,pear"])
    df = conform(drop_leading(read_csv_inferred(spark, path), 1), "item string, qty long")
    assert df.columns == ["item", "qty"] and sorted(tuple(r) for r in df.collect()) == [("apple", 3), ("pear", 4)]


def test_land_json_array_pages(spark):
    path = scratch_path(spark, "t_json")
    _text(spark, path, ['[{"_id":"a","name":"A"},{"_id":"b","name":null}]', '[{"_id":"c","name":"C"}]'])
    recs = read_json_records(spark, path, "_id string, name string")
    out = {r.object_id: r.object_value for r in land_json(recs, "_id", "2024-01-01 00:00:00").collect()}
    assert out == {"a": '{"_id":"a","name":"A"}', "b": '{"_id":"b","name":null}', "c": '{"_id":"c","name":"C"}'}
