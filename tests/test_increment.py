"""Entry A end to end: N daily increments == one backfill."""

from pyspark.sql import functions as F

from martflow import adapters as A
from martflow.plans.sales import run_increment
from martflow.session import scratch_path
from martflow.sources.files import write_csv
from martflow.sources.tables import Tables


def _rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_daily_runs_equal_backfill(spark, sf_small):
    feed = A.v_feed(Tables(spark, sf_small))
    days = [r[0] for r in feed.select(F.date_format("date_time", "yyyy-MM-dd").alias("d")).distinct()
            .orderBy("d").limit(4).collect()]
    part = feed.filter(F.date_format("date_time", "yyyy-MM-dd").isin(*days))
    csv = scratch_path(spark, "increment_csv")
    # the feed file has a leading row id and no status column (default 'shipped')
    write_csv(part.drop("status").select(F.monotonically_increasing_id().alias("uniq_id"), "*"), csv)

    daily = scratch_path(spark, "mart_daily")
    for d in days:
        marts_daily = run_increment(spark, csv, daily, d, "1995-01-01", 2557)
    # re-running a past day is idempotent
    marts_daily = run_increment(spark, csv, daily, days[1], "1995-01-01", 2557)
    back = scratch_path(spark, "mart_backfill")
    marts_back = run_increment(spark, csv, back, days, "1995-01-01", 2557)
    for name in ["f_daily_sales", "customer_retention"]:
        assert _rows(marts_daily[name]) == _rows(marts_back[name]), name
    # items: the same names, ids by arrival
    assert _rows(marts_daily["d_item"], "item_id", "item_name") == _rows(marts_back["d_item"], "item_id", "item_name")
    # customers: same members, dense ids, each once (ids follow arrival order when loaded daily)
    for m in (marts_daily, marts_back):
        c = m["d_customer"]
        assert sorted(r.id for r in c.collect()) == list(range(1, c.count() + 1))
    assert _rows(marts_daily["d_customer"], "customer_id") == _rows(marts_back["d_customer"], "customer_id")
    fact = marts_back["f_daily_sales"]
    assert fact.count() == part.select("item_id", "customer_id", "quantity", "payment_amount", "date_time") \
        .distinct().count()
    assert fact.filter(F.col("status") != "shipped").count() == 0


def test_full_rebuild_equals_incremental_backfill(spark, sf_small):
    from martflow.plans.sales import build_marts, read_stage
    feed = A.v_feed(Tables(spark, sf_small))
    days = [r[0] for r in feed.select(F.date_format("date_time", "yyyy-MM-dd").alias("d")).distinct()
            .orderBy("d").limit(3).collect()]
    part = feed.filter(F.date_format("date_time", "yyyy-MM-dd").isin(*days))
    csv = scratch_path(spark, "increment_csv2")
    write_csv(part.select(F.monotonically_increasing_id().alias("uniq_id"), "*"), csv)
    base = scratch_path(spark, "mart_inc")
    inc = run_increment(spark, csv, base, days, "1995-01-01", 2557)
    full = build_marts(spark, read_stage(spark, f"{base}/stage"), "1995-01-01", 2557)
    for name in ["f_daily_sales", "d_item", "customer_retention", "d_customer"]:
        assert _rows(inc[name]) == _rows(full[name]), name


def test_mart_constraints_after_increment(spark, sf_small):
    from martflow.operators.quality import check_marts
    feed = A.v_feed(Tables(spark, sf_small))
    days = [r[0] for r in feed.select(F.date_format("date_time", "yyyy-MM-dd").alias("d")).distinct()
            .orderBy("d").limit(2).collect()]
    csv = scratch_path(spark, "increment_csv3")
    write_csv(feed.filter(F.date_format("date_time", "yyyy-MM-dd").isin(*days))
              .select(F.monotonically_increasing_id().alias("uniq_id"), "*"), csv)
    marts = run_increment(spark, csv, scratch_path(spark, "mart_dq"), days, "1995-01-01", 2557)
    res = {(r.table_name, r.rule): r.violations for r in check_marts(marts).collect()}
    assert res[("d_customer", "unique:id")] == 0 and res[("customer_retention", "unique:period_id")] == 0
    fact = marts["f_daily_sales"]
    dup = fact.count() - fact.select("date_id", "item_id", "customer_id").distinct().count()
    assert res[("f_daily_sales", "unique:date_id,item_id,customer_id")] == dup  # B13 reported as found


def test_days_outside_the_calendar_and_other_starts_are_refused(spark):
    import pytest
    row = [(1, "2022-06-01 10:00:00", 1, "c", 7, "a", "b", 5, "i", 1, 2.5)]
    csv, base = scratch_path(spark, "increment_csv4"), scratch_path(spark, "mart_cal")
    write_csv(spark.createDataFrame(row, "uniq_id int, date_time string, city_id int, city_name string, customer_id int, first_name string, "
                                         "last_name string, item_id int, item_name string, quantity int, payment_amount double"), csv)
    with pytest.raises(ValueError):
        run_increment(spark, csv, base, "2022-06-01", "1995-01-01", 2557)
    assert run_increment(spark, csv, base, "2022-06-01", "2022-01-01", 365)["f_daily_sales"].count() == 1
    with pytest.raises(ValueError):
        run_increment(spark, csv, base, "2022-06-01", "2021-01-01", 900)


def test_item_ids_stay_and_days_are_pruned(spark):
    from martflow.plans.sales import read_days
    ddl = ("uniq_id int, date_time string, city_id int, city_name string, customer_id int, first_name string, last_name string, "
           "item_id int, item_name string, quantity int, payment_amount double")
    rows = [(1, "2022-06-02 10:00:00", 1, "c", 7, "a", "b", 5, "five", 1, 2.5), (2, "2022-06-03 10:00:00", 1, "c", 7, "a", "b", 3, "three", 1, 2.5),
            (3, "2022-06-03 11:00:00", 1, "c", 7, "a", "b", 5, "five again", 1, 2.5), (4, "2022-06-01 11:00:00", 1, "c", 8, "a", "b", 5, "too old", 1, 2.5)]
    csv, base = scratch_path(spark, "increment_csv5"), scratch_path(spark, "mart_items")
    write_csv(spark.createDataFrame(rows, ddl), csv)
    for day in ("2022-06-02", "2022-06-03", "2022-06-01"):
        items = run_increment(spark, csv, base, day, "2022-01-01", 365)["d_item"]
    assert _rows(items) == [(1, 5, "five again"), (2, 3, "three")]
    plan = read_days(spark, f"{base}/stage", ["2022-06-02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan, plan


def test_one_customer_row_per_id(spark):
    import datetime as dt
    from martflow.plans.sales import d_customer
    T = dt.datetime(2024, 1, 1)
    stage = spark.createDataFrame([(T, 1, 7, "Ann", "X"), (T + dt.timedelta(1), 2, 7, "Anne", "X"), (T, 3, 8, "Bo", "Y")],
                                  "date_time timestamp_ntz, city_id int, customer_id long, first_name string, last_name string")
    assert len(_rows(d_customer(stage))) == 3
    assert _rows(d_customer(stage, one_per_id=True)) == [(1, 7, "Anne", "X", 1), (2, 8, "Bo", "Y", 3)]


def test_other_feeds_are_staged_by_day(spark):
    from martflow.operators.tables import read_slices
    from martflow.plans.sales import FEEDS, load_feed
    csv, stage = scratch_path(spark, "research_csv"), scratch_path(spark, "research_stage")
    write_csv(spark.createDataFrame([(1, "2022-06-02 00:00:00", 1, 2, 3, 4.5), (2, "2022-06-03 00:00:00", 1, 2, 3, 5.5)],
                                    "row_id int, date_id string, category_id int, geo_id int, sales_qty int, sales_amt double"), csv)
    for _ in range(2):
        load_feed(spark, "customer_research", csv, stage, "2022-06-02")
    got = read_slices(spark, stage, "day", schema=FEEDS["customer_research"] + ", day string").collect()
    assert len(got) == 1 and str(got[0].sales_amt) == "4.50" and got[0].day == "2022-06-02"


def test_backfill_query_compares_the_whole_feed(spark, sf_small, monkeypatch):
    from martflow.catalog import QUERIES
    from martflow.operators import tables
    plain = tables.write_slices

    def losing(df, path, slice_col, slices=None):  # the batches lose the feed's oldest day
        plain(df if "backfill" in path else df.filter(F.col(slice_col) != oldest), path, slice_col, slices)

    from martflow import adapters as A
    from martflow.sources.tables import Tables
    feed = A.v_feed(Tables(spark, sf_small)).select(F.to_date("date_time").alias("day"))
    oldest = feed.agg(F.min("day")).first()[0]
    monkeypatch.setattr(tables, "write_slices", losing)
    got = QUERIES["backfill_equals_daily"](spark, sf_small)
    assert {r[0] for r in got.select("differing").distinct().collect()} == {feed.filter(F.col("day") == oldest).count()}
