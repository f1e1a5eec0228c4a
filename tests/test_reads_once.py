"""What several steps of a query read is computed once and written."""

import pytest

from martflow import adapters as A
from martflow.catalog import QUERIES
from martflow.operators import tables
from martflow.sources.tables import Tables


@pytest.fixture
def published(monkeypatch):
    names, plain = [], tables.publish

    def noting(df, name, *args, **kw):
        names.append(name)
        return plain(df, name, *args, **kw)
    monkeypatch.setattr(tables, "publish", noting)
    return names


@pytest.mark.parametrize("name, what", [("dm_deliveries", "stored"), ("dm_rate", "stored"), ("dm_tips", "stored"),
                                        ("d_item_increment", "item_names"), ("replace_slice", "feed")])
def test_shared_input_is_written_once(spark, sf_small, published, name, what):
    QUERIES[name](spark, sf_small)
    assert published.count(what) == 1


def test_a_dds_run_writes_new_orders_and_events_once(spark, sf_small, published):
    QUERIES["dds_two_runs"](spark, sf_small)
    assert published.count("orders_new") == published.count("events_new") == published.count("events_parsed") == 2


def test_feed_shuffles_lines_without_the_customers_columns(spark, sf_small):
    feed = A.v_feed(Tables(spark, sf_small))
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    joins = [line.split("Join")[1] for line in plan.split("\n") if "Join" in line]
    assert len(joins) == 3 and "o_orderkey" in joins[0] and "p_partkey" in joins[1] and "c_custkey" in joins[2]
