"""Reads of staged outbox events and documents.

Cursor filters are plain column predicates, so Catalyst pushes them into the
parquet (or JDBC) scan as ``PushedFilters`` and row groups are skipped by
their min/max statistics.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from martflow.constants import SESSION_LIMIT


def read_since(staged: DataFrame, cursor: int, id_col: str = "id") -> DataFrame:
    """Rows with ``id > cursor`` (a replay from -1 reads everything)."""
    return staged.filter(F.col(id_col) > F.lit(cursor))


def read_events(outbox: DataFrame, event_type: str, cursor: int) -> DataFrame:
    """One event type AND id > cursor (two pushed filters).  The
    reference's ``ORDER BY id`` (O2) is not needed: the batch is a set."""
    return outbox.filter((F.col("event_type") == F.lit(event_type)) & (F.col("id") > F.lit(cursor)))


# Payload shapes of the bonus system's own event types.
BONUS_SHAPES = {
    "user_rank": "user_id long, rank_id long",
    "user_balance": "user_id long, balance decimal(19,5)",
}


def oldest_k(docs: DataFrame, k: int = SESSION_LIMIT, ts_col: str = "update_ts", id_col: str = "id") -> DataFrame:
    """The ``k`` oldest documents by update time (ties by id).

    The limit is the feature here (one copy session); Spark plans it as
    TakeOrderedAndProject: each task keeps its own top k, so only k rows per
    task reach the final merge whatever the collection size.
    """
    return docs.orderBy(F.col(ts_col).asc(), F.col(id_col).asc()).limit(k)


def events_by_type(outbox: DataFrame, shapes: Mapping[str, str], value_col: str = "event_value") -> DataFrame:
    """Route each event type to its payload schema with ``from_json``;
    the result keeps id, type and the parsed payload as a struct per type.
    An event of a type without a declared shape stays, with NULL payloads."""
    cols = [F.col("id"), F.col("event_type")]
    for etype, ddl in shapes.items():
        cols.append(F.when(F.col("event_type") == etype, F.from_json(F.col(value_col), ddl)).alias(etype))
    return outbox.select(*cols)
