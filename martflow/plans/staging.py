"""Staging loads (M15 bonus system, M16 document collections).

Each load is a pure function (current staged table, source) -> new staged
table, plus the cursor state where the reference keeps one; publish the
table first and the state after it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from martflow.functions.scalars import to_json_keep_nulls
from martflow.constants import SESSION_LIMIT
from martflow.operators.cursor import cursor_advance, cursor_get, settings_get, settings_set
from martflow.operators.selection import Key, keys_at
from martflow.operators.tables import insert_if_absent, publish, rows_if_absent, upsert

# names of this package's own workflows in the state table
EVENTS_WF = "stage:events"
COPY_WF = "stage:documents"

Cursor = tuple[str, str | None]  # (update time, id) as text


def load_ranks(staged: DataFrame, ranks: DataFrame, order: str = "id") -> DataFrame:
    """Ranks upserted by id, every column refreshed."""
    return upsert(staged, ranks, ["id"], [F.col(order)])


def load_bonus_users(staged: DataFrame, users: DataFrame, order: str = "id") -> DataFrame:
    """Users inserted if absent; existing rows are never changed."""
    return insert_if_absent(staged, users, ["id"], [F.col(order)])


def load_events(staged: DataFrame, outbox: DataFrame, state: DataFrame,
                wf_key: str = EVENTS_WF) -> tuple[DataFrame, DataFrame]:
    """Outbox rows with id > cursor, each stored once (the
    staged table's primary key is the event id).  Returns (rows to append,
    new state): the staged table is insert-only, so a run appends its batch
    instead of rewriting the table; publish the state after the append.
    An empty batch keeps the cursor (B17)."""
    cur = cursor_get(state, wf_key)
    batch = outbox.filter(F.col("id") > F.lit(cur)).select(*staged.columns)
    new_rows = rows_if_absent(staged, batch, ["id"], [F.col("id")])
    return new_rows, cursor_advance(state, batch, "id", F.lit(wf_key))


STAGED_DOC_DDL = "object_id string, object_value string, update_ts timestamp_ntz"


FIRST_TS = "0001-01-01 00:00:00"  # a document without a stamp counts as the oldest


def _stamp(ts_col: str):
    return F.coalesce(F.col(ts_col), F.lit(FIRST_TS).cast("timestamp_ntz"))


ORDER = [Key("ts"), Key("id")]  # a document without an id comes first among those of its stamp


def _keys(docs: DataFrame, id_col: str, ts_col: str) -> DataFrame:
    return docs.select(_stamp(ts_col).alias("ts"), F.col(id_col).alias("id"))


def _typed(documents: DataFrame, id_col: str, cursor: Cursor) -> tuple[datetime, object]:
    """The stored cursor's text as values of the documents' types."""
    spark, (ts, doc_id) = documents.sparkSession, cursor
    row = spark.range(1).select(F.lit(ts).cast("timestamp_ntz"), F.lit(doc_id).cast(dict(documents.dtypes)[id_col])).first()
    return row[0], row[1]


def _rest(documents: DataFrame, id_col: str, ts_col: str, after_cursor: Cursor | None) -> DataFrame:
    """The documents after the cursor, by (update time, id) with NULL ids first."""
    if after_cursor is None:
        return documents
    ts, doc_id = _typed(documents, id_col, after_cursor)
    stamp, ident = _stamp(ts_col), F.col(id_col)
    later = ident.isNotNull() if doc_id is None else F.coalesce(ident > F.lit(doc_id), F.lit(False))
    # the range on the bare column reaches the scan
    return documents.filter((F.col(ts_col).isNull() | (F.col(ts_col) >= F.lit(ts))) & ((stamp > F.lit(ts)) | ((stamp == F.lit(ts)) & later)))


def session_ends(documents: DataFrame, state: DataFrame, wf_key: str = COPY_WF, id_col: str = "_id", ts_col: str = "update_ts",
                 limit: int = SESSION_LIMIT, sessions: int = 100) -> list[Cursor]:
    """The cursors that the next ``sessions`` sessions end at, found together
    by counting keys (``operators.selection``): nothing is sorted or written.
    A last session of fewer documents has no entry."""
    cursor = _cursor(state, wf_key)
    keys = _keys(_rest(documents, id_col, ts_col, cursor), id_col, ts_col)
    found = keys_at(keys, ORDER, [limit * (i + 1) for i in range(sessions)])
    return [(str(ts), None if i is None else str(i)) for ts, i in (found[r] for r in sorted(found))]


def _cursor(state: DataFrame, wf_key: str) -> Cursor | None:
    ts, doc_id = settings_get(state, wf_key, "last_ts", "last_id")
    return None if ts is None else (ts, doc_id)


def _doc_rows(documents: DataFrame, id_col: str, ts_col: str, limit: int, after_cursor: Cursor | None, end: Cursor | None = None) -> DataFrame:
    """The next ``limit`` documents after the cursor, or those up to ``end``,
    as staged rows plus the cursor columns.  They are copied by a filter, and
    no limit gathers them."""
    docs = _rest(documents, id_col, ts_col, after_cursor)
    if end is None:
        found = keys_at(_keys(docs, id_col, ts_col), ORDER, [limit])
        docs = _until(docs, id_col, ts_col, *found[limit]) if found else docs
    else:
        docs = _until(docs, id_col, ts_col, *_typed(documents, id_col, end))
    return docs.select(
        F.col(id_col).cast("string").alias("object_id"),
        to_json_keep_nulls(F.struct(*[F.col(c) for c in documents.columns])).alias("object_value"),
        F.col(ts_col).alias("update_ts"), _stamp(ts_col).alias("_page_ts"), F.col(id_col).alias("_page_id"))


def _session(documents: DataFrame, state: DataFrame, wf_key: str, id_col: str, ts_col: str,
             limit: int, end: Cursor | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of one copy session, state after it).  The cursor is (update_ts,
    id) of the last document copied, a NULL id included, kept in the state, so
    documents that tie on the stamp are neither lost nor read again; an empty
    session keeps it.  ``end`` is where the session ends if that is known
    (:func:`session_ends`)."""
    rows = publish(_doc_rows(documents, id_col, ts_col, limit, _cursor(state, wf_key), end), "copy_session")
    last = rows.agg(F.max(F.struct("_page_ts", "_page_id")).alias("m")).select(
        F.col("m._page_ts").cast("string"), F.col("m._page_id").cast("string")).first()
    if last[0] is not None:
        state = settings_set(state, wf_key, last_ts=last[0], last_id=last[1])
    return rows.drop("_page_ts", "_page_id"), state


def _until(docs: DataFrame, id_col: str, ts_col: str, ts: datetime, doc_id) -> DataFrame:
    """The documents up to a cursor, that of the cursor included."""
    stamp, ident = _stamp(ts_col), F.col(id_col)
    same = ident.isNull() if doc_id is None else F.coalesce(ident <= F.lit(doc_id), F.lit(True))
    return docs.filter((stamp < F.lit(ts)) | ((stamp == F.lit(ts)) & same))


def copy_collection_into(table_dir: str, documents: DataFrame, state: DataFrame, wf_key: str = COPY_WF, id_col: str = "_id",
                         ts_col: str = "update_ts", limit: int = SESSION_LIMIT, buckets: int | None = None, end: Cursor | None = None) -> DataFrame:
    """M16 in place: as :func:`copy_collection`, but the staged table is kept
    as hash buckets of ``object_id`` and only the buckets holding copied
    documents are rewritten, so a session costs O(touched buckets).  Returns
    the new state, to be published after the table."""
    from martflow.operators.tables import upsert_buckets
    rows, state = _session(documents, state, wf_key, id_col, ts_col, limit, end)
    upsert_buckets(table_dir, rows, ["object_id"], [F.col("update_ts")], STAGED_DOC_DDL,
                   update_cols=["object_value"], buckets=buckets, null_keys=True)
    return state


def copy_collection(staged: DataFrame, documents: DataFrame, state: DataFrame, wf_key: str = COPY_WF, id_col: str = "_id",
                    ts_col: str = "update_ts", limit: int = SESSION_LIMIT, end: Cursor | None = None) -> tuple[DataFrame, DataFrame]:
    """One session copies the next ``limit``
    documents (oldest first by update time, then id) into staging as JSON
    text; a document already staged gets its payload refreshed and keeps its
    stored update_ts (as written, B18).  Returns (staged table, state)."""
    rows, state = _session(documents, state, wf_key, id_col, ts_col, limit, end)
    return upsert(staged.select("object_id", "object_value", "update_ts"), rows, ["object_id"],
                  [F.col("update_ts")], update_cols=["object_value"], null_keys=True), state
