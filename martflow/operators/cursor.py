"""Per-workflow high-water marks and load run log.

The state table is (workflow_key, workflow_settings JSON text), as in the
reference.  Advancing a cursor is a DataFrame upsert whose new value is
``max(id)`` of the processed batch, computed in the same job; an empty
batch keeps the old cursor (B17).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.operators.tables import upsert

STATE_SCHEMA = "workflow_key string, workflow_settings string"
DEFAULT_CURSOR = -1


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def cursor_get(state: DataFrame, wf_key: str, field: str = "last_loaded_id", default: int = DEFAULT_CURSOR) -> int:
    """Read one cursor value (a scalar) from the state table."""
    row = (state.filter(F.col("workflow_key") == wf_key)
           .select(F.get_json_object("workflow_settings", f"$.{field}").cast("long").alias("v")).first())
    return default if row is None or row["v"] is None else int(row["v"])


def cursor_advance(state: DataFrame, batch: DataFrame, id_col: str, wf_key: F.Column,
                   field: str = "last_loaded_id") -> DataFrame:
    """New state: for each workflow key present in ``batch`` (``wf_key`` is a
    column expression, so one batch may feed several cursors) the cursor
    becomes max(old, max(id)); other keys are kept."""
    new = batch.groupBy(wf_key.alias("workflow_key")).agg(F.max(id_col).alias("_mf_max"))
    old = state.select("workflow_key",
                       F.get_json_object("workflow_settings", f"$.{field}").cast("long").alias("_mf_old"))
    merged = new.join(old, "workflow_key", "left").select(
        "workflow_key",
        F.to_json(F.struct(F.greatest(F.col("_mf_max"), F.coalesce("_mf_old", F.lit(DEFAULT_CURSOR)))
                           .alias(field))).alias("workflow_settings"),
        F.lit(0).alias("_mf_seq"),
    )
    return upsert(state, merged, ["workflow_key"], [F.col("_mf_seq")]).select("workflow_key", "workflow_settings")


def settings_get(state: DataFrame, wf_key: str, *fields: str) -> tuple[str | None, ...]:
    """Several settings of one workflow as text (None: not set)."""
    row = state.filter(F.col("workflow_key") == wf_key).select(
        *[F.get_json_object("workflow_settings", f"$.{f}").alias(f) for f in fields]).first()
    return tuple(row) if row is not None else (None,) * len(fields)


def settings_set(state: DataFrame, wf_key: str, **settings: str) -> DataFrame:
    """State with the settings of one workflow replaced."""
    new = state.sparkSession.createDataFrame([(wf_key, json.dumps(settings))], STATE_SCHEMA)
    return state.filter(F.col("workflow_key") != wf_key).unionByName(new)


def run_log(loads: Mapping[str, DataFrame], run_ts: str) -> DataFrame:
    """One row per landed table -- SUCCESS when it delivered rows,
    FAILED for an empty payload -- with the row count."""
    parts = []
    for name, df in loads.items():
        parts.append(df.groupBy().agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("workflow_key"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        "workflow_key",
        F.when(F.col("row_count") > 0, "SUCCESS").otherwise("FAILED").alias("status"),
        "row_count",
        F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"),
    )


def publish_observed(batch: DataFrame, name: str, id_col: str | None = None) -> tuple[DataFrame, int, int | None]:
    """K12 / A10 in one job: write ``batch`` as a new snapshot and observe its
    row count (and max id) while writing -- no second pass over the batch.
    Returns (published frame, rows, max id or None)."""
    from pyspark.sql import Observation

    from martflow.operators.tables import publish
    obs = Observation(f"mf_{name}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if id_col:
        metrics.append(F.max(id_col).alias("max_id"))
    out = publish(batch.observe(obs, *metrics), name)
    got = obs.get
    return out, int(got["rows"]), (got.get("max_id") if id_col else None)


def advance_to(state: DataFrame, wf_key: str, new_max: int | None, field: str = "last_loaded_id") -> DataFrame:
    """Cursor upsert from an already known max id (e.g. observed while
    writing); ``None`` (empty batch) keeps the old value."""
    spark = state.sparkSession
    if new_max is None:
        return state
    row = spark.createDataFrame([(wf_key, int(new_max))], "workflow_key string, _mf_id long")
    return cursor_advance(state, row, "_mf_id", F.col("workflow_key"), field)


def load_batch(staged: DataFrame, state: DataFrame, wf_key: str, name: str, id_col: str = "id",
               transform=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One cursor-driven load step: read ``id > cursor``, transform, publish
    while observing count and max id, then advance the cursor (returned, to
    be published *after* the data) and log the run.
    Returns (published rows, new state, run-log row)."""
    cur = cursor_get(state, wf_key)
    batch = staged.filter(F.col(id_col) > F.lit(cur))
    if transform is not None:
        batch = transform(batch)
    out, rows, max_id = publish_observed(batch, name, id_col)
    spark = staged.sparkSession
    log = spark.createDataFrame([(wf_key, "SUCCESS" if rows else "FAILED", rows)],
                                "workflow_key string, status string, row_count long")
    return out, advance_to(state, wf_key, max_id), log
