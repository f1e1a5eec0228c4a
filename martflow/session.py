"""Session settings and the shared working folder.

Every written intermediate (landed files, published snapshots, checkpoints)
goes under the folder the cluster names in ``spark.checkpoint.dir``.  Only
when that setting is absent (local tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, ANSI on,
# adaptive execution for runtime coalescing, skew splitting and
# broadcast conversion based on measured shuffle sizes.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "martflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster job passes its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARTFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_SETTINGS.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_settings(spark)
    shared_dir(spark)
    return spark


def apply_settings(spark: SparkSession) -> None:
    for k, v in SESSION_SETTINGS.items():
        spark.conf.set(k, v)
    _name_package_to_workers(spark)


def _name_package_to_workers(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it, too, so a
    driver started elsewhere needs no PYTHONPATH; a cluster without that path
    has the package installed or passed as ``--py-files``."""
    try:
        environment = spark.sparkContext.environment
    except Exception:  # noqa: BLE001 - a Spark Connect session has no context
        return
    home = str(Path(__file__).resolve().parents[1])
    have = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in have:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, have)])


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables.

    Read from the context's checkpoint dir or ``spark.checkpoint.dir``; only a
    local session without one gets a fresh folder of its own, any other master
    raises: each executor would write to its own disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="martflow-shared-")
    if sc is not None:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    return d


_RUN: ContextVar[str] = ContextVar("martflow_run", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder, in the folder of the
    :func:`scratch_run` that it is asked for in, if any."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/martflow/{_RUN.get()}{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """A run whose written intermediates go when it ends: numbered rows,
    published snapshots, stages and links rounds.  Results must have been
    written elsewhere or read by then; frames made inside can't be read after."""
    name = f"run-{uuid.uuid4().hex[:12]}/"
    token = _RUN.set(name)
    try:
        yield
    finally:
        _RUN.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/martflow/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside go when it ends, not when the
    driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for the data: file splits and shuffle partitions of
    ~``target_partition_bytes`` (so a task's sort/aggregate fits in executor
    memory and spills rarely), at least 2 tasks per core, and AQE free to
    coalesce small partitions and split skewed ones.

    E.g. 100 TB on 1000 executors x 8 cores -> 409,600 initial shuffle
    partitions of 256 MB, coalesced at run time by AQE where stages shrink.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        # broadcast decisions: static estimate capped low, runtime (measured) higher
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, total_cores: int) -> None:
    for k, v in scale_settings(input_bytes, total_cores).items():
        spark.conf.set(k, v)
