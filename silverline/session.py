"""Session settings and the shared working folder.

All intermediate tables (landing copies, bronze snapshots, silver segments,
stream checkpoints) live below the folder the cluster names in
``spark.checkpoint.dir``. On a cluster that folder is shared storage, so a
lost executor never takes written data with it. A folder of our own is set
only when the session has none, which happens in local tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a batch of this library wants; every one is a public Spark option.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.json.filterPushdown.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "silverline",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark; clusters bring their own."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the length of some writes."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# Spark removes the shuffle files of a write when the write ends, not when the driver's garbage collector finds its plan.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows that a task sorts or groups in memory, also wide ones.
TASK_ROWS = 1 << 19


def partitions_for(spark: SparkSession, rows: int) -> int | None:
    """Partitions that a shuffle of so many rows needs; None if the session's setting does."""
    needed = -(-rows // TASK_ROWS)
    return needed if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master          # "local-cluster" has executors of its own
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder from ``spark.checkpoint.dir``.

    When the setting is missing: on a local master a folder is chosen and set
    (tests); on a cluster this is a configuration error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    value = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if value:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(value)
        return value.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    value = _LOCAL_DIRS.get(sc.applicationId) or sc.getCheckpointDir() or tempfile.mkdtemp(prefix="silverline-")
    _LOCAL_DIRS[sc.applicationId] = value
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(value)
    try:
        spark.conf.set("spark.checkpoint.dir", value)
    except Exception:  # core setting; some sessions refuse runtime changes
        pass
    return value.rstrip("/")


_LOCAL_DIRS: dict[str, str] = {}


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unused folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/silverline/{tag}-{uuid.uuid4().hex[:12]}"
