"""Session construction and shared scratch storage.

Stateful operators (bookmarks, upserts, streams) need a folder that every
executor can see. On a cluster that folder is the one named by
``spark.checkpoint.dir``; it is read from the session and never replaced.
Only when it is unset (local runs, tests) a local folder is chosen.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job on this library expects. They are defaults: one that the launcher
# or an existing session has set is kept.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
LOCAL_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    asked = dict(LOCAL_CONF) if master and master.startswith("local") else {}
    if shuffle_partitions:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    asked.update(extra or {})
    for k, v in asked.items():
        builder = builder.config(k, v)
    active = SparkSession.getActiveSession()
    spark = builder.getOrCreate()
    launched = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if k not in asked and not launched.contains(k) and active is None:
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    # Unset: allowed only in local mode (tests). On a cluster a machine-local
    # folder would be invisible to other executors and lost with the host.
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                           "(e.g. on the cluster file system) for scratch tables and checkpoints")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def _base(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark)
    # setCheckpointDir appends a per-application uuid folder; keep scratch data
    # beside it so one application's tables survive between its own jobs.
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    return f"{_base(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"



def scratch_table(name: str) -> str:
    """A fresh, unique catalog table name."""
    return f"{name}_{uuid.uuid4().hex[:12]}"
