"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partitions are sized for the local
# tests; on a cluster pass a value sized to ~128-256 MB per shuffle partition
# (AQE coalesces the tail anyway).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state (per-user sessions, dedup keys) can outgrow the heap at
    # scale; RocksDB keeps it off-heap with incremental checkpoints.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "emporium", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local runs only: a catalog location outside the working directory
        # (it holds no data -- warehouse tables use explicit paths under the
        # checkpoint folder -- but enables bucketed tables). On a cluster the
        # deployment's own warehouse setting is kept.
        conf["spark.sql.warehouse.dir"] = os.path.join(tempfile.gettempdir(), "emporium-sql-warehouse")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared, fault-tolerant file system).
    Only when it is unset -- local tests -- a private scratch folder is made
    and registered as the context's checkpoint folder.
    """
    global _LOCAL_FALLBACK
    cur = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not cur:
        try:
            cur = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001
            cur = None
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
        if cur and cur.startswith("file:"):
            cur = cur[len("file:"):]
    if not cur:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _LOCAL_FALLBACK is None:
            _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="emporium-ckpt-")
        cur = _LOCAL_FALLBACK
        spark.sparkContext.setCheckpointDir(cur)
    return cur


_LOCAL_FALLBACK: str | None = None


_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING_LOCK = threading.Lock()
_FREEING: dict[str, tuple[int, str]] = {}   # per application: writes under way, the setting before the first


@contextlib.contextmanager
def exchanged_files_freed(spark: SparkSession):
    """What a write inside exchanges goes from the executors' disks when it
    ends, not when the driver happens to collect its garbage. Writes may
    overlap (tables are built concurrently): the last one restores the setting."""
    app = spark.sparkContext.applicationId
    with _FREEING_LOCK:
        n, before = _FREEING.get(app) or (0, spark.conf.get(_CLEANUP_KEY, "false"))
        _FREEING[app] = (n + 1, before)
        spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        with _FREEING_LOCK:
            n, before = _FREEING.pop(app)
            if n > 1:
                _FREEING[app] = (n - 1, before)
            else:
                spark.conf.set(_CLEANUP_KEY, before)


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one job run under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/runs/{name}-{uuid.uuid4().hex[:12]}"
