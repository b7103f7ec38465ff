"""Materialized Silver / Gold tables for one run.

Marts read *stored* Silver and Gold tables, as in any lakehouse: each table
is computed once, written as Parquet under the shared folder named by
``spark.checkpoint.dir`` and read back. The write cuts the lineage, so a
lost executor re-reads a finished table instead of recomputing the whole
Bronze -> Gold chain, and every mart query starts from compact typed
columns with Parquet statistics.

Each process gets its own run folder (no stale tables from an earlier
code version or input); within a process a table is built at most once per
(session, input folder).

Hashes of a row's own columns (record hashes, surrogate keys) take more room
than the row. A table is stored without them and other columns that follow
from its own, and its scan computes them for readers that ask for them; see
``Derived``.
"""

from __future__ import annotations

import os
import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emporium.operators.partitioned import read_partitions, write_partitions
from emporium.session import checkpoint_dir, exchanged_files_freed

#: Column -> (what is stored under its name, None for nothing; its value from the stored columns).
Derived = dict[str, tuple[Column | None, Column]]

_LOCK = threading.Lock()
_RUNS: dict[tuple[str, str], "Warehouse"] = {}


def to_stored(df: DataFrame, derived: Derived | None) -> DataFrame:
    """The columns of ``df`` that are written."""
    d = derived or {}
    return df.select(*[d[c][0].alias(c) if c in d else c for c in df.columns if c not in d or d[c][0] is not None])


def from_stored(stored: DataFrame, columns: list[str], derived: Derived | None) -> DataFrame:
    """All ``columns`` of a table of which ``stored`` is a scan; a derived
    column can use those before it."""
    for c, (_, value) in (derived or {}).items():
        stored = stored.withColumn(c, value)
    return stored.select(*columns)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._done: set[str] = set()
        self._logged = 0
        self._lock = threading.Lock()
        self._table_locks: dict[str, threading.Lock] = {}
        self.metrics: dict[str, int] = {}   # rows written per table, observed during the write

    def _table_lock(self, name: str) -> threading.Lock:
        with self._lock:
            return self._table_locks.setdefault(name, threading.Lock())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def persist(self, name: str, df: DataFrame, sort_within: list[str] | None = None, partition_by: str | None = None,
                derived: Derived | None = None, parts: list[DataFrame] | None = None) -> DataFrame:
        """Write ``df`` once as table ``name`` and return a scan of it.

        ``sort_within`` orders rows inside each file so row-group min/max
        statistics on that column let later filters skip data.
        ``partition_by`` writes a folder per value of that column, so readers
        that filter on it list only the folders they need. ``derived`` columns
        are computed by the scan. ``parts``, which together are ``df``, are
        written one after another instead: what one exchanged is gone from the
        executors' disks before the next begins.
        """
        kept = to_stored(df, derived)
        with self._table_lock(name):   # different tables may be built concurrently
            if name not in self._done:
                rows = 0
                for i, part in enumerate([kept] if partition_by or not parts else [to_stored(p, derived) for p in parts]):
                    obs = Observation(f"load:{name}")
                    with exchanged_files_freed(self.spark):
                        if partition_by:
                            write_partitions(part, self.path(name), partition_by, sort_within or [], rows=obs)
                        else:
                            out = part.observe(obs, F.count(F.lit(1)).alias("rows"))
                            out = out.sortWithinPartitions(*sort_within) if sort_within else out
                            out.write.mode("append" if i else "overwrite").option("compression", "zstd").parquet(self.path(name))
                    rows += int(obs.get["rows"])
                self.metrics[name] = rows
                self._done.add(name)
        return from_stored(read_partitions(self.spark, self.path(name), kept), df.columns, derived)

    def load_log(self) -> DataFrame:
        """Rows written per table of this run, from its load log; tables built
        since it was last written are added to it."""
        path = self.path("_load_log")
        with self._table_lock("_load_log"):
            if len(self.metrics) > self._logged:
                rows = sorted(self.metrics.items())
                self.spark.createDataFrame(rows, "table_name string, rows_written long").coalesce(1).write.mode("overwrite").parquet(path)
                self._logged = len(rows)
        return self.spark.read.parquet(path)


def warehouse_for(spark: SparkSession, source_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, os.path.realpath(source_dir))
    with _LOCK:
        wh = _RUNS.get(key)
        if wh is None:
            base = checkpoint_dir(spark).rstrip("/")
            tag = os.path.basename(key[1].rstrip("/")) or "src"
            wh = Warehouse(spark, f"{base}/warehouse/{tag}-{uuid.uuid4().hex[:12]}")
            _RUNS[key] = wh
        return wh


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists (any Hadoop-compatible file system)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
