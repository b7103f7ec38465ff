"""Versioned tables (history / time travel) on plain Parquet.

A versioned table is a change log in folders ``_version=<n>``: each load adds
the rows it inserted or changed as the next folder, by one write job, with the
operation and the time of the load as columns. A snapshot at version n
is, per key, the row with the greatest ``_version <= n`` -- computed with a
partial ``max(struct)`` aggregate, so it partitions like any group-by and a
hot key is pre-reduced per task. Deletes are recorded as tombstones. A load
that died is repeated under its number, which overwrites its folder. Loads of one table
follow each other; this is no transaction log.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.operators.upsert import change_set, clean_source

LOAD_COLUMNS = ("_version", "_deleted", "_operation", "_loaded_at")


def tag(df: DataFrame, version: int, deleted: bool = False) -> DataFrame:
    return df.select("*", F.lit(version).alias("_version"), F.lit(deleted).alias("_deleted"))


def snapshot(log: DataFrame, keys: list[str], version: int | None = None) -> DataFrame:
    """Table content as of ``version`` (latest when None)."""
    data = [c for c in log.columns if c not in keys and c not in LOAD_COLUMNS]
    src = log if version is None else log.filter(F.col("_version") <= version)
    best = src.groupBy(*keys).agg(F.max(F.struct("_version", "_deleted", *data)).alias("_r"))
    return (best.filter(~F.col("_r._deleted"))
                .select(*keys, *[F.col("_r." + c).alias(c) for c in data]))


def add_version(rows: DataFrame, path: str, version: int, operation: str, loaded_at: _dt.datetime, deleted: bool = False) -> None:
    """Write ``rows`` as version ``version`` of the table."""
    (rows.select("*", F.lit(deleted).alias("_deleted"), F.lit(operation).alias("_operation"),
                 F.lit(loaded_at).cast("timestamp_ntz").alias("_loaded_at"))
         .write.mode("overwrite").parquet(f"{path}/_version={int(version)}"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def upsert_version(spark: SparkSession, path: str, source: DataFrame, keys: list[str], version: int, operation: str,
                   loaded_at: _dt.datetime) -> None:
    """Add the rows of ``source`` that are new or changed since the version
    before; the first version takes all."""
    src = clean_source(source, keys)
    if version > 1:
        before = snapshot(read_log(spark, path), keys, version - 1)
        kinds = change_set(before, src, keys).filter(F.col("change_type").isin("insert", "update"))
        src = src.join(kinds.select(*keys), keys, "left_semi")
    add_version(src, path, version, operation, loaded_at)


def version_at(log: DataFrame, when: _dt.datetime) -> int:
    """The last version loaded at or before a time (0: none)."""
    return log.filter(F.col("_loaded_at") <= F.lit(when).cast("timestamp_ntz")).agg(F.max("_version")).first()[0] or 0


def history(log: DataFrame) -> DataFrame:
    """One row per version with rows: version, operation, time, rows."""
    return log.groupBy(F.col("_version").cast("long").alias("version"), F.col("_operation").alias("operation"),
                       F.col("_loaded_at").alias("loaded_at")).agg(F.count(F.lit(1)).alias("rows")).orderBy("version")
