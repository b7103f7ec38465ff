"""Landing -> Bronze ingest, incremental windows and file clustering.

* ``ingest``: a JSON config table lists ``{sourceFileName, sinkFolder,
  description}``; each entry is one CSV -> Parquet copy job into
  ``<bronze>/<sinkFolder>/ingest_date=<date>/`` (dynamic partition
  overwrite, so re-running a day replaces only that day). Copies run a few
  at a time from a thread pool -- Spark schedules concurrent jobs -- with a
  bounded number of retries per entry.
* ``read_bronze``: all landings of an entity, or only the latest one.
* ``process_window`` / ``backfill``: event-time slices written with dynamic
  partition overwrite -- one window per run, or every window in one job.
* ``cluster``: range-partition and sort a table on its filter keys so each
  file covers a narrow key range (min/max statistics then skip files).
"""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.sources.warehouse import Derived, from_stored, to_stored

# CSV dialect of the landing zone: comma, header row, '"' quote, '\' escape.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": "\\"}


def land_csv(df: DataFrame, path: str) -> None:
    """Write a DataFrame as landing CSV (all text)."""
    (df.select(*[F.col(c).cast("string") for c in df.columns])
       .write.mode("overwrite").options(**CSV_OPTIONS).csv(path))


def write_config(spark: SparkSession, entries: list[dict], path: str) -> None:
    spark.createDataFrame([json.dumps(e) for e in entries], "string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("sourceFileName string, sinkFolder string, description string").json(path)


def copy_one(spark: SparkSession, src: str, sink: str, ingest_date: str, columns: list[str] | None = None) -> None:
    """One CSV -> Parquet copy: every column read as text (schema-on-read)."""
    reader = spark.read.options(**CSV_OPTIONS)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    df = reader.csv(src)
    (df.withColumn("ingest_date", F.lit(ingest_date).cast("date"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("ingest_date").parquet(sink))


def ingest(spark: SparkSession, config_path: str, landing_root: str, bronze_root: str,
           ingest_date: str, parallel: int = 4, retries: int = 2, backoff_s: float = 1.0,
           columns: dict[str, list[str]] | None = None) -> list[str]:
    """Run every copy listed in the config; returns the sink folders written.

    The config is a handful of rows (one per source file); only those rows
    reach the driver, never the data.
    """
    entries = [r.asDict() for r in read_config(spark, config_path).collect()]

    def run(e):
        for attempt in range(retries + 1):
            try:
                copy_one(spark, f"{landing_root}/{e['sourceFileName']}", f"{bronze_root}/{e['sinkFolder']}",
                         ingest_date, (columns or {}).get(e["sinkFolder"]))
                return e["sinkFolder"]
            except Exception:  # noqa: BLE001
                if attempt == retries:
                    raise
                time.sleep(backoff_s * (attempt + 1))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(run, entries))


def read_bronze(spark: SparkSession, bronze_root: str, entity: str, latest: bool = False) -> DataFrame:
    """An entity's Bronze landings; ``latest`` keeps only the newest
    ``ingest_date`` (a partition filter fed by a scalar subquery: only the
    newest partition's files are read for the data)."""
    df = spark.read.parquet(f"{bronze_root}/{entity}")
    if latest:
        newest = df.agg(F.max("ingest_date")).scalar()
        df = df.filter(F.col("ingest_date") == newest)
    return df


def process_window(df: DataFrame, ts_col: str, start, end, out: str, window_col: str = "window_start") -> None:
    """One incremental run: rows with ``start <= ts < end`` replace that
    window's partition only (dynamic partition overwrite -> idempotent)."""
    ts = F.col(ts_col)
    part = df.filter((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz")))
    (part.withColumn(window_col, F.lit(start).cast("date"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(window_col).parquet(out))


def backfill(df: DataFrame, ts_col: str, unit: str, out: str, key: str,
             window_col: str = "window_start", files_hint: int | None = None) -> None:
    """Every window in one job: each row is tagged with its window and the
    table is range-partitioned on (window, key) before the write, so each
    task writes a contiguous stretch of windows and a hot window is split
    across tasks rather than landing in one."""
    tagged = df.withColumn(window_col, F.date_trunc(unit, F.col(ts_col)).cast("date"))
    n = files_hint or df.sparkSession.sparkContext.defaultParallelism
    (tagged.repartitionByRange(n, window_col, key)
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(window_col).parquet(out))


def cluster(df: DataFrame, keys: list[str], out: str, files: int | None = None, derived: Derived | None = None) -> DataFrame:
    """Z-order-like layout: range partitioning on the keys (sampled bounds,
    so a heavy key range is split by the following keys) and a sort inside
    each file; returns a scan of the written table. ``derived`` columns are
    neither exchanged nor written but computed by that scan."""
    n = files or df.sparkSession.sparkContext.defaultParallelism
    kept = to_stored(df, derived)
    (kept.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .write.mode("overwrite").option("compression", "zstd").parquet(out))
    return from_stored(df.sparkSession.read.parquet(out), df.columns, derived)


Z_BITS = 6           # of each column: 64 ranges by rank
Z_SAMPLE = 20_000    # rows from which the ranges are taken


def stored_bytes(df: DataFrame) -> int:
    """Size of the files a scan reads."""
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n")).distinct()
    return files.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _at_most(value: Column):
    return lambda bound: bound <= value


def _ranks(df: DataFrame, columns: list[str]) -> list[Column]:
    """For each column the number of bounds at or below the value; the bounds
    cut a sample into equally many rows, so ranks are spread evenly whatever
    the values' type or distribution. Nulls have rank 0."""
    total, n = df.count(), 1 << Z_BITS
    share = min(1.0, Z_SAMPLE / total) if total else 1.0
    picked = df.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < int(share * (1 << 30))).select(*columns).collect()
    out = []
    for c in columns:
        values = sorted(r[c] for r in picked if r[c] is not None)
        bounds = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
        value = F.col(c)
        rank = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), _at_most(value))) if bounds else F.lit(0)
        out.append(F.when(value.isNull(), F.lit(0)).otherwise(rank))
    return out


def z_key(ranks: list[Column], bits: int = Z_BITS) -> Column:
    """The ranks' bits interleaved, the first column's highest bit first."""
    key = F.lit(0).cast("long")
    for b in range(bits):
        for i, r in enumerate(ranks):
            bit = F.shiftright(r, b).bitwiseAND(1).cast("long")
            key = key.bitwiseOR(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - i))
    return key


def zorder(df: DataFrame, columns: list[str], out: str, target_bytes: int = 128 << 20,
           derived: Derived | None = None) -> DataFrame:
    """M8: a stored table rewritten along the Z-curve of some columns, its
    files merged (or split) to about ``target_bytes``; returns a scan of the
    new table. Every file covers a small box of all columns, where a plain
    sort narrows the first one only. ``derived`` columns are neither exchanged
    nor written but computed by that scan."""
    files = max(1, -(-stored_bytes(df) // target_bytes))
    tie = F.xxhash64(*columns)  # rows of one cell can be split over files
    kept = to_stored(df, derived)
    keyed = kept.withColumn("_z", z_key(_ranks(df, columns))).withColumn("_t", tie)
    (keyed.repartitionByRange(files, "_z", "_t").sortWithinPartitions("_z", *columns).drop("_z", "_t")
          .write.mode("overwrite").option("compression", "zstd").parquet(out))
    return from_stored(df.sparkSession.read.schema(kept.schema).parquet(out), df.columns, derived)


def file_ranges(df: DataFrame, key: str) -> DataFrame:
    """Per data file: rows and the min/max of ``key`` (layout diagnostics)."""
    return df.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))
