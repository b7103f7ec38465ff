"""Stored tables in partition folders, and upserts that rewrite only the
partitions a batch touches.

A partition is touched if a batch row lies in it or if the table holds a row
there that the batch replaces (a key may move). The old rows are
read from the touched partitions alone, merged with the batch, and written by
dynamic overwrite: files of all other partitions stay as they are, by name.
The outcome of a batch is the same when it is applied again, so a run that
died half-way is repeated.

Partition values are a small set (months): their list goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emporium.operators.upsert import change_set, clean_source, upsert


def write_partitions(df: DataFrame, path: str, column: str, order: list[str], rows: Observation | None = None) -> None:
    """Write ``df`` as folders of ``column``, replacing those it has rows for.

    Range partitioning on (column, order) gives each task a stretch of
    partitions, so there are few files per folder, and splits a heavy one over several tasks. ``rows``
    counts what is written (behind the exchange: its bounds are sampled in a pass of their own)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartitionByRange(n, column, *order).sortWithinPartitions(column, *order)
    if rows is not None:
        out = out.observe(rows, F.count(F.lit(1)).alias("rows"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(column).parquet(path))


def read_partitions(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored table with the columns and types of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def touched_partitions(target: DataFrame, source: DataFrame, keys: list[str], column: str, hash_col: str = "record_hash") -> tuple[list, list]:
    """Partition values that applying ``source`` to ``target`` changes: those
    where new and changed rows lie, and those that only lose rows."""
    kinds = change_set(target.select(*keys, hash_col), source.select(*keys, hash_col), keys, hash_col)
    changed = kinds.filter(F.col("change_type").isin("insert", "update")).select(*keys)
    after = clean_source(source, keys).join(changed, keys, "left_semi").select(column, F.lit(1).alias("gets"))
    before = target.join(changed, keys, "left_semi").select(column, F.lit(0).alias("gets"))
    found = after.union(before).groupBy(column).agg(F.max("gets").alias("gets")).collect()
    return [r[0] for r in found if r.gets], [r[0] for r in found if not r.gets]


def _among(column: str, values: list):
    some = F.col(column).isin([v for v in values if v is not None])
    return some | F.col(column).isNull() if None in values else some


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: list[str], column: str, order: list[str]) -> list:
    """Apply ``source`` to the table at ``path``; returns the partitions
    rewritten. Rows of the batch whose hash equals the stored one change
    nothing, and a batch without changes rewrites nothing."""
    target = read_partitions(spark, path, source)
    gain, lose = touched_partitions(target, source, keys, column)
    values = gain + lose
    if values:
        src = clean_source(source, keys)
        # rows of the batch that lie elsewhere are unchanged (else their partition would be touched)
        merged = upsert(target.filter(_among(column, values)), src.filter(_among(column, values)), keys)
        # a partition that loses its last row gets no rows, so the overwrite would leave its files
        emptied = set(lose) - {r[0] for r in merged.filter(_among(column, lose)).select(column).distinct().collect()} if lose else set()
        write_partitions(merged, path, column, order)
        for v in emptied:
            folder = "__HIVE_DEFAULT_PARTITION__" if v is None else v
            spark.createDataFrame([], source.drop(column).schema).write.mode("overwrite").parquet(f"{path}/{column}={folder}")
    return sorted(values, key=lambda v: (v is None, v))
