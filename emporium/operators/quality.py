"""Data-quality checks as DataFrames (never printed, never collected).

Each table is profiled in ONE aggregate pass -- every check of that table is
a conditional count in the same ``agg`` -- and the resulting single row is
unpivoted into ``(table, check, failed_rows, total_rows, passed)`` rows.
Referential checks ride on left joins whose miss flag is counted in that
same pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def table_checks(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """One pass over ``df``; ``checks`` maps name -> failed-row count expression."""
    names = list(checks)
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 *[checks[n].cast("bigint").alias(n) for n in names])
    long = agg.unpivot(["total_rows"], names, "check", "failed_rows")
    return long.select(F.lit(table).alias("table"), "check", "failed_rows", "total_rows",
                       (F.col("failed_rows") == 0).alias("passed"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def empty_table() -> Column:
    """1 when the table has no rows (a 'row count > 0' check)."""
    return F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)


def null_count(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def duplicate_count(c: str) -> Column:
    """Non-null values beyond the first occurrence (count - count distinct)."""
    return F.count(c) - F.count_distinct(c)


def missing_columns(df: DataFrame, required: list[str]) -> Column:
    """Schema check: how many required columns are absent (metadata, no scan)."""
    return F.lit(len([c for c in required if c not in df.columns]))


def flag_misses(df: DataFrame, ref: DataFrame, left_key: str, right_key: str, flag: str) -> DataFrame:
    """Left join ``df`` to the distinct keys of ``ref`` and add ``flag`` =
    true when the key has no partner (null keys are misses, as in an anti join)."""
    keys = ref.select(F.col(right_key).alias("_rk")).distinct().withColumn(flag, F.lit(False))
    j = df.join(keys, df[left_key] == keys["_rk"], "left").drop("_rk")
    return j.withColumn(flag, F.coalesce(F.col(flag), F.lit(True)))


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Null count of every column, one pass, long form."""
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 *[null_count(c).cast("bigint").alias(c) for c in df.columns])
    long = agg.unpivot(["total_rows"], df.columns, "column_name", "null_count")
    return long.select(F.lit(table).alias("table"), "column_name", "null_count", "total_rows")


def distinct_profile(df: DataFrame, table: str) -> DataFrame:
    """Exact distinct count per column: the columns as (name, value) rows,
    equal ones combined before the shuffle, then counted per name."""
    values = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "value")
    distinct = values.groupBy("column_name", "value").agg(F.lit(1).alias("one"))
    return distinct.groupBy("column_name").agg(F.count("value").alias("distinct_values")).select(
        F.lit(table).alias("table"), "column_name", "distinct_values")


def scd2_checks(dim: DataFrame, key: str, table: str = "dim_customers") -> DataFrame:
    """SCD2 invariants: current rows exist, <= 1 current row per key,
    no overlapping validity intervals between consecutive versions."""
    w = Window.partitionBy(key).orderBy("valid_from")
    nxt = F.lead("valid_from").over(w)
    ends = F.coalesce(F.col("valid_to"), F.lit("9999-12-31 23:59:59").cast("timestamp_ntz"))
    per_row = dim.select(key, "is_current", (nxt.isNotNull() & (nxt < ends)).alias("_overlap"))
    per_key = per_row.groupBy(key).agg(
        F.count_if("is_current").alias("_cur"), F.count_if("_overlap").alias("_ov"),
        F.count(F.lit(1)).alias("_n"))
    agg = per_key.agg(
        F.sum("_n").alias("total_rows"),
        F.when(F.sum("_cur") == 0, 1).otherwise(0).cast("bigint").alias("current_rows_present"),
        F.count_if(F.col("_cur") > 1).cast("bigint").alias("single_current_per_key"),
        F.sum("_ov").cast("bigint").alias("no_overlapping_versions"),
    )
    names = ["current_rows_present", "single_current_per_key", "no_overlapping_versions"]
    long = agg.unpivot(["total_rows"], names, "check", "failed_rows")
    return long.select(F.lit(table).alias("table"), "check", "failed_rows",
                       F.col("total_rows").cast("bigint").alias("total_rows"),
                       (F.col("failed_rows") == 0).alias("passed"))
