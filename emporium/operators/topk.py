"""Top-n rows per group.

A rank filter on a window is planned with a group limit before the
shuffle: every task keeps n rows of a group at most, so however large a group
is, the task that ranks it gets n rows from each task before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n within each group under ``order`` (which must be a
    total order, e.g. ending with a unique key)."""
    ranked = df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(rank_col) <= n)
