"""Table scans: Parquet (default), Delta when its jar is present, CSV for ingest."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations"]


def table_path(base: str, name: str) -> str:
    single = os.path.join(base, f"{name}.parquet")
    return single if "://" in base or os.path.exists(single) else os.path.join(base, name)


def read_table(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into it."""
    if fmt == "parquet":
        return spark.read.parquet(table_path(base, name))
    return spark.read.format(fmt).load(os.path.join(base, name))


class Tables:
    """Lazy accessor for the tables under one folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet"):
        self.spark, self.base, self.fmt = spark, base, fmt
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name, self.fmt)
        return self._cache[name]
