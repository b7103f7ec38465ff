"""Write a skewed copy of a test-data folder (derived with Spark).

Usage: python tools/make_skewed.py <src_sf_dir> <out_dir>

One customer places a third of the orders, one product and one seller carry
a third of the order lines, one user produces a third of the events. Every
other table is copied unchanged. Run ``tools/compare.py <out_dir>`` on the
result to check every query against its oracle under skew.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from emporium.session import get_session  # noqa: E402
from emporium.sources.tables import TEST_TABLES  # noqa: E402


def main():
    src, out = sys.argv[1], sys.argv[2]
    spark = get_session("local[8]")
    hot = F.col("_h") % 3 == 0
    for t in TEST_TABLES:
        path = os.path.join(src, f"{t}.parquet")
        if not os.path.exists(path):
            continue
        df = spark.read.parquet(path)
        if t == "orders":
            df = df.withColumn("_h", F.col("o_orderkey")).withColumn(
                "o_custkey", F.when(hot, F.lit(7)).otherwise(F.col("o_custkey")))
        elif t == "lineitem":
            df = df.withColumn("_h", F.xxhash64("l_orderkey", "l_linenumber", "l_extendedprice")).withColumn(
                "l_partkey", F.when(hot, F.lit(11)).otherwise(F.col("l_partkey"))).withColumn(
                "l_suppkey", F.when(hot, F.lit(3)).otherwise(F.col("l_suppkey")))
        elif t == "events":
            df = df.withColumn("_h", F.col("event_id")).withColumn(
                "user_id", F.when(hot, F.lit(5)).otherwise(F.col("user_id")))
        cols = [c for c in df.columns if c != "_h"]
        # One file per table, like the local test folders this tool copies
        # (a local fixture generator, not a production job).
        df.select(*cols).coalesce(1).write.mode("overwrite").parquet(os.path.join(out, f"{t}.parquet.d"))
        # single-file layout like the source folder: <table>.parquet
        part = [f for f in os.listdir(os.path.join(out, f"{t}.parquet.d")) if f.endswith(".parquet")][0]
        os.link(os.path.join(out, f"{t}.parquet.d", part), os.path.join(out, f"{t}.parquet"))
    print("wrote", out)


if __name__ == "__main__":
    main()
