"""Layouts are rewritten without the columns their scans can compute."""

from pyspark.sql import functions as F

from emporium.functions.hashing import surrogate_key
from emporium.sources import ingest as I


def test_layouts_neither_move_nor_write_derived_columns(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(500).select(F.col("id").cast("string").alias("order_id"), (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("b")).write.parquet(src)
    df = spark.read.parquet(src).select(surrogate_key("order_id").alias("order_sk"), "order_id", "a", "b")
    derived = {"order_sk": (None, surrogate_key("order_id"))}
    for layout in (I.zorder, I.cluster):
        out = str(tmp_path / layout.__name__)
        back = layout(df, ["a", "b"], out, derived=derived)
        assert back.columns == df.columns and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
        assert spark.read.parquet(out).columns == ["order_id", "a", "b"]
