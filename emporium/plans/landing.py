"""Ingest, incremental-window and layout scenarios over the shared tables.

Landing CSV files are derived from the Bronze adapters (written to the
run's folder under ``spark.checkpoint.dir``), then ingested exactly as raw
files would be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.plans.gold import derived_columns
from emporium.plans.silver import silver_orders
from emporium.sources import ingest as I
from emporium.sources.bronze import bronze, entity_columns
from emporium.session import run_folder as workdir

LANDED = ["orders", "order_items", "payments", "customers", "products", "sellers", "geolocation"]


def _columns(entity: str) -> list[str]:
    return entity_columns(entity)


def ingest_config(spark: SparkSession, sf: str) -> DataFrame:
    """Config-driven CSV -> Bronze Parquet for every entity, then
    the Silver orders built from what was ingested."""
    root = workdir(spark, "ingest")
    for e in LANDED:
        I.land_csv(bronze(spark, sf, e), f"{root}/landing/{e}.csv")
    entries = [{"sourceFileName": f"{e}.csv", "sinkFolder": e, "description": f"{e} landing"} for e in LANDED]
    I.write_config(spark, entries, f"{root}/config")
    I.ingest(spark, f"{root}/config", f"{root}/landing", f"{root}/bronze", "2024-01-01",
             columns={e: _columns(e) for e in LANDED})
    return silver_orders(I.read_bronze(spark, f"{root}/bronze", "orders"))


def latest_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Two daily landings of orders; read only the newest one."""
    root = workdir(spark, "latest")
    cols = {"orders": _columns("orders")}
    for day, entity in (("2024-01-01", "orders_batch1"), ("2024-01-02", "orders_batch2")):
        I.land_csv(bronze(spark, sf, entity), f"{root}/landing/{day}/orders.csv")
        I.write_config(spark, [{"sourceFileName": "orders.csv", "sinkFolder": "orders",
                                "description": "orders landing"}], f"{root}/config/{day}")
        I.ingest(spark, f"{root}/config/{day}", f"{root}/landing/{day}", f"{root}/bronze", day, columns=cols)
    latest = I.read_bronze(spark, f"{root}/bronze", "orders", latest=True)
    return latest.select("order_id", F.trim("order_status").alias("order_status"), "ingest_date")


def window_slice(spark: SparkSession, sf: str, orders: DataFrame) -> DataFrame:
    """Monthly windows backfilled in one job, then the first window
    re-run on its own (dynamic overwrite: the result must not change)."""
    out = workdir(spark, "windows") + "/orders_by_window"
    I.backfill(orders, "order_purchase_timestamp", "month", out, key="order_id")
    first = orders.agg(F.min(F.date_trunc("month", "order_purchase_timestamp")).alias("m")).first()["m"]
    nxt = first.replace(year=first.year + (first.month == 12), month=first.month % 12 + 1)
    I.process_window(orders, "order_purchase_timestamp", first, nxt, out)
    back = spark.read.parquet(out)
    return back.groupBy("window_start").agg(F.count(F.lit(1)).alias("orders"))


def clustered_layout(spark: SparkSession, sf: str, fact: DataFrame) -> DataFrame:
    """M8: the order fact clustered on (date key, customer) and read back."""
    out = workdir(spark, "clustered") + "/fact_orders"
    return I.cluster(fact, ["order_date_key", "customer_id"], out, derived=derived_columns("fact_orders")).select(*fact.columns)


def zordered_layout(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """M8: the stored order fact along the Z-curve of (date key, customer), its
    monthly files compacted."""
    return I.zorder(fact, ["order_date_key", "customer_id"], workdir(spark, "zordered") + "/fact_orders",
                    derived=derived_columns("fact_orders"))


def revenue_last_year(fact: DataFrame) -> DataFrame:
    """Monthly revenue of the last twelve months of data, from the
    stored order fact, which lies in folders by month: the month bound is a
    scalar subquery, so only the matching folders are scanned."""
    latest = fact.agg(F.max("order_month")).scalar()
    recent = fact.filter(F.col("order_month") > latest - 100)
    return recent.groupBy("order_month").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_payment_value").cast("decimal(38,2)").alias("revenue"))
