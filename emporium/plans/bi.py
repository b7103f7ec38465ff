"""Dashboard measures (cards, trends, segments, maps) as DataFrames.

Running / lagged measures (month-over-month, year-to-date, running total)
are computed with window functions over *already aggregated* month or day
rows: their size is bounded by the calendar span, so a window without a
partition key (one task) is safe at any data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.functions.numeric import MONEY_SUM, avg_exact, pct
from emporium.plans.marts import avg_days, current

DELIVERED = "DELIVERED"


def exec_cards(fact: DataFrame) -> DataFrame:
    """Total revenue, orders, average order value, average delivery days."""
    return fact.agg(
        F.sum("total_payment_value").cast(MONEY_SUM).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        avg_exact(F.col("total_payment_value")).alias("avg_order_value"),
        avg_days().alias("avg_delivery_days"),
    )


def _monthly(fact: DataFrame) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    return fact.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"),
                        F.date_format(ts, "yyyy-MM").alias("year_month")).agg(
        F.sum("total_payment_value").cast(MONEY_SUM).alias("revenue"))


def mom_growth(fact: DataFrame) -> DataFrame:
    """Revenue per month and growth over the previous month (%).

    Growth is 0 when the previous month had no revenue, null for the first month.
    """
    m = _monthly(fact).withColumn("prev_revenue", F.lag("revenue").over(Window.orderBy("year_month")))
    growth = pct("(revenue - prev_revenue) * 100", "prev_revenue * 100")
    return m.select(
        "year_month", "revenue", "prev_revenue",
        F.when(F.col("prev_revenue").isNull(), F.lit(None).cast("decimal(9,2)"))
         .when(F.col("prev_revenue") == 0, F.lit(0).cast("decimal(9,2)"))
         .otherwise(growth).alias("growth_pct"))


def ytd_revenue(fact: DataFrame) -> DataFrame:
    """Monthly revenue and its running total within each year."""
    w = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return _monthly(fact).select("year", "month", "revenue",
                                 F.sum("revenue").over(w).cast(MONEY_SUM).alias("ytd_revenue"))


def running_revenue(fact: DataFrame) -> DataFrame:
    """Daily revenue with its running total over all days."""
    d = fact.groupBy(F.to_date("order_purchase_timestamp").alias("date")).agg(
        F.sum("total_payment_value").cast(MONEY_SUM).alias("revenue"))
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return d.select("date", "revenue", F.sum("revenue").over(w).cast(MONEY_SUM).alias("running_revenue"))


def orders_by_status(fact: DataFrame) -> DataFrame:
    """V17."""
    return fact.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))


def segment_counts(clv: DataFrame) -> DataFrame:
    """People and revenue per value segment."""
    return clv.groupBy("value_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("lifetime_value").cast(MONEY_SUM).alias("revenue"))


def clv_histogram(clv: DataFrame, width: int = 500) -> DataFrame:
    """People per lifetime-value band of ``width``, every band that occurs."""
    # Integer division on cents: exact band edges.
    b = F.expr(f"CAST(lifetime_value * 100 AS BIGINT) div {width * 100}")
    return clv.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("customers")).select(
        "bucket", (F.col("bucket") * width).alias("bucket_start"), "customers")


def new_vs_returning(fact: DataFrame) -> DataFrame:
    """Per month, people ordering for the first time vs returning.

    Orders are counted per person and month first (combined before the
    shuffle), so a person is as many rows as there are months, however many
    orders they place; the first month joins these rows.
    """
    months = (fact.filter(F.col("customer_unique_id").isNotNull())
              .groupBy("customer_unique_id", F.date_format("order_purchase_timestamp", "yyyy-MM").alias("year_month"))
              .agg(F.count("order_id").alias("orders")))
    first = months.groupBy("customer_unique_id").agg(F.min("year_month").alias("first_month"))
    j = months.join(first, "customer_unique_id")
    kind = F.when(F.col("year_month") == F.col("first_month"), "new").otherwise("returning")
    return j.groupBy("year_month", kind.alias("customer_type")).agg(
        F.count("customer_unique_id").alias("customers"), F.sum("orders").alias("orders"))


def _with_geo(fact: DataFrame, dim_customers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    c = current(dim_customers).select("customer_unique_id", "customer_zip_code_prefix")
    g = dim_geography.select(F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
                             "latitude", "longitude", "state", "region")
    return fact.join(c, "customer_unique_id").join(g, "customer_zip_code_prefix")


def customer_map(fact: DataFrame, dim_customers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Revenue and orders per customer location."""
    j = _with_geo(fact, dim_customers, dim_geography)
    return j.groupBy(F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
                     "latitude", "longitude", "region").agg(
        F.sum("total_payment_value").cast(MONEY_SUM).alias("revenue"),
        F.count("order_id").alias("orders"))


def on_time_rate(fact: DataFrame) -> DataFrame:
    """Share of delivered orders that arrived by the estimate."""
    d = fact.filter(F.col("order_status") == DELIVERED)
    return d.agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        F.count_if(~F.col("is_late_delivery")).alias("on_time_orders"),
        pct("count_if(NOT is_late_delivery)", "count(1)").alias("on_time_rate"))


def delivery_by_region(fact: DataFrame, dim_customers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Delivered orders and average delivery days per customer region."""
    j = _with_geo(fact.filter(F.col("order_status") == DELIVERED), dim_customers, dim_geography)
    return j.groupBy("region").agg(F.count("order_id").alias("orders"),
                                   avg_days().alias("avg_delivery_days"))


def late_trend(fact: DataFrame) -> DataFrame:
    """Late share of delivered orders per month."""
    d = fact.filter(F.col("order_status") == DELIVERED)
    return d.groupBy(F.date_format("order_purchase_timestamp", "yyyy-MM").alias("year_month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("is_late_delivery")).alias("late_orders"),
        pct("count_if(is_late_delivery)", "count(1)").alias("late_pct"))


def delivery_heatmap(fact: DataFrame, dim_customers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Average delivery days per (customer state, month of year), long form."""
    j = _with_geo(fact.filter(F.col("order_status") == DELIVERED), dim_customers, dim_geography)
    return j.groupBy("state", F.month("order_purchase_timestamp").alias("month")).agg(
        F.count("order_id").alias("orders"), avg_days().alias("avg_delivery_days"))


def heatmap_wide(long: DataFrame) -> DataFrame:
    """The heatmap as a State x Month matrix (months 1..12 as columns)."""
    # One (state, month) row each in the long form; the explicit month list
    # makes this a single aggregation (no pass to discover pivot values).
    return long.groupBy("state").pivot("month", list(range(1, 13))).agg(F.max("avg_delivery_days"))


def top_customers(clv: DataFrame, n: int = 20) -> DataFrame:
    """The n people with the highest lifetime value (ties by id)."""
    return (clv.select("customer_unique_id", "city", "state", "lifetime_value", "total_orders")
               .orderBy(F.desc("lifetime_value"), "customer_unique_id").limit(n))


def top_categories_revenue(revenue_by_category: DataFrame, n: int = 10) -> DataFrame:
    """The n categories with most item revenue."""
    return revenue_by_category.orderBy(F.desc("revenue"), "category").limit(n)
