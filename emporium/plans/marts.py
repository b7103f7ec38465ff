"""Business marts over the Gold star schema (each a function -> DataFrame).

No side is broadcast by a hint: the planner and AQE broadcast a side when
its measured size is below the threshold (a calendar stretched by one wrong
timestamp is joined by shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions.numeric import MONEY_SUM, avg_exact, pct


def daily_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """V1: revenue, orders, freight, items and cancellations per calendar day."""
    j = fact.join(dim_date, fact["order_date_key"] == dim_date["date_key"])
    keys = ["date", "year", "month", "month_name", "year_month", "year_quarter", "day_name", "is_weekend"]
    # The fact has one row per order, so count(order_id) is the distinct count.
    return j.groupBy(*keys).agg(
        F.count("order_id").alias("daily_orders"),
        F.sum("total_payment_value").cast(MONEY_SUM).alias("daily_revenue"),
        F.sum("total_freight_value").cast(MONEY_SUM).alias("daily_freight_cost"),
        avg_exact(F.col("total_payment_value")).alias("avg_order_value"),
        F.sum("item_count").alias("items_sold"),
        F.count_if(F.col("order_status") == "CANCELED").alias("canceled_orders"),
        pct("count_if(order_status = 'CANCELED')", "count(1)").alias("cancellation_rate"),
    )


# --------------------------------------------------------------------------- helpers
def avg_days(seconds: str = "delivery_seconds"):
    """Average delivery time in days, from exact whole seconds."""
    return (F.sum(seconds).cast("double") / F.nullif(F.count(seconds), F.lit(0)).cast("double")
            / F.lit(86400.0))


def _late():
    return F.count_if(F.col("is_late_delivery"))


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def value_segment(ltv):
    from emporium.functions import lookups
    expr = None
    for bound, label in lookups.VALUE_SEGMENTS:
        expr = F.when(ltv > bound, label) if expr is None else expr.when(ltv > bound, label)
    return expr.otherwise(lookups.VALUE_SEGMENT_LOW)


# --------------------------------------------------------------------------- V2
def customer_lifetime_value(fact: DataFrame, dim_customers: DataFrame, literal: bool = False) -> DataFrame:
    """V2: per person, over delivered and shipped orders.

    The fact carries ``customer_unique_id`` so every order of a person counts.
    ``literal=True`` joins on the per-order ``customer_id`` kept in the
    dimension instead -- the source behaviour, which loses the person's
    other orders.
    """
    c = current(dim_customers).select("customer_unique_id", "customer_id",
                                      F.col("customer_city").alias("city"),
                                      F.col("customer_state").alias("state"))
    f = fact.filter(F.col("order_status").isin("DELIVERED", "SHIPPED"))
    # To person grain before the join: a hot person's orders are combined in
    # every task, and the join moves one row per person.
    key = "customer_id" if literal else "customer_unique_id"
    ts = F.col("order_purchase_timestamp")
    per = f.groupBy(key).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_payment_value").cast(MONEY_SUM).alias("lifetime_value"),
        avg_exact(F.col("total_payment_value")).alias("avg_order_value"),
        F.min(ts).alias("first_order_date"),
        F.max(ts).alias("last_order_date"),
        F.datediff(F.to_date(F.max(ts)), F.to_date(F.min(ts))).alias("customer_tenure_days"),
        avg_days().alias("avg_delivery_days"),
    )
    out = c.join(per, key).select("customer_unique_id", "city", "state", *[x for x in per.columns if x != key])
    return out.withColumn("value_segment", value_segment(F.col("lifetime_value")))


# --------------------------------------------------------------------------- V3
def primary_products(items: DataFrame) -> DataFrame:
    """First product of each order (lowest item number), one row per order."""
    return items.groupBy("order_id").agg(
        F.min_by("product_id", "order_item_id").alias("primary_product_id"))


def sales_by_category(fact: DataFrame, items: DataFrame, dim_products: DataFrame,
                      dim_date: DataFrame, item_weighted: bool = False) -> DataFrame:
    """V3: delivered orders by the category and size of their first product.

    ``item_weighted=True`` reproduces the source view, whose "first product"
    sub-query keeps one row per *item*, so each order's measures are counted
    once per item (order_count stays distinct).
    """
    prim = primary_products(items)
    if item_weighted:
        prim = items.select("order_id").join(prim, "order_id")
    f = fact.filter(F.col("order_status") == "DELIVERED")
    p = dim_products.select(F.col("product_id").alias("primary_product_id"), "category", "size_category")
    j = (prim.join(f, "order_id").join(p, "primary_product_id")
             .join(dim_date.select("date_key"), F.col("order_date_key") == F.col("date_key")))
    orders = F.count_distinct("order_id") if item_weighted else F.count("order_id")
    return j.groupBy("category", "size_category").agg(
        orders.alias("order_count"),
        F.sum("total_item_value").cast(MONEY_SUM).alias("total_revenue"),
        avg_exact(F.col("total_item_value")).alias("avg_order_value"),
        F.sum("item_count").alias("total_items_sold"),
        avg_days().alias("avg_delivery_days"),
        _late().alias("late_deliveries"),
        pct("count_if(is_late_delivery)", "count(1)").alias("late_delivery_pct"),
    )


# --------------------------------------------------------------------------- V4 / V13
def delivery_by_customer_geo(fact: DataFrame, dim_customers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """V4: delivered orders by the *customer's* state / city / region."""
    c = current(dim_customers).select("customer_unique_id", "customer_zip_code_prefix")
    g = dim_geography.select(F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
                             "state", "city", "region")
    j = (fact.filter(F.col("order_status") == "DELIVERED")
             .join(c, "customer_unique_id").join(g, "customer_zip_code_prefix"))
    return j.groupBy("state", "city", "region").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_payment_value").cast(MONEY_SUM).alias("total_revenue"),
        avg_days().alias("avg_delivery_days"),
        _late().alias("late_deliveries"),
        pct("count_if(is_late_delivery)", "count(1)").alias("late_delivery_pct"),
        avg_exact(F.col("total_payment_value")).alias("avg_order_value"),
        F.sum("total_freight_value").cast(MONEY_SUM).alias("total_freight_cost"),
        pct("sum(total_freight_value) * 100", "sum(total_payment_value) * 100").alias("freight_pct_of_revenue"),
    )


def seller_performance(fact_items: DataFrame, dim_sellers: DataFrame) -> DataFrame:
    """Delivered items by the seller who shipped them. Items are brought
    to seller grain before the join, so a hot seller is one row in it."""
    s = dim_sellers.select("seller_id", "seller_city", "seller_state", "seller_region")
    by_seller = fact_items.filter(F.col("order_status") == "DELIVERED").groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("items_sold"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("price").cast(MONEY_SUM).alias("total_revenue"),
        F.sum("freight_value").cast(MONEY_SUM).alias("total_freight"),
        avg_days().alias("avg_delivery_days"),
        pct("count_if(is_late_delivery)", "count(1)").alias("late_item_pct"),
    )
    return s.join(by_seller, "seller_id")


# --------------------------------------------------------------------------- V5-V9
def status_metrics(fact: DataFrame) -> DataFrame:
    """V5: orders, revenue and delivery time (1 decimal) per status."""
    from emporium.functions.numeric import round_div
    return fact.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_payment_value").cast(MONEY_SUM).alias("total_revenue"),
        round_div("sum(delivery_seconds)", "count(delivery_seconds) * 86400", 1)
         .cast("decimal(18,1)").alias("avg_delivery_days"),
    )


def payment_type_distribution(details: DataFrame) -> DataFrame:
    """V6: payments and amount per payment type."""
    return details.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("payment_value").cast(MONEY_SUM).alias("total_value"))


def top_sellers(items: DataFrame, n: int = 10) -> DataFrame:
    """V7: top-n sellers by item revenue (ties by seller id)."""
    agg = items.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("items_sold"),
        F.sum("price").cast(MONEY_SUM).alias("total_revenue"))
    return agg.orderBy(F.desc("total_revenue"), "seller_id").limit(n)


def top_categories(products: DataFrame, n: int = 20) -> DataFrame:
    """V8: most common product categories."""
    agg = products.groupBy(F.col("product_category_name_english").alias("category")).agg(
        F.count(F.lit(1)).alias("count"))
    return agg.orderBy(F.desc("count"), "category").limit(n)


def category_size_distribution(dim_products: DataFrame, n: int = 20) -> DataFrame:
    """V8: most common (category, size) pairs."""
    agg = dim_products.groupBy("category", "size_category").agg(F.count(F.lit(1)).alias("count"))
    return agg.orderBy(F.desc("count"), "category", "size_category").limit(n)


def zips_by_region(dim_geography: DataFrame) -> DataFrame:
    """V9: zip prefixes per region."""
    return dim_geography.groupBy("region").agg(F.count(F.lit(1)).alias("zip_codes"))


# --------------------------------------------------------------------------- V10-V14
def monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Delivered orders and revenue per calendar month."""
    j = (fact.filter(F.col("order_status") == "DELIVERED")
             .join(dim_date.select("date_key", "year_month"),
                   F.col("order_date_key") == F.col("date_key")))
    return j.groupBy("year_month").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_payment_value").cast(MONEY_SUM).alias("revenue"))


def monthly_revenue_items(fact_items: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Item-grain revenue, freight and delivery time per month."""
    d = dim_date.select("date_key", "year", "month", "month_name")
    j = fact_items.join(d, F.col("order_date_key") == F.col("date_key"))
    return j.groupBy("year", "month", "month_name").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("price").cast(MONEY_SUM).alias("revenue"),
        F.sum("freight_value").cast(MONEY_SUM).alias("freight"),
        avg_days().alias("avg_delivery_days"))


def top_products_by_year(fact_items: DataFrame, dim_products: DataFrame, n: int = 10,
                         year: int | None = None) -> DataFrame:
    """The n products with most revenue in each purchase year.

    Products are aggregated to (year, product) first; every task cuts its rows
    to n a year before they are ranked together.
    """
    from emporium.operators.topk import top_n_per_group
    f = fact_items.withColumn("year", F.year("order_purchase_timestamp"))
    if year is not None:
        f = f.filter(F.col("year") == year)
    agg = f.groupBy("year", "product_id").agg(
        F.sum("price").cast(MONEY_SUM).alias("revenue"),
        F.count_distinct("order_id").alias("orders"))
    ranked = top_n_per_group(agg, ["year"], [F.desc("revenue"), F.col("product_id")], n)
    return ranked.join(dim_products.select("product_id", "category"), "product_id", "left").select(
        "year", "rank", "category", "product_id", "revenue", "orders")


def revenue_by_category(fact_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Item revenue per product category. Items are brought to product
    grain before the join."""
    by_product = fact_items.groupBy("product_id").agg(F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("items"))
    j = by_product.join(dim_products.select("product_id", "category"), "product_id")
    return j.groupBy("category").agg(
        F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
        F.sum("items").alias("items"))


def customer_id_ratio(customers: DataFrame) -> DataFrame:
    """Customer ids per real person (one aggregate pass)."""
    from emporium.functions.numeric import round_div
    return customers.agg(
        F.count(F.lit(1)).alias("total_ids"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        round_div("count(1)", "count(DISTINCT customer_unique_id)", 2).cast("decimal(18,2)")
         .alias("ids_per_customer"))
