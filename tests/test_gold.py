import datetime as dt

from pyspark.sql import functions as F

from emporium.plans import gold as G


def test_dim_date_reference_range(spark):
    d = G.dim_date(spark)
    assert d.count() == 4018
    rows = {r.date: r for r in d.filter(F.col("date").isin(
        dt.date(2016, 2, 29), dt.date(2024, 12, 30), dt.date(2024, 1, 7), dt.date(2026, 12, 31))).collect()}
    leap = rows[dt.date(2016, 2, 29)]
    assert leap.date_key == 20160229 and leap.is_month_end and leap.day_of_year == 60
    assert rows[dt.date(2024, 12, 30)].week_of_year == 1           # ISO week 1 of 2025
    sunday = rows[dt.date(2024, 1, 7)]
    assert sunday.day_of_week == 1 and sunday.day_name == "Sunday" and sunday.is_weekend
    end = rows[dt.date(2026, 12, 31)]
    assert end.year_quarter == "2026-Q4" and end.month_name == "December" and end.month_short == "Dec"


def test_region_map(spark):
    from emporium.functions import lookups
    states = [s for _, ss in lookups.REGION_STATES for s in ss] + ["XX"]
    assert len(states) == 28
    df = spark.createDataFrame([(s,) for s in states], "state string")
    got = {r.state: r.region for r in df.select("state", G.region_of(F.col("state")).alias("region")).collect()}
    assert got["SP"] == "Southeast" and got["RS"] == "South" and got["BA"] == "Northeast"
    assert got["DF"] == "Central-West" and got["AM"] == "North" and got["XX"] == "Unknown"


def test_fact_pre_aggregates_items(spark):
    from decimal import Decimal
    orders = spark.createDataFrame(
        [("o1", "c1", "DELIVERED", dt.datetime(2018, 1, 1, 12), None, None, None, None, None, None, False)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz, "
        "delivery_seconds long, delivery_days double, is_late_delivery boolean")
    items = spark.createDataFrame([("o1", Decimal("10.00"), Decimal("1.00")), ("o1", Decimal("5.50"), Decimal("0.50"))],
                                  "order_id string, price decimal(18,2), freight_value decimal(18,2)")
    pay = spark.createDataFrame([("o1", Decimal("17.00"), 1, 1)],
                                "order_id string, total_payment_value decimal(18,2), payment_count long, "
                                "max_installments int")
    f = G.fact_orders(orders, items, pay).collect()
    assert len(f) == 1
    r = f[0]
    assert r.total_item_value == Decimal("15.50") and r.item_count == 2 and r.order_date_key == 20180101
    assert r.order_month == 201801


def test_a_hot_order_is_combined_before_its_shuffle(spark):
    """Items and payments of one order reach its task as a row per task before it."""
    from conftest import SF_SMALL
    from emporium.plans.gold import items_per_order
    from emporium.plans.registry import lakehouse
    from emporium.plans.silver import payment_summary
    s = lakehouse(spark, SF_SMALL).silver
    for df in (items_per_order(s.order_items), payment_summary(s.payment_details)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Exchange hashpartitioning(order_id"):]
        assert "partial_sum" in below and "Scan parquet" in below
