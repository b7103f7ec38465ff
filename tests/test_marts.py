"""Mart semantics on literal fixtures (Q13, Q15) and the exact ratio helpers."""

import datetime as dt
from decimal import Decimal

from emporium.plans import marts

FACT = ("order_id string, customer_id string, customer_unique_id string, order_date_key int, "
        "total_item_value decimal(18,2), total_freight_value decimal(18,2), total_payment_value decimal(18,2), "
        "item_count long, delivery_seconds long, order_status string, is_late_delivery boolean, "
        "order_purchase_timestamp timestamp_ntz")
DIMC = ("customer_unique_id string, customer_id string, customer_city string, customer_state string, "
        "customer_zip_code_prefix string, is_current boolean")


def test_person_with_two_customer_ids(spark):
    f = spark.createDataFrame([
        ("o1", "c1", "u1", 20180101, Decimal("10"), Decimal("1"), Decimal("300.00"), 1, 86400, "DELIVERED",
         False, dt.datetime(2018, 1, 1)),
        ("o2", "c2", "u1", 20180301, Decimal("10"), Decimal("1"), Decimal("250.00"), 1, 3 * 86400, "SHIPPED",
         True, dt.datetime(2018, 3, 1))], FACT)
    d = spark.createDataFrame([("u1", "c1", "X", "SP", "1", True)], DIMC)
    clv = marts.customer_lifetime_value(f, d).collect()[0]
    assert clv.total_orders == 2 and clv.lifetime_value == Decimal("550.00")
    assert clv.value_segment == "High Value" and clv.customer_tenure_days == 59
    assert clv.avg_delivery_days == 2.0
    lit = marts.customer_lifetime_value(f, d, literal=True).collect()[0]
    assert lit.total_orders == 1 and lit.value_segment == "Medium Value"   # the other id's order is lost


def test_first_product_fan_out(spark):
    f = spark.createDataFrame([
        ("o1", "c1", "u1", 20180101, Decimal("60.00"), Decimal("3"), Decimal("63.00"), 3, 86400, "DELIVERED",
         True, dt.datetime(2018, 1, 1))], FACT)
    items = spark.createDataFrame([("o1", 1, "pA"), ("o1", 2, "pB"), ("o1", 3, "pA")],
                                  "order_id string, order_item_id int, product_id string")
    prods = spark.createDataFrame([("pA", "toys", "Small"), ("pB", "audio", "Large")],
                                  "product_id string, category string, size_category string")
    dates = spark.createDataFrame([(20180101,)], "date_key int")
    one = marts.sales_by_category(f, items, prods, dates).collect()
    assert [(r.category, r.order_count, r.total_revenue, r.late_delivery_pct) for r in one] == \
        [("toys", 1, Decimal("60.00"), Decimal("100.00"))]
    fan = marts.sales_by_category(f, items, prods, dates, item_weighted=True).collect()[0]
    assert fan.order_count == 1 and fan.total_revenue == Decimal("180.00") and fan.total_items_sold == 9


def test_exact_ratios(spark):
    from emporium.functions.numeric import pct_sql, round_div_sql
    row = spark.sql(f"""SELECT {pct_sql('1', '32')} AS a, {pct_sql('1', '8')} AS b, {pct_sql('2', '3')} AS c,
                        {round_div_sql('-5', '2', 0)} AS d, {pct_sql('1', '0')} AS e""").collect()[0]
    assert row.a == Decimal("3.13") and row.b == Decimal("12.50") and row.c == Decimal("66.67")
    assert row.d == Decimal("-3") and row.e is None
