"""The data-quality reports over Silver and Gold."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions import lookups
from emporium.functions.numeric import pct
from emporium.operators import quality as Q
from emporium.plans.gold import Gold
from emporium.plans.silver import AUDIT_COLUMNS

# Reference instant for the "future-dated orders" check; a parameter rather
# than the wall clock so the report is reproducible.
DEFAULT_AS_OF = _dt.datetime(2024, 1, 1)


def dq_report(g: Gold, as_of=DEFAULT_AS_OF) -> DataFrame:
    s = g.silver
    orders = Q.table_checks(s.orders, "silver_orders", {
        "row_count_positive": Q.empty_table(),
        "pk_not_null": Q.null_count("order_id"),
        "pk_unique": Q.duplicate_count("order_id"),
        "status_in_domain": F.count_if(~F.coalesce(F.col("order_status").isin(lookups.ORDER_STATUSES),
                                                   F.lit(False))),
        "audit_columns_present": Q.missing_columns(s.orders, AUDIT_COLUMNS),
    })
    customers = Q.table_checks(s.customers, "silver_customers", {
        "row_count_positive": Q.empty_table(),
        "pk_not_null": Q.null_count("customer_id"),
        "pk_unique": Q.duplicate_count("customer_id"),
    })
    payments = Q.table_checks(s.payment_details, "payment_details", {
        "non_negative_amounts": F.count_if(F.col("payment_value") < 0),
    })
    cur = g.dim_customers.filter(F.col("is_current"))
    f = g.fact_orders.select("order_id", "customer_id", "customer_unique_id", "order_date_key",
                             "total_payment_value", "order_purchase_timestamp")
    f = Q.flag_misses(f, g.dim_date, "order_date_key", "date_key", "_no_date")
    f = Q.flag_misses(f, cur, "customer_id", "customer_id", "_no_cust_id")
    f = Q.flag_misses(f, cur, "customer_unique_id", "customer_unique_id", "_no_person")
    fact = Q.table_checks(f, "fact_orders", {
        "row_count_positive": Q.empty_table(),
        "date_key_in_dim_date": F.count_if("_no_date"),
        "customer_id_in_dim_customers": F.count_if("_no_cust_id"),
        "person_in_dim_customers": F.count_if("_no_person"),
        "payment_not_null_or_zero": F.count_if(F.col("total_payment_value").isNull()
                                               | (F.col("total_payment_value") == 0)),
        "not_future_dated": F.count_if(F.col("order_purchase_timestamp")
                                       > F.lit(as_of).cast("timestamp_ntz")),
    })
    return Q.union_all([orders, customers, payments, fact])


def dq_table_summary(g: Gold) -> DataFrame:
    """Rows and purchase-date range of the order fact."""
    ts = F.col("order_purchase_timestamp")
    return g.fact_orders.agg(F.lit("fact_orders").alias("table_name"),
                             F.count(F.lit(1)).alias("row_count"),
                             F.min(ts).alias("min_date"), F.max(ts).alias("max_date"))


def dq_removal(g: Gold) -> DataFrame:
    """Raw vs cleansed row counts and removal rate per entity.

    Counts of both sides are unioned and pivoted by a group-by (no cross join).
    """
    s = g.silver
    pairs = [("orders", s.raw("orders"), s.orders),
             ("order_items", s.raw("order_items"), s.order_items),
             ("payments", s.raw("payments"), s.payment_details),
             ("customers", s.raw("customers"), s.customers),
             ("products", s.raw("products"), s.products)]
    parts = []
    for name, raw, clean in pairs:
        parts.append(raw.agg(F.lit(name).alias("entity"), F.count(F.lit(1)).alias("raw"),
                             F.lit(0).cast("bigint").alias("clean")))
        parts.append(clean.agg(F.lit(name).alias("entity"), F.lit(0).cast("bigint").alias("raw"),
                               F.count(F.lit(1)).alias("clean")))
    both = Q.union_all(parts).groupBy("entity").agg(F.sum("raw").alias("raw_count"),
                                                    F.sum("clean").alias("clean_count"))
    return both.select("entity", "raw_count", "clean_count",
                       (F.col("raw_count") - F.col("clean_count")).alias("removed"),
                       pct("raw_count - clean_count", "raw_count").alias("removal_rate"))


PROFILED = ("orders", "order_items", "products", "payments", "customers")


def dq_null_profile(g: Gold) -> DataFrame:
    """Nulls per column of the raw (Bronze) entities."""
    s = g.silver
    return Q.union_all([Q.null_profile(s.raw(e), e) for e in PROFILED])


def dq_distinct_profile(g: Gold) -> DataFrame:
    s = g.silver
    return Q.union_all([Q.distinct_profile(s.raw(e), e) for e in PROFILED])


def dq_table_stats(g: Gold) -> DataFrame:
    """Rows and columns of every Silver table."""
    s = g.silver
    tables = [("orders", s.orders), ("customers", s.customers), ("products", s.products),
              ("payment_details", s.payment_details), ("payment_summary", s.payment_summary),
              ("order_items", s.order_items)]
    return Q.union_all([t.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                              F.lit(len(t.columns)).alias("column_count")) for n, t in tables])


def dq_scd2(g: Gold) -> DataFrame:
    """D7."""
    return Q.scd2_checks(g.dim_customers, "customer_unique_id")


def dq_duplicates(g: Gold) -> DataFrame:
    """Raw keys delivered more than once, per entity (what de-duplication removes)."""
    from emporium.operators.dedup import duplicate_groups
    s = g.silver
    specs = [("orders", ["order_id"]), ("order_items", ["order_id", "order_item_id"]),
             ("payments", ["order_id", "payment_sequential"]), ("customers", ["customer_id"]),
             ("products", ["product_id"])]
    parts = [duplicate_groups(s.raw(e), keys).agg(
        F.lit(e).alias("entity"), F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra_rows")) for e, keys in specs]
    return Q.union_all(parts)
