"""Bronze -> Silver: typed, validated, de-duplicated, audited tables.

Order of work per entity: cast (``try_cast`` -- bad text becomes null, never
an error), validate (reject reason), de-duplicate the *valid* rows on the
primary key with a total order, derive columns, add audit columns.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.functions import lookups
from emporium.functions.dates import seconds_between
from emporium.functions.hashing import row_hash
from emporium.functions.numeric import MONEY
from emporium.functions.text import clean_city, clean_state
from emporium.operators.cleanse import reject_reason, split_valid
from emporium.operators.dedup import keep_first
from emporium.operators.slices import SLICES, in_slices, is_large
from emporium.sources.bronze import bronze

# Batch timestamp stamped on audit columns when none is given; a parameter,
# never current_timestamp(), so reruns are reproducible.
DEFAULT_BATCH_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)

AUDIT_COLUMNS = ["ingestion_timestamp", "source_system", "record_hash"]

ORDER_TS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date"]
# What an order's record hash covers.
ORDER_COLUMNS = ["order_id", "customer_id", "order_status", *ORDER_TS]


def _ts(c: str):
    return F.trim(F.col(c)).try_cast("timestamp_ntz")


def add_audit_columns(df: DataFrame, source: str, batch_ts=DEFAULT_BATCH_TS,
                      hash_columns: list[str] | None = None) -> DataFrame:
    """ingestion_timestamp, source_system and a null-safe record hash."""
    cols = hash_columns or [c for c in df.columns if c not in AUDIT_COLUMNS]
    return df.select(
        "*",
        F.lit(batch_ts).cast("timestamp_ntz").alias("ingestion_timestamp"),
        F.lit(source).alias("source_system"),
        row_hash(df, cols).alias("record_hash"),
    )


def days(seconds: str):
    return F.col(seconds).cast("double") / F.lit(86400.0)


def line_total():
    return (F.col("price") + F.col("freight_value")).cast(MONEY)


def derived_columns(df: DataFrame):
    """What the scan of a stored Silver table computes (see ``warehouse``):
    columns that follow from others, and the record hash."""
    d = {}
    if "delivery_days" in df.columns:
        d["delivery_days"] = (None, days("delivery_seconds"))
    if "line_total_value" in df.columns:
        d["line_total_value"] = (None, line_total())
    if "record_hash" in df.columns:
        source = [c for c in df.columns if c not in AUDIT_COLUMNS]
        d["record_hash"] = (None, row_hash(df, ORDER_COLUMNS if "order_purchase_timestamp" in source else source))
    return d


# --------------------------------------------------------------------------- orders
def typed_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("order_id").alias("order_id"),
        F.trim("customer_id").alias("customer_id"),
        F.trim(F.upper("order_status")).alias("order_status"),
        *[_ts(c).alias(c) for c in ORDER_TS],
    )


def order_rules(df: DataFrame):
    return reject_reason(
        (F.col("order_id").isNotNull(), "null_order_id"),
        (F.col("order_status").isin(lookups.ORDER_STATUSES), "invalid_status"),
    )


def silver_orders(raw: DataFrame, batch_ts=DEFAULT_BATCH_TS, slices: int = 1, only: int | None = None) -> DataFrame:
    typed = in_slices(typed_orders(raw), ["order_id"], slices, only)
    # Validate first, then de-duplicate: an invalid copy can never evict a valid one.
    dedup = keep_first(typed, ["order_id"], ["order_purchase_timestamp", "customer_id"],
                       rejected=order_rules(typed).isNotNull())
    secs = F.when(F.col("order_delivered_customer_date").isNotNull()
                  & F.col("order_purchase_timestamp").isNotNull(),
                  seconds_between("order_purchase_timestamp", "order_delivered_customer_date"))
    enriched = dedup.withColumn("delivery_seconds", secs).select(
        "*",
        days("delivery_seconds").alias("delivery_days"),
        F.coalesce(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"),
                   F.lit(False)).alias("is_late_delivery"),
    )
    # The hash covers the source attributes; derived columns follow from them.
    return add_audit_columns(enriched, "orders", batch_ts, hash_columns=ORDER_COLUMNS)


def order_rejects(raw: DataFrame) -> DataFrame:
    typed = typed_orders(raw)
    _, bad = split_valid(typed, order_rules(typed))
    return bad


# --------------------------------------------------------------------------- customers
def typed_customers(raw: DataFrame, fold_accents: bool = False) -> DataFrame:
    return raw.select(
        F.trim("customer_id").alias("customer_id"),
        F.trim("customer_unique_id").alias("customer_unique_id"),
        F.trim("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        clean_city(F.col("customer_city"), fold_accents).alias("customer_city"),
        clean_state(F.col("customer_state")).alias("customer_state"),
    )


def customer_rules(df: DataFrame):
    return reject_reason((F.col("customer_id").isNotNull(), "null_customer_id"))


def silver_customers(raw: DataFrame, batch_ts=DEFAULT_BATCH_TS, fold_accents: bool = False) -> DataFrame:
    typed = typed_customers(raw, fold_accents).filter(F.col("customer_id").isNotNull())
    dedup = keep_first(typed, ["customer_id"], ["customer_unique_id"])
    return add_audit_columns(dedup, "customers", batch_ts)


# --------------------------------------------------------------------------- products
def translate_category(c, translations: dict[str, str] | None = None):
    """English category by the list of translations; unknown names are kept."""
    pairs = translations if translations is not None else lookups.CATEGORY_TRANSLATIONS
    if not pairs:
        return c
    translated = None
    for name, english in pairs.items():
        translated = F.when(c == name, english) if translated is None else translated.when(c == name, english)
    return translated.otherwise(c)


def typed_products(raw: DataFrame, translations: dict[str, str] | None = None) -> DataFrame:
    cat = F.trim(F.lower("product_category_name"))
    dims = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    return raw.select(
        F.trim("product_id").alias("product_id"),
        cat.alias("product_category_name"),
        translate_category(cat, translations).alias("product_category_name_english"),
        F.trim("product_name_lenght").try_cast("int").alias("product_name_lenght"),
        F.trim("product_description_lenght").try_cast("int").alias("product_description_lenght"),
        F.coalesce(F.trim("product_photos_qty").try_cast("int"), F.lit(0)).alias("product_photos_qty"),
        # Missing dimensions default to 0.0 (source rule); the flag keeps the fact visible.
        *[F.coalesce(F.trim(c).try_cast("double"), F.lit(0.0)).alias(c) for c in dims],
        F.trim("product_weight_g").try_cast("double").isNull().alias("weight_missing"),
    )


def product_rules(df: DataFrame):
    return reject_reason((F.col("product_id").isNotNull(), "null_product_id"))


def silver_products(raw: DataFrame, batch_ts=DEFAULT_BATCH_TS,
                    translations: dict[str, str] | None = None) -> DataFrame:
    typed = typed_products(raw, translations).filter(F.col("product_id").isNotNull())
    dedup = keep_first(typed, ["product_id"])
    return add_audit_columns(dedup, "products", batch_ts)


# --------------------------------------------------------------------------- payments
def typed_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("order_id").alias("order_id"),
        F.trim("payment_sequential").try_cast("int").alias("payment_sequential"),
        F.trim(F.upper("payment_type")).alias("payment_type"),
        F.trim("payment_installments").try_cast("int").alias("payment_installments"),
        F.trim("payment_value").try_cast(MONEY).alias("payment_value"),
    )


def payment_rules(df: DataFrame):
    return reject_reason(
        (F.col("order_id").isNotNull(), "null_order_id"),
        (F.col("payment_value") >= 0, "negative_or_invalid_value"),
        (F.col("payment_type").isin(lookups.PAYMENT_TYPES), "invalid_payment_type"),
    )


def payment_details(raw: DataFrame, batch_ts=DEFAULT_BATCH_TS, slices: int = 1) -> DataFrame:
    typed = in_slices(typed_payments(raw), ["order_id", "payment_sequential"], slices)
    # (order_id, payment_sequential) is the key: one valid row per key.
    dedup = keep_first(typed, ["order_id", "payment_sequential"],
                       rejected=payment_rules(typed).isNotNull())
    return add_audit_columns(dedup, "payments", batch_ts)


def payment_summary(details: DataFrame) -> DataFrame:
    """One row per order: totals, count, max installments, per-type amounts.

    Per-type amounts are the *largest* single payment of that type (null when
    the order has none); ``primary_payment_type`` is the type of the largest
    payment (ties -> greater type name).
    """
    per_type = [F.max(F.when(F.col("payment_type") == t, F.col("payment_value"))).alias(name)
                for t, name in lookups.PAYMENT_TYPE_COLUMNS]
    return details.groupBy("order_id").agg(
        F.sum("payment_value").cast(MONEY).alias("total_payment_value"),
        F.count(F.lit(1)).alias("payment_count"),
        F.max("payment_installments").alias("max_installments"),
        *per_type,
        F.max(F.struct("payment_value", "payment_type"))["payment_type"].alias("primary_payment_type"),
    )


# --------------------------------------------------------------------------- order items
def typed_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("order_id").alias("order_id"),
        F.trim("order_item_id").try_cast("int").alias("order_item_id"),
        F.trim("product_id").alias("product_id"),
        F.trim("seller_id").alias("seller_id"),
        _ts("shipping_limit_date").alias("shipping_limit_date"),
        F.round(F.trim("price").try_cast(MONEY), 2).cast(MONEY).alias("price"),
        F.round(F.trim("freight_value").try_cast(MONEY), 2).cast(MONEY).alias("freight_value"),
    )


def item_rules(df: DataFrame):
    return reject_reason(
        (F.col("order_id").isNotNull(), "null_order_id"),
        (F.col("product_id").isNotNull(), "null_product_id"),
        (F.col("order_item_id").isNotNull(), "null_order_item_id"),
        (F.col("price") >= 0, "negative_or_invalid_price"),
        (F.col("freight_value") >= 0, "negative_or_invalid_freight"),
        (F.col("price") < lookups.MAX_ITEM_PRICE, "price_over_limit"),
    )


def silver_order_items(raw: DataFrame, batch_ts=DEFAULT_BATCH_TS, slices: int = 1, only: int | None = None) -> DataFrame:
    typed = in_slices(typed_items(raw), ["order_id", "order_item_id"], slices, only)
    dedup = keep_first(typed, ["order_id", "order_item_id"],
                       ["product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
                       rejected=item_rules(typed).isNotNull())
    enriched = dedup.withColumn("line_total_value", line_total())
    return add_audit_columns(enriched, "order_items", batch_ts)


def item_rejects(raw: DataFrame) -> DataFrame:
    typed = typed_items(raw)
    _, bad = split_valid(typed, item_rules(typed))
    return bad


# --------------------------------------------------------------------------- builder
class Silver:
    """Silver tables over one source folder.

    Each table is built once per instance, so a plan that uses a table twice
    shares one subtree (Spark reuses the exchange). Without a store the
    tables are lazy plans; with one they are materialized.
    """

    def __init__(self, spark: SparkSession, base: str, batch_ts=DEFAULT_BATCH_TS, store=None,
                 raw_reader=None):
        """``raw_reader(entity) -> DataFrame`` supplies the Bronze entities
        (text columns); by default they are derived from the test tables
        under ``base``. With real landings pass e.g.
        ``lambda e: ingest.read_bronze(spark, bronze_root, e, latest=True)``."""
        self.spark, self.base, self.batch_ts, self.store = spark, base, batch_ts, store
        self.raw_reader = raw_reader or (lambda entity: bronze(spark, base, entity))
        # Stored tables are built in slices; a lazy plan, in which a table can appear several times, isn't.
        self.slices = SLICES if store is not None else 1
        self._t: dict[str, DataFrame] = {}

    def _memo(self, name, fn, part=None):
        """Build once; with a ``store`` (a Warehouse) the table is written
        once and read back (Bronze views stay lazy). ``part(i)`` is slice i of
        a table that is written slice by slice if its raw rows are many."""
        if name not in self._t:
            df = fn()
            if self.store is not None and not name.startswith("raw_"):
                df = self.store.persist("silver/" + name, df, derived=derived_columns(df),
                                        parts=[part(i) for i in range(self.slices)] if part is not None and is_large(self.raw(name)) else None)
            self._t.setdefault(name, df)
        return self._t[name]

    def raw(self, entity: str) -> DataFrame:
        return self._memo("raw_" + entity, lambda: self.raw_reader(entity))

    @property
    def orders(self):
        return self._memo("orders", lambda: silver_orders(self.raw("orders"), self.batch_ts, self.slices),
                          lambda i: silver_orders(self.raw("orders"), self.batch_ts, self.slices, i))

    @property
    def customers(self):
        return self._memo("customers", lambda: silver_customers(self.raw("customers"), self.batch_ts))

    @property
    def products(self):
        return self._memo("products", lambda: silver_products(self.raw("products"), self.batch_ts))

    @property
    def payment_details(self):
        return self._memo("payment_details", lambda: payment_details(self.raw("payments"), self.batch_ts, self.slices))

    @property
    def payment_summary(self):
        return self._memo("payment_summary", lambda: payment_summary(in_slices(self.payment_details, ["order_id"], self.slices)))

    @property
    def clickstream(self):
        """Decoded, valid clickstream events (the stream's Bronze -> Silver step, in batch)."""
        from emporium.sources.bronze import as_json_messages
        from emporium.streaming import clickstream as CS
        return self._memo("clickstream",
                          lambda: CS.decode_valid(as_json_messages(self.raw("clickstream"))))

    def orders_batch(self, n: int):
        """Silver orders of load batch ``n`` (1 or 2) of the upsert scenario."""
        from emporium.plans.history import BATCH2_TS
        ts = self.batch_ts if n == 1 else BATCH2_TS
        return self._memo(f"orders_batch{n}",
                          lambda: silver_orders(self.raw(f"orders_batch{n}"), ts, self.slices))

    @property
    def order_items(self):
        return self._memo("order_items", lambda: silver_order_items(self.raw("order_items"), self.batch_ts, self.slices),
                          lambda i: silver_order_items(self.raw("order_items"), self.batch_ts, self.slices, i))


def order_items_with_fallback(spark: SparkSession, silver_path: str, raw: DataFrame) -> DataFrame:
    """The Silver order items when that table exists, else the Bronze
    items put through the *same* Silver rules (never uncast raw rows)."""
    from emporium.sources.warehouse import exists
    if exists(spark, silver_path):
        return spark.read.parquet(silver_path)
    return silver_order_items(raw)
