"""Silver -> Gold: the star schema.

Partitioning note: items and payments are aggregated on ``order_id`` and the
order table is de-duplicated on ``order_id``; all three come out
hash-partitioned on that key, so the two left joins that assemble the order
fact need no further exchange.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emporium.functions import lookups
from emporium.functions.dates import calendar_columns, date_key, month_key
from emporium.functions.hashing import surrogate_key
from emporium.functions.numeric import MONEY, round_div
from emporium.operators.dedup import keep_first
from emporium.operators.scd import asof_lookup
from emporium.operators.slices import in_slices, is_large
from emporium.plans.silver import ORDER_TS, Silver, days, line_total

REFERENCE_DATE_RANGE = (_dt.date(2016, 1, 1), _dt.date(2026, 12, 31))


def items_per_order(items: DataFrame) -> DataFrame:
    """Pre-aggregate items to order grain before joining (prevents fan-out)."""
    return items.groupBy("order_id").agg(
        F.sum("price").cast(MONEY).alias("total_item_value"),
        F.sum("freight_value").cast(MONEY).alias("total_freight_value"),
        F.count(F.lit(1)).alias("item_count"),
    )


def fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame,
                customers: DataFrame | None = None) -> DataFrame:
    """One row per order with item, payment and delivery measures.

    ``customer_unique_id`` (the person, not the per-order customer id) is
    carried so marts can group a person's orders together.
    """
    pay = payments.select("order_id", "total_payment_value", "payment_count", "max_installments")
    o = orders.select("order_id", "customer_id", "delivery_days", "delivery_seconds", "order_status", "is_late_delivery", *ORDER_TS)
    if customers is not None:  # first, while an order's row is narrow
        o = o.join(customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
    else:
        o = o.withColumn("customer_unique_id", F.lit(None).cast("string"))
    f = (o.join(items_per_order(items), "order_id", "left")
          .join(pay, "order_id", "left"))
    return f.select(
        surrogate_key("order_id").alias("order_sk"),
        "order_id", "customer_id", "customer_unique_id",
        date_key("order_purchase_timestamp").alias("order_date_key"),
        month_key("order_purchase_timestamp").alias("order_month"),
        "total_item_value", "total_freight_value", "total_payment_value",
        "item_count", "payment_count", "max_installments",
        "delivery_days", "delivery_seconds",
        "order_status", "is_late_delivery",
        *ORDER_TS,
    )


def dim_date(spark: SparkSession, start=REFERENCE_DATE_RANGE[0], end=REFERENCE_DATE_RANGE[1]) -> DataFrame:
    """Calendar rows from ``start`` to ``end`` inclusive (defaults: 2016..2026)."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def dim_date_covering(orders: DataFrame) -> DataFrame:
    """Whole calendar years spanning the orders' purchase dates.

    One global min/max aggregate (partial per task) feeds a sequence whose
    length is bounded by the calendar span, not by the data volume.
    """
    ts = F.col("order_purchase_timestamp")
    bounds = orders.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    days = bounds.select(F.explode(F.sequence(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
        F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def size_category(weight) -> F.Column:
    expr = None
    for bound, label in lookups.SIZE_BANDS:
        expr = F.when(weight < bound, label) if expr is None else expr.when(weight < bound, label)
    return expr.otherwise(lookups.SIZE_BAND_TOP)


def dim_products(products: DataFrame, batch_ts=None) -> DataFrame:
    from emporium.plans.silver import DEFAULT_BATCH_TS
    ts = batch_ts or DEFAULT_BATCH_TS
    return products.select(
        surrogate_key("product_id").alias("product_sk"),
        "product_id",
        F.col("product_category_name_english").alias("category"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty", "product_weight_g", "product_length_cm",
        "product_height_cm", "product_width_cm",
        F.round(F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"), 2)
         .alias("product_volume_cm3"),
        size_category(F.col("product_weight_g")).alias("size_category"),
        "weight_missing",
        F.lit(ts).cast("timestamp_ntz").alias("valid_from"),
        F.lit(True).alias("is_current"),
    )


def region_of(state) -> F.Column:
    expr = None
    for region, states in lookups.REGION_STATES:
        expr = F.when(state.isin(states), region) if expr is None else expr.when(state.isin(states), region)
    return expr.otherwise(lookups.UNKNOWN_REGION)


def silver_geolocation(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.trim("geolocation_lat").try_cast("decimal(12,5)").alias("lat"),
        F.trim("geolocation_lng").try_cast("decimal(12,5)").alias("lng"),
        F.trim("geolocation_city").alias("city"),
        F.trim("geolocation_state").alias("state"),
    ).filter(F.col("zip_code_prefix").isNotNull())


def dim_geography(geo: DataFrame) -> DataFrame:
    """One row per zip prefix: centroid (6 decimals), dominant city/state.

    Two-level aggregation: (zip, city, state) first -- partial, skew-safe --
    then zip. The dominant place is the most frequent (city, state) pair,
    ties broken by name, instead of an order-dependent ``first``.
    """
    lat5 = (F.col("lat") * 100000).cast("bigint")
    lng5 = (F.col("lng") * 100000).cast("bigint")
    per_place = geo.groupBy("zip_code_prefix", "city", "state").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(lat5).alias("lat_sum"), F.count(lat5).alias("lat_n"),
        F.sum(lng5).alias("lng_sum"), F.count(lng5).alias("lng_n"),
    )
    per_zip = per_place.groupBy("zip_code_prefix").agg(
        F.sum("n").alias("geo_points_count"),
        F.sum("lat_sum").alias("lat_sum"), F.sum("lat_n").alias("lat_n"),
        F.sum("lng_sum").alias("lng_sum"), F.sum("lng_n").alias("lng_n"),
        F.min(F.struct((-F.col("n")).alias("neg_n"), "city", "state")).alias("top"),
    )
    return per_zip.select(
        surrogate_key("zip_code_prefix").alias("geography_sk"),
        "zip_code_prefix",
        F.col("top.city").alias("city"),
        F.col("top.state").alias("state"),
        round_div("lat_sum", "lat_n * 100000", 6).cast("decimal(12,6)").alias("latitude"),
        round_div("lng_sum", "lng_n * 100000", 6).cast("decimal(12,6)").alias("longitude"),
        region_of(F.col("top.state")).alias("region"),
        "geo_points_count",
    )


def dim_sellers(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        F.trim("seller_id").alias("seller_id"),
        F.trim("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.trim("seller_city").alias("seller_city"),
        F.trim("seller_state").alias("seller_state"),
    ).filter(F.col("seller_id").isNotNull())
    dedup = keep_first(typed, ["seller_id"])
    return dedup.select(surrogate_key("seller_id").alias("seller_sk"), "*",
                        region_of(F.col("seller_state")).alias("seller_region"))


#: What the item fact counts while it is written.
ITEM_MISSES = ["items", "without_order", "without_product", "without_seller", "without_customer"]


def absent_keys(items: DataFrame, dimensions: dict[str, DataFrame], slices: int = 1) -> DataFrame:
    """The product, seller, ... ids of items that their dimension lacks, each
    once: (dimension, id). Only ids are exchanged, each once per task."""
    ids = items.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(f"{d}_id").alias("id")) for d in dimensions])).alias("r"))
    known = reduce(DataFrame.unionAll, [t.select(F.lit(d).alias("dimension"), F.col(f"{d}_id").alias("id")) for d, t in dimensions.items()])
    return (in_slices(ids.select("r.dimension", "r.id"), ["dimension", "id"], slices).distinct().where(F.col("id").isNotNull())
            .join(known, ["dimension", "id"], "left_anti"))


def fact_order_items(orders: DataFrame, items: DataFrame, products: DataFrame, sellers: DataFrame, customers: DataFrame,
                     dim_customers: DataFrame, observed: Observation | None = None, packed_keys: bool = False,
                     absent: DataFrame | None = None) -> DataFrame:
    """Item grain: one row per (order, line) with the order's context and the
    keys of the dimensions it belongs to (the customer's version valid at
    purchase). An item without an order is dropped, one without a product,
    seller or customer keeps a null key; ``observed`` counts all four in the
    pass that writes the fact, so nothing disappears unseen.

    The customer's version is found per order, not per item, from the versions
    of each customer, and items meet products and sellers before they get the
    order's columns, so only narrow rows are exchanged. ``absent``: the
    ``absent_keys`` of the items, stored. Items then meet those, mostly few,
    instead of products and sellers (each of them once, with the key that
    Gold's dimensions give), so that they are exchanged by order alone unless
    many ids are absent. ``packed_keys``: dimension keys that are hashes of the
    natural key stay what they are made of until the stored fact is scanned
    (``derived_columns``): whether the product and the seller were found, and
    the person and start of the customer's version."""
    version = ["customer_unique_id", "valid_from"] if packed_keys else ["customer_sk"]
    o = orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                      "delivery_days", "delivery_seconds", "is_late_delivery", F.lit(True).alias("_has_order"))
    people = customers.select("customer_id", "customer_unique_id")
    versions = dim_customers.select("customer_unique_id", "valid_from", "valid_to", *([] if packed_keys else ["customer_sk"]))
    o = asof_lookup(o, people.join(versions, "customer_unique_id"), "customer_id", "order_purchase_timestamp")
    o = o.select("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                 "delivery_days", "delivery_seconds", "is_late_delivery", "_has_order", *version)
    j = items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "line_total_value", "shipping_limit_date")
    for d, table in (("seller", sellers), ("product", products)):
        natural, key = f"{d}_id", f"{d}_sk"
        if absent is None:
            j = j.join(table.select(natural, F.lit(True).alias(key) if packed_keys else key), natural, "left")
        else:
            lacking = absent.where(F.col("dimension") == d).select(F.col("id").alias(natural), F.lit(True).alias("_lacking"))
            found = F.col(natural).isNotNull() & F.col("_lacking").isNull()
            j = j.join(lacking, natural, "left").withColumn(key, F.when(found, F.lit(True))).drop("_lacking")
    j = j.join(o, "order_id", "left")
    if observed is not None:
        found = F.col("_has_order").isNotNull()
        missed = {"product": "product_sk", "seller": "seller_sk", "customer": version[-1]}
        j = j.observe(observed, F.count(F.lit(1)).alias("items"), F.count_if(~found).alias("without_order"),
                      *[F.count_if(found & F.col(c).isNull()).alias(f"without_{d}") for d, c in missed.items()])
    customer = F.when(F.col("valid_from").isNotNull(), F.struct(*version)).alias("customer_sk") if packed_keys else F.col("customer_sk")
    keys = [f"{d}_sk" if packed_keys or absent is None else F.when(F.col(f"{d}_sk"), surrogate_key(f"{d}_id")).alias(f"{d}_sk") for d in ("product", "seller")]
    return j.filter("_has_order").select(
        surrogate_key("order_id", F.col("order_item_id").cast("string")).alias("order_item_sk"),
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id",
        date_key("order_purchase_timestamp").alias("order_date_key"),
        F.lit(1).alias("quantity"),
        "price", "freight_value", "line_total_value",
        "order_status", "delivery_days", "delivery_seconds", "is_late_delivery",
        "shipping_limit_date", "order_purchase_timestamp", *keys, customer,
    )


def derived_columns(name: str, packed_keys: bool = True):
    """Columns of a Gold table that follow from others next to them: not
    stored but computed by the scan (see ``warehouse``); of the item fact also
    the dimension keys, when they are packed."""
    if name == "fact_orders":
        return {"order_sk": (None, surrogate_key("order_id")), "delivery_days": (None, days("delivery_seconds"))}
    if name != "fact_order_items":
        return None
    own = {"order_item_sk": (None, surrogate_key("order_id", F.col("order_item_id").cast("string"))),
           "line_total_value": (None, line_total()), "delivery_days": (None, days("delivery_seconds"))}
    if not packed_keys:
        return own
    c = F.col("customer_sk")
    keys = {"product_sk": F.when(F.col("product_sk"), surrogate_key("product_id")), "seller_sk": F.when(F.col("seller_sk"), surrogate_key("seller_id")),
            # as operators/scd.py makes it
            "customer_sk": F.when(c.isNotNull(), surrogate_key(c["customer_unique_id"], c["valid_from"].cast("string")))}
    return own | {k: (F.col(k), value) for k, value in keys.items()}


class Gold:
    """Gold tables over one source folder (lazy, or materialized with a store)."""

    def __init__(self, spark: SparkSession, base: str, silver: Silver | None = None, store=None,
                 customer_history: DataFrame | None = None, customer_batches=None):
        """``customer_history`` is the stored customer dimension of the last
        load (none on the first); this load's Silver customers are applied to
        it. ``customer_batches() -> [(customers, effective time), ...]``
        gives other batches, oldest first (the test tables hold two)."""
        self.spark, self.base, self.store = spark, base, store
        self.customer_history = customer_history
        self.customer_batches = customer_batches or (lambda: [(self.silver.customers, self.silver.batch_ts)])
        self.silver = silver or Silver(spark, base, store=store)
        # Keys of an older customer dimension may be made otherwise: they are taken as they are.
        self._packed_keys = store is not None and customer_history is None
        self._t: dict[str, DataFrame] = {}

    # Tables whose files are ordered by a key, so min/max statistics prune
    # scans filtered on it (the date key for facts).
    _SORT = {"fact_orders": ["order_date_key"], "fact_order_items": ["order_date_key"]}

    # The order fact is stored by purchase month: a batch rewrites the months it
    # touches (operators/partitioned.py) and readers of some months list only those.
    _PARTITION = {"fact_orders": "order_month"}

    def _memo(self, name, fn, parts=None):
        """``parts()`` are the slices of a table that is stored slice by slice."""
        if name not in self._t:
            df = fn()
            if self.store is not None:
                df = self.store.persist("gold/" + name, df, self._SORT.get(name), partition_by=self._PARTITION.get(name),
                                        derived=derived_columns(name, self._packed_keys),
                                        parts=parts() if parts is not None else None)
            self._t[name] = df
        return self._t[name]

    def prefetch(self, silver_tables: list[str], parallel: int = 4) -> None:
        """Materialize independent Silver tables concurrently (separate Spark
        jobs from a small thread pool); a no-op for lazy plans."""
        if self.store is None:
            return
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            list(pool.map(lambda n: getattr(self.silver, n), silver_tables))

    SILVER_TABLES = ["orders", "order_items", "payment_details", "payment_summary", "customers", "products",
                     "clickstream"]
    DIMENSIONS = ["dim_date", "dim_products", "dim_geography", "dim_sellers", "dim_customers"]
    FACTS = ["fact_orders", "fact_order_items"]

    def build_all(self, parallel: int = 4) -> None:
        """The load contract: Silver tables (independent, concurrently), then
        the dimensions (concurrently), then the facts."""
        from concurrent.futures import ThreadPoolExecutor
        self.prefetch(self.SILVER_TABLES, parallel)
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            list(pool.map(lambda n: getattr(self, n), self.DIMENSIONS))
        for n in self.FACTS:
            getattr(self, n)

    def register_views(self) -> list[str]:
        """Expose every Gold table as a temp view for ``spark.sql``."""
        names = self.DIMENSIONS + self.FACTS
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)
        return names

    @property
    def fact_orders(self):
        s = self.silver

        def build():
            self.prefetch(["orders", "order_items", "payment_summary", "customers"])
            return fact_orders(s.orders, in_slices(s.order_items, ["order_id"], s.slices), s.payment_summary, s.customers)
        return self._memo("fact_orders", build)

    @property
    def dim_date(self):
        return self._memo("dim_date", lambda: dim_date_covering(self.silver.orders))

    @property
    def dim_products(self):
        return self._memo("dim_products", lambda: dim_products(self.silver.products))

    @property
    def dim_geography(self):
        return self._memo("dim_geography",
                          lambda: dim_geography(silver_geolocation(self.silver.raw("geolocation"))))

    @property
    def dim_sellers(self):
        return self._memo("dim_sellers", lambda: dim_sellers(self.silver.raw("sellers")))

    @property
    def dim_customers(self):
        from emporium.plans.history import apply_customers
        return self._memo("dim_customers", lambda: apply_customers(self.customer_history, self.customer_batches()))

    @property
    def fact_order_items(self):
        s = self.silver

        def build(slices=1, only=None, absent=None, observed=None):
            orders, items = (in_slices(t, ["order_id"], slices, only) for t in (s.orders, s.order_items))
            return fact_order_items(orders, items, self.dim_products, self.dim_sellers, s.customers, self.dim_customers, observed,
                                    self._packed_keys, absent)

        def parts():
            # A large fact is written in slices, and its items meet absent keys instead of products and sellers.
            slices, absent = 1, None
            if is_large(s.order_items):
                slices = s.slices
                absent = self._memo("absent_item_keys", lambda: absent_keys(
                    s.order_items, {"product": self.dim_products, "seller": self.dim_sellers}, slices))
            self.item_misses = [Observation(f"item_misses_{i}") for i in range(slices)]
            return [build(slices, i, absent, seen) for i, seen in enumerate(self.item_misses)]

        if "fact_order_items" not in self._t:
            self.prefetch(["orders", "order_items", "customers", "products"])
        return self._memo("fact_order_items", build, parts)

    def item_key_misses(self) -> DataFrame:
        """What the item fact's joins missed, counted by its load."""
        self.fact_order_items
        seen = [part.get for part in self.item_misses]
        return self.spark.createDataFrame([tuple(sum(int(s[c]) for s in seen) for c in ITEM_MISSES)], ", ".join(f"{c} long" for c in ITEM_MISSES))
