"""Tables are stored without the columns their scans can compute."""

import datetime as dt

from pyspark.sql import functions as F

from emporium.operators.slices import SLICES, in_slices
from emporium.plans import gold as G
from emporium.plans.gold import Gold
from emporium.plans.registry import lakehouse
from emporium.plans.silver import Silver
from emporium.sources.warehouse import Warehouse, from_stored, to_stored

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_hashes_are_computed_by_scans(spark):
    g = lakehouse(spark, SF)
    lazy = Silver(spark, SF)
    for name in ("orders", "order_items", "payment_details", "customers", "products"):
        stored = getattr(g.silver, name)
        assert stored.schema.names == getattr(lazy, name).schema.names
        assert _rows(stored) == _rows(getattr(lazy, name))
        assert "record_hash" not in spark.read.parquet(g.store.path(f"silver/{name}")).columns
    assert "line_total_value" not in spark.read.parquet(g.store.path("silver/order_items")).columns


def test_facts_have_the_same_keys_as_unstored_ones(spark):
    g = lakehouse(spark, SF)
    lazy = Gold(spark, SF, customer_batches=g.customer_batches)
    assert _rows(g.fact_orders) == _rows(lazy.fact_orders)
    assert _rows(g.fact_order_items) == _rows(lazy.fact_order_items.select(g.fact_order_items.columns))
    assert "order_sk" not in spark.read.parquet(g.store.path("gold/fact_orders")).columns
    kept = dict(spark.read.parquet(g.store.path("gold/fact_order_items")).dtypes)
    assert "order_item_sk" not in kept and kept["product_sk"] == kept["seller_sk"] == "boolean"


def _tables(spark):
    t = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame([("o1", "c1", "X", t, 1.0, 86400, False), ("o2", "c2", "X", t, None, None, False), ("o3", None, "X", None, None, None, False)],
                                   "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, delivery_days double, delivery_seconds long, is_late_delivery boolean")
    items = spark.createDataFrame([("o1", 1, "p1", "s1"), ("o1", 2, "p9", None), ("o2", 1, "p1", "s9"), ("o3", 1, "p1", "s1"), ("o9", 1, "p1", "s1"), (None, 1, "p1", "s1")],
                                  "order_id string, order_item_id int, product_id string, seller_id string")
    items = items.selectExpr("*", "CAST(1 AS DECIMAL(18,2)) price", "CAST(NULL AS DECIMAL(18,2)) freight_value", "CAST(NULL AS DECIMAL(18,2)) line_total_value",
                             "timestamp_ntz'2024-01-02' shipping_limit_date")
    people = spark.createDataFrame([("c1", "u1"), ("c2", "u2"), (None, "u3")], "customer_id string, customer_unique_id string")
    versions = spark.createDataFrame([("u1", dt.datetime(2020, 1, 1), t), ("u1", t, None), ("u2", dt.datetime(2025, 1, 1), None)],
                                     "customer_unique_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    versions = versions.withColumn("customer_sk", G.surrogate_key("customer_unique_id", F.col("valid_from").cast("string")))
    products = spark.createDataFrame([("p1",), (None,)], "product_id string").withColumn("product_sk", G.surrogate_key("product_id"))
    sellers = spark.createDataFrame([("s1",), (None,)], "seller_id string").withColumn("seller_sk", G.surrogate_key("seller_id"))
    return orders, items, products, sellers, people, versions


def test_packed_keys_are_the_dimensions_keys(spark):
    tables = _tables(spark)
    plain = G.fact_order_items(*tables)
    packed = G.fact_order_items(*tables, packed_keys=True)
    derived = G.derived_columns("fact_order_items")
    again = from_stored(to_stored(packed, derived), packed.columns, derived)
    assert again.schema.names == plain.schema.names and _rows(again) == _rows(plain)
    assert [r.n for r in plain.selectExpr("count(customer_sk) n").collect()] == [2] and plain.count() == 4


def test_items_are_not_exchanged_by_customer(spark):
    """With nothing broadcast, the customer and their version are looked up by order."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = G.fact_order_items(*_tables(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("hashpartitioning(order_id") == 2     # the items once, the orders once
    items_side = plan[:plan.rindex("hashpartitioning(order_id")]
    assert "hashpartitioning(customer" not in items_side


def test_order_fact_meets_customers_before_items(spark):
    plan = Gold(spark, SF).fact_orders._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("Join LeftOuter, (")[1].split("#")[0] for line in plan.splitlines() if "Join LeftOuter" in line]
    assert keys[:3] == ["order_id", "order_id", "customer_id"]      # the outermost first


def test_a_given_customer_history_keeps_its_keys(spark, tmp_path):
    """Keys of a stored dimension are taken as they are, however they were made."""
    base = lakehouse(spark, SF)
    old = base.dim_customers.withColumn("customer_sk", F.concat(F.lit("k"), "customer_sk"))
    g = Gold(spark, SF, store=Warehouse(spark, str(tmp_path)), customer_history=old, customer_batches=lambda: [])
    got = {r[0] for r in g.fact_order_items.where("customer_sk is not null").selectExpr("substring(customer_sk, 1, 1)").distinct().collect()}
    assert got == {"k"}


def test_rows_of_a_key_are_in_one_slice(spark):
    rows = [(k, v) for k in (None, "a", "b", "c", "d", "e") for v in range(5)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    cut = in_slices(df, ["k"], 4)
    assert sorted(map(str, cut.collect())) == sorted(map(str, df.collect()))
    assert in_slices(df, ["k"], 1) is df
    held = cut.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.min("p").alias("lo"), F.max("p").alias("hi")).collect()
    assert all(r.hi - r.lo < 3 for r in held)   # the partitions of one scan


def test_stored_tables_are_aggregated_in_slices(spark, tmp_path, monkeypatch):
    """A task's partial aggregate holds a slice of its split (F5-F7): each large table is scanned once per slice."""
    plans = {}
    real = Warehouse.persist

    def persist(self, name, df, *args, **kw):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(self, name, df, *args, **kw)
    monkeypatch.setattr(Warehouse, "persist", persist)
    Gold(spark, SF, store=Warehouse(spark, str(tmp_path))).fact_orders
    for name in ("silver/orders", "silver/order_items", "silver/payment_details", "silver/payment_summary", "gold/fact_orders"):
        assert plans[name].count("xxhash64") >= SLICES, name
    lazy = Silver(spark, SF).payment_summary._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in lazy
