"""History-keeping plans: customer SCD2 dimension, order upserts, snapshots.

Scenario (all from the shared tables):
* customers: batch 1 loaded at ``INITIAL_TS``; batch 2 (new arrivals and
  relocations) applied at ``CHANGE_TS``;
* orders: batch 1 (purchases before 2000) is the target; batch 2 (from 1999
  on, with shipped orders since delivered) is upserted into it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.functions.dates import month_key
from emporium.functions.hashing import row_hash
from emporium.operators import partitioned, scd, schema_registry, upsert, versioning
from emporium.operators.dedup import keep_first
from emporium.plans.silver import Silver, silver_customers, silver_orders
from emporium.session import run_folder
from emporium.sources.bronze import bronze

INITIAL_TS = _dt.datetime(1990, 1, 1)
CHANGE_TS = _dt.datetime(1998, 1, 1)
OPEN_END = _dt.datetime(9999, 12, 31)
BATCH2_TS = _dt.datetime(2024, 2, 1)

CUSTOMER_ATTRS = ["customer_city", "customer_state", "customer_zip_code_prefix"]


# Attributes whose change opens a new version; the far-future variant (M9)
# tracks city and state only.
OPEN_END_ATTRS = ["customer_city", "customer_state"]


def customer_incoming(customers: DataFrame, tracked: list[str] | None = None) -> DataFrame:
    """One row per person (customer_unique_id) with a hash of the tracked attributes."""
    people = keep_first(
        customers.select("customer_unique_id", "customer_id", *CUSTOMER_ATTRS),
        ["customer_unique_id"], ["customer_id"])
    return people.withColumn("record_hash", row_hash(people, tracked or CUSTOMER_ATTRS))


def apply_customers(history: DataFrame | None, batches: list[tuple[DataFrame, object]], tracked: list[str] | None = None,
                    open_end=None) -> DataFrame:
    """The customer dimension after batches of Silver customers, oldest first,
    on top of its stored history (None before the first load)."""
    for customers, at in batches:
        incoming = customer_incoming(customers, tracked)
        if history is None:
            history = scd.scd2_initial(incoming, "customer_unique_id", at, sk="customer_sk", open_end=open_end)
        else:
            history = scd.scd2_apply(history, incoming, "customer_unique_id", "record_hash", at, sk="customer_sk", open_end=open_end)
    return history


def scenario_batches(spark: SparkSession, sf: str) -> list[tuple[DataFrame, object]]:
    """The two customer batches of the test tables."""
    return [(silver_customers(bronze(spark, sf, "customers_batch1")), INITIAL_TS),
            (silver_customers(bronze(spark, sf, "customers_batch2")), CHANGE_TS)]


def customers_batch(spark: SparkSession, sf: str, n: int, tracked: list[str] | None = None) -> DataFrame:
    entity = "customers_batch1" if n == 1 else "customers_batch2"
    return customer_incoming(silver_customers(bronze(spark, sf, entity)), tracked)


def dim_customers_initial(spark, sf, open_end=None, tracked=None) -> DataFrame:
    return scd.scd2_initial(customers_batch(spark, sf, 1, tracked), "customer_unique_id", INITIAL_TS,
                            sk="customer_sk", open_end=open_end)


def dim_customers(spark, sf, open_end=None, tracked=None) -> DataFrame:
    """Batch 1 then batch 2, as one plan."""
    return apply_customers(None, scenario_batches(spark, sf), tracked, open_end)


def customer_changes(spark, sf) -> DataFrame:
    """Per person, what applying batch 2 to the initial dimension does."""
    hist = dim_customers_initial(spark, sf)
    return scd.scd2_changes(hist, customers_batch(spark, sf, 2), "customer_unique_id", "record_hash")


def orders_asof_customer(spark, sf, gold=None) -> DataFrame:
    """Each order with the customer's address valid at purchase time."""
    s = gold.silver if gold is not None else Silver(spark, sf)
    facts = s.orders.join(s.customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
    facts = facts.select("order_id", "customer_unique_id", "order_purchase_timestamp")
    dim = gold.dim_customers if gold is not None else dim_customers(spark, sf)
    versions = dim.select(
        "customer_unique_id", "customer_sk", "customer_city", "customer_state", "valid_from", "valid_to")
    j = scd.asof_lookup(facts, versions, "customer_unique_id", "order_purchase_timestamp")
    return j.select("order_id", "customer_unique_id", "order_purchase_timestamp",
                    "customer_sk", "customer_city", "customer_state")


def customer_type3(spark, sf, gold=None) -> DataFrame:
    dim = gold.dim_customers if gold is not None else dim_customers(spark, sf)
    return scd.scd3_previous(dim, "customer_unique_id", ["customer_city"])


def orders_batches(spark, sf, silver=None) -> tuple[DataFrame, DataFrame]:
    if silver is not None:
        # Materialized: the two independent loads are built as concurrent jobs.
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=2) as pool:
            t, s = pool.map(silver.orders_batch, [1, 2])
        return t, s
    target = silver_orders(bronze(spark, sf, "orders_batch1"))
    source = silver_orders(bronze(spark, sf, "orders_batch2"), batch_ts=BATCH2_TS)
    return target, source


def upsert_orders(spark, sf, silver=None) -> DataFrame:
    t, s = orders_batches(spark, sf, silver)
    return upsert.upsert(t, s, ["order_id"])


def upsert_changeset(spark, sf, silver=None) -> DataFrame:
    t, s = orders_batches(spark, sf, silver)
    return upsert.change_set(t, s, ["order_id"])


def orders_change_log(spark, sf, silver=None) -> DataFrame:
    """Version 1 = batch 1; version 2 = the rows batch 2 inserted or changed."""
    t, s = orders_batches(spark, sf, silver)
    changed = upsert.change_set(t, s, ["order_id"]).filter(F.col("change_type").isin("insert", "update"))
    v2 = upsert.clean_source(s, ["order_id"]).join(changed.select("order_id"), "order_id", "left_semi")
    return versioning.tag(t, 1).unionByName(versioning.tag(v2, 2))


def snapshot_as_of(spark, sf, silver=None) -> DataFrame:
    """Both versions of the order table, read back from the change log."""
    log = orders_change_log(spark, sf, silver)
    v1 = versioning.snapshot(log, ["order_id"], 1).withColumn("snapshot_version", F.lit(1))
    v2 = versioning.snapshot(log, ["order_id"], 2).withColumn("snapshot_version", F.lit(2))
    return v1.unionByName(v2).select("snapshot_version", "order_id", "order_status",
                                     "order_delivered_customer_date", "record_hash")


def versioned_orders_table(spark, sf, silver=None) -> DataFrame:
    """M1 / M6: a stored order table, created from batch 1 and upserted with batch 2."""
    t, s = orders_batches(spark, sf, silver)
    path = run_folder(spark, "orders-table")
    versioning.upsert_version(spark, path, t, ["order_id"], 1, "create", INITIAL_TS)
    versioning.upsert_version(spark, path, s, ["order_id"], 2, "upsert", BATCH2_TS)
    return versioning.read_log(spark, path)


def versioned_orders(spark, sf, silver=None) -> DataFrame:
    """The stored table by version and by time: version 1, as of the second
    load, and the newest."""
    log = versioned_orders_table(spark, sf, silver)
    cols = ["order_id", "order_status", "order_delivered_customer_date", "record_hash"]
    reads = {"version 1": 1, "as of batch 2": versioning.version_at(log, BATCH2_TS), "newest": None}
    out = None
    for name, version in reads.items():
        part = versioning.snapshot(log, ["order_id"], version).select(F.lit(name).alias("read"), *cols)
        out = part if out is None else out.unionByName(part)
    return out


def version_history(spark, sf, silver=None) -> DataFrame:
    return versioning.history(versioned_orders_table(spark, sf, silver)).select("version", "operation", "rows")


def upsert_by_month(spark, sf, silver=None) -> DataFrame:
    """The orders stored by purchase month from batch 1, then
    batch 2 upserted into the months it changes."""
    t, s = (df.withColumn("order_month", month_key("order_purchase_timestamp")) for df in orders_batches(spark, sf, silver))
    path = run_folder(spark, "orders-by-month")
    partitioned.write_partitions(t, path, "order_month", ["order_id"])
    partitioned.upsert_partitions(spark, path, s, ["order_id"], "order_month", ["order_id"])
    return partitioned.read_partitions(spark, path, t)


def schema_evolution(spark, sf, silver=None) -> DataFrame:
    """Additive evolution: an older, narrower batch unioned with a wider one."""
    t, s = orders_batches(spark, sf, silver)
    old = t.drop("delivery_seconds", "delivery_days", "is_late_delivery")
    return old.unionByName(s, allowMissingColumns=True).select(
        "order_id", "order_status", "source_system", "ingestion_timestamp", "delivery_seconds",
        "is_late_delivery")


def schema_loads(spark, sf, silver=None) -> DataFrame:
    """M7: five loads of orders against the schema registry: a narrow batch,
    a wider one, one without a column, one with a changed type, and the wider
    one again under its number. One row per batch: what became of it, and its
    rows in the table as read at the end."""
    t, s = orders_batches(spark, sf, silver)
    narrow = t.drop("delivery_seconds", "delivery_days", "is_late_delivery")
    loads = [(1, narrow), (2, s), (3, t.drop("order_status")), (4, s.withColumn("delivery_days", F.col("delivery_days").cast("string"))), (2, s)]
    folder = run_folder(spark, "orders-by-schema")
    registry, table = f"{folder}/registry", f"{folder}/table"
    done = [schema_registry.load(spark, registry, table, batch, n) for n, batch in loads]
    outcomes = spark.createDataFrame([(i + 1, *vars(o).values()) for i, o in enumerate(done)],
                                     "load int, batch int, accepted boolean, schema_version int, added string, offending string")
    held = (schema_registry.read(spark, registry, table).groupBy(F.col("_batch").alias("batch"))
            .agg(F.count(F.lit(1)).alias("rows_held"), F.count("is_late_delivery").alias("rows_with_new_columns")))
    return (outcomes.join(held, "batch", "left")
            .select("load", "batch", "accepted", "schema_version", "added", "offending",
                    F.coalesce("rows_held", F.lit(0)).alias("rows_held"), F.coalesce("rows_with_new_columns", F.lit(0)).alias("rows_with_new_columns")))


def enforce(df: DataFrame, schema) -> DataFrame:
    """Schema enforcement: exact column set and types, else raise."""
    want = {f.name: f.dataType for f in schema.fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    wrong = [c for c in want if c in have and have[c] != want[c]]
    if missing or extra or wrong:
        raise ValueError(f"schema mismatch: missing={missing} extra={extra} type={wrong}")
    return df.select(*want)
