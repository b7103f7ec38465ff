"""Large tables are stored part by part, and what a part exchanged goes from disk with it (FINDINGS_r04, F1)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from emporium.operators import slices
from emporium.operators.dedup import keep_first
from emporium.operators.slices import SLICES, in_slices
from emporium.plans import gold as G
from emporium.plans.gold import Gold
from emporium.plans.silver import Silver
from emporium.session import _CLEANUP_KEY, exchanged_files_freed
from emporium.sources.bronze import entity_columns
from emporium.sources.warehouse import Warehouse


SF_SMALL = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.collect()))


def _exchanged(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {os.path.basename(files.apply(i).getPath()) for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


def _raw(spark):
    """Orders, items (twice, and refused ones), products, sellers and customers, with ids that lead nowhere and nulls."""
    at = "2024-05-01 00:00:00"
    rows = {
        "orders": [(f"o{i}", f"c{i % 4}" if i % 5 else None, "delivered", at, at, at, at, at) for i in range(9)] + [("o1", "c9", "bogus", at, at, at, at, at)],
        "order_items": [(f"o{i}", str(n), f"p{(i + n) % 4}", f"s{n}" if n else None, at, "10.00", "1.50") for i in range(12) for n in range(3)] * 2
        + [("o1", "7", "p1", "s1", at, "-1", "1"), ("o1", "0", "a", "a", at, "x", "1"), (None, "1", "p1", "s1", at, "1", "1"), ("o2", "9", "p1", "s1", at, "1", None)],
        "products": [(f"p{i}", "c", "1", "1", "1", "1", "1", "1", "1") for i in range(3)] * 2 + [(None, "c", "1", "1", "1", "1", "1", "1", "1")],
        "sellers": [("s1", "1", "x", "SP"), ("s1", "2", "y", "SP"), (None, "1", "x", "SP")],
        "customers": [(f"c{i}", f"u{i % 2}" if i != 2 else None, "1", "x", "SP") for i in range(3)] * 2,
    }
    return {e: spark.createDataFrame(r, ", ".join(f"{c} string" for c in entity_columns(e))) for e, r in rows.items()}


@pytest.fixture
def golds(spark, tmp_path, monkeypatch):
    """Gold tables of which none is too small to be stored in slices."""
    monkeypatch.setattr(slices, "PART_BYTES", 0)
    raw, n = _raw(spark), iter(range(99))

    def make(stored=True, **kw):
        store = Warehouse(spark, str(tmp_path / str(next(n)))) if stored else None
        silver = Silver(spark, "", store=store, raw_reader=raw.__getitem__)
        batches = lambda: [(silver.customers, dt.datetime(2020, 1, 1))]
        return Gold(spark, "", silver=silver, store=store, **{"customer_batches": batches, **kw})
    return make


def test_a_fact_in_parts_is_the_fact(golds):
    lazy, g = golds(stored=False), golds()
    want = _rows(lazy.fact_order_items)
    assert _rows(g.fact_order_items.select(lazy.fact_order_items.columns)) == want and len(want) == 9 * 3
    assert _rows(g.silver.order_items) == _rows(lazy.silver.order_items) and _rows(g.silver.orders) == _rows(lazy.silver.orders)
    assert g.store.metrics["gold/fact_order_items"] == len(want)
    seen = g.item_key_misses().collect()[0].asDict()
    f = lazy.fact_order_items
    assert seen == {"items": lazy.silver.order_items.count(), "without_order": lazy.silver.order_items.count() - len(want),
                    **{f"without_{d}": f.where(f"{d}_sk is null").count() for d in ("product", "seller", "customer")}}
    assert all(seen.values())


def test_keys_of_a_given_history_in_parts(golds):
    lazy = golds(stored=False)
    g = golds(customer_history=lazy.dim_customers.withColumn("customer_sk", F.concat(F.lit("k"), "customer_sk")), customer_batches=lambda: [])
    want = lazy.fact_order_items.withColumn("customer_sk", F.concat(F.lit("k"), "customer_sk"))
    assert _rows(g.fact_order_items.select(want.columns)) == _rows(want)


def test_what_tables_exchange_goes_from_disk(golds, spark):
    before, setting = _exchanged(spark), spark.conf.get(_CLEANUP_KEY, "false")
    golds().fact_order_items
    assert not _exchanged(spark) - before
    assert spark.conf.get(_CLEANUP_KEY, "false") == setting


def test_overlapping_writes_restore_the_setting_last(spark):
    setting = spark.conf.get(_CLEANUP_KEY, "false")
    first, second = exchanged_files_freed(spark), exchanged_files_freed(spark)
    first.__enter__(), second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(_CLEANUP_KEY) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(_CLEANUP_KEY) == setting


def test_large_tables_are_written_in_slices(golds, monkeypatch):
    parts = {}
    real = Warehouse.persist

    def persist(self, name, df, *args, **kw):
        parts[name] = kw.get("parts")
        return real(self, name, df, *args, **kw)
    monkeypatch.setattr(Warehouse, "persist", persist)
    golds().fact_order_items
    for name in ("silver/orders", "silver/order_items", "gold/fact_order_items"):
        assert len(parts[name]) == SLICES, name
        held = [{r[0] for r in p.select("order_id").distinct().collect()} for p in parts[name]]
        if name != "silver/order_items":        # its slices are of order and line
            assert sum(map(len, held)) == len(set().union(*held)) > 1, name


def test_small_tables_are_written_whole(spark, tmp_path, monkeypatch):
    parts = {}
    real = Warehouse.persist

    def persist(self, name, df, *args, **kw):
        parts[name] = len(kw.get("parts") or [df])
        return real(self, name, df, *args, **kw)
    monkeypatch.setattr(Warehouse, "persist", persist)
    Gold(spark, SF_SMALL, store=Warehouse(spark, str(tmp_path))).fact_order_items
    assert set(parts.values()) == {1} and "gold/absent_item_keys" not in parts


def test_one_slice_alone(spark):
    df = spark.createDataFrame([(k,) for k in (None, "a", "b", "c", "d", "e")] * 2, "k string")
    assert sorted(r for i in range(3) for r in _rows(in_slices(df, ["k"], 3, i))) == _rows(df)
    assert in_slices(df, ["k"], 1, 0) is df


def test_items_are_exchanged_by_order_alone(spark, tmp_path):
    """Products too many to broadcast: items don't travel to them, nor to sellers."""
    items = spark.range(4000).selectExpr("concat('o', id) order_id", "1 order_item_id", "concat('p', id) product_id", "concat('s', id) seller_id", "CAST(1 AS DECIMAL(18,2)) price",
                                         "CAST(1 AS DECIMAL(18,2)) freight_value", "CAST(2 AS DECIMAL(18,2)) line_total_value", "timestamp_ntz'2024-01-02' shipping_limit_date")
    t = "timestamp_ntz'2024-01-01'"
    orders = spark.range(4000).selectExpr("concat('o', id) order_id", "concat('c', id) customer_id", "'X' order_status", f"{t} order_purchase_timestamp", "1d delivery_days", "1L delivery_seconds", "false is_late_delivery")
    people = spark.range(4000).selectExpr("concat('c', id) customer_id", "concat('u', id) customer_unique_id")
    versions = people.selectExpr("customer_unique_id", f"{t} valid_from", "CAST(NULL AS TIMESTAMP_NTZ) valid_to", "'k' customer_sk")
    dims = {d: spark.range(1, 4000).select(F.concat(F.lit(d[0]), "id").alias(f"{d}_id")).withColumn(f"{d}_sk", G.surrogate_key(f"{d}_id")) for d in ("product", "seller")}
    for name, dim in dims.items():
        dim.write.parquet(str(tmp_path / name))
        dims[name] = spark.read.parquet(str(tmp_path / name))
    G.absent_keys(items, dims, SLICES).write.parquet(str(tmp_path / "absent"))
    absent = spark.read.parquet(str(tmp_path / "absent"))
    assert sorted(map(tuple, absent.collect())) == [("product", "p0"), ("seller", "s0")]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        tables = orders, items, dims["product"], dims["seller"], people, versions
        far = G.fact_order_items(*tables)._jdf.queryExecution().executedPlan().toString()
        fact = G.fact_order_items(*tables, absent=absent)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        got, want = _rows(fact), _rows(G.fact_order_items(*tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(product_id" in far and got == want
    assert "hashpartitioning(product_id" not in plan and "hashpartitioning(seller_id" not in plan
    assert plan.count("hashpartitioning(customer_id") == 1      # the orders


def test_rejected_copies_are_not_exchanged(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("b", "x"), ("c", None), (None, "2"), ("d", "4"), ("d", "3")], "k string, v string")
    typed = df.select("k", F.col("v").try_cast("int").alias("n"))
    out = keep_first(typed, ["k"], ["n"], rejected=F.col("n") < 0)      # null: rejected
    assert _rows(out) == _rows(spark.createDataFrame([("a", 1), (None, 2), ("d", 3)], "k string, n int"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [k") < plan.index("Generate explode") and plan.count("cast(v") == 1
