"""What is exchanged by marts over the item fact and by the hash audit."""

from decimal import Decimal

from emporium.plans import marts, registry

SF = "/root/testdata/sf0.001"


def test_revenue_by_category_joins_product_totals(spark):
    items = spark.createDataFrame([("p1", Decimal("1.50"))] * 3 + [("p2", None), ("p3", Decimal("9.00")), (None, Decimal("5.00")), ("p9", Decimal("2.00"))],
                                  "product_id string, price decimal(18,2)")
    products = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", "a"), ("p3", "c"), (None, "d")], "product_id string, category string")
    out = marts.revenue_by_category(items, products)
    assert {(r.category, r.revenue, r["items"]) for r in out.collect()} == {("a", Decimal("13.50"), 4), ("b", None, 1), ("c", Decimal("9.00"), 1)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Aggregate [product_id")


def test_hash_audit_exchanges_hashes_as_bytes_before_grouping(spark):
    df = registry.QUERIES["audit_hash"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "partial_count(distinct" not in plan
    rows = {r.source_system: r for r in df.collect()}
    assert len(rows) == 5 and all(r.row_count == r.distinct_hashes and len(r.min_hash) == 64 and r.min_hash < r.max_hash for r in rows.values())
