"""One-pass routing of raw rows, and what the item fact's joins miss."""

import datetime as dt

from pyspark.sql import Observation

from emporium.plans import gold as G
from emporium.plans import registry, routing
from emporium.plans import silver as S

SF = "/root/testdata/sf0.001"
TS = "2024-01-01 10:00:00"


def _raws(spark):
    s = "string"
    table = lambda cols, rows: spark.createDataFrame(rows, ", ".join(f"{c} {s}" for c in cols))
    return {
        "orders": table(["order_id", "customer_id", "order_status", *S.ORDER_TS],
                        [("1", "c", " Delivered", TS, TS, TS, TS, TS), ("1", "c", "shipped", TS, None, None, None, None), ("2", "c", "bogus", TS, None, None, None, None),
                         (None, "c", "shipped", TS, None, None, None, None)]),
        "order_items": table(["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
                             [("1", "1", "p", "s", TS, "10", "1"), ("1", "2", None, "s", TS, "10", "1"), ("1", "x", "p", "s", TS, "10", "1"), ("1", "3", "p", "s", TS, "-1", "1")]),
        "payments": table(["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
                          [("1", "1", "boleto", "1", "5"), ("1", "2", "barter", "1", "5"), ("1", "3", "boleto", "1", "n/a"), ("1", "1", "boleto", "1", "7")]),
        "customers": table(["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
                           [("c", "u", "1", "x", "SP"), (None, "u", "1", "x", "SP"), ("c", "u", "1", "x", "SP")]),
        "products": table(["product_id", "product_category_name", "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
                           "product_length_cm", "product_height_cm", "product_width_cm"], [("p", "Bebes ", "1", "1", None, None, "1", "1", "1"), (None,) * 9]),
    }


def test_one_pass_routes_every_row_once(spark, tmp_path):
    raws, path = _raws(spark), str(tmp_path / "routed")
    counted = routing.route(raws, path, "b1")
    assert counted == {"orders": 4, "order_items": 4, "payments": 4, "customers": 3, "products": 2}
    routed = routing.read_routed(spark, path)
    assert sorted((r.entity, r.record_key, r.reject_reason) for r in routing.rejects(routed).collect()) == [
        ("customers", "", "null_customer_id"), ("order_items", "1", "null_order_item_id"), ("order_items", "1/2", "null_product_id"),
        ("order_items", "1/3", "negative_or_invalid_price"), ("orders", "", "null_order_id"), ("orders", "2", "invalid_status"),
        ("payments", "1/2", "invalid_payment_type"), ("payments", "1/3", "negative_or_invalid_value"), ("products", "", "null_product_id")]
    silver = {"orders": S.silver_orders(raws["orders"]), "order_items": S.silver_order_items(raws["order_items"]), "payments": S.payment_details(raws["payments"]),
              "customers": S.silver_customers(raws["customers"]), "products": S.silver_products(raws["products"])}
    rows = {r.entity: r for r in routing.balance(spark, routed, counted, silver).collect()}
    assert len(rows) == 5 and all(r.balanced for r in rows.values())
    assert (rows["orders"].rejected, rows["orders"].duplicates, rows["orders"].silver_rows) == (2, 1, 1)
    # the valid part is enough to build Silver from, types included
    again = routing.valid_rows(spark, path, "orders", raws["orders"])
    assert sorted(map(str, again.collect())) == sorted(map(str, S.typed_orders(raws["orders"]).where("order_id = '1'").collect()))


def test_a_batch_loaded_again_replaces_itself(spark, tmp_path):
    raws, path = _raws(spark), str(tmp_path / "routed")
    routing.route(raws, path, "b1")
    routing.route(raws, path, "b2")
    routing.route({"orders": raws["orders"]}, path, "b1")
    by = {(r.batch, r.entity): r["count"] for r in routing.read_routed(spark, path).groupBy("batch", "entity").count().collect()}
    assert by == {("b1", "orders"): 4, ("b2", "orders"): 4, ("b2", "order_items"): 4, ("b2", "payments"): 4, ("b2", "customers"): 3, ("b2", "products"): 2}


def test_queries_see_rejects_of_all_entities(spark):
    found = {(r.entity, r.reject_reason) for r in registry.QUERIES["routed_rejects"](spark, SF).collect()}
    assert {e for e, _ in found} == set(routing.ENTITIES)
    assert {("payments", "invalid_payment_type"), ("payments", "negative_or_invalid_value")} <= found


def test_item_fact_counts_what_its_joins_miss(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame([("o1", "c1", "X", t, None, None, False), ("o2", "c2", "X", t, None, None, False)],
                                   "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, delivery_days double, delivery_seconds long, is_late_delivery boolean")
    items = spark.createDataFrame([("o1", 1, "p1", "s1"), ("o1", 2, "p9", "s1"), ("o2", 1, "p1", "s9"), ("o9", 1, "p1", "s1")], "order_id string, order_item_id int, product_id string, seller_id string")
    items = items.selectExpr("*", "1.0 price", "1.0 freight_value", "2.0 line_total_value", "timestamp_ntz'2024-01-02' shipping_limit_date")
    people = spark.createDataFrame([("c1", "u1"), ("c2", "u2")], "customer_id string, customer_unique_id string")
    versions = spark.createDataFrame([("u1", "old", dt.datetime(2020, 1, 1), t), ("u1", "new", t, None), ("u2", "late", dt.datetime(2025, 1, 1), None)],
                                     "customer_unique_id string, customer_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    seen = Observation("misses")
    G.fact_order_items(orders, items, spark.createDataFrame([("p1", "P1")], "product_id string, product_sk string"),
                       spark.createDataFrame([("s1", "S1")], "seller_id string, seller_sk string"), people, versions, seen).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    assert sorted((r.order_id, r.order_item_id, r.product_sk, r.seller_sk, r.customer_sk) for r in fact.collect()) == [
        ("o1", 1, "P1", "S1", "new"), ("o1", 2, None, "S1", "new"), ("o2", 1, "P1", None, None)]
    assert seen.get == {"items": 4, "without_order": 1, "without_product": 1, "without_seller": 1, "without_customer": 1}
