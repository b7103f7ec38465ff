"""Bronze -> Silver rules on literal fixtures (one per semantics-ledger row)."""

from decimal import Decimal

from pyspark.sql import functions as F

from emporium.plans import silver as S

ORDER_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
              "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]


def _orders(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ORDER_COLS))


def test_orders_validate_then_dedup(spark):
    rows = [
        (None, "c1", "delivered", "2018-01-01 10:00:00", None, None, None, None),           # null id
        (" o1 ", "c1", "bogus", "2018-01-01 10:00:00", None, None, None, None),            # invalid copy
        ("o1", "c1", " Delivered ", "2018-01-02 10:00:00", None, None,
         "2018-01-05 10:00:00", "2018-01-04 10:00:00"),                                      # valid copy, late
        ("o2", "c2", "shipped", "not a timestamp", None, None, None, "2018-01-10 00:00:00"),  # bad ts
        ("o3", "c3", "processing", "2018-01-03 00:00:00", None, None, None, "2018-01-10 00:00:00"),
        ("o4", "c4", "unknown", "2018-01-03 00:00:00", None, None, None, None),              # invalid status
    ]
    out = {r.order_id: r for r in S.silver_orders(_orders(spark, rows)).collect()}
    assert set(out) == {"o1", "o2", "o3"}
    o1 = out["o1"]
    assert o1.order_status == "DELIVERED"          # the invalid copy did not evict the valid one
    assert o1.delivery_seconds == 3 * 86400 and abs(o1.delivery_days - 3.0) < 1e-12
    assert o1.is_late_delivery is True
    assert out["o2"].order_purchase_timestamp is None and out["o2"].delivery_days is None
    assert out["o3"].is_late_delivery is False     # not delivered -> not late
    rejects = {r.order_id: r.reject_reason for r in S.order_rejects(_orders(spark, rows)).collect()}
    assert rejects == {None: "null_order_id", "o1": "invalid_status", "o4": "invalid_status"}


def test_customer_cleaning(spark):
    rows = [(" c1 ", "u1", "01001", "são paulo", "sp"), ("c2", "u1", "02002", "rio 123 de janeiro!", "RJX")]
    df = spark.createDataFrame(rows, "customer_id string, customer_unique_id string, "
                                     "customer_zip_code_prefix string, customer_city string, customer_state string")
    out = {r.customer_id: r for r in S.silver_customers(df).collect()}
    assert out["c1"].customer_city == "So Paulo"    # source rule strips accented letters
    assert out["c1"].customer_state == "sp"         # not upper-cased
    assert out["c2"].customer_city == "Rio  De Janeiro"
    assert out["c2"].customer_state == "RJ"
    folded = {r.customer_id: r for r in S.silver_customers(df, fold_accents=True).collect()}
    assert folded["c1"].customer_city == "Sao Paulo"


def test_products_defaults_and_sizes(spark):
    from emporium.plans.gold import dim_products
    rows = [("p1", "beleza_saude", "499"), ("p2", "UNKNOWN_CAT", "500"), ("p3", None, None),
            ("p4", "pcs", "1999"), ("p5", "pcs", "2000"), ("p6", "pcs", "9999"), ("p7", "pcs", "10000"),
            ("p8", "pcs", "abc"), (None, "pcs", "1")]
    df = spark.createDataFrame(rows, "product_id string, product_category_name string, product_weight_g string")
    for c in ["product_name_lenght", "product_description_lenght", "product_photos_qty",
              "product_length_cm", "product_height_cm", "product_width_cm"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    sp = S.silver_products(df)
    out = {r.product_id: r for r in dim_products(sp).collect()}
    assert len(out) == 8
    assert out["p1"].category == "health_beauty" and out["p2"].category == "unknown_cat"
    assert out["p3"].category is None and out["p3"].product_weight_g == 0.0 and out["p3"].weight_missing
    sizes = {k: out[k].size_category for k in ["p1", "p2", "p4", "p5", "p6", "p7", "p8"]}
    assert sizes == {"p1": "Small", "p2": "Medium", "p4": "Medium", "p5": "Large", "p6": "Large",
                     "p7": "Extra Large", "p8": "Small"}
    assert out["p1"].product_photos_qty == 0


def test_payments_detail_and_summary(spark):
    rows = [("o1", "1", "credit_card", "3", "100.00"), ("o1", "2", "voucher", "1", "20.50"),
            ("o1", "3", "credit_card", "1", "30.00"), ("o1", "3", "credit_card", "1", "30.00"),
            ("o2", "1", "boleto", "1", "-5.00"), ("o3", "1", "crypto", "1", "10.00"),
            ("o4", "1", "debit_card", "2", "abc"), (None, "1", "boleto", "1", "1.00")]
    df = spark.createDataFrame(rows, "order_id string, payment_sequential string, payment_type string, "
                                     "payment_installments string, payment_value string")
    det = S.payment_details(df)
    assert det.count() == 3                      # o1 x3 (duplicate key collapsed); others rejected
    summ = {r.order_id: r for r in S.payment_summary(det).collect()}
    o1 = summ["o1"]
    assert o1.total_payment_value == Decimal("150.50") and o1.payment_count == 3 and o1.max_installments == 3
    assert o1.credit_card_amount == Decimal("100.00")   # the largest single payment, not the sum
    assert o1.voucher_amount == Decimal("20.50") and o1.boleto_amount is None
    assert o1.primary_payment_type == "CREDIT_CARD"


def test_order_items_bounds(spark):
    rows = [("o1", "1", "p", "s", "2018-01-01 00:00:00", "0", "0"),
            ("o1", "2", "p", "s", "2018-01-01 00:00:00", "99999.99", "1.00"),
            ("o1", "3", "p", "s", "2018-01-01 00:00:00", "100000", "1.00"),
            ("o1", "4", "p", "s", "2018-01-01 00:00:00", "10.00", "-1.00"),
            ("o1", "1", "q", "s", "2018-01-01 00:00:00", "5.00", "1.00"),
            ("o2", None, "p", "s", "2018-01-01 00:00:00", "5.00", "1.00")]
    df = spark.createDataFrame(rows, "order_id string, order_item_id string, product_id string, seller_id string, "
                                     "shipping_limit_date string, price string, freight_value string")
    out = {(r.order_id, r.order_item_id): r for r in S.silver_order_items(df).collect()}
    assert set(out) == {("o1", 1), ("o1", 2)}
    assert out[("o1", 1)].product_id == "p"        # total order: smallest product id kept
    assert out[("o1", 2)].line_total_value == Decimal("100000.99")
    reasons = sorted(r.reject_reason for r in S.item_rejects(df).collect())
    assert reasons == ["negative_or_invalid_freight", "null_order_item_id", "price_over_limit"]


def test_row_hash_is_null_safe(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "")], "x string, y string")
    from emporium.functions.hashing import row_hash
    hashes = [r.h for r in df.select(row_hash(df, ["x", "y"]).alias("h")).collect()]
    assert len(set(hashes)) == 3


def test_keep_first_is_deterministic(spark):
    from emporium.operators.dedup import keep_first
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "z"), ("k", 1, "a"), ("j", None, "b")],
                               "k string, n int, v string")
    out = {r.k: (r.n, r.v) for r in keep_first(df.repartition(3), ["k"], ["n"]).collect()}
    assert out == {"k": (1, "a"), "j": (None, "b")}
