"""Bronze adapters: the shared test tables shaped as the raw retail entities.

Bronze is schema-on-read: every column is text, exactly as a CSV landing
would give it. Each entity is declared once as a list of ``(column, SQL
expression)`` pairs over the source tables, and rendered either for Spark
(``selectExpr``) or for the DuckDB oracle, so both engines start from the
same raw rows. The expressions deliberately inject the defects Silver has
to handle: mixed-case padded statuses, an unknown status, duplicate order
lines, prices above the sanity bound, missing weights, two customer ids per
person.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.sources.tables import Tables

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"


def _money_text(expr: str) -> str:
    return f"CAST(CAST(round({expr}, 2) AS DECIMAL(18,2)) AS STRING)"


#: States of all five listed regions, and the region's initials (unlisted) for the other nations.
_STATE = ("CASE n_nationkey % 7 WHEN 0 THEN 'SP' WHEN 1 THEN 'RS' WHEN 2 THEN 'BA' WHEN 3 THEN 'AM' WHEN 4 THEN 'GO' "
          "ELSE substr(r_name, 1, 2) END")


def _spec(dialect: str) -> dict[str, dict]:
    idiv = "div" if dialect == "spark" else "//"
    if dialect == "spark":
        delivered = ("timestampadd(HOUR, (o_orderkey % 30 + 1) * 24 + o_orderkey % 24, o_orderdate)")
    else:
        delivered = "(o_orderdate + to_hours(CAST((o_orderkey % 30 + 1) * 24 + o_orderkey % 24 AS BIGINT)))"
    return {
        "orders": {
            "from": "orders",
            "cols": [
                ("order_id", "CAST(o_orderkey AS STRING)"),
                ("customer_id", "CAST(o_custkey AS STRING)"),
                ("order_status",
                 "CASE WHEN o_orderkey % 97 = 0 THEN 'bogus' "
                 "WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN ' canceled' "
                 "WHEN o_orderstatus = 'F' THEN 'delivered ' "
                 "WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'processing' END"),
                ("order_purchase_timestamp", "CAST(o_orderdate AS STRING)"),
                ("order_approved_at", "CAST(o_orderdate + INTERVAL 1 DAY AS STRING)"),
                ("order_delivered_carrier_date", "CAST(o_orderdate + INTERVAL 2 DAY AS STRING)"),
                ("order_delivered_customer_date",
                 f"CASE WHEN o_orderstatus = 'F' THEN CAST({delivered} AS STRING) END"),
                ("order_estimated_delivery_date", "CAST(o_orderdate + INTERVAL 20 DAY AS STRING)"),
            ],
        },
        "order_items": {
            "from": "lineitem",
            "cols": [
                ("order_id", "CAST(l_orderkey AS STRING)"),
                ("order_item_id", "CAST(l_linenumber AS STRING)"),
                ("product_id", "CAST(l_partkey AS STRING)"),
                ("seller_id", "CAST(l_suppkey AS STRING)"),
                ("shipping_limit_date", "CAST(l_shipdate AS STRING)"),
                ("price", f"CAST({_PRICE} AS STRING)"),
                ("freight_value", _money_text(f"{_PRICE} * CAST(l_tax AS DECIMAL(4,2))")),
            ],
        },
        "payments": {
            "from": "lineitem",
            "cols": [
                ("order_id", "CAST(l_orderkey AS STRING)"),
                ("payment_sequential", "CAST(l_linenumber AS STRING)"),
                ("payment_type",
                 "CASE WHEN l_returnflag = 'R' THEN 'credit_card' "
                 "WHEN l_returnflag = 'A' THEN 'boleto' "
                 "WHEN l_linestatus = 'F' THEN 'voucher' ELSE 'debit_card' END"),
                ("payment_installments", "CAST(CAST(l_quantity AS INT) AS STRING)"),
                ("payment_value",
                 _money_text(f"{_PRICE} * (1 - CAST(l_discount AS DECIMAL(4,2)))")),
            ],
        },
        "customers": {
            "from": "customer",
            "geo": ("c_nationkey",),
            "cols": [
                ("customer_id", "CAST(c_custkey AS STRING)"),
                ("customer_unique_id", f"CAST(c_custkey {idiv} 2 AS STRING)"),
                ("customer_zip_code_prefix", "lpad(CAST(c_nationkey AS STRING), 5, '0')"),
                ("customer_city", "concat(c_mktsegment, ' ', c_name)"),
                ("customer_state", _STATE),
            ],
        },
        # Second customer batch: all customers (those with a negative balance
        # arrive for the first time) and every tenth one moved to another city.
        "customers_batch2": {
            "from": "customer",
            "geo": ("c_nationkey",),
            "cols": [
                ("customer_id", "CAST(c_custkey AS STRING)"),
                ("customer_unique_id", f"CAST(c_custkey {idiv} 2 AS STRING)"),
                ("customer_zip_code_prefix", "lpad(CAST(c_nationkey AS STRING), 5, '0')"),
                ("customer_city",
                 "CASE WHEN c_custkey % 10 = 0 THEN concat('RELOCATED ', c_name) "
                 "ELSE concat(c_mktsegment, ' ', c_name) END"),
                ("customer_state", _STATE),
            ],
        },
        "products": {
            "from": "part",
            "cols": [
                ("product_id", "CAST(p_partkey AS STRING)"),
                # every sixth part has a category of the translation list, one of them padded and in mixed case
                ("product_category_name",
                 "CASE p_partkey % 12 WHEN 0 THEN 'beleza_saude' WHEN 6 THEN ' Perfumaria ' ELSE p_type END"),
                ("product_name_lenght", "CAST(length(p_name) AS STRING)"),
                ("product_description_lenght", "CAST(length(p_name) * 10 + p_size AS STRING)"),
                ("product_photos_qty", "CAST(p_size % 5 AS STRING)"),
                ("product_weight_g",
                 "CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE CAST(p_size * 250 AS STRING) END"),
                ("product_length_cm", "CAST(p_size AS STRING)"),
                ("product_height_cm", "CAST(p_partkey % 20 + 1 AS STRING)"),
                ("product_width_cm", "CAST(p_partkey % 30 + 1 AS STRING)"),
            ],
        },
        "sellers": {
            "from": "supplier",
            "geo": ("s_nationkey",),
            "cols": [
                ("seller_id", "CAST(s_suppkey AS STRING)"),
                ("seller_zip_code_prefix", "lpad(CAST(s_nationkey AS STRING), 5, '0')"),
                ("seller_city", "n_name"),
                ("seller_state", _STATE),
            ],
        },
        "geolocation": {
            "from": "supplier",
            "geo": ("s_nationkey",),
            "cols": [
                ("geolocation_zip_code_prefix", "lpad(CAST(s_nationkey AS STRING), 5, '0')"),
                ("geolocation_lat",
                 "CAST(CAST(s_acctbal AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)) AS STRING)"),
                ("geolocation_lng",
                 "CAST(CAST(s_acctbal AS DECIMAL(12,2)) * CAST(-0.002 AS DECIMAL(4,3)) AS STRING)"),
                ("geolocation_city", "n_name"),
                ("geolocation_state", _STATE),
            ],
        },
        "clickstream": {
            "from": "events",
            "cols": [
                ("event_id", "CAST(event_id AS STRING)"),
                ("user_id", "CAST(user_id AS STRING)"),
                ("session_id",
                 "concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING))"),
                ("event_type",
                 "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' "
                 "WHEN 'signup' THEN 'search' ELSE event_type END"),
                ("product_id",
                 "CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(event_id % 500 AS STRING) END"),
                ("category",
                 "CASE WHEN event_type = 'signup' THEN NULL ELSE concat('cat_', CAST(event_id % 7 AS STRING)) END"),
                ("search_query",
                 "CASE WHEN event_type = 'signup' THEN concat('q', CAST(user_id % 50 AS STRING)) END"),
                ("page_url", "concat('/p/', CAST(event_id % 500 AS STRING))"),
                ("referrer", "CASE WHEN user_id % 4 = 0 THEN 'search_engine' ELSE 'direct' END"),
                ("device_type",
                 "CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END"),
                ("event_timestamp", "CAST(ts AS STRING)"),
            ],
        },
    }


def _with_batches(spec: dict[str, dict]) -> dict[str, dict]:
    """Load batches used by the upsert / SCD scenarios.

    Orders arrive in two overlapping date windows: batch 1 holds purchases
    before 2000, batch 2 purchases from 1999 on, where open (shipped) orders
    of batch 1 have since been delivered. Customers with a negative account
    balance are onboarded only in the second customer batch.
    """
    o = spec["orders"]
    b2 = []
    for name, expr in o["cols"]:
        if name == "order_status":
            expr = expr.replace("WHEN o_orderstatus = 'F' THEN", "WHEN o_orderstatus IN ('F', 'O') THEN")
        if name == "order_delivered_customer_date":
            expr = expr.replace("WHEN o_orderstatus = 'F'", "WHEN o_orderstatus IN ('F', 'O')")
        b2.append((name, expr))
    spec["orders_batch1"] = {**o, "where": "o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"}
    spec["orders_batch2"] = {**o, "cols": b2, "where": "o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'"}
    # A landing with rows that break the rules of each entity (routing scenario).
    def dirty(entity: str, column: str, broken: str) -> dict:
        return {**spec[entity], "cols": [(n, broken.format(e) if n == column else e) for n, e in spec[entity]["cols"]]}

    spec["payments_dirty"] = dirty("payments", "payment_type", "CASE WHEN l_orderkey % 53 = 0 THEN 'barter' ELSE {} END")
    value = next(e for n, e in spec["payments"]["cols"] if n == "payment_value")
    spec["payments_dirty"]["cols"] = [(n, f"CASE WHEN l_orderkey % 59 = 0 THEN concat('-', {value}) WHEN l_orderkey % 61 = 0 THEN 'n/a' ELSE {e} END" if n == "payment_value" else e)
                                      for n, e in spec["payments_dirty"]["cols"]]
    spec["customers_dirty"] = dirty("customers", "customer_id", "CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE {} END")
    spec["products_dirty"] = dirty("products", "product_id", "CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE {} END")
    spec["customers_batch1"] = {**spec["customers"], "where": "c_acctbal >= 0"}
    return spec


ENTITIES = ["orders", "orders_batch1", "orders_batch2", "customers_batch1", "order_items", "payments", "customers", "customers_batch2",
            "products", "sellers", "geolocation", "clickstream", "payments_dirty", "customers_dirty", "products_dirty"]


def _geo_join(t: Tables, df: DataFrame, key: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size reference tables:
    # broadcasting them is bounded regardless of data scale.
    geo = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.join(F.broadcast(geo), df[key] == geo["n_nationkey"], "left")


def bronze(spark: SparkSession, base: str, entity: str) -> DataFrame:
    """Bronze DataFrame for ``entity`` built from the tables under ``base``."""
    spec = _with_batches(_spec("spark"))[entity]
    t = Tables(spark, base)
    src = getattr(t, spec["from"])
    if "where" in spec:
        src = src.filter(spec["where"])
    if "geo" in spec:
        src = _geo_join(t, src, spec["geo"][0])
    return src.selectExpr(*[f"{expr} AS {name}" for name, expr in spec["cols"]])


def bronze_sql(entity: str) -> str:
    """The same entity as DuckDB SQL over the pre-registered source views."""
    spec = _with_batches(_spec("duckdb"))[entity]
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in spec["cols"])
    src = spec["from"]
    if "where" in spec:
        src = f"(SELECT * FROM {src} WHERE {spec['where']})"
    if "geo" in spec:
        src = (f"{src} LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) "
               f"ON {spec['geo'][0]} = n_nationkey")
    return f"SELECT\n  {cols}\nFROM {src}"


def entity_columns(entity: str) -> list[str]:
    """The raw (text) column names of a Bronze entity."""
    return [name for name, _ in _with_batches(_spec("spark"))[entity]["cols"]]


def shape(src: DataFrame, entity: str) -> DataFrame:
    """Apply an entity's Bronze projection to an already loaded (static or
    streaming) source DataFrame; joins are not supported here."""
    spec = _with_batches(_spec("spark"))[entity]
    if "where" in spec:
        src = src.filter(spec["where"])
    return src.selectExpr(*[f"{expr} AS {name}" for name, expr in spec["cols"]])


def as_json_messages(df: DataFrame) -> DataFrame:
    """Rows as broker messages: a key and one JSON text body per row."""
    return df.select(F.col("event_id").alias("key"), F.to_json(F.struct(*df.columns)).alias("body"))


def clickstream_json(spark: SparkSession, base: str) -> DataFrame:
    """Clickstream as the broker delivers it: one JSON text body per event."""
    return as_json_messages(bronze(spark, base, "clickstream"))


#: How a producer's faults change a body: cut off, without an id, with a time nobody can read.
FAULTY_BODY = ("CASE WHEN CAST(key AS BIGINT) % 31 = 0 THEN substring(body, 1, 25) "
               "WHEN CAST(key AS BIGINT) % 37 = 0 THEN replace(body, 'event_id', 'event_no') "
               "WHEN CAST(key AS BIGINT) % 41 = 0 THEN replace(body, 'event_timestamp\":\"', 'event_timestamp\":\"on ') ELSE body END")


def faulty(messages: DataFrame) -> DataFrame:
    """Messages as they come from producers of which some are broken."""
    return messages.select("key", F.expr(FAULTY_BODY).alias("body"))
