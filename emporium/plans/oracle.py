"""DuckDB oracle SQL: the same layers written independently as SQL.

Each Silver/Gold table is a named CTE; an oracle query is its final SELECT
plus the CTEs it (transitively) references. Output columns are cast to the
types the Spark side produces so the comparison is exact.
"""

from __future__ import annotations

import re

from emporium.functions import lookups
from emporium.functions.hashing import HASH_NULL, HASH_SEP
from emporium.functions.numeric import pct_sql, round_div_sql
from emporium.sources.bronze import bronze_sql

BATCH_TS = "TIMESTAMP '2024-01-01 00:00:00'"


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def text_of(col: str, is_double: bool = False) -> str:
    c = f"CAST({col} AS DECIMAL(38,9))" if is_double else col
    return f"coalesce(CAST({c} AS VARCHAR), chr({ord(HASH_NULL)}))"


def hash_sql(cols: list[str], doubles: tuple[str, ...] = ()) -> str:
    parts = ", ".join(text_of(c, c in doubles) for c in cols)
    return f"sha256(concat_ws(chr({ord(HASH_SEP)}), {parts}))"


def skey(*cols: str) -> str:
    if len(cols) == 1:
        text = f"CAST(coalesce(CAST({cols[0]} AS VARCHAR), chr({ord(HASH_NULL)})) AS VARCHAR)"
    else:
        text = f"concat_ws(chr({ord(HASH_SEP)}), " + ", ".join(
            f"coalesce(CAST({c} AS VARCHAR), chr({ord(HASH_NULL)}))" for c in cols) + ")"
    return f"sha256({text})"


def initcap(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: concat(upper(w[1]), w[2:])), ' ')")


def pct(part: str, whole: str) -> str:
    return pct_sql(part, whole, "duckdb")


def rdiv(num: str, den: str, digits: int) -> str:
    return round_div_sql(num, den, digits, "duckdb")


def avg_exact(col: str) -> str:
    return f"(CAST(SUM({col}) AS DOUBLE) / CAST(NULLIF(COUNT({col}), 0) AS DOUBLE))"


def region_case(state: str) -> str:
    whens = " ".join(f"WHEN {state} IN ({_q(states)}) THEN '{region}'"
                     for region, states in lookups.REGION_STATES)
    return f"CASE {whens} ELSE '{lookups.UNKNOWN_REGION}' END"


def size_case(weight: str) -> str:
    whens = " ".join(f"WHEN {weight} < {b} THEN '{label}'" for b, label in lookups.SIZE_BANDS)
    return f"CASE {whens} ELSE '{lookups.SIZE_BAND_TOP}' END"


def category_case(cat: str) -> str:
    whens = " ".join(f"WHEN {cat} = '{k}' THEN '{v}'" for k, v in lookups.CATEGORY_TRANSLATIONS.items())
    return f"CASE {whens} ELSE {cat} END"


def calendar_select(d: str) -> str:
    return f"""CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key,
  {d} AS date,
  CAST(year({d}) AS INTEGER) AS year,
  CAST(quarter({d}) AS INTEGER) AS quarter,
  CAST(month({d}) AS INTEGER) AS month,
  strftime({d}, '%B') AS month_name,
  strftime({d}, '%b') AS month_short,
  CAST(weekofyear({d}) AS INTEGER) AS week_of_year,
  CAST(day({d}) AS INTEGER) AS day_of_month,
  CAST(dayofweek({d}) + 1 AS INTEGER) AS day_of_week,
  strftime({d}, '%A') AS day_name,
  strftime({d}, '%a') AS day_short,
  dayofweek({d}) IN (0, 6) AS is_weekend,
  strftime({d}, '%Y-%m') AS year_month,
  concat(CAST(year({d}) AS VARCHAR), '-Q', CAST(quarter({d}) AS VARCHAR)) AS year_quarter,
  CAST(dayofyear({d}) AS INTEGER) AS day_of_year,
  {d} = last_day({d}) AS is_month_end,
  day({d}) = 1 AS is_month_start"""


def _dedup(src: str, keys: list[str], order: list[str]) -> str:
    o = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {o}) AS _rn FROM {src}) WHERE _rn = 1")


ORDER_TS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date"]

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


for _e in ["orders", "orders_batch1", "orders_batch2", "customers_batch1", "order_items", "payments", "customers", "customers_batch2",
           "products", "sellers", "geolocation", "clickstream", "payments_dirty", "customers_dirty", "products_dirty"]:
    cte(f"bronze_{_e}", bronze_sql(_e))

# ---------------------------------------------------------------- silver orders
cte("typed_orders", f"""SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
  trim(upper(order_status)) AS order_status,
  {", ".join(f"TRY_CAST(trim({c}) AS TIMESTAMP) AS {c}" for c in ORDER_TS)}
FROM bronze_orders""")
cte("order_rejects_t", f"""SELECT *, CASE WHEN order_id IS NULL THEN 'null_order_id'
  WHEN order_status IS NULL OR order_status NOT IN ({_q(lookups.ORDER_STATUSES)}) THEN 'invalid_status' END AS reject_reason
FROM typed_orders""")
def silver_orders_sql(src: str = "bronze_orders", batch_ts: str = BATCH_TS) -> str:
    typed = f"""SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
  trim(upper(order_status)) AS order_status,
  {", ".join(f"TRY_CAST(trim({c}) AS TIMESTAMP) AS {c}" for c in ORDER_TS)}
FROM {src}"""
    valid = (f"({typed}) WHERE order_id IS NOT NULL AND order_status IN ({_q(lookups.ORDER_STATUSES)})")
    ded = _dedup(f"(SELECT * FROM {valid})", ["order_id"],
                 ["order_purchase_timestamp", "customer_id", "order_status", *ORDER_TS[1:]])
    return f"""SELECT *, CAST(delivery_seconds AS DOUBLE) / 86400.0 AS delivery_days,
  coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) AS is_late_delivery,
  {batch_ts} AS ingestion_timestamp, 'orders' AS source_system,
  {hash_sql(["order_id", "customer_id", "order_status", *ORDER_TS])} AS record_hash
FROM (SELECT *, CASE WHEN order_delivered_customer_date IS NOT NULL AND order_purchase_timestamp IS NOT NULL
  THEN date_diff('second', order_purchase_timestamp, order_delivered_customer_date) END AS delivery_seconds
  FROM ({ded}))"""


cte("silver_orders", silver_orders_sql())
cte("orders_b1", silver_orders_sql("bronze_orders_batch1"))
cte("orders_b2", silver_orders_sql("bronze_orders_batch2", "TIMESTAMP '2024-02-01 00:00:00'"))

# ---------------------------------------------------------------- silver customers
_CUST_COLS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]


def _silver_customers(src: str) -> str:
    typed = f"""SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
  trim(customer_zip_code_prefix) AS customer_zip_code_prefix,
  regexp_replace({initcap(f"trim(customer_city)")}, '[^a-zA-Z\\s]', '', 'g') AS customer_city,
  substr(trim(customer_state), 1, 2) AS customer_state
FROM {src} WHERE trim(customer_id) IS NOT NULL"""
    ded = _dedup(f"({typed})", ["customer_id"], _CUST_COLS[1:])
    return f"""SELECT *, {BATCH_TS} AS ingestion_timestamp, 'customers' AS source_system,
  {hash_sql(_CUST_COLS)} AS record_hash FROM ({ded})"""


cte("silver_customers", _silver_customers("bronze_customers"))
cte("silver_customers_b1", _silver_customers("bronze_customers_batch1"))
cte("silver_customers_b2", _silver_customers("bronze_customers_batch2"))

# ---------------------------------------------------------------- silver products
_PROD_DIMS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
_PROD_COLS = ["product_id", "product_category_name", "product_category_name_english",
              "product_name_lenght", "product_description_lenght", "product_photos_qty",
              *_PROD_DIMS, "weight_missing"]
cte("silver_products", f"""SELECT *, {BATCH_TS} AS ingestion_timestamp, 'products' AS source_system,
  {hash_sql(_PROD_COLS, tuple(_PROD_DIMS))} AS record_hash
FROM ({_dedup(f'''(SELECT trim(product_id) AS product_id,
  trim(lower(product_category_name)) AS product_category_name,
  {category_case("trim(lower(product_category_name))")} AS product_category_name_english,
  TRY_CAST(trim(product_name_lenght) AS INTEGER) AS product_name_lenght,
  TRY_CAST(trim(product_description_lenght) AS INTEGER) AS product_description_lenght,
  coalesce(TRY_CAST(trim(product_photos_qty) AS INTEGER), 0) AS product_photos_qty,
  {", ".join(f"coalesce(TRY_CAST(trim({c}) AS DOUBLE), 0.0) AS {c}" for c in _PROD_DIMS)},
  TRY_CAST(trim(product_weight_g) AS DOUBLE) IS NULL AS weight_missing
FROM bronze_products WHERE trim(product_id) IS NOT NULL)''', ["product_id"], _PROD_COLS[1:])})""")

# ---------------------------------------------------------------- silver payments
cte("typed_payments", """SELECT trim(order_id) AS order_id,
  TRY_CAST(trim(payment_sequential) AS INTEGER) AS payment_sequential,
  trim(upper(payment_type)) AS payment_type,
  TRY_CAST(trim(payment_installments) AS INTEGER) AS payment_installments,
  TRY_CAST(trim(payment_value) AS DECIMAL(18,2)) AS payment_value
FROM bronze_payments""")
_PAY_COLS = ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]
cte("payment_details", f"""SELECT *, {BATCH_TS} AS ingestion_timestamp, 'payments' AS source_system,
  {hash_sql(_PAY_COLS)} AS record_hash
FROM ({_dedup(f'''(SELECT * FROM typed_payments WHERE order_id IS NOT NULL AND payment_value >= 0
  AND payment_type IN ({_q(lookups.PAYMENT_TYPES)}))''', ["order_id", "payment_sequential"],
  ["payment_type", "payment_installments", "payment_value"])})""")
cte("payment_summary", f"""SELECT order_id,
  CAST(SUM(payment_value) AS DECIMAL(18,2)) AS total_payment_value,
  CAST(COUNT(*) AS BIGINT) AS payment_count,
  MAX(payment_installments) AS max_installments,
  {", ".join(f"MAX(CASE WHEN payment_type = '{t}' THEN payment_value END) AS {n}" for t, n in lookups.PAYMENT_TYPE_COLUMNS)},
  arg_max(payment_type, (payment_value, payment_type)) AS primary_payment_type
FROM payment_details GROUP BY order_id""")

# ---------------------------------------------------------------- silver order items
cte("typed_items", """SELECT trim(order_id) AS order_id,
  TRY_CAST(trim(order_item_id) AS INTEGER) AS order_item_id,
  trim(product_id) AS product_id, trim(seller_id) AS seller_id,
  TRY_CAST(trim(shipping_limit_date) AS TIMESTAMP) AS shipping_limit_date,
  CAST(round(TRY_CAST(trim(price) AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS price,
  CAST(round(TRY_CAST(trim(freight_value) AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS freight_value
FROM bronze_order_items""")
cte("item_rejects_t", f"""SELECT *, CASE WHEN order_id IS NULL THEN 'null_order_id'
  WHEN product_id IS NULL THEN 'null_product_id'
  WHEN order_item_id IS NULL THEN 'null_order_item_id'
  WHEN price IS NULL OR price < 0 THEN 'negative_or_invalid_price'
  WHEN freight_value IS NULL OR freight_value < 0 THEN 'negative_or_invalid_freight'
  WHEN price >= {lookups.MAX_ITEM_PRICE} THEN 'price_over_limit' END AS reject_reason
FROM typed_items""")
_ITEM_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
              "price", "freight_value", "line_total_value"]
cte("silver_order_items", f"""SELECT *, {BATCH_TS} AS ingestion_timestamp, 'order_items' AS source_system,
  {hash_sql(_ITEM_COLS)} AS record_hash
FROM (SELECT *, CAST(price + freight_value AS DECIMAL(18,2)) AS line_total_value FROM ({_dedup(
    "(SELECT * EXCLUDE (reject_reason) FROM item_rejects_t WHERE reject_reason IS NULL)",
    ["order_id", "order_item_id"], ["product_id", "seller_id", "shipping_limit_date", "price", "freight_value"])}))""")

# ---------------------------------------------------------------- gold
cte("items_per_order", """SELECT order_id, CAST(SUM(price) AS DECIMAL(18,2)) AS total_item_value,
  CAST(SUM(freight_value) AS DECIMAL(18,2)) AS total_freight_value, CAST(COUNT(*) AS BIGINT) AS item_count
FROM silver_order_items GROUP BY order_id""")
cte("fact_orders", f"""SELECT {skey("o.order_id")} AS order_sk, o.order_id, o.customer_id, c.customer_unique_id,
  CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_date_key,
  CAST(strftime(o.order_purchase_timestamp, '%Y%m') AS INTEGER) AS order_month,
  i.total_item_value, i.total_freight_value, p.total_payment_value,
  i.item_count, p.payment_count, p.max_installments,
  o.delivery_days, o.delivery_seconds, o.order_status, o.is_late_delivery,
  {", ".join("o." + c for c in ORDER_TS)}
FROM silver_orders o
LEFT JOIN items_per_order i ON o.order_id = i.order_id
LEFT JOIN payment_summary p ON o.order_id = p.order_id
LEFT JOIN silver_customers c ON o.customer_id = c.customer_id""")
cte("dim_date", f"""SELECT {calendar_select("d")} FROM (
  SELECT CAST(unnest(generate_series(make_date(CAST(year(lo) AS INTEGER), 1, 1),
    make_date(CAST(year(hi) AS INTEGER), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT min(order_purchase_timestamp) AS lo, max(order_purchase_timestamp) AS hi FROM silver_orders))""")
cte("dim_products", f"""SELECT {skey("product_id")} AS product_sk, product_id,
  product_category_name_english AS category,
  product_name_lenght AS product_name_length, product_description_lenght AS product_description_length,
  product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm,
  round(product_length_cm * product_height_cm * product_width_cm, 2) AS product_volume_cm3,
  {size_case("product_weight_g")} AS size_category, weight_missing,
  {BATCH_TS} AS valid_from, true AS is_current
FROM silver_products""")
cte("silver_geolocation", """SELECT trim(geolocation_zip_code_prefix) AS zip_code_prefix,
  TRY_CAST(trim(geolocation_lat) AS DECIMAL(12,5)) AS lat,
  TRY_CAST(trim(geolocation_lng) AS DECIMAL(12,5)) AS lng,
  trim(geolocation_city) AS city, trim(geolocation_state) AS state
FROM bronze_geolocation WHERE trim(geolocation_zip_code_prefix) IS NOT NULL""")
cte("dim_geography", f"""SELECT {skey("zip_code_prefix")} AS geography_sk, zip_code_prefix, city, state,
  CAST({rdiv("lat_sum", "lat_n * 100000", 6)} AS DECIMAL(12,6)) AS latitude,
  CAST({rdiv("lng_sum", "lng_n * 100000", 6)} AS DECIMAL(12,6)) AS longitude,
  {region_case("state")} AS region, geo_points_count
FROM (SELECT zip_code_prefix,
    CAST(COUNT(*) AS BIGINT) AS geo_points_count,
    SUM(CAST(lat * 100000 AS BIGINT)) AS lat_sum, COUNT(lat) AS lat_n,
    SUM(CAST(lng * 100000 AS BIGINT)) AS lng_sum, COUNT(lng) AS lng_n,
    arg_min(city, (-n, city, state)) AS city, arg_min(state, (-n, city, state)) AS state
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY zip_code_prefix, city, state) AS n FROM silver_geolocation)
  GROUP BY zip_code_prefix)""")
cte("dim_sellers", f"""SELECT {skey("seller_id")} AS seller_sk, seller_id, seller_zip_code_prefix, seller_city,
  seller_state, {region_case("seller_state")} AS seller_region
FROM ({_dedup('''(SELECT trim(seller_id) AS seller_id, trim(seller_zip_code_prefix) AS seller_zip_code_prefix,
  trim(seller_city) AS seller_city, trim(seller_state) AS seller_state FROM bronze_sellers
  WHERE trim(seller_id) IS NOT NULL)''', ["seller_id"], ["seller_zip_code_prefix", "seller_city", "seller_state"])})""")
cte("fact_order_items", f"""SELECT {skey("i.order_id", "CAST(i.order_item_id AS VARCHAR)")} AS order_item_sk,
  i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id,
  CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_date_key,
  1 AS quantity, i.price, i.freight_value, i.line_total_value,
  o.order_status, o.delivery_days, o.delivery_seconds, o.is_late_delivery,
  i.shipping_limit_date, o.order_purchase_timestamp, p.product_sk, s.seller_sk, d.customer_sk
FROM silver_order_items i JOIN silver_orders o ON i.order_id = o.order_id
LEFT JOIN dim_products p ON p.product_id = i.product_id LEFT JOIN dim_sellers s ON s.seller_id = i.seller_id
LEFT JOIN silver_customers c ON c.customer_id = o.customer_id
LEFT JOIN dim_customers d ON d.customer_unique_id = c.customer_unique_id AND o.order_purchase_timestamp >= d.valid_from
  AND (d.valid_to IS NULL OR o.order_purchase_timestamp < d.valid_to)""")


def with_ctes(select: str) -> str:
    """Prefix ``select`` with every CTE it needs, in dependency order."""
    names = list(CTES)
    need: list[str] = []

    def visit(text: str):
        for n in names:
            if n not in need and re.search(rf"\b{n}\b", text):
                visit(CTES[n])
                if n not in need:
                    need.append(n)

    visit(select)
    if not need:
        return select
    body = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in need)
    return f"WITH {body}\n{select}"


# ---------------------------------------------------------------- history (SCD2, upsert)
def _cust_inc(src: str, tracked=("customer_city", "customer_state", "customer_zip_code_prefix")) -> str:
    ded = _dedup(f"(SELECT customer_unique_id, customer_id, customer_city, customer_state, "
                 f"customer_zip_code_prefix FROM {src})", ["customer_unique_id"],
                 ["customer_id", "customer_city", "customer_state", "customer_zip_code_prefix"])
    return f"SELECT *, {hash_sql(list(tracked))} AS record_hash FROM ({ded})"


cte("cust_inc_1", _cust_inc("silver_customers_b1"))
cte("cust_inc_2", _cust_inc("silver_customers_b2"))
cte("cust_inc_1_cs", _cust_inc("silver_customers_b1", ("customer_city", "customer_state")))
cte("cust_inc_2_cs", _cust_inc("silver_customers_b2", ("customer_city", "customer_state")))
_INC = ["customer_unique_id", "customer_id", "customer_city", "customer_state", "customer_zip_code_prefix",
        "record_hash"]
_T1, _T2, _OPEN = "1990-01-01 00:00:00", "1998-01-01 00:00:00", "9999-12-31 00:00:00"


def _scd_initial(open_end: str | None, inc1: str = "cust_inc_1") -> str:
    vt = f"TIMESTAMP '{open_end}'" if open_end else "CAST(NULL AS TIMESTAMP)"
    return (f"SELECT {skey('customer_unique_id', repr(_T1))} AS customer_sk, {', '.join(_INC)}, "
            f"true AS is_current, TIMESTAMP '{_T1}' AS valid_from, {vt} AS valid_to FROM {inc1}")


def _scd_apply(hist: str, open_end: str | None, inc2: str = "cust_inc_2") -> str:
    vt = f"TIMESTAMP '{open_end}'" if open_end else "CAST(NULL AS TIMESTAMP)"
    changed = "(i.customer_unique_id IS NOT NULL AND c.record_hash IS DISTINCT FROM i.record_hash)"
    return f"""SELECT * FROM {hist} WHERE NOT is_current
UNION ALL
SELECT c.customer_sk, {', '.join('c.' + x for x in _INC)},
  (NOT {changed}) AND c.is_current AS is_current, c.valid_from,
  CASE WHEN {changed} THEN TIMESTAMP '{_T2}' ELSE c.valid_to END AS valid_to
FROM (SELECT * FROM {hist} WHERE is_current) c LEFT JOIN {inc2} i ON c.customer_unique_id = i.customer_unique_id
UNION ALL
SELECT {skey('i.customer_unique_id', repr(_T2))} AS customer_sk, {', '.join('i.' + x for x in _INC)},
  true AS is_current, TIMESTAMP '{_T2}' AS valid_from, {vt} AS valid_to
FROM {inc2} i LEFT JOIN (SELECT * FROM {hist} WHERE is_current) c ON c.customer_unique_id = i.customer_unique_id
WHERE c.customer_unique_id IS NULL OR c.record_hash IS DISTINCT FROM i.record_hash"""


cte("dim_customers_initial", _scd_initial(None))
cte("dim_customers", _scd_apply("dim_customers_initial", None))
cte("dim_customers_initial_oe", _scd_initial(_OPEN, "cust_inc_1_cs"))
cte("dim_customers_oe", _scd_apply("dim_customers_initial_oe", _OPEN, "cust_inc_2_cs"))

_ORD_COLS = ["customer_id", "order_status", *ORDER_TS, "delivery_seconds", "delivery_days",
             "is_late_delivery", "ingestion_timestamp", "source_system", "record_hash"]
cte("orders_b2_clean", _dedup("(SELECT * FROM orders_b2 WHERE order_id IS NOT NULL)", ["order_id"], _ORD_COLS))
_TAKE_S = ("(t.order_id IS NULL OR (s.order_id IS NOT NULL AND t.record_hash IS DISTINCT FROM s.record_hash))")
cte("orders_upserted", f"""SELECT coalesce(t.order_id, s.order_id) AS order_id,
  {", ".join(f"CASE WHEN {_TAKE_S} THEN s.{c} ELSE t.{c} END AS {c}" for c in _ORD_COLS)}
FROM orders_b1 t FULL OUTER JOIN orders_b2_clean s ON t.order_id = s.order_id""")
cte("orders_changeset", """SELECT coalesce(t.order_id, s.order_id) AS order_id,
  CASE WHEN t.order_id IS NULL THEN 'insert' WHEN s.order_id IS NULL THEN 'target_only'
       WHEN t.record_hash IS DISTINCT FROM s.record_hash THEN 'update' ELSE 'unchanged' END AS change_type
FROM orders_b1 t FULL OUTER JOIN orders_b2_clean s ON t.order_id = s.order_id""")


def avg_days(col: str = "delivery_seconds") -> str:
    return f"(CAST(SUM({col}) AS DOUBLE) / CAST(NULLIF(COUNT({col}), 0) AS DOUBLE) / 86400.0)"


def value_segment_case(ltv: str) -> str:
    whens = " ".join(f"WHEN {ltv} > {b} THEN '{label}'" for b, label in lookups.VALUE_SEGMENTS)
    return f"CASE {whens} ELSE '{lookups.VALUE_SEGMENT_LOW}' END"


cte("dim_customers_current", "SELECT * FROM dim_customers WHERE is_current")
cte("primary_product", """SELECT order_id, arg_min(product_id, order_item_id) AS primary_product_id
FROM silver_order_items GROUP BY order_id""")


def checks_sql(label: str, src: str, checks: dict[str, str]) -> str:
    """One aggregate over ``src`` unpivoted into report rows."""
    cols = ", ".join(f"{expr} AS {name}" for name, expr in checks.items())
    agg = f"(SELECT COUNT(*) AS total_rows, {cols} FROM {src})"
    return "\nUNION ALL\n".join(
        f"""SELECT '{label}' AS "table", '{name}' AS "check", CAST({name} AS BIGINT) AS failed_rows,
  CAST(total_rows AS BIGINT) AS total_rows, {name} = 0 AS passed FROM {agg}"""
        for name in checks)


# ---------------------------------------------------------------- routing
cte("routed", f"""SELECT 'orders' AS entity, order_id AS record_key, reject_reason FROM order_rejects_t
UNION ALL SELECT 'order_items', concat_ws('/', order_id, CAST(order_item_id AS VARCHAR)), reject_reason FROM item_rejects_t
UNION ALL SELECT 'payments', concat_ws('/', trim(order_id), CAST(TRY_CAST(trim(payment_sequential) AS INTEGER) AS VARCHAR)),
  CASE WHEN trim(order_id) IS NULL THEN 'null_order_id'
    WHEN coalesce(TRY_CAST(trim(payment_value) AS DECIMAL(18,2)) < 0, true) THEN 'negative_or_invalid_value'
    WHEN trim(upper(payment_type)) NOT IN ({_q(lookups.PAYMENT_TYPES)}) THEN 'invalid_payment_type' END FROM bronze_payments_dirty
UNION ALL SELECT 'customers', coalesce(trim(customer_id), ''), CASE WHEN trim(customer_id) IS NULL THEN 'null_customer_id' END FROM bronze_customers_dirty
UNION ALL SELECT 'products', coalesce(trim(product_id), ''), CASE WHEN trim(product_id) IS NULL THEN 'null_product_id' END FROM bronze_products_dirty""")

# ---------------------------------------------------------------- clickstream
cte("clicks", "SELECT *, TRY_CAST(event_timestamp AS TIMESTAMP) AS event_ts FROM bronze_clickstream")
cte("click_minutes", """SELECT time_bucket(INTERVAL '1 minute', event_ts) AS window_start,
  time_bucket(INTERVAL '1 minute', event_ts) + INTERVAL '1 minute' AS window_end,
  event_type, device_type, CAST(COUNT(*) AS BIGINT) AS event_count,
  CAST(COUNT(user_id) AS BIGINT) AS unique_sessions,
  CAST(COUNT(DISTINCT session_id) AS BIGINT) AS distinct_sessions
FROM clicks GROUP BY ALL""")
