"""One pass over every raw entity routes each row to the valid rows
or, with the first rule it breaks, to the quarantine.

All five entities are written by a single job, as an append keyed by the
batch: ``batch=<id>/entity=<name>/outcome=<valid or reason>``. A batch that is
loaded again replaces its own folder. Rows keep their typed content as JSON
text, so a repaired rule can be applied to the quarantine later and Silver can
be rebuilt from the valid part without the raw files. The raw rows per entity
are counted by the write itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emporium.plans import silver as S

VALID = "valid"

#: entity -> (raw to typed rows, reject reason of typed rows, key columns)
ENTITIES: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], Column], list[str]]] = {
    "orders": (S.typed_orders, S.order_rules, ["order_id"]),
    "order_items": (S.typed_items, S.item_rules, ["order_id", "order_item_id"]),
    "payments": (S.typed_payments, S.payment_rules, ["order_id", "payment_sequential"]),
    "customers": (S.typed_customers, S.customer_rules, ["customer_id"]),
    "products": (S.typed_products, S.product_rules, ["product_id"]),
}


def tagged(entity: str, raw: DataFrame) -> DataFrame:
    """(entity, outcome, record_key, body) of one raw entity."""
    typed, rules, keys = ENTITIES[entity]
    rows = typed(raw)
    return rows.select(F.lit(entity).alias("entity"), F.coalesce(rules(rows), F.lit(VALID)).alias("outcome"),
                       F.concat_ws("/", *[F.col(k).cast("string") for k in keys]).alias("record_key"),
                       F.to_json(F.struct(*rows.columns)).alias("body"))


def route(raws: dict[str, DataFrame], path: str, batch: str) -> dict[str, int]:
    """Route the rows of ``raws`` (by entity) as batch ``batch`` of the table
    at ``path``; returns the raw rows per entity, counted by the write."""
    every = None
    for entity, raw in raws.items():
        part = tagged(entity, raw)
        every = part if every is None else every.unionByName(part)
    seen = Observation("routed")
    every = every.observe(seen, *[F.count_if(F.col("entity") == e).alias(e) for e in raws])
    (every.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("entity", "outcome")
          .parquet(f"{path}/batch={batch}"))
    return {e: int(seen.get[e]) for e in raws}


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("record_key string, body string, batch string, entity string, outcome string").parquet(path)


def valid_rows(spark: SparkSession, path: str, entity: str, raw: DataFrame) -> DataFrame:
    """The typed valid rows of an entity, read back from the routed table
    (``raw`` only gives the column types)."""
    schema = ENTITIES[entity][0](raw.limit(0)).schema
    part = read_routed(spark, path).filter((F.col("entity") == entity) & (F.col("outcome") == VALID))
    return part.select(F.from_json("body", schema).alias("r")).select("r.*")


def rejects(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("outcome") != VALID).select("entity", "record_key", F.col("outcome").alias("reject_reason"))


def balance(spark: SparkSession, routed: DataFrame, raw_rows: dict[str, int], silver: dict[str, DataFrame]) -> DataFrame:
    """Per entity: every raw row is rejected, a duplicate, or a Silver row.
    Raw rows come from the load's own pass, duplicates from the routed keys
    and Silver rows from the Silver tables, which are built on their own."""
    keyed = routed.groupBy("entity", "outcome", "record_key").agg(F.count(F.lit(1)).alias("n"))
    is_valid = F.col("outcome") == VALID
    counted = keyed.groupBy("entity").agg(F.sum(F.when(~is_valid, F.col("n")).otherwise(0)).alias("rejected"),
                                          F.sum(F.when(is_valid, F.col("n") - 1).otherwise(0)).alias("duplicates"))
    raw = spark.createDataFrame(sorted(raw_rows.items()), "entity string, raw_rows long")
    stored = None
    for entity, df in silver.items():
        n = df.agg(F.count(F.lit(1)).alias("silver_rows")).select(F.lit(entity).alias("entity"), "silver_rows")
        stored = n if stored is None else stored.unionByName(n)
    return (raw.join(counted, "entity").join(stored, "entity")
            .select("entity", "raw_rows", "rejected", "duplicates", "silver_rows",
                    (F.col("rejected") + F.col("duplicates") + F.col("silver_rows") == F.col("raw_rows")).alias("balanced")))
