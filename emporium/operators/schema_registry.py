"""Schema registry: what columns a table has had, version by version (M7).

The registry of a table is a small Parquet table of its own, a folder
``_version=<n>`` per schema, one row per column. A batch is compared with the
newest version before anything is written. Equal columns are appended;
further columns make the next version (additive evolution); a missing column
or another type refuses the batch, and the outcome names the columns. Names
are compared without case, order does not matter.

Batches lie in folders ``_batch=<n>``, so a repeated load overwrites its own
rows. The table is read under the newest version: batches from before a column hold
nulls in it. Loads of one table follow each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from emporium.sources.warehouse import exists

COLUMNS = "position int, name string, type string"


@dataclass(frozen=True)
class Outcome:
    batch: int
    accepted: bool
    schema_version: int
    added: str       # columns new with this batch
    offending: str   # columns it was refused for


def newest(spark: SparkSession, registry: str) -> tuple[int, T.StructType]:
    """The newest version (0 before the first) and its columns."""
    if not exists(spark, registry):
        return 0, T.StructType()
    rows = spark.read.schema(f"{COLUMNS}, _version int").parquet(registry).collect()  # a row per column and version
    version = max(r["_version"] for r in rows)
    cols = sorted((r["position"], r["name"], r["type"]) for r in rows if r["_version"] == version)
    return version, T.StructType([T.StructField(name, T.DataType.fromDDL(kind)) for _, name, kind in cols])


def differences(known: T.StructType, batch: T.StructType) -> tuple[list[str], list[str]]:
    """(columns only the batch has, columns that are missing in it or changed their type)."""
    have = {f.name.lower(): f.dataType.simpleString() for f in batch.fields}
    want = {f.name.lower(): f.dataType.simpleString() for f in known.fields}
    bad = [f"{c}: missing" for c in want if c not in have]
    bad += [f"{c}: {want[c]} to {have[c]}" for c in want if c in have and have[c] != want[c]]
    return [c for c in have if c not in want], sorted(bad)


def load(spark: SparkSession, registry: str, table: str, batch: DataFrame, number: int) -> Outcome:
    """Append batch ``number`` if its schema is the newest or adds to it."""
    version, known = newest(spark, registry)
    added, bad = differences(known, batch.schema)
    if bad:
        return Outcome(number, False, version, "", ", ".join(bad))
    if added:
        version += 1
        known = T.StructType(known.fields + [f for f in batch.schema.fields if f.name.lower() in added])
        rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(known.fields)]
        spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{registry}/_version={version}")
    batch.select(*[batch[f.name].alias(f.name) for f in known.fields]).write.mode("overwrite").parquet(f"{table}/_batch={int(number)}")
    return Outcome(number, True, version, ", ".join(sorted(added)) if version > 1 else "", "")


def read(spark: SparkSession, registry: str, table: str) -> DataFrame:
    """All batches under the newest schema, with their number as ``_batch``."""
    _, known = newest(spark, registry)
    return spark.read.schema(T.StructType(known.fields + [T.StructField("_batch", T.IntegerType())])).parquet(table)
