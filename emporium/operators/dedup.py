"""Deterministic de-duplication on a key.

``dropDuplicates`` keeps an arbitrary copy. Here the kept copy is the
smallest row under a total order (the given columns first, then every other
column, ascending, nulls first), chosen with ``min(struct(...))``: a partial
aggregate, so each map task already reduces a hot key to one row before the
shuffle -- a key holding a third of the table never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order_by: list[str] | None = None,
               rejected: Column | None = None) -> DataFrame:
    """One row per key: the smallest under (order_by..., other columns...).

    With ``rejected`` (true for rows that fail validation) rejected copies
    never get to the aggregate, so they are not exchanged and keys without a
    valid copy are dropped -- exactly "validate, then de-duplicate". Valid rows
    are kept through a generator, which the optimizer cannot push into (and
    re-evaluate) the parsing projection.
    """
    cols = df.columns
    order_by = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in cols if c not in keys and c not in order_by]
    fields = order_by + rest
    if rejected is not None:
        valid = F.explode(F.when(~F.coalesce(rejected, F.lit(True)), F.array(F.lit(True))))
        df = df.select("*", valid.alias("_valid")).select(*cols)
    if not fields:
        return df.select(*keys).distinct()
    best = F.min(F.struct(*[F.col(c) for c in fields])).alias("_kept")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_kept.{c}").alias(c) for c in fields]).select(*cols)


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1))
