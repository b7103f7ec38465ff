"""Keyed upsert without a transactional MERGE.

``upsert`` is a pure function: target and source are full-outer-joined on
the keys, and each key takes the source row when it is new or its hash
differs, else the target row. The caller writes the result as a *new*
version (never reading and overwriting one path in the same job).
Source rows are de-duplicated on the keys first and null keys are rejected,
so a batch with repeated keys cannot make the outcome ambiguous.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.operators.dedup import keep_first


def clean_source(source: DataFrame, keys: list[str]) -> DataFrame:
    ok = None
    for k in keys:
        ok = F.col(k).isNotNull() if ok is None else ok & F.col(k).isNotNull()
    return keep_first(source.filter(ok), keys)


def _joined(target: DataFrame, source: DataFrame, keys: list[str], hash_col: str):
    src = clean_source(source, keys)
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias("t_" + c) for c in cols], F.lit(True).alias("_in_t"))
    s = src.select(*keys, *[F.col(c).alias("s_" + c) for c in cols], F.lit(True).alias("_in_s"))
    j = t.join(s, keys, "full_outer")
    in_t = F.coalesce(F.col("_in_t"), F.lit(False))
    in_s = F.coalesce(F.col("_in_s"), F.lit(False))
    differs = ~F.col("t_" + hash_col).eqNullSafe(F.col("s_" + hash_col))
    kind = (F.when(in_s & ~in_t, "insert")
             .when(in_t & ~in_s, "target_only")
             .when(differs, "update")
             .otherwise("unchanged"))
    return j, cols, kind


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           hash_col: str = "record_hash") -> DataFrame:
    j, cols, kind = _joined(target, source, keys, hash_col)
    take_s = kind.isin("insert", "update")
    return j.select(*keys, *[F.when(take_s, F.col("s_" + c)).otherwise(F.col("t_" + c)).alias(c)
                             for c in cols]).select(*target.columns)


def change_set(target: DataFrame, source: DataFrame, keys: list[str],
               hash_col: str = "record_hash") -> DataFrame:
    """Per key: insert / update / unchanged / target_only."""
    j, _, kind = _joined(target, source, keys, hash_col)
    return j.select(*keys, kind.alias("change_type"))
