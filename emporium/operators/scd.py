"""Slowly changing dimensions: type 2 (history rows) and type 3 (prior value).

``scd2_apply`` is one plan: the current rows are full-outer-joined with the
incoming batch on the business key, and each joined row emits at most two
rows (the old version, possibly expired, and a new version) through one
``explode`` -- no re-read of the dimension between "expire" and "insert",
one effective timestamp for the whole batch, one write by the caller.
Closed history rows pass through untouched. Re-applying the same batch is a
no-op (hashes equal). Keys missing from a batch are not expired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.functions.hashing import surrogate_key

SCD_COLS = ["is_current", "valid_from", "valid_to"]


def _ts(v) -> Column:
    return F.lit(v).cast("timestamp_ntz") if v is not None else F.lit(None).cast("timestamp_ntz")


def scd2_initial(incoming: DataFrame, key: str, effective_ts, sk: str = "sk",
                 open_end=None) -> DataFrame:
    """First load: every incoming row is a current version (null keys rejected)."""
    incoming = incoming.filter(F.col(key).isNotNull())
    vf = _ts(effective_ts)
    return incoming.select(
        surrogate_key(F.col(key), vf.cast("string")).alias(sk), *incoming.columns,
        F.lit(True).alias("is_current"), vf.alias("valid_from"), _ts(open_end).alias("valid_to"))


def scd2_apply(history: DataFrame, incoming: DataFrame, key: str, hash_col: str,
               effective_ts, sk: str = "sk", open_end=None) -> DataFrame:
    # A null business key never matches, so it would open a new version on
    # every load: such rows are rejected.
    incoming = incoming.filter(F.col(key).isNotNull())
    attrs = [c for c in incoming.columns if c != key]
    cols = [sk, key, *attrs, *SCD_COLS]
    cur = history.filter(F.col("is_current"))
    closed = history.filter(~F.col("is_current"))
    c = cur.select(*[F.col(x).alias("c_" + x) for x in cols])
    i = incoming.select(*[F.col(x).alias("i_" + x) for x in incoming.columns])
    j = c.join(i, F.col("c_" + key) == F.col("i_" + key), "full_outer")

    has_cur = F.col("c_valid_from").isNotNull()
    has_inc = F.col("i_" + hash_col).isNotNull()
    eff = _ts(effective_ts)
    differs = has_cur & has_inc & ~F.col("c_" + hash_col).eqNullSafe(F.col("i_" + hash_col))
    # A batch at the time a version began corrects that version in place; one
    # from before it comes too late and changes nothing.
    replaced = differs & (F.col("c_valid_from") == eff)
    changed = differs & (F.col("c_valid_from") < eff)

    old = F.struct(
        F.col("c_" + sk).alias(sk), F.col("c_" + key).alias(key),
        *[F.col("c_" + a).alias(a) for a in attrs],
        (~changed & F.col("c_is_current")).alias("is_current"),
        F.col("c_valid_from").alias("valid_from"),
        F.when(changed, eff).otherwise(F.col("c_valid_to")).alias("valid_to"),
    )
    new = F.struct(
        surrogate_key(F.col("i_" + key), eff.cast("string")).alias(sk),
        F.col("i_" + key).alias(key),
        *[F.col("i_" + a).alias(a) for a in attrs],
        F.lit(True).alias("is_current"), eff.alias("valid_from"), _ts(open_end).alias("valid_to"),
    )
    rows = F.array(F.when(has_cur & ~replaced, old), F.when(has_inc & (~has_cur | changed | replaced), new))
    applied = (j.select(F.explode(rows).alias("r")).filter(F.col("r").isNotNull())
                .select("r.*"))
    return closed.select(*cols).unionByName(applied)


def scd2_changes(history: DataFrame, incoming: DataFrame, key: str, hash_col: str) -> DataFrame:
    """What an apply would do, per key: new / changed / unchanged / missing."""
    cur = history.filter(F.col("is_current")).select(key, F.col(hash_col).alias("_old"))
    inc = incoming.select(key, F.col(hash_col).alias("_new"))
    j = cur.join(inc, key, "full_outer")
    kind = (F.when(F.col("_old").isNull(), "new")
             .when(F.col("_new").isNull(), "missing")
             .when(F.col("_old") == F.col("_new"), "unchanged")
             .otherwise("changed"))
    return j.select(key, kind.alias("change_type"))


def asof_lookup(facts: DataFrame, versions: DataFrame, key: str, ts_col: str,
                how: str = "left") -> DataFrame:
    """Attach to each fact row the dimension version valid at ``ts_col``.

    Equi-join on the business key with the validity interval
    ``[valid_from, valid_to)`` as a residual predicate (open end = null or a
    far-future date). Versions per key are bounded by the number of loads,
    so the candidate pairs are bounded too; a hot key is split by AQE's
    skew-join handling rather than landing whole in one task.
    """
    v = versions.withColumnRenamed(key, "_v_key")
    ts = facts[ts_col]
    cond = ((facts[key] == v["_v_key"]) & (ts >= v["valid_from"])
            & (v["valid_to"].isNull() | (ts < v["valid_to"])))
    return facts.join(v, cond, how).drop("_v_key")


def scd3_previous(history: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Type-3 view: each current row with the attribute values it replaced.

    The prior version is the one whose ``valid_to`` equals the current row's
    ``valid_from`` -- an exact equi-join, no window over a whole key.
    """
    cur = history.filter(F.col("is_current"))
    prev = history.filter(~F.col("is_current")).select(
        F.col(key).alias("_p_key"), F.col("valid_to").alias("_p_to"),
        *[F.col(a).alias("previous_" + a) for a in attrs])
    j = cur.join(prev, (cur[key] == prev["_p_key"]) & (cur["valid_from"] == prev["_p_to"]), "left")
    return j.select(key, *attrs, *["previous_" + a for a in attrs], "valid_from")
