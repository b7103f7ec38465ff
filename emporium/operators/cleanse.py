"""Row validation with an explicit reject reason (quarantine instead of silent drop)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reject_reason(*rules: tuple[Column, str]) -> Column:
    """First failing rule's label, or null when the row passes every rule.

    Each rule is ``(passes, label)``; a rule whose predicate is null (e.g. a
    comparison on a null value) counts as failed, as in ``filter``.
    """
    expr = None
    for passes, label in rules:
        failed = ~F.coalesce(passes, F.lit(False))
        expr = F.when(failed, F.lit(label)) if expr is None else expr.when(failed, F.lit(label))
    return expr


def split_valid(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows + ``reject_reason``) from one tagged plan."""
    tagged = df.withColumn("reject_reason", reason)
    good = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = tagged.filter(F.col("reject_reason").isNotNull())
    return good, bad
