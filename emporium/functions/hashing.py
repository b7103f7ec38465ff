"""Row hashes and stable surrogate keys (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Separator and null marker for row hashes. A plain ``concat_ws`` skips nulls,
# so (null, 'a') and ('a', null) would hash equal; marking nulls fixes that.
HASH_SEP = "␟"
HASH_NULL = "␀"


def _as_text(c: Column, dtype: T.DataType) -> Column:
    # Doubles print differently across engines (1.0E7 vs 10000000.0): fix the
    # textual form through a wide decimal first.
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        c = c.cast("decimal(38,9)")
    return F.coalesce(c.cast("string"), F.lit(HASH_NULL))


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """Null-safe SHA-256 (hex) of the given columns, in the given order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [_as_text(F.col(c), types[c]) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEP, *parts), 256)


def surrogate_key(*cols: Column | str) -> Column:
    """A key derived from the natural key: its full SHA-256, so keys of
    different rows are different at any table size.

    Unlike ``monotonically_increasing_id`` it does not depend on partition
    layout, so it is stable across rebuilds and across appends.
    """
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(HASH_NULL)).cast("string")
             for c in cols]
    text = parts[0] if len(parts) == 1 else F.concat_ws(HASH_SEP, *parts)
    return F.sha2(text, 256)
