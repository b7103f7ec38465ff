"""Narrow tasks before an aggregation on a key that hardly repeats.

A partial aggregate (its sort, or its hash map) holds every distinct key of a
task's input split: with some 10 bytes a row in a columnar file and 150 in
memory, more than a gigabyte for a full split, which then spills. Read in
slices of the keys, each task holds one slice of its split; a hot key is still
reduced in every task before the exchange, and what is exchanged is the same.

A table written in parts (``Warehouse.persist``), one slice after another, has
no more than a slice of its exchange on the executors' disks at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slices of the large tables: a full split of 128 MB takes 350 to 500 MB.
SLICES = 4

#: Tables of more bytes (by Spark's estimate, from the size of their files) are written slice by slice.
PART_BYTES = 256 << 20


def is_large(df: DataFrame) -> bool:
    """Whether what ``df`` exchanges is worth writing it slice by slice; each
    slice is a job of its own. A size Spark doesn't know counts as large."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > PART_BYTES


def in_slices(df: DataFrame, keys: list[str], slices: int = SLICES, only: int | None = None) -> DataFrame:
    """The rows of ``df``, scanned once per slice; rows of equal keys (nulls
    too) are in one slice. One slice is ``df`` itself. ``only``: the rows of
    that slice alone."""
    if slices <= 1:
        return df
    at = F.pmod(F.xxhash64(*keys), F.lit(slices))
    if only is not None:
        return df.where(at == only)
    out = df.where(at == 0)
    for i in range(1, slices):
        out = out.union(df.where(at == i))
    return out
