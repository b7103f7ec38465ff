"""Embedding near-duplicates by an exact metric range join.

Vectors of one label (and dimension) are linked if their cosine reaches the
threshold, which for unit vectors is a distance of at most
eps = sqrt(2 - 2 * threshold). Per label, pivots are chosen far apart from a
bounded sample. A vector's home cell is that of its nearest pivot; it is also
sent to every other cell j whose home vectors may lie within eps of it:
  d(x, pj) - d(x, pi) <= 2 eps                          (triangle inequality)
  (d(x, pj)^2 - d(x, pi)^2) / (2 d(pi, pj)) <= eps      (distance to the border)
so every link of a home vector is found inside its home cell, and cells are
joined independently. Cells larger than ``block`` rows are joined in pairs of
blocks, so no task holds more than two blocks. A task returns, per home
vector, the number of vectors linked, and one edge per vector to its local
component instead of all pairs; edges make components.

Equal vectors are joined as one that counts as many. Pivots only decide the
amount of work: without any, the join is still exact.

Results per row: (id, n_links: other rows linked, component_id: smallest id
reachable, kept: id = component_id). Rows whose vector is null, empty, zero or
holds null or non-finite components, and rows without a label, link with
nothing; so do rows without an id (component null, kept). Rows that repeat an
id are vectors of their own, kept or not together (those that link with
nothing stay). Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import cut, importable
from emporium.llm.components import components

THRESHOLD = 0.98
MAX_PIVOTS = 4096     # of all labels
SAMPLE = 4            # sampled vectors a pivot
CELL = 500            # vectors a pivot is meant for
BLOCK = 2000
_SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def identified(rows: DataFrame) -> DataFrame:
    """(id, label, vec) -> (id, label, key, dim, vec) with a 128-bit key of label
    and vector; rows that link with nothing have a null key."""
    importable(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, dims = [], []
            for i, label, vec in zip(*(b.column(c).to_pylist() for c in range(3))):
                key = dim = None
                if i is not None and label is not None and vec and not any(x is None for x in vec):
                    v = np.array(vec, float)
                    if np.isfinite(v).all() and v.any():
                        key, dim = xxhash.xxh128_digest(struct.pack("<qq", label, len(v)) + v.tobytes()), len(v)
                keys.append(key)
                dims.append(dim)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), b.column(2)],
                                             names=["id", "label", "key", "dim", "vec"])

    return rows.mapInArrow(run, "id long, label long, key binary, dim int, vec array<double>")


def choose_pivots(sample: np.ndarray, n: int, eps: float) -> np.ndarray:
    """At most n rows far apart: each the farthest from those before, until
    all others are within eps."""
    if not len(sample) or n < 2:
        return sample[:0]
    picked, far = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(picked) < n and far.max() > eps:
        k = int(far.argmax())
        picked.append(k)
        far = np.minimum(far, np.linalg.norm(sample - sample[k], axis=1))
    return sample[picked]


def pivots(spark: SparkSession, texts: DataFrame, eps: float, max_pivots: int, cell: int) -> dict[tuple[int, int], np.ndarray]:
    """Unit pivots by (label, dim): from a sample of about ``SAMPLE * max_pivots``
    vectors of all labels at most."""
    counts = texts.groupBy("label", "dim").agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        return {}
    wanted = min(max_pivots, -(-total // cell))
    share = min(1.0, SAMPLE * wanted / total)
    picked = texts.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("label", "dim", "vec")
    by: dict[tuple[int, int], list] = defaultdict(list)
    for r in picked.toLocalIterator():
        by[r.label, r.dim].append(r.vec)
    out = {}
    for k in sorted(by):
        x = np.array(by[k], float)
        x = x[np.lexsort(x.T)]
        out[k] = choose_pivots(x / np.linalg.norm(x, axis=1)[:, None], -(-len(x) // SAMPLE), eps)
    return {k: v for k, v in out.items() if len(v) > 1}


def cells_of(x: np.ndarray, p: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and cells of unit vectors x for pivots p: (row, cell, is home)."""
    d2 = np.maximum(2 - 2 * x @ p.T, 0)
    home = d2.argmin(1)
    between = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))
    own2 = d2[np.arange(len(x)), home][:, None]
    near = np.sqrt(d2) - np.sqrt(own2) <= 2 * eps + _SLACK
    near &= d2 - own2 <= 2 * between[home] * eps + _SLACK
    near[np.arange(len(x)), home] = True
    row, cell = np.nonzero(near)
    return row, cell, cell == home[row]


def _join_cell(a: pa.Table, threshold: float) -> pa.Table:
    """Home rows of a block against member rows of a block."""
    role = a.column("role").to_numpy()
    vec = a.column("vec").combine_chunks()
    x = _matrix(vec)
    ids, copies = a.column("id").to_numpy(), a.column("copies").to_numpy()
    home, member = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    out_id, out_root, out_n = [], [], []
    if len(home) and len(member):
        h, m = x[home], x[member]
        linked = (h @ m.T) / (np.linalg.norm(h, axis=1)[:, None] * np.linalg.norm(m, axis=1)[None, :]) >= threshold
        linked |= ids[home][:, None] == ids[member][None, :]
        n = linked @ copies[member]
        root = np.arange(len(home))
        while True:  # smallest local root over links, home to member and back
            via = np.where(linked, root[:, None], len(home)).min(0)
            new = np.minimum(root, np.where(linked, via[None, :], len(home)).min(1))
            if (new == root).all():
                break
            root = new
        met = via < len(home)
        out_id = np.concatenate([ids[home], ids[member][met]])
        out_root = np.concatenate([ids[home][root], ids[home][via[met]]])
        out_n = np.concatenate([n, np.zeros(met.sum(), np.int64)])
    return pa.table({"id": pa.array(out_id, pa.int64()), "root": pa.array(out_root, pa.int64()), "n": pa.array(out_n, pa.int64())})


def near_duplicates(spark: SparkSession, df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, max_pivots: int = MAX_PIVOTS, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) per input row; see the module."""
    eps = float(np.sqrt(2 - 2 * threshold))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                     F.col(vec_col).cast("array<double>").alias("vec"))
    found = cut(spark, identified(rows), "vectors")
    usable = found.where("key is not null")
    distinct = cut(spark, usable.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"),
                                                    F.first("dim").alias("dim"), F.first("vec").alias("vec"))
                   .withColumn("id", F.monotonically_increasing_id()), "distinct")  # from here on vectors go by a number of their own
    sent = spark.sparkContext.broadcast(pivots(spark, distinct, eps, max_pivots, cell))  # max_pivots vectors

    def deal(batches):
        for b in batches:
            label, dim, vecs = b.column(3).to_numpy(), b.column(4).to_numpy(), b.column(5)
            for key in sorted(set(zip(label.tolist(), dim.tolist()))):
                at = np.flatnonzero((label == key[0]) & (dim == key[1]))
                p = sent.value.get(key)
                if p is None:
                    row, cells, home = np.arange(len(at)), np.zeros(len(at), int), np.ones(len(at), bool)
                else:
                    x = _matrix(vecs.take(pa.array(at)))
                    row, cells, home = cells_of(x / np.linalg.norm(x, axis=1)[:, None], p, eps)
                t = pa.array(at[row])
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).take(t), b.column(2).take(t), b.column(3).take(t), b.column(4).take(t), vecs.take(t),
                     pa.array(cells, pa.int32()), pa.array(home, pa.bool_())],
                    names=["id", "copies", "label", "dim", "vec", "cell", "home"])

    dealt = cut(spark, distinct.select("key", "id", "copies", "label", "dim", "vec").mapInArrow(
        deal, "id long, copies long, label long, dim int, vec array<double>, cell int, home boolean"), "cells")
    # cells of one vector have no links; large ones are joined in pairs of blocks
    size = (dealt.groupBy("label", "dim", "cell").agg(F.count("*").alias("rows"))
            .select(F.col("label").alias("kl"), F.col("dim").alias("kd"), F.col("cell").alias("kc"),
                    F.ceil(F.col("rows") / block).cast("int").alias("blocks")))
    placed = (dealt.join(size, (F.col("label") == F.col("kl")) & (F.col("dim") == F.col("kd")) & (F.col("cell") == F.col("kc")))
              .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    cols = ["label", "dim", "cell", "id", "copies", "vec"]
    sides = (placed.where("home").select(*cols, F.col("own").alias("i"), F.col("other").alias("j"), F.lit(0).alias("role"))
             .union(placed.select(*cols, F.col("other").alias("i"), F.col("own").alias("j"), F.lit(1).alias("role"))))
    joined = cut(spark, sides.groupBy("label", "dim", "cell", "i", "j").applyInArrow(
        lambda t: _join_cell(t, threshold), "id long, root long, n long"), "links")

    counts = joined.groupBy("id").agg(F.sum("n").alias("n"))
    part = components(spark, joined.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    placed = (distinct.select("key", "id", "least").join(part.withColumnRenamed("node", "k2"), F.col("id") == F.col("k2"), "left")
              .select("key", "id", "least", F.coalesce("component", "id").alias("part")))
    named = placed.groupBy("part").agg(F.min("least").alias("component")).withColumnRenamed("part", "k3")
    of_vector = (placed.join(counts.withColumnRenamed("id", "k1"), F.col("id") == F.col("k1"))
                 .join(named, F.col("part") == F.col("k3")).select(F.col("key").alias("k"), "n", "component"))
    by_row = found.select("id", "key").join(of_vector, F.col("key") == F.col("k")).select("id", "n", "component")
    alone = found.where("key is null").select("id", F.lit(1).cast("long").alias("n"), F.col("id").alias("component"))
    return (by_row.union(alone)
            .select(F.col("id").alias(id_col), (F.col("n") - 1).alias("n_links"), F.col("component").alias("component_id"),
                    F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept")))
