"""Approximate nearest neighbours by shifted space-filling curves.

Nearness is the largest inner product. Vectors are projected to a few
dimensions, shifted, and ordered along a Hilbert curve, once per curve with a
projection and shift of its own. The orderings are range-partitioned and
numbered; a query meets the rows up to ``W`` places before and after its own
place on every curve, their windows are merged and ranked by the exact inner
product of the original vectors.

Fit (bounded): mean and main directions come from ``SAMPLE`` vectors at most.
``W`` is measured, not fixed: ``PROBES`` queries are compared with all rows,
and W is the distance along the best curve within which the share ``recall``
of their true neighbours lies. So W follows the data: some hundred rows where
vectors cluster, a good part of the table where directions are uniform and no
order can keep neighbours together. Every row is indexed, and W is no cap: with
``recall=1.0`` it covers all neighbours of the probes.

Norms may differ: candidates get one more component, sqrt(largest norm^2 -
norm^2), queries a zero there, so that the largest inner product is the
smallest distance.

Scale. Equal vectors are one candidate with its ``k + 1`` smallest ids (no
more can be in any answer) and one query, so copies cost nothing. Places are cut into
blocks of ``block`` candidates and, for queries, ``_WIDE`` times that; every
pair of blocks within W is joined by a task of its own, which holds one block
of each side and returns k + 1 vectors a query. Dense or repeated
keys can't make a block larger, as blocks are numbers of rows, not key ranges.

Result: (query_id, rank, vec_id, score) for rows whose id is divisible by
``every``: up to k other rows, nearest first, ties to the smaller id. Rows
without an id or whose vector is null, empty, zero or has null or non-finite
components take no part; vectors of other lengths are searched among
themselves, one index per length. Rows that repeat an id are rows of their own (each a
query and a candidate, its own row left out once). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emporium.llm.common import cut, importable, spent

K = 20
EVERY = 20
CURVES = 4
DIMS = 4          # of a curve
BITS = 15         # of a curve's coordinate
MAIN = 16         # main directions that are mixed into a curve's
SAMPLE = 4096
PROBES = 64
RECALL = 0.95
BLOCK = 8192
_WIDE = 4
_TOGETHER = 64    # queries scored at once
_RESULT = "query_id long, rank int, vec_id long, score double"


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of integer points below 2^bits (one
    point a row, columns x bits up to 63): undoes the reflections and exchanges of
    every level, from the coarsest on, then reads bits across columns."""
    x, one = x.astype(np.uint64), np.uint64(1)
    columns = [x[:, i].copy() for i in range(x.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for c in columns:
            up = (c & bit) != 0
            swap = np.where(up, np.uint64(0), (columns[0] ^ c) & low)
            columns[0] ^= np.where(up, low, swap)
            if c is not columns[0]:
                c ^= swap
    for a, b in zip(columns, columns[1:]):
        b ^= a
    flip = np.zeros(len(x), np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((columns[-1] & np.uint64(1 << level)) != 0, np.uint64((1 << level) - 1), np.uint64(0))
    key = np.zeros(len(x), np.uint64)
    for level in range(bits - 1, -1, -1):
        for c in columns:
            key = (key << one) | (((c ^ flip) >> np.uint64(level)) & one)
    return key.astype(np.int64)


class Curves:
    """Projections and shifts fitted to a sample of vectors of one length."""

    def __init__(self, sample: np.ndarray, largest: float, curves: int = CURVES, dims: int = DIMS):
        self.largest, self.bits, self.curves = largest, BITS, curves
        x = self.lifted(sample, False)
        self.mean = x.mean(0)
        _, _, directions = np.linalg.svd(x - self.mean, full_matrices=False)
        main = directions[:MAIN]
        rng = np.random.default_rng(12)
        self.axes = [main.T @ np.linalg.qr(rng.normal(size=(len(main), len(main))))[0][:, :dims] for _ in range(curves)]
        spread = np.concatenate([np.abs((x - self.mean) @ a).max(0) for a in self.axes])
        self.half = max(float(spread.max()), 1e-300) * 1.5

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit scale, with the component that evens out norms."""
        rest = np.zeros(len(x)) if query else np.maximum(self.largest ** 2 - (x * x).sum(1), 0)
        return np.hstack([x, np.sqrt(rest)[:, None]]) / self.largest

    def keys(self, x: np.ndarray, query: bool) -> list[np.ndarray]:
        """The keys of the vectors on every curve; the shift is a part of the
        doubled range that differs by curve."""
        y, top = self.lifted(x, query) - self.mean, (1 << self.bits) - 1
        out = []
        for c, a in enumerate(self.axes):
            place = ((y @ a) / self.half + 1) / 4 + c / (2 * self.curves)
            out.append(hilbert(np.clip(place * top, 0, top).astype(np.uint64), self.bits))
        return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


def identified(rows: DataFrame) -> DataFrame:
    """(id, vec) -> (id, dim, digest, norm, vec) of the usable rows."""
    importable(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, vec in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or not vec or any(x is None for x in vec):
                    continue
                v = np.array(vec, float) + 0.0  # -0.0 is 0.0
                if np.isfinite(v).all() and v.any():
                    out.append((i, len(v), xxhash.xxh128_digest(v.tobytes()), float(np.sqrt((v * v).sum())), v))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.list_(pa.float64())))],
                    names=["id", "dim", "digest", "norm", "vec"])

    return rows.mapInArrow(run, "id long, dim int, digest binary, norm double, vec array<double>")


def nearest(q: np.ndarray, c: np.ndarray, first: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row of q the k rows of c of the largest inner product (ties:
    smaller ``first``), and these, summed in one order wherever it is done."""
    size = np.sqrt((q * q).sum(1)) * np.sqrt((c * c).sum(1).max(initial=0.0))
    for x, s, unsure in zip(q, q @ c.T, size * 1e-12):
        at = np.arange(len(s))
        if len(s) > k:
            at = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k] - unsure)
        score = (c[at] * x).sum(1)
        order = np.lexsort((first[at], -score))[:k]
        yield at[order], score[order]


def _score_cell(t: pa.Table, window: int, k: int) -> pa.Table:
    """The queries of one block against the candidates of another, each with
    what lies within its window: k + 1 distinct vectors a query."""
    kind, place = t.column("kind").to_numpy(), t.column("place").to_numpy()
    by_place = lambda which: (at := np.flatnonzero(kind == which))[np.argsort(place[at], kind="stable")]
    q, c = by_place(1), by_place(0)
    digests, scores, found, ids = [], [], [], []
    if len(q) and len(c):
        vec = _matrix(t.column("vec"))
        x, y, there = vec[q], vec[c], place[c]
        names, ids_of = t.column("digest").take(pa.array(q)).to_pylist(), t.column("ids").take(pa.array(c))
        digest_of, first = t.column("digest").take(pa.array(c)), ids_of.combine_chunks()
        first = first.values.to_numpy()[first.offsets.to_numpy()[:-1]]
        for low in range(0, len(q), _TOGETHER):
            high = min(low + _TOGETHER, len(q))
            a, b = np.searchsorted(there, (place[q[low]] - window, place[q[high - 1]] + window + 1))
            if a == b:
                continue
            for name, (at, score) in zip(names[low:high], nearest(x[low:high], y[a:b], first[a:b], k + 1)):
                at = pa.array(at + a)
                digests.append(name)
                scores.append(score)
                found.append(digest_of.take(at).to_pylist())
                ids.append(ids_of.take(at).to_pylist())
    return pa.table({"digest": pa.array(digests, pa.binary()), "scores": pa.array(scores, pa.list_(pa.float64())),
                     "found": pa.array(found, pa.list_(pa.binary())), "ids": pa.array(ids, pa.list_(pa.list_(pa.int64())))})


def _merge_query(t: pa.Table, k: int) -> pa.Table:
    """All windows of a query vector: its k + 1 best rows."""
    name = t.column("digest")[0].as_py()
    vectors = {}
    for scores, found, ids in zip(*(t.column(c).to_pylist() for c in ("scores", "found", "ids"))):
        vectors.update(zip(found, zip(scores, ids)))
    best = sorted((-s, i, d == name) for d, (s, all_ids) in vectors.items() for i in all_ids)[:k + 1]
    entry = [{"score": -s, "vec_id": i, "same": same} for s, i, same in best]
    return pa.table({"digest": pa.array([name], pa.binary()),
                     "best": pa.array([entry], pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64()), ("same", pa.bool_())])))})


def places(spark: SparkSession, vectors: DataFrame, curves: Curves) -> DataFrame:
    """(digest, kind, curve, place): kind 0 for candidates, 1 for queries. Places run on
    from curve to curve."""
    importable(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, asked = _matrix(b.column(2)), np.flatnonzero(b.column(1).to_numpy(zero_copy_only=False))
            for kind, at in ((0, np.arange(len(x))), (1, asked)):
                if len(at):
                    for c, key in enumerate(curves.keys(x[at], kind == 1)):
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(np.full(len(at), kind), pa.int32()),
                                                          pa.array(np.full(len(at), c), pa.int32()), pa.array(key, pa.int64())], names=["digest", "kind", "curve", "key"])

    keyed = vectors.select("digest", "asked", "vec").mapInArrow(run, "digest binary, kind int, curve int, key long")
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ("curve", "key", "digest", "kind")
    ranged = (keyed.repartitionByRange(number, *order).sortWithinPartitions(*order)
              .select("digest", "kind", "curve", F.monotonically_increasing_id().alias("at")))
    ranged = cut(spark, ranged, "ranges")
    part = F.shiftright("at", 33)
    rows = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row per partition
    before = rows.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return ranged.withColumn("part", part).join(before, "part").select(
        "digest", "kind", "curve", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("place"))


def fitted_window(spark: SparkSession, vectors: DataFrame, placed: DataFrame, k: int, probes: int, recall: float) -> int:
    """The distance along the nearest curve that holds ``recall`` of the true
    neighbours of some queries; they are compared with all vectors."""
    chosen = vectors.where("asked").orderBy("digest").select("digest", "vec").limit(probes).collect()
    q, names = np.array([r.vec for r in chosen], float), [bytes(r.digest) for r in chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(1).to_pylist()
            for n, (at, score) in zip(names, nearest(q, _matrix(b.column(2)), np.array([i[0] for i in ids]), k + 1)):
                yield pa.RecordBatch.from_arrays([pa.array([n] * len(at), pa.binary()), b.column(0).take(pa.array(at)), pa.array(score)],
                                                 names=["probe", "digest", "score"])

    scored = vectors.select("digest", "ids", "vec").mapInArrow(run, "probe binary, digest binary, score double")
    best = (scored.where("probe <> digest").withColumn("n", F.row_number().over(W.partitionBy("probe").orderBy(F.desc("score"), "digest")))
            .where(F.col("n") <= k).select("probe", F.col("digest").alias("near")))
    own = placed.where("kind = 1").select(F.col("digest").alias("probe"), "curve", F.col("place").alias("own"))
    other = placed.where("kind = 0").select(F.col("digest").alias("near"), "curve", "place")
    wanted = best.join(own, "probe").join(other, ["near", "curve"])
    away = wanted.groupBy("probe", "near").agg(F.min(F.abs(F.col("own") - F.col("place"))).alias("d")).select("d")
    d = np.sort([r.d for r in away.collect()])  # probes x k numbers
    return int(d[min(len(d) - 1, int(np.ceil(recall * len(d))) - 1)]) if len(d) else 0


def _search_length(spark: SparkSession, vectors: DataFrame, k: int, n_curves: int, probes: int, recall: float, block: int) -> DataFrame:
    """(digest, best) of the queries among distinct vectors of one length."""
    n, largest = vectors.agg(F.count("*"), F.max("norm")).first()
    share = min(1.0, SAMPLE / n)
    picked = vectors.where(F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("digest").limit(SAMPLE).select("vec").collect()
    picked = picked or vectors.orderBy("digest").limit(1).select("vec").collect()
    curves = Curves(np.array([r.vec for r in picked], float), largest, n_curves)
    placed = cut(spark, places(spark, vectors, curves), "places")
    window = fitted_window(spark, vectors, placed, k, probes, recall)
    last = placed.agg(F.max("place")).first()[0]
    wide = block * _WIDE
    near = lambda at, own, other: F.explode(F.sequence(
        F.greatest(F.floor((F.floor(at / own) * own - window) / other), F.lit(0)),
        F.least(F.floor((F.floor(at / own) * own + own - 1 + window) / other), F.floor(F.lit(last) / other))))
    at = F.col("place")
    rows = placed.join(vectors.select("digest", "ids", "vec"), "digest")
    cells = (rows.where("kind = 0").select("curve", "digest", "kind", "place", "ids", "vec", F.floor(at / block).alias("i"), near(at, block, wide).alias("j"))
             .union(rows.where("kind = 1").select("curve", "digest", "kind", "place", "ids", "vec", near(at, wide, block).alias("i"), F.floor(at / wide).alias("j"))))
    scored = cut(spark, cells.groupBy("curve", "i", "j").applyInArrow(
        lambda t: _score_cell(t, window, k), "digest binary, scores array<double>, found array<binary>, ids array<array<bigint>>"), "windows")
    return scored.groupBy("digest").applyInArrow(lambda t: _merge_query(t, k), "digest binary, best array<struct<score:double,vec_id:bigint,same:boolean>>")


def search(spark: SparkSession, df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = EVERY, k: int = K,
           curves: int = CURVES, probes: int = PROBES, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score); see the module."""
    rows = cut(spark, identified(df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))), "vectors")
    first = W.partitionBy("digest").orderBy("id")
    distinct = (rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).groupBy("digest")
                .agg(F.first("dim").alias("dim"), F.first("norm").alias("norm"), F.sort_array(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec")))
    queries = rows.where(F.col("id") % every == 0).select("id", "digest")
    asked = queries.select("digest").distinct().withColumn("asked", F.lit(True))
    vectors = cut(spark, distinct.join(asked, "digest", "left").withColumn("asked", F.coalesce("asked", F.lit(False))), "distinct")
    out = spark.createDataFrame([], "digest binary, best array<struct<score:double,vec_id:bigint,same:boolean>>")
    for dim in sorted(r.dim for r in vectors.where("asked").select("dim").distinct().collect()):  # lengths, commonly one
        out = out.union(_search_length(spark, vectors.where(F.col("dim") == dim), k, curves, probes, recall, block))
    best = cut(spark, out, "nearest")
    spent(vectors)
    own = F.array_position(F.transform("best", lambda e: e.same & (e.vec_id == F.col("id"))), F.lit(True))
    others = F.slice(F.filter("best", lambda e, i: (i + 1) != F.col("own")), 1, k)
    return (queries.join(best, "digest").withColumn("own", own).select("id", F.posexplode(others).alias("p", "e"))
            .select(F.col("id").alias("query_id"), (F.col("p") + 1).alias("rank"), "e.vec_id", "e.score"))
