"""Centroid clustering with norm-of-sum (ns) bounds.

Exact rounds of assignment and update on integer vectors, with the centroids
of all rounds kept. For every vector and centroid j the state holds the last
computed distance and the round it was computed in. Later, the distance can
have changed by at most the norm of j's total displacement since that round,
``|c_j(now) - c_j(then)|`` (not the sum of the drifts of each round, which is
never smaller). A vector keeps its cluster without any distance computed if
the loosened distance to its own centroid stays below all other loosened
ones. Otherwise the own distance is computed, and, if the test still fails,
the distances to the centroids whose bound does not exclude them: those are
exact integers, ties go to the smaller number. Stored bounds are rounded
outwards, so an excluded centroid is strictly farther.

Each round is one map over the stored state and one grouping of 16 rows of
sums (combined before the shuffle); a state folder is emptied once its
successor is written. The history is rounds x clusters x components numbers,
whatever the size of the table, and travels with the task.

Rows whose vector is null, has another number of components, or holds null or
non-finite ones are left out. Components of 2^20 or more in magnitude raise an
error, as squared distances would not fit a long. Seeds are the rows with the
smallest sha256 of ``1:<id>`` (a null id: ``1:``; equal hashes: the smaller
vector first), so repeated rows may seed several equal centroids, of which the
smaller number gets all; fewer rows than clusters give fewer centroids, and no
rows an empty result. Repeated ids and equal vectors are rows of their own;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import cut, importable, spent

CLUSTERS = 16
ROUNDS = 3
DIM = 64
SCALE = 64
_LARGEST = float(2 ** 20)
_WIDER = 1 + 1e-9


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, dim: int = DIM) -> DataFrame:
    """(id, vec): components as floor(64 x)."""
    x = F.col(vec_col).cast("array<double>")
    usable = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.when(F.abs(v) < _LARGEST, F.floor(v * SCALE)).otherwise(
        F.raise_error(F.lit("a component is too large for distances of type long"))).cast("int"))
    return df.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).alias("id"), whole.alias("vec"))


def seeds(rows: DataFrame, clusters: int) -> np.ndarray:
    """The vectors of the smallest hashes, as many as there are at most."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(key.alias("key"), "vec").orderBy("key", "vec").limit(clusters).collect()
    return np.array([r.vec for r in first], np.int64)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x and rows of c, pair by pair."""
    d = x - c
    return np.einsum("nd,nd->n", d, d)


def reassign(x: np.ndarray, cluster: np.ndarray | None, known: np.ndarray | None, at: np.ndarray | None,
             history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest centroids of the last round for integer vectors x, from the
    last computed distances ``known`` (rounded to float32) and the rounds
    ``at`` they are of: (cluster, known, at, number of distances computed)."""
    n, now, centroids = len(x), len(history) - 1, history[-1]
    k = len(centroids)
    if cluster is None:
        d = np.stack([_distances(x, c[None, :]) for c in centroids], 1) if n else np.zeros((0, k), np.int64)
        return d.argmin(1).astype(np.int32), np.sqrt(d).astype(np.float32), np.full((n, k), now, np.int8), n * k
    moved = np.stack([np.sqrt(((centroids - c).astype(float) ** 2).sum(1)) for c in history]) * _WIDER
    rows, columns = np.arange(n), np.arange(k)
    cluster, known, at = cluster.copy(), known.copy(), at.copy()
    drift = moved[at, columns[None, :]]
    below = np.nextafter(known, np.float32(-np.inf)).astype(float) - drift
    below[rows, cluster] = np.inf
    above = np.nextafter(known[rows, cluster], np.float32(np.inf)).astype(float) + drift[rows, cluster]
    fails = np.flatnonzero(below.min(1, initial=np.inf) <= above)
    computed = len(fails)
    own = _distances(x[fails], centroids[cluster[fails]])
    exact = np.sqrt(own)
    known[fails, cluster[fails]], at[fails, cluster[fails]] = exact, now
    still = below[fails].min(1, initial=np.inf) <= exact * _WIDER
    fails, own, limit = fails[still], own[still], exact[still] * _WIDER
    best, least = cluster[fails].copy(), own.copy()
    for j in range(k):
        near = np.flatnonzero(below[fails, j] <= limit)  # never the own one, whose entry is infinite
        if not len(near):
            continue
        r = fails[near]
        d = _distances(x[r], centroids[j][None, :])
        computed += len(r)
        known[r, j], at[r, j] = np.sqrt(d), now
        better = (d < least[near]) | ((d == least[near]) & (j < best[near]))
        best[near[better]], least[near[better]] = j, d[better]
    cluster[fails] = best
    return cluster, known, at, computed


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(values.reshape(-1), kind))


def _flat(column: pa.Array, k: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, k)


def assigned(state: DataFrame, history: list[np.ndarray], final: bool = False) -> DataFrame:
    """The state after one more assignment; ``final``: (id, cluster, distance)."""
    importable(state.sparkSession)
    first, k, dim = "cluster" not in state.columns, len(history[-1]), history[-1].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _flat(b.column(1), dim, np.int64)
            old = (None, None, None) if first else (b.column(2).to_numpy(), _flat(b.column(3), k, np.float32), _flat(b.column(4), k, np.int8))
            cluster, known, at, _ = reassign(x, *old, history)
            if final:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), pa.array(_distances(x, history[-1][cluster]), pa.int64())],
                                                 names=["id", "cluster", "distance"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cluster, pa.int32()), _lists(known, pa.float32()),
                                                  _lists(at, pa.int8())], names=["id", "vec", "cluster", "known", "at"])

    kind = state.schema["id"].dataType.simpleString()
    return state.mapInArrow(run, f"id {kind}, cluster int, distance long" if final
                            else f"id {kind}, vec array<int>, cluster int, known array<float>, at array<tinyint>")


def updated(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floor of the mean of every cluster; an empty one stays."""
    dim = centroids.shape[1]
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.get("vec", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(dim)])
    out = centroids.copy()
    for r in sums.collect():  # a row per cluster
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(dim)]
    return out


def cluster_vectors(spark: SparkSession, df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every usable vector; see the module."""
    rows = integer_vectors(df, id_col, vec_col, dim)
    start = seeds(rows, clusters)
    if not len(start):
        return (rows.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
                            F.lit("").alias("centroid_sha256")).where("false"))
    history, state = [start], rows
    for i in range(rounds):
        after = cut(spark, assigned(state, history), f"assigned-{i}")
        if i:
            spent(state)
        state = after
        history.append(updated(state, history[-1]))
    found = cut(spark, assigned(state, history, final=True), "clusters")
    if rounds:
        spent(state)
    per_cluster = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # a row per cluster
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in history[-1]]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return found.select(
        F.col("id").alias(id_col), "cluster", "distance", of([per_cluster.get(j, 0) for j in range(len(start))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(per_cluster.values())).cast("long").alias("inertia"), of(digests).alias("centroid_sha256"))


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM) -> str:
    """The clustering of ``embeddings`` by plain exact rounds."""
    parts = [f"""rows AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT sha256('1:' || vec_id) AS h, v FROM rows ORDER BY h, v LIMIT {clusters}))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT rid, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT rid, k, CAST(list_sum(list_transform(range(1, {dim + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS d FROM rows, c{i}) GROUP BY rid)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM (SELECT k, i, sum(v[i]) AS s, count(*) AS n FROM rows JOIN a{i} USING (rid), range(1, {dim + 1}) AS r(i) GROUP BY k, i) GROUP BY k) USING (k))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM rows JOIN a{rounds} USING (rid) JOIN c{rounds} USING (k)"""


SQL = _sql()
