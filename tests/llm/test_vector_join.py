import math
import random

import numpy as np

from emporium.llm import queries, vector_join

SF = "/root/testdata/sf0.001"


def brute_force(rows):
    good = [(i, lab, np.array(v, float)) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in range(len(good))}
    for a in range(len(good)):
        for b in range(a):
            (_, la, x), (_, lb, y) = good[a], good[b]
            if la == lb and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        least = min(good[n][0] for n in seen)
        out.append((good[k][0], len(links[k]), least, good[k][0] == least))
    n_good = [g[0] for g in good]
    for i, v, lab in rows:
        if i not in n_good:
            out.append((i, 0, i, True))
    return sorted(out, key=str)


def answer(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want = brute_force(rows)
    assert answer(queries.op9_vector_join(spark, "/root/testdata/sf0.01")) == want
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    # any number of pivots and any block size give the same links
    for how in ({"cell": 10, "block": 7}, {"max_pivots": 1, "block": 50}, {"cell": 3}):
        assert answer(vector_join.near_duplicates(spark, df, **how)) == want


def test_border_replication_loses_nothing():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    p, eps = x[:20], 0.2
    row, cell, home = vector_join.cells_of(x, p, eps)
    at = {(r, c) for r, c in zip(row, cell)}
    own = dict(zip(row[home], cell[home]))
    a, b = np.nonzero(np.linalg.norm(x[:, None] - x[None], axis=2) <= eps)
    assert all((j, own[i]) in at for i, j in zip(a, b)) and len(at) < 0.7 * 600 * 20


def test_odd_rows(spark):
    rng = random.Random(1)
    v = [rng.random() for _ in range(8)]
    rows = [(1, v, 1), (2, v, 1), (3, [2 * x for x in v], 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [0.0] * 8, 1), (8, [float("nan")] + v[1:], 1),
            (9, [None] + v[1:], 1), (10, [float("inf")] + v[1:], 1), (11, [], 1), (12, v[:4], 1), (13, v, 2), (13, v, 2), (None, v, 1)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, label int, id string, n int")
    assert answer(vector_join.near_duplicates(spark, df)) == sorted(
        [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 2, 4, True), (13, 2, 4, False), (13, 2, 4, False), (None, 0, None, True)]
        + [(i, 0, i, True) for i in (5, 6, 7, 8, 9, 10, 11, 12)], key=str)
    assert vector_join.near_duplicates(spark, df.limit(0)).count() == 0


def test_repeated_id_keeps_rows_without_a_usable_vector(spark):
    """One row per vector, also where an id has a null or zero vector beside a valid one."""
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, None, 0), (2, [0.0, 0.0], 0), (3, None, 0), (None, [1.0, 0.0], 0), (None, None, None)],
                               "vec_id long, embedding array<double>, label long")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_join.near_duplicates(spark, df).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (2, 1, 1, False), (2, 0, 2, True), (2, 0, 2, True), (3, 0, 3, True), (None, 0, None, True), (None, 0, None, True)], key=str)


def test_repeated_ids_do_not_link_other_vectors(spark):
    """Rows of one id are vectors of their own: neither links nor components pass from one to the other."""
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.001], 0), (3, [0.001, 1.0], 0), (4, [3.0, 4.0], 0), (4, [3.0, 4.0], 1), (5, [3.0, 4.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert answer(vector_join.near_duplicates(spark, df)) == sorted(
        [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 1, 4, True), (4, 0, 4, True), (5, 1, 4, False)], key=str)
