"""Centroid clustering, nearest neighbours and source divergence against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from emporium.llm import hilbert_search, ns_kmeans, queries, source_divergence

SF = "/root/testdata/sf0.001"


def lloyd(rows, clusters, rounds, dim):
    """(id, cluster, distance) by plain rounds over Python integers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:clusters]
    c = [v for _, v in seeds]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(c))
    for _ in range(rounds):
        by = defaultdict(list)
        for _, v in kept:
            by[near(v)[1]].append(v)
        c = [[sum(x) // len(by[k]) for x in zip(*by[k])] if k in by else m for k, m in enumerate(c)]
    out = [(i, near(v)[1], near(v)[0], hashlib.sha256(",".join(map(str, c[near(v)[1]])).encode()).hexdigest()) for i, v in kept]
    total, per = sum(r[2] for r in out), Counter()
    for r in out:
        per[r[1]] += r[2]
    return sorted(((i, k, d, per[k], total, h) for i, k, d, h in out), key=str)


def clustered(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=str)


def test_clusters_equal_plain_rounds(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert clustered(queries.op11_ns_kmeans(spark, SF)) == lloyd(rows, 16, 3, 64)


def test_clusters_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(120)]  # ties and repeated vectors
    rows += rows[:10] + [(None, [1.0, 0.0, 0.0, 0.0]), (900, None), (901, []), (902, [1.0, None, 0.0, 0.0]), (903, [math.nan, 0.0, 0.0, 0.0]),
                         (904, [math.inf, 0.0, 0.0, 0.0]), (905, [1.0]), (906, [0.0] * 4), (907, [-0.01, 1e-9, -1e-9, 3.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, cluster int, distance int")
    for clusters, rounds in ((7, 5), (16, 0), (400, 2)):
        assert clustered(ns_kmeans.cluster_vectors(spark, df, clusters=clusters, rounds=rounds, dim=4)) == lloyd(rows, clusters, rounds, 4)
    assert ns_kmeans.cluster_vectors(spark, df.limit(0)).collect() == []
    assert ns_kmeans.cluster_vectors(spark, df.limit(0)).columns == ns_kmeans.cluster_vectors(spark, df, dim=4).columns
    with pytest.raises(Exception, match="too large"):
        ns_kmeans.cluster_vectors(spark, spark.createDataFrame([(1, [1e7])], "vec_id long, embedding array<double>"), dim=1).collect()


def test_bounds_save_distances_and_never_lie():
    rng = np.random.default_rng(5)
    middles = rng.integers(-300, 300, (12, 16))
    x = np.concatenate([m + rng.integers(-40, 40, (200, 16)) for m in middles])
    history, state, computed, summed = [x[::200][:12].copy()], (None, None, None), [], 0
    for _ in range(8):
        *state, n = ns_kmeans.reassign(x, *state, history)
        computed.append(n)
        d = ((x[:, None] - history[-1][None]) ** 2).sum(2)
        assert (state[0] == d.argmin(1)).all()
        exact = np.sqrt(((x[:, None] - np.stack(history)[state[2], np.arange(12)]) ** 2).sum(2))
        assert np.allclose(state[1], exact, rtol=1e-6)  # what is stored is the distance at the round it is said to be of
        history.append(np.array([x[state[0] == k].sum(0) // max(1, (state[0] == k).sum()) if (state[0] == k).any() else history[-1][k] for k in range(12)]))
    assert computed[0] == len(x) * 12 and sum(computed[1:]) < 0.3 * 7 * len(x) * 12
    steps = [np.linalg.norm(b - a, axis=1) for a, b in zip(history, history[1:])]
    assert (np.linalg.norm(history[-1] - history[0], axis=1) <= sum(steps) + 1e-9).all()


def test_hilbert_keys_visit_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = hilbert_search.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def true_neighbours(rows, every, k):
    good = [(i, tuple(float(x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, v) in enumerate(good):
        if i % every == 0:
            others = sorted((-float((np.array(v) * np.array(w)).sum()), j) for m, (j, w) in enumerate(good) if m != n and len(v) == len(w))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(others)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def recall(got, want):
    return len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) / len(want)


def test_search_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got, want = found(queries.op12_hilbert_search(spark, "/root/testdata/sf0.01")), true_neighbours(rows, 20, 20)
    assert len(got) == len(want) and recall(got, want) >= 0.9


def test_search_in_small_windows(spark):
    """Clustered vectors of unequal norms: the fitted window is a small part of the table, blocks are many."""
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(60, 24)) * 3
    x = np.concatenate([m + 0.2 * rng.normal(size=(50, 24)) for m in middles])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen, fit = [], hilbert_search.fitted_window
    hilbert_search.fitted_window = lambda *a: seen.append(fit(*a)) or seen[-1]
    try:
        got = found(hilbert_search.search(spark, df, every=10, k=10, block=128))
    finally:
        hilbert_search.fitted_window = fit
    want = true_neighbours(rows, 10, 10)
    assert len(got) == len(want) and recall(got, want) >= 0.9 and seen[0] < len(rows) / 4


def test_search_of_odd_rows(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)] + [(i, [1.0, 2.0, 2.0]) for i in range(100, 150)]  # fifty copies
    rows += [(0, rows[0][1]), (0, [9.0, 9.0, 9.0]), (20, None), (40, []), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 1.0]), (200, [math.nan, 1.0, 1.0]),
             (220, [math.inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (240, [1.0, 1.0]), (241, [1.0, 3.0]), (260, [5.0])]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, score double, rank int")
    rounded = lambda found_: [(q, r, v, round(s, 9)) for q, r, v, s in found_]
    assert rounded(found(hilbert_search.search(spark, df, recall=1.0))) == rounded(true_neighbours(rows, 20, 20))
    assert found(hilbert_search.search(spark, df.limit(0))) == []


def divergence(rows, least_docs=10, top=10):
    words = [(la or "", so or "", [re.sub("[A-Z]+", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]) for t, la, so in rows]
    docs, counts, groups = Counter(), Counter(), {(la, so) for la, so, _ in words}
    for la, so, ws in words:
        docs.update((la, w) for w in set(ws))
        counts.update((la, so, w) for w in ws)
    out = []
    for lang in {la for la, _ in groups}:
        kept = sorted(w for (la, w), n in docs.items() if la == lang and n >= least_docs)
        sources = sorted(so for la, so in groups if la == lang)
        n = {s: sum(counts[lang, s, w] for w in kept) for s in sources}
        p = {(s, w): 1 + 10 ** 9 * (counts[lang, s, w] + 2) // (n[s] + 2 * len(kept)) for s in sources for w in kept}
        q = {w: 1 + 10 ** 9 * (sum(counts[lang, s, w] for s in sources) + 2) // (sum(n.values()) + 2 * len(kept)) for w in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = sorted((-sum(f(p[s, w], p[t, w]) for w in kept), t.encode(), t) for t in sources if t != s)
            term = sorted((-f(p[s, w], q[w]), w.encode(), w) for w in kept if counts[lang, s, w] and p[s, w] > q[w])[:top]
            out += [(lang, s, part, i, -v, r + 1) for part, found_ in (("pair", pair), ("term", term)) for r, (v, _, i) in enumerate(found_)]
    return sorted(out)


def audited(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def test_divergence_equals_brute_force(spark):
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert audited(queries.op13_source_divergence(spark, SF)) == divergence(rows)


def test_divergence_of_odd_rows(spark):
    rows = [("Ärger Äpfel a1b-c", "de", "x"), ("ÄRGER zz zz", "de", "y"), (None, "de", "z"), ("", None, None), ("only", "fr", None), ("only", "fr", ""),
            ("   em—dash", "xx", "s"), ("w " * 50_000 + "tail", "en", "long"), ("w w", "en", "b"), ("w w", "en", "b"), ("v tail", "en", "c")]
    rows += [("Zebra zebra éé \U0001f600 " + "q" * n, "en", f"s{n % 4}") for n in range(30)]
    df = spark.createDataFrame([(*r, "en", 3) for r in rows], "text string, lang string, source string, part string, value int")
    for least, block in ((1, 7), (2, 800_000), (10, 100)):
        assert audited(source_divergence.divergence(spark, df, least_docs=least, block=block)) == divergence(rows, least)
    assert audited(source_divergence.divergence(spark, df.limit(0))) == []


def test_divergence_beyond_32_bits():
    """Shares of counts whose products pass 2^63."""
    count = source_divergence._integers([10 ** 13, 5])
    total = source_divergence._integers([3 * 10 ** 13, 10 ** 12])
    assert source_divergence.share(count, total, 7).tolist() == [1 + 10 ** 9 * (c + 2) // (t + 14) for c, t in ((10 ** 13, 3 * 10 ** 13), (5, 10 ** 12))]


@pytest.mark.parametrize("name,table", [("op11_ns_kmeans", "embeddings"), ("op13_source_divergence", "documents")])
def test_oracles(spark, name, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.fetchall())
