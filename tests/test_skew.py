"""Hot keys: one key holds a third of the rows. Results are checked against
brute force and the plans must reduce the hot key before the shuffle."""

import random

from pyspark.sql import functions as F

from emporium.operators.dedup import keep_first
from emporium.operators.topk import top_n_per_group
from emporium.plans.marts import primary_products


def _skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(200)}"
        rows.append((key, rnd.randrange(50), f"p{rnd.randrange(1000):04d}", rnd.randrange(10**6)))
    return rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_hot_key(spark):
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "k string, item int, product string, v long").repartition(8)
    got = {(r.k, r.item): (r.product, r.v) for r in keep_first(df, ["k", "item"], ["product"]).collect()}
    want = {}
    for k, item, product, v in rows:
        cur = want.get((k, item))
        if cur is None or (product, v) < cur:
            want[(k, item)] = (product, v)
    assert got == want
    plan = _plan(keep_first(df, ["k"], ["product"]))
    assert "partial_min" in plan            # reduced per task before the exchange


def test_primary_product_hot_order(spark):
    rows = [("hot", i, f"p{(i * 37) % 101}") for i in range(1, 2001)] + \
           [(f"o{j}", i, f"p{j + i}") for j in range(500) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "order_id string, order_item_id int, product_id string").repartition(8)
    got = {r.order_id: r.primary_product_id for r in primary_products(df).collect()}
    assert got["hot"] == "p37" and got["o3"] == "p4" and len(got) == 501


def test_top_n_per_group_matches_brute_force(spark):
    rows = _skewed_rows(5000, seed=11)
    df = spark.createDataFrame(rows, "k string, item int, product string, v long")
    agg = df.groupBy("k", "product").agg(F.sum("v").alias("rev"))
    got = {(r.k, r.rank): (r.product, r.rev) for r in top_n_per_group(
        agg, ["k"], [F.desc("rev"), F.col("product")], 5).collect()}
    sums = {}
    for k, _, product, v in rows:
        sums[(k, product)] = sums.get((k, product), 0) + v
    want = {}
    for k in {k for k, _ in sums}:
        ranked = sorted(((-rev, p) for (kk, p), rev in sums.items() if kk == k))[:5]
        for i, (neg, p) in enumerate(ranked, 1):
            want[(k, i)] = (p, -neg)
    assert got == want
