"""Landing -> Bronze ingest, latest landing, windows, clustering."""

import datetime as dt

from pyspark.sql import functions as F

from emporium.sources import ingest as I


def test_ingest_latest_and_rerun(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("1", " a "), ("2", None)], "id string, v string")
    I.land_csv(df, f"{root}/landing/d1/x.csv")
    I.land_csv(df.filter("id = '1'"), f"{root}/landing/d2/x.csv")
    cfg = [{"sourceFileName": "x.csv", "sinkFolder": "x", "description": "x"},
           {"sourceFileName": "missing.csv", "sinkFolder": "y", "description": "absent source"}]
    I.write_config(spark, cfg[:1], f"{root}/cfg")
    assert I.ingest(spark, f"{root}/cfg", f"{root}/landing/d1", f"{root}/bronze", "2024-01-01",
                    columns={"x": ["id", "v"]}) == ["x"]
    I.ingest(spark, f"{root}/cfg", f"{root}/landing/d2", f"{root}/bronze", "2024-01-02", columns={"x": ["id", "v"]})
    # re-running a day replaces only that day's partition
    I.ingest(spark, f"{root}/cfg", f"{root}/landing/d2", f"{root}/bronze", "2024-01-02", columns={"x": ["id", "v"]})
    assert I.read_bronze(spark, f"{root}/bronze", "x").count() == 3
    latest = I.read_bronze(spark, f"{root}/bronze", "x", latest=True).collect()
    assert [(r.id, r.ingest_date) for r in latest] == [("1", dt.date(2024, 1, 2))]
    # a failing copy is retried, then raised
    I.write_config(spark, cfg[1:], f"{root}/cfg2")
    import pytest
    with pytest.raises(Exception):
        I.ingest(spark, f"{root}/cfg2", f"{root}/landing/d1", f"{root}/bronze", "2024-01-01",
                 retries=1, backoff_s=0.0)


def test_windows_are_idempotent(spark, tmp_path):
    out = str(tmp_path / "w")
    df = spark.createDataFrame([(i, dt.datetime(2020, 1 + i % 3, 1 + i % 27)) for i in range(60)],
                               "id int, ts timestamp_ntz")
    I.backfill(df, "ts", "month", out, key="id")
    before = {r.window_start: r.n for r in spark.read.parquet(out).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    I.process_window(df, "ts", dt.datetime(2020, 2, 1), dt.datetime(2020, 3, 1), out)
    after = {r.window_start: r.n for r in spark.read.parquet(out).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert before == after and sum(after.values()) == 60 and len(after) == 3


def test_cluster_gives_narrow_file_ranges(spark, tmp_path):
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 20000).alias("k"), F.col("id").alias("v"))
    back = I.cluster(df, ["k"], str(tmp_path / "c"), files=4)
    assert back.count() == 20000
    ranges = sorted((r.min_key, r.max_key) for r in I.file_ranges(back, "k").collect())
    assert len(ranges) == 4
    for (_, hi), (lo, _) in zip(ranges, ranges[1:]):
        assert hi < lo            # disjoint key ranges per file


def test_marts_from_ingested_landings(spark, tmp_path):
    """The README path: CSV landings -> ingest -> Silver via a Bronze reader -> Gold -> mart."""
    from conftest import SF_SMALL
    from emporium.plans import marts, registry
    from emporium.plans.gold import Gold
    from emporium.plans.landing import LANDED, _columns
    from emporium.plans.silver import Silver
    from emporium.sources.bronze import bronze
    root = str(tmp_path)
    for e in LANDED:
        I.land_csv(bronze(spark, SF_SMALL, e), f"{root}/landing/{e}.csv")
    I.write_config(spark, [{"sourceFileName": f"{e}.csv", "sinkFolder": e, "description": e} for e in LANDED],
                   f"{root}/cfg")
    I.ingest(spark, f"{root}/cfg", f"{root}/landing", f"{root}/bronze", "2024-06-01",
             columns={e: _columns(e) for e in LANDED})
    silver = Silver(spark, f"{root}/bronze",
                    raw_reader=lambda e: I.read_bronze(spark, f"{root}/bronze", e, latest=True))
    g = Gold(spark, f"{root}/bronze", silver=silver)
    got = marts.daily_revenue(g.fact_orders, g.dim_date)
    want = registry.QUERIES["daily_revenue"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    # the customer dimension comes from the landed customers, the next load is applied to its history
    people = silver.customers.select("customer_unique_id").where("customer_unique_id IS NOT NULL").distinct().count()
    first = g.dim_customers
    assert first.count() == first.where("is_current").count() == people
    again = Gold(spark, f"{root}/bronze", silver=silver, customer_history=first)
    assert again.dim_customers.count() == people
    assert set(g.register_views()) == set(g.DIMENSIONS + g.FACTS)
    g.build_all()


def test_zorder_narrows_both_columns_and_merges_files(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "CASE WHEN id % 50 = 0 THEN NULL ELSE cast(pmod(xxhash64(id, 1), 5000) as int) END AS a",
                                          "concat('c', lpad(pmod(xxhash64(id, 2), 7000), 4, '0')) AS b")
    rows.repartition(37).write.parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    size = I.stored_bytes(stored)
    z = I.zorder(stored, ["a", "b"], str(tmp_path / "z"), target_bytes=size // 16)
    assert 12 <= len(z.inputFiles()) <= 18 < len(stored.inputFiles())
    assert sorted(map(str, z.collect())) == sorted(map(str, rows.collect()))
    one = I.zorder(stored, ["a", "b"], str(tmp_path / "one"))
    assert len(one.inputFiles()) == 1 and one.count() == 20_000

    def share(df, c):  # mean part of the values' range that a file covers
        r = [(int(str(x.min_key).lstrip("c")), int(str(x.max_key).lstrip("c"))) for x in I.file_ranges(df, c).collect()]
        return sum(hi - lo for lo, hi in r) / len(r) / (max(hi for _, hi in r) - min(lo for lo, _ in r))

    linear = I.cluster(stored, ["a", "b"], str(tmp_path / "linear"), files=16)
    assert share(z, "a") < 0.55 and share(z, "b") < 0.55 and share(linear, "b") > 0.95
