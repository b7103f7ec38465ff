"""SCD2, upsert and versioning invariants."""

import datetime as dt

from pyspark.sql import functions as F

from emporium.operators import partitioned, scd, upsert, versioning
from emporium.plans import registry
from emporium.plans.history import customer_incoming

T1, T2, T3 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1), dt.datetime(2022, 1, 1)
COLS = "customer_unique_id string, customer_id string, customer_city string, customer_state string, " \
       "customer_zip_code_prefix string"


def _batch(spark, rows):
    return customer_incoming(spark.createDataFrame(rows, COLS))


def _current(dim):
    return {r.customer_unique_id: r for r in dim.filter("is_current").collect()}


def test_scd2_lifecycle(spark):
    b1 = _batch(spark, [("u1", "c1", "A", "SP", "1"), ("u2", "c2", "B", "RJ", "2"),
                        ("u3", "c3", "C", "MG", "3"), ("u4", "c4", "D", "BA", "4")])
    # u1 changes, u2 unchanged, u3 changes (and changes back later), u4 missing, u5 new
    b2 = _batch(spark, [("u1", "c1", "A2", "SP", "1"), ("u2", "c2", "B", "RJ", "2"),
                        ("u3", "c3", "C2", "MG", "3"), ("u5", "c5", "E", "PE", "5")])
    b3 = _batch(spark, [("u3", "c3", "C", "MG", "3")])
    h1 = scd.scd2_initial(b1, "customer_unique_id", T1, sk="customer_sk")
    h2 = scd.scd2_apply(h1, b2, "customer_unique_id", "record_hash", T2, sk="customer_sk")
    h3 = scd.scd2_apply(h2, b3, "customer_unique_id", "record_hash", T3, sk="customer_sk")
    rows = h3.collect()
    assert len(rows) == 4 + 3 + 1        # initial + (u1, u3, u5) + u3 back
    cur = _current(h3)
    assert set(cur) == {"u1", "u2", "u3", "u4", "u5"}   # a missing key is not expired
    assert cur["u1"].customer_city == "A2" and cur["u3"].customer_city == "C"
    assert cur["u3"].valid_from == T3 and cur["u4"].valid_from == T1
    # invariants: one current row per key; intervals contiguous and disjoint
    per_key = {}
    for r in rows:
        per_key.setdefault(r.customer_unique_id, []).append(r)
    for versions in per_key.values():
        versions.sort(key=lambda r: r.valid_from)
        assert sum(v.is_current for v in versions) == 1
        for a, b in zip(versions, versions[1:]):
            assert a.valid_to == b.valid_from
    # surrogate keys are unique across loads
    assert len({r.customer_sk for r in rows}) == len(rows)


def test_scd2_idempotent(spark):
    b1 = _batch(spark, [("u1", "c1", "A", "SP", "1")])
    b2 = _batch(spark, [("u1", "c1", "B", "SP", "1")])
    h = scd.scd2_apply(scd.scd2_initial(b1, "customer_unique_id", T1), b2, "customer_unique_id",
                       "record_hash", T2)
    again = scd.scd2_apply(h, b2, "customer_unique_id", "record_hash", T2)
    key = lambda r: (r.customer_unique_id, r.valid_from, r.is_current)
    assert sorted(map(key, h.collect())) == sorted(map(key, again.collect()))


def test_scd2_rejects_null_keys(spark):
    b = _batch(spark, [("u1", "c1", "A", "SP", "1"), (None, "c9", "Z", "SP", "9")])
    h = scd.scd2_initial(b, "customer_unique_id", T1)
    h2 = scd.scd2_apply(h, b, "customer_unique_id", "record_hash", T2)
    assert [r.customer_unique_id for r in h2.collect()] == ["u1"]


def test_scd2_open_end_and_asof(spark):
    far = dt.datetime(9999, 12, 31)
    b1 = _batch(spark, [("u1", "c1", "A", "SP", "1")])
    b2 = _batch(spark, [("u1", "c1", "B", "SP", "1")])
    h = scd.scd2_apply(scd.scd2_initial(b1, "customer_unique_id", T1, open_end=far), b2,
                       "customer_unique_id", "record_hash", T2, open_end=far)
    assert {r.valid_to for r in h.collect()} == {T2, far}
    facts = spark.createDataFrame([("o1", "u1", dt.datetime(2020, 6, 1)), ("o2", "u1", dt.datetime(2021, 6, 1)),
                                   ("o3", "u1", dt.datetime(2019, 6, 1))],
                                  "order_id string, customer_unique_id string, ts timestamp_ntz")
    got = {r.order_id: r.customer_city for r in scd.asof_lookup(facts, h, "customer_unique_id", "ts").collect()}
    assert got == {"o1": "A", "o2": "B", "o3": None}
    prev = scd.scd3_previous(h, "customer_unique_id", ["customer_city"]).collect()
    assert [(r.customer_city, r.previous_customer_city) for r in prev] == [("B", "A")]


def test_upsert_and_changeset(spark):
    schema = "k string, v string, record_hash string"
    target = spark.createDataFrame([("a", "1", "h1"), ("b", "2", "h2"), ("c", "3", "h3")], schema)
    source = spark.createDataFrame([("a", "1", "h1"), ("b", "2x", "h2x"), ("d", "4", "h4"),
                                    (None, "9", "h9"), ("d", "4", "h4")], schema)
    out = {r.k: r.v for r in upsert.upsert(target, source, ["k"]).collect()}
    assert out == {"a": "1", "b": "2x", "c": "3", "d": "4"}
    kinds = {r.k: r.change_type for r in upsert.change_set(target, source, ["k"]).collect()}
    assert kinds == {"a": "unchanged", "b": "update", "c": "target_only", "d": "insert"}
    twice = upsert.upsert(upsert.upsert(target, source, ["k"]), source, ["k"])
    assert {r.k: r.v for r in twice.collect()} == out          # idempotent


def test_versioned_snapshots(spark, tmp_path):
    schema = "k string, v string"
    log = versioning.tag(spark.createDataFrame([("a", "1"), ("b", "2")], schema), 1).unionByName(
        versioning.tag(spark.createDataFrame([("a", "1b")], schema), 2)).unionByName(
        versioning.tag(spark.createDataFrame([("b", None)], schema), 3, deleted=True))
    v = lambda n: {r.k: r.v for r in versioning.snapshot(log, ["k"], n).collect()}
    assert v(1) == {"a": "1", "b": "2"} and v(2) == {"a": "1b", "b": "2"} and v(3) == {"a": "1b"}


def test_versioned_table(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v string, record_hash string")
    path, day = str(tmp_path / "t"), lambda n: dt.datetime(2024, 1, n)
    load = lambda df, n, when: versioning.upsert_version(spark, path, df, ["k"], n, "upsert", when)
    load(rows(("a", "1", "h1"), ("b", "1", "h1")), 1, day(1))
    second = rows(("a", "1", "h1"), ("b", "2", "h2"), ("c", "1", "h1"))
    load(second, 2, day(5))
    load(second, 2, day(5))  # a repeated load overwrites its own version
    versioning.add_version(rows(("a", None, None)), path, 3, "delete", day(9), deleted=True)
    log = versioning.read_log(spark, path)
    at = lambda n: {(r.k, r.v) for r in versioning.snapshot(log, ["k"], n).collect()}
    assert at(1) == {("a", "1"), ("b", "1")} and at(2) == {("a", "1"), ("b", "2"), ("c", "1")} and at(None) == {("b", "2"), ("c", "1")}
    assert [(r.version, r.rows) for r in versioning.history(log).collect()] == [(1, 2), (2, 2), (3, 1)]
    assert [versioning.version_at(log, day(n)) for n in (1, 4, 5, 30)] == [1, 1, 2, 3] and versioning.version_at(log, dt.datetime(2023, 1, 1)) == 0


def _files(path):
    import os
    out = {}
    for d, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.basename(d), set()).add(n)
    return out


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v string, record_hash string, month int")
    path = str(tmp_path / "t")
    old = [(f"k{i}", "1", "h1", 202401 + i % 4) for i in range(20)] + [("n", "1", "h1", None), ("moves", "1", "h1", 202412)]
    partitioned.write_partitions(rows(*old), path, "month", ["k"])
    before = _files(path)
    batch = rows(("k1", "2", "h2", 202402), ("k0", "1", "h1", 202401),          # changed; unchanged
                 ("new", "1", "h1", 202405), ("moves", "2", "h2", 202402),      # a new month; away from a month of its own
                 ("k1", "2", "h2", 202402), (None, "x", "hx", 202403))          # repeated; without a key
    assert partitioned.upsert_partitions(spark, path, batch, ["k"], "month", ["k"]) == [202402, 202405, 202412]
    after = _files(path)
    for month in ("month=202401", "month=202403", "month=202404", "month=__HIVE_DEFAULT_PARTITION__"):
        assert after[month] == before[month]
    assert after["month=202402"].isdisjoint(before["month=202402"])
    want = {r[0]: r for r in old} | {"k1": ("k1", "2", "h2", 202402), "new": ("new", "1", "h1", 202405), "moves": ("moves", "2", "h2", 202402)}
    read = lambda: sorted(map(tuple, partitioned.read_partitions(spark, path, batch).collect()))
    assert read() == sorted(want.values())
    assert partitioned.upsert_partitions(spark, path, batch, ["k"], "month", ["k"]) == [] and _files(path) == after
    assert partitioned.upsert_partitions(spark, path, rows(("n", "2", "h2", None)), ["k"], "month", ["k"]) == [None]
    assert ("n", "2", "h2", None) in partitioned.read_partitions(spark, path, batch).collect() and len(read()) == len(want)


def test_stored_fact_is_read_by_month(spark):
    """The year's revenue scans the months it asks for, from the stored fact itself."""
    fact = registry.lakehouse(spark, "/root/testdata/sf0.001").fact_orders
    assert fact.inputFiles()[0].split("/")[-2].startswith("order_month=")
    plan = fact.filter("order_month > 200012")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_scd2_batches_at_or_before_the_current_version(spark):
    one = lambda v: spark.createDataFrame([("a", v, v)], "customer_unique_id string, city string, record_hash string")
    t = lambda d: dt.datetime(2024, 1, d)
    h = scd.scd2_apply(scd.scd2_initial(one("x"), "customer_unique_id", t(1), sk="customer_sk"), one("y"), "customer_unique_id", "record_hash", t(5), sk="customer_sk")
    same = scd.scd2_apply(h, one("z"), "customer_unique_id", "record_hash", t(5), sk="customer_sk").collect()
    assert sorted((r.city, r.is_current) for r in same) == [("x", False), ("z", True)]
    assert len({r.customer_sk for r in same}) == 2 and all(r.valid_to is None or r.valid_to > r.valid_from for r in same)
    older = scd.scd2_apply(h, one("z"), "customer_unique_id", "record_hash", t(3), sk="customer_sk").collect()
    assert sorted((r.city, r.is_current) for r in older) == [("x", False), ("y", True)]


def test_schema_enforcement(spark):
    import pytest
    from pyspark.sql import types as T
    from emporium.plans.history import enforce
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    ok = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    assert enforce(df, ok).columns == ["k", "n"]
    with pytest.raises(ValueError):
        enforce(df.withColumn("extra", F.lit(1)), ok)
