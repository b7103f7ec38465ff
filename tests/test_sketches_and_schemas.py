"""Mergeable distinct sketches (T6, T15) and the schema registry (M7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emporium.operators import schema_registry
from emporium.plans import registry
from emporium.session import run_folder
from emporium.streaming import clickstream as CS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def clicks(spark):
    return registry._clicks(spark, SF)


def test_united_minutes_equal_the_exact_windows(spark, clicks):
    got = {(r.window_start, r.window_end): r.active_users
           for r in CS.distinct_of_minutes(CS.stored_minutes(spark, clicks)).where("grain = '5 minutes'").collect()}
    assert got == {(r.window_start, r.window_end): r.active_users for r in CS.active_users(clicks).collect()}


def test_small_sketches_stay_within_their_error_bound(clicks):
    bits = 6
    exact = {r.d: r for r in clicks.groupBy(F.date_trunc("day", "event_ts").cast("timestamp_ntz").alias("d"))
             .agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("events")).collect()}
    rows = CS.distinct_of_minutes(CS.minute_sketches(clicks, bits), bits).where("grain = 'day'").collect()
    assert len(rows) == len(exact) and any(exact[r.window_start].users > 2 ** bits for r in rows)
    error = [abs(r.active_users - exact[r.window_start].users) / exact[r.window_start].users for r in rows]
    assert max(error) <= 4 / 2 ** (bits / 2) and all(r.events == exact[r.window_start].events for r in rows)


def test_sketches_of_empty_and_null(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), None, None)], "event_ts timestamp_ntz, user_id string, session_id string")
    rows = CS.distinct_of_minutes(CS.minute_sketches(df)).collect()
    assert {r.grain for r in rows} == {"5 minutes", "day"} and {(r.active_users, r.events) for r in rows} == {(0, 1)}
    assert CS.distinct_of_minutes(CS.minute_sketches(df.limit(0))).count() == 0


def test_registry_accepts_additions_and_names_what_it_refuses(spark):
    folder = run_folder(spark, "schema-test")
    load = lambda df, n: schema_registry.load(spark, f"{folder}/r", f"{folder}/t", df, n)
    assert schema_registry.newest(spark, f"{folder}/r")[0] == 0
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2.5, "y", 2)], "w double, V string, K int")   # other order and case, a column more
    assert load(a, 1) == schema_registry.Outcome(1, True, 1, "", "")
    assert load(b, 2) == schema_registry.Outcome(2, True, 2, "w", "")
    assert load(a, 3) == schema_registry.Outcome(3, False, 2, "", "w: missing")
    bad = load(spark.createDataFrame([("1", 1, 1.0)], "k string, v int, w double"), 4)
    assert bad == schema_registry.Outcome(4, False, 2, "", "k: int to string, v: string to int")
    assert load(b, 2).schema_version == 2   # repeated: its rows are overwritten
    rows = schema_registry.read(spark, f"{folder}/r", f"{folder}/t").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None, 1), (2, "y", 2.5, 2)]
