"""Stream results against their batch twins."""

import datetime as dt

from pyspark.sql import functions as F

from emporium.plans import registry
from emporium.sources.bronze import as_json_messages, shape
from emporium.streaming import clickstream as CS
from emporium.streaming import recovery as RC
from emporium.streaming import streams as ST

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_update_mode_upsert_equals_batch(spark):
    batch = registry.QUERIES["click_tumbling"](spark, SF_SMALL).drop("distinct_sessions")
    stream = ST.tumbling_upsert(spark, SF_SMALL)
    assert _rows(stream.select(*batch.columns)) == _rows(batch)


def test_append_mode_closes_all_but_the_last_windows(spark):
    batch = registry.QUERIES["click_tumbling"](spark, SF_SMALL)
    stream = ST.tumbling(spark, SF_SMALL)
    assert 0 < batch.count() - stream.count() <= 5


def test_raw_append_and_dedup_keep_every_event(spark):
    src = spark.read.parquet(SF_SMALL + "/events.parquet")
    n = src.count()
    assert ST.raw_append(spark, SF_SMALL).count() == n
    sent = ST.redelivered(as_json_messages(shape(src, "clickstream")))
    assert sent.count() == n + src.where("event_id % 7 = 0").count()
    assert ST.dedup(spark, SF_SMALL).count() == n


def test_late_rows_are_dropped(spark):
    r = ST.late_drop(spark, SF_SMALL).first()
    assert 0 < r.late_events < r.sent_events and r.kept_events + r.late_events == r.sent_events


def test_progress_covers_every_batch(spark, tmp_path):
    """More files than the last hundred updates a query remembers."""
    spark.read.parquet(SF_SMALL + "/events.parquet").limit(530).repartition(106).write.parquet(str(tmp_path / "ev"))
    rows = ST.stream_progress(spark, str(tmp_path / "ev"), file_glob="*.parquet").collect()
    assert len(rows) == 106 and sum(r.input_rows for r in rows) == 530 and sum(r.sink_rows for r in rows) == 530


def test_restart_with_a_wider_payload_and_a_replayed_batch(spark, tmp_path):
    """Old and new payload on one checkpoint, events delivered twice, and one
    batch that runs twice: every event is there once, new ones with campaign."""
    out = str(tmp_path / "job")
    got = RC.restarted(spark, SF_SMALL, out)
    src = spark.read.parquet(SF_SMALL + "/events.parquet")
    lo, hi = src.agg(F.min("ts"), F.max("ts")).first()
    new = F.col("ts") >= F.lit(lo + (hi - lo) / 2).cast("timestamp_ntz")
    want = src.select(F.col("event_id").cast("string"), F.when(new, F.expr(RC.CAMPAIGN)).alias("campaign"))
    assert _rows(got.select("event_id", F.coalesce("campaign", F.lit("-")))) == _rows(want.select("event_id", F.coalesce("campaign", F.lit("-"))))
    assert {r.campaign for r in got.select("campaign").distinct().collect()} == {None, "spring", "outlet"}
    messages = spark.read.schema("key string, body string").option("recursiveFileLookup", "true").parquet(out + "/landing")
    assert messages.count() > src.count()  # something was delivered twice
    runs = {r.batch: r["count"] for r in spark.read.parquet(out + "/attempts").groupBy("batch").count().collect()}
    assert sorted(runs.values())[-1] == 2 and list(runs.values()).count(2) == 1  # one batch was replayed


def test_interrupted_batch_is_not_in_the_result_twice(spark, tmp_path):
    out = str(tmp_path / "job")
    RC.restarted(spark, SF_SMALL, out)
    ids = spark.read.parquet(out + "/data").groupBy("event_id").count()
    assert ids.where("count > 1").count() == 0


def test_complete_mode_republishes_the_whole_result(spark):
    batch = registry.QUERIES["click_tumbling"](spark, SF_SMALL).drop("distinct_sessions")
    assert _rows(RC.complete_counts(spark, SF_SMALL).select(*batch.columns)) == _rows(batch)


def test_monitor_sees_every_batch(spark):
    rows = sorted(RC.monitored(spark, SF_SMALL).collect())
    n = spark.read.parquet(SF_SMALL + "/events.parquet").count()
    with_rows = [r for r in rows if r.input_rows]
    assert len(with_rows) >= 3 and sum(r.input_rows for r in rows) == n
    held = [r.state_rows for r in rows]
    assert held == sorted(held) and all(r.duration_ms > 0 for r in with_rows)
    marks = [r.watermark for r in rows if r.watermark]
    assert marks == sorted(marks) and all(r.state_updated <= r.input_rows for r in with_rows)


def test_sessions_by_slots_equal_session_windows(spark):
    t0 = dt.datetime(2024, 5, 1)
    steps = [0, 599, 600, 1199, 1799, 2399, 3000, 3001, 9000, 9600, 10199]  # gaps just under, at and over ten minutes
    rows = [("u", t0 + dt.timedelta(seconds=s), "purchase") for s in steps]
    rows += [("hot", t0 + dt.timedelta(seconds=s), "page_view") for s in range(0, 40_000, 3)] + [(None, t0, "x"), ("v", None, "x"), ("v", t0, "x"), ("v", t0, "x")]
    ev = spark.createDataFrame(rows, "user_id string, event_ts timestamp_ntz, event_type string")
    key = lambda df: sorted((str(r.user_id), r.session_start, r.session_end, r.events, r.purchases) for r in df.collect())
    assert key(CS.sessions_by_slots(ev)) == key(CS.sessions(ev))


def test_no_task_holds_a_hot_users_events(spark):
    """What reaches the window of a user is its slots: 67, not 13,334 events."""
    t0 = dt.datetime(2024, 5, 1)
    ev = spark.createDataFrame([("hot", t0 + dt.timedelta(seconds=s), "page_view") for s in range(0, 40_000, 3)], "user_id string, event_ts timestamp_ntz, event_type string")
    assert CS.session_slots(ev).count() == 67
    plan = CS.sessions_by_slots(ev)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in before_shuffle and "partial_min" in before_shuffle


def test_quarantine_keeps_bodies_beside_the_events(spark, tmp_path):
    bodies = ['{"event_id":"1","event_timestamp":"2024-01-01 10:00:00"}', '{"event_id":"2","event_ti', '{"user_id":"x","event_timestamp":"2024-01-01 10:00:00"}',
              '{"event_id":"3","event_timestamp":"soon"}', '', None, '[1, 2]', '{"event_id":"4","event_timestamp":"2024-01-01 10:00:00","more":1}']
    for ltz in (False, True):
        got = CS.routed(spark.createDataFrame([(b,) for b in bodies], "body string"), ltz=ltz).collect()
        assert [r.route for r in got] == ["events", "malformed_json", "no_event_id", "no_event_time", "malformed_json", "malformed_json", "malformed_json", "events"]
        assert all((r.body is None) == (r.route == "events") or b is None for r, b in zip(got, bodies))
    stream = RC.quarantined(spark, SF_SMALL, str(tmp_path / "q"))
    counts = {r.route: r.messages for r in RC.route_counts(stream).collect()}
    assert counts == {r.route: r.messages for r in registry.QUERIES["click_quarantine"](spark, SF_SMALL).collect()}
    assert set(counts) == {"events", "malformed_json", "no_event_id", "no_event_time"}
    cut = stream.where("route = 'malformed_json'").first().body
    assert cut.startswith("{") and len(cut) == 25
