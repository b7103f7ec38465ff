"""Clickstream decoding and windowed metrics, shared by batch and streaming.

Every function here works on a static *or* a streaming DataFrame; the
streaming module adds watermarks, output modes and sinks around them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from emporium.session import run_folder
from emporium.functions.numeric import pct

# The event payload: 11 text fields; declared non-null fields are not
# enforced by from_json (missing -> null), so validity is checked explicitly.
CLICK_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("search_query", T.StringType(), True),
    T.StructField("page_url", T.StringType(), True),
    T.StructField("referrer", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("event_timestamp", T.StringType(), False),
])

def decode(raw: DataFrame, body: str = "body", ltz: bool = False,
           schema: T.StructType = CLICK_SCHEMA) -> DataFrame:
    """JSON body -> typed events (+ ``event_ts``); malformed bodies are kept
    with ``_corrupt = true`` and a null ``event_ts`` instead of failing.

    A wider ``schema`` (additive evolution) simply yields nulls for fields
    older messages do not carry."""
    ev = raw.select(F.from_json(F.col(body).cast("string"), schema).alias("e"))
    ts = F.col("e.event_timestamp")
    parsed = F.to_timestamp(ts) if ltz else ts.try_cast("timestamp_ntz")
    return ev.select("e.*", parsed.alias("event_ts"),
                     (F.col("e").isNull() | F.col("e.event_id").isNull() | parsed.isNull()).alias("_corrupt"))


def valid(events: DataFrame) -> DataFrame:
    return events.filter(~F.col("_corrupt")).drop("_corrupt")


def decode_valid(raw: DataFrame, body: str = "body", ltz: bool = False,
                 schema: T.StructType = CLICK_SCHEMA) -> DataFrame:
    """Only the valid events of :func:`decode`, with the JSON parsed once.

    A plain ``filter`` on parsed fields is pushed by the optimizer below the
    parsing projection (and below any repartition), evaluating ``from_json``
    twice and before the rows are spread. Keeping rows through a generator
    -- explode a one-element array filtered by validity -- cannot be pushed
    down, so each body is decoded exactly once.
    """
    e = F.from_json(F.col(body).cast("string"), schema)
    parsed = raw.select(e.alias("e"))
    ts = F.col("e.event_timestamp")
    ts = F.to_timestamp(ts) if ltz else ts.try_cast("timestamp_ntz")
    row = F.struct(*[F.col("e." + f.name).alias(f.name) for f in schema.fields], ts.alias("event_ts"))
    keep = F.filter(F.array(row), lambda r: r["event_id"].isNotNull() & r["event_ts"].isNotNull())
    return parsed.select(F.explode(keep).alias("r")).select("r.*")


ROUTE_EVENTS, CORRUPT = "events", "_corrupt_body"
BODY_SCHEMA = T.StructType(CLICK_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def routed(raw: DataFrame, body: str = "body", ltz: bool = False) -> DataFrame:
    """F-json: every message decoded once, with the route it takes: ``events``,
    or the reason for its quarantine. The parser itself reports a body that is
    no JSON of the schema in its corrupt-record column; a body that parses may still lack
    its id or a readable time. Quarantined messages keep their body."""
    text = F.col(body).cast("string")
    e = F.from_json(text, BODY_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = raw.select(text.alias("body"), e.alias("e"))
    stamp = F.col("e.event_timestamp")
    ts = stamp.try_cast("timestamp") if ltz else stamp.try_cast("timestamp_ntz")
    route = (F.when(F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull(), "malformed_json")
              .when(F.col("e.event_id").isNull(), "no_event_id").when(ts.isNull(), "no_event_time").otherwise(ROUTE_EVENTS))
    return parsed.select(route.alias("route"), *[F.col("e." + f.name).alias(f.name) for f in CLICK_SCHEMA.fields], ts.alias("event_ts"),
                         F.when(route != ROUTE_EVENTS, F.col("body")).alias("body"))


def _flat(df: DataFrame, w: str = "window") -> DataFrame:
    cols = [c for c in df.columns if c != w]
    return df.select(F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end"), *cols)


def tumbling_metrics(events: DataFrame, width: str = "1 minute", exact_sessions: bool = True) -> DataFrame:
    """Events per (window, event_type, device_type).

    ``unique_sessions`` keeps the source definition (a count of non-null
    user ids, i.e. events); ``distinct_sessions`` is the real distinct session
    count (exact in batch; approximate when ``exact_sessions`` is False, as
    streams require).
    """
    distinct = (F.count_distinct("session_id") if exact_sessions
                else F.approx_count_distinct("session_id"))
    g = events.groupBy(F.window("event_ts", width), "event_type", "device_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count("user_id").alias("unique_sessions"),
        distinct.alias("distinct_sessions"))
    return _flat(g)


def tumbling_metrics_chained(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """T5 / T6 for streams with an *exact* distinct session count.

    ``count(DISTINCT)`` is not allowed on a stream, but two chained
    aggregations are: per (window, type, device, session) first, then per
    (window, type, device) -- event counts are summed, sessions counted."""
    per_session = events.groupBy(F.window("event_ts", width).alias("w"), "event_type", "device_type",
                                 "session_id").agg(F.count(F.lit(1)).alias("n"),
                                                   F.count("user_id").alias("n_user"))
    g = per_session.groupBy("w", "event_type", "device_type").agg(
        F.sum("n").alias("event_count"), F.sum("n_user").alias("unique_sessions"),
        F.count("session_id").alias("distinct_sessions"))
    return _flat(g, "w")


def sliding_metrics(events: DataFrame, width: str = "1 minute", slide: str = "30 seconds") -> DataFrame:
    """Events per overlapping window and event type."""
    g = events.groupBy(F.window("event_ts", width, slide), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"))
    return _flat(g)


def sessions(events: DataFrame, gap: str = "10 minutes") -> DataFrame:
    """Activity sessions per user (a gap of ``gap`` closes a session)."""
    g = events.groupBy(F.session_window("event_ts", gap).alias("session"), "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    return _flat(g, "session").withColumnRenamed("window_start", "session_start") \
        .withColumnRenamed("window_end", "session_end")


def session_slots(events: DataFrame, gap: str = "10 minutes") -> DataFrame:
    """Activity per user and time slot as long as the gap: first and last
    event and counts. Two events of a slot are nearer than the gap, so a slot
    never spans two sessions. A partial aggregate: a hot user's events are
    reduced by every task before the shuffle."""
    g = events.groupBy("user_id", F.window("event_ts", gap).alias("slot")).agg(
        F.min("event_ts").alias("first"), F.max("event_ts").alias("last"), F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    return g.select("user_id", F.col("slot.start").alias("slot"), "first", "last", "events", "purchases")


def sessions_by_slots(events: DataFrame, gap: str = "10 minutes") -> DataFrame:
    """T9 in batch, in two levels: slots first (:func:`session_slots`), then
    neighbouring slots of a user no farther apart than the gap are stitched. The window
    per user runs over its slots, whose number the calendar bounds (144 a day
    for ten minutes), not over its events."""
    by_user = W.partitionBy("user_id").orderBy("slot")
    apart = F.coalesce(F.col("first") > F.lag("last").over(by_user) + F.expr(f"INTERVAL {gap}"), F.lit(True))
    numbered = (session_slots(events, gap).withColumn("new", apart.cast("int"))
                .withColumn("n", F.sum("new").over(by_user.rowsBetween(W.unboundedPreceding, W.currentRow))))
    return numbered.groupBy("user_id", "n").agg(
        F.min("first").alias("session_start"), (F.max("last") + F.expr(f"INTERVAL {gap}")).alias("session_end"),
        F.sum("events").alias("events"), F.sum("purchases").alias("purchases")).drop("n").select(
        "session_start", "session_end", "user_id", "events", "purchases")


def active_users(events: DataFrame, width: str = "5 minutes", slide: str = "1 minute",
                 exact: bool = True) -> DataFrame:
    """Distinct users active in each trailing ``width`` window."""
    d = F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id")
    return _flat(events.groupBy(F.window("event_ts", width, slide)).agg(d.alias("active_users")))


#: Sketches are exact up to 2^14 distinct values; beyond, the standard error is 1 / sqrt(2^14), 0.8 %.
SKETCH_BITS = 14


def minute_sketches(events: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """Per minute, mergeable sketches of its distinct users and
    sessions. A minute's row is bounded (eight bytes a value, 2^bits at most), so
    longer windows are united from stored minutes without the events."""
    return _flat(events.groupBy(F.window("event_ts", "1 minute")).agg(
        F.theta_sketch_agg("user_id", bits).alias("users"), F.theta_sketch_agg("session_id", bits).alias("sessions"),
        F.count(F.lit(1)).alias("events")))


def distinct_of_minutes(minutes: DataFrame, bits: int = SKETCH_BITS, trailing: int = 5) -> DataFrame:
    """Distinct users and sessions of every ``trailing``-minute window (slid by
    a minute) and of every day, from :func:`minute_sketches`."""
    start = F.col("window_start")
    slid = minutes.withColumn("w", F.explode(F.expr(f"transform(sequence(0, {int(trailing) - 1}), i -> window_start - make_dt_interval(0, 0, i))")))
    grains = [(f"{trailing} minutes", slid, F.expr(f"INTERVAL {int(trailing)} MINUTES")),
              ("day", minutes.withColumn("w", F.date_trunc("day", start).cast("timestamp_ntz")), F.expr("INTERVAL 1 DAY"))]
    out = None
    for grain, rows, width in grains:
        part = rows.groupBy("w").agg(F.theta_union_agg("users", bits).alias("u"), F.theta_union_agg("sessions", bits).alias("s"), F.sum("events").alias("events"))
        part = part.select(F.lit(grain).alias("grain"), F.col("w").alias("window_start"), (F.col("w") + width).alias("window_end"),
                           F.theta_sketch_estimate("u").alias("active_users"), F.theta_sketch_estimate("s").alias("distinct_sessions"), "events")
        out = part if out is None else out.unionByName(part)
    return out


def stored_minutes(spark, events: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """:func:`minute_sketches` as a stored table."""
    minutes = minute_sketches(events, bits)
    path = run_folder(spark, "click-minute-sketches")
    minutes.write.parquet(path)
    return spark.read.schema(minutes.schema).parquet(path)


def funnel(events: DataFrame) -> DataFrame:
    """Sessions reaching view -> cart -> purchase, in that order.

    One partial aggregate per session takes the first time of each step;
    a step counts when its first occurrence is not earlier than the
    previous step's first occurrence.
    """
    first = lambda t: F.min(F.when(F.col("event_type") == t, F.col("event_ts")))
    s = events.groupBy("session_id").agg(first("page_view").alias("v"),
                                         first("add_to_cart").alias("c"),
                                         first("purchase").alias("p"))
    viewed = F.col("v").isNotNull()
    carted = viewed & (F.col("c") >= F.col("v"))
    bought = carted & (F.col("p") >= F.col("c"))
    agg = s.agg(F.count_if(viewed).alias("viewed"), F.count_if(carted).alias("added_to_cart"),
                F.count_if(bought).alias("purchased"))
    long = agg.unpivot([], ["viewed", "added_to_cart", "purchased"], "stage", "sessions")
    order = F.when(F.col("stage") == "viewed", 1).when(F.col("stage") == "added_to_cart", 2).otherwise(3)
    return long.select(order.alias("step"), "stage", "sessions")


def conversion_rate(metrics: DataFrame) -> DataFrame:
    """Purchases per page view, from summed window counts (not rows)."""
    return metrics.agg(
        F.sum(F.when(F.col("event_type") == "purchase", F.col("event_count")).otherwise(0)).alias("purchases"),
        F.sum(F.when(F.col("event_type") == "page_view", F.col("event_count")).otherwise(0)).alias("page_views"),
        pct("sum(CASE WHEN event_type = 'purchase' THEN event_count ELSE 0 END)",
            "sum(CASE WHEN event_type = 'page_view' THEN event_count ELSE 0 END)").alias("conversion_rate"))


def events_per_minute(metrics: DataFrame) -> DataFrame:
    """All events per window."""
    return metrics.groupBy("window_start", "window_end").agg(F.sum("event_count").alias("events"))
