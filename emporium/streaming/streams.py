"""Structured Streaming jobs over the clickstream.

Source: a folder of Parquet event files read with ``readStream`` (a Kafka
topic in production -- only the reader changes). The broker message is
reproduced as a JSON body so the decode step is the real one.

Every job writes under the shared checkpoint folder (``spark.checkpoint.dir``;
a private folder only when unset, as in tests), with its own checkpoint so a
job started again on its checkpoint resumes where it stopped (``late_drop``
does so). The registered jobs each take a new folder and run with the
``availableNow`` trigger: they drain what is there and stop. In append mode
the windows still open at the end are not part of the result;
``tumbling_upsert`` (update mode) has every window.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emporium.operators import versioning
from emporium.session import run_folder
from emporium.sources.bronze import as_json_messages, shape
from emporium.streaming import clickstream as CS

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
WATERMARK = "5 minutes"


def workdir(spark: SparkSession, name: str) -> str:
    """A fresh folder (checkpoint, sink) for one stream run."""
    return run_folder(spark, "stream-" + name)


def event_source(spark: SparkSession, folder: str, file_glob: str = "events*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the event files in ``folder``."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def json_source(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw JSON messages, one per line, from files landing in ``folder``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder).withColumnRenamed("value", "body")


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "earliest") -> DataFrame:
    """Production reader: the topic's messages as (key, body).

    Needs the Spark Kafka connector on the classpath (not bundled with
    PySpark); everything downstream of this reader is unchanged."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("body"))


def messages(spark: SparkSession, folder: str, **kw) -> DataFrame:
    """The source as broker messages (key, JSON body)."""
    return as_json_messages(shape(event_source(spark, folder, **kw), "clickstream"))


def events(spark: SparkSession, folder: str, **kw) -> DataFrame:
    """Decoded, typed events with an event-time column usable for watermarks."""
    return CS.decode_valid(messages(spark, folder, **kw), ltz=True)


def redelivered(raw: DataFrame, every: int = 7) -> DataFrame:
    """The messages as an at-least-once broker may deliver them: those whose
    key ``every`` divides come twice."""
    twice = F.coalesce(F.col("key").try_cast("long") % every == 0, F.lit(False))
    return raw.select("*", F.explode(F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_n")).drop("_n")


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


class _state_partitions:
    """Start a stream with one state partition per core.

    A stateful stream fixes its partition count at first start (stored in
    its checkpoint) from ``spark.sql.shuffle.partitions``; the stream's
    session is a snapshot taken at ``start()``, so the settings are
    applied only around the start and the caller's session is restored.
    Sessions are merged inside each task before they are shuffled, so a user
    with very many events sends a few sessions per task, not the events."""

    def __init__(self, spark: SparkSession, n: int | None = None):
        self.spark = spark
        self.own = {"spark.sql.shuffle.partitions": str(n or spark.sparkContext.defaultParallelism),
                    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k) for k in self.own}
        for k, v in self.own.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            self.spark.conf.set(k, v)


def run_to_parquet(df: DataFrame, out: str, mode: str = "append", trigger: dict | None = None,
                   timeout_s: float | None = None):
    """Run a stream into a Parquet sink; returns the ended query (which
    remembers the progress of its last hundred batches only).

    ``trigger`` defaults to ``{"availableNow": True}`` (drain and stop); a
    continuous deployment passes e.g. ``{"processingTime": "30 seconds"}``
    and a ``timeout_s`` after which the query is stopped (its checkpoint
    lets the next start resume exactly there)."""
    with _state_partitions(df.sparkSession):
        q = (df.writeStream.format("parquet").outputMode(mode)
               .option("checkpointLocation", out + "/_checkpoint")
               .trigger(**(trigger or {"availableNow": True})).start(out + "/data"))
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
        q.stop()
    return q


def raw_append(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded events appended to a Bronze table; read back."""
    out = workdir(spark, "raw")
    run_to_parquet(events(spark, folder), out)
    return _ntz(spark.read.parquet(out + "/data"), "event_ts")


def tumbling(spark: SparkSession, folder: str) -> DataFrame:
    """Watermark 5 min, 1-min windows, appended once a window closes;
    distinct sessions exact through chained aggregation."""
    ev = events(spark, folder).withWatermark("event_ts", WATERMARK)
    m = CS.tumbling_metrics_chained(ev)
    out = workdir(spark, "tumbling")
    run_to_parquet(m, out)
    return _ntz(spark.read.parquet(out + "/data"), "window_start", "window_end")


def sliding(spark: SparkSession, folder: str) -> DataFrame:
    """T8."""
    ev = events(spark, folder).withWatermark("event_ts", WATERMARK)
    out = workdir(spark, "sliding")
    run_to_parquet(CS.sliding_metrics(ev), out)
    return _ntz(spark.read.parquet(out + "/data"), "window_start", "window_end")


def session_windows(spark: SparkSession, folder: str) -> DataFrame:
    """T9."""
    ev = events(spark, folder).withWatermark("event_ts", WATERMARK)
    out = workdir(spark, "sessions")
    run_to_parquet(CS.sessions(ev), out)
    return _ntz(spark.read.parquet(out + "/data"), "session_start", "session_end")


def distinct_users_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Exact distinct users per (window, event type) in a stream.

    ``count(DISTINCT)`` is not supported on streams; two chained
    aggregations are: (window, type, user) first, then (window, type).
    """
    ev = events(spark, folder).withWatermark("event_ts", WATERMARK)
    per_user = ev.groupBy(F.window("event_ts", "1 minute").alias("w"), "event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"))
    per_win = per_user.groupBy("w", "event_type").agg(F.count(F.lit(1)).alias("distinct_users"))
    out = workdir(spark, "distinct")
    run_to_parquet(per_win.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                                  "event_type", "distinct_users"), out)
    return _ntz(spark.read.parquet(out + "/data"), "window_start", "window_end")


def dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Drop re-delivered events (same event_id) within the watermark.
    The broker delivers every seventh event twice here."""
    ev = CS.decode_valid(redelivered(messages(spark, folder)), ltz=True).withWatermark("event_ts", WATERMARK)
    d = ev.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "event_type", "user_id", "event_ts")
    out = workdir(spark, "dedup")
    run_to_parquet(d, out)
    return _ntz(spark.read.parquet(out + "/data"), "event_ts")


def tumbling_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Update-mode window counts kept exactly-once in a table.

    Each micro-batch's updated windows are written under ``_version =
    batch_id`` (overwrite of that one partition, so a replayed batch
    rewrites the same rows); readers take, per window key, the row of the
    latest version. The open last window is included -- no flush needed.
    """
    ev = events(spark, folder).withWatermark("event_ts", WATERMARK)
    g = ev.groupBy(F.window("event_ts", "1 minute"), "event_type", "device_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.count("user_id").alias("unique_sessions"))
    m = g.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                 "event_type", "device_type", "event_count", "unique_sessions")
    out = workdir(spark, "upsert")
    table = out + "/table"

    def write_batch(batch: DataFrame, batch_id: int):
        # The version is the partition folder; a replayed batch overwrites it.
        (batch.withColumn("_deleted", F.lit(False)).write.mode("overwrite")
            .parquet(f"{table}/_version={int(batch_id)}"))

    with _state_partitions(spark):
        q = (m.writeStream.outputMode("update").foreachBatch(write_batch)
               .option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    keys = ["window_start", "window_end", "event_type", "device_type"]
    log = spark.read.parquet(table)
    snap = versioning.snapshot(log, keys)
    return _ntz(snap, "window_start", "window_end").select(*keys, "event_count", "unique_sessions")


def late_drop(spark: SparkSession, folder: str) -> DataFrame:
    """Replay the events out of time order and report what was dropped.

    Three parts land one after the other -- the newest quarter of the time
    span, the quarter before it, then the older half -- and after each the
    job is started again on the same checkpoint (a restart resumes where the
    last run stopped). Late rows are those whose window ended before the
    watermark that the earlier batches set. One row: events sent, events
    counted in some window, late events, and windows.
    """
    src = spark.read.schema(EVENTS_SCHEMA).parquet(_event_files(folder))
    lo, hi = src.agg(F.min("ts"), F.max("ts")).first()
    replay, out = workdir(spark, "late-src"), workdir(spark, "late")
    span = (hi - lo) // _dt.timedelta(microseconds=1) if lo else 0
    cut = [F.lit(lo + _dt.timedelta(microseconds=n) if lo else None).cast("timestamp_ntz") for n in (span * 3 // 4, span // 2)]
    ts = F.col("ts")
    parts = [src.filter(ts >= cut[0]), src.filter((ts >= cut[1]) & (ts < cut[0])), src.filter(ts < cut[1])]

    def write_batch(batch: DataFrame, batch_id: int):
        batch.withColumn("_deleted", F.lit(False)).write.mode("overwrite").parquet(f"{out}/table/_version={int(batch_id)}")

    for i, part in enumerate(parts):
        part.write.parquet(f"{replay}/{i}")
        ev = CS.decode_valid(as_json_messages(shape(
            spark.readStream.schema(EVENTS_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .parquet(replay), "clickstream")), ltz=True)
        g = ev.withWatermark("event_ts", WATERMARK).groupBy(F.window("event_ts", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
        with _state_partitions(spark):
            q = (g.select(F.col("w.start").alias("window_start"), "n").writeStream.outputMode("update").foreachBatch(write_batch)
                 .option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    sent = CS.decode_valid(as_json_messages(shape(src, "clickstream"))).agg(F.count(F.lit(1)).alias("sent_events"))
    log = spark.read.schema("window_start timestamp, n long, _deleted boolean, _version int").parquet(out + "/table")
    kept = versioning.snapshot(log, ["window_start"]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("kept_events"), F.count(F.lit(1)).alias("windows"))
    return sent.join(kept).select("sent_events", "kept_events", (F.col("sent_events") - F.col("kept_events")).alias("late_events"), "windows")


def stream_progress(spark: SparkSession, folder: str, file_glob: str = "events*.parquet") -> DataFrame:
    """What each micro-batch (one file) read and wrote.

    Every batch writes its own record beside its rows, so the report covers
    all batches of the checkpoint, however many; a replayed batch replaces
    its record."""
    out = workdir(spark, "progress")

    def write_batch(batch: DataFrame, batch_id: int):
        own = Observation(f"batch_{batch_id}")
        (CS.decode_valid(batch.observe(own, F.count(F.lit(1)).alias("n"))).write.mode("overwrite").parquet(f"{out}/data/batch={int(batch_id)}"))
        written = batch.sparkSession.read.parquet(f"{out}/data/batch={int(batch_id)}").count()
        batch.sparkSession.createDataFrame([(int(own.get["n"]), written)], "input_rows long, sink_rows long") \
            .write.mode("overwrite").parquet(f"{out}/progress/batch_id={int(batch_id)}")

    q = (messages(spark, folder, file_glob=file_glob, max_files_per_trigger=1).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("input_rows long, sink_rows long, batch_id long").parquet(out + "/progress").select("batch_id", "input_rows", "sink_rows")


def _event_files(folder: str) -> str:
    """The events table: one file, or a folder of files, of that name."""
    return f"{folder.rstrip('/')}/events*.parquet"
