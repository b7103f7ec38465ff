"""Streams that outlive their start: restart with a wider payload, replayed
batches, a whole result republished per batch, and a monitor of every batch.

All sinks here are keyed by the batch id, which is what makes a replay
harmless: a batch that was written but not committed to the checkpoint is run
again under the same id and overwrites its own folder.
"""

from __future__ import annotations

import datetime as _dt
import threading

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from emporium.sources.bronze import as_json_messages, faulty, shape
from emporium.streaming import clickstream as CS
from emporium.streaming.streams import EVENTS_SCHEMA, _event_files, _ntz, _state_partitions, event_source, workdir

#: The payload after the additive change: one more optional field.
WIDER_SCHEMA = T.StructType(CS.CLICK_SCHEMA.fields + [T.StructField("campaign", T.StringType(), True)])
CAMPAIGN = "CASE CAST(user_id AS INT) % 4 WHEN 0 THEN 'spring' WHEN 1 THEN 'outlet' END"
#: How long an event may be delivered again, and how long its id is remembered.
REDELIVERED = _dt.timedelta(hours=2)
REMEMBERED = "6 hours"


class Interrupted(RuntimeError):
    """Raised by a sink after its write, as if the driver had died there."""


def batch_sink(path: str, interrupt: bool = False):
    """A ``foreachBatch`` function that writes each batch under its id. Every
    run of a batch also leaves a file in ``attempts``, so replays can be seen."""

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={int(batch_id)}")
        batch.sparkSession.range(1).coalesce(1).write.mode("append").parquet(f"{path}/attempts/batch={int(batch_id)}")
        if interrupt:
            raise Interrupted(f"stopped after batch {batch_id} was written")

    return write


def drain(df: DataFrame, checkpoint: str, sink, mode: str = "append", interrupted: bool = False) -> None:
    """Start (or go on with) the job of ``checkpoint``, take what is there and stop."""
    with _state_partitions(df.sparkSession):
        q = (df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except StreamingQueryException as e:
        if not (interrupted and Interrupted.__name__ in str(e)):
            raise


def unique_events(spark: SparkSession, landing: str, schema: T.StructType) -> DataFrame:
    """Decoded messages, each event id once: the ids of the last hours are state."""
    raw = spark.readStream.schema("key string, body string").option("recursiveFileLookup", "true").parquet(landing)
    ev = CS.decode_valid(raw, ltz=True, schema=schema).withWatermark("event_ts", REMEMBERED)
    wanted = [f.name for f in schema.fields if f.name in ("event_id", "event_type", "campaign")]
    return ev.dropDuplicatesWithinWatermark(["event_id"]).select(*wanted, "event_ts")


def restarted(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """T13 / T19 / T20 on one checkpoint:

    1. The older half of the events arrives in the old payload and is drained.
    2. The newer half arrives with ``campaign``, beside events of the last two
       hours before it delivered a second time. The job starts again with
       the wider schema; its sink dies after the write, before the commit.
    3. The third start runs that batch again (same id, same folder).

    The result holds every event once: the state of the first run recognises
    what was delivered twice, old events have a null campaign.
    """
    src = spark.read.schema(EVENTS_SCHEMA).parquet(_event_files(folder))
    lo, hi = src.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return spark.createDataFrame([], "event_id string, event_type string, campaign string, event_ts timestamp_ntz")
    cut = lo + _dt.timedelta(microseconds=((hi - lo) // _dt.timedelta(microseconds=1)) // 2)
    ts, at = F.col("ts"), lambda t: F.lit(t).cast("timestamp_ntz")
    old = src.filter(ts < at(cut))
    new = shape(src.filter(ts >= at(cut)), "clickstream").withColumn("campaign", F.expr(CAMPAIGN))
    again = shape(old.filter(ts >= at(cut - REDELIVERED)), "clickstream")
    landing, checkpoint = f"{out}/landing", f"{out}/_checkpoint"

    as_json_messages(shape(old, "clickstream")).write.parquet(f"{landing}/1")
    drain(unique_events(spark, landing, CS.CLICK_SCHEMA), checkpoint, batch_sink(out))
    as_json_messages(new).unionByName(as_json_messages(again)).write.parquet(f"{landing}/2")
    drain(unique_events(spark, landing, WIDER_SCHEMA), checkpoint, batch_sink(out, interrupt=True), interrupted=True)
    drain(unique_events(spark, landing, WIDER_SCHEMA), checkpoint, batch_sink(out))
    found = spark.read.schema("event_id string, event_type string, campaign string, event_ts timestamp").parquet(f"{out}/data").drop("batch")
    return _ntz(found, "event_ts")


def evolved_schema(spark: SparkSession, folder: str) -> DataFrame:
    return restarted(spark, folder, workdir(spark, "evolution"))


def in_parts(spark: SparkSession, folder: str, n: int = 4) -> str:
    """The events as ``n`` files or so by time, for several micro-batches."""
    out = workdir(spark, "parts")
    spark.read.schema(EVENTS_SCHEMA).parquet(_event_files(folder)).repartitionByRange(n, "ts").write.parquet(out)
    return out


def minute_counts(spark: SparkSession, parts: str) -> DataFrame:
    raw = as_json_messages(shape(event_source(spark, parts, "*.parquet", max_files_per_trigger=1), "clickstream"))
    ev = CS.decode_valid(raw, ltz=True).withWatermark("event_ts", "5 minutes")
    g = ev.groupBy(F.window("event_ts", "1 minute").alias("w"), "event_type", "device_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.count("user_id").alias("unique_sessions"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "device_type",
                    "event_count", "unique_sessions")


def publish_whole(path: str, view: str):
    """A ``foreachBatch`` function for complete mode: the whole result is
    written beside the published one, then the view is moved to it in one
    step, and the one before the last is emptied. Readers of the view see one
    batch's result or the next one's, never a half-written table."""

    def write(batch: DataFrame, batch_id: int):
        session, n = batch.sparkSession, int(batch_id)
        batch.write.mode("overwrite").parquet(f"{path}/{n}")
        session.read.schema(batch.schema).parquet(f"{path}/{n}").createOrReplaceGlobalTempView(view)
        if n >= 2:
            session.createDataFrame([], batch.schema).write.mode("overwrite").parquet(f"{path}/{n - 2}")

    return write


def complete_counts(spark: SparkSession, folder: str, view: str = "click_minutes_live") -> DataFrame:
    """T11, complete mode: all windows so far, republished after every batch.
    The result is the published view after the last one."""
    out = workdir(spark, "complete")
    drain(minute_counts(spark, in_parts(spark, folder)), out + "/_checkpoint", publish_whole(out + "/table", view), mode="complete")
    return _ntz(spark.table(f"global_temp.{view}"), "window_start", "window_end")


class BatchMonitor(StreamingQueryListener):
    """State rows, watermark, input and duration of every batch, which
    only the engine knows (the batch function sees its rows alone). Rows are
    kept until :meth:`table` writes them; one row per batch."""

    COLUMNS = ("batch_id long, input_rows long, state_rows long, state_updated long, dropped_rows long, "
               "max_event_ts timestamp_ntz, watermark timestamp_ntz, duration_ms long")

    def __init__(self):
        self.rows: dict[int, tuple] = {}
        self.ended = threading.Event()

    def onQueryStarted(self, event):
        self.ended.clear()

    def onQueryProgress(self, event):
        p = event.progress
        time = lambda key: _dt.datetime.fromisoformat(p.eventTime[key]).replace(tzinfo=None) if p.eventTime.get(key) else None
        state = p.stateOperators
        last = self.rows.get(p.batchId)
        if last is None or p.numInputRows or not last[1]:  # an idle report repeats the id of the batch before
            self.rows[p.batchId] = (p.batchId, p.numInputRows, sum(s.numRowsTotal for s in state), sum(s.numRowsUpdated for s in state),
                                    sum(s.numRowsDroppedByWatermark for s in state), time("max"), time("watermark"), int(p.batchDuration))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.set()

    def table(self, spark: SparkSession, path: str) -> DataFrame:
        """What was seen so far, as a stored table."""
        spark.createDataFrame([self.rows[k] for k in sorted(self.rows)], self.COLUMNS).write.mode("overwrite").parquet(path)
        return spark.read.schema(self.COLUMNS).parquet(path)


def monitored(spark: SparkSession, folder: str) -> DataFrame:
    """The record of each batch of the complete-mode job."""
    out, monitor = workdir(spark, "monitor"), BatchMonitor()
    parts = in_parts(spark, folder)
    spark.streams.addListener(monitor)
    try:
        drain(minute_counts(spark, parts), out + "/_checkpoint", publish_whole(out + "/table", "click_minutes_monitored"), mode="complete")
        if not monitor.ended.wait(60):  # events arrive after the query has ended
            raise TimeoutError("the end of the query was not reported")
    finally:
        spark.streams.removeListener(monitor)
    return monitor.table(spark, out + "/batches")


def monitor_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Over all batches: rows read, windows held in state at the end, newest event."""
    return monitored(spark, folder).agg(
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"), F.max_by("state_rows", "batch_id").alias("windows_held"),
        F.max("max_event_ts").alias("newest_event"))


def quarantined(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """F-json on a stream: events and quarantined messages leave one pass over
    the messages, as folders by route below the batch's id."""

    def write(batch: DataFrame, batch_id: int):
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route").parquet(f"{out}/data/batch={int(batch_id)}"))

    messages = as_json_messages(shape(event_source(spark, folder), "clickstream"))
    stream = CS.routed(faulty(messages), ltz=True)
    drain(stream, out + "/_checkpoint", write)
    return spark.read.schema(T.StructType(stream.schema.fields + [T.StructField("batch", T.LongType())])).parquet(out + "/data").drop("batch")


def route_counts(routes: DataFrame) -> DataFrame:
    return routes.groupBy("route").agg(F.count(F.lit(1)).alias("messages"), F.count("body").alias("bodies_kept"),
                                       F.min("event_ts").cast("timestamp_ntz").alias("first_event"))


def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    return route_counts(quarantined(spark, folder, workdir(spark, "quarantine")))
