"""Registered queries that run streams over the files of the event table to their end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from indicatrix.plans.registry import query
from indicatrix.plans.standins import Tables, now
from indicatrix.session import scratch_dir
from indicatrix.streaming import events, topic

ONCE = events.Trigger(once=True)
_GOOD = "event_id % 17 <> 0"


def _finish(*streams) -> None:
    for stream in streams:
        stream.awaitTermination()


def _messages(t: Tables):
    return t.message_stream().select("value")


@query(
    "a3_append_sink",
    f"""SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 19 = 0 THEN 'x.com' ELSE concat('d', CAST(user_id AS VARCHAR), '.com') END AS domain,
      CASE WHEN event_id % 19 <> 0 THEN 2678400.0 END AS latency_sec FROM events WHERE {_GOOD}""",
)
def a3_append_sink(t: Tables):
    root = scratch_dir(t.spark, "append")
    good, _ = events.split(_messages(t), ingest_ts=now())
    _finish(events.parquet_sink(good, f"{root}/out", f"{root}/chk", None, ONCE))
    return t.spark.read.parquet(f"{root}/out").select("id", "domain", "latency_sec")


@query(
    "a4_daily_sink",
    """SELECT strftime(ts, '%Y-%m-%d') AS ds, count(*) AS n FROM events GROUP BY 1""",
)
def a4_daily_sink(t: Tables):
    """Unique events by day; each event of the table has its own time."""
    root = scratch_dir(t.spark, "daily")
    stream = t.message_stream().select(F.col("event_id").cast("string").alias("id"), F.col("ts").alias("event_ts"))
    # All files of one run share a batch, so no event comes too late.
    _finish(events.parquet_sink(events.dedupe(stream), f"{root}/out", f"{root}/chk", ["ds"], ONCE))
    days = t.spark.read.parquet(f"{root}/out")
    return days.groupBy(F.date_format("ds", "yyyy-MM-dd").alias("ds")).agg(F.count("*").alias("n"))


@query(
    "a5_dead_letter",
    "SELECT value, 'json_parse_failed' AS reason FROM stream_event WHERE event_id % 17 = 0",
)
def a5_dead_letter(t: Tables):
    root = scratch_dir(t.spark, "dead")
    _, bad = events.split(_messages(t), ingest_ts=now())
    _finish(events.parquet_sink(bad, f"{root}/out", f"{root}/chk", None, ONCE))
    return t.spark.read.parquet(f"{root}/out").select("value", "reason")


@query(
    "a7_batch_metrics",
    f"""SELECT CAST(0 AS INTEGER) AS batch_id, count(*) AS rows, quantile_disc(late, 0.5) AS p50, quantile_disc(late, 0.95) AS p95
    FROM (SELECT CASE WHEN event_id % 19 <> 0 THEN epoch(TIMESTAMP '2024-02-01') - epoch(TIMESTAMP '2024-01-01') END AS late FROM events WHERE {_GOOD})""",
)
def a7_batch_metrics(t: Tables):
    root = scratch_dir(t.spark, "metrics")
    good, _ = events.split(_messages(t), ingest_ts=now())
    _finish(events.metrics_sink(good, f"{root}/out", f"{root}/chk", ONCE))
    return t.spark.read.parquet(f"{root}/out").select("batch_id", "rows", "p50", "p95")



def _landed_days(t: Tables) -> str:
    """The event texts as three files of ten days each, in order of time."""
    folder = scratch_dir(t.spark, "landed")
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    for part in range(3):
        t.stream_event.filter(third == part).select("value").coalesce(1).write.mode("append").text(folder)
    return folder


def _timed_days(t: Tables, *parts: int) -> str:
    """Ids and times of the events of the given thirds of the month, a file each, in the given order."""
    folder = scratch_dir(t.spark, "timed")
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    rows = t.events.select(F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("event_ts"), third.alias("third"))
    for part in parts:
        rows.filter(F.col("third") == part).drop("third").coalesce(1).write.mode("append").parquet(folder)
    return folder


def _timed_stream(t: Tables, folder: str):
    reader = t.spark.readStream.schema("id string, event_ts timestamp").option("maxFilesPerTrigger", 1)
    return reader.parquet(folder)


@query("a6_preview", f"SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE {_GOOD}")
def a6_preview(t: Tables):
    """The good events as the memory sink shows them."""
    good, _ = events.split(_messages(t), ingest_ts=now())
    name = f"preview_{uuid.uuid4().hex}"
    _finish(events.preview_sink(good, ONCE, memory_table=name))
    return t.spark.table(name).select("id")


@query("j1_watermark", "SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE dayofmonth(ts) > 10")
def j1_watermark(t: Tables):
    """The first third of the month comes last and lies behind the watermark then."""
    root = scratch_dir(t.spark, "watermark")
    stream = _timed_stream(t, _timed_days(t, 1, 2, 0))
    _finish(events.parquet_sink(events.dedupe(stream), f"{root}/out", f"{root}/chk", ["ds"], ONCE))
    return t.spark.read.parquet(f"{root}/out").select("id")


@query("j3_trigger", f"SELECT count(*) AS rows FROM events WHERE {_GOOD}")
def j3_trigger(t: Tables):
    """A processing-time trigger reads everything, too."""
    root = scratch_dir(t.spark, "trigger")
    good, _ = events.split(_messages(t), ingest_ts=now())
    stream = events.parquet_sink(good, f"{root}/out", f"{root}/chk", None, events.Trigger(seconds=1))
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return t.spark.read.parquet(f"{root}/out").agg(F.count("*").alias("rows"))


@query("j5_restart", f"SELECT CAST(event_id AS VARCHAR) AS id, CAST(1 AS BIGINT) AS copies FROM events WHERE {_GOOD}")
def j5_restart(t: Tables):
    """Three runs over one checkpoint, each with one more file: every event is written once."""
    root, folder = scratch_dir(t.spark, "restart"), scratch_dir(t.spark, "landed")
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    for part in range(3):
        t.stream_event.filter(third == part).select("value").coalesce(1).write.mode("append").text(folder)
        good, _ = events.split(events.text_source(t.spark, folder), ingest_ts=now())
        _finish(events.parquet_sink(good, f"{root}/out", f"{root}/chk", None, ONCE))
    return t.spark.read.parquet(f"{root}/out").groupBy("id").agg(F.count("*").alias("copies"))


@query("j6_admission", "SELECT CAST(least((dayofmonth(ts) - 1) // 10, 2) AS BIGINT) AS batch_id, count(*) AS rows FROM events WHERE event_id % 17 <> 0 GROUP BY 1")
def j6_admission(t: Tables):
    """One file per batch: as many batches as files, each with the rows of its file."""
    root = scratch_dir(t.spark, "admission")
    source = events.text_source(t.spark, _landed_days(t), files_per_trigger=1)
    good, _ = events.split(source, ingest_ts=now())
    _finish(events.metrics_sink(good, f"{root}/out", f"{root}/chk", ONCE))
    return t.spark.read.parquet(f"{root}/out").select(F.col("batch_id").cast("bigint").alias("batch_id"), "rows")


@query("j7_late_events", "SELECT count(*) AS dropped FROM events WHERE dayofmonth(ts) <= 10")
def j7_late_events(t: Tables):
    """How many events the stream's state reports as later than the watermark."""
    root = scratch_dir(t.spark, "late")
    stream = _timed_stream(t, _timed_days(t, 1, 2, 0))
    query_ = events.parquet_sink(events.dedupe(stream), f"{root}/out", f"{root}/chk", ["ds"], ONCE)
    _finish(query_)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query_.recentProgress for s in p["stateOperators"])
    return t.spark.range(1).select(F.lit(dropped).cast("bigint").alias("dropped"))


@query(
    "j2_stream_dedupe",
    """SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events""",
)
def j2_stream_dedupe(t: Tables):
    """One row per user out of the whole stream, which is one batch."""
    root = scratch_dir(t.spark, "dedupe")
    stream = t.event_stream().select(
        F.col("user_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("event_ts")
    )
    _finish(events.parquet_sink(events.dedupe(stream), f"{root}/out", f"{root}/chk", ["ds"], ONCE))
    return t.spark.read.parquet(f"{root}/out").select("id")


@query(
    "j2_batch_dedupe",
    "SELECT CAST(user_id AS VARCHAR) AS id, min(ts) AS event_ts, strftime(min(ts), '%Y-%m-%d') AS ds FROM events GROUP BY user_id",
)
def j2_batch_dedupe(t: Tables):
    rows = t.events.select(F.col("user_id").cast("string").alias("id"), F.col("ts").alias("event_ts"))
    return events.dedupe_batch(rows).withColumn("ds", F.date_format("ds", "yyyy-MM-dd"))


@query(
    "j4_fan_out",
    """SELECT part, count(*) AS n FROM (SELECT CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN 'bad' ELSE 'good' END AS part FROM events) GROUP BY part""",
)
def j4_fan_out(t: Tables):
    """One read of the source feeds good rows, rejected rows and metrics."""
    root = scratch_dir(t.spark, "fan-out")
    _finish(events.fan_out(_messages(t), f"{root}/out", f"{root}/chk", ingest_ts=now(), trigger=ONCE))
    parts = [
        t.spark.read.parquet(f"{root}/out/{part}").select(F.lit(part).alias("part")) for part in ("good", "bad")
    ]
    return parts[0].unionByName(parts[1]).groupBy("part").agg(F.count("*").alias("n"))


_TOPIC_SQL = """SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition, row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS "offset", ts FROM events"""


def _landed_topic(t: Tables) -> str:
    """The events' texts as a landed topic of four partitions with three segments each, in order of time."""
    folder = scratch_dir(t.spark, "topic")
    n, third = F.col("event_id"), F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    rows = t.as_messages(t.events).join(t.events.select("event_id", (F.col("user_id") % 4).cast("int").alias("partition")), "event_id")
    rows = rows.select("partition", n.cast("string").alias("key"), "value", F.col("ts").alias("timestamp"), F.struct("ts", "event_id").alias("sequence"), third.alias("third"))
    for part in range(3):
        topic.land(rows.filter(F.col("third") == part).drop("third"), folder)
    return folder.removeprefix("file://") if folder.startswith("file:///") else folder


@query("a1_topic_source", f"SELECT CAST(event_id AS VARCHAR) AS key, partition, \"offset\", value, ts AS kafka_ts FROM ({_TOPIC_SQL}) JOIN stream_event USING (event_id, ts)")
def a1_topic_source(t: Tables):
    """Every message of the topic with its partition and offset, in batches of a bounded number of messages, over a restart."""
    root, folder = scratch_dir(t.spark, "topic-out"), _landed_topic(t)
    limit = max(1, t.events.count() // 3)
    for last in (False, True):
        stream = topic.topic_stream(t.spark, folder, limit)
        writer = events.parquet_sink(stream.withColumnRenamed("timestamp", "kafka_ts"), f"{root}/out", f"{root}/chk", None, events.Trigger(seconds=0))
        try:
            if last:
                writer.processAllAvailable()
            else:
                while not writer.recentProgress and writer.isActive:  # stopped after its first batch
                    writer.awaitTermination(1)
        finally:
            writer.stop()
    return t.spark.read.parquet(f"{root}/out").select("key", "partition", "offset", "value", "kafka_ts")


@query("j6_topic_admission", "SELECT CAST(g AS BIGINT) AS batch, CAST(CASE WHEN g < 7 THEN ceil(n / 7.0) ELSE n - 6 * ceil(n / 7.0) END AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM events), (SELECT unnest(range(1, 8)) AS g)")
def j6_topic_admission(t: Tables):
    """A limit of a seventh of all messages: seven batches, all but the last full."""
    root, folder = scratch_dir(t.spark, "topic-admission"), _landed_topic(t)
    limit = -(-t.events.count() // 7)
    counted = topic.topic_stream(t.spark, folder, limit).select(F.lit(0.0).alias("latency_sec"))
    writer = events.metrics_sink(counted, f"{root}/out", f"{root}/chk", events.Trigger(seconds=0))
    try:
        writer.processAllAvailable()
    finally:
        writer.stop()
    batches = t.spark.read.parquet(f"{root}/out").filter("rows > 0")
    return batches.select((F.col("batch_id") + 1).cast("bigint").alias("batch"), "rows")
