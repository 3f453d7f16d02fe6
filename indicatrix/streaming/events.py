"""Event streams: sources, one transform shared with batch, sinks and metrics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from indicatrix.operators import contract
from indicatrix.operators.picks import pick_one
from indicatrix.session import scratch_dir
from indicatrix.sources import commits

# Stream settings.
TRIGGER_SECONDS = 5
LATENESS = "10 minutes"


@dataclass(frozen=True)
class Trigger:
    """Processing-time trigger, or one pass over what is there."""

    seconds: int = TRIGGER_SECONDS
    once: bool = False

    def apply(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.once:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=f"{self.seconds} seconds")


# -- sources -----------------------------------------------------------------------


def kafka_options(
    servers: str, topic: str, limit: int | None = None, start: str = "earliest", fail_on_data_loss: bool = True, **more: str
) -> dict[str, str]:
    """Options of the topic source. Nothing is skipped or held back unless the caller says so."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **more,
    }
    if limit:
        options["maxOffsetsPerTrigger"] = str(limit)
    return options


def kafka_source(spark: SparkSession, servers: str, topic: str, limit: int | None = None, **more):
    """Messages of a topic. Needs the Kafka connector on the class path."""
    return envelope(spark.readStream.format("kafka").options(**kafka_options(servers, topic, limit, **more)).load())


def envelope(messages: DataFrame) -> DataFrame:
    """Message text and broker time."""
    return messages.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("kafka_ts"))


def text_source(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Landed text files, one message per line."""
    reader = spark.readStream.schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


# -- transforms ---------------------------------------------------------------------


def split(
    messages: DataFrame, check_contract: bool = False, ingest_ts: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good events and rejected messages, for streams and batch tables alike."""
    parsed = contract.validate(messages) if check_contract else contract.parse(messages)
    return contract.good_events(parsed, ingest_ts), contract.bad_events(parsed, ingest_ts)


def _event_time(good: DataFrame) -> Column:
    """The event's time; where it has none that can be read, the time it came in."""
    return F.coalesce("event_ts", "ingest_ts") if "ingest_ts" in good.columns else F.col("event_ts")


def dedupe(good: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One event per id. State older than the watermark is dropped, and so are later events."""
    timed = good.withColumn("_time", _event_time(good)).withWatermark("_time", lateness)
    return timed.dropDuplicatesWithinWatermark(["id"]).withColumn("ds", F.to_date("_time")).drop("_time")


def dedupe_batch(good: DataFrame) -> DataFrame:
    """The batch twin: the earliest event of each id; events without any time come last."""
    timed = good.withColumn("_time", _event_time(good))
    unique = pick_one(timed, ["id"], [F.col("_time").asc_nulls_last()])
    return unique.withColumn("ds", F.to_date("_time")).drop("_time")


# -- sinks -----------------------------------------------------------------------------


def parquet_sink(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, trigger: Trigger = Trigger()
) -> StreamingQuery:
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return trigger.apply(writer).start()


def preview_sink(df: DataFrame, trigger: Trigger = Trigger(), memory_table: str | None = None) -> StreamingQuery:
    """The first rows of each batch on the console, or all rows in a named view of the session.

    Spark's memory and console sinks bring every row to the driver. Here tasks write the rows below the scratch folder, by batch, so a
    replay replaces its own; the view shows the batches that have ended.
    """
    if memory_table is None:
        return trigger.apply(df.writeStream.foreachBatch(_shown)).start()
    spark, root, schema = df.sparkSession, scratch_dir(df.sparkSession, "preview"), df.schema
    spark.createDataFrame([], schema).createOrReplaceTempView(memory_table)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch-{batch_id}")
        spark.read.schema(schema).parquet(f"{root}/rows/*").createOrReplaceTempView(memory_table)

    writer = df.writeStream.outputMode("append").queryName(memory_table).foreachBatch(write)
    return trigger.apply(writer.option("checkpointLocation", f"{root}/checkpoint")).start()


def _shown(batch: DataFrame, batch_id: int) -> None:
    print(f"-- batch {batch_id}")
    batch.show(20, truncate=False)


def batch_metrics(batch: DataFrame) -> DataFrame:
    """Rows and latency quantiles of one batch, in one aggregate."""
    latency = F.col("latency_sec").cast("double")
    return batch.agg(
        F.count("*").alias("rows"),
        F.percentile_approx(latency, 0.5).alias("p50"),
        F.percentile_approx(latency, 0.95).alias("p95"),
    )


def metrics_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A batch hook; a replayed batch replaces its own metrics."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_metrics(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def metrics_sink(df: DataFrame, path: str, checkpoint: str, trigger: Trigger = Trigger()) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(metrics_writer(path)).option("checkpointLocation", checkpoint)
    return trigger.apply(writer).start()


def clock() -> str:
    """Now, as text in UTC."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def arrival(spark: SparkSession, root: str, batch_id: int) -> Column:
    """When a batch came in: noted by its first attempt and read by every other one."""
    path = f"{root}/_arrivals/{batch_id:012d}.json"
    noted = commits.get(spark, path)
    if noted is None:
        commits.put_new(spark, path, {"at": clock()})
        noted = commits.get(spark, path)
    return F.lit(datetime.strptime(noted["at"] + "+0000", "%Y-%m-%d %H:%M:%S.%f%z"))


def fan_out_writer(root: str, ingest_ts: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Good rows, rejected rows and metrics out of one read of a batch of parsed messages.

    Rows lie below their day and batch, so readers prune by day and a replay replaces its own rows. All sinks of a batch, and all
    attempts at it, go by one time of arrival, so a replay finds the same days. ``ingest_ts`` stands in for that time.
    """

    def put(df: DataFrame, part: str, *by: str) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).parquet(f"{root}/{part}")

    def write(batch: DataFrame, batch_id: int) -> None:
        came = arrival(batch.sparkSession, root, batch_id) if ingest_ts is None else ingest_ts
        batch.persist()
        try:
            number = F.lit(batch_id).cast("bigint")
            good = contract.good_events(batch, came).withColumn("batch_id", number)
            bad = contract.bad_events(batch, came).withColumn("batch_id", number)
            put(good.withColumn("ds", F.to_date(_event_time(good))), "good", "ds", "batch_id")
            put(bad.withColumn("ds", F.to_date("ingest_ts")), "bad", "ds", "batch_id")
            put(batch_metrics(good).withColumn("batch_id", number), "metrics", "batch_id")
        finally:
            batch.unpersist()

    return write


def fan_out(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    check_contract: bool = True,
    ingest_ts: Column | None = None,
    trigger: Trigger = Trigger(),
) -> StreamingQuery:
    """One query that reads the source once and feeds all three sinks."""
    parsed = contract.validate(messages) if check_contract else contract.parse(messages)
    writer = parsed.writeStream.foreachBatch(fan_out_writer(root, ingest_ts)).option("checkpointLocation", checkpoint)
    return trigger.apply(writer).start()


def run_ct_stream(
    messages: DataFrame,
    out: str,
    dead_letter: str,
    checkpoint: str,
    ingest_ts: Column | None = None,
    trigger: Trigger = Trigger(),
    preview: bool = False,
) -> list[StreamingQuery]:
    """The certificate stream: unique events by day, rejected messages apart, a preview if asked for."""
    good, bad = split(messages, ingest_ts=ingest_ts)
    return [
        parquet_sink(dedupe(good), out, f"{checkpoint}/good", ["ds"], trigger),
        parquet_sink(bad, dead_letter, f"{checkpoint}/bad", None, trigger),
        *([preview_sink(good, trigger)] if preview else []),
    ]


def run_event_stream(
    messages: DataFrame,
    out: str,
    dead_letter: str,
    metrics: str,
    checkpoint: str,
    ingest_ts: Column | None = None,
    trigger: Trigger = Trigger(),
    check_contract: bool = False,
    preview: bool = False,
) -> list[StreamingQuery]:
    """The domain-event stream: events, rejected messages and batch metrics, each with its checkpoint."""
    good, bad = split(messages, check_contract, ingest_ts)
    return [
        parquet_sink(good, out, f"{checkpoint}/good", None, trigger),
        parquet_sink(bad, dead_letter, f"{checkpoint}/bad", None, trigger),
        metrics_sink(good, metrics, f"{checkpoint}/metrics", trigger),
        *([preview_sink(good, trigger)] if preview else []),
    ]
