"""Landed topics: segments of a message log as files, written by Spark and read as a stream with offsets.

A topic is a folder with one folder per topic partition, and in it segments named by the offset of their first message:
``partition=3/00000000000000001200.jsonl``. A line is one message, an object with key, value and timestamp. Segments are complete
when they appear and never change; old ones may be deleted. This is what a mirror of a message broker leaves in a data lake.

The reader is a streaming data source of its own: the driver lists names, one task reads one segment from one offset to another.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Readers travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "landed_topic"
SCHEMA = "partition int, offset long, key string, value string, timestamp timestamp"
ROWS_PER_BATCH = 10_000


class LostMessages(RuntimeError):
    """Messages that the stream has yet to read are gone."""


def opened(folder: str):
    """File system and plain path of a folder."""
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def segments(folder: str) -> dict[int, list[int]]:
    """First offsets of the segments of each topic partition, in order."""
    from pyarrow import fs

    files, root = opened(folder)
    found: dict[int, list[int]] = {}
    for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        parent, _, name = info.path.rpartition("/")
        at = parent.rpartition("/")[2]
        if info.type == fs.FileType.Directory and name.startswith("partition="):
            found.setdefault(int(name.removeprefix("partition=")), [])
        elif name.endswith(".jsonl") and at.startswith("partition="):
            found.setdefault(int(at.removeprefix("partition=")), []).append(int(name.removesuffix(".jsonl")))
    return {p: sorted(bases) for p, bases in sorted(found.items())}


def segment_path(folder: str, partition: int, base: int) -> str:
    return f"{folder}/partition={partition}/{base:020d}.jsonl"


def lines_in(folder: str, partition: int, base: int) -> int:
    files, root = opened(folder)
    count = 0
    with files.open_input_stream(segment_path(root, partition, base)) as source:
        while chunk := source.read(1 << 20):
            count += chunk.count(b"\n")
    return count


@dataclass
class Segment(InputPartition):
    """Messages from ``first`` up to ``last`` (exclusive) of one segment."""

    partition: int
    base: int
    first: int
    last: int


class LandedTopic(DataSource):
    """Options: ``path``; ``startingOffsets`` (earliest, latest, or JSON of offsets by partition); ``maxOffsetsPerTrigger``; ``failOnDataLoss``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TopicReader(dict(self.options))


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.folder = options["path"]
        self.start = options.get("startingoffsets", "earliest")
        limit = options.get("maxoffsetspertrigger")
        self.limit = int(limit) if limit else None
        self.strict = options.get("failondataloss", "true").lower() == "true"
        self.reached: dict[str, int] | None = None
        self.counted: dict[tuple[int, int], int] = {}

    # -- offsets: {partition: next message} ------------------------------------------

    def earliest(self) -> dict[str, int]:
        return {str(p): bases[0] for p, bases in segments(self.folder).items() if bases}

    def newest(self) -> dict[str, int]:
        out = {}
        for p, bases in segments(self.folder).items():
            if bases:
                key = (p, bases[-1])
                if key not in self.counted:
                    self.counted[key] = lines_in(self.folder, *key)
                out[str(p)] = bases[-1] + self.counted[key]
        return out

    def initialOffset(self) -> dict[str, int]:
        if self.start == "earliest":
            return self.earliest()
        if self.start == "latest":
            return self.newest()
        given = json.loads(self.start)
        return {p: given.get(p, first) for p, first in self.earliest().items()}

    def latestOffset(self) -> dict[str, int]:
        """All that is there, or as much of it as one batch may take, shared out by what each partition has waiting."""
        there = self.newest()
        if self.reached is None:
            self.reached = self.initialOffset()
        # A partition that was found later starts with its first message; none is ever left out again.
        first = self.earliest()
        start = {p: self.reached.get(p, first.get(p, 0)) for p in there} | {p: at for p, at in self.reached.items() if p not in there}
        waiting = {p: max(0, there.get(p, at) - at) for p, at in start.items()}
        total = sum(waiting.values())
        if self.limit is not None and total > self.limit:
            shares = {p: n * self.limit // total for p, n in waiting.items()}
            # What rounding leaves goes to the longest queues.
            for p in sorted(waiting, key=lambda p: (-waiting[p], p))[: self.limit - sum(shares.values())]:
                shares[p] += shares[p] < waiting[p]
            waiting = shares
        self.reached = {p: at + waiting[p] for p, at in start.items()}
        return self.reached

    # -- batches -----------------------------------------------------------------------

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        # After a restart the engine plans its last batch again, which tells where the stream is.
        if self.reached is None:
            self.reached = end
        known, out = segments(self.folder), []
        for p, last in end.items():
            bases = known.get(int(p), [])
            first = start.get(p, bases[0] if bases else last)
            if first >= last:
                continue
            if not bases or bases[0] > first:
                if self.strict:
                    raise LostMessages(f"partition {p}: messages from {first} on are gone; the first one left is {bases[0] if bases else 'none'}")
                first = min(last, bases[0] if bases else last)
            for base, following in zip(bases, [*bases[1:], last]):
                low, high = max(first, base), min(last, following)
                if low < high:
                    out.append(Segment(int(p), base, low, high))
        return out

    def read(self, partition: Segment):
        files, root = opened(self.folder)
        types = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.timestamp("us", "UTC")]
        names = [c.split()[0] for c in SCHEMA.split(", ")]

        def batch(offsets, found):
            when = pa.array([m.get("timestamp") for m in found], pa.string()).cast(pa.timestamp("us", "UTC"))
            columns = [pa.array([partition.partition] * len(found), types[0]), pa.array(offsets, types[1]), *(pa.array([m.get(k) for m in found], pa.string()) for k in ("key", "value")), when]
            return pa.record_batch(columns, names)

        offsets, found, expected = [], [], partition.last - partition.first
        with files.open_input_stream(segment_path(root, partition.partition, partition.base)) as source:
            for offset, line in enumerate(lines(source), partition.base):
                if offset >= partition.last:
                    break
                if offset < partition.first:
                    continue
                offsets.append(offset)
                found.append(json.loads(line))
                if len(found) == ROWS_PER_BATCH:
                    yield batch(offsets, found)
                    expected -= len(found)
                    offsets, found = [], []
        if found:
            yield batch(offsets, found)
        if self.strict and expected != len(found):
            raise LostMessages(f"partition {partition.partition}, segment {partition.base}: {expected - len(found)} messages are gone")

    def commit(self, end: dict[str, int]) -> None:
        pass


def lines(source):
    """Lines of a stream of bytes, read in large pieces."""
    rest = b""
    while chunk := source.read(1 << 20):
        *whole, rest = (rest + chunk).split(b"\n")
        yield from whole


def topic_stream(spark: SparkSession, folder: str, limit: int | None = None, start: str = "earliest", fail_on_data_loss: bool = True) -> DataFrame:
    """Messages of a landed topic as a stream with partition, offset, key, value and timestamp. Nothing is skipped unless asked for."""
    spark.dataSource.register(LandedTopic)
    reader = spark.readStream.format(FORMAT).option("path", folder).option("startingOffsets", start).option("failOnDataLoss", str(fail_on_data_loss).lower())
    return (reader.option("maxOffsetsPerTrigger", str(limit)) if limit else reader).load()


def land(messages: DataFrame, folder: str) -> DataFrame:
    """Append messages (partition, key, value, timestamp, in the order of ``sequence``) as one new segment per topic partition.

    Returns (partition, base, messages) of the segments. A task writes a segment under a name of its own and moves it at the end.
    """
    reader = TopicReader({"path": folder})
    ends = {int(p): n for p, n in reader.newest().items()}

    def run(batches):
        import uuid

        files, root = opened(folder)
        out, at, draft, count = None, None, "", 0

        def close():
            out.close()
            files.move(draft, segment_path(root, at, ends.get(at, 0)))
            return pa.record_batch([pa.array([at], pa.int32()), pa.array([ends.get(at, 0)]), pa.array([count])], ["partition", "base", "messages"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["partition"] != at:
                    if out is not None:
                        yield close()
                    at, count = row["partition"], 0
                    files.create_dir(f"{root}/partition={at}", recursive=True)
                    draft = f"{root}/partition={at}/.{uuid.uuid4().hex}"
                    out = files.open_output_stream(draft)
                message = {"key": row["key"], "value": row["value"], "timestamp": row["timestamp"]}
                out.write(json.dumps(message, ensure_ascii=False).encode() + b"\n")
                count += 1
        if out is not None:
            yield close()

    when = F.date_format(F.to_utc_timestamp("timestamp", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    rows = messages.select(F.col("partition").cast("int"), F.col("key").cast("string"), F.col("value").cast("string"), when.alias("timestamp"), "sequence")
    ordered = rows.repartition("partition").sortWithinPartitions("partition", "sequence")
    spark = messages.sparkSession
    # Written once; what comes back is one row per topic partition.
    found = ordered.mapInArrow(run, "partition int, base long, messages long").collect()
    return spark.createDataFrame(found, "partition int, base long, messages long")
