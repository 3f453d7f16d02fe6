"""Landed topics: offsets, limits, restarts and lost messages."""

import os

import pytest
from pyspark.sql import functions as F

from indicatrix.streaming import events, topic
from tests.conftest import rows

MESSAGES = "partition int, key string, value string, timestamp string, sequence int"


def landed(table, folder, *parts):
    for part in parts:
        topic.land(table(part, MESSAGES).withColumn("timestamp", F.col("timestamp").cast("timestamp")), str(folder))


def message(partition, n, value=None):
    return (partition, f"k{n}", value or f"v{n}", f"2024-01-01 00:00:{n % 60:02d}.5", n)


@pytest.fixture
def folder(table, tmp_path):
    landed(table, tmp_path / "t", [message(n % 2, n) for n in range(10)], [message(0, n) for n in range(10, 14)])
    return tmp_path / "t"


def drained(spark, folder, out, **how):
    query = events.parquet_sink(topic.topic_stream(spark, str(folder), **how), f"{out}/rows", f"{out}/chk", None, events.Trigger(seconds=0))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return rows(spark.read.schema(topic.SCHEMA).parquet(f"{out}/rows"), "partition", "offset", "value")


WANT = sorted([(0, i, f"v{2 * i}") for i in range(5)] + [(1, i, f"v{2 * i + 1}") for i in range(5)] + [(0, 5 + i, f"v{10 + i}") for i in range(4)])


def test_offsets_times_and_texts(spark, table, tmp_path):
    landed(table, tmp_path / "t", [message(0, 1, 'é "x"\n  {'), (0, None, None, None, 2)])
    assert drained(spark, tmp_path / "t", tmp_path / "out") == [(0, 0, 'é "x"\n  {'), (0, 1, None)]
    got = spark.read.parquet(f"{tmp_path}/out/rows").orderBy("offset").select("key", F.col("timestamp").cast("string")).collect()
    assert [tuple(r) for r in got] == [("k1", "2024-01-01 00:00:01.5"), (None, None)]


def test_all_messages_and_a_restart_with_more(spark, table, folder, tmp_path):
    assert drained(spark, folder, tmp_path / "out") == WANT
    assert drained(spark, folder, tmp_path / "out") == WANT
    landed(table, folder, [message(1, 20), message(2, 21)])
    assert drained(spark, folder, tmp_path / "out") == sorted([*WANT, (1, 5, "v20"), (2, 0, "v21")])


@pytest.mark.parametrize("limit", [1, 3, 5, 100])
def test_limit_of_a_batch(spark, folder, tmp_path, limit):
    counted = topic.topic_stream(spark, str(folder), limit).select(F.lit(1.0).alias("latency_sec"))
    query = events.metrics_sink(counted, f"{tmp_path}/m", f"{tmp_path}/c", events.Trigger(seconds=0))
    query.processAllAvailable()
    query.stop()
    sizes = [r["rows"] for r in spark.read.parquet(f"{tmp_path}/m").orderBy("batch_id").collect()]
    assert sum(sizes) == 14 and max(sizes) <= limit and len([n for n in sizes if n]) == -(-14 // limit)


def test_a_limited_stream_goes_on_where_it_stopped(spark, folder, tmp_path):
    query = events.parquet_sink(topic.topic_stream(spark, str(folder), 4), f"{tmp_path}/out/rows", f"{tmp_path}/out/chk", None, events.Trigger(seconds=0))
    while not query.recentProgress:
        query.awaitTermination(1)
    query.stop()
    assert drained(spark, folder, tmp_path / "out", limit=4) == WANT


def test_start_positions(spark, table, folder, tmp_path):
    assert drained(spark, folder, tmp_path / "a", start='{"0": 7, "1": 4}') == [(0, 7, "v12"), (0, 8, "v13"), (1, 4, "v9")]
    query = events.parquet_sink(topic.topic_stream(spark, str(folder), start="latest"), f"{tmp_path}/b/rows", f"{tmp_path}/b/chk", None, events.Trigger(seconds=0))
    query.processAllAvailable()
    landed(table, folder, [message(0, 30)])
    query.processAllAvailable()
    query.stop()
    assert rows(spark.read.parquet(f"{tmp_path}/b/rows"), "partition", "offset", "value") == [(0, 9, "v30")]


def test_lost_messages(spark, table, folder, tmp_path):
    out = tmp_path / "out"
    query = events.parquet_sink(topic.topic_stream(spark, str(folder), 2), f"{out}/rows", f"{out}/chk", None, events.Trigger(seconds=0))
    while not query.recentProgress:
        query.awaitTermination(1)
    query.stop()
    before = rows(spark.read.parquet(f"{out}/rows"), "partition", "offset", "value")
    os.remove(topic.segment_path(str(folder), 0, 0))
    if len([r for r in before if r[0] == 0]) < 5:
        with pytest.raises(Exception, match="gone"):
            drained(spark, folder, out)
    left = [r for r in WANT if r[0] == 1 or r[1] >= 5]
    assert drained(spark, folder, out, fail_on_data_loss=False) == sorted({*before, *left})


def test_no_topic_yet(spark, table, tmp_path):
    query = events.parquet_sink(topic.topic_stream(spark, f"{tmp_path}/none"), f"{tmp_path}/o/rows", f"{tmp_path}/o/chk", None, events.Trigger(seconds=0))
    query.processAllAvailable()
    landed(table, tmp_path / "none", [message(3, 1)])
    query.processAllAvailable()
    query.stop()
    assert rows(spark.read.parquet(f"{tmp_path}/o/rows"), "partition", "offset", "value") == [(3, 0, "v1")]
