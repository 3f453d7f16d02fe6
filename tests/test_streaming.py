import json

import pytest
from pyspark.sql import functions as F

from indicatrix.operators import contract
from indicatrix.streaming import events
from tests.conftest import rows

ONCE = events.Trigger(once=True)
NOW = F.lit("2024-01-01 12:00:00").cast("timestamp")


def message(i, at="2024-01-01T11:59:58.500Z", **more):
    return json.dumps({"id": str(i), "domain": f"d{i}.com", "tld": "com", "event_ts": at, "source": "s", "producer_ts": at, **more})


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    # Written aside first, so that the stream never sees half a file.
    part = folder / f".{name}"
    part.write_text("\n".join(lines) + "\n")
    part.rename(folder / name)


def run(*queries):
    for query in queries:
        query.awaitTermination()
        assert query.exception() is None
    return queries


def test_duplicates_restart_and_dead_letters(spark, tmp_path):
    src, out, dead, chk = (str(tmp_path / n) for n in ("in", "out", "dead", "chk"))
    land(tmp_path / "in", "a.txt", [message(1), message(1), message(2), "{broken", "[1]", message(3, "2024-01-02T00:00:30Z")])

    def once():
        return run(*events.run_ct_stream(events.text_source(spark, src), out, dead, chk, NOW, ONCE))

    once()
    assert rows(spark.read.parquet(out), "id") == [("1",), ("2",), ("3",)]
    assert {str(r["ds"]) for r in spark.read.parquet(out).collect()} == {"2024-01-01", "2024-01-02"}
    assert rows(spark.read.parquet(dead), "value", "reason") == [("[1]", "json_parse_failed"), ("{broken", "json_parse_failed")]
    # A second run has nothing new to read and writes nothing twice.
    once()
    assert spark.read.parquet(out).count() == 3 and spark.read.parquet(dead).count() == 2
    # Known id, new id, and an event far behind the watermark.
    land(tmp_path / "in", "b.txt", [message(3, "2024-01-02T00:00:40Z"), message(4, "2024-01-02T00:01:00Z"), message(5, "2024-01-01T00:00:00Z")])
    good, _ = once()
    assert rows(spark.read.parquet(out), "id") == [("1",), ("2",), ("3",), ("4",)]
    dropped = sum(s["numRowsDroppedByWatermark"] for p in good.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_stream_equals_batch(spark, tmp_path):
    texts = [message(i % 50, f"2024-01-01T11:{i % 10:02d}:00Z") for i in range(120)] + ["{x", message(7, tld=None)]
    land(tmp_path / "in", "a.txt", texts)
    src = str(tmp_path / "in")
    good, bad = events.split(events.text_source(spark, src), ingest_ts=NOW)
    run(events.parquet_sink(good, str(tmp_path / "good"), str(tmp_path / "c1"), None, ONCE), events.parquet_sink(bad, str(tmp_path / "bad"), str(tmp_path / "c2"), None, ONCE))
    batch_good, batch_bad = events.split(spark.read.text(src), ingest_ts=NOW)
    assert rows(spark.read.parquet(str(tmp_path / "good"))) == rows(batch_good)
    assert rows(spark.read.parquet(str(tmp_path / "bad"))) == rows(batch_bad)
    assert sorted(r[0] for r in rows(events.dedupe_batch(batch_good), "id")) == sorted(str(i) for i in range(50))


def test_metrics_are_replaced_on_replay(spark, tmp_path):
    path = str(tmp_path / "m")
    batch = spark.createDataFrame([(float(i),) for i in range(1, 101)], "latency_sec double")
    write = events.metrics_writer(path)
    write(batch, 0)
    write(batch, 0)
    write(batch.limit(0), 1)
    got = {r["batch_id"]: (r["rows"], r["p50"], r["p95"]) for r in spark.read.parquet(path).collect()}
    assert got == {0: (100, 50.0, 95.0), 1: (0, None, None)}


def test_fan_out_reads_once_and_validates(spark, tmp_path):
    land(tmp_path / "in", "a.txt", [message(1), message(2, domain=""), "{broken", message(3)])
    root = str(tmp_path / "out")
    for _ in range(2):
        run(events.fan_out(events.text_source(spark, str(tmp_path / "in")), root, str(tmp_path / "chk"), ingest_ts=NOW, trigger=ONCE))
    assert rows(spark.read.parquet(f"{root}/good"), "id", "latency_sec") == [("1", 1.5), ("3", 1.5)]
    reasons = [r[0] for r in rows(spark.read.parquet(f"{root}/bad"), "reason")]
    assert [r.split(":")[0] for r in reasons] == ["contract_violation", "json_decode_error"]
    assert rows(spark.read.parquet(f"{root}/metrics"), "rows", "p50") == [(2, 1.5)]


def test_a_replay_across_midnight_finds_the_same_days(spark, tmp_path, monkeypatch):
    """The first attempt breaks off after one sink, before midnight; the second one comes after it."""
    texts = [message(1), message(2, "never"), "{broken"]
    batch = contract.validate(spark.createDataFrame([(t,) for t in texts], "value string"))
    root = str(tmp_path / "out")
    write = events.fan_out_writer(root)
    monkeypatch.setattr(events, "clock", lambda: "2024-01-01 23:59:59.900000")
    real, calls = events.batch_metrics, []
    monkeypatch.setattr(events, "batch_metrics", lambda df: calls.append(df) or (_ for _ in ()).throw(OSError("stopped here")))
    with pytest.raises(OSError):
        write(batch, 7)
    monkeypatch.setattr(events, "batch_metrics", real)
    monkeypatch.setattr(events, "clock", lambda: "2024-01-02 00:00:05.000000")
    write(batch, 7)
    write(batch, 7)
    good, bad = (spark.read.parquet(f"{root}/{part}") for part in ("good", "bad"))
    assert rows(good.select("id", F.col("ds").cast("string"))) == [("1", "2024-01-01"), ("2", "2024-01-01")]
    assert rows(bad.select(F.col("ds").cast("string"), F.col("ingest_ts").cast("string"))) == [("2024-01-01", "2024-01-01 23:59:59.9")]
    assert rows(spark.read.parquet(f"{root}/metrics"), "batch_id", "rows") == [(7, 2)]
    write(batch.limit(1), 8)
    assert rows(spark.read.parquet(f"{root}/good").filter("batch_id = 8").select(F.col("ingest_ts").cast("string"))) == [("2024-01-02 00:00:05",)]


def test_event_stream_with_metrics(spark, tmp_path):
    land(tmp_path / "in", "a.txt", [message(1), "{broken"])
    paths = [str(tmp_path / n) for n in ("out", "dead", "metrics", "chk")]
    run(*events.run_event_stream(events.text_source(spark, str(tmp_path / "in")), *paths, NOW, ONCE))
    assert [spark.read.parquet(p).count() for p in paths[:3]] == [1, 1, 1]


def test_events_without_a_time_are_unique_too(spark, tmp_path):
    """Three batches bring one id without a readable time; the batch twin agrees."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        land(tmp_path / "in", f"{i}.txt", [message("n", "never"), message(i)])
        good, _ = events.split(events.text_source(spark, src), ingest_ts=NOW)
        run(events.parquet_sink(events.dedupe(good), out, str(tmp_path / "chk"), ["ds"], ONCE))
    want = ["0", "1", "2", "n"]
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == want
    twin = events.dedupe_batch(events.split(spark.read.text(src), ingest_ts=NOW)[0])
    assert sorted(r["id"] for r in twin.collect()) == want
    assert {str(r["ds"]) for r in twin.collect()} == {"2024-01-01"}


def test_earliest_event_wins_over_one_without_time(spark):
    df = spark.createDataFrame([("a", None), ("a", "2024-01-01 00:00:00")], "id string, t string").select("id", F.col("t").cast("timestamp").alias("event_ts"))
    assert events.dedupe_batch(df).first()["event_ts"] is not None


def test_admission_control(spark, tmp_path):
    for i in range(3):
        land(tmp_path / "in", f"{i}.txt", [message(i)])
    good, _ = events.split(events.text_source(spark, str(tmp_path / "in"), files_per_trigger=1), ingest_ts=NOW)
    query = events.parquet_sink(good, str(tmp_path / "out"), str(tmp_path / "chk"), None, ONCE)
    run(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert events.kafka_options("host:1", "topic", limit=7)["maxOffsetsPerTrigger"] == "7"
    plain = events.kafka_options("host:1", "topic")
    assert "maxOffsetsPerTrigger" not in plain and plain["failOnDataLoss"] == "true" and plain["startingOffsets"] == "earliest"


def test_preview(spark, tmp_path):
    land(tmp_path / "in", "a.txt", [message(1)])
    good, _ = events.split(events.text_source(spark, str(tmp_path / "in")), ingest_ts=NOW)
    query = events.preview_sink(good, events.Trigger(1), memory_table="preview")
    query.processAllAvailable()
    query.stop()
    assert rows(spark.table("preview"), "id") == [("1",)]


def test_preview_rows_stay_in_files(spark, tmp_path):
    """All batches are in the view, which reads what tasks wrote; nothing is held by the driver."""
    for i in range(3):
        land(tmp_path / "in", f"{i}.txt", [message(i)])
    good, _ = events.split(events.text_source(spark, str(tmp_path / "in"), files_per_trigger=1), ingest_ts=NOW)
    run(events.preview_sink(good, ONCE, memory_table="preview_files"))
    shown = spark.table("preview_files")
    assert shown.columns == good.columns and rows(shown, "id") == [("0",), ("1",), ("2",)]
    files = shown.inputFiles()
    assert files and {f.rsplit("/", 2)[1] for f in files} == {"batch-0", "batch-1", "batch-2"}


def test_preview_on_the_console(spark, tmp_path, capsys):
    land(tmp_path / "in", "a.txt", [message(1)])
    good, _ = events.split(events.text_source(spark, str(tmp_path / "in")), ingest_ts=NOW)
    run(events.preview_sink(good, ONCE))
    assert "-- batch 0" in capsys.readouterr().out


def test_dedupe_keeps_bounded_state(spark, tmp_path):
    """Only the operator that drops old state is used."""
    good, _ = events.split(events.text_source(spark, str(tmp_path)), ingest_ts=NOW)
    plan = events.dedupe(good)._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark" in plan and "EventTimeWatermark" in plan


def test_envelope(spark):
    df = spark.sql("SELECT cast('x' AS binary) value, timestamp'2024-01-01' timestamp, 'k' key")
    assert [str(v) for v in events.envelope(df).first()] == ["x", "2024-01-01 00:00:00"]
