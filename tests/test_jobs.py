"""The jobs end to end on small landed files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from indicatrix.operators import models
from indicatrix.plans import jobs
from tests.conftest import rows

DS, NOW = "2024-02-01", "2024-02-01 12:00:00"
SPEC = models.FeatureSpec(gram_width=64, category_width=16)
NAMES = [f"evil{i}-login.com" for i in range(30)] + [f"bad{i}.co.uk" for i in range(30)]
SEEDS = [f"nice{c}.org" for c in "abcdefghijklmnopqrstuvwxyz"] + [f"good{c}.net" for c in "abcdefghijklmnopqrstuvwxyz"]


@pytest.fixture(scope="module")
def at(spark, tmp_path_factory):
    return jobs.Layout(str(tmp_path_factory.mktemp("lake")))


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    lines = [f'"{i}","2024-01-31 0{i % 10}:00:00","http://www.{n}/x{i}","online","","malware_download","","l","r"' for i, n in enumerate(NAMES[:30])]
    (folder / "malware.csv").write_text("# Last updated: 2024-02-01 10:00:00 (UTC)\n" + "\n".join(lines) + "\n")
    (folder / "phish.txt").write_text("\n".join(f"https://{n}/login" for n in NAMES[30:]) + "\n")
    (folder / "list").mkdir()
    event = {"Event": {"id": "7", "date": "2024-01-30", "Orgc": {"name": "o"}, "Tag": [{"name": "t"}], "Attribute": [
        {"value": "bad0.co.uk", "type": "domain", "category": "Phish-Kit"}, {"value": "9.9.9.9", "type": "ip-dst", "category": "c2"}]}}
    (folder / "list" / "e.json").write_text(json.dumps(event, indent=1))
    return folder


def test_daily_layers(spark, at, landed):
    feed = str(landed / "malware.csv")
    with pytest.raises(jobs.FailedChecks):
        jobs.ingest_malware(spark, at, feed, DS, "2024-02-02 00:00:00", min_rows=20)
    assert jobs.ingest_malware(spark, at, feed, "2024-01-31", NOW, today=DS) == "history"
    for _ in range(2):
        assert jobs.ingest_malware(spark, at, feed, DS, NOW, today=DS, min_rows=20) == "written"
        assert jobs.ingest_phish(spark, at, str(landed / "phish.txt"), DS, NOW, today=DS, min_rows=20) == "written"
        assert jobs.daily_silver(spark, at, DS) == {"urlhaus": "written", "openphish": "written"}
        seeds = spark.createDataFrame([(n, f"http://{n}/") for n in SEEDS], "domain string, url string").withColumns(
            {"first_seen": F.lit("2024-01-15").cast("timestamp"), "label": F.lit("benign"), "source": F.lit("benign_seed")}
        )
        assert jobs.daily_union(spark, at, DS, [seeds]) == "written"
        assert jobs.ingest_threat_list(spark, at, str(landed / "list"), DS, min_rows=2) == "written"
    assert jobs.daily_silver(spark, at, "2023-01-01") == {"urlhaus": "no_input", "openphish": "no_input"}
    labels = jobs.labels_of(spark, at)
    assert labels.count() == 60 + len(SEEDS)
    assert rows(labels.filter("url = 'http://www.evil3-login.com/x3'"), "registered_domain", "seen_in_urlhaus") == [("evil3-login.com", True)]


def test_lookups(spark, at):
    names = jobs.domains_of_day(spark, at, DS)
    assert names.count() == 60 + len(SEEDS)
    pairs = names.select("puny_domain", F.when(F.col("domain") == "bad1.co.uk", "9.9.9.9").otherwise(F.concat(F.lit("1.2.3."), F.length("domain").cast("string"))).alias("ip"))
    pairs = pairs.filter("puny_domain <> 'bad2.co.uk'")
    value = F.lit(json.dumps({"status": "success", "country": "NL", "as": "AS1 Net", "isp": "I"}))
    answers = pairs.select("ip", F.lit("ip_api").alias("provider"), value.alias("value")).distinct()
    total = 60 + len(SEEDS)
    first = jobs.merge_dns(spark, at, DS, NOW, pairs, answers).first()
    assert (first["total_domains"], first["new_pairs_resolved"], first["daily_rows"], first["cache_size"]) == (total, total - 1, total - 1, total - 1)
    again = jobs.merge_dns(spark, at, DS, NOW, pairs, answers).first()
    assert (again["new_pairs_resolved"], again["daily_rows"], again["cache_size"]) == (0, total - 1, total - 1)

    assert jobs.whois_to_fetch(spark, at, DS, NOW).count() == total
    body = json.dumps({"registrar": {"name": "Reg"}, "status": ["active"], "events": [{"eventAction": "registration", "eventDate": "2020-01-01T00:00:00Z"}]})
    responses = names.select(
        "domain", F.when(F.col("domain") == "bad3.co.uk", 500).otherwise(200).alias("http_status"), F.lit(body).alias("body"),
        F.lit(None).cast("string").alias("error"), F.lit(NOW).cast("timestamp").alias("fetched_at"),
    )
    assert jobs.merge_whois(spark, at, DS, responses) == "written"
    assert jobs.whois_to_fetch(spark, at, DS, NOW).count() == 0
    assert rows(jobs.whois_to_fetch(spark, at, DS, "2024-02-10 00:00:00")) == [("bad3.co.uk",)]
    assert jobs.whois_to_fetch(spark, at, DS, "2024-03-10 00:00:00").count() == total


def test_training_and_publishing(spark, at):
    scratch = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(scratch))
    meta = jobs.train_model(spark, at, DS, NOW, spec=SPEC, estimator=models.logistic(80, 25)).first()
    assert set(os.listdir(scratch)) == before
    assert (meta["n_rows"], meta["n_pos"], meta["n_neg"]) == (60 + len(SEEDS), 60, len(SEEDS))
    assert meta["metrics"]["roc_auc"] > 0.9
    exported = jobs.publish_threats(spark, at, DS, NOW, SPEC)
    got = {r["domain"]: r for r in exported.collect()}
    assert len(got) == 60 + len(SEEDS)
    assert (got["bad0.co.uk"]["source"], got["bad0.co.uk"]["threatType"], got["bad0.co.uk"]["riskScore"]) == ("misp_osint", "phish-kit", 1.0)
    assert got["bad1.co.uk"]["threatType"] == "network infrastructure overlap"
    assert got["bad2.co.uk"]["source"] == "openphish" and got["bad2.co.uk"]["country"] == "Unknown"
    threats = spark.read.json(f"{at.gold__threats}/ds={DS}")
    assert threats.count() == len(got) and set(threats.columns) == set(exported.columns)
    stats = spark.read.json(f"{at.gold__statistics}/ds={DS}").first()
    assert stats["totalSamples"] == stats["exportedCount"] == len(got)
    drift = spark.read.json(f"{at.gold__drift}/ds={DS}").first()
    assert drift["date"] == DS and drift["alert"] is None and drift["risk_distribution"]["CRITICAL"] >= 2 and drift["top_asns"]["AS1"] == len(got) - 1
    meta = spark.read.json(f"{at.gold__model_meta}/ds={DS}").first()
    assert meta["model_file"] == f"model-{DS}" and meta["metrics"]["roc_auc"] > 0.9
    assert jobs.publish_threats(spark, at, "2023-01-01", NOW, SPEC) is None
    # A second run of the day changes nothing.
    again = jobs.publish_threats(spark, at, DS, NOW, SPEC)
    assert rows(again) == sorted((tuple(r) for r in got.values()), key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert spark.read.parquet(at.gold__history).count() == 1


def test_certificate_path(spark, at):
    events = spark.createDataFrame(
        [("*.a-login.com", 3), ("www.a-login.com.", 1), ("b.org", 2), ("10.0.0.1", 2), ("c.co.uk", 5)], "domain string, t int"
    ).select("domain", F.timestamp_seconds("t").alias("event_ts"), F.lit("certstream").alias("source"), F.timestamp_seconds("t").alias("ingest_ts"), F.lit("2024-02-01").alias("ds"))
    base = jobs.ct_domains(events)
    assert rows(base, "registered_domain", "domain") == [("a-login.com", "www.a-login.com"), ("b.org", "b.org"), ("c.co.uk", "c.co.uk")]
    assert jobs.ct_domains(events, rows=1).count() == 1
    many = spark.range(30_000).select(
        F.concat(F.lit("d"), "id", F.lit(".com")).alias("domain"), F.timestamp_seconds("id").alias("event_ts"), F.lit("s").alias("source"),
        F.timestamp_seconds("id").alias("ingest_ts"), F.lit("2024-02-01").alias("ds"),
    )
    assert jobs.ct_domains(many, runs=7).count() == jobs.ct_domains(many).count() == 30_000
    resolved = spark.createDataFrame([("a-login.com", "1.1.1.1"), ("a-login.com", "::1"), ("b.org", "1.1.1.1")], "registered_domain string, ip string")
    answers = spark.createDataFrame([("1.1.1.1", json.dumps({"status": "success", "country": "US", "as": "AS1 N", "asname": "N"}))], "ip string, value string")
    enriched = jobs.ct_facts(base, resolved, answers)
    got = {r["registered_domain"]: r for r in enriched.collect()}
    assert (got["a-login.com"]["num_unique_ips"], got["a-login.com"]["has_ipv6"], got["a-login.com"]["sample_asn"]) == (2, 1, "AS1 N")
    assert got["c.co.uk"]["num_unique_ips"] == 0
    scored = jobs.ct_scores(models.newest(spark, at.models), enriched, SPEC)
    assert scored.count() == 3 and scored.filter("risk_bucket IS NULL").count() == 0
    reports = jobs.ct_reports(scored)
    assert reports["summary"].first()["count"] == 3 and rows(reports["keywords"], "registered_domain") == [("a-login.com",)]
    assert {name for name, df in reports.items() if df.count() == 0} == {"tld", "country"}
