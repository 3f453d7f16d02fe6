import os

import pytest
from pyspark.sql import functions as F

from indicatrix import schemas
from indicatrix.operators import layers, picks, quality
from indicatrix.sources import commits, feeds, tables
from tests.conftest import rows

NOW = F.lit("2024-02-01 00:00:00").cast("timestamp")


def test_malware_feed_to_union(spark, table, tmp_path):
    (tmp_path / "feed.csv").write_text(
        "# Last updated: 2024-01-31 20:00:00 (UTC)\n"
        '"1","2024-01-05 01:02:03","http://1.2.3.4:80/a,b","online","","malware_download","elf,mirai","link","rep"\n'
        '"2","bad date","http://Host.example/x","offline","","","","link","rep"\n'
        '"3","2024-01-05 01:02:03","http://1.2.3.4:80/a,b","online","","other","","link","rep"\n'
        '"4","2024-01-05 01:02:03","http:///nohost","online","","x","","link","rep"\n'
    )
    raw = feeds.read_malware_csv(spark, str(tmp_path / "feed.csv"), "2024-02-01")
    bronze = layers.bronze_malware(raw, NOW)
    assert bronze.columns == schemas.BRONZE_MALWARE.fieldNames()
    got = {r["url"]: (r["domain"], str(r["first_seen"])) for r in bronze.collect()}
    assert got == {
        "http://1.2.3.4:80/a,b": ("1.2.3.4", "2024-01-05 01:02:03"),
        "http://Host.example/x": ("host.example", "2024-02-01 00:00:00"),
    }
    silver = layers.silver_malware(bronze)
    assert ("host.example", "unknown", "urlhaus") in rows(silver, "domain", "label", "source")
    age = quality.feed_age(feeds.read_feed_header(spark, str(tmp_path / "feed.csv")), NOW).first()
    assert age["age_hours"] == 4.0 and age["stale"] is False


def test_unknown_layout(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,http://a.example/,x\n2,https://b.example/,y\n3,none,z\n")
    df = feeds.read_malware_csv(spark, str(tmp_path / "a.csv"), "2024-02-01")
    assert df.columns == ["c0", "url", "c2", "dateadded"]
    (tmp_path / "b.csv").write_text("p,q\nr,s\n")
    assert feeds.read_malware_csv(spark, str(tmp_path / "b.csv"), "2024-02-01").columns == ["url", "c1", "dateadded"]


def test_line_feed(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("# note\n\n  http://a.example/x \n   \nhttp://b.example/#frag\n")
    urls = rows(feeds.read_url_lines(spark, str(tmp_path / "lines.txt")))
    assert urls == [("http://a.example/x",), ("http://b.example/#frag",)]
    bronze = layers.bronze_phish(feeds.read_url_lines(spark, str(tmp_path / "lines.txt")), NOW)
    assert bronze.columns == schemas.BRONZE_PHISH.fieldNames() and bronze.count() == 2


def test_union_of_nothing_is_an_empty_table(spark):
    empty = layers.label_union(spark)
    assert empty.schema == schemas.LABELS_UNION and empty.count() == 0


def test_union_keeps_distinct_urls_and_flags(spark, table):
    schema = "domain string, url string, first_seen timestamp, label string, source string"
    day = spark.sql("SELECT timestamp'2024-01-01'").first()[0]
    malware = table([("d", "u1", day, "m", "urlhaus"), ("d", "u1", day, "m", "urlhaus"), ("d", "u2", day, "m", "urlhaus")], schema)
    phish = table([("d", "u1", day, "phishing", "openphish"), (None, "u", day, "phishing", "openphish"), ("d", "u", None, "p", "openphish")], schema)
    got = rows(layers.label_union(spark, malware, phish), "url", "source", "seen_in_urlhaus", "seen_in_openphish")
    assert got == [("u1", "openphish", False, True), ("u1", "urlhaus", True, False), ("u2", "urlhaus", True, False)]


def test_picks_do_not_depend_on_partitioning(spark):
    n = F.col("id")
    data = spark.range(3000).select(
        (n % 7).cast("string").alias("domain"),
        F.timestamp_seconds(n % 5).alias("first_seen"),
        F.concat(F.lit("u"), (n % 11).cast("string")).alias("url"),
        (n % 13).cast("string").alias("label"),
        (n % 3).cast("string").alias("source"),
        (n % 7).cast("string").alias("registered_domain"),
        F.timestamp_seconds(n % 4).alias("fetched_at"),
        F.timestamp_seconds(n % 4).alias("event_ts"),
        F.timestamp_seconds(n % 6).alias("ingest_ts"),
        (n % 2).cast("string").alias("event_id"),
        (n % 17).cast("string").alias("category"),
    )
    for pick in (
        picks.malware_silver, picks.phish_silver, picks.union_labels, picks.label_per_domain,
        picks.category_per_domain, picks.latest_whois, picks.latest_ct, picks.first_ct,
    ):
        one = rows(pick(data.coalesce(1)))
        many = rows(pick(data.orderBy(F.rand(1)).repartition(8)))
        assert one == many, pick.__name__


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    data = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id"))).alias("domain"),
        F.timestamp_seconds("id").alias("first_seen"), F.col("id").cast("string").alias("url"),
    )
    picked = picks.pick_one(data, ["domain"], [F.col("first_seen").desc()])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert rows(picked.filter("domain = 'hot'"), "url") == [("99999",)]


def test_publishing_rules(spark, table, tmp_path):
    path = str(tmp_path / "t")
    some = table([(i,) for i in range(60)], "x int")
    few = table([(1,)], "x int")
    assert tables.publish_day(some, path, "2024-01-01", 50, today="2024-01-02") == "history"
    assert tables.publish_day(None, path, "2024-01-01") == "no_input"
    assert tables.publish_day(some.limit(0), path, "2024-01-01") == "no_input"
    try:
        tables.publish_day(few, path, "2024-01-01", 50)
        raise AssertionError("too few rows on the first run must fail")
    except ValueError:
        pass
    assert tables.publish_day(some, path, "2024-01-01", 50) == "written"
    assert tables.publish_day(few, path, "2024-01-01", 50) == "kept"
    assert tables.publish_day(few, path, "2024-01-02") == "written"
    before = rows(tables.read_table(spark, path))
    assert tables.publish_day(some, path, "2024-01-01", 50) == "written"
    assert rows(tables.read_table(spark, path)) == before and len(before) == 61
    assert rows(tables.listed_days(tables.read_table(spark, path), ["2024-01-02"]), "x") == [(1,)]


def test_publishing_that_breaks_off(spark, table, tmp_path, monkeypatch):
    """Before the commit readers take the old day, after it the new one; there is no time between."""
    path, schema = str(tmp_path / "t"), "x int, ingest_date date"
    read = lambda: rows(tables.read_table(spark, path, spark.createDataFrame([], schema).schema), "x")

    def broken(*args):
        raise OSError("stopped here")

    with monkeypatch.context() as m:
        m.setattr(commits, "put_new", broken)
        with pytest.raises(OSError):
            tables.publish_day(table([(9,)], "x int"), path, "2024-01-01")
    assert read() == [] and not tables.day_exists(spark, path, "2024-01-01")
    assert tables.publish_day(table([(1,)], "x int"), path, "2024-01-01") == "written"
    with monkeypatch.context() as m:
        m.setattr(commits, "put_new", broken)
        with pytest.raises(OSError):
            tables.publish_day(table([(2,), (3,)], "x int"), path, "2024-01-01")
    assert read() == [(1,)]
    old = tables.read_table(spark, path)
    with monkeypatch.context() as m:
        m.setattr(tables, "drop_attempts", broken)
        with pytest.raises(OSError):
            tables.publish_day(table([(4,)], "x int"), path, "2024-01-01")
    assert read() == [(4,)] and rows(old, "x") == [(1,)]
    for n in (5, 6):
        assert tables.publish_day(table([(n,)], "x int"), path, "2024-01-01") == "written"
    assert read() == [(6,)]
    assert len([n for n in os.listdir(f"{path}/ingest_date=2024-01-01") if n.startswith("attempt-")]) == 2


def test_days_of_both_kinds(spark, table, tmp_path):
    """Days written in place are read beside published ones, and replaced by them."""
    path = str(tmp_path / "t")
    for day in ("2024-01-01", "2024-01-02"):
        tables.write_day(table([(day,)], "x string"), path, day)
    assert tables.day_exists(spark, path, "2024-01-02")
    assert tables.publish_day(table([("new",)], "x string"), path, "2024-01-02") == "written"
    assert rows(tables.read_table(spark, path).select("x", F.col("ingest_date").cast("string"))) == [("2024-01-01", "2024-01-01"), ("new", "2024-01-02")]


def test_scans_prune_partitions(spark, table, tmp_path):
    path = str(tmp_path / "t")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        tables.write_day(table([(day, 1)], "a string, b int"), path, day)
    df = tables.read_table(spark, path)
    late = tables.trailing_days(df, "2024-01-03", 2).select("b")
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "ReadSchema: struct<b:int>" in plan
    assert rows(tables.trailing_days(df, "2024-01-03", 2), "a") == [("2024-01-02",), ("2024-01-03",)]
    assert rows(tables.listed_days(df, ["2024-01-01", "2030-01-01"]), "a") == [("2024-01-01",)]


def test_unreadable_files_are_skipped(spark, table, tmp_path):
    path = tmp_path / "t"
    table([(1,)], "a int").write.parquet(str(path / "part=1"))
    table([(2, "x")], "a int, b string").write.parquet(str(path / "part=2"))
    (path / "part=2" / "bad.parquet").write_bytes(b"PAR1 this is no table PAR1")
    schema = spark.createDataFrame([], "a int, b string, part int").schema
    assert rows(tables.read_table(spark, str(path), schema, skip_unreadable=True), "a", "b") == [(1, None), (2, "x")]
    table([], "a int, b string").write.parquet(str(path / "part=3"))
    (path / "part=2" / "of few bytes.parquet").write_bytes(b"x")
    found = {r["path"].rsplit("/", 1)[1]: (r["bytes"], r["reason"]) for r in tables.unreadable_files(spark, str(path), schema).collect()}
    assert {name: size for name, (size, _) in found.items()} == {"bad.parquet": 26, "of%20few%20bytes.parquet": 1}
    assert all(reason for _, reason in found.values())
    with pytest.raises(Exception):
        tables.read_table(spark, str(path), schema).collect()
    assert tables.read_table(spark, str(path / "absent"), schema).count() == 0


def test_cache_versions(spark, table, tmp_path):
    path, schema = str(tmp_path / "cache"), spark.createDataFrame([], "domain string, n int").schema
    for n in range(1, 4):
        old, version = tables.read_cache(spark, path, schema)
        assert version == n - 1
        tables.write_version(picks.upsert(old, table([("a", n), (f"d{n}", n)], "domain string, n int"), ["domain"]), path, version + 1)
    cache, version = tables.read_cache(spark, path, schema)
    assert version == 3 and rows(cache) == [("a", 3), ("d1", 1), ("d2", 2), ("d3", 3)]
    (tmp_path / "cache" / "version=4").mkdir()
    assert tables.read_cache(spark, path, schema)[1] == 3


def test_conform_fills_and_casts(table):
    df = table([("2024-01-01", "x", "junk")], "first_seen string, domain string, extra string")
    row = schemas.conform(df, schemas.SILVER_LABEL, {"label": F.lit("unknown")}).first()
    assert row["url"] is None and row["label"] == "unknown" and str(row["first_seen"]) == "2024-01-01 00:00:00"


def test_json_records_keep_nulls(table):
    df = tables.json_records(table([(1, None)], "a int, b string"))
    assert df.first()["value"] == '{"a":1,"b":null}'


def test_expectations(table):
    df = table([("http://a", "a"), ("http://a", "a"), ("ftp://b", None), ("https://c", "x" * 254)], "url string, domain string")
    assert dict(rows(quality.feed_expectations(df))) == {"domain_length": 1, "domain_not_null": 1, "url_scheme": 1, "url_unique": 1}


def test_partition_audit(table):
    data = [("urlhaus", "2024-01-02", f"2024-01-{d:02d}") for d in range(1, 21)]
    df = table(data, "source string, ingest_date string, added string").withColumn("ingest_date", F.col("ingest_date").cast("date"))
    row = quality.partition_audit(df, "added", "bronze").first()
    assert row["match_ratio"] == 0.15 and row["anomaly"] == "dateadded_mismatch_ratio=0.150"
    assert row["path"] == "bronze/urlhaus/ingest_date=2024-01-02" and row["is_empty"] is False
