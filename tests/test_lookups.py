import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from indicatrix import schemas
from indicatrix.operators import features, gold, lookups, matches, quality, serving
from indicatrix.operators.skew import is_small, lookup_join
from tests.conftest import rows

NOW = F.lit("2024-02-01 00:00:00").cast("timestamp")
WHOIS = "domain string, error string, fetched_at string"


def whois(table, data):
    return table(data, WHOIS).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))


def test_refresh_list(table):
    cache = whois(
        table,
        [
            ("fresh.com", None, "2024-01-20"), ("stale.com", None, "2024-01-02"), ("never.com", None, None),
            ("failed-new.com", "timeout", "2024-01-26"), ("failed-old.com", "timeout", "2024-01-25"), ("blank.com", "", "2024-01-20"),
            ("exact.com", None, "2024-01-02 00:00:00"), ("two.com", None, "2024-01-30"), ("two.com", None, "2023-01-01"), ("UPPER.com", None, "2024-01-30"),
        ],
    )
    names = ["fresh.com", "stale.com", "never.com", "failed-new.com", "failed-old.com", "blank.com", "exact.com", "new.com", "two.com", "upper.com"]
    got = rows(lookups.refresh_list(table([(n,) for n in names * 2], "domain string"), cache, NOW))
    assert [r[0] for r in got] == ["exact.com", "failed-old.com", "never.com", "new.com", "stale.com", "two.com"]


def test_missing_pairs_and_snapshot(table):
    cache = table([("a", "1"), ("b", "2")], "puny_domain string, ip string")
    pairs = table([("a", "1"), ("a", "2"), ("a", "2"), ("c", "3")], "puny_domain string, ip string")
    assert rows(lookups.missing_pairs(pairs, cache)) == [("a", "2"), ("c", "3")]
    assert rows(lookups.daily_snapshot(cache, pairs, "puny_domain")) == [("1", "a")] or rows(
        lookups.daily_snapshot(cache, pairs, "puny_domain"), "puny_domain", "ip"
    ) == [("a", "1")]


def test_attach_geo_and_upsert(table):
    geo = table([("1.1.1.1", "AU", "AS1"), ("1.1.1.1", "US", "AS2")], "ip string, country string, asn string")
    got = lookups.attach_geo(table([("a", "1.1.1.1"), ("a", "::1"), ("b", "x")], "puny_domain string, ip string"), geo)
    assert got.columns == schemas.DNS_GEO.fieldNames()
    assert rows(got, "puny_domain", "ip", "family", "country") == [
        ("a", "1.1.1.1", 4, "AU"), ("a", "::1", 6, None), ("b", "x", None, None),
    ]
    new = got.filter("ip = '1.1.1.1'").withColumn("country", F.lit("NZ"))
    assert ("1.1.1.1", "NZ") in rows(lookups.upsert_geo(got, new), "ip", "country") and lookups.upsert_geo(got, new).count() == 3


def test_upsert_whois_nulls_lose(table):
    cache = whois(table, [("a", None, None), ("b", None, "2024-01-02")])
    new = whois(table, [("A", None, "2024-01-01"), ("b", "late", "2024-01-01")])
    assert [(r[0], r[1], str(r[2])[:10]) for r in rows(lookups.upsert_whois(cache, new))] == [
        ("a", None, "2024-01-01"), ("b", None, "2024-01-02"),
    ]


def test_locate_ips_against_brute_force(table):
    rng = random.Random(5)
    blocks = ["10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/24", "10.1.2.128/25", "192.168.0.0/15", "0.0.0.0/1", "200.1.2.3/32", "200.1.2.9/30", "2001:db8::/32", "2001:db8:7::/48", "2001:db8:7::1:0/113", "::ffff:10.0.0.0/104", "fe80::/10"]
    ips = [f"10.1.2.{i}" for i in range(0, 256, 5)] + [
        ".".join(str(rng.choice([10, 1, 2, 192, 168, 169, 200, 255])) for _ in range(4)) for _ in range(200)
    ] + ["200.1.2.3", "200.1.2.8", "::1", "x", "255.255.255.255", "0.0.0.0"] + [
        "2001:db8::5", "2001:db8:7::5", "2001:DB8:7::1:1", "2001:db8:7::1:8000", "2001:db9::", "::ffff:10.9.8.7", "fe80::1", "::", "2001:db8:7:0:0:0:1:ffff"]
    got = {
        r["ip"]: r["name"]
        for r in lookups.locate_ips(
            table([(i,) for i in ips * 2], "ip string"), table([(b, f"n{b}") for b in blocks] + [("bad", "n"), ("1.2.3.4/99", "n")], "network string, name string")
        ).collect()
    }

    def want(text):
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return None
        hits = [b for b in blocks if address in ipaddress.ip_network(b, strict=False)]
        return "n" + max(hits, key=lambda b: int(b.split("/")[1])) if hits else None

    assert got == {i: want(i) for i in ips}


@pytest.mark.parametrize("ranges", [1, 13])
def test_locate_many_ips_in_nested_blocks(spark, table, monkeypatch, ranges):
    """Random nested blocks of both families, in one range and in many."""
    rng = random.Random(ranges)
    base4, base6 = int(ipaddress.ip_address("10.0.0.0")), int(ipaddress.ip_address("2001:db8::"))
    blocks = {"0.0.0.0/0", "::/0", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff/128", "255.255.255.255/32", "8000::/1"}
    for _ in range(150):
        blocks.add(f"{ipaddress.ip_address(base4 + rng.getrandbits(12))}/{rng.randint(18, 32)}")
        blocks.add(f"{ipaddress.ip_address(base6 + (rng.getrandbits(6) << 66) + rng.getrandbits(12))}/{rng.choice([58, 60, 62, 63, 64, 65, 100, 116, 120, 124, 127, 128])}")
    ips = {str(ipaddress.ip_address(base4 + rng.getrandbits(13))) for _ in range(400)} | {str(ipaddress.ip_address(base6 + (rng.getrandbits(6) << 66) + rng.getrandbits(13))) for _ in range(400)}
    ips |= {"ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:fffe", "255.255.255.255", "255.255.255.254", "0.0.0.0", "::", "no address"}
    monkeypatch.setattr(lookups, "RANGE_ROWS", 1_000_000 if ranges == 1 else 100)
    got = lookups.locate_ips(table([(i,) for i in ips], "ip string"), table([(b, len(b)) for b in blocks], "network string, size int"))
    nets: dict = {}
    for b in sorted(blocks, reverse=True):
        nets[ipaddress.ip_network(b, strict=False)] = b

    def want(text):
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return None
        hits = [n for n in nets if n.version == address.version and address in n]
        return nets[max(hits, key=lambda n: n.prefixlen)] if hits else None

    assert {r["ip"]: (r["network"], r["size"]) for r in got.collect()} == {i: (b, len(b)) if (b := want(i)) else (None, None) for i in ips}


def test_locate_without_blocks_or_ips(table):
    none = table([], "network string, name string")
    assert rows(lookups.locate_ips(table([("1.2.3.4",), (None,)], "ip string"), none)) == [(None, None, None), ("1.2.3.4", None, None)]
    assert lookups.locate_ips(table([], "ip string"), table([("1.0.0.0/8", "x")], "network string, name string")).count() == 0


def test_halves_sort_like_addresses(values):
    from indicatrix.functions.ip import address_halves

    ips = ["::", "::1", "::ffff:1.2.3.4", "7fff:ffff:ffff:ffff::", "8000::", "2001:db8::8000:0:0:0", "2001:db8:0:0:7fff:ffff:ffff:ffff", "ffff::", "1.2.3.4", "0.0.0.0", "255.255.255.255"]
    got = values(ips, address_halves(F.col("x")))
    key = lambda t: (ipaddress.ip_address(t).version, int(ipaddress.ip_address(t)))
    assert [ips[i] for i in sorted(range(len(ips)), key=lambda i: tuple(got[i]))] == sorted(ips, key=key)
    assert values(["1.2.3", "::g", None], address_halves(F.col("x"))) == [None] * 3


DNS = "puny_domain string, ip string, family int, country string, asn string, isp string"


def dns(table):
    return table(
        [
            ("a.com", "2.2.2.2", 4, "US", "AS2", None), ("a.com", "1.1.1.1", 4, None, "AS1", "I1"), ("a.com", "1.1.1.1", 4, None, "AS1", "I1"),
            ("a.com", "::1", 6, "DE", None, None), ("b.com", "3.3.3.3", 4, None, None, None), ("c.com", "4.4.4.4", None, "US", "AS2", "I2"),
        ],
        DNS,
    )


def test_dns_summary(table):
    got = {r["registered_domain"]: tuple(r)[1:] for r in features.dns_summary(dns(table)).collect()}
    assert got == {
        "a.com": (3, 1, 2, 2, "AS1", "I1", "US"), "b.com": (1, 0, 0, 0, None, None, None), "c.com": (1, 0, 1, 1, "AS2", "I2", "US"),
    }


def test_ct_summary(table):
    base = table([("a.com", "w.a.com", 2, "s", 2), ("a.com", "v.a.com", 1, "s", 1), ("n.com", "n.com", 1, "s", 1)],
                 "registered_domain string, domain string, event_ts int, source string, ingest_ts int")
    resolved = table([("a.com", "::1", "US", "AS1", "N"), ("a.com", "1.1.1.1", None, None, None), ("n.com", None, None, None, None)],
                     "registered_domain string, ip string, country string, asn string, asname string")
    got = {r["registered_domain"]: r.asDict() for r in features.ct_summary(resolved, base).collect()}
    assert got["a.com"]["domain_sample"] == "v.a.com" and got["a.com"]["has_ipv6"] == 1 and got["a.com"]["num_unique_ips"] == 2
    assert got["n.com"]["num_unique_ips"] == 0 and got["n.com"]["sample_country"] is None
    assert quality.resolution_coverage(features.ct_summary(resolved, base)).first()["coverage_pct"] == 50.0


LABELS = "registered_domain string, domain string, url string, first_seen string, label string, source string"
ATTRS = "indicator string, type string, category string, event_id string, first_seen string"


def labels(table):
    data = [
        ("a.com", "a.com", "u1", "2024-01-02", "m", "urlhaus"), ("a.com", "a.com", "u0", "2024-01-03", "b", "benign_seed"),
        ("b.com", "w.b.com", "u2", "2024-01-01", "phishing", "openphish"), ("nodns.com", "nodns.com", "u3", "2024-01-01", "x", "other"),
        ("c.com", "c.com", "u4", "2024-01-01", "m", "urlhaus"),
    ]
    return table(data, LABELS).withColumn("first_seen", F.col("first_seen").cast("timestamp"))


def full_whois(table):
    data = [("a.com", "R", "ok", "2023-01-01", "2025-01-01", None, "2024-01-02"), ("A.com ", "old", "ok", "2020-01-01", None, "x", "2024-01-01"),
            ("c.com", None, None, None, None, "boom", "2024-01-01")]
    df = table(data, "domain string, registrar string, status string, created string, expires string, error string, fetched_at string")
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("created", "expires", "fetched_at")})


def attrs(table):
    data = [
        ("http://x.b.com:80/p", "url", "Banking", "2", "2024-01-02"), ("b.com", "domain", "Older", "9", "2024-01-01"), ("b.com", "hostname", "Wins", "3", "2024-01-02"),
        (" 4.4.4.4 ", "ip-dst", "net", "1", "2024-01-01"), ("a.com", "md5", "no", "1", "2024-01-01"), ("zzz", "domain", "none", "1", "2024-01-01"),
    ]
    return table(data, ATTRS).withColumn("first_seen", F.col("first_seen").cast("timestamp"))


def test_feature_rows_have_one_row_per_domain(table):
    found = features.feature_rows(labels(table), dns(table), full_whois(table), NOW, matches.listed_domains(attrs(table)))
    got = {r["registered_domain"]: r.asDict() for r in found.collect()}
    assert len(got) == found.count() == 4
    assert got["a.com"]["registrar"] == "R" and got["a.com"]["url"] == "u1" and str(got["a.com"]["last_first_seen"])[:10] == "2024-01-03"
    assert got["a.com"]["age_days"] == 396.0 and got["nodns.com"]["num_unique_ips"] is None
    assert [got[d]["is_in_misp"] for d in ("a.com", "b.com", "c.com")] == [0, 1, 0]
    assert got["c.com"]["has_error"] == 1 and got["c.com"]["created_isnull"] == 1


def threat_rows(table):
    scored = gold.scored_rows(labels(table), dns(table), full_whois(table), attrs(table), NOW)
    scores = table([("a.com", 0.61239), ("b.com", 0.1), ("c.com", 0.1), ("nodns.com", 0.2)], "registered_domain string, score double")
    return scored.join(scores, "registered_domain")


def test_threat_table(table):
    threats = gold.assemble(threat_rows(table))
    assert threats.schema.fieldNames() == schemas.THREAT.fieldNames()
    got = {r["domain"]: r for r in threats.collect()}
    assert (got["a.com"]["riskScore"], got["a.com"]["riskLevel"], got["a.com"]["threatType"], got["a.com"]["domainAgeDays"]) == (0.6124, "HIGH", "malware", 396)
    b = got["w.b.com"]
    assert (b["riskScore"], b["riskLevel"], b["source"], b["threatType"]) == (1.0, "CRITICAL", "misp_osint", "wins")
    assert (got["c.com"]["source"], got["c.com"]["threatType"]) == ("misp_osint", "network infrastructure overlap")
    # No addresses means no overlap.
    n = got["nodns.com"]
    assert (n["source"], n["riskLevel"], n["threatType"], n["country"], n["registrar"], n["domainAgeDays"]) == ("other", "MEDIUM", "suspicious", "Unknown", "Unknown", -1)
    assert all(failed == 0 for _, failed in rows(quality.export_checks(threats)))
    assert all(failed == 0 for _, failed in rows(quality.override_checks(threats)))
    assert matches.catch_rates(threat_rows(table)).first().asDict() == {"direct": 1, "overlap_only": 1, "multiplier": 2.0}


def test_statistics_and_excerpts(table):
    threats = gold.assemble(threat_rows(table))
    top = gold.top_threats(threats, 3)
    assert [r["domain"] for r in top.collect()] == ["c.com", "w.b.com", "a.com"]
    assert [r["domain"] for r in gold.recent(top, 1).collect()] == ["a.com"]
    assert gold.high_risk(top, 2).count() == 2
    stats = gold.statistics(labels(table), top)
    row = stats.first().asDict(recursive=True)
    assert gold.totals(threats, 2).first()["exportedCount"] == 2 and gold.totals(threats, 2).first()["threatCount"] == 4
    assert row["totalSamples"] == 5 and row["exportedCount"] == row["threatCount"] == 3 and row["maliciousCount"] == 3 and row["highRiskCount"] == 3
    assert row["riskDistribution"] == {"CRITICAL": 2, "HIGH": 1, "MEDIUM": 0, "LOW": 0}
    assert row["topCountries"] == {"US": 2} and row["topRegistrars"] == {"R": 1}
    assert all(failed == 0 for _, failed in rows(quality.statistics_checks(stats)))
    broken = stats.withColumn("highRiskCount", F.lit(9))
    assert dict(rows(quality.statistics_checks(broken)))["high_risk_recount"] == 1


def test_lookup_of_many_texts_agrees_with_few(table, monkeypatch):
    threats = table(
        [(f"D{i}.com", f"https://d{i}.com/{i % 7}/path{i}", float(i % 5)) for i in range(300)] + [(None, None, 9.0), ("", "", 9.0)],
        "domain string, url string, riskScore double",
    )
    texts = [f"d{i}.COM" for i in range(0, 300, 3)] + [f"/{i}/" for i in range(9)] + ["h", "th1", " path29 ", "nowhere", "", "//d7.com/0/path7"]
    best = [(-F.col("riskScore")).alias("_score"), F.col("domain").alias("_domain")]
    monkeypatch.setattr(serving, "CONSTANT_TEXTS", 1000)
    few = rows(serving.lookup(threats, texts, best))
    monkeypatch.setattr(serving, "CONSTANT_TEXTS", 0)
    assert rows(serving.lookup(threats, texts, best)) == few and len(few) > 100
    many = table([(t,) for t in texts], "text string")
    assert rows(serving.lookup(threats, many, best)) == few


def test_common_endings_bring_nothing_together(spark):
    """10 000 texts that end alike: candidates are the hits and little more, and hits are those of comparing all."""
    n = F.col("id")
    name = F.concat(F.substring(F.md5(n.cast("string")), 1, 10), F.lit(".com"))
    threats = spark.range(20_000).select(name.alias("domain"), F.concat(F.lit("https://"), name, F.lit("/")).alias("url"), (n % 7).cast("double").alias("riskScore"))
    texts = spark.range(10_000, 30_000, 2).select(F.concat(F.substring(F.md5(n.cast("string")), 4, 7), F.lit(".com/")).alias("query"))
    candidates = serving.url_candidates(threats, texts).select("_url", "query").distinct()
    hits = candidates.where(F.contains("_url", F.col("query"))).count()
    assert hits >= 5000 and candidates.count() < 4 * hits
    # Texts that have nothing but common stretches are found in all rows.
    assert rows(serving.url_candidates(threats, texts.limit(1).select(F.lit(".com/").alias("query"))).groupBy("query").count()) == [(".com/", 20_000)]


def test_rarest_stretches(table):
    urls = table([("abcdefg",), ("abcdxyz",), ("ab",), ("abcdx",)], "_url string")
    wanted = table([("abcdx",), ("bcdefg",), ("ab",), ("zzzz",), ("abcdq",), ("q",)], "query string")
    assert rows(serving.rarest_grams(urls, wanted)) == [("ab", "ab"), ("abcdx", "bcdx"), ("bcdefg", "bcde")]


def test_drift(table):
    history = table([("2024-01-01", 10, 0.5, 0.5, 5), ("2024-01-02", 10, 0.61, 0.5, 6), ("2024-01-03", 10, 0.6, 0.43, 4), ("2024-01-04", 10, 0.5, 0.43, 4)],
                    "run_date string, total_samples int, malicious_ratio double, avg_risk_score double, high_risk_count int")
    got = gold.drift(history).orderBy("run_date").collect()
    assert [r["malicious_ratio_delta"] for r in got] == [None, 0.11, -0.01, -0.1]
    assert [r["alert"] for r in got] == [None, "Malicious ratio shifted by +11.0%", "Average risk score shifted by -0.0700", None]
    assert [r["high_risk_count_delta"] for r in got] == [None, 1, -2, 0]


def test_skewed_address_gives_whole_results(spark):
    """A third of all rows shares one address, and one domain."""
    n = F.col("id")
    rows_ = spark.range(60_000).select(
        F.when(n % 3 == 1, "hot.com").otherwise(F.concat(F.lit("d"), (n % 5000).cast("string"))).alias("puny_domain"),
        F.when(n % 3 == 0, "9.9.9.9").otherwise(F.concat(F.lit("1.2."), (n % 250).cast("string"), F.lit("."), (n % 199).cast("string"))).alias("ip"),
        F.lit(4).alias("family"), F.lit("US").alias("country"), F.lit("AS1").alias("asn"), F.lit("I").alias("isp"),
    )
    listed = spark.createDataFrame([("9.9.9.9",)], "ip string")
    flags = {r[0]: r[1] for r in matches.overlap_flags(rows_, listed).collect()}
    local = rows_.select("puny_domain", "ip").toPandas()
    want = local.assign(hit=local.ip == "9.9.9.9").groupby("puny_domain").hit.max().to_dict()
    assert flags == want
    counts = {r[0]: r[1] for r in features.dns_summary(rows_).select("registered_domain", "num_unique_ips").collect()}
    assert counts == local.groupby("puny_domain").ip.nunique().to_dict()


def skewed(spark, rows_=30_000):
    n = F.col("id")
    return spark.range(0, rows_, 1, 6).select(
        n, F.when(n % 3 == 0, "hot").when(n % 7 == 0, None).otherwise((n % 500).cast("string")).alias("key")
    )


def lookup_table(spark):
    n = F.col("id")
    key = F.when(n == 0, "hot").otherwise(n.cast("string"))
    return spark.range(0, 400).select(key.alias("key"), (n * 2).alias("value"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [50, 1000, 10**6])
def test_spread_join_equals_plain_join(spark, how, hot_rows):
    left, right = skewed(spark), lookup_table(spark)
    plain = left.join(right, "key", how)
    spread = lookup_join(left, right, "key", how, hot_rows=hot_rows)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).count() == 0 and plain.exceptAll(spread).count() == 0


def test_spread_join_bounds_every_task(spark):
    """No part of the hot key holds much more than the limit."""
    left = skewed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        spread = lookup_join(left, lookup_table(spark), "key", hot_rows=500)
        plan = spread._jdf.queryExecution().executedPlan().toString()
        assert "_part" in plan[plan.index("SortMergeJoin") :].split("\n")[0]
        parts = left.filter("key = 'hot'").select(F.pmod(F.xxhash64("id", "key"), F.lit(20)).alias("p")).groupBy("p").count()
        assert parts.agg(F.max("count")).first()[0] < 2 * 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_long_lists_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(matches, "is_small", lambda df: False)
    pairs = skewed(spark).select(F.col("id").cast("string").alias("puny_domain"), F.coalesce("key", F.lit("x")).alias("ip"))
    got = matches.overlap_flags(pairs, spark.createDataFrame([("hot",), ("7",)], "ip string"))
    want = {r[0]: r[1] for r in pairs.select("puny_domain", F.col("ip").isin("hot", "7")).collect()}
    assert {r[0]: r[1] for r in got.collect()} == want


def test_size_check(spark):
    assert is_small(spark.range(10), 10) and not is_small(spark.range(11), 10)
