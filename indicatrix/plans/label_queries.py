"""Registered queries for contracts, bronze and silver layers, checks and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicatrix.operators import contract, gold, layers, lookups, matches, picks, quality
from indicatrix.plans.registry import query
from indicatrix.plans.standins import Tables, now
from indicatrix.session import scratch_dir
from indicatrix.sources.cache import geo_cache, whois_cache

# -- events ------------------------------------------------------------------------------

_EXTRA_TEXT = """CASE event_id % 13 WHEN 0 THEN '' WHEN 1 THEN '[1,2]' WHEN 2 THEN '7' WHEN 3 THEN '{"id":"","domain":"x","event_ts":"t","source":"s","producer_ts":"p"}'
  WHEN 4 THEN '{"id":null,"domain":"x","event_ts":"t","source":"s","producer_ts":"p"}' WHEN 5 THEN '{"id":"1","domain":"x","event_ts":5,"source":"s","producer_ts":"p"}'
  WHEN 6 THEN '{"id":"1","domain":"x","tld":9,"event_ts":"t","source":"s","producer_ts":"p"}' WHEN 7 THEN '{"id":"1","domain":"x","event_ts":"t","source":"","producer_ts":"p","more":{}}'
  WHEN 8 THEN '{"id":"1","domain":"x","event_ts":"t","producer_ts":"p"}' WHEN 9 THEN '{"id":true,"domain":["x"],"event_ts":"t","source":"s","producer_ts":"p"}'
  ELSE value END"""


@query(
    "q1_parse_good",
    """SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 19 = 0 THEN 'x.com' ELSE concat('d', CAST(user_id AS VARCHAR), '.com') END AS domain,
      CAST(NULL AS VARCHAR) AS tld, CASE WHEN event_id % 19 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS event_ts,
      CASE WHEN event_id % 19 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS producer_ts,
      CASE WHEN event_id % 19 <> 0 THEN event_type END AS source, CASE WHEN event_id % 19 <> 0 THEN 2678400.0 END AS latency_sec
    FROM events WHERE event_id % 17 <> 0""",
)
def q1_parse_good(t: Tables):
    messages = t.stream_event.select("value")
    return contract.good_events(contract.parse(messages), now()).drop("ingest_ts")


@query(
    "q1_parse_bad",
    f"""SELECT value, 'json_parse_failed' AS reason FROM (SELECT {_EXTRA_TEXT} AS value FROM stream_event)
    WHERE NOT json_valid(value) OR json_type(CASE WHEN json_valid(value) THEN value ELSE '0' END) <> 'OBJECT'""",
)
def q1_parse_bad(t: Tables):
    messages = t.stream_event.select(F.expr(_EXTRA_TEXT).alias("value"))
    return contract.bad_events(contract.parse(messages), now()).drop("ingest_ts")


def _missing(field: str) -> str:
    return f"WHEN json_type(j, '$.{field}') IS NULL THEN 'contract_violation:<root>:''{field}'' is a required property'"


@query(
    "q2_contract_reason",
    f"""SELECT event_id, CASE WHEN j IS NULL THEN 'json_decode_error' WHEN json_type(j) <> 'OBJECT' THEN 'contract_violation:<root>'
      {' '.join(_missing(f) for f in ('id', 'domain', 'event_ts', 'source', 'producer_ts'))}
      WHEN json_type(j, '$.id') <> 'VARCHAR' OR j->>'$.id' = '' THEN 'contract_violation:id'
      WHEN json_type(j, '$.domain') <> 'VARCHAR' OR j->>'$.domain' = '' THEN 'contract_violation:domain'
      WHEN json_type(j, '$.tld') NOT IN ('VARCHAR', 'NULL') THEN 'contract_violation:tld'
      WHEN json_type(j, '$.event_ts') <> 'VARCHAR' THEN 'contract_violation:event_ts'
      WHEN json_type(j, '$.producer_ts') <> 'VARCHAR' THEN 'contract_violation:producer_ts'
      WHEN json_type(j, '$.source') <> 'VARCHAR' OR j->>'$.source' = '' THEN 'contract_violation:source' END AS reason
    FROM (SELECT event_id, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j
      FROM (SELECT event_id, {_EXTRA_TEXT} AS value FROM stream_event))""",
)
def q2_contract_reason(t: Tables):
    """Reason code and path, with the message only for missing fields."""
    messages = t.stream_event.select("event_id", F.expr(_EXTRA_TEXT).alias("value"))
    reason = F.col("reason")
    code = F.when(F.contains(reason, F.lit("required property")), reason).otherwise(
        F.regexp_extract(reason, r"^(json_decode_error|contract_violation:[^:]+)", 1)
    )
    return contract.validate(messages).select("event_id", code.alias("reason"))


# -- layers --------------------------------------------------------------------------------


@query(
    "q3_bronze_rows",
    """SELECT url, nullif(lower(regexp_extract(url, '^https?://([^:/?#]*)', 1)), '') AS domain, min(page_id) AS page_id
    FROM (SELECT page_id, CASE WHEN page_id % 20 = 0 THEN 'http://?x' WHEN page_id % 6 = 0 THEN 'http://a.example/x' ELSE url END AS url FROM pages)
    WHERE regexp_extract(url, '^https?://([^:/?#]*)', 1) <> '' GROUP BY url""",
)
def q3_bronze_rows(t: Tables):
    n = F.col("page_id")
    url = F.when(n % 20 == 0, "http://?x").when(n % 6 == 0, "http://a.example/x").otherwise(F.col("url"))
    return layers.bronze_rows(t.pages.select(n, url.alias("url")))


_FEED_COLUMNS = ["domain", "url", "first_seen", "label", "source"]


def _feed(t: Tables, source: str):
    return t.feed_url.filter(F.col("source") == source)


def _malware(t: Tables):
    threat = F.when(F.col("page_id") % 4 != 0, F.col("label")).alias("threat")
    return _feed(t, "urlhaus").select("domain", "url", "first_seen", threat)


def _phish(t: Tables):
    return _feed(t, "openphish").select("domain", "url", "first_seen")


_MALWARE_SQL = """SELECT domain, min(url) AS url, first_seen, min_by(CASE WHEN page_id % 4 <> 0 THEN label ELSE 'unknown' END, url) AS label, 'urlhaus' AS source
  FROM feed_url WHERE source = 'urlhaus' GROUP BY domain, first_seen"""
_PHISH_SQL = """SELECT DISTINCT domain, url, first_seen, 'phishing' AS label, 'openphish' AS source FROM feed_url WHERE source = 'openphish'"""


@query("q4_silver_malware", _MALWARE_SQL)
def q4_silver_malware(t: Tables):
    return layers.silver_malware(_malware(t))


@query("q4_silver_phish", _PHISH_SQL)
def q4_silver_phish(t: Tables):
    return layers.silver_phish(_phish(t).union(_phish(t)))


_UNION_SQL = f"""SELECT *, true AS seen_in_urlhaus, false AS seen_in_openphish FROM ({_MALWARE_SQL})
  UNION ALL SELECT *, false, true FROM ({_PHISH_SQL})"""


@query(
    "i1_label_union",
    _UNION_SQL
    + """ UNION ALL SELECT DISTINCT domain, url, first_seen, label, source, false, false FROM feed_url WHERE source = 'benign_seed'""",
)
def i1_label_union(t: Tables):
    seeds = _feed(t, "benign_seed").select(*_FEED_COLUMNS)
    return layers.label_union(t.spark, layers.silver_malware(_malware(t)), layers.silver_phish(_phish(t)), [seeds])


@query("i1_label_union_one_feed", f"SELECT *, false AS seen_in_urlhaus, true AS seen_in_openphish FROM ({_PHISH_SQL})")
def i1_label_union_one_feed(t: Tables):
    return layers.label_union(t.spark, None, layers.silver_phish(_phish(t)))


@query(
    "q12_binary_label",
    "SELECT domain AS registered_domain, url, first_seen, CASE WHEN source = 'benign_seed' THEN 0 ELSE 1 END AS label FROM label_row",
)
def q12_binary_label(t: Tables):
    return layers.binary_labels(t.labels_rd).select("registered_domain", "url", "first_seen", "label")


# -- checks ----------------------------------------------------------------------------------


@query("q5_row_guard", "SELECT count(*) AS rows, count(*) >= 50 AS enough FROM feed_url WHERE source = 'urlhaus'")
def q5_row_guard(t: Tables):
    return quality.row_guard(_feed(t, "urlhaus"))


@query(
    "q6_feed_age",
    """SELECT max(first_seen) AS header_ts, epoch(TIMESTAMP '2024-02-01 00:00:00' - max(first_seen)) / 3600 AS age_hours,
      epoch(TIMESTAMP '2024-02-01 00:00:00' - max(first_seen)) / 3600 > 12 AS stale FROM feed_url""",
)
def q6_feed_age(t: Tables):
    stamp = F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss")
    lines = t.feed_url.select(F.concat(F.lit("# Last updated: "), stamp, F.lit(" (UTC)")).alias("value"))
    return quality.feed_age(lines.union(t.pages.select("url")), now())


@query(
    "q7_expectations",
    """WITH v AS (SELECT CASE WHEN page_id % 40 = 0 THEN 'ftp://x' ELSE url END AS url,
        CASE WHEN page_id % 30 = 0 THEN NULL WHEN page_id % 7 = 0 THEN repeat('a', 254) ELSE domain END AS domain FROM feed_url)
    SELECT 'domain_not_null' AS "check", count(*) FILTER (WHERE domain IS NULL) AS failed_rows FROM v
    UNION ALL SELECT 'domain_length', count(*) FILTER (WHERE length(domain) NOT BETWEEN 1 AND 253) FROM v
    UNION ALL SELECT 'url_scheme', count(*) FILTER (WHERE url NOT LIKE 'http://%' AND url NOT LIKE 'https://%') FROM v
    UNION ALL SELECT 'url_unique', count(*) - count(DISTINCT url) FROM v""",
)
def q7_expectations(t: Tables):
    n = F.col("page_id")
    rows = t.feed_url.select(
        F.when(n % 40 == 0, "ftp://x").otherwise(F.col("url")).alias("url"),
        F.when(n % 30 == 0, None).when(n % 7 == 0, F.repeat(F.lit("a"), F.lit(254))).otherwise(F.col("domain")).alias("domain"),
    )
    return quality.feed_expectations(rows)


@query(
    "q8_partition_audit",
    """SELECT 'bronze' AS layer, source, strftime(ds, '%Y-%m-%d') AS ds, concat('bronze/', source, '/ingest_date=', strftime(ds, '%Y-%m-%d')) AS path,
      rows, false AS is_empty, strftime(lo, '%Y-%m-%d') AS content_date_min, strftime(hi, '%Y-%m-%d') AS content_date_max, round(ratio, 6) AS match_ratio,
      CASE WHEN ratio < 0.2 THEN concat('dateadded_mismatch_ratio=', printf('%.3f', round(ratio, 3))) END AS anomaly
    FROM (SELECT source, date_trunc('month', first_seen) AS ds, count(*) AS rows, min(first_seen) AS lo, max(first_seen) AS hi,
        avg(CASE WHEN abs(date_diff('day', first_seen, CAST(date_trunc('month', first_seen) AS TIMESTAMP))) <= 1 THEN 1.0 ELSE 0.0 END) AS ratio
      FROM label_row GROUP BY ALL)""",
)
def q8_partition_audit(t: Tables):
    rows = t.label_row.withColumn("ingest_date", F.trunc("ingest_date", "month"))
    audit = quality.partition_audit(rows, "first_seen", "bronze")
    days = {c: F.date_format(c, "yyyy-MM-dd") for c in ("ds", "content_date_min", "content_date_max")}
    return audit.withColumns({**days, "match_ratio": F.round("match_ratio", 6)})


@query(
    "q8_expected_partitions",
    """SELECT source, strftime(date_trunc('month', first_seen), '%Y-%m-%d') AS ds, count(*) FILTER (WHERE source <> 'openphish' OR month(first_seen) <> 1) AS rows,
      count(*) FILTER (WHERE source <> 'openphish' OR month(first_seen) <> 1) = 0 AS is_empty
    FROM label_row GROUP BY source, date_trunc('month', first_seen)""",
)
def q8_expected_partitions(t: Tables):
    """One source lacks its partitions of every January; the audit shows them as empty."""
    months = t.label_row.withColumn("ingest_date", F.trunc("ingest_date", "month"))
    rows = months.filter((F.col("source") != "openphish") | (F.month("first_seen") != 1))
    audit = quality.partition_audit(rows, "first_seen", "bronze", expected=months.select("source", "ingest_date"))
    return audit.select("source", F.date_format("ds", "yyyy-MM-dd").alias("ds"), "rows", "is_empty")


def _faulty_threats(t: Tables):
    from indicatrix.plans.gold_queries import threats

    n = F.regexp_extract("domain", r"^d([0-9]+)\.com$", 1).cast("bigint")
    return threats(t).withColumns(
        {
            "riskScore": F.when(n % 50 == 0, 1.5).otherwise(F.col("riskScore")),
            "riskLevel": F.when(n % 60 == 0, "SEVERE").when(n % 70 == 0, "LOW").otherwise(F.col("riskLevel")),
            "country": F.when(n % 80 != 0, F.col("country")),
        }
    )


_FAULTY_SQL = """f AS (SELECT domain, url, "firstSeen", label, source, CASE WHEN n % 50 = 0 THEN 1.5 ELSE "riskScore" END AS score,
    CASE WHEN n % 60 = 0 THEN 'SEVERE' WHEN n % 70 = 0 THEN 'LOW' ELSE "riskLevel" END AS level, CASE WHEN n % 80 <> 0 THEN country END AS country
  FROM (SELECT *, CAST(substr(split_part(domain, '.', 1), 2) AS BIGINT) AS n FROM threat_row))"""


@query(
    "q9_export_checks",
    f"""WITH {_FAULTY_SQL}, c AS (SELECT unnest(['domain', 'url', 'firstSeen', 'label', 'source', 'riskScore', 'riskLevel', 'threatType', 'registrar', 'domainAgeDays']) AS name)
    SELECT concat('missing_', name) AS "check", CAST(0 AS BIGINT) AS failed_rows FROM c
    UNION ALL SELECT 'missing_country', count(*) FILTER (WHERE country IS NULL) FROM f
    UNION ALL SELECT 'score_range', count(*) FILTER (WHERE score NOT BETWEEN 0 AND 1) FROM f
    UNION ALL SELECT 'level_values', count(*) FILTER (WHERE level NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) FROM f""",
)
def q9_export_checks(t: Tables):
    return quality.export_checks(_faulty_threats(t))


@query(
    "q10_override_checks",
    f"""WITH {_FAULTY_SQL}
    SELECT 'listed_not_critical' AS "check", count(*) FILTER (WHERE source = 'misp_osint' AND level <> 'CRITICAL') AS failed_rows FROM f
    UNION ALL SELECT 'listed_score_not_one', count(*) FILTER (WHERE source = 'misp_osint' AND score <> 1) FROM f
    UNION ALL SELECT 'listed_low', count(*) FILTER (WHERE source = 'misp_osint' AND level = 'LOW') FROM f
    UNION ALL SELECT 'critical_below_limit', count(*) FILTER (WHERE level = 'CRITICAL' AND score < 0.9 AND source <> 'misp_osint') FROM f""",
)
def q10_override_checks(t: Tables):
    return quality.override_checks(_faulty_threats(t))


@query(
    "q9_statistics_checks",
    """WITH s AS (SELECT count(*) AS n, count(*) FILTER (WHERE "riskScore" >= 0.6) AS bad, count(*) FILTER (WHERE "riskScore" < 0.6) AS good,
        count(*) FILTER (WHERE "riskLevel" IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW')) AS levels, count(*) FILTER (WHERE "riskLevel" IN ('CRITICAL', 'HIGH')) AS high,
        avg("riskScore") AS mean, (SELECT count(*) FROM label_row) AS total FROM threat_row)
    SELECT 'counts_add_up' AS "check", CAST(bad + good + 1 <> n AS BIGINT) AS failed_rows FROM s
    UNION ALL SELECT 'malicious_within_total', CAST(bad + 1 > total AS BIGINT) FROM s
    UNION ALL SELECT 'levels_sum', CAST(levels <> n AS BIGINT) FROM s
    UNION ALL SELECT 'high_risk_recount', CAST(high + n <> high AS BIGINT) FROM s
    UNION ALL SELECT 'mean_range', CAST(mean < 0 OR mean > 1 AS BIGINT) FROM s""",
)
def q9_statistics_checks(t: Tables):
    from indicatrix.plans.gold_queries import threats
    from indicatrix.session import materialise

    stats = gold.statistics(t.label_row, materialise(threats(t), "threats"))
    # One count too many, and another that does not agree with the levels.
    faulty = stats.withColumns({"maliciousCount": F.col("maliciousCount") + 1, "highRiskCount": F.col("highRiskCount") + F.col("threatCount")})
    return quality.statistics_checks(faulty)


# -- one row per key -----------------------------------------------------------------------------


def _first(table: str, keys: str, order: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1"""


@query("g1_malware_silver", _first("label_row", "domain, first_seen", "url", "domain, first_seen, url"))
def g1_malware_silver(t: Tables):
    return picks.malware_silver(t.label_row).select("domain", "first_seen", "url")


@query(
    "g2_phish_silver",
    _first("label_row", "domain, first_seen, url", "label, source", "domain, first_seen, url, label, source"),
)
def g2_phish_silver(t: Tables):
    return picks.phish_silver(t.label_row.drop("ingest_date")).select("domain", "first_seen", "url", "label", "source")


@query("g3_union_labels", "SELECT domain, first_seen, source, url, min(label) AS label FROM label_row GROUP BY ALL")
def g3_union_labels(t: Tables):
    return picks.union_labels(t.label_row).select("domain", "first_seen", "source", "url", "label")


@query("g4_label_per_domain", "SELECT registered_domain, first_seen, source, url, label FROM label_pick")
def g4_label_per_domain(t: Tables):
    return picks.label_per_domain(t.labels_rd).select("registered_domain", "first_seen", "source", "url", "label")


@query(
    "g4_label_conflicts",
    """SELECT count(*) AS conflicts FROM (SELECT domain FROM label_row GROUP BY domain
      HAVING count(*) FILTER (WHERE source = 'benign_seed') > 0 AND count(*) FILTER (WHERE source <> 'benign_seed') > 0)""",
)
def g4_label_conflicts(t: Tables):
    return quality.label_conflicts(layers.binary_labels(t.labels_rd))


@query("g5_category_per_domain", "SELECT registered_domain, category FROM listed_domain")
def g5_category_per_domain(t: Tables):
    return matches.listed_domains(t.misp_attr)


@query(
    "g6_upsert_geo",
    """SELECT puny_domain, ip, CASE WHEN max(family) = 6 THEN 'moved' ELSE min(country) END AS country FROM dns_geo GROUP BY puny_domain, ip""",
)
def g6_upsert_geo(t: Tables):
    cache = t.dns_geo.select("puny_domain", "ip", "family", "country")
    new = cache.filter("family = 6").withColumn("country", F.lit("moved"))
    return lookups.upsert_geo(cache, new).select("puny_domain", "ip", "country")


@query(
    "g7_upsert_whois",
    """SELECT domain, fetched_at, registrar FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY fetched_at DESC NULLS LAST, registrar) AS rn
      FROM (SELECT domain, CASE WHEN o_orderkey % 8 <> 0 THEN fetched_at END AS fetched_at, registrar FROM whois
        UNION ALL SELECT domain, TIMESTAMP '2024-02-01 00:00:00', 'new' FROM whois WHERE o_orderkey % 5 = 0)) WHERE rn = 1""",
)
def g7_upsert_whois(t: Tables):
    n = F.col("o_orderkey")
    cache = t.whois.select("domain", F.when(n % 8 != 0, F.col("fetched_at")).alias("fetched_at"), "registrar")
    new = t.whois.filter(n % 5 == 0).select(F.upper("domain").alias("domain"), now().alias("fetched_at"), F.lit("new").alias("registrar"))
    return lookups.upsert_whois(cache, new)


@query(
    "g6_geo_cache",
    """SELECT puny_domain, ip, CASE WHEN max(s_suppkey) % 3 = 0 THEN 'third' WHEN max(s_suppkey) % 2 = 0 THEN 'second' ELSE 'first' END AS country
    FROM dns_geo JOIN (SELECT ip, max(s_suppkey) AS s_suppkey FROM supplier_ip GROUP BY ip) USING (ip) GROUP BY puny_domain, ip""",
)
def g6_geo_cache(t: Tables):
    """Three merges into a stored cache, each adding its rows alone; the last one of a pair counts."""
    cache = geo_cache(t.spark, scratch_dir(t.spark, "geo-cache"))
    suppliers = t.supplier_ip.groupBy("ip").agg(F.max("s_suppkey").alias("n"))
    rows = t.dns_geo.select("puny_domain", "ip", "family").distinct().join(suppliers, "ip")
    for country, part in (("first", rows), ("second", rows.filter("n % 2 = 0")), ("third", rows.filter("n % 3 = 0"))):
        cache.merge(part.withColumn("country", F.lit(country)))
    return cache.read().select("puny_domain", "ip", "country")


@query(
    "g7_whois_cache",
    """SELECT domain, max(fetched_at) AS fetched_at FROM whois GROUP BY domain""",
)
def g7_whois_cache(t: Tables):
    """Later fetches first, earlier ones after them, one bucket compacted in between: the latest fetch of a domain counts."""
    cache = whois_cache(t.spark, scratch_dir(t.spark, "whois-cache"))
    rows = t.whois.select("domain", "registrar", "created", "fetched_at")
    middle = now() - F.make_dt_interval(F.lit(30))
    cache.merge(rows.filter(F.col("fetched_at") >= middle))
    cache.compact(["0"])
    cache.merge(rows.filter(F.col("fetched_at") < middle))
    return cache.read().select("domain", "fetched_at")


@query(
    "g8_latest_ct",
    "SELECT domain AS registered_domain, max(first_seen) AS event_ts FROM label_row GROUP BY domain",
)
def g8_latest_ct(t: Tables):
    rows = t.labels_rd.select("registered_domain", F.col("first_seen").alias("event_ts"), "source", "url")
    return picks.latest_ct(rows).select("registered_domain", "event_ts")


@query(
    "g9_first_ct",
    """SELECT registered_domain, ingest_ts, domain FROM (SELECT *, row_number() OVER (PARTITION BY registered_domain ORDER BY ingest_ts, domain) AS rn
      FROM (SELECT concat('d', CAST(o_orderkey % 6500 AS VARCHAR), '.com') AS registered_domain, o_orderdate AS ingest_ts,
        concat('www', CAST(o_custkey AS VARCHAR), '.d', CAST(o_orderkey % 6500 AS VARCHAR), '.com') AS domain FROM orders)) WHERE rn = 1""",
)
def g9_first_ct(t: Tables):
    from indicatrix.functions.domains import with_registered_domain

    name = F.concat(
        F.lit("www"), F.col("o_custkey").cast("string"), F.lit(".d"), (F.col("o_orderkey") % 6500).cast("string"), F.lit(".com")
    )
    rows = with_registered_domain(t.orders.select(F.col("o_orderdate").alias("ingest_ts"), name.alias("domain")), "domain")
    return picks.first_ct(rows)


# -- set operations ---------------------------------------------------------------------------------


@query("i2_cache_and_new", "SELECT puny_domain, ip, country, CAST(NULL AS VARCHAR) AS isp FROM dns_geo UNION ALL SELECT puny_domain, ip, NULL, isp FROM dns_geo WHERE family = 6")
def i2_cache_and_new(t: Tables):
    cache = t.dns_geo.select("puny_domain", "ip", "country")
    new = t.dns_geo.filter("family = 6").select("puny_domain", "ip", "isp")
    return cache.unionByName(new, allowMissingColumns=True)


@query("i3_key_intersection", "SELECT domain FROM label_row INTERSECT SELECT domain FROM whois")
def i3_key_intersection(t: Tables):
    return t.label_row.select("domain").intersect(t.whois.select("domain"))
