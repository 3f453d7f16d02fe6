"""Registered queries for joins, lookup caches, aggregates and risk reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicatrix.operators import features, layers, lookups, matches, ordered, quality, risk
from indicatrix.operators.skew import lookup_join
from indicatrix.plans.registry import query
from indicatrix.plans.standins import Tables, now

_DNS_COLUMNS = "num_unique_ips, has_ipv6, num_countries, num_asns, sample_asn, sample_isp, sample_country"
_WHOIS_COLUMNS = """registrar, status, round(age_days, 6) AS age_days, round(days_to_expiry, 6) AS days_to_expiry,
  created_isnull, expires_isnull, has_error"""


def _rounded_days(df):
    return df.withColumns({c: F.round(c, 6) for c in ("age_days", "days_to_expiry")})


def listed(t: Tables):
    return matches.listed_domains(t.misp_attr)


def feature_rows(t: Tables):
    """Binary-labelled feature rows."""
    return features.feature_rows(layers.binary_labels(t.labels_rd), t.dns_geo, t.whois, now())


@query(
    "e1_feature_rows",
    f"""SELECT registered_domain, first_seen, source, url, label, last_first_seen, {_DNS_COLUMNS}, {_WHOIS_COLUMNS},
      CASE WHEN category IS NOT NULL THEN 1 ELSE 0 END AS is_in_misp
    FROM feature_row""",
)
def e1_feature_rows(t: Tables):
    rows = features.with_membership(feature_rows(t), listed(t))
    return _rounded_days(rows).drop("domain")


@query(
    "e2_dns_with_overlap",
    f"SELECT registered_domain, {_DNS_COLUMNS}, matched_misp_ip FROM dns_agg JOIN dns_hit USING (registered_domain)",
)
def e2_dns_with_overlap(t: Tables):
    return matches.dns_summary_with_overlap(t.dns_geo, matches.listed_ips(t.misp_attr))


@query(
    "e3_missing_pairs",
    "SELECT DISTINCT puny_domain, ip FROM dns_geo EXCEPT SELECT puny_domain, ip FROM dns_geo WHERE family = 4",
)
def e3_missing_pairs(t: Tables):
    return lookups.missing_pairs(t.dns_geo, t.dns_geo.filter("family = 4"))


@query(
    "e4_refresh_list",
    """SELECT DISTINCT domain FROM label_row l WHERE NOT EXISTS (SELECT 1 FROM whois w WHERE w.domain = l.domain)
      OR EXISTS (SELECT 1 FROM whois w WHERE w.domain = l.domain AND (fetched_at <= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 30 DAY
        OR (error <> '' AND fetched_at <= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 7 DAY)))""",
)
def e4_refresh_list(t: Tables):
    return lookups.refresh_list(t.label_row, t.whois, now())


@query(
    "e5_daily_snapshot",
    "SELECT * FROM dns_geo WHERE puny_domain IN (SELECT domain FROM label_row WHERE source = 'urlhaus')",
)
def e5_daily_snapshot(t: Tables):
    names = t.label_row.filter("source = 'urlhaus'").select(F.col("domain").alias("puny_domain"))
    return lookups.daily_snapshot(t.dns_geo, names, "puny_domain")


@query("e6_infrastructure_overlap", "SELECT registered_domain, matched_misp_ip FROM dns_hit")
def e6_infrastructure_overlap(t: Tables):
    return matches.overlap_flags(t.dns_geo, matches.listed_ips(t.misp_attr))


@query(
    "e7_list_match",
    """SELECT l.domain AS registered_domain, l.url, l.first_seen, m.category FROM label_row l LEFT JOIN listed_domain m ON l.domain = m.registered_domain""",
)
def e7_list_match(t: Tables):
    rows = t.labels_rd.select("registered_domain", "url", "first_seen")
    return lookup_join(rows, listed(t), "registered_domain")


@query(
    "e8_membership",
    "SELECT DISTINCT domain AS registered_domain, CAST(domain IN (SELECT registered_domain FROM listed_domain) AS INTEGER) AS is_in_misp FROM label_row",
)
def e8_membership(t: Tables):
    return features.with_membership(t.labels_rd.select("registered_domain").distinct(), listed(t))


@query(
    "e9_attach_geo",
    """SELECT DISTINCT puny_domain, d.ip, family, g.country, g.asn FROM dns_geo d LEFT JOIN
      (SELECT ip, min(n_name) AS country, min(concat('AS', CAST(64512 + n_nationkey AS VARCHAR))) AS asn
        FROM supplier_ip JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 <> 0 GROUP BY ip) g ON d.ip = g.ip""",
)
def e9_attach_geo(t: Tables):
    geo = t.supplier_ip.filter("s_suppkey % 3 <> 0").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "ip", F.col("n_name").alias("country"), F.concat(F.lit("AS"), (F.col("n_nationkey") + 64512).cast("string")).alias("asn")
    )
    return lookups.attach_geo(t.dns_geo, geo).select("puny_domain", "ip", "family", "country", "asn")


def _ct_inputs(t: Tables):
    base = t.labels_rd.select(
        "registered_domain", "domain", F.col("first_seen").alias("event_ts"), F.col("first_seen").alias("ingest_ts"), "source"
    )
    answers = t.dns_geo.select(
        F.col("puny_domain").alias("registered_domain"), "ip", "country", "asn", F.col("isp").alias("asname")
    )
    resolved = base.select("registered_domain").distinct().join(answers, "registered_domain", "left")
    return resolved, base


_CT_SQL = """SELECT l.registered_domain, coalesce(num_unique_ips, 0) AS num_unique_ips, coalesce(has_ipv6, 0) AS has_ipv6,
    coalesce(num_countries, 0) AS num_countries, coalesce(num_asns, 0) AS num_asns, sample_asn, sample_isp, sample_country{}
  FROM label_pick l LEFT JOIN dns_agg d USING (registered_domain)"""


@query("f2_ct_summary", _CT_SQL.format(""))
def f2_ct_summary(t: Tables):
    return features.ct_summary(*_ct_inputs(t)).drop("domain_sample", "event_ts", "source")


@query(
    "e10_ct_sample",
    _CT_SQL.format(", l.domain AS domain_sample, l.first_seen AS event_ts, l.source"),
)
def e10_ct_sample(t: Tables):
    return features.ct_summary(*_ct_inputs(t))


@query(
    "e11_coverage",
    """SELECT count(*) AS domains, round(100.0 * count(*) FILTER (WHERE domain IN (SELECT puny_domain FROM dns_geo)) / count(*), 2) AS dns_pct,
      round(100.0 * count(*) FILTER (WHERE domain IN (SELECT domain FROM whois)) / count(*), 2) AS whois_pct
    FROM (SELECT DISTINCT domain FROM label_row WHERE source = 'benign_seed')""",
)
def e11_coverage(t: Tables):
    return quality.coverage(t.labels_rd.filter("source = 'benign_seed'"), t.dns_geo, t.whois)


@query(
    "e12_locate_ips",
    """SELECT DISTINCT ip, CASE WHEN family = 6 THEN '2001:db8::/32' WHEN s_nationkey % 3 = 0 THEN '10.0.0.0/8' ELSE concat('10.0.', CAST(s_nationkey AS VARCHAR), '.0/24') END AS network,
      CASE WHEN family = 6 THEN 'SIX' WHEN s_nationkey % 3 = 0 THEN 'WIDE' ELSE n_name END AS country
    FROM supplier_ip JOIN nation ON s_nationkey = n_nationkey""",
)
def e12_locate_ips(t: Tables):
    n = F.col("n_nationkey")
    narrow = t.nation.filter(n % 3 != 0).select(
        F.concat(F.lit("10.0."), n.cast("string"), F.lit(".0/24")).alias("network"), F.col("n_name").alias("country")
    )
    wide = t.nation.filter(n == 0).select(F.lit("10.0.0.0/8").alias("network"), F.lit("WIDE").alias("country"))
    six = t.region.select(
        F.when(F.col("r_regionkey") == 0, "2001:db8::/32").otherwise(F.concat(F.lit("2001:db8:"), F.col("r_regionkey").cast("string"), F.lit("::/48"))).alias("network"),
        F.lit("SIX").alias("country"),
    )
    return lookups.locate_ips(t.supplier_ip, narrow.unionByName(wide).unionByName(six))


# -- aggregates --------------------------------------------------------------------------------------


@query("f1_dns_summary", f"SELECT registered_domain, {_DNS_COLUMNS} FROM dns_agg")
def f1_dns_summary(t: Tables):
    return features.dns_summary(t.dns_geo)


@query(
    "f3_last_seen",
    """SELECT domain AS registered_domain, max(first_seen) AS last_first_seen, strftime(max(ingest_date), '%Y-%m-%d') AS last_ingest_date
    FROM label_row GROUP BY domain""",
)
def f3_last_seen(t: Tables):
    day = features.last_seen(t.labels_rd, "ingest_date")
    days = day.withColumn("last_ingest_date", F.date_format("last_ingest_date", "yyyy-MM-dd"))
    return features.last_seen(t.labels_rd).join(days, "registered_domain")


_KEYED_SQL = """(SELECT *, 'com' AS tld,
    CASE WHEN age_days IS NULL THEN 'age:unknown' WHEN age_days < 7 THEN 'age:<7d' WHEN age_days < 30 THEN 'age:7-30d'
      WHEN age_days < 180 THEN 'age:30-180d' WHEN age_days < 365 THEN 'age:180-365d' ELSE 'age:>365d' END AS age_bucket,
    CASE WHEN num_unique_ips IS NULL THEN 'ips:none' WHEN num_unique_ips = 1 THEN 'ips:1' WHEN num_unique_ips <= 3 THEN 'ips:2-3'
      WHEN num_unique_ips <= 10 THEN 'ips:4-10' ELSE 'ips:>10' END AS ip_bucket,
    CASE WHEN length(registered_domain) <= 10 THEN 'len:<=10' ELSE 'len:11-20' END AS len_bucket,
    CASE WHEN (length(registered_domain) - 5) / (length(registered_domain) + 1e-6) <= 0.1 THEN 'digits:<10%'
      WHEN (length(registered_domain) - 5) / (length(registered_domain) + 1e-6) <= 0.3 THEN 'digits:10-30%' ELSE 'digits:>30%' END AS digit_bucket
  FROM feature_row)"""


_ENTROPY_SQL = """(SELECT registered_domain, CASE WHEN bits <= 2.5 THEN 'entropy:low' WHEN bits <= 3.5 THEN 'entropy:med' ELSE 'entropy:high' END AS entropy_bucket
  FROM (SELECT registered_domain, -sum(k * 1.0 / size * log2(k * 1.0 / size)) AS bits
    FROM (SELECT registered_domain, length(registered_domain) AS size, ch, count(*) AS k
      FROM (SELECT registered_domain, unnest(string_split(registered_domain, '')) AS ch FROM label_pick) GROUP BY ALL) GROUP BY registered_domain))"""


@query(
    "f4_label_risk",
    f"""SELECT key, value, count(*) AS count, CAST(sum(label) AS BIGINT) AS phish, CAST(count(*) - sum(label) AS BIGINT) AS benign, round(avg(label), 9) AS phish_rate
    FROM (SELECT label, unnest(['tld', 'registrar', 'age_bucket', 'ip_bucket', 'len_bucket', 'digit_bucket', 'sample_country', 'entropy_bucket']) AS key,
        unnest([tld, registrar, age_bucket, ip_bucket, len_bucket, digit_bucket, sample_country, entropy_bucket]) AS value FROM {_KEYED_SQL} k JOIN {_ENTROPY_SQL} USING (registered_domain))
    WHERE value IS NOT NULL GROUP BY key, value HAVING count(*) >= 30""",
)
def f4_label_risk(t: Tables):
    rows = risk.with_group_keys(feature_rows(t))
    return risk.label_risk_all(rows, risk.GROUP_KEYS).withColumn("phish_rate", F.round("phish_rate", 9))


@query(
    "f4_country_risk",
    """SELECT sample_country, count(*) AS count, CAST(sum(label) AS BIGINT) AS phish, CAST(count(*) - sum(label) AS BIGINT) AS benign, round(avg(label), 9) AS phish_rate
    FROM feature_row WHERE sample_country IS NOT NULL GROUP BY sample_country HAVING count(*) >= 30
    ORDER BY avg(label) DESC, count(*) DESC, sample_country LIMIT 25""",
)
def f4_country_risk(t: Tables):
    return risk.label_risk(feature_rows(t), "sample_country", 30, 25).withColumn("phish_rate", F.round("phish_rate", 9))


@query(
    "f4_entropy_risk",
    """WITH e AS (SELECT registered_domain, label, -sum(k * 1.0 / size * log2(k * 1.0 / size)) AS bits
      FROM (SELECT registered_domain, label, length(registered_domain) AS size, ch, count(*) AS k
        FROM (SELECT registered_domain, CASE WHEN source = 'benign_seed' THEN 0 ELSE 1 END AS label,
          unnest(string_split(registered_domain, '')) AS ch FROM label_pick) GROUP BY ALL) GROUP BY registered_domain, label)
    SELECT CASE WHEN bits <= 2.5 THEN 'entropy:low' WHEN bits <= 3.5 THEN 'entropy:med' ELSE 'entropy:high' END AS entropy_bucket, count(*) AS count,
      CAST(sum(label) AS BIGINT) AS phish, CAST(count(*) - sum(label) AS BIGINT) AS benign, round(avg(label), 9) AS phish_rate
    FROM e GROUP BY 1 HAVING count(*) >= 30""",
)
def f4_entropy_risk(t: Tables):
    rows = risk.with_group_keys(feature_rows(t))
    return risk.label_risk(rows, "entropy_bucket", 30, 20).withColumn("phish_rate", F.round("phish_rate", 9))


_SCORE_COLUMNS = """count(*) AS count, round(avg(score), 9) AS avg_score, max(score) AS max_score,
  round(100.0 * count(*) FILTER (WHERE score >= 0.9) / count(*), 9) AS pct_high"""


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 9) for n in names})


@query(
    "f5_score_risk",
    f"""SELECT source, {_SCORE_COLUMNS} FROM scored GROUP BY source HAVING count(*) >= 20
    ORDER BY avg(CASE WHEN score >= 0.9 THEN 1.0 ELSE 0.0 END) DESC, avg(score) DESC, source LIMIT 30""",
)
def f5_score_risk(t: Tables):
    return _rounded(risk.score_risk(t.scored, "source"), "avg_score", "pct_high")


@query(
    "f6_score_by_ip_count",
    """SELECT CASE WHEN coalesce(num_unique_ips, 0) = 0 THEN 'ips:0' WHEN num_unique_ips = 1 THEN 'ips:1' WHEN num_unique_ips <= 3 THEN 'ips:2-3'
        WHEN num_unique_ips <= 10 THEN 'ips:4-10' ELSE 'ips:>10' END AS ip_bucket, count(*) AS count, round(avg(score), 9) AS avg_score,
      round(100.0 * count(*) FILTER (WHERE score >= 0.9) / count(*), 9) AS pct_high
    FROM scored_domain LEFT JOIN dns_agg USING (registered_domain) GROUP BY 1""",
)
def f6_score_by_ip_count(t: Tables):
    rows = t.scored_domain.join(features.dns_summary(t.dns_geo), "registered_domain", "left")
    return _rounded(risk.score_by_ip_count(rows), "avg_score", "pct_high")


@query(
    "f7_score_by_bucket",
    """SELECT CASE WHEN score <= 0.2 THEN 'low' WHEN score <= 0.5 THEN 'medium' WHEN score <= 0.8 THEN 'high' ELSE 'critical' END AS risk_bucket,
      count(*) AS count, min(score) AS min, max(score) AS max, round(avg(score), 9) AS mean FROM scored GROUP BY 1""",
)
def f7_score_by_bucket(t: Tables):
    return _rounded(risk.score_by_bucket(t.scored), "mean")


@query(
    "f8_score_summary",
    """SELECT count(*) AS count, round(avg(score), 9) AS mean, round(stddev_samp(score), 9) AS std, min(score) AS min, max(score) AS max,
      round(quantile_cont(score, 0.5), 9) AS p50, round(quantile_cont(score, 0.9), 9) AS p90, round(quantile_cont(score, 0.95), 9) AS p95,
      round(quantile_cont(score, 0.99), 9) AS p99, round(quantile_cont(score, 0.999), 9) AS p999 FROM scored""",
)
def f8_score_summary(t: Tables):
    return _rounded(risk.score_summary(t.scored), "mean", "std", *risk.QUANTILES)


@query(
    "f9_thresholds",
    """SELECT CAST(threshold AS DOUBLE) AS threshold, count(*) FILTER (WHERE score >= threshold) AS n,
      round(100.0 * count(*) FILTER (WHERE score >= threshold) / count(*), 9) AS pct
    FROM scored, (SELECT unnest([0.5, 0.9, 0.99]) AS threshold) GROUP BY threshold""",
)
def f9_thresholds(t: Tables):
    return _rounded(risk.score_thresholds(t.scored), "pct")


@query(
    "f10_histogram",
    """SELECT CAST(least(floor((score - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS count
    FROM scored, (SELECT min(score) AS lo, max(score) AS hi FROM scored) GROUP BY 1""",
)
def f10_histogram(t: Tables):
    return risk.score_histogram(t.scored)


@query(
    "f11_latency",
    """SELECT round(quantile_cont(s, 0.5), 6) AS p50, round(quantile_cont(s, 0.95), 6) AS p95
    FROM (SELECT ((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts) + 500) // 1000) / 1000.0 AS s FROM events)""",
)
def f11_latency(t: Tables):
    from indicatrix.functions.times import seconds_between

    latency = t.events.select(seconds_between(now(), F.col("ts")).alias("latency_sec"))
    points = ordered.exact_quantiles(latency, "latency_sec", {"p50": 0.5, "p95": 0.95})
    return points.withColumns({n: F.round(n, 6) for n in ("p50", "p95")})


@query(
    "f14_dataset_counts",
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg FROM feature_row""",
)
def f14_dataset_counts(t: Tables):
    return features.dataset_counts(features.label_rows(layers.binary_labels(t.labels_rd)))


@query(
    "f15_resolution_coverage",
    """SELECT count(*) AS domains, round(100.0 * count(num_unique_ips) / count(*), 9) AS coverage_pct
    FROM label_pick LEFT JOIN dns_agg USING (registered_domain)""",
)
def f15_resolution_coverage(t: Tables):
    return _rounded(quality.resolution_coverage(features.ct_summary(*_ct_inputs(t))), "coverage_pct")
