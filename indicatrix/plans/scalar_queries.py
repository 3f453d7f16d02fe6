"""Registered queries for scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicatrix import schemas
from indicatrix.functions import buckets, domains, ip, text, times
from indicatrix.operators import features, serving
from indicatrix.plans.registry import query
from indicatrix.plans.standins import Tables, now


def _url_variant(t: Tables):
    """URLs in the untidy forms that feeds hold."""
    n, url = F.col("page_id"), F.col("url")
    forms = [
        F.concat(F.lit("  "), url, F.lit(" ")),
        F.regexp_replace(url, "://", "://user:pw@"),
        F.regexp_replace(url, "^(https?://[^/]*)", "$1:8080"),
        F.substring_index(url, "://", -1),
        F.upper(url),
        F.concat(F.lit("http://[2001:DB8::"), n.cast("string"), F.lit("]:80/x")),
        F.regexp_replace(url, r"\.example", "_x.example"),
        F.lit(""),
    ]
    variant = url
    for i, form in enumerate(forms):
        variant = F.when(n % 9 == i, form).otherwise(variant)
    return t.pages.select("page_id", variant.alias("url"))


_URL_VARIANT_SQL = r"""
    SELECT page_id, CASE page_id % 9
      WHEN 0 THEN concat('  ', url, ' ') WHEN 1 THEN replace(url, '://', '://user:pw@')
      WHEN 2 THEN regexp_replace(url, '^(https?://[^/]*)', '\1:8080') WHEN 3 THEN split_part(url, '://', 2)
      WHEN 4 THEN upper(url) WHEN 5 THEN concat('http://[2001:DB8::', CAST(page_id AS VARCHAR), ']:80/x')
      WHEN 6 THEN replace(url, '.example', '_x.example') WHEN 7 THEN '' ELSE url END AS url
    FROM pages"""


@query(
    "c1_url_host",
    f"""WITH v AS ({_URL_VARIANT_SQL}),
    s AS (SELECT *, CASE WHEN trim(url) LIKE 'http://%' OR trim(url) LIKE 'https://%'
        THEN split_part(trim(url), '://', 2) ELSE trim(url) END AS rest FROM v),
    a AS (SELECT *, split_part(split_part(split_part(rest, '/', 1), '?', 1), '#', 1) AS netloc FROM s),
    h AS (SELECT *, CASE WHEN contains(netloc, '@') THEN split_part(netloc, '@', 2) ELSE netloc END AS hostport FROM a)
    SELECT page_id, url, nullif(lower(CASE WHEN starts_with(hostport, '[')
      THEN split_part(substr(hostport, 2), ']', 1) ELSE split_part(hostport, ':', 1) END), '') AS host FROM h""",
)
def c1_url_host(t: Tables):
    return _url_variant(t).withColumn("host", text.url_host(F.col("url")))


def _raw_name(t: Tables):
    n, d = F.col("page_id"), F.col("domain")
    raw = (
        F.when(n % 5 == 0, F.concat(F.lit("*."), F.upper(d), F.lit(".")))
        .when(n % 5 == 1, F.concat(F.lit(" "), d, F.lit("..")))
        .when(n % 5 == 2, F.concat(F.lit("www.*."), d))
        .when(n % 5 == 3, F.concat(F.lit("two words "), d))
        .otherwise(F.regexp_replace(d, r"\.", "-"))
    )
    return t.feed_url.select("page_id", raw.alias("raw"))


_RAW_NAME_SQL = """
    SELECT page_id, CASE page_id % 5 WHEN 0 THEN concat('*.', upper(domain), '.') WHEN 1 THEN concat(' ', domain, '..')
      WHEN 2 THEN concat('www.*.', domain) WHEN 3 THEN concat('two words ', domain)
      ELSE replace(domain, '.', '-') END AS raw FROM feed_url"""


@query(
    "c2_clean_domain",
    f"""SELECT page_id, raw,
      CASE WHEN starts_with(rtrim(lower(trim(raw)), '.'), '*.') THEN substr(rtrim(lower(trim(raw)), '.'), 3)
        ELSE rtrim(lower(trim(raw)), '.') END AS cleaned,
      replace(rtrim(lower(trim(raw)), '.'), '*.', '') AS cleaned_anywhere
    FROM ({_RAW_NAME_SQL})""",
)
def c2_clean_domain(t: Tables):
    raw = F.col("raw")
    return _raw_name(t).withColumns(
        {"cleaned": text.clean_domain(raw), "cleaned_anywhere": text.clean_domain_anywhere(raw)}
    )


@query(
    "c3_domain_chars",
    f"""SELECT page_id, raw, length(raw) > 0 AND length(translate(lower(raw),
      'abcdefghijklmnopqrstuvwxyz0123456789-._*', '')) = 0 AS valid FROM ({_RAW_NAME_SQL})""",
)
def c3_domain_chars(t: Tables):
    return _raw_name(t).withColumn("valid", text.has_domain_chars(F.col("raw")))


@query(
    "c4_last_label",
    f"""SELECT page_id, raw, CASE WHEN contains(raw, '.') THEN string_split(raw, '.')[-1] END AS tld,
      CASE WHEN contains(raw, '.') THEN string_split(raw, '.')[-1] ELSE '' END AS tld_or_empty
    FROM ({_RAW_NAME_SQL})""",
)
def c4_last_label(t: Tables):
    raw = F.col("raw")
    return _raw_name(t).withColumns({"tld": text.last_label(raw), "tld_or_empty": text.last_label(raw, "")})


# Hosts whose public suffix is known: (form, suffix, registered domain) over a name p.
_SUFFIX_CASES = [
    ("{p}.com", "com", "{p}.com"),
    ("www.{p}.co.uk", "co.uk", "{p}.co.uk"),
    ("a.{p}.ck", "{p}.ck", "a.{p}.ck"),
    ("{p}.www.ck", "ck", "www.ck"),
    ("10.0.0.7", "", ""),
    ("{p}.nosuchtld", "", ""),
    ("https://u@{p}.r2.dev:80/x", "dev", "r2.dev"),
    ("co.jp", "co.jp", ""),
    ("{p}.city.kobe.jp", "kobe.jp", "city.kobe.jp"),
    ("x.y.{p}.COM.AU.", "com.au", "{p}.com.au"),
]


def _suffix_sql(column: int) -> str:
    def said(form: str) -> str:
        return "concat('" + form.replace("{p}", "', p, '") + "')"

    whens = " ".join(f"WHEN {i} THEN {said(case[column])}" for i, case in enumerate(_SUFFIX_CASES))
    return f"CASE n % {len(_SUFFIX_CASES)} {whens} END"


def _suffix_case(t: Tables):
    n = F.col("o_orderkey")
    name = F.concat(F.lit("d"), n.cast("string"))
    host = F.lit(None).cast("string")
    for i, case in enumerate(_SUFFIX_CASES):
        before, _, after = case[0].partition("{p}")
        form = F.concat(F.lit(before), name, F.lit(after)) if "{p}" in case[0] else F.lit(case[0])
        host = F.when(n % len(_SUFFIX_CASES) == i, form).otherwise(host)
    return t.orders.select("o_orderkey", host.alias("host"))


_SUFFIX_BASE = "(SELECT o_orderkey, o_orderkey AS n, concat('d', CAST(o_orderkey AS VARCHAR)) AS p FROM orders)"


@query("c5_public_suffix", f"SELECT o_orderkey, {_suffix_sql(0)} AS host, {_suffix_sql(1)} AS suffix FROM {_SUFFIX_BASE}")
def c5_public_suffix(t: Tables):
    return domains.with_registered_domain(_suffix_case(t), "host", "suffix", None)


@query(
    "c6_registered_domain",
    f"SELECT o_orderkey, {_suffix_sql(0)} AS host, {_suffix_sql(2)} AS registered_domain FROM {_SUFFIX_BASE}",
)
def c6_registered_domain(t: Tables):
    return domains.with_registered_domain(_suffix_case(t), "host")


@query(
    "c7_punycode",
    """SELECT doc_id, name, NOT regexp_matches(replace(name, 'ß', 'ss'), '[^ -~]') AS same_or_folded
    FROM (SELECT DISTINCT doc_id, concat(unnest(regexp_extract_all(lower(text), '[a-zà-öø-ÿ]+')), '.com') AS name FROM documents)""",
)
def c7_punycode(t: Tables):
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-zà-öø-ÿ]+"), 0))
    names = t.documents.select("doc_id", F.explode(words).alias("word")).select("doc_id", F.concat("word", F.lit(".com")).alias("name"))
    return domains.with_punycode(names, "name").select(
        "doc_id", "name", (~F.startswith("puny_domain", F.lit("xn--"))).alias("same_or_folded")
    )


@query(
    "c8_ip_family",
    """SELECT s_suppkey, ip, CASE k WHEN 0 THEN 4 WHEN 1 THEN 6 WHEN 4 THEN 6 END AS family,
      CASE WHEN k IN (1, 4) THEN 1 ELSE 0 END AS is_ipv6
    FROM (SELECT s_suppkey, s_suppkey % 6 AS k, CASE s_suppkey % 6
        WHEN 0 THEN concat('10.0.0.', CAST(s_suppkey % 250 AS VARCHAR))
        WHEN 1 THEN concat('2001:db8::', CAST(s_suppkey % 9999 AS VARCHAR))
        WHEN 2 THEN concat('10.0.0.', CAST(256 + s_suppkey AS VARCHAR)) WHEN 3 THEN s_name
        WHEN 4 THEN '::ffff:10.0.0.1' ELSE '1:2:3' END AS ip FROM supplier)""",
)
def c8_ip_family(t: Tables):
    n = F.col("s_suppkey")
    address = (
        F.when(n % 6 == 0, F.concat(F.lit("10.0.0."), (n % 250).cast("string")))
        .when(n % 6 == 1, F.concat(F.lit("2001:db8::"), (n % 9999).cast("string")))
        .when(n % 6 == 2, F.concat(F.lit("10.0.0."), (n + 256).cast("string")))
        .when(n % 6 == 3, F.col("s_name"))
        .when(n % 6 == 4, "::ffff:10.0.0.1")
        .otherwise("1:2:3")
    )
    return t.supplier.select(n, address.alias("ip")).withColumns(
        {"family": ip.ip_family(F.col("ip")), "is_ipv6": ip.ipv6_flag(F.col("ip"))}
    )


@query(
    "c9_utc_or_run_time",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 3) THEN TIMESTAMP '2024-02-01 00:00:00'
      ELSE o_orderdate END AS first_seen FROM orders""",
)
def c9_utc_or_run_time(t: Tables):
    n, day = F.col("o_orderkey"), F.col("o_orderdate")
    stamp = (
        F.when(n % 5 == 0, "not a date")
        .when(n % 5 == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(n % 5 == 2, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(n % 5 == 4, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    return t.orders.select(n, times.utc_or(stamp, now()).alias("first_seen"))


@query(
    "c10_latency",
    """SELECT event_id, ((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts) + 500) // 1000) / 1000.0 AS latency_sec
    FROM events""",
)
def c10_latency(t: Tables):
    return t.events.select("event_id", times.seconds_between(now(), F.col("ts")).alias("latency_sec"))


_NAMES_SQL = "(SELECT DISTINCT domain FROM label_row UNION SELECT DISTINCT domain FROM feed_url)"


def _names(t: Tables):
    return t.label_row.select("domain").union(t.feed_url.select("domain")).distinct()


_ENTROPY_SQL = """(SELECT domain, -sum(k * 1.0 / size * log2(k * 1.0 / size)) AS entropy
    FROM (SELECT domain, length(domain) AS size, ch, count(*) AS k
      FROM (SELECT domain, unnest(string_split(domain, '')) AS ch FROM {names}) GROUP BY domain, ch)
    GROUP BY domain)"""


@query(
    "c11_entropy",
    f"SELECT domain, round(entropy, 6) AS entropy FROM {_ENTROPY_SQL.format(names=_NAMES_SQL)}",
)
def c11_entropy(t: Tables):
    return _names(t).withColumn("entropy", F.round(text.entropy(F.col("domain")), 6))


@query(
    "c12_lexical_features",
    f"""SELECT n.domain, length(n.domain) AS len, length(regexp_replace(n.domain, '[^0-9]', '', 'g')) AS digits,
      length(regexp_replace(n.domain, '[^-]', '', 'g')) AS hyphens, length(regexp_replace(n.domain, '[^.]', '', 'g')) AS dots,
      round(length(regexp_replace(n.domain, '[^0-9]', '', 'g')) / (length(n.domain) + 1e-6), 6) AS digit_ratio,
      round(length(regexp_replace(n.domain, '[^-]', '', 'g')) / (length(n.domain) + 1e-6), 6) AS hyphen_ratio,
      round(e.entropy, 6) AS entropy, CAST(contains(n.domain, 'xn--') AS INTEGER) AS xn_punycode,
      length(regexp_replace(n.domain, '[^.]', '', 'g')) + 1 AS labels,
      length(string_split(n.domain, '.')[-1]) AS tld_len
    FROM {_NAMES_SQL} n JOIN {_ENTROPY_SQL.format(names=_NAMES_SQL)} e ON n.domain = e.domain""",
)
def c12_lexical_features(t: Tables):
    found = text.lexical_features(F.col("domain"))
    rounded = {k: F.round(v, 6).alias(k) if k.endswith(("ratio", "entropy")) else v.cast("bigint").alias(k) for k, v in found.items()}
    rounded["xn_punycode"] = found["xn_punycode"]
    return _names(t).select("domain", *rounded.values())


@query(
    "c13_whois_features",
    """SELECT o_orderkey, round(epoch_us(TIMESTAMP '2024-02-01 00:00:00' - created) / 86400e6, 6) AS age_days,
      round(epoch_us(expires - TIMESTAMP '2024-02-01 00:00:00') / 86400e6, 6) AS days_to_expiry,
      CAST(created IS NULL AS INTEGER) AS created_isnull, CAST(expires IS NULL AS INTEGER) AS expires_isnull,
      CAST(error IS NOT NULL AS INTEGER) AS has_error
    FROM (SELECT o_orderkey, error, CASE WHEN o_orderkey % 7 <> 0 THEN created END AS created,
      CASE WHEN o_orderkey % 13 <> 0 THEN expires END AS expires FROM whois)""",
)
def c13_whois_features(t: Tables):
    n = F.col("o_orderkey")
    rows = t.whois.withColumns(
        {"created": F.when(n % 7 != 0, F.col("created")), "expires": F.when(n % 13 != 0, F.col("expires"))}
    )
    found = rows.select(n, *times.whois_features(F.col("created"), F.col("expires"), F.col("error"), now()))
    return found.withColumns({c: F.round(c, 6) for c in ("age_days", "days_to_expiry")})


# Scores on and beside every class limit, and NULL.
_SCORE_SQL = """(SELECT doc_id, CASE doc_id % 11 WHEN 0 THEN 0.2 WHEN 1 THEN 0.5 WHEN 2 THEN 0.6 WHEN 3 THEN 0.8
    WHEN 4 THEN 0.9 WHEN 5 THEN 1.0 WHEN 6 THEN 0.0 ELSE score END AS score FROM scored)"""


def _scores(t: Tables):
    edges = [0.2, 0.5, 0.6, 0.8, 0.9, 1.0, 0.0]
    value = F.col("score")
    for i, edge in enumerate(edges):
        value = F.when(F.col("doc_id") % 11 == i, F.lit(edge)).otherwise(value)
    return t.scored.select("doc_id", value.alias("score"))


@query(
    "c14_risk_level",
    f"""SELECT doc_id, score, CASE WHEN score >= 0.9 THEN 'CRITICAL' WHEN score >= 0.6 THEN 'HIGH'
      WHEN score >= 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM {_SCORE_SQL}""",
)
def c14_risk_level(t: Tables):
    return _scores(t).withColumn("risk_level", buckets.risk_level(F.col("score")))


@query(
    "c15_risk_bucket",
    f"""SELECT doc_id, score, CASE WHEN score <= 0.2 THEN 'low' WHEN score <= 0.5 THEN 'medium'
      WHEN score <= 0.8 THEN 'high' ELSE 'critical' END AS risk_bucket FROM {_SCORE_SQL}""",
)
def c15_risk_bucket(t: Tables):
    return _scores(t).withColumn("risk_bucket", buckets.risk_bucket(F.col("score")))


@query(
    "c16_display_tier",
    f"""SELECT doc_id, score, CASE WHEN score >= 0.75 THEN 'red' WHEN score >= 0.5 THEN 'orange'
      WHEN score >= 0.3 THEN 'yellow' ELSE 'green' END AS tier FROM {_SCORE_SQL}""",
)
def c16_display_tier(t: Tables):
    return _scores(t).withColumn("tier", buckets.display_tier(F.col("score")))


@query(
    "c17_threat_type",
    """SELECT o_orderkey, feed, CASE o_orderkey % 4 WHEN 0 THEN 'malware' WHEN 1 THEN 'phishing' WHEN 2 THEN 'malware'
      ELSE 'suspicious' END AS threat_type
    FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'abuse URLhaus' WHEN 1 THEN 'OpenPhish'
      WHEN 2 THEN 'misp_osint' ELSE 'benign_seed' END AS feed FROM orders)""",
)
def c17_threat_type(t: Tables):
    n = F.col("o_orderkey")
    feed = (
        F.when(n % 4 == 0, "abuse URLhaus").when(n % 4 == 1, "OpenPhish").when(n % 4 == 2, "misp_osint")
        .otherwise("benign_seed")
    )
    return t.orders.select(n, feed.alias("feed")).withColumn("threat_type", buckets.threat_type(F.col("feed")))


@query(
    "c18_ip_bucket",
    """SELECT l.registered_domain, d.num_unique_ips,
      CASE WHEN coalesce(num_unique_ips, 0) = 0 THEN 'ips:0' WHEN num_unique_ips = 1 THEN 'ips:1'
        WHEN num_unique_ips <= 3 THEN 'ips:2-3' WHEN num_unique_ips <= 10 THEN 'ips:4-10' ELSE 'ips:>10' END AS of_scores,
      CASE WHEN num_unique_ips IS NULL THEN 'ips:none' WHEN num_unique_ips = 0 THEN 'ips:0' WHEN num_unique_ips = 1 THEN 'ips:1'
        WHEN num_unique_ips <= 3 THEN 'ips:2-3' WHEN num_unique_ips <= 10 THEN 'ips:4-10' ELSE 'ips:>10' END AS of_labels
    FROM label_pick l LEFT JOIN dns_agg d USING (registered_domain)""",
)
def c18_ip_bucket(t: Tables):
    n = F.col("num_unique_ips")
    counts = features.dns_summary(t.dns_geo).select("registered_domain", "num_unique_ips")
    rows = t.labels_rd.select("registered_domain").distinct().join(counts, "registered_domain", "left")
    return rows.withColumns(
        {"of_scores": buckets.ip_count_bucket(n), "of_labels": buckets.ip_count_bucket(n, "ips:none")}
    )


@query(
    "c19_age_bucket",
    """SELECT o_orderkey, age_days, CASE WHEN age_days IS NULL THEN 'age:unknown' WHEN age_days < 7 THEN 'age:<7d'
      WHEN age_days < 30 THEN 'age:7-30d' WHEN age_days < 180 THEN 'age:30-180d' WHEN age_days < 365 THEN 'age:180-365d'
      ELSE 'age:>365d' END AS age_bucket
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 9 THEN CAST(o_orderkey % 400 AS DOUBLE) END AS age_days FROM orders)""",
)
def c19_age_bucket(t: Tables):
    n = F.col("o_orderkey")
    age = F.when(n % 10 != 9, (n % 400).cast("double"))
    return t.orders.select(n, age.alias("age_days")).withColumn("age_bucket", buckets.age_bucket(F.col("age_days")))


@query(
    "c20_name_buckets",
    f"""SELECT n.domain, CASE WHEN length(n.domain) <= 10 THEN 'len:<=10' WHEN length(n.domain) <= 20 THEN 'len:11-20'
        WHEN length(n.domain) <= 30 THEN 'len:21-30' ELSE 'len:>30' END AS len_bucket,
      CASE WHEN r <= 0.1 THEN 'digits:<10%' WHEN r <= 0.3 THEN 'digits:10-30%' ELSE 'digits:>30%' END AS digit_bucket,
      CASE WHEN entropy <= 2.5 THEN 'entropy:low' WHEN entropy <= 3.5 THEN 'entropy:med' ELSE 'entropy:high' END AS entropy_bucket
    FROM (SELECT domain, length(regexp_replace(domain, '[^0-9]', '', 'g')) / (length(domain) + 1e-6) AS r FROM {_NAMES_SQL}) n
      JOIN {_ENTROPY_SQL.format(names=_NAMES_SQL)} e ON n.domain = e.domain""",
)
def c20_name_buckets(t: Tables):
    name = F.col("domain")
    found = text.lexical_features(name)
    return _names(t).select(
        name,
        buckets.length_bucket(found["len"]).alias("len_bucket"),
        buckets.digit_bucket(found["digit_ratio"]).alias("digit_bucket"),
        buckets.entropy_bucket(found["entropy"]).alias("entropy_bucket"),
    )


@query(
    "c21_suspicious_words",
    """SELECT p_partkey, name, p_partkey % 4 IN (0, 2) AS suspicious
    FROM (SELECT p_partkey, concat(replace(p_name, ' ', '-'), CASE p_partkey % 4 WHEN 0 THEN '-Secure.com'
      WHEN 1 THEN '.com' WHEN 2 THEN '-dHl.net' ELSE '.org' END) AS name FROM part)""",
)
def c21_suspicious_words(t: Tables):
    n = F.col("p_partkey")
    tail = F.when(n % 4 == 0, "-Secure.com").when(n % 4 == 1, ".com").when(n % 4 == 2, "-dHl.net").otherwise(".org")
    rows = t.part.select(n, F.concat(F.regexp_replace("p_name", " ", "-"), tail).alias("name"))
    return rows.withColumn("suspicious", text.has_suspicious_word(F.col("name")))


@query(
    "c22_display_fields",
    """SELECT registered_domain, coalesce(sample_country, 'Unknown') AS country, coalesce(registrar, 'Unknown') AS registrar,
      coalesce(CAST(trunc(age_days) AS INTEGER), -1) AS "domainAgeDays", round(score, 4) AS "riskScore"
    FROM label_pick LEFT JOIN dns_agg USING (registered_domain) LEFT JOIN whois_pick USING (registered_domain)
      JOIN scored_domain USING (registered_domain)""",
)
def c22_display_fields(t: Tables):
    rows = features.feature_rows(t.labels_rd, t.dns_geo, t.whois, now()).join(t.scored_domain, "registered_domain")
    return rows.select(
        "registered_domain",
        *buckets.display_fields(F.col("sample_country"), F.col("registrar"), F.col("age_days"), F.col("score")),
    )


@query(
    "c23_display_text",
    """SELECT page_id, CASE WHEN length(url) <= 40 THEN url ELSE concat(substr(url, 1, 40), '...') END AS short,
      CASE WHEN page_id % 10 = 0 THEN '0%' ELSE concat(CAST(CAST(floor(1000.0 * (page_id % 7) / (page_id % 10) + 0.5) AS BIGINT) // 10 AS VARCHAR),
        '.', CAST(CAST(floor(1000.0 * (page_id % 7) / (page_id % 10) + 0.5) AS BIGINT) % 10 AS VARCHAR), '%') END AS share
    FROM pages""",
)
def c23_display_text(t: Tables):
    n = F.col("page_id")
    return t.pages.select(n, text.shorten(F.col("url")).alias("short"), text.percent(n % 7, n % 10).alias("share"))


@query(
    "c24_country_classes",
    """WITH c AS (SELECT CASE country WHEN 'NATION_1' THEN 'United States' WHEN 'NATION_2' THEN 'Russia' ELSE country END AS v,
        count(*) AS n FROM dns_geo GROUP BY 1),
      k AS (SELECT CASE n_name WHEN 'NATION_1' THEN 'United States of America' WHEN 'NATION_2' THEN 'Russian Federation'
        WHEN 'NATION_3' THEN 'Nowhere' ELSE n_name END AS name FROM nation),
      j AS (SELECT k.name, coalesce(c.n, 0) AS n FROM k LEFT JOIN c ON c.v = CASE k.name
        WHEN 'United States of America' THEN 'United States' WHEN 'Russian Federation' THEN 'Russia' ELSE k.name END)
    SELECT name, n AS count, CASE WHEN n > 0 THEN CAST(least(greatest(floor((n - 1) * 8.0 / ((SELECT greatest(max(n), 10) FROM c) - 1)), 0), 7) AS INTEGER) END AS class
    FROM j""",
)
def c24_country_classes(t: Tables):
    def renamed(name, first, second, third=None):
        out = F.when(F.col(name) == "NATION_1", first).when(F.col(name) == "NATION_2", second)
        return (out.when(F.col(name) == "NATION_3", third) if third else out).otherwise(F.col(name))

    counts = (
        t.dns_geo.groupBy(renamed("country", "United States", "Russia").alias("value"))
        .agg(F.count("*").alias("count"))
    )
    shown = t.nation.select(renamed("n_name", "United States of America", "Russian Federation", "Nowhere").alias("name"))
    return serving.country_classes(counts, shown)


@query(
    "c25_conform",
    """SELECT domain, url, first_seen, 'unknown' AS label, source, false AS seen_in_urlhaus, CAST(NULL AS BOOLEAN) AS seen_in_openphish
    FROM feed_url""",
)
def c25_conform(t: Tables):
    partial = t.feed_url.select("source", "url", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"), "domain")
    return schemas.conform(
        partial, schemas.LABELS_UNION, {"label": F.lit("unknown"), "seen_in_urlhaus": F.lit(False)}
    )
