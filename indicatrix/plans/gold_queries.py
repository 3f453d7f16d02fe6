"""Registered queries for the threat table, its statistics and the queries over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatrix.operators import gold, matches, risk, serving
from indicatrix.operators.skew import lookup_join
from indicatrix.plans.registry import query
from indicatrix.plans.standins import Tables, now
from indicatrix.session import materialise

_THREAT = 'domain, url, "firstSeen", label, source, "riskScore", "riskLevel", "threatType", country, registrar, "domainAgeDays"'


def matched(t: Tables) -> DataFrame:
    """Feature rows with their list matches and a given score."""
    rows = gold.scored_rows(t.labels_rd, t.dns_geo, t.whois, t.misp_attr, now())
    return rows.join(t.scored_domain, "registered_domain")


def threats(t: Tables) -> DataFrame:
    return gold.assemble(matched(t))


@query(
    "l1_override",
    """SELECT f.registered_domain, CASE WHEN is_in_misp = 1 THEN 1.0 ELSE round(score, 4) END AS "riskScore",
      CASE WHEN is_in_misp = 1 OR score >= 0.9 THEN 'CRITICAL' WHEN score >= 0.6 THEN 'HIGH' WHEN score >= 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS "riskLevel",
      CASE WHEN is_in_misp = 1 THEN 'misp_osint' ELSE source END AS source,
      CASE WHEN category IS NOT NULL THEN lower(category) WHEN matched_misp_ip THEN 'network infrastructure overlap'
        WHEN source = 'urlhaus' THEN 'malware' WHEN source = 'openphish' THEN 'phishing' ELSE 'suspicious' END AS "threatType"
    FROM feature_row f JOIN scored_domain USING (registered_domain)""",
)
def l1_override(t: Tables):
    return matched(t).select("registered_domain", *[v.alias(k) for k, v in matches.override().items()])


@query("l2_threat_table", f"SELECT {_THREAT} FROM threat_row")
def l2_threat_table(t: Tables):
    return threats(t)


@query("h1_top_threats", f"SELECT {_THREAT} FROM exported")
def h1_top_threats(t: Tables):
    return gold.top_threats(threats(t))


@query("h2_recent_threats", f'SELECT {_THREAT} FROM threat_row ORDER BY "firstSeen" DESC, domain, url LIMIT 100')
def h2_recent_threats(t: Tables):
    return gold.recent(threats(t))


@query(
    "h3_high_risk_threats",
    f"""SELECT {_THREAT} FROM threat_row WHERE "riskLevel" IN ('CRITICAL', 'HIGH') ORDER BY "riskScore" DESC, domain, url LIMIT 1000""",
)
def h3_high_risk_threats(t: Tables):
    return gold.high_risk(threats(t))


@query("h4_top_domains", "SELECT registered_domain, score FROM scored_domain ORDER BY score DESC, registered_domain LIMIT 20")
def h4_top_domains(t: Tables):
    return risk.top_domains(t.scored_domain)


@query(
    "h4_keyword_hits",
    """SELECT p_partkey, name, p_retailprice FROM (SELECT p_partkey, p_retailprice,
        concat(replace(p_name, ' ', '-'), CASE p_partkey % 4 WHEN 0 THEN '-Secure.com' WHEN 1 THEN '.com' WHEN 2 THEN '-dHl.net' ELSE '.org' END) AS name FROM part)
    WHERE name LIKE '%-Secure.com' OR name LIKE '%-dHl.net' ORDER BY p_retailprice DESC, name, p_partkey LIMIT 50""",
)
def h4_keyword_hits(t: Tables):
    n = F.col("p_partkey")
    tail = F.when(n % 4 == 0, "-Secure.com").when(n % 4 == 1, ".com").when(n % 4 == 2, "-dHl.net").otherwise(".org")
    rows = t.part.select(n, F.concat(F.regexp_replace("p_name", " ", "-"), tail).alias("name"), "p_retailprice")
    return risk.suspicious_names(rows, "name", "p_retailprice")


@query(
    "h5_value_counts",
    """SELECT sample_country AS value, count(*) AS count FROM feature_row WHERE sample_country <> 'NATION_7' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def h5_value_counts(t: Tables):
    return gold.value_counts(matched(t), "sample_country", 10, without="NATION_7")


_COUNTS = {
    "riskDistribution": '"riskLevel"', "threatTypeDistribution": '"threatType"', "sourceDistribution": "source",
}
_TOPS = {"topCountries": "country", "topRegistrars": "registrar"}


@query(
    "f12_statistic_counts",
    " UNION ALL ".join(
        [f"SELECT '{k}' AS kind, {c} AS value, count(*) AS count FROM threat_row GROUP BY {c}" for k, c in _COUNTS.items()]
        + ["""SELECT 'riskDistribution', v, CAST(0 AS BIGINT) FROM (SELECT unnest(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW']) AS v)
             WHERE v NOT IN (SELECT "riskLevel" FROM threat_row)"""]
        + [
            f"""SELECT * FROM (SELECT '{k}', {c}, count(*) FROM threat_row WHERE {c} <> 'Unknown' GROUP BY {c}
                ORDER BY count(*) DESC, {c} LIMIT 10)"""
            for k, c in _TOPS.items()
        ]
    ),
)
def f12_statistic_counts(t: Tables):
    return gold.count_tables(threats(t))


@query(
    "f12_statistics",
    """SELECT (SELECT count(*) FROM label_row) AS "totalSamples", count(*) AS "threatCount", least(count(*), 5000) AS "exportedCount", count(*) FILTER (WHERE "riskScore" >= 0.6) AS "maliciousCount",
      count(*) FILTER (WHERE "riskScore" < 0.6) AS "benignCount", round(avg("riskScore"), 9) AS "averageRiskScore",
      count(*) FILTER (WHERE "riskLevel" IN ('CRITICAL', 'HIGH')) AS "highRiskCount", (SELECT min(first_seen) FROM label_row) AS earliest,
      (SELECT max(first_seen) FROM label_row) AS latest, count(*) FILTER (WHERE "riskLevel" = 'LOW') AS low, count(DISTINCT "threatType") AS types
    FROM threat_row""",
)
def f12_statistics(t: Tables):
    stored = materialise(threats(t), "threats")
    return gold.statistics(t.label_row, stored).select(
        "totalSamples", "threatCount", "exportedCount", "maliciousCount", "benignCount", F.round("averageRiskScore", 9).alias("averageRiskScore"),
        "highRiskCount", "dateRange.earliest", "dateRange.latest", F.col("riskDistribution")["LOW"].alias("low"),
        F.size("threatTypeDistribution").cast("bigint").alias("types"),
    )


def _runs(t: Tables):
    run = F.date_format("first_seen", "yyyy-MM").alias("run_date")
    return lookup_join(t.labels_rd.select(run, "registered_domain"), t.scored_domain, "registered_domain", "inner")


@query(
    "f13_drift",
    """WITH s AS (SELECT strftime(first_seen, '%Y-%m') AS run_date, count(*) AS total_samples, round(avg(CASE WHEN score >= 0.6 THEN 1.0 ELSE 0.0 END), 4) AS malicious_ratio,
        avg(score) AS avg_risk_score, count(*) FILTER (WHERE score >= 0.6) AS high_risk_count
      FROM label_row JOIN scored_domain ON domain = registered_domain GROUP BY 1),
    d AS (SELECT *, round(malicious_ratio - lag(malicious_ratio) OVER (ORDER BY run_date), 4) AS malicious_ratio_delta,
        round(avg_risk_score - lag(avg_risk_score) OVER (ORDER BY run_date), 6) AS avg_risk_score_delta,
        high_risk_count - lag(high_risk_count) OVER (ORDER BY run_date) AS high_risk_count_delta FROM s)
    SELECT run_date, total_samples, malicious_ratio, round(avg_risk_score, 9) AS avg_risk_score, high_risk_count, malicious_ratio_delta, avg_risk_score_delta, high_risk_count_delta,
      nullif(concat_ws(' | ', CASE WHEN abs(malicious_ratio_delta) > 0.10 THEN concat('Malicious ratio shifted by ', CASE WHEN malicious_ratio_delta >= 0 THEN '+' ELSE '' END, CAST(round(CAST(malicious_ratio_delta * 100 AS DECIMAL(20, 6)), 1) AS DECIMAL(20, 1)), '%') END,
        CASE WHEN abs(avg_risk_score_delta) > 0.05 THEN concat('Average risk score shifted by ', CASE WHEN avg_risk_score_delta >= 0 THEN '+' ELSE '' END, CAST(round(CAST(avg_risk_score_delta AS DECIMAL(20, 6)), 4) AS DECIMAL(20, 4))) END), '') AS alert
    FROM d""",
)
def f13_drift(t: Tables):
    drift = gold.drift(gold.run_statistics(_runs(t), "run_date"))
    return drift.withColumn("avg_risk_score", F.round("avg_risk_score", 9))


@query(
    "f13_top_asns",
    """SELECT run_date, sample_asn, count, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY run_date ORDER BY count DESC, sample_asn) AS INTEGER) AS rank
      FROM (SELECT strftime(last_first_seen, '%Y-%m') AS run_date, sample_asn, count(*) AS count FROM feature_row WHERE sample_asn IS NOT NULL GROUP BY ALL)) WHERE rank <= 5""",
)
def f13_top_asns(t: Tables):
    rows = matched(t).withColumn("run_date", F.date_format("last_first_seen", "yyyy-MM"))
    return gold.top_asns(rows, "run_date")


_QUERIES = ["D12.com", " /77 ", "d6499.com", "nowhere.example", ""]


@query(
    "l3_lookup",
    f"""SELECT query, {_THREAT} FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY "riskScore" DESC, domain, url) AS rn
      FROM threat_row JOIN (SELECT unnest(['d12.com', '/77', 'd6499.com', 'nowhere.example']) AS query) ON lower(domain) = query OR contains(lower(url), query))
    WHERE rn = 1""",
)
def l3_lookup(t: Tables):
    rank = [(-F.col("riskScore")).alias("_score"), F.col("domain").alias("_domain"), F.col("url").alias("_url")]
    return serving.lookup(threats(t), _QUERIES, rank)


@query("l4_search", f"SELECT {_THREAT} FROM threat_row WHERE contains(lower(domain), 'd12') OR contains(lower(url), 'd12')")
def l4_search(t: Tables):
    return serving.search(threats(t), " D12 ")


@query("l5_level_filter", f"""SELECT {_THREAT} FROM threat_row WHERE "riskLevel" = 'HIGH'""")
def l5_level_filter(t: Tables):
    return serving.of_level(serving.of_level(threats(t), "ALL"), "HIGH")


@query(
    "l6_shares",
    """SELECT "threatType" AS value, count(*) AS count, round(count(*) * 1.0 / (SELECT count(*) FROM threat_row), 6) AS share FROM threat_row GROUP BY 1""",
)
def l6_shares(t: Tables):
    return serving.shares(threats(t), "threatType")


@query(
    "l7_catch_rates",
    """SELECT count(*) FILTER (WHERE category IS NOT NULL) AS direct, count(*) FILTER (WHERE category IS NULL AND matched_misp_ip) AS overlap_only,
      round(count(*) FILTER (WHERE is_in_misp = 1) * 1.0 / count(*) FILTER (WHERE category IS NOT NULL), 6) AS multiplier FROM feature_row""",
)
def l7_catch_rates(t: Tables):
    return matches.catch_rates(gold.scored_rows(t.labels_rd, t.dns_geo, t.whois, t.misp_attr, now()))
