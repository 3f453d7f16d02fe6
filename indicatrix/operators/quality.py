"""Data checks. Each check is a count of failing rows; one pass serves many checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.functions.buckets import RISK_LEVELS
from indicatrix.operators.matches import LIST_SOURCE

MIN_ROWS = 50
MAX_FEED_AGE_HOURS = 12
LOW_MATCH_RATIO = 0.2


def failures(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, failed_rows) for conditions that are true on failing rows."""
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    lines = F.explode(
        F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failed_rows")) for n in checks])
    )
    return counts.select(lines.alias("_line")).select("_line.*")


def feed_expectations(bronze: DataFrame) -> DataFrame:
    """Bronze checks: unique URL, domain present and 1-253 long, URL with a web scheme."""
    size = F.length("domain")
    row_checks = failures(
        bronze,
        {
            "domain_not_null": F.col("domain").isNull(),
            "domain_length": (size < 1) | (size > 253),
            "url_scheme": ~F.coalesce(F.col("url").rlike(r"^https?://"), F.lit(False)),
        },
    )
    repeats = bronze.groupBy("url").agg((F.count("*") - 1).alias("_more"))
    unique = repeats.agg(F.coalesce(F.sum("_more"), F.lit(0)).alias("failed_rows"))
    return row_checks.unionByName(unique.select(F.lit("url_unique").alias("check"), "failed_rows"))


def row_guard(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Row count and whether it reaches the least size of a feed."""
    return df.agg(F.count("*").alias("rows")).withColumn("enough", F.col("rows") >= min_rows)


def feed_age(lines: DataFrame, run_ts: Column, max_hours: float = MAX_FEED_AGE_HOURS) -> DataFrame:
    """Hours since the time in the feed's header, and whether the feed is stale."""
    stamp = F.regexp_extract("value", r"Last updated:\s*([0-9\-: ]+?)\s*\(UTC\)", 1)
    header = lines.agg(F.max(F.try_to_timestamp(F.nullif(stamp, F.lit("")))).alias("header_ts"))
    hours = (F.unix_micros(run_ts) - F.unix_micros(F.col("header_ts"))) / F.lit(3600e6)
    return header.withColumn("age_hours", hours).withColumn("stale", F.coalesce(hours > max_hours, F.lit(False)))


def partition_audit(
    rows: DataFrame,
    date: str,
    layer: str,
    source: str = "source",
    partition: str = "ingest_date",
    root: str = "",
    expected: DataFrame | None = None,
) -> DataFrame:
    """Size, content dates and their agreement with the partition date, per partition.

    ``expected`` lists the (source, partition) pairs there should be; ones without
    rows appear as empty.
    """
    day = F.to_date(date)
    near = F.abs(F.date_diff(day, F.col(partition))) <= 1
    groups = rows.groupBy(source, partition).agg(
        F.count("*").alias("rows"),
        F.min(day).alias("content_date_min"),
        F.max(day).alias("content_date_max"),
        F.avg(near.cast("double")).alias("match_ratio"),
    )
    if expected is not None:
        wanted = expected.select(source, partition).distinct()
        groups = wanted.join(groups, [source, partition], "full").withColumn("rows", F.coalesce("rows", F.lit(0)))
    ratio = F.round(F.col("match_ratio"), 3)
    text = F.concat(F.lit("dateadded_mismatch_ratio="), ratio.cast("decimal(10,3)").cast("string"))
    return groups.select(
        F.lit(layer).alias("layer"),
        F.col(source).alias("source"),
        F.col(partition).alias("ds"),
        F.concat_ws("/", F.lit(root or layer), F.col(source), F.concat(F.lit("ingest_date="), partition)).alias("path"),
        "rows",
        (F.col("rows") == 0).alias("is_empty"),
        "content_date_min",
        "content_date_max",
        "match_ratio",
        F.when(F.col("match_ratio") < LOW_MATCH_RATIO, text).alias("anomaly"),
    )


def export_checks(threats: DataFrame) -> DataFrame:
    """Every exported row has its fields, a score in [0, 1] and one of the four levels."""
    needed = [
        "domain", "url", "firstSeen", "label", "source", "riskScore", "riskLevel", "threatType", "country",
        "registrar", "domainAgeDays",
    ]
    score = F.col("riskScore")
    checks = {f"missing_{c}": F.col(c).isNull() for c in needed}
    checks["score_range"] = F.coalesce((score < 0) | (score > 1), F.lit(True))
    checks["level_values"] = ~F.coalesce(F.col("riskLevel").isin(*RISK_LEVELS), F.lit(False))
    return failures(threats, checks)


def override_checks(threats: DataFrame) -> DataFrame:
    """List-matched rows are CRITICAL with score 1; CRITICAL needs 0.9 or a match."""
    listed = F.col("source") == LIST_SOURCE
    critical = F.col("riskLevel") == "CRITICAL"
    return failures(
        threats,
        {
            "listed_not_critical": listed & ~critical,
            "listed_score_not_one": listed & (F.col("riskScore") != 1.0),
            "listed_low": listed & (F.col("riskLevel") == "LOW"),
            "critical_below_limit": critical & (F.col("riskScore") < 0.9) & ~listed,
        },
    )


def statistics_checks(stats: DataFrame) -> DataFrame:
    """The statistics row agrees with itself."""
    levels = F.aggregate(F.map_values("riskDistribution"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    dist = F.col("riskDistribution")
    return failures(
        stats,
        {
            "counts_add_up": F.col("maliciousCount") + F.col("benignCount") != F.col("threatCount"),
            "malicious_within_total": F.col("maliciousCount") > F.col("totalSamples"),
            "levels_sum": levels != F.col("threatCount"),
            "high_risk_recount": dist["CRITICAL"] + dist["HIGH"] != F.col("highRiskCount"),
            "mean_range": (F.col("averageRiskScore") < 0) | (F.col("averageRiskScore") > 1),
        },
    )


def coverage(domains: DataFrame, dns: DataFrame, whois: DataFrame, key: str = "registered_domain") -> DataFrame:
    """Share of distinct domains, in percent, that each lookup covers."""
    base = domains.select(key).distinct()
    in_dns = dns.select(F.lower(F.trim("puny_domain")).alias(key)).distinct().withColumn("_dns", F.lit(1))
    in_whois = whois.select(F.lower(F.trim("domain")).alias(key)).distinct().withColumn("_whois", F.lit(1))
    total = F.nullif(F.count("*"), F.lit(0))
    return (
        base.join(in_dns, key, "left")
        .join(in_whois, key, "left")
        .agg(
            F.count("*").alias("domains"),
            F.round(F.count("_dns") * 100.0 / total, 2).alias("dns_pct"),
            F.round(F.count("_whois") * 100.0 / total, 2).alias("whois_pct"),
        )
    )


def resolution_coverage(summary: DataFrame) -> DataFrame:
    """Share of domains, in percent, with at least one address."""
    share = F.avg((F.col("num_unique_ips") > 0).cast("double")) * 100.0
    return summary.agg(F.count("*").alias("domains"), F.coalesce(share, F.lit(0.0)).alias("coverage_pct"))


def label_conflicts(labels: DataFrame) -> DataFrame:
    """Domains that appear both as benign and as malicious."""
    per_domain = labels.groupBy("registered_domain").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"))
    return per_domain.agg(F.count_if(F.col("_lo") != F.col("_hi")).alias("conflicts"))
