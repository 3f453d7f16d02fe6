"""Score, age and size classes.  All limits below are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RISK_LEVELS = ["CRITICAL", "LOW", "MEDIUM", "HIGH"]
MALICIOUS_FROM = 0.6
# Country names as the feeds write them -> names as the map writes them.
MAP_COUNTRY_ALIASES = {
    "United States": "United States of America",
    "Russia": "Russian Federation",
}


def risk_level(score: Column) -> Column:
    return (
        F.when(score >= 0.90, "CRITICAL")
        .when(score >= 0.60, "HIGH")
        .when(score >= 0.20, "MEDIUM")
        .otherwise("LOW")
    )


def risk_bucket(score: Column) -> Column:
    """Right-closed classes over [0, 1]; NULL outside."""
    return (
        F.when((score >= 0.0) & (score <= 0.2), "low")
        .when((score > 0.2) & (score <= 0.5), "medium")
        .when((score > 0.5) & (score <= 0.8), "high")
        .when((score > 0.8) & (score <= 1.0), "critical")
    )


def display_tier(score: Column) -> Column:
    return (
        F.when(score.isNull(), "unknown")
        .when(score >= 0.75, "red")
        .when(score >= 0.50, "orange")
        .when(score >= 0.30, "yellow")
        .otherwise("green")
    )


def threat_type(source: Column) -> Column:
    s = F.lower(source)
    return (
        F.when(F.contains(s, F.lit("urlhaus")), "malware")
        .when(F.contains(s, F.lit("openphish")), "phishing")
        .when(F.contains(s, F.lit("misp")), "malware")
        .otherwise("suspicious")
    )


def ip_count_bucket(n: Column, none_label: str | None = None) -> Column:
    """Classes of IP counts. Without ``none_label`` NULL counts as 0."""
    rest = (
        F.when(n == 1, "ips:1").when(n <= 3, "ips:2-3").when(n <= 10, "ips:4-10").otherwise("ips:>10")
    )
    return F.when(n.isNull(), none_label or "ips:0").when(n <= 0, "ips:0").otherwise(rest)


def age_bucket(age_days: Column) -> Column:
    return (
        F.when(age_days.isNull(), "age:unknown")
        .when(age_days < 7, "age:<7d")
        .when(age_days < 30, "age:7-30d")
        .when(age_days < 180, "age:30-180d")
        .when(age_days < 365, "age:180-365d")
        .otherwise("age:>365d")
    )


def length_bucket(n: Column) -> Column:
    return (
        F.when((n >= 0) & (n <= 10), "len:<=10")
        .when((n > 10) & (n <= 20), "len:11-20")
        .when((n > 20) & (n <= 30), "len:21-30")
        .when((n > 30) & (n <= 1000), "len:>30")
    )


def digit_bucket(ratio: Column) -> Column:
    return (
        F.when((ratio >= 0.0) & (ratio <= 0.1), "digits:<10%")
        .when((ratio > 0.1) & (ratio <= 0.3), "digits:10-30%")
        .when((ratio > 0.3) & (ratio <= 1.0), "digits:>30%")
    )


def entropy_bucket(bits: Column) -> Column:
    return (
        F.when((bits >= 0.0) & (bits <= 2.5), "entropy:low")
        .when((bits > 2.5) & (bits <= 3.5), "entropy:med")
        .when((bits > 3.5) & (bits <= 10.0), "entropy:high")
    )


def intensity_class(count: Column, max_count: Column, classes: int = 8) -> Column:
    """Equal-width class 0..classes-1 of a count over [1, max(max_count, 10)]; NULL for 0."""
    top = F.greatest(max_count, F.lit(10))
    step = F.floor((count - 1) * F.lit(float(classes)) / (top - 1))
    return F.when(count > 0, F.least(F.greatest(step, F.lit(0)), F.lit(classes - 1)).cast("int"))


def display_fields(country: Column, registrar: Column, age_days: Column, score: Column) -> list[Column]:
    """The display form of the optional threat fields."""
    return [
        F.coalesce(country, F.lit("Unknown")).alias("country"),
        F.coalesce(registrar, F.lit("Unknown")).alias("registrar"),
        F.coalesce(age_days.cast("int"), F.lit(-1)).alias("domainAgeDays"),
        F.round(score, 4).alias("riskScore"),
    ]
