"""One feature row per registered domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.functions.ip import ipv6_flag
from indicatrix.functions.times import whois_features
from indicatrix.operators import picks

DNS_FEATURES = ["num_unique_ips", "has_ipv6", "num_countries", "num_asns"]
WHOIS_FEATURES = ["age_days", "days_to_expiry", "created_isnull", "expires_isnull", "has_error"]
CATEGORIES = ["sample_asn", "sample_isp", "sample_country", "registrar", "status"]


def _sample(column: str) -> Column:
    """The non-null value at the smallest address."""
    pair = F.struct(F.col("ip"), F.col(column))
    return F.min(F.when(F.col(column).isNotNull(), pair))[column].alias(f"sample_{column}")


def distinct_addresses(dns: DataFrame, key: str = "puny_domain") -> DataFrame:
    """The columns the summaries read, without the repeats that daily snapshots bring."""
    domain = F.col(key).alias("registered_domain")
    return dns.select(domain, "ip", "family", "country", "asn", "isp").distinct()


def address_summary(rows: DataFrame, flag: str | None = None) -> DataFrame:
    """Address facts per domain out of distinct rows; ``flag`` names a boolean column to carry as "any".

    Distinct counts copy every row per counted column. Samples need sorted
    aggregation, which is cheap on the plain rows but not on the copies. So each
    has an aggregation of its own; both read the same shuffled rows and meet on
    the partitioning they share.
    """
    flags = [F.coalesce(F.bool_or(flag), F.lit(False)).alias(flag)] if flag else []
    counts = rows.groupBy("registered_domain").agg(
        F.countDistinct("ip").alias("num_unique_ips"),
        F.coalesce(F.max((F.col("family") == 6).cast("int")), F.lit(0)).alias("has_ipv6"),
        F.countDistinct("country").alias("num_countries"),
        F.countDistinct("asn").alias("num_asns"),
        *flags,
    )
    samples = rows.groupBy("registered_domain").agg(_sample("asn"), _sample("isp"), _sample("country"))
    return counts.join(samples, "registered_domain").select(
        "registered_domain", *DNS_FEATURES, "sample_asn", "sample_isp", "sample_country", *([flag] if flag else [])
    )


def dns_summary(dns: DataFrame, key: str = "puny_domain") -> DataFrame:
    """Address facts per domain."""
    return address_summary(distinct_addresses(dns, key))


def ct_summary(resolved: DataFrame, base: DataFrame) -> DataFrame:
    """Address facts per certificate domain, with one original name per domain.

    ``resolved`` has a NULL address for a domain without one; such domains count
    0. The address family is read off the address text.
    """
    family = F.when(ipv6_flag(F.col("ip")) == 1, 6)
    rows = resolved.withColumns({"family": family, "isp": F.col("asname")})
    facts = address_summary(distinct_addresses(rows, "registered_domain"))
    sample = picks.first_ct(base).select(
        "registered_domain", F.col("domain").alias("domain_sample"), "event_ts", "source"
    )
    return facts.join(sample, "registered_domain", "left")


def last_seen(labels: DataFrame, column: str = "first_seen") -> DataFrame:
    return labels.groupBy("registered_domain").agg(F.max(column).alias(f"last_{column}"))


def label_rows(labels: DataFrame) -> DataFrame:
    """The first label row per domain and its last appearance, in one aggregation."""
    first = F.min(F.struct("first_seen", "source", "url", "label", "domain")).alias("_first")
    return (
        labels.groupBy("registered_domain")
        .agg(first, F.max("first_seen").alias("last_first_seen"))
        .select("registered_domain", "_first.*", "last_first_seen")
    )


def whois_rows(whois: DataFrame, now: Column) -> DataFrame:
    """Registration features, one row per domain: the latest fetch."""
    rows = whois.select(
        F.lower(F.trim("domain")).alias("domain"), "registrar", "status", "created", "expires", "error", "fetched_at"
    )
    return picks.latest_whois(rows).select(
        F.col("domain").alias("registered_domain"),
        "registrar",
        "status",
        *whois_features(F.col("created"), F.col("expires"), F.col("error"), now),
    )


def feature_rows(
    labels: DataFrame,
    dns: DataFrame,
    whois: DataFrame,
    now: Column,
    listed: DataFrame | None = None,
    addresses: DataFrame | None = None,
    registrations: DataFrame | None = None,
) -> DataFrame:
    """Label, address and registration facts per registered domain.

    Every side is brought to one row per domain first, so no join multiplies
    rows or meets a hot key, and all sides share one partitioning. ``listed``
    holds the domains on a threat list and adds ``is_in_misp``. A job that needs
    the sides more than once passes what ``dns_summary`` and ``whois_rows`` gave.
    """
    rows = (
        label_rows(labels)
        .join(dns_summary(dns) if addresses is None else addresses, "registered_domain", "left")
        .join(whois_rows(whois, now) if registrations is None else registrations, "registered_domain", "left")
    )
    if listed is not None:
        rows = with_membership(rows, listed)
    return rows


def with_membership(rows: DataFrame, listed: DataFrame, flag: str = "is_in_misp") -> DataFrame:
    marks = listed.select("registered_domain").distinct().withColumn(flag, F.lit(1))
    return rows.join(marks, "registered_domain", "left").withColumn(flag, F.coalesce(flag, F.lit(0)))


def numeric_block(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric features as doubles; missing values and missing columns are 0."""
    return rows.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in rows.columns else F.lit(0.0)
            for c in columns
        }
    )


def dataset_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("label") == 1).alias("n_pos"),
        F.count_if(F.col("label") == 0).alias("n_neg"),
    )
