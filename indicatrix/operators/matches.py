"""Threat-list matches by name and by shared addresses, and the score override."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.functions.buckets import risk_level, threat_type
from indicatrix.functions.domains import with_registered_domain
from indicatrix.functions.text import strip
from indicatrix.operators import features, picks
from indicatrix.operators.layers import ADDRESS_TYPES, NAME_TYPES, of_type
from indicatrix.operators.skew import is_small, lookup_join

# How an override is named in the published table.
LIST_SOURCE = "misp_osint"
OVERLAP = "Network Infrastructure Overlap"


def listed_domains(attrs: DataFrame) -> DataFrame:
    """Registered domains on the list, each with the category of its latest row."""
    named = with_registered_domain(of_type(attrs, *NAME_TYPES), "indicator")
    latest = picks.category_per_domain(named.filter(F.col("registered_domain") != ""))
    return latest.select("registered_domain", F.coalesce("category", F.lit(LIST_SOURCE)).alias("category"))


def listed_ips(attrs: DataFrame) -> DataFrame:
    return of_type(attrs, *ADDRESS_TYPES).select(strip(F.col("indicator")).alias("ip")).distinct()


def mark_listed_ips(rows: DataFrame, ips: DataFrame, flag: str = "matched_misp_ip") -> DataFrame:
    """Add whether each row's address is on the list. Pass distinct rows.

    A short list, by count, is broadcast; a long one is joined with hot
    addresses spread.
    """
    marks = ips.select("ip").distinct().withColumn(flag, F.lit(True))
    joined = lookup_join(rows, marks, "ip", small=is_small(marks))
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def overlap_flags(dns: DataFrame, ips: DataFrame) -> DataFrame:
    """Per domain: does any of its addresses appear on the list?"""
    pairs = dns.select(F.col("puny_domain").alias("registered_domain"), "ip").distinct()
    return mark_listed_ips(pairs, ips).groupBy("registered_domain").agg(
        F.bool_or("matched_misp_ip").alias("matched_misp_ip")
    )


def dns_summary_with_overlap(dns: DataFrame, ips: DataFrame) -> DataFrame:
    """Address facts per domain and the overlap flag, out of the same rows."""
    marked = mark_listed_ips(features.distinct_addresses(dns), ips)
    return features.address_summary(marked, flag="matched_misp_ip")


def with_matches(rows: DataFrame, listed: DataFrame, overlap: DataFrame | None = None) -> DataFrame:
    """Add ``category`` of a direct match, ``matched_misp_ip`` and the override flag.

    A domain without addresses has no overlap. Where ``rows`` already carries
    ``matched_misp_ip`` no ``overlap`` is needed.
    """
    out = rows.join(listed.select("registered_domain", "category"), "registered_domain", "left")
    if overlap is not None:
        out = out.join(overlap, "registered_domain", "left")
    shared = F.coalesce("matched_misp_ip", F.lit(False))
    return out.withColumns(
        {"matched_misp_ip": shared, "is_in_misp": (F.col("category").isNotNull() | shared).cast("int")}
    )


def override(score: str = "score") -> dict[str, Column]:
    """Published score, level, source and type: a match always wins over the model."""
    hit = F.col("is_in_misp") == 1
    named = F.lower(
        F.coalesce("category", F.when(F.col("matched_misp_ip"), F.lit(OVERLAP)), F.lit(""))
    )
    listed_type = F.when(named.isin("", "nan"), LIST_SOURCE).otherwise(named)
    return {
        "riskScore": F.when(hit, 1.0).otherwise(F.round(score, 4)),
        "riskLevel": F.when(hit, "CRITICAL").otherwise(risk_level(F.col(score))),
        "threatType": F.when(hit, listed_type).otherwise(threat_type(F.coalesce("source", F.lit("")))),
        "source": F.when(hit, LIST_SOURCE).otherwise(F.coalesce("source", F.lit("unknown"))),
    }


def catch_rates(matched: DataFrame) -> DataFrame:
    """How many domains each override phase caught, and the gain of the second one."""
    direct = F.count_if(F.col("category").isNotNull())
    extra = F.count_if(F.col("category").isNull() & F.col("matched_misp_ip"))
    return matched.agg(
        direct.alias("direct"),
        extra.alias("overlap_only"),
        F.round((direct + extra) / F.nullif(direct, F.lit(0)), 6).alias("multiplier"),
    )
