"""Bronze hygiene, silver normalisation and the daily label union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatrix import schemas
from indicatrix.functions.text import url_host
from indicatrix.functions.times import utc_or
from indicatrix.operators import picks


def bronze_rows(df: DataFrame) -> DataFrame:
    """Derive the domain, drop rows without one and keep one row per URL."""
    rows = df.withColumn("domain", url_host(F.col("url"))).filter(F.col("domain").isNotNull())
    return picks.pick_one(rows, ["url"], ["domain"])


def bronze_malware(df: DataFrame, run_ts: Column) -> DataFrame:
    """Malware feed rows; a missing or unreadable date becomes the run time."""
    rows = df.withColumn("first_seen", utc_or(F.col("dateadded"), run_ts)).drop("domain")
    return schemas.conform(bronze_rows(rows), schemas.BRONZE_MALWARE)


def bronze_phish(df: DataFrame, run_ts: Column) -> DataFrame:
    rows = df.select("url").withColumn("first_seen", run_ts)
    return schemas.conform(bronze_rows(rows), schemas.BRONZE_PHISH)


def _silver(df: DataFrame, label: Column, source: str) -> DataFrame:
    rows = schemas.conform(df, schemas.SILVER_LABEL)
    return rows.withColumns({"label": label, "source": F.lit(source)}).na.drop(subset=["domain", "first_seen"])


def silver_malware(df: DataFrame) -> DataFrame:
    threat = F.coalesce(F.col("label"), F.lit("unknown"))
    named = df.drop("label").withColumnRenamed("threat", "label")
    return picks.malware_silver(_silver(named, threat, "urlhaus"))


def silver_phish(df: DataFrame) -> DataFrame:
    return picks.phish_silver(_silver(df, F.lit("phishing"), "openphish"))


def label_union(
    spark: SparkSession,
    malware: DataFrame | None = None,
    phish: DataFrame | None = None,
    others: list[DataFrame] | None = None,
) -> DataFrame:
    """All feeds with the feed each row came from. Any of them may be absent."""
    flags = [(malware, True, False), (phish, False, True), *[(o, False, False) for o in others or []]]
    parts = [
        schemas.conform(feed, schemas.SILVER_LABEL).withColumns(
            {"seen_in_urlhaus": F.lit(in_malware), "seen_in_openphish": F.lit(in_phish)}
        )
        for feed, in_malware, in_phish in flags
        if feed is not None
    ]
    if not parts:
        return schemas.empty(spark, schemas.LABELS_UNION)
    rows = reduce(DataFrame.unionByName, parts).na.drop(subset=["domain", "first_seen"])
    return picks.union_labels(rows)


def binary_labels(labels: DataFrame) -> DataFrame:
    """0 for benign seeds, 1 for the rest; rows without a registered domain are dropped."""
    return labels.withColumn("label", F.when(F.col("source") == "benign_seed", 0).otherwise(1)).filter(
        F.col("registered_domain") != ""
    )


def of_type(attrs: DataFrame, *types: str) -> DataFrame:
    return attrs.filter(F.col("type").isin(*types))


# The indicator types that name hosts and the ones that name addresses.
NAME_TYPES = ("domain", "hostname", "url")
ADDRESS_TYPES = ("ip-src", "ip-dst")
