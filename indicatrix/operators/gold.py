"""The published threat table, its excerpts, statistics and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatrix import schemas
from indicatrix.functions.buckets import MALICIOUS_FROM, RISK_LEVELS, display_fields
from indicatrix.functions.times import iso_text
from indicatrix.operators import features, matches

# Sizes of the published excerpts and limits of the drift alerts.
TOP_THREATS, TOP_RECENT, TOP_HIGH_RISK = 5000, 100, 1000
RATIO_SHIFT, MEAN_SHIFT = 0.10, 0.05
HIGH_RISK = ("CRITICAL", "HIGH")


def assemble(rows: DataFrame) -> DataFrame:
    """Threat rows out of scored feature rows that carry their list matches."""
    published = matches.override("score")
    display = display_fields(
        F.col("sample_country"), F.col("registrar"), F.col("age_days"), published["riskScore"]
    )
    out = rows.select(
        "domain",
        F.coalesce("url", F.lit("")).alias("url"),
        iso_text(F.col("first_seen")).alias("firstSeen"),
        F.coalesce(F.col("label").cast("string"), F.lit("unknown")).alias("label"),
        *[value.alias(name) for name, value in published.items() if name != "riskScore"],
        *display,
    )
    return out.select(*schemas.THREAT.fieldNames())


def scored_rows(
    labels: DataFrame,
    dns: DataFrame,
    whois: DataFrame,
    attrs: DataFrame,
    now: Column,
    addresses: DataFrame | None = None,
    registrations: DataFrame | None = None,
    listed: DataFrame | None = None,
) -> DataFrame:
    """Feature rows with list matches, ready for scoring. A job that needs the sides more than once passes them."""
    if addresses is None:
        addresses = matches.dns_summary_with_overlap(dns, matches.listed_ips(attrs))
    rows = features.feature_rows(labels, dns, whois, now, addresses=addresses, registrations=registrations)
    return matches.with_matches(rows, matches.listed_domains(attrs) if listed is None else listed)


def top_threats(threats: DataFrame, n: int = TOP_THREATS) -> DataFrame:
    return threats.orderBy(F.col("riskScore").desc(), "domain", "url").limit(n)


def recent(threats: DataFrame, n: int = TOP_RECENT) -> DataFrame:
    return threats.orderBy(F.col("firstSeen").desc(), "domain", "url").limit(n)


def high_risk(threats: DataFrame, n: int = TOP_HIGH_RISK) -> DataFrame:
    return top_threats(threats.filter(F.col("riskLevel").isin(*HIGH_RISK)), n)


def value_counts(df: DataFrame, column: str, n: int, without: str | None = None) -> DataFrame:
    known = df.filter(F.col(column).isNotNull())
    if without is not None:
        known = known.filter(F.col(column) != without)
    counts = known.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.col("count").desc(), "value").limit(n)


def count_tables(threats: DataFrame) -> DataFrame:
    """Counts per level, type, source, country and registrar from one pass over all threats.

    All four levels appear, with 0 where there is none.
    """
    kinds = {
        "riskDistribution": "riskLevel",
        "threatTypeDistribution": "threatType",
        "sourceDistribution": "source",
        "topCountries": "country",
        "topRegistrars": "registrar",
    }
    spark = threats.sparkSession
    one = F.lit(1).cast("bigint")
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in kinds.items()]))
    rows = threats.select(pairs.alias("_p")).select("_p.*", one.alias("n"))
    levels = spark.createDataFrame([("riskDistribution", level, 0) for level in RISK_LEVELS], rows.schema)
    counts = rows.unionByName(levels).groupBy("kind", "value").agg(F.sum("n").alias("count"))
    top = Window.partitionBy("kind").orderBy(F.col("count").desc(), "value")
    is_top = F.col("kind").isin("topCountries", "topRegistrars")
    return (
        counts.filter(~(is_top & (F.col("value") == "Unknown")))
        .withColumn("_rank", F.row_number().over(top))
        .filter(~is_top | (F.col("_rank") <= 10))
        .select("kind", "value", "count")
    )


def totals(threats: DataFrame, export_limit: int = TOP_THREATS) -> DataFrame:
    """Counts and the mean over all threats: malicious + benign = all. Also how many the export document holds."""
    malicious = F.count_if(F.col("riskScore") >= MALICIOUS_FROM)
    return threats.agg(
        F.count("*").alias("threatCount"),
        F.least(F.count("*"), F.lit(export_limit)).cast("bigint").alias("exportedCount"),
        malicious.alias("maliciousCount"),
        (F.count("*") - malicious).alias("benignCount"),
        F.avg("riskScore").alias("averageRiskScore"),
        F.count_if(F.col("riskLevel").isin(*HIGH_RISK)).alias("highRiskCount"),
    )


def population(rows: DataFrame) -> DataFrame:
    """Size and date range of the whole population."""
    return rows.agg(
        F.count("*").alias("totalSamples"),
        F.min("first_seen").alias("earliest"),
        F.max("first_seen").alias("latest"),
    )


def statistics(rows: DataFrame, threats: DataFrame) -> DataFrame:
    """The statistics document as one row, over the whole threat table. It is read twice, so pass a stored one."""
    maps = (
        count_tables(threats)
        .groupBy("kind")
        .agg(F.map_from_entries(F.collect_list(F.struct("value", "count"))).alias("counts"))
        .agg(F.map_from_entries(F.collect_list(F.struct("kind", "counts"))).alias("_maps"))
    )
    kinds = [
        "riskDistribution", "threatTypeDistribution", "sourceDistribution", "topCountries", "topRegistrars",
    ]
    people = population(rows).select(F.struct("*")).scalar()
    joined = totals(threats).withColumns({"_population": people, "_maps": maps.scalar()})
    return joined.select(
        "_population.totalSamples", "threatCount", "exportedCount", "maliciousCount", "benignCount", "averageRiskScore", "highRiskCount",
        F.struct("_population.earliest", "_population.latest").alias("dateRange"),
        *[F.col("_maps")[k].alias(k) for k in kinds],
    )


def run_statistics(rows: DataFrame, run: str, score: str = "score") -> DataFrame:
    """One statistics row per run, over one population."""
    malicious = F.count_if(F.col(score) >= MALICIOUS_FROM)
    return rows.groupBy(run).agg(
        F.count("*").alias("total_samples"),
        F.round(malicious / F.count("*"), 4).alias("malicious_ratio"),
        F.avg(score).alias("avg_risk_score"),
        malicious.alias("high_risk_count"),
    )


def drift(history: DataFrame, run: str = "run_date") -> DataFrame:
    """Changes against the run before, with an alert text where they are large.

    ``history`` has one row per run, so the one window over it stays small.
    """
    before = Window.orderBy(run)
    changes = history.withColumns(
        {
            "malicious_ratio_delta": F.round(F.col("malicious_ratio") - F.lag("malicious_ratio").over(before), 4),
            "avg_risk_score_delta": F.round(F.col("avg_risk_score") - F.lag("avg_risk_score").over(before), 6),
            "high_risk_count_delta": F.col("high_risk_count") - F.lag("high_risk_count").over(before),
        }
    )
    ratio, mean = F.col("malicious_ratio_delta"), F.col("avg_risk_score_delta")
    alert = F.concat_ws(
        " | ",
        F.when(
            F.abs(ratio) > RATIO_SHIFT,
            F.concat(F.lit("Malicious ratio shifted by "), _signed(ratio * 100, 1), F.lit("%")),
        ),
        F.when(F.abs(mean) > MEAN_SHIFT, F.concat(F.lit("Average risk score shifted by "), _signed(mean, 4))),
    )
    return changes.withColumn("alert", F.nullif(alert, F.lit("")))


def _signed(value: Column, digits: int) -> Column:
    number = F.round(value.cast("decimal(20,6)"), digits).cast(f"decimal(20,{digits})").cast("string")
    return F.when(value >= 0, F.concat(F.lit("+"), number)).otherwise(number)


def top_asns(rows: DataFrame, run: str, n: int = 5) -> DataFrame:
    """The most frequent networks of each run."""
    counts = rows.filter(F.col("sample_asn").isNotNull()).groupBy(run, "sample_asn").agg(F.count("*").alias("count"))
    order = Window.partitionBy(run).orderBy(F.col("count").desc(), "sample_asn")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
