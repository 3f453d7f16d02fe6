"""Risk reports over labels and over model scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.functions import buckets, text
from indicatrix.operators.ordered import exact_quantiles

HIGH = 0.9
# The quantiles and limits of the score report.
QUANTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}
THRESHOLDS = [0.5, 0.9, 0.99]
GROUP_KEYS = [
    "tld", "registrar", "age_bucket", "ip_bucket", "len_bucket", "digit_bucket", "entropy_bucket", "sample_country",
]


def with_group_keys(rows: DataFrame) -> DataFrame:
    """Add the derived keys that the label risk report groups by."""
    name = F.coalesce("registered_domain", F.lit(""))
    lexical = text.lexical_features(name)
    # Measures first, classes next: a class looks at its measure several times.
    measured = rows.withColumns({"_digit_ratio": lexical["digit_ratio"], "_entropy": lexical["entropy"]})
    return measured.withColumns(
        {
            "tld": text.last_label(name, ""),
            "age_bucket": buckets.age_bucket(F.col("age_days")),
            "ip_bucket": buckets.ip_count_bucket(F.col("num_unique_ips"), "ips:none"),
            "len_bucket": buckets.length_bucket(F.length(name)),
            "digit_bucket": buckets.digit_bucket(F.col("_digit_ratio")),
            "entropy_bucket": buckets.entropy_bucket(F.col("_entropy")),
        }
    ).drop("_digit_ratio", "_entropy")


def label_risk(rows: DataFrame, key: str, min_count: int = 20, top: int = 20) -> DataFrame:
    """Share of malicious rows per key value; rows without a key do not count.

    Counting the key leaves those rows at 0. A filter on the key would move
    below the joins and work the key out for every raw row.
    """
    groups = (
        rows.groupBy(key)
        .agg(F.count(key).alias("count"), F.sum("label").cast("bigint").alias("phish"))
        .withColumn("benign", F.col("count") - F.col("phish"))
        .withColumn("phish_rate", F.try_divide("phish", "count"))
    )
    order = [F.col("phish_rate").desc(), F.col("count").desc(), F.col(key)]
    return groups.filter(F.col("count") >= max(min_count, 1)).orderBy(*order).limit(top)


def label_risk_all(rows: DataFrame, keys: list[str], min_count: int = 30) -> DataFrame:
    """The report of all keys from one pass over the rows, without the top limit."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys]))
    return (
        rows.select("label", pairs.alias("_pair"))
        .select("label", "_pair.*")
        .filter(F.col("value").isNotNull())
        .groupBy("key", "value")
        .agg(F.count("*").alias("count"), F.sum("label").cast("bigint").alias("phish"))
        .filter(F.col("count") >= min_count)
        .withColumn("benign", F.col("count") - F.col("phish"))
        .withColumn("phish_rate", F.col("phish") / F.col("count"))
    )


def _pct_high(score: str) -> Column:
    return (F.avg((F.col(score) >= HIGH).cast("double")) * 100.0).alias("pct_high")


def score_risk(rows: DataFrame, key: str, score: str = "score", min_count: int = 20, top: int = 30) -> DataFrame:
    groups = (
        rows.groupBy(key)
        .agg(
            F.count(key).alias("count"),
            F.avg(score).alias("avg_score"),
            F.max(score).alias("max_score"),
            _pct_high(score),
        )
    )
    order = [F.col("pct_high").desc(), F.col("avg_score").desc(), F.col(key)]
    return groups.filter(F.col("count") >= max(min_count, 1)).orderBy(*order).limit(top)


def score_by_ip_count(rows: DataFrame, score: str = "score") -> DataFrame:
    return (
        rows.withColumn("ip_bucket", buckets.ip_count_bucket(F.col("num_unique_ips")))
        .groupBy("ip_bucket")
        .agg(F.count("*").alias("count"), F.avg(score).alias("avg_score"), _pct_high(score))
    )


def score_by_bucket(rows: DataFrame, score: str = "score") -> DataFrame:
    return (
        rows.withColumn("risk_bucket", buckets.risk_bucket(F.col(score)))
        .filter(F.col("risk_bucket").isNotNull())
        .groupBy("risk_bucket")
        .agg(F.count(score).alias("count"), F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean"))
    )


def score_summary(rows: DataFrame, score: str = "score") -> DataFrame:
    """Count, moments and quantiles in one row."""
    moments = rows.agg(
        F.count(score).alias("count"),
        F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
    )
    points = exact_quantiles(rows, score, QUANTILES).select(F.struct("*")).scalar()
    return moments.withColumn("_points", points).select(*moments.columns, "_points.*")


def score_thresholds(rows: DataFrame, score: str = "score") -> DataFrame:
    """How many scores reach each threshold, from one pass."""
    counts = rows.agg(
        F.count("*").alias("_total"),
        *[F.count_if(F.col(score) >= t).alias(f"_n{i}") for i, t in enumerate(THRESHOLDS)],
    )
    lines = F.explode(
        F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"_n{i}").alias("n")) for i, t in enumerate(THRESHOLDS)])
    )
    return (
        counts.select("_total", lines.alias("_line"))
        .select("_line.*", "_total")
        .withColumn("pct", F.col("n") * 100.0 / F.nullif(F.col("_total"), F.lit(0)))
        .drop("_total")
    )


def score_histogram(rows: DataFrame, score: str = "score", bins: int = 50) -> DataFrame:
    """Equal-width bins between the least and the largest score, the last one closed.

    Where all scores are equal the bins span one unit around them.
    """
    known = rows.filter(F.col(score).isNotNull()).select(score)
    lo, hi = F.min(score), F.max(score)
    half = F.when(lo == hi, 0.5).otherwise(0.0)
    limits = known.agg(F.struct((lo - half).alias("lo"), (hi + half).alias("hi"))).scalar()
    width = (F.col("_limits.hi") - F.col("_limits.lo")) / bins
    step = F.floor((F.col(score) - F.col("_limits.lo")) / width)
    return (
        known.withColumn("_limits", limits)
        .withColumn("bin", F.least(step, F.lit(bins - 1)).cast("int"))
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
    )


def top_domains(rows: DataFrame, name: str = "registered_domain", score: str = "score", top: int = 20) -> DataFrame:
    """The highest scored names."""
    return rows.orderBy(F.col(score).desc(), name).limit(top)


def suspicious_names(rows: DataFrame, name: str, score: str = "score", top: int = 50) -> DataFrame:
    """The highest scored names that hold a suspicious word."""
    hits = rows.filter(text.has_suspicious_word(F.col(name)))
    return hits.orderBy(F.col(score).desc(), name).limit(top)
