"""Readers for landed feed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the malware feed by position.
MALWARE_COLUMNS = [
    "id", "dateadded", "url", "url_status", "last_online", "threat", "tags", "urlhaus_link", "reporter",
]
WEB_PREFIX = r"^https?://"


def read_malware_csv(spark: SparkSession, path: str, ds: str, columns: int | None = None) -> DataFrame:
    """A malware feed snapshot: no header, comment lines skipped, columns by position.

    ``columns`` is the width of the files; without it a line of each file tells, and
    files that disagree are an error. A file of fewer than nine columns has an
    unknown layout and goes through ``guess_layout``.
    """
    reader = spark.read.option("comment", "#").option("multiLine", False)
    width = columns or file_width(spark, path)
    names = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # The feed quotes its fields and doubles quotes inside them.
    raw = reader.schema(schema).option("escape", '"').csv(path)
    raw = raw.select(*[F.nullif(n, F.lit("")).alias(n) for n in names])
    if width < len(MALWARE_COLUMNS):
        return guess_layout(raw, ds)
    named = raw.select(*[F.col(old).alias(new) for old, new in zip(names, MALWARE_COLUMNS)])
    return named.withColumnRenamed("url_status", "status")


def file_width(spark: SparkSession, path: str) -> int:
    """The number of columns of the first lines of all files; an error if they differ."""
    lines = spark.read.text(path).filter(~F.startswith("value", F.lit("#")) & (F.trim("value") != ""))
    by_file = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.first("value").alias("line"))
    # Commas outside quotes.
    columns = F.size(F.split("line", r',(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    widths = sorted(r[0] for r in by_file.select(columns).distinct().collect())
    if len(widths) > 1:
        raise ValueError(f"files of {path} have {widths} columns")
    return widths[0] if widths else len(MALWARE_COLUMNS)


def guess_layout(raw: DataFrame, ds: str) -> DataFrame:
    """Unknown layout: the first column that mostly holds web addresses is the URL."""
    shares = raw.agg(
        *[F.avg(F.coalesce(F.col(c).rlike(WEB_PREFIX), F.lit(False)).cast("int")).alias(c) for c in raw.columns]
    ).first()
    url = next((c for c in raw.columns if (shares[c] or 0) > 0.5), raw.columns[0])
    return raw.withColumnRenamed(url, "url").withColumn("dateadded", F.lit(ds))


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line; blank and comment lines are dropped."""
    lines = spark.read.text(path)
    return (
        lines.filter(~F.startswith("value", F.lit("#")))
        .select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("url"))
        .filter(F.col("url") != "")
    )


def read_feed_header(spark: SparkSession, path: str) -> DataFrame:
    """The comment lines of a feed file."""
    return spark.read.text(path).filter(F.startswith("value", F.lit("#")))
