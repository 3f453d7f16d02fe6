"""De-duplication: one row per key under a total order.

``row_number() = 1`` is planned with a group limit below the shuffle, so every
map task sends at most one row per key and a hot key costs no more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row per key. Ties are broken by the remaining simple columns."""
    used = set(keys) | {o for o in order if isinstance(o, str)}
    simple = [
        name for name, kind in df.dtypes if name not in used and not kind.startswith(("map", "variant"))
    ]
    window = Window.partitionBy(*keys).orderBy(*order, *simple)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def malware_silver(df: DataFrame) -> DataFrame:
    """One URL per domain and time."""
    return pick_one(df, ["domain", "first_seen"], ["url"])


def phish_silver(df: DataFrame) -> DataFrame:
    return pick_one(df, ["domain", "first_seen", "url"], ["label"])


def union_labels(df: DataFrame) -> DataFrame:
    return pick_one(df, ["domain", "first_seen", "source", "url"], ["label"])


def label_per_domain(df: DataFrame) -> DataFrame:
    """The earliest label of each registered domain."""
    return pick_one(df, ["registered_domain"], ["first_seen", "source", "url"])


def category_per_domain(df: DataFrame) -> DataFrame:
    """The latest threat-list row of each registered domain."""
    return pick_one(
        df, ["registered_domain"], [F.col("first_seen").desc(), F.col("event_id").desc(), "category"]
    )


def latest_whois(df: DataFrame) -> DataFrame:
    return pick_one(df, ["domain"], [F.col("fetched_at").desc_nulls_last()])


def latest_ct(df: DataFrame) -> DataFrame:
    return pick_one(df, ["registered_domain"], [F.col("event_ts").desc_nulls_last()])


def first_ct(df: DataFrame) -> DataFrame:
    return pick_one(df, ["registered_domain"], [F.col("ingest_ts").asc_nulls_last(), "domain"])


def upsert(cache: DataFrame, new: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """Cache and new rows, one per key. New rows win unless ``order`` says otherwise."""
    both = cache.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return pick_one(both, keys, [*(order or []), F.col("_new").desc()]).drop("_new")
