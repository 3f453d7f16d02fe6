"""Time functions.  ``now`` is always passed in, never read from the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_or(text: Column, default: Column | None = None) -> Column:
    """Timestamp of a text; ``default`` (or NULL) where it does not parse."""
    parsed = F.try_to_timestamp(text)
    return parsed if default is None else F.coalesce(parsed, default)


def iso_text(time: Column) -> Column:
    """Published form of a time in UTC: with its offset, and a fraction where there is one."""
    whole = F.date_format(time, "yyyy-MM-dd HH:mm:ssxxx")
    exact = F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(time) % 1_000_000 == 0, whole).otherwise(exact)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds with their fraction, rounded to milliseconds."""
    return F.round((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6), 3)


def days_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(86400e6)


def whois_features(created: Column, expires: Column, error: Column, now: Column) -> list[Column]:
    """The five registration features of a domain."""
    return [
        days_between(now, created).alias("age_days"),
        days_between(expires, now).alias("days_to_expiry"),
        created.isNull().cast("int").alias("created_isnull"),
        expires.isNull().cast("int").alias("expires_isnull"),
        error.isNotNull().cast("int").alias("has_error"),
    ]
