"""Public suffix, registered domain and IDNA form of domain names."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatrix.functions.ip import is_ipv4
from indicatrix.functions.text import count_of, indicator_host

# The suffix list that ships with Spark's own HTTP client jar.
SUFFIX_RESOURCE = "mozilla/public-suffix-list.txt"
PRIVATE_SECTION = "// ===END ICANN DOMAINS==="
# A name that needs no tidying and is no address: those end in a digit.
CLEAN_NAME = r"^[a-z0-9_.\-]*[a-z]$"
# Upper bound that proves the rule table small enough to broadcast.
MAX_RULES = 50_000

_rules_by_app: dict[tuple[str, bool], tuple[DataFrame, int]] = {}


def read_suffix_text(spark: SparkSession) -> str:
    jvm = spark.sparkContext._jvm
    stream = jvm.java.lang.Thread.currentThread().getContextClassLoader().getResourceAsStream(SUFFIX_RESOURCE)
    if stream is None:
        raise FileNotFoundError(f"{SUFFIX_RESOURCE} is not on Spark's class path")
    return jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()


def _idna(name: str) -> str:
    try:
        return name.encode("idna").decode("ascii")
    except UnicodeError:
        return name


def parse_suffix_rules(text: str, private: bool = False) -> pd.DataFrame:
    """One row per suffix: its label count and which kinds of rule it carries.

    ``*.ck`` is kept as a wildcard on ``ck``. Non-ASCII rules are kept in their
    IDNA form too.
    """
    if not private:
        text = text.split(PRIVATE_SECTION)[0]
    kinds: dict[str, dict[str, bool]] = {}
    for line in text.splitlines():
        rule = line.split()[0] if line.split() else ""
        if not rule or rule.startswith("//"):
            continue
        kind = "exception" if rule.startswith("!") else "wildcard" if rule.startswith("*.") else "plain"
        name = rule.removeprefix("!").removeprefix("*.").lower()
        for form in {name, _idna(name)}:
            kinds.setdefault(form, {"plain": False, "wildcard": False, "exception": False})[kind] = True
    rows = [{"suffix": s, "n": s.count(".") + 1, **k} for s, k in kinds.items()]
    return pd.DataFrame(rows, columns=["suffix", "n", "plain", "wildcard", "exception"])


def suffix_rules(spark: SparkSession, private: bool = False) -> tuple[DataFrame, int]:
    """The rule table and the largest label count in it, read once per application."""
    key = (spark.sparkContext.applicationId, private)
    if key not in _rules_by_app:
        rules = parse_suffix_rules(read_suffix_text(spark), private)
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} suffix rules are too many to broadcast")
        schema = "suffix string, n int, plain boolean, wildcard boolean, exception boolean"
        _rules_by_app[key] = (spark.createDataFrame(rules, schema), int(rules["n"].max()))
    return _rules_by_app[key]


def with_registered_domain(
    df: DataFrame,
    name: str,
    suffix_col: str | None = None,
    domain_col: str | None = "registered_domain",
    private: bool = False,
) -> DataFrame:
    """Add the public suffix and/or the registered domain of ``name``.

    ``name`` may hold a host or a whole URL. Both results are ``''`` for IPs,
    unknown suffixes and NULL; the registered domain also for bare suffixes.
    The rules are looked up by one broadcast join per label count, so the rows
    are never shuffled.
    """
    rules, longest = suffix_rules(df.sparkSession, private)
    text = F.col(name)
    host = F.translate(indicator_host(text), "。．｡", "...")
    # Addresses match no suffix rule. Clean lower-case names, the bulk, are taken as they are.
    untidy = F.when(is_ipv4(host), "").otherwise(F.coalesce(host, F.lit("")))
    out = df.withColumn("_host", F.when(text.rlike(CLEAN_NAME), text).otherwise(untidy))
    out = out.withColumn("_labels", count_of(F.col("_host"), ".") + 1)
    plain, wildcard, exception = [], [], []
    for k in range(1, longest + 1):
        tail = F.when(F.col("_labels") >= k, F.substring_index("_host", ".", -k))
        found = rules.filter(F.col("n") == k).select(
            F.col("suffix").alias("_tail"),
            F.struct("plain", "wildcard", "exception").alias(f"_rule{k}"),
        )
        out = out.withColumn("_tail", tail).join(F.broadcast(found), "_tail", "left").drop("_tail")
        rule = F.col(f"_rule{k}")
        plain.append(F.when(rule["plain"], k))
        wildcard.append(F.when(rule["wildcard"] & (F.col("_labels") > k), k + 1))
        exception.append(F.when(rule["exception"], k - 1))
    size = F.coalesce(*exception, F.greatest(*plain, *wildcard), F.lit(0))
    out = out.withColumn("_size", size).drop(*[f"_rule{k}" for k in range(1, longest + 1)])
    if suffix_col:
        suffix = F.when(F.col("_size") > 0, _last_labels("_size", 0, longest + 1))
        out = out.withColumn(suffix_col, F.coalesce(suffix, F.lit("")))
    if domain_col:
        domain = F.when(
            (F.col("_size") > 0) & (F.col("_labels") > F.col("_size")), _last_labels("_size", 1, longest + 1)
        )
        out = out.withColumn(domain_col, F.coalesce(domain, F.lit("")))
    return out.drop("_host", "_labels", "_size")


def _last_labels(size: str, more: int, longest: int) -> Column:
    """The last ``size + more`` labels of the host; the count is a column, so one branch per size."""
    chosen = F.when(F.lit(False), F.lit(""))
    for k in range(1, longest + 1):
        chosen = chosen.when(F.col(size) == k, F.substring_index("_host", ".", -(k + more)))
    return chosen


def is_ascii(name: Column) -> Column:
    return ~name.rlike(r"[^\x00-\x7F]")


def punycode(name: Column) -> Column:
    """The IDNA form of a name; ASCII names already are their own, and a name that has none is kept as it is."""
    encoded = F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), name)
    return F.when(is_ascii(name), name).otherwise(F.coalesce(encoded, name))


def with_punycode(df: DataFrame, name: str, out: str = "puny_domain") -> DataFrame:
    return df.withColumn(out, punycode(F.col(name)))
