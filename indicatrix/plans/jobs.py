"""The daily, lookup, training, scoring and certificate jobs, from landed files to published tables.

Every job takes its dates as arguments and can be run again for the same day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicatrix import schemas
from indicatrix.functions.buckets import risk_bucket
from indicatrix.functions.domains import with_punycode, with_registered_domain
from indicatrix.functions.text import clean_domain_anywhere
from indicatrix.operators import features, gold, layers, lookups, matches, models, picks, quality, risk
from indicatrix.operators.skew import lookup_join
from indicatrix.session import materialise, removes_scratch
from indicatrix.sources import documents, feeds, tables
from indicatrix.sources.cache import geo_cache, whois_cache

RUN = "run_date"


@dataclass(frozen=True)
class Layout:
    """Where the tables lie below one root."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root}/{name.replace('__', '/')}"


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _day(df: DataFrame, ds: str) -> DataFrame:
    return tables.listed_days(df, [ds]).drop(tables.PARTITION)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A daily table with its partition column; empty before the first day."""
    return tables.read_table(spark, path, T.StructType([*schema.fields, T.StructField(tables.PARTITION, T.DateType())]))


class FailedChecks(ValueError):
    """A feed broke an expectation."""


def _require(checks: DataFrame) -> None:
    broken = checks.filter("failed_rows > 0").collect()
    if broken:
        raise FailedChecks(", ".join(f"{r['check']}: {r['failed_rows']}" for r in broken))


# -- daily layers --------------------------------------------------------------------------


@removes_scratch
def ingest_malware(
    spark: SparkSession, at: Layout, feed: str, ds: str, run_ts: str, today: str | None = None, min_rows: int = quality.MIN_ROWS
) -> str:
    age = quality.feed_age(feeds.read_feed_header(spark, feed), _at(run_ts)).first()
    if age["stale"]:
        raise FailedChecks(f"feed is {age['age_hours']:.1f} hours old")
    bronze = layers.bronze_malware(feeds.read_malware_csv(spark, feed, ds), _at(run_ts))
    return _publish_feed(bronze, at.bronze__urlhaus, ds, min_rows, today)


@removes_scratch
def ingest_phish(
    spark: SparkSession, at: Layout, feed: str, ds: str, run_ts: str, today: str | None = None, min_rows: int = quality.MIN_ROWS
) -> str:
    bronze = layers.bronze_phish(feeds.read_url_lines(spark, feed), _at(run_ts))
    return _publish_feed(bronze, at.bronze__openphish, ds, min_rows, today)


def _publish_feed(bronze: DataFrame, path: str, ds: str, min_rows: int, today: str | None) -> str:
    if today is not None and ds != today:
        return "history"
    # Checked and then written, so worked out once.
    rows = materialise(bronze, "bronze")
    _require(quality.feed_expectations(rows))
    return tables.publish_day(rows, path, ds, min_rows)


def daily_silver(spark: SparkSession, at: Layout, ds: str) -> dict[str, str]:
    malware = _day(_read(spark, at.bronze__urlhaus, schemas.BRONZE_MALWARE), ds)
    phish = _day(_read(spark, at.bronze__openphish, schemas.BRONZE_PHISH), ds)
    return {
        "urlhaus": tables.publish_day(layers.silver_malware(malware), at.silver__urlhaus, ds),
        "openphish": tables.publish_day(layers.silver_phish(phish), at.silver__openphish, ds),
    }


def daily_union(spark: SparkSession, at: Layout, ds: str, others: list[DataFrame] | None = None) -> str:
    malware = _day(_read(spark, at.silver__urlhaus, schemas.SILVER_LABEL), ds)
    phish = _day(_read(spark, at.silver__openphish, schemas.SILVER_LABEL), ds)
    return tables.publish_day(layers.label_union(spark, malware, phish, others), at.silver__labels_union, ds)


def ingest_threat_list(spark: SparkSession, at: Layout, folder: str, ds: str, min_rows: int = quality.MIN_ROWS) -> str:
    """Threat-event documents, one per file, as published list rows."""
    events = documents.threat_events(spark.read.text(folder, wholetext=True))
    return tables.publish_day(documents.lists_as_text(events), at.silver__misp_osint, ds, min_rows)


def changed_files(index_pages: DataFrame, base_url: str, ds: str, newest: int | None = None) -> DataFrame:
    """The listed threat documents that changed on the day, to be fetched and then read by ``ingest_threat_list``."""
    return documents.files_of_day(documents.directory_index(index_pages, base_url), ds, newest=newest)


def ingest_search_results(spark: SparkSession, at: Layout, folder: str, ds: str, min_rows: int = 0) -> str:
    """Attribute-search responses, one per file, as published list rows."""
    found = documents.attribute_search(spark.read.text(folder, wholetext=True))
    return tables.publish_day(documents.lists_as_text(found), at.silver__misp, ds, min_rows)


def lookup_coverage(spark: SparkSession, at: Layout, ds: str) -> DataFrame:
    """Shares of the day's domains that the lookups cover."""
    labels = tables.listed_days(labels_of(spark, at), [ds])
    dns = _day(_read(spark, at.lookups__dns_geo, schemas.DNS_GEO), ds)
    return quality.coverage(labels, dns, _day(_whois_columns(spark, at), ds))


def audit(spark: SparkSession, at: Layout, table: str, schema: T.StructType, date: str, expected: DataFrame) -> DataFrame:
    """The audit rows of a daily table: ``expected`` (source, ingest_date) partitions, absent and empty ones too."""
    rows = _read(spark, f"{at.root}/{table}", schema)
    return quality.partition_audit(rows, date, table.split("/")[0], expected=expected)


def labels_of(spark: SparkSession, at: Layout) -> DataFrame:
    rows = _read(spark, at.silver__labels_union, schemas.LABELS_UNION)
    return with_registered_domain(rows, "domain").filter("registered_domain <> ''")


# -- lookups ---------------------------------------------------------------------------------


def domains_of_day(spark: SparkSession, at: Layout, ds: str) -> DataFrame:
    """The day's registered domains and their IDNA form."""
    names = tables.listed_days(labels_of(spark, at), [ds]).select(F.col("registered_domain").alias("domain")).distinct()
    return with_punycode(names, "domain")


@removes_scratch
def merge_dns(
    spark: SparkSession,
    at: Layout,
    ds: str,
    now: str,
    resolved: DataFrame,
    answers: DataFrame,
    provider: str = "ip_api",
    blocks: DataFrame | None = None,
) -> DataFrame:
    """Bring newly resolved pairs and landed geo answers into the cache and publish the day.

    ``resolved`` has (puny_domain, ip), ``answers`` (ip, provider, value). ``blocks``,
    network blocks with geo attributes, stand for a local database and go before answers.
    """
    cache = geo_cache(spark, at.lookups__dns_geo_cache)
    names = domains_of_day(spark, at, ds).select("puny_domain")
    pairs = materialise(lookups.missing_pairs(resolved.join(names, "puny_domain", "left_semi"), cache.rows()), "pairs")
    geo = documents.geo_rows(answers)
    if blocks is not None:
        # The local database: attributes of the network block that holds the address.
        geo = lookups.locate_ips(pairs.select("ip"), blocks).filter("network IS NOT NULL").drop("network")
    cache.merge(lookups.attach_geo(pairs, geo))
    tables.publish_day(cache.read(within=names), at.lookups__dns_geo, ds)
    published = _day(_read(spark, at.lookups__dns_geo, schemas.DNS_GEO), ds)
    manifest = materialise(tables.run_manifest("dns_ip_geo_ingest", ds, now, names, pairs, published, cache.rows().select(*lookups.PAIR).distinct(), provider), "manifest")
    tables.write_json(manifest, f"{at.lookups__manifests}/ds={ds}")
    return spark.read.json(f"{at.lookups__manifests}/ds={ds}")


def whois_to_fetch(spark: SparkSession, at: Layout, ds: str, now: str, ttl_days: int = 30, error_days: int = 7) -> DataFrame:
    names = domains_of_day(spark, at, ds)
    cached = whois_cache(spark, at.lookups__whois_cache).read(within=names.select("domain"))
    return lookups.refresh_list(names, cached, _at(now), ttl_days, error_days)


def merge_whois(spark: SparkSession, at: Layout, ds: str, responses: DataFrame) -> str:
    """Bring landed registration responses into the cache and publish the day."""
    cache = whois_cache(spark, at.lookups__whois_cache)
    cache.merge(documents.whois_rows(responses).withColumn("domain", F.lower("domain")))
    names = domains_of_day(spark, at, ds).select("domain")
    return tables.publish_day(cache.read(within=names), at.lookups__whois, ds)


# -- training and scoring --------------------------------------------------------------------


def _whois_columns(spark: SparkSession, at: Layout) -> DataFrame:
    """Registration rows without the raw document, which no feature reads."""
    return _read(spark, at.lookups__whois, schemas.WHOIS).drop("raw")


def _attrs(spark: SparkSession, at: Layout) -> DataFrame:
    return _read(spark, at.silver__misp_osint, schemas.THREAT_LIST_TEXT)


@removes_scratch
def train_model(
    spark: SparkSession,
    at: Layout,
    ds: str,
    now: str,
    days: int = 14,
    spec: models.FeatureSpec = models.FeatureSpec(),
    estimator=None,
) -> DataFrame:
    """Train on the last days, measure on held-out domains and register the model."""
    labels = layers.binary_labels(tables.trailing_days(labels_of(spark, at), ds, days))
    dns = tables.trailing_days(_read(spark, at.lookups__dns_geo, schemas.DNS_GEO), ds, days)
    whois = tables.trailing_days(_whois_columns(spark, at), ds, days)
    listed = matches.listed_domains(tables.trailing_days(_attrs(spark, at), ds, days).drop(tables.PARTITION))
    rows = features.feature_rows(labels, dns, whois, _at(now), listed)
    data = models.training_table(rows)
    counts = features.dataset_counts(data).first().asDict()
    if not counts["n_rows"]:
        raise ValueError("no labels to train on")
    model = models.train(data.filter(~F.col("is_test")), estimator or models.boosted(), spec)
    measures = models.evaluate(model, data.filter("is_test"), spec).first().asDict()
    return models.register(model, at.models, f"model-{ds}", now, counts, measures)


@removes_scratch
def publish_threats(
    spark: SparkSession, at: Layout, ds: str, now: str, spec: models.FeatureSpec = models.FeatureSpec()
) -> DataFrame | None:
    """Score the day's domains, apply the overrides and publish threats, statistics and drift."""
    labels = tables.listed_days(labels_of(spark, at), [ds])
    if labels.isEmpty():
        return None
    dns = _day(_read(spark, at.lookups__dns_geo, schemas.DNS_GEO), ds)
    whois = _day(_whois_columns(spark, at), ds)
    rows = gold.scored_rows(labels, dns, whois, _day(_attrs(spark, at), ds), _at(now))
    scored = materialise(models.score(models.newest(spark, at.models), rows, spec), "scored")
    # The whole threat table of the day, read by all that follows; the documents are its named excerpts.
    tables.publish_day(gold.assemble(scored), at.gold__threat_table, ds)
    threats = _day(_read(spark, at.gold__threat_table, schemas.THREAT), ds)
    tables.write_json(gold.top_threats(threats), f"{at.gold__threats}/ds={ds}")
    tables.write_json(gold.recent(threats), f"{at.gold__threats_recent}/ds={ds}")
    tables.write_json(gold.high_risk(threats), f"{at.gold__threats_high_risk}/ds={ds}")
    stats = materialise(gold.statistics(scored, threats), "statistics")
    _require(quality.export_checks(threats).unionByName(quality.override_checks(threats)).unionByName(quality.statistics_checks(stats)))
    tables.write_json(stats, f"{at.gold__statistics}/ds={ds}")
    run = F.lit(ds).alias(RUN)
    published = F.when(F.col("is_in_misp") == 1, 1.0).otherwise(F.col("score")).alias("score")
    tables.write_days(
        gold.run_statistics(scored.select(run, published), RUN).withColumn(tables.PARTITION, F.col(RUN).cast("date")),
        at.gold__history,
    )
    history = spark.read.parquet(at.gold__history).drop(tables.PARTITION)
    asns = gold.top_asns(scored.withColumn(RUN, F.lit(ds)), RUN).groupBy(RUN).agg(
        F.map_from_entries(F.collect_list(F.struct("sample_asn", "count"))).alias("top_asns")
    )
    latest = gold.drift(history).filter(F.col(RUN) == ds).join(asns, RUN, "left")
    levels = stats.select("riskDistribution").scalar().alias("risk_distribution")
    drift = latest.withColumnRenamed(RUN, "date").select(F.lit(now).alias("generated_at"), "*", levels)
    tables.write_json(drift, f"{at.gold__drift}/ds={ds}")
    tables.write_json(models.newest_meta(spark, at.models), f"{at.gold__model_meta}/ds={ds}")
    return threats


# -- certificate events ------------------------------------------------------------------------


def ct_domains(events: DataFrame, runs: int | None = None, rows: int | None = None) -> DataFrame:
    """One row per registered domain out of stored certificate events.

    ``runs`` and ``rows`` keep only the newest days and events where given.
    """
    if runs is not None or rows is not None:
        order = [F.col("ingest_ts").desc(), "domain"]
        events = tables.newest_rows(events, "ds", order, runs, rows)
    named = events.select(clean_domain_anywhere(F.col("domain")).alias("domain"), "event_ts", "source", "ingest_ts")
    known = with_registered_domain(named, "domain").filter("registered_domain <> ''")
    return picks.first_ct(known)


def ct_facts(base: DataFrame, resolved: DataFrame, answers: DataFrame) -> DataFrame:
    """Address facts per certificate domain out of landed answers.

    ``resolved`` has (registered_domain, ip); a domain without a row there counts
    as unresolved.
    """
    pairs = base.select("registered_domain").join(resolved.distinct(), "registered_domain", "left")
    geo = picks.pick_one(documents.ct_geo_rows(answers), ["ip"], ["country"])
    return features.ct_summary(lookup_join(pairs, geo, "ip"), base)


def ct_scores(model, enriched: DataFrame, spec: models.FeatureSpec) -> DataFrame:
    """The newest record per domain with its score and risk bucket."""
    scored = models.score(model, picks.latest_ct(enriched), spec)
    return scored.withColumn("risk_bucket", risk_bucket(F.col("score")))


def ct_reports(scored: DataFrame) -> dict[str, DataFrame]:
    """The score reports. ``scored`` is read by all of them, so pass a stored table."""
    by_suffix = with_registered_domain(scored.withColumn("_name", F.col("registered_domain")), "_name", "tld", None)
    return {
        "summary": risk.score_summary(scored),
        "thresholds": risk.score_thresholds(scored),
        "buckets": risk.score_by_bucket(scored),
        "tld": risk.score_risk(by_suffix, "tld"),
        "country": risk.score_risk(scored, "sample_country"),
        "ip_count": risk.score_by_ip_count(scored),
        "keywords": risk.suspicious_names(scored, "registered_domain"),
        "histogram": risk.score_histogram(scored),
    }
