"""Queries over the published threat table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.functions.buckets import MAP_COUNTRY_ALIASES, intensity_class
from indicatrix.operators.skew import is_small
from indicatrix.session import materialise

# Texts that travel as a constant, and characters of a text by which it meets URLs otherwise.
CONSTANT_TEXTS, GRAM = 100, 4


def _name_or_url_holds(query: str | Column) -> Column:
    q = F.lit(query) if isinstance(query, str) else query
    return F.contains(F.lower("domain"), q) | F.contains(F.lower("url"), q)


def search(threats: DataFrame, query: str) -> DataFrame:
    """Rows whose domain or URL holds the text, whatever the case; all rows for an empty text."""
    q = query.lower().strip()
    return threats.filter(_name_or_url_holds(q)) if q else threats


def of_level(threats: DataFrame, level: str) -> DataFrame:
    return threats if level == "ALL" else threats.filter(F.col("riskLevel") == level)


def lookup(threats: DataFrame, texts: DataFrame | list[str], rank: list[Column | str]) -> DataFrame:
    """For each text the first row, by ``rank``, whose domain equals it or whose URL holds it.

    Up to CONSTANT_TEXTS texts of a list travel as a constant and the rows are scanned once. More of them, or a
    table of one column, are joined: a text meets domains by equality, and URLs by that stretch of GRAM characters
    (or all of a shorter text) that the fewest URLs hold, and is then looked for in the URL. What common texts share, as
    their endings, brings nothing together. Only the best row per text and task is shuffled on.
    """
    order = F.struct(*[F.col(r) if isinstance(r, str) else r for r in rank], *[F.col(c) for c in threats.columns])
    if isinstance(texts, list) and len(texts) <= CONSTANT_TEXTS:
        hits = _constant_hits(threats, texts)
    else:
        if isinstance(texts, list):
            texts = threats.sparkSession.createDataFrame([(t,) for t in texts], "query string")
        hits = _joined_hits(threats, texts)
    found = hits.groupBy("query").agg(F.min(order).alias("_first"))
    return found.select("query", *[F.col("_first")[c].alias(c) for c in threats.columns])


def _constant_hits(threats: DataFrame, texts: list[str]) -> DataFrame:
    wanted = sorted({t.lower().strip() for t in texts} - {""})
    domain, url = F.lower("domain"), F.lower("url")
    held = F.filter(
        F.array(*[F.lit(t) for t in wanted]).cast("array<string>"), lambda t: (t == domain) | F.contains(url, t)
    )
    return threats.withColumn("query", F.explode(held))


def grams(text: Column, length: int = GRAM) -> Column:
    """The distinct stretches of ``length`` characters; a text that is shorter is one itself."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - length + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(length))))


def rarest_grams(urls: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query, gram) with the stretch of each text that the fewest URLs hold.

    ``urls`` has ``_url``, ``wanted`` has ``query``. A text with a stretch that no URL holds is in none and left out. Texts shorter
    than GRAM keep themselves: as stretches of their own length they are counted likewise.
    """
    asked = wanted.select("query", F.explode(grams(F.col("query"))).alias("gram"))
    lengths = range(1, GRAM + 1)
    present = asked.agg(F.collect_set(F.length("gram"))).first()[0]  # at most GRAM numbers
    counted = urls.select(F.explode(_url_grams(F.col("_url"), [n for n in lengths if n in present])).alias("gram"))
    counts = counted.groupBy("gram").agg(F.count("*").alias("_urls"))
    met = asked.join(counts, "gram", "left")
    best = F.min(F.struct(F.coalesce("_urls", F.lit(0)).alias("urls"), "gram")).alias("best")
    return met.groupBy("query").agg(best).where("best.urls > 0").select("query", "best.gram")


def _url_grams(url: Column, lengths: list[int]) -> Column:
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(F.length(url) >= n, grams(url, n)).otherwise(none) for n in lengths])


def url_candidates(threats: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows with the texts that their URLs may hold: those whose rarest stretch they hold."""
    rows = threats.withColumn("_url", F.lower("url"))
    chosen = materialise(rarest_grams(rows.where("_url IS NOT NULL").select("_url"), wanted), "rarest-grams")
    lengths = [r[0] for r in chosen.select(F.length("gram")).distinct().collect()]
    held = rows.select("*", F.explode(_url_grams(F.col("_url"), sorted(lengths))).alias("gram"))
    if is_small(chosen):
        return held.join(F.broadcast(chosen), "gram")
    return held.join(chosen.hint("merge"), "gram")


def _joined_hits(threats: DataFrame, texts: DataFrame) -> DataFrame:
    text = F.lower(F.trim(F.col(texts.columns[0])))
    wanted = materialise(texts.select(text.alias("query")).filter("query <> ''").distinct(), "texts")
    names = threats.withColumn("query", F.lower("domain"))
    by_name = names.join(F.broadcast(wanted) if is_small(wanted) else wanted, "query").select(*threats.columns, "query")
    by_url = url_candidates(threats, wanted).where(F.contains(F.col("_url"), F.col("query")))
    return by_name.unionByName(by_url.select(*threats.columns, "query"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of the total per value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("share", F.round(F.col("count") / total, 6))


def country_classes(counts: DataFrame, countries: DataFrame) -> DataFrame:
    """Count and intensity class per map country.

    ``counts`` has (value, count), ``countries`` the map's names in ``name``. A
    country the feeds write differently takes the count of its alias.
    """
    alias = F.create_map(*[F.lit(x) for feed, shown in MAP_COUNTRY_ALIASES.items() for x in (shown, feed)])
    peak = counts.agg(F.max("count")).scalar()
    own = counts.select(F.col("value").alias("name"), F.col("count").alias("_own"))
    other = counts.select(F.col("value").alias("_alias"), F.col("count").alias("_other"))
    return (
        countries.withColumn("_alias", alias[F.col("name")])
        .join(own, "name", "left")
        .join(other, "_alias", "left")
        .withColumn("count", F.coalesce(F.nullif("_own", F.lit(0)), "_other", F.lit(0)).cast("bigint"))
        .withColumn("_peak", F.coalesce(peak, F.lit(0)))
        .select("name", "count", intensity_class(F.col("count"), F.col("_peak")).alias("class"))
    )
