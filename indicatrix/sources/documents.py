"""Landed JSON and HTML documents flattened into rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix import schemas
from indicatrix.functions.text import clean_domain, has_domain_chars, last_label
from indicatrix.operators.contract import document
from indicatrix.operators.picks import pick_one

# A cell that starts with a date and a time, seconds or not.
DATE_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?"


def _text(doc: Column, *paths: str) -> Column:
    """The first non-empty text among the paths."""
    found = [F.nullif(F.try_variant_get(doc, p, "string"), F.lit("")) for p in paths]
    return F.coalesce(*found) if len(found) > 1 else found[0]


def _items(doc: Column, path: str, other: str | None = None) -> Column:
    """The list at a path as variants, else at the other path; empty where there is none."""
    empty = F.array().cast("array<variant>")
    found = F.try_variant_get(doc, path, "array<variant>")
    if other is None:
        return F.coalesce(found, empty)
    return F.when(F.size(found) > 0, found).otherwise(F.coalesce(F.try_variant_get(doc, other, "array<variant>"), empty))


def _is_string(doc: Column) -> Column:
    return F.schema_of_variant(doc) == "STRING"


def _names(items: Column, *paths: str) -> Column:
    """Names out of a list of objects or plain strings."""
    picked = F.transform(
        items, lambda t: F.when(_is_string(t), F.try_variant_get(t, "$", "string")).otherwise(_text(t, *paths))
    )
    return F.filter(picked, lambda x: x.isNotNull())


# -- certificate messages -------------------------------------------------------


def ct_events(messages: DataFrame, seen_at: str, every_n: int = 1, source: str = "certstream") -> DataFrame:
    """One event per certificate name out of messages in ``value``.

    Every ``every_n``-th name by position is kept, cleaned and checked. ``seen_at``
    names the time column that stands for the arrival of a message. The id ends in
    a digest of the message, since many messages arrive in one millisecond.
    """
    names = F.from_json("value", "data struct<leaf_cert: struct<all_domains: array<string>>>")
    raw = messages.select(seen_at, F.substring(F.md5(F.col("value").cast("binary")), 1, 16).alias("_message"), F.posexplode(names["data"]["leaf_cert"]["all_domains"]).alias("pos", "raw"))
    cleaned = raw.filter(F.col("pos") % every_n == 0).withColumn("domain", clean_domain(F.col("raw")))
    stamp = F.date_format(seen_at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return cleaned.filter(has_domain_chars(F.col("domain"))).select(
        F.concat_ws("-", F.lit("ct"), F.unix_millis(seen_at).cast("string"), F.col("pos").cast("string"), F.col("_message")).alias("id"),
        "domain",
        last_label(F.col("domain")).alias("tld"),
        stamp.alias("event_ts"),
        stamp.alias("producer_ts"),
        F.lit(source).alias("source"),
    )


# -- threat-list documents ----------------------------------------------------------


def threat_events(documents: DataFrame) -> DataFrame:
    """Attribute rows of threat-event documents in ``value``, with the event's facts on each."""
    doc = documents.select(document(F.col("value")).alias("_root"))
    event = F.coalesce(F.try_variant_get("_root", "$.Event", "variant"), F.col("_root"))
    head = doc.select(event.alias("_e")).select(
        F.coalesce(_text(F.col("_e"), "$.Orgc.name", "$.orgc.name"), F.lit("")).alias("orgc"),
        F.coalesce(_text(F.col("_e"), "$.id", "$.uuid"), F.lit("")).alias("event_id"),
        _text(F.col("_e"), "$.date").alias("_date"),
        _names(_items(F.col("_e"), "$.Tag", "$.tags"), "$.name", "$.Name").alias("tags"),
        F.filter(
            F.transform(_items(F.col("_e"), "$.Galaxy", "$.galaxies"), lambda g: _text(g, "$.name")),
            lambda x: x.isNotNull(),
        ).alias("galaxies"),
        F.explode(_items(F.col("_e"), "$.Attribute", "$.attributes")).alias("_a"),
    )
    a = F.col("_a")
    rows = head.select(
        F.coalesce(_text(a, "$.value", "$.Value"), F.lit("")).alias("indicator"),
        F.coalesce(_text(a, "$.type", "$.Type"), F.lit("")).alias("type"),
        F.coalesce(_text(a, "$.category", "$.Category"), F.lit("")).alias("category"),
        "orgc",
        "event_id",
        F.try_to_timestamp(F.coalesce(_text(a, "$.first_seen"), "_date")).alias("first_seen"),
        F.try_to_timestamp(_text(a, "$.last_seen")).alias("last_seen"),
        "tags",
        "galaxies",
        F.lit("misp_osint").alias("source"),
    )
    return schemas.conform(rows, schemas.THREAT_LIST)


def attribute_search(responses: DataFrame) -> DataFrame:
    """Rows of attribute-search responses in ``value``; tags of attribute and event merged as a set."""
    doc = document(F.col("value"))
    a = F.col("_a")
    event = F.try_variant_get(a, "$.Event", "variant")
    found = responses.select(F.explode(_items(doc, "$.response.Attribute")).alias("_a"))
    tags = [
        F.filter(F.transform(_items(a, path), lambda t: F.try_variant_get(t, "$.name", "string")), lambda x: x.isNotNull())
        for path in ("$.Tag", "$.Event.Tag")
    ]
    clusters = F.flatten(F.transform(_items(event, "$.Galaxy"), lambda g: _items(g, "$.GalaxyCluster")))
    galaxies = F.transform(clusters, lambda c: _text(c, "$.value", "$.tag_name"))
    rows = found.select(
        F.try_variant_get(a, "$.value", "string").alias("indicator"),
        F.try_variant_get(a, "$.type", "string").alias("type"),
        F.try_variant_get(a, "$.category", "string").alias("category"),
        F.try_variant_get(a, "$.Event.Orgc.name", "string").alias("orgc"),
        F.try_variant_get(a, "$.Event.id", "string").alias("event_id"),
        F.try_to_timestamp(_text(a, "$.first_seen", "$.timestamp")).alias("first_seen"),
        F.try_to_timestamp(F.try_variant_get(a, "$.last_seen", "string")).alias("last_seen"),
        F.array_sort(F.array_union(*tags)).alias("tags"),
        F.filter(galaxies, lambda x: x.isNotNull()).alias("galaxies"),
        F.lit("misp").alias("source"),
    )
    return schemas.conform(rows, schemas.THREAT_LIST)


def lists_as_text(attrs: DataFrame) -> DataFrame:
    """Published form: lists joined by commas, one row per indicator and event."""
    flat = attrs.withColumns(
        {c: F.coalesce(F.array_join(c, ", "), F.lit("")) for c in ("tags", "galaxies")}
    ).filter(F.col("indicator").isNotNull())
    return pick_one(flat, ["indicator", "event_id"], ["type", "category"])


def lists_as_json(attrs: DataFrame) -> DataFrame:
    return attrs.withColumns({c: F.to_json(c) for c in ("tags", "galaxies")})


# -- directory listing ------------------------------------------------------------


def directory_index(pages: DataFrame, base_url: str) -> DataFrame:
    """(url, last_modified) of the JSON files in directory pages in ``value``.

    A page is taken link by link: a link to a JSON file, and the first cell up to
    the next link that starts with a date and a time.
    """
    row, cells = F.col("_row"), F.col("_cells")
    rows = pages.select(F.explode(F.split("value", r"(?i)<a\b")).alias("_row"))
    rows = rows.withColumn("link", F.regexp_extract(row, r"""(?i)^[^>]*\bhref\s*=\s*["']([^"']+\.json)["']""", 1)).filter(F.col("link") != "")
    after = F.element_at(F.split(row, "(?i)</a>", 2), -1)
    rows = rows.withColumn("_cells", F.transform(F.split(after, "(?i)<td[^>]*>"), lambda c: F.trim(F.regexp_replace(c, r"<[^>]*>|\s+", " "))))
    dated = F.filter(F.slice(cells, 2, F.size(cells)), lambda c: c.rlike(DATE_TIME))
    rows = rows.select("link", F.regexp_extract(F.get(dated, F.lit(0)), DATE_TIME, 0).alias("time"))
    folder = base_url.rsplit("/", 1)[0] + "/"
    site = "/".join(base_url.split("/", 3)[:3])
    link = F.col("link")
    url = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(F.startswith(link, F.lit("/")), F.concat(F.lit(site), link))
        .otherwise(F.concat(F.lit(folder), F.regexp_replace(link, r"^(\./)+", "")))
    )
    listed = rows.select(url.alias("url"), F.try_to_timestamp("time").alias("last_modified"))
    return pick_one(listed.filter(F.col("last_modified").isNotNull()), ["url"], ["last_modified"])


def files_of_day(index: DataFrame, ds: str, hours: int = 3, newest: int | None = None) -> DataFrame:
    """Files changed on the day, a few hours either way; ``newest`` keeps only so many."""
    day = F.lit(ds).cast("timestamp")
    start = day - F.make_dt_interval(hours=F.lit(hours))
    end = day + F.make_dt_interval(days=F.lit(1), hours=F.lit(hours))
    changed = index.filter((F.col("last_modified") >= start) & (F.col("last_modified") < end))
    return changed if newest is None else changed.orderBy(F.col("last_modified").desc(), "url").limit(newest)


# -- registration data --------------------------------------------------------------


def whois_rows(responses: DataFrame, raw_chars: int | None = None) -> DataFrame:
    """WHOIS rows out of landed responses (domain, http_status, body, error, fetched_at).

    The raw document is kept whole unless ``raw_chars`` says how much of it.
    """
    parsed = responses.withColumn("_doc", document(F.col("body")))
    d = F.col("_doc")
    # Entities with the role and a card of the two parts that cards have.
    is_registrar = F.filter(
        _items(d, "$.entities"),
        lambda e: F.array_contains(F.coalesce(F.try_variant_get(e, "$.roles", "array<string>"), F.array()), "registrar")
        & (F.size(_items(e, "$.vcardArray")) == 2),
    )
    full_names = F.flatten(
        F.transform(
            is_registrar,
            lambda e: F.transform(
                F.filter(
                    _items(e, "$.vcardArray[1]"),
                    lambda item: F.try_variant_get(item, "$[0]", "string") == "fn",
                ),
                lambda item: F.try_variant_get(item, "$[3]", "string"),
            ),
        )
    )

    def last_event(*actions: str) -> Column:
        events = F.filter(
            _items(d, "$.events"), lambda e: F.try_variant_get(e, "$.eventAction", "string").isin(*actions)
        )
        last = F.try_element_at(events, F.lit(-1))
        return F.try_to_timestamp(F.try_variant_get(last, "$.eventDate", "string"))

    failure = F.when(F.col("error").isNotNull(), F.col("error")).when(
        F.col("http_status") >= 400, F.concat(F.lit("http status "), F.col("http_status").cast("string"))
    )
    missing = F.coalesce(F.col("http_status") == 404, F.lit(False)) & F.col("error").isNull()
    failure = F.when(~missing, F.coalesce(failure, F.when(d.isNull(), F.lit("response is not JSON"))))
    usable = failure.isNull() & ~missing
    statuses = F.array_join(F.try_variant_get(d, "$.status", "array<string>"), ",")
    rows = parsed.select(
        "domain",
        F.when(usable, F.coalesce(_text(d, "$.registrar.name"), F.get(full_names, F.lit(0)))).alias("registrar"),
        F.when(missing, "not_found").when(usable, F.nullif(statuses, F.lit(""))).alias("status"),
        F.when(usable, last_event("registration")).alias("created"),
        F.when(usable, last_event("expiration", "expire")).alias("expires"),
        F.when(usable, F.col("body") if raw_chars is None else F.substring("body", 1, raw_chars)).alias("raw"),
        failure.alias("error"),
        "fetched_at",
    )
    return schemas.conform(rows, schemas.WHOIS)


# -- address data --------------------------------------------------------------------


def _batch_api(doc: Column) -> dict[str, Column]:
    ok = F.try_variant_get(doc, "$.status", "string") == "success"

    def get(path: str, kind: str = "string") -> Column:
        return F.when(ok, F.try_variant_get(doc, path, kind))

    return {
        "country": get("$.country"),
        "region": get("$.regionName"),
        "city": get("$.city"),
        "lat": get("$.lat", "double"),
        "lon": get("$.lon", "double"),
        "asn": F.when(ok, F.substring_index(_text(doc, "$.as"), " ", 1)),
        "asn_name": get("$.asname"),
        "isp": get("$.isp"),
        "org": get("$.org"),
        "reverse": get("$.reverse"),
        "proxy": get("$.proxy", "boolean"),
        "hosting": get("$.hosting", "boolean"),
    }


def _single_api(doc: Column) -> dict[str, Column]:
    place = F.split(F.try_variant_get(doc, "$.loc", "string"), ",")
    org = F.try_variant_get(doc, "$.org", "string")
    two = F.size(place) == 2
    return {
        "country": F.coalesce(F.try_variant_get(doc, "$.country", "string"), F.when(doc.isNotNull(), "")),
        "region": F.try_variant_get(doc, "$.region", "string"),
        "city": F.try_variant_get(doc, "$.city", "string"),
        "lat": F.when(two, F.get(place, F.lit(0)).try_cast("double")),
        "lon": F.when(two, F.get(place, F.lit(1)).try_cast("double")),
        "asn": F.when(doc.isNotNull(), F.substring_index(F.coalesce(org, F.lit("")), " ", 1)),
        "asn_name": F.when(doc.isNotNull(), F.coalesce(org, F.lit(""))),
        "isp": org,
        "org": org,
        "reverse": F.try_variant_get(doc, "$.hostname", "string"),
        "proxy": F.lit(None).cast("boolean"),
        "hosting": F.lit(None).cast("boolean"),
    }


def _database(doc: Column) -> dict[str, Column]:
    owner = F.try_variant_get(doc, "$.autonomous_system_organization", "string")
    number = F.try_variant_get(doc, "$.autonomous_system_number", "bigint")
    return {
        "country": F.try_variant_get(doc, "$.country.name", "string"),
        "region": F.try_variant_get(doc, "$.subdivision.name", "string"),
        "city": F.try_variant_get(doc, "$.city.name", "string"),
        "lat": F.nullif(F.try_variant_get(doc, "$.location.latitude", "double"), F.lit(0.0)),
        "lon": F.nullif(F.try_variant_get(doc, "$.location.longitude", "double"), F.lit(0.0)),
        "asn": F.when(number.isNotNull(), F.concat(F.lit("AS"), number.cast("string"))),
        "asn_name": owner,
        "isp": owner,
        "org": owner,
        "reverse": F.lit(None).cast("string"),
        "proxy": F.lit(None).cast("boolean"),
        "hosting": F.lit(None).cast("boolean"),
    }


LAYOUTS = {"maxmind": _database, "ipinfo_lite": _single_api, "ip_api": _batch_api}


def geo_rows(answers: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """Geo attributes per address out of landed answers (ip, provider, value).

    Each provider's layout is brought to the same columns; where several
    answered, the first in ``priority`` counts.
    """
    order = priority or list(LAYOUTS)
    doc = document(F.col("value"))
    parts = [
        answers.filter(F.col("provider") == name)
        .withColumn("_doc", doc)
        .select("ip", F.lit(rank).alias("_rank"), *[v.alias(k) for k, v in LAYOUTS[name](F.col("_doc")).items()])
        for rank, name in enumerate(order)
    ]
    best = pick_one(reduce(DataFrame.unionByName, parts), ["ip"], ["_rank"])
    return schemas.conform(best, schemas.GEO)


def ct_geo_rows(answers: DataFrame) -> DataFrame:
    """The short geo form of the certificate path: full network text and network name."""
    doc = document(F.col("value"))
    ok = F.try_variant_get(doc, "$.status", "string") == "success"
    fields = {"country": "$.country", "asn": "$.as", "asname": "$.asname", "org": "$.org"}
    return answers.select(
        "ip", *[F.when(ok, F.try_variant_get(doc, p, "string")).alias(n) for n, p in fields.items()]
    )
