"""Registered queries for sources and nested documents.

The documents are made from the given tables by text expressions that both
engines understand; the checking SQL states the expected rows directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicatrix import schemas
from indicatrix.operators import layers
from indicatrix.plans.registry import query
from indicatrix.plans.standins import Tables, now
from indicatrix.session import scratch_dir
from indicatrix.sources import documents, feeds, tables
from indicatrix.streaming import events


@query("a2_envelope", "SELECT value, ts AS kafka_ts FROM stream_event")
def a2_envelope(t: Tables):
    messages = t.stream_event.select(F.col("value").cast("binary").alias("value"), F.col("ts").alias("timestamp"))
    return events.envelope(messages)


def _landed(t: Tables, lines, name: str) -> str:
    path = scratch_dir(t.spark, name)
    lines.write.text(path)
    return path


@query(
    "a8_malware_csv",
    """SELECT CAST(page_id AS VARCHAR) AS id, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS dateadded, url, 'online' AS status,
      CAST(NULL AS VARCHAR) AS last_online, label AS threat, 'a,b "q"' AS tags, CAST(page_id AS VARCHAR) AS urlhaus_link, 'r' AS reporter
    FROM feed_url WHERE page_id % 50 <> 0""",
)
def a8_malware_csv(t: Tables):
    n = F.col("page_id")
    line = F.concat(
        F.lit('"'), n.cast("string"), F.lit('","'), F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss"), F.lit('","'),
        F.col("url"), F.lit('","online","","'), F.col("label"), F.lit('","a,b ""q""","'), n.cast("string"), F.lit('","r"'),
    )
    value = F.when(n % 50 == 0, F.concat(F.lit("# Last updated: "), F.col("url"))).otherwise(line)
    path = _landed(t, t.feed_url.select(value.alias("value")), "csv")
    return feeds.read_malware_csv(t.spark, path, "2024-02-01")


@query(
    "a9_guess_layout",
    """SELECT CAST(page_id AS VARCHAR) AS c0, CASE WHEN page_id % 9 = 0 THEN 'broken' ELSE url END AS url, label AS c2,
      '2024-02-01' AS dateadded FROM feed_url""",
)
def a9_guess_layout(t: Tables):
    url = F.when(F.col("page_id") % 9 == 0, "broken").otherwise(F.col("url"))
    lines = t.feed_url.select(F.concat_ws(",", F.col("page_id").cast("string"), url, F.col("label")).alias("value"))
    # The commentless lines may hold a fragment mark, which only counts at the line start.
    return feeds.read_malware_csv(t.spark, _landed(t, lines, "csv"), "2024-02-01")


@query("a10_url_lines", "SELECT url FROM pages WHERE page_id % 10 > 1")
def a10_url_lines(t: Tables):
    n = F.col("page_id")
    line = (
        F.when(n % 10 == 0, F.concat(F.lit("#"), F.col("url"))).when(n % 10 == 1, "   ")
        .otherwise(F.concat(F.lit(" "), F.col("url"), F.lit("\t")))
    )
    return feeds.read_url_lines(t.spark, _landed(t, t.pages.select(line.alias("value")), "lines"))


_LABEL_COLUMNS = "domain, url, first_seen, label, source"


@query(
    "a12_trailing_days",
    f"""SELECT {_LABEL_COLUMNS} FROM label_row
    WHERE ingest_date > DATE '1998-06-30' - INTERVAL 14 DAY AND ingest_date <= DATE '1998-06-30'""",
)
def a12_trailing_days(t: Tables):
    return tables.trailing_days(t.label_row, "1998-06-30", 14).drop("ingest_date")


_DAYS = ["1997-03-01", "1997-03-02", "1999-12-31", "2030-01-01"]


@query(
    "a13_listed_days",
    f"SELECT {_LABEL_COLUMNS} FROM label_row WHERE CAST(ingest_date AS VARCHAR) IN ({', '.join(repr(d) for d in _DAYS)})",
)
def a13_listed_days(t: Tables):
    return tables.listed_days(t.label_row, _DAYS).drop("ingest_date")


@query(
    "a14_newest_rows",
    f"""SELECT {_LABEL_COLUMNS} FROM label_row
    WHERE ingest_date >= (SELECT min(d) FROM (SELECT DISTINCT ingest_date AS d FROM label_row ORDER BY d DESC LIMIT 50))
    ORDER BY first_seen DESC, domain, url, source, label LIMIT 20000""",
)
def a14_newest_rows(t: Tables):
    order = [F.col("first_seen").desc(), "domain", "url", "source", "label"]
    return tables.newest_rows(t.label_row, "ingest_date", order, runs=50, rows=20_000).drop("ingest_date")


@query("a11_damaged_file", """SELECT o_orderkey, CAST(1 AS BIGINT) AS unreadable FROM orders""")
def a11_damaged_file(t: Tables):
    """A table with one damaged file among good ones: all other rows, and how many files were left out."""
    path = scratch_dir(t.spark, "damaged")
    rows = t.orders.select("o_orderkey")
    rows.filter("o_orderkey % 2 = 0").write.mode("append").parquet(path)
    rows.filter("o_orderkey % 2 <> 0").write.mode("append").parquet(path)
    t.spark.range(1).select(F.lit("no Parquet").alias("value")).coalesce(1).write.mode("append").option("compression", "none").text(f"{path}-text")
    broken = t.spark.read.format("binaryFile").load(f"{path}-text").first()["path"]
    source, files = tables.files_at(t.spark, broken)
    files.rename(source, tables.files_at(t.spark, f"{path}/part-damaged.parquet")[0])
    stored = tables.read_table(t.spark, path, rows.schema, skip_unreadable=True)
    skipped = tables.unreadable_files(t.spark, path, rows.schema).agg(F.count("*")).scalar()
    return stored.withColumn("unreadable", skipped)


@query("a17_empty_table", "SELECT name, CAST(0 AS BIGINT) AS rows, columns FROM (SELECT 'labels_union' AS name, CAST(7 AS BIGINT) AS columns) WHERE (SELECT count(*) FROM orders) > 0")
def a17_empty_table(t: Tables):
    """A table that nobody has written yet reads as empty, with all its columns."""
    union = tables.read_table(t.spark, scratch_dir(t.spark, "never-written"), schemas.LABELS_UNION)
    return union.agg(F.count("*").alias("rows")).select(F.lit("labels_union").alias("name"), "rows", F.lit(len(union.columns)).cast("bigint").alias("columns"))


@query(
    "a18_skip_rules",
    """SELECT 1 AS step, 'no_input' AS answer, CAST(0 AS BIGINT) AS rows UNION ALL SELECT 2, 'history', 0 UNION ALL SELECT 3, 'written', count(*) FROM orders
    UNION ALL SELECT 4, 'kept', count(*) FROM orders UNION ALL SELECT 5, 'no_input', count(*) FROM orders""",
)
def a18_skip_rules(t: Tables):
    """Publishing nothing, a past day, a day, a day with too few rows, and nothing again; with the rows there after each."""
    path, day = scratch_dir(t.spark, "published"), "2024-02-01"
    rows = t.orders.select("o_orderkey")
    attempts = [
        (rows.filter("o_orderkey < 0"), {}),
        (rows, {"today": "2024-02-02"}),
        (rows, {"min_rows": 50}),
        (rows.limit(3), {"min_rows": 50}),
        (rows.filter("o_orderkey < 0"), {}),
    ]
    schema = T.StructType([*rows.schema.fields, T.StructField(tables.PARTITION, T.DateType())])
    answers = []
    for step, (df, rules) in enumerate(attempts, 1):
        answer = tables.publish_day(df, path, day, **rules)
        answers.append((step, answer, tables.read_table(t.spark, path, schema).count()))
    return t.spark.createDataFrame(answers, "step int, answer string, rows long")


@query(
    "a15_latest_run",
    "SELECT o_orderkey, domain, fetched_at FROM whois WHERE fetched_at = (SELECT max(fetched_at) FROM whois)",
)
def a15_latest_run(t: Tables):
    return tables.latest_run(t.whois, "fetched_at").select("o_orderkey", "domain", "fetched_at")


@query(
    "a16_replace_days",
    """SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN upper(label) ELSE label END AS label,
      strftime(first_seen, '%Y-%m-%d') AS ds FROM feed_url""",
)
def a16_replace_days(t: Tables):
    """A second run replaces the odd days, and no others."""
    path = scratch_dir(t.spark, "days")
    rows = t.feed_url.select("page_id", "url", "label", F.to_date("first_seen").alias("ingest_date"))
    tables.write_days(rows, path)
    tables.write_days(rows.filter(F.dayofmonth("ingest_date") % 2 == 1).withColumn("label", F.upper("label")), path)
    stored = tables.read_table(t.spark, path, rows.schema)
    return stored.select("page_id", "url", "label", F.date_format("ingest_date", "yyyy-MM-dd").alias("ds"))


@query(
    "a19_json_records",
    """SELECT CAST(json_object('page_id', page_id, 'url', url, 'domain', domain, 'source', nullif(source, 'benign_seed'),
      'first_seen', strftime(first_seen, '%Y-%m-%d')) AS VARCHAR) AS value FROM feed_url""",
)
def a19_json_records(t: Tables):
    source = F.nullif("source", F.lit("benign_seed")).alias("source")
    return tables.json_records(
        t.feed_url.select("page_id", "url", "domain", source, F.date_format("first_seen", "yyyy-MM-dd").alias("first_seen"))
    )


@query(
    "a20_run_manifest",
    """SELECT 'dns_ip_geo_ingest' AS dag_id, '2024-02-01' AS ds, '2024-02-01T00:00:00Z' AS generated_at, (SELECT count(DISTINCT domain) FROM label_row) AS total_domains,
      (SELECT count(*) FROM (SELECT DISTINCT puny_domain, ip FROM dns_geo WHERE family = 6)) AS new_pairs_resolved,
      (SELECT count(*) FROM dns_geo WHERE puny_domain IN (SELECT domain FROM label_row)) AS daily_rows,
      (SELECT count(*) FROM dns_geo) AS cache_size, 'ip_api' AS geo_provider, CAST(0 AS BIGINT) AS errors""",
)
def a20_run_manifest(t: Tables):
    from indicatrix.operators import lookups

    names = t.label_row.select(F.col("domain").alias("puny_domain")).distinct()
    fresh = lookups.missing_pairs(t.dns_geo, t.dns_geo.filter("family = 4"))
    daily = lookups.daily_snapshot(t.dns_geo, names, "puny_domain")
    return tables.run_manifest(
        "dns_ip_geo_ingest", "2024-02-01", "2024-02-01T00:00:00Z", names, fresh, daily, t.dns_geo, "ip_api"
    )


# -- certificate messages ---------------------------------------------------------

_CT_TEXT = """CASE WHEN event_id % 23 = 0 THEN '{"data":' WHEN event_id % 29 = 0 THEN '{"data":{"leaf_cert":{}}}'
  ELSE concat('{"data":{"leaf_cert":{"all_domains":["*.D', CAST(user_id AS STRING), '.Com.","www.d', CAST(event_id AS STRING),
    '.net","bad name!","d', CAST(event_id AS STRING), '"]}}}') END"""
_CT_SQL = f"""WITH m AS (SELECT *, {_CT_TEXT} AS message FROM events)
  SELECT concat('ct-', CAST(epoch_us(ts) // 1000 AS VARCHAR), '-', CAST(pos AS VARCHAR), '-', substr(md5(message), 1, 16)) AS id, domain, tld,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_ts, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS producer_ts, 'certstream' AS source
  FROM (SELECT ts, 0 AS pos, concat('d', CAST(user_id AS VARCHAR), '.com') AS domain, 'com' AS tld, event_id, message FROM m
    UNION ALL SELECT ts, 1, concat('www.d', CAST(event_id AS VARCHAR), '.net'), 'net', event_id, message FROM m
    UNION ALL SELECT ts, 3, concat('d', CAST(event_id AS VARCHAR)), NULL, event_id, message FROM m)
  WHERE event_id % 23 <> 0 AND event_id % 29 <> 0"""


@query("b1_ct_events", _CT_SQL)
def b1_ct_events(t: Tables):
    return documents.ct_events(t.events.select("ts", F.expr(_CT_TEXT).alias("value")), "ts")


@query("b1_ct_events_sampled", _CT_SQL + " AND pos % 3 = 0")
def b1_ct_events_sampled(t: Tables):
    return documents.ct_events(t.events.select("ts", F.expr(_CT_TEXT).alias("value")), "ts", every_n=3)


# -- threat-list documents ------------------------------------------------------------

_EVENT_TEXT = """concat(CASE WHEN o_orderkey % 4 = 0 THEN '{"Event":' ELSE '' END,
  CASE WHEN o_orderkey % 4 = 3 THEN '{"id":' WHEN o_orderkey % 4 = 2 THEN '{"uuid":"u","Attribute":[]}'
    WHEN o_orderkey % 4 = 0 THEN concat('{"id":"', CAST(o_orderkey AS STRING), '","date":"2024-01-05","Orgc":{"name":"', o_orderpriority,
      '"},"Tag":[{"name":"t1"},"t2",{"Name":"t3"},{"colour":"x"}],"Galaxy":[{"name":"g1"},{"type":"x"}],"Attribute":[',
      '{"value":"d', CAST(o_custkey AS STRING), '.com","type":"domain","category":"Network","first_seen":"2024-01-02T03:04:05Z","last_seen":"not a date"},',
      '{"Value":"10.0.0.1","Type":"ip-dst","Category":"Payload"}]}')
    ELSE concat('{"uuid":"u', CAST(o_orderkey AS STRING), '","orgc":{"name":"low"},"tags":["one"],"galaxies":[],"attributes":[',
      '{"value":"","type":"url","last_seen":"2024-01-03 00:00:00"}]}') END,
  CASE WHEN o_orderkey % 4 = 0 THEN '}' ELSE '' END)"""


def _events(t: Tables):
    return documents.threat_events(t.orders.select(F.expr(_EVENT_TEXT).alias("value")))


_EVENT_SQL = """SELECT concat('d', CAST(o_custkey AS VARCHAR), '.com') AS indicator, 'domain' AS type, 'Network' AS category,
    o_orderpriority AS orgc, CAST(o_orderkey AS VARCHAR) AS event_id, TIMESTAMP '2024-01-02 03:04:05' AS first_seen,
    CAST(NULL AS TIMESTAMP) AS last_seen, {t1} AS tags, {g1} AS galaxies, 'misp_osint' AS source FROM orders WHERE o_orderkey % 4 = 0
  UNION ALL SELECT '10.0.0.1', 'ip-dst', 'Payload', o_orderpriority, CAST(o_orderkey AS VARCHAR), TIMESTAMP '2024-01-05 00:00:00',
    NULL, {t1}, {g1}, 'misp_osint' FROM orders WHERE o_orderkey % 4 = 0
  UNION ALL SELECT '', 'url', '', 'low', concat('u', CAST(o_orderkey AS VARCHAR)), NULL, TIMESTAMP '2024-01-03 00:00:00',
    {t2}, {g2}, 'misp_osint' FROM orders WHERE o_orderkey % 4 = 1"""


@query("b2_threat_events", _EVENT_SQL.format(t1="3", g1="1", t2="1", g2="0"))
def b2_threat_events(t: Tables):
    return _events(t).withColumns({c: F.size(c) for c in ("tags", "galaxies")})


@query("b6_lists_as_text", _EVENT_SQL.format(t1="'t1, t2, t3'", g1="'g1'", t2="'one'", g2="''"))
def b6_lists_as_text(t: Tables):
    rows = _events(t)
    return documents.lists_as_text(rows.unionByName(rows))


_SEARCH_TEXT = """CASE WHEN o_orderkey % 5 = 4 THEN '{"response":{}}' ELSE concat('{"response":{"Attribute":[{"value":"d',
  CAST(o_custkey AS STRING), '.com","type":"hostname","category":"Network","timestamp":"', CASE WHEN o_orderkey % 5 = 0 THEN '1700000000'
  ELSE '2024-01-04 05:06:07' END, '","Tag":[{"name":"b"},{"name":"a"},{"id":1}],"Event":{"id":"', CAST(o_orderkey AS STRING),
  '","Orgc":{"name":"org"},"Tag":[{"name":"a"},{"name":"c"}],"Galaxy":[{"GalaxyCluster":[{"value":"v1"},{"tag_name":"n2"},{"x":1}]},',
  '{"GalaxyCluster":[]}]}}]}}') END"""


@query(
    "b3_attribute_search",
    """SELECT concat('d', CAST(o_custkey AS VARCHAR), '.com') AS indicator, 'hostname' AS type, 'Network' AS category, 'org' AS orgc,
      CAST(o_orderkey AS VARCHAR) AS event_id, CASE WHEN o_orderkey % 5 <> 0 THEN TIMESTAMP '2024-01-04 05:06:07' END AS first_seen,
      CAST(NULL AS TIMESTAMP) AS last_seen, '["a","b","c"]' AS tags, '["v1","n2"]' AS galaxies, 'misp' AS source
    FROM orders WHERE o_orderkey % 5 <> 4""",
)
def b3_attribute_search(t: Tables):
    rows = documents.attribute_search(t.orders.select(F.expr(_SEARCH_TEXT).alias("value")))
    return documents.lists_as_json(rows)


# -- directory listing -------------------------------------------------------------------

_INDEX_TEXT = """concat('<tr><td><a HREF="', CAST(o_orderkey AS STRING), '.json">x</a></td><td align="right">2024-01-05  13:58</td></tr>',
  '<tr><td><a href="/abs/', CAST(o_custkey AS STRING), '.json">x</a></td><td>2024-01-06 01:02:03  </td></tr>',
  '<tr><td><a href="bad', CAST(o_orderkey AS STRING), '.json">x</a></td><td>2024-13-45 01:02</td></tr>',
  '<tr><td><a href="other.txt">x</a></td><td>2024-01-06 01:02</td></tr>')"""


@query(
    "b4_directory_index",
    """SELECT concat('https://feed.example/doc/list/', CAST(o_orderkey AS VARCHAR), '.json') AS url, TIMESTAMP '2024-01-05 13:58:00' AS last_modified FROM orders
    UNION ALL SELECT DISTINCT concat('https://feed.example/abs/', CAST(o_custkey AS VARCHAR), '.json'), TIMESTAMP '2024-01-06 01:02:03' FROM orders""",
)
def b4_directory_index(t: Tables):
    pages = t.orders.select(F.expr(_INDEX_TEXT).alias("value"))
    return documents.directory_index(pages, "https://feed.example/doc/list/")


@query(
    "b5_files_of_day",
    """SELECT * FROM (SELECT concat(CAST(o_orderkey AS VARCHAR), '.json') AS url, o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INT) AS last_modified FROM orders)
    WHERE last_modified >= TIMESTAMP '1998-03-04 21:00:00' AND last_modified < TIMESTAMP '1998-03-06 03:00:00'
    ORDER BY last_modified DESC, url LIMIT 100""",
)
def b5_files_of_day(t: Tables):
    n = F.col("o_orderkey")
    index = t.orders.select(
        F.concat(n.cast("string"), F.lit(".json")).alias("url"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(n % 24).cast("int"))).alias("last_modified"),
    )
    return documents.files_of_day(index, "1998-03-05", newest=100)


# -- registration and address data ------------------------------------------------------------

_RDAP_TEXT = """CASE WHEN o_orderkey % 6 = 4 THEN 'oops' WHEN o_orderkey % 6 = 5 THEN '{}' ELSE concat('{', CASE WHEN o_orderkey % 6 = 0
  THEN concat('"registrar":{"name":"', o_orderpriority, '"},') ELSE '' END,
  '"entities":[{"roles":["abuse"],"vcardArray":["vcard",[["fn",{},"text","no"]]]},{"roles":["registrar"],"vcardArray":["vcard",[["version",{},"text","4.0"],["fn",{},"text","',
  o_orderstatus, '"]]]}],"status":["active","locked"],"events":[{"eventAction":"registration","eventDate":"2001-01-01T00:00:00Z"},',
  '{"eventAction":"registration","eventDate":"2002-02-02T00:00:00Z"},{"eventAction":"', CASE WHEN o_orderkey % 2 = 0 THEN 'expire' ELSE 'expiration' END,
  '","eventDate":"2030-03-03T00:00:00Z"},{"eventAction":"last changed","eventDate":"2031-01-01T00:00:00Z"}]}') END"""


@query(
    "b7_whois_documents",
    """SELECT concat('d', CAST(o_orderkey AS VARCHAR), '.com') AS domain,
      CASE k WHEN 0 THEN o_orderpriority WHEN 3 THEN o_orderstatus END AS registrar,
      CASE WHEN k IN (0, 3) THEN 'active,locked' WHEN k = 1 THEN 'not_found' END AS status,
      CASE WHEN k IN (0, 3) THEN TIMESTAMP '2002-02-02 00:00:00' END AS created,
      CASE WHEN k IN (0, 3) THEN TIMESTAMP '2030-03-03 00:00:00' END AS expires,
      CASE k WHEN 2 THEN 'http status 503' WHEN 4 THEN 'response is not JSON' END AS error,
      k IN (0, 3, 5) AS has_raw
    FROM (SELECT *, o_orderkey % 6 AS k FROM orders)""",
)
def b7_whois_documents(t: Tables):
    k = F.col("o_orderkey") % 6
    status = F.when(k == 1, 404).when(k == 2, 503).otherwise(200)
    responses = t.orders.select(
        F.concat(F.lit("d"), F.col("o_orderkey").cast("string"), F.lit(".com")).alias("domain"),
        status.alias("http_status"),
        F.expr(_RDAP_TEXT).alias("body"),
        F.lit(None).cast("string").alias("error"),
        now().alias("fetched_at"),
    )
    rows = documents.whois_rows(responses)
    return rows.withColumn("has_raw", F.col("raw").isNotNull()).drop("raw", "fetched_at")


_BATCH_TEXT = """concat('{"status":"', CASE WHEN c_custkey % 7 = 0 THEN 'fail' ELSE 'success' END, '","country":"A","regionName":"R","city":"C","lat":1.5,"lon":-2.25,"as":"AS',
  CAST(c_custkey AS STRING), ' Some Net","asname":"SN","isp":"I","org":"O","reverse":"r.example","proxy":false,"hosting":true}')"""
_SINGLE_TEXT = """concat('{"country":"B","region":"R2","city":"C2","loc":"3.5,4.25","org":"AS', CAST(c_custkey AS STRING), ' Net","hostname":"h.example"}')"""
_BASE_TEXT = """concat('{"country":{"name":"M"},"subdivision":{"name":"S"},"city":{"name":"T"},"location":{"latitude":5.5,"longitude":0.0},"autonomous_system_number":',
  CAST(c_custkey AS STRING), ',"autonomous_system_organization":"Own"}')"""


@query(
    "b8_geo_documents",
    """SELECT ip, CASE p WHEN 2 THEN CASE WHEN c_custkey % 7 <> 0 THEN 'A' END WHEN 1 THEN 'B' ELSE 'M' END AS country,
      CASE p WHEN 2 THEN CASE WHEN c_custkey % 7 <> 0 THEN 'R' END WHEN 1 THEN 'R2' ELSE 'S' END AS region,
      CASE p WHEN 2 THEN CASE WHEN c_custkey % 7 <> 0 THEN 1.5 END WHEN 1 THEN 3.5 ELSE 5.5 END AS lat,
      CASE p WHEN 2 THEN CASE WHEN c_custkey % 7 <> 0 THEN -2.25 END WHEN 1 THEN 4.25 END AS lon,
      CASE WHEN p < 2 OR c_custkey % 7 <> 0 THEN concat('AS', CAST(c_custkey AS VARCHAR)) END AS asn,
      CASE p WHEN 2 THEN CASE WHEN c_custkey % 7 <> 0 THEN 'SN' END WHEN 1 THEN concat('AS', CAST(c_custkey AS VARCHAR), ' Net') ELSE 'Own' END AS asn_name,
      CASE p WHEN 2 THEN CASE WHEN c_custkey % 7 <> 0 THEN 'r.example' END WHEN 1 THEN 'h.example' END AS reverse,
      CASE WHEN p = 2 AND c_custkey % 7 <> 0 THEN true END AS hosting
    FROM (SELECT c_custkey, concat('ip', CAST(c_custkey AS VARCHAR)) AS ip, CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS p FROM customer)""",
)
def b8_geo_documents(t: Tables):
    """The batch service answers for all addresses, the others for some and take precedence."""
    n = F.col("c_custkey")
    ip = F.concat(F.lit("ip"), n.cast("string")).alias("ip")
    parts = [
        t.customer.filter(cond).select(ip, F.lit(name).alias("provider"), F.expr(text).alias("value"))
        for name, cond, text in [
            ("ip_api", n >= 0, _BATCH_TEXT), ("ipinfo_lite", n % 2 == 0, _SINGLE_TEXT), ("maxmind", n % 3 == 0, _BASE_TEXT),
        ]
    ]
    rows = documents.geo_rows(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return rows.select("ip", "country", "region", "lat", "lon", "asn", "asn_name", "reverse", "hosting")


@query(
    "b8_ct_geo_documents",
    """SELECT concat('ip', CAST(c_custkey AS VARCHAR)) AS ip, CASE WHEN ok THEN 'A' END AS country,
      CASE WHEN ok THEN concat('AS', CAST(c_custkey AS VARCHAR), ' Some Net') END AS asn, CASE WHEN ok THEN 'SN' END AS asname,
      CASE WHEN ok THEN 'O' END AS org FROM (SELECT c_custkey, c_custkey % 7 <> 0 AS ok FROM customer)""",
)
def b8_ct_geo_documents(t: Tables):
    ip = F.concat(F.lit("ip"), F.col("c_custkey").cast("string")).alias("ip")
    return documents.ct_geo_rows(t.customer.select(ip, F.expr(_BATCH_TEXT).alias("value")))


@query("q11_type_filter", "SELECT event_id, type, indicator FROM misp_attr WHERE type IN ('domain', 'hostname', 'url')")
def q11_type_filter(t: Tables):
    return layers.of_type(t.misp_attr, *layers.NAME_TYPES).select("event_id", "type", "indicator")


@query("i4_tag_union", """SELECT event_id, concat_ws(',', CASE WHEN event_type < 'f' THEN concat(event_type, ',f') ELSE CASE WHEN event_type = 'f' THEN 'f' ELSE concat('f,', event_type) END END) AS tags FROM events""")
def i4_tag_union(t: Tables):
    own = F.array("event_type", F.lit("f"), "event_type")
    return t.events.select("event_id", F.array_join(F.array_sort(F.array_union(own, F.array(F.lit("f")))), ",").alias("tags"))
