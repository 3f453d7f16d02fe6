import json

from pyspark.sql import functions as F

from indicatrix.sources import documents
from tests.conftest import rows


def texts(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) or d is None else json.dumps(d),) for d in docs], "value string")


def test_ct_messages(spark):
    docs = texts(
        spark, {"data": {"leaf_cert": {"all_domains": ["*.A.com.", "b c", "", "*.*.d.org", "noDot", "ü.de"]}}},
        {"data": {"leaf_cert": {"all_domains": None}}}, {"data": None}, "{broken", None, {},
    ).withColumn("t", F.lit("2024-01-01 00:00:01.234567").cast("timestamp"))
    got = rows(documents.ct_events(docs, "t"), "id", "domain", "tld", "event_ts")
    stamp = "2024-01-01T00:00:01Z"
    mark = docs.select(F.substring(F.md5("value"), 1, 16)).first()[0]
    assert got == [
        (f"ct-1704067201234-0-{mark}", "a.com", "com", stamp), (f"ct-1704067201234-3-{mark}", "*.d.org", "org", stamp), (f"ct-1704067201234-4-{mark}", "nodot", None, stamp),
    ]
    assert len(rows(documents.ct_events(docs, "t", every_n=3))) == 2


def test_messages_of_one_millisecond_keep_their_ids(spark):
    docs = texts(spark, *({"data": {"leaf_cert": {"all_domains": [d]}}} for d in ("a.com", "b.org"))).withColumn("t", F.lit("2024-01-01 00:00:01").cast("timestamp"))
    assert documents.ct_events(docs, "t").select("id").distinct().count() == 2


def test_threat_event_forms(spark):
    wrapped = {"Event": {"id": "1", "uuid": "u", "date": "2024-01-05", "Orgc": {"name": "o"}, "Tag": [{"name": "a"}, "b", {"Name": "c"}, {"name": ""}, 5],
                         "Galaxy": [{"name": "g"}, "text", {"name": ""}], "Attribute": [
                             {"value": "x.com", "type": "domain", "category": "c", "first_seen": "", "last_seen": "2024-01-07 01:00:00"},
                             {"Value": "y", "Type": "url", "Category": "d", "first_seen": "bad"}, {}]}}
    bare = {"uuid": "u2", "orgc": {"name": "low"}, "tags": ["t"], "attributes": [{"value": 5, "type": "domain"}]}
    got = {(r["event_id"], r["indicator"]): r.asDict() for r in documents.threat_events(texts(spark, wrapped, bare, {"Event": {}}, "{x", None)).collect()}
    assert set(got) == {("1", "x.com"), ("1", "y"), ("1", ""), ("u2", "5")}
    first = got["1", "x.com"]
    assert (first["orgc"], first["tags"], first["galaxies"], str(first["first_seen"]), str(first["last_seen"])) == (
        "o", ["a", "b", "c"], ["g"], "2024-01-05 00:00:00", "2024-01-07 01:00:00")
    assert got["1", "y"]["type"] == "url" and got["1", "y"]["first_seen"] is None
    assert got["u2", "5"]["orgc"] == "low" and got["u2", "5"]["tags"] == ["t"] and got["u2", "5"]["first_seen"] is None


def test_lists_as_text(spark):
    events = documents.threat_events(texts(spark, {"id": "1", "Tag": ["a", "b"], "Attribute": [{"value": "x"}, {"value": "x"}, {"value": "y"}]}))
    assert rows(documents.lists_as_text(events), "indicator", "tags", "galaxies") == [("x", "a, b", ""), ("y", "a, b", "")]


def test_attribute_search(spark):
    doc = {"response": {"Attribute": [
        {"value": "x.com", "type": "domain", "first_seen": "2024-01-01 00:00:00", "timestamp": "1", "Tag": [{"name": "b"}, {"x": 1}],
         "Event": {"id": 7, "Orgc": {"name": "o"}, "Tag": [{"name": "a"}, {"name": "b"}], "Galaxy": [{"GalaxyCluster": [{"value": "v", "tag_name": "n"}, {"value": "", "tag_name": "m"}]}, {}]}},
        {"value": "y.com", "timestamp": "1700000000"}]}}
    got = {r["indicator"]: r for r in documents.attribute_search(texts(spark, doc, {"response": {}}, "[]")).collect()}
    x, y = got["x.com"], got["y.com"]
    assert (x["event_id"], x["tags"], x["galaxies"], str(x["first_seen"])) == ("7", ["a", "b"], ["v", "m"], "2024-01-01 00:00:00")
    assert (y["orgc"], y["tags"], y["galaxies"], y["first_seen"]) == (None, [], [], None)


def test_directory_index(spark):
    page = """<a href="a.json">a.json</a></td><td align="right">2024-01-05 13:58  </td>
    <a HREF="/x/b.json">b</a></TD><TD>2024-01-05
    13:58:09</td> <a href="https://other/c.json">c</a></td><td>2024-02-31 10:00</td> <a href="https://other/d.json">d</a></td><td>2024-01-06 10:00</td>
    <a href="a.json">again</a></td><td>2024-01-09 13:58</td> <a href="e.html">e</a></td><td>2024-01-09 13:58</td>"""
    got = [(u, str(t)) for u, t in rows(documents.directory_index(texts(spark, page), "https://h.example/doc/feed/"), "url", "last_modified")]
    assert got == [
        ("https://h.example/doc/feed/a.json", "2024-01-05 13:58:00"), ("https://h.example/x/b.json", "2024-01-05 13:58:09"), ("https://other/d.json", "2024-01-06 10:00:00"),
    ]


def test_directory_index_with_far_columns(spark):
    page = "<tr><td><a href='a.json'>a</a></td><td>" + "x" * 1000 + "</td><td> 2024-01-05 13:58</td></tr><tr><td><a href='b.json'>b</a></td><td>-</td></tr>"
    assert [r[0] for r in rows(documents.directory_index(texts(spark, page), "https://h/f/"), "url")] == ["https://h/f/a.json"]


def test_files_of_day_window(spark):
    times = ["2024-01-04 20:59:59", "2024-01-04 21:00:00", "2024-01-05 12:00:00", "2024-01-06 02:59:59", "2024-01-06 03:00:00"]
    index = spark.createDataFrame([(f"{i}", t) for i, t in enumerate(times)], "url string, last_modified string").withColumn("last_modified", F.col("last_modified").cast("timestamp"))
    assert rows(documents.files_of_day(index, "2024-01-05"), "url") == [("1",), ("2",), ("3",)]
    assert rows(documents.files_of_day(index, "2024-01-05", newest=1), "url") == [("3",)]


def test_whois_documents(spark):
    def entity(*roles, items):
        return {"roles": list(roles), "vcardArray": ["vcard", items]}

    bodies = {
        "top": (200, {"registrar": {"name": "Top"}, "entities": [entity("registrar", items=[["fn", {}, "text", "Ent"]])], "status": []}),
        "entity": (200, {"entities": [entity("abuse", items=[["fn", {}, "text", "No"]]), entity("tech", "registrar", items=[["org", {}, "t", "x"], ["fn", {}, "text", "Ent"]])], "status": ["a", "b"]}),
        "odd": (200, {"registrar": "text", "entities": [{"roles": ["registrar"], "vcardArray": ["vcard"]}, {"roles": None}],
                      "events": [{"eventAction": "expiration", "eventDate": "2030-01-01T00:00:00Z"}, {"eventAction": "expire", "eventDate": "junk"}]}),
        "gone": (404, "whatever"),
        "down": (503, "oops"),
        "html": (200, "<html>"),
    }
    data = [(d, s, b if isinstance(b, str) else json.dumps(b), None) for d, (s, b) in bodies.items()] + [("fail", None, None, "timed out")]
    df = spark.createDataFrame(data, "domain string, http_status int, body string, error string").withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp"))
    got = {r["domain"]: (r["registrar"], r["status"], r["expires"], r["error"]) for r in documents.whois_rows(df).collect()}
    assert got == {
        "top": ("Top", None, None, None), "entity": ("Ent", "a,b", None, None), "odd": (None, None, None, None), "gone": (None, "not_found", None, None),
        "down": (None, None, None, "http status 503"), "html": (None, None, None, "response is not JSON"), "fail": (None, None, None, "timed out"),
    }


def test_long_raw_documents_are_cut(spark):
    body = json.dumps({"x": "y" * 300_000})
    df = spark.createDataFrame([("d", 200, body, None)], "domain string, http_status int, body string, error string").withColumn("fetched_at", F.current_timestamp())
    assert documents.whois_rows(df).select(F.length("raw") == F.length(F.lit(df.first()["body"]))).first()[0]
    assert documents.whois_rows(df, raw_chars=10).select(F.length("raw")).first()[0] == 10


def test_geo_layouts(spark):
    data = [
        ("1", "ip_api", {"status": "success", "country": "A", "as": "AS5 Five Net", "lat": 1, "proxy": True}),
        ("2", "ip_api", {"status": "fail", "country": "A"}), ("3", "ip_api", {"status": "success", "as": ""}),
        ("4", "ipinfo_lite", {"country": "B", "loc": "1.5,x", "org": "AS6 Six"}), ("5", "ipinfo_lite", {}),
        ("6", "maxmind", {"country": {"name": "C"}, "location": {"latitude": 0, "longitude": 2}, "autonomous_system_number": 7}),
        ("6", "ip_api", {"status": "success", "country": "Z"}), ("7", "other", {}),
    ]
    df = spark.createDataFrame([(i, p, json.dumps(v)) for i, p, v in data], "ip string, provider string, value string")
    got = {r["ip"]: (r["country"], r["asn"], r["lat"], r["lon"], r["proxy"]) for r in documents.geo_rows(df).collect()}
    assert got == {
        "1": ("A", "AS5", 1.0, None, True), "2": (None, None, None, None, None), "3": (None, None, None, None, None), "4": ("B", "AS6", 1.5, None, None),
        "5": ("", "", None, None, None), "6": ("C", "AS7", None, 2.0, None),
    }
