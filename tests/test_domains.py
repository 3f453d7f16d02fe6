from pyspark.sql import functions as F

from indicatrix.functions import domains
from tests.conftest import rows

# Host -> (public suffix, registered domain), after the list's published examples.
EXAMPLES = {
    "com": ("com", ""),
    "example.com": ("com", "example.com"),
    "b.Example.COM": ("com", "example.com"),
    "example.nosuchtld": ("", ""),
    "uk.com": ("com", "uk.com"),
    "co.uk": ("co.uk", ""),
    "a.b.example.co.uk": ("co.uk", "example.co.uk"),
    "c.ck": ("c.ck", ""),
    "b.c.ck": ("c.ck", "b.c.ck"),
    "www.ck": ("ck", "www.ck"),
    "www.www.ck": ("ck", "www.ck"),
    "ide.kyoto.jp": ("ide.kyoto.jp", ""),
    "a.b.ide.kyoto.jp": ("ide.kyoto.jp", "b.ide.kyoto.jp"),
    "c.kobe.jp": ("c.kobe.jp", ""),
    "city.kobe.jp": ("kobe.jp", "city.kobe.jp"),
    "pub-1.r2.dev": ("dev", "r2.dev"),
    "食狮.公司.cn": ("公司.cn", "食狮.公司.cn"),
    "xn--85x722f.xn--55qx5d.cn": ("xn--55qx5d.cn", "xn--85x722f.xn--55qx5d.cn"),
    "https://u:p@www.example.co.uk:8443/a/b?c": ("co.uk", "example.co.uk"),
    "example.com.": ("com", "example.com"),
    "10.0.0.1": ("", ""),
    "http://10.0.0.1:80/x": ("", ""),
    "2001:db8::1": ("", ""),
    "http://[2001:db8::1]/": ("", ""),
    "localhost": ("", ""),
    "": ("", ""),
    None: ("", ""),
}


def test_published_examples(table):
    df = table([(i, h) for i, h in enumerate(EXAMPLES)], "i int, host string")
    found = domains.with_registered_domain(df, "host", "suffix").orderBy("i").collect()
    got = {r["host"]: (r["suffix"], r["registered_domain"]) for r in found}
    assert got == EXAMPLES
    assert found[0].asDict().keys() == {"i", "host", "suffix", "registered_domain"}


def test_private_section_on_request(table):
    df = table([("a.b.github.io",)], "host string")
    assert rows(domains.with_registered_domain(df, "host", private=True), "registered_domain") == [("b.github.io",)]


def test_lookup_does_not_shuffle_rows(table):
    df = table([("a.com",)], "host string")
    plan = domains.with_registered_domain(df, "host")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_punycode(table):
    names = ["plain.com", "münchen.de", "日本.jp", "x" * 70 + "é.com", "", None]
    df = domains.with_punycode(table([(n,) for n in names], "name string"), "name")
    got = {r["name"]: r["puny_domain"] for r in df.collect()}
    assert got == {
        "plain.com": "plain.com", "münchen.de": "xn--mnchen-3ya.de", "日本.jp": "xn--wgv71a.jp",
        "x" * 70 + "é.com": "x" * 70 + "é.com", "": "", None: None,
    }
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and plan.count("Scan") == 1
