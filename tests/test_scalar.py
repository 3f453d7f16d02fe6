import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from indicatrix.functions import buckets, ip, text, times

X = F.col("x")


def test_url_host(values):
    cases = {
        "http://61.52.158.73:59538/i": "61.52.158.73",
        "https://User:p@w@A_b.Example.COM:8080/p?q#f": "a_b.example.com",
        "no-scheme.example/path": "no-scheme.example",
        "http://[2001:DB8::1]:80/x": "2001:db8::1",
        "  http://blank.example/a b|c ": "blank.example",
        "HTTP://upper.example/": "http",
        "http://münchen.example/": "münchen.example",
        "http://?x": None,
        "": None,
        None: None,
    }
    assert values(list(cases), text.url_host(X)) == list(cases.values())


def test_clean_domain(values):
    cases = {
        " *.Shop.Example.com.. ": ("shop.example.com", "shop.example.com"),
        "www.*.x.com": ("www.*.x.com", "www.x.com"),
        "*.*.x.com": ("*.x.com", "x.com"),
        "\tplain.com\n": ("plain.com", "plain.com"),
        "": ("", ""),
    }
    assert values(list(cases), text.clean_domain(X)) == [v[0] for v in cases.values()]
    assert values(list(cases), text.clean_domain_anywhere(X)) == [v[1] for v in cases.values()]
    assert values([None], text.clean_domain(X)) == [""]


def test_domain_chars_and_last_label(values):
    assert values(["a-b_c.*.com", "a b", "é.com", ""], text.has_domain_chars(X)) == [True, False, False, False]
    assert values(["a.b.com", "host", "", None], text.last_label(X)) == ["com", None, None, None]
    assert values(["a.b.com", "host", None], text.last_label(X, "")) == ["com", "", ""]


def python_entropy(s):
    return -sum(v / len(s) * math.log2(v / len(s)) for v in Counter(s).values()) if s else 0.0


def test_entropy(values):
    names = ["aab.com", "aaaa", "a", "", None, "xn--mnchen-3ya.example", "日本.jp"]
    got = values(names, text.entropy(X))
    assert got == pytest.approx([python_entropy(n or "") for n in names], abs=1e-12)
    assert round(got[0], 4) == 2.5216


def test_lexical_features(spark, table):
    names = ["a-1.xn--p..com", "", None, "12.34", "no-dots"]
    found = table([(n,) for n in names], "x string").select(*text.lexical_features(X).values()).collect()
    for name, row in zip(names, found):
        d = name or ""
        digits, hyphens = sum(c.isdigit() for c in d), d.count("-")
        want = [
            len(d), digits, hyphens, d.count("."), digits / (len(d) + 1e-6), hyphens / (len(d) + 1e-6),
            python_entropy(d), int("xn--" in d), len([p for p in d.split(".") if p]), len(d.split(".")[-1]),
        ]
        assert list(row) == pytest.approx(want), name


def test_char_ngrams(values):
    def grams(s):
        return [s[i : i + n] for n in (3, 4, 5) for i in range(len(s) - n + 1)]

    names = ["", "a", "ab", "abc", "ABCD", "abc.com", "日本語.jp"]
    assert values(names, text.char_ngrams(X)) == [grams(n.lower()) for n in names]
    assert values([None], text.char_ngrams(X)) == [[]]


def test_words_and_display(values):
    assert values(["MyLOGIN.com", "cups.org", "plain.net", None], text.has_suspicious_word(X)) == [True, True, False, False]
    assert values(["a" * 40, "a" * 41], text.shorten(X)) == ["a" * 40, "a" * 40 + "..."]
    assert values([0, 1, 2, 3], text.percent(X, F.lit(3)), "int") == ["0.0%", "33.3%", "66.7%", "100.0%"]
    assert values([5], text.percent(X, F.lit(0)), "int") == ["0%"]


def test_score_classes_at_their_limits(values):
    scores = [0.0, 0.2, 0.3, 0.5, 0.6, 0.75, 0.8, 0.9, 1.0]
    assert values(scores, buckets.risk_level(X), "double") == (
        ["LOW"] + ["MEDIUM"] * 3 + ["HIGH"] * 3 + ["CRITICAL"] * 2
    )
    assert values(scores, buckets.risk_bucket(X), "double") == (
        ["low", "low", "medium", "medium", "high", "high", "high", "critical", "critical"]
    )
    assert values([-0.1, 1.1], buckets.risk_bucket(X), "double") == [None, None]
    assert values(scores, buckets.display_tier(X), "double") == (
        ["green", "green", "yellow", "orange", "orange"] + ["red"] * 4
    )


def test_count_and_age_classes(values):
    counts = [None, 0, 1, 2, 3, 4, 10, 11]
    rest = ["ips:0", "ips:1", "ips:2-3", "ips:2-3", "ips:4-10", "ips:4-10", "ips:>10"]
    assert values(counts, buckets.ip_count_bucket(X), "int") == ["ips:0", *rest]
    assert values(counts, buckets.ip_count_bucket(X, "ips:none"), "int") == ["ips:none", *rest]
    ages = [None, 6.9, 7.0, 29.9, 30.0, 179.9, 180.0, 364.9, 365.0]
    assert values(ages, buckets.age_bucket(X), "double") == [
        "age:unknown", "age:<7d", "age:7-30d", "age:7-30d", "age:30-180d", "age:30-180d", "age:180-365d", "age:180-365d", "age:>365d",
    ]
    assert values([0, 10, 11, 20, 21, 30, 31], buckets.length_bucket(X), "int") == [
        "len:<=10", "len:<=10", "len:11-20", "len:11-20", "len:21-30", "len:21-30", "len:>30",
    ]
    assert values([0.0, 0.1, 0.11, 0.3, 0.31], buckets.digit_bucket(X), "double") == [
        "digits:<10%", "digits:<10%", "digits:10-30%", "digits:10-30%", "digits:>30%",
    ]
    assert values([0.0, 2.5, 2.6, 3.5, 3.6], buckets.entropy_bucket(X), "double") == [
        "entropy:low", "entropy:low", "entropy:med", "entropy:med", "entropy:high",
    ]


def test_intensity_class(values):
    got = values([0, 1, 2, 3, 9, 10], buckets.intensity_class(X, F.lit(4)), "bigint")
    assert got == [None, 0, 0, 1, 7, 7]


def test_threat_type(values):
    assert values(["URLhaus", "openphish", "misp_osint", "seed"], buckets.threat_type(X)) == [
        "malware", "phishing", "malware", "suspicious",
    ]


def test_ip_family(values):
    cases = {
        "1.2.3.4": 4, "256.1.1.1": None, "1.2.3": None, "01.2.3.4": None, "::": 6, "::1": 6, "2001:db8::1": 6, "1::": 6,
        "1:2:3:4:5:6:7:8": 6, "1:2:3:4:5:6:7": None, "a::b::c": None, "::ffff:1.2.3.4": 6, "host": None, ":1": None, None: None,
    }
    assert values(list(cases), ip.ip_family(X)) == list(cases.values())
    assert values(list(cases), ip.ipv6_flag(X)) == [int(v == 6) for v in cases.values()]
    assert values(["0.0.0.0", "255.255.255.255", "1.2.3.4", "x"], ip.ipv4_number(X)) == [0, 2**32 - 1, 16909060, None]


def test_times(values):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    texts = ["2024-01-01", "2024-01-01T10:00:00+02:00", "junk", None]
    assert [str(v) for v in values(texts, times.utc_or(X, now))] == [
        "2024-01-01 00:00:00", "2024-01-01 08:00:00", "2024-02-01 00:00:00", "2024-02-01 00:00:00",
    ]
    assert values(["2024-01-31 23:59:58.1"], times.seconds_between(now, X.cast("timestamp"))) == [1.9]
    assert values(["2024-01-31 12:00:00"], times.days_between(now, X.cast("timestamp"))) == [0.5]
    stamps = ["2024-01-31 00:00:00", "2024-01-31 01:02:03.5"]
    assert values(stamps, times.iso_text(X.cast("timestamp"))) == ["2024-01-31 00:00:00+00:00", "2024-01-31 01:02:03.500000+00:00"]
