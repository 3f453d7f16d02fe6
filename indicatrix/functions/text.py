"""String functions over URLs and domain names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that mark a domain as suspicious.
SUSPICIOUS_WORDS = [
    "login", "secure", "update", "verify", "account", "password", "signin",
    "pay", "paypal", "bank", "office", "microsoft", "apple", "support",
    "delivery", "package", "post", "dhl", "ups",
]
# Fixed value: the characters a certificate name may hold.
DOMAIN_CHARS = r"^[A-Za-z0-9\-\._*]+$"
# The order of the lexical features in the feature vector.
LEXICAL_FEATURES = [
    "len", "digits", "hyphens", "dots", "digit_ratio", "hyphen_ratio",
    "entropy", "xn_punycode", "labels", "tld_len",
]


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def url_host(url: Column) -> Column:
    """Lower-case host of a URL, without user info and port; NULL if there is none.

    ``parse_url`` rejects underscores, blanks and non-ASCII hosts, which real
    feeds hold, so the host is cut out by a pattern.
    """
    text = strip(url)
    full = F.when(text.rlike(r"^https?://"), text).otherwise(F.concat(F.lit("http://"), text))
    host = F.regexp_extract(full, r"^https?://(?:[^/?#]*@)?(\[[^\]]*\]|[^:/?#]*)", 1)
    return F.nullif(F.lower(F.translate(host, "[]", "")), F.lit(""))


def indicator_host(indicator: Column) -> Column:
    """Host part of an indicator that may be a bare name, a host with port or a URL."""
    text = F.lower(strip(indicator))
    rest = F.regexp_replace(text, r"^(?:[a-z][a-z0-9+.\-]*:)?//", "")
    netloc = F.regexp_extract(rest, r"^(?:[^/?#]*@)?(\[[^\]]*\]|[^:/?#]*)", 1)
    return F.regexp_replace(netloc, r"\.+$", "")


def clean_domain(name: Column) -> Column:
    """Trimmed, lower-case name without trailing dots and one leading wildcard label."""
    base = F.regexp_replace(F.lower(strip(F.coalesce(name, F.lit("")))), r"\.+$", "")
    return F.regexp_replace(base, r"^\*\.", "")


def clean_domain_anywhere(name: Column) -> Column:
    """As ``clean_domain``, but wildcard labels are removed wherever they stand."""
    base = F.regexp_replace(strip(F.lower(name)), r"\.+$", "")
    return F.replace(base, F.lit("*."), F.lit(""))


def has_domain_chars(name: Column) -> Column:
    return name.rlike(DOMAIN_CHARS)


def last_label(name: Column, missing: str | None = None) -> Column:
    """The label behind the last dot; ``missing`` for names without a dot."""
    return F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1)).otherwise(F.lit(missing))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits; 0 for NULL and empty text."""
    size = F.length(text)

    def share(char: Column) -> Column:
        p = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return -p * F.log2(p)

    bits = F.aggregate(
        F.transform(F.array_distinct(F.split(text, "")), share), F.lit(0.0), lambda acc, x: acc + x
    )
    return F.when(size > 0, bits).otherwise(F.lit(0.0))


def count_of(text: Column, part: str) -> Column:
    """How often a one-character ``part`` stands in the text."""
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def lexical_features(name: Column) -> dict[str, Column]:
    """The ten lexical features of a domain name, keyed and ordered by feature name."""
    d = F.coalesce(name, F.lit(""))
    size = F.length(d)
    digits = F.regexp_count(d, F.lit(r"\p{Nd}"))
    hyphens = count_of(d, "-")
    values = {
        "len": size,
        "digits": digits,
        "hyphens": hyphens,
        "dots": count_of(d, "."),
        "digit_ratio": digits / (size + F.lit(1e-6)),
        "hyphen_ratio": hyphens / (size + F.lit(1e-6)),
        "entropy": entropy(d),
        "xn_punycode": F.contains(d, F.lit("xn--")).cast("int"),
        "labels": F.size(F.filter(F.split(d, r"\."), lambda p: p != "")),
        "tld_len": F.length(F.substring_index(d, ".", -1)),
    }
    return {key: values[key].alias(key) for key in LEXICAL_FEATURES}


def has_suspicious_word(name: Column) -> Column:
    return F.lower(F.coalesce(name, F.lit(""))).rlike("|".join(SUSPICIOUS_WORDS))


def char_ngrams(text: Column, shortest: int = 3, longest: int = 5) -> Column:
    """All character n-grams of the lower-case text, as an array, repeats kept.

    ``sequence`` counts downwards when its end lies before its start, so
    lengths that do not fit are dropped first.
    """
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " ")
    size = F.length(t)
    fitting = F.filter(F.array(*[F.lit(n) for n in range(shortest, longest + 1)]), lambda n: n <= size)
    return F.flatten(
        F.transform(
            fitting,
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(t, i, n)),
        )
    )


def shorten(name: Column, width: int = 40) -> Column:
    return F.when(F.length(name) <= width, name).otherwise(
        F.concat(F.substring(name, 1, width), F.lit("..."))
    )


def percent(value: Column, total: Column) -> Column:
    """Share as text with one decimal; ``0%`` when the total is 0."""
    # Rounding happens in decimals so that halves go the same way everywhere.
    share = (value * 100 / F.nullif(total.cast("double"), F.lit(0.0))).cast("decimal(20,6)")
    return F.when(total == 0, F.lit("0%")).otherwise(
        F.concat(F.round(share, 1).cast("decimal(20,1)").cast("string"), F.lit("%"))
    )
