"""Secrets in texts: three fixed patterns, and a battery of randomness tests for everything they miss. Expressions only.

Candidates are runs of 20 or more characters of the base64 and URL alphabets that hold a letter and a digit. Each gets the
smallest alphabet that fits it (hex, base32, base62, base64). Three tests ask whether it can be ordinary writing or numbering
in that alphabet, and each gives the probability that such writing looks at least so random:

* chi-squared uniformity: writing uses letters unevenly, so its chi-squared value is far above that of random text; the
  value is set against a noncentral chi-squared law whose noncentrality grows with the length;
* runs: writing seldom changes between letter cases and digits; the number of runs is set against a binomial law;
* serial correlation: codes of neighbours in writing and numbering are correlated; the lag-one coefficient of the
  alphabet's indexes is set against its normal law around a correlated mean.

The three normal scores are combined (Stouffer). Short candidates cannot reach a small combined probability, since the
chi-squared and serial terms grow with length. The Benjamini-Hochberg rule then bounds the share of false discoveries at
``fdr`` within each class of lengths, over all candidates of the corpus. It needs ranks; they are taken from counts per
class and hundredth of a unit of -log10 p, a table of fixed size, which rounds against discovery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The patterns of the base kinds and the length that a match, or its second group, must have.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
LONG_HEX = "(?<![0-9a-f])[0-9a-f]{%d,}" % HEX_LEAST  # the matches of [0-9a-f]+ that are long enough

KINDS = ("assign", "access", "hex", "random")
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
INDEX = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/-_="
LENGTH_CLASSES = (24, 32, 48, 64, 128)
STEPS = 100  # per unit of -log10 p
TOP = 30 * STEPS

# The writing that the tests take as their null: excess of the index of coincidence over a uniform alphabet, as a multiple
# of 1 / alphabet size; share of neighbours of different classes; lag-one correlation.
EXCESS, CHANGES, CORRELATION = 0.9, 0.2, 0.45


SPANS = "array<struct<start:int,kind:int,end:int>>"


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def none_of(kind: str) -> Column:
    return F.array().cast(kind)


def located(text: Column, pattern: str, found: Column, kind: str) -> Column:
    """Sorted spans of the matches ``found``, from the lengths of matches and of the pieces between them."""

    def next_span(done, x):
        start = done["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + x["size"]).alias("end"))
        return F.struct((start + x["size"]).alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def spans(pieces):
        steps = F.zip_with(found, pieces, lambda m, p: F.struct(F.length(p).alias("gap"), F.length(m).alias("size")))
        start = F.struct(F.lit(0).alias("at"), none_of(SPANS).alias("spans"))
        return F.aggregate(steps, start, next_span, lambda done: done["spans"])

    return F.when(F.size(found) > 0, bound(F.slice(F.split(text, pattern, -1), 1, F.size(found)), spans)).otherwise(none_of(SPANS))


def of_length(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: s["end"] - s["start"] >= least)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def with_base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_body`` (the text, null as empty) and ``_base``, the spans of the three patterns by start, then kind."""
    body = F.col("_body")
    some = lambda test, found: F.when(test, found).otherwise(none_of("array<string>"))
    out = docs.withColumn("_body", F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = out.withColumns(
        {
            "_values": matches(body, ASSIGN, 2),
            "_accessed": some(body.contains("AKIA"), matches(body, ACCESS)),
            "_hexed": matches(body, LONG_HEX),
        }
    )
    out = out.withColumn("_assigned", some(F.size("_values") > 0, matches(body, ASSIGN)))
    assigned = F.zip_with(
        located(body, ASSIGN, F.col("_assigned"), "assign"), F.col("_values"), lambda s, v: F.when(F.length(v) >= ASSIGN_LEAST, s)
    )
    spans = F.concat(
        F.filter(assigned, lambda s: s.isNotNull()),
        of_length(located(body, ACCESS, F.col("_accessed"), "access"), ACCESS_LEAST),
        located(body, LONG_HEX, F.col("_hexed"), "hex"),
    )
    return out.withColumn("_base", F.sort_array(spans)).drop("_values", "_accessed", "_hexed", "_assigned")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def normal_below(z: Column) -> Column:
    """Probability that a standard normal value is below z: a logistic form, and a series in the lower tail."""

    def below(x):
        near = 1 / (1 + F.exp(-(1.5976 * x + 0.070565992 * x * x * x)))
        t = F.greatest(F.least(x, F.lit(-2.5)), F.lit(-30.0))
        tail = F.exp(-t * t / 2) / (-t * 2.5066282746310002) * (1 - 1 / (t * t) + 3 / (t * t * t * t))
        return F.when(x < -2.5, tail).when(x > 6, F.lit(1.0)).otherwise(near)

    return bound(z, below)


LETTERS = "abcdefghijklmnopqrstuvwxyz"
CLASSES_FROM = LETTERS + LETTERS.upper() + "0123456789" + "+/-_="
CLASSES_TO = "a" * 26 + "A" * 26 + "0" * 10 + "+" * 5


def alphabet_size(token: Column) -> Column:
    """Size of the smallest alphabet that fits: hex, base32, one-case alphanumeric, base62, base64."""
    sizes = (
        ("^([0-9a-f]+|[0-9A-F]+)$", 16),
        ("^[A-Z2-7]+=*$", 32),
        ("^([0-9a-z]+|[0-9A-Z]+)$", 36),
        ("^[0-9A-Za-z]+$", 62),
    )
    out = F.lit(64)
    for pattern, size in reversed(sizes):
        out = F.when(token.rlike(pattern), F.lit(size)).otherwise(out)
    return out.cast("double")


def uniformity(token: Column, chars: Column, n: Column, size: Column) -> Column:
    squares = F.aggregate(
        F.array_distinct(chars),
        F.lit(0.0),
        lambda s, c: s + F.pow(n - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)),
    )
    return (size / n * squares - n - (size - 1 + n * EXCESS)) / F.sqrt(2 * (size - 1) + 4 * n * EXCESS)


def runs(token: Column, n: Column) -> Column:
    changes = F.length(F.regexp_replace(F.translate(token, CLASSES_FROM, CLASSES_TO), r"(.)\1+", "$1")) - 1
    return ((n - 1) * CHANGES - changes) / F.sqrt((n - 1) * CHANGES * (1 - CHANGES))


def serial(codes: Column, n: Column) -> Column:
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)

    def score(mean):
        spread = total(F.transform(codes, lambda x: (x - mean) * (x - mean)))
        pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda x, y: (x - mean) * (y - mean))
        return (F.abs(total(pairs) / F.greatest(spread, F.lit(1e-9))) - CORRELATION) * F.sqrt(n)

    return bound(total(codes) / n, score)


def battery(token: Column) -> Column:
    """Combined probability that ordinary writing looks at least as random as the token, in the token's inferred alphabet."""

    def score(chars):
        n = F.length(token).cast("double")
        codes = F.transform(chars, lambda c: F.instr(F.lit(INDEX), c).cast("double"))
        scores = uniformity(token, chars, n, alphabet_size(token)) + runs(token, n) + bound(codes, lambda x: serial(x, n))
        return normal_below(scores / F.sqrt(F.lit(3.0)))

    return bound(F.filter(F.split(token, ""), lambda c: c != ""), score)


def length_class(n: Column) -> Column:
    out = F.lit(0)
    for i, limit in enumerate(LENGTH_CLASSES):
        out = F.when(n >= limit, F.lit(i + 1)).otherwise(out)
    return out


def with_candidates(docs: DataFrame) -> DataFrame:
    """Adds ``_tested``: span, length class and step of -log10 p of each candidate in ``_body``."""
    body = F.col("_body")
    out = docs.withColumn("_found", matches(body, CANDIDATE))
    out = out.withColumn("_spans", located(body, CANDIDATE, F.col("_found"), "random"))

    def tested(span, token):
        step = F.least(F.floor(-F.log10(F.greatest(battery(token), F.lit(1e-40))) * STEPS).cast("int"), F.lit(TOP))
        fits = token.rlike("[0-9]") & token.rlike("[A-Za-z]")
        return F.when(fits, F.struct(span.alias("span"), length_class(F.length(token)).alias("size"), step.alias("step")))

    return out.withColumn("_tested", F.filter(F.zip_with("_spans", "_found", tested), lambda x: x.isNotNull())).drop("_found", "_spans")


def discovery_steps(docs: DataFrame, fdr: float) -> dict[int, int]:
    """Per length class the smallest step of -log10 p that the Benjamini-Hochberg rule lets through; over all candidates.

    The counts have at most (length classes) x (steps) rows, the result a row per class.
    """
    bodies = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_body"))
    counts = with_candidates(bodies).select(F.inline("_tested")).groupBy("size", "step").agg(F.count("*").alias("n"))
    ranked = counts.select(
        "size",
        "step",
        F.sum("n").over(Window.partitionBy("size").orderBy(F.desc("step"))).alias("rank"),
        F.sum("n").over(Window.partitionBy("size")).alias("total"),
    )
    passing = ranked.where(F.pow(F.lit(10.0), -F.col("step") / STEPS) <= fdr * F.col("rank") / F.col("total"))
    return {r["size"]: r["least"] for r in passing.groupBy("size").agg(F.min("step").alias("least")).collect()}


def find_secrets(docs: DataFrame, fdr: float = 0.001) -> DataFrame:
    """Adds n_assign, n_access, n_hex, ``base`` and ``spans`` to documents: arrays of (start, kind, end) by start, then kind.

    Positions are code points, ends exclusive, kinds indexes of KINDS. ``base`` holds the three patterns; ``spans`` adds
    candidates that no base span touches and that the battery discovers. A null or empty text has no spans; repeated rows
    and ties are judged alike; columns beside ``text`` pass through, and ones of the added names are replaced.
    """
    steps = discovery_steps(docs, fdr)
    passes = F.lit(False)
    out = docs.drop("n_assign", "n_access", "n_hex", "base", "spans")
    out = with_candidates(with_base_spans(out))

    def discovered(x):
        ok = passes
        for size, least in sorted(steps.items()):
            ok = ok | ((x["size"] == size) & (x["step"] >= least))
        return ok & ~F.exists("_base", lambda b: (b["start"] < x["span"]["end"]) & (x["span"]["start"] < b["end"]))

    added = F.transform(F.filter("_tested", discovered), lambda x: x["span"])
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return out.withColumns(
        {
            "n_assign": count("assign"),
            "n_access": count("access"),
            "n_hex": count("hex"),
            "base": F.col("_base"),
            "spans": F.sort_array(F.concat(F.col("_base"), added)),
        }
    ).drop("_body", "_base", "_tested")


def redacted(docs: DataFrame, fdr: float = 0.001, mark: str = "[SECRET]") -> DataFrame:
    """The documents, of the same columns, with every secret span in ``text`` replaced by ``mark``; overlaps count once.

    A null text stays null; ``n_chars``, if present, follows the text. Other columns pass through, whatever they are called.
    """
    found = find_secrets(docs.select(F.struct("*").alias("_row"), "doc_id", "text"), fdr)

    def step(done, s):
        clear = F.substring(F.col("text"), done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        piece = F.when(s["start"] >= done["at"], F.concat(clear, F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["out"], F.array(piece)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), none_of("array<string>").alias("out"))
    clean = F.aggregate(
        "spans", start, step, lambda done: F.concat(F.array_join(done["out"], ""), F.substring(F.col("text"), done["at"] + 1, F.length("text")))
    )
    changed = F.size("spans") > 0
    out = found.withColumn("_text", F.when(changed, clean).otherwise(F.col("text")))
    own = {c: F.col("_row")[c] for c in docs.columns}
    own["text"] = F.col("_text")
    if "n_chars" in own:
        own["n_chars"] = F.when(changed, F.length("_text").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    return out.select(*[value.alias(c) for c, value in own.items()])


def digest(docs: DataFrame, fdr: float = 0.001) -> DataFrame:
    """doc_id, counts, the digest of the base spans and the text of all spans."""
    return find_secrets(docs, fdr).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )
