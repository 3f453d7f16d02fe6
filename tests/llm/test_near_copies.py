"""The near-duplicate stage of the pipeline on planted rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from indicatrix.llm import copies
from indicatrix.llm.simhash import components
from tests.llm.common import DOCS, ascii_lower, words


def stage(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    return sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect()), key=str)


def prose(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_null_and_repeated_ids(spark):
    a, b, c, d, e = (" ".join(prose(i, 60)) for i in range(5))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d), (9, d), (None, e), (3, e), (None, None), (None, "")]
    want = [(None, a), (None, b), (7, c), (7, d), (3, e)]
    got = stage(spark, [(i, t, "en", "s", 0) for i, t in rows])
    assert [x for x in got if x[1]] == sorted(want, key=str)
    assert len(got) == len(want) + 1


def test_columns_of_any_name(spark):
    a = " ".join(prose(1, 40))
    docs = spark.createDataFrame([(1, a, "en", "s", 0), (2, a, "en", "s", 0), (3, "other", "en", "s", 0)], DOCS)
    names = ["_key", "_id", "_text", "_row", "_doc", "_rows", "key", "root", "shingle", "size", "n", "hub", "a", "b", "one"]
    docs = docs.selectExpr("*", *[f"concat(doc_id, '{n}') AS `{n}`" for n in names])
    kept = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    assert {(r["doc_id"], r["_key"], r["n"]) for r in kept.collect()} == {(1, "1_key", "1n"), (3, "3_key", "3n")}
    assert corpus_pipeline.keep_one_of_each(spark, docs.limit(0), "").count() == 0


def shingles(text):
    ws = words(ascii_lower(text))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}


def brute(texts):
    """Smallest number in each text's group, by union of all pairs of similarity 0.8 or more."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def planted(seed):
    """Texts with copies of one to four changed words, chains of them, one crowded group and a common line."""
    rng, texts = random.Random(seed), []
    line = " ".join(prose(-1, 30))
    for k in range(25):
        ws = prose(seed * 100 + k, rng.randint(4, 150))
        texts.append(" ".join(ws))
        for _ in range(rng.randint(0, 4)):
            for _ in range(rng.randint(1, 4)):
                ws[rng.randrange(len(ws))] = "Changed"
            texts.append("  ".join(ws).upper() if rng.random() < 0.2 else " ".join(ws))
    for k in range(40):
        ws = prose(seed, 120)
        for _ in range(rng.randint(0, 4)):
            ws[rng.randrange(120)] = f"new{rng.randrange(99)}"
        texts.append(" ".join(ws))
        texts.append(line + " " + " ".join(prose(1000 + k, rng.randint(3, 12))))
    return texts


@pytest.mark.parametrize("crowd", [1, 5, 64])
def test_near_copies_against_all_pairs(spark, monkeypatch, crowd):
    monkeypatch.setattr(copies, "CROWD", crowd)
    texts = planted(crowd)
    want = sorted(set(brute(texts)))
    assert [i for i, _ in sorted(stage(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]))] == want


def test_fingerprints_take_part(spark, monkeypatch):
    """The SimHash operator brings pairs to the stage, and an exact check follows: alike fingerprints alone link nothing."""
    seen = []

    def operator(docs, width):
        seen.append(width)
        return docs.selectExpr("doc_id", "'0' AS fingerprint", "min(doc_id) OVER () AS component_id")

    monkeypatch.setattr(copies, "near_duplicates", operator)
    texts = [" ".join(prose(i, 60)) for i in range(6)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*texts, texts[0] + " more"])]
    assert [i for i, _ in stage(spark, rows)] == list(range(6)) and seen == [copies.WIDTH]


def test_sketches_drop_unlike_pairs_only(spark):
    """Pairs are dropped by their sketches, without a join over shingles; none that is similar goes."""
    texts = planted(3)
    docs = copies.keyed(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)).distinct()
    sketches = copies.prefixes(docs, copies.common_shingles(docs)).where("place = 0")
    pairs = sketches.alias("x").crossJoin(sketches.alias("y")).where("x.key < y.key").selectExpr("x.key AS a", "y.key AS b")
    kept = copies.likely(pairs, sketches.select("key", "size", "sketch"))
    similar = copies.verified(pairs, docs)
    assert similar.join(kept, ["a", "b"], "left_anti").isEmpty()
    assert kept.count() <= 2 * similar.count() < pairs.count()


def test_sketches_of_long_texts(spark):
    """Unlike texts of thousands of words that share a passage are dropped by sketches too; similar ones stay, also across a change of width."""
    shared = prose(0, 300)
    unlike = [" ".join(shared + prose(i, 4000)) for i in range(1, 5)]
    base = prose(9, 1200)
    texts = [*unlike, " ".join(base[:1024]), " ".join(base[:1100]), unlike[0] + " and more", " ".join([*unlike[1].split()[:4100], *prose(10, 200)])]
    docs = copies.keyed(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)).distinct()
    sketches = copies.prefixes(docs, copies.common_shingles(docs)).where("place = 0").select("key", "size", "sketch")
    pairs = sketches.alias("x").crossJoin(sketches.alias("y")).where("x.key < y.key").selectExpr("x.key AS a", "y.key AS b")
    kept = sorted(map(tuple, copies.likely(pairs, sketches).collect()))
    assert kept == sorted(map(tuple, copies.verified(pairs, docs).collect())) and len(kept) == 3


def test_components_leave_one_table(spark, tmp_path):
    """Tables of the rounds go as soon as they are read; only the last one stays."""
    before = spark.conf.get("spark.checkpoint.dir", None)
    spark.conf.set("spark.checkpoint.dir", str(tmp_path))
    try:
        found = components(spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long"))
        assert {r["root"] for r in found.collect()} == {0} and found.count() == 21
        assert len(list(tmp_path.iterdir())) == 1
    finally:
        spark.conf.unset("spark.checkpoint.dir") if before is None else spark.conf.set("spark.checkpoint.dir", before)


def test_rounds_without_pairs_end_at_once(spark, monkeypatch):
    """A round that brings no likely pair neither compares texts nor looks for components again."""
    texts = planted(2)
    docs = copies.keyed(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)).distinct()
    sketches = copies.prefixes(docs, copies.common_shingles(docs)).where("place = 0").select("key", "size", "sketch")
    found = components(spark.createDataFrame([(1, 2)], "a long, b long"))
    names = []
    kept = copies.stored
    monkeypatch.setattr(copies, "stored", lambda df, name: (names.append(name), kept(df, name))[1])
    none = sketches.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0)
    assert sorted(map(tuple, copies.grown(found, none, sketches, docs).collect())) == [(1, 1), (2, 1)]
    assert names == ["pairs-of-folded"]


def test_sketches_are_folded_once(spark, monkeypatch):
    """Plans of rounds read the folded sketches; they do not hold their long expression again, and drop the same pairs."""
    plans = {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().analyzed().toString()
        return kept(df, name)

    kept = copies.stored
    monkeypatch.setattr(copies, "stored", noted)
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" if j != 90 * i else "x" for j in range(400))) for i in range(5)], "doc_id long, text string")
    assert len({r["root"] for r in copies.roots(docs).collect()}) == 1
    assert "lambda" in plans["sketches"] and "lambda" not in plans["pairs-of-folded"]
    sketches = copies.prefixes(copies.keyed(docs), copies.common_shingles(copies.keyed(docs))).where("place = 0").select("key", "size", "sketch")
    pairs = sketches.alias("x").crossJoin(sketches.alias("y")).where("x.key < y.key").selectExpr("x.key AS a", "y.key AS b")
    both = [sorted(map(tuple, copies.likely(pairs, s).collect())) for s in (sketches, sketches.withColumn("folded", copies.folded(F.col("sketch"))))]
    assert both[0] == both[1] and len(both[0]) == 10
