import math
import random

from pyspark.sql import functions as F

from indicatrix.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k=5, every=50):
    usable = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault((i, tuple(math.floor(256 * x) for x in v)), None)
    out = []
    asked = {}
    for i, v in sorted(usable):
        if i % every == 0:
            asked.setdefault(i, v)
    for q, v in asked.items():
        scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in usable if i != q]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = topk.nearest(df)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def vectors(n, seed=1, dims=6, spread=1.0):
    rng = random.Random(seed)
    f = lambda x: float(__import__("numpy").float32(x))
    return [(i, [f(rng.choice([0.0, rng.uniform(-spread, spread)])) for _ in range(dims)], 0, "x") for i in range(n)]


def test_against_all_pairs(spark):
    check(spark, vectors(320))


def test_ties_nulls_and_lengths(spark):
    rows = vectors(60) + [(100 + i, [0.5] * 6, 0, "x") for i in range(30)]
    rows += [(150, None, 0, "x"), (200, [1.0, None], 0, "x"), (250, [float("nan")], 0, "x"), (300, [float("inf")], 0, "x")]
    rows += [(350, [], 0, "x"), (400, [0.25], 0, "x"), (None, [0.5], 0, "x"), (450, [0.5] * 9, 0, "x")]
    check(spark, rows)
    check(spark, rows + rows[:40])


def test_large_components(spark):
    check(spark, vectors(55, 2) + [(500, [3e30, -3e30, 1.0], 0, "x"), (501, [1e7, 2.0], 0, "x"), (550, [1e9, 1e9], 0, "x")])


def test_few_rows(spark):
    check(spark, vectors(3))
    check(spark, vectors(1))
    assert topk.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 2)
    rows = vectors(400, 5)
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows)
