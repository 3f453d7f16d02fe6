import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from indicatrix.operators import metrics, ordered, risk
from tests.conftest import rows


def scores(n, seed, ties):
    rng = random.Random(seed)
    return [(int(rng.random() < 0.4), round(rng.random(), ties) if ties else rng.random()) for _ in range(n)]


def brute(data):
    """ROC-AUC over all pairs, average precision and recall over thresholds."""
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    ap, last, recall = 0.0, 0.0, 0.0
    for limit in sorted({s for _, s in data}, reverse=True):
        tp, fp = sum(s >= limit for s in pos), sum(s >= limit for s in neg)
        ap += (tp / len(pos) - last) * tp / (tp + fp)
        last = tp / len(pos)
        if fp / len(neg) <= 0.01:
            recall = max(recall, last)
    return auc, ap, recall


@pytest.mark.parametrize("n,seed,ties", [(400, 1, 1), (400, 2, 2), (500, 3, 0), (12, 4, 1)])
def test_measures_against_brute_force(table, n, seed, ties):
    data = scores(n, seed, ties)
    got = metrics.evaluate(table(data, "label int, score double").repartition(5)).first()
    assert tuple(got) == pytest.approx(brute(data), abs=1e-9)


def test_measures_of_one_class_are_null(table):
    row = metrics.evaluate(table([(1, 0.5), (1, 0.6)], "label int, score double")).first()
    assert row["roc_auc"] is None


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = random.Random(7)
    data = {round(rng.gauss(0, 1), 3): rng.randint(0, 9) for _ in range(2000)}
    groups = spark.createDataFrame(list(data.items()), "key double, n int").repartition(6)
    got = {r["key"]: r["upto"] for r in ordered.running_totals(groups, "key", {"upto": "n"}, descending, ranges=16).collect()}
    total, want = 0, {}
    for key in sorted(data, reverse=descending):
        total += data[key]
        want[key] = total
    assert got == want


def test_ranges_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 10)
    groups = spark.range(1000).select((F.col("id") * 0.5).alias("key"), F.lit(1).alias("n")).cache()
    totals = ordered.running_totals(groups, "key", {"upto": "n"})
    assert [r["upto"] for r in totals.orderBy("key").collect()] == list(range(1, 1001))
    cuts = [float(c) for c in range(0, 500, 5)]
    places = groups.select("key", ordered._place("key", cuts).alias("place")).collect()
    assert all(r["place"] == sum(c < r["key"] for c in cuts) for r in places) and max(r["place"] for r in places) > 64


def test_running_totals_use_no_window_over_all_rows(spark):
    groups = spark.range(1000).select((F.col("id") * 0.5).alias("key"), F.lit(1).alias("n"))
    plan = ordered.running_totals(groups, "key", {"upto": "n"}, ranges=16)._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step lies above the aggregation of the ranges.
    single = plan[plan.index("SinglePartition") :]
    assert "HashAggregate(keys=[_range" in single and plan.count("SinglePartition") == 1


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [0.3] * 50, [i * 7919 % 1000 / 1000 for i in range(1500)]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(4)
    points = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p999": 0.999, "p100": 1.0}
    got = ordered.exact_quantiles(df, "v", points).first().asDict()
    assert got == pytest.approx({k: float(np.quantile(values, p)) for k, p in points.items()}, abs=1e-12)


def test_quantiles_of_nothing(spark):
    assert tuple(ordered.exact_quantiles(spark.createDataFrame([], "v double"), "v", {"p50": 0.5}).first()) == (None,)


def test_score_reports_against_pandas(spark):
    n = 3000
    pdf = pd.DataFrame({"score": [i * 37 % 1000 / 999 for i in range(n)], "k": [None if i % 50 == 0 else f"k{i % 7}" for i in range(n)]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "score double, k string")
    got = risk.score_summary(df).first().asDict()
    want = pdf.score.describe(percentiles=[0.5, 0.9, 0.95, 0.99, 0.999])
    assert got == pytest.approx(
        {"count": want["count"], "mean": want["mean"], "std": want["std"], "min": want["min"], "max": want["max"],
         "p50": want["50%"], "p90": want["90%"], "p95": want["95%"], "p99": want["99%"], "p999": want["99.9%"]}
    )
    bins = {r["bin"]: r["count"] for r in risk.score_histogram(df).collect()}
    counts, edges = np.histogram(pdf.score, bins=50)
    assert sum(bins.values()) == n and len(bins) == 50
    # Scores on a bin's edge may fall to either side of it by rounding.
    assert max(abs(bins[i] - c) for i, c in enumerate(counts.tolist())) <= 3
    by_key = {r["k"]: (r["count"], r["pct_high"]) for r in risk.score_risk(df, "k", min_count=1).collect()}
    groups = pdf.groupby("k").score
    assert by_key == {k: (len(g), pytest.approx((g >= 0.9).mean() * 100)) for k, g in groups}
    assert {r["threshold"]: r["n"] for r in risk.score_thresholds(df).collect()} == {t: int((pdf.score >= t).sum()) for t in (0.5, 0.9, 0.99)}


def test_histogram_of_equal_scores(spark):
    df = spark.createDataFrame([(0.5,)] * 3, "score double")
    assert rows(risk.score_histogram(df)) == [(25, 3)]


def test_label_risk_drops_missing_keys_and_small_groups(table):
    data = [("a", 1)] * 30 + [("b", 0)] * 29 + [(None, 1)] * 40 + [("c", 0)] * 30 + [("c", 1)] * 10
    df = table(data, "k string, label int")
    got = [tuple(r) for r in risk.label_risk(df, "k", 30, 5).collect()]
    assert got == [("a", 30, 30, 0, 1.0), ("c", 40, 10, 30, 0.25)]
    assert rows(risk.label_risk_all(df, ["k"], 30), "value", "phish") == [("a", 30), ("c", 10)]


def test_hash_ranks_are_whole_and_stable(spark):
    df = spark.range(5000).select((F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("string").alias("key"))
    one = rows(ordered.hash_ranks(df.coalesce(1), "label", "key", 42), "label", "key", "hash_rank")
    many = rows(ordered.hash_ranks(df.orderBy(F.rand(3)).repartition(7), "label", "key", 42), "label", "key", "hash_rank")
    assert one == many
    for label in (0, 1):
        assert sorted(r[2] for r in one if r[0] == label) == list(range(1, 2501))
