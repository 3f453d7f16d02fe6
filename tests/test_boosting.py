"""Leaf-wise boosted trees against a plain reading of the same rules."""

import heapq
import math
import random
from dataclasses import asdict

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from indicatrix.operators import boosting
from indicatrix.operators.boosting import UNIT, Growth


def data(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = [round(rng.gauss(0, 1), 1), float(rng.randint(0, 3)), 0.0 if rng.random() < 0.8 else round(rng.random(), 2), -rng.random() if rng.random() < 0.1 else 0.0, 0.0]
        label = int((x[0] > 0.3) != (x[1] > 1) or x[2] > 0.5) if rng.random() < 0.9 else rng.randint(0, 1)
        out.append((x, label, 1.0 + (label == 1)))
    return out


def frame(spark, rows):
    vectors = [Vectors.sparse(len(x), {i: v for i, v in enumerate(x) if v}) if k % 3 else Vectors.dense(x) for k, (x, _, _) in enumerate(rows)]
    listed = [(v, y, w, "more") for v, (_, y, w) in zip(vectors, rows)]
    return spark.createDataFrame(listed, ["features", "label", "weight", "other"])


def brute(rows, edges, growth):
    """Margins after all rounds, by sorting nothing and trying every edge of every feature for every leaf."""
    total = sum(w for *_, w in rows)
    share = sum(w for _, y, w in rows if y) / total
    margins = [math.log(share / (1 - share))] * len(rows)

    def value(part):
        return max(abs(part) - growth.l1, 0) * (1 if part > 0 else -1)

    def gain(g, h):
        return value(g / UNIT) ** 2 / (h / UNIT + growth.l2)

    for _ in range(growth.rounds):
        g, h = [], []
        for (_, y, w), m in zip(rows, margins):
            p = 1 / (1 + np.exp(-m))
            g.append(int(np.rint(w * (p - y) * UNIT)))
            h.append(int(np.rint(w * p * (1 - p) * UNIT)))
        sums = lambda part: (sum(g[i] for i in part), sum(h[i] for i in part))

        def best(part):
            found = None
            for f, list_ in enumerate(edges):
                for e in list_:
                    left = [i for i in part if rows[i][0][f] <= e]
                    right = [i for i in part if not rows[i][0][f] <= e]
                    if min(len(left), len(right)) < growth.least_rows or min(sums(left)[1], sums(right)[1]) < growth.least_curvature * UNIT:
                        continue
                    d = gain(*sums(left)) + gain(*sums(right)) - gain(*sums(part))
                    if d > 1e-10 and (found is None or d > found[0] + 1e-12):
                        found = (d, left, right)
            return found

        leaves, heap, count = [list(range(len(rows)))], [], 0
        if found := best(leaves[0]):
            heap = [(-found[0], 0, leaves[0], found)]
        while heap and len(leaves) < growth.leaves:
            _, _, part, found = heapq.heappop(heap)
            leaves.remove(part)
            for side in found[1:]:
                leaves.append(side)
                count += 1
                if below := best(side):
                    heapq.heappush(heap, (-below[0], count, side, below))
        for part in leaves:
            a, b = sums(part)
            for i in part:
                margins[i] -= growth.rate * value(a / UNIT) / (b / UNIT + growth.l2)
    return margins


def scores(spark, rows, growth, partitions=3):
    df = frame(spark, rows).withColumn("n", F.monotonically_increasing_id()).repartition(partitions)
    model = boosting.LeafwiseClassifier.of(**asdict(growth)).fit(df)
    out = model.transform(frame(spark, rows))
    return [float(r["probability"][1]) for r in out.collect()], model


@pytest.mark.parametrize("more", [{}, {"l1": 0.5, "l2": 2.0}, {"leaves": 4, "least_rows": 40}])
def test_against_plain_rules(spark, more):
    rows = data()
    growth = Growth(rounds=3, rate=0.3, leaves=more.pop("leaves", 9), **{"least_rows": 5, **more})
    got, _ = scores(spark, rows, growth)
    edges = boosting.edges_of(frame(spark, rows), 5, growth.bins)
    want = [1 / (1 + math.exp(-m)) for m in brute(rows, edges, growth)]
    assert np.allclose(got, want, atol=1e-9)


def test_histograms_and_gathered_rows_give_the_same_trees(spark, monkeypatch):
    rows, growth = data(600, 2), Growth(rounds=2, leaves=12, least_rows=10, column_share=0.8)
    found = []
    for local, chunk, block in ((100_000, 8192, 8192), (0, 8192, 8192), (150, 10, 100)):
        monkeypatch.setattr(boosting, "LOCAL_ROWS", local)
        monkeypatch.setattr(boosting, "CHUNK_BINS", chunk)
        monkeypatch.setattr(boosting, "BLOCK_ROWS", block)
        found.append([asdict(t) for t in scores(spark, rows, growth)[1].content()[1]])
    assert found[0] == found[1] == found[2]


def test_partitions_and_kept_margins_change_nothing(spark, monkeypatch):
    rows, growth = data(300, 3), Growth(rounds=4, leaves=6)
    one = scores(spark, rows, growth, 1)[1].content()
    monkeypatch.setattr(boosting, "KEEP", 2)
    assert scores(spark, rows, growth, 5)[1].content() == one


def test_leaves_and_shares(spark):
    rows = data(500, 4)
    _, model = scores(spark, rows, Growth(rounds=3, leaves=5, row_share=0.5, column_share=0.4))
    trees = model.content()[1]
    assert model.getNumTrees() == 3
    for tree in trees:
        used = {f for f in tree.feature if f >= 0}
        assert len(used) <= 2 and sum(f < 0 for f in tree.feature) <= 5


def test_more_rounds_fit_better(spark):
    rows = data(500, 5)
    labels = np.array([y for _, y, _ in rows])

    def loss(rounds):
        p = np.clip(scores(spark, rows, Growth(rounds=rounds, rate=0.2, leaves=8))[0], 1e-9, 1 - 1e-9)
        return -np.mean(np.log(np.where(labels == 1, p, 1 - p)))

    assert loss(12) < loss(3) < math.log(2)


def test_one_class_and_no_rows(spark):
    got, model = scores(spark, [([1.0, 0.0], 1, 1.0)] * 30, Growth(rounds=1))
    assert min(got) > 0.99 and model.content()[1][0].feature == [-1]
    with pytest.raises(ValueError):
        boosting.LeafwiseClassifier.of().fit(frame(spark, data(3)).limit(0))


def test_model_is_stored_and_loaded(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    df = frame(spark, data(200, 6))
    model = Pipeline(stages=[boosting.LeafwiseClassifier.of(rounds=2)]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    take = lambda m: [r["probability"][1] for r in m.transform(df).collect()]
    assert take(loaded) == take(model)
    assert boosting.LeafwiseClassifier().settings() == Growth()


def test_one_child_of_two_is_counted(monkeypatch):
    """Below a node, only the child with fewer entries is counted; the first split agrees with a count of each side."""
    rng, n = np.random.default_rng(3), 2000
    binning = boosting.Binning.of([np.array([0.0, 1.0, 2.0])] * 6)
    bins = rng.integers(1, 4, 6 * n)
    places, features = np.tile(np.arange(n), 6), np.repeat(np.arange(6), n)
    g = np.rint((bins[:n] + rng.normal(0, 1, n) - 2) * UNIT).astype(np.int64)
    h = np.full(n, UNIT // 4)
    seen, count = [], boosting.counted
    monkeypatch.setattr(boosting, "counted", lambda key, *more: seen.append(len(key)) or count(key, *more))
    sums = (int(g.sum()), int(h.sum()), n)
    found = boosting.local_splits(places, features, bins, g, h, sums, binning, Growth(leaves=8), np.ones(6, bool))
    assert [p for p, *_ in found[:2]] == [-1, 0] and len(found) == 7
    assert seen[0] == 6 * n and len(seen) == 7 and max(seen[1:]) <= 3 * n
    side = bins[:n] <= found[0][4]
    assert found[0][3] == 0 and found[0][5] == (int(g[side].sum()), int(h[side].sum()), int(side.sum()))
