import random

from indicatrix.llm import mixing
from tests.llm.common import DOCS, corpus, frame, words


def filled(sizes, weights, epochs=3):
    """Clamp and reshare until nothing is above its cap."""
    total, capped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(epochs * sizes[i] for i in capped)
        level = left / sum(weights[i] for i in free) if free else 0
        over = {i for i in free if level * weights[i] >= epochs * sizes[i]}
        if not over:
            return [epochs * sizes[i] if i in capped else level * weights[i] for i in range(len(sizes))]
        capped |= over


def check(spark, rows):
    got = sorted(mixing.mix_digest(frame(spark, rows)).collect(), key=lambda r: (r["doc_id"], r["size"]))
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(len(words(r[1])) for r in rows if r[3] == s) for s in names}
    want = dict(zip(names, filled([sizes[s] for s in names], [1 + i % 3 for i in range(len(names))])))
    taken = dict.fromkeys(names, 0)
    for r, g in zip(sorted(rows, key=lambda r: (r[0], len(words(r[1])))), got):
        assert (g["doc_id"], g["size"], g["source_size"]) == (r[0], len(words(r[1])), sizes[r[3]])
        assert abs(g["target"] - want[r[3]]) < 1e-6 * max(1, want[r[3]])
        assert 0 <= g["taken"] <= 3 * g["size"]
        taken[r[3]] += g["taken"]
    for s in names:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6, s


def test_targets_and_taken_words(spark):
    check(spark, corpus(5, 90))
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 30), "en", rng.choice(["a", "b", "b", "b", "b", "b", "Z", "é", "zz", None]), 0) for i in range(300)]
    check(spark, rows)


def test_reruns_agree_and_edges(spark):
    rows = corpus(6, 50)
    one, two = (sorted(map(tuple, mixing.mix_digest(spark.createDataFrame(rows, DOCS).repartition(n)).collect())) for n in (1, 5))
    assert one == two
    assert mixing.mix_digest(spark.createDataFrame([], DOCS)).count() == 0
    alone = mixing.mix_digest(spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOCS)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in alone] == [(0, 0.0, 0)] * 2
    twice = mixing.mix_digest(frame(spark, rows + rows)).collect()
    assert len(twice) == 2 * len(rows)


def test_sources_of_a_few_words(spark):
    """A source of one word may be repeated as often as its target says."""
    rows = [(1, "one", "", "z", 0), (2, "w " * 50, "", "a", 0), (3, "two words", "", "b", 0)]
    check(spark, rows)
    got = {r["doc_id"]: r["taken"] for r in mixing.mix_digest(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1] == 3 and got[3] == 6


def test_mixed_judges_each_row(spark):
    """Rows of one id in two sources, equal rows, and columns named like those in use."""
    rows = [(2, "one", "", "A", 0), (2, "w " * 100, "", "B", 0), (2, "w " * 100, "", "B", 0), (5, "x y", "", None, 0), (None, "q " * 30, "", "A", 0), (6, None, "", "A", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    names = ["_row", "_order", "_bucket", "_id", "size", "taken", "border", "goal"]
    docs = docs.selectExpr("*", *[f"'mine' AS `{n}`" for n in names])
    got = mixing.mixed(docs).collect()
    assert mixing.mixed(docs).columns == [*[c for c in docs.columns if c not in ("size", "taken")], "size", "target", "taken"]
    assert all(r["size"] == len(words(r["text"])) and 0 < r["taken"] <= 3 * r["size"] and r["border"] == r["_row"] == "mine" for r in got)
    want = {}
    for r in mixing.mix(docs).collect():
        want.setdefault((r["doc_id"], r["source"], r["size"]), []).append((r["target"], r["taken"]))
    found = {}
    for r in got:
        found.setdefault((r["doc_id"], r["source"], r["size"]), []).append((r["target"], r["taken"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(x for x in v if x[1]) for k, v in want.items() if any(t for _, t in v)}
