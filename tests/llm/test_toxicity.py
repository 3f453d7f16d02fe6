import random
import zlib

import numpy as np
import pytest

from indicatrix.llm import toxicity
from tests.llm.common import DOCS, frame

LABELS = "doc_id long, quality int, toxic int, text string"


def labelled(n=900, seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(rng.randint(1, 3))) for _ in range(300)]
    vocab += ["idea", "riot", "pilot", "motor", "normal", "more", "baron"]
    docs, labels = [], []
    for i in range(n):
        ws = [rng.choice(vocab) for _ in range(rng.randint(3, 60))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(2):
                ws.insert(rng.randrange(len(ws)), rng.choice(["idiot", "moron", "lowei" + rng.choice(vocab)]))
        docs.append((i, " ".join(ws), "en", "s", 0))
        labels.append((i, 0, toxic, "x"))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = labelled()
    return toxicity.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))


def scored(spark, model, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r["score"] for r in toxicity.with_score(df, model).orderBy("i").collect()]


def test_held_out_accuracy(spark):
    docs, labels = labelled()
    got = toxicity.toxicity(frame(spark, docs), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(docs)
    truth = {i: t for i, _, t, _ in labels}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97


@pytest.mark.parametrize("written", ["idiot", "1d10t", "IDIOT", "i d i o t", "i.d.i.o.t", "idiooooot", "m0r0n", "m o r o n", "moooron", "loweithon", "iiidiot", "iiddiioott"])
def test_obfuscated_spellings(spark, model, written):
    assert scored(spark, model, [f"the {written} here"])[0] >= 0.5


def test_clean_and_odd_texts(spark, model):
    texts = ["", None, "the idea of a pilot", "e3b0c44298fc1c149afbf4c8996fb924 a1 b2 3c", "x" * 200_000, "1" * 1000, "a b c d e f g h", "the " * 50_000 + " idiot"]
    got = scored(spark, model, texts)
    assert max(got[:-1]) < 0.5 and got[-1] >= 0.5
    assert got[0] == got[1]


def test_viterbi_is_the_cheapest_path(spark):
    rng = np.random.default_rng(1)
    costs = toxicity.trigram_costs(rng.integers(0, 50, 27**3))
    code = lambda c: ord(c) - 96

    def cost(path):
        a = b = 0
        total = 0.0
        for letters, channel in path:
            total += channel
            for c in letters:
                total += costs[a][b][code(c)]
                a, b = b, code(c)
        return total + costs[a][b][0]

    import itertools

    for stretch in ["1d1ot", "aaa1b", "m00r0n", "1l1l1"]:
        columns = toxicity.lattice(stretch, False)
        best = min(itertools.product(*columns), key=cost)
        got = toxicity.viterbi(columns, costs)
        assert got == "".join(x for x, _ in best)


def test_letter_counts_are_over_all_documents(spark):
    df = spark.createDataFrame([("ab",), ("AB",), (None,), ("",)], "text string")
    counts = toxicity.letter_counts(df).reshape(27, 27, 27)
    assert counts[0, 1, 2] == 2 and counts[1, 2, 0] == 2


def test_no_labels_and_no_documents(spark):
    docs, _ = labelled(20)
    none = spark.createDataFrame([], LABELS)
    assert {r["predicted"] for r in toxicity.toxicity(spark.createDataFrame(docs, DOCS), none).collect()} == {0}
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), none).count() == 0
    odd = spark.createDataFrame([(1, 0, None, ""), (None, 0, 1, ""), (9999, 0, 1, "")], LABELS)
    assert toxicity.toxicity(spark.createDataFrame(docs + docs, DOCS), odd).count() == 40
