import hashlib
import random

import numpy as np
import pytest

from indicatrix.llm import substrings
from tests.llm.common import DOCS, corpus, frame, words


def brute(rows, length):
    first = {}
    for doc_id, text in sorted((r[0], r[1]) for r in [(r[0], r[1] or "") for r in rows]):
        ws = words(text)
        for i in range(len(ws) - length + 1):
            first.setdefault(tuple(ws[i : i + length]), (doc_id, i))
    out = []
    for r in rows:
        ws = words(r[1])
        gone = set()
        for i in range(len(ws) - length + 1):
            if first[tuple(ws[i : i + length])] != (r[0], i):
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((r[0], len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def passages(seed, n=40):
    """Texts that share passages of many lengths, also within themselves, with few distinct words."""
    rng = random.Random(seed)
    vocab = ["a", "b", "c", "é", "dd"] if seed % 2 else [f"w{i}" for i in range(400)]
    shared = [[rng.choice(vocab) for _ in range(rng.randint(10, 60))] for _ in range(5)]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(rng.randint(0, 5)):
            ws += rng.choice(shared) if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(ws), "en", "s", 0))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed):
    rows = passages(seed) + [(100 + r[0], *r[1:]) for r in corpus(seed, 30)]
    got = sorted(map(tuple, substrings.digest(frame(spark, rows)).collect()))
    assert got == brute(rows, 20)


def test_repeats_of_one_word(spark):
    rows = [(1, "la " * 19, "", "", 0), (2, "la " * 20, "", "", 0), (3, "la " * 500, "", "", 0), (4, "x " + "la " * 20, "", "", 0), (0, None, "", "", 0)]
    got = sorted(map(tuple, substrings.digest(frame(spark, rows)).collect()))
    assert got == brute(rows, 20)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = substrings.digest(spark.createDataFrame([(None, text, "", "", 0), (5, text, "", "", 0), (5, text, "", "", 0)], DOCS)).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in got) == [(-1, 0), (5, 30), (5, 30)]
    assert substrings.digest(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("length,prefix", [(8, 3), (5, 5), (13, 1)])
def test_other_lengths(spark, length, prefix):
    rows = passages(2, 15)
    kept = substrings.without_repeats(spark.createDataFrame(rows, DOCS), length, prefix)
    assert kept.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "kept_text", "n_words", "n_removed"]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in kept.collect())
    assert got == brute(rows, length)


def test_least_places():
    x = np.array([5, 3, 3, 9, 1, 1, 7, 2])
    for width in range(1, 9):
        want = [int(np.argmin(x[i : i + width])) + i for i in range(len(x) - width + 1)]
        assert substrings.least_places(x, width).tolist() == want
