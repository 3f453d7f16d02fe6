import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from indicatrix.llm import periods
from tests.llm.common import DOCS, corpus, frame, words


def brute_runs(ws, shortest=6, turns=4):
    """Stretches of every period by direct comparison, each under its smallest period."""
    n, best = len(ws), {}
    for q in range(1, n):
        i = q
        while i < n:
            if ws[i] != ws[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and ws[i] == ws[i - q]:
                i += 1
            best.setdefault((start, i - start), q)
    return sorted((s, k, q) for (s, k), q in best.items() if k >= max(shortest, turns * q))


def planted(doc_id, ws):
    if doc_id is None:
        return ws
    h, n = zlib.crc32(str(doc_id).encode()), len(ws)
    g = h // 10
    if h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def brute(rows):
    out = []
    for doc_id, text in [(r[0], r[1]) for r in rows]:
        ws = planted(doc_id, words(text))
        runs = brute_runs(ws)
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
        out.append((doc_id, len(runs), *best, milli, *digests))
    return out


def repeating(seed, n=60):
    """Texts of few words, with stretches repeated inside repeated stretches."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vocab = ["a", "b", "é", "cc"][: rng.randint(1, 4)] + [f"w{k}" for k in range(rng.choice([0, 0, 30]))]
        ws = []
        for _ in range(rng.randint(0, 6)):
            part = [rng.choice(vocab) for _ in range(rng.randint(1, 12))]
            if rng.random() < 0.3 and ws:
                part = ws[-rng.randint(1, len(ws)) :][:30]
            ws += part * rng.choice([1, 1, 3, 4, 5, 9])
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(ws[:400]), "en", "s", 0))
    return rows


def key(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, str(r)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_query_against_direct_comparison(spark, seed):
    rows = repeating(seed) + [(1000 + r[0], *r[1:]) for r in corpus(seed, 30)]
    got = periods.digest(frame(spark, rows))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert key(got.collect()) == key(brute(rows))


@pytest.mark.parametrize("shortest,turns", [(6, 4), (2, 2), (9, 3), (3, 5)])
def test_runs_of_random_sequences(shortest, turns):
    rng = np.random.default_rng(shortest)
    texts = [rng.integers(0, rng.integers(1, 4), rng.integers(0, 60)) for _ in range(150)]
    texts += [np.tile(rng.integers(0, 3, rng.integers(1, 7)), 9)[: rng.integers(1, 50)] for _ in range(100)]
    sequence = np.concatenate(texts)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got, at = periods.runs_of(sequence, owner, shortest, turns), 0
    want = []
    for t in texts:
        want += [(at + s, k, q) for s, k, q in brute_runs(t.tolist(), shortest, turns)]
        at += len(t)
    assert list(map(tuple, got.tolist())) == want


def test_one_word_and_long_periods():
    for n in (5, 6, 20_000):
        got = periods.runs_of(np.zeros(n, np.int64), np.zeros(n, np.int64), 6, 4).tolist()
        assert got == ([[0, n, 1]] if n >= 6 else [])
    rng = np.random.default_rng(1)
    text = np.concatenate([np.tile(rng.integers(0, 10**6, 3000), 5), np.tile([1, 2, 3], 2000)])
    assert periods.runs_of(text, np.zeros(len(text), np.int64), 6, 4).tolist() == [[0, 15000, 3000], [15000, 6000, 3]]


def test_general_columns_and_odd_rows(spark):
    rows = [(None, "x " * 9, "", "", 0), (7, None, "", "", 0), (7, None, "", "", 0), (8, "", "", "", 0), (9, "z a b a b a b a b c", "", "", 0)]
    got = periods.periodic_runs(frame(spark, rows))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    found = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()), key=str)
    assert found == sorted([(None, 9, [(0, 9, 1)], "x"), (7, 0, [], ""), (7, 0, [], ""), (8, 0, [], ""), (9, 10, [(1, 8, 2)], "z a b c")], key=str)
    assert periods.digest(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(frame(spark, rows), turns=1)


def test_texts_in_many_chunks(spark, monkeypatch):
    rows = repeating(9, 40)
    whole = key(periods.digest(frame(spark, rows)).collect())
    monkeypatch.setattr(periods, "chunks", lambda data, offsets: [(i, i + 1, data[offsets[i] : offsets[i + 1]], offsets[i : i + 2] - offsets[i]) for i in range(len(offsets) - 1)])
    assert key(periods.digest(frame(spark, rows)).collect()) == whole == key(brute(rows))
