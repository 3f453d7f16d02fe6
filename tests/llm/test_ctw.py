import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicatrix.llm import ctw
from tests.llm.common import DOCS, ascii_lower, corpus, frame, words


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def word_model(rows):
    counts, n = {}, 0
    for r in rows:
        if not is_held_out(r[0]):
            for w in [*words(ascii_lower(r[1])), None]:
                counts[w] = counts.get(w, 0) + 1
                n += 1
    return counts, n


class PlainTree:
    """Context-tree weighting by its recursion, one decision at a time."""

    def __init__(self, texts):
        self.counts = {}
        for text in texts:
            for context, symbol in self.symbols(text):
                for d in range(ctw.DEPTH + 1):
                    for node, bit in self.bits(symbol):
                        key = (context[:d], node)
                        c = self.counts.setdefault(key, [0, 0])
                        c[bit] += 1
        self.children = {}
        for context, node in self.counts:
            if context:
                self.children.setdefault((context[:-1], node), []).append((context, node))

    @staticmethod
    def symbols(text):
        data = bytes(ctw.DEPTH) + (text or "").encode() + b"\0"
        for i in range(ctw.DEPTH, len(data)):
            yield tuple(data[i - 1 : i - 1 - ctw.DEPTH : -1] if i > ctw.DEPTH else data[i - 1 :: -1][: ctw.DEPTH]), data[i]

    @staticmethod
    def bits(symbol):
        for j in range(8):
            yield 1 << j | symbol >> 8 - j, symbol >> 7 - j & 1

    def own(self, key):
        a, b = self.counts[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, key):
        own = self.own(key)
        if len(key[0]) == ctw.DEPTH:
            return own
        return float(np.logaddexp(own, sum(map(self.weighted, self.children[key])))) - math.log(2)

    def log10(self, text):
        total = 0.0
        for context, symbol in self.symbols(text):
            for node, bit in self.bits(symbol):
                p, known = 0.5, False
                for d in range(ctw.DEPTH, -1, -1):
                    key = (context[:d], node)
                    if key not in self.counts:
                        continue
                    a, b = self.counts[key]
                    one = (b + 0.5) / (a + b + 1)
                    if known:
                        ratio = math.exp(min(60, max(-60, self.own(key) - sum(map(self.weighted, self.children[key])))))
                        p = (ratio * one + p) / (ratio + 1)
                    else:
                        p, known = one, True
                total += math.log10(p if bit else 1 - p)
        return total


@pytest.fixture(scope="module")
def rows():
    return corpus(8, 25, 30, 25)


@pytest.mark.parametrize("common,part", [(0, 1000), (40, 10**6)])
def test_scores(spark, rows, monkeypatch, common, part):
    """With all values sent, some of them or none, in many parts and in one."""
    monkeypatch.setattr(ctw, "COMMON_WORDS", 12)
    monkeypatch.setattr(ctw, "COMMON_CODES", common)
    monkeypatch.setattr(ctw, "PART_CODES", part)
    got = sorted(ctw.scores(frame(spark, rows)).collect(), key=lambda r: r["doc_id"])
    counts, n = word_model(rows)
    tree = PlainTree([r[1] for r in rows if not is_held_out(r[0])])
    assert len(got) == len(rows)
    for r, g in zip(rows, got):
        tokens = [*words(ascii_lower(r[1])), None]
        assert (g["doc_id"], g["held_out"], g["train_tokens"]) == (r[0], is_held_out(r[0]), n)
        assert (g["n_tokens"], g["n_known"]) == (len(tokens), sum(t in counts for t in tokens))
        base = sum(math.log10((counts.get(t, 0) + 1) / (n + len(counts) + 1)) for t in tokens)
        assert g["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert g["score"] == pytest.approx(tree.log10(r[1]), rel=1e-9, abs=1e-9)
        bits = -tree.log10(r[1]) / math.log10(2) / (len((r[1] or "").encode()) + 1)
        assert g["bits_per_byte"] == pytest.approx(bits)


def test_probabilities_of_a_byte_sum_to_one(spark, rows):
    """Over all bytes in contexts that occur, in part or not at all."""
    texts = spark.createDataFrame([(r[1], True) for r in rows], "text string, training boolean")
    contexts = (b"    ", b"aaaa", b"\0\0\0\0", b"zq\xff\x01")
    codes = [(int.from_bytes(c, "big") << 8 | s, 0, 1) for c in contexts for s in range(256)]
    asked = spark.createDataFrame(codes, "code long, n long, seen long")
    counts = ctw.byte_counts(texts).unionByName(asked).groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    values = {r["code"]: r["value"] for r in ctw.code_values(counts).collect()}
    for k in range(len(contexts)):
        assert sum(10 ** values[c] for c, *_ in codes[256 * k : 256 * k + 256]) == pytest.approx(1, abs=1e-9)


def test_counts_of_training_and_all_texts(spark):
    counted = ctw.byte_counts(spark.createDataFrame([("ab", True), ("ab", False), (None, False)], "text string, training boolean")).collect()
    got = {r["code"]: (r["n"], r["seen"]) for r in counted}
    assert got == {97: (1, 2), 97 << 32 | 98: (1, 2), (98 << 32) | (97 << 24): (1, 2), 0: (0, 1)}


def test_edges(spark):
    assert ctw.scores(spark.createDataFrame([], DOCS)).count() == 0
    one = next(i for i in range(99) if is_held_out(i))
    got = ctw.scores(spark.createDataFrame([(one, "abc", "", "", 0), (one, "abc", "", "", 0)], DOCS)).collect()
    assert [(r["train_tokens"], r["n_tokens"], r["base_score"], round(r["score"], 6)) for r in got] == [(0, 2, 0.0, round(-4 * math.log10(256), 6))] * 2
    got = ctw.scores(spark.createDataFrame([(None, None, "", "", 0)], DOCS)).collect()
    assert [(r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(False, 1, 1, 1)]
