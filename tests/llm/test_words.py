import numpy as np
import pyarrow as pa

from indicatrix.llm.words import Hasher, bounds, buffers, chunks
from tests.llm.common import ascii_lower, corpus, words


def test_words_and_hashes():
    texts = [r[1] for r in corpus(9, 50)]
    data, offsets = buffers(pa.array(["skip", *texts]).slice(1))
    hasher, seen, got = Hasher(3, lower=True), {}, []
    for first, last, part, cuts in chunks(data, offsets, 200):
        starts, ends, text = bounds(part, cuts)
        hashes = hasher.words(part, starts, ends)
        got += [(first + t, part[s:e].tobytes().decode()) for s, e, t in zip(starts, ends, text)]
        for s, e, h in zip(starts, ends, hashes):
            assert seen.setdefault(ascii_lower(part[s:e].tobytes().decode()), h) == h
    assert got == [(i, w) for i, t in enumerate(texts) for w in words(t)]
    assert len(set(seen.values())) == len(seen)


def test_spans_agree_wherever_they_stand():
    x = np.random.default_rng(1).integers(0, 9, 300, dtype=np.uint64) + np.uint64(1)
    x[200:250] = x[:50]
    h = Hasher(5)
    at = np.arange(281)
    out = h.spans(x, at, at + 20)
    assert (out[200:231] == out[:31]).all()
    assert len(np.unique(out)) == len({tuple(x[i : i + 20]) for i in at})
