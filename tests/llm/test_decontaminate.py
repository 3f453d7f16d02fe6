import random

import numpy as np
import pytest

from indicatrix.llm import decontaminate
from indicatrix.llm.words import Hasher
from tests.llm.common import DOCS, ascii_lower, frame, words

ITEMS = "item_id long, text string, matches string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def data(seed=1):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(20)]
    new = lambda n: [rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abdefg") for _ in range(6)) for _ in range(n)]
    items = [new(rng.randint(15, 55)) for _ in range(30)]
    docs, truth = [], set()
    for i in range(200):
        ws = new(rng.randint(0, 300))
        if i % 4 == 0:
            k = rng.randrange(len(items))
            part = list(items[k])
            if i % 8 == 0:  # reworded: a few words changed or dropped
                for _ in range(len(part) // 10):
                    part[rng.randrange(len(part) - 5)] = "zzz"
            at = rng.randint(0, len(ws))
            ws[at:at] = part
            truth.add((i, k))
        docs.append((i, " ".join(ws).title() if i % 3 else "\n".join(ws), "en", "s", 0))
    docs += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, " ".join(new(20_000) + items[3]), "en", "s", 0)]
    return docs, [(k, " ".join(t), "x") for k, t in enumerate(items)], truth | {(902, 3)}


@pytest.fixture(scope="module")
def case():
    return data()


def test_planted_passages(spark, case):
    docs, items, truth = case
    got = decontaminate.contamination(frame(spark, docs).drop("matches"), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == truth
    texts = {d[0]: words(ascii_lower(d[1])) for d in docs}
    for r in got:
        item = words(items[r["item_id"]][1])
        assert r["item_words"] == len(item)
        assert 0.8 * len(item) <= r["lcs"] <= lcs(item, texts[r["doc_id"]]) or r["answered"]


def test_candidates_recall(spark, case):
    """Every passage that holds most of an item is a candidate: recall of the index against brute force."""
    docs, items, truth = case
    hasher = Hasher(seed=7, lower=True)
    df = spark.createDataFrame(docs, DOCS)
    block = decontaminate.Items([{"item_id": k, "text": t} for k, t, _ in items], hasher)
    idf = decontaminate.idf_of(df.select("text"), block, hasher)
    basis = decontaminate.latent_basis(df.select("text", "doc_id"), block, idf, hasher)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-8)
    search = decontaminate.Search(block, idf, basis, hasher, 0.25, 0.0, 0.0)
    import pyarrow as pa

    found = search.find(pa.array([d[1] for d in docs]))
    pairs = {(d[0], i) for d, f in zip(docs, found) for i in f}
    assert len(pairs & truth) >= 0.9 * len(truth)


def all_passages(docs, block, idf, hasher):
    """A^T A over every passage of every document, by plain counting."""
    place = {int(h): i for i, h in enumerate(block.vocabulary)}
    out = np.zeros((len(place), len(place)))
    for d in docs:
        ws = ascii_lower(d[1] or "").encode().split()
        data = np.frombuffer(b" ".join(ws), np.uint8)
        ends = np.cumsum([len(w) + 1 for w in ws]) - 1
        hashes = hasher.words(data, ends - [len(w) for w in ws], ends) if ws else []
        index = [place.get(int(h), -1) for h in hashes]
        last = max(0, -(-(len(index) - decontaminate.PASSAGE) // decontaminate.STRIDE)) if index else -1
        for k in range(last + 1):
            part = index[k * decontaminate.STRIDE :][: decontaminate.PASSAGE]
            x = np.zeros(len(place))
            for i in part:
                if i >= 0:
                    x[i] += idf[i]
            x /= np.sqrt(sum(idf[i] ** 2 for i in part))
            out += np.outer(x, x)
    return out


@pytest.mark.parametrize("weight, frequent, gathered", [(1e9, 2_048, 1 << 20), (1.0, 40, 100)])
def test_basis_is_of_all_passages(spark, case, monkeypatch, weight, frequent, gathered):
    """The latent directions are those of the items and of every passage, also behind a text's first; none is left out."""
    docs, items, _ = case
    hasher = Hasher(seed=7)
    for name, value in (("RANK", 60), ("PASSAGE_WEIGHT", weight), ("FREQUENT", frequent), ("GATHERED", gathered), ("PIECE", 1000)):
        monkeypatch.setattr(decontaminate, name, value, raising=False)
    texts = [(d[0], ascii_lower(d[1] or ""), *d[2:]) for d in docs]
    df = spark.createDataFrame(texts, DOCS)
    block = decontaminate.Items([{"item_id": k, "text": t} for k, t, _ in items], hasher)
    idf = decontaminate.idf_of(df.select("text"), block, hasher)
    basis = decontaminate.latent_basis(df.select("text", "doc_id"), block, idf, hasher)
    row, column, value = decontaminate.item_matrix(block, idf)
    own = np.zeros((len(items), len(block.vocabulary)))
    np.add.at(own, (row, column), value)
    passages = all_passages(texts, block, idf, hasher)
    full = own.T @ own + min(1.0, weight * (own**2).sum() / np.trace(passages)) * passages
    # The same algorithm over the whole matrix, from the same random start.
    found = np.random.default_rng(7).standard_normal((len(full), min(60 + decontaminate.OVERSAMPLE, len(full))))
    for _ in range(2):
        found, _ = np.linalg.qr(full @ found)
    values, vectors = np.linalg.eigh(found.T @ full @ found)
    found = found @ vectors[:, ::-1][:, :60]
    assert np.allclose(np.abs(np.sum(found * basis, axis=0)), 1, atol=1e-6)


def test_items_keep_their_directions(spark, monkeypatch):
    """Passages that fill any space by themselves take none from the items: there are more directions than items."""
    rng = random.Random(4)
    items = [[f"w{40 * k + j}" for j in range(20)] for k in range(30)]
    pool = [w for t in items for w in t]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(400)), "en", "s", 0) for i in range(150)]
    monkeypatch.setattr(decontaminate, "RANK", 40)
    hasher, df = Hasher(seed=7), spark.createDataFrame(docs, DOCS)
    block = decontaminate.Items([{"item_id": k, "text": " ".join(t)} for k, t in enumerate(items)], hasher)
    # Weights as of a corpus in which the words are rare.
    idf = np.append(np.ones(len(block.vocabulary)), 1.0)
    basis = decontaminate.latent_basis(df.select("text", "doc_id"), block, idf, hasher)
    row, column, value = decontaminate.item_matrix(block, idf)
    own = np.zeros((len(items), len(block.vocabulary)))
    np.add.at(own, (row, column), value)
    assert np.linalg.norm(own @ basis, axis=1).min() >= 0.95


@pytest.mark.parametrize("n", [0, 1, 5, 3_000])
def test_lookup(n):
    rng = np.random.default_rng(n)
    some = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
    for vocabulary in (some, np.unique(some >> np.uint64(50)), np.arange(n, dtype=np.uint64)):
        place = {h: i for i, h in enumerate(vocabulary.tolist())}
        asked = np.concatenate([vocabulary, vocabulary + np.uint64(1), rng.integers(0, 1 << 64, 500, dtype=np.uint64)])
        assert decontaminate.Lookup(vocabulary)(asked).tolist() == [place.get(h, -1) for h in asked.tolist()]


def test_clean_documents_stay(spark, case):
    docs, items, truth = case
    kept = decontaminate.clean(frame(spark, docs), spark.createDataFrame(items, ITEMS))
    assert kept.columns == frame(spark, docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs} - {d for d, _ in truth}


def test_answers(spark):
    item = [f"q{i}" for i in range(20)]
    half = item[:6] + ["x"] * 3 + item[15:]
    bare = item[:11] + ["x"] * 9
    others = [(100 + i, " ".join(f"o{i}x{j}" for j in range(20)), "", "", 0) for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(half), "", "", 0), (2, " ".join(bare), "", "", 0), *others], DOCS)
    items = spark.createDataFrame([(7, " ".join(item), "q9 q10")], "item_id long, text string, answer string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, items).collect()}
    assert set(got) == {2} and got[2]["answered"]
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, items.drop("answer")).collect()}
    assert set(got) == {1} and got[1]["answered"]


def test_empty_tables(spark, case):
    docs, items, _ = case
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, None, ""), (2, " ", "")], ITEMS)
    assert decontaminate.contamination(none, spark.createDataFrame(items, ITEMS)).count() == 0
    assert decontaminate.contamination(spark.createDataFrame(docs, DOCS), no_items).count() == 0
    assert decontaminate.clean(spark.createDataFrame(docs, DOCS), no_items.limit(0)).count() == len(docs)


def test_repeated_items_and_documents(spark, case):
    docs, items, truth = case
    got = decontaminate.contamination(spark.createDataFrame(docs[:9] * 2, DOCS), spark.createDataFrame(items + items[:1], ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {t for t in truth if t[0] < 9}


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(100):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert decontaminate.common_subsequence(a, b) == lcs(a, b)


@pytest.mark.parametrize("size", [5, 12, 30])
def test_item_that_many_documents_hold(spark, size):
    rng = random.Random(size)
    new = lambda n: ["".join(rng.choice("abdefg") for _ in range(7)) for _ in range(n)]
    items = [new(size), *(new(rng.randint(15, 40)) for _ in range(20))]
    docs, truth = [], set()
    for i in range(300):
        ws = new(100)
        if i % 3 == 0:
            part = list(items[0])
            if i % 2 and size > 5:  # reworded: every sixth word
                part[2::6] = new(len(part[2::6]))
            at = rng.randint(0, 100)
            ws[at:at] = part
            truth.add((i, 0))
        docs.append((i, " ".join(ws), "en", "s", 0))
    got = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(k, " ".join(t), "x") for k, t in enumerate(items)], ITEMS))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == truth
