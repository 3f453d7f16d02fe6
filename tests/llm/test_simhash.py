import random

import pytest
import xxhash

from indicatrix.llm import simhash
from tests.llm.common import DOCS, ascii_lower, corpus, frame, words


def fingerprint(text):
    ws = words(ascii_lower(text))
    if not ws:
        return 0
    shingles = [" ".join(ws)] if len(ws) < 3 else [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius=2):
    """Smallest key reachable, by union of all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def check(spark, rows):
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(frame(spark, rows)).collect())
    fps = [fingerprint(r[1]) for r in rows]
    assert got == [(r[0], f"{fp:016x}", c) for r, fp, c in zip(rows, fps, components(fps))]


def test_documents(spark):
    check(spark, corpus(3, 80))


def test_repeated_rows_and_empty_table(spark):
    rows = corpus(4, 5)
    got = simhash.near_duplicates(frame(spark, rows + rows[:2])).collect()
    assert len(got) == len(rows) + 2
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_null_ids(spark):
    got = simhash.near_duplicates(spark.createDataFrame([(None, "a b c d", "", "", 0), (5, "a b c d", "", "", 0)], DOCS)).collect()
    assert {r["component_id"] for r in got} == {5}


@pytest.mark.parametrize("limit", [0, 3, 64])
def test_links_against_all_pairs(spark, limit):
    """Chains and clouds of fingerprints; with a small limit the crowded cells decide."""
    rng = random.Random(limit)
    values = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(15):
            values.add(x)
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                x ^= 1 << b
    values = sorted(values)
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    links = simhash.near_pairs(df, 2, limit)
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    got = {}
    for v in values:
        got.setdefault(roots.get(simhash.signed(v), simhash.signed(v)), set()).add(v)
    want = {}
    for v, c in zip(values, components(values)):
        want.setdefault(c, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_cell_distance_bounds_hamming(spark):
    rng = random.Random(5)
    pairs = [(simhash.signed(rng.getrandbits(64)), simhash.signed(rng.getrandbits(64))) for _ in range(200)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(pairs, "a long, b long")
    apart = df.select("a", "b", F.bit_count(simhash.cell_of(F.col("a")).bitwiseXOR(simhash.cell_of(F.col("b")))).alias("d")).collect()
    for a, b, d in apart:
        popcounts = [abs((a >> s & 3).bit_count() - (b >> s & 3).bit_count()) for s in range(0, 64, 2)]
        assert d == sum(popcounts) <= ((a ^ b) & (2**64 - 1)).bit_count()


def test_long_chain(spark):
    df = spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long")
    assert {tuple(r) for r in simhash.components(df).collect()} == {(i, 0) for i in range(41)}


def test_stars_against_all_pairs():
    """Links of one task, among them chains in any order, a hub whose number is the greatest, and none."""
    import numpy as np

    rng = random.Random(8)
    for n in (0, 1, 5, 300):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)]
        chain = rng.sample(range(1000, 1000 + n), n)
        links += [*zip(chain, chain[1:]), *((5000 + n, 2000 + i) for i in range(n))]
        links = [(a, b) for a, b in links if a != b]
        root = {x: x for link in links for x in link}
        for _ in root:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        a, b = (np.array([link[i] for link in links], np.int64) for i in range(2))
        nodes, roots = simhash.stars(a, b)
        assert dict(zip(nodes.tolist(), roots.tolist())) == {x: r for x, r in root.items() if x != r} and len(nodes) <= len(links)


@pytest.mark.parametrize("limit", [40, 1 << 20])
def test_shortened_links_join_the_same_nodes(spark, monkeypatch, limit):
    """However the links are cut into tasks and blocks, components are the same."""
    rng = random.Random(limit)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    links += [*links[:40], *((i, i + 1) for i in rng.sample(range(1000, 1090), 90)), *((-7, i) for i in range(2000, 2100))]
    root = {x: x for a, b in links if a != b for x in (a, b)}
    for _ in range(100):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    monkeypatch.setattr(simhash, "HELD", limit)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        found = simhash.components(spark.createDataFrame(links, "a long, b long").repartition(3))
        assert sorted(map(tuple, found.collect())) == sorted(root.items())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_components_write_few_tables(spark, monkeypatch):
    """Stars need no round, and links of a few tasks need few: the driver holds the plans and tasks of every table for long."""
    names = []

    def counted(df, name):
        names.append(name)
        return kept(df, name)

    kept = simhash.stored
    monkeypatch.setattr(simhash, "stored", counted)
    hub = spark.createDataFrame([(i, 0) for i in range(1, 200)], "a long, b long").repartition(8)
    assert {tuple(r) for r in simhash.components(hub).collect()} == {(i, 0) for i in range(200)} and names == ["links", "links", "lows"]
    names.clear()
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(8)
    assert {r["root"] for r in simhash.components(chain).collect()} == {0} and names == ["links", "links", "lows"]


def test_few_links_are_joined_without_a_shuffle(spark, monkeypatch):
    """What one task holds needs no more than that task, however many partitions shuffles have."""
    plans = {}

    def noted(df, name):
        plans[name] = df.rdd.getNumPartitions(), df._jdf.queryExecution().toString()
        return kept(df, name)

    kept = simhash.stored
    monkeypatch.setattr(simhash, "stored", noted)
    links = [(i, i + 1) for i in range(50)] + [(-3, 70), (70, 71), (90, 90)]
    found = simhash.components(spark.createDataFrame(links, "a long, b long").repartition(6))
    assert sorted(map(tuple, found.collect())) == [(-3, -3), *((i, 0) for i in range(51)), (70, -3), (71, -3)]
    assert plans["lows"][0] == 1 and "Exchange" not in plans["lows"][1]
    assert simhash.components(spark.createDataFrame([(5, 5)], "a long, b long")).collect() == []
