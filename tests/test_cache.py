"""Caches that grow by deltas, and commits."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicatrix.sources import cache as caches
from indicatrix.sources import commits
from indicatrix.sources.cache import KeyedCache
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def files_below(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def store(spark, tmp_path):
    return KeyedCache(spark, str(tmp_path / "cache"), SCHEMA, ("k",), buckets=8)


def test_newest_merge_wins(spark, table, store):
    assert store.read().count() == 0 and store.rows().columns == ["k", "v"]
    store.merge(table([("a", 9), ("b", 1), (None, 3)], SCHEMA))
    store.merge(table([("a", 2), ("c", 4), ("c", 5)], SCHEMA))
    assert rows(store.read()) == [(None, 3), ("a", 2), ("b", 1), ("c", 4)]
    assert rows(store.read(within=table([("a",), ("a",), ("x",)], "k string"))) == [("a", 2)]
    assert store.rows().count() == 5
    assert store.merge(table([], SCHEMA)) == 2


def test_order_goes_before_age(spark, table, tmp_path):
    store = KeyedCache(spark, str(tmp_path / "c"), SCHEMA, ("k",), (F.col("v").desc_nulls_last(),))
    for batch in ([("a", 5), ("b", None)], [("a", 3), ("b", 1)], [("a", 5)]):
        store.merge(table(batch, SCHEMA))
    store.compact()
    assert rows(store.read()) == [("a", 5), ("b", 1)]


def test_a_merge_writes_its_rows_alone(spark, table, store):
    store.merge(spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("v")))
    store.compact()
    before = files_below(store.path)
    size = sum(map(os.path.getsize, before))
    store.merge(table([("7", 1), ("new", 1)], SCHEMA))
    added = files_below(store.path) - before
    assert before <= files_below(store.path) and 1 <= len(added) <= 2
    assert sum(map(os.path.getsize, added)) < size / 10
    assert store.read().count() == 20_001 and rows(store.read().filter("k = '7'")) == [("7", 1)]


def test_heavy_and_many_deltas_are_compacted_by_bucket(spark, table, store):
    for n in range(caches.MOST_DELTAS + 1):
        store.merge(table([("a", n)], SCHEMA))
    _, state = commits.latest(spark, store.path)
    assert len(state["bases"]) == 1 and state["deltas"] == []
    store.merge(table([("b", 1)], SCHEMA))
    _, state = commits.latest(spark, store.path)
    assert len(state["bases"]) == 1 and len(state["deltas"]) == 1
    assert rows(store.read()) == [("a", caches.MOST_DELTAS), ("b", 1)]
    store.merge(table([("a", 100)], SCHEMA))
    store.merge(table([("a", 101)], SCHEMA))  # two of the size of the base
    assert rows(store.read()) == [("a", 101), ("b", 1)]
    # Nothing but what the last two commits name is left.
    store.compact()
    store.compact()
    assert len({p.split("/")[-3] for p in files_below(store.path)}) == 2


def test_what_a_broken_merge_leaves_is_not_read(spark, table, store, monkeypatch):
    store.merge(table([("a", 1)], SCHEMA))

    def broken(*args):
        raise OSError("stopped here")

    monkeypatch.setattr(commits, "commit", broken)
    with pytest.raises(OSError):
        store.merge(table([("a", 2), ("b", 2)], SCHEMA))
    monkeypatch.undo()
    assert rows(store.read()) == [("a", 1)]
    store.merge(table([("b", 3)], SCHEMA))
    assert rows(store.read()) == [("a", 1), ("b", 3)]
    store.compact()
    assert rows(store.read()) == [("a", 1), ("b", 3)]


def test_a_reader_keeps_its_state(spark, table, store):
    store.merge(table([("a", 1)], SCHEMA))
    old = store.read()
    store.merge(table([("a", 2)], SCHEMA))
    assert rows(old) == [("a", 1)]
    store.compact()
    assert rows(old) == [("a", 1)]


def test_commits_are_taken_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert commits.latest(spark, path) == (0, {}) and commits.get(spark, f"{path}/none.json") is None
    commits.commit(spark, path, 1, {"a": ["é", 1]})
    with pytest.raises(RuntimeError):
        commits.commit(spark, path, 1, {"a": 2})
    commits.commit(spark, path, 2, {"a": 2})
    assert commits.latest(spark, path) == (2, {"a": 2})
    commits.drop_before(spark, path, 2)
    assert commits.numbers(spark, path) == [2]
    assert not commits.put_new(spark, f"{path}/_commits/{2:012d}.json", {}) and [f for f in os.listdir(f"{path}/_commits") if "." == f[0] and not f.endswith(".crc")] == []
