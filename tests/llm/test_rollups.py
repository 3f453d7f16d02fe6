import tempfile

from indicatrix.llm import rollups
from tests.llm.common import DOCS, frame

CHANGES = "op string, source string, lang string, tokenizer string, tokens long, old_tokens long"


def totals(rollup):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in rollup.totals().collect()}


def test_batches(spark):
    rollup = rollups.Rollup(spark, tempfile.mkdtemp(prefix="rollup-") + "/r")
    assert totals(rollup) == {}
    make = lambda rows: spark.createDataFrame(rows, CHANGES)
    first = make([("insert", "a", "en", "v1", 5, None), ("insert", "a", "en", "v1", 7, None), ("insert", None, None, "v1", None, None), ("?", "a", "en", "v1", 99, None)])
    assert rollup.commit("1", first) and not rollup.commit("1", first)
    assert totals(rollup) == {("a", "en", "v1"): (2, 12), (None, None, "v1"): (1, 0)}
    rollup.commit("2", make([("revise", "a", "en", "v1", 9, 7), ("delete", None, None, "v1", 0, None)]))
    rollup.commit("3", make([]))
    assert totals(rollup) == {("a", "en", "v1"): (2, 14)}
    rollup.compact("x")
    assert totals(rollup) == {("a", "en", "v1"): (2, 14)}
    assert not rollup.commit("2", first)
    rollup.commit("4", make([("delete", "a", "en", "v1", 5, None), ("delete", "a", "en", "v1", 9, None)]))
    assert totals(rollup) == {}
    rollup.compact("y")
    assert totals(rollup) == {} and not rollup.commit("1", first)


def test_unfinished_batch_does_not_count(spark):
    import os

    path = tempfile.mkdtemp(prefix="rollup-") + "/r"
    rollup = rollups.Rollup(spark, path)
    rows = spark.createDataFrame([("insert", "a", "en", "v1", 5, None)], CHANGES)
    rollup.commit("1", rows)
    os.rename(f"{path}/batch-1/_SUCCESS", f"{path}/batch-1/_broken")
    assert totals(rollup) == {}
    assert rollup.commit("1", rows)
    assert totals(rollup) == {("a", "en", "v1"): (1, 5)}


def test_history(spark):
    rows = [(1, "a | b " * 10, "en", "s", 0), (2, "short", "en", "s", 0), (3, None, None, None, 0), (4, "é" * 50, "fr", "s", 0), (4, "é" * 50, "fr", "s", 0)]
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in rollups.token_totals(frame(spark, rows)).collect()}
    assert got == {
        ("s", "en", "words@1"): (2, 31), ("s", "en", "words@2"): (2, 21), ("s", "en", "bytes@1"): (2, 65),
        ("s", "fr", "words@1"): (2, 2), ("s", "fr", "words@2"): (2, 2), ("s", "fr", "bytes@1"): (2, 200),
        (None, None, "words@1"): (1, 0), (None, None, "words@2"): (1, 0), (None, None, "bytes@1"): (1, 0),
    }
    assert rollups.token_totals(spark.createDataFrame([], DOCS)).count() == 0
