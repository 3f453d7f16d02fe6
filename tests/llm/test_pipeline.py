"""The pipeline and the registered queries on the small tables."""

import inspect
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
import check_queries
import corpus_pipeline
from indicatrix.llm import decontaminate, queries
from indicatrix.llm.store import discard, stored
from indicatrix.session import configure
from tests.llm.common import words
from tests.llm.test_near_copies import brute as groups_of_all_pairs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialise(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_near_duplicates_leave_one_of_each(stages):
    """Against all pairs: groups of texts whose five-word shingles have a similarity of 0.8 or more, the smallest id of each stays."""
    before, after = stages["near_duplicates"]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    assert ids(after) == sorted({rows[i][0] for i in groups_of_all_pairs([t for _, t in rows])})


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    found = decontaminate.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
    bad = {r["doc_id"] for r in found.collect()}
    assert bad and ids(after) == [i for i in ids(before) if i not in bad]
    # Brute force: a document that holds an item's words in a row is gone.
    items = [" " + " ".join(words(r["text"].lower())) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in after.collect():
        text = " " + " ".join(words(r["text"].lower())) + " "
        assert not any(i in text for i in items)


def test_secrets_keep_all_documents(stages):
    before, after = stages["secrets"]
    assert ids(before) == ids(after)
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    changed = [r for r in after.collect() if r["text"] != old[r["doc_id"]]]
    assert changed and all("[SECRET]" in r["text"] and r["n_chars"] == len(r["text"]) for r in changed)


def test_mix(stages):
    before, after = stages["mixing"]
    rows = after.collect()
    assert set(ids(after)) <= set(ids(before)) and all(0 < r["taken"] <= 3 * r["size"] for r in rows)
    taken, target = {}, {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows_and_names(spark, name, stage):
    """Every stage: nulls in any column, repeated rows, a very long text, columns named like those in use, and no rows."""
    plain = [(1, "a plain text of some words", "en", "a", 26), (1, "a plain text of some words", "en", "a", 26), (2, None, None, None, None), (2, "", "en", "b", 0)]
    rows = [*plain, (None, "words without an id but five or more", "de", "a", 36), (3, "long text " * 60_000, "en", "b", 600_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["_row", "_score", "score", "matches", "spans", "base", "n_assign", "_key", "_id", "_text", "_body", "_tested", "root"]
    docs = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    out = stage(spark, docs, SF)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = out.collect()
    assert all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in got for n in names)
    ids_ = sorted((r["doc_id"] or 0) for r in got)
    assert ids_ == {"near_duplicates": [0, 1, 2, 3], "mixing": [0, 1, 1, 3]}.get(name, [0, 1, 1, 2, 2, 3]) or name == "mixing"
    assert {r["text"] for r in got} <= {r[1] for r in rows}
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_run(spark, stages):
    assert ids(corpus_pipeline.run(spark, SF)) == ids(stages["mixing"][1])


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_with_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert check_queries.compare(spark, db, SF, name) == ""


def test_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_native_operators_use_no_python():
    from indicatrix.llm import chat, secrets

    for module in (chat, secrets):
        source = inspect.getsource(module)
        assert not any(x in source for x in ("udf", "InArrow", "InPandas", ".rdd", "import pandas", "import numpy"))


def test_nothing_else_imports_the_subpackage():
    root = pathlib.Path(queries.__file__).parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text(), path


def test_lists_of_files_do_not_stay_in_the_driver(spark):
    """Spark would keep those of every table that was read, also of deleted ones, as long as the session lasts."""
    configure(spark)
    cache = spark._jvm.org.apache.spark.sql.execution.datasources.FileStatusCache.getOrCreate(spark._jsparkSession)
    table = stored(spark.range(10).repartition(3), "rows")
    files = table.inputFiles()
    assert table.count() == 10 and len(files) > 1
    assert cache.getClass().getSimpleName() == "NoopCache$"
    discard(table)
