from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from indicatrix.session import build_session  # noqa: E402


# Started on import, because test modules hold column expressions.
SESSION = build_session(
    "tests",
    "local[8]",
    **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-"),
    },
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def table(spark):
    """A DataFrame out of rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def values(spark):
    """Values of one expression over a list of texts."""

    def apply(texts, expression, kind="string"):
        rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], f"i int, x {kind}")
        return [r[0] for r in rows.orderBy("i").select(expression).collect()]

    return apply


def rows(df, *columns):
    """Rows as sorted plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
