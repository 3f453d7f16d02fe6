"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check_queries
from indicatrix.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
# These answers are single rows of measures, or counts that may be empty on tiny tables.
MAY_BE_EMPTY = {"f4_label_risk", "f4_country_risk", "f4_entropy_risk", "f5_score_risk", "b5_files_of_day", "a12_trailing_days", "a13_listed_days"}


@pytest.fixture(scope="module")
def db():
    return check_queries.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    problem = check_queries.compare(spark, db, SF, name)
    if name in MAY_BE_EMPTY and problem == "agree, but no rows":
        return
    assert problem == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "domain"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
