"""Properties of physical plans that matter at scale."""

import re

import pytest

import __spark_entry__ as entry
from indicatrix.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
# Queries that need Python in the plan: vectors turned into arrays.
PYTHON = {"k1_gram_vectors", "k2_category_vectors", "k4_vector_widths", "k12_model_registry", "k13_scored_threats"}
LAZY = [
    name
    for name in QUERIES
    if not name.startswith(("k10", "k11", "k12", "k13", "j", "a3", "a4", "a5", "a7", "a8", "a9", "a10", "a16", "q9_stat", "a6", "a11", "a18", "a21"))
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_plan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    if name not in PYTHON:
        assert "EvalPython" not in plan and "InPandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Windows over all rows stand above an aggregation to a table of known small size.
    for block in re.findall(r"Window \[[^\n]*", plan):
        if "windowspecdefinition(" in block and not re.search(r"\], \[[^\]]+\], \[", block):
            assert name in ("f13_drift", "f8_score_summary", "f11_latency", "k6_roc_auc", "k7_average_precision", "k8_recall_at_fpr", "k14_model_comparison"), block


def test_scans_read_only_what_is_needed(spark):
    queries = entry.queries()
    plan = plan_of(queries["f1_dns_summary"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in plan
    plan = plan_of(queries["c6_registered_domain"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    plan = plan_of(queries["f7_score_by_bucket"](spark, SF))
    assert "text" not in plan[plan.index("FileScan") :].split("ReadSchema")[1]


def test_same_addresses_are_shuffled_once(spark):
    df = entry.queries()["f1_dns_summary"](spark, SF)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_picks_cut_groups_before_the_shuffle(spark):
    for name in ("g1_malware_silver", "g3_union_labels", "g7_upsert_whois", "g8_latest_ct", "g9_first_ct"):
        plan = plan_of(entry.queries()[name](spark, SF))
        assert plan.count("WindowGroupLimit") >= 2, name
