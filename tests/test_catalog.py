"""Every registered query against DuckDB, and what its plan must not contain."""

import re

import pytest

from tests.compare import difference, duck
from voxscope.catalog import entries

FOLDER = "/root/testdata/sf0.001"
NEVER = ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(entries()))
def test_same_rows_as_duckdb(spark, con, name):
    assert difference(spark, FOLDER, name, con, NEVER) is None


@pytest.mark.parametrize("name", [
    "heat_of_clean_comments", "dedup_keep_first", "burst_spam_filter", "attach_user_stats", "upsert_partial",
    "edges_touching_top_nodes", "tokenize_filtered", "naive_bayes_parameters", "minmax_normalise", "tfidf"])
def test_plan_has_no_cross_join_and_no_python(spark, name):
    from voxscope.catalog.base import Tables

    plan = entries()[name].run(Tables(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]


@pytest.mark.parametrize("name", ["dedup_keep_first", "cap_per_group", "latest_per_key"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    from voxscope.catalog.base import Tables

    plan = entries()[name].run(Tables(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    below = plan[re.search("Exchange hashpartitioning", plan).end():]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
