"""Plan properties of the registered queries: no Python evaluation, no
cartesian or nested-loop joins, pruned scans, and the expected partial
aggregates and window limits."""

import re

import pytest

from postclust.plans.catalog import QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join(spark, sf_small, name):
    plan = _plan(QUERIES[name](spark, sf_small))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def _read_schema(plan: str, table: str) -> set[str]:
    cols = set()
    for line in plan.splitlines():
        if f"{table}.parquet" in line:
            m = re.search(r"ReadSchema: struct<([^>]*)>", line)
            if m:
                cols |= {c.split(":")[0] for c in m.group(1).split(",")}
    return cols


def test_scans_are_pruned(spark, sf_small):
    plan = _plan(QUERIES["q_scored_questions"](spark, sf_small))
    assert _read_schema(plan, "lineitem") == {"l_orderkey", "l_linenumber", "l_extendedprice"}
    assert _read_schema(plan, "orders") == {"o_orderkey", "o_orderpriority"}
    plan = _plan(QUERIES["q_grouped_counts"](spark, sf_small))
    assert _read_schema(plan, "lineitem") == {"l_orderkey", "l_linenumber"}


def test_partial_aggregates_before_shuffle(spark, sf_small):
    plan = _plan(QUERIES["q_scored_questions"](spark, sf_small))
    assert "partial_max" in plan and "partial_min" in plan
    plan = _plan(QUERIES["q_weighted_points"](spark, sf_small))
    assert "partial_count" in plan


def test_seed_sample_limits_groups_before_shuffle(spark, sf_small):
    plan = _plan(QUERIES["q_sample_per_language"](spark, sf_small))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    plan = _plan(QUERIES["q_sample_global"](spark, sf_small))
    assert "TakeOrderedAndProject" in plan
