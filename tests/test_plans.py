"""Plan guards over every registered query: no cross joins, no Python evaluation."""

import re

import pytest

from chronoleaf.plans.queries import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name} plan contains {bad}"


def test_pushdown_and_pruning_reach_the_scan(spark):
    df = QUERIES["split_before"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts,2024-01-23" in plan
    df = QUERIES["asof_user"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the feature side reads only the columns the lookup needs
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def _count(plan: str, op: str) -> int:
    return len(re.findall(op, plan))


@pytest.mark.parametrize("name", ["feat_user", "feat_destination", "rolling_mean_price",
                                  "asof_availability"])
def test_one_shuffle_one_sort_one_window(spark, name):
    # all window lengths of a feature group (or both sides of an as-of) share one
    # exchange by key and one sort; ordinary keys need no carry rows
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().toString()
    assert _count(plan, r"Exchange hashpartitioning") == 1
    assert _count(plan, r"Sort \[") == 1
    assert _count(plan, r"Window \[") == 1


def test_dimension_lookup_is_broadcast_without_shuffle(spark):
    plan = QUERIES["lookup_location"](spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
