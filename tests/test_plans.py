"""Physical-plan properties the scale design depends on."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def _plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def _no_cartesian(plan):
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan


def test_flagship_aggregates_before_joining_and_prunes(spark):
    plan = _plan(spark, "flagship_insight")
    _no_cartesian(plan)
    # lineitem is read with only the three columns the model uses
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>", plan)
    # the customer side is reduced to one row per key before it is joined
    first_join = min(plan.index(j) for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if j in plan)
    assert "Aggregate" in plan[first_join:]


def test_upsert_is_a_plain_anti_join(spark):
    plan = _plan(spark, "upsert_keyed")
    assert "LeftAnti" in plan
    assert "isNullAwareAntiJoin=true" not in plan.replace(" ", "")
    _no_cartesian(plan)


def test_relation_diff_is_one_aggregation(spark):
    plan = _plan(spark, "relation_diff")
    assert "Join" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan


def test_snapshot_merge_single_full_outer_join(spark):
    plan = _plan(spark, "snapshot_merge")
    assert plan.count("FullOuter") == 1
    _no_cartesian(plan)


def test_high_water_mark_is_a_scalar_subquery(spark):
    plan = _plan(spark, "incremental_highwater")
    assert "Subquery" in plan
    _no_cartesian(plan)


def test_filters_reach_the_scan(spark):
    plan = _plan(spark, "filter_predicates")
    assert "PushedFilters: [Or(" in plan, plan
    plan = _plan(spark, "incremental_first")
    assert "LessThan(ts," in plan


def test_set_operations_need_no_join(spark):
    for name in ("set_except", "set_intersect", "relation_diff"):
        assert "Join" not in _plan(spark, name)


def test_column_stats_is_one_scan(spark):
    plan = _plan(spark, "column_stats")
    assert plan.count("FileScan") == 1
    assert "Join" not in plan
