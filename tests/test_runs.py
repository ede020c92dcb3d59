"""Upserts kept as runs: equal to upserts that rewrite, batch after batch."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelsmith.operators.incremental import plan_upsert
from modelsmith.operators.project import Project
from modelsmith.operators.publish import Layout
from modelsmith.operators.runs import merge_from, resolve_runs
from modelsmith.operators.schema_change import SchemaChangeError
from modelsmith.plans.upkeep_store_queries import upsert_batches
from tests.conftest import SF_CHECK, rows

SCHEMA = "k int, part string, v int"


def _rewritten(frames, keys):
    target = frames[0]
    for f in frames[1:]:
        target = plan_upsert(target, f, keys)
    return target


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["a", None]), st.integers(0, 9)), max_size=6),
                min_size=1, max_size=4), st.sampled_from(["k", ["k", "part"]]))
def test_any_runs(spark, batches, keys):
    """NULL keys, repeated keys in a batch, empty batches; also with a suffix of the runs merged first."""
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    expected = rows(_rewritten(frames, keys))
    assert rows(resolve_runs(frames, keys)) == expected
    half = len(frames) // 2
    assert rows(resolve_runs([*frames[:half], resolve_runs(frames[half:], keys)], keys)) == expected


def test_columns_named_as_the_helpers(spark):
    a = spark.createDataFrame([(1, 2, 3), (2, 2, 3)], "_seq int, _last int, _SEQ_ int")
    b = spark.createDataFrame([(1, 9, 9)], "_seq int, _last int, _SEQ_ int")
    assert rows(resolve_runs([a, b], "_seq")) == [(1, 9, 9), (2, 2, 3)]


def test_merges_follow_a_binary_counter():
    assert merge_from([]) == 0 and merge_from([5]) == 0
    assert merge_from([1000, 10]) == 1 and merge_from([1000, 10, 10]) == 1
    assert merge_from([1000, 20, 10, 10]) == 1 and merge_from([10, 1000]) == 0
    runs, written = [], 0
    for _ in range(1000):
        runs.append(10)
        written += 10
        start = merge_from(runs)
        if start < len(runs) - 1:
            written += sum(runs[start:])
            runs[start:] = [sum(runs[start:])]
        assert len(runs) <= 11
    assert sum(runs) == 10_000 and written <= 11 * 10_000


def _size(project, name, runs):
    folder = os.path.dirname(project.spark.table(project.publisher.run_table(name, runs[-1][0])).inputFiles()[0]).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet"))


def test_builder_equals_the_rewriting_builder_over_four_batches(spark):
    project = Project(spark, "upsert_by_runs")
    for i, batch in enumerate(upsert_batches(spark, SF_CHECK)):
        got = project.incremental_runs("orders_runs", batch, "o_orderkey", comment="orders" if i == 0 else None)
        want = project.incremental("orders_rewritten", batch, "o_orderkey")
        assert rows(got) == rows(want)
    assert project.publisher.stored_comments("orders_runs")[0] == "orders"
    assert rows(project.compact_runs("orders_runs")) == rows(want)
    assert len(project.publisher.upsert_runs("orders_runs")[1]) == 1
    project.drop("orders_runs")
    project.drop("orders_rewritten")
    assert not [t for t in project.publisher._tables() if t.startswith("orders_")]


def test_a_small_batch_writes_a_small_run_and_leaves_the_target(spark):
    project = Project(spark, "upsert_small")
    orders = upsert_batches(spark, SF_CHECK)[0]
    project.incremental_runs("o", orders, "o_orderkey")
    pub = project.publisher
    base = pub.upsert_runs("o")[1]
    files = set(spark.table(pub.run_table("o", base[0][0])).inputFiles())
    whole = _size(project, "o", base)
    project.incremental_runs("o", orders.where("o_orderkey % 500 = 0").withColumn("o_totalprice", F.lit(1.0)), "o_orderkey")
    runs = pub.upsert_runs("o")[1]
    assert runs[0] == base[0] and len(runs) == 2
    assert set(spark.table(pub.run_table("o", base[0][0])).inputFiles()) == files
    assert _size(project, "o", runs) < whole / 10
    assert project.ref("o").count() == orders.count()
    project.incremental_runs("o", orders.where("false"), "o_orderkey")  # an empty batch leaves no run
    assert pub.upsert_runs("o")[1] == runs and pub.runs("o") == [r for r, _ in runs]
    project.drop("o")


def test_schema_changes_keys_and_refresh(spark):
    project = Project(spark, "upsert_changes")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3), (None, "n", 0)], SCHEMA)
    wider = spark.createDataFrame([(2, "bb", 5_000_000_000, True)], "k int, part string, v long, seen boolean")
    project.incremental_runs("m", first, "k")
    with pytest.raises(SchemaChangeError):
        project.incremental_runs("m", wider, "k", on_schema_change="fail")
    assert rows(project.ref("m")) == rows(first)
    got = project.incremental_runs("m", wider, "k", on_schema_change="append_new_columns")
    want = plan_upsert(first, wider, "k", "append_new_columns")
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    # another key: what was resolved with the old key is settled first
    got = project.incremental_runs("m", spark.createDataFrame([(9, "a", 7, None)], wider.schema), "part")
    assert sorted(r.part for r in got.collect()) == ["a", "bb", "c", "n"]
    assert {r.k for r in got.collect() if r.part == "a"} == {9}
    with pytest.raises(ValueError, match="lack the unique key"):
        project.incremental_runs("m", first, "absent")
    with pytest.raises(ValueError, match="kept as runs"):
        project.incremental("m", first, "k")
    assert rows(project.incremental_runs("m", first, "k", full_refresh=True)) == rows(first)
    assert rows(project.incremental("m", first.limit(1), "k", full_refresh=True)) == rows(first.limit(1))
    assert not project.publisher.runs("m") and project.publisher.upsert_runs("m") is None
    project.drop("m")


def test_a_versioned_model_and_a_plain_table_become_the_oldest_run(spark):
    project = Project(spark, "upsert_adopt")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    new = spark.createDataFrame([(2, "z", 9)], SCHEMA)
    want = rows(plan_upsert(first, new, "k"))
    project.incremental("m", first, "k", comment="kept", layout=Layout(order_by=["k"]))
    assert rows(project.incremental_runs("m", new, "k")) == want
    assert project.publisher.stored_comments("m")[0] == "kept"
    assert tuple(project.publisher.stored_layout("m", ["k"]).order_by) == ("k",)
    first.write.saveAsTable("upsert_adopt.plain")
    assert rows(project.incremental_runs("plain", new, "k")) == want
    for name in ("m", "plain"):
        project.drop(name)


def test_an_interrupted_build_leaves_the_model(spark):
    project = Project(spark, "upsert_orphan")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    project.incremental_runs("m", first, "k")
    project.publisher.write_upsert_run("m", first.where("k = 1"))  # written, never published
    assert rows(project.ref("m")) == rows(first)
    assert project.publisher.drop_orphans() == ["m__run2"]
    assert rows(project.ref("m")) == rows(first)
    project.drop("m")


def test_reading_is_anti_joins_on_keys_of_newer_runs(spark):
    plan = resolve_runs(upsert_batches(spark, SF_CHECK), "o_orderkey")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == plan.count("Join ") == 3  # one for each run but the newest
    # the newest runs' side of each join is reduced to one row a key before it is joined
    assert plan.count("Aggregate [o_orderkey") == 3
