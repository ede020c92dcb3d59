"""Distinct words: equal to count(DISTINCT), mergeable in any order, appended without overlap."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelsmith.operators.distinct import BITS, DistinctCount, count_words, distinct_words, merge_words, unseen_words
from modelsmith.operators.project import Project
from modelsmith.sources.relations import read_table
from tests.conftest import SF_CHECK, rows

EDGES = [0, -1, 1, 63, 64, 65, -64, -65, 2**63 - 1, -(2**63), 2**31, None]


def _exact(df, group, value):
    return rows(df.groupBy(group).agg(F.count_distinct(value).alias("n")))


def test_edges_of_words_null_groups_and_groups_of_nulls(spark):
    data = [("a", v) for v in EDGES * 2] + [(None, 5), (None, 5), ("nulls", None)]
    df = spark.createDataFrame(data, "g string, v long")
    words = distinct_words(df, "g", "v")
    assert rows(count_words(words, "g")) == _exact(df, "g", "v") == rows(spark.createDataFrame([("a", 11), (None, 1), ("nulls", 0)], "g string, n long"))
    assert words.where("word = 0").select(F.bit_count(BITS).alias("n")).collect()[0].n == 3  # 0, 1 and 63 share one


@pytest.mark.parametrize("dtype,values", [
    ("date", [dt.date(1960, 1, 1), dt.date(2024, 2, 29), dt.date(1960, 1, 1), None]),
    ("boolean", [True, False, True, None]),
    ("tinyint", [-128, 127, -128, None]),
    ("string", ["", "a", "A", "a", "x" * 50_000, None]),
    ("double", [0.0, -0.0, float("nan"), float("nan"), 1.5, None]),
    ("decimal(38,10)", [None, 1, 1, 2]),
])
def test_types(spark, dtype, values):
    from decimal import Decimal
    if dtype.startswith("decimal"):
        values = [v if v is None else Decimal(v) for v in values]
    df = spark.createDataFrame([(1, v) for v in values], f"g int, v {dtype}")
    assert rows(count_words(distinct_words(df, "g", "v"), "g")) == _exact(df, "g", "v")


def test_empty_frames(spark):
    df = spark.createDataFrame([], "g int, v long")
    words = distinct_words(df, "g", "v")
    assert count_words(words, "g").count() == 0
    assert unseen_words(words, words, "g").count() == 0


def test_no_group_at_all(spark):
    df = spark.createDataFrame([(3,), (3,), (None,), (70,)], "v long")
    words = distinct_words(df, [], "v")
    assert rows(count_words(words, [])) == [(2,)]


def test_clashing_group_names_are_refused(spark):
    with pytest.raises(ValueError, match="rename"):
        distinct_words(spark.createDataFrame([(1, 2)], "Word int, v int"), "Word", "v")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([*EDGES, 2, 3])), max_size=12), min_size=1, max_size=3))
def test_any_batches_in_any_order(spark, batches):
    frames = [spark.createDataFrame(b, "g string, v long") for b in batches]
    everything = frames[0]
    for f in frames[1:]:
        everything = everything.unionByName(f)
    exact = _exact(everything, "g", "v")
    words = [distinct_words(f, "g", "v") for f in frames]
    assert rows(count_words(merge_words(*words, *words[::-1], group_by="g"), "g")) == exact
    table = None
    for f in frames[::-1]:
        batch = DistinctCount("g", "v").batch(f, table)
        table = batch if table is None else table.unionByName(batch)
    assert rows(count_words(table, "g")) == exact
    assert table.groupBy("g", "word").count().where("g is not null and word is not null").count() <= table.count()


def test_side_table_is_only_appended_to(spark):
    """Three batches of events through the builder: the files of earlier batches stay as they are."""
    e = read_table(spark, SF_CHECK, "events")
    users = DistinctCount("event_type", "user_id")
    project = Project(spark, "distinct_upkeep")
    files, sizes = set(), []
    for part in (0, 1, 2, 2):  # the last batch comes twice: it brings nothing
        batch = e.where(F.pmod("event_id", F.lit(3)) == part)
        table = project.incremental("users_seen", lambda ctx: users.batch(batch, ctx.this))
        now = set(table.inputFiles())
        assert files <= now
        files = now
        sizes.append(table.count())
    assert sizes[2] == sizes[3]
    assert rows(users.counts(table)) == _exact(e, "event_type", "user_id")
    # no bit is stored twice, so that counts add up
    assert table.agg(F.sum(F.bit_count(BITS))).first()[0] == e.select("event_type", "user_id").dropna().distinct().count()
    project.drop("users_seen")


def test_words_are_combined_map_side_in_generated_code(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS v")
    plan = distinct_words(df, "g", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert plan.count("Exchange") == 1


def test_a_hot_group_is_spread_over_its_words(spark):
    df = spark.range(100_000).selectExpr("1 AS g", "id AS v")
    parts = distinct_words(df, "g", "v").repartition(8, "g", "word").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 2 * 1563 / 8
