"""Snapshots of change feeds: equal to changes taken one at a time, however they are dealt to runs."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelsmith.operators.feed import FEED_COLUMNS, alive, plan_feed
from modelsmith.operators.project import Project
from tests.conftest import rows

SCHEMA = "k int, pos int, v string, at timestamp_ntz, gone boolean"
DAY0 = datetime(2023, 12, 31, 23, 0)
COLS = ("k", "pos", "v", "at", "valid_from", "valid_to", "is_deleted")


def one_at_a_time(changes):
    """Versions as a list that each change splits, replaces or extends."""
    versions = []  # [k, start, end, pos, v, gone]
    for k, pos, v, at, gone in changes:
        gone = bool(gone)
        mine = [x for x in versions if x[0] == k]
        same = [x for x in mine if x[1] == at]
        if same:
            if pos > same[0][3]:
                same[0][3:] = [pos, v, gone]
            continue
        over = [x for x in mine if x[1] < at and (x[2] is None or at < x[2])]
        if over:  # split
            versions.append([k, at, over[0][2], pos, v, gone])
            over[0][2] = at
        else:  # before all versions of the key
            versions.append([k, at, min((x[1] for x in mine), default=None), pos, v, gone])
    return sorted(((k, pos, v, start, start, end, gone) for k, start, end, pos, v, gone in versions), key=repr)


@st.composite
def feeds(draw):
    n = draw(st.integers(0, 14))
    out = [(draw(st.sampled_from([1, 2, None])), pos, draw(st.sampled_from(["a", None])),
            DAY0 + timedelta(minutes=40 * draw(st.integers(0, 6))), draw(st.sampled_from([True, False, False, None]))) for pos in range(n)]
    return draw(st.permutations(out))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feeds(), st.integers(1, 3), st.sampled_from(["year", "day", "hour", "minute"]))
def test_any_runs(spark, changes, runs, unit):
    """NULL keys, ties, late changes, deletions, empty runs; units that changes share and units of one change."""
    target = None
    for part in range(runs):
        batch = spark.createDataFrame(changes[part::runs], SCHEMA)
        target = plan_feed(target, batch, "k", "at", "gone", ["pos"], unit)
    assert rows(target, *COLS) == one_at_a_time(changes)
    assert target.select("scd_id").distinct().count() == target.count()


def test_without_order_a_later_run_wins(spark):
    at = DAY0
    first = plan_feed(None, spark.createDataFrame([(1, 9, "old", at, False)], SCHEMA), "k", "at", "gone")
    second = plan_feed(first, spark.createDataFrame([(1, 1, "new", at, None)], SCHEMA), "k", "at", "gone")
    assert [r.v for r in second.collect()] == ["new"]


def test_a_change_needs_an_instant(spark):
    changes = spark.createDataFrame([(1, 1, "a", None, False)], SCHEMA)
    with pytest.raises(Exception, match="a change has no at"):
        plan_feed(None, changes, "k", "at", "gone").collect()
    with pytest.raises(ValueError, match="columns of the snapshot"):
        plan_feed(None, changes.withColumn("valid_to", F.lit(1)), "k", "at", "gone")


def test_new_columns_and_clashing_names(spark):
    """Columns named as the plan's own; a column that joins later reads NULL before."""
    first = plan_feed(None, spark.createDataFrame([(1, 2, DAY0)], "k0 int, run int, t timestamp_ntz"), "k0", "t", order_by=["run"])
    second = plan_feed(first, spark.createDataFrame([(1, 3, DAY0 + timedelta(days=2), "x")], "k0 int, run int, t timestamp_ntz, e string"),
                       "k0", "t", order_by=["run"])
    assert rows(second, "run", "e", "valid_to") == sorted([(2, None, DAY0 + timedelta(days=2)), (3, "x", None)], key=repr)


def test_hot_key_is_spread(spark):
    """The window of a key is cut by units, so that no task sorts a hot key's whole chain."""
    changes = spark.range(20_000).select(F.lit(7).alias("k"), F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz").alias("at"))
    chain = plan_feed(None, changes, "k", "at")
    plan = chain._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and any("u#" in line.split("], [")[1] for line in windows)
    got = chain.agg(F.count("*"), F.count("valid_to"), F.max(F.col("valid_to") - F.col("valid_from"))).first()
    assert (got[0], got[1], got[2]) == (20_000, 19_999, timedelta(minutes=10))


def test_each_run_is_read_once(spark):
    """Runs that are not stored between: the changes of each are read once, not again for each use of the runs after it."""
    read = spark.sparkContext.accumulator(0)
    target, want = None, []
    for run in range(3):
        changes = [(k, 10 * run + k, "v", DAY0 + timedelta(days=7 * k + run), False) for k in range(4)]
        counted = spark.sparkContext.parallelize(changes, 2).map(lambda row: (read.add(1), row)[1])
        target = plan_feed(target, spark.createDataFrame(counted, SCHEMA), "k", "at", "gone", ["pos"])
        want += changes
    assert rows(target, *COLS) == one_at_a_time(want)
    assert read.value == len(want)


def test_keys_that_no_run_names_again(spark):
    """Versions of keys that are not in the feed come out as they were, in all columns."""
    first = plan_feed(None, spark.createDataFrame([(k, i, "v", DAY0 + timedelta(days=20 * i), k == 2) for k in (1, 2, None) for i in range(3)], SCHEMA),
                      "k", "at", "gone", ["pos"])
    second = plan_feed(first, spark.createDataFrame([(1, 9, "w", DAY0 + timedelta(days=5), False)], SCHEMA), "k", "at", "gone", ["pos"])
    rest = F.coalesce("k", F.lit(0)) != 1
    assert rows(second.where(rest), *first.columns) == rows(first.where(rest), *first.columns)
    assert second.where(~rest).count() == 4


def test_project_builds(spark):
    project = Project(spark, "feed_builds")
    day = [DAY0 + timedelta(days=i) for i in range(6)]
    project.snapshot_feed("h", spark.createDataFrame([(1, 1, "a", day[0], False), (1, 2, "c", day[4], True), (2, 1, "z", day[1], False)], SCHEMA),
                          "k", "at", "gone", ["pos"])
    got = project.snapshot_feed("h", spark.createDataFrame([(1, 3, "b", day[2], False), (1, 4, "d", day[5], False)], SCHEMA), "k", "at", "gone", ["pos"])
    assert rows(alive(got), "k", "v", "valid_from", "valid_to") == [
        (1, "a", day[0], day[2]), (1, "b", day[2], day[4]), (1, "d", day[5], None), (2, "z", day[1], None)]
    assert set(FEED_COLUMNS) <= set(got.columns)
    project.table("plain", spark.range(3))
    with pytest.raises(ValueError, match="not a snapshot of a feed"):
        project.snapshot_feed("plain", spark.createDataFrame([], SCHEMA), "k", "at", "gone")
