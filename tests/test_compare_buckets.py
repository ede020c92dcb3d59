"""The relation diff by bucket fingerprints: equal to the plain diff, with a fraction of its shuffle."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelsmith.operators.compare import MAX_BUCKETS, rows_different, rows_different_by_buckets
from modelsmith.sources.relations import read_table
from tests.conftest import rows

SCHEMA = "k int, s string, d double, l array<int>, t struct<x:int,y:string>"
cell = st.tuples(st.sampled_from([1, 2, None]), st.sampled_from(["", "a", None]), st.sampled_from([0.0, -0.0, float("nan"), 1.5, None]),
                 st.sampled_from([[], [None], [1, None], [None, 1], None]), st.sampled_from([(1, None), (None, "1"), None]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cell, max_size=7), st.lists(cell, max_size=7), st.booleans(), st.sampled_from([1, 3, 512]), st.sampled_from([None, ["k"], ["s", "l"]]))
def test_any_relations(spark, a, b, null_safe, buckets, key):
    """Multiplicity, NULLs in any place (nested ones too), NaN and both zeros, empty sides."""
    x, y = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(a[1:] + b, SCHEMA)
    got = rows_different_by_buckets(x, y, null_safe=null_safe, key=key, buckets=buckets)
    assert rows(got) == rows(rows_different(x, y, null_safe=null_safe))


def test_types_that_differ(spark):
    x, y = spark.createDataFrame([(1,), (2,)], "_bucket int"), spark.createDataFrame([(1,), (3,)], "_bucket long")
    assert rows(rows_different_by_buckets(x, y)) == [(0, 2)]
    with pytest.raises(ValueError, match="buckets"):
        rows_different_by_buckets(x, y, buckets=MAX_BUCKETS + 1)


def _shuffled(df):
    """Bytes that the exchanges of an executed plan have written."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleBytesWritten").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.length())]
    return total


def test_shuffles_a_tenth(spark):
    a = read_table(spark, "/root/testdata/sf0.1", "orders")
    b = a.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 15_013 == 0, -1).otherwise(F.col("o_totalprice")))
    near, plain = rows_different_by_buckets(a, b, key=["o_orderkey"], buckets=1024), rows_different(a, b)
    few, all_rows = _shuffled(near), _shuffled(plain)
    assert rows(near) == rows(plain) and rows(plain)[0][1] > 0
    assert 0 < few <= all_rows / 10, (few, all_rows)
