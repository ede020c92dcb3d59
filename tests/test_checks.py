import pytest
from pyspark.sql import functions as F

from modelsmith.operators import checks, compare, stats
from tests.conftest import rows


def test_relationships_keeps_duplicates_and_ignores_nulls(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (4,)], "k long")
    parent = spark.createDataFrame([(1,), (None,), (3,), (1,)], "k long")
    assert rows(checks.relationships(child, "k", parent, "k")) == [(2,), (2,), (4,)]


def test_relationships_plan_is_anti_join_without_nested_loop(spark):
    child = spark.range(1000).withColumnRenamed("id", "k")
    parent = spark.range(500).withColumnRenamed("id", "k")
    plan = checks.relationships(child, "k", parent, "k")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "NestedLoop" not in plan


def test_unique_not_null_accepted_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (None, "a")], "k long, v string")
    assert rows(checks.unique(df, "k")) == [(1, 2)]
    assert rows(checks.unique(df, ["k", "v"])) == []
    assert rows(checks.not_null(df, "v", keep=["k"])) == [(2, None)]
    assert rows(checks.accepted_values(df, "v", ["a"])) == [("b", 1)]


@pytest.mark.parametrize("warn,error,expected", [
    ("!= 0", "!= 0", (3, "true", "true")),
    ("> 2", "> 5", (3, "true", "false")),
    (">=10", "<0", (3, "false", "false")),
])
def test_check_result_thresholds(spark, warn, error, expected):
    failing = spark.range(3)
    r = checks.check_result(failing, warn_if=warn, error_if=error).first()
    assert (r.failures, r.should_warn, r.should_error) == expected


def test_check_result_limit_and_empty(spark):
    r = checks.check_result(spark.range(100), limit=7).first()
    assert r.failures == 7
    r = checks.singular(spark.range(0)).first()
    assert (r.failures, r.should_warn, r.should_error) == (0, "false", "false")
    with pytest.raises(ValueError):
        checks.parse_threshold("; drop table x")


def test_relation_diff_null_safe(spark):
    # Example of the deviation register: '=' on every column says 4, the
    # NULL-safe comparison says 2 (only the duplicated row differs in count
    # and the 'x' row is missing on one side).
    a = spark.createDataFrame([(1, None), (2, "b"), (3, "c"), (3, "c")], "id int, v string")
    b = spark.createDataFrame([(1, None), (2, "b"), (3, "c"), (4, "x")], "id int, v string")
    r = compare.rows_different(a, b).first()
    assert (r.row_count_difference, r.num_mismatched) == (0, 1)
    same = compare.rows_different(a, a).first()
    assert (same.row_count_difference, same.num_mismatched) == (0, 0)
    j = compare.rows_different_by_join(a, b).first()
    assert (j.row_count_difference, j.num_mismatched) == (0, 1)


def test_relation_diff_agrees_with_join_form(spark):
    a = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    b = a.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_orderpriority")))
    x = compare.rows_different(a, b).first()
    y = compare.rows_different_by_join(a, b).first()
    assert tuple(x) == tuple(y)
    assert x.num_mismatched > 0


def test_column_stats(spark):
    df = spark.createDataFrame([(1, "a", [1]), (None, "b", [2]), (3, None, None)], "k int, s string, arr array<int>")
    out = {r.column_name: r for r in stats.column_stats(df, "t", "s1", column_comments={"k": "key"},
                                                         stats=stats.ALL_STATS).collect()}
    assert out["k"].column_index == 1 and out["k"].column_comment == "key"
    assert (out["k"].null_count, out["k"].min_value, out["k"].max_value, out["k"].row_count) == (1, "1", "3", 3)
    assert out["s"].approx_distinct == 2
    assert out["arr"].min_value is None and out["arr"].column_type == "array<int>"


def test_set_operations_are_null_safe_and_distinct(spark):
    from modelsmith.operators import setops

    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "z"), (3, "y"), (3, "y")], "k int, v string")
    assert rows(setops.except_distinct(a, b)) == rows(a.subtract(b)) == [(2, "x")]
    assert rows(setops.intersect_distinct(a, b)) == rows(a.intersect(b))
    plan = setops.except_distinct(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_column_stats_sketch_against_exact_counts(spark):
    """The approximate distinct count of the registered sketch query, checked
    against brute-force exact counts on the small fixture (HLL, rsd 5 %)."""
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet")
    exact = lineitem.agg(*[F.count_distinct(c).alias(c) for c in lineitem.columns]).first().asDict()
    got = {r.column_name: r for r in entry.queries()["column_stats_sketch"](spark, sf).collect()}
    for c, n in exact.items():
        assert abs(got[c].approx_distinct - n) <= max(2, 0.15 * n), (c, got[c].approx_distinct, n)
        assert got[c].row_count == lineitem.count()


def test_evaluate_and_enforce(spark):
    failing = spark.range(5)
    assert checks.evaluate(failing, warn_if="> 2", error_if="> 10") == ("warn", 5)
    assert checks.evaluate(spark.range(0)) == ("pass", 0)
    with pytest.raises(checks.CheckFailed):
        checks.enforce(failing, name="five rows", error_if=">= 5")


def test_relation_diff_plain_equality_example(spark):
    a = spark.createDataFrame([(1, None), (2, "b"), (3, "c"), (3, "c")], "id int, v string")
    b = spark.createDataFrame([(1, None), (2, "b"), (3, "c"), (4, "x")], "id int, v string")
    r = compare.rows_different(a, b, null_safe=False).first()
    assert (r.row_count_difference, r.num_mismatched) == (0, 3)   # both NULL rows count


def test_column_stats_exact_distinct_matches_duckdb(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    got = {r.column_name: r.distinct_count for r in
           stats.column_stats(orders, "orders", stats=("row_count", "distinct_count")).collect()}
    cols = ", ".join(f"count(DISTINCT {c}) AS {c}" for c in orders.columns)
    want = duckdb.sql(f"SELECT {cols} FROM '{sf}/orders.parquet'").fetchall()[0]
    assert got == dict(zip(orders.columns, want))
