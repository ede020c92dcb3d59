"""Upkeep of aggregates over joins: equal to a full rebuild, at the cost of the touched groups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from modelsmith.operators.upkeep import JoinAggregate
from modelsmith.plans.upkeep_queries import CUSTOMER_INSIGHT, late_rows
from modelsmith.sources.relations import read_table
from tests.conftest import SF_CHECK, rows

C = "c_custkey long, c_name string, c_mktsegment string"
O = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"
L = "l_orderkey long, l_partkey long, l_extendedprice double"


def _frames(spark, customer, orders, lines):
    day = dt.datetime(2024, 1, 1)
    return {"customer": spark.createDataFrame(customer, C), "orders": spark.createDataFrame([(o, c, day + dt.timedelta(days=n)) for o, c, n in orders], O), "lineitem": spark.createDataFrame(lines, L)}


CUSTOMERS = [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "y")]
ORDERS = [(10, 1, 0), (11, 1, 3), (20, 2, 1), (30, 3, 2), (None, 2, 5)]
LINES = [(10, 7, 1.0), (10, 8, 2.0), (20, 7, 3.0), (30, 9, 4.0), (99, 1, 5.0), (None, 2, 6.0)]


@pytest.mark.parametrize("name,was,now", [
    ("customer", [(2, "b", "x")], [(2, "bb", "z")]),  # another value
    ("customer", [], [(5, "e", "q")]),  # new, without orders
    ("orders", [], [(40, 4, 9)]),  # a group that comes
    ("orders", [(30, 3, 2)], []),  # a group that goes
    ("orders", [(10, 1, 0)], [(10, 2, 0)]),  # an order that moves takes its lines along
    ("orders", [], [(99, 3, 1)]),  # lines that waited for their order
    ("lineitem", [], [(11, 5, 2.5), (30, 9, 1.5)]),
    ("lineitem", [(10, 8, 2.0)], [(20, 8, 2.0)]),  # a line that moves
    ("lineitem", [], [(None, 3, 1.0), (1234, 3, 1.0)]),  # lines that belong to nothing
])
def test_late_changes_of_each_source(spark, name, was, now):
    first = {"customer": list(CUSTOMERS), "orders": list(ORDERS), "lineitem": list(LINES)}
    then = {k: list(v) for k, v in first.items()}
    then[name] = [r for r in then[name] if r not in was] + now
    old, new = (_frames(spark, v["customer"], v["orders"], v["lineitem"]) for v in (first, then))
    images = _frames(spark, *[was + now if k == name else [] for k in ("customer", "orders", "lineitem")])
    target = CUSTOMER_INSIGHT.refresh(None, old, None)
    assert rows(CUSTOMER_INSIGHT.refresh(target, new, {name: images[name]})) == rows(CUSTOMER_INSIGHT.model(new))


def test_only_touched_groups_are_computed(spark):
    new = _frames(spark, CUSTOMERS, ORDERS, LINES)
    changes = _frames(spark, [], [], [(30, 9, 4.0)])
    keys = CUSTOMER_INSIGHT.touched_keys(new, {"lineitem": changes["lineitem"]})
    assert rows(keys) == [(3,)]
    part = CUSTOMER_INSIGHT.touched_part(new, keys)
    assert {k: v.count() for k, v in part.items()} == {"customer": 1, "orders": 1, "lineitem": 1}
    # A target whose other groups are wrong keeps them: they were not computed.
    wrong = CUSTOMER_INSIGHT.model(new).withColumn("num_parts", F.lit(77).cast("long"))
    got = {r.id: r.num_parts for r in CUSTOMER_INSIGHT.refresh(wrong, new, {"lineitem": changes["lineitem"]}).collect()}
    assert got == {1: 77, 2: 77, 3: 1}


def test_sources_are_read_through_semi_joins(spark):
    sources = {n: read_table(spark, SF_CHECK, n) for n in ("customer", "orders", "lineitem")}
    late = late_rows()
    keys = CUSTOMER_INSIGHT.touched_keys(sources, {n: df.where(late[n]) for n, df in sources.items()})
    for name, df in CUSTOMER_INSIGHT.touched_part(sources, keys).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "LeftSemi" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name
    assert 0 < keys.count() < sources["customer"].count()


def test_null_group_key_and_two_columns(spark):
    spec = JoinAggregate(keys={"t": ["a", "b"]}, key=["a", "b"], model=lambda s: s["t"].groupBy("a", "b").agg(F.sum("v").alias("v")))
    was = spark.createDataFrame([(None, 1, 1), (None, 1, 2), (1, None, 3)], "a int, b int, v int")
    late = spark.createDataFrame([(None, 1, 10), (2, 2, 1)], "a int, b int, v int")
    new = was.unionByName(late)
    assert rows(spec.refresh(spec.model({"t": was}), {"t": new}, {"t": late})) == rows(spec.model({"t": new}))


def test_bad_specs():
    with pytest.raises(ValueError):
        JoinAggregate(keys={"a": ["x"]}, key=["x", "y"], model=lambda s: s["a"])
    with pytest.raises(ValueError):
        JoinAggregate(keys={"a": ["x"]}, links={"b": ("c", [("i", "i")]), "c": ("b", [("i", "i")])}, key=["x"], model=lambda s: s["a"])
    with pytest.raises(ValueError):
        JoinAggregate(keys={"a": ["x"]}, links={"a": ("a", [("i", "i")])}, key=["x"], model=lambda s: s["a"])
    with pytest.raises(ValueError):
        CUSTOMER_INSIGHT.touched_keys({}, {"nation": None})
