"""Clustered layout: same rows, files with narrow ranges in every clustered column."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from modelsmith.operators.cluster import _ranked, cluster, z_order
from modelsmith.operators.project import Project
from modelsmith.operators.publish import Layout
from modelsmith.sources.relations import read_table
from tests.conftest import SF_CHECK, rows

FILES = 16


@pytest.fixture
def many_files(spark):
    """As many files as a large table would have: tasks are not merged."""
    keys = {"spark.sql.shuffle.partitions": str(FILES), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _files(df):
    return [f.removeprefix("file:") for f in df.inputFiles()]


def _met(df, **ranges):
    """How many files a filter on these ranges reads, by the statistics in their footers."""
    met = 0
    for f in _files(df):
        meta = pq.ParquetFile(f).metadata
        place = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(place[c]).statistics for c in ranges}
            if all(stats[c].min <= hi and stats[c].max >= lo for c, (lo, hi) in ranges.items()):
                met += 1
                break
    return met


def test_a_box_in_two_columns_reads_fewer_files(spark, many_files):
    lines = read_table(spark, SF_CHECK, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    spread = lines.repartition(FILES)
    project = Project(spark, "clustered")
    plain = project.table("plain", spread, layout=Layout(order_by=["l_partkey", "l_suppkey"]))
    box = project.table("box", spread, layout=Layout(cluster_by=["l_partkey", "l_suppkey"]))
    assert rows(box) == rows(plain) == rows(lines)
    for c in ("l_partkey", "l_suppkey"):
        lo, hi = lines.agg(F.percentile_approx(c, [0.4, 0.5])).first()[0]
        assert _met(box, **{c: (lo, hi)}) <= FILES * 3 / 4 and _met(plain, **{c: (lo, hi)}) == FILES
    p, s = [lines.agg(F.percentile_approx(c, [0.4, 0.5])).first()[0] for c in ("l_partkey", "l_suppkey")]
    assert _met(box, l_partkey=tuple(p), l_suppkey=tuple(s)) <= FILES / 2
    assert _met(plain, l_partkey=tuple(p), l_suppkey=tuple(s)) == FILES
    assert not [t for t in project.publisher._tables() if "__stage_" in t]
    # the layout is kept, also by runs of an upsert
    assert project.publisher.stored_layout("box", box.columns).cluster_by == ("l_partkey", "l_suppkey")
    project.drop("plain")
    project.drop("box")


def test_one_column_is_dealt_by_value(spark, many_files):
    orders = read_table(spark, SF_CHECK, "orders")
    project = Project(spark, "clustered_one")
    t = project.table("o", orders.repartition(FILES), layout=Layout(cluster_by="o_custkey"))
    lo, hi = orders.agg(F.percentile_approx("o_custkey", [0.50, 0.51])).first()[0]
    assert _met(t, o_custkey=(lo, hi)) <= 2
    project.drop("o")


def test_a_hot_value_is_split(spark, many_files):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 7L, id) AS a", "IF(id % 3 = 0, 7L, id % 100) AS b", "id AS v")
    for columns in (["a"], ["a", "b"]):
        parts = cluster(df, columns).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum((F.col("a") == 7).cast("int")).alias("hot")).collect()
        assert max(r.n for r in parts) < 2 * 30_000 / FILES
        assert sum(r.hot > 0 for r in parts) >= FILES / 4


def test_ranks_of_all_types_follow_the_order_of_the_values(spark):
    base = [(i, -i / 7, dt.date(1970, 1, 1) + dt.timedelta(days=i), dt.datetime(2000, 1, 1) + dt.timedelta(hours=i), f"Customer#{i:06d}", i % 2 == 0) for i in range(-500, 500)]
    df = spark.createDataFrame([*base, (None,) * 6], "i long, d double, day date, ts timestamp_ntz, s string, b boolean")
    for c in df.columns:
        got = df.select(c, _ranked(df, [c])[0].alias("r")).collect()
        assert {g.r for g in got if g[c] is None} == {0}
        known = sorted((g for g in got if g[c] is not None), key=lambda g: g[c])
        ranks = [g.r for g in known]
        assert ranks == sorted(ranks) and 0 <= ranks[0] and ranks[-1] <= 1023
        if c in ("i", "d", "day", "ts"):
            assert len(set(ranks)) > 900
        if c == "s":
            assert len({g.r for g in known if g.s >= "Customer#0"}) > 400


def test_z_order_interleaves(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (1023, 1023)], "a long, b long")
    got = [r.z for r in df.select(z_order([F.col("a"), F.col("b")]).alias("z")).collect()]
    assert got == [0, 1, 2, 3, 8, 2**20 - 1]


def test_odd_frames(spark):
    nulls = spark.createDataFrame([(None, None, 1), (None, None, 1)], "a int, b string, _z int")
    assert rows(cluster(nulls, ["a", "b"])) == rows(nulls)
    empty = nulls.where("false")
    assert cluster(empty, ["a", "b"]).columns == nulls.columns and cluster(empty, ["a", "b"]).count() == 0
    odd = spark.createDataFrame([(1, float("nan"), {"k": 1}), (2, float("inf"), None), (2, float("-inf"), {})], "`a.b` int, d double, m map<string,int>")
    assert cluster(odd, ["a.b", "d"]).count() == 3
    with pytest.raises(ValueError, match="no order"):
        cluster(odd, ["a.b", "m"])
    with pytest.raises(ValueError, match="one to"):
        cluster(nulls, list("abcdefg"))
    with pytest.raises(ValueError, match="choose one"):
        Layout(cluster_by=["a"], buckets=4, bucket_by=["a"])


def test_within_partitions(spark, many_files):
    orders = read_table(spark, SF_CHECK, "orders")
    project = Project(spark, "clustered_parts")
    t = project.table("o", orders, layout=Layout(partition_by="o_orderstatus", cluster_by=["o_custkey", "o_orderdate"], order_by=["o_orderkey"]))
    assert rows(t, *orders.columns) == rows(orders)
    project.drop("o")
