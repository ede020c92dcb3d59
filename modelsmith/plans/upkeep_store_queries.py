"""Queries for what is kept between runs: distinct words, upsert runs, clustered files."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelsmith.operators.distinct import DistinctCount
from modelsmith.operators.publish import Layout
from modelsmith.operators.runs import resolve_runs
from modelsmith.plans._registry import register
from modelsmith.sources.relations import read_table


@register("agg_distinct_merge", "SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type")
def agg_distinct_merge(spark, d):
    """F4 + B5: distinct users by event type over two batches, the second one adding only the words it brings."""
    e = read_table(spark, d, "events")
    users = DistinctCount("event_type", "user_id")
    early = F.col("event_id") % 3 != 0
    table = users.batch(e.where(early), None)
    table = table.unionByName(users.batch(e.where(~early | early.isNull()), table))
    return users.counts(table, "n_users")


@register("agg_distinct_text", "SELECT c_mktsegment, count(DISTINCT c_name) AS n_names FROM customer GROUP BY c_mktsegment")
def agg_distinct_text(spark, d):
    """the same for a text, whose words are the values, over three batches."""
    c = read_table(spark, d, "customer")
    names = DistinctCount("c_mktsegment", "c_name")
    table = None
    for part in range(3):
        batch = names.batch(c.where(F.coalesce(F.pmod("c_custkey", F.lit(3)), F.lit(0)) == part), table)
        table = batch if table is None else table.unionByName(batch)
    return names.counts(table, "n_names")


def upsert_batches(spark, d):
    """Four batches of orders: all before 1998, then three repriced parts that overlap."""
    o = read_table(spark, d, "orders")
    ts = {y: F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (1994, 1996, 1998)}
    price = F.col("o_totalprice")
    return [
        o.where(F.col("o_orderdate") < ts[1998]),
        o.where(F.col("o_orderdate") >= ts[1996]).withColumn("o_totalprice", price + 1),
        o.where(F.col("o_orderkey") % 5 == 0).withColumn("o_totalprice", price + 2),
        o.where(F.col("o_orderdate") < ts[1994]).withColumn("o_totalprice", price + 3),
    ]


@register("upsert_runs", """
WITH runs AS (
  SELECT 0 AS run, * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL SELECT 1, o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
  UNION ALL SELECT 2, o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT 3, o_orderkey, o_custkey, o_orderstatus, o_totalprice + 3, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '1994-01-01')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM runs AS r
WHERE NOT EXISTS (SELECT 1 FROM runs AS n WHERE n.o_orderkey = r.o_orderkey AND n.run > r.run)""")
def upsert_runs(spark, d):
    """Four batches kept as runs and resolved on read, the last writer of a key winning."""
    return resolve_runs(upsert_batches(spark, d), "o_orderkey")


@register("table_clustered", "SELECT * FROM orders")
def table_clustered(spark, d):
    """A5: orders as a table clustered by customer and date would write them."""
    return Layout(cluster_by=["o_custkey", "o_orderdate"]).arrange(read_table(spark, d, "orders"))
