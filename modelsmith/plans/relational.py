"""Relational operators used by model SELECTs (2.D projections and filters,
2.E joins, 2.F aggregates, 2.H sorts, limits and set operations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelsmith import functions as fn
from modelsmith.operators import setops
from modelsmith.plans._registry import register
from modelsmith.sources.relations import read_table


def _t(spark, d, name):
    return read_table(spark, d, name)


# ---------------------------------------------------------------- 2.A / 2.D

@register("scan_source", "SELECT * FROM orders")
def scan_source(spark, d):
    """A1: a declared source scanned whole."""
    return _t(spark, d, "orders")


@register("project_alias", """
SELECT o_orderkey AS id, o_orderstatus AS status, 1 AS one, 'model' AS kind,
       CAST(NULL AS VARCHAR) AS note, o_custkey + 1 AS next_custkey
FROM orders""")
def project_alias(spark, d):
    """Projection, aliases, number / string / NULL literals."""
    o = _t(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.lit(1).alias("one"),
        F.lit("model").alias("kind"),
        F.lit(None).cast("string").alias("note"),
        (F.col("o_custkey") + 1).alias("next_custkey"),
    )


@register("cte_chain", """
WITH recent AS (
  SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
), per_customer AS (
  SELECT o_custkey, count(*) AS recent_orders FROM recent GROUP BY o_custkey
)
SELECT c.c_custkey, c.c_name, p.recent_orders
FROM (SELECT * FROM customer) c JOIN per_customer p ON p.o_custkey = c.c_custkey""")
def cte_chain(spark, d):
    """CTEs and a subquery in FROM, written as chained DataFrames."""
    recent = _t(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    per_customer = recent.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("recent_orders"))
    c = _t(spark, d, "customer")
    return c.join(per_customer, per_customer.o_custkey == c.c_custkey).select(
        "c_custkey", "c_name", "recent_orders"
    )


@register("filter_predicates", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE (o_orderstatus = 'F' AND o_totalprice > 100000)
   OR (o_orderpriority != '1-URGENT' AND o_custkey > 1000)""")
def filter_predicates(spark, d):
    """Equality, >, !=, AND, OR (pushed into the Parquet scan)."""
    o = _t(spark, d, "orders")
    cond = ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)) | (
        (F.col("o_orderpriority") != "1-URGENT") & (F.col("o_custkey") > 1000)
    )
    return o.filter(cond).select("o_orderkey", "o_custkey", "o_orderstatus")


@register("filter_in_list", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')""")
def filter_in_list(spark, d):
    """IN list and NOT IN list (literal lists only)."""
    o = _t(spark, d, "orders")
    return o.filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
    ).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@register("filter_like", """
SELECT p_partkey, p_name, p_type FROM part
WHERE p_name LIKE '%ring%' OR p_type LIKE 'ECO%'""")
def filter_like(spark, d):
    """LIKE patterns."""
    p = _t(spark, d, "part")
    return p.filter(F.col("p_name").like("%ring%") | F.col("p_type").like("ECO%")).select(
        "p_partkey", "p_name", "p_type"
    )


@register("case_multi_if", """
SELECT o_orderkey,
       CASE WHEN o_totalprice > 300000 THEN 'high'
            WHEN o_totalprice > 100000 THEN 'mid'
            ELSE 'low' END AS price_band,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_final,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'u'
            WHEN o_orderpriority = '2-HIGH' THEN 'h' END AS urgency
FROM orders""")
def case_multi_if(spark, d):
    """CASE WHEN, if(c, a, b) and multiIf(...) as when/otherwise chains."""
    o = _t(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 300000, "high")
        .when(F.col("o_totalprice") > 100000, "mid")
        .otherwise("low")
        .alias("price_band"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_final"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "u")
        .when(F.col("o_orderpriority") == "2-HIGH", "h")
        .alias("urgency"),
    )


# ---------------------------------------------------------------- 2.E joins

@register("join_inner", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, p.p_brand
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""")
def join_inner(spark, d):
    """Inner equi-join (Catalyst picks broadcast or sort-merge by size)."""
    li, p = _t(spark, d, "lineitem"), _t(spark, d, "part")
    return li.join(p, p.p_partkey == li.l_partkey, "inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand"
    )


@register("join_composite", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, s.same_part_lines
FROM lineitem l
JOIN (SELECT l_orderkey, l_partkey, count(*) AS same_part_lines
      FROM lineitem GROUP BY l_orderkey, l_partkey) s
  ON s.l_orderkey = l.l_orderkey AND s.l_partkey = l.l_partkey""")
def join_composite(spark, d):
    """Composite (two-key) inner equi-join."""
    li = _t(spark, d, "lineitem")
    same = li.groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("same_part_lines"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey").join(
        same, ["l_orderkey", "l_partkey"], "inner"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "same_part_lines")


@register("join_left", """
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey
FROM orders o LEFT OUTER JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def join_left(spark, d):
    """Left outer join; orders without lines keep NULL line columns."""
    o, li = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    return o.join(li, li.l_orderkey == o.o_orderkey, "left").select(
        "o_orderkey", "l_linenumber", "l_partkey"
    )


# ---------------------------------------------------------------- 2.F aggregates

@register("agg_count", """
SELECT o_orderstatus, count(*) AS n_orders, count(o_custkey) AS n_with_customer
FROM orders GROUP BY o_orderstatus""")
def agg_count(spark, d):
    """count(*) and count(column)."""
    return _t(spark, d, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("o_custkey").alias("n_with_customer")
    )


@register("agg_max", """
SELECT l_returnflag, max(l_shipdate) AS last_ship, max(l_quantity) AS max_qty,
       max(l_orderkey) AS max_order
FROM lineitem GROUP BY l_returnflag""")
def agg_max(spark, d):
    """max over timestamps and numbers."""
    return _t(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.max("l_shipdate").alias("last_ship"),
        F.max("l_quantity").alias("max_qty"),
        F.max("l_orderkey").alias("max_order"),
    )


@register("agg_avg", """
SELECT l_returnflag, l_linestatus,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_price,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_avg(spark, d):
    """average, computed exactly on decimals (order-independent)."""
    return _t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        fn.exact_avg("l_extendedprice", 2).alias("avg_price"),
        fn.exact_avg("l_quantity", 2).alias("avg_qty"),
    )


@register("agg_count_distinct", """
SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY l_suppkey""")
def agg_count_distinct(spark, d):
    """exact distinct counts (two in one query plan as an Expand)."""
    return _t(spark, d, "lineitem").groupBy("l_suppkey").agg(
        fn.count_distinct("l_partkey").alias("n_parts"),
        fn.count_distinct("l_orderkey").alias("n_orders"),
    )


@register("agg_any_value", """
SELECT o.o_custkey, any_value(c.c_name) AS name, count(*) AS n_orders
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY o.o_custkey""")
def agg_any_value(spark, d):
    """any value of an expression fixed by the group key."""
    o, c = _t(spark, d, "orders"), _t(spark, d, "customer")
    return (
        o.join(c, c.c_custkey == o.o_custkey)
        .groupBy("o_custkey")
        .agg(fn.any_value("c_name").alias("name"), F.count(F.lit(1)).alias("n_orders"))
    )


@register("agg_bool_or", """
SELECT o_custkey, bool_or(o_orderstatus = 'F') AS any_final,
       bool_or(o_totalprice > 400000) AS any_large
FROM orders GROUP BY o_custkey""")
def agg_bool_or(spark, d):
    """true OR over the group (not an arbitrary row's value)."""
    return _t(spark, d, "orders").groupBy("o_custkey").agg(
        fn.bool_or(F.col("o_orderstatus") == "F").alias("any_final"),
        fn.bool_or(F.col("o_totalprice") > 400000).alias("any_large"),
    )


@register("agg_listagg", """
SELECT l_orderkey,
       string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS parts
FROM lineitem GROUP BY l_orderkey""")
def agg_listagg(spark, d):
    """listagg(measure, ',') within group (order by line number), per order."""
    return _t(spark, d, "lineitem").groupBy("l_orderkey").agg(
        fn.listagg(F.col("l_partkey").cast("string"), ",", order_by="l_linenumber").alias("parts")
    )


@register("agg_listagg_limit", """
SELECT l_orderkey,
       array_to_string((list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)))[1:3], ',') AS first_parts
FROM lineitem GROUP BY l_orderkey""")
def agg_listagg_limit(spark, d):
    """F7 with its limit argument: first three parts per order, trimmed
    per salt bucket before any collection."""
    li = _t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part")
    )
    return fn.listagg_limited(
        li, ["l_orderkey"], "part", ",", "l_linenumber", 3, alias="first_parts"
    )


@register("agg_listagg_nulls", """
SELECT l_orderkey,
       string_agg(CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey AS VARCHAR) END, ',' ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS returned
FROM lineitem GROUP BY l_orderkey""")
def agg_listagg_nulls(spark, d):
    """NULL measures are skipped; an order that has no other stays, with NULL."""
    part = F.when(F.col("l_returnflag") == "R", F.col("l_partkey").cast("string"))
    return _t(spark, d, "lineitem").groupBy("l_orderkey").agg(fn.listagg(part, ",", order_by="l_linenumber").alias("returned"))


@register("agg_group_array", """
SELECT l_orderkey, list(l_partkey ORDER BY l_partkey) AS parts
FROM lineitem GROUP BY l_orderkey""")
def agg_group_array(spark, d):
    """F8: array aggregate (sorted, per order)."""
    return _t(spark, d, "lineitem").groupBy("l_orderkey").agg(
        fn.group_array("l_partkey").alias("parts")
    )


# ---------------------------------------------------------------- 2.H sorts, limits, sets

@register("sort_multi", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
ORDER BY o_orderdate DESC, o_custkey ASC, o_orderkey ASC""")
def sort_multi(spark, d):
    """H1: multi-key ORDER BY, ascending and descending (range-partitioned sort)."""
    return _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate").orderBy(
        F.col("o_orderdate").desc(), F.col("o_custkey").asc(), F.col("o_orderkey").asc()
    )


@register("top_k", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10""")
def top_k(spark, d):
    """H2: ORDER BY + LIMIT planned as TakeOrderedAndProject (per-task top-k,
    then a merge of k rows per task); ties broken by the unique key."""
    return (
        _t(spark, d, "orders")
        .select("o_orderkey", "o_custkey", "o_totalprice")
        .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc())
        .limit(10)
    )


@register("set_union_all", """
SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey AS id, s_name AS name, 'supplier' AS kind FROM supplier""")
def set_union_all(spark, d):
    """H3: UNION ALL, matched by column name."""
    c = _t(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind")
    )
    s = _t(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind")
    )
    return c.unionByName(s)


@register("set_except", """
SELECT o_custkey AS custkey FROM orders
EXCEPT
SELECT c_custkey AS custkey FROM customer WHERE c_mktsegment = 'BUILDING'""")
def set_except(spark, d):
    """H4: EXCEPT (distinct) as one tagged aggregation (see operators.setops)."""
    a = _t(spark, d, "orders").select(F.col("o_custkey").alias("custkey"))
    b = _t(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("custkey")
    )
    return setops.except_distinct(a, b)


@register("set_intersect", """
SELECT l_partkey AS partkey FROM lineitem WHERE l_returnflag = 'R'
INTERSECT
SELECT p_partkey AS partkey FROM part WHERE p_size > 25""")
def set_intersect(spark, d):
    """H5: INTERSECT (distinct) as one tagged aggregation."""
    a = _t(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("partkey")
    )
    b = _t(spark, d, "part").filter(F.col("p_size") > 25).select(F.col("p_partkey").alias("partkey"))
    return setops.intersect_distinct(a, b)


@register("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, d):
    """Global aggregate, the row count of a relation."""
    return _t(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))

