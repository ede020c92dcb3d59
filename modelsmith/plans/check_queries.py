"""Queries for the data checks (2.C): relationships, generic and singular
checks, the severity verdict, relation diff and column statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelsmith.operators import checks, compare, stats
from modelsmith.plans._registry import register
from modelsmith.sources.relations import read_table

# Orphans are made by restricting the parent: lines whose order is not among
# orders placed before 2000.
_EARLY = "o_orderdate < TIMESTAMP '2000-01-01'"


def _early_orders(spark, d):
    return read_table(spark, d, "orders").filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


_ORPHANS_SQL = f"""
SELECT l.l_orderkey AS from_field FROM lineitem l
WHERE l.l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE {_EARLY} AND o.o_orderkey = l.l_orderkey)"""


@register("check_relationships", _ORPHANS_SQL)
def check_relationships(spark, d):
    """Child values with no parent (left anti join)."""
    return checks.relationships(read_table(spark, d, "lineitem"), "l_orderkey", _early_orders(spark, d), "o_orderkey")


@register("check_relationships_gap", """
SELECT d.doc_id AS from_field FROM documents d
WHERE d.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def check_relationships_gap(spark, d):
    """C1 on a real gap of the data: documents without labels."""
    return checks.relationships(read_table(spark, d, "documents"), "doc_id", read_table(spark, d, "labels"), "doc_id")


@register("check_severity", f"""
SELECT count(*) AS failures,
       CASE WHEN count(*) > 10 THEN 'true' ELSE 'false' END AS should_warn,
       CASE WHEN count(*) > 100000 THEN 'true' ELSE 'false' END AS should_error
FROM ({_ORPHANS_SQL}) t""")
def check_severity(spark, d):
    """Verdict of the relationships check with warn '> 10', error '> 100000'."""
    failing = check_relationships(spark, d)
    return checks.check_result(failing, warn_if="> 10", error_if="> 100000")


@register("check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def check_unique(spark, d):
    """C3 unique on a composite key that is not unique in the data."""
    return checks.unique(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("check_not_null", """
SELECT o.o_orderkey, l.l_linenumber
FROM orders o LEFT OUTER JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE l.l_linenumber IS NULL""")
def check_not_null(spark, d):
    """C3 not_null / P5: orders without lines give NULL line numbers."""
    o, li = read_table(spark, d, "orders"), read_table(spark, d, "lineitem")
    joined = o.join(li, li.l_orderkey == o.o_orderkey, "left")
    return checks.not_null(joined, "l_linenumber", keep=["o_orderkey"])


@register("check_accepted_values", """
SELECT o_orderstatus AS value_field, count(*) AS n_records FROM orders
GROUP BY o_orderstatus HAVING o_orderstatus NOT IN ('F', 'O')""")
def check_accepted_values(spark, d):
    """C3 accepted_values: statuses outside ('F', 'O')."""
    return checks.accepted_values(read_table(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@register("check_singular", """
SELECT count(*) AS failures,
       CASE WHEN count(*) != 0 THEN 'true' ELSE 'false' END AS should_warn,
       CASE WHEN count(*) > 1000 THEN 'true' ELSE 'false' END AS should_error
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_shipdate < o.o_orderdate""")
def check_singular(spark, d):
    """C4: a user SELECT of failing rows (lines shipped before their order)."""
    o, li = read_table(spark, d, "orders"), read_table(spark, d, "lineitem")
    bad = li.join(o, o.o_orderkey == li.l_orderkey).filter(F.col("l_shipdate") < F.col("o_orderdate"))
    return checks.singular(bad, warn_if="!= 0", error_if="> 1000")


# Relation diff: orders against a perturbed copy. Both sides hold NULLs (the
# priority of open orders), which must still compare equal.
def _diff_sides(spark, d):
    o = read_table(spark, d, "orders")
    priority = F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
    a = o.withColumn("o_orderpriority", priority)
    year = F.year("o_orderdate")
    b = (
        a.filter(year != 1996)
        .withColumn("o_totalprice", F.when(year == 1997, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
        .unionByName(a.filter(year == 2001))
    )
    return a, b


_DIFF_SIDES_SQL = """
WITH a AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders
), b AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM a WHERE year(o_orderdate) != 1996
  UNION ALL
  SELECT * FROM a WHERE year(o_orderdate) = 2001
)"""

_NULL_SAFE = " AND ".join(
    f"x.{c} IS NOT DISTINCT FROM y.{c}"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
)


@register("relation_diff", f"""{_DIFF_SIDES_SQL}
SELECT (SELECT count(*) FROM a) - (SELECT count(*) FROM b) AS row_count_difference,
       (SELECT count(*) FROM a x WHERE NOT EXISTS (SELECT 1 FROM b y WHERE {_NULL_SAFE}))
     + (SELECT count(*) FROM b x WHERE NOT EXISTS (SELECT 1 FROM a y WHERE {_NULL_SAFE})) AS num_mismatched""")
def relation_diff(spark, d):
    """NULL-safe relation diff in one aggregation pass."""
    a, b = _diff_sides(spark, d)
    return compare.rows_different(a, b)


@register("relation_diff_buckets", f"""{_DIFF_SIDES_SQL}, c AS (
  SELECT * EXCLUDE (o_totalprice), CASE WHEN o_orderkey % 1009 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM a)
SELECT (SELECT count(*) FROM a) - (SELECT count(*) FROM c) AS row_count_difference,
       (SELECT count(*) FROM a x WHERE NOT EXISTS (SELECT 1 FROM c y WHERE {_NULL_SAFE}))
     + (SELECT count(*) FROM c x WHERE NOT EXISTS (SELECT 1 FROM a y WHERE {_NULL_SAFE})) AS num_mismatched""")
def relation_diff_buckets(spark, d):
    """The diff of nearly equal relations (one order in 1,009 repriced), exact only in buckets that differ."""
    a, _ = _diff_sides(spark, d)
    repriced = F.when(F.col("o_orderkey") % 1009 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return compare.rows_different_by_buckets(a, a.withColumn("o_totalprice", repriced), key=["o_orderkey"], buckets=1024)


_CUSTOMER_COLUMNS = [
    ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
    ("c_acctbal", "double"), ("c_mktsegment", "string"),
]
_COMMENTS = {"c_custkey": "customer key", "c_mktsegment": "market segment"}


def _stats_sql():
    arms = []
    for i, (name, typ) in enumerate(_CUSTOMER_COLUMNS, start=1):
        comment = f"'{_COMMENTS[name]}'" if name in _COMMENTS else "CAST(NULL AS VARCHAR)"
        arms.append(
            f"SELECT 'tpch' AS table_schema, 'customer' AS table_name, 'table' AS table_type, "
            f"'customers of the shop' AS table_comment, {i} AS column_index, '{name}' AS column_name, "
            f"'{typ}' AS column_type, {comment} AS column_comment, "
            f"count(*) - count({name}) AS null_count, CAST(min({name}) AS VARCHAR) AS min_value, "
            f"CAST(max({name}) AS VARCHAR) AS max_value, count(*) AS row_count FROM customer"
        )
    return "\nUNION ALL\n".join(arms)


@register("column_stats", _stats_sql())
def column_stats(spark, d):
    """C7 + B20: one row per column of customer with comments and exact
    statistics, from a single aggregate over the table."""
    return stats.column_stats(
        read_table(spark, d, "customer"),
        table_name="customer",
        table_schema="tpch",
        table_comment="customers of the shop",
        column_comments=_COMMENTS,
    )


@register("column_stats_sketch")
def column_stats_sketch(spark, d):
    """C7 with the HyperLogLog distinct estimate (approximate: rows-only check)."""
    return stats.column_stats(
        read_table(spark, d, "lineitem"), table_name="lineitem", stats=stats.ALL_STATS
    )
