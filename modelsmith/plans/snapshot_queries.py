"""Queries for snapshots.

Run 1 snapshots the orders placed before 2000; run 2 sees all orders except
those of 1996 (hard-deleted keys), with 1997 orders repriced and updated 30
days later, 1999 orders losing their status (NULL against a value is a change
for the check strategy, not for the timestamp one), and orders from 2000 on
as new keys. The oracles spell out the classic staging + four-arm merge.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from modelsmith import functions as fn
from modelsmith.operators import feed
from modelsmith.operators import snapshot as snap
from modelsmith.plans._registry import register
from modelsmith.sources.relations import read_table

AS_OF_0 = "2024-01-01 00:00:00"
AS_OF_1 = "2025-01-01 00:00:00"
_CHECK = ["o_orderstatus", "o_totalprice"]


def _sources(spark, d):
    o = read_table(spark, d, "orders")
    year = F.year("o_orderdate")
    src0 = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").alias("updated_at")
    )
    src1 = o.filter(year != 1996).select(
        "o_orderkey",
        "o_custkey",
        F.when(year == 1999, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(year == 1997, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(year == 1997, fn.dateadd("day", 30, "o_orderdate")).otherwise(F.col("o_orderdate")).alias("updated_at"),
    )
    return src0, src1


def _scd_sql(*exprs: str) -> str:
    parts = [
        f"coalesce(CAST(length(CAST({e} AS VARCHAR)) AS VARCHAR) || ':' || CAST({e} AS VARCHAR), 'N')"
        for e in exprs
    ]
    return "md5(" + " || '|' || ".join(parts) + ")"


_DATA = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, updated_at"


def _sources_sql(strategy: str) -> str:
    start0 = "updated_at" if strategy == "timestamp" else f"TIMESTAMP '{AS_OF_0}'"
    return f"""
WITH src0 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS updated_at
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
), src1 AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN year(o_orderdate) = 1999 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN year(o_orderdate) = 1997 THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END AS updated_at
  FROM orders WHERE year(o_orderdate) != 1996
), t0 AS (
  SELECT {_DATA}, {_scd_sql('o_orderkey', start0)} AS scd_id, {start0} AS scd_updated_at,
         {start0} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM src0
), live AS (SELECT * FROM t0 WHERE valid_to IS NULL)"""


def _staging_sql(strategy: str, hard_deletes: bool) -> str:
    if strategy == "timestamp":
        start = "s.updated_at"
        changed = "l.valid_from < s.updated_at"
    else:
        start = f"TIMESTAMP '{AS_OF_1}'"
        changed = " OR ".join(f"NOT (l.{c} IS NOT DISTINCT FROM s.{c})" for c in _CHECK)
    sql = f""",
ins AS (
  SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.updated_at,
         {_scd_sql('s.o_orderkey', start)} AS scd_id, {start} AS scd_updated_at, {start} AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to
  FROM src1 s LEFT JOIN live l ON l.o_orderkey = s.o_orderkey
  WHERE l.o_orderkey IS NULL OR ({changed})
), upd AS (
  SELECT l.o_orderkey, l.scd_id, l.valid_from, {start} AS new_to
  FROM src1 s JOIN live l ON l.o_orderkey = s.o_orderkey WHERE {changed}
)"""
    if hard_deletes:
        sql += f""", del AS (
  SELECT l.o_orderkey, l.scd_id, l.valid_from, TIMESTAMP '{AS_OF_1}' AS new_to FROM live l
  WHERE NOT EXISTS (SELECT 1 FROM src1 s WHERE s.o_orderkey = l.o_orderkey)
)"""
    else:
        sql += """, del AS (SELECT * FROM upd WHERE false)"""
    return sql


def _changes_sql(strategy: str, hard_deletes: bool) -> str:
    return _sources_sql(strategy) + _staging_sql(strategy, hard_deletes) + """
SELECT o_orderkey, 'insert' AS change_type, scd_id, valid_from, valid_to FROM ins
UNION ALL SELECT o_orderkey, 'update' AS change_type, scd_id, valid_from, new_to AS valid_to FROM upd
UNION ALL SELECT o_orderkey, 'delete' AS change_type, scd_id, valid_from, new_to AS valid_to FROM del"""


def _merge_sql(strategy: str, hard_deletes: bool) -> str:
    return _sources_sql(strategy) + _staging_sql(strategy, hard_deletes) + f""",
closing AS (SELECT scd_id, new_to FROM upd UNION ALL SELECT scd_id, new_to FROM del)
SELECT * FROM t0 WHERE scd_id NOT IN (SELECT scd_id FROM closing)
UNION ALL
SELECT t0.o_orderkey, t0.o_custkey, t0.o_orderstatus, t0.o_totalprice, t0.updated_at,
       t0.scd_id, t0.scd_updated_at, t0.valid_from, c.new_to AS valid_to
FROM t0 JOIN closing c ON t0.scd_id = c.scd_id
UNION ALL
SELECT * FROM ins"""


def _first(src0, strategy):
    if strategy == "timestamp":
        return snap.first_snapshot(src0, "o_orderkey", "timestamp", updated_at="updated_at")
    return snap.first_snapshot(src0, "o_orderkey", "check", check_cols=_CHECK, as_of=AS_OF_0)


def _kwargs(strategy):
    if strategy == "timestamp":
        return {"strategy": "timestamp", "updated_at": "updated_at", "as_of": AS_OF_1}
    return {"strategy": "check", "check_cols": _CHECK, "as_of": AS_OF_1}


@register("snapshot_timestamp", _changes_sql("timestamp", False))
def snapshot_timestamp(spark, d):
    """Staged changes under the timestamp strategy."""
    src0, src1 = _sources(spark, d)
    return snap.snapshot_changes(_first(src0, "timestamp"), src1, "o_orderkey", **_kwargs("timestamp"))


@register("snapshot_check", _changes_sql("check", True))
def snapshot_check(spark, d):
    """Staged changes under the check strategy (NULL-safe column
    comparison) with hard deletes, at a fixed as_of."""
    src0, src1 = _sources(spark, d)
    return snap.snapshot_changes(
        _first(src0, "check"), src1, "o_orderkey", invalidate_hard_deletes=True, **_kwargs("check")
    )


@register("snapshot_merge", _merge_sql("timestamp", False))
def snapshot_merge(spark, d):
    """The merged snapshot after run 2 (timestamp strategy), in one pass."""
    src0, src1 = _sources(spark, d)
    return snap.plan_snapshot(_first(src0, "timestamp"), src1, "o_orderkey", **_kwargs("timestamp"))


@register("snapshot_merge_check", _merge_sql("check", False))
def snapshot_merge_check(spark, d):
    """B15 under the check strategy."""
    src0, src1 = _sources(spark, d)
    return snap.plan_snapshot(_first(src0, "check"), src1, "o_orderkey", **_kwargs("check"))


@register("snapshot_hard_delete", _merge_sql("timestamp", True))
def snapshot_hard_delete(spark, d):
    """Keys missing from the source are closed at as_of."""
    src0, src1 = _sources(spark, d)
    return snap.plan_snapshot(
        _first(src0, "timestamp"), src1, "o_orderkey", invalidate_hard_deletes=True, **_kwargs("timestamp")
    )


AS_OF_2 = "2026-01-01 00:00:00"

_RETURN_SQL = f"""
WITH m AS ({_merge_sql("timestamp", True)}),
src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS updated_at
        FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
back AS (
  SELECT src.*, greatest(src.updated_at, c.last_closed) AS start
  FROM src JOIN (SELECT o_orderkey, max(valid_to) AS last_closed FROM m GROUP BY o_orderkey HAVING count(*) = count(valid_to)) c
    ON c.o_orderkey = src.o_orderkey)
SELECT * REPLACE (CASE WHEN valid_to IS NULL AND o_orderkey NOT IN (SELECT o_orderkey FROM src) THEN TIMESTAMP '{AS_OF_2}' ELSE valid_to END AS valid_to)
FROM m
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, updated_at, {_scd_sql('o_orderkey', 'start')} AS scd_id,
       start AS scd_updated_at, start AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
FROM back"""


@register("snapshot_hard_delete_return", _RETURN_SQL)
def snapshot_hard_delete_return(spark, d):
    """B15 / B16 over three runs: the third meets closed history and keys that come back."""
    src0, src1 = _sources(spark, d)
    kw = {"invalidate_hard_deletes": True, **_kwargs("timestamp")}
    second = snap.plan_snapshot(_first(src0, "timestamp"), src1, "o_orderkey", **kw)
    return snap.plan_snapshot(second, src0, "o_orderkey", **(kw | {"as_of": AS_OF_2}))


@register("snapshot_hash", """
SELECT o_orderkey,
       CAST(CAST('0x' || substr(md5(coalesce(CAST(o_orderkey AS VARCHAR), '') || '|' || coalesce(o_orderstatus, '')), 1, 16) AS UBIGINT) AS DECIMAL(20,0)) AS legacy_id,
       md5(coalesce(CAST(length(CAST(o_orderkey AS VARCHAR)) AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR), 'N')
           || '|' || coalesce(CAST(length(o_orderstatus) AS VARCHAR) || ':' || o_orderstatus, 'N')) AS scd_id
FROM orders""")
def snapshot_hash(spark, d):
    """The legacy 64-bit version hash and the collision-safe id."""
    o = read_table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        fn.half_md5("o_orderkey", "o_orderstatus").alias("legacy_id"),
        fn.scd_id("o_orderkey", "o_orderstatus").alias("scd_id"),
    )


@register("snapshot_increment", _merge_sql("timestamp", False))
def snapshot_increment(spark, d):
    """B15 stored as history segments: what run 2 writes (the versions it
    closes plus the new live set). Run 1 left no closed history, so this
    equals the full merge."""
    src0, src1 = _sources(spark, d)
    return snap.plan_snapshot_increment(_first(src0, "timestamp"), None, src1, "o_orderkey",
                                        **_kwargs("timestamp"))


@register("snapshot_feed", f"""
WITH ranked AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, coalesce(l_returnflag = 'R', false) AS is_deleted,
         row_number() OVER (PARTITION BY l_orderkey, l_shipdate ORDER BY l_linenumber DESC NULLS LAST,
           coalesce(l_returnflag = 'R', false) DESC, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST) AS place
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, {_scd_sql('l_orderkey', 'l_shipdate')} AS scd_id,
       l_shipdate AS scd_updated_at, l_shipdate AS valid_from,
       lead(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate) AS valid_to, is_deleted
FROM ranked WHERE place = 1""")
def snapshot_feed(spark, d):
    """Line items as changes of their order by shipping time, returns as deletions, in three runs that come out of order."""
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", (F.col("l_returnflag") == "R").alias("gone"))
    target = None
    for part in (2, 0, 1):
        run = lines.where(F.coalesce(F.pmod("l_linenumber", F.lit(3)), F.lit(0)) == part)
        target = feed.plan_feed(target, run, "l_orderkey", "l_shipdate", "gone", ["l_linenumber"], unit="month")
    return target
