"""Queries for the materializations (2.A sinks, 2.B, 2.K).

Each query returns the DataFrame a build would write as the model's next
version — the same plan :class:`modelsmith.operators.project.Project` writes
and publishes — so the check compares exactly what a run would store. Batches
are cut from the test tables by date: run 1 sees the data before a cut-off,
run 2 the data from an earlier date on (overlapping, so updates occur).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from modelsmith import functions as fn
from modelsmith.operators import incremental as inc
from modelsmith.operators.publish import Layout
from modelsmith.operators.schema_change import SchemaChangeError
from modelsmith.operators.types import conform, split_conformed
from modelsmith.plans._registry import register
from modelsmith.plans.flagship import FLAGSHIP_ORACLE
from modelsmith.sources import seeds
from modelsmith.sources.relations import read_table


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ------------------------------------------------------------------ seeds

def _orders_csv_text(spark, d):
    """orders as a CSV reader returns them: every column text, timestamps in
    ISO form with 'T', booleans as words, empty fields for missing prices."""
    o = read_table(spark, d, "orders")
    price = F.col("o_totalprice").cast("string")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        price.alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("o_orderdate"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("is_final"),
        "o_orderpriority",
        price.alias("price_dec"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(price).alias("maybe_price"),
    )


_SEED_TYPES = {"o_orderpriority": "LowCardinality(String)", "price_dec": "Decimal(12, 2)"}


@register("seed_load", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(o_orderdate AS DATE) AS order_day, o_orderstatus = 'F' AS is_final, o_orderpriority,
       CAST(o_totalprice AS DECIMAL(12,2)) AS price_dec,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS maybe_price
FROM orders""")
def seed_load(spark, d):
    """A2: seed text typed by inference, with declared types winning."""
    return seeds.type_seed(_orders_csv_text(spark, d), _SEED_TYPES)


@register("seed_infer", """
SELECT * FROM (VALUES
  ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
  ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('order_day', 'date'),
  ('is_final', 'boolean'), ('o_orderpriority', 'string'), ('price_dec', 'double'),
  ('maybe_price', 'double')) t(column_name, column_type)""")
def seed_infer(spark, d):
    """A3: the inferred type of each seed column (one aggregate pass)."""
    inferred = seeds.infer_types(_orders_csv_text(spark, d))
    return spark.createDataFrame(list(inferred.items()), "column_name string, column_type string")


# ------------------------------------------------------------------ tables and views

def _daily_orders(spark, d):
    o = read_table(spark, d, "orders")
    return o.groupBy("o_orderstatus", F.to_date("o_orderdate").alias("order_day")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"),
    )


_DAILY_SQL = """
SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS order_day, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue
FROM orders GROUP BY o_orderstatus, CAST(o_orderdate AS DATE)"""


@register("table_full", _DAILY_SQL)
def table_full(spark, d):
    """B2 / A4: a table model, arranged as written (sorted by order_by)."""
    return Layout(order_by=["order_day", "o_orderstatus"]).arrange(_daily_orders(spark, d))


@register("table_partitioned", _DAILY_SQL)
def table_partitioned(spark, d):
    """A5: partition_by status, order_by day: rebalanced on the partition
    column, sorted by partition column then order key."""
    return Layout(partition_by=["o_orderstatus"], order_by=["order_day"]).arrange(_daily_orders(spark, d))


@register("view_model", FLAGSHIP_ORACLE)
def view_model(spark, d):
    """The flagship as a SQL view model over the source tables."""
    base = d.rstrip("/")
    spark.sql(
        f"""
        CREATE OR REPLACE TEMP VIEW modelsmith_view_model AS
        SELECT id, any_value(actor_name) AS name, count(DISTINCT movie_id) AS num_parts,
               CAST(sum(CAST(rating AS DECIMAL(18,2))) AS DOUBLE) / count(rating) AS avg_price,
               max(created_at) AS updated_at
        FROM (
          SELECT c.c_custkey AS id, concat(c.c_name, ' ', c.c_mktsegment) AS actor_name,
                 l.l_partkey AS movie_id, l.l_extendedprice AS rating, o.o_orderdate AS created_at
          FROM parquet.`{base}/customer.parquet` c
          JOIN parquet.`{base}/orders.parquet` o ON o.o_custkey = c.c_custkey
          LEFT OUTER JOIN parquet.`{base}/lineitem.parquet` l ON l.l_orderkey = o.o_orderkey
        ) t
        GROUP BY id"""
    )
    return spark.table("modelsmith_view_model")


@register("update_column", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""")
def update_column(spark, d):
    """Update one column where a condition holds."""
    o = read_table(spark, d, "orders")
    return inc.plan_update_column(o, "o_totalprice", F.col("o_totalprice") * 2, F.col("o_orderstatus") == "F")


# ------------------------------------------------------------------ conformance

def _orders_text_with_bad_rows(spark, d):
    o = read_table(spark, d, "orders")
    year = F.year("o_orderdate")
    price = F.col("o_totalprice").cast("string")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(year == 1996, F.concat("o_orderstatus", "o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(year == 1999, F.concat(F.lit("99999999"), price)).otherwise(price).alias("o_totalprice"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        "o_orderpriority",
    )


_DECLARED = {
    "o_orderkey": "UInt32",
    "o_custkey": "Nullable(Int64)",
    "o_orderstatus": "FixedString(1)",
    "o_totalprice": "Decimal(12, 2)",
    "o_orderdate": "DateTime",
    "o_orderpriority": "LowCardinality(String)",
}


@register("conform_types", """
WITH t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k,
         CASE WHEN o_orderstatus = 'P' THEN 'c' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS c,
         CASE WHEN year(o_orderdate) = 1996 THEN o_orderstatus || o_orderstatus ELSE o_orderstatus END AS s,
         CASE WHEN year(o_orderdate) = 1999 THEN '99999999' || CAST(o_totalprice AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END AS p,
         CAST(o_orderdate AS VARCHAR) AS dt,
         o_orderpriority
  FROM orders
)
SELECT TRY_CAST(k AS BIGINT) AS o_orderkey, TRY_CAST(c AS BIGINT) AS o_custkey, s AS o_orderstatus,
       TRY_CAST(p AS DECIMAL(12,2)) AS o_totalprice, TRY_CAST(dt AS TIMESTAMP) AS o_orderdate, o_orderpriority
FROM t
WHERE TRY_CAST(k AS BIGINT) BETWEEN 0 AND 4294967295
  AND (c IS NULL OR TRY_CAST(c AS BIGINT) IS NOT NULL)
  AND s IS NOT NULL AND length(s) <= 1
  AND TRY_CAST(p AS DECIMAL(12,2)) IS NOT NULL
  AND TRY_CAST(dt AS TIMESTAMP) IS NOT NULL
  AND o_orderpriority IS NOT NULL""")
def conform_types(spark, d):
    """K1: text columns conformed to declared types; rows that do not fit
    (bad integers, too-long fixed strings, decimal overflow) are rejected."""
    good, _bad = split_conformed(conform(_orders_text_with_bad_rows(spark, d), _DECLARED))
    return good


@register("conform_nested", """
WITH t AS (
  SELECT o_orderkey, [CAST(o_custkey AS VARCHAR), o_orderstatus] AS a, o_custkey % 300 AS n
  FROM orders
)
SELECT o_orderkey, a AS names, [CAST(n AS SMALLINT)] AS levels, a[2] AS status, CAST(n AS SMALLINT) AS level
FROM t WHERE n <= 255 AND length(a[1]) <= 3""")
def conform_nested(spark, d):
    """K1: rules of element and value types hold inside arrays and maps."""
    key = F.col("o_custkey")
    o = read_table(spark, d, "orders").select(
        "o_orderkey", F.array(key.cast("string"), "o_orderstatus").alias("names"),
        F.array((key % 300).cast("string")).alias("levels"),
        F.create_map("o_orderstatus", (key % 300).cast("string")).alias("by_status"))
    good, _bad = split_conformed(conform(o, {
        "names": "Array(FixedString(3))", "levels": "Array(Nullable(UInt8))", "by_status": "Map(String, UInt8)"}))
    return good.select(
        "o_orderkey", "names", "levels", F.map_keys("by_status")[0].alias("status"), F.map_values("by_status")[0].alias("level"))


# ------------------------------------------------------------------ incremental

_CUT = "2024-01-16"      # run 1 sees events before this instant
_OVERLAP = "2024-01-10"  # run 2's append batch starts here (overlaps run 1)
_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]
_EVENT_SQL_COLS = ", ".join(_EVENT_COLS)


def _events(spark, d):
    return read_table(spark, d, "events").select(*_EVENT_COLS)


def _event_model(spark, d):
    """The events before the cut without a target, the overlapping batch with one."""
    events = _events(spark, d)
    return lambda this: events.filter(F.col("ts") < _ts(_CUT) if this is None else F.col("ts") >= _ts(_OVERLAP))


@register("incremental_first", f"SELECT {_EVENT_SQL_COLS} FROM events WHERE ts < TIMESTAMP '{_CUT}'")
def incremental_first(spark, d):
    """No target yet, the model output is the first version."""
    return inc.next_version(None, _event_model(spark, d))


@register("incremental_append", f"""
SELECT {_EVENT_SQL_COLS} FROM events WHERE ts < TIMESTAMP '{_CUT}'
UNION ALL
SELECT {_EVENT_SQL_COLS} FROM events WHERE ts >= TIMESTAMP '{_OVERLAP}'""")
def incremental_append(spark, d):
    """No unique key, all new rows appended (duplicates kept)."""
    model = _event_model(spark, d)
    return inc.next_version(inc.next_version(None, model), model)


@register("incremental_full_refresh", f"SELECT {_EVENT_SQL_COLS} FROM events")
def incremental_full_refresh(spark, d):
    """A full refresh rebuilds from the whole source, ignoring the target."""
    first = inc.next_version(None, _event_model(spark, d))
    return inc.next_version(first, lambda this: _events(spark, d), full_refresh=True)


def _user_insight(events):
    return events.groupBy(F.col("user_id").alias("id")).agg(
        fn.count_distinct("event_type").alias("num_types"),
        fn.exact_avg("value").alias("avg_value"),
        F.max("ts").alias("updated_at"),
    )


_USER_INSIGHT_SQL = """SELECT user_id AS id, count(DISTINCT event_type) AS num_types,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS avg_value,
       max(ts) AS updated_at FROM events"""


@register("incremental_highwater", f"""
WITH m1 AS ({_USER_INSIGHT_SQL} WHERE ts < TIMESTAMP '{_CUT}' GROUP BY user_id),
     m2 AS ({_USER_INSIGHT_SQL} GROUP BY user_id)
SELECT * FROM m1
UNION ALL
SELECT * FROM m2
WHERE (SELECT max(id) FROM m1) IS NULL OR id > (SELECT max(id) FROM m1)
   OR (SELECT max(updated_at) FROM m1) IS NULL OR updated_at > (SELECT max(updated_at) FROM m1)""")
def incremental_highwater(spark, d):
    """is_incremental() filter ``id > max(id) OR updated_at >
    max(updated_at)`` of the target, as scalar subqueries."""
    events = read_table(spark, d, "events")
    this = _user_insight(events.filter(F.col("ts") < _ts(_CUT)))
    new = inc.high_water_filter(_user_insight(events), this, ["id", "updated_at"])
    return inc.plan_append(this, new)


# ------------------------------------------------------------------ upserts

_OLD_CUT = "1999-01-01"  # the target holds orders before this date
_NEW_FROM = "1998-01-01"  # new data: orders from this date on, repriced


def _upsert_sides(spark, d):
    o = read_table(spark, d, "orders")
    old = o.filter(F.col("o_orderdate") < _ts(_OLD_CUT))
    new = o.filter(F.col("o_orderdate") >= _ts(_NEW_FROM)).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    return old, new


_UPSERT_CTE = f"""
WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{_OLD_CUT}'),
     new AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
                    o_orderdate, o_orderpriority
             FROM orders WHERE o_orderdate >= TIMESTAMP '{_NEW_FROM}')"""


@register("upsert_keyed", f"""{_UPSERT_CTE}
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey)
UNION ALL SELECT * FROM new""")
def upsert_keyed(spark, d):
    """Keyed upsert, old rows without a new key plus all new rows."""
    old, new = _upsert_sides(spark, d)
    return inc.plan_upsert(old, new, "o_orderkey")


@register("upsert_composite", f"""{_UPSERT_CTE}
SELECT * FROM old WHERE NOT EXISTS (
  SELECT 1 FROM new WHERE new.o_custkey = old.o_custkey AND new.o_orderkey = old.o_orderkey)
UNION ALL SELECT * FROM new""")
def upsert_composite(spark, d):
    """B6 with a composite unique key (o_custkey, o_orderkey)."""
    old, new = _upsert_sides(spark, d)
    return inc.plan_upsert(old, new, ["o_custkey", "o_orderkey"])


# ------------------------------------------------------------------ schema change

def _drift_sides(spark, d):
    """Target: events before the cut with user_id as int and a value column;
    new batch: later events with user_id as bigint, no value, a new props."""
    e = read_table(spark, d, "events")
    target = e.filter(F.col("ts") < _ts(_CUT)).select(
        "event_id", "ts", F.col("user_id").cast("int").alias("user_id"), "event_type", "value"
    )
    new = e.filter(F.col("ts") >= _ts(_CUT)).select("event_id", "ts", "user_id", "event_type", "props")
    return target, new


@register("schema_ignore", f"""
SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, value FROM events WHERE ts < TIMESTAMP '{_CUT}'
UNION ALL
SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, CAST(NULL AS DOUBLE) AS value
FROM events WHERE ts >= TIMESTAMP '{_CUT}'""")
def schema_ignore(spark, d):
    """Keep the target's columns; the new batch is projected onto them."""
    target, new = _drift_sides(spark, d)
    return inc.plan_append(target, new, "ignore")


@register("schema_fail", f"""
SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, value
FROM events WHERE ts < TIMESTAMP '{_CUT}'""")
def schema_fail(spark, d):
    """The drifted batch is refused before any write, so the target stays
    as it was."""
    target, new = _drift_sides(spark, d)
    try:
        return inc.plan_append(target, new, "fail")
    except SchemaChangeError:
        return target


@register("schema_append", f"""
SELECT event_id, ts, CAST(user_id AS BIGINT) AS user_id, event_type, value, CAST(NULL AS VARCHAR) AS props
FROM events WHERE ts < TIMESTAMP '{_CUT}'
UNION ALL
SELECT event_id, ts, user_id, event_type, CAST(NULL AS DOUBLE) AS value, props
FROM events WHERE ts >= TIMESTAMP '{_CUT}'""")
def schema_append(spark, d):
    """B10 + B12: new columns appended (NULL in old rows), int widened to bigint."""
    target, new = _drift_sides(spark, d)
    return inc.plan_append(target, new, "append_new_columns")


@register("schema_sync", f"""
SELECT event_id, ts, CAST(user_id AS BIGINT) AS user_id, event_type, CAST(NULL AS VARCHAR) AS props
FROM events WHERE ts < TIMESTAMP '{_CUT}'
UNION ALL
SELECT event_id, ts, user_id, event_type, props FROM events WHERE ts >= TIMESTAMP '{_CUT}'""")
def schema_sync(spark, d):
    """The new column list wins; removed columns dropped."""
    target, new = _drift_sides(spark, d)
    return inc.plan_append(target, new, "sync_all_columns")


@register("widen_refused", f"""
SELECT event_id, ts, user_id FROM events WHERE ts < TIMESTAMP '{_CUT}'""")
def widen_refused(spark, d):
    """Bigint ids do not become doubles; the batch is refused before any write."""
    e = read_table(spark, d, "events")
    target = e.filter(F.col("ts") < _ts(_CUT)).select("event_id", "ts", "user_id")
    new = e.filter(F.col("ts") >= _ts(_CUT)).select(F.col("event_id").cast("double").alias("event_id"), "ts", "user_id")
    try:
        return inc.plan_append(target, new, "append_new_columns")
    except SchemaChangeError:
        return target


@register("widen_types", f"""
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(CAST(value AS DECIMAL(8,2)) AS DECIMAL(10,3)) AS value,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day
FROM events WHERE ts < TIMESTAMP '{_CUT}'
UNION ALL
SELECT event_id, CAST(value AS DECIMAL(10,3)) AS value, ts AS day
FROM events WHERE ts >= TIMESTAMP '{_CUT}'""")
def widen_types(spark, d):
    """int→bigint, decimal(8,2)∪decimal(10,3)→decimal(10,3),
    date→timestamp, by explicit casts before the union."""
    e = read_table(spark, d, "events")
    target = e.filter(F.col("ts") < _ts(_CUT)).select(
        F.col("event_id").cast("int").alias("event_id"),
        F.col("value").cast("decimal(8,2)").alias("value"),
        F.to_date("ts").alias("day"),
    )
    new = e.filter(F.col("ts") >= _ts(_CUT)).select(
        "event_id", F.col("value").cast("decimal(10,3)").alias("value"), F.col("ts").alias("day")
    )
    return inc.plan_append(target, new, "append_new_columns")
