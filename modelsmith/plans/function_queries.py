"""Queries exercising the portable function layer (2.I) on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelsmith import functions as fn
from modelsmith.plans._registry import register
from modelsmith.sources.relations import read_table


@register("fn_hash", """
SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS key_hash,
       md5(o_orderstatus) AS status_hash
FROM orders""")
def fn_hash(spark, d):
    """lower(hex(md5(toString(x))))."""
    o = read_table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        fn.hash_text("o_orderkey").alias("key_hash"),
        fn.hash_text("o_orderstatus").alias("status_hash"),
    )


@register("fn_split_part", """
SELECT c_custkey, split_part(c_name, '#', 1) AS part_1, split_part(c_name, '#', 2) AS part_2,
       split_part(c_name, '#', 3) AS part_3, split_part(c_mktsegment, 'I', 2) AS seg_2
FROM customer""")
def fn_split_part(spark, d):
    """1-based split on a literal delimiter; out of range gives ''."""
    c = read_table(spark, d, "customer")
    return c.select(
        "c_custkey",
        fn.split_part("c_name", "#", 1).alias("part_1"),
        fn.split_part("c_name", "#", 2).alias("part_2"),
        fn.split_part("c_name", "#", 3).alias("part_3"),
        fn.split_part("c_mktsegment", "I", 2).alias("seg_2"),
    )


@register("fn_replace", """
SELECT p_partkey, replace(p_name, ' ', '_') AS name_snake, replace(p_brand, 'Brand#', 'B') AS brand_short
FROM part""")
def fn_replace(spark, d):
    """I4: replace every occurrence."""
    p = read_table(spark, d, "part")
    return p.select(
        "p_partkey",
        fn.replace("p_name", " ", "_").alias("name_snake"),
        fn.replace("p_brand", "Brand#", "B").alias("brand_short"),
    )


@register("fn_bool_text", """
SELECT o_orderkey,
       CASE WHEN (o_custkey % 3) - 1 > 0 THEN 'true'
            WHEN (o_custkey % 3) - 1 = 0 THEN 'false' END AS flag_text
FROM orders""")
def fn_bool_text(spark, d):
    """cast_bool_to_text: > 0 'true', = 0 'false', otherwise NULL."""
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", fn.cast_bool_to_text((F.col("o_custkey") % 3) - 1).alias("flag_text"))


@register("fn_concat", """
SELECT c_custkey, c_name || '-' || c_mktsegment AS label,
       CASE WHEN c_custkey % 2 = 0 THEN c_name END || '!' AS maybe_label
FROM customer""")
def fn_concat(spark, d):
    """Concat / ||; NULL when any part is NULL."""
    c = read_table(spark, d, "customer")
    even_name = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name"))
    return c.select(
        "c_custkey",
        fn.concat("c_name", F.lit("-"), "c_mktsegment").alias("label"),
        fn.concat(even_name, F.lit("!")).alias("maybe_label"),
    )


@register("fn_length_position_right", """
SELECT p_partkey, CAST(length(p_name) AS BIGINT) AS name_len,
       CAST(position('ring' IN p_name) AS BIGINT) AS ring_pos, right(p_name, 3) AS name_tail
FROM part""")
def fn_length_position_right(spark, d):
    """Length, position (1-based, 0 when absent), right."""
    p = read_table(spark, d, "part")
    return p.select(
        "p_partkey",
        fn.length("p_name").alias("name_len"),
        fn.position("ring", "p_name").alias("ring_pos"),
        fn.right("p_name", 3).alias("name_tail"),
    )


@register("fn_safe_cast", """
SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS name_number,
       TRY_CAST(c_mktsegment AS INTEGER) AS segment_number
FROM customer""")
def fn_safe_cast(spark, d):
    """I8: safe_cast yields NULL instead of failing."""
    c = read_table(spark, d, "customer")
    return c.select(
        "c_custkey",
        fn.safe_cast(fn.split_part("c_name", "#", 2), "bigint").alias("name_number"),
        fn.safe_cast("c_mktsegment", "int").alias("segment_number"),
    )


@register("fn_string_literal", """
SELECT n_nationkey, 'it''s' AS single_quoted, '"quoted"' AS double_quoted,
       n_name || ' o''clock' AS mixed
FROM nation""")
def fn_string_literal(spark, d):
    """String literals holding either quote style, never spliced as SQL text."""
    n = read_table(spark, d, "nation")
    return n.select(
        "n_nationkey",
        fn.string_literal("it's").alias("single_quoted"),
        fn.string_literal('"quoted"').alias("double_quoted"),
        fn.concat("n_name", fn.string_literal(" o'clock")).alias("mixed"),
    )


@register("fn_now")
def fn_now(spark, d):
    """Load timestamp of the query; not repeatable, so rows-only."""
    e = read_table(spark, d, "events")
    return e.select("event_id", "ts", fn.now().alias("loaded_at"))


@register("fn_dateadd", """
SELECT event_id,
       ts + INTERVAL 3 DAY AS plus_3_days,
       ts + INTERVAL 1 MONTH AS plus_1_month,
       ts - INTERVAL 1 YEAR AS minus_1_year,
       ts + INTERVAL 5 HOUR AS plus_5_hours
FROM events""")
def fn_dateadd(spark, d):
    """dateadd(part, n, ts); month arithmetic clamps to the month end."""
    e = read_table(spark, d, "events")
    return e.select(
        "event_id",
        fn.dateadd("day", 3, "ts").alias("plus_3_days"),
        fn.dateadd("month", 1, "ts").alias("plus_1_month"),
        fn.dateadd("year", -1, "ts").alias("minus_1_year"),
        fn.dateadd("hour", 5, "ts").alias("plus_5_hours"),
    )


@register("fn_datediff", """
SELECT l.l_orderkey, l.l_linenumber,
       date_diff('day', o.o_orderdate, l.l_shipdate) AS days,
       date_diff('day', date_trunc('week', o.o_orderdate), date_trunc('week', l.l_shipdate)) // 7 AS weeks,
       date_diff('month', o.o_orderdate, l.l_shipdate) AS months,
       date_diff('quarter', o.o_orderdate, l.l_shipdate) AS quarters,
       date_diff('year', o.o_orderdate, l.l_shipdate) AS years,
       date_diff('hour', o.o_orderdate, l.l_shipdate + INTERVAL 1 MINUTE) AS hours
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def fn_datediff(spark, d):
    """Boundary-counting datediff (weeks start on Monday)."""
    li, o = read_table(spark, d, "lineitem"), read_table(spark, d, "orders")
    j = li.join(o, o.o_orderkey == li.l_orderkey)
    ship_plus = fn.dateadd("minute", 1, "l_shipdate")
    return j.select(
        "l_orderkey",
        "l_linenumber",
        fn.datediff("o_orderdate", "l_shipdate", "day").alias("days"),
        fn.datediff("o_orderdate", "l_shipdate", "week").alias("weeks"),
        fn.datediff("o_orderdate", "l_shipdate", "month").alias("months"),
        fn.datediff("o_orderdate", "l_shipdate", "quarter").alias("quarters"),
        fn.datediff("o_orderdate", "l_shipdate", "year").alias("years"),
        fn.datediff("o_orderdate", ship_plus, "hour").alias("hours"),
    )


@register("fn_datediff_clock", """
SELECT event_id,
       date_diff('hour', ts, TIMESTAMP '2024-01-15 12:34:56.5') AS hours,
       date_diff('minute', ts, TIMESTAMP '2024-01-15 12:34:56.5') AS minutes,
       date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-01-15 12:34:56') AS seconds
FROM events""")
def fn_datediff_clock(spark, d):
    """I13 on clock units against a fixed instant."""
    e = read_table(spark, d, "events")
    pin = F.lit("2024-01-15 12:34:56.5").cast("timestamp_ntz")
    return e.select(
        "event_id",
        fn.datediff("ts", pin, "hour").alias("hours"),
        fn.datediff("ts", pin, "minute").alias("minutes"),
        fn.datediff("ts", pin, "second").alias("seconds"),
    )


@register("fn_date_trunc", """
SELECT event_id, date_trunc('day', ts) AS ts_day, date_trunc('hour', ts) AS ts_hour,
       date_trunc('week', ts) AS ts_week, date_trunc('month', ts) AS ts_month
FROM events""")
def fn_date_trunc(spark, d):
    """date_trunc, kept as timestamp_ntz."""
    e = read_table(spark, d, "events")
    return e.select(
        "event_id",
        fn.date_trunc("day", "ts").alias("ts_day"),
        fn.date_trunc("hour", "ts").alias("ts_hour"),
        fn.date_trunc("week", "ts").alias("ts_week"),
        fn.date_trunc("month", "ts").alias("ts_month"),
    )


@register("fn_last_day", """
SELECT o_orderkey,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
       CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end
FROM orders""")
def fn_last_day(spark, d):
    """Last day of month, quarter and year."""
    o = read_table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        fn.last_day("o_orderdate", "month").alias("month_end"),
        fn.last_day("o_orderdate", "quarter").alias("quarter_end"),
        fn.last_day("o_orderdate", "year").alias("year_end"),
    )


@register("fn_array_construct", """
SELECT c_custkey, [c_custkey, CAST(c_nationkey AS BIGINT)] AS keys,
       CAST([] AS BIGINT[]) AS no_keys
FROM customer""")
def fn_array_construct(spark, d):
    """I16: array literal from columns, and a typed empty array."""
    c = read_table(spark, d, "customer")
    return c.select(
        "c_custkey",
        fn.array_construct([F.col("c_custkey"), F.col("c_nationkey").cast("bigint")]).alias("keys"),
        fn.array_construct([], "bigint").alias("no_keys"),
    )


@register("fn_array_append", """
SELECT o_orderkey, list_append([o_custkey], o_orderkey) AS keys
FROM orders""")
def fn_array_append(spark, d):
    """Append an element."""
    o = read_table(spark, d, "orders")
    return o.select(
        "o_orderkey", fn.array_append(fn.array_construct([F.col("o_custkey")]), F.col("o_orderkey")).alias("keys")
    )


@register("fn_array_concat", """
SELECT l_orderkey, l_linenumber, list_concat([l_partkey, l_suppkey], [l_orderkey]) AS keys
FROM lineitem""")
def fn_array_concat(spark, d):
    """Concatenate two arrays."""
    li = read_table(spark, d, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        fn.array_concat(
            fn.array_construct([F.col("l_partkey"), F.col("l_suppkey")]),
            fn.array_construct([F.col("l_orderkey")]),
        ).alias("keys"),
    )


@register("fn_element_at", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[2] AS second_word,
       string_split(p_name, ' ')[5] AS fifth_word
FROM part""")
def fn_element_at(spark, d):
    """1-based element access; out of range gives NULL."""
    p = read_table(spark, d, "part")
    words = F.split(F.col("p_name"), " ")
    return p.select(
        "p_partkey",
        fn.element_at(words, 1).alias("first_word"),
        fn.element_at(words, 2).alias("second_word"),
        fn.element_at(words, 5).alias("fifth_word"),
    )


@register("fn_type_casts", """
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS as_bigint, CAST(o_custkey AS INTEGER) AS as_int,
       CAST(o_orderstatus = 'F' AS BOOLEAN) AS as_boolean, CAST(o_totalprice AS FLOAT) AS as_float,
       CAST(o_totalprice AS DECIMAL(28,6)) AS as_numeric, CAST(o_custkey AS VARCHAR) AS as_string,
       CAST(o_orderdate AS TIMESTAMP) AS as_timestamp
FROM orders""")
def fn_type_casts(spark, d):
    """Casts to the portable type names."""
    o = read_table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        fn.cast_to("o_custkey", "bigint").alias("as_bigint"),
        fn.cast_to("o_custkey", "int").alias("as_int"),
        fn.cast_to(F.col("o_orderstatus") == "F", "boolean").alias("as_boolean"),
        fn.cast_to("o_totalprice", "float").alias("as_float"),
        fn.cast_to("o_totalprice", "numeric").alias("as_numeric"),
        fn.cast_to("o_custkey", "string").alias("as_string"),
        fn.cast_to("o_orderdate", "timestamp").alias("as_timestamp"),
    )
