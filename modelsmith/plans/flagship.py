"""Flagship model: per-customer insight (the shape of the reference's example
``actors ⋈ roles ⟕ movies GROUP BY actor``), mapped onto the test tables as
customer ⋈ orders ⟕ lineitem.

    SELECT id, any(name), count(DISTINCT part), avg(price), max(order date)
    FROM customer JOIN orders LEFT JOIN lineitem GROUP BY id

The plan aggregates before it joins (eager aggregation):

* ``max(o_orderdate)`` depends only on the customer's orders, so it is taken
  from orders alone; the left join to lineitem cannot change it.
* part count, price sum and price count come from the *inner* join
  lineitem ⋈ orders; customers whose orders have no lines get 0 / NULL.
* the name is fixed by the customer key, so customer is reduced to one row
  per key and joined to the already aggregated result.

The wide join (lineitem ⋈ orders on the order key) is an inner join, so AQE
may split a skewed order key on either side; a left outer join could only be
split on its preserved side. All three aggregates are hash-partitioned on the
customer key, so the final joins add no shuffle. Partial (map-side)
aggregation means a customer holding a third of all rows still sends one row
per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith import functions as fn
from modelsmith.plans._registry import register
from modelsmith.sources.relations import read_table


def customer_insight(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    last_order = orders.groupBy(F.col("o_custkey").alias("id")).agg(
        F.max("o_orderdate").alias("updated_at")
    )
    links = orders.select("o_orderkey", "o_custkey")
    lines = lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    line_stats = (
        lines.join(links, lines.l_orderkey == links.o_orderkey, "inner")
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(
            fn.count_distinct("l_partkey").alias("num_parts"),
            fn.exact_avg("l_extendedprice", 2).alias("avg_price"),
        )
    )
    names = customer.groupBy(F.col("c_custkey").alias("id")).agg(
        fn.any_value(fn.concat("c_name", F.lit(" "), "c_mktsegment")).alias("name")
    )
    joined = names.join(last_order, "id", "inner").join(line_stats, "id", "left")
    return joined.select(
        "id",
        "name",
        F.coalesce(F.col("num_parts"), F.lit(0).cast("bigint")).alias("num_parts"),
        "avg_price",
        "updated_at",
    )


FLAGSHIP_ORACLE = """
SELECT id,
       any_value(actor_name) AS name,
       count(DISTINCT movie_id) AS num_parts,
       CAST(sum(CAST(rating AS DECIMAL(18,2))) AS DOUBLE) / count(rating) AS avg_price,
       max(created_at) AS updated_at
FROM (
  SELECT c.c_custkey AS id,
         c.c_name || ' ' || c.c_mktsegment AS actor_name,
         l.l_partkey AS movie_id,
         l.l_extendedprice AS rating,
         o.o_orderdate AS created_at
  FROM customer c
  JOIN orders o ON o.o_custkey = c.c_custkey
  LEFT OUTER JOIN lineitem l ON l.l_orderkey = o.o_orderkey
) t
GROUP BY id
"""


@register("flagship_insight", FLAGSHIP_ORACLE)
def flagship_insight(spark, data_dir: str) -> DataFrame:
    """F9 + E1 + E3 + F2-F5: per-customer insight, aggregated before joining."""
    return customer_insight(
        read_table(spark, data_dir, "customer"),
        read_table(spark, data_dir, "orders"),
        read_table(spark, data_dir, "lineitem"),
    )
