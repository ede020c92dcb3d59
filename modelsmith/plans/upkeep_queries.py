"""Queries for the upkeep of aggregates over joins and for exact sums of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelsmith.functions.exact import exact_double_totals
from modelsmith.operators.upkeep import JoinAggregate
from modelsmith.plans._registry import register
from modelsmith.plans.flagship import FLAGSHIP_ORACLE, customer_insight
from modelsmith.sources.relations import read_table

#: The flagship model's sources: the group key in customer and orders, lineitem linked to its order.
CUSTOMER_INSIGHT = JoinAggregate(
    keys={"customer": ["c_custkey"], "orders": ["o_custkey"]},
    links={"lineitem": ("orders", [("l_orderkey", "o_orderkey")])},
    key=["id"],
    model=lambda s: customer_insight(s["customer"], s["orders"], s["lineitem"]),
)


def late_rows() -> dict[str, Column]:
    """Which rows of each source the first run did not see: some customers, the orders of every
    97th key, and the third lines of some orders."""
    return {
        "customer": F.col("c_custkey") % 211 == 5,
        "orders": F.col("o_orderkey") % 97 == 3,
        "lineitem": (F.col("l_linenumber") == 3) & (F.col("l_orderkey") % 89 == 7),
    }


@register("incremental_affected_keys", FLAGSHIP_ORACLE)
def incremental_affected_keys(spark, d):
    """B6 + B7 + F9: the flagship after late rows of all three sources, by recomputing the touched groups alone."""
    sources = {name: read_table(spark, d, name) for name in ("customer", "orders", "lineitem")}
    late = late_rows()
    target = CUSTOMER_INSIGHT.refresh(None, {name: df.where(~late[name]) for name, df in sources.items()}, None)
    return CUSTOMER_INSIGHT.refresh(target, sources, {name: df.where(late[name]) for name, df in sources.items()})


def _exact_sql(value: str, name: str, shift: int) -> str:
    """Sum and average by group of doubles that are whole multiples of 2^-shift, in 128-bit integers."""
    cut = "greatest(0, CAST(floor(log2(CAST({0} AS DOUBLE) + 1)) AS INTEGER) - 60)"

    def near(size: str, below: str, power: str) -> str:
        k = cut.format(size)
        unit = f"CAST(pow(2, {k}) AS HUGEINT)"
        bits = f"CAST(({size}) // {unit} AS BIGINT)"
        low = f"CASE WHEN ({size}) % {unit} <> 0 OR {below} THEN 1 ELSE 0 END"
        return f"CAST({bits} | CAST({low} AS BIGINT) AS DOUBLE) * pow(2.0, {k} - {power})"

    return f"""
{name} AS (
  SELECT event_type, count(v) AS n, abs(s) AS size, CASE WHEN s < 0 THEN -1 ELSE 1 END AS sgn
  FROM (SELECT event_type, v, sum(CAST(v * pow(2.0, {shift}) AS HUGEINT)) OVER (PARTITION BY event_type) AS s FROM (SELECT event_type, {value} AS v FROM events))
  GROUP BY event_type, s
), {name}_out AS (
  SELECT event_type, CAST(n AS BIGINT) AS {name}_count, sgn * {near("size", "false", str(shift))} AS {name}_sum,
    sgn * {near("(size * 1073741824) // n", "(size * 1073741824) % n <> 0", str(shift + 30))} AS {name}_avg
  FROM {name}
)"""


@register("agg_avg_exact", f"""
WITH {_exact_sql("value", "plain", 60)}, {_exact_sql("value * 1e-7", "small", 90)}, {_exact_sql("value * 1e12", "large", 20)}
SELECT * FROM plain_out JOIN small_out USING (event_type) JOIN large_out USING (event_type)""")
def agg_avg_exact(spark, d):
    """exact sum and average of doubles of any size, rounded once; no scale is declared."""
    events = read_table(spark, d, "events")
    return exact_double_totals(events, ["event_type"], {"plain": "value", "small": F.col("value") * 1e-7, "large": F.col("value") * 1e12})
