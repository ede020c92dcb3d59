"""Portable aggregates (F1-F8).

``listagg`` and ``group_array`` return a whole group as one value, so their
result grows with the group; use them on groups whose size is bounded by the
model (for example, per order). :func:`listagg_limited` trims every group to
``limit`` values in a distributed first pass before anything is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelsmith.functions._util import as_col


def any_value(value) -> Column:
    """Some non-NULL value of the group (only repeatable when the value is
    fixed by the group key)."""
    return F.any_value(as_col(value), ignoreNulls=True)


def bool_or(value) -> Column:
    """True when any value is true (a real OR, not an arbitrary row)."""
    return F.bool_or(as_col(value))


def count_distinct(*values) -> Column:
    """Exact number of distinct non-NULL values."""
    return F.count_distinct(*[as_col(v) for v in values])


def exact_sum(value, scale: int = 2, precision: int = 18) -> Column:
    """Sum of ``value`` rounded to ``scale`` decimals, exact and independent of
    the order a distributed sum meets the rows in.

    With ``precision <= 8`` Spark sums the unscaled values as 64-bit integers
    (its DecimalAggregates rewrite) instead of arbitrary-precision decimals,
    several times faster. A value that does not fit ``decimal(precision,
    scale)``, or a total that overflows, fails the query under ANSI mode
    rather than giving a wrong result, so pick the precision from the
    column's domain (for example prices below 10^6: ``precision=8``).
    """
    return F.sum(as_col(value).cast(f"decimal({precision},{scale})"))


def exact_avg(value, scale: int = 2, precision: int = 18) -> Column:
    """Average computed on decimals, so it does not depend on the order in
    which a distributed sum adds doubles: the sum of ``decimal(x)`` over the
    count of the values that were summed (see :func:`exact_sum` for the precision)."""
    c = as_col(value)
    return exact_sum(c, scale, precision).cast("double") / F.nullif(F.count(c.cast(f"decimal({precision},{scale})")), F.lit(0))


def group_array(value) -> Column:
    """All non-NULL values of the group, sorted (bounded groups only)."""
    return F.array_sort(F.collect_list(as_col(value)))


def listagg(measure, delimiter: str = ",", order_by=None) -> Column:
    """Values of the group joined by ``delimiter`` in ``order_by`` order
    (measure order when none). NULL measures are skipped, a group that has no
    other is NULL; ties are broken by the measure itself so the result is repeatable."""
    m = as_col(measure)
    key = as_col(order_by) if order_by is not None else m
    pairs = F.array_sort(F.collect_list(F.when(m.isNotNull(), F.struct(key.alias("k"), m.alias("v")))))
    return F.when(F.count(m) > 0, F.array_join(F.transform(pairs, lambda p: p["v"]), delimiter))


def listagg_limited(
    df: DataFrame,
    group_by: list[str],
    measure: str,
    delimiter: str,
    order_by: str,
    limit: int,
    alias: str = "listagg",
    salt_buckets: int = 64,
) -> DataFrame:
    """``listagg(measure, delimiter) within group (order by ...) limit n``.

    Each group is first cut to its ``limit`` smallest values per salt bucket
    (a window over ``(group, bucket)``, which spills instead of holding rows),
    so a hot group is spread over ``salt_buckets`` tasks; only at most
    ``limit * salt_buckets`` candidates per group reach the final collect.
    NULL measures are skipped; a group that has no other stays, with NULL.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
    known = F.col(measure).isNotNull()
    w = Window.partitionBy(*group_by, "_salt").orderBy(known.desc(), F.col(order_by), F.col(measure))
    trimmed = df.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit)
    pairs = F.array_sort(
        F.collect_list(F.when(known, F.struct(F.col(order_by).alias("k"), F.col(measure).alias("v"))))
    )
    top = F.slice(pairs, 1, limit)
    return trimmed.groupBy(*group_by).agg(
        F.when(F.count(measure) > 0, F.array_join(F.transform(top, lambda p: p["v"]), delimiter)).alias(alias)
    )
