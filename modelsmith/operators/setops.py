"""EXCEPT and INTERSECT (distinct), H4 and H5.

Spark rewrites ``a EXCEPT b`` into ``distinct(a)`` anti-joined with ``b`` on
NULL-safe equality of every column: two shuffles, and a value repeated in a
third of ``b`` lands in one task of the join, which AQE cannot split on the
right side of an anti join. Here both sides are tagged, unioned and grouped
by all columns once, recording on which side each distinct row occurs: one
shuffle, partial aggregation collapses repeated rows before it, and grouping
compares NULLs as equal, exactly as the set operators do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    if len(a.columns) != len(b.columns):
        raise ValueError("set operations need the same number of columns")
    cols = a.columns
    b_named = b.toDF(*cols)  # positional, like SQL set operators
    tagged = a.select(*[F.col(f"`{c}`") for c in cols], F.lit(True).alias("_a"), F.lit(False).alias("_b"))
    tagged = tagged.unionByName(
        b_named.select(*[F.col(f"`{c}`") for c in cols], F.lit(False).alias("_a"), F.lit(True).alias("_b"))
    )
    return tagged.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(
        F.bool_or("_a").alias("_in_a"), F.bool_or("_b").alias("_in_b")
    )


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that do not occur in ``b``."""
    g = _sides(a, b)
    return g.filter(F.col("_in_a") & ~F.col("_in_b")).drop("_in_a", "_in_b")


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that occur in both ``a`` and ``b``."""
    g = _sides(a, b)
    return g.filter(F.col("_in_a") & F.col("_in_b")).drop("_in_a", "_in_b")
