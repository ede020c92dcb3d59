"""Column catalog with statistics (C7, with the comments of B20).

One row per column: where it lives, its 1-based position, type and comment,
and statistics over the whole relation. All statistics of a table come from
**one** global aggregate (one scan, partial aggregation per task, a final merge
of one row per task), which is then unpivoted into one row per column with
``inline``; column metadata is carried as literals, so there is no join.

Exact statistics (row and NULL counts, min, max) cost one pass. The distinct
count uses a HyperLogLog sketch (``approx_count_distinct``); an exact distinct
count of every column would expand each row once per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType

EXACT_STATS = ("row_count", "null_count", "min_value", "max_value")
ALL_STATS = EXACT_STATS + ("approx_distinct",)
# Opt-in: exact distinct counts expand every row once per column (Spark's
# Expand for several distinct aggregates), so they are for small relations.
KNOWN_STATS = ALL_STATS + ("distinct_count",)


def _orderable(dtype) -> bool:
    return not isinstance(dtype, (MapType, StructType, ArrayType, BinaryType))


def column_comment(field) -> str | None:
    return field.metadata.get("comment") if field.metadata else None


def column_stats(
    df: DataFrame,
    table_name: str,
    table_schema: str | None = None,
    table_type: str = "table",
    table_comment: str | None = None,
    column_comments: Mapping[str, str] | None = None,
    stats: Sequence[str] = EXACT_STATS,
    rsd: float = 0.05,
) -> DataFrame:
    unknown = set(stats) - set(KNOWN_STATS)
    if unknown:
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    comments = dict(column_comments or {})
    aggs = [F.count(F.lit(1)).alias("_rows")]
    entries = []
    for i, field in enumerate(df.schema.fields, start=1):
        c = F.col(f"`{field.name}`")
        parts = [
            F.lit(table_schema).cast("string").alias("table_schema"),
            F.lit(table_name).alias("table_name"),
            F.lit(table_type).alias("table_type"),
            F.lit(table_comment).cast("string").alias("table_comment"),
            F.lit(i).alias("column_index"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.lit(comments.get(field.name, column_comment(field))).cast("string").alias("column_comment"),
        ]
        if "null_count" in stats:
            aggs.append(F.count(c).alias(f"_n{i}"))
            parts.append((F.col("_rows") - F.col(f"_n{i}")).alias("null_count"))
        ordered = _orderable(field.dataType)
        for stat, fn in (("min_value", F.min), ("max_value", F.max)):
            if stat in stats:
                if ordered:
                    aggs.append(fn(c).cast("string").alias(f"_{stat}{i}"))
                    parts.append(F.col(f"_{stat}{i}").alias(stat))
                else:
                    parts.append(F.lit(None).cast("string").alias(stat))
        if "approx_distinct" in stats:
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"_d{i}"))
            parts.append(F.col(f"_d{i}").alias("approx_distinct"))
        if "distinct_count" in stats:
            if ordered:
                aggs.append(F.count_distinct(c).alias(f"_x{i}"))
                parts.append(F.col(f"_x{i}").alias("distinct_count"))
            else:
                parts.append(F.lit(None).cast("bigint").alias("distinct_count"))
        if "row_count" in stats:
            parts.append(F.col("_rows").alias("row_count"))
        entries.append(F.struct(*parts))
    one_row = df.agg(*aggs)
    return one_row.select(F.inline(F.array(*entries)))
