"""Global prefix sums over an ordered table, without a single-task sort.

The rows are range-partitioned by the order and staged; each partition's totals
(one row a partition) give the sums before it; a window inside each partition
adds the rest. What is broadcast has one row for each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelsmith.llm.scratch import stage


def prefix_sums(rows: DataFrame, order: Sequence[str], amount: str) -> DataFrame:
    """Adds ``before`` (sum of ``amount`` over all earlier rows) and ``number`` (of earlier rows).

    Rows that tie in ``order`` are told apart by an id given before the staging,
    so a key that holds many rows is still split between partitions.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    order = [*order, "_tie"]
    ranged = stage(tied.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_part").agg(F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows"))
    inside = Window.partitionBy("_part").orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.select(
        "*", F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias("_in"), (F.row_number().over(inside) - 1).cast("long").alias("_nth"))
    return summed.join(F.broadcast(offsets), "_part").select(
        *rows.columns, (F.col("_sum") + F.col("_in")).alias("before"), (F.col("_rows") + F.col("_nth")).alias("number"))
