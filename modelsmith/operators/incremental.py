"""Plans of the incremental materializations.

Each function takes DataFrames and returns the DataFrame of the *next
version* of the target; writing and publishing it is the builder's job
(:mod:`modelsmith.operators.project`). All are single declarative plans.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelsmith.operators.schema_change import reconcile


def _keys(unique_key: str | Sequence[str]) -> list[str]:
    return [unique_key] if isinstance(unique_key, str) else list(unique_key)


def high_water_filter(new: DataFrame, this: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """Rows of ``new`` past the target's high-water mark (B7, P9):
    ``c1 > max(c1) OR c2 > max(c2) ...`` over the target ``this``.

    The marks are one scalar subquery (a one-row aggregate of the target, run
    once), not a collected literal and not a join. A NULL mark (empty target,
    or no target yet) lets every row pass; a plain ``c > NULL`` would drop the
    whole batch.
    """
    if this is None:
        return new
    marks = this.agg(F.struct(*[F.max(c).alias(c) for c in columns]).alias("m")).scalar()
    passes: Column | None = None
    for c in columns:
        mark = marks[c]
        cond = mark.isNull() | (F.col(c) > mark)
        passes = cond if passes is None else (passes | cond)
    return new.filter(F.coalesce(passes, F.lit(False)))


def next_version(
    this: DataFrame | None,
    model: Callable[[DataFrame | None], DataFrame],
    unique_key: str | Sequence[str] | None = None,
    inserts_only: bool = False,
    on_schema_change: str = "ignore",
    full_refresh: bool = False,
) -> DataFrame:
    """The branch of a run (B3-B6) and the target's next version.

    Without a target ``this``, or on a full refresh, the model's whole output is
    the next version (the model then sees None); otherwise its output is
    appended, or upserted on ``unique_key``.
    """
    if this is None or full_refresh:
        return model(None)
    new = model(this)
    if inserts_only or unique_key is None:
        return plan_append(this, new, on_schema_change)
    return plan_upsert(this, new, unique_key, on_schema_change)


def plan_append(existing: DataFrame, new: DataFrame, on_schema_change: str = "ignore") -> DataFrame:
    """Every new row is added, duplicates allowed (the schema policy is
    applied to this branch too)."""
    old_p, new_p = reconcile(existing, new, on_schema_change)
    return old_p.unionByName(new_p)


def plan_upsert(
    existing: DataFrame,
    new: DataFrame,
    unique_key: str | Sequence[str],
    on_schema_change: str = "ignore",
) -> DataFrame:
    """Old rows whose key is absent from the new data, plus all new rows.

    The surviving old rows come from a left anti join against the distinct new
    keys (sort-merge, or broadcast when AQE measures the key side small). The
    distinct is hash-partitioned on the key, so the join reuses it. A NULL key
    never matches: such old rows survive and new ones are added, nothing is
    lost (``NOT IN`` would drop every old row once a new key is NULL).
    """
    keys = _keys(unique_key)
    old_p, new_p = reconcile(existing, new, on_schema_change)
    new_keys = new_p.select(*keys).distinct()
    survivors = old_p.join(new_keys, keys, "left_anti")
    return survivors.select(*old_p.columns).unionByName(new_p)


def plan_partition_upsert(
    existing: DataFrame,
    new: DataFrame,
    unique_key: str | Sequence[str],
    partition_by: Sequence[str],
    on_schema_change: str = "ignore",
) -> DataFrame:
    """B6 restricted to the partitions the new data touches.

    Returns the full contents of every touched partition (surviving old rows
    plus new rows); untouched partitions are not read or rewritten. The
    semi join on the partition columns lets dynamic partition pruning skip the
    untouched partitions of the target scan. Contract: no key of the new data
    lies in an untouched partition (see :func:`moved_keys`).
    Partition values are compared NULL-safely, so the NULL partition is
    handled like any other.
    """
    keys = _keys(unique_key)
    parts = list(partition_by)
    old_p, new_p = reconcile(existing, new, on_schema_change)
    touched = new_p.select(*parts).distinct()
    cond = None
    for p in parts:
        c = old_p[p].eqNullSafe(touched[p])
        cond = c if cond is None else (cond & c)
    old_in_touched = old_p.join(touched, cond, "left_semi")
    new_keys = new_p.select(*keys).distinct()
    survivors = old_in_touched.join(new_keys, keys, "left_anti")
    return survivors.select(*old_p.columns).unionByName(new_p)


def moved_keys(existing: DataFrame, new: DataFrame, unique_key: str | Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Keys of the new data that the target holds in a partition which the new data does not touch.
    Reads only the key and partition columns of the target."""
    keys, parts = _keys(unique_key), list(partition_by)
    touched = new.select(*parts).distinct()
    old = existing.select(*dict.fromkeys([*keys, *parts]))
    cond = None
    for p in parts:
        c = old[p].eqNullSafe(touched[p])
        cond = c if cond is None else (cond & c)
    return old.join(touched, cond, "left_anti").select(*keys).join(new.select(*keys).distinct(), keys, "left_semi")


def plan_update_column(existing: DataFrame, column: str, value: Column, where: Column | None = None) -> DataFrame:
    """``update dst set column = value [where ...]`` as a projection."""
    new_value = value if where is None else F.when(where, value).otherwise(F.col(column))
    dtype = existing.schema[column].dataType
    return existing.withColumn(column, new_value.cast(dtype))
