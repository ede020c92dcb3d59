"""Snapshots of change feeds (B13-B16 for sources that send changes instead of states).

A feed holds any number of changes of a key, each with the instant it happened at, in any order
and as late as it likes; a change may say that the key was deleted. The snapshot keeps one version for each
key and instant: the source's columns, ``scd_id``, ``scd_updated_at``, ``valid_from``,
``valid_to`` (the key's next instant, NULL for the last) and ``is_deleted``. A deletion is
a version too, so that all that is known of a key stays known: a late change splits the
version in whose time it falls, closed ones and deletions included, and **the snapshot
does not depend on how the changes were dealt to runs, nor on the order of the runs**.
:func:`alive` leaves the versions that a snapshot of states has.

Of several changes of a key at one instant the greatest by ``order_by`` counts (columns of the source,
such as a log position); of those that tie, one of a later run, and of these a deletion before a value,
then the greatest row. So results are free of run order where ``order_by`` tells changes apart.

A run reads the target once and rebuilds the chains of all keys; those that the feed doesn't name come out as they were.
Repeated changes of an instant fall together map-side. Then versions and changes are dealt once by key and calendar
unit ``unit``: the next instant is found within the unit first, then from the next unit's first instant,
so that no task holds more of one key than its instants of one unit and one row a unit, also where a key
holds a third of the feed. All steps read that one exchange, so that a chain of runs
that are not stored between does not compute the runs before again and again.

NULL keys are a key like any other. An instant that is NULL fails the run, as it has no place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from modelsmith.functions.hashing import scd_id as _scd_hash
from modelsmith.operators.schema_change import project_to
from modelsmith.operators.snapshot import SCD_COLUMNS, _keys

DELETED = "is_deleted"
FEED_COLUMNS = (*SCD_COLUMNS, DELETED)
UNITS = ("year", "month", "day", "hour", "minute")


def _unit(t: Column, unit: str) -> Column:
    """The number of the calendar unit of ``t``, whatever the session's zone."""
    day = F.unix_date(t.cast("date")).cast("bigint")
    if unit == "day":
        return day
    if unit in ("hour", "minute"):
        hour = day * 24 + F.hour(t)
        return hour if unit == "hour" else hour * 60 + F.minute(t)
    year = F.year(t).cast("bigint")
    return year if unit == "year" else year * 12 + F.month(t)


def _chained(events: DataFrame, keys: Sequence[str], unit: str) -> DataFrame:
    """``events`` (k0.., t, e), the greatest e of each key and t, with ``until``: the key's next t."""
    # A struct is equal to another where its NULLs are too, so that a plain join keeps the exchange.
    key = F.struct(*keys, _unit(F.col("t"), unit).alias("u")).alias("ku")
    dealt = events.select(key, "t", "e").repartition("ku")
    # e is never NULL; counted, it is a column that both readers of the exchange need, so that Spark makes it once.
    firsts = dealt.groupBy("ku").agg(F.when(F.count("e") > 0, F.min("t")).alias("first"))
    onward = F.lead("first").over(Window.partitionBy(*keys).orderBy("u")).alias("onward")
    nexts = firsts.select("ku", "ku.*", "first").select("ku", onward)
    inner = Window.partitionBy("ku").orderBy("t")
    within = dealt.groupBy("ku", "t").agg(F.max("e").alias("e")).select("*", F.lead("t").over(inner).alias("then"))
    return within.join(nexts, "ku", "left").select("ku.*", "t", "e", F.coalesce("then", "onward").alias("until"))


def plan_feed(
    target: DataFrame | None,
    changes: DataFrame,
    unique_key: str | Sequence[str],
    changed_at: str,
    deleted: str | None = None,
    order_by: Sequence[str] = (),
    unit: str = "day",
) -> DataFrame:
    """The next version of the snapshot. ``changes`` holds the source's columns and, where ``deleted`` names it, a
    boolean column that is true of deletions (NULL: no deletion). Target and changes are read once."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    keys = _keys(unique_key)
    source = [f for f in changes.schema.fields if f.name != deleted]
    clash = {f.name.lower() for f in source} & set(FEED_COLUMNS)
    if clash:
        raise ValueError(f"the feed has columns of the snapshot: {sorted(clash)}")
    if target is None:
        cols = [(f.name, f.dataType) for f in source]
    else:
        cols = [(f.name, f.dataType) for f in target.schema.fields if f.name not in FEED_COLUMNS]
        known = {n.lower() for n, _ in cols}
        # Columns new in the feed join the snapshot; versions so far hold NULL.
        cols += [(f.name, f.dataType) for f in source if f.name.lower() not in known]
        target = target.select(*[F.col(f"`{n}`") if n in target.columns else F.lit(None).cast(t).alias(n) for n, t in cols],
                               *FEED_COLUMNS)
    data = [n for n, _ in cols]
    names = [f"k{i}" for i in range(len(keys))]
    flag = F.coalesce(F.col(f"`{deleted}`"), F.lit(False)) if deleted else F.lit(False)
    fresh = project_to(changes.withColumn(DELETED, flag), [*cols, (DELETED, BooleanType())])

    def events(df: DataFrame, run: int, at: Column) -> DataFrame:
        row = F.struct(*[F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order_by)], F.lit(run).alias("run"), F.col(DELETED).alias("gone"),
                       F.struct(*[F.col(f"`{c}`") for c in data]).alias("row"))
        return df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], at.alias("t"), row.alias("e"))

    instant = F.col(f"`{changed_at}`").cast("timestamp_ntz")
    instant = F.when(instant.isNull(), F.raise_error(F.lit(f"a change has no {changed_at}"))).otherwise(instant)
    all_events = events(fresh, 1, instant).groupBy(*names, "t").agg(F.max("e").alias("e"))
    if target is not None:
        all_events = all_events.unionByName(events(target, 0, F.col("valid_from")))
    chain = _chained(all_events, names, unit)
    return chain.select(
        *[F.col("e.row")[c].alias(c) for c in data],
        _scd_hash(*[F.col(n) for n in names], F.col("t")).alias("scd_id"),
        F.col("t").alias("scd_updated_at"), F.col("t").alias("valid_from"), F.col("until").alias("valid_to"),
        F.col("e.gone").alias(DELETED),
    )


def alive(snapshot: DataFrame) -> DataFrame:
    """The versions that are no deletions, with the columns of a snapshot of states."""
    return snapshot.where(~F.col(DELETED)).drop(DELETED)
