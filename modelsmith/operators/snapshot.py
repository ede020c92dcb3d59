"""Slowly-changing snapshots.

A snapshot keeps every version of each source row. Target columns are the
source columns plus ``scd_id`` (version id), ``scd_updated_at``, ``valid_from``
and ``valid_to`` (NULL while the version is live).

Strategies:

* ``timestamp`` — a key changed when the source ``updated_at`` is later than
  the live version's ``valid_from``; the new version starts at ``updated_at``.
* ``check`` — a key changed when any ``check_cols`` value differs NULL-safely
  (NULL against a value is a change); the new version starts at ``as_of``.

Hard deletes (opt-in): a live key missing from the source is closed at
``as_of``.

The merge is one pass instead of staging plus four statements: the live rows
(``valid_to IS NULL``) are full-outer-joined with the source on the key, and
each joined row emits up to two rows — the live version (kept or closed) and a
new version — by exploding a two-element literal and picking each column per
side. Closed history is
carried over untouched and is not shuffled. The live rows and the source are read
once; of closed history the keys and close times are read besides, for returning keys.

When hard deletes are on, a key without a live row may have closed history
(it was deleted and came back). Its new version starts no earlier than its
last ``valid_to`` and the version id hashes that start, so the returning
version never collides with the closed one and the closed one is kept. Only
this opt-in path reads closed history: its ``(key, valid_to)`` columns are
semi-joined to the keys that have no live row (usually a small set, which
Spark's runtime Bloom filter or AQE's broadcast conversion can exploit) and
reduced to one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelsmith.functions.hashing import scd_id as _scd_hash
from modelsmith.operators.schema_change import project_to

SCD_COLUMNS = ("scd_id", "scd_updated_at", "valid_from", "valid_to")
STRATEGIES = ("timestamp", "check")


def _keys(unique_key) -> list[str]:
    return [unique_key] if isinstance(unique_key, str) else list(unique_key)


def _as_of(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _validate_args(strategy, updated_at, check_cols):
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy == "timestamp" and not updated_at:
        raise ValueError("the timestamp strategy needs updated_at")
    if strategy == "check" and not check_cols:
        raise ValueError("the check strategy needs check_cols")


def first_snapshot(
    source: DataFrame,
    unique_key,
    strategy: str = "timestamp",
    updated_at: str | None = None,
    check_cols: Sequence[str] | None = None,
    as_of=None,
) -> DataFrame:
    """The first build: every source row becomes a live version."""
    _validate_args(strategy, updated_at, check_cols)
    keys = _keys(unique_key)
    start = F.col(updated_at).cast("timestamp_ntz") if strategy == "timestamp" else _as_of(as_of)
    return source.select(
        *[F.col(f"`{c}`") for c in source.columns],
        _scd_hash(*[F.col(k) for k in keys], start).alias("scd_id"),
        start.alias("scd_updated_at"),
        start.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def _classified(target, source, keys, strategy, updated_at, check_cols, as_of, invalidate_hard_deletes):
    known = {c.lower() for c in target.columns}
    added = [f for f in source.schema.fields if f.name.lower() not in known]
    if added:
        # Columns new in the source join the snapshot; existing versions hold NULL.
        data = [F.col(f"`{c}`") for c in target.columns if c not in SCD_COLUMNS]
        target = target.select(*data, *[F.lit(None).cast(f.dataType).alias(f.name) for f in added],
                               *SCD_COLUMNS)
    data_cols = [c for c in target.columns if c not in SCD_COLUMNS]
    if check_cols == "all":
        check_cols = [c for c in data_cols if c not in keys]
    target_types = [(f.name, f.dataType) for f in target.schema.fields if f.name in data_cols]
    src = project_to(source, target_types)
    live = target.filter(F.col("valid_to").isNull())
    closed = target.filter(F.col("valid_to").isNotNull())

    key_alias = [f"_k{i}" for i in range(len(keys))]
    lv = live.select(*[F.col(k).alias(a) for k, a in zip(keys, key_alias)],
                     F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("l"))
    sv = src.select(*[F.col(k).alias(a) for k, a in zip(keys, key_alias)],
                    F.struct(*[F.col(f"`{c}`") for c in data_cols]).alias("s"))
    # The last close of each key, so that a returning key starts after it and no two
    # versions share an id. It joins on the shuffle that the full join needs anyway.
    last_closed = closed.groupBy(*[F.col(k).alias(a) for k, a in zip(keys, key_alias)]).agg(
        F.max("valid_to").alias("_last_closed"))
    j = lv.join(sv.join(last_closed, key_alias, "left"), key_alias, "full_outer")

    in_live, in_src = F.col("l").isNotNull(), F.col("s").isNotNull()
    when_ts = _as_of(as_of)
    if strategy == "timestamp":
        start = F.col("s")[updated_at].cast("timestamp_ntz")
        changed = in_live & in_src & (F.col("l")["valid_from"] < start)
    else:
        start = when_ts
        diff = None
        for c in check_cols:
            d = ~F.col("l")[c].eqNullSafe(F.col("s")[c])
            diff = d if diff is None else (diff | d)
        changed = in_live & in_src & diff

    start = F.when(~in_live & F.col("_last_closed").isNotNull(), F.greatest(start, F.col("_last_closed"))).otherwise(start)
    deleted = in_live & ~in_src if invalidate_hard_deletes else F.lit(False)

    j = j.select(
        *key_alias, "l", "s",
        in_live.alias("_in_live"), in_src.alias("_in_src"),
        F.coalesce(changed, F.lit(False)).alias("_changed"),
        F.coalesce(deleted, F.lit(False)).alias("_deleted"),
        start.alias("_start"),
    )
    return j, closed, data_cols, key_alias, when_ts


def _emitted(j: DataFrame, data_cols, keys, when_ts) -> DataFrame:
    """The rows the merge produces from the joined live/source rows: for each
    key the live version (kept, or closed) and, when it changed or is new, the
    new version. Side 0 is the live version, side 1 the new one; exploding a
    two-element literal and choosing each column per side keeps the generated
    code to one small CASE per column."""
    l, s = F.col("l"), F.col("s")
    new_to = (
        F.when(F.col("_changed"), F.col("_start"))
        .when(F.col("_deleted"), when_ts)
        .otherwise(l["valid_to"])
    )
    emit_new = F.col("_in_src") & (~F.col("_in_live") | F.col("_changed"))
    pairs = j.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_side")).filter(
        ((F.col("_side") == 0) & F.col("_in_live")) | ((F.col("_side") == 1) & emit_new)
    )
    live_side = F.col("_side") == 0
    key_vals = [s[k] for k in keys]
    return pairs.select(
        *[F.when(live_side, l[c]).otherwise(s[c]).alias(c) for c in data_cols],
        F.when(live_side, l["scd_id"]).otherwise(_scd_hash(*key_vals, F.col("_start"))).alias("scd_id"),
        F.when(live_side, l["scd_updated_at"]).otherwise(F.col("_start")).alias("scd_updated_at"),
        F.when(live_side, l["valid_from"]).otherwise(F.col("_start")).alias("valid_from"),
        F.when(live_side, new_to).cast("timestamp_ntz").alias("valid_to"),
    )


def plan_snapshot(
    target: DataFrame | None,
    source: DataFrame,
    unique_key,
    strategy: str = "timestamp",
    updated_at: str | None = None,
    check_cols: Sequence[str] | None = None,
    as_of=None,
    invalidate_hard_deletes: bool = False,
) -> DataFrame:
    """The next version of the snapshot table."""
    _validate_args(strategy, updated_at, check_cols)
    if target is None:
        return first_snapshot(source, unique_key, strategy, updated_at, check_cols, as_of)
    keys = _keys(unique_key)
    j, closed, data_cols, _, when_ts = _classified(
        target, source, keys, strategy, updated_at, check_cols, as_of, invalidate_hard_deletes
    )
    emitted = _emitted(j, data_cols, keys, when_ts)
    return closed.select(*emitted.columns).unionByName(emitted)


def plan_snapshot_increment(
    live: DataFrame,
    history: DataFrame | None,
    source: DataFrame,
    unique_key,
    strategy: str = "timestamp",
    updated_at: str | None = None,
    check_cols: Sequence[str] | None = None,
    as_of=None,
    invalidate_hard_deletes: bool = False,
) -> DataFrame:
    """Only what a run changes, for snapshots stored as history segments:
    the next live set (``valid_to`` NULL) plus the versions this run closes.
    Of closed ``history`` only the keys and ``valid_to`` are read, for the
    start of keys that come back after a hard delete."""
    _validate_args(strategy, updated_at, check_cols)
    keys = _keys(unique_key)
    target = live if history is None else live.unionByName(history, allowMissingColumns=True)
    j, _, data_cols, _, when_ts = _classified(
        target, source, keys, strategy, updated_at, check_cols, as_of, invalidate_hard_deletes
    )
    return _emitted(j, data_cols, keys, when_ts)


def snapshot_changes(
    target: DataFrame,
    source: DataFrame,
    unique_key,
    strategy: str = "timestamp",
    updated_at: str | None = None,
    check_cols: Sequence[str] | None = None,
    as_of=None,
    invalidate_hard_deletes: bool = False,
) -> DataFrame:
    """Staged changes (B13, B14): one row per insert, update or delete with
    the version id it affects and the validity bounds it sets."""
    _validate_args(strategy, updated_at, check_cols)
    keys = _keys(unique_key)
    j, _, _, key_alias, when_ts = _classified(
        target, source, keys, strategy, updated_at, check_cols, as_of, invalidate_hard_deletes
    )
    l, s = F.col("l"), F.col("s")
    key_vals = [s[k] for k in keys]
    insert = F.when(
        F.col("_in_src") & (~F.col("_in_live") | F.col("_changed")),
        F.struct(F.lit("insert").alias("change_type"),
                 _scd_hash(*key_vals, F.col("_start")).alias("scd_id"),
                 F.col("_start").alias("valid_from"),
                 F.lit(None).cast("timestamp_ntz").alias("valid_to")),
    )
    update = F.when(
        F.col("_changed"),
        F.struct(F.lit("update").alias("change_type"), l["scd_id"].alias("scd_id"),
                 l["valid_from"].alias("valid_from"), F.col("_start").alias("valid_to")),
    )
    delete = F.when(
        F.col("_deleted"),
        F.struct(F.lit("delete").alias("change_type"), l["scd_id"].alias("scd_id"),
                 l["valid_from"].alias("valid_from"), when_ts.alias("valid_to")),
    )
    out = j.select(
        *[F.col(a).alias(k) for a, k in zip(key_alias, keys)],
        F.inline(F.filter(F.array(insert, update, delete), lambda r: r.isNotNull())),
    )
    return out
