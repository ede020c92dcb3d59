"""Keyed upserts stored as runs (B6 without a rewrite of the target).

A run is one batch, written as it came; runs are ordered. A row counts unless a
newer run has its key: what :func:`modelsmith.operators.incremental.plan_upsert` gives
when the batches are applied one after another, rows that repeat a key within a batch
and rows with a NULL key included (a NULL matches nothing, so they all stay).

Reading is a left anti join of the older rows against the newest run of each key of
the runs above the oldest. Spark pushes it below the union, to one join a run over the same
reduced keys. Only keys are read of those runs, and they are far fewer than the
rows of the oldest run, so AQE broadcasts them where it measures them small.

Runs are merged as in a binary counter (:func:`merge_from`): a run is merged with those
after it once they together have as many rows. So N rows lie in at most
``log2(N / smallest batch) + 2`` runs, and a row is rewritten that often at most
in its life, rather than once a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _free(stem: str, columns: Sequence[str]) -> str:
    """A column name that no column has."""
    taken = {c.lower() for c in columns}
    while stem in taken:
        stem += "_"
    return stem


def resolve_runs(runs: Sequence[DataFrame], unique_key: str | Sequence[str]) -> DataFrame:
    """The rows that count of runs with equal columns, oldest first."""
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    *older, newest = runs
    if not older:
        return newest
    cols = newest.columns
    seq, last = _free("_seq", cols), _free("_last", cols)

    def numbered(frames: Sequence[DataFrame], names: Sequence[str], start: int) -> DataFrame:
        parts = [f.select(*names, F.lit(i).alias(seq)) for i, f in enumerate(frames, start)]
        together = parts[0]
        for p in parts[1:]:
            together = together.unionByName(p)
        return together

    above = numbered(runs[1:], keys, 1).groupBy(*keys).agg(F.max(seq).alias(last)).alias("n")
    cond = F.col(f"n.{last}") > F.col(f"o.{seq}")
    for k in keys:
        cond = cond & (F.col(f"n.`{k}`") == F.col(f"o.`{k}`"))
    kept = numbered(older, cols, 0).alias("o").join(above, cond, "left_anti")
    return kept.select(*cols).unionByName(newest)


def resolve_sql(tables: Sequence[str], columns: Sequence[str], unique_key: Sequence[str]) -> str:
    """:func:`resolve_runs` over run tables (quoted names), as the text of a view."""
    from modelsmith.operators.publish import quote_ident

    cols = ", ".join(map(quote_ident, columns))
    keys = ", ".join(map(quote_ident, unique_key))
    *older, newest = tables
    body = f"SELECT {cols} FROM {newest}"
    if not older:
        return body
    seq, last = _free("_seq", columns), _free("_last", columns)
    old = " UNION ALL ".join(f"SELECT {cols}, {i} AS {seq} FROM {t}" for i, t in enumerate(older))
    above = " UNION ALL ".join(f"SELECT {keys}, {i} AS {seq} FROM {t}" for i, t in enumerate(tables) if i)
    same = " AND ".join(f"n.{quote_ident(k)} = o.{quote_ident(k)}" for k in unique_key)
    return (f"SELECT {cols} FROM ({old}) AS o LEFT ANTI JOIN "
            f"(SELECT {keys}, max({seq}) AS {last} FROM ({above}) GROUP BY {keys}) AS n "
            f"ON {same} AND n.{last} > o.{seq} UNION ALL {body}")


def merge_from(rows: Sequence[int]) -> int:
    """From which place on to merge, given the runs' row counts, oldest first: as far back as a run has no more
    rows than all after it together. ``len(rows) - 1`` means that nothing is merged."""
    start = len(rows) - 1
    total = rows[start] if rows else 0
    while start > 0 and rows[start - 1] <= total:
        start -= 1
        total += rows[start]
    return max(start, 0)
