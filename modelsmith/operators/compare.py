"""Relation diff (C5): how two relations differ, in one distributed pass.

Result (one row): ``row_count_difference`` = rows(a) - rows(b), and
``num_mismatched`` = rows of a with no equal row in b plus rows of b with no
equal row in a (multiplicity kept, as with an anti join each way). Equality is
NULL-safe: two rows holding NULL in the same column are equal.

Instead of two outer/anti joins over all columns (four full shuffles), both
relations are tagged, unioned and grouped by every compared column, counting
rows per side. Grouping is NULL-safe by nature, partial aggregation collapses
repeated rows before the shuffle, and the counts for both results come out of
the same aggregate.

Relations that are nearly equal need not be shuffled whole
(:func:`rows_different_by_buckets`): rows are dealt to buckets by a hash, each bucket's
rows are summed up to an order-free fingerprint of 128 bits a row, and only rows of
buckets whose fingerprints differ are compared exactly, as above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelsmith.operators.runs import _free

#: Most buckets of a comparison: the numbers of those that differ are broadcast.
MAX_BUCKETS = 1 << 20


def rows_different(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None,
                   null_safe: bool = True) -> DataFrame:
    """``row_count_difference`` and ``num_mismatched`` of ``a`` against ``b``.

    ``null_safe=False`` reproduces plain ``=`` matching, under which a row
    holding a NULL in any compared column matches nothing and always counts
    as mismatched.
    """
    cols = _compared(a, b, columns)
    return _differences(_tagged(a, b, cols), cols, null_safe)


def rows_different_by_buckets(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None,
                              null_safe: bool = True, key: Sequence[str] | None = None,
                              buckets: int = 4096) -> DataFrame:
    """The same result where few rows are expected to differ.

    Each side is read twice and shuffled not at all, but for one row of sums a bucket and map task, and
    for the rows of the buckets that differ. A row goes to a bucket by the hash of ``key`` (all compared
    columns where none is given): with a key, both forms of a changed row lie in one bucket; without,
    the rows of a key that holds much of the relation spread over all buckets. ``d`` differing
    rows leave at most ``d / buckets`` of the relation to compare, or twice that without a key, so ``buckets``
    should be some ten times the changes expected. More cost only the rest of the gain.

    Two unequal buckets pass as equal only if six sums of two 64-bit hashes of their rows agree, which
    for data not made to collide has a chance of about 2^-128. Both inputs are read twice, so they have to be
    deterministic; a bucket may hold up to 2^41 rows.
    """
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    cols = _compared(a, b, columns)
    tagged = _tagged(a, b, cols)
    name = _free("_bucket", cols)
    dealt = F.pmod(F.xxhash64(*_hashable(tagged, list(key) if key is not None else cols)), F.lit(buckets)).cast("int")
    tagged = tagged.withColumn(name, dealt)
    parts = [F.sum((F.col("_in_a") - F.col("_in_b")) * p) for p in _pieces(_hashable(tagged, cols))]
    parts.append(F.sum(F.col("_in_a") - F.col("_in_b")))
    if not null_safe:  # a row with a NULL counts wherever it is
        parts.append(F.max(F.greatest(F.lit(0), *[F.col(f"`{c}`").isNull().cast("int") for c in cols])))
    sums = tagged.groupBy(name).agg(*[p.cast("bigint").alias(f"p{i}") for i, p in enumerate(parts)])
    differing = sums.where(" OR ".join(f"p{i} != 0" for i in range(len(parts)))).select(name)
    # At most MAX_BUCKETS integers, so the broadcast is bounded.
    left = tagged.join(F.broadcast(differing), name, "left_semi")
    return _differences(left, cols, null_safe)


def _hashable(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Columns whose hash tells all values of ``cols`` apart: Spark's hashes skip NULLs, so each value goes
    with a flag, and nested values, whose inner NULLs are skipped too, go as text."""
    exact = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
             "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    out = []
    for c in cols:
        value = F.col(f"`{c}`")
        if isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType)):
            value = F.to_json(F.struct(value), exact)
        out += [F.col(f"`{c}`").isNull(), value]
    return out


def _pieces(values: Sequence[Column]) -> list[Column]:
    """Two hashes of a row in pieces of at most 22 bits, whose sums stay within a long for 2^41 rows."""
    low = F.lit((1 << 22) - 1).cast("bigint")
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *values)
        out += [F.shiftrightunsigned(h, 44), F.shiftrightunsigned(h, 22).bitwiseAND(low), h.bitwiseAND(low)]
    return out


def _compared(a: DataFrame, b: DataFrame, columns: Sequence[str] | None) -> list[str]:
    cols = sorted(columns) if columns is not None else sorted(a.columns)
    missing = [c for c in cols if c not in b.columns]
    if missing:
        raise ValueError(f"columns missing from the second relation: {missing}")
    return cols


def _tagged(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    return a.select(*cols, F.lit(1).alias("_in_a"), F.lit(0).alias("_in_b")).unionByName(
        b.select(*cols, F.lit(0).alias("_in_a"), F.lit(1).alias("_in_b"))
    )


def _differences(tagged: DataFrame, cols: Sequence[str], null_safe: bool) -> DataFrame:
    per_row = tagged.groupBy(*cols).agg(
        F.sum("_in_a").cast("bigint").alias("n_a"), F.sum("_in_b").cast("bigint").alias("n_b")
    )
    only = F.when(F.col("n_b") == 0, F.col("n_a")).when(F.col("n_a") == 0, F.col("n_b")).otherwise(0)
    if not null_safe:
        has_null = None
        for c in cols:
            cond = F.col(f"`{c}`").isNull()
            has_null = cond if has_null is None else (has_null | cond)
        only = F.when(has_null, F.col("n_a") + F.col("n_b")).otherwise(only)
    return per_row.agg(
        F.coalesce(F.sum(F.col("n_a") - F.col("n_b")), F.lit(0)).cast("bigint").alias("row_count_difference"),
        F.coalesce(F.sum(only), F.lit(0)).cast("bigint").alias("num_mismatched"),
    )


def rows_different_by_join(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None,
                           null_safe: bool = True) -> DataFrame:
    """The same result written as anti joins each way; kept as the
    plain-SQL-shaped definition for tests."""
    cols = sorted(columns) if columns is not None else sorted(a.columns)
    a2, b2 = a.select(*cols), b.select(*cols)

    def cond(x: str, y: str):
        c = None
        for name in cols:
            left, right = F.col(f"{x}.{name}"), F.col(f"{y}.{name}")
            e = left.eqNullSafe(right) if null_safe else (left == right)
            c = e if c is None else (c & e)
        return c

    a_only = a2.alias("x").join(b2.alias("y"), cond("x", "y"), "left_anti")
    b_only = b2.alias("y").join(a2.alias("x"), cond("y", "x"), "left_anti")
    diff = a2.agg(F.count(F.lit(1)).alias("na")).crossJoin(b2.agg(F.count(F.lit(1)).alias("nb")))
    missing = a_only.unionByName(b_only).agg(F.count(F.lit(1)).alias("num_mismatched"))
    return diff.crossJoin(missing).select(
        (F.col("na") - F.col("nb")).alias("row_count_difference"), "num_mismatched"
    )
