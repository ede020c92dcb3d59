"""Clustered layout: files that filters on several columns can skip (A5).

Sorting inside each task's file leaves every file with nearly the whole range of each
column, so the min/max statistics of the files skip nothing. Here rows are dealt to files by
range. One column is dealt by its values. Several columns are dealt by a Z-order code: each
column's value becomes its rank among 1,024 quantiles, and the bits of the ranks are
interleaved, so that a file covers a small box in all columns at once.

Ranks rather than values keep the boxes even where values are uneven. A value that holds a
third of all rows is one rank, hence one code; a hash of the whole row as last range key
splits it over as many files as its size needs. (Rows that are equal in every column can not be
told apart and stay together.) A hash and not a random number, so that a lost task deals its rows again alike.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

#: Ranks are found in two steps of this many: 32 * 32 quantiles.
STEP = 32
RANK_BITS = 10
#: Z-order codes are longs.
MAX_COLUMNS = 63 // RANK_BITS
_PREFIX_BYTES = 6


def _number(name: str, dtype: DataType, skip: int) -> Column:
    """A double that orders as the value does; of text, the six bytes after the first ``skip``."""
    c = F.col(f"`{name}`")
    if isinstance(dtype, (StringType, BinaryType)):
        head = F.hex(F.substring(c.cast("binary"), skip + 1, _PREFIX_BYTES))
        return F.conv(F.rpad(head, 2 * _PREFIX_BYTES, "0"), 16, 10).cast("double")
    if isinstance(dtype, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dtype, (NumericType, BooleanType)):
        return c.cast("double")
    raise ValueError(f"cannot cluster by {name}: {dtype.simpleString()} has no order to rank")


def _ranked(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Each column's rank, 0 to 1,023, as an expression; NULL is rank 0. Two aggregates of one row
    reach the driver: the least and the largest text of text columns, and the quantiles."""
    types = {c: df.schema[c].dataType for c in columns}
    texts = [c for c in columns if isinstance(types[c], (StringType, BinaryType))]
    skip = dict.fromkeys(columns, 0)
    if texts:
        ends = df.agg(*[f(F.col(f"`{c}`").cast("binary")).alias(f"{p}{i}") for i, c in enumerate(texts) for p, f in (("a", F.min), ("z", F.max))]).first()
        for i, c in enumerate(texts):
            if ends[f"a{i}"] is not None:
                skip[c] = len(os.path.commonprefix([bytes(ends[f"a{i}"]), bytes(ends[f"z{i}"])]))
    numbers = {c: _number(c, types[c], skip[c]) for c in columns}
    shares = [i / STEP**2 for i in range(1, STEP**2)]
    quantiles = df.agg(*[F.percentile_approx(numbers[c], shares, 20000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    ranks = []
    for i, c in enumerate(columns):
        bounds = quantiles[f"q{i}"]
        if bounds is None:  # no value at all
            ranks.append(F.lit(0).cast("long"))
            continue
        blocks = [([float("-inf")] + bounds)[b * STEP:(b + 1) * STEP] for b in range(STEP)]

        def below(array: Column, v: Column = numbers[c]) -> Column:
            return F.size(F.filter(array, lambda b: b <= v))

        block = below(F.lit([b[0] for b in blocks[1:]]))
        within = below(F.element_at(F.lit([b[1:] for b in blocks]), block + 1))
        ranks.append(F.coalesce(F.when(numbers[c].isNotNull(), block * STEP + within), F.lit(0)).cast("long"))
    return ranks


def z_order(ranks: Sequence[Column]) -> Column:
    """The bits of the ranks interleaved, the first column's on top."""
    n = len(ranks)
    code = F.lit(0).cast("long")
    for bit in range(RANK_BITS):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            code = code.bitwiseOR(F.shiftleft(one, bit * n + n - 1 - place))
    return code


def cluster(df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = (), order_by: Sequence[str] = ()) -> DataFrame:
    """``df`` dealt to tasks by range of ``columns`` (within ``partition_by``) and sorted in each. No row is added,
    lost or changed. ``df`` is read once more for the range bounds, and for several columns once or twice more
    for the quantiles: stage it where it is dear (:meth:`Publisher.write_version` does)."""
    columns = list(columns)
    if not columns or len(columns) > MAX_COLUMNS:
        raise ValueError(f"cluster by one to {MAX_COLUMNS} columns")
    taken = {c.lower() for c in df.columns}
    code, spread = "_z", "_spread"
    while {code, spread} & taken:
        code, spread = code + "_", spread + "_"
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    keyed = df.withColumn(spread, F.xxhash64(*hashed) if hashed else F.lit(0))
    keys = columns
    if len(columns) > 1:
        keyed, keys = keyed.withColumn(code, z_order(_ranked(df, columns))), [code]

    def cols(names: Sequence[str]) -> list[Column]:
        return [F.col(f"`{n}`") for n in dict.fromkeys(names)]

    dealt = keyed.repartitionByRange(*cols([*partition_by, *keys, spread]))
    return dealt.sortWithinPartitions(*cols([*partition_by, *keys, *columns, *order_by])).drop(code, spread)
