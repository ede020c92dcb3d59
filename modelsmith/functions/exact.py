"""Exact sums and averages of doubles.

A sum of doubles depends on the order in which a distributed aggregation meets the
rows. Here every value is taken apart into integers on a fixed grid of powers of
2^26; the integers are summed as longs by (group, grid place), with map-side partial
sums; the places of a group are then carried into each other, and the total, which is
the exact rational sum, is rounded once to the nearest double (ties to even). The
average divides that exact total by the count before it is rounded. No scale is
declared and nothing is rounded on the way, so any order gives the same bits.

All is SQL expressions: two aggregations, of which the second meets one row for each
place that occurs in a group (two or three in most data, 81 at most).

NULLs are skipped, a group without values has NULL. NaN, or infinities of both signs,
give NaN; infinities of one sign give that. A zero total is 0.0. A total beyond the
largest double is infinite, as the rounding of IEEE 754 has it.

A group may hold 2^34 values a place; beyond that the long sum overflows, which fails
under ANSI mode. An average below 2^-1022 may be one unit in the last place off, as it
is rounded twice there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26
_BASE = 1 << BITS
#: The grid's place 0 has the weight 2^LOWEST, below the smallest double.
LOWEST = -1092
_PARTS = 3


def _pow2(e: Column) -> Column:
    return F.pow(F.lit(2.0), e)


def _left(x: Column, n: Column) -> Column:
    return F.call_function("shiftleft", x, n.cast("int"))


def _right(x: Column, n: Column) -> Column:
    return F.call_function("shiftright", x, n.cast("int"))


def _scaled(x: Column, e: Column) -> Column:
    """x * 2^e in two steps, as 2^e alone may be no double."""
    half = F.floor(e / 2)
    return x * _pow2(half) * _pow2(e - half)


def _place_and_parts(x: Column) -> tuple[Column, Column]:
    """The grid place of a finite value other than zero, and its size in units of that place (a whole number below 2^80)."""
    # The logarithm may be one off near a power of two; one more unit below costs nothing.
    exponent = F.floor(F.log2(F.abs(x))) - 1
    lowest = F.when(exponent.isNotNull(), F.greatest(exponent - 52, F.lit(-1074).cast("long")))  # no bit of x is below this
    place = F.floor((lowest - LOWEST) / BITS)
    return place, _scaled(x, -(place * BITS + LOWEST))


def exact_double_totals(df: DataFrame, group_by: Sequence[str], values: Mapping[str, str | Column]) -> DataFrame:
    """``group_by`` columns, and for each name of ``values`` the columns ``<name>_sum``, ``<name>_avg`` and ``<name>_count``."""
    group = list(group_by)
    out = None
    for name, value in values.items():
        x = (F.col(value) if isinstance(value, str) else value).cast("double")
        one = _totals(df.select(*group, x.alias("__x")), group, name)
        if out is None:
            out = one
        elif group:
            same = None
            right = one.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(group)], *[c for c in one.columns if c not in group])
            for i, c in enumerate(group):
                cond = F.col(c).eqNullSafe(F.col(f"__{i}"))
                same = cond if same is None else same & cond
            out = out.join(right, same).drop(*[f"__{i}" for i in range(len(group))])
        else:
            out = out.crossJoin(one)  # one row each
    return out


def _totals(rows: DataFrame, group: list[str], name: str) -> DataFrame:
    x = F.col("__x")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kind = F.when(x.isNull(), 0).when(F.isnan(x), 1).when(x == float("inf"), 2).when(x == float("-inf"), 3).otherwise(4)
    place, units = _place_and_parts(F.when(finite & (x != 0), x))
    split = rows.select(*group, kind.alias("__kind"), place.cast("int").alias("__place"), units.alias("__u"))
    parts, rest = [], F.abs(F.col("__u"))
    for i in reversed(range(_PARTS)):
        high = F.floor(rest / float(_BASE**i)).cast("double") if i else rest
        parts.append((F.signum("__u") * high).cast("long"))
        rest = rest - high * float(_BASE**i)
    sums = split.groupBy(*group, "__kind", "__place").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(p).alias(f"__p{i}") for i, p in zip(reversed(range(_PARTS)), parts, strict=True)])
    counted = F.coalesce(F.sum(F.when(F.col("__kind") > 0, F.col("__n")).otherwise(0)), F.lit(0).cast("long"))
    seen = F.bit_or(_left(F.lit(1), F.col("__kind")))
    digits = F.collect_list(F.when(F.col("__place").isNotNull(), F.struct(F.col("__place").alias("place"), *[F.col(f"__p{i}").alias(f"p{i}") for i in range(_PARTS)])))
    total = sums.groupBy(*group).agg(counted.alias("__n"), seen.alias("__seen"), digits.alias("__digits"))
    has = lambda bit: F.col("__seen").bitwiseAND(F.lit(1 << bit)) > 0
    special = F.when(has(1) | (has(2) & has(3)), float("nan")).when(has(2), float("inf")).when(has(3), float("-inf"))
    none = F.size("__digits") == 0
    low = F.array_min(F.transform("__digits", lambda d: d["place"]))
    high = F.array_max(F.transform("__digits", lambda d: d["place"]))
    # One whole number for each place from the lowest on; six more hold what is carried beyond the highest.
    laid = total.select(*group, "__n", special.alias("__special"), F.when(none, 0).otherwise(low).alias("__low"), "__digits", F.when(none, 0).otherwise(high).alias("__high")).select(
        *group, "__n", "__special", "__low", F.transform(F.sequence("__low", F.col("__high") + 6), lambda k: F.aggregate(
            "__digits", F.lit(0).cast("long"), lambda s, d: s + F.when(d["place"] == k, d["p0"]).when(d["place"] == k - 1, d["p1"]).when(d["place"] == k - 2, d["p2"]).otherwise(F.lit(0).cast("long")))).alias("__d"))
    # The sign of the total is that of its last carry; then the digits of its size.
    signed = laid.select("*", F.when(_carried(F.col("__d"))["carry"] < 0, -1).otherwise(1).alias("__sign"))
    sized = signed.select("*", _carried(F.transform("__d", lambda d: d * F.col("__sign")))["digits"].alias("__size"))
    # The average's digits: long division, down to six more places below.
    divided = F.aggregate(
        F.concat(F.reverse("__size"), F.array_repeat(F.lit(0).cast("long"), 6)),
        F.struct(F.lit(0).cast("long").alias("rest"), F.array().cast("array<bigint>").alias("digits")),
        lambda s, d: F.struct(((s["rest"] * _BASE + d) % F.col("__n")).alias("rest"), F.array_append(s["digits"], F.call_function("div", s["rest"] * _BASE + d, F.col("__n"))).alias("digits")))
    done = sized.withColumn("__q", F.when(F.col("__n") > 0, divided))

    def shown(digits: Column, low: Column, below: Column) -> Column:
        size = _rounded(digits, low, below)
        return F.when(F.col("__n") > 0, F.coalesce("__special", F.when(size == 0, size).otherwise(F.col("__sign") * size)))

    return done.select(
        *group, shown(F.col("__size"), F.col("__low"), F.lit(False)).alias(f"{name}_sum"),
        shown(F.reverse(F.col("__q.digits")), F.col("__low") - 6, F.col("__q.rest") > 0).alias(f"{name}_avg"), F.col("__n").alias(f"{name}_count"))


def _carried(digits: Column) -> Column:
    """digits (0 to 2^26 - 1 each) and carry (what is left beyond the last place) of whole numbers by place."""
    def step(s: Column, d: Column) -> Column:
        total = s["carry"] + d
        digit = F.pmod(total, F.lit(_BASE).cast("long"))
        return F.struct(_right(total, F.lit(BITS)).alias("carry"), F.array_append(s["digits"], digit).alias("digits"))

    return F.aggregate(digits, F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("digits")), step)


def _rounded(digits: Column, low: Column, below: Column) -> Column:
    """The double nearest to the digits (by place from ``low`` on); ``below``: whether anything follows below them."""
    # The last place that is not zero, as an index from 1.
    top = F.aggregate(F.sequence(F.lit(1), F.size(digits)), F.lit(0), lambda s, i: F.when(F.element_at(digits, i) != 0, i).otherwise(s))

    def finish(h: Column) -> Column:
        at = lambda k: F.when(h - k >= 1, F.try_element_at(digits, F.greatest(h - k, F.lit(1)))).otherwise(F.lit(0).cast("long"))
        lead = F.length(F.bin(at(0)))
        # The first 61 bits, of which the last also says whether anything follows.
        keep = F.lit(61) - lead
        first = _left(at(0), keep)
        second = _left(at(1), keep - BITS)  # keep is 35 to 60
        third = F.when(keep >= 2 * BITS, _left(at(2), keep - 2 * BITS)).otherwise(_right(at(2), F.lit(2 * BITS) - keep))
        fourth = F.when(keep > 2 * BITS, _right(at(3), F.lit(3 * BITS) - keep)).otherwise(F.lit(0).cast("long"))
        lost = F.when(keep >= 2 * BITS, F.pmod(at(3), _left(F.lit(1).cast("long"), F.lit(3 * BITS) - keep)) != 0).otherwise(
            (F.pmod(at(2), _left(F.lit(1).cast("long"), F.greatest(F.lit(2 * BITS) - keep, F.lit(0)))) != 0) | (at(3) != 0))
        rest = F.exists(F.slice(digits, F.lit(1), F.greatest(h - 4, F.lit(0))), lambda d: d != 0)
        bits = first + second + third + fourth
        sticky = F.when(lost | rest | below, 1).otherwise(0).cast("long")
        exponent = (low + h - 1).cast("long") * BITS + LOWEST - keep.cast("long")
        return F.when(h == 0, F.lit(0.0)).otherwise(_scaled(bits.bitwiseOR(sticky).cast("double"), exponent))

    return F.element_at(F.transform(F.array(top), finish), 1)
