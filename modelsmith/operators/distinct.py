"""Exact distinct counts that are kept current batch by batch.

``count(DISTINCT x)`` expands all rows on every run. Here the distinct values of a
group are kept as a side table of *words*: row ``(group, word, bits)`` says which of
the 64 consecutive integers that begin at ``64 * word`` the group has. Integers, dates
and booleans are packed so; a value of any other type that can be grouped is its own
word, with one bit. A group whose values are all NULL has one row with a NULL word and
no bits, so that it is counted as 0 and not lost.

Words are merged with ``bit_or``: the result does not depend on the order, the number
or the repetition of the merges. It is a declarative aggregate on a long, so it is
combined map-side within generated code, and a group that holds a third of all rows is
spread over its words. Spark's own ``bitmap_construct_agg`` takes 4 KB for each
occupied range of 32,768 values, which sparse identifiers fill with zeros.

:func:`unseen_words` cuts a batch to the bits that the side table lacks. Appended,
they stay disjoint, so the counts of batches add up (:func:`count_words`) and a batch
neither reads old rows again nor rewrites the side table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, IntegralType

WORD, BITS = "word", "bits"


def _groups(df: DataFrame, group_by: str | Sequence[str]) -> list[str]:
    groups = [group_by] if isinstance(group_by, str) else list(group_by)
    clash = {c.lower() for c in groups} & {WORD, BITS}
    if clash:
        raise ValueError(f"rename the group column {sorted(clash)}: words have columns of that name")
    return groups


def _integer(value: Column, dtype: DataType) -> Column | None:
    """The value as a long, one to one; None for types that are not packed."""
    if isinstance(dtype, DateType):
        return F.unix_date(value).cast("long")
    if isinstance(dtype, (IntegralType, BooleanType)):
        return value.cast("long")
    return None


def distinct_words(df: DataFrame, group_by: str | Sequence[str], value: str) -> DataFrame:
    """The words ``(group..., word, bits)`` of the distinct non-NULL values of ``value``.
    NULL groups are groups of their own, as with GROUP BY. An empty frame has no words."""
    groups = _groups(df, group_by)
    col = F.col(value)
    number = _integer(col, df.schema[value].dataType)
    if number is None:
        word, bits = col, F.when(col.isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")
    else:
        word = F.shiftright(number, 6)
        bit = number.bitwiseAND(F.lit(63)).cast("int")
        # shiftleft takes the distance from a column only as an SQL function
        bits = F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), bit), F.lit(0).cast("long"))
    return merge_words(df.select(*groups, word.alias(WORD), bits.alias(BITS)), group_by=groups)


def merge_words(*words: DataFrame, group_by: str | Sequence[str]) -> DataFrame:
    """The words of all frames together: one row for each group and word."""
    groups = _groups(words[0], group_by)
    together = words[0]
    for other in words[1:]:
        together = together.unionByName(other)
    return together.groupBy(*groups, WORD).agg(F.bit_or(BITS).alias(BITS))


def unseen_words(words: DataFrame, seen: DataFrame | None, group_by: str | Sequence[str]) -> DataFrame:
    """What ``words`` (merged) have beyond ``seen`` (disjoint or not): rows with the new bits only, to be
    appended to ``seen``. Groups that ``seen`` does not have keep their row without bits.

    ``seen`` is first cut by a semi join to the words of the batch, so that a small
    batch is broadcast by measured size and the side table is not shuffled."""
    if seen is None:
        return words
    groups = _groups(words, group_by)
    keys = [*groups, WORD]

    def same(a: str, b: str) -> Column:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
        return cond

    met = seen.select(*keys, BITS).alias("s").join(words.select(*keys).alias("b"), same("s", "b"), "left_semi")
    old = met.groupBy(*keys).agg(F.bit_or(BITS).alias(BITS)).alias("o")
    new = F.col(f"n.{BITS}").bitwiseAND(F.bitwise_not(F.coalesce(F.col(f"o.{BITS}"), F.lit(0).cast("long"))))
    joined = words.alias("n").join(old, same("n", "o"), "left")
    return joined.where((new != 0) | F.col(f"o.{BITS}").isNull()).select(*[F.col(f"n.`{k}`") for k in keys], new.alias(BITS))


def count_words(words: DataFrame, group_by: str | Sequence[str], alias: str = "n") -> DataFrame:
    """The number of distinct values of each group. The words must be disjoint: merged, or
    appended as :func:`unseen_words` gives them."""
    return words.groupBy(*_groups(words, group_by)).agg(F.sum(F.bit_count(BITS)).cast("long").alias(alias))


class DistinctCount:
    """``count(DISTINCT value)`` by group, kept in a side table that batches are appended to.

        users = DistinctCount("event_type", "user_id")
        project.incremental("users_seen", lambda ctx: users.batch(new_events, ctx.this))
        users.counts(project.ref("users_seen"))
    """

    def __init__(self, group_by: str | Sequence[str], value: str):
        self.group_by = [group_by] if isinstance(group_by, str) else list(group_by)
        self.value = value

    def batch(self, rows: DataFrame, this: DataFrame | None) -> DataFrame:
        """The words to append for ``rows``; ``this`` is the side table, or None at first."""
        return unseen_words(distinct_words(rows, self.group_by, self.value), this, self.group_by)

    def counts(self, this: DataFrame, alias: str = "n") -> DataFrame:
        return count_words(this, self.group_by, alias)
