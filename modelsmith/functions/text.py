"""Portable string functions (I3-I10) as Spark Columns.

Every function maps to built-in Catalyst expressions, so it stays inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelsmith.functions._util import as_col


def split_part(text, delimiter: str, part_number: int) -> Column:
    """1-based field of ``text`` split on a literal delimiter.

    Out of range gives ``''``, NULL text gives NULL, negative parts count from
    the end, part 0 raises. The delimiter is literal text, never a regex.
    """
    return F.split_part(as_col(text), F.lit(delimiter), F.lit(int(part_number)))


def replace(text, old: str, new: str) -> Column:
    """Replace every occurrence of ``old`` by ``new``."""
    return F.replace(as_col(text), F.lit(old), F.lit(new))


def concat(*parts) -> Column:
    """``a || b || ...``; NULL when any part is NULL."""
    return F.concat(*[as_col(p) for p in parts])


def length(text) -> Column:
    """Character length as bigint."""
    return F.length(as_col(text)).cast("bigint")


def position(substring: str, text) -> Column:
    """1-based position of ``substring`` in ``text`` (0 when absent), bigint."""
    return F.locate(substring, as_col(text)).cast("bigint")


def right(text, n: int) -> Column:
    """The last ``n`` characters."""
    return F.right(as_col(text), F.lit(int(n)))


def string_literal(value: str) -> Column:
    """A string literal; quotes of any style are data, never spliced into SQL."""
    return F.lit(value)


def hash_text(value) -> Column:
    """Lower-case hex MD5 of the value's text form."""
    return F.md5(as_col(value).cast("string"))


def cast_bool_to_text(value) -> Column:
    """``'true'`` when > 0, ``'false'`` when 0, NULL otherwise."""
    number = as_col(value).try_cast("double")
    return F.when(number > 0, F.lit("true")).when(number == 0, F.lit("false"))
