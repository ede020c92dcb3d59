"""Portable array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from modelsmith.functions._util import as_col


def _lit_or_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def array_construct(inputs=(), data_type: DataType | str | None = None) -> Column:
    """``[a, b, ...]``; with no inputs, a typed empty array."""
    items = [_lit_or_col(v) for v in inputs]
    if items:
        arr = F.array(*items)
        return arr.cast(ArrayType(_dtype(data_type))) if data_type is not None else arr
    if data_type is None:
        raise ValueError("an empty array needs a data_type")
    return F.array().cast(ArrayType(_dtype(data_type)))


def _dtype(data_type):
    if isinstance(data_type, str):
        from modelsmith.functions.casts import PORTABLE_TYPES

        if data_type.lower() in PORTABLE_TYPES:
            return PORTABLE_TYPES[data_type.lower()]
        from modelsmith.operators.types import parse_type

        return parse_type(data_type).spark_type
    return data_type


def array_append(array, new_element) -> Column:
    """Append one element at the end."""
    return F.array_append(as_col(array), _lit_or_col(new_element))


def array_concat(array_1, array_2) -> Column:
    """Concatenate two arrays."""
    return F.concat(as_col(array_1), as_col(array_2))


def element_at(array, index: int) -> Column:
    """1-based element; NULL when out of range (never raises)."""
    return F.try_element_at(as_col(array), F.lit(int(index)))
