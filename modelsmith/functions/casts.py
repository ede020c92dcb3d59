"""Portable type names and casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
)

from modelsmith.functions._util import as_col

# Portable type names and the Spark type each one denotes.
PORTABLE_TYPES: dict[str, DataType] = {
    "bigint": LongType(),
    "boolean": BooleanType(),
    "float": FloatType(),
    "int": IntegerType(),
    "integer": IntegerType(),
    "numeric": DecimalType(28, 6),
    "string": StringType(),
    "timestamp": TimestampNTZType(),
}


def type_of(name: str) -> DataType:
    """Spark type for a portable type name (``bigint``, ``numeric``, ...)."""
    try:
        return PORTABLE_TYPES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown portable type {name!r}") from None


def cast_to(value, name: str | DataType) -> Column:
    """Plain cast; raises on bad input under ANSI mode."""
    target = type_of(name) if isinstance(name, str) else name
    return as_col(value).cast(target)


def safe_cast(value, name: str | DataType) -> Column:
    """Cast that yields NULL instead of failing."""
    target = type_of(name) if isinstance(name, str) else name
    return as_col(value).try_cast(target)
