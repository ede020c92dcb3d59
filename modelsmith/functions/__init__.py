"""Portable function layer: string, date, array, hash, cast and aggregate
functions with pinned semantics, all built from Catalyst expressions."""

from modelsmith.functions.aggregates import (
    any_value,
    bool_or,
    count_distinct,
    exact_avg,
    exact_sum,
    group_array,
    listagg,
    listagg_limited,
)
from modelsmith.functions.arrays import array_append, array_concat, array_construct, element_at
from modelsmith.functions.casts import PORTABLE_TYPES, cast_to, safe_cast, type_of
from modelsmith.functions.dates import date_trunc, dateadd, datediff, last_day, now
from modelsmith.functions.hashing import half_md5, half_md5_of_text, scd_id
from modelsmith.functions.text import (
    cast_bool_to_text,
    concat,
    hash_text,
    length,
    position,
    replace,
    right,
    split_part,
    string_literal,
)

__all__ = [
    "any_value", "bool_or", "count_distinct", "exact_avg", "exact_sum", "group_array", "listagg",
    "listagg_limited", "array_append", "array_concat", "array_construct", "element_at",
    "PORTABLE_TYPES", "cast_to", "safe_cast", "type_of", "date_trunc", "dateadd",
    "datediff", "last_day", "now", "half_md5", "half_md5_of_text", "scd_id",
    "cast_bool_to_text", "concat", "hash_text", "length", "position", "replace", "right",
    "split_part", "string_literal",
]
