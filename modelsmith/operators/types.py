"""Column type strings and conformance to declared types (K1, K2).

Declared column types use the reference's type vocabulary, e.g.
``Nullable(UInt32)``, ``LowCardinality(String)``, ``FixedString(16)``,
``Decimal(12, 2)``, ``DateTime('UTC')``, ``Array(Nullable(String))``,
``Map(String, UInt64)``. :func:`parse_type` maps one onto a Spark type plus
the constraints Spark types cannot express (unsigned range, fixed length, not
NULL); :func:`conform` applies them to a DataFrame with two projections.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# String type names accepted as plain String.
STRING_ALIASES = frozenset({
    "string", "text", "varchar", "char", "blob", "tinytext", "mediumtext", "longtext",
    "tinyblob", "mediumblob", "longblob", "clob", "uuid",
})

# Signed integer widths and their Spark types; unsigned ones take
# the next wider signed type (UInt64 and wider need decimals).
_SIGNED = {8: ByteType(), 16: ShortType(), 32: IntegerType(), 64: LongType()}
_UNSIGNED = {8: ShortType(), 16: IntegerType(), 32: LongType(), 64: DecimalType(20, 0)}
_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


@dataclass(frozen=True)
class ColumnType:
    spark_type: DataType
    nullable: bool = False
    fixed_length: int | None = None
    min_value: int | None = None
    max_value: int | None = None
    timezone: str | None = None
    key: ColumnType | None = None  # of a map
    value: ColumnType | None = None  # of an array's elements or a map's values


def _split_args(body: str) -> list[str]:
    parts, depth, cur, quote = [], 0, [], None
    for ch in body:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    if cur:
        parts.append("".join(cur).strip())
    return parts


_CALL = re.compile(r"^\s*([A-Za-z][A-Za-z0-9]*)\s*(?:\((.*)\))?\s*$", re.S)


def parse_type(type_string: str) -> ColumnType:
    """Parse a declared type string. Raises ``ValueError`` when the type has no
    Spark equivalent (for example a decimal of more than 38 digits). Integers of
    128 and 256 bits are held as ``decimal(38,0)``: values beyond 38 digits are
    out of range and are rejected, never rounded."""
    m = _CALL.match(type_string)
    if not m:
        raise ValueError(f"cannot parse type {type_string!r}")
    name, body = m.group(1), m.group(2)
    lname = name.lower()
    args = _split_args(body) if body is not None else []

    if lname == "nullable":
        inner = parse_type(args[0])
        return replace(inner, nullable=True)
    if lname == "lowcardinality":
        return parse_type(args[0])  # dictionary encoding is Parquet's job
    if lname == "array":
        inner = parse_type(args[0])
        return ColumnType(ArrayType(inner.spark_type, containsNull=inner.nullable), value=inner)
    if lname == "map":
        k, v = parse_type(args[0]), parse_type(args[1])
        return ColumnType(MapType(k.spark_type, v.spark_type, valueContainsNull=v.nullable), key=k, value=v)
    if lname in STRING_ALIASES:
        return ColumnType(StringType())
    if lname == "fixedstring":
        return ColumnType(StringType(), fixed_length=int(args[0]))
    m_int = re.fullmatch(r"(u?)int(\d+)", lname)
    if m_int:
        unsigned, bits = m_int.group(1) == "u", int(m_int.group(2))
        if bits not in (8, 16, 32, 64, 128, 256):
            raise ValueError(f"unknown integer type {type_string!r}")
        if unsigned:
            hi = 2**bits - 1
            spark_t = _UNSIGNED.get(bits, DecimalType(38, 0))
            return ColumnType(spark_t, min_value=0, max_value=min(hi, 10**38 - 1))
        lo, hi = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1
        spark_t = _SIGNED.get(bits, DecimalType(38, 0))
        return ColumnType(spark_t, min_value=max(lo, -(10**38) + 1), max_value=min(hi, 10**38 - 1))
    if lname in ("integer", "int"):
        return ColumnType(IntegerType())
    if lname == "bigint":
        return ColumnType(LongType())
    if lname in ("float32", "float", "real"):
        return ColumnType(FloatType())
    if lname in ("float64", "double"):
        return ColumnType(DoubleType())
    if lname in ("decimal", "numeric"):
        p = int(args[0]) if args else 10
        s = int(args[1]) if len(args) > 1 else 0
        if p > 38:
            raise ValueError(f"{type_string!r}: precision above 38 has no Spark equivalent")
        return ColumnType(DecimalType(p, s))
    if lname in ("bool", "boolean"):
        return ColumnType(BooleanType())
    if lname in ("date", "date32"):
        return ColumnType(DateType())
    if lname in ("datetime", "datetime64", "timestamp"):
        tz = [a.strip("'\"") for a in args if a.strip()[:1] in "'\""]
        if tz:
            return ColumnType(TimestampType(), timezone=tz[0])
        return ColumnType(TimestampNTZType())
    raise ValueError(f"unsupported type {type_string!r}")


def _typed(source: Column, source_type: DataType, ct: ColumnType) -> Column:
    """The value in the declared type, NULL where it (or a key of a map) cannot be cast."""
    if ct.timezone:
        return F.to_utc_timestamp(source.try_cast("timestamp_ntz"), ct.timezone).cast(TimestampType())
    if ct.value is None:
        return source.try_cast(loosened(ct.spark_type))
    if ct.key is None:
        return F.transform(source, lambda x: _typed(x, source_type.elementType, ct.value))
    keys = F.transform(F.map_keys(source), lambda k: _typed(k, source_type.keyType, ct.key))
    values = F.transform(F.map_values(source), lambda v: _typed(v, source_type.valueType, ct.value))
    sound = ~F.exists(keys, lambda k: k.isNull()) & (F.size(F.array_distinct(keys)) == F.size(keys))
    return F.when(sound, F.map_from_arrays(keys, values))


def _check_nesting(source_type: DataType, ct: ColumnType, name: str) -> None:
    if ct.value is None:
        return
    if not isinstance(source_type, ArrayType if ct.key is None else MapType):
        raise ValueError(f"{name}: declared {ct.spark_type.simpleString()}, found {source_type.simpleString()}")
    if ct.key is None:
        return _check_nesting(source_type.elementType, ct.value, name)
    _check_nesting(source_type.keyType, ct.key, name)
    _check_nesting(source_type.valueType, ct.value, name)


def _violations(source: Column, typed: Column, source_type: DataType, ct: ColumnType, name: str) -> list[Column]:
    """One expression per rule: its reason text when the value breaks it, else NULL."""
    return [F.when(broken, F.lit(f"{name}: {text}")) for broken, text in _rules(source, typed, source_type, ct)]


def _inner_rules(items: Column, item_type: DataType, ct: ColumnType, what: str) -> list[tuple[Column, str]]:
    """The rules of a declared element, key or value type, each broken if any item breaks it."""
    def of(x: Column) -> list[tuple[Column, str]]:
        return _rules(x, _typed(x, item_type, ct), item_type, ct)

    def broken(i: int) -> Column:
        return F.exists(items, lambda x: F.coalesce(of(x)[i][0], F.lit(False)))

    return [(broken(i), f"{what} {text}") for i, (_, text) in enumerate(of(F.lit(None).cast(item_type)))]


def _rules(source: Column, typed: Column, source_type: DataType, ct: ColumnType) -> list[tuple[Column, str]]:
    """(condition that a value breaks the rule, reason) for each rule of a declared type."""
    broken = [(source.isNotNull() & typed.isNull(), "not castable")]
    if not ct.nullable:
        broken.append((source.isNull(), "NULL in non-nullable column"))
    if isinstance(ct.spark_type, (*_INTEGRAL, DecimalType)):
        if isinstance(source_type, (FloatType, DoubleType, DecimalType)):
            broken.append((typed.isNotNull() & ~typed.try_cast(source_type).eqNullSafe(source), "not exact"))
        elif isinstance(source_type, StringType):
            broken.append((typed.try_cast("decimal(38,18)") != source.try_cast("decimal(38,18)"), "not exact"))
    def bound(value: int) -> Column:
        # decimal bounds go through text: Python ints beyond 64 bits are not literals
        raw = F.lit(str(value)) if isinstance(ct.spark_type, DecimalType) else F.lit(value)
        return raw.cast(ct.spark_type)

    if ct.min_value is not None:
        broken.append((typed < bound(ct.min_value), "below range"))
    if ct.max_value is not None:
        broken.append((typed > bound(ct.max_value), "above range"))
    if ct.fixed_length is not None:
        broken.append((F.length(typed) > ct.fixed_length, f"longer than {ct.fixed_length}"))
    if ct.key is not None:
        broken += _inner_rules(F.map_keys(source), source_type.keyType, ct.key, "key")
        broken += _inner_rules(F.map_values(source), source_type.valueType, ct.value, "value")
    elif ct.value is not None:
        broken += _inner_rules(source, source_type.elementType, ct.value, "element")
    return broken


def conform(df: DataFrame, declared: dict[str, str], reason_column: str = "_reject_reason") -> DataFrame:
    """Cast declared columns and attach a reject reason (no shuffle, no join).

    Returns the frame with declared columns typed and ``reason_column`` holding
    NULL for conforming rows; :func:`split_conformed` separates the two sets.
    A number that the declared type cannot hold exactly is rejected, not
    rounded; rules of element, key and value types hold for every item.
    """
    parsed = {c: parse_type(t) for c, t in declared.items()}
    missing = [c for c in parsed if c not in df.columns]
    if missing:
        raise ValueError(f"declared columns not in the frame: {missing}")
    # Step 1 casts each declared column once, next to its source text; step 2
    # checks the rules against those columns. Two small projections instead of
    # one expression tree that repeats every cast per rule keep the generated
    # code small enough for the JIT, however many columns are declared.
    types = {c: df.schema[c].dataType for c in parsed}
    typed_name = {c: f"__typed_{i}" for i, c in enumerate(parsed)}
    casts = []
    for c, ct in parsed.items():
        _check_nesting(types[c], ct, c)
        casts.append(_typed(F.col(f"`{c}`"), types[c], ct).alias(typed_name[c]))
    step1 = df.select("*", *casts)
    reasons = []
    for c, ct in parsed.items():
        reasons += _violations(F.col(f"`{c}`"), F.col(typed_name[c]), types[c], ct, c)
    reason = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    out = [F.col(typed_name[c]).alias(c) if c in parsed else F.col(f"`{c}`") for c in df.columns]
    return step1.select(*out, F.when(reason != "", reason).alias(reason_column))


def split_conformed(conformed: DataFrame, reason_column: str = "_reject_reason"):
    """(typed rows, rejected rows with their reason)."""
    good = conformed.filter(F.col(reason_column).isNull()).drop(reason_column)
    bad = conformed.filter(F.col(reason_column).isNotNull())
    return good, bad


# ----------------------------------------------------------------- widening (K2)

_INTEGRAL_ORDER = [ByteType(), ShortType(), IntegerType(), LongType()]


def loosened(t: DataType) -> DataType:
    """The type with NULL allowed at every depth, as a stored table has it."""
    if isinstance(t, ArrayType):
        return ArrayType(loosened(t.elementType), True)
    if isinstance(t, MapType):
        return MapType(loosened(t.keyType), loosened(t.valueType), True)
    if isinstance(t, StructType):
        return StructType([StructField(f.name, loosened(f.dataType), True) for f in t.fields])
    return t


def widen(old: DataType, new: DataType, allow_string: bool = False, allow_rounding: bool = False) -> DataType | None:
    """Least common type of an existing and a new column type, or None when
    the pair may not be widened. integers to the wider one, int→double, decimals
    to the larger scale and integer digits, date→timestamp; bigint and long
    decimals to double only if ``allow_rounding``, as a double has 53 bits; number↔string only when
    ``allow_string`` (the ``sync_all_columns`` policy), to string."""
    old, new = loosened(old), loosened(new)
    if old == new:
        return old
    if old in _INTEGRAL_ORDER and new in _INTEGRAL_ORDER:
        return max(old, new, key=_INTEGRAL_ORDER.index)
    numeric_float = (FloatType, DoubleType)
    rounds = any(isinstance(t, LongType) or isinstance(t, DecimalType) and t.precision > 15 for t in (old, new))
    if rounds and not allow_rounding and any(isinstance(t, numeric_float) for t in (old, new)):
        return None
    if isinstance(old, numeric_float + (ByteType, ShortType, IntegerType, LongType)) and isinstance(
        new, numeric_float + (ByteType, ShortType, IntegerType, LongType)
    ):
        return DoubleType()
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        scale = max(old.scale, new.scale)
        digits = max(old.precision - old.scale, new.precision - new.scale)
        if digits + scale > 38:
            return None
        return DecimalType(digits + scale, scale)
    if isinstance(old, DecimalType) and new in _INTEGRAL_ORDER or isinstance(new, DecimalType) and old in _INTEGRAL_ORDER:
        dec = old if isinstance(old, DecimalType) else new
        return widen(dec, DecimalType(20, 0))
    if isinstance(old, DecimalType) and isinstance(new, numeric_float) or isinstance(new, DecimalType) and isinstance(old, numeric_float):
        return DoubleType()
    if {type(old), type(new)} == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if {type(old), type(new)} == {DateType, TimestampType}:
        return TimestampType()
    if allow_string and (isinstance(old, StringType) or isinstance(new, StringType)):
        return StringType()
    return None
