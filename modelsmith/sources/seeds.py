"""CSV seeds (A2, A3): small CSV files loaded as typed tables.

The file is parsed by Spark's CSV reader (real quoting, so values holding the
delimiter or ``|`` stay whole; empty fields are NULL). Every column is first
read as text; its type is then inferred in **one** aggregate pass over the
data (per column, a bitmask of the kinds of values present), and a declared
``column_types`` entry always wins over inference.

Inference order (first type that every non-empty value fits): bigint,
decimal(38,0) (whole numbers beyond 64 bits), double, boolean, date
(``YYYY-MM-DD`` only), timestamp (date, ``T`` or space, time; date-only values
may mix in), else string. Time-of-day values stay strings.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from modelsmith.operators.types import conform, parse_type

# Per-value type codes, tried in this order (first fit wins),
# with the text pattern a value must also match (None: the cast alone decides).
# The pattern is tested first, so the cast is only tried on plausible values.
_CANDIDATES = (
    (1, "bigint", r"^[+-]?\d{1,19}$"),
    (2, "decimal(38,0)", r"^[+-]?\d{1,38}$"),
    (3, "double", r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))$"),
    (4, "boolean", r"^(?i)(true|false)$"),
    (5, "date", r"^\d{4}-\d{2}-\d{2}$"),
    (6, "timestamp_ntz", r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"),
)
_STRING_CODE = 7

# Sets of codes seen in a column (empty values excluded) and the
# column type they give (the first set that holds them all); any other mix is
# string. Whole numbers beyond 64 bits stay exact as decimal(38,0).
_COLUMN_TYPES = (
    ({1}, "bigint"),
    ({1, 2}, "decimal(38,0)"),
    ({1, 2, 3}, "double"),
    ({4}, "boolean"),
    ({5}, "date"),
    ({5, 6}, "timestamp_ntz"),
)


def read_seed_text(spark: SparkSession, path: str, delimiter: str = ",", header: bool = True,
                   **options) -> DataFrame:
    """The CSV with every column as text (no inference by the reader)."""
    reader = spark.read.option("header", header).option("sep", delimiter).option("mode", "FAILFAST")
    for k, v in options.items():
        reader = reader.option(k, v)
    probe = reader.csv(path)
    text_schema = StructType([StructField(c, StringType(), True) for c in probe.columns])
    return reader.schema(text_schema).csv(path)


def _value_bit(c: Column) -> Column:
    """``1 << code`` of one text value: code 0 empty, 1..5 the first candidate
    it fits, 6 anything else (a short-circuiting CASE chain)."""
    v = F.trim(c)
    bit = F.when(c.isNull() | (v == ""), F.lit(1))
    for n, t, pattern in _CANDIDATES:
        fits = v.try_cast(t).isNotNull()
        if pattern is not None:
            fits = v.rlike(pattern) & fits
        bit = bit.when(fits, F.lit(1 << n))
    return bit.otherwise(F.lit(1 << _STRING_CODE))


def _column_type(mask: int | None) -> str:
    seen = {n for n in range(1, _STRING_CODE + 1) if mask and mask >> n & 1}
    for allowed, name in _COLUMN_TYPES:
        if seen and seen <= allowed and (name != "timestamp_ntz" or 6 in seen):
            return name
    return "string"


def infer_types(text: DataFrame) -> dict[str, str]:
    """Column → inferred Spark type name.

    One aggregate over the data: the text is unpivoted into (column, value)
    cells, each value gets the bit of its kind, and the bits are OR-ed per
    column. A single small expression serves every column, so code generation
    stays compact however wide the seed is; partial aggregation leaves at most
    one row per column and task for the shuffle, and one row per column (a
    bitmask) reaches the driver.
    """
    if not text.columns:
        return {}
    cells = text.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("v")) for i, c in enumerate(text.columns)
    ])))
    masks = {r["i"]: r["m"] for r in
             cells.groupBy("i").agg(F.bit_or(_value_bit(F.col("v"))).alias("m")).collect()}
    return {c: _column_type(masks.get(i)) for i, c in enumerate(text.columns)}


def type_seed(text: DataFrame, column_types: Mapping[str, str] | None = None,
              inferred: Mapping[str, str] | None = None) -> DataFrame:
    """Cast the text columns: declared types first, then inferred ones.

    A declared type holds as in :func:`modelsmith.operators.types.conform`: a value that it
    would round, that is out of its range or longer than it allows fails the load, with the
    column and the reason; it never becomes NULL or another value. Empty fields are NULL.
    """
    declared = dict(column_types or {})
    unknown = [c for c in declared if c not in text.columns]
    if unknown:
        raise ValueError(f"column_types names unknown columns: {unknown}")
    inferred = dict(inferred) if inferred is not None else infer_types(
        text.select(*[F.col(f"`{c}`") for c in text.columns if c not in declared])
    )

    def bare(c: str) -> Column:
        return F.when(F.trim(F.col(f"`{c}`")) != "", F.trim(F.col(f"`{c}`")))

    # Text stays as it is; what else is declared is read without the spaces around it.
    source = text.select(*[
        (bare(c) if c in declared and parse_type(declared[c]).spark_type != StringType() else F.col(f"`{c}`")).alias(c) for c in text.columns])
    reason = "__reason"
    typed = conform(source, {c: f"Nullable({t})" for c, t in declared.items()}, reason) if declared else source
    cols = []
    for c in text.columns:
        value = F.col(f"`{c}`")
        if c in declared:
            value = F.when(F.col(reason).isNotNull(), F.raise_error(F.concat(F.lit("seed value refused: "), F.col(reason)))).otherwise(value)
        elif inferred[c] != "string":
            value = bare(c).cast(inferred[c])
        cols.append(value.alias(c))
    return typed.select(*cols)


def seed_rejects(text: DataFrame, column_types: Mapping[str, str], reason_column: str = "reason") -> DataFrame:
    """The text rows that :func:`type_seed` refuses, each with its reason."""
    bare = text.select(*[
        F.when(F.trim(F.col(f"`{c}`")) != "", F.trim(F.col(f"`{c}`"))).alias(c) if c in column_types and parse_type(column_types[c]).spark_type != StringType()
        else F.col(f"`{c}`") for c in text.columns])
    kept = bare.select(F.struct(*[F.col(f"`{c}`") for c in text.columns]).alias("__row"), *[F.col(f"`{c}`") for c in column_types])
    checked = conform(kept, {c: f"Nullable({t})" for c, t in column_types.items()}, reason_column)
    return checked.where(F.col(reason_column).isNotNull()).select("__row.*", reason_column)


def load_seed(spark: SparkSession, path: str, column_types: Mapping[str, str] | None = None,
              delimiter: str = ",", **options) -> DataFrame:
    """A2: CSV file → typed DataFrame (publish it with the builder)."""
    return type_seed(read_seed_text(spark, path, delimiter, **options), column_types)
