import pytest
from pyspark.sql.types import (
    ArrayType, ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType,
    ShortType, StringType, TimestampNTZType, TimestampType,
)

from modelsmith.operators.types import conform, parse_type, split_conformed, widen

BASES = {
    "UInt8": ShortType(), "UInt16": IntegerType(), "UInt32": LongType(), "UInt64": DecimalType(20, 0),
    "UInt128": DecimalType(38, 0), "UInt256": DecimalType(38, 0),
    "Int8": ByteType(), "Int16": ShortType(), "Int32": IntegerType(), "Int64": LongType(),
    "Int128": DecimalType(38, 0), "Int256": DecimalType(38, 0),
    "String": StringType(), "FixedString(16)": StringType(), "Decimal(6, 6)": DecimalType(6, 6),
    "Float32": FloatType(), "Float64": DoubleType(), "Date": DateType(), "Date32": DateType(),
    "DateTime('Asia/Istanbul')": TimestampType(), "DateTime": TimestampNTZType(), "UUID": StringType(),
}


@pytest.mark.parametrize("base,expected", list(BASES.items()))
def test_type_strings_bare_and_wrapped(base, expected):
    assert parse_type(base).spark_type == expected
    assert parse_type(base).nullable is False
    assert parse_type(f"Nullable({base})").spark_type == expected
    assert parse_type(f"Nullable({base})").nullable is True
    assert parse_type(f"LowCardinality({base})").spark_type == expected
    assert parse_type(f"LowCardinality(Nullable({base}))").nullable is True


def test_composite_types():
    assert parse_type("Array(String)").spark_type == ArrayType(StringType(), False)
    assert parse_type("Array(Nullable(String))").spark_type == ArrayType(StringType(), True)
    assert parse_type("Array(Nullable(FixedString(16)))").spark_type == ArrayType(StringType(), True)
    assert parse_type("Map(String, UInt64)").spark_type == MapType(StringType(), DecimalType(20, 0), False)
    assert parse_type("Map(String, Decimal(6, 6))").spark_type == MapType(StringType(), DecimalType(6, 6), False)
    assert parse_type("Decimal(12,2)").spark_type == DecimalType(12, 2)  # tolerant spacing
    assert parse_type("FixedString(16)").fixed_length == 16
    with pytest.raises(ValueError):
        parse_type("Decimal(40, 2)")
    with pytest.raises(ValueError):
        parse_type("Tuple(String)")


def test_conform_rejects_bad_rows(spark):
    df = spark.createDataFrame(
        [("1", "ab", "5", "x"), ("-1", "a", "5", "y"), ("4294967296", "a", "5", "z"),
         ("7", "a", None, "w"), ("8", "abc", "99999999999", None), ("9", "b", "3", "v")],
        "u string, f string, d string, s string",
    )
    conformed = conform(df, {"u": "UInt32", "f": "FixedString(2)", "d": "Nullable(Decimal(4, 0))",
                             "s": "String"})
    good, bad = split_conformed(conformed)
    assert sorted((r.u, r.f) for r in good.collect()) == [(1, "ab"), (7, "a"), (9, "b")]
    reasons = {r.u if r.u is not None else -999: r._reject_reason for r in bad.collect()}
    assert "below range" in reasons[-1]
    assert "above range" in reasons[4294967296]
    assert "longer than 2" in reasons[8] and "not castable" in reasons[8] and "NULL" in reasons[8]
    assert good.schema["u"].dataType == LongType()


def test_int128_beyond_decimal_is_refused_not_rounded(spark):
    big = "1" + "0" * 38  # 39 digits
    df = spark.createDataFrame([(big,), ("12",)], "v string")
    good, bad = split_conformed(conform(df, {"v": "Int128"}))
    assert [r.v for r in good.collect()] == [12]
    assert bad.count() == 1


def test_widen():
    assert widen(IntegerType(), LongType()) == LongType()
    assert widen(LongType(), DoubleType()) is None
    assert widen(LongType(), DoubleType(), allow_rounding=True) == DoubleType()
    assert widen(IntegerType(), DoubleType()) == DoubleType()
    assert widen(DecimalType(8, 2), DecimalType(10, 3)) == DecimalType(10, 3)
    assert widen(DecimalType(10, 0), DecimalType(6, 6)) == DecimalType(16, 6)
    assert widen(DateType(), TimestampNTZType()) == TimestampNTZType()
    assert widen(IntegerType(), StringType()) is None
    assert widen(IntegerType(), StringType(), allow_string=True) == StringType()


def test_conform_rejects_what_does_not_fit_exactly(spark):
    df = spark.createDataFrame([(1, 1.0, "1.23"), (2, 1.7, "1.23"), (3, 1.0, "1.239"), (4, None, None)], "id int, n double, p string")
    out = conform(df, {"n": "Nullable(Int32)", "p": "Nullable(Decimal(5, 2))"})
    assert {r.id: r._reject_reason for r in out.collect()} == {1: None, 2: "n: not exact", 3: "p: not exact", 4: None}


def test_conform_arrays_and_maps(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, array('ab', null), array('5', null), map('k', '7')),
          (2, array('abcdef'), array('5'), map('k', '7')),
          (3, array('ab'), array('-5'), map('k', '7')),
          (4, array('ab'), array('5'), map('k', 'x')),
          (5, cast(null as array<string>), array(), map()) AS t(id, f, u, m)""")
    declared = {"f": "Array(Nullable(FixedString(2)))", "u": "Array(Nullable(UInt8))", "m": "Map(String, UInt64)"}
    out = conform(df, declared)
    reasons = {r.id: r._reject_reason for r in out.collect()}
    assert reasons == {
        1: None, 2: "f: element longer than 2", 3: "u: element below range", 4: "m: value not castable",
        5: "f: NULL in non-nullable column"}
    good, _ = split_conformed(out)
    row = good.first()
    assert row.f == ["ab", None] and row.u == [5, None] and {k: int(v) for k, v in row.m.items()} == {"k": 7}
    try:
        conform(df, {"id": "Array(String)"})
    except ValueError as e:
        assert "id" in str(e)
    else:
        raise AssertionError("a scalar column passed as an array")


def test_conform_map_keys_that_meet_or_fail_are_rejected(spark):
    df = spark.sql("SELECT * FROM VALUES (1, map('1', 'a')), (2, map('1', 'a', '01', 'b')), (3, map('x', 'a')) AS t(id, m)")
    out = conform(df, {"m": "Map(Int32, String)"})
    assert {r.id for r in out.where("_reject_reason is null").collect()} == {1}
