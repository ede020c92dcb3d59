import datetime as dt

from pyspark.sql import functions as F

from modelsmith import functions as fn

# Fixture rows (first, second, part, expected) of the boundary-counting datediff.
DATEDIFF_ROWS = [
    ("2018-01-01 01:00:00", "2018-01-02 01:00:00", "day", 1),
    ("2018-01-01 01:00:00", "2018-02-01 01:00:00", "month", 1),
    ("2018-01-01 01:00:00", "2019-01-01 01:00:00", "year", 1),
    ("2018-01-01 01:00:00", "2018-01-01 02:00:00", "hour", 1),
    ("2018-01-01 01:00:00", "2018-01-01 02:01:00", "minute", 61),
    ("2018-01-01 01:00:00", "2018-01-01 02:00:01", "second", 3601),
    ("2019-12-31 00:00:00", "2019-12-27 00:00:00", "week", -1),
    ("2019-12-31 00:00:00", "2019-12-30 00:00:00", "week", 0),
    ("2019-12-31 00:00:00", "2020-01-02 00:00:00", "week", 0),
    ("2019-12-31 00:00:00", "2020-01-06 02:00:00", "week", 1),
    # boundaries, not elapsed time
    ("2018-12-31 23:59:59", "2019-01-01 00:00:00", "year", 1),
    ("2018-01-01 01:59:00", "2018-01-01 02:00:00", "hour", 1),
]


def test_datediff_counts_boundaries(spark):
    df = spark.createDataFrame(DATEDIFF_ROWS, "a string, b string, part string, expected int")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"),
                   "part", "expected")
    parts = sorted({r[2] for r in DATEDIFF_ROWS})
    actual = None
    for p in parts:
        branch = F.when(F.col("part") == p, fn.datediff("a", "b", p))
        actual = branch if actual is None else F.coalesce(actual, branch)
    out = df.select(actual.alias("actual"), "expected", "part").collect()
    assert all(r["actual"] == r["expected"] for r in out), [tuple(r) for r in out]


def test_dateadd_rows(spark):
    rows_in = [
        ("2018-01-01 01:00:00", 1, "day", "2018-01-02 01:00:00"),
        ("2018-01-01 01:00:00", 1, "month", "2018-02-01 01:00:00"),
        ("2018-01-01 01:00:00", 1, "year", "2019-01-01 01:00:00"),
        ("2018-01-01 01:00:00", 1, "hour", "2018-01-01 02:00:00"),
        ("2024-01-31 00:00:00", 1, "month", "2024-02-29 00:00:00"),  # clamps to month end
    ]
    df = spark.createDataFrame(rows_in, "t string, n int, part string, expected string")
    for t, n, part, expected in rows_in:
        got = df.filter((F.col("t") == t) & (F.col("part") == part)).select(
            fn.dateadd(part, n, F.col("t").cast("timestamp_ntz")).alias("r")
        ).first()["r"]
        assert got == dt.datetime.fromisoformat(expected)


def test_split_part_bar_delimiter(spark):
    df = spark.createDataFrame([("a|b|c",), ("1|2|3",), ("",), (None,), ("x",)], "parts string")
    out = df.select(
        fn.split_part("parts", "|", 1).alias("p1"),
        fn.split_part("parts", "|", 2).alias("p2"),
        fn.split_part("parts", "|", 3).alias("p3"),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("a", "b", "c"), ("1", "2", "3"), ("", "", ""), (None, None, None), ("x", "", ""),
    ]


def test_replace_and_strings(spark):
    df = spark.createDataFrame([("a.b.c", "it's")], "s string, q string")
    r = df.select(
        fn.replace("s", ".", "/").alias("r"),
        fn.length("s").alias("n"),
        fn.position("b", "s").alias("p"),
        fn.right("s", 2).alias("tail"),
        fn.concat("s", F.lit(None).cast("string")).alias("null_concat"),
        fn.string_literal("'quoted' \"both\"").alias("lit"),
    ).first()
    assert (r.r, r.n, r.p, r.tail, r.null_concat, r.lit) == ("a/b/c", 5, 3, ".c", None, "'quoted' \"both\"")


def test_cast_bool_to_text(spark):
    df = spark.createDataFrame([(1,), (0,), (-1,), (None,)], "x int")
    out = [r[0] for r in df.select(fn.cast_bool_to_text("x")).collect()]
    assert out == ["true", "false", None, None]
    b = spark.createDataFrame([(True,), (False,)], "x boolean")
    assert [r[0] for r in b.select(fn.cast_bool_to_text("x")).collect()] == ["true", "false"]


def test_last_day(spark):
    df = spark.createDataFrame([("2024-02-10",), ("2023-11-30",)], "d string").select(
        F.col("d").cast("date").alias("d")
    )
    out = df.select(
        fn.last_day("d", "month").alias("m"), fn.last_day("d", "quarter").alias("q"),
        fn.last_day("d", "year").alias("y"),
    ).collect()
    assert [tuple(r) for r in out] == [
        (dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 12, 31)),
        (dt.date(2023, 11, 30), dt.date(2023, 12, 31), dt.date(2023, 12, 31)),
    ]


def test_arrays(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    out = df.select(
        "id",
        fn.array_append(fn.array_construct([1, 2, 3]), -77777777).alias("appended"),
        fn.array_concat(fn.array_construct([1, 2, 3]), fn.array_construct([4, 5, -77777777])).alias("cat"),
        fn.array_construct([], "int").alias("empty"),
        fn.element_at(fn.array_construct([10, 20]), 3).alias("oob"),
    ).orderBy("id").collect()
    assert out[0].appended == [1, 2, 3, -77777777]
    assert out[0].cat == [1, 2, 3, 4, 5, -77777777]
    assert out[0].empty == []
    assert out[0].oob is None


def test_hashes(spark):
    import hashlib

    df = spark.createDataFrame([(1, "a|b", None), (1, "a", "b|")], "k long, x string, y string")
    out = df.select(
        fn.hash_text("x").alias("h"),
        fn.half_md5("x", "y").alias("legacy"),
        fn.scd_id("x", "y").alias("sid"),
    ).collect()
    assert out[0].h == hashlib.md5(b"a|b").hexdigest()
    # the legacy hash folds NULL to '' and joins with '|': these two collide
    assert out[0].legacy == out[1].legacy
    assert out[0].sid != out[1].sid
    expected = int(hashlib.md5(b"a|b|").hexdigest()[:16], 16)
    assert int(out[0].legacy) == expected


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("g", 3, "c", True), ("g", 1, "a", False), ("g", 2, None, False), ("h", 1, "z", None)],
        "g string, o int, v string, b boolean",
    )
    out = {r.g: r for r in df.groupBy("g").agg(
        fn.listagg("v", ",", order_by="o").alias("l"),
        fn.group_array("o").alias("arr"),
        fn.bool_or("b").alias("bo"),
        fn.any_value("v").alias("any"),
        fn.exact_avg("o").alias("avg"),
        fn.count_distinct("v").alias("nd"),
    ).collect()}
    assert out["g"].l == "a,c" and out["g"].arr == [1, 2, 3] and out["g"].bo is True
    assert out["g"].avg == 2.0 and out["g"].nd == 2 and out["h"].bo is None
    bare = spark.createDataFrame([("x", None, 1), ("y", "a", 2), ("y", None, 1)], "g string, v string, o int")
    assert {r.g: r.l for r in bare.groupBy("g").agg(fn.listagg("v", ",", order_by="o").alias("l")).collect()} == {"x": None, "y": "a"}
    assert {r.g: r.l for r in fn.listagg_limited(bare, ["g"], "v", ",", "o", 1, alias="l").collect()} == {"x": None, "y": "a"}
    large = spark.createDataFrame([(1, 5e6), (1, 1.5), (2, None)], "g int, p double")
    assert {r.g: r.a for r in large.groupBy("g").agg(fn.exact_avg("p").alias("a")).collect()} == {1: 2500000.75, 2: None}
    limited = fn.listagg_limited(df, ["g"], "v", "-", "o", 1, alias="first")
    assert {r.g: r.first for r in limited.collect()} == {"g": "a", "h": "z"}


def test_casts(spark):
    df = spark.createDataFrame([("12", "x")], "a string, b string")
    r = df.select(fn.safe_cast("a", "bigint").alias("a"), fn.safe_cast("b", "int").alias("b"),
                  fn.cast_to(F.lit(-9223372036854775800), "bigint").alias("big")).first()
    assert (r.a, r.b, r.big) == (12, None, -9223372036854775800)
