import os
import uuid

import pytest
from pyspark.sql import functions as F

from modelsmith.operators.project import Project, SnapshotInputError
from modelsmith.operators.publish import Layout
from modelsmith.operators.schema_change import SchemaChangeError
from tests.conftest import rows


@pytest.fixture()
def project(spark):
    return Project(spark, f"t_{uuid.uuid4().hex[:8]}")


def _df(spark, data, schema="id long, v string"):
    return spark.createDataFrame(data, schema)


def test_table_versions_swap_and_retention(spark, project):
    project.table("m", _df(spark, [(1, "a")]))
    assert project.publisher.current_version("m") == 1
    project.table("m", _df(spark, [(1, "b"), (2, "c")]))
    planned_on_v2 = project.ref("m")
    assert rows(planned_on_v2) == [(1, "b"), (2, "c")]
    assert project.publisher.versions("m") == [1, 2]
    project.table("m", _df(spark, [(3, "d")]))
    assert project.publisher.versions("m") == [2, 3]          # n-2 dropped, previous kept
    assert rows(project.ref("m")) == [(3, "d")]
    assert rows(planned_on_v2) == [(1, "b"), (2, "c")]         # a reader of the old version still works


def test_partitioned_table_keeps_rows_and_prunes(spark, project):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    layout = Layout(partition_by=["o_orderstatus"], order_by=["o_orderdate", "o_orderkey"])
    project.table("orders_p", orders, layout=layout)
    project.table("orders_p", orders, layout=layout)            # swap of a partitioned build
    ref = project.ref("orders_p")
    assert ref.count() == orders.count()
    plan = ref.filter(F.col("o_orderstatus") == "F")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan and "= F)" in plan


def test_comments_reach_the_catalog(spark, project):
    project.table("c", _df(spark, [(1, "a")]), comment="a table", column_comments={"id": "the key"})
    cols = {c.name: c.description for c in spark.catalog.listColumns(f"{project.publisher.schema}.c")}
    assert cols["id"] == "the key"
    desc = spark.sql(f"DESCRIBE TABLE EXTENDED {project.publisher.qualified('c')}").collect()
    assert any(r.col_name == "Comment" and r.data_type == "a table" for r in desc)


def test_view_model_then_table(spark, project):
    project.table("base", _df(spark, [(1, "a"), (2, "b")]))
    schema = project.publisher.schema
    v = project.view("v", f"SELECT id, upper(v) AS v FROM {schema}.base WHERE id > 1")
    assert rows(v) == [(2, "B")]
    project.view("v", f"SELECT id FROM {schema}.base")
    assert project.ref("v").columns == ["id"]                   # view replaced, new column list


def test_incremental_append_in_place_with_highwater(spark, project):
    from modelsmith.operators.incremental import high_water_filter

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "value")
    first = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))

    def model(ctx):
        src = first if not ctx.is_incremental else events
        return high_water_filter(src, ctx.this, ["event_id", "ts"]) if ctx.is_incremental else src

    project.incremental("ev", model)
    assert project.ref("ev").count() == first.count()
    project.incremental("ev", model)
    assert project.publisher.current_version("ev") == 1          # appended in place, no rewrite
    assert rows(project.ref("ev")) == rows(events)
    project.incremental("ev", model)                              # nothing new: no change
    assert project.ref("ev").count() == events.count()


def test_upsert_null_keys_duplicates_and_empty_batch(spark, project):
    project.incremental("u", _df(spark, [(1, "old"), (2, "old"), (None, "null-old")]), unique_key="id")
    new = _df(spark, [(2, "new"), (2, "dup"), (None, "null-new"), (3, "new")])
    project.incremental("u", new, unique_key="id")
    assert rows(project.ref("u")) == sorted(
        [(1, "old"), (2, "new"), (2, "dup"), (None, "null-old"), (None, "null-new"), (3, "new")], key=repr
    )
    before = rows(project.ref("u"))
    project.incremental("u", _df(spark, []), unique_key="id")
    assert rows(project.ref("u")) == before


def test_upsert_composite_key_plan(spark, project):
    from modelsmith.operators.incremental import plan_upsert

    old = spark.range(100).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    new = spark.range(50, 60).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    plan = plan_upsert(old, new, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "NestedLoop" not in plan
    assert plan_upsert(old, new, ["a", "b"]).count() == 100


def test_schema_policies_on_the_builder(spark, project):
    project.incremental("s", _df(spark, [(1, "a")]), unique_key="id")
    drifted = spark.createDataFrame([(2, "x")], "id long, w string")
    with pytest.raises(SchemaChangeError):
        project.incremental("s", drifted, unique_key="id", on_schema_change="fail")
    assert rows(project.ref("s")) == [(1, "a")]
    project.incremental("s", drifted, unique_key="id", on_schema_change="append_new_columns")
    assert project.ref("s").columns == ["id", "v", "w"]
    assert rows(project.ref("s")) == [(1, "a", None), (2, None, "x")]
    project.incremental("s", drifted, unique_key="id", on_schema_change="sync_all_columns")
    assert project.ref("s").columns == ["id", "w"]
    widened = spark.createDataFrame([(3, 1.5)], "id long, w double")
    project.incremental("s", widened, on_schema_change="sync_all_columns")
    assert dict(project.ref("s").dtypes)["w"] == "string"      # number meets string: string


def test_full_refresh_and_update_column(spark, project):
    project.incremental("f", _df(spark, [(1, "a")]))
    project.incremental("f", _df(spark, [(5, "z")]), full_refresh=True)
    assert rows(project.ref("f")) == [(5, "z")]
    project.update_column("f", "v", F.upper("v"), F.col("id") == 5)
    assert rows(project.ref("f")) == [(5, "Z")]


def _src(spark, data):
    return spark.createDataFrame(data, "id long, name string, updated_at timestamp_ntz")


def _ts(s):
    import datetime as dt

    return dt.datetime.fromisoformat(s)


def test_snapshot_timestamp_runs_and_rerun_is_idempotent(spark, project):
    run1 = _src(spark, [(1, "a", _ts("2024-01-01")), (2, "b", _ts("2024-01-01"))])
    project.snapshot("h", run1, "id", updated_at="updated_at", as_of="2024-01-02 00:00:00")
    run2 = _src(spark, [(1, "a2", _ts("2024-02-01")), (2, "b", _ts("2024-01-01")), (3, "c", _ts("2024-02-01"))])
    project.snapshot("h", run2, "id", updated_at="updated_at", as_of="2024-02-02 00:00:00")
    after = rows(project.ref("h"), "id", "name", "valid_from", "valid_to")
    assert after == sorted([
        (1, "a", _ts("2024-01-01"), _ts("2024-02-01")),
        (1, "a2", _ts("2024-02-01"), None),
        (2, "b", _ts("2024-01-01"), None),
        (3, "c", _ts("2024-02-01"), None),
    ], key=repr)
    project.snapshot("h", run2, "id", updated_at="updated_at", as_of="2024-03-01 00:00:00")
    assert rows(project.ref("h"), "id", "name", "valid_from", "valid_to") == after


def test_snapshot_hard_delete_and_return_keeps_history(spark, project):
    t = _ts("2024-01-01")
    kw = dict(unique_key="id", updated_at="updated_at", invalidate_hard_deletes=True)
    project.snapshot("d", _src(spark, [(1, "a", t), (2, "b", t)]), as_of="2024-01-05 00:00:00", **kw)
    project.snapshot("d", _src(spark, [(1, "a", t)]), as_of="2024-01-10 00:00:00", **kw)
    # key 2 comes back unchanged, with the same updated_at as before its deletion
    project.snapshot("d", _src(spark, [(1, "a", t), (2, "b", t)]), as_of="2024-01-20 00:00:00", **kw)
    got = rows(project.ref("d").filter("id = 2"), "name", "valid_from", "valid_to")
    assert got == sorted([("b", t, _ts("2024-01-10")), ("b", _ts("2024-01-10"), None)], key=repr)
    ids = [r.scd_id for r in project.ref("d").filter("id = 2").collect()]
    assert len(set(ids)) == 2


def test_snapshot_check_strategy_null_is_a_change(spark, project):
    kw = dict(unique_key="id", strategy="check", check_cols=["name"])
    project.snapshot("c", _src(spark, [(1, "a", None), (2, "b", None)]), as_of="2024-01-01 00:00:00",
                     validate=False, **kw)
    project.snapshot("c", _src(spark, [(1, None, None), (2, "b", None)]), as_of="2024-02-01 00:00:00",
                     validate=False, **kw)
    live = rows(project.ref("c").filter("valid_to IS NULL"), "id", "name", "valid_from")
    assert live == sorted([(1, None, _ts("2024-02-01")), (2, "b", _ts("2024-01-01"))], key=repr)


def test_snapshot_rejects_duplicate_and_null_keys(spark, project):
    dup = _src(spark, [(1, "a", _ts("2024-01-01")), (1, "b", _ts("2024-01-02"))])
    with pytest.raises(SnapshotInputError):
        project.snapshot("bad", dup, "id", updated_at="updated_at")
    nulls = _src(spark, [(None, "a", _ts("2024-01-01"))])
    with pytest.raises(SnapshotInputError):
        project.snapshot("bad", nulls, "id", updated_at="updated_at")


def test_seed_from_csv(spark, project, scratch):
    path = os.path.join(scratch, f"seed_{uuid.uuid4().hex[:6]}.csv")
    with open(path, "w") as fh:
        fh.write(
            "key,val1,val2,flag,day,at,clock,note\n"
            "a,1,3000000000,true,2020-01-01,2020-01-01T01:02:03,10:20,\"x|y\"\n"
            "b,2,,false,2020-01-02,2020-01-02 04:05:06,11:30,\"has, comma\"\n"
            "c,3,1.5,,2020-01-03,2020-01-03,12:00,\n"
        )
    seed = project.seed("s", path)
    types = dict(seed.dtypes)
    assert types == {"key": "string", "val1": "bigint", "val2": "double", "flag": "boolean", "day": "date",
                     "at": "timestamp_ntz", "clock": "string", "note": "string"}
    got = {r.key: r for r in seed.collect()}
    assert got["a"].note == "x|y" and got["b"].note == "has, comma" and got["c"].note is None
    assert got["b"].val2 is None and got["a"].val2 == 3000000000.0 and got["c"].flag is None
    typed = project.seed("s2", path, column_types={"val1": "Int32", "clock": "String", "val2": "Nullable(Float64)"})
    assert dict(typed.dtypes)["val1"] == "int"


def test_partition_scoped_upsert_rewrites_only_touched_partitions(spark, project):
    import datetime as dt

    data = [(i, f"v{i}", dt.date(2024, 1, 1 + i % 3)) for i in range(9)]
    df = spark.createDataFrame(data, "id long, v string, day date")
    layout = Layout(partition_by=["day"], order_by=["id"])
    project.incremental("pu", df, unique_key="id", layout=layout)
    table = project.publisher.version_table("pu", 1)
    files_before = {d: set(spark.table(table).filter(F.col("day") == d).inputFiles())
                    for d in (dt.date(2024, 1, 1), dt.date(2024, 1, 2))}
    new = spark.createDataFrame([(1, "new1", dt.date(2024, 1, 2)), (20, "new20", dt.date(2024, 1, 2))],
                                "id long, v string, day date")
    project.incremental("pu", new, unique_key="id", layout=layout, partition_scoped=True)
    assert project.publisher.current_version("pu") == 1          # in place, no new version
    got = rows(project.ref("pu"), "id", "v")
    expected = sorted([(i, f"v{i}") for i in range(9) if i != 1] + [(1, "new1"), (20, "new20")], key=repr)
    assert got == expected
    untouched = set(spark.table(table).filter(F.col("day") == dt.date(2024, 1, 1)).inputFiles())
    assert untouched == files_before[dt.date(2024, 1, 1)]
    touched = set(spark.table(table).filter(F.col("day") == dt.date(2024, 1, 2)).inputFiles())
    assert touched != files_before[dt.date(2024, 1, 2)]


def test_bucketed_target_upsert_does_not_shuffle_the_target(spark, project):
    from modelsmith.operators.incremental import plan_upsert

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = spark.range(2000).select(F.col("id"), (F.col("id") * 2).alias("v"))
        layout = Layout(buckets=4, bucket_by=["id"], order_by=["id"])
        project.table("bk", old, layout=layout)
        new = spark.range(1990, 2010).select(F.col("id"), F.lit(-1).cast("long").alias("v"))
        plan = plan_upsert(project.ref("bk"), new, "id")._jdf.queryExecution().executedPlan().toString()
        anti = plan[plan.index("LeftAnti"):]
        target_side = anti[: anti.index("FileScan")]
        assert "Exchange" not in target_side.split("\n")[1], plan
        assert plan_upsert(project.ref("bk"), new, "id").count() == 2010
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upper_case_model_name_and_catalog(spark, project):
    project.table("Seeds_Upper", _df(spark, [(i, f"n{i}") for i in range(10)]),
                  comment="ten rows", column_comments={"id": "row id"})
    assert project.ref("Seeds_Upper").count() == 10
    project.table("Seeds_Upper", _df(spark, [(i, f"n{i}") for i in range(10)]))
    assert project.publisher.versions("Seeds_Upper") == [1, 2]
    project.view("v_upper", f"SELECT id FROM {project.publisher.schema}.seeds_upper")
    cat = {(r.table_name, r.column_name): r for r in project.catalog().collect()}
    assert cat[("seeds_upper", "id")].row_count == 10
    assert cat[("seeds_upper", "id")].column_index == 1
    assert cat[("v_upper", "id")].table_type == "view"
    assert cat[("seeds_upper", "v")].max_value == "n9"


def test_snapshot_new_source_column_and_check_all(spark, project):
    kw = dict(unique_key="id", strategy="check", check_cols="all", validate=False)
    project.snapshot("n", _src(spark, [(1, "a", None), (2, "b", None)]), as_of="2024-01-01 00:00:00", **kw)
    wider = spark.createDataFrame([(1, "a", None, "x"), (2, "b", None, None)],
                                  "id long, name string, updated_at timestamp_ntz, extra string")
    project.snapshot("n", wider, as_of="2024-02-01 00:00:00", **kw)
    out = rows(project.ref("n"), "id", "name", "extra", "valid_to")
    # key 1 changed (extra: NULL -> 'x'), key 2 did not (NULL <=> NULL)
    assert out == sorted([(1, "a", None, _ts("2024-02-01")), (1, "a", "x", None), (2, "b", None, None)], key=repr)


def test_drop_orphans(spark, project):
    project.table("o", _df(spark, [(1, "a")]))
    pub = project.publisher
    pub.write_version("o", _df(spark, [(2, "b")]))           # written, never swapped
    pub.stage("o", _df(spark, [(3, "c")]))                    # staging left behind
    dropped = pub.drop_orphans()
    assert "o__v2" in dropped and any("__stage_" in d for d in dropped)
    assert pub.versions("o") == [1] and rows(project.ref("o")) == [(1, "a")]


def test_inserts_only_and_unchanged_sync(spark, project):
    schema = "user_id_current_time string, platform string"
    project.incremental("ins", spark.createDataFrame([("u1", "p" * 20)], schema), unique_key="user_id_current_time",
                        inserts_only=True, on_schema_change="sync_all_columns")
    project.incremental("ins", spark.createDataFrame([("u1", "p" * 18)], schema), unique_key="user_id_current_time",
                        inserts_only=True, on_schema_change="sync_all_columns")
    assert rows(project.ref("ins")) == [("u1", "p" * 18), ("u1", "p" * 20)]     # duplicates kept
    assert project.publisher.current_version("ins") == 1                      # appended in place


def test_plain_table_is_kept_as_the_target(spark, project):
    schema = project.publisher.schema
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    for name in ("pt_up", "pt_add", "pt_full"):
        old.write.saveAsTable(f"{schema}.{name}")
    project.incremental("pt_up", _df(spark, [(3, "new")]), unique_key="id")
    assert rows(project.ref("pt_up"), "id", "v") == [(1, "a"), (2, "b"), (3, "new")]
    project.incremental("pt_add", _df(spark, [(3, "new")]))
    assert project.ref("pt_add").count() == 4
    project.incremental("pt_full", _df(spark, [(3, "new")]), unique_key="id", full_refresh=True)
    assert rows(project.ref("pt_full"), "id", "v") == [(3, "new")]
    assert not [t for t in project.publisher._tables() if "__stage_" in t]


def test_snapshot_goes_on_from_a_plain_table(spark, project):
    kw = dict(unique_key="id", updated_at="updated_at")
    runs = _snap_runs(spark)
    project.snapshot("snap_src", _src(spark, runs[0]), as_of="2024-02-01 00:00:00", **kw)
    project.ref("snap_src").write.saveAsTable(f"{project.publisher.schema}.snap_plain")
    project.snapshot("snap_plain", _src(spark, runs[1]), as_of="2024-02-02 00:00:00", **kw)
    project.snapshot("snap_src", _src(spark, runs[1]), as_of="2024-02-02 00:00:00", **kw)
    cols = ("id", "name", "updated_at", "scd_id", "valid_from", "valid_to")
    assert rows(project.ref("snap_plain"), *cols) == rows(project.ref("snap_src"), *cols)


def test_table_model_replaces_plain_table_and_view_model(spark, project):
    schema = project.publisher.schema
    spark.createDataFrame([(9, "old")], "id long, v string").write.saveAsTable(f"{schema}.plain")
    project.table("plain", _df(spark, [(1, "new")]))
    assert rows(project.ref("plain")) == [(1, "new")]
    project.view("vm", f"SELECT 1 AS one")
    project.incremental("vm", _df(spark, [(2, "x")]), unique_key="id")   # a view is rebuilt as a table
    assert rows(project.ref("vm")) == [(2, "x")] and project.publisher.current_version("vm") == 1


def test_bucketed_snapshot_does_not_shuffle_live_rows(spark, project):
    from modelsmith.operators.snapshot import plan_snapshot

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = spark.range(3000).select(F.col("id"), F.lit("a").alias("name"),
                                       F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"))
        layout = Layout(buckets=4, bucket_by=["id"])
        project.snapshot("bs", src, "id", updated_at="updated_at", layout=layout, validate=False)
        plan = plan_snapshot(project.ref("bs"), src, "id", updated_at="updated_at", as_of="2024-02-01")
        text = plan._jdf.queryExecution().executedPlan().toString()
        join = text[text.index("FullOuter"):]
        live_side = join[: join.index("FileScan")]
        assert "Exchange" not in live_side and "Bucketed: true" in join, text   # live rows stay put
        assert "Exchange hashpartitioning" in join[join.index("FileScan"):]      # the source moves
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_swap_materializations_view_table_view_and_empty(spark, project):
    schema = project.publisher.schema
    project.table("base2", _df(spark, [(1, "a"), (2, "b")]))
    project.view("swap", f"SELECT id FROM {schema}.base2", comment="as a view")
    project.table("swap", project.ref("base2").select("id", "v"))          # view -> table
    assert project.ref("swap").columns == ["id", "v"] and project.publisher.current_version("swap") == 1
    project.view("swap", f"SELECT v FROM {schema}.base2")                   # table -> view
    assert project.ref("swap").columns == ["v"] and project.publisher.versions("swap") == []
    empty = project.table("empty", _df(spark, []))                          # an empty model builds
    assert empty.count() == 0 and empty.columns == ["id", "v"]


def test_sink_format_is_configurable(spark, project):
    layout = Layout(format="orc", order_by=["id"])
    project.table("orc_model", _df(spark, [(2, "b"), (1, "a")]), layout=layout)
    table = project.publisher.version_table("orc_model", 1)
    provider = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert provider.get("Provider", "").lower() == "orc"
    assert rows(project.ref("orc_model")) == [(1, "a"), (2, "b")]


def test_seed_inference_mixtures(spark, project, scratch):
    from modelsmith.sources.seeds import infer_types

    cols = {
        "ints": ["1", "", "-3"], "huge": ["1", "123456789012345678901234", "2"],
        "mixed_num": ["1", "2.5", "1e3"], "dates_ts": ["2020-01-01", "2020-01-02 03:04:05", ""],
        "dates_ints": ["2020-01-01", "7", "8"], "bools": ["true", "FALSE", ""],
        "bools_ints": ["true", "1", "0"], "empty": ["", "", ""], "clock": ["10:20", "11:00", ""],
    }
    data = list(zip(*cols.values()))
    text = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    assert infer_types(text) == {
        "ints": "bigint", "huge": "decimal(38,0)", "mixed_num": "double", "dates_ts": "timestamp_ntz",
        "dates_ints": "string", "bools": "boolean", "bools_ints": "string", "empty": "string",
        "clock": "string",
    }


def _snap_runs(spark):
    t = _ts
    return [
        [(1, "a", t("2024-01-01")), (2, "b", t("2024-01-01")), (3, "c", t("2024-01-01"))],
        [(1, "a2", t("2024-01-05")), (2, "b", t("2024-01-01"))],                      # 1 changes, 3 deleted
        [(1, "a2", t("2024-01-05")), (2, "b3", t("2024-01-09")), (3, "c", t("2024-01-01"))],  # 3 returns
        [(1, "a4", t("2024-01-12")), (2, "b3", t("2024-01-09")), (4, "d", t("2024-01-12"))],
    ]


def test_segmented_snapshot_equals_rewritten_snapshot(spark, project):
    kw = dict(unique_key="id", updated_at="updated_at", invalidate_hard_deletes=True)
    for i, data in enumerate(_snap_runs(spark)):
        as_of = f"2024-02-0{i + 1} 00:00:00"
        project.snapshot("full", _src(spark, data), as_of=as_of, **kw)
        project.snapshot("seg", _src(spark, data), as_of=as_of, segmented=True, **kw)
        if i == 2:
            project.compact_snapshot("seg", newest=2)
    cols = ("id", "name", "updated_at", "scd_id", "valid_from", "valid_to")
    assert rows(project.ref("seg"), *cols) == rows(project.ref("full"), *cols)
    closed_runs, live_run = project.publisher.segments("seg")
    assert len(closed_runs) == 2  # the merged segment and the run after it
    # superseded runs keep only their closed rows
    for r in project.publisher.runs("seg"):
        if r != live_run and r in closed_runs:
            t = spark.table(project.publisher.run_table("seg", r))
            assert t.filter("_open").count() == 0


def test_segmented_snapshot_does_not_rewrite_history(spark, project):
    kw = dict(unique_key="id", updated_at="updated_at", segmented=True)
    runs = _snap_runs(spark)
    project.snapshot("h2", _src(spark, runs[0]), as_of="2024-02-01 00:00:00", **kw)
    project.snapshot("h2", _src(spark, runs[1]), as_of="2024-02-02 00:00:00", **kw)
    closed_runs, _ = project.publisher.segments("h2")
    first_closed = closed_runs[-1]
    files = set(spark.table(project.publisher.run_table("h2", first_closed)).filter("NOT _open").inputFiles())
    project.snapshot("h2", _src(spark, runs[2]), as_of="2024-02-03 00:00:00", **kw)
    assert first_closed in project.publisher.segments("h2")[0]
    after = set(spark.table(project.publisher.run_table("h2", first_closed)).filter("NOT _open").inputFiles())
    assert files == after


def test_versioned_snapshot_converts_to_segments(spark, project):
    kw = dict(unique_key="id", updated_at="updated_at")
    runs = _snap_runs(spark)
    project.snapshot("cv", _src(spark, runs[0]), as_of="2024-02-01 00:00:00", **kw)
    project.snapshot("cv", _src(spark, runs[1]), as_of="2024-02-02 00:00:00", segmented=True, **kw)
    project.snapshot("ref_cv", _src(spark, runs[0]), as_of="2024-02-01 00:00:00", **kw)
    project.snapshot("ref_cv", _src(spark, runs[1]), as_of="2024-02-02 00:00:00", **kw)
    cols = ("id", "name", "valid_from", "valid_to")
    assert rows(project.ref("cv"), *cols) == rows(project.ref("ref_cv"), *cols)
    with pytest.raises(ValueError):
        project.snapshot("cv", _src(spark, runs[2]), **kw)
    assert project.publisher.versions("cv") != []          # kept one round for readers
    project.snapshot("cv", _src(spark, runs[2]), as_of="2024-02-03 00:00:00", segmented=True, **kw)
    assert project.publisher.versions("cv") == []


def test_drop_model(spark, project):
    project.table("gone", _df(spark, [(1, "a")]))
    project.table("gone", _df(spark, [(2, "b")]))
    project.snapshot("gone_s", _src(spark, [(1, "a", _ts("2024-01-01"))]), "id", updated_at="updated_at",
                     segmented=True)
    project.drop("gone")
    project.drop("gone_s")
    left = [t.name for t in spark.catalog.listTables(project.publisher.schema) if t.name.startswith("gone")]
    assert left == []


def test_layout_rules_and_no_conf_leak(spark, project):
    with pytest.raises(ValueError):
        Layout(order_by=["a", "b"], primary_key=["b"])
    assert Layout(primary_key=["k"]).order_by == ("k",)
    with pytest.raises(ValueError):
        Layout(buckets=4)
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    df = _df(spark, [(1, "a"), (2, "b")])
    layout = Layout(partition_by=["v"])
    project.incremental("pl", df, unique_key="id", layout=layout)
    project.incremental("pl", _df(spark, [(1, "a")]), unique_key="id", layout=layout, partition_scoped=True)
    assert spark.conf.get(key, None) == before
    assert rows(project.ref("pl")) == [(1, "a"), (2, "b")]


def test_seed_declared_zone(spark, project, scratch):
    path = os.path.join(scratch, f"tz_{uuid.uuid4().hex[:6]}.csv")
    with open(path, "w") as fh:
        fh.write("k,at\n1,2024-01-01 12:00:00\n")
    seed = project.seed("tz", path, column_types={"at": "DateTime('Asia/Istanbul')"})
    r = seed.select(F.col("at").cast("string").alias("s")).first()
    assert r.s == "2024-01-01 09:00:00"      # 12:00 in Istanbul (UTC+3) is 09:00 UTC; session is UTC
    assert dict(seed.dtypes)["at"] == "timestamp"


def test_catalog_sees_segmented_snapshot_as_table(spark, project):
    project.snapshot("cs", _src(spark, [(1, "a", _ts("2024-01-01"))]), "id", updated_at="updated_at",
                     segmented=True)
    cat = {(r.table_name, r.column_name): r for r in project.catalog().collect()}
    assert cat[("cs", "id")].table_type == "table" and cat[("cs", "id")].row_count == 1
    assert ("cs", "_open") not in cat


def test_snapshot_returning_key_gets_a_new_id_with_the_flag_off(spark, project):
    t = _ts("2024-01-01")
    for name, more in (("ro", {}), ("rs", {"segmented": True})):
        kw = dict(unique_key="id", updated_at="updated_at", **more)
        both = _src(spark, [(1, "a", t), (2, "b", t)])
        project.snapshot(name, both, as_of="2024-01-05 00:00:00", **kw)
        project.snapshot(name, _src(spark, [(1, "a", t)]), as_of="2024-01-10 00:00:00", invalidate_hard_deletes=True, **kw)
        project.snapshot(name, both, as_of="2024-01-20 00:00:00", **kw)
        got = project.ref(name).where("id = 2").collect()
        assert len(got) == 2 and len({r.scd_id for r in got}) == 2
        assert sorted([(r.valid_from, r.valid_to) for r in got], key=str) == sorted(
            [(t, _ts("2024-01-10")), (_ts("2024-01-10"), None)], key=str)


def test_snapshot_shuffles_each_input_once(spark):
    from modelsmith.operators.snapshot import first_snapshot, plan_snapshot

    t = _ts("2024-01-01")
    src = _src(spark, [(1, "a", t)])
    target = first_snapshot(src, "id", updated_at="updated_at").withColumn("valid_to", F.when(F.rand() < 2, F.col("valid_to")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_snapshot(target, src, "id", updated_at="updated_at", invalidate_hard_deletes=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # live rows, source, and the aggregated closes
    assert plan.count("Exchange hashpartitioning") <= 3, plan


def test_partition_scoped_upsert_refuses_a_key_from_another_partition(spark, project):
    layout = Layout(partition_by=["g"])
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, g string")
    project.incremental("pm", old, unique_key="id", layout=layout)
    kw = dict(unique_key="id", layout=layout, partition_scoped=True)
    for moved in ([(1, "b")], [(3, "b")]):
        with pytest.raises(ValueError, match="partition"):
            project.incremental("pm", spark.createDataFrame(moved, "id int, g string"), **kw)
    assert rows(project.ref("pm")) == rows(old)
    project.incremental("pm", spark.createDataFrame([(3, None), (4, "b")], "id int, g string"), **kw)
    assert rows(project.ref("pm")) == sorted([(1, "a"), (2, "a"), (3, None), (4, "b")], key=repr)


def test_unchanged_array_column_passes_under_fail(spark, project):
    model = spark.sql("SELECT id, array(id, id + 1) AS a FROM range(3)")
    project.incremental("af", model, on_schema_change="fail")
    project.incremental("af", model, on_schema_change="fail")
    assert project.ref("af").count() == 6


def test_values_that_do_not_fit_are_refused(spark, project):
    from modelsmith.operators.schema_change import SchemaChangeError

    project.incremental("vf", spark.createDataFrame([(1, 5)], "id int, v int"))
    with pytest.raises(Exception, match="cannot hold"):
        project.incremental("vf", spark.createDataFrame([(2, 1.7)], "id int, v double"))
    project.incremental("vf", spark.createDataFrame([(2, 2.0)], "id int, v double"))
    assert rows(project.ref("vf")) == [(1, 5), (2, 2)]
    project.incremental("vl", spark.createDataFrame([(9007199254740993,)], "id bigint"))
    for policy in ("append_new_columns", "sync_all_columns"):
        with pytest.raises(SchemaChangeError, match="no type holds"):
            project.incremental("vl", spark.createDataFrame([(1.5,)], "id double"), on_schema_change=policy)
    assert rows(project.ref("vl")) == [(9007199254740993,)]


def test_layout_and_comments_outlive_the_call(spark, project):
    layout = Layout(partition_by=["g"], order_by=["id"])
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id int, g string")
    project.incremental("keep", frame, layout=layout, comment="it's kept", column_comments={"id": "the id"})

    def facts():
        pub = project.publisher
        stored = pub.version_table("keep", pub.current_version("keep"))
        described = spark.sql(f"DESCRIBE TABLE {stored}").collect()
        parts = [r.col_name for r in described[[r.col_name for r in described].index("# Partition Information"):]][2:]
        comment, columns = pub.stored_comments("keep")
        return parts, comment, columns

    first = facts()
    assert first == (["g"], "it's kept", {"id": "the id"})
    project.incremental("keep", frame)  # append without a layout
    assert facts() == first and project.ref("keep").count() == 4
    project.update_column("keep", "id", "id + 10", "g = 'a'")
    assert facts() == first and rows(project.ref("keep"), "id") == [(11,), (11,), (2,), (2,)]
    project.incremental("keep", frame, comment="new words", column_comments={"g": "the group"})
    assert facts() == (["g"], "new words", {"id": "the id", "g": "the group"})
    assert project.ref("keep").count() == 6
    project.table("keep", frame.select("id"))  # the layout's column is gone
    assert project.publisher.stored_layout("keep", ["id"]) is None and project.ref("keep").count() == 2
