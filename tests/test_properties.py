"""Property tests: the single-aggregation operators against their plain
join-based definitions on random small relations (with NULLs and repeats)."""

import datetime as _dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from modelsmith.operators import compare, setops
from modelsmith.operators.incremental import plan_upsert
from modelsmith.operators.snapshot import first_snapshot, plan_snapshot
from tests.conftest import rows

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from(["a", "b"])))
REL = st.lists(ROW, max_size=8)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "k int, v string"


@SETTINGS
@given(a=REL, b=REL)
def test_diff_equals_anti_join_definition(spark, a, b):
    da, db = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    assert tuple(compare.rows_different(da, db).first()) == tuple(compare.rows_different_by_join(da, db).first())


@SETTINGS
@given(a=REL, b=REL)
def test_set_ops_equal_spark_builtins(spark, a, b):
    da, db = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    assert rows(setops.except_distinct(da, db)) == rows(da.subtract(db))
    assert rows(setops.intersect_distinct(da, db)) == rows(da.intersect(db))


@SETTINGS
@given(old=REL, new=REL)
def test_upsert_invariants(spark, old, new):
    d_old, d_new = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    out = rows(plan_upsert(d_old, d_new, "k"))
    new_keys = {k for k, _ in new if k is not None}
    expected = [r for r in old if r[0] is None or r[0] not in new_keys] + list(new)
    assert out == sorted(expected, key=repr)


# ----------------------------------------------------------------- snapshots

_DAY = {d: _dt.datetime(2024, 1, d) for d in range(1, 5)}
AS0, AS1 = _dt.datetime(2024, 2, 1), _dt.datetime(2024, 3, 1)
SRC = st.dictionaries(st.integers(0, 5), st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, 3])),
                      max_size=6)
SNAP_SCHEMA = "id long, name string, updated_at timestamp_ntz"


def _brute(src0, src1, strategy, hard):
    out = []
    for k, (name, d) in src0.items():
        start0 = _DAY[d] if strategy == "timestamp" else AS0
        live = (k, name, _DAY[d], start0)
        if k in src1:
            name1, d1 = src1[k]
            start1 = _DAY[d1] if strategy == "timestamp" else AS1
            changed = (_DAY[d1] > start0) if strategy == "timestamp" else (name1 != name)
            if changed:
                out += [live + (start1,), (k, name1, _DAY[d1], start1, None)]
            else:
                out.append(live + (None,))
        else:
            out.append(live + ((AS1,) if hard else (None,)))
    for k, (name1, d1) in src1.items():
        if k not in src0:
            start1 = _DAY[d1] if strategy == "timestamp" else AS1
            out.append((k, name1, _DAY[d1], start1, None))
    return sorted(out, key=repr)


@SETTINGS
@given(src0=SRC, src1=SRC, strategy=st.sampled_from(["timestamp", "check"]), hard=st.booleans())
def test_snapshot_against_brute_force(spark, src0, src1, strategy, hard):
    def frame(src):
        return spark.createDataFrame([(k, n, _DAY[d]) for k, (n, d) in src.items()], SNAP_SCHEMA)

    kw = {"updated_at": "updated_at"} if strategy == "timestamp" else {"check_cols": ["name"]}
    t0 = first_snapshot(frame(src0), "id", strategy, as_of=AS0.isoformat(" "), **kw)
    t1 = plan_snapshot(t0, frame(src1), "id", strategy, as_of=AS1.isoformat(" "),
                       invalidate_hard_deletes=hard, **kw)
    got = rows(t1, "id", "name", "updated_at", "valid_from", "valid_to")
    assert got == _brute(src0, src1, strategy, hard)
    ids = [r.scd_id for r in t1.collect()]
    assert len(ids) == len(set(ids))


@SETTINGS
@given(a=REL, b=REL)
def test_plain_equality_diff_equals_anti_join_definition(spark, a, b):
    da, db = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    got = compare.rows_different(da, db, null_safe=False).first()
    want = compare.rows_different_by_join(da, db, null_safe=False).first()
    assert tuple(got) == tuple(want)
