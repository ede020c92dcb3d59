"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver contract of ``__spark_entry__``."""

import duckdb
import pytest

import __spark_entry__ as entry
from modelsmith import plans
from tools.oracle_check import _key, _norm, _type_eq

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ROWS_ONLY = {"fn_now", "column_stats_sketch"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "name", "num_parts", "avg_price", "updated_at"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = plans.queries(), plans.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY
    assert set(q) <= set(entry.queries()) and set(o) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    if name in ROWS_ONLY:
        assert len(srows) > 0
        return
    rel = duck.sql(plans.oracle_sql()[name])
    assert cols == sorted(rel.columns)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert all(_type_eq(stypes[c], dtypes[c]) for c in cols), (stypes, dtypes)
    drows = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=_key)
    assert srows == drows
