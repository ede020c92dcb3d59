"""Registered queries: one per operator of the inventory, each a function
``(spark, data_dir) -> DataFrame`` over the test tables, plus DuckDB oracles."""

from __future__ import annotations

from modelsmith.plans import (  # noqa: F401  (modules register their queries)
    build_queries,
    check_queries,
    flagship,
    function_queries,
    relational,
    snapshot_queries,
    upkeep_queries,
    upkeep_store_queries,
)
from modelsmith.plans._registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
