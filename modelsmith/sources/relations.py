"""Source and ref scans (A1).

A *source* is a declared external table; a *ref* is another model built by
the toolkit. Both resolve to a lazily planned DataFrame, so Catalyst can push
filters and prune columns into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Tables of the driver's test data directories (one Parquet file each).
TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Scan ``<data_dir>/<name>.parquet``; nothing is read until an action."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def source(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """``source(schema, table)``: a catalog table addressed ``schema.table``."""
    return spark.table(f"{schema}.{table}")


def ref(spark: SparkSession, schema: str, model: str) -> DataFrame:
    """``ref(model)``: the published relation of a model (its pointer view)."""
    return spark.table(f"{schema}.{model}")


def register_views(spark: SparkSession, data_dir: str, names=TEST_TABLES) -> None:
    """Register each Parquet table as a temp view of the same name."""
    for name in names:
        read_table(spark, data_dir, name).createOrReplaceTempView(name)
