"""Session settings the toolkit expects, and the shared scratch location.

On a cluster the session already exists and carries its own settings; the
toolkit only reads them. ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every build relies on. UTC keeps timestamp_ntz <-> timestamp casts
# (date_trunc returns a zoned timestamp) stable; AQE coalesces small shuffle
# partitions, splits skewed join partitions and turns joins into broadcasts only
# after it has measured the real size of a side.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    warehouse: str | None = None,
    checkpoint_dir: str | None = None,
    app_name: str = "modelsmith",
    extra: dict | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MODELSMITH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir:
        ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session. A fallback is applied only when the
    session names none, which happens in local tests.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    if fallback:
        spark.sparkContext.setCheckpointDir(fallback)
        return spark.sparkContext.getCheckpointDir()
    return None
