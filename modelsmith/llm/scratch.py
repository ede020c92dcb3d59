"""Staging of intermediate results in the cluster's shared folder.

A staged frame is written once as Parquet below ``spark.checkpoint.dir`` and
read back: its lineage is cut, a lost executor costs no recomputation of what
came before, and the planner sees its true size. The files stay until the owner
of the folder clears it; :func:`release` removes those of this session early.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from modelsmith.session import ensure_checkpoint_dir

_STAGED: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset on a local master."""
    folder = ensure_checkpoint_dir(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="run-"))
    return folder


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` below the shared folder and return the frame that reads it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/modelsmith-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete what this driver staged (call it once the results are written); the number of folders."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
