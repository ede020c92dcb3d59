"""Sends this package's code to the Python workers.

The operators' Arrow functions are pickled by reference, so that a worker keeps
one copy of their modules and of the tables in them from task to task. A cluster
on which the package is not installed gets it through ``addPyFile``.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SENT: set[str] = set()  # application ids


def ship(spark: SparkSession) -> None:
    """Once an application: the source files of the package, as a zip that Spark hands to its executors."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    target = os.path.join(tempfile.mkdtemp(prefix="run-"), f"{os.path.basename(_ROOT)}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(_ROOT):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(_ROOT)))
    context.addPyFile(target)
    _SENT.add(context.applicationId)


def map_arrow(frame: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package's code on the workers."""
    ship(frame.sparkSession)
    return frame.mapInArrow(function, schema)
