from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    """Column as given, or a column name turned into a Column."""
    return value if isinstance(value, Column) else F.col(value)
