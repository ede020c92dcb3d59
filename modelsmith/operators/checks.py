"""Data checks (C1-C4): each check returns its *failing rows* as a DataFrame;
:func:`check_result` turns failing rows into the one-row verdict
``failures, should_warn, should_error`` under severity thresholds.

Every check is a single distributed plan (anti join or grouped count); none
collects rows to the driver.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelsmith.functions._util import as_col


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values (non-NULL) with no parent row; duplicates are kept.

    Written as a left anti join, never ``NOT IN (subquery)``: ``NOT IN`` returns
    nothing once the parent holds a NULL, and plans as a broadcast or nested
    loop join. The parent keys are made distinct first; that aggregation is
    hash-partitioned on the key, so the join reuses it and a hot parent key is
    collapsed map-side before the shuffle.
    """
    kids = child.select(as_col(column).alias("from_field")).filter(F.col("from_field").isNotNull())
    keys = parent.select(as_col(field).alias("to_field")).filter(F.col("to_field").isNotNull()).distinct()
    return kids.join(keys, kids.from_field == keys.to_field, "left_anti")


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Key values (all parts non-NULL) that occur more than once, with counts."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    present = df.select(*cols)
    for c in cols:
        present = present.filter(F.col(c).isNotNull())
    return (
        present.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, column: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Rows where ``column`` is NULL (projected to ``keep`` + the column)."""
    cols = list(keep or []) + ([column] if column not in (keep or []) else [])
    return df.filter(F.col(column).isNull()).select(*cols)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the accepted list, with their counts (NULL passes)."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(~F.col("value_field").isin(list(values)))


_OPS = {
    "=": operator.eq, "==": operator.eq, "!=": operator.ne, "<>": operator.ne,
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
}
_THRESHOLD = re.compile(r"^\s*(==|=|!=|<>|>=|<=|>|<)\s*(-?\d+(?:\.\d+)?)\s*$")


def parse_threshold(spec: str):
    """``'!= 0'``, ``'>10'`` ... → (operator function, number)."""
    m = _THRESHOLD.match(spec)
    if not m:
        raise ValueError(f"bad threshold {spec!r}; expected '<op> <number>'")
    num = float(m.group(2)) if "." in m.group(2) else int(m.group(2))
    return _OPS[m.group(1)], num


def check_result(
    failing_rows: DataFrame,
    fail_calc: Column | str | None = None,
    warn_if: str = "!= 0",
    error_if: str = "!= 0",
    limit: int | None = None,
) -> DataFrame:
    """One row: ``failures``, and ``should_warn`` / ``should_error`` as the
    text ``'true'`` / ``'false'``. ``fail_calc`` is an aggregate Column over the
    failing rows (default ``count(*)``); ``limit`` caps the rows it looks at,
    which is part of the check's definition."""
    rows = failing_rows.limit(limit) if limit is not None else failing_rows
    if isinstance(fail_calc, str):
        calc = F.expr(fail_calc)
    else:
        calc = fail_calc if fail_calc is not None else F.count(F.lit(1))
    summary = rows.agg(calc.alias("failures"))
    warn_op, warn_n = parse_threshold(warn_if)
    err_op, err_n = parse_threshold(error_if)

    def verdict(op, n):
        return F.when(op(F.col("failures"), F.lit(n)), F.lit("true")).otherwise(F.lit("false"))

    return summary.select(
        "failures",
        verdict(warn_op, warn_n).alias("should_warn"),
        verdict(err_op, err_n).alias("should_error"),
    )


def singular(failing_rows: DataFrame, **kwargs) -> DataFrame:
    """A singular check: any DataFrame of failing rows; passes when empty."""
    return check_result(failing_rows, **kwargs)


class CheckFailed(AssertionError):
    """Raised by :func:`enforce` when a check reaches error severity."""


def evaluate(failing_rows: DataFrame, **kwargs) -> tuple[str, object]:
    """Run a check and return ``(status, failures)`` with status ``'pass'``,
    ``'warn'`` or ``'error'``. Only the one-row verdict reaches the driver."""
    row = check_result(failing_rows, **kwargs).first()
    if row["should_error"] == "true":
        return "error", row["failures"]
    if row["should_warn"] == "true":
        return "warn", row["failures"]
    return "pass", row["failures"]


def enforce(failing_rows: DataFrame, name: str = "check", **kwargs) -> tuple[str, object]:
    """:func:`evaluate`, raising :class:`CheckFailed` on error severity."""
    status, failures = evaluate(failing_rows, **kwargs)
    if status == "error":
        raise CheckFailed(f"{name}: {failures} failing")
    return status, failures
