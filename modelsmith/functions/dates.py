"""Portable date functions.

``datediff`` counts *boundaries crossed* (calendar semantics): both sides are
truncated to the unit before the difference is taken, and weeks start on
Monday. Spark's plain ``timestampdiff`` counts elapsed units instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelsmith.functions._util import as_col

_UNITS = {
    "year": "YEAR", "quarter": "QUARTER", "month": "MONTH", "week": "WEEK",
    "day": "DAY", "hour": "HOUR", "minute": "MINUTE", "second": "SECOND",
    "millisecond": "MILLISECOND", "microsecond": "MICROSECOND",
}
_MONTHS_PER = {"month": 1, "quarter": 3, "year": 12}


def _unit(datepart: str) -> str:
    key = datepart.strip().lower()
    if key not in _UNITS and key.endswith("s") and key[:-1] in _UNITS:
        key = key[:-1]  # plural spellings: days, months, ...
    if key not in _UNITS:
        raise ValueError(f"unsupported date part: {datepart!r}")
    return key


def now() -> Column:
    """Wall-clock timestamp of the query start, as timestamp_ntz.

    Not repeatable; builds that must be repeatable take an ``as_of`` argument.
    """
    return F.localtimestamp()


def date_trunc(datepart: str, ts) -> Column:
    """Truncate to the unit; returns timestamp_ntz like the input data."""
    return F.date_trunc(_UNITS[_unit(datepart)], as_col(ts)).cast("timestamp_ntz")


def dateadd(datepart: str, interval, ts) -> Column:
    """Add ``interval`` units; month arithmetic clamps to the month end."""
    amount = interval if isinstance(interval, Column) else F.lit(int(interval))
    return F.timestamp_add(_UNITS[_unit(datepart)], amount, as_col(ts))


def datediff(first, second, datepart: str) -> Column:
    """Number of ``datepart`` boundaries between ``first`` and ``second`` (bigint)."""
    unit = _UNITS[_unit(datepart)]
    a = F.date_trunc(unit, as_col(first))
    b = F.date_trunc(unit, as_col(second))
    return F.timestamp_diff(unit, a, b).cast("bigint")


def last_day(date, datepart: str = "month") -> Column:
    """Last day of the date's month, quarter or year, as a date.

    ``trunc(part) + 1 part - 1 day``; the built-in ``last_day`` covers months only.
    """
    key = _unit(datepart)
    day = as_col(date).cast("date")
    if key in _MONTHS_PER:
        start = F.trunc(day, key.upper())
        return F.date_sub(F.add_months(start, _MONTHS_PER[key]), 1)
    if key == "week":
        return F.date_add(F.date_trunc("WEEK", day).cast("date"), 6)
    if key == "day":
        return day
    raise ValueError(f"last_day does not support {datepart!r}")
