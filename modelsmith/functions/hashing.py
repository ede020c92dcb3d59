"""Hashes used for version ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelsmith.functions._util import as_col


def half_md5_of_text(text) -> Column:
    """First 64 bits of MD5 of a string, read big-endian as an unsigned
    integer; returned as decimal(20,0) because Spark has no unsigned long."""
    head = F.substring(F.md5(as_col(text)), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)")


def half_md5(*args) -> Column:
    """Compatibility version hash: parts as text, NULL folded to ``''``,
    joined by ``'|'``, then :func:`half_md5_of_text`.

    Kept for callers that need the legacy value. It collides when values
    contain ``'|'`` or when NULL meets ``''``; :func:`scd_id` does not.
    """
    parts = [F.coalesce(as_col(a).cast("string"), F.lit("")) for a in args]
    return half_md5_of_text(F.concat_ws("|", *parts))


def scd_id(*args) -> Column:
    """Collision-safe 128-bit version id: each part is length-prefixed
    (``len:text``) or ``N`` for NULL, parts joined by ``'|'``, then MD5 hex."""
    parts = []
    for a in args:
        s = as_col(a).cast("string")
        parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("N")))
    return F.md5(F.concat_ws("|", *parts))
