"""Materializations and checks as Spark plans.

``project`` (the builder), ``publish`` (versioned tables, pointer views,
history segments), ``incremental`` (append, upsert, partition-scoped upsert,
high-water filter, column update), ``schema_change`` (policies and widening),
``snapshot`` (one-pass merge and increments), ``types`` (declared type strings
and conformance), ``checks``, ``compare`` (relation diff), ``setops``
(EXCEPT / INTERSECT) and ``stats`` (column catalog with statistics).
"""
