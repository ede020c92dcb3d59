"""Schema drift between an existing target and new data.

``reconcile`` decides the target schema under an ``on_schema_change`` policy
and returns both sides projected and *explicitly cast* to it, so the union
that follows never relies on implicit coercion (under ANSI, int ∪ string is
planned as bigint and fails at run time).

Policies:

* ``ignore`` — keep the target's columns; new data is projected onto them,
  missing columns become NULL, extra ones are dropped; a value that the
  target's type cannot hold exactly fails the job.
* ``fail`` — raise :class:`SchemaChangeError` when anything differs.
* ``append_new_columns`` — add new columns at the end (old rows NULL); columns
  missing from new data become NULL there; changed types are widened.
* ``sync_all_columns`` — take the new column list; removed columns are
  dropped, added ones are NULL in old rows, changed types are widened (number
  and string meet as string).

Types that have no common one raise before anything is written.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DateType, DoubleType, FloatType, NumericType, StructField, StructType, TimestampNTZType, TimestampType,
)

from modelsmith.operators.types import loosened, widen

POLICIES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


class SchemaChangeError(RuntimeError):
    """Raised under the ``fail`` policy, and for types without a common one, before anything is written."""

    def __init__(self, diff: "SchemaDiff", reason: str = "the model's columns differ from its target's"):
        self.diff = diff
        super().__init__(
            f"{reason}: {diff.describe()}. The policies 'append_new_columns' and 'sync_all_columns' "
            "take added and removed columns and types that widen; full_refresh=True takes any."
        )


@dataclass
class SchemaDiff:
    added: list[tuple[str, DataType]] = field(default_factory=list)
    removed: list[tuple[str, DataType]] = field(default_factory=list)
    changed: list[tuple[str, DataType, DataType]] = field(default_factory=list)

    @property
    def changed_any(self) -> bool:
        return bool(self.added or self.removed or self.changed)

    def describe(self) -> str:
        parts = [f"added {n} {t.simpleString()}" for n, t in self.added]
        parts += [f"removed {n} {t.simpleString()}" for n, t in self.removed]
        parts += [f"changed {n} {a.simpleString()} -> {b.simpleString()}" for n, a, b in self.changed]
        return ", ".join(parts) or "no change"

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(n, "added", None, t.simpleString()) for n, t in self.added]
        rows += [(n, "removed", t.simpleString(), None) for n, t in self.removed]
        rows += [(n, "changed", a.simpleString(), b.simpleString()) for n, a, b in self.changed]
        return spark.createDataFrame(
            rows, "column_name string, change string, old_type string, new_type string"
        )


def _norm(name: str) -> str:
    return name.lower()  # Spark resolves column names case-insensitively


def schema_diff(target: StructType, new: StructType) -> SchemaDiff:
    old_f = {_norm(f.name): f for f in target.fields}
    new_f = {_norm(f.name): f for f in new.fields}
    diff = SchemaDiff()
    for f in new.fields:
        if _norm(f.name) not in old_f:
            diff.added.append((f.name, f.dataType))
    for f in target.fields:
        nf = new_f.get(_norm(f.name))
        if nf is None:
            diff.removed.append((f.name, f.dataType))
        elif loosened(nf.dataType) != loosened(f.dataType):
            diff.changed.append((f.name, f.dataType, nf.dataType))
    return diff


def target_schema(target: StructType, new: StructType, policy: str) -> list[tuple[str, DataType]]:
    """Column list (name, type) of the reconciled target."""
    if policy not in POLICIES:
        raise ValueError(f"on_schema_change must be one of {POLICIES}, got {policy!r}")
    diff = schema_diff(target, new)
    if policy == "fail" and diff.changed_any:
        raise SchemaChangeError(diff)
    new_f = {_norm(f.name): f for f in new.fields}
    if policy in ("ignore", "fail"):
        return [(f.name, loosened(f.dataType)) for f in target.fields]
    old_f = {_norm(f.name): f for f in target.fields}
    if policy == "append_new_columns":
        cols = []
        for f in target.fields:
            nf = new_f.get(_norm(f.name))
            cols.append((f.name, loosened(f.dataType) if nf is None else _common(f, nf)))
        cols += [(n, t) for n, t in diff.added]
        return cols
    cols = []  # sync_all_columns
    for f in new.fields:
        of = old_f.get(_norm(f.name))
        cols.append((f.name, loosened(f.dataType) if of is None else _common(of, f, allow_string=True)))
    return cols


def _common(old: StructField, new: StructField, allow_string: bool = False) -> DataType:
    t = widen(old.dataType, new.dataType, allow_string)
    if t is None:
        raise SchemaChangeError(SchemaDiff(changed=[(old.name, old.dataType, new.dataType)]), "no type holds the old and the new values")
    return t


_NUMBERS, _TIMES = (NumericType,), (DateType, TimestampNTZType, TimestampType)


def _cast_exactly(col: Column, old: DataType, new: DataType, name: str) -> Column:
    """``col`` in type ``new``; a number or time that the type cannot hold exactly fails the job."""
    narrows = any(isinstance(old, kind) and isinstance(new, kind) for kind in (_NUMBERS, _TIMES))
    if not narrows or widen(old, new) == new or isinstance(old, DoubleType) and isinstance(new, FloatType):
        return col.cast(new)
    typed = col.try_cast(new)
    lossy = F.raise_error(F.concat(F.lit(f"column {name}: {new.simpleString()} cannot hold "), col.cast("string")))
    return F.when(col.isNull() | typed.try_cast(old).eqNullSafe(col), typed).otherwise(lossy.cast(new))


def project_to(df: DataFrame, columns: list[tuple[str, DataType]]) -> DataFrame:
    """Select ``columns`` in order, casting each exactly; absent ones become typed NULLs."""
    present = {_norm(c): c for c in df.columns}
    out = []
    for name, dtype in columns:
        src = present.get(_norm(name))
        if src is None:
            col = F.lit(None).cast(dtype)
        else:
            col = _cast_exactly(F.col(f"`{src}`"), df.schema[src].dataType, dtype, name)
        out.append(col.alias(name))
    return df.select(*out)


def reconcile(existing: DataFrame, new: DataFrame, policy: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Both sides projected onto the reconciled target schema."""
    cols = target_schema(existing.schema, new.schema, policy)
    return project_to(existing, cols), project_to(new, cols)
