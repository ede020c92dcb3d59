"""Writing and publishing builds.

Parquet tables in Spark's built-in catalog have no transactions: no MERGE,
UPDATE or atomic table swap, and renaming a partitioned table leaves it
reading nothing until its partitions are repaired. So every build of a model
``db.m`` is written to a fresh managed table ``db.m__v<N>`` and published by
one catalog call, ``CREATE OR REPLACE VIEW db.m AS SELECT ... FROM
db.m__v<N>``. Readers always see a complete version, a new build may read the
live version while writing the next one, and partition filters pass through
the view. The version the view points to is kept as a view property. The
previous version is kept for readers that planned against it; older ones are
dropped after each publish.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelsmith.operators.claims import Claims
from modelsmith.operators.cluster import cluster
from modelsmith.operators.runs import resolve_sql

_LAYOUT_PROP = "modelsmith.layout"
_VERSION_PROP = "modelsmith.version"
_SEGMENTS_PROP = "modelsmith.segments"  # "<closed runs, comma separated>|<live run>"
_RUNS_PROP = "modelsmith.upsert_runs"  # {"key": [...], "runs": [[run, rows], ...]}, oldest first
OPEN_FLAG = "_open"  # partition column of a run table: the live rows of that run
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """A Spark SQL string literal for arbitrary text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class Layout:
    """Physical layout of a built table.

    ``partition_by``: directory partitions (pruned by filters on the view).
    ``order_by``: sort inside each file (Parquet min/max skipping); the primary
    key, when given, must be a prefix of it. ``buckets``: hash-bucket the table
    on ``bucket_by`` (for example the unique key of an upserted model) so later
    joins and upserts on that key do not shuffle the table again. ``cluster_by``:
    deal rows to files by range, of several columns by Z-order, so that filters
    on any of them skip files (:mod:`modelsmith.operators.cluster`).
    """

    partition_by: Sequence[str] = ()
    order_by: Sequence[str] = ()
    primary_key: Sequence[str] = ()
    buckets: int | None = None
    bucket_by: Sequence[str] = ()
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    cluster_by: Sequence[str] = ()

    def __post_init__(self):
        for attr in ("partition_by", "order_by", "primary_key", "bucket_by", "cluster_by"):
            value = getattr(self, attr)
            setattr(self, attr, (value,) if isinstance(value, str) else tuple(value))
        if self.primary_key and tuple(self.order_by[: len(self.primary_key)]) != self.primary_key:
            if self.order_by:
                raise ValueError("primary_key must be a prefix of order_by")
            self.order_by = self.primary_key
        if self.buckets and not self.bucket_by:
            raise ValueError("buckets needs bucket_by")
        if self.buckets and self.cluster_by:
            raise ValueError("buckets deal rows by hash, cluster_by by range: choose one")

    def arrange(self, df: DataFrame) -> DataFrame:
        """The frame as it will be written.

        With partitions, rows are first rebalanced on the partition columns
        (AQE splits a skewed partition value over several tasks and merges
        small ones, so each value gets few, full files), then sorted by the
        partition columns *followed by* ``order_by``: sorting by ``order_by``
        alone would be undone by the writer's own sort on partition columns.
        """
        if self.cluster_by:
            return cluster(df, self.cluster_by, self.partition_by, self.order_by)
        if self.partition_by:
            df = df.hint("rebalance", *self.partition_by)
            return df.sortWithinPartitions(*self.partition_by, *self.order_by)
        if self.order_by:
            return df.sortWithinPartitions(*self.order_by)
        return df

    def writer(self, df: DataFrame):
        w = df.write.format(self.format)
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        if self.buckets:
            w = w.bucketBy(self.buckets, *self.bucket_by)
            if self.order_by:
                w = w.sortBy(*self.order_by)
        for k, v in self.options.items():
            w = w.option(k, v)
        return w


class Publisher:
    """Versioned tables behind a pointer view, in one catalog schema."""

    def __init__(self, spark: SparkSession, schema: str, keep_versions: int = 2):
        if not _IDENT.match(schema):
            raise ValueError(f"bad schema name {schema!r}")
        self.spark = spark
        self.schema = schema
        self.keep_versions = max(2, keep_versions)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(schema)}")
        self.claims = Claims(spark, f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/_modelsmith_claims")

    # ----------------------------------------------------------- names
    def qualified(self, name: str) -> str:
        if not _IDENT.match(name):
            raise ValueError(f"bad relation name {name!r}")
        return f"{quote_ident(self.schema)}.{quote_ident(name)}"

    def _tables(self) -> dict[str, str]:
        return {t.name: (t.tableType or "").upper() for t in self.spark.catalog.listTables(self.schema)
                if not t.isTemporary}

    def kind(self, name: str) -> str | None:
        """'view' / 'table' for an existing relation, else None."""
        tables = self._tables()
        t = tables.get(name.lower()) or tables.get(name)
        if t is None:
            return None
        return "view" if t == "VIEW" else "table"

    def models(self) -> list[str]:
        """Published relations of the schema (versions and staging excluded)."""
        return sorted(n for n in self._tables() if not re.search(r"__(v\d+|run\d+|stage_[0-9a-f]+)$", n))

    def versions(self, name: str) -> list[int]:
        pat = re.compile(rf"^{re.escape(name.lower())}__v(\d+)$")
        return sorted(int(m.group(1)) for t in self._tables() if (m := pat.match(t.lower())))

    def current_version(self, name: str) -> int | None:
        value = self._properties(name).get(_VERSION_PROP)
        return int(value) if value is not None else None

    def _properties(self, name: str) -> dict[str, str]:
        if self.kind(name) != "view":
            return {}
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(name)}").collect()}

    def stored_layout(self, name: str, columns: Sequence[str]) -> Layout | None:
        """The layout that the model was last published with, if it fits ``columns``."""
        text = self._properties(name).get(_LAYOUT_PROP)
        layout = Layout(**json.loads(text)) if text else None
        if layout and not {*layout.partition_by, *layout.order_by, *layout.bucket_by, *layout.cluster_by} <= {*columns}:
            return None
        return layout

    def stored_comments(self, name: str) -> tuple[str | None, dict[str, str]]:
        """The comments of the relation and of its columns, as the catalog has them."""
        if self.kind(name) is None:
            return None, {}
        qualified = self.qualified(name)
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").where("col_name = 'Comment'").collect()
        columns = {f.name: f.metadata["comment"] for f in self.spark.table(qualified).schema.fields if "comment" in f.metadata}
        return (described[0].data_type if described else None), columns

    def version_table(self, name: str, version: int) -> str:
        return self.qualified(f"{name}__v{version}")

    def relation(self, name: str) -> DataFrame | None:
        return self.spark.table(self.qualified(name)) if self.kind(name) else None

    # ----------------------------------------------------------- writing
    def write_version(self, name: str, df: DataFrame, layout: Layout | None = None) -> int:
        """Write ``df`` to a new version table; nothing is published yet."""
        layout = layout or self.stored_layout(name, df.columns) or Layout()
        existing = self.versions(name)
        version = (existing[-1] + 1) if existing else 1
        self._write(name, df, layout, self.version_table(name, version))
        return version

    def _write(self, name: str, df: DataFrame, layout: Layout, table: str) -> None:
        """``df`` to a new table. A clustered layout reads its rows several times, so they are staged first."""
        staged = None
        try:
            if layout.cluster_by:
                staged, df = self.stage(name, df)
            layout.writer(layout.arrange(df)).mode("errorifexists").saveAsTable(table)
        finally:
            if staged is not None:
                self.drop(staged)

    def append_to_version(self, name: str, version: int, df: DataFrame, layout: Layout | None = None) -> None:
        """Append rows to a version in place, matched by column name."""
        self.claims.check(name)
        layout = layout or self.stored_layout(name, df.columns) or Layout()
        target = self.spark.table(self.version_table(name, version))
        ordered = df.select(*target.columns)
        layout.writer(layout.arrange(ordered)).mode("append").saveAsTable(self.version_table(name, version))

    def overwrite_partitions(self, name: str, version: int, df: DataFrame, layout: Layout) -> None:
        """Replace only the partitions present in ``df`` inside a version, in
        place (dynamic partition overwrite: output is staged and each touched
        partition directory is swapped at job commit)."""
        if not layout.partition_by:
            raise ValueError("a partition-scoped rewrite needs layout.partition_by")
        self.claims.check(name)
        table = self.version_table(name, version)
        ordered = layout.arrange(df).select(*self.spark.table(table).columns)
        key = "spark.sql.sources.partitionOverwriteMode"
        previous = self.spark.conf.get(key, None)
        # insertInto takes the mode from the session, not from writer options
        self.spark.conf.set(key, "dynamic")
        try:
            ordered.write.mode("overwrite").insertInto(table)
        finally:
            if previous is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, previous)

    def stage(self, name: str, df: DataFrame) -> tuple[str, DataFrame]:
        """Write ``df`` once to a staging table in the shared warehouse and read
        it back: the new data of an upsert is used twice (keys and rows), so
        it is computed once, and the build survives lost executors without
        recomputing the model."""
        stage = self.qualified(f"{name}__stage_{uuid.uuid4().hex[:12]}")
        df.write.format("parquet").mode("errorifexists").saveAsTable(stage)
        return stage, self.spark.table(stage)

    def drop(self, qualified_name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {qualified_name}")

    # ----------------------------------------------------------- publishing
    def swap(
        self,
        name: str,
        version: int,
        comment: str | None = None,
        column_comments: Mapping[str, str] | None = None,
        layout: Layout | None = None,
    ) -> None:
        """Point the model's view at ``version`` (one catalog call), carrying
        the layout, the relation and column comments (those of the relation
        so far where none are given), then retire old versions."""
        old_comment, old_columns = self.stored_comments(name)
        comment = old_comment if comment is None else comment
        column_comments = old_columns if column_comments is None else {**old_columns, **column_comments}
        layout = layout or self.stored_layout(name, self.spark.table(self.version_table(name, version)).columns)
        properties = self._properties(name)  # all that the view carries stays, such as a stream's progress
        self.claims.check(name)
        backup = self._aside(name)
        previous = self.current_version(name)
        cols = self.spark.table(self.version_table(name, version)).columns
        col_list = ", ".join(
            quote_ident(c) + (f" COMMENT {sql_string(column_comments[c])}" if c in column_comments else "")
            for c in cols
        )
        select = ", ".join(quote_ident(c) for c in cols)
        clauses = f" COMMENT {sql_string(comment)}" if comment else ""
        props = {k: v for k, v in properties.items() if k.startswith("modelsmith.") and k not in (_SEGMENTS_PROP, _LAYOUT_PROP, _RUNS_PROP)}
        props[_VERSION_PROP] = str(version)
        if layout:
            props[_LAYOUT_PROP] = json.dumps(asdict(layout))
        clauses += f" TBLPROPERTIES ({', '.join(f'{sql_string(k)} = {sql_string(v)}' for k, v in props.items())})"
        try:
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.qualified(name)} ({col_list}){clauses} "
                f"AS SELECT {select} FROM {self.version_table(name, version)}"
            )
        except Exception:
            self._back(name, backup)
            raise
        if backup is not None:
            self.drop(backup)
        if _RUNS_PROP in properties:  # the model was kept as runs before
            for r in self.runs(name):
                self.drop(self.run_table(name, r))
        newest = [v for v in self.versions(name) if v <= version][-self.keep_versions:]
        self.retire(name, keep={version, previous, *newest})

    def adopt(self, name: str, layout: Layout | None = None) -> int:
        """Take over a plain table (built by other means) as a version, with all its rows."""
        version = self.write_version(name, self.spark.table(self.qualified(name)), layout)
        self.swap(name, version, layout=layout)
        return version

    # ----------------------------------------------------------- history segments
    # A segmented model (used by snapshots) is a view over run tables
    # ``m__run<N>``, each partitioned by ``_open``: the closed partitions of all
    # runs plus the open partition of the latest run. A run writes only what
    # it changes; closed history is never rewritten.

    def run_table(self, name: str, run: int) -> str:
        return self.qualified(f"{name}__run{run}")

    def runs(self, name: str) -> list[int]:
        pat = re.compile(rf"^{re.escape(name.lower())}__run(\d+)$")
        return sorted(int(m.group(1)) for t in self._tables() if (m := pat.match(t.lower())))

    def segments(self, name: str) -> tuple[list[int], int] | None:
        """(closed runs, live run) of a segmented model, or None."""
        if self.kind(name) != "view":
            return None
        props = {r["key"]: r["value"] for r in self.spark.sql(
            f"SHOW TBLPROPERTIES {self.qualified(name)}").collect()}
        value = props.get(_SEGMENTS_PROP)
        if value is None:
            return None
        closed, live = value.split("|")
        return [int(x) for x in closed.split(",") if x], int(live)

    def write_run(self, name: str, df: DataFrame, layout: Layout | None = None) -> int:
        """Write a run table; ``df`` carries the ``_open`` flag column."""
        layout = layout or Layout()
        run_layout = Layout(partition_by=(OPEN_FLAG, *layout.partition_by), order_by=layout.order_by,
                            format=layout.format, options=layout.options)
        existing = self.runs(name)
        run = (existing[-1] + 1) if existing else 1
        run_layout.writer(run_layout.arrange(df)).mode("errorifexists").saveAsTable(self.run_table(name, run))
        return run

    def run_part(self, name: str, run: int, open_rows: bool) -> DataFrame:
        """The open or the closed partition of a run (partition-pruned)."""
        t = self.spark.table(self.run_table(name, run))
        flag = F.col(OPEN_FLAG) if open_rows else ~F.col(OPEN_FLAG)
        return t.filter(flag).drop(OPEN_FLAG)

    def swap_segments(self, name: str, closed_runs: Sequence[int], live_run: int,
                      comment: str | None = None,
                      column_comments: Mapping[str, str] | None = None) -> None:
        """Point the view at the closed partitions of ``closed_runs`` and the
        open partition of ``live_run`` (one catalog call). Older runs may lack
        columns added later; they read as typed NULLs."""
        previous = self.segments(name)
        fields = [f for f in self.spark.table(self.run_table(name, live_run)).schema.fields
                  if f.name != OPEN_FLAG]

        def branch(run: int, open_rows: bool) -> str:
            have = set(self.spark.table(self.run_table(name, run)).columns)
            cols = ", ".join(
                quote_ident(f.name) if f.name in have
                else f"CAST(NULL AS {f.dataType.simpleString()}) AS {quote_ident(f.name)}"
                for f in fields
            )
            cond = quote_ident(OPEN_FLAG) if open_rows else f"NOT {quote_ident(OPEN_FLAG)}"
            return f"SELECT {cols} FROM {self.run_table(name, run)} WHERE {cond}"

        body = " UNION ALL ".join([branch(r, False) for r in closed_runs] + [branch(live_run, True)])
        column_comments = dict(column_comments or {})
        col_list = ", ".join(
            quote_ident(f.name) + (f" COMMENT {sql_string(column_comments[f.name])}"
                                   if f.name in column_comments else "")
            for f in fields
        )
        self.claims.check(name)
        marker = ",".join(str(r) for r in closed_runs) + f"|{live_run}"
        clauses = f" COMMENT {sql_string(comment)}" if comment else ""
        clauses += f" TBLPROPERTIES ({sql_string(_SEGMENTS_PROP)} = {sql_string(marker)})"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(name)} ({col_list}){clauses} AS {body}")
        keep = set(closed_runs) | {live_run}
        live_runs = {live_run} | ({previous[1]} if previous is not None else set())
        if previous is not None:
            keep |= set(previous[0]) | {previous[1]}
        for r in self.runs(name):
            if r not in keep:
                self.drop(self.run_table(name, r))
            elif r not in live_runs:
                # a superseded run keeps only its closed rows
                self.spark.sql(f"ALTER TABLE {self.run_table(name, r)} DROP IF EXISTS "
                               f"PARTITION ({quote_ident(OPEN_FLAG)} = true)")

    # ----------------------------------------------------------- upsert runs
    # A model kept as runs (:mod:`modelsmith.operators.runs`) is a view that resolves
    # the run tables ``m__run<N>``; the view's properties name them in order.

    def upsert_runs(self, name: str) -> tuple[list[str], list[tuple[int, int]]] | None:
        """(unique key, [(run, rows), ...] oldest first) of a model kept as runs, or None."""
        text = self._properties(name).get(_RUNS_PROP)
        if text is None:
            return None
        stored = json.loads(text)
        return stored["key"], [(run, rows) for run, rows in stored["runs"]]

    def write_upsert_run(self, name: str, df: DataFrame, layout: Layout | None = None) -> tuple[int, int]:
        """Write one run table; returns its number and its row count (from the files' footers)."""
        layout = layout or self.stored_layout(name, df.columns) or Layout()
        run = max(self.runs(name), default=0) + 1
        table = self.run_table(name, run)
        self._write(name, df, layout, table)
        return run, self.spark.table(table).count()

    def swap_upsert_runs(
        self,
        name: str,
        unique_key: Sequence[str],
        runs: Sequence[tuple[int, int]],
        comment: str | None = None,
        column_comments: Mapping[str, str] | None = None,
        layout: Layout | None = None,
    ) -> None:
        """Point the model's view at ``runs`` (one catalog call), comments and layout as in :meth:`swap`. Runs that
        neither this view nor the one before names are dropped."""
        before = self.upsert_runs(name)
        old_comment, old_columns = self.stored_comments(name)
        comment = old_comment if comment is None else comment
        column_comments = old_columns if column_comments is None else {**old_columns, **column_comments}
        cols = self.spark.table(self.run_table(name, runs[-1][0])).columns
        layout = layout or self.stored_layout(name, cols)
        props = {k: v for k, v in self._properties(name).items()
                 if k.startswith("modelsmith.") and k not in (_VERSION_PROP, _SEGMENTS_PROP, _LAYOUT_PROP)}
        props[_RUNS_PROP] = json.dumps({"key": list(unique_key), "runs": [list(r) for r in runs]})
        if layout:
            props[_LAYOUT_PROP] = json.dumps(asdict(layout))
        col_list = ", ".join(
            quote_ident(c) + (f" COMMENT {sql_string(column_comments[c])}" if c in column_comments else "")
            for c in cols
        )
        clauses = f" COMMENT {sql_string(comment)}" if comment else ""
        clauses += f" TBLPROPERTIES ({', '.join(f'{sql_string(k)} = {sql_string(v)}' for k, v in props.items())})"
        body = resolve_sql([self.run_table(name, r) for r, _ in runs], cols, unique_key)
        self.claims.check(name)
        backup = self._aside(name)
        try:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(name)} ({col_list}){clauses} AS {body}")
        except Exception:
            self._back(name, backup)
            raise
        if backup is not None:
            self.drop(backup)
        keep = {r for r, _ in runs} | {r for r, _ in (before[1] if before else [])}
        for r in self.runs(name):
            if r not in keep:
                self.drop(self.run_table(name, r))

    def drop_model(self, name: str) -> None:
        """Remove a model: its view (or plain table) and every version, run and
        staging table behind it."""
        kind = self.kind(name)
        if kind == "view":
            self.spark.sql(f"DROP VIEW IF EXISTS {self.qualified(name)}")
        elif kind == "table":
            self.drop(self.qualified(name))
        for v in self.versions(name):
            self.drop(self.version_table(name, v))
        for r in self.runs(name):
            self.drop(self.run_table(name, r))
        pat = re.compile(rf"^{re.escape(name.lower())}__stage_[0-9a-f]+$")
        for t in self._tables():
            if pat.match(t.lower()):
                self.drop(self.qualified(t))

    def drop_orphans(self) -> list[str]:
        """Drop what interrupted builds left behind: staging tables, and
        version tables newer than the published one (a build that wrote its
        version but died before the swap). What belongs to a model that a builder has claimed stays.
        Returns the dropped names."""
        dropped = []
        tables = self._tables()
        for t in tables:
            if (m := re.match(r"(.+)__stage_[0-9a-f]+$", t)) and not self.claims.open(m.group(1)):
                self.drop(self.qualified(t))
                dropped.append(t)
        for model in self.models():
            if self.claims.open(model):
                continue
            current = self.current_version(model)
            if current is not None:
                for v in self.versions(model):
                    if v > current:
                        self.drop(self.version_table(model, v))
                        dropped.append(f"{model}__v{v}")
            segs = self.segments(model)
            if segs is not None:
                referenced = set(segs[0]) | {segs[1]}
                for r in self.runs(model):
                    if r > segs[1] and r not in referenced:
                        self.drop(self.run_table(model, r))
                        dropped.append(f"{model}__run{r}")
            upserts = self.upsert_runs(model)
            if upserts is not None:
                newest = max(r for r, _ in upserts[1])
                for r in self.runs(model):
                    if r > newest:
                        self.drop(self.run_table(model, r))
                        dropped.append(f"{model}__run{r}")
        return dropped

    def retire(self, name: str, keep: set) -> None:
        """Drop version tables not in ``keep`` (the live one and the one before:
        a DataFrame already planned against the previous version still reads)."""
        for v in self.versions(name):
            if v not in keep:
                self.drop(self.version_table(name, v))

    def publish(
        self,
        name: str,
        df: DataFrame,
        layout: Layout | None = None,
        comment: str | None = None,
        column_comments: Mapping[str, str] | None = None,
    ) -> int:
        version = self.write_version(name, df, layout)
        self.swap(name, version, comment, column_comments, layout)
        return version

    def publish_view(
        self,
        name: str,
        sql: str,
        comment: str | None = None,
        column_comments: Mapping[str, str] | None = None,
    ) -> None:
        """(re)build a view model from SQL over catalog names. A
        versioned build of the same name is replaced and its versions dropped."""
        cols = self.spark.sql(sql).columns  # analysed before anything is touched
        column_comments = dict(column_comments or {})
        col_list = ", ".join(
            quote_ident(c) + (f" COMMENT {sql_string(column_comments[c])}" if c in column_comments else "")
            for c in cols
        )
        clauses = f" COMMENT {sql_string(comment)}" if comment else ""
        self.claims.check(name)
        backup = self._aside(name)
        try:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(name)} ({col_list}){clauses} AS {sql}")
        except Exception:
            self._back(name, backup)
            raise
        if backup is not None:
            self.drop(backup)
        self.retire(name, keep=set())

    def _aside(self, name: str) -> str | None:
        """Rename a plain table of that name (built by other means), so that it makes way for the view; None
        where there is none. The caller drops it once the view exists, or brings it :meth:`_back`."""
        if self.kind(name) != "table":
            return None
        backup = self.qualified(f"{name}__stage_{uuid.uuid4().hex}")
        self.spark.sql(f"ALTER TABLE {self.qualified(name)} RENAME TO {backup}")
        return backup

    def _back(self, name: str, backup: str | None) -> None:
        if backup is None:
            return
        table = self.qualified(name)
        self.spark.sql(f"ALTER TABLE {backup} RENAME TO {table}")
        if any(r.col_name == "# Partition Information" for r in self.spark.sql(f"DESCRIBE TABLE {table}").collect()):
            self.spark.catalog.recoverPartitions(table)  # a renamed table has lost its partitions
