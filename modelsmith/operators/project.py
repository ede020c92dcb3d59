"""The model builder: materializations over a catalog schema.

    project = Project(spark, "analytics")
    project.table("orders_by_day", lambda: orders.groupBy(...).agg(...),
                  layout=Layout(partition_by=["day"]))
    project.incremental("events_clean", model, unique_key="event_id",
                        on_schema_change="append_new_columns")
    project.snapshot("customers_history", customers, unique_key="c_custkey",
                     strategy="check", check_cols=["c_name", "c_acctbal"],
                     as_of="2024-01-01 00:00:00")

Every build computes the next version as one DataFrame plan (see
:mod:`modelsmith.operators.incremental` and :mod:`modelsmith.operators.snapshot`),
writes it once, and publishes it with one catalog call
(:class:`modelsmith.operators.publish.Publisher`).
"""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelsmith.operators.feed import FEED_COLUMNS, plan_feed
from modelsmith.operators.incremental import (
    moved_keys,
    next_version,
    plan_partition_upsert,
    plan_update_column,
)
from modelsmith.operators.publish import OPEN_FLAG, Layout, Publisher
from modelsmith.operators.runs import merge_from, resolve_runs
from modelsmith.operators.schema_change import POLICIES, project_to, target_schema
from modelsmith.operators.snapshot import first_snapshot, plan_snapshot, plan_snapshot_increment


@dataclass
class ModelContext:
    """What a model function sees: ``is_incremental`` and the live target
    (``this``) when it exists."""

    spark: SparkSession
    is_incremental: bool
    this: DataFrame | None


Model = DataFrame | Callable[..., DataFrame]


class SnapshotInputError(ValueError):
    pass


def _claimed(build):
    """A builder's method that holds the claim of its model (:mod:`modelsmith.operators.claims`)."""

    @functools.wraps(build)
    def run(self, name, *args, **kwargs):
        with self.publisher.claims.claimed(name):
            return build(self, name, *args, **kwargs)

    return run


class Project:
    def __init__(self, spark: SparkSession, schema: str, keep_versions: int = 2):
        self.spark = spark
        self.publisher = Publisher(spark, schema, keep_versions)

    # ------------------------------------------------------------- helpers
    def ref(self, name: str) -> DataFrame:
        """The published relation of a model."""
        return self.spark.table(self.publisher.qualified(name))

    def _run_model(self, model: Model, ctx: ModelContext) -> DataFrame:
        if isinstance(model, DataFrame):
            return model
        takes_ctx = len(inspect.signature(model).parameters) > 0
        return model(ctx) if takes_ctx else model()

    # ------------------------------------------------------------- B1
    @_claimed
    def view(self, name: str, sql: str, comment: str | None = None,
             column_comments: Mapping[str, str] | None = None) -> DataFrame:
        self.publisher.publish_view(name, sql, comment, column_comments)
        return self.ref(name)

    # ------------------------------------------------------------- B2
    @_claimed
    def table(self, name: str, model: Model, layout: Layout | None = None,
              comment: str | None = None, column_comments: Mapping[str, str] | None = None) -> DataFrame:
        df = self._run_model(model, ModelContext(self.spark, False, None))
        self.publisher.publish(name, df, layout, comment, column_comments)
        return self.ref(name)

    # ------------------------------------------------------------- B3-B12
    @_claimed
    def incremental(
        self,
        name: str,
        model: Model,
        unique_key: str | Sequence[str] | None = None,
        inserts_only: bool = False,
        on_schema_change: str = "ignore",
        full_refresh: bool = False,
        layout: Layout | None = None,
        comment: str | None = None,
        column_comments: Mapping[str, str] | None = None,
        partition_scoped: bool = False,
    ) -> DataFrame:
        """Build an incremental model.

        First run (or ``full_refresh``): the model's output becomes the first
        version. Later runs: the model sees ``ctx.is_incremental`` and the live
        target ``ctx.this``; its output is appended (no ``unique_key``, or
        ``inserts_only``; in place when the schema is unchanged) or staged once
        and upserted on ``unique_key`` into a new version.
        ``partition_scoped=True`` (with ``layout.partition_by``) rewrites only
        the partitions the new data touches, in place, instead of writing a new
        version; it refuses new data with a key from any other partition.
        A run without layout or comments keeps those of the run before.
        """
        if on_schema_change not in POLICIES:
            raise ValueError(f"on_schema_change must be one of {POLICIES}")
        pub = self.publisher
        if partition_scoped:
            layout = layout or (pub.stored_layout(name, self.ref(name).columns) if pub.kind(name) else None)
            if unique_key is None or layout is None or not layout.partition_by:
                raise ValueError("partition_scoped needs unique_key and layout.partition_by")
        if pub.upsert_runs(name) is not None and not full_refresh:
            raise ValueError(f"{name} is kept as runs; use incremental_runs, or a full refresh")
        if pub.kind(name) == "table" and not full_refresh:
            pub.adopt(name, layout)  # an existing plain table is the target of this run
        version = pub.current_version(name)
        is_model_view = pub.kind(name) == "view" and version is None
        if version is None or full_refresh or is_model_view:
            # B3 first run, B4 full refresh (or the name was a view model)
            df = next_version(None, lambda _: self._run_model(model, ModelContext(self.spark, False, None)))
            pub.publish(name, df, layout, comment, column_comments)
            return self.ref(name)

        this = self.ref(name)
        new = self._run_model(model, ModelContext(self.spark, True, this))
        if inserts_only or unique_key is None:
            # The new rows are read once, so they are not staged.
            cols = target_schema(this.schema, new.schema, on_schema_change)
            if [(f.name, f.dataType) for f in this.schema.fields] == cols:
                # unchanged schema: append to the live version in place, no rewrite
                pub.append_to_version(name, version, project_to(new, cols), layout)
                if comment is not None or column_comments is not None:
                    pub.swap(name, version, comment, column_comments)
            else:
                nxt = next_version(this, lambda _: new, None, inserts_only, on_schema_change)
                pub.publish(name, nxt, layout, comment, column_comments)
            return self.ref(name)
        # Refuse a schema change under "fail" before anything is computed or written.
        target_schema(this.schema, new.schema, on_schema_change)
        # An upsert reads the new rows twice (keys, rows): stage them once.
        stage_name, staged = pub.stage(name, new)
        try:
            if partition_scoped:
                cols = target_schema(this.schema, staged.schema, on_schema_change)
                if [(f.name, f.dataType) for f in this.schema.fields] != cols:
                    raise ValueError("a partition-scoped upsert cannot change the schema; "
                                     "run a full upsert or a full refresh")
                if not moved_keys(this, staged, unique_key, layout.partition_by).isEmpty():
                    raise ValueError("a key of the new data lies in a partition that the new data does not touch; "
                                     "run a full upsert")
                # B6 on large targets: rewrite only the touched partitions, in
                # place. Spark refuses to overwrite a table the same job reads,
                # so the touched partitions' new contents are staged first.
                touched = plan_partition_upsert(this, staged, unique_key, layout.partition_by,
                                                on_schema_change)
                touched_name, touched_rows = pub.stage(name, touched)
                try:
                    pub.overwrite_partitions(name, version, touched_rows, layout)
                finally:
                    pub.drop(touched_name)
                return self.ref(name)
            else:
                nxt = next_version(this, lambda _: staged, unique_key, False, on_schema_change)  # B6
            pub.publish(name, nxt, layout, comment, column_comments)
        finally:
            pub.drop(stage_name)
        return self.ref(name)

    @_claimed
    def incremental_runs(
        self,
        name: str,
        model: Model,
        unique_key: str | Sequence[str],
        on_schema_change: str = "ignore",
        full_refresh: bool = False,
        layout: Layout | None = None,
        comment: str | None = None,
        column_comments: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """:meth:`incremental` with a ``unique_key``, kept as runs (:mod:`modelsmith.operators.runs`): a run of
        the model writes its new rows and, now and then, merges the newest runs; the target is not
        rewritten. Each read resolves the runs, so this suits models that are written more often
        than they are read whole. A batch without rows changes nothing. A changed schema or a changed key makes one run of all.
        An existing versioned model, or a plain table, is the oldest run; ``on_schema_change`` is as in :meth:`incremental`.
        """
        if on_schema_change not in POLICIES:
            raise ValueError(f"on_schema_change must be one of {POLICIES}")
        pub = self.publisher
        keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
        if pub.segments(name) is not None:
            raise ValueError(f"{name} is stored as history segments")
        stored, version = pub.upsert_runs(name), pub.current_version(name)
        target = pub.kind(name) == "table" or stored is not None or version is not None
        if full_refresh or not target:
            df = self._run_model(model, ModelContext(self.spark, False, None))
            pub.swap_upsert_runs(name, keys, [pub.write_upsert_run(name, df, layout)], comment, column_comments, layout)
            pub.retire(name, keep=set())
            return self.ref(name)
        this = self.ref(name)
        new = self._run_model(model, ModelContext(self.spark, True, this))
        cols = target_schema(this.schema, new.schema, on_schema_change)
        if not set(keys) <= {c for c, _ in cols}:
            raise ValueError(f"the columns {[c for c, _ in cols]} lack the unique key {keys}")
        same = [(f.name, f.dataType) for f in this.schema.fields] == cols
        if stored is None or stored[0] != keys or not same:
            runs = [pub.write_upsert_run(name, project_to(this, cols), layout)]
        else:
            runs = stored[1]
        written = pub.write_upsert_run(name, project_to(new, cols), layout)
        if written[1]:
            runs = [*runs, written]
        else:
            pub.drop(pub.run_table(name, written[0]))
        runs = self._merge_runs(name, keys, runs, merge_from([rows for _, rows in runs]), layout)
        pub.swap_upsert_runs(name, keys, runs, comment, column_comments, layout)
        pub.retire(name, keep={version})
        return self.ref(name)

    @_claimed
    def compact_runs(self, name: str, layout: Layout | None = None) -> DataFrame:
        """Merge all runs of a model kept as runs into one, so that reads need no join."""
        stored = self.publisher.upsert_runs(name)
        if stored is None:
            raise ValueError(f"{name} is not kept as runs")
        keys, runs = stored
        self.publisher.swap_upsert_runs(name, keys, self._merge_runs(name, keys, runs, 0, layout), layout=layout)
        return self.ref(name)

    def _merge_runs(self, name, keys, runs, start, layout) -> list[tuple[int, int]]:
        """``runs`` with those from place ``start`` on merged into one."""
        if start >= len(runs) - 1:
            return runs
        pub = self.publisher
        tables = [self.spark.table(pub.run_table(name, r)) for r, _ in runs[start:]]
        return [*runs[:start], pub.write_upsert_run(name, resolve_runs(tables, keys), layout)]

    @_claimed
    def drop(self, name: str) -> None:
        """Remove a model and everything stored for it."""
        self.publisher.drop_model(name)

    # ------------------------------------------------------------- A11
    @_claimed
    def update_column(self, name: str, column: str, value, where=None,
                      layout: Layout | None = None) -> DataFrame:
        this = self.ref(name)
        value = F.expr(value) if isinstance(value, str) else value
        where = F.expr(where) if isinstance(where, str) else where
        self.publisher.publish(name, plan_update_column(this, column, value, where), layout)
        return self.ref(name)

    # ------------------------------------------------------------- B13-B16
    @_claimed
    def snapshot(
        self,
        name: str,
        source: Model,
        unique_key: str | Sequence[str],
        strategy: str = "timestamp",
        updated_at: str | None = None,
        check_cols: Sequence[str] | None = None,
        as_of=None,
        invalidate_hard_deletes: bool = False,
        validate: bool = True,
        layout: Layout | None = None,
        segmented: bool = False,
    ) -> DataFrame:
        """Build a snapshot (see :mod:`modelsmith.operators.snapshot`).

        ``segmented=False`` writes each run as a full new version (closed
        history copied). ``segmented=True`` stores history as segments: each
        run writes one table holding only the rows it closes and the new live
        set, and the view unions every run's closed rows with the latest live
        set, so a run costs O(live rows + source), not O(history). Segments
        are only ever merged by :meth:`compact_snapshot`. An existing versioned
        snapshot is converted on the first segmented run; an existing plain
        table is the history to start from.
        """
        pub = self.publisher
        if pub.kind(name) == "table":
            pub.adopt(name)
        src = self._run_model(source, ModelContext(self.spark, False, None))
        # Validation and the merge both read the source: stage it once so the
        # model runs once. Without validation the merge reads it once, unstaged.
        stage_name, staged = pub.stage(name, src) if validate else (None, src)
        try:
            if validate:
                validate_snapshot_source(staged, unique_key, strategy, updated_at)
            if as_of is None:
                as_of = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
            if segmented:
                self._snapshot_segment(name, staged, unique_key, strategy, updated_at, check_cols,
                                       as_of, invalidate_hard_deletes, layout)
            else:
                if pub.segments(name) is not None:
                    raise ValueError(f"{name} is stored as history segments; pass segmented=True")
                this = self.ref(name) if pub.current_version(name) is not None else None
                nxt = plan_snapshot(this, staged, unique_key, strategy, updated_at, check_cols,
                                    as_of, invalidate_hard_deletes)
                pub.publish(name, nxt, layout)
        finally:
            if stage_name is not None:
                pub.drop(stage_name)
        return self.ref(name)

    @_claimed
    def snapshot_feed(
        self,
        name: str,
        changes: Model,
        unique_key: str | Sequence[str],
        changed_at: str,
        deleted: str | None = None,
        order_by: Sequence[str] = (),
        unit: str = "day",
        layout: Layout | None = None,
    ) -> DataFrame:
        """Build a snapshot from a feed of changes, of which a key may have many, late ones too
        (see :mod:`modelsmith.operators.feed`)."""
        pub = self.publisher
        this = self.ref(name) if pub.kind(name) else None
        if this is not None and not {*FEED_COLUMNS} <= {*this.columns}:
            raise ValueError(f"{name} is not a snapshot of a feed")
        # The changes are read twice (keys, rows): stage them once.
        stage_name, staged = pub.stage(name, self._run_model(changes, ModelContext(self.spark, this is not None, this)))
        try:
            pub.publish(name, plan_feed(this, staged, unique_key, changed_at, deleted, order_by, unit), layout)
        finally:
            pub.drop(stage_name)
        return self.ref(name)

    @_claimed
    def compact_snapshot(self, name: str, newest: int = 8, layout: Layout | None = None) -> DataFrame:
        """Merge the ``newest`` latest closed segments of a segmented snapshot into one;
        older segments are left as they are."""
        pub = self.publisher
        segs = pub.segments(name)
        if segs is None:
            raise ValueError(f"{name} is not stored as history segments")
        closed, live = segs
        kept, merged = closed[:-newest], closed[-newest:]
        if len(merged) > 1:
            parts = [pub.run_part(name, r, open_rows=False) for r in merged]
            frame = parts[0]
            for p in parts[1:]:
                frame = frame.unionByName(p, allowMissingColumns=True)
            run = pub.write_run(name, frame.select("*", F.lit(False).alias(OPEN_FLAG)), layout)
            pub.swap_segments(name, [*kept, run], live)
        return self.ref(name)

    def _snapshot_segment(self, name, source, unique_key, strategy, updated_at, check_cols, as_of,
                          invalidate_hard_deletes, layout) -> None:
        pub = self.publisher
        open_flag = F.col("valid_to").isNull().alias(OPEN_FLAG)
        segs = pub.segments(name)
        converted = None
        if segs is None:
            converted = pub.current_version(name)
            if converted is not None:
                # convert a versioned snapshot: its rows become the first run
                base = self.ref(name)
                run = pub.write_run(name, base.select("*", open_flag), layout)
                segs = ([run], run)
            else:
                first = first_snapshot(source, unique_key, strategy, updated_at, check_cols, as_of)
                run = pub.write_run(name, first.select("*", open_flag), layout)
                pub.swap_segments(name, [], run)
                return
        closed_runs, live_run = segs
        live = pub.run_part(name, live_run, open_rows=True)
        history = None
        if closed_runs:
            parts = [pub.run_part(name, r, open_rows=False) for r in closed_runs]
            history = parts[0]
            for p in parts[1:]:
                history = history.unionByName(p, allowMissingColumns=True)
        increment = plan_snapshot_increment(live, history, source, unique_key, strategy, updated_at,
                                            check_cols, as_of, invalidate_hard_deletes)
        run = pub.write_run(name, increment.select("*", open_flag), layout)
        pub.swap_segments(name, [*closed_runs, run], run)
        if converted is not None:
            pub.retire(name, keep={converted})  # the old version stays one round for readers
        elif pub.versions(name):
            pub.retire(name, keep=set())  # that round is over

    # ------------------------------------------------------------- C7
    def catalog(self, stats: Sequence[str] = ("row_count", "null_count", "min_value", "max_value")) -> DataFrame:
        """Column catalog of every published relation of the schema, with the
        relation and column comments and statistics (one aggregate per relation)."""
        from modelsmith.operators.stats import column_stats

        pub = self.publisher
        frames = []
        for name in pub.models():
            qualified = pub.qualified(name)
            built = pub.current_version(name) is not None or pub.segments(name) is not None
            kind = "table" if built else "view"
            comment = self._comment(qualified)
            frames.append(column_stats(self.spark.table(qualified), name, pub.schema, kind, comment,
                                       stats=stats))
        if not frames:
            raise ValueError(f"schema {pub.schema} has no relations")
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def _comment(self, qualified: str) -> str | None:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").collect()
        for r in rows:
            if r.col_name == "Comment":
                return r.data_type
        return None

    # ------------------------------------------------------------- A2
    @_claimed
    def seed(self, name: str, path: str, column_types: Mapping[str, str] | None = None,
             layout: Layout | None = None, **csv_options) -> DataFrame:
        from modelsmith.sources.seeds import load_seed

        df = load_seed(self.spark, path, column_types, **csv_options)
        self.publisher.publish(name, df, layout)
        return self.ref(name)


def validate_snapshot_source(source: DataFrame, unique_key, strategy: str, updated_at: str | None) -> None:
    """Refuse inputs that have no well-defined history: duplicate or NULL keys,
    and NULL ``updated_at`` under the timestamp strategy. One grouped pass
    (partial aggregation, so a hot key is collapsed map-side); only whether a
    bad group exists reaches the driver."""
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    null_key = None
    for k in keys:
        cond = F.col(k).isNull()
        null_key = cond if null_key is None else (null_key | cond)
    aggs = [F.count(F.lit(1)).alias("_n")]
    if strategy == "timestamp" and updated_at:
        aggs.append(F.max(F.col(updated_at).isNull().cast("int")).alias("_null_ts"))
    else:
        aggs.append(F.lit(0).alias("_null_ts"))
    groups = source.groupBy(*keys).agg(*aggs)
    bad = groups.filter((F.col("_n") > 1) | null_key | (F.col("_null_ts") > 0)).limit(1).collect()
    if bad:
        row = bad[0]
        if row["_n"] > 1:
            raise SnapshotInputError(f"snapshot source has duplicate keys on {keys}")
        raise SnapshotInputError("snapshot source has NULL keys or NULL updated_at values")
