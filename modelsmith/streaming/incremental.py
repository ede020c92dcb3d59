"""Keep an incremental model up to date from a stream.

The reference has no streaming operators; the nearest thing is the
incremental model, which is re-run on a schedule and picks up new rows. On
Spark the same materialization can be driven by Structured Streaming:
``foreachBatch`` hands each micro-batch to :meth:`Project.incremental`
(append, or upsert on ``unique_key``), so every batch is one build with the
usual staging, schema policy and publish. The stream's progress lives in a
checkpoint under the cluster's shared ``spark.checkpoint.dir``.

Replays: after a failure Spark may hand the same batch id again. The id of
the last applied batch is kept as a property of the model's view; a batch
at or below it is skipped. (Appends in place commit before the property is
set, so an append can still repeat if the driver dies between the two;
upserts on a unique key are idempotent anyway.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from modelsmith.operators.project import Project
from modelsmith.operators.publish import Layout, sql_string
from modelsmith.session import ensure_checkpoint_dir

_BATCH_PROP = "modelsmith.stream.last_batch"


def _last_batch(project: Project, name: str) -> int:
    if project.publisher.kind(name) != "view":
        return -1
    props = {r["key"]: r["value"] for r in project.spark.sql(
        f"SHOW TBLPROPERTIES {project.publisher.qualified(name)}").collect()}
    return int(props.get(_BATCH_PROP, -1))


def _mark_batch(project: Project, name: str, batch_id: int) -> None:
    project.spark.sql(
        f"ALTER VIEW {project.publisher.qualified(name)} SET TBLPROPERTIES "
        f"({sql_string(_BATCH_PROP)} = {sql_string(str(batch_id))})"
    )


def stream_into_model(
    project: Project,
    name: str,
    stream: DataFrame,
    unique_key: str | Sequence[str] | None = None,
    on_schema_change: str = "ignore",
    layout: Layout | None = None,
    checkpoint_location: str | None = None,
    trigger: Mapping[str, object] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start a streaming query that applies each micro-batch to the model.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (for example
    ``{"availableNow": True}`` for a catch-up run, or
    ``{"processingTime": "5 minutes"}``).
    """
    if not stream.isStreaming:
        raise ValueError("stream must be a streaming DataFrame (spark.readStream...)")
    if checkpoint_location is None:
        base = ensure_checkpoint_dir(project.spark)
        if base is None:
            raise ValueError("no checkpoint_location given and spark.checkpoint.dir is not set")
        checkpoint_location = f"{base.rstrip('/')}/modelsmith-streams/{project.publisher.schema}.{name}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= _last_batch(project, name):
            return
        project.incremental(name, batch, unique_key=unique_key,
                            on_schema_change=on_schema_change, layout=layout)
        _mark_batch(project, name, batch_id)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
