import os
import uuid

from pyspark.sql import functions as F

from modelsmith.operators.project import Project
from modelsmith.streaming import stream_into_model


def test_stream_batches_upsert_into_model(spark, scratch):
    src_dir = os.path.join(scratch, f"stream_src_{uuid.uuid4().hex[:6]}")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "value")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    events.filter(F.col("ts") < cut).write.parquet(os.path.join(src_dir, "part1"))
    project = Project(spark, f"s_{uuid.uuid4().hex[:8]}")
    ckpt = os.path.join(scratch, f"ckpt_{uuid.uuid4().hex[:6]}")

    def run():
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(src_dir)
        q = stream_into_model(project, "ev", stream, unique_key="event_id",
                              checkpoint_location=ckpt, trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    assert project.ref("ev").count() == events.filter(F.col("ts") < cut).count()
    # second file overlaps the first (re-sent rows are upserted, not duplicated)
    events.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).write.parquet(
        os.path.join(src_dir, "part2"))
    run()
    assert project.ref("ev").count() == events.count()
    assert project.ref("ev").select("event_id").distinct().count() == events.count()


def test_replayed_batches_are_skipped(spark, scratch):
    from modelsmith.streaming.incremental import _last_batch, _mark_batch

    src_dir = os.path.join(scratch, f"stream_src_{uuid.uuid4().hex[:6]}")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "value")
    events.write.parquet(src_dir)
    project = Project(spark, f"s_{uuid.uuid4().hex[:8]}")
    project.incremental("ev", events.limit(0), unique_key="event_id")
    _mark_batch(project, "ev", 0)                 # pretend batch 0 was applied before a crash
    assert _last_batch(project, "ev") == 0
    stream = spark.readStream.schema(events.schema).parquet(src_dir)
    q = stream_into_model(project, "ev", stream, unique_key="event_id",
                          checkpoint_location=os.path.join(scratch, f"ckpt_{uuid.uuid4().hex[:6]}"),
                          trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    assert project.ref("ev").count() == 0         # the replayed batch 0 was not applied again
