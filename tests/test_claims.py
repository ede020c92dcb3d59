"""Builders that meet: one publishes, the other gets a conflict, no rows are lost."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from modelsmith.operators.claims import BuildConflict, Claims
from modelsmith.operators.project import Project
from tests.conftest import rows


def test_one_of_two_builders_publishes(spark):
    first, second = Project(spark, "claims_two"), Project(spark, "claims_two")
    first.incremental("m", spark.range(3), unique_key="id")

    def slow(ctx):
        with pytest.raises(BuildConflict, match="another builder has m"):
            second.incremental("m", spark.range(10, 12), unique_key="id")
        second.table("other", spark.range(1))  # other models are free
        return spark.range(3, 5)

    first.incremental("m", slow, unique_key="id")
    assert rows(first.ref("m")) == [(i,) for i in range(5)]
    second.incremental("m", spark.range(10, 12), unique_key="id")
    assert sorted(r.id for r in second.ref("m").collect()) == [*range(5), 10, 11]
    assert set(first.publisher.models()) == {"m", "other"}


@pytest.mark.parametrize("build", ["table", "incremental", "incremental_runs", "snapshot", "segmented", "append"])
def test_a_builder_that_was_taken_for_dead_publishes_nothing(spark, build):
    late, other = Project(spark, f"claims_late_{build}"), Project(spark, f"claims_late_{build}")
    other.publisher.claims.lifetime = -1.0  # every claim counts as a dead builder's
    at = F.lit("2024-01-01").cast("timestamp_ntz")

    def run(project, model):
        if build == "table":
            return project.table("m", model)
        if build == "append":
            return project.incremental("m", model)
        if build in ("snapshot", "segmented"):
            return project.snapshot("m", model, "id", updated_at="at", segmented=build == "segmented")
        return getattr(project, build)("m", model, unique_key="id")

    def ids(n):
        return spark.range(n, n + 2).withColumn("at", at)

    run(other, ids(0))

    def overtaken(*_):
        run(other, ids(4))
        return ids(8)

    late_model = overtaken if build == "table" else (lambda ctx: overtaken())
    with pytest.raises(BuildConflict, match="nothing was published"):
        run(late, late_model)
    expected = {4, 5} if build == "table" else {0, 1, 4, 5}
    assert {r.id for r in late.ref("m").collect()} == expected
    assert {r.id for r in run(late, ids(20)).collect()} == expected - ({4, 5} if build == "table" else set()) | {20, 21}


def test_failed_builds_release_their_claim(spark):
    project = Project(spark, "claims_failed")
    with pytest.raises(ZeroDivisionError):
        project.table("m", lambda: 1 / 0)
    assert not project.publisher.claims.open("m")
    project.table("m", spark.range(2))


def test_orphans_of_a_running_build_stay(spark):
    project, cleaner = Project(spark, "claims_orphans"), Project(spark, "claims_orphans")
    project.table("m", spark.range(2))
    with project.publisher.claims.claimed("m"):
        name, _ = project.publisher.stage("m", spark.range(3))
        project.publisher.write_version("m", spark.range(4))
        assert cleaner.publisher.drop_orphans() == []
        assert spark.table(name).count() == 3
    assert len(cleaner.publisher.drop_orphans()) == 2


def test_many_builders_at_once(spark, tmp_path):
    """Of builders that claim at the same instant, at most one gets the model; numbers are never given twice."""
    builders = [Claims(spark, f"file:{tmp_path}/claims") for _ in range(6)]

    def attempt(claims):
        try:
            return claims.take("m")
        except BuildConflict:
            return None

    seen = []
    for _ in range(5):
        with ThreadPoolExecutor(6) as pool:
            got = list(pool.map(attempt, builders))
        winners = [(b, n) for b, n in zip(builders, got) if n is not None]
        assert len(winners) <= 1
        for b, n in winners:
            seen.append(n)
            b.release("m")
    assert seen and seen == sorted(set(seen))
