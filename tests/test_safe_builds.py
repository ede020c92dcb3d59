"""What a failed build must not lose, and what a seed must not change."""

import os
import tempfile

import pytest

from modelsmith import Project
from modelsmith.sources import seeds
from tests.conftest import rows


@pytest.fixture(scope="module")
def project(spark):
    return Project(spark, "safe_builds")


def test_a_failed_view_build_keeps_the_plain_table(spark, project):
    for partitioned in (False, True):
        name = f"kept_{partitioned}".lower()
        writer = spark.range(5).selectExpr("id", "id % 2 p").write
        (writer.partitionBy("p") if partitioned else writer).saveAsTable(f"safe_builds.{name}")
        with pytest.raises(Exception):
            project.view(name, "SELECT * FROM safe_builds.no_such_table")
        assert spark.table(f"safe_builds.{name}").count() == 5
        with pytest.raises(Exception):  # analysed, but no view: two columns of one name
            project.view(name, "SELECT 1 AS a, 2 AS a")
        assert spark.table(f"safe_builds.{name}").count() == 5 and project.publisher.kind(name) == "table"
        project.view(name, "SELECT 1 AS a")
        assert rows(project.ref(name)) == [(1,)] and project.publisher.kind(name) == "view"


def test_a_publish_carries_the_views_properties(spark, project):
    project.table("carried", spark.range(3).toDF("id"))
    spark.sql("ALTER VIEW safe_builds.carried SET TBLPROPERTIES ('modelsmith.stream.last_batch' = '7')")
    project.table("carried", spark.range(4).toDF("id"))
    assert project.publisher._properties("carried")["modelsmith.stream.last_batch"] == "7" and project.ref("carried").count() == 4


@pytest.mark.parametrize("kind,good,bad", [
    ("Decimal(12, 2)", ["1.23", "", " 4.5 "], "1.239"), ("UInt8", ["0", "255"], "300"), ("UInt8", ["1"], "-1"), ("FixedString(2)", ["ab", "a"], "abcd"),
    ("Int32", ["7"], "7.5"), ("Date", ["2024-01-31"], "2024-02-31"), ("UInt64", ["18446744073709551615"], "18446744073709551616"),
])
def test_declared_seed_types_refuse_what_they_would_change(spark, kind, good, bad):
    def text(values):
        return spark.createDataFrame([(v, "x") for v in values], "v string, other string")

    typed = seeds.type_seed(text(good), {"v": kind})
    assert typed.count() == len(good) and len(typed.collect()) == len(good)
    with pytest.raises(Exception, match="seed value refused: v"):
        seeds.type_seed(text([*good, bad]), {"v": kind}).collect()
    rejects = seeds.seed_rejects(text([*good, bad]), {"v": kind}).collect()
    assert [(r.v, r.other) for r in rejects] == [(bad, "x")] and rejects[0].reason.startswith("v: ")


def test_every_column_declared(spark, project):
    path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "s.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,x|y\n,\n")
    assert rows(project.seed("declared", path, {"a": "Int32", "b": "String"})) == [(1, "x|y"), (None, None)]
    assert project.ref("declared").schema.simpleString() == "struct<a:int,b:string>"
