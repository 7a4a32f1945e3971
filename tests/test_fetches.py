"""Landed fetches: what landed twice counts once, and panel versions are told apart."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aftermerge.operators import activity as A
from workload import queries as Q
from workload.rules import compiled

SF = "/root/testdata/sf0.001"


def test_landed_twice_counts_once(spark: SparkSession) -> None:
    once = Q._activity(spark, SF)
    failed = once.withColumns({"status": F.lit("error"), "request_id": F.lit("zzz")})
    twice = once.unionByName(once).unionByName(failed)
    members = Q._members(spark, SF)
    options = {"fetched_on": Q.FETCHED_ON, "registry_version": 1}

    def counts(activity, pages):
        return (
            A.repo_snapshots(activity, members, Q.FETCHED_ON).groupBy("status").count().orderBy("status").collect(),
            A.panel_commits(A.stitch_history(activity, pages), members, compiled(), **options).count(),
            A.panel_pulls(A.activity_pulls(activity), members, compiled(), **options).count(),
        )

    pages = Q._pages(spark, SF)
    assert counts(twice, pages) == counts(once, pages)


def test_a_manifest_row_per_panel_version(spark: SparkSession) -> None:
    schema = "fetched_on date, panel_version int, status string"
    day = Q.FETCHED_ON
    snapshots = spark.createDataFrame([(day, 1, "ok"), (day, 2, "ok"), (day, 2, "empty")], schema)
    schema = "fetched_on date, panel_version int, agent_id string, is_revert boolean"
    rows = spark.createDataFrame([(day, 2, "a", False), (day, 2, None, True)], schema)
    got = {r["panel_version"]: r for r in A.panel_manifest(snapshots, rows, rows).collect()}
    assert {v: (r["repos"], r["commits"], r["pulls_attributed"]) for v, r in got.items()} == {1: (1, 0, 0), 2: (2, 2, 1)}


def test_bodies_of_repository_fetches_are_parsed_once(spark: SparkSession) -> None:
    history = Q._repo_history(spark, SF)
    assert "from_json" not in history._jdf.queryExecution().optimizedPlan().toString()
    assert history.count() > 0
