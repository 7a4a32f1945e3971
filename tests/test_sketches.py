"""Merged sketches against exact distinct counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aftermerge.operators.sketches import LOG_SIZE, distinct_repos, repo_sketches


def test_merged_counts_are_within_the_error(spark: SparkSession) -> None:
    """Days overlap in their repositories; sums of daily counts would be far off."""
    rows = spark.range(60_000).select(
        F.date_add(F.lit(dt.date(2026, 1, 5)), (F.col("id") % 14).cast("int")).alias("day"),
        F.when(F.col("id") % 3 > 0, F.lit("heron")).alias("agent_id"),
        F.concat(F.lit("Org/R"), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("repo"),
    )
    rows = rows.unionByName(rows.withColumn("repo", F.lower("repo")))
    week = F.date_trunc("week", "day").cast("date").alias("week")
    found = {(r["week"], r["agent_id"]): r for r in distinct_repos(repo_sketches(rows), [week, "agent_id"]).collect()}
    exact = rows.groupBy(week, "agent_id").agg(F.count("*").alias("n"), F.count_distinct(F.lower("repo")).alias("d")).collect()
    assert len(found) == len(exact) == 4
    for r in exact:
        got = found[r["week"], r["agent_id"]]
        assert got["commits"] == r["n"]
        assert abs(got["repos"] - r["d"]) <= 4 * 1.04 / 2 ** (LOG_SIZE / 2) * r["d"]
