"""Distinct counts that can be merged: stored sketches per day and agent.

A sketch of a few kilobytes stands for the set of repositories of a day and agent; the sketches
of any stretch of days and any choice of agents merge into that of their union, which daily
distinct counts cannot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 12
"""Binary logarithm of a sketch's registers: its standard error is 1.04 / sqrt(2 ** LOG_SIZE), 1.6 %."""


def repo_sketches(commits: DataFrame, log_size: int = LOG_SIZE) -> DataFrame:
    """Per day and agent: commits, and a sketch of the repositories (names compare without case)."""
    return commits.groupBy("day", "agent_id").agg(
        F.count("*").alias("commits"), F.hll_sketch_agg(F.lower("repo"), log_size).alias("repos_sketch")
    )


def distinct_repos(sketches: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Commits and the estimated number of different repositories per group of stored rows."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("repos_sketch"))
    return sketches.groupBy(*by).agg(F.sum("commits").alias("commits"), merged.alias("repos"))
