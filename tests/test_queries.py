"""Registered queries against their SQL, on the smallest data.

A cross-section by default; set ``CHECK_ALL=1`` for every query (several minutes).
"""

from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

import __spark_entry__ as entry
from workload.check import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "trailers_exploded evidence_table reverts_parsed census_observations panel_members panel_commits "
    "revert_links revert_rate_30d review_burden stream_daily_counts stream_revert_links"
).split()
NAMES = sorted(entry.queries()) if os.environ.get("CHECK_ALL") else SAMPLE


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark: SparkSession, name: str) -> None:
    verdict = compare(spark, SF, name, connect(SF))
    assert verdict.startswith(("ok", "rows only")), verdict


def test_contract(spark: SparkSession) -> None:
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
