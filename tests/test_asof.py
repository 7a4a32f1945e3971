"""As-of joins against a plain search, for hot and cold keys."""

from __future__ import annotations

import datetime as dt
import random
import re
from bisect import bisect_right

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aftermerge.operators.asof import asof_join, block_at, time_blocks

START = dt.datetime(2026, 1, 1)


def plain(rows: list[tuple], states: list[tuple]) -> dict[int, tuple]:
    out = {}
    for i, key, at in rows:
        known = [s for s in states if s[0] == key and s[1] is not None and at is not None and key is not None and s[1] <= at]
        best = max(known, key=lambda s: (s[1], (s[2] is not None, s[2]), (s[3] is not None, s[3])), default=(None,) * 4)
        out[i] = (best[2], best[3])
    return out


def made(seed: int) -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["warm", "cold", "unset", None]
    time = lambda: START + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 9))
    rows = [(i, rng.choice(keys), None if i % 50 == 3 else time()) for i in range(600)]
    states = [
        (rng.choice(["hot", "hot", "warm", "cold", None]), time() if k % 9 else None, rng.choice(["Go", "C", None]), k)
        for k in range(60)
    ]
    states += [("hot", states[0][1], "A", 1), ("hot", states[0][1], "A", 2)]  # set at the same time
    return rows, states


@pytest.mark.parametrize("hot_rows", [1_000_000, 40, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_every_row_meets_the_last_state(spark: SparkSession, seed: int, hot_rows: int) -> None:
    rows, states = made(seed)
    left = spark.createDataFrame(rows, "id int, repo string, at timestamp")
    right = spark.createDataFrame(states, "repo string, since timestamp, language string, stars int")
    found = asof_join(left, right, ["repo"], "at", "since", hot_rows)
    assert found.columns == ["id", "repo", "at", "language", "stars"]
    got = {r["id"]: (r["language"], r["stars"]) for r in found.collect()}
    assert len(got) == len(rows) and got == plain(rows, states)


def test_hot_keys_are_cut_into_even_blocks_of_time(spark: SparkSession) -> None:
    hours = [("hot", START + dt.timedelta(hours=h)) for h in range(100) for _ in range(10)]
    hours += [("cold", START)] * 10
    times = spark.createDataFrame(hours, "repo string, hour timestamp")
    blocks = time_blocks(times, ["repo"], 50).collect()
    assert {r["repo"] for r in blocks} == {"hot"}
    assert len(blocks) == 100 and len({r["block"] for r in blocks}) == 20
    by_time = [r["block"] for r in sorted(blocks, key=lambda r: r["hour"])]
    assert by_time == sorted(by_time)


def test_several_keys_empty_sides_and_clashing_names(spark: SparkSession) -> None:
    left = spark.createDataFrame([(1, "a", "x", START)], "id int, owner string, name string, at timestamp")
    right = spark.createDataFrame([("a", "x", START, 5), ("a", "y", START, 6)], "owner string, name string, since timestamp, stars int")
    keys = ["owner", "name"]
    assert asof_join(left, right, keys, "at", "since").first()["stars"] == 5
    assert asof_join(left, right.limit(0), keys, "at", "since").first()["stars"] is None
    assert asof_join(left.limit(0), right, keys, "at", "since").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof_join(left, right.withColumnRenamed("stars", "id"), keys, "at", "since")


def test_blocks_are_found_by_bisection(spark: SparkSession) -> None:
    begins = [[START + dt.timedelta(hours=3 * k) for k in range(n)] for n in range(1, 20)]
    times = [START + dt.timedelta(hours=h, minutes=m) for h in range(-2, 60) for m in (0, 1)]
    rows = [(b, t) for b in begins for t in times] + [(None, START)]
    found = spark.createDataFrame(rows, "_begins array<timestamp>, at timestamp").select("*", block_at(F.col("at")).alias("n"))
    for row in found.collect():
        assert row["n"] == (bisect_right(row["_begins"], row["at"]) if row["_begins"] else 0)


def test_rows_are_shuffled_once_whatever_their_size(spark: SparkSession) -> None:
    """Rows aren't dealt by hour to meet their blocks, nor counted per hour where no key is hot."""
    left = spark.createDataFrame([(1, "a", START)], "id int, repo string, at timestamp")
    right = spark.createDataFrame([("a", START, 5)], "repo string, since timestamp, stars int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = asof_join(left, right, ["repo"], "at", "since")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"SortMergeJoin \[_k0#\d+, hour#\d+", plan)
    assert re.search(r"BroadcastHashJoin \[_k0#\d+\], \[_k0#\d+\], LeftSemi", plan)
