"""Estimates and their errors against plain arithmetic, and how often intervals hold."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.operators import estimates
from aftermerge.operators.outcomes import Z_95

MEMBER = "repo string, cohort string, treated_rate double, control_rate double"


def panel(rng: random.Random, many: int) -> list[tuple]:
    return [(f"O/r{i}", "treated" if i % 3 else "control", 0.5, 0.2) for i in range(many)]


def plain_rate(rows: list[tuple], members: list[tuple]) -> tuple[float, float]:
    """Share and standard error from the residuals of every member, zeros included."""
    rate = {m[0].lower(): (m[1], m[2] if m[1] == "treated" else m[3]) for m in members}
    n, y = defaultdict(int), defaultdict(int)
    for repo, hit in rows:
        if repo.lower() in rate:
            n[repo.lower()] += 1
            y[repo.lower()] += hit
    total = sum(n[r] / f for r, (_, f) in rate.items())
    p = sum(y[r] / f for r, (_, f) in rate.items()) / total
    variance = 0.0
    for cohort in ("treated", "control"):
        of = [r for r, (c, _) in rate.items() if c == cohort]
        f, m = rate[of[0]][1], len(of)
        e = [y[r] - p * n[r] for r in of]
        mean = sum(e) / m
        variance += (1 - f) / f**2 * m / (m - 1) * sum((x - mean) ** 2 for x in e)
    return p, math.sqrt(variance) / total


def test_panel_rate_is_the_weighted_ratio(spark: SparkSession) -> None:
    rng = random.Random(4)
    members = panel(rng, 60)
    rows = [(rng.choice(members)[0].upper(), "heron" if rng.random() < 0.5 else None, rng.random() < 0.3) for _ in range(500)]
    rows += [("stranger/x", "heron", True)] * 20  # no member
    df = spark.createDataFrame(rows, "repo string, agent_id string, hit boolean")
    drawn = spark.createDataFrame(members, MEMBER)
    found = {r["agent_id"]: r for r in estimates.panel_rate(df, drawn, F.col("hit"), ["agent_id"]).collect()}
    for agent in ("heron", None):
        p, e = plain_rate([(r[0], r[2]) for r in rows if r[1] == agent], members)
        got = found[agent]
        assert got["rate"] == pytest.approx(p, abs=1e-6) and got["std_error"] == pytest.approx(e, abs=1e-6)
        assert got["ci_low"] == pytest.approx(p - Z_95 * e, abs=2e-6)
    (whole,) = estimates.panel_rate(df, drawn, F.col("hit")).collect()
    assert whole["rate"] == pytest.approx(plain_rate([(r[0], r[2]) for r in rows], members)[0], abs=1e-6)


def test_a_cohort_of_one_has_no_error(spark: SparkSession) -> None:
    drawn = spark.createDataFrame([("a/x", "treated", 0.5, 0.2)], MEMBER)
    df = spark.createDataFrame([("a/x", True), ("a/x", False)], "repo string, hit boolean")
    (got,) = estimates.panel_rate(df, drawn, F.col("hit")).collect()
    assert got["rate"] == 0.5 and got["std_error"] is None and got["ci_low"] is None
    assert estimates.panel_rate(df.limit(0), drawn, F.col("hit")).first()["rate"] is None


def test_panel_intervals_hold_the_population_share(spark: SparkSession) -> None:
    """Repositories sampled from a population of unlike ones: nearly all intervals hold."""
    rng = random.Random(8)
    population = []
    for i in range(400):
        cohort = "treated" if i < 150 else "control"
        p = rng.betavariate(2, 3) if cohort == "treated" else rng.betavariate(1, 6)
        n = rng.randint(1, 12)
        population.append((f"o/r{i}", cohort, n, sum(rng.random() < p for _ in range(n))))
    truth = sum(x[3] for x in population) / sum(x[2] for x in population)
    rows, members = [], []
    for draw in range(12):
        for repo, cohort, n, y in population:
            if rng.random() < (0.5 if cohort == "treated" else 0.3):
                members.append((draw, repo, cohort, 0.5, 0.3))
                rows += [(draw, repo, k < y) for k in range(n)]
    drawn = spark.createDataFrame(members, f"draw int, {MEMBER}")
    seen = spark.createDataFrame(rows, "draw int, repo string, hit boolean")
    union: DataFrame | None = None
    for d in range(12):
        own = drawn.where(F.col("draw") == d).drop("draw")
        got = estimates.panel_rate(seen.where(F.col("draw") == d), own, F.col("hit"))
        union = got if union is None else union.unionByName(got)
    assert union.where((F.col("ci_low") <= truth) & (F.col("ci_high") >= truth)).count() >= 10


def test_values_at_ranks(spark: SparkSession) -> None:
    rng = random.Random(3)
    values = [(rng.choice("ab"), rng.choice([rng.randint(-5, 5), rng.randint(0, 10**6)])) for _ in range(400)]
    df = spark.createDataFrame(values, "g string, _v long").groupBy("g", "_v").agg(F.count("*").alias("_n"))
    want = {g: sorted(v for h, v in values if h == g) for g in "ab"}
    ranks = [(g, str(k), k) for g in "ab" for k in (1, 2, 77, len(want[g]))]
    found = estimates.values_at_ranks(df, ["g"], spark.createDataFrame(ranks, "g string, label string, rank long"))
    assert {(r["g"], int(r["label"])): r["value"] for r in found.collect()} == {(g, k): want[g][k - 1] for g, _, k in ranks}


def plain_bounds(rows: list[tuple]) -> tuple:
    values = sorted(v for _, v in rows)
    n = len(values)
    middle = (values[(n - 1) // 2] + values[n // 2]) / 2
    by = defaultdict(list)
    for repo, v in rows:
        by[repo.lower()].append(v <= middle)
    p, m = sum(map(sum, by.values())) / n, len(by)
    half = Z_95 * math.sqrt(sum((sum(x) - p * len(x)) ** 2 for x in by.values()) * m / (m - 1))
    low, high = max(1, math.floor(n / 2 - half)), min(n, math.ceil(1 + n / 2 + half))
    return middle, values[low - 1], values[high - 1]


def test_median_bounds_are_order_statistics(spark: SparkSession) -> None:
    rng = random.Random(5)
    rows = []
    for agent in ("heron", None):
        for i in range(40):
            shift = rng.randint(0, 400_000)  # rows of one repository are alike
            rows += [(agent, f"O/r{i}" if k % 2 else f"o/R{i}", shift + rng.randint(0, 1000)) for k in range(rng.randint(1, 9))]
    df = spark.createDataFrame([*rows, ("solo", "o/x", 4), ("solo", "o/x", 6), ("heron", "o/x", None)], "agent_id string, repo string, v long")
    found = {r["agent_id"]: r for r in estimates.median_interval(df, F.col("v"), ["agent_id"]).collect()}
    for agent in ("heron", None):
        want = plain_bounds([(r[1], r[2]) for r in rows if r[0] == agent])
        assert (found[agent]["median"], found[agent]["median_low"], found[agent]["median_high"]) == want
    assert (found["solo"]["median"], found["solo"]["median_low"]) == (5.0, None)


def test_bounds_widen_with_likeness_in_repositories(spark: SparkSession) -> None:
    rng = random.Random(6)
    base = [rng.randint(0, 10**6) for _ in range(60)]
    rows = [("apart", f"r{i}-{k}", base[i] + k) for i in range(60) for k in range(5)]
    rows += [("alike", f"r{i}", base[i] + k) for i in range(60) for k in range(5)]
    df = spark.createDataFrame(rows, "g string, repo string, v long")
    width = {r["g"]: r["median_high"] - r["median_low"] for r in estimates.median_interval(df, F.col("v"), ["g"]).collect()}
    assert width["alike"] > 1.3 * width["apart"]


def test_logrank_by_hand(spark: SparkSession) -> None:
    """Two strata worked out in full; a repository without a baseline says nothing."""
    rows = [  # repo, agent, age of the revert, age at the end
        ("a", "h", 1, None), ("a", "h", None, 9), ("a", None, 2, None), ("a", None, None, 9),
        ("b", "h", 3, None), ("b", None, 3, None), ("b", None, None, 9), ("c", "h", 1, None),
    ]
    df = spark.createDataFrame(rows, "repo_key string, agent_id string, r int, e int").select(
        "repo_key",
        "agent_id",
        F.date_sub(F.lit("2026-01-10"), F.coalesce("e", F.lit(9))).cast("timestamp").alias("at"),
        F.expr("CAST(date_add(date_sub(DATE'2026-01-10', coalesce(e, 9)), r) AS TIMESTAMP)").alias("reverted_at"),
    )
    (got,) = estimates.stratified_logrank(df, F.lit("2026-01-10").cast("timestamp")).collect()
    # a: at age 1 two of each at risk, one falls; at 2 one of h, two of the baseline. b: at 3 one and two, two fall.
    expected = 2 / 4 + 1 / 3 + 2 * 1 / 3
    variance = 0.25 + (1 / 3) * (2 / 3) + 2 * (1 / 3) * (2 / 3) * (1 / 2)
    assert (got["repos"], got["commits"], got["reverted"]) == (2, 3, 2)
    assert got["expected"] == pytest.approx(expected, abs=1e-4)
    assert got["variance"] == pytest.approx(variance, abs=1e-4)
    assert got["statistic"] == pytest.approx((2 - expected) ** 2 / variance, abs=1e-3)
