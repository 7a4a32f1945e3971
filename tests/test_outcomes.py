"""Outcome operators against brute force, with hot keys split even at this size."""

from __future__ import annotations

import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aftermerge.functions import text
from aftermerge.functions.patterns import own
from aftermerge.operators import outcomes as O
from aftermerge.operators.joins import lookup_join

T0 = dt.datetime(2025, 1, 1)
DAY = dt.timedelta(days=1)
CHANGE = (
    "repo string, repo_key string, sha string, at timestamp, event_id string, agent_id string, pr_number bigint,"
    "is_fix boolean, is_undo boolean, is_reapply boolean, target_sha string, target_pr bigint"
)


def sha(n: int) -> str:
    return f"{n:07x}" + "0" * 33


def change(n: int, day: float, *, pr: int | None = None, target: str | None = None, target_pr: int | None = None,
           reapply: bool | None = None, repo: str = "o/r", agent: str | None = None) -> tuple:
    undo = target is not None or target_pr is not None
    return (repo, repo, sha(n), T0 + day * DAY, str(n), agent, pr, False, undo, (reapply or False) if undo else None, target, target_pr)


def links(spark: SparkSession, rows: list[tuple], hot: int = 1_000_000) -> dict[str, tuple[str, str]]:
    found = O.revert_links(spark.createDataFrame(rows, CHANGE), hot_rows=hot).collect()
    return {r["sha"]: (r["revert_sha"], r["linked_by"]) for r in found}


def test_revert_links(spark: SparkSession) -> None:
    rows = [
        change(1, 0), change(2, 1, target=sha(1)[:9]),  # short name
        change(3, 0, pr=7), change(4, 2, target_pr=7), change(5, 1, target_pr=7),  # by PR, first one
        change(6, 0), change(7, 1, target=sha(6)), change(8, 2, target=sha(7), reapply=True),  # netted
        change(9, 0), change(10, 1, target=sha(9)), change(11, 2, target=sha(10), reapply=True),
        change(12, 3, target=sha(9)),  # reverted again after the reapply
        change(13, 5), change(14, 1, target=sha(13)),  # older than what it names
        change(15, 0, repo="x/y"), change(16, 1, target=sha(15)),  # other repository
    ]
    expected = {sha(1): (sha(2), "sha"), sha(3): (sha(5), "pr"), sha(9): (sha(12), "sha"), sha(7): (sha(8), "sha")}
    got = links(spark, rows)
    assert got.pop(sha(7), None) is None  # a reapply is no revert
    expected.pop(sha(7))
    assert got == expected
    assert links(spark, rows, hot=1) == got


def test_ambiguous_names_link_to_nothing(spark: SparkSession) -> None:
    twin = ("o/r", "o/r", sha(1)[:39] + "1", T0, "t", None, None, False, False, None, None, None)
    assert links(spark, [change(1, 0), twin, change(2, 1, target=sha(1)[:7])]) == {}


def test_commits_are_shuffled_once_to_meet_names(spark: SparkSession) -> None:
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    frame = spark.createDataFrame([change(1, 0), change(2, 1, target=sha(1))], CHANGE)
    for name, value in confs.items():
        spark.conf.set(name, value)
    try:
        plan = O.revert_links(frame)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in confs:
            spark.conf.unset(name)
    shuffled = re.findall(r"(Reused)?Exchange(?: \[[^\n]*\], Exchange)? hashpartitioning\(repo_key#\d+, key7#\d+", plan)
    assert shuffled.count("") == 2  # names and commits


def test_a_commit_undone_under_several_names_stands_by_the_last(spark: SparkSession) -> None:
    rows = [
        change(1, 0), change(2, 3, target=sha(1)),
        change(3, 2, target=sha(2)[:8], reapply=True), change(4, 4, target=sha(2)[:9], reapply=True), change(5, 1, target=sha(2), reapply=True),
    ]
    frame = spark.createDataFrame(rows, CHANGE)
    found = {r["revert_sha"]: r["reapplied_at"] for r in O.net_reapplies(frame, O.resolve_names(frame)).collect()}
    assert found == {sha(2): T0 + 4 * DAY}
    assert links(spark, rows) == {}


def test_packed_shas(spark: SparkSession) -> None:
    """Twenty bytes for a SHA; any other text comes back as it was and equals no other."""
    texts = [
        sha(1), sha(10**8 - 1), sha(1).replace("0", "a"), sha(1).replace("0", "A"), "", "a", "x" * 20, "\0" * 20, "\0" * 19, "\0" * 21,
        "\0" * 21 + "x", "x" * 40, sha(1)[:39], sha(1) + "0", "0" * 64, "\u00e9" * 10, "f" * 38 + " 1", "not-a-sha", None,
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "sha string").select("sha", O.packed_sha("sha").alias("p"))
    found = rows.select("sha", "p", O.unpacked_sha("p").alias("back")).collect()
    assert all(r["back"] == r["sha"] for r in found)
    assert len({None if r["p"] is None else bytes(r["p"]) for r in found}) == len(texts)
    assert [r["sha"] for r in found if r["p"] is not None and len(r["p"]) == 20] == texts[:3]


def test_window_and_follow_up(spark: SparkSession) -> None:
    rows = [change(1, 0, agent="a"), change(2, 30, target=sha(1)), change(3, 0, agent="a"), change(4, 30.5, target=sha(3)), change(5, 40)]
    frame = spark.createDataFrame(rows, CHANGE)
    end = F.lit(T0 + 60 * DAY).cast("timestamp")
    out = {r["sha"]: (r["reverted"], r["followed_up"]) for r in O.commit_outcomes(frame, O.revert_links(frame), data_end=end).collect()}
    assert out == {sha(1): (True, True), sha(3): (False, True), sha(5): (False, False)}


def test_lookup_join_equals_plain_join(spark: SparkSession) -> None:
    rng = random.Random(3)
    rows = [(None if rng.random() < 0.1 else (0 if rng.random() < 0.5 else rng.randint(0, 9)), i) for i in range(2000)]
    left = spark.createDataFrame(rows, "k int, v int")
    right = spark.createDataFrame([(k, f"x{j}") for k in range(0, 8) for j in range(2)], "k int, x string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = sorted(map(str, left.join(right, ["k"], how).collect()))
        assert sorted(map(str, lookup_join(left, right, ["k"], how, hot_rows=50).collect())) == plain
    with pytest.raises(ValueError, match="unsupported"):
        lookup_join(left, right, ["k"], "full_outer")


def test_followed_by_fix_is_exact(spark: SparkSession) -> None:
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        hot = rng.random() < 0.4
        path = "hot" if hot else f"p{rng.randint(0, 20)}"
        at = T0 + rng.choice([1, 7, 14]) * DAY * rng.randint(0, 20) + dt.timedelta(seconds=rng.choice([0, 1]))
        rows.append(("o/r", f"c{i // 2}", at, path, rng.random() < 0.1))
    frame = spark.createDataFrame(rows, "repo string, sha string, at timestamp, path string, is_fix boolean")
    expected: dict[str, bool] = {}
    for _, commit, at, path, _ in rows:
        hit = any(p == path and f and at < t <= at + 14 * DAY for _, _, t, p, f in rows)
        expected[commit] = expected.get(commit, False) or hit
    for hot_rows in (1_000_000, 100):
        got = {r["sha"]: r["followed_by_fix"] for r in O.followed_by_fix(frame, hot_rows=hot_rows).collect()}
        assert got == expected


def test_exact_median(spark: SparkSession) -> None:
    rng = random.Random(9)
    data = {"a": [rng.randint(-10**7, 10**7) for _ in range(501)], "b": [5], "c": [1, 10**9], None: [7] * 300 + [8] * 300}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None)]
    frame = spark.createDataFrame(rows, "g string, v bigint")
    got = {r["g"]: (r["n"], r["median"]) for r in O.exact_median(frame, ["g"], F.col("v")).collect()}
    assert got == {g: (len(vs), float(statistics.median(vs))) for g, vs in data.items()}
    whole = O.exact_median(frame, [], F.col("v")).first()
    assert whole["median"] == float(statistics.median([v for vs in data.values() for v in vs]))


def test_dedupe_keeps_the_earliest(spark: SparkSession) -> None:
    rows = [("O/r", "AA", T0 + DAY, "2"), ("o/r", "aa", T0, "9"), ("o/r", "aa", T0, "1"), ("o/x", "aa", T0, "5")]
    frame = spark.createDataFrame(rows, "repo string, sha string, at timestamp, event_id string")
    assert sorted((r["repo"], r["event_id"]) for r in O.dedupe_commits(frame).collect()) == [("o/r", "1"), ("o/x", "5")]


def test_wilson(spark: SparkSession) -> None:
    frame = spark.createDataFrame([(10, 100), (0, 5), (0, 0)], "y int, n int")
    rows = O.rates_with_ci(frame, "y", "n").collect()
    assert (rows[0]["ci_low"], rows[0]["ci_high"]) == (0.055229, 0.174366)
    assert rows[1]["ci_low"] == 0.0 and rows[2]["ci_low"] is None


def test_survival(spark: SparkSession) -> None:
    rows = [("a", T0, T0 + 2 * DAY), ("a", T0, T0 + 4 * DAY), ("a", T0, None), ("a", T0 + 7 * DAY, None)]
    frame = spark.createDataFrame(rows, "agent_id string, at timestamp, reverted_at timestamp")
    end = F.lit(T0 + 10 * DAY).cast("timestamp")
    curve = {r["age_days"]: (r["at_risk"], r["survival"]) for r in O.revert_survival(frame, end).collect()}
    assert curve == {2: (4, 0.75), 4: (2, 0.375)}


def test_compare_versions(spark: SparkSession) -> None:
    schema = "repo string, sha string, at timestamp, event_id string, old_agent string, new_agent string"
    rows = [
        ("r", "1", T0, "1", "a", "a"),
        ("r", "2", T0, "2", None, "b"),
        ("r", "3", T0, "3", "a", None),
        ("r", "4", T0, "4", "a", "b"),
        ("R", "4", T0 + DAY, "5", "a", "a"),  # a later copy under another spelling
        ("r", "5", T0, "6", None, None),
    ]
    found = O.compare_versions(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["sha"], r["change"]) for r in found) == [
        ("1", "same"), ("2", "gained"), ("3", "lost"), ("4", "changed"), ("5", "same"),
    ]


def test_repositories_compare_without_case(spark: SparkSession) -> None:
    """Two spellings are one cluster, one baseline, one set of files and one covered repository."""
    schema = "repo string, sha string, at timestamp, agent_id string, hit boolean"
    rows = [("O/R", "1", T0, "a", True), ("o/r", "2", T0, None, False), ("o/R", "3", T0, "a", False)]
    frame = spark.createDataFrame(rows, schema)
    base = O.with_baseline(frame, "hit").first()
    assert (base["repos"], base["units"], base["agent_rate"], base["baseline_rate"]) == (1, 2, 0.5, 0.0)
    assert {r["agent_id"]: r["clusters"] for r in O.clustered_rate(frame, "hit", ["agent_id"]).collect()} == {"a": 1, None: 1}
    assert {r["agent_id"]: r["repos"] for r in O.coverage_by_agent(frame).collect()} == {"a": 1, None: 1}
    files = spark.createDataFrame(
        [("O/R", "1", T0, "f", False), ("o/r", "2", T0 + DAY, "f", True)],
        "repo string, sha string, at timestamp, path string, is_fix boolean",
    )
    assert {r["sha"]: r["followed_by_fix"] for r in O.followed_by_fix(files).collect()} == {"1": True, "2": False}


def test_baselines_stay_within_their_period(spark: SparkSession) -> None:
    rng = random.Random(4)
    rows = [
        (rng.choice(["O/r", "o/R", "o/x", None]), T0 + rng.randint(0, 120) * DAY, rng.choice(["a", "b", None, None]),
         rng.random() < 0.4, rng.choice([None, *range(9)]))
        for _ in range(400)
    ]
    frame = spark.createDataFrame(rows, "repo string, at timestamp, agent_id string, hit boolean, v bigint")
    cells: dict[tuple, list] = {}
    for repo, at, agent, hit, v in rows:
        if repo is not None:
            cells.setdefault((repo.lower(), at.month), []).append((agent, hit, v))
    period = O.period_of("at")
    got = {r["agent_id"]: r for r in O.with_baseline(frame, "hit", period=period).collect()}
    medians = {r["agent_id"]: r for r in O.median_with_baseline(frame, F.col("v"), period).collect()}
    for agent in ("a", "b"):
        diffs, own, base = [], [], []
        for members in cells.values():
            mine = [h for a, h, _ in members if a == agent]
            theirs = [h for a, h, _ in members if a is None]
            if mine and theirs:
                diffs.append((len(mine), sum(mine) / len(mine) - sum(theirs) / len(theirs)))
            mine = [v for a, _, v in members if a == agent and v is not None]
            theirs = [v for a, _, v in members if a is None and v is not None]
            if mine and theirs:
                own, base = own + mine, base + theirs
        assert got[agent]["repos"] == len(diffs)
        assert got[agent]["repo_weighted_diff"] == pytest.approx(sum(d for _, d in diffs) / len(diffs), abs=1e-6)
        weighted = sum(n * d for n, d in diffs) / sum(n for n, _ in diffs)
        assert got[agent]["unit_weighted_diff"] == pytest.approx(weighted, abs=1e-6)
        r = medians[agent]
        assert (r["units"], r["agent_median"]) == (len(own), statistics.median(own))
        assert (r["baseline_units"], r["baseline_median"]) == (len(base), statistics.median(base))
    with pytest.raises(ValueError, match="unknown baseline"):
        O.with_baseline(frame, "hit", baseline="all")


def test_fix_words_are_read_in_any_case_that_the_pattern_knows(spark: SparkSession) -> None:
    subjects = ["FIX it", "f\u0131x it", "F\u0130X it", "regre\u017f\u017fion", "Repair", "hotfix", "bUG", "prefix", "Next", "Tidy\n\nfix", "", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(subjects)], "i int, m string")
    plain = F.coalesce(text.subject("m").rlike(own(O.FIX_MESSAGE)), F.lit(False))
    rows = df.select(O.is_fix("m").alias("a"), plain.alias("b"), O.pr_number("m").alias("n")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] and rows[0]["a"] and not rows[9]["a"]


def test_a_letter_of_an_address_does_not_make_a_message_be_read_for_fixes(spark: SparkSession) -> None:
    messages = ["Fix it", "bugfıx", "FİX", "f i x", "Tidy\n\nCo-Authored-By: A <a@example.com>", "repaır", "REPAIR", None]
    df = spark.createDataFrame([(m,) for m in messages], "m string")
    plain = text.subject("m").rlike(own(O.FIX_MESSAGE))
    rows = df.select(O.is_fix("m").alias("a"), F.coalesce(plain, F.lit(False)).alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] and sum(r["a"] for r in rows) >= 3
    assert "x" not in O.FIX_PARTS


def test_rows_are_sorted_by_the_sha_first(spark: SparkSession) -> None:
    plan = O.dedupe_commits(spark.createDataFrame([("o/r", "a", T0, "e")], "repo string, sha string, at timestamp, event_id string"))
    ordered = plan._jdf.queryExecution().optimizedPlan().toString()
    assert ordered.index("lower(sha") < ordered.index("lower(repo")
