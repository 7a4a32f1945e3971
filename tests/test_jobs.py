"""Whole jobs on small landed inputs: census, panel build, panel fetch, budget, plans."""

from __future__ import annotations

import datetime as dt
import json
import re
import tempfile
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.operators import activity as A
from aftermerge.operators import census as C
from aftermerge.operators import panel as P
from aftermerge.operators import rules as R
from aftermerge.operators.prefilter import prefilter_flags
from aftermerge.plans.census import OverBudgetError, UnreadableDayError, judged_commits, run_census
from aftermerge.plans.panel import run_build, run_panel
from aftermerge.schemas import CENSUS, PANEL_MEMBERS, PUSH_EVENTS, RESPONSES, columns
from aftermerge.sources import readers
from aftermerge.sources.sinks import SNAPSHOT_PARTITIONS, clear_absent, in_ranges, write_ordered, write_partitions
from workload import views as V
from workload.rules import RULES_V1, RULES_V2, compiled

DAY = dt.date(2025, 9, 1)
NOON = dt.datetime(2025, 9, 1, 12)
SIGNED = "Add retry\n\nCo-Authored-By: Heron <bot@heron.example>\n"


def folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def event(i: int, repo: str, commits: list[dict] | str | None, login: str = "ada", kind: str = "PushEvent", day: dt.date = DAY) -> tuple:
    payload = json.dumps({"size": 1 if commits is None else len(commits), "commits": commits})
    return (str(i), kind, (repo,), (login,), NOON, payload, day)


def commit(c: str, message: str, **more: object) -> dict:
    return {"sha": c * 40, "message": message, "distinct": True, "author": {"name": "Ada", "email": "ada@example.com"}, **more}


def events(spark: SparkSession) -> DataFrame:
    rows = [
        event(1, "o/r", [commit("a", SIGNED), commit("c", "Tidy")]),
        event(2, "o/r", [commit("b", f'Revert "Add retry (#12)" (#15)\n\nThis reverts commit {"a" * 40}.')], "kestrel-app[bot]"),
        event(3, "o/r", [{**commit("d", "Broken"), "sha": "nope"}, {**commit("e", "x"), "sha": None}]),
        event(4, "quiet/repo", [commit("f", "Nothing here")]),
        event(5, "quiet/repo", None),
        event(6, "o/r", [commit("9", SIGNED)], kind="WatchEvent"),
        event(7, "o/late", [commit("8", SIGNED)], day=dt.date(2025, 10, 7)),
        event(8, "lone/revert", [commit("7", 'Revert "open'), {**commit("6", "x"), "distinct": "yes", "author": {"name": {"a": 1}}}]),
    ]
    return spark.createDataFrame(rows, PUSH_EVENTS)


def rules(spark: SparkSession, document: dict = RULES_V1) -> DataFrame:
    return R.rules_frame(spark, R.rules_from_mapping(document))


def test_commits_from_pushes(spark: SparkSession) -> None:
    rows = {r["sha"]: r for r in C.commits_from_pushes(events(spark)).collect()}
    assert set(rows) == {"a" * 40, "b" * 40, "c" * 40, "nope", "f" * 40, "8" * 40, "7" * 40, "6" * 40}
    odd = rows["6" * 40]
    assert odd["is_distinct"] is True and odd["author_name"] is None and odd["author_email"] is None


def test_census_job(spark: SparkSession) -> None:
    archive, out = folder() + "/archive", folder() + "/out"
    events(spark).write.partitionBy("day").parquet(archive)
    days = [DAY, dt.date(2025, 10, 7)]
    with pytest.raises(UnreadableDayError, match="2025-10-07: no_commit_content"):
        run_census(spark, archive, days, rules(spark), out)
    manifest = {r["day"]: r for r in run_census(spark, archive, [DAY], rules(spark), out).collect()}
    assert set(manifest) == {DAY}
    m = manifest[DAY]
    counts = (m["total"], m["attributed"], m["reverts"], m["baseline"], m["skipped_invalid"])
    assert counts == (4, 2, 1, 2, 1)  # the unterminated revert is kept and counted as baseline
    assert m["by_agent"] == {"heron": 1, "kestrel": 1}
    stored = readers.read_observations(spark, f"{out}/observations")
    rows = {r["sha"]: r for r in stored.collect()}
    assert {s[0] for s in rows} == {"a", "b", "c", "7"}
    assert rows["a" * 40]["agent_id"] == "heron" and rows["a" * 40]["commits_in_repo_day"] == 4
    assert json.loads(rows["a" * 40]["evidence_json"])[0]["signal_id"] == "heron-mail"
    revert = rows["b" * 40]
    assert (revert["reverted_sha"], revert["original_pr_number"], revert["revert_pr_number"]) == ("a" * 40, 12, 15)
    assert revert["pusher_is_bot"] and revert["agent_id"] == "kestrel"
    assert "ada@example.com" not in str([r.asDict() for r in rows.values()])
    assert stored.columns == columns(CENSUS)
    # Another rule version is added beside the first; the same version replaces itself.
    run_census(spark, archive, [DAY], rules(spark, RULES_V2), out)
    run_census(spark, archive, [DAY], rules(spark), out)
    again = readers.read_observations(spark, f"{out}/observations")
    versions = again.groupBy("registry_version").count().orderBy("registry_version").collect()
    assert [tuple(r) for r in versions] == [(1, 4), (2, 4)]
    written = spark.read.json(f"{out}/manifests").where("registry_version = 1").first()
    assert written["total"] == 4 and len(written["fingerprint"]) == 16
    skipped = readers.skipped_days(spark, days).collect()
    assert [tuple(r) for r in skipped] == [(dt.date(2025, 10, 7), "no_commit_content")]


def test_build_draws_controls_from_any_archive_day(spark: SparkSession) -> None:
    archive, out = folder() + "/archive", folder()
    late = dt.date(2026, 8, 31)
    pushes = [event(i, f"o/r{i}", None, day=late) for i in range(20)] + [event(99, "o/early", None)]
    spark.createDataFrame(pushes, PUSH_EVENTS).write.partitionBy("day").parquet(archive)
    spark.createDataFrame([], CENSUS).write.parquet(f"{out}/observations")
    members = run_build(spark, f"{out}/observations", archive, late, f"{out}/panel", version=3, created_on=late, treated_rate=1.0, control_rate=1.0)
    assert {(r["repo"], r["cohort"]) for r in members.collect()} == {(f"o/r{i}", "control") for i in range(20)}
    assert readers.read_members(spark, f"{out}/panel", version=3).count() == 20


def test_budget(spark: SparkSession) -> None:
    archive, out = folder() + "/archive", folder() + "/out"
    events(spark).write.partitionBy("day").parquet(archive)
    size = {r["day"]: r["bytes"] for r in readers.scan_budget(spark, archive, 0).collect()}[DAY.isoformat()]
    within = {r["day"]: r["within_budget"] for r in readers.scan_budget(spark, archive, size).collect()}
    assert within[DAY.isoformat()] is True  # equal to the ceiling passes
    with pytest.raises(OverBudgetError):
        run_census(spark, archive, [DAY], rules(spark), out, max_bytes=size - 1)
    for days in ([DAY, dt.date(2025, 8, 17)], [dt.date(2025, 8, 17)]):
        with pytest.raises(OverBudgetError, match="no files to price on 2025-08-17"):
            run_census(spark, archive, days, rules(spark), out, max_bytes=size)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        readers.read_observations(spark, f"{out}/observations").count()


def test_census_rerun_without_rows_clears_the_day(spark: SparkSession) -> None:
    archive, bare, out = folder() + "/archive", folder() + "/bare", folder() + "/out"
    events(spark).write.partitionBy("day").parquet(archive)
    events(spark).where("type = 'other'").drop("day").write.parquet(f"{bare}/day={DAY}")
    run_census(spark, archive, [DAY], rules(spark), out)
    run_census(spark, archive, [DAY], rules(spark, RULES_V2), out)
    manifest = run_census(spark, bare, [DAY], rules(spark), out).collect()
    assert [(r["day"], r["total"], r["attributed"], r["by_agent"]) for r in manifest] == [(DAY, 0, 0, {})]
    kept = readers.read_observations(spark, f"{out}/observations")
    assert [tuple(r) for r in kept.groupBy("registry_version").count().collect()] == [(2, 4)]
    written = spark.read.json(f"{out}/manifests").where("registry_version = 1")
    assert [r["total"] for r in written.collect()] == [0]


def test_clear_absent_touches_only_requested_partitions(spark: SparkSession) -> None:
    path = folder()
    schema = "name string, fetched_on date, panel_version int"
    keys = [(DAY, v) for v in (1, 2, 3)]
    rows = spark.createDataFrame([(f"o/r{v}", *k) for k in keys for v in k[1:]], schema)
    write_partitions(rows, path, SNAPSHOT_PARTITIONS)
    fewer = rows.where("panel_version = 1")
    write_partitions(fewer, path, SNAPSHOT_PARTITIONS)
    clear_absent(fewer, path, SNAPSHOT_PARTITIONS, keys[:2])
    assert {r["name"] for r in spark.read.schema(schema).parquet(path).collect()} == {"o/r1", "o/r3"}


@pytest.mark.parametrize("strict", [True, False])
def test_selection_is_the_same_with_stored_totals(spark: SparkSession, strict: bool) -> None:
    commits = V.commits(spark, "/root/testdata/sf0.001")
    lost = commits.limit(5).withColumns({"day": F.lit(None).cast("date"), "message": F.lit('Revert "x"')})
    flagged = prefilter_flags(commits.unionByName(lost), compiled()).cache()
    plain = C.select_observations(flagged, strict_reference=strict)
    rows = flagged if strict else C.exact_revert_flag(flagged)
    split = C.select_observations(flagged, strict_reference=strict, totals=C.kept_totals(rows).cache())
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
    seen, kept = flagged.where("day IS NOT NULL").collect(), plain.collect()
    totals: dict[tuple, int] = {}
    candidates = set()
    for r in seen:
        key = (r["day"], r["repo"])
        totals[key] = totals.get(key, 0) + 1
        if r["message_hit"] or r["author_email_hit"] or r["author_name_hit"] or r["pusher_login_hit"]:
            candidates.add(key)
    if strict:
        assert len(kept) == sum((r["day"], r["repo"]) in candidates or r["revert_hit"] for r in seen)
    assert all(r["commits_in_repo_day"] == totals[r["day"], r["repo"]] for r in kept)


def build(spark: SparkSession, treated: list[str], control: list[str], t: float, c: float) -> list[tuple]:
    def frame(repos: list[str]) -> DataFrame:
        return spark.createDataFrame([(r,) for r in repos], "repo string")

    members = P.build_panel(frame(treated), frame(control), version=1, created_on=DAY, treated_rate=t, control_rate=c, control_source="x")
    return [(r["repo"], r["cohort"]) for r in members.orderBy(*P.panel_order()).collect()]


def test_panel(spark: SparkSession) -> None:
    assert build(spark, ["B/x", "a/y", "A/y"], ["b/X", "c/z"], 1.0, 1.0) == [("A/y", "treated"), ("B/x", "treated"), ("c/z", "control")]
    assert build(spark, ["a/y"], ["b/x"], 0.0, 0.0) == []
    repos = [f"o{i}/r" for i in range(500)]
    small = {r for r, _ in build(spark, [], repos, 0.0, 0.1)}
    large = {r for r, _ in build(spark, [], repos, 0.0, 0.2)}
    assert small < large  # raising a rate keeps every member
    with pytest.raises(ValueError):
        build(spark, [], [], 1.5, 0.1)


def history(nodes: list[dict], more: bool = False) -> dict:
    return {"totalCount": len(nodes), "pageInfo": {"hasNextPage": more, "endCursor": "c" if more else None}, "nodes": nodes}


def node(c: str, message: str, login: str | None = "ada") -> dict:
    user = {"login": login, "__typename": "User"} if login else None
    return {"oid": c * 40, "committedDate": "2026-09-02T10:00:00+02:00", "messageHeadline": message[:5], "message": message,
            "author": {"name": "Ada", "email": "ada@example.com", "user": user}, "associatedPullRequests": {"nodes": [{"number": 7}]}}


def pull(number: int, updated: str, **more: object) -> dict:
    return {"number": number, "title": 'Revert "Add (#12)"', "state": "OPEN", "createdAt": "2026-09-01T09:00:00Z", "updatedAt": updated,
            "author": {"login": "kestrel-app[bot]", "__typename": "Bot"}, **more}


def test_panel_job(spark: SparkSession) -> None:
    repo = {"nameWithOwner": "moved/ai", "databaseId": 5, "isFork": False, "stargazerCount": 3, "primaryLanguage": {"name": "Go"},
            "pullRequests": {"nodes": [pull(1, "2026-09-02T00:00:00Z"), pull(2, "2026-08-01T00:00:00Z", merged=True)]},
            "defaultBranchRef": {"name": "main", "target": {"history": history([node("a", SIGNED), node("z", "bad sha")], more=True)}}}
    body = {"data": {"rateLimit": {"cost": 2, "remaining": 9}, "r0": repo, "r1": None, "r2": {"nameWithOwner": "e/e", "defaultBranchRef": None}, "r3": None},
            "errors": [{"type": "NOT_FOUND", "path": ["r1", 3]}, {"type": "OTHER", "path": ["r1"]}]}
    page = {"data": {"rateLimit": {"cost": 1, "remaining": 8}, "repository": {"defaultBranchRef": {"target": {"history": history([node("a", SIGNED), node("b", "x", None)])}}}}}
    landed = spark.createDataFrame(
        [("1", NOON, "batch", ["a/ai", "b/gone", "e/e", "f/odd"], 0, json.dumps(body)), ("2", NOON, "history", ["a/ai"], 1, json.dumps(page))],
        RESPONSES)
    names = ["a/ai", "b/gone", "e/e", "f/odd"]
    members = spark.createDataFrame([(1, DAY, 1.0, 1.0, n, "treated", DAY, "source_a", 1) for n in names], PANEL_MEMBERS)
    out = folder() + "/out"
    since = dt.datetime(2026, 9, 1, tzinfo=dt.UTC)
    m = run_panel(spark, landed, members, rules(spark), since=since, fetched_on=DAY, out=out).first()
    assert m["repos_by_status"] == {"empty": 1, "error": 1, "not_found": 1, "ok": 1}
    assert (m["commits"], m["commits_attributed"], m["pulls"], m["pulls_by_agent"]) == (2, 1, 1, {"kestrel": 1})
    assert (m["requests"], m["points_spent"], m["members_total"]) == (2, 3, 4)
    repos = {r["repo"]: r for r in readers.read_panel_table(spark, out, "repos").collect()}
    assert repos["b/gone"]["error"] == "NOT_FOUND" and repos["f/odd"]["error"] == "no data"
    assert repos["a/ai"]["commits_truncated"] is False
    stored = {r["sha"][0]: r for r in readers.read_panel_table(spark, out, "commits").collect()}
    assert set(stored) == {"a", "b"}
    assert stored["a"]["committed_at"] == dt.datetime(2026, 9, 2, 8) and stored["a"]["associated_pr_number"] == 7
    assert stored["b"]["author_login_hash"] is None and "ada@example.com" not in str(stored)
    only = readers.read_panel_table(spark, out, "pulls").first()
    assert (only["number"], only["is_revert"], only["original_pr_number"], only["author_is_bot"]) == (1, True, 12, True)
    assert A.renamed_repos(A.parse_activity(landed, since=since)).first()["name_with_owner"] == "moved/ai"


def test_activity_arguments(spark: SparkSession) -> None:
    landed = spark.createDataFrame([], RESPONSES)
    with pytest.raises(ValueError, match="time zone"):
        A.parse_activity(landed, since=NOON)
    with pytest.raises(ValueError, match="between 1 and 100"):
        A.parse_activity(landed, since=NOON.replace(tzinfo=dt.UTC), prs_first=101)


def test_invalid_panels_are_refused(spark: SparkSession) -> None:
    rows = [(1, DAY, 1.0, 1.0, n, "treated", DAY, "s", 1) for n in ("a/b", "A/b")]
    with pytest.raises(ValueError, match="more than once"):
        readers.check_members(spark.createDataFrame(rows, PANEL_MEMBERS))


def test_empty_write_keeps_a_readable_table(spark: SparkSession) -> None:
    out = folder() + "/out"
    spark.createDataFrame([], CENSUS).write.parquet(out)
    assert readers.read_observations(spark, out).count() == 0


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark: SparkSession) -> None:
    archive = folder() + "/archive"
    events(spark).write.partitionBy("day").parquet(archive)
    pushes = readers.read_push_events(spark, archive, [DAY])
    plan = plan_of(judged_commits(pushes, compiled()))
    assert "Python" not in plan and "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "EqualTo(type,PushEvent)" in plan and re.search(r"PartitionFilters: \[.*isnotnull\(day", plan)
    attributed = plan_of(judged_commits(pushes, compiled()).where(F.col("agent_id").isNotNull()))
    assert attributed.count("bot@heron") == plan.count("bot@heron")  # a filter repeats no rule
    from aftermerge.operators.outcomes import dedupe_commits

    commits = V.commits(spark, "/root/testdata/sf0.001").withColumnRenamed("pushed_at", "at")
    deduped = plan_of(dedupe_commits(commits))
    assert deduped.count("WindowGroupLimit") == 2  # applied on both sides of the shuffle


def test_rejected_and_redacted(spark: SparkSession) -> None:
    df = spark.createDataFrame([("x", "o/r", SIGNED + "by <a@b.c> and <d@e.f>"), ("a" * 40, "bad", "m"), ("A" * 40, "o/r", "m")], "sha string, repo string, message string")
    reasons = {r["sha"]: r["reject_reason"] for r in C.rejected_commits(df).collect()}
    assert reasons == {"x": "bad_sha", "a" * 40: "bad_repo"}
    assert [r["sha"] for r in C.valid_commits(df).collect()] == ["a" * 40]
    text = C.redact_person_emails(df).where("sha = 'x'").first()["message"]
    assert "@" not in text and text.startswith("Add retry\n\nCo-Authored-By: Heron <")


def test_observed_counts_are_those_of_the_stored_rows(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    """The manifest is counted as rows are written; a job of many days counts the stored rows."""
    days = [DAY, DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=2)]
    rows = []
    for i in range(60):
        message = [SIGNED, "Tidy", 'Revert "x"\n\nThis reverts commit ' + "a" * 40 + "."][i % 3]
        c = {**commit("0", message), "sha": "short" if i % 10 == 7 else f"{i:040x}"}
        rows.append(event(i, f"o/{'ab'[i % 2]}", [c], day=days[i % 2]))
    archive = folder()
    spark.createDataFrame(rows, PUSH_EVENTS).write.partitionBy("day").mode("overwrite").parquet(archive)

    def manifest() -> dict:
        out = folder()
        found = {r["day"]: r.asDict() for r in run_census(spark, archive, days, rules(spark), out).collect()}
        stored = readers.read_observations(spark, f"{out}/observations")
        assert {r["day"]: r["count"] for r in stored.groupBy("day").count().collect()} == {d: m["total"] for d, m in found.items() if m["total"]}
        return found

    observed = manifest()
    assert observed[days[2]]["total"] == 0 and observed[days[1]]["skipped_invalid"] > 0
    assert sum(observed[days[0]]["by_agent"].values()) == observed[days[0]]["attributed"] > 0
    monkeypatch.setattr("aftermerge.plans.census.MOST_METRICS", 0)
    assert manifest() == observed


def test_ordered_store_holds_disjoint_ranges(spark: SparkSession, tmp_path: Path) -> None:
    """Files are sorted and don't overlap, so a range of time touches few of them."""
    rows = [(f"e{i}", f"{i % 97:040x}", dt.datetime(2025, 9, 1) + dt.timedelta(seconds=i * 7919 % 86400)) for i in range(4000)]
    df = spark.createDataFrame(rows, "event_id string, sha string, pushed_at timestamp")
    df = df.withColumns({"day": F.col("pushed_at").cast("date"), "registry_version": F.lit(1)})
    order = ("pushed_at", "event_id", "sha")
    write_ordered(in_ranges(df.repartition(5), ["day", *order], 6), str(tmp_path / "out"), ["day", "registry_version"], order)
    files = sorted((tmp_path / "out").rglob("part-*.parquet"))
    assert len(files) > 3
    stored = [pq.read_table(f, partitioning=None).select(order).to_pylist() for f in files]
    keys = [[tuple(r[c] for c in order) for r in part] for part in stored]
    assert [k for part in keys for k in part] == sorted(k for part in keys for k in part)
    low, high = rows[100][2], rows[100][2] + dt.timedelta(minutes=10)
    touched = [f for f in files if (s := pq.ParquetFile(f).metadata.row_group(0)) and _overlaps(s, low, high)]
    assert 1 <= len(touched) <= 2


def _overlaps(group, low: dt.datetime, high: dt.datetime) -> bool:
    names = [group.column(i).path_in_schema for i in range(group.num_columns)]
    stats = group.column(names.index("pushed_at")).statistics
    first, last = (x.replace(tzinfo=None) for x in (stats.min, stats.max))
    return first <= high and last >= low


def test_unstored_totals_are_not_sent_to_the_driver(spark: SparkSession) -> None:
    pushes = V.push_events(spark, "/root/testdata/sf0.001")
    plan = plan_of(judged_commits(pushes, compiled()))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_spread_rows_are_written_without_a_shuffle(spark: SparkSession) -> None:
    from aftermerge.sources.sinks import write_partitions

    root = folder()
    rows = spark.range(0, 40, 1, 4).withColumn("v", F.lit(1))
    write_partitions(rows, root, ["v"], spread=True)
    assert sorted(r[0] for r in spark.read.parquet(root).select("id").collect()) == list(range(40))
    assert len(spark.read.parquet(root).inputFiles()) == 4  # one a task


def test_panel_candidates_are_listed_once(spark: SparkSession) -> None:
    from workload import queries as Q

    found = Q._candidates(spark, "/root/testdata/sf0.001")
    plan = plan_of(Q._panel(spark, "/root/testdata/sf0.001", 1, 0.5, 0.3, found))
    assert "lineitem" not in plan and "orders" not in plan
