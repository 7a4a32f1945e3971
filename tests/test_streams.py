"""Streams against their batch results: over restarts, late rows and several landed files."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.operators import census as C
from aftermerge.operators import outcomes as O
from aftermerge.operators.prefilter import prefilter_flags
from aftermerge.streaming import jobs
from workload import queries as Q
from workload.check import compare, connect
from workload.rules import compiled

COMMIT = (
    "event_id string, repo string, pusher_login string, pushed_at timestamp, push_size int, sha string, message string,"
    " author_name string, author_email string, is_distinct boolean"
)
START = dt.datetime(2025, 9, 1)
SIGNED = "Add retry\n\nCo-Authored-By: Heron <bot@heron.example>"


def commits(seed: int, many: int, days: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(many):
        message = rng.choice([SIGNED, "Tidy", "Tidy", "Tidy", 'Revert "Tidy"\n\nThis reverts commit ' + "a" * 40 + "."])
        at = START + dt.timedelta(minutes=rng.randint(0, days * 24 * 60 - 1))
        sha = "bad" if i % 37 == 5 else f"{i:040x}"
        repo = rng.choice([None, "o/a", "o/b", "O/a", "o/c", "o/quiet"])
        if repo == "o/quiet":
            message = "Tidy"
        rows.append((f"e{i}", repo, "ada", at, 1, sha, message, "Ada", "ada@example.com", True))
    return sorted(rows, key=lambda r: r[3])


def land(spark: SparkSession, folder: Path, name: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, COMMIT).coalesce(1).write.parquet(str(folder / name))


def listen(spark: SparkSession, folder: Path) -> DataFrame:
    files = spark.readStream.schema(COMMIT).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
    return files.parquet(str(folder)).withColumn("day", F.col("pushed_at").cast("date"))


def stored(spark: SparkSession, rows: list[tuple]) -> set[tuple]:
    df = spark.createDataFrame(rows, COMMIT).withColumn("day", F.col("pushed_at").cast("date"))
    judged = C.judge_commits(C.select_observations(prefilter_flags(df, compiled())), compiled())
    return as_set(C.flatten_observation(judged.where("reject_reason is null"), 1))


def as_set(df: DataFrame) -> set[tuple]:
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def drain(spark: SparkSession, stream: DataFrame, out: Path) -> DataFrame:
    jobs.start_file_sink(stream, str(out / "rows"), str(out / "checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(out / "rows"))


def test_census_stream_over_a_restart_and_late_rows(spark: SparkSession, tmp_path: Path) -> None:
    rows = commits(3, 400, 6)
    late = [r for i, r in enumerate(rows) if i % 11 == 0]  # land a file later, less than a day behind
    source, out = tmp_path / "in", tmp_path / "out"
    day = lambda r: (r[3] - START).days
    files = [[r for r in rows if day(r) == d and r not in late or d and day(r) == d - 1 and r in late and r[3].hour >= 12] for d in range(6)]
    lost = [r for r in late if not any(r in f for f in files)]  # the early half of late days: never landed
    landed = [r for f in files for r in f]
    assert len(landed) + len(lost) == len(rows)

    def stream() -> DataFrame:
        return jobs.census_stream(listen(spark, source), listen(spark, source), compiled(), 1)

    for d in range(3):
        land(spark, source, f"f{d}", files[d])
    first = as_set(drain(spark, stream(), out))
    assert first and max(r[0] for r in first) < dt.date(2025, 9, 3)  # open days wait
    for d in range(3, 6):
        land(spark, source, f"f{d}", files[d])
    land(spark, source, "tick", [("t", "t/t", None, dt.datetime(2026, 1, 1), None, "0" * 40, "", None, None, None)])
    done = as_set(drain(spark, stream(), out))
    assert first < done
    assert done == stored(spark, landed)
    assert not any(r[4] == "o/quiet" for r in done)


def test_rows_beyond_the_lateness_are_dropped(spark: SparkSession, tmp_path: Path) -> None:
    source, out = tmp_path / "in", tmp_path / "out"
    row = lambda i, at: (f"e{i}", "o/a", "ada", at, 1, f"{i:040x}", SIGNED, "Ada", "ada@example.com", True)
    land(spark, source, "f0", [row(0, START)])
    land(spark, source, "f1", [row(1, START + dt.timedelta(days=9))])
    land(spark, source, "f2", [row(5, START + dt.timedelta(days=10))])  # day 0 closes with this batch
    land(spark, source, "f3", [row(2, START + dt.timedelta(hours=1)), row(3, START + dt.timedelta(days=20))])
    land(spark, source, "f4", [row(4, START + dt.timedelta(days=60))])
    got = drain(spark, jobs.census_stream(listen(spark, source), listen(spark, source), compiled(), 1), out)
    assert {(r["event_id"], r["commits_in_repo_day"]) for r in got.collect()} == {("e0", 1), ("e1", 1), ("e5", 1), ("e3", 1)}


def causal(seed: int) -> list[tuple]:
    """Commits, reverts by SHA and number, reverts of reverts, reapplies and copies, in causal order."""
    rng = random.Random(seed)
    rows: list[tuple] = []
    for i in range(150):
        at = START + dt.timedelta(hours=3 * i)
        sha = f"{rng.getrandbits(160):040x}"
        repo = rng.choice(["o/a", "o/b"])
        before = [r for r in rows if r[1].lower() == repo]
        kind = rng.random()
        if kind < 0.45 or not before:
            message = f"Add thing (#{i})" if kind < 0.3 else "Tidy"
        else:
            target = rng.choice(before[-8:])
            name = target[5][: rng.choice([7, 9, 40])]
            word = "Reapply" if kind > 0.9 else "Revert"
            message = f'{word} "x"\n\nThis reverts commit {name}.'
            numbered = [r[6] for r in before if r[6].startswith("Add")]
            if kind < 0.65 and numbered:
                message = f'Revert "{rng.choice(numbered[-4:])}"'
        row = (f"e{i:04}", repo, "ada", at, 1, sha, message, "Ada", "ada@example.com", True)
        rows.append(row)
        if i % 9 == 0:  # the same push, landed once more
            rows.append(("z" + row[0], repo.upper(), *row[2:]))
    return rows


def test_standing_reverts_equal_the_batch_links(spark: SparkSession, tmp_path: Path) -> None:
    rows = causal(5)
    source, out = tmp_path / "in", tmp_path / "out"
    for k in range(3):
        land(spark, source, f"f{k}", rows[k * len(rows) // 3 : (k + 1) * len(rows) // 3])
        pairs = drain(spark, jobs.undo_pairs(listen(spark, source), listen(spark, source)), out)
    found = {tuple(r) for r in jobs.standing_reverts(pairs).collect()}
    judged = C.valid_commits(spark.createDataFrame(rows, COMMIT)).withColumns({"at": F.col("pushed_at"), "agent_id": F.lit(None).cast("string")})
    links = O.revert_links(O.changes(judged))
    soon = links.where("reverted_at <= committed_at + INTERVAL 30 DAYS")
    assert found == {tuple(r) for r in soon.select("repo_key", "sha", "committed_at", "revert_sha", "reverted_at", "linked_by").collect()}
    assert {r[5] for r in found} == {"sha", "pr"} and len(found) > 20


def test_a_revert_taken_back_later_is_withdrawn(spark: SparkSession, tmp_path: Path) -> None:
    a, b, c = ("a" * 40, "b" * 40, "c" * 40)
    undo = lambda sha, word="Revert": f'{word} "x"\n\nThis reverts commit {sha}.'
    at = lambda d: START + dt.timedelta(days=d)
    row = lambda i, d, sha, m: (f"e{i}", "o/a", "ada", at(d), 1, sha, m, "Ada", "ada@example.com", True)
    source, out = tmp_path / "in", tmp_path / "out"
    land(spark, source, "f0", [row(0, 0, a, "Add"), row(1, 1, b, undo(a))])
    pairs = drain(spark, jobs.undo_pairs(listen(spark, source), listen(spark, source)), out)
    assert [(r["sha"], r["revert_sha"]) for r in jobs.standing_reverts(pairs).collect()] == [(a, b)]
    land(spark, source, "f1", [row(2, 2, c, undo(b, "Reapply"))])
    pairs = drain(spark, jobs.undo_pairs(listen(spark, source), listen(spark, source)), out)
    assert jobs.standing_reverts(pairs).count() == 0


def test_census_stream_meets_totals_of_its_own_day_only(spark: SparkSession, tmp_path: Path) -> None:
    land(spark, tmp_path / "in", "a", commits(5, 20, 3))
    listened = listen(spark, tmp_path / "in")
    plan = jobs.census_stream(listened, listened, compiled(), 1)._jdf.queryExecution().analyzed().toString()
    assert "of_day" in plan and "of_closed" in plan  # keyed by day as well, not by repository alone
    day = spark.sql("SELECT explode(array(-1, 0, 86399, 86400)) s").select(F.timestamp_seconds("s").alias("t"))
    assert [r[0] for r in day.select(jobs._utc_day("t")).collect()] == [-1, 0, 0, 1]


SF = "/root/testdata/sf0.001"
LANDED = "stream_revert_links stream_standing_reverts stream_census_observations stream_attribution".split()


@pytest.mark.parametrize("name", LANDED)
def test_streams_over_files_that_land_in_turn(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, name: str) -> None:
    monkeypatch.setattr(Q, "LANDED_ROWS", 400)
    verdict = compare(spark, SF, name, connect(SF))
    assert verdict.startswith("ok"), verdict


def test_streams_hold_a_few_files_not_the_table(
    spark: SparkSession, monkeypatch: pytest.MonkeyPatch, tmp_path: Path
) -> None:
    monkeypatch.setattr(Q, "LANDED_ROWS", 100)
    lines = Q._landed(spark, Q._landing(spark, SF))
    pairs = jobs.revert_pairs(Q._commit_stream(lines), Q._commit_stream(lines))
    run = jobs.start_file_sink(pairs, str(tmp_path / "rows"), str(tmp_path / "checkpoint"))
    run.awaitTermination()
    held = [max(s["numRowsTotal"] for s in p["stateOperators"]) for p in run.recentProgress if p["stateOperators"]]
    assert len(held) >= 8  # a batch for each file
    assert max(held) < spark.read.parquet(f"{SF}/lineitem.parquet").count() / 2


def test_landed_files_go_on_where_the_one_before_ended(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    monkeypatch.setattr(Q, "LANDED_ROWS", 100)
    landed = spark.read.parquet(Q._landing(spark, SF, pulse=True))
    table = spark.read.parquet(f"{SF}/lineitem.parquet").select(*Q.V.LINE_COLUMNS)
    lines = landed.where("NOT pulse").select(*Q.V.LINE_COLUMNS)
    assert lines.exceptAll(table).isEmpty() and table.exceptAll(lines).isEmpty()
    age = "_metadata.file_modification_time AS age"
    timed = Q.V.with_push_time(landed.selectExpr("*", age))
    spans = timed.groupBy("age").agg(F.min("pushed_at").alias("low"), F.max("pushed_at").alias("high"), F.max("pulse").alias("pulse"))
    files = spans.orderBy("age").collect()
    assert len(files) >= 9 and [f["pulse"] for f in files] == [False] * (len(files) - 1) + [True]
    assert all(a["high"] <= b["low"] for a, b in zip(files[:-2], files[1:-1], strict=True))
