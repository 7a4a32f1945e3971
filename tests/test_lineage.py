"""Identity through renames: chains, swaps, names taken over, and what outcomes make of it."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.operators import outcomes
from aftermerge.operators.components import connected
from aftermerge.operators.lineage import canonical_repos, sightings, with_repo_key
from aftermerge.sources.sinks import stage

SEEN = "asked string, reported string, repo_id long, seen_on date"


def day(n: int) -> dt.date:
    return dt.date(2026, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def keep(tmp_path):
    folders = iter(range(1000))

    def write(df: DataFrame, name: str) -> DataFrame:
        return stage(df, f"{tmp_path}/{next(folders)}", name)

    return write


def lineage(spark: SparkSession, keep, rows: list[tuple]) -> DataFrame:
    return canonical_repos(spark.createDataFrame(rows, SEEN), keep)


def spans(table: DataFrame) -> dict[str, list[tuple]]:
    out: dict[str, list[tuple]] = {}
    for r in table.orderBy("name", F.asc_nulls_first("valid_from")).collect():
        out.setdefault(r["name"], []).append((r["valid_from"], r["valid_to"], r["repo_key"]))
    return out


def test_components_match_union_find(spark: SparkSession, keep) -> None:
    rng = random.Random(2)
    edges = [(f"v{rng.randint(0, 300)}", f"v{rng.randint(0, 300)}") for _ in range(260)]
    edges += [(f"c{i:03}", f"c{i + 1:03}") for i in range(90)]  # a long chain
    edges += [("lone", "lone")]
    root = {v: v for e in edges for v in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = connected(spark.createDataFrame(edges, "a string, b string"), keep)
    assert {r["vertex"]: r["least"] for r in found.collect()} == root


def test_names_that_never_moved_need_no_row(spark: SparkSession, keep) -> None:
    rows = [("a/x", "a/x", 1, day(0)), ("a/x", "a/x", 1, day(7)), ("b/y", "b/y", None, day(0))]
    assert lineage(spark, keep, rows).count() == 0


def test_a_chain_of_renames_is_one_repository(spark: SparkSession, keep) -> None:
    rows = [("a/x", "a/x", 5, day(0)), ("a/x", "b/x", 5, day(7)), ("a/x", "b/z", 5, day(14))]
    assert spans(lineage(spark, keep, rows)) == {n: [(None, None, "#5")] for n in ("a/x", "b/x", "b/z")}


def test_renames_without_a_number_are_tied_by_name(spark: SparkSession, keep) -> None:
    rows = [("a/x", "a/x", None, day(0)), ("a/x", "b/x", None, day(7)), ("b/x", "c/x", None, day(9))]
    assert {k for s in spans(lineage(spark, keep, rows)).values() for _, _, k in s} == {"~a/x@0"}


def test_swapped_and_reused_names(spark: SparkSession, keep) -> None:
    rows = [
        ("a/x", "a/x", 1, day(0)),
        ("a/y", "a/y", 2, day(0)),
        ("a/x", "a/x", None, day(3)),  # an answer without a number stays with the one before
        ("a/x", "a/x", 2, day(7)),
        ("a/y", "a/y", 1, day(7)),
        ("a/old", "a/new", 3, day(7)),
        ("a/old", "a/old", 4, day(14)),  # taken by another
        ("a/new", "a/new", 3, day(14)),
    ]
    assert spans(lineage(spark, keep, rows)) == {
        "a/x": [(None, day(7), "#1"), (day(7), None, "#2")],
        "a/y": [(None, day(7), "#2"), (day(7), None, "#1")],
        "a/old": [(None, day(14), "#3"), (day(14), None, "#4")],
        "a/new": [(None, None, "#3")],
    }


def test_the_fetch_that_asked_for_a_name_decides(spark: SparkSession, keep) -> None:
    """Another request, by an old name, also reports ``a/x`` that day, with another number."""
    rows = [("a/x", "a/x", 9, day(0)), ("b/x", "a/x", 2, day(0)), ("a/x", "a/x", 2, day(7))]
    assert spans(lineage(spark, keep, rows)) == {
        "a/x": [(None, day(7), "#9"), (day(7), None, "#2")],
        "b/x": [(None, None, "#2")],
    }


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_rows_meet_the_tenure_of_their_day(spark: SparkSession, keep, hot_rows: int) -> None:
    table = lineage(
        spark,
        keep,
        [("a/x", "a/x", 1, day(0)), ("a/x", "a/x", 2, day(7)), ("b/x", "b/x", 1, day(7)), ("a/x", "b/x", 1, day(3))],
    )
    rows = [("A/x", day(1)), ("a/X", day(7)), ("a/x", day(30)), ("b/x", day(30)), ("z/z", day(1)), (None, day(1)), ("a/x", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, repo string, at date")
    got = {r["id"]: r["repo_key"] for r in with_repo_key(df, table, hot_rows=hot_rows).collect()}
    assert got == {0: "#1", 1: "#2", 2: "#2", 3: "#1", 4: "z/z", 5: None, 6: "#1"}
    plain = {r["id"]: r["repo_key"] for r in with_repo_key(df, None).collect()}
    assert plain[1] == "a/x"


def test_sightings_of_snapshots(spark: SparkSession) -> None:
    rows = [("A/x", "B/x", 1, day(0)), ("A/y", None, None, day(0)), ("A/z", None, 7, day(0))]
    seen = sightings(spark.createDataFrame(rows, "repo string, name_with_owner string, repo_id long, fetched_on date"))
    assert {tuple(r) for r in seen.collect()} == {("a/x", "b/x", 1, day(0)), ("a/z", "a/z", 7, day(0))}


def test_reverts_link_across_a_rename(spark: SparkSession, keep) -> None:
    sha = "a" * 40
    undo = f'Revert "Add"\n\nThis reverts commit {sha}.'
    rows = [
        ("a/x", sha, dt.datetime(2026, 1, 1), "Add", "e1"),
        ("b/x", "b" * 40, dt.datetime(2026, 1, 9), undo, "e2"),
        ("A/X", sha, dt.datetime(2026, 1, 2), "Add", "e3"),
        ("b/x", sha, dt.datetime(2026, 1, 9), "Add", "e4"),  # the same commit, pushed once more
    ]
    judged = spark.createDataFrame(rows, "repo string, sha string, at timestamp, message string, event_id string")
    judged = judged.withColumn("agent_id", F.lit("heron"))
    table = lineage(spark, keep, [("a/x", "a/x", 1, day(0)), ("a/x", "b/x", 1, day(7))])
    # Under its names apart, the revert only finds the copy pushed after the rename.
    apart = outcomes.revert_links(outcomes.changes(judged)).collect()
    assert [(r["repo_key"], r["committed_at"].day) for r in apart] == [("b/x", 9)]
    one = outcomes.revert_links(outcomes.changes(judged, table)).collect()
    assert [(r["repo_key"], r["sha"], r["committed_at"].day, r["revert_sha"]) for r in one] == [("#1", sha, 1, "b" * 40)]


def test_a_member_found_under_a_new_name_is_not_lost(spark: SparkSession, keep) -> None:
    rows = [("a/x", "treated", "ok", day(0)), ("a/x", "treated", "not_found", day(7)), ("b/x", "treated", "ok", day(14))]
    snaps = spark.createDataFrame(rows, "repo string, cohort string, status string, fetched_on date")
    table = lineage(spark, keep, [("a/x", "a/x", 1, day(0)), ("b/x", "b/x", 1, day(14))])
    (lost,) = outcomes.first_loss(snaps, table).collect()
    assert (lost["repo_key"], lost["first_lost_on"], lost["last_found_on"]) == ("#1", day(7), day(14))
    assert outcomes.first_loss(snaps).first()["last_found_on"] == day(0)
