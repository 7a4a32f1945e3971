"""The census job: a set of days of push events to observations and manifests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aftermerge import CENSUS_METHOD, __version__
from aftermerge.operators.census import (
    census_manifest,
    commits_from_pushes,
    exact_revert_flag,
    flatten_observation,
    judge_commits,
    kept_totals,
    manifest_from_metrics,
    manifest_metrics,
    redact_person_emails,
    select_observations,
)
from aftermerge.operators.prefilter import prefilter_flags
from aftermerge.operators.rules import Rule, compile_rules, fingerprint, rules_version
from aftermerge.sources.readers import read_push_events, scan_budget, skipped_days
from aftermerge.sources.sinks import (
    CENSUS_ORDER,
    CENSUS_PARTITIONS,
    clear_partitions,
    in_ranges,
    stage,
    staging_folder,
    write_json,
    write_ordered,
)


MOST_METRICS = 500
"""Counts that are observed while the census is written; a job of more days and agents counts the
stored rows in a pass of its own."""


class OverBudgetError(RuntimeError):
    """The scan would read more bytes than allowed; nothing was read."""


class UnreadableDayError(ValueError):
    """A requested day holds no complete list of commits; nothing was read."""


def judged_commits(
    pushes: DataFrame, rules: Sequence[Rule], *, strict_reference: bool = True
) -> DataFrame:
    """Push events to selected, judged commits: one lazy plan, no intermediate tables."""
    flagged = prefilter_flags(commits_from_pushes(pushes), rules)
    return judge_commits(select_observations(flagged, strict_reference=strict_reference), rules)


def staged_judgement(
    pushes: DataFrame, rules: Sequence[Rule], folder: str, *, strict_reference: bool = True
) -> DataFrame:
    """The same rows by way of two stored tables, for jobs over much data.

    The payload is parsed and flagged once; totals then read only the flag columns. Both being
    stored, the join sees their true sizes. The rows are those of :func:`judged_commits`.
    """
    rows = prefilter_flags(commits_from_pushes(pushes), rules)
    flagged = stage(rows if strict_reference else exact_revert_flag(rows), folder, "flagged")
    totals = stage(kept_totals(flagged), folder, "totals")
    return judge_commits(select_observations(flagged, totals=totals), rules)


def _counted(spark: SparkSession, judged: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """The manifest of the wanted days from stored rows, with zeros for days without any."""
    asked = spark.createDataFrame([(d,) for d in days], "day date")
    counts = ("total", "attributed", "reverts", "baseline", "skipped_invalid")
    found = asked.join(census_manifest(judged), "day", "left")
    return found.select(
        "day",
        *(F.coalesce(name, F.lit(0)).alias(name) for name in counts),
        F.coalesce("by_agent", F.expr("CAST(map() AS map<string, bigint>)")).alias("by_agent"),
    )


def run_census(
    spark: SparkSession,
    path: str,
    days: Iterable[dt.date],
    rules: DataFrame,
    out: str,
    *,
    max_bytes: int | None = None,
    strict_reference: bool = True,
    redact_emails: bool = False,
    registry_version: int | None = None,
) -> DataFrame:
    """Ingest the days and return the stored manifest rows.

    See :func:`staged_judgement`. Judged rows are staged too, so nothing is judged twice, and the
    manifest's counts are observed as the rows are written.

    A day without rows gets an empty file and a manifest row of zeros.

    Raises:
        OverBudgetError: when the files of some day exceed ``max_bytes`` or a day has no files
            to price; nothing is written.
        UnreadableDayError: when a day lies outside the archive's commit-bearing range.
    """
    wanted = sorted(set(days))
    if max_bytes is not None:
        try:
            sizes = scan_budget(spark, path, max_bytes, days=wanted).collect()  # a row per wanted day
        except AnalysisException as error:  # none of the days has a folder
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            sizes = []
        over = [f"{r['day']}: {r['gib']} GiB" for r in sizes if not r["within_budget"]]
        if over:
            raise OverBudgetError(f"scan exceeds {max_bytes} bytes on {', '.join(sorted(over))}")
        unpriced = {d.isoformat() for d in wanted} - {r["day"] for r in sizes}
        if unpriced:
            raise OverBudgetError(f"no files to price on {', '.join(sorted(unpriced))}")
    unreadable = skipped_days(spark, wanted).orderBy("day").collect()
    if unreadable:
        raise UnreadableDayError(", ".join(f"{r['day']}: {r['status']}" for r in unreadable))
    compiled = compile_rules(rules, version=registry_version)
    version = rules_version(rules, registry_version)
    folder = staging_folder(out)
    pushes = read_push_events(spark, path, wanted)
    rows = staged_judgement(pushes, compiled, folder, strict_reference=strict_reference)
    judged = stage(rows, folder, "judged")
    agents = sorted({rule.agent_id for rule in compiled})
    metrics = manifest_metrics(wanted, agents)
    # An empty input is optimised away, and what would observe it.
    observe = len(metrics) <= MOST_METRICS and not judged.isEmpty()
    observed = Observation("census") if observe else None
    ranges = in_ranges(judged, ["day", *CENSUS_ORDER])
    if observed is not None:
        # Behind the shuffle, in the writing stage: every row is counted once, on its way out.
        ranges = ranges.observe(observed, *(count.alias(name) for name, count in metrics.items()))
    stored = flatten_observation(ranges.where("reject_reason is null"), version)
    if redact_emails:
        stored = redact_person_emails(stored)
    write_ordered(stored, f"{out}/observations", CENSUS_PARTITIONS, CENSUS_ORDER)
    if observed is not None:
        counted = manifest_from_metrics(spark, observed.get, wanted, agents)
    else:
        counted = _counted(spark, judged, wanted)
    # A row per wanted day.
    rows = counted.collect()
    empty = [(r["day"], version, CENSUS_METHOD) for r in rows if not r["total"]]
    clear_partitions(stored, f"{out}/observations", CENSUS_PARTITIONS, empty)
    manifest = spark.createDataFrame(rows, counted.schema).withColumns(
        {
            "registry_version": F.lit(version),
            "methodology_version": F.lit(CENSUS_METHOD),
            "software_version": F.lit(__version__),
        }
    )
    # Configuration-sized: one row per rule version.
    marks = F.broadcast(fingerprint(rules))
    write_json(
        manifest.join(marks, "registry_version", "left").withColumn(
            "written_at", F.current_timestamp()
        ),
        f"{out}/manifests",
        CENSUS_PARTITIONS,
    )
    return manifest
