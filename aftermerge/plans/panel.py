"""The panel jobs: draw a panel, and turn a landed fetch into its three tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge import PANEL_METHOD, __version__
from aftermerge.operators import activity as A
from aftermerge.operators.census import active_repos
from aftermerge.operators.panel import build_panel, first_members, treated_candidates
from aftermerge.operators.rules import compile_rules, rules_version
from aftermerge.sources.readers import check_members, read_events, read_observations
from aftermerge.sources.sinks import (
    PANEL_PARTITIONS,
    SNAPSHOT_PARTITIONS,
    clear_absent,
    stage,
    staging_folder,
    write_json,
    write_partitions,
)


def run_build(
    spark: SparkSession,
    observations: str,
    archive: str,
    active_on: dt.date,
    out: str,
    *,
    version: int,
    created_on: dt.date,
    treated_rate: float,
    control_rate: float,
) -> DataFrame:
    """Draw a panel from stored observations and one archive day, and store it by version."""
    members = build_panel(
        treated_candidates(read_observations(spark, observations)),
        active_repos(read_events(spark, archive, [active_on])),
        version=version,
        created_on=created_on,
        treated_rate=treated_rate,
        control_rate=control_rate,
        control_source=f"archive_active:{active_on.isoformat()}",
    )
    write_partitions(members, out, ["panel_version"])
    return members


def run_panel(
    spark: SparkSession,
    responses: DataFrame,
    members: DataFrame,
    rules: DataFrame,
    *,
    since: dt.datetime,
    fetched_on: dt.date,
    out: str,
    prs_first: int = 50,
    limit: int | None = None,
) -> DataFrame:
    """Parse a landed fetch, attribute it, write the tables and return the manifest row.

    Response bodies are parsed once, into a staged table the three outputs read from.
    """
    compiled = compile_rules(rules)
    version = rules_version(rules)
    chosen = check_members(members if limit is None else first_members(members, limit))
    folder = staging_folder(out)
    parsed = stage(A.parse_activity(responses, since=since, prs_first=prs_first), folder, "activity")
    pages = stage(A.history_pages(responses), folder, "history")
    snapshots = A.repo_snapshots(A.with_history_flags(parsed, pages), chosen, fetched_on)
    options = {"fetched_on": fetched_on, "registry_version": version}
    commits = A.panel_commits(A.stitch_history(parsed, pages), chosen, compiled, **options)
    pulls = A.panel_pulls(A.activity_pulls(parsed), chosen, compiled, **options)
    # Snapshots do not depend on the rules, so no rule version identifies them.
    write_partitions(snapshots, f"{out}/repos", SNAPSHOT_PARTITIONS)
    write_partitions(commits, f"{out}/commits", PANEL_PARTITIONS)
    write_partitions(pulls, f"{out}/pulls", PANEL_PARTITIONS)
    # As many versions as panels are fetched together.
    versions = [r["panel_version"] for r in chosen.select("panel_version").distinct().collect()]
    keys = [(fetched_on, v, version, PANEL_METHOD) for v in versions]
    clear_absent(snapshots, f"{out}/repos", SNAPSHOT_PARTITIONS, [k[:2] for k in keys])
    clear_absent(commits, f"{out}/commits", PANEL_PARTITIONS, keys)
    clear_absent(pulls, f"{out}/pulls", PANEL_PARTITIONS, keys)
    ledger = A.api_cost(responses).agg(
        F.sum("requests").alias("requests"), F.sum("points_spent").alias("points_spent")
    )
    drawn = members.groupBy("panel_version", "created_on", "treated_rate", "control_rate").agg(
        F.count("*").alias("members_total")
    )
    # The ledger is one row, the panel header one per version, keyed like the manifest.
    manifest = (
        A.panel_manifest(snapshots, commits, pulls)
        .join(ledger.withColumn("fetched_on", F.lit(fetched_on)), "fetched_on")
        .join(drawn, "panel_version")
        .withColumns(
            {
                "since": F.lit(since),
                "registry_version": F.lit(version),
                "methodology_version": F.lit(PANEL_METHOD),
                "software_version": F.lit(__version__),
            }
        )
    )
    stored = stage(manifest, folder, "manifest")
    write_json(
        stored.withColumn("written_at", F.current_timestamp()), f"{out}/manifests", PANEL_PARTITIONS
    )
    return stored
