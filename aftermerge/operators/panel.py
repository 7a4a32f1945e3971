"""The repository panel: a reproducible hash sample with treated and control cohorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aftermerge.functions.identity import in_sample, sample_key
from aftermerge.functions.identity import valid_repo as is_valid_repo


def treated_candidates(observations: DataFrame) -> DataFrame:
    """Distinct repositories with an attributed commit on any day."""
    attributed = observations.where(F.length("agent_id") > 0)
    return attributed.select("repo").distinct()


def dedupe_spellings(repos: DataFrame) -> DataFrame:
    """One spelling per case-insensitive name: the smallest in code-point order."""
    named = repos.where(F.col("repo").isNotNull())
    return (
        named.groupBy(F.lower("repo").alias("repo_key")).agg(F.min("repo").alias("repo"))
    ).select("repo_key", "repo")


def build_panel(
    treated: DataFrame,
    control: DataFrame,
    *,
    version: int,
    created_on: dt.date,
    treated_rate: float,
    control_rate: float,
    control_source: str,
) -> DataFrame:
    """Sample both candidate lists and stack them; a repository in both stays treated only.

    Candidates are sampled before anything is shuffled, so only the sample is grouped. Both
    sides are then keyed by the lower-cased name, one row per key, which is all the
    exclusion join needs.
    """
    if version < 1:
        raise ValueError(f"a panel version is at least 1, got {version}")

    def sampled(candidates: DataFrame, rate: float) -> DataFrame:
        return dedupe_spellings(candidates.where(in_sample("repo", rate)))

    def members(repos: DataFrame, cohort: str, source: str) -> DataFrame:
        return repos.select(
            F.lit(version).alias("panel_version"),
            F.lit(created_on).alias("created_on"),
            F.lit(float(treated_rate)).alias("treated_rate"),
            F.lit(float(control_rate)).alias("control_rate"),
            "repo",
            F.lit(cohort).alias("cohort"),
            F.lit(created_on).alias("added_on"),
            F.lit(source).alias("source"),
            sample_key("repo").alias("sample_key"),
        )

    chosen = sampled(treated, treated_rate)
    others = sampled(control, control_rate).join(chosen.select("repo_key"), "repo_key", "left_anti")
    return members(chosen, "treated", "source_a").unionByName(
        members(others, "control", control_source)
    )


def panel_order() -> list[Column]:
    """Panel order: treated before control, each by lower-cased name."""
    return [F.when(F.col("cohort") == "treated", 0).otherwise(1), F.lower("repo")]


def first_members(members: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` members in panel order, for smoke runs."""
    return members.orderBy(*panel_order()).limit(limit)


def by_cohort(members: DataFrame, cohort: str) -> DataFrame:
    """Members of one cohort."""
    return members.where(F.col("cohort") == cohort)


def panel_problems(members: DataFrame) -> DataFrame:
    """Violations of a panel's rules as ``(panel_version, repo, problem)``; empty when valid."""
    duplicated = (
        members.groupBy("panel_version", F.lower("repo").alias("repo"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("panel_version", "repo", F.lit("repository appears more than once").alias("problem"))
    )
    checks = {
        "version below 1": F.col("panel_version") < 1,
        "unknown cohort": ~F.col("cohort").isin("treated", "control"),
        "invalid repository name": ~is_valid_repo("repo"),
        "sample key out of range": ~F.col("sample_key").between(0, 9_999),
        "rate out of range": ~(
            F.col("treated_rate").between(0, 1) & F.col("control_rate").between(0, 1)
        ),
    }
    failed = F.array_compact(
        F.array(
            *[F.when(F.coalesce(test, F.lit(True)), F.lit(name)) for name, test in checks.items()]
        )
    )
    broken = members.select("panel_version", "repo", F.explode(failed).alias("problem"))
    return duplicated.unionByName(broken)


def panel_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per repository: ``added``, ``removed``, ``kept`` or ``moved`` (cohort changed)."""

    def side(members: DataFrame, name: str) -> DataFrame:
        return members.select(
            F.lower("repo").alias("repo_key"), F.col("cohort").alias(f"{name}_cohort")
        )

    both = side(old, "old").join(side(new, "new"), "repo_key", "full_outer")
    change = (
        F.when(F.col("old_cohort").isNull(), "added")
        .when(F.col("new_cohort").isNull(), "removed")
        .when(F.col("old_cohort") == F.col("new_cohort"), "kept")
        .otherwise("moved")
    )
    return both.withColumn("change", change)


def build_report(members: DataFrame, treated: DataFrame, control: DataFrame) -> DataFrame:
    """Per cohort: members drawn and candidates they were drawn from."""

    def sizes(candidates: DataFrame, cohort: str) -> DataFrame:
        found = candidates.agg(F.count_distinct("repo").alias("candidates"))
        return found.select(F.lit(cohort).alias("cohort"), "candidates")

    drawn = members.groupBy("cohort").agg(F.count("*").alias("members"))
    of = sizes(treated, "treated").unionByName(sizes(control, "control"))
    return of.join(drawn, "cohort", "left").select(
        "cohort", F.coalesce("members", F.lit(0)).alias("members"), "candidates"
    )


def contaminated_control(members: DataFrame, treated: DataFrame) -> DataFrame:
    """Control members that are treated candidates the treated sample happened to skip."""
    keys = dedupe_spellings(treated).select(F.col("repo_key"))
    control = by_cohort(members, "control").withColumn("repo_key", F.lower("repo"))
    return control.join(keys, "repo_key", "left_semi").drop("repo_key")
