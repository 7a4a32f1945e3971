"""The census: from a day of push events to attributed, classified commit rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge import CENSUS_METHOD
from aftermerge.functions import identity, text
from aftermerge.operators.attribution import PUSH_INPUTS, attribute, evidence_json
from aftermerge.operators.barrier import with_struct
from aftermerge.operators.prefilter import any_hit
from aftermerge.operators.rules import Rule
from aftermerge.schemas import CENSUS, PUSH_PAYLOAD, columns

# The first archived day and the last day whose pushes list their commits.
FIRST_DAY = dt.date(2011, 2, 12)
LAST_COMMIT_DAY = dt.date(2025, 10, 6)


def day_status(day: Column, today: Column | None = None) -> Column:
    """Whether a UTC day can be read: ``ok`` or the reason it cannot.

    ``today`` defaults to the current date; run sessions in UTC, as the archive's days are.
    """
    today = F.current_date() if today is None else today
    return (
        F.when(day.isNull(), "no_day")
        .when(day < F.lit(FIRST_DAY), "before_archive")
        .when(day > F.lit(LAST_COMMIT_DAY), "no_commit_content")
        .when(day >= today, "incomplete")
        .otherwise("ok")
    )


def active_repos(pushes: DataFrame) -> DataFrame:
    """Distinct repositories with at least one push."""
    named = pushes.where((F.col("type") == "PushEvent") & F.col("repo.name").isNotNull())
    return named.select(F.col("repo.name").alias("repo")).distinct()


def commits_from_pushes(pushes: DataFrame) -> DataFrame:
    """One row per listed commit, with its push; commits lacking sha, message or repo go.

    The payload is parsed once per event; an absent, empty or malformed commit list yields
    no rows. ``push_size`` is the true size of the push, which may exceed the listed commits.
    """
    parsed = pushes.where(F.col("type") == "PushEvent").select(
        "day",
        F.col("id").alias("event_id"),
        F.col("repo.name").alias("repo"),
        F.col("actor.login").alias("pusher_login"),
        F.col("created_at").alias("pushed_at"),
        F.explode(F.array(F.from_json("payload", PUSH_PAYLOAD))).alias("p"),
    )
    listed = parsed.select(
        "day",
        "event_id",
        "repo",
        "pusher_login",
        "pushed_at",
        F.col("p.size").try_cast("bigint").alias("push_size"),
        F.explode("p.commits").alias("c"),
    )
    return listed.select(
        "day",
        "event_id",
        "repo",
        "pusher_login",
        "pushed_at",
        "push_size",
        _scalar("c.sha").alias("sha"),
        F.col("c.message").alias("message"),
        _scalar("c.author.name").alias("author_name"),
        _scalar("c.author.email").alias("author_email"),
        F.coalesce(_boolean(F.col("c.distinct")), F.lit(True)).alias("is_distinct"),
    ).dropna(subset=["sha", "message", "repo"])


def _scalar(path: str) -> Column:
    # A JSON object or array read as STRING is its text; as a scalar it is NULL.
    value = F.col(path)
    return F.when(~value.rlike(r"^\s*[{\[]"), value)


def _boolean(value: Column) -> Column:
    word = F.lower(value)
    return F.when(word == "true", True).when(word == "false", False)


def reject_reason(sha: str = "sha", repo: str = "repo") -> Column:
    """Why a commit row is malformed, or NULL when it is fine."""
    return F.when(~identity.valid_sha(sha), "bad_sha").when(
        ~identity.valid_repo(repo), "bad_repo"
    )


def validate_commits(commits: DataFrame) -> DataFrame:
    """Add ``reject_reason`` and lower-case valid SHAs; no row is dropped."""
    checked = commits.withColumn("reject_reason", reject_reason())
    sha = F.when(F.col("reject_reason").isNull(), F.lower("sha")).otherwise(F.col("sha"))
    return checked.withColumn("sha", sha)


def valid_commits(commits: DataFrame) -> DataFrame:
    """Only the well-formed rows."""
    return commits.where(reject_reason().isNull()).withColumn("sha", F.lower("sha"))


def rejected_commits(commits: DataFrame) -> DataFrame:
    """The quarantine: malformed rows with the reason."""
    return validate_commits(commits).where(F.col("reject_reason").isNotNull())


def repo_day_totals(flagged: DataFrame) -> DataFrame:
    """Per (day, repo): commits seen, whether any is a candidate, whether any is a revert.

    Combined map-side, so a repository with a third of all commits costs one row per task.
    """
    return flagged.groupBy("day", "repo").agg(
        F.count("*").alias("commits_in_repo_day"),
        F.max(any_hit()).alias("has_candidate"),
        F.max(_is_revert()).alias("has_revert"),
    )


def kept_totals(flagged: DataFrame) -> DataFrame:
    """Totals of the repository-days from which anything is kept."""
    return repo_day_totals(flagged).where("has_candidate or has_revert")


def _is_revert() -> Column:
    return F.coalesce(F.col("revert_hit"), F.lit(False))


def exact_revert_flag(flagged: DataFrame) -> DataFrame:
    """Replace the coarse revert flag by the verdict of the full parser."""
    return flagged.withColumn("revert_hit", text.revert("message").isNotNull())


def select_observations(
    flagged: DataFrame, *, strict_reference: bool = True, totals: DataFrame | None = None
) -> DataFrame:
    """Commits worth keeping, with the size of their repository-day.

    Kept are all commits of repositories with a candidate that day (candidates and their
    baseline) and every revert anywhere. ``strict_reference`` uses the coarse revert flag of
    the scan; otherwise the full revert parser decides.

    Totals are aggregated from the narrow columns and hold only repository-days from which
    something is kept, so one inner join at every size finds all rows. A job that has stored the
    totals passes them in, and Spark broadcasts them where their size allows it. Unstored, neither
    side has a size worth trusting, so both are sorted by key and neither passes the driver; a
    skewed repository-day is split. Rows without a day or repository belong to
    no repository-day; they are quarantined (``validate_commits``), not kept.
    """
    rows = flagged if strict_reference else exact_revert_flag(flagged)
    totals = kept_totals(rows).hint("merge") if totals is None else totals
    joined = rows.join(totals.drop("has_revert"), ["day", "repo"])
    wanted = F.col("has_candidate") | _is_revert()
    return joined.where(wanted).select(*rows.columns, "commits_in_repo_day")


def judge_commits(selected: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Attribute, parse reverts and validate, keeping malformed rows marked for the counts."""
    judged = attribute(validate_commits(selected), rules, PUSH_INPUTS)
    parsed = with_struct(judged, F.struct(text.revert("message")), ["revert"])
    return parsed.withColumn("matched_prefilter", any_hit())


def hash_identities(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace each raw identity column ``x`` by ``x_hash``; the raw values are dropped."""
    hashed = {f"{name}_hash": identity.hash_identity(name) for name in names}
    return df.withColumns(hashed).drop(*names)


def flatten_observation(judged: DataFrame, registry_version: int) -> DataFrame:
    """The 25 stored columns of the census, in order, from judged rows."""
    bot = judged.withColumn("pusher_is_bot", identity.is_bot_login("pusher_login"))
    hashed = hash_identities(bot, ["author_email", "author_name", "pusher_login"])
    full = hashed.withColumns(
        {
            "methodology_version": F.lit(CENSUS_METHOD),
            "registry_version": F.lit(registry_version),
            "push_size": F.col("push_size").try_cast("int"),
            "commits_in_repo_day": F.col("commits_in_repo_day").cast("int"),
            "subject": text.subject("message"),
            "is_revert": F.col("revert").isNotNull(),
            "evidence_json": evidence_json(F.col("evidence"), F.col("agent_id")),
            **{
                name: F.col(f"revert.{name}")
                for name in (
                    "is_reapply",
                    "reverted_sha",
                    "original_pr_number",
                    "revert_pr_number",
                )
            },
        }
    )
    return full.select(*columns(CENSUS))


def observations(selected: DataFrame, rules: Sequence[Rule], registry_version: int) -> DataFrame:
    """Selected commits as census rows; malformed ones are left out (see the manifest)."""
    judged = judge_commits(selected, rules).where(F.col("reject_reason").isNull())
    return flatten_observation(judged, registry_version)


def census_manifest(judged: DataFrame) -> DataFrame:
    """Per day: row-class counts and a map of attributed commits by agent.

    The classes overlap on purpose: an attributed revert counts as both, and a flagged but
    unattributed commit counts in neither ``attributed`` nor ``baseline``.
    """
    ok = F.col("reject_reason").isNull()
    is_revert = F.col("revert").isNotNull()
    per_agent = judged.groupBy("day", "agent_id").agg(
        F.count_if(ok).alias("total"),
        F.count_if(ok & is_revert).alias("reverts"),
        F.count_if(ok & ~F.col("matched_prefilter") & ~is_revert).alias("baseline"),
        F.count_if(~ok).alias("skipped_invalid"),
    )
    attributed = F.when(F.col("agent_id").isNotNull(), F.col("total")).otherwise(0)
    return per_agent.groupBy("day").agg(
        F.sum("total").alias("total"),
        F.sum(attributed).alias("attributed"),
        F.sum("reverts").alias("reverts"),
        F.sum("baseline").alias("baseline"),
        F.sum("skipped_invalid").alias("skipped_invalid"),
        count_map(F.col("agent_id"), F.col("total")).alias("by_agent"),
    )


def manifest_metrics(days: Sequence[dt.date], agents: Sequence[str]) -> dict[str, Column]:
    """The manifest's counts of judged rows as plain aggregates, for an observation: one per day and
    class, and per day and agent. :func:`manifest_from_metrics` puts them together again."""
    ok = F.col("reject_reason").isNull()
    is_revert = F.col("revert").isNotNull()
    classes = {
        "total": ok,
        "attributed": ok & F.col("agent_id").isNotNull(),
        "reverts": ok & is_revert,
        "baseline": ok & ~F.col("matched_prefilter") & ~is_revert,
        "skipped_invalid": ~ok,
        **{f"by_{k}": ok & (F.col("agent_id") == agent) for k, agent in enumerate(agents)},
    }
    return {
        f"{d}_{name}": F.count_if((F.col("day") == F.lit(day)) & condition)
        for d, day in enumerate(days)
        for name, condition in classes.items()
    }


def manifest_from_metrics(
    spark: SparkSession, found: Mapping[str, int], days: Sequence[dt.date], agents: Sequence[str]
) -> DataFrame:
    """The rows of :func:`census_manifest` from observed metrics; a day without rows has zeros."""
    classes = ("total", "attributed", "reverts", "baseline", "skipped_invalid")
    rows = [
        (
            day,
            *(found[f"{d}_{name}"] for name in classes),
            {agent: n for k, agent in enumerate(agents) if (n := found[f"{d}_by_{k}"])},
        )
        for d, day in enumerate(days)
    ]
    schema = "day date, " + ", ".join(f"{name} bigint" for name in classes) + ", by_agent map<string, bigint>"
    return spark.createDataFrame(rows, schema)


def count_map(key: Column, count: Column) -> Column:
    """Sorted ``map<key,count>`` of pre-aggregated rows; NULL keys and zero counts are left out."""
    entry = F.when(key.isNotNull() & (count > 0), F.struct(key, count))
    return F.map_from_entries(F.sort_array(F.collect_list(entry)))


def redact_person_emails(df: DataFrame, column: str = "message") -> DataFrame:
    """Replace the address of ``Name <address>`` in stored text by a hash of it.

    Optional: stored messages otherwise keep the addresses people put in their trailers.
    """
    pattern = text.quote(r"<([^<>\s@]+@[^<>\s@]+)>")
    marked = f"'<' || {identity.hash_identity_sql('address')} || '>'"
    rebuilt = (
        f"array_join(zip_with(split({column}, {pattern}, -1), regexp_extract_all({column}, {pattern}, 1),"
        f" (before, address) -> before || coalesce({marked}, '')), '')"
    )
    return df.withColumn(column, F.expr(rebuilt))


def pii_leak_audit(stored: DataFrame, hash_columns: Sequence[str]) -> DataFrame:
    """Per identity column: stored values that are not a 16-digit hash (must be zero)."""
    leaks = [
        F.count_if(~F.col(name).rlike(r"^[0-9a-f]{16}\z")).alias(name) for name in hash_columns
    ]
    counted = stored.agg(*leaks)
    pairs = [f"'{name}', `{name}`" for name in hash_columns]
    return counted.selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) as (column_name, leaks)")


def required_nulls(stored: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per required column: how many stored rows are NULL (must be zero)."""
    counted = stored.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    pairs = [f"'{name}', `{name}`" for name in required]
    return counted.selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) as (column_name, nulls)")
