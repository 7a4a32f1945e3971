"""Landed API responses to repository, commit and pull-request tables.

Responses are nested JSON with one alias per requested repository. Bodies are parsed where
they lie, one row per response; only the parsed, narrow rows are ever shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aftermerge import PANEL_METHOD
from aftermerge.functions import identity, text
from aftermerge.operators.attribution import COMMIT_INPUTS, PULL_INPUTS, attribute, evidence_json
from aftermerge.operators.barrier import with_struct
from aftermerge.operators.census import count_map, hash_identities
from aftermerge.operators.rules import Rule
from aftermerge.schemas import (
    HISTORY_PAGE_NODE,
    PANEL_COMMITS,
    PANEL_PULLS,
    PANEL_REPOS,
    RATE_LIMIT,
    REPOSITORY_NODE,
    RESPONSE_BODY,
    SNAPSHOT_NODE,
    columns,
)

COMMIT = """struct<sha:string,committed_at:timestamp,subject:string,message:string,
    author_name:string,author_email:string,author_login:string,author_is_bot:boolean,
    associated_pr_number:bigint>"""


# One API node `n` as a typed struct. Missing text is '', missing counts are 0, optional
# times stay NULL; times are ISO 8601 with a zone.
_COMMIT = """struct(
    n.oid AS sha, try_to_timestamp(n.committedDate) AS committed_at,
    coalesce(n.messageHeadline, '') AS subject, coalesce(n.message, '') AS message,
    n.author.name AS author_name, n.author.email AS author_email,
    n.author.user.login AS author_login,
    coalesce(n.author.user.__typename = 'Bot', false) AS author_is_bot,
    get(n.associatedPullRequests.nodes, 0).number AS associated_pr_number)"""

_PULL = """struct(
    n.number AS number, coalesce(n.title, '') AS title, coalesce(n.body, '') AS body,
    coalesce(n.state, '') AS state, try_to_timestamp(n.createdAt) AS created_at,
    try_to_timestamp(n.updatedAt) AS updated_at, try_to_timestamp(n.closedAt) AS closed_at,
    try_to_timestamp(n.mergedAt) AS merged_at, coalesce(n.merged, false) AS merged,
    n.author.login AS author_login, coalesce(n.author.__typename = 'Bot', false) AS author_is_bot,
    n.additions AS additions, n.deletions AS deletions, n.changedFiles AS changed_files,
    CAST(coalesce(n.reviews.totalCount, 0) AS INT) AS review_count,
    CAST(coalesce(n.comments.totalCount, 0) AS INT) AS comment_count,
    CAST(coalesce(n.reviewThreads.totalCount, 0) AS INT) AS review_thread_count,
    n.mergeCommit.oid AS merge_commit_sha)"""


def _commits(nodes: str) -> Column:
    listed = f"transform({nodes}, n -> {_COMMIT})"
    return F.expr(f"coalesce({listed}, CAST(array() AS array<{COMMIT}>))").alias("commits")


def parse_activity(
    responses: DataFrame, *, since: dt.datetime, prs_first: int = 50, nodes: bool = True
) -> DataFrame:
    """One row per requested repository: status, metadata and its commit and pull arrays.

    Without ``nodes`` the arrays are left out, and bodies are parsed only as far as snapshots need.

    Arrays hold one response page each (the API caps a page at 100 entries). Pull requests
    older than ``since`` are left out; a full page with none left out is marked truncated.
    """
    if since.tzinfo is None:
        raise ValueError("since must carry a time zone")
    if not 1 <= prs_first <= 100:
        raise ValueError("page sizes lie between 1 and 100")
    request = ["request_id", *(c for c in ("fetched_at",) if c in responses.columns)]
    bodies = responses.where(F.col("kind") == "batch").select(
        *request, "repos", F.from_json("body", RESPONSE_BODY).alias("b")
    )
    asked = bodies.select(*request, "b", F.posexplode("repos").alias("pos", "repo"))
    alias = F.concat(F.lit("r"), F.col("pos").cast("string"))
    own_errors = F.filter(F.col("b.errors"), lambda e: F.get(e["path"], F.lit(0)) == alias)
    first = F.get(own_errors, F.lit(0))
    error = F.when(
        first.isNotNull(),
        F.coalesce(F.nullif(first["type"], F.lit("")), F.nullif(first["message"], F.lit("")), F.lit("ERROR")),
    )
    found = asked.select(
        *request,
        "repo",
        error.alias("error_type"),
        F.explode(
            F.array(
                F.from_json(
                    F.try_element_at(F.col("b.data"), alias), REPOSITORY_NODE if nodes else SNAPSHOT_NODE
                )
            )
        ).alias("n"),
    )
    missing = F.col("n").isNull()
    branch = F.col("n.defaultBranchRef")
    status = (
        F.when(missing & (F.col("error_type") == "NOT_FOUND"), "not_found")
        .when(missing, "error")
        .when(branch.isNull(), "empty")
        .otherwise("ok")
    )
    history = branch["target"]["history"]
    pull = _PULL if nodes else "struct(try_to_timestamp(n.updatedAt) AS updated_at)"
    parsed = found.select(
        *request,
        "repo",
        status.alias("status"),
        F.when(missing, F.coalesce("error_type", F.lit("no data"))).alias("error"),
        F.col("n.nameWithOwner").alias("name_with_owner"),
        F.col("n.databaseId").alias("repo_id"),
        F.col("n.isFork").alias("is_fork"),
        F.col("n.stargazerCount").alias("stargazers"),
        F.col("n.primaryLanguage.name").alias("primary_language"),
        branch["name"].alias("default_branch"),
        history["totalCount"].alias("commits_total"),
        F.coalesce(history["pageInfo"]["hasNextPage"], F.lit(False)).alias("commits_truncated"),
        *([_commits("n.defaultBranchRef.target.history.nodes")] if nodes else []),
        F.expr(f"transform(n.pullRequests.nodes, n -> {pull})").alias("all_pulls"),
    )
    recent = F.filter("all_pulls", lambda p: p["updated_at"] >= F.lit(since))
    page = F.coalesce(F.size("all_pulls"), F.lit(0))
    whole = parsed.withColumn("pulls", recent).select(
        *[c for c in parsed.columns if c != "all_pulls"],
        "pulls",
        ((page >= prs_first) & (F.size("pulls") == page)).alias("pulls_truncated"),
    )
    return whole if nodes else whole.drop("pulls")


def history_pages(responses: DataFrame) -> DataFrame:
    """Follow-up history pages: ``(repo, page_no, has_next, commits)``."""
    pages = responses.where(F.col("kind") == "history").select(
        F.get("repos", F.lit(0)).alias("repo"),
        "page_no",
        F.from_json(F.from_json("body", RESPONSE_BODY)["data"]["repository"], HISTORY_PAGE_NODE)[
            "defaultBranchRef"
        ]["target"]["history"].alias("h"),
    )
    info = F.col("h.pageInfo")
    more = info["hasNextPage"] & (F.length(info["endCursor"]) > 0)
    return pages.select(
        "repo",
        "page_no",
        F.coalesce(more, F.lit(False)).alias("has_next"),
        _commits("h.nodes"),
    )


def stitch_history(activity: DataFrame, pages: DataFrame) -> DataFrame:
    """Commits of all pages of the ``ok`` repositories, one row per (repo, sha).

    Pages stay rows: nothing is collected per repository. A commit seen on two pages keeps
    its first place; the rank filter is applied before the shuffle as well as after it.
    Further pages exist only for repositories whose first page announced one, so they need
    no status check of their own.
    """
    ok = activity.where(F.col("status") == "ok")
    first = ok.select("repo", F.lit(0).alias("page_no"), F.posexplode("commits").alias("pos", "c"))
    rest = pages.select("repo", "page_no", F.posexplode("commits").alias("pos", "c"))
    rows = first.unionByName(rest).select("repo", "page_no", "pos", "c.*")
    keep_first = Window.partitionBy("repo", "sha").orderBy("page_no", "pos", "message")
    return rows.withColumn("_n", F.row_number().over(keep_first)).where("_n = 1").drop("_n")


def with_history_flags(activity: DataFrame, pages: DataFrame) -> DataFrame:
    """Correct ``commits_truncated``: the last page fetched decides."""
    last = pages.groupBy("repo").agg(F.max_by("has_next", "page_no").alias("_has_next"))
    joined = activity.join(last, "repo", "left")
    truncated = F.coalesce("_has_next", "commits_truncated")
    return joined.withColumn("commits_truncated", truncated).drop("_has_next")


def _stamp(df: DataFrame, fetched_on: dt.date, registry_version: int) -> DataFrame:
    return df.withColumns(
        {
            "fetched_on": F.lit(fetched_on),
            "methodology_version": F.lit(PANEL_METHOD),
            "registry_version": F.lit(registry_version),
        }
    )


def _membership(members: DataFrame) -> DataFrame:
    return members.select("repo", "cohort", "panel_version")


def repo_snapshots(
    activity: DataFrame, members: DataFrame, fetched_on: dt.date | None = None
) -> DataFrame:
    """One row per fetched member, gone ones included: the attrition record.

    A repository that landed more than once counts once: an answer beats an error, then the
    last request identifier wins. Without a date the rows' own ``fetched_on`` tells fetches apart.
    """
    if fetched_on is not None:
        activity = activity.withColumn("fetched_on", F.lit(fetched_on))
    narrow = activity.withColumnRenamed("commits_total", "commits_total_since").drop(
        "commits", "pulls"
    )
    best = Window.partitionBy("repo", "fetched_on").orderBy(
        F.col("status") == "error", F.desc("request_id")
    )
    landed = narrow.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")
    joined = landed.join(_membership(members), "repo")
    return joined.select(*columns(PANEL_REPOS), "name_with_owner", "pulls_truncated")


def _judged(df: DataFrame, body: str) -> DataFrame:
    revert = with_struct(df, F.struct(text.revert(body)), ["_revert"])
    names = ("is_reapply", "reverted_sha", "original_pr_number", "revert_pr_number")
    return revert.withColumns(
        {
            "is_revert": F.col("_revert").isNotNull(),
            **{name: F.col(f"_revert.{name}") for name in names},
            "original_subject": F.col("_revert.original_subject"),
            "evidence_json": evidence_json(F.col("evidence"), F.col("agent_id")),
            "author_is_bot": F.col("author_is_bot") | identity.is_bot_login("author_login"),
        }
    )


def panel_commits(
    stitched: DataFrame,
    members: DataFrame,
    rules: Sequence[Rule],
    *,
    fetched_on: dt.date,
    registry_version: int,
) -> DataFrame:
    """Attributed commits of the members; rows with an invalid SHA are left out."""
    rows = stitched.where(identity.valid_sha("sha")).withColumns(
        {"sha": F.lower("sha"), "subject": F.col("subject")}
    )
    judged = _judged(attribute(rows.join(_membership(members), "repo"), rules, COMMIT_INPUTS), "message")
    hashed = hash_identities(judged, ["author_login", "author_email", "author_name"])
    return _stamp(hashed, fetched_on, registry_version).select(
        *columns(PANEL_COMMITS), "original_subject"
    )


def activity_pulls(activity: DataFrame) -> DataFrame:
    """Pull requests of the ``ok`` repositories, one row each: its last update if it landed twice."""
    ok = activity.where(F.col("status") == "ok")
    rows = ok.select("repo", "request_id", F.explode("pulls").alias("p")).select("repo", "request_id", "p.*")
    newest = Window.partitionBy("repo", "number").orderBy(F.desc("updated_at"), F.desc("request_id"))
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "request_id")


def panel_pulls(
    pulls: DataFrame,
    members: DataFrame,
    rules: Sequence[Rule],
    *,
    fetched_on: dt.date,
    registry_version: int,
) -> DataFrame:
    """Attributed pull requests of the members."""
    merge_sha = F.when(F.length("merge_commit_sha") == 40, F.lower("merge_commit_sha"))
    judged = _judged(attribute(pulls.join(_membership(members), "repo"), rules, PULL_INPUTS), "title")
    cleaned = judged.withColumns(
        {"merge_commit_sha": merge_sha, "title": F.col("title")}
    )
    hashed = hash_identities(cleaned, ["author_login"])
    return _stamp(hashed, fetched_on, registry_version).select(
        *columns(PANEL_PULLS), "updated_at", "original_subject"
    )


def next_watermark(pulls: DataFrame, commits: DataFrame) -> DataFrame:
    """Per repository: the latest activity seen, to start the next fetch from."""
    seen = pulls.select("repo", F.col("updated_at").alias("at")).unionByName(
        commits.select("repo", F.col("committed_at").alias("at"))
    )
    return seen.groupBy("repo").agg(F.max("at").alias("since"))


def api_cost(responses: DataFrame) -> DataFrame:
    """Ledger of the landed responses per kind: requests, points, last remaining budget."""
    limits = responses.select(
        "kind",
        "fetched_at",
        "request_id",
        F.from_json(F.from_json("body", RESPONSE_BODY)["data"]["rateLimit"], RATE_LIMIT).alias("r"),
    )
    return limits.groupBy("kind").agg(
        F.count("*").alias("requests"),
        F.coalesce(F.sum("r.cost"), F.lit(0)).alias("points_spent"),
        F.max_by("r.remaining", F.struct("fetched_at", "request_id")).alias("last_remaining"),
    )


def renamed_repos(activity: DataFrame) -> DataFrame:
    """Repositories the API reports under another name; ``repo_id`` survives a rename."""
    renamed = F.lower("name_with_owner") != F.lower("repo")
    return activity.where(renamed).select("repo", "name_with_owner", "repo_id")


def panel_manifest(snapshots: DataFrame, commits: DataFrame, pulls: DataFrame) -> DataFrame:
    """Per fetch and panel version: repositories by status, commit and pull totals, attributed
    counts by agent."""
    key = ["fetched_on", "panel_version"]
    statuses = (
        snapshots.groupBy(*key, "status")
        .agg(F.count("*").alias("n"))
        .groupBy(*key)
        .agg(
            F.sum("n").alias("repos"),
            count_map(F.col("status"), F.col("n")).alias("repos_by_status"),
        )
    )

    def by_agent(rows: DataFrame, name: str) -> DataFrame:
        counted = rows.groupBy(*key, "agent_id").agg(
            F.count("*").alias("n"), F.count_if("is_revert").alias("reverts")
        )
        attributed = F.when(F.col("agent_id").isNotNull(), F.col("n")).otherwise(0)
        return counted.groupBy(*key).agg(
            F.sum("n").alias(name),
            F.sum(attributed).alias(f"{name}_attributed"),
            F.sum("reverts").alias(f"{name}_reverts"),
            count_map(F.col("agent_id"), F.col("n")).alias(f"{name}_by_agent"),
        )

    full = statuses.join(by_agent(commits, "commits"), key, "left").join(
        by_agent(pulls, "pulls"), key, "left"
    )
    counts = [c for c in full.columns if c.startswith(("commits", "pulls")) and "_by_" not in c]
    return full.fillna(0, subset=counts)
