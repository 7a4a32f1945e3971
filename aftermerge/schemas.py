"""Explicit schemas of every table read or written; nothing is inferred."""

from __future__ import annotations

# Raw push events, one row per event, partitioned by day.
PUSH_EVENTS = """
    id STRING, type STRING, repo STRUCT<name: STRING>, actor STRUCT<login: STRING>,
    created_at TIMESTAMP, payload STRING, day DATE
"""

# Every leaf is STRING so one odd value cannot void a whole payload; casts come later.
PUSH_PAYLOAD = """
    size STRING,
    commits ARRAY<STRUCT<sha: STRING, message: STRING, distinct: STRING,
                         author: STRUCT<name: STRING, email: STRING>>>
"""

CENSUS = """
    day DATE, methodology_version STRING, registry_version INT, event_id STRING, repo STRING,
    sha STRING, pushed_at TIMESTAMP, is_distinct BOOLEAN, push_size INT, subject STRING,
    message STRING, is_revert BOOLEAN, is_reapply BOOLEAN, reverted_sha STRING,
    original_pr_number BIGINT, revert_pr_number BIGINT, author_email_hash STRING,
    author_name_hash STRING, pusher_login_hash STRING, pusher_is_bot BOOLEAN, agent_id STRING,
    attribution_confidence STRING, evidence_json STRING, matched_prefilter BOOLEAN,
    commits_in_repo_day INT
"""
CENSUS_NULLABLE = (
    "push_size is_reapply reverted_sha original_pr_number revert_pr_number author_email_hash "
    "author_name_hash pusher_login_hash agent_id attribution_confidence evidence_json"
).split()

PANEL_MEMBERS = """
    panel_version INT, created_on DATE, treated_rate DOUBLE, control_rate DOUBLE, repo STRING,
    cohort STRING, added_on DATE, source STRING, sample_key INT
"""

# Landed API responses: one row per request. `kind` is 'batch' (aliases r0..rN stand for
# `repos` in order) or 'history' (a further history page of the single entry of `repos`).
RESPONSES = """
    request_id STRING, fetched_at TIMESTAMP, kind STRING, repos ARRAY<STRING>, page_no INT,
    body STRING
"""
RESPONSE_BODY = """
    data MAP<STRING, STRING>,
    errors ARRAY<STRUCT<type: STRING, path: ARRAY<STRING>, message: STRING>>
"""
_COUNT = "STRUCT<totalCount: BIGINT>"
_HISTORY = """
    STRUCT<totalCount: BIGINT, pageInfo: STRUCT<hasNextPage: BOOLEAN, endCursor: STRING>,
           nodes: ARRAY<STRUCT<
               oid: STRING, committedDate: STRING, messageHeadline: STRING, message: STRING,
               author: STRUCT<name: STRING, email: STRING,
                              user: STRUCT<login: STRING, __typename: STRING>>,
               associatedPullRequests: STRUCT<nodes: ARRAY<STRUCT<number: BIGINT>>>>>>
"""
_BRANCH = f"STRUCT<name: STRING, target: STRUCT<history: {_HISTORY}>>"
REPOSITORY_NODE = f"""
    nameWithOwner STRING, databaseId BIGINT, isFork BOOLEAN, stargazerCount BIGINT,
    primaryLanguage STRUCT<name: STRING>,
    pullRequests STRUCT<totalCount: BIGINT, nodes: ARRAY<STRUCT<
        number: BIGINT, title: STRING, body: STRING, state: STRING, createdAt: STRING,
        closedAt: STRING, mergedAt: STRING, merged: BOOLEAN, updatedAt: STRING,
        author: STRUCT<login: STRING, __typename: STRING>, additions: BIGINT,
        deletions: BIGINT, changedFiles: BIGINT, reviews: {_COUNT}, comments: {_COUNT},
        reviewThreads: {_COUNT}, mergeCommit: STRUCT<oid: STRING>>>>,
    defaultBranchRef {_BRANCH}
"""
# What a snapshot needs of the same node: no commits, and of pull requests their times only.
SNAPSHOT_NODE = """
    nameWithOwner STRING, databaseId BIGINT, isFork BOOLEAN, stargazerCount BIGINT,
    primaryLanguage STRUCT<name: STRING>,
    pullRequests STRUCT<totalCount: BIGINT, nodes: ARRAY<STRUCT<updatedAt: STRING>>>,
    defaultBranchRef STRUCT<name: STRING, target: STRUCT<history: STRUCT<
        totalCount: BIGINT, pageInfo: STRUCT<hasNextPage: BOOLEAN, endCursor: STRING>>>>
"""
HISTORY_PAGE_NODE = f"defaultBranchRef {_BRANCH}"
RATE_LIMIT = "cost BIGINT, remaining BIGINT, resetAt STRING"

PANEL_REPOS = """
    fetched_on DATE, panel_version INT, repo STRING, cohort STRING, status STRING,
    repo_id BIGINT, primary_language STRING, is_fork BOOLEAN, stargazers BIGINT,
    default_branch STRING, commits_total_since BIGINT, commits_truncated BOOLEAN, error STRING
"""
_REVERT_COLUMNS = """
    is_revert BOOLEAN, is_reapply BOOLEAN, reverted_sha STRING, original_pr_number BIGINT,
    revert_pr_number BIGINT
"""
_VERDICT_COLUMNS = "agent_id STRING, attribution_confidence STRING, evidence_json STRING"
PANEL_COMMITS = f"""
    fetched_on DATE, panel_version INT, methodology_version STRING, registry_version INT,
    repo STRING, cohort STRING, sha STRING, committed_at TIMESTAMP, subject STRING,
    message STRING, associated_pr_number BIGINT, author_login_hash STRING,
    author_email_hash STRING, author_name_hash STRING, author_is_bot BOOLEAN,
    {_REVERT_COLUMNS}, {_VERDICT_COLUMNS}
"""
PANEL_PULLS = f"""
    fetched_on DATE, panel_version INT, methodology_version STRING, registry_version INT,
    repo STRING, cohort STRING, number BIGINT, title STRING, state STRING,
    created_at TIMESTAMP, closed_at TIMESTAMP, merged_at TIMESTAMP, merged BOOLEAN,
    merge_commit_sha STRING, author_login_hash STRING, author_is_bot BOOLEAN,
    additions BIGINT, deletions BIGINT, changed_files BIGINT, review_count INT,
    comment_count INT, review_thread_count INT, {_REVERT_COLUMNS}, {_VERDICT_COLUMNS}
"""

RULES = """
    registry_version INT, agent_order INT, agent_id STRING, name STRING, vendor STRING,
    status STRING, signal_order INT, signal_id STRING, type STRING, trailer_key STRING,
    pattern STRING, confidence STRING, case_sensitive BOOLEAN, evidence STRING, notes STRING,
    requires ARRAY<STRING>
"""

EVIDENCE = (
    "array<struct<agent_id:string,signal_id:string,signal_type:string,confidence:string,"
    "matched:string>>"
)


def columns(ddl: str) -> list[str]:
    """Top-level column names of one of the flat schemas above, in order."""
    return [part.split()[0] for part in ddl.split(",")]
