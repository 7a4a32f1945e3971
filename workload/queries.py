"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

Results are flat (arrays and maps become text) so they can be compared value by value.
"""

from __future__ import annotations

import datetime as dt
import math
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.functions import identity, text
from aftermerge.operators import activity as A
from aftermerge.operators import census as C
from aftermerge.operators import estimates as E
from aftermerge.operators import lineage as L
from aftermerge.operators import outcomes as O
from aftermerge.operators import panel as P
from aftermerge.operators import rules as R
from aftermerge.operators import sketches as K
from aftermerge.operators.attribution import (
    PULL_INPUTS,
    agent_ids,
    agent_status,
    attribute,
    evaluate_signals,
    evidence_table,
)
from aftermerge.operators.barrier import with_struct
from aftermerge.operators.prefilter import any_hit, prefilter_audit, prefilter_flags
from aftermerge.plans.census import judged_commits, staged_judgement
from aftermerge.schemas import CENSUS_NULLABLE
from aftermerge.sources.readers import read_observations, read_push_events, scan_budget
from aftermerge.sources.sinks import (
    CENSUS_ORDER,
    in_ranges,
    shared_folder,
    stage,
    write_ordered,
    write_partitions,
)
from aftermerge.streaming import jobs as S
from workload import views as V
from workload.rules import RULES_V1, RULES_V2, RULES_V3, compiled

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FETCHED_ON = dt.date(2026, 3, 2)
CREATED_ON = dt.date(2026, 1, 5)
SINCE = dt.datetime(2026, 1, 31, tzinfo=dt.UTC)
DATA_END = "2025-10-06 23:59:59"


def query(function: Query) -> Query:
    """Register a query under its function name, less the suffix that avoids a clash."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def data_end() -> Column:
    return F.lit(DATA_END).cast("timestamp_ntz")


def utc(column: str) -> Column:
    """A point in time as its UTC wall clock, whatever zone the session shows."""
    return F.convert_timezone(None, F.lit("UTC"), F.col(column))


def _folder(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is set, as in a local test, a temporary one is."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="aftermerge-"))
    return shared_folder(spark)


def as_text(column: str) -> Column:
    return F.to_json(F.col(column))


# --- text, trailers, attribution --------------------------------------------------------


@query
def attributed_by_agent_day(spark: SparkSession, sf: str) -> DataFrame:
    """Attributed commits and reverts among them, per day and agent."""
    rows = attribute(C.valid_commits(V.commits(spark, sf)), compiled())
    counted = rows.groupBy("day", "agent_id").agg(
        F.count("*").alias("commits"),
        F.count_if(text.revert("message").isNotNull()).alias("reverts"),
    )
    return counted.where("agent_id is not null")


@query
def subjects(spark: SparkSession, sf: str) -> DataFrame:
    return V.commits(spark, sf).select("event_id", "sha", text.subject("message").alias("subject"))


@query
def document_subjects(spark: SparkSession, sf: str) -> DataFrame:
    """Text functions over whole documents: first line, revert test and trailer count."""
    documents = V.table(spark, sf, "documents").select("doc_id", "text")
    return V.wide_enough(spark, documents).select(
        "doc_id",
        text.subject("text").alias("subject"),
        F.length(text.normalise("text")).alias("chars"),
        F.size(text.trailers("text")).alias("trailers"),
        text.revert("text").isNotNull().alias("is_revert"),
    )


@query
def conversation_trailers(spark: SparkSession, sf: str) -> DataFrame:
    """Trailers of messages with long real bodies: each turn signed by its role."""
    message = F.concat_ws(
        "\n\n",
        F.lit("Turn"),
        "text",
        F.concat(F.lit("Signed-Off-By: "), F.col("role"), F.lit(" <"), F.col("role"), F.lit("@x.example>")),
    )
    turns = V.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = V.wide_enough(spark, turns).select("conv_id", "turn", message.alias("m"))
    found = rows.select("conv_id", "turn", F.posexplode(text.trailers("m")).alias("pos", "t"))
    return found.select("conv_id", "turn", "pos", "t.key", "t.value", text.person("t.value")["email"].alias("email"))


def _trailers(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.commits(spark, sf).select(
        "repo", "sha", "event_id", F.posexplode(text.trailers("message")).alias("pos", "t")
    )
    person = text.person("value")
    return rows.select("repo", "sha", "event_id", "pos", "t.key", "t.value").withColumns(
        {"person_name": person["name"], "person_email": person["email"]}
    )


@query
def trailers_exploded(spark: SparkSession, sf: str) -> DataFrame:
    return _trailers(spark, sf)


@query
def trailer_key_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _trailers(spark, sf).groupBy(F.lower("key").alias("key")).agg(
        F.count("*").alias("trailers"),
        F.count("person_email").alias("with_person"),
    )


@query
def trailer_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """All values of one key, any case, in order."""
    values = text.trailer_values("message", "CO-AUTHORED-BY")
    rows = V.commits(spark, sf).select("event_id", "sha", F.array_join(values, "|").alias("signers"))
    return rows.where("signers <> ''")


@query
def evidence_table_query(spark: SparkSession, sf: str) -> DataFrame:
    return evidence_table(V.commits(spark, sf), compiled(), ["repo", "sha", "event_id"])


@query
def evidence_conjunctive(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence where some signals count only together with others."""
    return evidence_table(V.commits(spark, sf), compiled(RULES_V3), ["repo", "sha", "event_id"])


@query
def prefilter_audit_conjunctive(spark: SparkSession, sf: str) -> DataFrame:
    """The flags still miss nothing that such rules attribute."""
    return prefilter_audit(V.commits(spark, sf), compiled(RULES_V3))


@query
def agent_ids_query(spark: SparkSession, sf: str) -> DataFrame:
    """Agents named by the evidence, low-confidence evidence included."""
    rows = evaluate_signals(V.commits(spark, sf), compiled())
    agents = F.array_join(agent_ids(F.col("evidence")), ",")
    return rows.groupBy(agents.alias("agents"), F.size("evidence").alias("signals")).agg(
        F.count("*").alias("commits")
    )


@query
def agent_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Attributed commits by verification status of the agent."""
    rows = attribute(V.commits(spark, sf), compiled()).groupBy("agent_id").agg(
        F.count("*").alias("commits")
    )
    table = R.rules_frame(spark, R.rules_from_mapping(RULES_V1))
    return agent_status(rows.where("agent_id is not null"), table)


@query
def reverts_parsed(spark: SparkSession, sf: str) -> DataFrame:
    commits = V.commits(spark, sf)
    rows = with_struct(commits, F.struct(text.revert("message")), ["r"])
    return rows.where("r is not null").select("repo", "sha", "event_id", "r.*")


@query
def prefilter_flags_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = prefilter_flags(V.commits(spark, sf), compiled())
    return rows.select(
        "event_id",
        "sha",
        "message_hit",
        "author_email_hit",
        "author_name_hit",
        "pusher_login_hit",
        "revert_hit",
    )


@query
def prefilter_audit_query(spark: SparkSession, sf: str) -> DataFrame:
    return prefilter_audit(V.commits(spark, sf), compiled())


# --- census -----------------------------------------------------------------------------


@query
def commits_from_payload(spark: SparkSession, sf: str) -> DataFrame:
    return C.commits_from_pushes(V.push_events(spark, sf))


@query
def event_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Safe scalar extraction from JSON text over the event stream table."""
    parsed = F.from_json("props", "k STRING")
    rows = V.table(spark, sf, "events").select("event_type", parsed["k"].try_cast("bigint").alias("k"))
    return rows.groupBy("event_type", "k").agg(F.count("*").alias("events"))


@query
def day_status_query(spark: SparkSession, sf: str) -> DataFrame:
    day = F.expr("date_add(DATE'2010-12-01', CAST(o_orderkey % 5800 AS INT))")
    rows = V.table(spark, sf, "orders").select(
        C.day_status(day, today=F.lit(dt.date(2025, 8, 1))).alias("status")
    )
    return rows.groupBy("status").agg(F.count("*").alias("days"))


@query
def validated_commits(spark: SparkSession, sf: str) -> DataFrame:
    return C.valid_commits(V.commits(spark, sf)).select("event_id", "repo", "sha", "pushed_at")


@query
def rejected_commits(spark: SparkSession, sf: str) -> DataFrame:
    return C.rejected_commits(V.commits(spark, sf)).select("event_id", "repo", "sha", "reject_reason")


@query
def hashed_identities(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.commits(spark, sf).select("event_id", "sha", "author_email", "author_name", "pusher_login")
    return C.hash_identities(rows, ["author_email", "author_name", "pusher_login"])


@query
def bot_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.commits(spark, sf).withColumn("is_bot", identity.is_bot_login("pusher_login"))
    return rows.groupBy("is_bot").agg(F.count("*").alias("commits"))


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return staged_judgement(V.push_events(spark, sf), compiled(), _folder(spark))


def _observations(spark: SparkSession, sf: str) -> DataFrame:
    return C.flatten_observation(_judged(spark, sf).where("reject_reason is null"), 1)


@query
def census_observations_lazy(spark: SparkSession, sf: str) -> DataFrame:
    """The same as one lazy plan, joined by key with hot repository-days split."""
    judged = judged_commits(V.push_events(spark, sf), compiled())
    return C.flatten_observation(judged.where("reject_reason is null"), 1)


@query
def census_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Push events to the 25 stored columns, end to end."""
    return _observations(spark, sf)


@query
def census_selected_by_parser(spark: SparkSession, sf: str) -> DataFrame:
    """The selection with the full revert parser instead of the coarse flag."""
    flagged = prefilter_flags(V.commits(spark, sf), compiled())
    kept = C.select_observations(flagged, strict_reference=False)
    return kept.groupBy("day").agg(
        F.count("*").alias("kept"), F.max("commits_in_repo_day").alias("largest_repo_day")
    )


@query
def census_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return C.census_manifest(_judged(spark, sf)).withColumn("by_agent", as_text("by_agent"))


@query
def census_by_agent_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """The summary listing: agents by commits, ties by name."""
    rows = _observations(spark, sf).where("agent_id is not null")
    counted = rows.groupBy("agent_id").agg(F.count("*").alias("commits"))
    return counted.orderBy(F.desc("commits"), "agent_id")


@query
def identity_leak_audit(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["author_email_hash", "author_name_hash", "pusher_login_hash"]
    return C.pii_leak_audit(_observations(spark, sf), columns)


@query
def required_null_audit(spark: SparkSession, sf: str) -> DataFrame:
    stored = _observations(spark, sf)
    return C.required_nulls(stored, [c for c in stored.columns if c not in CENSUS_NULLABLE])


@query
def redacted_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.redact_person_emails(V.commits(spark, sf)).select("message")
    return rows.groupBy("message").agg(F.count("*").alias("commits"))


@query
def active_repos(spark: SparkSession, sf: str) -> DataFrame:
    return C.active_repos(V.push_events(spark, sf))


# --- panel ------------------------------------------------------------------------------


def _treated(spark: SparkSession, sf: str) -> DataFrame:
    rows = attribute(C.valid_commits(V.commits(spark, sf)), compiled())
    return stage(P.treated_candidates(rows), _folder(spark), "treated")


def _control(spark: SparkSession, sf: str) -> DataFrame:
    """Names of repositories that never push here, plus the active ones."""
    idle = V.table(spark, sf, "orders").selectExpr(
        "concat(if(o_orderkey % 3 = 0, 'Idle', 'idle'), o_custkey % 50, '/r', o_orderkey % 2000) AS repo"
    )
    names = C.active_repos(V.push_events(spark, sf)).unionByName(idle).distinct()
    return stage(names, _folder(spark), "control")


def _panel(
    spark: SparkSession,
    sf: str,
    version: int,
    treated: float,
    control: float,
    candidates: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """A panel of the stored ``candidates``, treated and control; they are listed here if not given."""
    drawn, others = candidates or _candidates(spark, sf)
    return P.build_panel(
        drawn,
        others,
        version=version,
        created_on=CREATED_ON,
        treated_rate=treated,
        control_rate=control,
        control_source="archive_active:2025-08-25",
    )


def _candidates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both lists of candidates, stored: a panel and what is asked of it read them several times."""
    return _treated(spark, sf), _control(spark, sf)


@query
def treated_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _treated(spark, sf)


@query
def sample_keys(spark: SparkSession, sf: str) -> DataFrame:
    repos = V.commits(spark, sf).select("repo").distinct()
    keyed = repos.withColumn("sample_key", identity.sample_key("repo"))
    return keyed.withColumn("in_sample", identity.in_sample("repo", 0.25))


@query
def panel_members(spark: SparkSession, sf: str) -> DataFrame:
    return _panel(spark, sf, 1, 0.5, 0.3)


@query
def panel_first_members(spark: SparkSession, sf: str) -> DataFrame:
    return P.first_members(_panel(spark, sf, 1, 0.5, 0.3), 25).select("repo", "cohort")


@query
def panel_diff(spark: SparkSession, sf: str) -> DataFrame:
    found = _candidates(spark, sf)
    changes = P.panel_diff(_panel(spark, sf, 1, 0.5, 0.3, found), _panel(spark, sf, 2, 0.7, 0.2, found))
    return changes.groupBy("change", "old_cohort", "new_cohort").agg(F.count("*").alias("repos"))


@query
def panel_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Validation of a panel with defects: duplicates, bad names and out-of-range keys."""
    members = V.commits(spark, sf).select("repo").distinct().select(
        F.lit(1).alias("panel_version"),
        F.lit(0.5).alias("treated_rate"),
        F.lit(0.3).alias("control_rate"),
        "repo",
        F.when(F.col("repo").endswith("0"), "other").otherwise("treated").alias("cohort"),
        (identity.sample_key("repo") + 100).alias("sample_key"),
    )
    return P.panel_problems(members)


@query
def panel_build_report(spark: SparkSession, sf: str) -> DataFrame:
    found = _candidates(spark, sf)
    return P.build_report(_panel(spark, sf, 1, 0.5, 0.3, found), *found)


@query
def panel_contaminated_control(spark: SparkSession, sf: str) -> DataFrame:
    candidates = _candidates(spark, sf)
    found = P.contaminated_control(_panel(spark, sf, 3, 0.1, 0.6, candidates), candidates[0])
    return found.select("repo", "sample_key")


# --- panel activity ---------------------------------------------------------------------


def _members(spark: SparkSession, sf: str) -> DataFrame:
    orders = V.table(spark, sf, "orders").where("o_orderkey % 11 <> 5")
    names = orders.selectExpr(
        "concat('org', o_orderkey % 60, '/app', o_orderkey) AS a", "concat('away/gone', o_orderkey) AS b", "o_orderkey AS ok"
    )
    return names.selectExpr(
        "explode(array(a, b)) AS repo", "if(ok % 2 = 0, 'treated', 'control') AS cohort", "1 AS panel_version",
        "0.5D AS treated_rate", "0.25D AS control_rate",
    )


def _activity(spark: SparkSession, sf: str, nodes: bool = True) -> DataFrame:
    return A.parse_activity(V.responses(spark, sf), since=SINCE, prs_first=2, nodes=nodes)


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return A.history_pages(V.responses(spark, sf))


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    flagged = A.with_history_flags(_activity(spark, sf, nodes=False), _pages(spark, sf))
    return A.repo_snapshots(flagged, _members(spark, sf), FETCHED_ON)


def _panel_commits(spark: SparkSession, sf: str) -> DataFrame:
    stitched = A.stitch_history(_activity(spark, sf), _pages(spark, sf))
    return A.panel_commits(
        stitched, _members(spark, sf), compiled(), fetched_on=FETCHED_ON, registry_version=1
    )


def _panel_pulls(spark: SparkSession, sf: str) -> DataFrame:
    pulls = A.activity_pulls(_activity(spark, sf))
    return A.panel_pulls(
        pulls, _members(spark, sf), compiled(), fetched_on=FETCHED_ON, registry_version=1
    )


@query
def repo_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshots(spark, sf)


@query
def panel_commits(spark: SparkSession, sf: str) -> DataFrame:
    return _panel_commits(spark, sf).withColumn("committed_at", utc("committed_at"))


@query
def panel_pulls(spark: SparkSession, sf: str) -> DataFrame:
    times = {c: utc(c) for c in ("created_at", "closed_at", "merged_at", "updated_at")}
    return _panel_pulls(spark, sf).withColumns(times)


@query
def history_stitched(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.stitch_history(_activity(spark, sf), _pages(spark, sf))
    return rows.select("repo", "page_no", "sha", utc("committed_at").alias("committed_at"))


@query
def renamed_repos(spark: SparkSession, sf: str) -> DataFrame:
    return A.renamed_repos(_activity(spark, sf, nodes=False))


@query
def api_cost(spark: SparkSession, sf: str) -> DataFrame:
    return A.api_cost(V.responses(spark, sf))


@query
def next_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    activity = _activity(spark, sf)
    stitched = A.stitch_history(activity, _pages(spark, sf))
    found = A.next_watermark(A.activity_pulls(activity), stitched)
    return found.withColumn("since", utc("since"))


@query
def panel_manifest(spark: SparkSession, sf: str) -> DataFrame:
    folder = _folder(spark)
    parsed = stage(_activity(spark, sf), folder, "activity")
    pages = stage(_pages(spark, sf), folder, "pages")
    members, options = _members(spark, sf), {"fetched_on": FETCHED_ON, "registry_version": 1}
    snapshots = A.repo_snapshots(A.with_history_flags(parsed, pages), members, FETCHED_ON)
    commits = A.panel_commits(A.stitch_history(parsed, pages), members, compiled(), **options)
    pulls = A.panel_pulls(A.activity_pulls(parsed), members, compiled(), **options)
    found = A.panel_manifest(snapshots, commits, pulls)
    maps = ("repos_by_status", "commits_by_agent", "pulls_by_agent")
    return found.withColumns({m: as_text(m) for m in maps})


# --- rule tables ------------------------------------------------------------------------


def _derived_rules(spark: SparkSession, sf: str) -> DataFrame:
    """One rule per part, three to an agent, with a defect in some."""
    return V.table(spark, sf, "part").selectExpr(
        "CAST(if(p_partkey % 97 = 0, 0, 1) AS INT) AS registry_version",
        "CAST(p_partkey div 3 + if(p_partkey % 101 = 1, 1, 0) AS INT) AS agent_order",
        "if(p_partkey % 89 = 2, 'Bad Id', concat('agent-', p_partkey div 3)) AS agent_id",
        "'A' AS name",
        "'V' AS vendor",
        "CASE p_partkey % 7 WHEN 0 THEN 'verified' WHEN 1 THEN 'retired' ELSE 'needs_verification' END AS status",
        "CAST(p_partkey % 3 AS INT) AS signal_order",
        "concat('s', if(p_partkey % 83 = 3, 0, p_partkey % 3)) AS signal_id",
        "CASE p_partkey % 5 WHEN 0 THEN 'trailer_name' WHEN 1 THEN 'message' WHEN 2 THEN 'pr_body' WHEN 3 THEN 'author_login' ELSE 'colour' END AS type",
        "if(p_partkey % 10 IN (0, 1), 'Co-Authored-By', NULL) AS trailer_key",
        "CASE p_partkey % 11 WHEN 3 THEN '(open' WHEN 4 THEN '(?=ahead)x' WHEN 5 THEN '(a)\\\\1' ELSE '^ok$' END AS pattern",
        "if(p_partkey % 13 = 0, 'sure', 'high') AS confidence",
        "false AS case_sensitive",
        "if(p_partkey % 14 = 0, 'seen', NULL) AS evidence",
        "CAST(NULL AS STRING) AS notes",
    )


@query
def validate_rules_query(spark: SparkSession, sf: str) -> DataFrame:
    return R.validate_rules(_derived_rules(spark, sf))


@query
def rule_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return R.fingerprint(_derived_rules(spark, sf))


@query
def validate_requirements(spark: SparkSession, sf: str) -> DataFrame:
    """Signals in threes that require one another in a row, in a circle, or one that isn't there."""
    needs = F.expr(
        "CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 17 = 4 THEN array('gone')"
        " WHEN p_partkey % 3 < 2 THEN array(concat('s', p_partkey % 3 + 1))"
        " WHEN p_partkey div 3 % 4 = 1 THEN array('s0', 's1') END"
    )
    parts = V.table(spark, sf, "part").select(
        F.lit(1).alias("registry_version"),
        F.expr("concat('agent-', p_partkey div 3)").alias("agent_id"),
        F.expr("concat('s', p_partkey % 3)").alias("signal_id"),
        needs.alias("requires"),
    )
    return R.requirement_problems(parts)


# --- outcomes ---------------------------------------------------------------------------


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    """The narrow change table, staged: the outcome queries read it several times."""
    rows = attribute(C.valid_commits(V.commits(spark, sf)), compiled())
    changed = O.changes(rows.withColumnRenamed("pushed_at", "at"))
    return stage(changed, _folder(spark), "changes")


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    changed = _changes(spark, sf)
    return O.commit_outcomes(changed, O.revert_links(changed), data_end=data_end())


def _attributed_pulls(spark: SparkSession, sf: str) -> DataFrame:
    return attribute(V.pulls(spark, sf), compiled(), PULL_INPUTS)


@query
def dedupe_commits(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.valid_commits(V.commits(spark, sf)).withColumnRenamed("pushed_at", "at")
    return O.dedupe_commits(rows.select("repo", "sha", "at", "event_id"))


@query
def latest_pulls(spark: SparkSession, sf: str) -> DataFrame:
    """Two fetches per pull request; the second reports the later state of some."""
    pulls = V.pulls(spark, sf).select("repo", "number", "state", "updated_at")
    first = pulls.withColumns(
        {"fetched_on": F.lit(dt.date(2026, 3, 1)), "state": F.lit("OPEN")}
    )
    second = pulls.where("number % 3 <> 0").withColumn("fetched_on", F.lit(FETCHED_ON))
    return O.latest_pulls(first.unionByName(second)).groupBy("fetched_on", "state").agg(
        F.count("*").alias("pulls")
    )


@query
def push_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return O.push_coverage(C.commits_from_pushes(V.push_events(spark, sf)))


@query
def revert_links(spark: SparkSession, sf: str) -> DataFrame:
    return O.revert_links(_changes(spark, sf))


@query
def reapply_netted(spark: SparkSession, sf: str) -> DataFrame:
    changed = _changes(spark, sf)
    return O.net_reapplies(changed, O.resolve_names(changed))


@query
def revert_rate_30d(spark: SparkSession, sf: str) -> DataFrame:
    return O.revert_rate(_outcomes(spark, sf))


@query
def rates_with_ci(spark: SparkSession, sf: str) -> DataFrame:
    return O.rates_with_ci(O.revert_rate(_outcomes(spark, sf)), "reverted", "commits")


@query
def clustered_revert_rate(spark: SparkSession, sf: str) -> DataFrame:
    return O.clustered_rate(_outcomes(spark, sf).where("followed_up"), "reverted", ["agent_id"])


@query
def revert_survival(spark: SparkSession, sf: str) -> DataFrame:
    return O.revert_survival(_outcomes(spark, sf).where(F.col("at") <= data_end()), data_end())


@query
def pr_acceptance(spark: SparkSession, sf: str) -> DataFrame:
    return O.pr_acceptance(_attributed_pulls(spark, sf))


@query
def time_to_merge(spark: SparkSession, sf: str) -> DataFrame:
    return O.time_to_merge(_attributed_pulls(spark, sf))


@query
def review_burden(spark: SparkSession, sf: str) -> DataFrame:
    return O.review_burden(_attributed_pulls(spark, sf))


@query
def followup_fix_rate(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.valid_commits(V.commit_files(spark, sf)).withColumnRenamed("pushed_at", "at")
    files = rows.select("repo", "sha", "at", "path", O.is_fix("message").alias("is_fix"))
    files = stage(files, _folder(spark), "commit_files")
    commits = _changes(spark, sf).select("repo_key", "sha", "agent_id")
    return O.followup_fix_rate(commits, O.followed_by_fix(files))


@query
def outcomes_with_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return O.with_baseline(_outcomes(spark, sf).where("followed_up"), "reverted")


@query
def outcomes_with_period_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Against the same repositories in the same month."""
    rows = _outcomes(spark, sf).where("followed_up")
    return O.with_baseline(rows, "reverted", period=O.period_of("at"))


@query
def outcomes_with_unflagged_baseline(spark: SparkSession, sf: str) -> DataFrame:
    flagged = prefilter_flags(C.valid_commits(V.commits(spark, sf)), compiled())
    judged = attribute(flagged.withColumn("matched_prefilter", any_hit()), compiled())
    changed = stage(O.changes(judged.withColumnRenamed("pushed_at", "at")), _folder(spark), "changes")
    rows = O.commit_outcomes(changed, O.revert_links(changed), data_end=data_end()).where("followed_up")
    return O.with_baseline(
        rows.withColumnRenamed("is_undo", "is_revert"), "reverted", baseline="unflagged"
    )


@query
def pr_outcomes_with_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Merged share of decided pull requests against the same repositories and months."""
    decided = _attributed_pulls(spark, sf).where("state <> 'OPEN'")
    rows = decided.withColumn("accepted", F.col("state") == "MERGED")
    return O.with_baseline(rows, "accepted", period=O.period_of("created_at"))


@query
def time_to_merge_with_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Median seconds from opening to merge against the same repositories and months."""
    merged = _attributed_pulls(spark, sf).where("merged_at IS NOT NULL")
    return O.median_with_baseline(merged, O.seconds_to_merge(), O.period_of("created_at"))


@query
def review_load_with_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Median reviews, comments and threads together, against the same repositories and months."""
    load = F.col("review_count") + F.col("comment_count") + F.col("review_thread_count")
    return O.median_with_baseline(_attributed_pulls(spark, sf), load, O.period_of("created_at"))


def _repo_history(spark: SparkSession, sf: str) -> DataFrame:
    """Stored snapshots of the pushed repositories, of all their fetches."""
    # Stored: members and snapshots both read the parsed rows, which are few columns of large bodies.
    parsed = stage(A.parse_activity(V.repo_fetches(spark, sf), since=SINCE, nodes=False), _folder(spark), "fetched")
    members = parsed.select("repo").distinct().selectExpr("repo", "'treated' AS cohort", "1 AS panel_version")
    return A.repo_snapshots(parsed.withColumn("fetched_on", F.col("fetched_at").cast("date")), members)


def _by_dims(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes with language and size class of their repository as of the commit's time."""
    rows = _outcomes(spark, sf).where("followed_up").select("repo_key", "at", "agent_id", "reverted")
    rows = stage(rows, _folder(spark), "observed")
    dated = O.with_snapshot(rows, stage(_repo_history(spark, sf), _folder(spark), "history"))
    return dated.select(
        F.coalesce("agent_id", F.lit("human")).alias("agent"),
        F.coalesce("language", F.lit("unknown")).alias("language"),
        O.size_class(F.col("stargazers")).alias("size"),
        O.week_of(F.col("at")).alias("week"),
        "reverted",
    )


@query
def rollup_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return O.rollup_outcomes(_by_dims(spark, sf), ["agent", "language", "size", "week"], "reverted")


@query
def cube_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return O.rollup_outcomes(_by_dims(spark, sf), ["agent", "language", "size"], "reverted", cube=True)


@query
def snapshots_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Per repository and language as of the push: commits and the stars they were pushed under."""
    rows = _changes(spark, sf).select("repo_key", "sha", "at")
    dated = O.with_snapshot(rows, stage(_repo_history(spark, sf), _folder(spark), "history"))
    return dated.groupBy("repo_key", "language").agg(
        F.count("*").alias("commits"), F.sum("stargazers").alias("stars")
    )


# --- identity through renames -----------------------------------------------------------


def _lineage(spark: SparkSession, seen: DataFrame) -> DataFrame:
    folder = _folder(spark)
    return L.canonical_repos(seen, lambda df, name: stage(df, folder, name))


@query
def canonical_repos(spark: SparkSession, sf: str) -> DataFrame:
    return _lineage(spark, V.sightings(spark, sf))


def _renamed_changes(spark: SparkSession, sf: str) -> DataFrame:
    lineage = stage(_lineage(spark, V.renamed_sightings(spark, sf)), _folder(spark), "lineage")
    rows = attribute(C.valid_commits(V.renamed_commits(spark, sf)), compiled())
    changed = O.changes(rows.withColumnRenamed("pushed_at", "at"), lineage)
    return stage(changed, _folder(spark), "changes")


@query
def revert_links_renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Reverts of commits that were pushed under the repository's earlier name."""
    return O.revert_links(_renamed_changes(spark, sf))


@query
def latest_pulls_renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Two fetches per pull request, the second under the repository's new name."""
    lineage = stage(_lineage(spark, V.renamed_sightings(spark, sf)), _folder(spark), "lineage")
    pulls = V.pulls(spark, sf).select("repo", "number", "state", "updated_at")
    early, late = (F.lit(dt.date(y, 3, 1)) for y in (2022, 2026))
    first = pulls.withColumns({"fetched_on": early, "state": F.lit("OPEN")})
    renamed = F.when(F.col("number") % 4 == 0, F.concat(F.lit("Moved/repo"), F.col("number") % 240))
    second = pulls.where("number % 3 <> 0").withColumns(
        {"fetched_on": late, "repo": F.coalesce(renamed, "repo")}
    )
    latest = O.latest_pulls(first.unionByName(second), lineage)
    return latest.groupBy("repo_key", "fetched_on", "state").agg(F.count("*").alias("pulls"))


@query
def first_loss_renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Members that were lost under every name they had; those found under a later one are not."""
    seen = V.sightings(spark, sf)
    lineage = stage(_lineage(spark, seen), _folder(spark), "lineage")
    found = seen.where("asked = reported").select(
        F.col("asked").alias("repo"), F.col("seen_on").alias("fetched_on"), F.lit("ok").alias("status")
    )
    # The week after, each name asked for last is gone.
    lost = seen.where("seen_on = DATE'2026-01-26'").select(
        F.col("asked").alias("repo"), F.lit(dt.date(2026, 2, 2)).alias("fetched_on"), F.lit("not_found").alias("status")
    )
    rows = found.unionByName(lost).withColumn("cohort", F.lit("treated"))
    return O.first_loss(rows, lineage)


# --- estimates on the panel -------------------------------------------------------------


@query
def panel_acceptance_weighted(spark: SparkSession, sf: str) -> DataFrame:
    decided = _panel_pulls(spark, sf).where("state <> 'OPEN'").select("repo", "agent_id", "state")
    decided = stage(decided, _folder(spark), "decided")
    return E.panel_rate(decided, _members(spark, sf), F.col("state") == "MERGED", ["agent_id"])


@query
def panel_adoption_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """Share of repositories with commits that have an attributed one."""
    per_repo = _panel_commits(spark, sf).groupBy("repo").agg(F.count("agent_id").alias("attributed"))
    rows = stage(per_repo, _folder(spark), "per_repo")
    return E.panel_rate(rows, _members(spark, sf), F.col("attributed") > 0)


PANEL_END = "2026-03-02 00:00:00"


@query
def panel_revert_rate_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the panel's commits reverted within 30 days."""
    rows = _panel_commits(spark, sf).withColumns({"at": utc("committed_at"), "event_id": F.col("sha")})
    changed = stage(
        O.changes(rows.withColumnRenamed("associated_pr_number", "pr_number")), _folder(spark), "panel_changes"
    )
    end = F.lit(PANEL_END).cast("timestamp_ntz")
    outcomes = O.commit_outcomes(changed, O.revert_links(changed), data_end=end).where("followed_up")
    observed = stage(outcomes.select("repo", "agent_id", "reverted"), _folder(spark), "observed")
    return E.panel_rate(observed, _members(spark, sf), F.col("reverted"), ["agent_id"])


@query
def panel_time_to_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Median seconds to merge on the panel, with bounds."""
    merged = _panel_pulls(spark, sf).where("merged_at IS NOT NULL")
    rows = stage(merged.select("repo", "agent_id", "created_at", "merged_at"), _folder(spark), "merged")
    return E.median_interval(rows, O.seconds_to_merge(), ["agent_id"])


@query
def panel_review_load(spark: SparkSession, sf: str) -> DataFrame:
    """Median reviews, comments and threads together on the panel, with bounds."""
    load = F.col("review_count") + F.col("comment_count") + F.col("review_thread_count")
    rows = _panel_pulls(spark, sf).select("repo", "agent_id", load.alias("load"))
    return E.median_interval(stage(rows, _folder(spark), "load"), F.col("load"), ["agent_id"])


@query
def revert_logrank(spark: SparkSession, sf: str) -> DataFrame:
    """Do attributed commits last as long as others of the same repositories."""
    return E.stratified_logrank(_outcomes(spark, sf).where(F.col("at") <= data_end()), data_end())


# --- stored runs ------------------------------------------------------------------------


def _stored_runs(spark: SparkSession, sf: str) -> str:
    """The census of both rule versions, each stored as its own partition."""
    folder = _folder(spark)
    for version, document in ((1, RULES_V1), (2, RULES_V2)):
        judged = staged_judgement(V.push_events(spark, sf), compiled(document), f"{folder}/v{version}")
        rows = C.flatten_observation(judged.where("reject_reason is null"), version)
        write_partitions(rows, f"{folder}/observations", ["registry_version"], spread=True)
    return f"{folder}/observations"


@query
def compare_stored_runs(spark: SparkSession, sf: str) -> DataFrame:
    root = _stored_runs(spark, sf)
    old, new = (
        read_observations(spark, root, registry_version=v).withColumnRenamed("pushed_at", "at") for v in (1, 2)
    )
    return O.compare_runs(old, new).groupBy("change", "old_agent", "new_agent", "in_old", "in_new").agg(
        F.count("*").alias("commits")
    )


@query
def stored_versions(spark: SparkSession, sf: str) -> DataFrame:
    """What the versioned store holds after two runs."""
    rows = read_observations(spark, _stored_runs(spark, sf))
    return rows.groupBy("registry_version", "methodology_version").agg(
        F.count("*").alias("commits"), F.count("agent_id").alias("attributed")
    )


@query
def census_time_range(spark: SparkSession, sf: str) -> DataFrame:
    """A range of time read back from an ordered store, in the census order."""
    folder = _folder(spark)
    judged = stage(_judged(spark, sf).where("reject_reason is null"), folder, "judged")
    rows = C.flatten_observation(in_ranges(judged, ["day", *CENSUS_ORDER]), 1)
    write_ordered(rows, f"{folder}/observations", ["registry_version"], ["day", *CENSUS_ORDER])
    stored = read_observations(spark, f"{folder}/observations", registry_version=1)
    low, high = "2021-03-01 06:00:00", "2021-06-30 18:00:00"
    wanted = stored.where(F.col("pushed_at").between(F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")))
    return wanted.select("pushed_at", "event_id", "sha", "repo", "agent_id").withColumn("pushed_at", utc("pushed_at"))


@query
def archive_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Pushes per readable day of a stored archive, whose events lie in a folder per day."""
    folder = _folder(spark)
    events = V.push_events(spark, sf)
    month = F.date_trunc("month", "day").cast("date")  # days are gathered, to keep folders few
    write_partitions(events.withColumn("day", month), f"{folder}/archive", ["day"])
    return read_push_events(spark, f"{folder}/archive").groupBy("day").agg(F.count("*").alias("pushes"))


@query
def scan_budget_query(spark: SparkSession, sf: str) -> DataFrame:
    """Which days of that archive are within a budget that all of them keep, and one that none does."""
    folder = _folder(spark)
    events = V.push_events(spark, sf).withColumn("day", F.date_trunc("year", "day").cast("date"))
    write_partitions(events, f"{folder}/archive", ["day"])
    sized = [scan_budget(spark, f"{folder}/archive", ceiling) for ceiling in (2**50, 1)]
    ample, none = (s.select("day", F.col("within_budget").alias(n)) for s, n in zip(sized, ("ample", "none"), strict=True))
    return ample.join(none, "day").select(F.col("day").cast("date").alias("day"), "ample", "none")


@query
def distinct_repos_weekly(spark: SparkSession, sf: str) -> DataFrame:
    """Different repositories per week and agent, merged from daily sketches."""
    rows = attribute(C.valid_commits(V.commits(spark, sf)), compiled())
    stored = stage(K.repo_sketches(rows), _folder(spark), "sketches")
    return K.distinct_repos(stored, [O.week_of(F.col("day")).alias("week"), "agent_id"])


def _snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    """Three fetches of the derived panel in which members disappear one after another."""
    members = _members(spark, sf).withColumn("k", identity.sample_key("repo"))
    fetch = F.explode(F.array(*[F.lit(d) for d in (0, 1, 2)]))
    rows = members.withColumn("f", fetch).withColumn(
        "fetched_on", F.date_add(F.lit(FETCHED_ON), F.col("f") * 30)
    )
    gone = F.col("k") < F.col("f") * 1500
    return rows.withColumn("status", F.when(gone, "not_found").otherwise("ok"))


@query
def attrition(spark: SparkSession, sf: str) -> DataFrame:
    return O.attrition(_snapshot_history(spark, sf))


@query
def first_loss(spark: SparkSession, sf: str) -> DataFrame:
    return O.first_loss(_snapshot_history(spark, sf))


@query
def adoption(spark: SparkSession, sf: str) -> DataFrame:
    return O.adoption(_panel_commits(spark, sf), _members(spark, sf))


@query
def coverage_by_agent(spark: SparkSession, sf: str) -> DataFrame:
    return O.coverage_by_agent(attribute(V.commits(spark, sf), compiled()))


@query
def sources_unioned(spark: SparkSession, sf: str) -> DataFrame:
    census = _observations(spark, sf).withColumn("panel_version", F.lit(None).cast("int"))
    keep = ["panel_version", "registry_version", "repo", "sha", "agent_id"]
    stacked = O.union_sources({"census": census, "panel": _panel_commits(spark, sf)}, keep)
    return stacked.groupBy("source", "panel_version", "registry_version", "agent_id").agg(
        F.count("*").alias("commits")
    )


@query
def compare_versions(spark: SparkSession, sf: str) -> DataFrame:
    commits = C.valid_commits(V.commits(spark, sf)).withColumnRenamed("pushed_at", "at")
    old = attribute(commits, compiled()).withColumnRenamed("agent_id", "old_agent")
    old = old.drop("attribution_confidence", "evidence")
    both = attribute(old, compiled(RULES_V2)).withColumnRenamed("agent_id", "new_agent")
    changes = O.compare_versions(both)
    return changes.groupBy("change", "old_agent", "new_agent").agg(F.count("*").alias("commits"))


@query
def link_commits_to_pulls(spark: SparkSession, sf: str) -> DataFrame:
    return O.link_commits_to_pulls(_changes(spark, sf), V.pulls(spark, sf))


# --- sources and streams ----------------------------------------------------------------


LANDED_ROWS = 250_000
"""Rows of a landed file per core: what a micro-batch reads, and with it about what a stream holds."""

def _landing(spark: SparkSession, sf: str, *, pulse: bool = False) -> str:
    """The line table as a folder where files landed one by one, in the order of the push times.

    The watermark moves between micro-batches, so what one batch reads is held as state until the
    next: a table that lands in one file is held as a whole. Here each file is a batch, of a size that
    the cluster's cores set, and goes on where the one before it ended: no row is late. The files are
    written in turn, since a stream reads them by their age. With a ``pulse``, ``region`` lands last.
    """
    folder = _folder(spark)
    lines = V.with_push_time(V.table(spark, sf, "lineitem").select(*V.LINE_COLUMNS))
    files = max(1, math.ceil(lines.count() / (LANDED_ROWS * spark.sparkContext.defaultParallelism)))
    placed = in_ranges(lines, ["pushed_at"], files).withColumn("file", F.spark_partition_id())
    sliced = stage(placed.drop("pushed_at"), folder, "lines", ["file"]).withColumn("pulse", F.lit(False))
    blank = [F.lit(None).cast(sliced.schema[c].dataType).alias(c) for c in V.LINE_COLUMNS]
    last = [V.table(spark, sf, "region").select(*blank, F.lit(True).alias("pulse"))] if pulse else []
    for rows in [*(sliced.where(F.col("file") == k).drop("file") for k in range(files)), *last]:
        rows.coalesce(1).write.mode("append").option("maxRecordsPerFile", 0).parquet(f"{folder}/landed")
    return f"{folder}/landed"


def _landed(spark: SparkSession, landing: str) -> DataFrame:
    """What lies in the folder of :func:`_landing` as a stream, a file to a micro-batch.

    A file is narrow and has few row groups, so its rows are dealt out to all cores.
    """
    schema = spark.read.parquet(landing).schema
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    return files.repartition(spark.sparkContext.defaultParallelism)


def _commit_stream(lines: DataFrame) -> DataFrame:
    """A stream of lines, turned into commits by the same projection as the table."""
    commits = V.commits_from_lines(lines.select(*V.LINE_COLUMNS))
    return commits.withColumn("pushed_at", F.col("pushed_at").cast("timestamp"))


def _line_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The line table as a stream of files."""
    static = V.table(spark, sf, "lineitem")
    files = spark.readStream.schema(static.schema).option("pathGlobFilter", "lineitem.parquet")
    lines = files.parquet(sf).select(*V.LINE_COLUMNS)
    if V.spread(spark):  # one small file would be one task
        lines = lines.repartition(spark.sparkContext.defaultParallelism)
    return _commit_stream(lines)


def _drain(spark: SparkSession, stream: DataFrame) -> DataFrame:
    folder = _folder(spark)
    S.start_file_sink(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _drain_updates(spark: SparkSession, stream: DataFrame) -> DataFrame:
    folder = _folder(spark)
    S.start_update_sink(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return S.read_updates(spark, f"{folder}/out", stream.schema)


@query
def stream_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """Unique valid commits and their repositories by agent, through a stream."""
    commits = _commit_stream(_landed(spark, _landing(spark, sf)))
    written = _drain_updates(spark, S.attributed_stream(commits, compiled()))
    return O.coverage_by_agent(S.earliest_copies(written).withColumnRenamed("repo_key", "repo"))


@query
def stream_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """All days, those still open at the end of the stream included."""
    return S.latest_counts(_drain_updates(spark, S.daily_counts(_line_stream(spark, sf), compiled())))


@query
def stream_revert_links(spark: SparkSession, sf: str) -> DataFrame:
    """Each commit's first revert by SHA, through a join of two streams."""
    lines = _landed(spark, _landing(spark, sf))
    pairs = S.revert_pairs(_commit_stream(lines), _commit_stream(lines))
    first = S.first_reverts(_drain(spark, pairs))
    return first.withColumns({c: utc(c) for c in ("committed_at", "reverted_at")})


def _ticks(landed: DataFrame, like: DataFrame) -> DataFrame:
    """A pulse long after all pushes, as the next day's landing gives it: it closes every day."""
    tick = {
        "pushed_at": F.lit("2100-01-01 00:00:00").cast("timestamp"),
        "repo": F.lit("tick/tick"),
        "sha": F.lit("0" * 40),
        "message": F.lit(""),
    }
    return landed.where("pulse").select(
        *[tick.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in like.schema]
    )


@query
def stream_census_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Pushed commits to the 25 stored columns, each repository-day judged as its day closes."""

    landing = _landing(spark, sf, pulse=True)

    def landed() -> DataFrame:
        files = _landed(spark, landing)
        lines = _commit_stream(files.where("NOT pulse"))
        return lines.unionByName(_ticks(files, lines))

    stored = _drain(spark, S.census_stream(landed(), landed(), compiled(), 1))
    return stored.withColumn("pushed_at", utc("pushed_at"))


@query
def stream_standing_reverts(spark: SparkSession, sf: str) -> DataFrame:
    """Reverts by SHA and by pull request that still stand, from pairs of a stream."""
    lines = _landed(spark, _landing(spark, sf))
    pairs = _drain(spark, S.undo_pairs(_commit_stream(lines), _commit_stream(lines)))
    found = S.standing_reverts(pairs)
    return found.withColumns({c: utc(c) for c in ("committed_at", "reverted_at")})
