"""Outcome metrics: what happened to changes after they landed.

Everything starts from :func:`changes`, a narrow table with one row per commit in which the
message has already been read: verdict, what the commit undoes, its PR number, whether it is
a fix. Messages are never shuffled. Repository names are compared without case.

Where a key may repeat without bound it is aggregated before it is joined, or looked up N:1;
no operator pairs up the members of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aftermerge.functions import text
from aftermerge.functions.patterns import own
from aftermerge.operators.barrier import with_struct
from aftermerge.operators.asof import asof_join
from aftermerge.operators.joins import HOT_ROWS, lookup_join
from aftermerge.operators.lineage import with_repo_key

SHORT_SHA = 7
"""Shortest abbreviated SHA a revert message may name; the join key of revert linkage."""

# Fixed value: words that mark a follow-up commit as a fix.
FIX_MESSAGE = r"(?i)\b(?:fix|fixes|fixed|bug|bugfix|hotfix|regression|repair)\b"

FIX_PARTS = ("bug", "regre", "repa")
"""Each word of :data:`FIX_MESSAGE` but those with ``fix`` holds one of these, whose letters have no case
outside ASCII. An ``i`` has: in lower case it may be two characters."""

Z_95 = 1.959963984540054
"""Two-sided 95 % normal quantile."""

PERCENT_DIGITS = 6

SHA_BYTES = 20

NO_SHA = b"\0" * (SHA_BYTES + 1)
"""Stands before packed text that is no full SHA, so that it has another length than one."""


def packed_sha(sha: str) -> Column:
    """A full lower-case SHA as its 20 bytes, half of what its digits take in a shuffle.

    Any other text is kept behind :data:`NO_SHA`: texts are equal where their packed forms are.
    """
    raw = F.unhex(sha)
    full = (F.length(sha) == 2 * SHA_BYTES) & (F.lower(F.hex(raw)) == F.col(sha))
    return F.when(full, raw).otherwise(F.concat(F.lit(NO_SHA), F.col(sha).cast("binary")))


def unpacked_sha(packed: str) -> Column:
    """The text that :func:`packed_sha` was given."""
    text_bytes = F.expr(f"substring({packed}, {len(NO_SHA) + 1})")
    full = F.octet_length(packed) == SHA_BYTES
    return F.when(full, F.lower(F.hex(packed))).otherwise(text_bytes.cast("string"))


# --- row preparation -------------------------------------------------------------------

CHANGE_COLUMNS = (
    "event_id agent_id pr_number is_fix is_undo is_reapply target_sha target_pr"
).split()


def changes(judged: DataFrame, lineage: DataFrame | None = None) -> DataFrame:
    """Narrow, de-duplicated change table from attributed commits.

    Needs ``repo, sha, at, message, event_id, agent_id`` (and keeps ``pr_number`` if the
    source knows it, else reads it from the subject). The message is parsed and dropped
    before the first shuffle. Worth staging: every outcome reads it several times.

    ``repo_key`` is the lower-cased name or, with the table of
    :func:`aftermerge.operators.lineage.canonical_repos`, the repository the name meant at the
    commit's time, so that what follows sees through renames.

    A ``matched_prefilter`` of the rows is kept: whether any copy of the commit matched.
    """
    known = F.col("pr_number") if "pr_number" in judged.columns else pr_number("message")
    parsed = judged.select(
        "repo",
        F.lower("sha").alias("sha"),
        "at",
        "event_id",
        "agent_id",
        known.alias("pr_number"),
        is_fix("message").alias("is_fix"),
        F.struct(text.revert("message")).alias("_r"),
        *(F.col(c) for c in ("matched_prefilter",) if c in judged.columns),
    )
    names = [c for c in parsed.columns if c != "_r"]
    undo = with_struct(parsed, F.col("_r"), ["_u"])
    flat = undo.select(
        *names,
        F.col("_u").isNotNull().alias("is_undo"),
        F.col("_u.is_reapply").alias("is_reapply"),
        F.col("_u.reverted_sha").alias("target_sha"),
        F.col("_u.original_pr_number").alias("target_pr"),
    )
    keyed = with_repo_key(flat, lineage).withColumn("sha", packed_sha("sha"))
    if "matched_prefilter" not in judged.columns:
        kept = _first_rows(keyed, [F.col("sha"), F.col("repo_key")], ["at", *CHANGE_COLUMNS, "repo"])
        return kept.withColumn("sha", unpacked_sha("sha"))
    # The first copy and what any copy showed, in one aggregation.
    first = F.min(F.struct("at", *CHANGE_COLUMNS, "repo")).alias("_first")
    folded = keyed.groupBy("sha", "repo_key").agg(first, F.max("matched_prefilter").alias("matched_prefilter"))
    return folded.select("repo_key", unpacked_sha("sha").alias("sha"), "_first.*", "matched_prefilter")


def _first_rows(rows: DataFrame, key: Sequence[Column], order: Sequence[str]) -> DataFrame:
    """The first row of each key. Sorts compare the beginning of the first column of ``key`` and look at the
    rest only where that is equal: name the column with the most values first, as joins and groups do here."""
    first = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def dedupe_commits(commits: DataFrame, order: Sequence[str] = ("at", "event_id")) -> DataFrame:
    """One row per (repo, sha) without case: the first in ``order``, i.e. the earliest push.

    A ``repo_key`` of the rows stands in for the name. The rank filter runs before the shuffle as well (a map task passes on one row per key),
    so copies of one commit never pile up in a task. ``order`` should decide every tie.
    """
    repo = F.col("repo_key") if "repo_key" in commits.columns else F.lower("repo")
    return _first_rows(commits, [F.lower("sha"), repo], [*order, "repo"])


def latest_pulls(pulls: DataFrame, lineage: DataFrame | None = None) -> DataFrame:
    """The newest observation of each pull request across fetches.

    With a ``lineage`` also across the names of its repository, whose ``repo_key`` is added.
    """
    keyed = with_repo_key(pulls, lineage, at="fetched_on")
    newest = Window.partitionBy("repo_key", "number").orderBy(
        F.desc("fetched_on"), F.desc("updated_at"), "repo"
    )
    kept = keyed.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    return kept if lineage is not None else kept.drop("repo_key")


def push_coverage(commits: DataFrame) -> DataFrame:
    """Per repository-day: pushes, commits listed, true push sizes and the share listed."""
    per_push = commits.groupBy("day", "repo", "event_id").agg(
        F.count("*").alias("listed"), F.max("push_size").alias("size")
    )
    return per_push.groupBy("day", "repo").agg(
        F.count("*").alias("pushes"),
        F.sum("listed").alias("listed"),
        F.sum(F.greatest("listed", F.coalesce("size", "listed"))).alias("pushed"),
        F.count_if(F.col("size") > F.col("listed")).alias("truncated_pushes"),
    ).withColumn("coverage", F.round(F.col("listed") / F.col("pushed"), PERCENT_DIGITS))


# --- revert linkage --------------------------------------------------------------------


def pr_number(message: str) -> Column:
    """Number in the trailing ``(#n)`` of a squash-merge subject, or NULL."""
    found = F.regexp_extract(text.subject(message), r"\(#(\d+)\)\z", 1)
    number = F.nullif(found, F.lit("")).try_cast("bigint")
    return F.when(F.contains(F.col(message), F.lit("(#")), number)  # few messages hold one


def resolve_names(changed: DataFrame) -> DataFrame:
    """SHA names used by undo commits -> the one commit each means, per repository.

    Names are made distinct first, with ``undone_at``, when they were last used; so a commit undone
    a million times is one row. The equi-join is on (repository, first seven digits), nearly unique
    on both sides; the rest of the name is a residual prefix test. A name that fits several commits
    resolves to none.

    What a name resolves to is folded as one struct: whichever fields a use of the names reads, its
    plan is the same up to there, so that all commits are shuffled once for all uses.
    """
    names = (
        changed.where(F.length("target_sha") >= SHORT_SHA)
        .groupBy("target_sha", "repo_key")
        .agg(F.max("at").alias("undone_at"))
        .withColumn("key7", F.substring("target_sha", 1, SHORT_SHA))
    )
    commits = changed.select(
        "repo_key",
        packed_sha("sha").alias("_sha"),
        F.col("at").alias("committed_at"),
        F.substring("sha", 1, SHORT_SHA).alias("key7"),
    )
    pairs = names.join(commits, ["repo_key", "key7"]).where(F.startswith(unpacked_sha("_sha"), "target_sha"))
    meant = F.struct("_sha", "committed_at", "undone_at")
    return (
        pairs.groupBy("target_sha", "repo_key")
        .agg(F.count("*").alias("fits"), F.min(meant).alias("_c"))
        .where("fits = 1")
        .select("repo_key", "target_sha", unpacked_sha("_c._sha").alias("sha"), "_c.committed_at", "_c.undone_at")
    )


def net_reapplies(changed: DataFrame, names: DataFrame) -> DataFrame:
    """Every revert with ``reapplied_at`` and ``netted``: was it itself undone afterwards.

    A reapply (or a revert of the revert) that names the revert's SHA nets it, so the change
    it undid stands after all. ``names`` are those of :func:`resolve_names`, where undo events are
    folded per name, and reverts are unique per SHA, so the join cannot skew.
    """
    undone = names.groupBy("sha", "repo_key").agg(F.max("undone_at").alias("undone_at"))
    reverts = changed.where("is_undo and not is_reapply").select(
        "repo_key", "sha", F.col("at").alias("reverted_at"), "target_sha", "target_pr"
    )
    joined = reverts.join(undone, ["sha", "repo_key"], "left")
    later = F.when(F.col("undone_at") >= F.col("reverted_at"), F.col("undone_at"))
    return joined.select(
        "repo_key",
        F.col("sha").alias("revert_sha"),
        "reverted_at",
        "target_sha",
        "target_pr",
        later.alias("reapplied_at"),
        later.isNotNull().alias("netted"),
    )


def revert_links(changed: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per commit whose revert stands: the first such revert, by SHA or PR number.

    Reverts are folded to the earliest per name and per (repository, PR) before they meet
    the commits. An undo older than the commit it names is not a link.
    """
    names = resolve_names(changed)
    standing = net_reapplies(changed, names).where(~F.col("netted"))
    first = F.min(F.struct("reverted_at", "revert_sha")).alias("u")
    link = ["repo_key", "sha", "committed_at", "u.revert_sha", "u.reverted_at"]
    by_sha = (
        standing.where("target_sha is not null")
        .groupBy("target_sha", "repo_key")
        .agg(first)
        .join(names, ["target_sha", "repo_key"])
        .select(*link, F.lit(0).alias("w"))
    )
    per_pr = (
        standing.where("target_pr is not null")
        .groupBy(F.col("target_pr").alias("pr_number"), "repo_key")
        .agg(first)
    )
    with_pr = changed.where("pr_number is not null").select(
        "repo_key", "sha", F.col("at").alias("committed_at"), "pr_number"
    )
    by_pr = lookup_join(with_pr, per_pr, ["pr_number", "repo_key"], "inner", hot_rows).select(
        *link, F.lit(1).alias("w")
    )
    later = by_sha.unionByName(by_pr).where(
        (F.col("reverted_at") >= F.col("committed_at")) & (F.col("revert_sha") != F.col("sha"))
    )
    best = later.groupBy("sha", "repo_key").agg(
        F.min(F.struct("reverted_at", "revert_sha", "w", "committed_at")).alias("b")
    )
    return best.select(
        "repo_key",
        "sha",
        "b.committed_at",
        "b.revert_sha",
        "b.reverted_at",
        F.when(F.col("b.w") == 0, "sha").otherwise("pr").alias("linked_by"),
    )


def commit_outcomes(
    changed: DataFrame, links: DataFrame, *, data_end: Column, window_days: int = 30
) -> DataFrame:
    """Per change: was it reverted within the window, and was the window fully observed.

    Reverts and reapplies are not changes of their own and are left out. Both sides are
    unique per (repository, sha), so the join cannot skew.
    """
    undone = links.select("repo_key", packed_sha("sha").alias("_sha"), "reverted_at")
    keyed = changed.where("not is_undo").withColumn("_sha", packed_sha("sha")).drop("sha")
    met = keyed.join(undone, ["_sha", "repo_key"], "left")
    rest = [F.col(f"`{c}`") for c in met.columns if c not in ("repo_key", "_sha")]
    rows = met.select("repo_key", unpacked_sha("_sha").alias("sha"), *rest)
    window = F.make_dt_interval(F.lit(window_days))
    soon = F.col("reverted_at") <= F.col("at") + window
    return rows.withColumns(
        {
            "reverted": F.coalesce(soon, F.lit(False)),
            "followed_up": F.col("at") + window <= data_end,
        }
    )


# --- rates -----------------------------------------------------------------------------


def rate(hits: Column, n: Column) -> Column:
    """A share, NULL when there is nothing to divide by, rounded for stable comparison."""
    return F.round(F.when(n > 0, hits / n), PERCENT_DIGITS)


def wilson(hits: Column, n: Column, z: float = Z_95) -> tuple[Column, Column]:
    """Wilson score interval of a share: (low, high)."""
    p = hits / n
    denominator = 1 + z * z / n
    centre = p + z * z / (2 * n)
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))

    def bound(value: Column) -> Column:
        return F.round(F.when(n > 0, value / denominator), PERCENT_DIGITS)

    return bound(centre - spread), bound(centre + spread)


def revert_rate(outcomes: DataFrame, by: Sequence[str] = ("agent_id",)) -> DataFrame:
    """Share of fully observed commits reverted within the window, per group."""
    observed = outcomes.where("followed_up")
    counted = observed.groupBy(*by).agg(
        F.count("*").alias("commits"), F.count_if("reverted").alias("reverted")
    )
    return counted.withColumn("revert_rate", rate(F.col("reverted"), F.col("commits")))


def rates_with_ci(counted: DataFrame, hits: str, n: str) -> DataFrame:
    """Add a Wilson 95 % interval to already counted groups."""
    low, high = wilson(F.col(hits), F.col(n))
    return counted.withColumns({"ci_low": low, "ci_high": high})


def clustered_rate(
    outcomes: DataFrame, hit: str, by: Sequence[str], cluster: str = "repo"
) -> DataFrame:
    """Share per group with a standard error that treats whole repositories as the sample.

    Linearised ratio estimator over per-cluster sums; each cluster is reduced to one row
    before its group is, so no repository is held in one place. Names compare without case.
    """
    clusters = outcomes.groupBy(*by, F.lower(cluster).alias("_cluster")).agg(
        F.count("*").alias("n"), F.count_if(F.col(hit)).alias("y")
    )
    sums = clusters.groupBy(*by).agg(
        F.count("*").alias("clusters"),
        F.sum("n").alias("n"),
        F.sum("y").alias("y"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.col("y")).alias("ny"),
        F.sum(F.col("y") * F.col("y")).alias("yy"),
    )
    p = F.col("y") / F.col("n")
    residual = F.col("yy") - 2 * p * F.col("ny") + p * p * F.col("nn")
    scale = F.col("clusters") / (F.col("clusters") - 1)
    error = F.when(
        F.col("clusters") > 1, F.sqrt(F.greatest(residual, F.lit(0.0)) * scale) / F.col("n")
    )
    return sums.select(
        *by,
        "clusters",
        F.col("n").alias("units"),
        F.col("y").alias("hits"),
        F.round(p, PERCENT_DIGITS).alias("rate"),
        F.round(error, PERCENT_DIGITS).alias("std_error"),
    )


def pr_acceptance(pulls: DataFrame, by: Sequence[str] = ("agent_id",)) -> DataFrame:
    """Merged share of the decided pull requests; open ones are counted apart."""
    counted = pulls.groupBy(*by).agg(
        F.count_if(F.col("state") == "MERGED").alias("merged"),
        F.count_if(F.col("state") == "CLOSED").alias("closed"),
        F.count_if(F.col("state") == "OPEN").alias("open"),
    )
    decided = F.col("merged") + F.col("closed")
    return counted.withColumn("acceptance", rate(F.col("merged"), decided))


MEDIAN_BUCKET = 65_536


def exact_median(
    rows: DataFrame, by: Sequence[str], value: Column, weight: Column | None = None
) -> DataFrame:
    """Exact median of a whole-number value per group: ``by..., n, median``.

    ``weight``: how many times a row counts (once without it).

    Values are reduced to counts; a coarse histogram finds the buckets that hold the two
    middle ranks, and only those are ordered value by value. No task ever sees a group, just
    at most ``MEDIAN_BUCKET`` distinct values of it.
    """
    bucket = F.floor(F.col("_v") / F.lit(MEDIAN_BUCKET)).cast("bigint")
    counts = (
        rows.select(*by, value.cast("bigint").alias("_v"), (F.lit(1) if weight is None else weight).alias("_w"))
        .where("_v is not null")
        .groupBy(*by, "_v")
        .agg(F.sum("_w").alias("_n"))
        .withColumn("_b", bucket)
    )
    group = [F.col(name) for name in by] or [F.lit(0)]
    upward = Window.partitionBy(*group).orderBy("_b")
    coarse = counts.groupBy(*by, "_b").agg(F.sum("_n").alias("_bn"))
    ranked = coarse.withColumns(
        {
            "_upto": F.sum("_bn").over(upward),
            "n": F.sum("_bn").over(Window.partitionBy(*group)),
        }
    ).withColumns(
        {"_before": F.col("_upto") - F.col("_bn"), "_lo": F.expr("(n + 1) div 2"), "_hi": F.expr("n div 2 + 1")}
    )
    middle = ranked.where(
        "(_lo > _before and _lo <= _upto) or (_hi > _before and _hi <= _upto)"
    ).select(*[F.col(c).alias(f"_g_{c}") for c in by], F.col("_b").alias("_mb"), "n", "_before", "_lo", "_hi")
    same = F.col("_b") == F.col("_mb")
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_g_{name}"))
    within = Window.partitionBy(*group, F.col("_b")).orderBy("_v")
    fine = counts.join(middle, same).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(within)
    )
    low = F.min(F.when(F.col("_upto") >= F.col("_lo"), F.col("_v")))
    high = F.min(F.when(F.col("_upto") >= F.col("_hi"), F.col("_v")))
    return fine.groupBy(*by).agg(F.max("n").alias("n"), ((low + high) / 2).alias("median"))


def seconds_to_merge() -> Column:
    """Whole seconds from opening to merge."""
    return F.unix_seconds(F.col("merged_at").cast("timestamp")) - F.unix_seconds(
        F.col("created_at").cast("timestamp")
    )


def time_to_merge(pulls: DataFrame, by: Sequence[str] = ("agent_id",)) -> DataFrame:
    """Exact median hours from opening to merge, over merged pull requests (whole seconds)."""
    found = exact_median(pulls.where("merged_at is not null"), by, seconds_to_merge())
    hours = F.round(F.col("median") / 3600, PERCENT_DIGITS).alias("median_hours")
    return found.select(*by, F.col("n").alias("merged"), hours)


def review_burden(pulls: DataFrame, by: Sequence[str] = ("agent_id",)) -> DataFrame:
    """Exact medians per pull request, one row per (group, measure).

    The measures are the three stored counts and their sum.
    """
    parts = ("review_count", "comment_count", "review_thread_count")
    measures = [
        F.struct(F.lit(name).alias("measure"), F.col(name).cast("bigint").alias("value"))
        for name in parts
    ]
    load = F.struct(
        F.lit("load").alias("measure"),
        (F.col(parts[0]) + F.col(parts[1]) + F.col(parts[2])).cast("bigint").alias("value"),
    )
    long = pulls.select(*by, F.explode(F.array(*measures, load)).alias("m")).select(*by, "m.*")
    found = exact_median(long, [*by, "measure"], F.col("value"))
    return found.select(*by, "measure", F.col("n").alias("pulls"), "median")


def is_fix(message: str) -> Column:
    """True for a message whose subject reads like a fix."""
    fix = text.subject(message).rlike(own(FIX_MESSAGE))
    # Only messages that hold such letters have their subject cut out and read.
    words = [F.contains(F.lower(message), F.lit(part)) for part in FIX_PARTS]
    words.append(F.lower(message).rlike("f..?x"))
    return F.coalesce(F.when(reduce(Column.__or__, words), fix), F.lit(False))


def followed_by_fix(
    commit_files: DataFrame, window_days: int = 14, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Per commit: did a later fix touch one of its files within the window.

    ``commit_files`` has ``repo, sha, at, path, is_fix``. Time is cut into buckets as long
    as the window. A fix later in the commit's own bucket is within the window by
    construction, and one in the next bucket is if the bucket's first fix is; so the last
    and first fix time of each (repo, path, bucket) decide exactly, and commits are never
    paired with fixes.
    """
    span = window_days * 86_400_000_000
    micros = F.unix_micros(F.col("at").cast("timestamp"))
    rows = commit_files.select(
        F.lower("repo").alias("repo_key"),
        F.lower("sha").alias("sha"),
        "path",
        "is_fix",
        micros.alias("_t"),
        F.floor(micros / F.lit(span)).cast("bigint").alias("_bucket"),
    )
    fixes = rows.where("is_fix").groupBy("repo_key", "path", "_bucket").agg(
        F.max("_t").alias("last"), F.min("_t").alias("first")
    )
    seen_from = fixes.select(
        "repo_key",
        "path",
        F.explode(
            F.array(
                F.struct(
                    F.col("_bucket").alias("b"),
                    F.col("last").alias("own_last"),
                    F.lit(None).cast("bigint").alias("next_first"),
                ),
                F.struct(
                    (F.col("_bucket") - 1).alias("b"),
                    F.lit(None).cast("bigint").alias("own_last"),
                    F.col("first").alias("next_first"),
                ),
            )
        ).alias("s"),
    )
    lookup = seen_from.groupBy("repo_key", "path", F.col("s.b").alias("_bucket")).agg(
        F.max("s.own_last").alias("own_last"), F.min("s.next_first").alias("next_first")
    )
    narrow = rows.drop("is_fix")
    joined = lookup_join(narrow, lookup, ["repo_key", "path", "_bucket"], "left", hot_rows)
    hit = (F.col("own_last") > F.col("_t")) | (F.col("next_first") <= F.col("_t") + span)
    return joined.groupBy("repo_key", "sha").agg(
        F.max(F.coalesce(hit, F.lit(False))).alias("followed_by_fix")
    )


def followup_fix_rate(
    commits: DataFrame, flags: DataFrame, by: Sequence[str] = ("agent_id",)
) -> DataFrame:
    """Share of commits (with known files) followed by a fix of the same files.

    ``commits`` are changes, ``flags`` come from :func:`followed_by_fix`; both are unique per
    ``repo_key`` and ``sha``.
    """
    joined = commits.join(flags, ["repo_key", "sha"])
    counted = joined.groupBy(*by).agg(
        F.count("*").alias("commits"), F.count_if("followed_by_fix").alias("followed")
    )
    return counted.withColumn("followup_fix_rate", rate(F.col("followed"), F.col("commits")))


# --- comparison with the same repositories' own baseline --------------------------------


def _baseline_rows(baseline: str) -> Column:
    """Which rows an agent is compared with: see :func:`with_baseline`."""
    if baseline not in ("unattributed", "unflagged"):
        raise ValueError(f"unknown baseline {baseline!r}")
    in_baseline = F.col("agent_id").isNull()
    if baseline == "unflagged":
        in_baseline = in_baseline & ~F.col("matched_prefilter") & ~F.col("is_revert")
    return in_baseline


def period_of(at: str, unit: str = "month") -> Column:
    """First day of the calendar period (``week``, ``month``, ``quarter``, ``year``) of ``at``."""
    return F.date_trunc(unit, F.col(at)).cast("date")


def with_baseline(
    outcomes: DataFrame,
    hit: str,
    baseline: str = "unattributed",
    repo: str = "repo",
    period: Column | None = None,
) -> DataFrame:
    """Per agent: its rate, the baseline rate in the same repositories, and the difference.

    ``baseline`` is ``unattributed`` (every commit without an agent) or ``unflagged`` (also
    not flagged by the prefilter and not a revert, as the census manifest counts it). Each
    agent is compared only within cells that have both its rows and baseline ones: a
    repository (names compare without case) in a ``period``, or over all time without one.
    The unit-weighted difference weighs each cell by the agent's rows there, the
    repository-weighted one counts each cell once; ``repos`` is the number of cells.
    """
    where = [F.lower(repo).alias("_repo"), (F.lit(None) if period is None else period).cast("date").alias("_period")]
    cells = outcomes.groupBy(*where, "agent_id", _baseline_rows(baseline).alias("_base")).agg(
        F.count("*").alias("n"), F.count_if(F.col(hit)).alias("y")
    )
    base = (
        cells.where("_base")
        .groupBy(F.col("_repo").alias("_b_repo"), F.col("_period").alias("_b_period"))
        .agg(F.sum("n").alias("base_n"), F.sum("y").alias("base_y"))
    )
    same = (F.col("_repo") == F.col("_b_repo")) & F.col("_period").eqNullSafe(F.col("_b_period"))
    both = cells.where("agent_id is not null").join(base, same)
    p, q = F.col("y") / F.col("n"), F.col("base_y") / F.col("base_n")
    return both.groupBy("agent_id").agg(
        F.count("*").alias("repos"),
        F.sum("n").alias("units"),
        F.round(F.sum("y") / F.sum("n"), PERCENT_DIGITS).alias("agent_rate"),
        F.round(F.sum(q * F.col("n")) / F.sum("n"), PERCENT_DIGITS).alias("baseline_rate"),
        F.round(F.sum((p - q) * F.col("n")) / F.sum("n"), PERCENT_DIGITS).alias("unit_weighted_diff"),
        F.round(F.avg(p - q), PERCENT_DIGITS).alias("repo_weighted_diff"),
    )


def median_with_baseline(
    rows: DataFrame, value: Column, period: Column | None = None, repo: str = "repo"
) -> DataFrame:
    """Per agent: the exact median of its rows and of baseline rows in the same cells.

    A cell is a repository (in a period); an agent's baseline are the rows without an agent
    in the cells where it has some. Those rows are counted per cell and value before they
    meet the agents' cells, so what is joined is a histogram; each value's weight stays in it.
    """
    where = [F.lower(repo).alias("_repo"), (F.lit(None) if period is None else period).cast("date").alias("_period")]
    counts = (
        rows.select(*where, "agent_id", value.cast("bigint").alias("_v"))
        .where("_v is not null")
        .groupBy("_repo", "_period", "agent_id", "_v")
        .agg(F.count("*").alias("_n"))
    )
    own_rows, base = counts.where("agent_id is not null"), counts.where("agent_id is null").drop("agent_id")
    own_cells = own_rows.select(
        F.col("_repo").alias("_a_repo"), F.col("_period").alias("_a_period"), "agent_id"
    ).distinct()
    same = (F.col("_repo") == F.col("_a_repo")) & F.col("_period").eqNullSafe(F.col("_a_period"))
    theirs = own_cells.join(base, same)
    base_cells = base.select(
        F.col("_repo").alias("_a_repo"), F.col("_period").alias("_a_period")
    ).distinct()
    ours = own_rows.join(base_cells, same, "left_semi")
    keep = ["agent_id", "_v", "_n"]
    stacked = ours.select(*keep, F.lit(False).alias("_base")).unionByName(
        theirs.select(*keep, F.lit(True).alias("_base"))
    )
    found = exact_median(stacked, ["agent_id", "_base"], F.col("_v"), weight=F.col("_n"))
    return found.groupBy("agent_id").agg(
        F.max(F.when(~F.col("_base"), F.col("n"))).alias("units"),
        F.max(F.when(~F.col("_base"), F.col("median"))).alias("agent_median"),
        F.max(F.when(F.col("_base"), F.col("n"))).alias("baseline_units"),
        F.max(F.when(F.col("_base"), F.col("median"))).alias("baseline_median"),
    )


def size_class(stars: Column) -> Column:
    """Repository size class by stargazers (our definition; bounds are inclusive below)."""
    return (
        F.when(stars >= 10_000, "huge")
        .when(stars >= 1_000, "large")
        .when(stars >= 100, "medium")
        .when(stars >= 0, "small")
        .otherwise("unknown")
    )


def with_snapshot(rows: DataFrame, snapshots: DataFrame, lineage: DataFrame | None = None) -> DataFrame:
    """Changes with ``language`` and ``stargazers`` of their repository as last fetched before them.

    ``rows`` has ``repo_key`` and ``at``; ``snapshots`` are the stored ones of all fetches. Fetches
    without an answer say nothing. Changes before the first fetch get NULLs.
    """
    answered = with_repo_key(snapshots.where("status = 'ok'"), lineage, at="fetched_on")
    states = answered.select(
        "repo_key", "fetched_on", F.col("primary_language").alias("language"), "stargazers"
    )
    return asof_join(rows, states, ["repo_key"], "at", "fetched_on")


def week_of(at: Column) -> Column:
    """Monday of the ISO week, as a DATE."""
    return F.date_trunc("week", at).cast("date")


def rollup_outcomes(
    outcomes: DataFrame, dims: Sequence[str], hit: str, *, cube: bool = False
) -> DataFrame:
    """Counts and rates at every rollup (or cube) level of ``dims``, with ``level`` naming it.

    The finest grain is counted first; only that small result is expanded into levels.
    """
    finest = outcomes.groupBy(*dims).agg(
        F.count("*").alias("n"), F.count_if(F.col(hit)).alias("y")
    )
    levels = finest.cube(*dims) if cube else finest.rollup(*dims)
    counted = levels.agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("n").alias("units"),
        F.sum("y").alias("hits"),
    )
    return counted.withColumn("rate", rate(F.col("hits"), F.col("units")))


# --- panel measures --------------------------------------------------------------------


def attrition(snapshots: DataFrame) -> DataFrame:
    """Per fetch and cohort: members, members gone, and the share gone."""
    counted = snapshots.groupBy("fetched_on", "cohort").agg(
        F.count("*").alias("members"),
        F.count_if(F.col("status") == "not_found").alias("gone"),
    )
    return counted.withColumn("attrition", rate(F.col("gone"), F.col("members")))


def first_loss(snapshots: DataFrame, lineage: DataFrame | None = None) -> DataFrame:
    """Per member ever gone: the first fetch that missed it and the last that found it.

    With a ``lineage`` members are repositories (``repo_key``): one that is found under a later
    name after its old name was lost has been found.
    """
    gone = F.col("status") == "not_found"
    member = "repo" if lineage is None else "repo_key"
    rows = snapshots if lineage is None else with_repo_key(snapshots, lineage, at="fetched_on")
    seen = rows.groupBy(member, "cohort").agg(
        F.min(F.when(gone, F.col("fetched_on"))).alias("first_lost_on"),
        F.max(F.when(~gone, F.col("fetched_on"))).alias("last_found_on"),
    )
    return seen.where(F.col("first_lost_on").isNotNull())


def adoption(commits: DataFrame, members: DataFrame) -> DataFrame:
    """Per cohort: attributed share of commits and repositories, and the weighted estimate.

    Counts are reduced to one row per repository before membership is looked up. A member
    stands for ``1 / rate`` repositories of its cohort's population.
    """
    per_repo = commits.groupBy("repo").agg(
        F.count("*").alias("commits"), F.count("agent_id").alias("attributed")
    )
    weight = 1 / F.when(F.col("cohort") == "treated", F.col("treated_rate")).otherwise(
        F.col("control_rate")
    )
    joined = members.withColumn("weight", weight).join(per_repo, "repo")
    return joined.groupBy("cohort").agg(
        F.count("*").alias("repos"),
        F.sum("commits").alias("commits"),
        F.sum("attributed").alias("attributed"),
        F.round(F.sum("attributed") / F.sum("commits"), PERCENT_DIGITS).alias("attributed_share"),
        rate(F.count_if(F.col("attributed") > 0), F.count("*")).alias("adopting_share"),
        F.round(F.sum(F.when(F.col("attributed") > 0, F.col("weight")).otherwise(0.0)), 3).alias(
            "adopting_estimate"
        ),
    )


def coverage_by_agent(commits: DataFrame) -> DataFrame:
    """Per agent: commits, repositories and share of all commits (NULL agent = no marker)."""
    per_repo = commits.groupBy("agent_id", F.lower("repo").alias("repo_key")).agg(
        F.count("*").alias("n")
    )
    per_agent = per_repo.groupBy("agent_id").agg(
        F.sum("n").alias("commits"), F.count("*").alias("repos")
    )
    # One row per agent is left: a window over it is small whatever the input.
    total = F.sum("commits").over(Window.partitionBy(F.lit(0)))
    return per_agent.withColumn("share", rate(F.col("commits"), total))


def union_sources(frames: dict[str, DataFrame], keep: Sequence[str]) -> DataFrame:
    """Stack census and panel rows, each tagged with its source; never blended silently."""
    tagged = [
        frame.select(F.lit(name).alias("source"), *keep) for name, frame in sorted(frames.items())
    ]
    stacked = tagged[0]
    for frame in tagged[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def compare_versions(judged: DataFrame) -> DataFrame:
    """Per commit: how its verdict changed between two rule versions.

    ``judged`` carries both verdicts on one row (``old_agent``, ``new_agent``) beside ``repo,
    sha, at, event_id``, so the source is read once. Copies of a commit are folded to the
    earliest as :func:`dedupe_commits` does. The change is ``same``, ``gained``, ``lost`` or
    ``changed``.
    """
    columns = ["repo", "sha", "at", "event_id", "old_agent", "new_agent"]
    order = ["at", "event_id", "old_agent", "new_agent"]
    verdicts = dedupe_commits(judged.select(*columns), order).select(
        F.lower("repo").alias("repo_key"), F.lower("sha").alias("sha"), "old_agent", "new_agent"
    )
    before, after = F.col("old_agent"), F.col("new_agent")
    change = (
        F.when(before.eqNullSafe(after), "same")
        .when(before.isNull(), "gained")
        .when(after.isNull(), "lost")
        .otherwise("changed")
    )
    return verdicts.withColumn("change", change)


VERDICT_COLUMNS = "repo sha at event_id agent_id".split()


def compare_runs(old: DataFrame, new: DataFrame) -> DataFrame:
    """How verdicts changed between two stored runs, commit by commit.

    Each side holds one version's stored rows (``repo, sha, at, event_id, agent_id``); copies are
    folded on each side as :func:`dedupe_commits` does. Both are then dealt out by the same key,
    so the full outer join needs no further shuffle. ``change`` is ``same``, ``gained``, ``lost``
    or ``changed``; a run need not have kept a commit that the other kept, which ``in_old`` and
    ``in_new`` tell.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        keyed = rows.select(*VERDICT_COLUMNS).withColumns(
            {"repo_key": F.lower("repo"), "sha": F.lower("sha")}
        )
        order = Window.partitionBy("repo_key", "sha").orderBy("at", "event_id", "agent_id", "repo")
        first = keyed.withColumn("_n", F.row_number().over(order)).where("_n = 1")
        return first.select(
            "repo_key", "sha", F.col("agent_id").alias(f"{name}_agent"), F.lit(True).alias(f"in_{name}")
        )

    both = side(old, "old").join(side(new, "new"), ["repo_key", "sha"], "full_outer")
    before, after = F.col("old_agent"), F.col("new_agent")
    change = (
        F.when(before.eqNullSafe(after), "same")
        .when(before.isNull(), "gained")
        .when(after.isNull(), "lost")
        .otherwise("changed")
    )
    return both.withColumns(
        {**{c: F.coalesce(c, F.lit(False)) for c in ("in_old", "in_new")}, "change": change}
    )


def revert_survival(outcomes: DataFrame, data_end: Column, by: Sequence[str] = ("agent_id",)) -> DataFrame:
    """Kaplan-Meier share of commits not yet reverted, per day of age.

    Commits are reduced to counts per (group, age in days); only that histogram, at most one
    row per day of history, is windowed. Commits without a revert leave at ``data_end``.
    """
    end = F.coalesce("reverted_at", data_end)
    age = F.greatest(F.datediff(end, F.col("at")), F.lit(0))
    histogram = outcomes.groupBy(*by, age.alias("age_days")).agg(
        F.count("reverted_at").alias("reverted"), F.count("*").alias("left")
    )
    upward = Window.partitionBy(*by).orderBy(F.desc("age_days"))
    downward = Window.partitionBy(*by).orderBy("age_days")
    at_risk = histogram.withColumn("at_risk", F.sum("left").over(upward))
    survives = 1 - F.col("reverted") / F.col("at_risk")
    # A factor of zero (everything left was reverted) ends the curve; logs cover the rest.
    zero = F.max((survives <= 0).cast("int")).over(downward)
    logs = F.sum(F.when(survives > 0, F.log(survives)).otherwise(0.0)).over(downward)
    curve = at_risk.withColumn(
        "survival", F.round(F.when(zero == 1, 0.0).otherwise(F.exp(logs)), PERCENT_DIGITS)
    )
    return curve.where("reverted > 0").select(*by, "age_days", "at_risk", "reverted", "survival")


def link_commits_to_pulls(
    commits: DataFrame, pulls: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Commits with the pull request they landed by: its merge commit, else its number.

    ``pulls`` holds one row per pull request (:func:`latest_pulls`), ``commits`` carries
    ``pr_number``. A commit that is several pulls' merge commit takes the lowest number.
    """
    rows = commits.select(
        F.lower("repo").alias("repo_key"), F.lower("sha").alias("sha"), "pr_number"
    )
    # Merge commits are unique on both sides; only numbers may repeat.
    by_merge = (
        pulls.where(F.col("merge_commit_sha").isNotNull())
        .groupBy(F.lower("repo").alias("repo_key"), F.lower("merge_commit_sha").alias("sha"))
        .agg(F.min("number").alias("merge_pull"))
    )
    numbers = pulls.select(
        F.lower("repo").alias("repo_key"),
        F.col("number").alias("pr_number"),
        F.col("number").alias("number_pull"),
    )
    merged = rows.join(by_merge, ["repo_key", "sha"], "left")
    linked = lookup_join(merged, numbers, ["repo_key", "pr_number"], "left", hot_rows, counted=rows)
    how = F.when(F.col("merge_pull").isNotNull(), "merge_commit").when(
        F.col("number_pull").isNotNull(), "number"
    )
    return linked.select(
        "repo_key",
        "sha",
        F.coalesce("merge_pull", "number_pull").alias("pull_number"),
        how.alias("linked_by"),
    ).where(F.col("pull_number").isNotNull())
