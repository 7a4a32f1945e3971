"""DuckDB SQL for each query, written independently of the Spark expressions.

Trailers are parsed relationally here (one row per line, window sums for folding), evidence
is a union of one SELECT per rule, joins are plain joins, medians and intervals are written
out. Shared steps are CTEs put together by :func:`_with`.
"""

from __future__ import annotations

import re

from workload.views import duck_api, duck_commits, duck_pulls, duck_repo_fetches, duck_sightings

NL = "chr(10)"
CUTOFF = "TIMESTAMP '2025-10-06 23:59:59'"

CTE: dict[str, tuple[tuple[str, ...], str]] = {}
"""CTE name -> (names it needs, its SQL; may define several)."""

CTE["commits"] = ((), duck_commits())
CTE["pulls"] = ((), duck_pulls())
CTE["api"] = ((), duck_api())
CTE["fetches"] = ((), duck_repo_fetches())

# --- trailers of distinct messages -------------------------------------------------------
_TRAILER_STEPS = """
paras AS (
  SELECT message, regexp_split_to_array(
    rtrim(replace(replace(message, chr(13) || chr(10), chr(10)), chr(13), chr(10)), ' ' || chr(10) || chr(9)),
    '\\n\\s*\\n') AS p FROM msgs),
blocks AS (SELECT message, string_split(p[len(p)], chr(10)) AS ls FROM paras WHERE len(p) > 1),
lines AS (SELECT message, UNNEST(ls) AS line, UNNEST(generate_series(1, len(ls))) AS n FROM blocks),
kinds AS (SELECT *, CASE
    WHEN regexp_matches(line, '^\\s') THEN 'fold'
    WHEN regexp_full_match(line, '\\(cherry picked from commit [0-9a-fA-F]{7,64}\\)') THEN 'note'
    WHEN regexp_matches(line, '^[A-Za-z0-9][A-Za-z0-9-]*\\s*:') THEN 'key'
    ELSE 'prose' END AS kind FROM lines),
owned AS (
  SELECT *, sum(CASE WHEN kind = 'key' THEN 1 ELSE 0 END) OVER (PARTITION BY message ORDER BY n) AS g
  FROM kinds WHERE kind <> 'note'),
fits AS (SELECT message FROM owned GROUP BY message HAVING bool_and(kind <> 'prose') AND min(g) >= 1),
trl AS (
  SELECT message, CAST(g - 1 AS INT) AS pos,
    max(CASE WHEN kind = 'key' THEN regexp_extract(line, '^([A-Za-z0-9-]+)', 1) END) AS key,
    trim(string_agg(trim(CASE WHEN kind = 'key' THEN regexp_replace(line, '^[^:]*:', '') ELSE line END), ' ' ORDER BY n)) AS value
  FROM owned JOIN fits USING (message) GROUP BY message, g),
people AS (
  SELECT *, regexp_full_match(value, '.*<[^<>]+>\\s*') AS is_person,
    trim(regexp_extract(value, '^(.*)<[^<>]+>\\s*$', 1)) AS pname,
    trim(regexp_extract(value, '<([^<>]+)>\\s*$', 1)) AS pmail FROM trl)"""
CTE["trailers"] = (("commits",), "msgs AS (SELECT DISTINCT message FROM commits)," + _TRAILER_STEPS)

# --- evidence: one SELECT per rule --------------------------------------------------------


def _evidence(v2: bool = False) -> str:
    """Matches as (rid, ord, agent_id, signal_id, signal_type, confidence, matched)."""
    signer = "SELECT message, arg_min({m}, pos) AS matched FROM people WHERE lower(key) = '{k}' AND {t} GROUP BY message"
    by_message = [
        (1, "heron", "heron-mail", "trailer_email", "high",
         signer.format(m="pmail", k="co-authored-by", t="is_person AND regexp_matches(pmail, '(?i)^bot@heron\\.example$')")),
        (7 if not v2 else 3, "heron", "heron-hint", "message", "medium" if v2 else "low",
         "SELECT message, regexp_extract(message, '(?i)generated with heron') AS matched FROM msgs WHERE regexp_matches(message, '(?i)generated with heron')"),
        (4, "kestrel", "kestrel-task", "trailer_present", "medium",
         signer.format(m="value", k="task-link", t="regexp_matches(value, '(?i)kestrel\\.example/tasks/')")),
    ]
    if not v2:
        by_message.append(
            (3, "heron", "heron-name", "trailer_name", "medium",
             signer.format(m="CASE WHEN is_person THEN pname ELSE value END", k="co-authored-by",
                           t="regexp_matches(CASE WHEN is_person THEN pname ELSE value END, '(?i)^Heron(\\s|$)')")))
    by_field = [
        (2, "kestrel", "kestrel-login", "author_login", "high", "pusher_login", "(?i)^kestrel-app\\[bot\\]$"),
        (5, "kestrel", "kestrel-author", "author_name", "medium", "author_name", "(?i)\\(kestrel\\)$"),
        (6, "kestrel", "kestrel-mail", "author_email", "medium", "author_email", "@kestrel\\.example$"),
    ]
    if v2:
        by_field.append((2.5, "dodo", "dodo-login", "author_login", "high", "pusher_login", "(?i)^dodo$"))
    parts = [
        f"SELECT rid, {o} AS ord, '{a}' AS agent_id, '{s}' AS signal_id, '{t}' AS signal_type, '{c}' AS confidence, matched FROM commits JOIN ({q}) USING (message)"
        for o, a, s, t, c, q in by_message
    ] + [
        f"SELECT rid, {o}, '{a}', '{s}', '{t}', '{c}', regexp_extract({col}, '{p}') FROM commits WHERE {col} <> '' AND regexp_matches({col}, '{p}')"
        for o, a, s, t, c, col, p in by_field
    ]
    return "\n  UNION ALL ".join(parts)


CTE["evidence"] = (
    ("trailers",),
    f"""found AS ({_evidence()}),
evid AS (SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY ord) - 1 AS INT) AS rank FROM found),
verdict AS (SELECT rid, agent_id, confidence FROM evid WHERE rank = 0 AND confidence <> 'low')""",
)
CTE["evidence2"] = (
    ("trailers",),
    f"""found2 AS ({_evidence(v2=True)}),
verdict2 AS (SELECT rid, arg_min(agent_id, ord) AS agent_id FROM found2 GROUP BY rid)""",
)

CTE["evidence3"] = (
    ("evidence",),
    """found3 AS (
  SELECT f.* FROM found f WHERE f.signal_id NOT IN ('heron-name', 'heron-hint', 'kestrel-author')
    OR f.signal_id = 'heron-name' AND f.rid IN (SELECT rid FROM found WHERE signal_id = 'heron-mail')
    OR f.signal_id = 'heron-hint' AND f.rid IN (SELECT a.rid FROM found a JOIN found b USING (rid) WHERE a.signal_id = 'heron-mail' AND b.signal_id = 'heron-name')
    OR f.signal_id = 'kestrel-author' AND f.rid IN (SELECT rid FROM found WHERE signal_id = 'kestrel-mail')),
evid3 AS (SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY ord) - 1 AS INT) AS rank FROM found3)""",
)

_HEAD = f"'^(Revert|Reapply)\\s+\"(.*)\"(?:\\s+\\(#(\\d+)\\))?$'"
CTE["reverts"] = (
    ("commits",),
    f"""heads AS (
  SELECT rid, trim(string_split(rtrim(replace(message, chr(13), '')), {NL} || {NL})[1]) AS head, message FROM commits),
rev AS (
  SELECT rid, regexp_extract(head, {_HEAD}, 1) = 'Reapply' AS is_reapply,
    regexp_extract(head, {_HEAD}, 2) AS original_subject,
    lower(nullif(regexp_extract(message, 'This reverts commit ([0-9a-fA-F]{{7,40}})\\b', 1), '')) AS reverted_sha,
    CAST(coalesce(nullif(regexp_extract(message, '(?m)^Reverts\\s+(?:[\\w.-]+/[\\w.-]+)?#(\\d+)\\s*$', 1), ''),
      nullif(regexp_extract(regexp_extract(head, {_HEAD}, 2), '\\(#(\\d+)\\)$', 1), '')) AS BIGINT) AS original_pr_number,
    CAST(nullif(regexp_extract(head, {_HEAD}, 3), '') AS BIGINT) AS revert_pr_number
  FROM heads WHERE regexp_matches(head, {_HEAD}))""",
)

_SUBJ = "trim(string_split(ltrim(replace(replace(message, chr(13) || chr(10), chr(10)), chr(13), chr(10))), chr(10))[1])"
_OK_SHA = "regexp_full_match(sha, '[0-9a-fA-F]{40}')"
_OK_REPO = "regexp_full_match(repo, '[A-Za-z0-9][A-Za-z0-9-]*/[A-Za-z0-9._-]+')"


def _hash(column: str) -> str:
    return f"CASE WHEN {column} <> '' THEN substr(sha256(lower(trim({column}))), 1, 16) END"


CTE["valid"] = (
    ("commits",),
    f"valid AS (SELECT * REPLACE (lower(sha) AS sha) FROM commits WHERE {_OK_SHA} AND {_OK_REPO})",
)

_MSG_HIT = (
    "regexp_matches(message, '(?im)^Co\\-Authored\\-By\\s*:[^\\n]*bot@heron\\.example|"
    "^Co\\-Authored\\-By\\s*:[^\\n]*Heron(\\s|$)|generated with heron|^Task\\-Link\\s*:[^\\n]*kestrel\\.example/tasks/')"
)
CTE["flags"] = (
    ("commits",),
    f"""flags AS (SELECT *, {_MSG_HIT} AS message_hit,
    regexp_matches(coalesce(author_email, ''), '(?i)@kestrel\\.example$') AS author_email_hit,
    regexp_matches(coalesce(author_name, ''), '(?i)\\(kestrel\\)$') AS author_name_hit,
    regexp_matches(coalesce(pusher_login, ''), '(?i)^kestrel-app\\[bot\\]$') AS pusher_login_hit,
    regexp_matches(message, '^(Revert|Reapply) "') AS revert_hit FROM commits)""",
)
_ANY = "(message_hit OR author_email_hit OR author_name_hit OR pusher_login_hit)"

# What the event scan yields from the derived push events.
_LISTED = "(push_size % 10) NOT IN (4, 5, 7)"
CTE["census"] = (
    ("flags", "evidence", "reverts"),
    f"""scanned AS (SELECT * REPLACE (CASE WHEN push_size % 10 = 6 THEN NULL ELSE push_size END AS push_size) FROM flags WHERE {_LISTED}),
totals AS (SELECT day, repo, count(*) AS commits_in_repo_day FROM scanned GROUP BY day, repo),
cands AS (SELECT DISTINCT day, repo FROM scanned WHERE {_ANY}),
kept AS (
  SELECT s.*, t.commits_in_repo_day FROM scanned s JOIN totals t USING (day, repo) LEFT JOIN cands c USING (day, repo)
  WHERE c.repo IS NOT NULL OR s.revert_hit),
judged AS (
  SELECT k.*, CASE WHEN NOT {_OK_SHA} THEN 'bad_sha' WHEN NOT {_OK_REPO} THEN 'bad_repo' END AS reject_reason,
    v.agent_id, v.confidence, rev.rid IS NOT NULL AS is_revert, rev.is_reapply, rev.reverted_sha, rev.original_pr_number, rev.revert_pr_number
  FROM kept k LEFT JOIN verdict v USING (rid) LEFT JOIN rev USING (rid)),
ejson AS (
  SELECT rid, '[' || string_agg('{{"agent_id":"' || agent_id || '","signal_id":"' || signal_id || '","signal_type":"' || signal_type
    || '","confidence":"' || confidence || '","matched":"' || matched || '"}}', ',' ORDER BY rank) || ']' AS j FROM evid GROUP BY rid),
obs AS (
  SELECT day, 'census-spark-1' AS methodology_version, 1 AS registry_version, event_id, repo, lower(sha) AS sha, pushed_at, is_distinct,
    CAST(push_size AS INT) AS push_size, {_SUBJ} AS subject, message, is_revert, is_reapply, reverted_sha,
    original_pr_number, revert_pr_number, {_hash('author_email')} AS author_email_hash, {_hash('author_name')} AS author_name_hash,
    {_hash('pusher_login')} AS pusher_login_hash, coalesce(suffix(pusher_login, '[bot]'), false) AS pusher_is_bot, agent_id,
    confidence AS attribution_confidence, CASE WHEN agent_id IS NOT NULL THEN j END AS evidence_json, {_ANY} AS matched_prefilter,
    CAST(commits_in_repo_day AS INT) AS commits_in_repo_day
  FROM judged LEFT JOIN ejson USING (rid) WHERE reject_reason IS NULL)""",
)

# --- panel ------------------------------------------------------------------------------
_KEY = "CAST(('0x' || substr(sha256(lower(trim(repo))), 1, 16))::UBIGINT % 10000 AS INT)"
CTE["cohorts"] = (
    ("valid", "evidence"),
    f"""treated AS (SELECT DISTINCT repo FROM valid JOIN verdict USING (rid)),
control AS (
  SELECT repo FROM commits WHERE (push_size % 10) <> 7
  UNION SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'Idle' ELSE 'idle' END || CAST(o_custkey % 50 AS VARCHAR) || '/r' || CAST(o_orderkey % 2000 AS VARCHAR) FROM orders)""",
)


def _panel(name: str, treated: int, control: int) -> str:
    return f"""{name}_t AS (SELECT lower(repo) AS k, min(repo) AS repo FROM treated WHERE {_KEY} < {treated} GROUP BY 1),
{name}_c AS (SELECT lower(repo) AS k, min(repo) AS repo FROM control WHERE {_KEY} < {control} AND lower(repo) NOT IN (SELECT k FROM {name}_t) GROUP BY 1),
{name} AS (SELECT repo, 'treated' AS cohort, 'source_a' AS source FROM {name}_t UNION ALL SELECT repo, 'control', 'archive_active:2025-08-25' FROM {name}_c)"""


CTE["panel1"] = (("cohorts",), _panel("p1", 5000, 3000))
CTE["panel2"] = (("cohorts",), _panel("p2", 7000, 2000))
CTE["panel3"] = (("cohorts",), _panel("p3", 1000, 6000))
CTE["members"] = (
    (),
    """members AS (SELECT UNNEST(['org' || CAST(o_orderkey % 60 AS VARCHAR) || '/app' || CAST(o_orderkey AS VARCHAR), 'away/gone' || CAST(o_orderkey AS VARCHAR)]) AS repo,
  CASE WHEN o_orderkey % 2 = 0 THEN 'treated' ELSE 'control' END AS cohort, 1 AS panel_version FROM orders WHERE o_orderkey % 11 <> 5)""",
)

# --- activity ---------------------------------------------------------------------------
_EP = "TIMESTAMP '2026-01-01 00:00:00'"
CTE["activity"] = (
    ("api", "members"),
    f"""snap AS (
  SELECT DATE '2026-03-02' AS fetched_on, m.panel_version, r.repo, m.cohort, r.status,
    CASE WHEN seen THEN ok END AS repo_id,
    CASE WHEN seen AND ok % 8 <> 0 THEN ['Go', 'Python', 'Rust'][1 + ok % 3] END AS primary_language,
    CASE WHEN seen THEN ok % 6 = 0 END AS is_fork, CASE WHEN seen THEN price % 20000 END AS stargazers,
    CASE WHEN status = 'ok' THEN 'main' END AS default_branch, CASE WHEN status = 'ok' THEN 1 + ok % 3 END AS commits_total_since,
    status = 'ok' AND ok % 10 = 0 AS commits_truncated, r.error,
    CASE WHEN seen THEN CASE WHEN ok % 20 = 7 THEN 'moved/app' || CAST(ok AS VARCHAR) ELSE r.repo END END AS name_with_owner,
    seen AND ok % 2 = 1 AND (ok * 7 + 31) % 60 >= 30 AND (ok * 7 + 62) % 60 >= 30 AS pulls_truncated
  FROM (SELECT *, status IN ('ok', 'empty') AS seen FROM api_repos) r JOIN members m USING (repo)),
crow AS (
  SELECT DATE '2026-03-02' AS fetched_on, m.panel_version, 'panel-spark-1' AS methodology_version, 1 AS registry_version, c.repo, m.cohort,
    c.oid AS sha, {_EP} + INTERVAL '1' MINUTE * c.minutes AS committed_at, string_split(c.message, chr(10))[1] AS subject, c.message, c.pr AS associated_pr_number,
    {_hash('login')} AS author_login_hash, substr(sha256('dev' || CAST(ck AS VARCHAR) || '@example.com'), 1, 16) AS author_email_hash,
    substr(sha256('dev'), 1, 16) AS author_name_hash, coalesce(login IS NOT NULL AND c.bot OR suffix(login, '[bot]'), false) AS author_is_bot,
    c.message LIKE 'Revert%' AS is_revert, CASE WHEN c.message LIKE 'Revert%' THEN false END AS is_reapply,
    CASE WHEN c.message LIKE 'Revert%' THEN substr(sha256('api:' || CAST(ok AS VARCHAR) || ':1'), 1, 10) END AS reverted_sha,
    CASE WHEN c.message LIKE 'Revert%' THEN ok END AS original_pr_number, CAST(NULL AS BIGINT) AS revert_pr_number,
    CASE WHEN c.message LIKE '%bot@heron.example>' THEN 'heron' WHEN login = 'kestrel-app[bot]' THEN 'kestrel' END AS agent_id,
    CASE WHEN c.message LIKE '%bot@heron.example>' OR login = 'kestrel-app[bot]' THEN 'high' END AS attribution_confidence,
    c.message LIKE '%bot@heron.example>' AS by_heron, coalesce(login = 'kestrel-app[bot]', false) AS by_kestrel,
    CASE WHEN c.message LIKE 'Revert%' THEN 'Add retry (#' || CAST(ok AS VARCHAR) || ')' END AS original_subject
  FROM api_commits c JOIN members m USING (repo) WHERE c.oid <> 'short'),
prow AS (
  SELECT DATE '2026-03-02' AS fetched_on, m.panel_version, 'panel-spark-1' AS methodology_version, 1 AS registry_version, p.repo, m.cohort, p.number,
    p.title, p.state, {_EP} AS created_at, CASE WHEN p.state <> 'OPEN' THEN {_EP} + INTERVAL '1' HOUR * p.hours END AS closed_at,
    CASE WHEN p.state = 'MERGED' THEN {_EP} + INTERVAL '1' HOUR * p.hours END AS merged_at, p.state = 'MERGED' AS merged,
    CASE WHEN p.state = 'MERGED' AND ok % 2 = 0 THEN substr(sha256('m:' || CAST(p.number AS VARCHAR)), 1, 40) END AS merge_commit_sha,
    {_hash('login')} AS author_login_hash, login IS NOT NULL AND (ok + i) % 16 = 1 AS author_is_bot, p.additions, 2 AS deletions, 1 AS changed_files,
    CAST(coalesce(p.reviews, 0) AS INT) AS review_count, CAST(p.comments AS INT) AS comment_count, 0 AS review_thread_count,
    p.title LIKE 'Revert%' AS is_revert, CASE WHEN p.title LIKE 'Revert%' THEN false END AS is_reapply, CAST(NULL AS VARCHAR) AS reverted_sha,
    CASE WHEN p.title LIKE 'Revert%' THEN 12 END AS original_pr_number, CAST(NULL AS BIGINT) AS revert_pr_number,
    CASE WHEN p.body <> '' THEN 'kestrel' END AS agent_id, CASE WHEN p.body <> '' THEN 'medium' END AS attribution_confidence,
    CASE WHEN p.body <> '' THEN '[{{"agent_id":"kestrel","signal_id":"kestrel-pr-link","signal_type":"pr_body","confidence":"medium","matched":"kestrel.example/tasks/"}}]' END AS evidence_json,
    {_EP} + INTERVAL '1' DAY * p.updated_days AS updated_at, CASE WHEN p.title LIKE 'Revert%' THEN 'Add thing (#12)' END AS original_subject
  FROM api_pulls p JOIN members m USING (repo) WHERE p.updated_days >= 30)""",
)

# --- outcomes ---------------------------------------------------------------------------
CTE["dedup"] = (
    ("valid", "evidence", "reverts"),
    f"""chg AS (
  SELECT v.rid, v.repo, lower(v.repo) AS repo_key, v.sha, v.pushed_at AS seen, v.event_id, w.agent_id,
    CAST(nullif(regexp_extract({_SUBJ}, '\\(#(\\d+)\\)$', 1), '') AS BIGINT) AS pr,
    regexp_matches({_SUBJ}, '(?i)\\b(fix|fixes|fixed|bug|bugfix|hotfix|regression|repair)\\b') AS is_fix,
    r.rid IS NOT NULL AS is_undo, r.is_reapply, r.reverted_sha AS target_sha, r.original_pr_number AS target_pr
  FROM valid v LEFT JOIN verdict w USING (rid) LEFT JOIN rev r USING (rid)),
ded AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_key, sha ORDER BY seen, event_id, agent_id NULLS FIRST, pr NULLS FIRST, is_fix, is_undo,
  is_reapply NULLS FIRST, target_sha NULLS FIRST, target_pr NULLS FIRST, repo) AS rn FROM chg) WHERE rn = 1)""",
)
CTE["links"] = (
    ("dedup",),
    """pairs AS (
  SELECT n.repo_key, n.target_sha, d.sha, d.seen AS committed_at, count(*) OVER (PARTITION BY n.repo_key, n.target_sha) AS fits
  FROM (SELECT DISTINCT repo_key, target_sha FROM ded WHERE target_sha IS NOT NULL) n JOIN ded d ON d.repo_key = n.repo_key AND starts_with(d.sha, n.target_sha)),
resolved AS (SELECT * FROM pairs WHERE fits = 1),
undone AS (SELECT repo_key, p.sha, max(d.seen) AS undone_at FROM ded d JOIN resolved p USING (repo_key, target_sha) GROUP BY 1, 2),
netted AS (
  SELECT d.repo_key, d.sha AS revert_sha, d.seen AS reverted_at, d.target_sha, d.target_pr, CASE WHEN u.undone_at >= d.seen THEN u.undone_at END AS reapplied_at,
    coalesce(u.undone_at >= d.seen, false) AS netted
  FROM ded d LEFT JOIN undone u ON u.repo_key = d.repo_key AND u.sha = d.sha WHERE d.is_undo AND NOT d.is_reapply),
byname AS (
  SELECT p.repo_key, p.sha, p.committed_at, n.revert_sha, n.reverted_at, 0 AS w,
    row_number() OVER (PARTITION BY p.repo_key, p.target_sha ORDER BY n.reverted_at, n.revert_sha) AS k
  FROM netted n JOIN resolved p USING (repo_key, target_sha) WHERE NOT n.netted),
bypr AS (
  SELECT c.repo_key, c.sha, c.seen, n.revert_sha, n.reverted_at, 1 AS w,
    row_number() OVER (PARTITION BY c.repo_key, c.sha ORDER BY n.reverted_at, n.revert_sha) AS k
  FROM netted n JOIN ded c ON c.repo_key = n.repo_key AND c.pr = n.target_pr WHERE NOT n.netted),
links AS (
  SELECT repo_key, sha, committed_at, revert_sha, reverted_at, CASE w WHEN 0 THEN 'sha' ELSE 'pr' END AS linked_by FROM (
    SELECT *, row_number() OVER (PARTITION BY repo_key, sha ORDER BY reverted_at, revert_sha, w) AS n
    FROM (SELECT * FROM byname WHERE k = 1 UNION ALL SELECT * FROM bypr WHERE k = 1) WHERE reverted_at >= committed_at AND revert_sha <> sha) WHERE n = 1)""",
)
CTE["outcomes"] = (
    ("links",),
    f"""outc AS (
  SELECT d.*, l.reverted_at, coalesce(l.reverted_at <= d.seen + INTERVAL 30 DAY, false) AS reverted, d.seen + INTERVAL 30 DAY <= {CUTOFF} AS followed_up
  FROM ded d LEFT JOIN links l ON l.repo_key = d.repo_key AND l.sha = d.sha WHERE NOT d.is_undo),
obsd AS (SELECT * FROM outc WHERE followed_up)""",
)
CTE["prs"] = (
    ("pulls",),
    """prs AS (SELECT *, CASE WHEN author_login = 'kestrel-app[bot]' OR body <> '' THEN 'kestrel' END AS agent_id FROM pulls)""",
)
CTE["dims"] = (
    ("outcomes", "fetches"),
    """states AS (SELECT lower(repo) AS repo_key, fetched_on, language, stargazers FROM fetches WHERE status = 'ok'),
dims AS (
  SELECT coalesce(agent_id, 'human') AS agent, coalesce(language, 'unknown') AS language,
    CASE WHEN stargazers >= 10000 THEN 'huge' WHEN stargazers >= 1000 THEN 'large' WHEN stargazers >= 100 THEN 'medium' WHEN stargazers >= 0 THEN 'small' ELSE 'unknown' END AS size,
    CAST(date_trunc('week', seen) AS DATE) AS week, reverted
  FROM obsd ASOF LEFT JOIN states ON obsd.repo_key = states.repo_key AND obsd.seen >= states.fetched_on)""",
)
CTE["lineage"] = (
    (),
    duck_sightings()
    + """,
named AS (
  SELECT lower(asked) AS name, seen_on, repo_id, 0 AS w FROM sight UNION ALL SELECT lower(reported), seen_on, repo_id, 1 FROM sight),
name_days AS (SELECT name, seen_on, repo_id FROM (
  SELECT *, row_number() OVER (PARTITION BY name, seen_on ORDER BY repo_id IS NULL, w, repo_id) AS k FROM named) WHERE k = 1),
held AS (SELECT *, last_value(repo_id IGNORE NULLS) OVER (PARTITION BY name ORDER BY seen_on ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM name_days),
placed AS (SELECT name, seen_on, repo_id, sum(CASE WHEN repo_id <> before THEN 1 ELSE 0 END) OVER (PARTITION BY name ORDER BY seen_on) AS tenure FROM held),
tenures AS (SELECT name, tenure, '~' || name || '@' || CAST(tenure AS VARCHAR) AS v, min(seen_on) AS since, max(repo_id) AS repo_id FROM placed GROUP BY 1, 2),
edges AS (
  SELECT v AS a, '#' || CAST(repo_id AS VARCHAR) AS b FROM tenures WHERE repo_id IS NOT NULL
  UNION SELECT '~' || p.name || '@' || CAST(p.tenure AS VARCHAR), '~' || q.name || '@' || CAST(q.tenure AS VARCHAR)
    FROM sight s JOIN placed p ON p.name = lower(s.asked) AND p.seen_on = s.seen_on JOIN placed q ON q.name = lower(s.reported) AND q.seen_on = s.seen_on
    WHERE s.repo_id IS NULL AND lower(s.asked) <> lower(s.reported)),
sides AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT v AS a, v AS b FROM tenures UNION SELECT r.a, s.b FROM reach r JOIN sides s ON s.a = r.b),
ids AS (SELECT a, min(TRY_CAST(b[2:] AS BIGINT)) FILTER (b[1] = '#') AS id, min(b) AS v, count(DISTINCT regexp_extract(b, '^~(.*)@', 1)) FILTER (b[1] = '~') AS names FROM reach GROUP BY a),
lineage AS (
  SELECT t.name, CASE WHEN t.tenure > 0 THEN t.since END AS valid_from, lead(t.since) OVER (PARTITION BY t.name ORDER BY t.tenure) AS valid_to,
    CASE WHEN i.id IS NULL THEN i.v ELSE '#' || CAST(i.id AS VARCHAR) END AS repo_key, i.id AS repo_id,
    i.names > 1 OR max(t.tenure) OVER (PARTITION BY t.name) > 0 AS needed
  FROM tenures t JOIN ids i ON i.a = t.v)""",
)
CTE["members_drawn"] = (
    ("members",),
    """drawn AS (SELECT lower(repo) AS repo, cohort, CASE cohort WHEN 'treated' THEN 0.5 ELSE 0.25 END AS f FROM members)""",
)


def _renamed(text: str, names: str) -> str:
    """A CTE's text over other tables: every one of ``names`` gets the prefix ``p_``."""
    return re.sub(rf"\b({'|'.join(names.split())})\b", r"p_\1", text)


CTE["panel_outcomes"] = (
    ("activity",),
    """p_ded AS (SELECT lower(repo) AS repo_key, repo, sha, committed_at AS seen, agent_id, associated_pr_number AS pr, is_revert AS is_undo, is_reapply,
  reverted_sha AS target_sha, original_pr_number AS target_pr FROM crow),
"""
    + _renamed(CTE["links"][1], "ded pairs resolved undone netted byname bypr links")
    + """,
p_obsd AS (
  SELECT d.*, coalesce(l.reverted_at <= d.seen + INTERVAL 30 DAY, false) AS reverted FROM p_ded d LEFT JOIN p_links l ON l.repo_key = d.repo_key AND l.sha = d.sha
  WHERE NOT d.is_undo AND d.seen + INTERVAL 30 DAY <= TIMESTAMP '2026-03-02 00:00:00')""",
)

CTE["census_all"] = (
    ("flags", "evidence", "reverts"),
    _renamed(
        CTE["census"][1].replace(
            CTE["census"][1][: CTE["census"][1].index("\ntotals")], "scanned AS (SELECT * FROM flags),"
        ),
        "scanned totals cands kept judged ejson obs",
    ),
)

_MSG_HIT_2 = (
    "regexp_matches(message, '(?im)^Co\\-Authored\\-By\\s*:[^\\n]*bot@heron\\.example|"
    "generated with heron|^Task\\-Link\\s*:[^\\n]*kestrel\\.example/tasks/')"
)
CTE["census2"] = (
    ("census", "evidence2"),
    f"""scanned2 AS (SELECT *, {_MSG_HIT_2} OR author_email_hit OR author_name_hit OR pusher_login_hit OR regexp_matches(coalesce(pusher_login, ''), '(?i)^dodo$') AS any2 FROM scanned),
cands2 AS (SELECT DISTINCT day, repo FROM scanned2 WHERE any2),
obs2 AS (
  SELECT s.day, s.repo, lower(s.sha) AS sha, s.pushed_at, s.event_id, v.agent_id FROM scanned2 s LEFT JOIN cands2 c USING (day, repo) LEFT JOIN verdict2 v USING (rid)
  WHERE (c.repo IS NOT NULL OR s.revert_hit) AND {_OK_SHA.replace('sha', 's.sha')} AND {_OK_REPO.replace('repo', 's.repo')})""",
)
CTE["history"] = (
    ("members",),
    f"""hist AS (SELECT repo, cohort, DATE '2026-03-02' + CAST(f * 30 AS INT) AS fetched_on, {_KEY} < f * 1500 AS gone
  FROM members, (SELECT UNNEST([0, 1, 2]) AS f))""",
)


def _with(needs: str, body: str) -> str:
    """``body`` preceded by the CTEs it names (space separated), dependencies first.

    A body that starts with a comma has further CTEs of its own.
    """
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTE[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    return "WITH RECURSIVE " + ",\n".join(CTE[name][1] for name in order) + ("" if body.startswith(",") else "\n") + body


def _wilson(sign: str) -> str:
    z, n = "1.959963984540054", "commits"
    p = "(reverted / commits)"
    return f"round(({p} + {z} * {z} / (2 * {n}) {sign} {z} * sqrt({p} * (1 - {p}) / {n} + {z} * {z} / (4 * {n} * {n}))) / (1 + {z} * {z} / {n}), 6)"


def _baseline(condition: str, src: str = "obsd", cell: str = "lower(repo)", hit: str = "reverted") -> str:
    return f"""SELECT agent_id, count(*) AS repos, CAST(sum(n) AS BIGINT) AS units, round(sum(y) / sum(n), 6) AS agent_rate, round(sum(b_y / bn * n) / sum(n), 6) AS baseline_rate,
  round(sum((y / n - b_y / bn) * n) / sum(n), 6) AS unit_weighted_diff, round(avg(y / n - b_y / bn), 6) AS repo_weighted_diff
FROM (SELECT {cell} AS cell, agent_id, count(*) AS n, count(*) FILTER ({hit}) AS y FROM {src} WHERE agent_id IS NOT NULL GROUP BY 1, 2)
JOIN (SELECT {cell} AS cell, count(*) AS bn, count(*) FILTER ({hit}) AS b_y FROM {src} WHERE {condition} GROUP BY 1) USING (cell) GROUP BY agent_id"""


def _in_month(at: str) -> str:
    return f"lower(repo) || ' in ' || strftime({at}, '%Y-%m')"


def _median_baseline(value: str, condition: str) -> str:
    """Medians of a value of pull requests, within cells that hold both kinds of rows."""
    rows = f"(SELECT {_in_month('created_at')} AS cell, agent_id, {value} AS v FROM prs WHERE {condition})"
    return f"""SELECT agent_id, units, agent_median, baseline_units, baseline_median FROM (
  SELECT agent_id, count(*) AS units, CAST(median(v) AS DOUBLE) AS agent_median FROM {rows} WHERE agent_id IS NOT NULL
    AND cell IN (SELECT cell FROM {rows} WHERE agent_id IS NULL) GROUP BY 1)
JOIN (SELECT c.agent_id, count(*) AS baseline_units, CAST(median(b.v) AS DOUBLE) AS baseline_median
  FROM (SELECT DISTINCT agent_id, cell FROM {rows} WHERE agent_id IS NOT NULL) c JOIN {rows} b ON b.cell = c.cell AND b.agent_id IS NULL GROUP BY 1) USING (agent_id)"""


def _weighted(source: str, hit: str, by: str = "agent_id") -> str:
    """Design-weighted share with the variance of residuals over all members."""
    group = by or "0"
    return f""",
pr AS (SELECT {group} AS g, lower(repo) AS repo, count(*) AS n, count(*) FILTER ({hit}) AS y FROM {source} GROUP BY 1, 2),
share AS (SELECT g, sum(y / f) / sum(n / f) AS p, sum(n / f) AS total, count(*) AS repos, sum(n) AS units, sum(y) AS hits FROM pr JOIN drawn USING (repo) GROUP BY g),
resid AS (SELECT s.g, d.cohort, d.f, coalesce(pr.y - s.p * pr.n, 0) AS e FROM share s CROSS JOIN drawn d LEFT JOIN pr ON pr.repo = d.repo AND pr.g IS NOT DISTINCT FROM s.g),
errs AS (SELECT g, sqrt(sum(v)) AS e FROM (SELECT g, cohort, (1 - f) / (f * f) * count(*) * var_samp(e) AS v FROM resid GROUP BY g, cohort, f) GROUP BY g)
SELECT {'s.g AS ' + by + ', ' if by else ''}repos, CAST(units AS BIGINT) AS units, CAST(hits AS BIGINT) AS hits, round(p, 6) AS rate, round(e / total, 6) AS std_error,
  round(greatest(p - {_Z} * e / total, 0), 6) AS ci_low, round(least(p + {_Z} * e / total, 1), 6) AS ci_high
FROM share s JOIN errs x ON x.g IS NOT DISTINCT FROM s.g"""


_Z = "1.959963984540054"


def _median_bounds(source: str, value: str) -> str:
    return f""",
src AS (SELECT agent_id, lower(repo) AS repo, {value} AS v FROM {source}),
med AS (SELECT agent_id, median(v) AS m, count(*) AS n FROM src GROUP BY 1),
cl AS (SELECT s.agent_id, s.repo, count(*) AS n, count(*) FILTER (s.v <= m.m) AS y FROM src s JOIN med m ON m.agent_id IS NOT DISTINCT FROM s.agent_id GROUP BY 1, 2),
tot AS (SELECT agent_id, count(*) AS clusters, sum(n) AS n, sum(y) / sum(n) AS p FROM cl GROUP BY 1),
half AS (SELECT t.agent_id, {_Z} * sqrt(sum((c.y - t.p * c.n) * (c.y - t.p * c.n)) * any_value(t.clusters) / (any_value(t.clusters) - 1)) AS h
  FROM cl c JOIN tot t ON t.agent_id IS NOT DISTINCT FROM c.agent_id GROUP BY 1),
ord AS (SELECT agent_id, v, row_number() OVER (PARTITION BY agent_id ORDER BY v) AS k FROM src)
SELECT t.agent_id, t.clusters, CAST(t.n AS BIGINT) AS units, CAST(any_value(m.m) AS DOUBLE) AS median,
  CAST(max(o.v) FILTER (o.k = greatest(floor(t.n / 2 - h.h), 1)) AS BIGINT) AS median_low,
  CAST(max(o.v) FILTER (o.k = least(ceil(1 + t.n / 2 + h.h), t.n)) AS BIGINT) AS median_high
FROM tot t JOIN med m ON m.agent_id IS NOT DISTINCT FROM t.agent_id JOIN half h ON h.agent_id IS NOT DISTINCT FROM t.agent_id JOIN ord o ON o.agent_id IS NOT DISTINCT FROM t.agent_id
GROUP BY t.agent_id, t.clusters, t.n"""


_DOC_BODY = "rtrim(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), ' ' || chr(9) || chr(10))"
_API_DEDUP = f"SELECT repo, page_no, oid AS sha, {_EP} + INTERVAL '1' MINUTE * minutes AS committed_at FROM api_commits"
_COUNT_MAP = "'{{' || coalesce(string_agg('\"' || {k} || '\":' || CAST(n AS VARCHAR), ',' ORDER BY {k}) FILTER ({k} IS NOT NULL AND n > 0), '') || '}}'"

ORACLE: dict[str, str] = {
    "attributed_by_agent_day": _with(
        "valid evidence reverts",
        "SELECT day, agent_id, count(*) AS commits, count(rev.rid) AS reverts FROM valid JOIN verdict USING (rid) LEFT JOIN rev USING (rid) GROUP BY day, agent_id",
    ),
    "subjects": _with("commits", f"SELECT event_id, sha, {_SUBJ} AS subject FROM commits"),
    "document_subjects": f"""SELECT doc_id, trim(string_split(ltrim({_DOC_BODY}, ' ' || chr(9) || chr(10)), chr(10))[1]) AS subject, length({_DOC_BODY}) AS chars,
  0 AS trailers, regexp_matches(ltrim({_DOC_BODY}), '^(Revert|Reapply)\\s+"') AS is_revert FROM documents""",
    "conversation_trailers": "SELECT conv_id, turn, 0 AS pos, 'Signed-Off-By' AS key, role || ' <' || role || '@x.example>' AS value, role || '@x.example' AS email FROM conversations",
    "trailers_exploded": _with(
        "trailers",
        "SELECT repo, sha, event_id, pos, key, value, CASE WHEN is_person THEN pname END AS person_name, CASE WHEN is_person THEN pmail END AS person_email FROM commits JOIN people USING (message)",
    ),
    "trailer_key_counts": _with(
        "trailers",
        "SELECT lower(key) AS key, count(*) AS trailers, count(*) FILTER (is_person) AS with_person FROM commits JOIN people USING (message) GROUP BY 1",
    ),
    "trailer_lookup": _with(
        "trailers",
        "SELECT event_id, sha, string_agg(value, '|' ORDER BY pos) AS signers FROM commits JOIN people USING (message) WHERE lower(key) = 'co-authored-by' GROUP BY rid, event_id, sha",
    ),
    "evidence_table": _with(
        "evidence",
        "SELECT repo, sha, event_id, rank, agent_id, signal_id, signal_type, confidence, matched FROM commits JOIN evid USING (rid)",
    ),
    "agent_ids": _with(
        "evidence",
        """SELECT agents, CAST(signals AS INT) AS signals, count(*) AS commits FROM (
  SELECT coalesce(string_agg(agent_id, ',' ORDER BY r), '') AS agents, coalesce(sum(k), 0) AS signals FROM commits
  LEFT JOIN (SELECT rid, agent_id, min(rank) AS r, count(*) AS k FROM evid GROUP BY rid, agent_id) USING (rid) GROUP BY rid) GROUP BY 1, 2""",
    ),
    "agent_status_counts": _with(
        "evidence",
        "SELECT agent_id, count(*) AS commits, CASE agent_id WHEN 'heron' THEN 'verified' ELSE 'needs_verification' END AS agent_status, CASE agent_id WHEN 'heron' THEN 'Heron' ELSE 'Kestrel' END AS agent_name FROM verdict GROUP BY agent_id",
    ),
    "reverts_parsed": _with(
        "reverts",
        "SELECT repo, sha, event_id, is_reapply, original_subject, reverted_sha, original_pr_number, revert_pr_number FROM commits JOIN rev USING (rid)",
    ),
    "prefilter_flags": _with(
        "flags",
        "SELECT event_id, sha, message_hit, author_email_hit, author_name_hit, pusher_login_hit, revert_hit FROM flags",
    ),
    "prefilter_audit": _with(
        "flags evidence",
        f"SELECT agent_id, signal_id, count(*) AS attributed, count(*) FILTER (NOT {_ANY}) AS missed FROM flags JOIN evid USING (rid) WHERE rank = 0 AND confidence <> 'low' GROUP BY 1, 2",
    ),
    "commits_from_payload": _with(
        "commits",
        f"SELECT day, event_id, repo, pusher_login, pushed_at, CASE WHEN push_size % 10 = 6 THEN NULL ELSE push_size END AS push_size, sha, message, author_name, author_email, is_distinct FROM commits WHERE {_LISTED}",
    ),
    "event_properties": "SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS events FROM events GROUP BY 1, 2",
    "day_status": """SELECT CASE WHEN day < DATE '2011-02-12' THEN 'before_archive' WHEN day > DATE '2025-10-06' THEN 'no_commit_content' WHEN day >= DATE '2025-08-01' THEN 'incomplete' ELSE 'ok' END AS status, count(*) AS days
FROM (SELECT DATE '2010-12-01' + CAST(o_orderkey % 5800 AS INT) AS day FROM orders) GROUP BY 1""",
    "validated_commits": _with("valid", "SELECT event_id, repo, sha, pushed_at FROM valid"),
    "rejected_commits": _with(
        "commits",
        f"SELECT event_id, repo, sha, CASE WHEN NOT {_OK_SHA} THEN 'bad_sha' ELSE 'bad_repo' END AS reject_reason FROM commits WHERE NOT ({_OK_SHA} AND {_OK_REPO})",
    ),
    "hashed_identities": _with(
        "commits",
        f"SELECT event_id, sha, {_hash('author_email')} AS author_email_hash, {_hash('author_name')} AS author_name_hash, {_hash('pusher_login')} AS pusher_login_hash FROM commits",
    ),
    "bot_flags": _with("commits", "SELECT coalesce(suffix(pusher_login, '[bot]'), false) AS is_bot, count(*) AS commits FROM commits GROUP BY 1"),
    "census_observations": _with("census", "SELECT * FROM obs"),
    "census_observations_lazy": _with("census", "SELECT * FROM obs"),
    "census_selected_by_parser": _with(
        "flags reverts",
        f"""SELECT day, count(*) AS kept, max(n) AS largest_repo_day FROM (
  SELECT f.day, count(*) OVER w AS n, bool_or({_ANY}) OVER w AS cand, rev.rid IS NOT NULL AS is_rev FROM flags f LEFT JOIN rev USING (rid) WINDOW w AS (PARTITION BY f.day, f.repo))
WHERE cand OR is_rev GROUP BY day""",
    ),
    "census_manifest": _with(
        "census",
        f"""SELECT day, CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (agent_id IS NOT NULL), 0) AS BIGINT) AS attributed, CAST(sum(revs) AS BIGINT) AS reverts,
  CAST(sum(base) AS BIGINT) AS baseline, CAST(sum(bad) AS BIGINT) AS skipped_invalid, {_COUNT_MAP.format(k='agent_id')} AS by_agent
FROM (SELECT day, agent_id, count(*) FILTER (reject_reason IS NULL) AS n, count(*) FILTER (reject_reason IS NULL AND is_revert) AS revs,
  count(*) FILTER (reject_reason IS NULL AND NOT {_ANY} AND NOT is_revert) AS base, count(*) FILTER (reject_reason IS NOT NULL) AS bad FROM judged GROUP BY 1, 2) GROUP BY day""",
    ),
    "census_by_agent_ranked": _with("census", "SELECT agent_id, count(*) AS commits FROM obs WHERE agent_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1"),
    "identity_leak_audit": "SELECT UNNEST(['author_email_hash', 'author_name_hash', 'pusher_login_hash']) AS column_name, CAST(0 AS BIGINT) AS leaks FROM (SELECT count(*) FROM lineitem)",
    "required_null_audit": "SELECT UNNEST(['day', 'methodology_version', 'registry_version', 'event_id', 'repo', 'sha', 'pushed_at', 'is_distinct', 'subject', 'message', 'is_revert', 'pusher_is_bot', 'matched_prefilter', 'commits_in_repo_day']) AS column_name, CAST(0 AS BIGINT) AS nulls FROM (SELECT count(*) FROM lineitem)",
    "redacted_messages": _with(
        "commits",
        """SELECT CASE WHEN regexp_matches(message, '<[^<>\\s@]+@[^<>\\s@]+>') THEN
    CASE WHEN len(m) = 1 THEN replace(message, '<' || m[1] || '>', '<' || substr(sha256(lower(m[1])), 1, 16) || '>')
    ELSE replace(replace(message, '<' || m[1] || '>', '<' || substr(sha256(lower(m[1])), 1, 16) || '>'), '<' || m[2] || '>', '<' || substr(sha256(lower(m[2])), 1, 16) || '>') END
  ELSE message END AS message, count(*) AS commits
FROM (SELECT message, regexp_extract_all(message, '<([^<>\\s@]+@[^<>\\s@]+)>', 1) AS m FROM commits) GROUP BY 1""",
    ),
    "active_repos": _with("commits", "SELECT DISTINCT repo FROM commits WHERE (push_size % 10) <> 7"),
    "treated_candidates": _with("cohorts", "SELECT repo FROM treated"),
    "sample_keys": _with("commits", f"SELECT DISTINCT repo, {_KEY} AS sample_key, {_KEY} < 2500 AS in_sample FROM commits"),
    "panel_members": _with(
        "panel1",
        f"SELECT 1 AS panel_version, DATE '2026-01-05' AS created_on, CAST(0.5 AS DOUBLE) AS treated_rate, CAST(0.3 AS DOUBLE) AS control_rate, repo, cohort, DATE '2026-01-05' AS added_on, source, {_KEY} AS sample_key FROM p1",
    ),
    "panel_first_members": _with("panel1", "SELECT repo, cohort FROM p1 ORDER BY CASE cohort WHEN 'treated' THEN 0 ELSE 1 END, lower(repo) LIMIT 25"),
    "panel_diff": _with(
        "panel1 panel2",
        """SELECT CASE WHEN a.cohort IS NULL THEN 'added' WHEN b.cohort IS NULL THEN 'removed' WHEN a.cohort = b.cohort THEN 'kept' ELSE 'moved' END AS change,
  a.cohort AS old_cohort, b.cohort AS new_cohort, count(*) AS repos FROM p1 a FULL JOIN p2 b ON lower(a.repo) = lower(b.repo) GROUP BY 1, 2, 3""",
    ),
    "panel_problems": _with(
        "commits",
        f"""SELECT * FROM (
  SELECT 1 AS panel_version, lower(repo) AS repo, 'repository appears more than once' AS problem FROM r GROUP BY lower(repo) HAVING count(*) > 1
  UNION ALL SELECT 1, repo, 'unknown cohort' FROM r WHERE suffix(repo, '0')
  UNION ALL SELECT 1, repo, 'invalid repository name' FROM r WHERE NOT {_OK_REPO}
  UNION ALL SELECT 1, repo, 'sample key out of range' FROM r WHERE {_KEY} + 100 > 9999)""",
    ).replace("\nSELECT * FROM (", ",\nr AS (SELECT DISTINCT repo FROM commits)\nSELECT * FROM (", 1),
    "panel_build_report": _with(
        "panel1",
        """SELECT 'treated' AS cohort, (SELECT count(*) FROM p1 WHERE cohort = 'treated') AS members, (SELECT count(*) FROM treated) AS candidates
UNION ALL SELECT 'control', (SELECT count(*) FROM p1 WHERE cohort = 'control'), (SELECT count(*) FROM control)""",
    ),
    "panel_contaminated_control": _with(
        "panel3",
        f"SELECT repo, {_KEY} AS sample_key FROM p3 WHERE cohort = 'control' AND lower(repo) IN (SELECT lower(repo) FROM treated)",
    ),
    "repo_snapshots": _with("activity", "SELECT * FROM snap"),
    "panel_commits": _with(
        "activity",
        """SELECT * EXCLUDE (by_heron, by_kestrel), CASE WHEN agent_id IS NOT NULL THEN '[' || concat_ws(',',
    CASE WHEN by_heron THEN '{"agent_id":"heron","signal_id":"heron-mail","signal_type":"trailer_email","confidence":"high","matched":"bot@heron.example"}' END,
    CASE WHEN by_kestrel THEN '{"agent_id":"kestrel","signal_id":"kestrel-login","signal_type":"author_login","confidence":"high","matched":"kestrel-app[bot]"}' END,
    CASE WHEN by_heron THEN '{"agent_id":"heron","signal_id":"heron-name","signal_type":"trailer_name","confidence":"medium","matched":"Heron"}' END) || ']' END AS evidence_json FROM crow""",
    ),
    "panel_pulls": _with("activity", "SELECT * FROM prow"),
    "history_stitched": _with("api", _API_DEDUP.replace("repo, page_no, oid", "repo, CAST(page_no AS INT) AS page_no, oid")),
    "renamed_repos": _with(
        "api",
        "SELECT repo, 'moved/app' || CAST(ok AS VARCHAR) AS name_with_owner, ok AS repo_id FROM api_repos WHERE status IN ('ok', 'empty') AND ok % 20 = 7",
    ),
    "api_cost": """SELECT 'batch' AS kind, count(*) AS requests, CAST(sum(1 + o_orderkey % 3) AS BIGINT) AS points_spent, arg_max(5000 - o_orderkey % 1000, o_orderkey) AS last_remaining FROM orders
UNION ALL SELECT 'history', count(*), count(*), 4000 FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 12 > 2""",
    "next_watermarks": _with(
        "api",
        f"SELECT repo, max(seen) AS since FROM (SELECT repo, {_EP} + INTERVAL '1' DAY * updated_days AS seen FROM api_pulls WHERE updated_days >= 30 UNION ALL SELECT repo, committed_at FROM ({_API_DEDUP})) GROUP BY repo",
    ),
    "panel_manifest": _with(
        "activity",
        f"""SELECT DATE '2026-03-02' AS fetched_on, 1 AS panel_version, (SELECT count(*) FROM snap) AS repos,
  (SELECT {_COUNT_MAP.format(k='status')} FROM (SELECT status, count(*) AS n FROM snap GROUP BY 1)) AS repos_by_status,
  (SELECT count(*) FROM crow) AS commits, (SELECT count(agent_id) FROM crow) AS commits_attributed, (SELECT count(*) FILTER (is_revert) FROM crow) AS commits_reverts,
  (SELECT {_COUNT_MAP.format(k='agent_id')} FROM (SELECT agent_id, count(*) AS n FROM crow GROUP BY 1)) AS commits_by_agent,
  (SELECT count(*) FROM prow) AS pulls, (SELECT count(agent_id) FROM prow) AS pulls_attributed, (SELECT count(*) FILTER (is_revert) FROM prow) AS pulls_reverts,
  (SELECT {_COUNT_MAP.format(k='agent_id')} FROM (SELECT agent_id, count(*) AS n FROM prow GROUP BY 1)) AS pulls_by_agent""",
    ),
    "validate_rules": """WITH r AS (
  SELECT CAST(CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE 1 END AS INT) AS registry_version, p_partkey // 3 + CASE WHEN p_partkey % 101 = 1 THEN 1 ELSE 0 END AS agent_order,
    CASE WHEN p_partkey % 89 = 2 THEN 'Bad Id' ELSE 'agent-' || CAST(p_partkey // 3 AS VARCHAR) END AS agent_id,
    CASE p_partkey % 7 WHEN 0 THEN 'verified' WHEN 1 THEN 'retired' ELSE 'needs_verification' END AS status,
    's' || CAST(CASE WHEN p_partkey % 83 = 3 THEN 0 ELSE p_partkey % 3 END AS VARCHAR) AS signal_id,
    ['trailer_name', 'message', 'pr_body', 'author_login', 'colour'][p_partkey % 5 + 1] AS type,
    p_partkey % 10 IN (0, 1) AS has_key, p_partkey % 11 AS pat, p_partkey % 13 = 0 AS sure, p_partkey % 14 = 0 AS seen FROM part)
SELECT registry_version, agent_id, signal_id, 'version below 1' AS problem FROM r WHERE registry_version < 1
UNION ALL SELECT registry_version, agent_id, signal_id, 'agent id is not a slug' FROM r WHERE agent_id = 'Bad Id'
UNION ALL SELECT registry_version, agent_id, signal_id, 'unknown type' FROM r WHERE type = 'colour'
UNION ALL SELECT registry_version, agent_id, signal_id, 'trailer_key missing' FROM r WHERE type = 'trailer_name' AND NOT has_key
UNION ALL SELECT registry_version, agent_id, signal_id, 'trailer_key not allowed' FROM r WHERE type IN ('message', 'pr_body', 'author_login') AND has_key
UNION ALL SELECT registry_version, agent_id, signal_id, 'unknown confidence' FROM r WHERE sure
UNION ALL SELECT registry_version, agent_id, signal_id, 'unknown status' FROM r WHERE status = 'retired'
UNION ALL SELECT registry_version, agent_id, signal_id, 'verified without evidence' FROM r WHERE status = 'verified' AND NOT sure AND NOT seen
UNION ALL SELECT registry_version, agent_id, signal_id, 'invalid regular expression' FROM r WHERE pat = 3
UNION ALL SELECT registry_version, agent_id, signal_id, 'not portable' FROM r WHERE pat IN (4, 5)
UNION ALL SELECT registry_version, agent_id, signal_id, 'duplicate signal id' FROM r GROUP BY 1, 2, 3 HAVING count(*) > 1
UNION ALL SELECT registry_version, agent_id, NULL, 'duplicate agent id' FROM r GROUP BY 1, 2 HAVING count(DISTINCT agent_order) > 1""",
    "rule_fingerprints": r"""WITH r AS (
  SELECT CASE WHEN p_partkey % 97 = 0 THEN '0' ELSE '1' END AS registry_version,
    CAST(p_partkey // 3 + CASE WHEN p_partkey % 101 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS agent_order,
    CASE WHEN p_partkey % 89 = 2 THEN 'Bad Id' ELSE 'agent-' || CAST(p_partkey // 3 AS VARCHAR) END AS agent_id,
    CASE p_partkey % 7 WHEN 0 THEN 'verified' WHEN 1 THEN 'retired' ELSE 'needs_verification' END AS status,
    CAST(p_partkey % 3 AS VARCHAR) AS signal_order,
    's' || CAST(CASE WHEN p_partkey % 83 = 3 THEN 0 ELSE p_partkey % 3 END AS VARCHAR) AS signal_id,
    ['trailer_name', 'message', 'pr_body', 'author_login', 'colour'][p_partkey % 5 + 1] AS type,
    CASE WHEN p_partkey % 10 IN (0, 1) THEN 'Co-Authored-By' END AS trailer_key,
    CASE p_partkey % 11 WHEN 3 THEN '(open' WHEN 4 THEN '(?=ahead)x' WHEN 5 THEN '(a)\1' ELSE '^ok$' END AS pattern,
    CASE WHEN p_partkey % 13 = 0 THEN 'sure' ELSE 'high' END AS confidence,
    CASE WHEN p_partkey % 14 = 0 THEN 'seen' END AS evidence FROM part),
marked AS (SELECT registry_version, [registry_version, agent_order, agent_id, 'A', 'V', status, signal_order, signal_id,
    type, trailer_key, pattern, confidence, 'false', evidence, NULL] AS v FROM r),
hashed AS (SELECT registry_version, sha256(array_to_string(
    list_transform(v, lambda x: coalesce(length(x) || ':' || x, '-')), '')) AS h FROM marked),
sums AS (SELECT registry_version, count(*) || '-' || sum(CAST('0x' || h[1:15] AS BIGINT)) || '-' || sum(CAST('0x' || h[16:30] AS BIGINT))
    || '-' || sum(CAST('0x' || h[31:45] AS BIGINT)) || '-' || sum(CAST('0x' || h[46:60] AS BIGINT)) AS s FROM hashed GROUP BY 1)
SELECT CAST(registry_version AS INT) AS registry_version, sha256(s)[1:16] AS fingerprint FROM sums""",
    "dedupe_commits": _with("dedup", "SELECT repo, sha, seen AS \"at\", event_id FROM ded"),
    "latest_pulls": _with(
        "pulls",
        "SELECT CASE WHEN number % 3 <> 0 THEN DATE '2026-03-02' ELSE DATE '2026-03-01' END AS fetched_on, CASE WHEN number % 3 <> 0 THEN state ELSE 'OPEN' END AS state, count(*) AS pulls FROM pulls GROUP BY 1, 2",
    ),
    "push_coverage": _with(
        "commits",
        f"""SELECT day, repo, count(*) AS pushes, CAST(sum(listed) AS BIGINT) AS listed, CAST(sum(greatest(listed, coalesce(size, listed))) AS BIGINT) AS pushed,
  count(*) FILTER (size > listed) AS truncated_pushes, round(sum(listed) / sum(greatest(listed, coalesce(size, listed))), 6) AS coverage
FROM (SELECT day, repo, event_id, count(*) AS listed, max(CASE WHEN push_size % 10 = 6 THEN NULL ELSE push_size END) AS size FROM commits WHERE {_LISTED} GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    ),
    "revert_links": _with("links", "SELECT * FROM links"),
    "reapply_netted": _with("links", "SELECT * FROM netted"),
    "revert_rate_30d": _with(
        "outcomes",
        "SELECT agent_id, count(*) AS commits, count(*) FILTER (reverted) AS reverted, round(count(*) FILTER (reverted) / count(*), 6) AS revert_rate FROM obsd GROUP BY 1",
    ),
    "rates_with_ci": _with(
        "outcomes",
        f"SELECT agent_id, commits, reverted, round(reverted / commits, 6) AS revert_rate, {_wilson('-')} AS ci_low, {_wilson('+')} AS ci_high FROM (SELECT agent_id, count(*) AS commits, count(*) FILTER (reverted) AS reverted FROM obsd GROUP BY 1)",
    ),
    "clustered_revert_rate": _with(
        "outcomes",
        """SELECT agent_id, count(*) AS clusters, CAST(sum(n) AS BIGINT) AS units, CAST(sum(y) AS BIGINT) AS hits, round(max(p), 6) AS rate,
  round(sqrt(sum((y - p * n) * (y - p * n)) * count(*) / nullif(count(*) - 1, 0)) / sum(n), 6) AS std_error
FROM (SELECT *, sum(y) OVER w / sum(n) OVER w AS p FROM (SELECT agent_id, lower(repo) AS repo, count(*) AS n, count(*) FILTER (reverted) AS y FROM obsd GROUP BY 1, 2) WINDOW w AS (PARTITION BY agent_id)) GROUP BY agent_id""",
    ),
    "revert_survival": _with(
        "outcomes",
        f"""SELECT agent_id, age_days, CAST(at_risk AS BIGINT) AS at_risk, reverted, survival FROM (
  SELECT agent_id, age_days, at_risk, reverted,
    round(CASE WHEN min(1 - reverted / at_risk) OVER w <= 0 THEN 0.0 ELSE exp(sum(CASE WHEN reverted < at_risk THEN ln(1 - reverted / at_risk) ELSE 0 END) OVER w) END, 6) AS survival
  FROM (SELECT *, sum(gone) OVER (PARTITION BY agent_id ORDER BY age_days DESC) AS at_risk FROM (
    SELECT agent_id, CAST(greatest(date_diff('day', CAST(seen AS DATE), CAST(coalesce(reverted_at, {CUTOFF}) AS DATE)), 0) AS INT) AS age_days, count(reverted_at) AS reverted, count(*) AS gone FROM outc WHERE seen <= {CUTOFF} GROUP BY 1, 2))
  WINDOW w AS (PARTITION BY agent_id ORDER BY age_days)) WHERE reverted > 0""",
    ),
    "pr_acceptance": _with(
        "prs",
        """SELECT agent_id, count(*) FILTER (state = 'MERGED') AS merged, count(*) FILTER (state = 'CLOSED') AS closed, count(*) FILTER (state = 'OPEN') AS open,
  round(count(*) FILTER (state = 'MERGED') / nullif(count(*) FILTER (state <> 'OPEN'), 0), 6) AS acceptance FROM prs GROUP BY 1""",
    ),
    "time_to_merge": _with(
        "prs",
        "SELECT agent_id, count(*) AS merged, round(median(date_diff('second', created_at, merged_at)) / 3600, 6) AS median_hours FROM prs WHERE merged_at IS NOT NULL GROUP BY 1",
    ),
    "review_burden": _with(
        "prs",
        """SELECT agent_id, measure, count(*) AS pulls, CAST(median(value) AS DOUBLE) AS median FROM (
  SELECT agent_id, 'review_count' AS measure, review_count AS value FROM prs UNION ALL SELECT agent_id, 'comment_count', comment_count FROM prs
  UNION ALL SELECT agent_id, 'review_thread_count', review_thread_count FROM prs UNION ALL SELECT agent_id, 'load', review_count + comment_count + review_thread_count FROM prs) GROUP BY 1, 2""",
    ),
    "followup_fix_rate": _with(
        "dedup",
        """SELECT agent_id, count(*) AS commits, count(*) FILTER (hit) AS followed, round(count(*) FILTER (hit) / count(*), 6) AS followup_fix_rate FROM (
  SELECT d.rid, d.agent_id, bool_or(EXISTS (SELECT 1 FROM fx WHERE fx.repo_key = d.repo_key AND fx.path = f.path AND fx.pushed_at > f.pushed_at AND fx.pushed_at <= f.pushed_at + INTERVAL 14 DAY)) AS hit
  FROM ded d JOIN valid f ON lower(f.repo) = d.repo_key AND f.sha = d.sha GROUP BY d.rid, d.agent_id) GROUP BY 1""",
    ).replace(
        "\nSELECT agent_id, count(*) AS commits",
        ",\nfx AS (SELECT lower(v.repo) AS repo_key, v.path, v.pushed_at FROM valid v JOIN chg USING (rid) WHERE is_fix)\nSELECT agent_id, count(*) AS commits",
        1,
    ),
    "outcomes_with_baseline": _with("outcomes", _baseline("agent_id IS NULL")),
    "outcomes_with_period_baseline": _with("outcomes", _baseline("agent_id IS NULL", cell=_in_month("seen"))),
    "outcomes_with_unflagged_baseline": _with(
        "outcomes flags",
        _baseline("agent_id IS NULL AND (repo_key, sha) NOT IN (SELECT (lower(v.repo), v.sha) FROM valid v JOIN flags USING (rid) WHERE " + _ANY + ")"),
    ),
    "pr_outcomes_with_baseline": _with(
        "prs",
        _baseline("agent_id IS NULL", "(SELECT * FROM prs WHERE state <> 'OPEN')", _in_month("created_at"), "state = 'MERGED'"),
    ),
    "time_to_merge_with_baseline": _with(
        "prs", _median_baseline("date_diff('second', created_at, merged_at)", "merged_at IS NOT NULL")
    ),
    "review_load_with_baseline": _with(
        "prs", _median_baseline("review_count + comment_count + review_thread_count", "true")
    ),
    "rollup_outcomes": _with(
        "dims",
        """SELECT agent, language, size, week, CAST(grouping(agent, language, size, week) AS INT) AS level, count(*) AS units, count(*) FILTER (reverted) AS hits,
  round(count(*) FILTER (reverted) / count(*), 6) AS rate FROM dims GROUP BY ROLLUP (agent, language, size, week)""",
    ),
    "cube_outcomes": _with(
        "dims",
        """SELECT agent, language, size, CAST(grouping(agent, language, size) AS INT) AS level, count(*) AS units, count(*) FILTER (reverted) AS hits,
  round(count(*) FILTER (reverted) / count(*), 6) AS rate FROM dims GROUP BY CUBE (agent, language, size)""",
    ),
    "attrition": _with(
        "history",
        "SELECT fetched_on, cohort, count(*) AS members, count(*) FILTER (gone) AS gone, round(count(*) FILTER (gone) / count(*), 6) AS attrition FROM hist GROUP BY 1, 2",
    ),
    "first_loss": _with(
        "history",
        "SELECT repo, cohort, min(fetched_on) FILTER (gone) AS first_lost_on, max(fetched_on) FILTER (NOT gone) AS last_found_on FROM hist GROUP BY 1, 2 HAVING bool_or(gone)",
    ),
    "adoption": _with(
        "activity",
        """SELECT cohort, count(*) AS repos, CAST(sum(n) AS BIGINT) AS commits, CAST(sum(a) AS BIGINT) AS attributed, round(sum(a) / sum(n), 6) AS attributed_share,
  round(count(*) FILTER (a > 0) / count(*), 6) AS adopting_share, round(count(*) FILTER (a > 0) * CASE cohort WHEN 'treated' THEN 2.0 ELSE 4.0 END, 3)::DOUBLE AS adopting_estimate
FROM (SELECT cohort, repo, count(*) AS n, count(agent_id) AS a FROM crow GROUP BY 1, 2) GROUP BY cohort""",
    ),
    "coverage_by_agent": _with(
        "evidence",
        """SELECT agent_id, CAST(count(*) AS BIGINT) AS commits, count(DISTINCT lower(repo)) AS repos, round(count(*) / (SELECT count(*) FROM commits), 6) AS share FROM commits LEFT JOIN verdict USING (rid) GROUP BY 1""",
    ),
    "sources_unioned": _with(
        "census activity",
        """SELECT 'census' AS source, CAST(NULL AS INT) AS panel_version, 1 AS registry_version, agent_id, count(*) AS commits FROM obs GROUP BY agent_id
UNION ALL SELECT 'panel', 1, 1, agent_id, count(*) FROM crow GROUP BY agent_id""",
    ),
    "compare_versions": _with(
        "valid evidence evidence2",
        """SELECT CASE WHEN a.agent_id IS NOT DISTINCT FROM b.agent_id THEN 'same' WHEN a.agent_id IS NULL THEN 'gained' WHEN b.agent_id IS NULL THEN 'lost' ELSE 'changed' END AS change,
  a.agent_id AS old_agent, b.agent_id AS new_agent, count(*) AS commits
FROM (SELECT v.rid, x.agent_id, row_number() OVER (PARTITION BY lower(v.repo), v.sha ORDER BY v.pushed_at, v.event_id, x.agent_id NULLS FIRST, y.agent_id NULLS FIRST) AS k
  FROM valid v LEFT JOIN verdict x USING (rid) LEFT JOIN verdict2 y USING (rid)) a LEFT JOIN verdict2 b USING (rid) WHERE k = 1 GROUP BY 1, 2, 3""",
    ),
    "link_commits_to_pulls": _with(
        "links pulls",
        """SELECT c.repo_key, c.sha, coalesce(m.number, n.number) AS pull_number, CASE WHEN m.number IS NOT NULL THEN 'merge_commit' ELSE 'number' END AS linked_by
FROM ded c LEFT JOIN pulls m ON lower(m.repo) = c.repo_key AND m.merge_commit_sha = c.sha
LEFT JOIN pulls n ON lower(n.repo) = c.repo_key AND n.number = c.pr WHERE coalesce(m.number, n.number) IS NOT NULL""",
    ),
    "stream_attribution": _with(
        "dedup",
        "SELECT agent_id, count(*) AS commits, count(DISTINCT repo_key) AS repos, round(count(*) / (SELECT count(*) FROM ded), 6) AS share FROM ded GROUP BY 1",
    ),
    "stream_daily_counts": _with(
        "valid evidence", "SELECT day, agent_id, count(*) AS commits FROM valid LEFT JOIN verdict USING (rid) GROUP BY 1, 2"
    ),
    "stream_revert_links": _with(
        "valid reverts",
        """SELECT repo_key, sha, committed_at, revert_sha, reverted_at FROM (
  SELECT lower(c.repo) AS repo_key, c.sha, c.pushed_at AS committed_at, r.sha AS revert_sha, r.pushed_at AS reverted_at,
    row_number() OVER (PARTITION BY lower(c.repo), c.sha ORDER BY r.pushed_at, r.sha, c.pushed_at) AS k
  FROM valid c JOIN (SELECT v.*, rev.reverted_sha FROM valid v JOIN rev USING (rid) WHERE NOT is_reapply AND reverted_sha IS NOT NULL) r
  ON lower(c.repo) = lower(r.repo) AND starts_with(c.sha, r.reverted_sha) AND r.pushed_at BETWEEN c.pushed_at AND c.pushed_at + INTERVAL 30 DAY WHERE c.sha <> r.sha) WHERE k = 1""",
    ),
    "snapshots_as_of": _with(
        "dedup dims",
        """SELECT d.repo_key, language, count(*) AS commits, CAST(sum(stargazers) AS BIGINT) AS stars
FROM ded d ASOF LEFT JOIN states s ON d.repo_key = s.repo_key AND d.seen >= s.fetched_on GROUP BY 1, 2""",
    ),
    "canonical_repos": _with("lineage", "SELECT name, valid_from, valid_to, repo_key, repo_id FROM lineage WHERE needed"),
    "revert_links_renamed": _with(
        "links",
        "SELECT * REPLACE (CASE WHEN CAST(regexp_extract(repo_key, '/repo(\\d+)$', 1) AS BIGINT) % 4 = 0 THEN '#' || regexp_extract(repo_key, '/repo(\\d+)$', 1) ELSE repo_key END AS repo_key) FROM links",
    ),
    "latest_pulls_renamed": _with(
        "pulls",
        """SELECT CASE WHEN number % 4 = 0 THEN '#' || CAST(number % 240 AS VARCHAR) ELSE lower(repo) END AS repo_key,
  CASE WHEN number % 3 <> 0 THEN DATE '2026-03-01' ELSE DATE '2022-03-01' END AS fetched_on, CASE WHEN number % 3 <> 0 THEN state ELSE 'OPEN' END AS state, count(*) AS pulls FROM pulls GROUP BY 1, 2, 3""",
    ),
    "first_loss_renamed": _with(
        "lineage",
        """SELECT repo_key, 'treated' AS cohort, min(fetched_on) FILTER (gone) AS first_lost_on, max(fetched_on) FILTER (NOT gone) AS last_found_on FROM (
  SELECT coalesce(l.repo_key, f.repo) AS repo_key, f.fetched_on, f.gone FROM (
    SELECT lower(asked) AS repo, seen_on AS fetched_on, false AS gone FROM sight WHERE lower(asked) = lower(reported)
    UNION ALL SELECT lower(asked), DATE '2026-02-02', true FROM sight WHERE seen_on = DATE '2026-01-26') f
  LEFT JOIN (SELECT * FROM lineage WHERE needed) l ON l.name = f.repo AND (l.valid_from IS NULL OR f.fetched_on >= l.valid_from) AND (l.valid_to IS NULL OR f.fetched_on < l.valid_to))
GROUP BY 1 HAVING bool_or(gone)""",
    ),
    "panel_acceptance_weighted": _with(
        "activity members_drawn", _weighted("(SELECT * FROM prow WHERE state <> 'OPEN')", "state = 'MERGED'")
    ),
    "panel_adoption_weighted": _with(
        "activity members_drawn", _weighted("(SELECT repo, count(agent_id) AS a FROM crow GROUP BY repo)", "a > 0", "")
    ),
    "panel_revert_rate_weighted": _with("panel_outcomes members_drawn", _weighted("p_obsd", "reverted")),
    "panel_time_to_merge": _with(
        "activity", _median_bounds("prow WHERE merged_at IS NOT NULL", "date_diff('second', created_at, merged_at)")
    ),
    "panel_review_load": _with("activity", _median_bounds("prow", "review_count + comment_count + review_thread_count")),
    "revert_logrank": _with(
        "outcomes",
        f""",
g AS (SELECT repo_key, agent_id, reverted_at, greatest(date_diff('day', CAST(seen AS DATE), CAST(coalesce(reverted_at, {CUTOFF}) AS DATE)), 0) AS age FROM outc WHERE seen <= {CUTOFF}),
cells AS (SELECT DISTINCT agent_id, repo_key FROM g WHERE agent_id IS NOT NULL AND repo_key IN (SELECT repo_key FROM g WHERE agent_id IS NULL)),
r AS (SELECT c.agent_id AS a, g.repo_key, g.age, g.agent_id IS NOT NULL AS own, g.reverted_at FROM cells c JOIN g ON g.repo_key = c.repo_key AND (g.agent_id IS NULL OR g.agent_id = c.agent_id)),
t AS (SELECT a, repo_key, age, count(reverted_at) AS d, count(reverted_at) FILTER (own) AS d1, count(*) AS l, count(*) FILTER (own) AS l1 FROM r GROUP BY 1, 2, 3),
u AS (SELECT *, sum(l) OVER w AS n, sum(l1) OVER w AS n1 FROM t WINDOW w AS (PARTITION BY a, repo_key ORDER BY age DESC)),
z AS (SELECT a, count(DISTINCT repo_key) AS repos, sum(l1) AS commits, sum(d1) AS reverted, sum(d * n1 / n) AS e,
  sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END) AS v FROM u GROUP BY 1)
SELECT a AS agent_id, repos, CAST(commits AS BIGINT) AS commits, CAST(reverted AS BIGINT) AS reverted, round(e, 4) AS expected, round(v, 4) AS variance,
  round(CASE WHEN v > 0 THEN (reverted - e) * (reverted - e) / v END, 4) AS statistic FROM z""",
    ),
    "compare_stored_runs": _with(
        "census2",
        """,
o1 AS (SELECT * FROM (SELECT lower(repo) AS repo_key, sha, agent_id, row_number() OVER (PARTITION BY lower(repo), sha ORDER BY pushed_at, event_id, agent_id NULLS FIRST, repo) AS k FROM obs) WHERE k = 1),
o2 AS (SELECT * FROM (SELECT lower(repo) AS repo_key, sha, agent_id, row_number() OVER (PARTITION BY lower(repo), sha ORDER BY pushed_at, event_id, agent_id NULLS FIRST, repo) AS k FROM obs2) WHERE k = 1)
SELECT CASE WHEN a.agent_id IS NOT DISTINCT FROM b.agent_id THEN 'same' WHEN a.agent_id IS NULL THEN 'gained' WHEN b.agent_id IS NULL THEN 'lost' ELSE 'changed' END AS change,
  a.agent_id AS old_agent, b.agent_id AS new_agent, a.k IS NOT NULL AS in_old, b.k IS NOT NULL AS in_new, count(*) AS commits
FROM o1 a FULL JOIN o2 b ON a.repo_key = b.repo_key AND a.sha = b.sha GROUP BY 1, 2, 3, 4, 5""",
    ),
    "stored_versions": _with(
        "census2",
        """SELECT 1 AS registry_version, 'census-spark-1' AS methodology_version, count(*) AS commits, count(agent_id) AS attributed FROM obs
UNION ALL SELECT 2, 'census-spark-1', count(*), count(agent_id) FROM obs2""",
    ),
    "census_time_range": _with(
        "census",
        "SELECT pushed_at, event_id, sha, repo, agent_id FROM obs WHERE pushed_at BETWEEN TIMESTAMP '2021-03-01 06:00:00' AND TIMESTAMP '2021-06-30 18:00:00'",
    ),
    "archive_scan": _with(
        "commits",
        """SELECT CAST(date_trunc('month', day) AS DATE) AS day, count(*) AS pushes FROM commits
WHERE push_size % 10 <> 7 AND date_trunc('month', day) BETWEEN DATE '2011-02-12' AND DATE '2025-10-06' GROUP BY 1""",
    ),
    "scan_budget": _with("commits", "SELECT DISTINCT CAST(date_trunc('year', day) AS DATE) AS day, true AS ample, false AS none FROM commits"),
    "distinct_repos_weekly": _with(
        "valid evidence",
        "SELECT CAST(date_trunc('week', day) AS DATE) AS week, agent_id, count(*) AS commits, count(DISTINCT lower(repo)) AS repos FROM valid LEFT JOIN verdict USING (rid) GROUP BY 1, 2",
    ),
    "stream_census_observations": _with("census_all", "SELECT * FROM p_obs"),
    "stream_standing_reverts": _with(
        "valid reverts",
        f""",
every AS (
  SELECT lower(v.repo) AS repo_key, v.sha, v.pushed_at AS t, CAST(nullif(regexp_extract({_SUBJ}, '\\(#(\\d+)\\)$', 1), '') AS BIGINT) AS pr,
    r.rid IS NOT NULL AS is_undo, r.is_reapply, r.reverted_sha AS target, r.original_pr_number AS target_pr FROM valid v LEFT JOIN rev r USING (rid)),
named AS (
  SELECT c.repo_key, c.sha, c.t AS committed_at, u.sha AS undo_sha, u.t AS undone_at, u.is_reapply, u.target FROM every c JOIN every u
  ON u.repo_key = c.repo_key AND starts_with(c.sha, u.target) AND u.t BETWEEN c.t AND c.t + INTERVAL 30 DAY WHERE u.is_undo AND c.sha <> u.sha),
clear AS (SELECT repo_key, target FROM named GROUP BY 1, 2 HAVING count(DISTINCT sha) = 1),
resolved AS (SELECT * FROM named JOIN clear USING (repo_key, target)),
numbered AS (
  SELECT c.repo_key, c.sha, c.t AS committed_at, u.sha AS undo_sha, u.t AS undone_at, u.is_reapply FROM every c JOIN every u
  ON u.repo_key = c.repo_key AND c.pr = u.target_pr AND u.t BETWEEN c.t AND c.t + INTERVAL 30 DAY WHERE u.is_undo AND c.sha <> u.sha),
undone AS (SELECT repo_key, sha, max(undone_at) AS taken_back_at FROM resolved GROUP BY 1, 2),
either AS (SELECT repo_key, sha, committed_at, undo_sha, undone_at, is_reapply, 0 AS w FROM resolved UNION ALL SELECT *, 1 FROM numbered)
SELECT repo_key, sha, committed_at, revert_sha, reverted_at, CASE w WHEN 0 THEN 'sha' ELSE 'pr' END AS linked_by FROM (
  SELECT e.repo_key, e.sha, e.committed_at, e.undo_sha AS revert_sha, e.undone_at AS reverted_at, e.w,
    row_number() OVER (PARTITION BY e.repo_key, e.sha ORDER BY e.undone_at, e.undo_sha, e.w, e.committed_at) AS k
  FROM either e LEFT JOIN undone d ON d.repo_key = e.repo_key AND d.sha = e.undo_sha
  WHERE NOT e.is_reapply AND (d.taken_back_at IS NULL OR d.taken_back_at < e.undone_at)) WHERE k = 1""",
    ),
    "evidence_conjunctive": _with(
        "evidence3",
        "SELECT repo, sha, event_id, rank, agent_id, signal_id, signal_type, confidence, matched FROM commits JOIN evid3 USING (rid)",
    ),
    "prefilter_audit_conjunctive": _with(
        "flags evidence3",
        f"SELECT agent_id, signal_id, count(*) AS attributed, count(*) FILTER (NOT {_ANY}) AS missed FROM flags JOIN evid3 USING (rid) WHERE rank = 0 AND confidence <> 'low' GROUP BY 1, 2",
    ),
    "validate_requirements": """WITH RECURSIVE r AS (
  SELECT 'agent-' || CAST(p_partkey // 3 AS VARCHAR) AS agent_id, 's' || CAST(p_partkey % 3 AS VARCHAR) AS signal_id,
    CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 17 = 4 THEN ['gone'] WHEN p_partkey % 3 < 2 THEN ['s' || CAST(p_partkey % 3 + 1 AS VARCHAR)]
      WHEN p_partkey // 3 % 4 = 1 THEN ['s0', 's1'] END AS needs FROM part),
e AS (SELECT DISTINCT agent_id, signal_id, UNNEST(needs) AS needs FROM r),
reach AS (SELECT agent_id, signal_id AS a, needs AS b FROM e UNION SELECT x.agent_id, x.a, e.needs FROM reach x JOIN e ON e.agent_id = x.agent_id AND e.signal_id = x.b),
loops AS (SELECT agent_id, a FROM reach WHERE a = b)
SELECT 1 AS registry_version, agent_id, signal_id, 'requires an unknown signal' AS problem FROM e
  WHERE (agent_id, needs) NOT IN (SELECT (agent_id, signal_id) FROM r)
UNION SELECT 1, x.agent_id, x.a, 'requires itself in a circle' FROM reach x JOIN loops l ON l.agent_id = x.agent_id AND (l.a = x.b OR l.a = x.a)""",
}
