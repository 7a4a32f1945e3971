"""Commits, pull requests, push events and API responses derived from the given tables.

The tables hold no commits, so each row of ``lineitem`` stands for one pushed commit and each
row of ``orders`` for one pull request (and one landed API response). The derivations are
plain projections: no shuffle, the same text in Spark and in DuckDB, and work that grows
with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.functions.text import let
from aftermerge.operators.barrier import with_struct

# Dialect differences, filled into the shared expressions.
SPARK = {"SHA": "sha2(%s, 256)", "TS": "TIMESTAMP_NTZ", "STR": "STRING", "DIV": "div"}
DUCK = {"SHA": "sha256(%s)", "TS": "TIMESTAMP", "STR": "VARCHAR", "DIV": "//"}

LF, CR = "chr(10)", "chr(13)"
PARA = f"{LF} || {LF}"


def _dialect(text: str, d: dict[str, str]) -> str:
    out = text.replace("{TS}", d["TS"]).replace("{STR}", d["STR"]).replace("{DIV}", d["DIV"])
    while "{SHA:" in out:
        start = out.index("{SHA:")
        end = out.index("}", start)
        out = out[:start] + d["SHA"] % out[start + 5 : end] + out[end + 1 :]
    return out


def _s(expr: str) -> str:
    return f"CAST({expr} AS {{STR}})"


_KEYS = {
    "ok": "l_orderkey",
    "ln": "CAST(l_linenumber AS BIGINT)",
    "pk": "l_partkey",
    "sk": "l_suppkey",
    "q": "CAST(floor(l_quantity) AS BIGINT)",
}

_SHA = f"substr({{SHA:{_s('ok')} || ':' || {_s('ln')}}}, 1, 40)"
_PREV = f"{{SHA:{_s('ok')} || ':' || {_s('ln - 1')}}}"
_HERON = "'Co-Authored-By: Heron <bot@heron.example>'"

MESSAGE = f"""CASE pk % 16
  WHEN 0 THEN 'Add retry' || {PARA} || {_HERON}
  WHEN 1 THEN 'Add retry' || {PARA} || 'Body.' || {PARA} || 'co-authored-by: Heron Model 3 <x@else.example>'
  WHEN 2 THEN 'Fold' || {PARA} || 'Co-Authored-By: Heron' || {LF} || '  <bot@heron.example>'
  WHEN 3 THEN 'Prose' || {PARA} || {_HERON} || {LF} || 'and more prose follows.'
  WHEN 4 THEN 'Crlf' || {CR} || {PARA.replace('||', f'|| {CR} ||')} || {_HERON} || {CR} || {LF}
  WHEN 5 THEN 'Revert "Ship feature (#' || {_s('ok')} || ')" (#' || {_s('ok + 1')} || ')' || {PARA}
       || 'This reverts commit ' || substr({_PREV}, 1, CASE WHEN ln % 2 = 0 THEN 40 ELSE 9 END) || '.'
  WHEN 6 THEN 'Reapply "Ship feature"' || {PARA} || 'This reverts commit ' || upper(substr({_PREV}, 1, 40)) || '.'
  WHEN 7 THEN 'Hint' || {PARA} || 'This was Generated With Heron.'
  WHEN 9 THEN 'Ship feature (#' || {_s('ok')} || ')'
  WHEN 10 THEN 'Fix crash in part ' || {_s('pk')}
  WHEN 12 THEN 'Port' || {PARA} || 'generated with heron' || {PARA} || 'Signed-off-by: Dev ' || {_s('sk')}
       || ' <dev@example.com>' || {LF} || '(cherry picked from commit ' || substr({_PREV}, 1, 12) || ')' || {LF} || {_HERON} || ' ' || {LF}
  WHEN 13 THEN 'Revert "Rename "a" to "b""' || {PARA} || 'Reverts org/repo#' || {_s('ok')} || {LF}
  WHEN 14 THEN 'Lone' || {CR} || {CR} || {_HERON}
  WHEN 15 THEN '  Plan ' || {PARA} || 'Notes: first' || {LF} || '  second' || {LF} || 'Task-Link: https://kestrel.example/tasks/' || {_s('ok')}
  ELSE 'Tidy imports ' || {_s('pk')} END"""

COMMITS = {
    "event_id": f"{_s('ok')} || '-' || {_s('q')}",
    "repo": f"CASE WHEN sk % 50 = 3 THEN 'no owner/' ELSE CASE WHEN ok % 7 = 0 THEN 'Org' ELSE 'org' END || {_s('ok % 60')} || '/' END || 'repo' || {_s('ok % 240')}",
    "pusher_login": f"CASE WHEN sk % 40 = 0 THEN 'kestrel-app[bot]' WHEN sk % 40 = 1 THEN 'dodo' WHEN sk % 40 = 2 THEN 'renovate[bot]' WHEN sk % 40 = 4 THEN CAST(NULL AS {{STR}}) ELSE 'User' || {_s('ok % 500')} END",
    "pushed_at": "CAST('2019-03-01 00:00:00' AS {TS}) + INTERVAL '1' DAY * (ok % 2400 + q) + INTERVAL '1' SECOND * (pk * 37 % 86400)",
    "push_size": "1 + ok % 30",
    "sha": f"CASE WHEN pk % 16 = 8 THEN 'not-a-sha' ELSE CASE WHEN sk % 9 = 0 THEN upper({_SHA}) ELSE {_SHA} END END",
    "message": MESSAGE,
    "author_name": f"CASE WHEN sk % 45 = 5 THEN 'Dev (kestrel)' ELSE ' Dev ' || {_s('ok % 700')} END",
    "author_email": f"CASE WHEN sk % 45 = 6 THEN 'dev@kestrel.example' WHEN sk % 45 = 7 THEN 'dev@KESTREL.example' WHEN sk % 45 = 8 THEN '' ELSE 'Dev' || {_s('ok % 700')} || '@example.com' END",
    "is_distinct": "(ln % 5) <> 0",
    # Not part of a commit row; used for the file-level job.
    "path": f"'src/f' || {_s('pk % 50')}",
}
COMMIT_COLUMNS = [c for c in COMMITS if c != "path"]


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _select(exprs: dict[str, str], d: dict[str, str]) -> list[str]:
    return [f"{_dialect(expr, d)} AS {name}" for name, expr in exprs.items()]


def commits_from_lines(lineitem: DataFrame, *, with_path: bool = False) -> DataFrame:
    """One commit per line; works on static and streaming frames alike."""
    columns = [*COMMIT_COLUMNS, *(["path"] if with_path else [])]
    keys = lineitem.selectExpr(*_select(_KEYS, SPARK))
    if not lineitem.isStreaming:
        keys = wide_enough(lineitem.sparkSession, keys)
    derived = _derive(keys, COMMITS)
    return derived.select(F.col("pushed_at").cast("date").alias("day"), *columns)


def with_push_time(lineitem: DataFrame) -> DataFrame:
    """The lines with the ``pushed_at`` of their commits, without the rest of these."""
    keys = lineitem.selectExpr("*", *_select(_KEYS, SPARK))
    return keys.selectExpr(*lineitem.columns, *_select({"pushed_at": COMMITS["pushed_at"]}, SPARK))


def _derive(keys: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Add derived columns once per row, apart from the code of the operators downstream.

    The generator keeps later filters from repeating them; the lambda beside them keeps these long
    CASE expressions out of the fused stage code, which the JVM would otherwise find too large to
    compile. They lie outside its body, which would be evaluated expression by expression.
    """
    fields = ", ".join(_select(exprs, SPARK))
    return with_struct(keys, F.expr(f"struct({fields}, {let('ok', '_k', '_k')} AS _apart)"), [*exprs, "_apart"])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(spark: SparkSession) -> int:
    """Partitions that scans are dealt into: the option ``aftermerge.workload.spread``, 0 if unset.

    The small test tables are one row group, i.e. one task. ``bench.py`` sets the option to its
    cores; elsewhere a scan is split by its files, whatever its size.
    """
    return int(spark.conf.get("aftermerge.workload.spread", "0"))


def wide_enough(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """``scan``, dealt out evenly if the option of :func:`spread` says so."""
    return scan.repartition(spread(spark)) if spread(spark) else scan


def commits(spark: SparkSession, sf: str) -> DataFrame:
    """Pushed commits as the scan would list them, malformed ones included."""
    return commits_from_lines(table(spark, sf, "lineitem"))


def commit_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same commits with the one file each touched."""
    return commits_from_lines(table(spark, sf, "lineitem"), with_path=True)


def duck_commits() -> str:
    """The commits view as a DuckDB CTE named ``commits`` (plus ``path``)."""
    keys = ", ".join(_select(_KEYS, DUCK))
    cols = ", ".join(_select(COMMITS, DUCK))
    return (
        f"base_c AS (SELECT {keys} FROM lineitem),\n"
        f"flat_c AS (SELECT {cols} FROM base_c),\n"
        "commits AS MATERIALIZED (SELECT CAST(pushed_at AS DATE) AS day, *, row_number() OVER () AS rid FROM flat_c)"
    )


# --- pull requests ----------------------------------------------------------------------

PULLS = {
    "repo": f"'org' || {_s('ok % 60')} || '/repo' || {_s('ok % 240')}",
    "number": "ok",
    "title": "CASE WHEN ok % 11 = 3 THEN 'Revert \"Ship feature\"' ELSE 'Ship feature' END",
    "body": f"CASE WHEN ok % 9 = 0 THEN 'See https://kestrel.example/tasks/' || {_s('ok')} ELSE '' END",
    "state": "CASE st WHEN 'F' THEN 'MERGED' WHEN 'P' THEN 'CLOSED' ELSE 'OPEN' END",
    "created_at": "opened",
    "merged_at": "CASE WHEN st = 'F' THEN opened + INTERVAL '1' MINUTE * (ck * 61 % 20000) END",
    "updated_at": "opened + INTERVAL '1' HOUR * (ck % 200)",
    "author_login": f"CASE WHEN ck % 20 = 0 THEN 'kestrel-app[bot]' ELSE 'user' || {_s('ck')} END",
    "author_is_bot": "ck % 20 = 0",
    "review_count": "CAST(ok % 6 AS INT)",
    "comment_count": "CAST(ck % 9 AS INT)",
    "review_thread_count": "CAST((ok + ck) % 4 AS INT)",
    "merge_commit_sha": f"CASE WHEN st = 'F' THEN substr({{SHA:{_s('ok')} || ':1'}}, 1, 40) END",
}
_ORDER_KEYS = {
    "ok": "o_orderkey",
    "ck": "o_custkey",
    "st": "o_orderstatus",
    "opened": "o_orderdate + INTERVAL '1' DAY * 9000",
    "price": "CAST(floor(o_totalprice) AS BIGINT)",
}


def pulls(spark: SparkSession, sf: str) -> DataFrame:
    """One pull request per order."""
    orders = table(spark, sf, "orders").selectExpr(*_select(_ORDER_KEYS, SPARK))
    return _derive(wide_enough(spark, orders), PULLS).select(*PULLS)


def duck_pulls() -> str:
    """The pulls view as a DuckDB CTE named ``pulls``."""
    keys = ", ".join(_select(_ORDER_KEYS, DUCK))
    cols = ", ".join(_select(PULLS, DUCK))
    return f"base_o AS (SELECT {keys} FROM orders),\npulls AS (SELECT {cols} FROM base_o)"


# --- push events ------------------------------------------------------------------------


def push_events(spark: SparkSession, sf: str) -> DataFrame:
    """Raw events, one per line: its commit, plus what a scan must survive.

    Every third event lists a second commit without a SHA, some list nothing or something
    that is no list, some sizes are no numbers, and some events are not pushes.
    """
    rows = commits(spark, sf)
    author = F.struct(F.col("author_name").alias("name"), F.col("author_email").alias("email"))
    listed = F.struct("sha", "message", F.col("is_distinct").alias("distinct"), author.alias("author"))
    nameless = F.struct(
        F.lit(None).cast("string").alias("sha"),
        "message",
        F.lit(None).cast("boolean").alias("distinct"),
        author.alias("author"),
    )
    kind = F.pmod(F.col("push_size"), F.lit(10))
    body: Column = F.to_json(
        F.struct(
            F.col("push_size").alias("size"),
            F.when(kind == 3, F.array(listed, nameless)).otherwise(F.array(listed)).alias("commits"),
        )
    )
    payload = (
        F.when(kind == 4, F.lit('{"size": 2, "commits": "none"}'))
        .when(kind == 5, F.lit('{"ref": "refs/heads/main"}'))
        .when(kind == 6, F.replace(body, F.lit('{"size":'), F.lit('{"size":"many","true_size":')))
        .otherwise(body)
    )
    return rows.select(
        F.col("event_id").alias("id"),
        F.when(kind == 7, "WatchEvent").otherwise("PushEvent").alias("type"),
        F.struct(F.col("repo").alias("name")).alias("repo"),
        F.struct(F.col("pusher_login").alias("login")).alias("actor"),
        F.col("pushed_at").alias("created_at"),
        payload.alias("payload"),
        "day",
    )


# --- landed API responses ---------------------------------------------------------------
# Each order is one batch request for two repositories; every fifth adds a history page.

API_REPO = f"'org' || {_s('ok % 60')} || '/app' || {_s('ok')}"
API_OTHER = f"'away/gone' || {_s('ok')}"
API_COMMIT = {
    "oid": f"CASE WHEN i = 2 AND ok % 4 = 1 THEN 'short' ELSE substr({{SHA:'api:' || {_s('ok')} || ':' || {_s('i')}}}, 1, 40) END",
    "minutes": "i * 7 + ok % 1000",
    "message": f"""CASE (ok + i) % 5 WHEN 0 THEN 'Add retry' || {PARA} || {_HERON}
        WHEN 1 THEN 'Revert "Add retry (#' || {_s('ok')} || ')"' || {PARA} || 'This reverts commit ' || substr({{SHA:'api:' || {_s('ok')} || ':1'}}, 1, 10) || '.'
        ELSE 'Tidy ' || {_s('i')} END""",
    "login": f"CASE (ok + i) % 7 WHEN 0 THEN 'kestrel-app[bot]' WHEN 1 THEN CAST(NULL AS {{STR}}) ELSE 'User' || {_s('ck')} END",
    "bot": "(ok + i) % 13 = 0",
    "pr": "CASE WHEN (ok + i) % 3 = 0 THEN ok * 10 + i END",
}
API_PULL = {
    "number": "ok * 10 + i",
    "title": "CASE WHEN (ok + i) % 6 = 0 THEN 'Revert \"Add thing (#12)\"' ELSE 'Add thing' END",
    "body": f"CASE WHEN (ok + i) % 4 = 0 THEN 'Task https://kestrel.example/tasks/' || {_s('ok')} END",
    "state": "CASE (ok + i) % 3 WHEN 0 THEN 'MERGED' WHEN 1 THEN 'CLOSED' ELSE 'OPEN' END",
    "login": f"CASE WHEN (ok + i) % 8 = 0 THEN CAST(NULL AS {{STR}}) ELSE 'user' || {_s('ck')} END",
    "hours": "i * 5 + ck % 100",
    "updated_days": "(ok * 7 + i * 31) % 60",
    "additions": "CASE WHEN ok % 10 = 0 THEN NULL ELSE price % 500 END",
    "reviews": "CASE WHEN ok % 10 = 1 THEN NULL ELSE (ok + i) % 5 END",
    "comments": "(ck + i) % 7",
}
API_SINCE_DAY = 30
"""Pull requests updated fewer than this many days after opening fall before the watermark."""

API_STATUS = {0: "not_found", 1: "error", 2: "empty"}
"""What becomes of an order's first repository by ``ok % 12``; otherwise it is ``ok``."""


def _iso(expr: str) -> str:
    return f"date_format({expr}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


# All responses share one opening date so the watermark splits them the same way at any scale.
API_EPOCH = "CAST('2026-01-01 00:00:00' AS {TS})"


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Landed response bodies, built by string functions only (no grouping)."""
    c = {k: _dialect(v, SPARK) for k, v in API_COMMIT.items()}
    p = {k: _dialect(v, SPARK) for k, v in API_PULL.items()}
    epoch = _dialect(API_EPOCH, SPARK)
    commit = f"""named_struct('oid', {c['oid']},
        'committedDate', {_iso(f"{epoch} + INTERVAL '1' MINUTE * ({c['minutes']})")},
        'messageHeadline', substring_index({c['message']}, chr(10), 1), 'message', {c['message']},
        'author', named_struct('name', 'Dev', 'email', concat('dev', ck, '@example.com'),
            'user', if(({c['login']}) IS NULL, NULL, named_struct('login', {c['login']}, '__typename', if({c['bot']}, 'Bot', 'User')))),
        'associatedPullRequests', named_struct('nodes', if(({c['pr']}) IS NULL, array(), array(named_struct('number', {c['pr']})))))"""
    pull = f"""named_struct('number', {p['number']}, 'title', {p['title']}, 'body', {p['body']}, 'state', {p['state']},
        'createdAt', {_iso(epoch)},
        'closedAt', if({p['state']} <> 'OPEN', {_iso(f"{epoch} + INTERVAL '1' HOUR * ({p['hours']})")}, NULL),
        'mergedAt', if({p['state']} = 'MERGED', {_iso(f"{epoch} + INTERVAL '1' HOUR * ({p['hours']})")}, NULL),
        'merged', {p['state']} = 'MERGED',
        'updatedAt', {_iso(f"{epoch} + INTERVAL '1' DAY * ({p['updated_days']})")},
        'author', if(({p['login']}) IS NULL, NULL, named_struct('login', {p['login']}, '__typename', if((ok + i) % 16 = 1, 'Bot', 'User'))),
        'additions', {p['additions']}, 'deletions', 2L, 'changedFiles', 1L,
        'reviews', if(({p['reviews']}) IS NULL, NULL, named_struct('totalCount', {p['reviews']})),
        'comments', named_struct('totalCount', {p['comments']}),
        'reviewThreads', named_struct('totalCount', 0L),
        'mergeCommit', if({p['state']} = 'MERGED', named_struct('oid', substr(sha2(concat('m:', {p['number']}), 256), 1, 40 - CAST(ok % 2 AS INT))), NULL))"""
    branch = f"""named_struct('name', 'main', 'target', named_struct('history', named_struct(
        'totalCount', 1 + ok % 3, 'pageInfo', named_struct('hasNextPage', ok % 5 = 0, 'endCursor', if(ok % 5 = 0, 'c1', NULL)),
        'nodes', transform(sequence(1L, 1 + ok % 3), i -> {commit}))))"""
    node = f"""to_json(named_struct('nameWithOwner', if(ok % 20 = 7, concat('moved/app', ok), {_dialect(API_REPO, SPARK)}),
        'databaseId', ok, 'isFork', ok % 6 = 0, 'stargazerCount', price % 20000,
        'primaryLanguage', if(ok % 8 = 0, NULL, named_struct('name', element_at(array('Go', 'Python', 'Rust'), CAST(1 + ok % 3 AS INT)))),
        'pullRequests', named_struct('totalCount', 1 + ok % 2, 'nodes', transform(sequence(1L, 1 + ok % 2), i -> {pull})),
        'defaultBranchRef', if(ok % 12 = 2, NULL, {branch})))"""
    page = f"""to_json(named_struct('rateLimit', named_struct('cost', 1L, 'remaining', 4000L, 'resetAt', '2026-09-05T13:00:00Z'),
        'repository', named_struct('defaultBranchRef', named_struct('target', named_struct('history', named_struct(
            'pageInfo', named_struct('hasNextPage', ok % 10 = 0, 'endCursor', if(ok % 10 = 0, 'c2', NULL)),
            'nodes', transform(sequence(1 + ok % 3, 3 + ok % 3), i -> {commit})))))))"""
    limit = "to_json(named_struct('cost', 1 + ok % 3, 'remaining', 5000 - ok % 1000, 'resetAt', '2026-09-05T13:00:00Z'))"
    orders = wide_enough(spark, table(spark, sf, "orders").selectExpr(*_select(_ORDER_KEYS, SPARK)))
    repo, other = _dialect(API_REPO, SPARK), _dialect(API_OTHER, SPARK)
    errors = """CASE ok % 12 WHEN 0 THEN ',"errors":[{"type":"NOT_FOUND","path":["r0"],"message":"gone"},{"type":"NOT_FOUND","path":["r1"]}]'
        WHEN 1 THEN ',"errors":[{"message":"timeout","path":["r0",3]},{"type":"NOT_FOUND","path":["r0"]},{"type":"NOT_FOUND","path":["r1"]}]'
        ELSE ',"errors":[{"type":"NOT_FOUND","path":["r1"]}]' END"""
    batch = orders.selectExpr(
        "concat('b', ok) AS request_id",
        f"{_dialect(API_EPOCH, SPARK)} + INTERVAL '1' SECOND * ok AS fetched_at",
        "'batch' AS kind",
        f"array({repo}, {other}) AS repos",
        "0 AS page_no",
        f"""concat('{{"data":{{"rateLimit":', {limit}, ',"r0":', if(ok % 12 < 2, 'null', {node}), ',"r1":null}}', {errors}, '}}') AS body""",
    )
    history = orders.where("ok % 5 = 0 AND ok % 12 > 2").selectExpr(
        "concat('h', ok) AS request_id",
        f"{_dialect(API_EPOCH, SPARK)} + INTERVAL '1' SECOND * ok AS fetched_at",
        "'history' AS kind",
        f"array({repo}) AS repos",
        "1 AS page_no",
        f"""concat('{{"data":', {page}, '}}') AS body""",
    )
    return batch.unionByName(history)


def duck_api() -> str:
    """Flat oracle of the responses: CTEs ``api_repos``, ``api_commits`` and ``api_pulls``."""
    keys = ", ".join(_select(_ORDER_KEYS, DUCK))
    c = ", ".join(_select({k: v for k, v in API_COMMIT.items()}, DUCK))
    p = ", ".join(_select({k: v for k, v in API_PULL.items()}, DUCK))
    repo, other = _dialect(API_REPO, DUCK), _dialect(API_OTHER, DUCK)
    return f"""base_a AS (SELECT {keys} FROM orders),
api_repos AS (
  SELECT ok, ck, price, {repo} AS repo,
    CASE ok % 12 WHEN 0 THEN 'not_found' WHEN 1 THEN 'error' WHEN 2 THEN 'empty' ELSE 'ok' END AS status,
    CASE ok % 12 WHEN 0 THEN 'NOT_FOUND' WHEN 1 THEN 'timeout' END AS error
  FROM base_a
  UNION ALL SELECT ok, ck, price, {other}, 'not_found', 'NOT_FOUND' FROM base_a),
api_commits AS (
  SELECT repo, page_no, ok, ck, {c} FROM (
    SELECT r.*, 0 AS page_no, UNNEST(generate_series(1, 1 + ok % 3)) AS i FROM api_repos r WHERE status = 'ok'
    UNION ALL
    SELECT r.*, 1, UNNEST(generate_series(2 + ok % 3, 3 + ok % 3)) FROM api_repos r WHERE status = 'ok' AND ok % 5 = 0)),
api_pulls AS (
  SELECT repo, ok, ck, i, status, {p} FROM (
    SELECT r.*, UNNEST(generate_series(1, 1 + ok % 2)) AS i FROM api_repos r WHERE status = 'ok'))"""


# --- fetches of the pushed repositories, over time ----------------------------------------
# Each order is one fetch of one repository that commits are pushed to, on a day of its own.

FETCH_DAY = "CAST('2019-01-01' AS DATE) + CAST(ok * 37 % 2500 AS INT)"
FETCH_LANGUAGE = "CASE ok {DIV} 240 % 4 WHEN 0 THEN 'Go' WHEN 1 THEN 'Python' WHEN 2 THEN 'Rust' END"


def repo_fetches(spark: SparkSession, sf: str) -> DataFrame:
    """Landed responses, one repository each."""
    language = _dialect(FETCH_LANGUAGE, SPARK)
    node = f"""to_json(named_struct('nameWithOwner', concat('org', ok % 60, '/repo', ok % 240), 'databaseId', ok % 240,
        'isFork', false, 'stargazerCount', price % 20000,
        'primaryLanguage', if(({language}) IS NULL, NULL, named_struct('name', {language})),
        'pullRequests', named_struct('totalCount', 0, 'nodes', array()),
        'defaultBranchRef', named_struct('name', 'main', 'target', named_struct('history', named_struct('totalCount', 1)))))"""
    orders = wide_enough(spark, table(spark, sf, "orders").selectExpr(*_select(_ORDER_KEYS, SPARK)))
    return orders.selectExpr(
        "concat('b', ok) AS request_id",
        f"CAST({FETCH_DAY} AS TIMESTAMP_NTZ) AS fetched_at",
        "'batch' AS kind",
        "array(concat('org', ok % 60, '/repo', ok % 240)) AS repos",
        "0 AS page_no",
        f"""if(ok % 12 = 0, '{{"data":{{"r0":null}},"errors":[{{"type":"NOT_FOUND","path":["r0"]}}]}}', concat('{{"data":{{"r0":', {node}, '}}}}')) AS body""",
    )


def duck_repo_fetches() -> str:
    """Stored snapshots of those fetches as a DuckDB CTE named ``fetches``."""
    keys = ", ".join(_select(_ORDER_KEYS, DUCK))
    return f"""base_f AS (SELECT {keys} FROM orders),
fetches AS (SELECT repo, fetched_on, status, language, stargazers FROM (
  SELECT 'org' || CAST(ok % 60 AS VARCHAR) || '/repo' || CAST(ok % 240 AS VARCHAR) AS repo, CAST({FETCH_DAY} AS DATE) AS fetched_on,
    CASE WHEN ok % 12 = 0 THEN 'not_found' ELSE 'ok' END AS status, {_dialect(FETCH_LANGUAGE, DUCK)} AS language, price % 20000 AS stargazers,
    row_number() OVER (PARTITION BY repo, fetched_on ORDER BY 'b' || CAST(ok AS VARCHAR) DESC) AS k FROM base_f) WHERE k = 1)"""


# --- names that move ----------------------------------------------------------------------
# Each customer is a repository seen by four weekly fetches: it keeps its name, is renamed twice,
# swaps names with its neighbour, or leaves a name that the neighbour takes.

_P = _s("ck {DIV} 6")
SIGHTINGS = {
    "asked": f"""CASE ck % 6 WHEN 0 THEN 'own' || {_s('ck')} WHEN 1 THEN 'a' || {_s('ck')}
        WHEN 2 THEN CASE WHEN d < 2 THEN 'x' ELSE 'y' END || {_P} WHEN 3 THEN CASE WHEN d < 2 THEN 'y' ELSE 'x' END || {_P}
        WHEN 4 THEN CASE WHEN d < 2 THEN 'z' ELSE 'zz' END || {_P} ELSE CASE WHEN d < 3 THEN 'w' ELSE 'z' END || {_P} END || '/app'""",
    "reported": f"""CASE ck % 6 WHEN 0 THEN 'Own' || {_s('ck')} WHEN 1 THEN CASE WHEN d < 2 THEN 'a' WHEN d = 2 THEN 'B' ELSE 'c' END || {_s('ck')}
        WHEN 2 THEN CASE WHEN d < 2 THEN 'X' ELSE 'y' END || {_P} WHEN 3 THEN CASE WHEN d < 2 THEN 'y' ELSE 'x' END || {_P}
        WHEN 4 THEN CASE WHEN d < 2 THEN 'z' ELSE 'zz' END || {_P} ELSE CASE WHEN d < 2 THEN 'w' ELSE 'Z' END || {_P} END || '/App'""",
    "repo_id": "CASE WHEN ck % 7 = 3 AND d = 1 OR ck % 6 = 1 AND ck % 5 = 2 AND d >= 1 OR ck % 6 = 1 AND ck % 35 = 0 THEN NULL ELSE ck END",
    "seen_on": "CAST('2026-01-05' AS DATE) + CAST(7 * d AS INT)",
}


def sightings(spark: SparkSession, sf: str) -> DataFrame:
    """What those fetches saw."""
    repos = table(spark, sf, "customer").selectExpr("c_custkey AS ck", "explode(array(0, 1, 2, 3)) AS d")
    flat = repos.selectExpr(*_select(SIGHTINGS, SPARK))
    return flat.withColumns({c: F.lower(c) for c in ("asked", "reported")})


def duck_sightings() -> str:
    cols = ", ".join(_select(SIGHTINGS, DUCK))
    return f"sight AS (SELECT {cols} FROM (SELECT c_custkey AS ck, UNNEST([0, 1, 2, 3]) AS d FROM customer))"


RENAMED_FROM = "2022-06-01"
"""The day from which every fourth repository of the commits is pushed to under another name."""


def renamed_commits(spark: SparkSession, sf: str) -> DataFrame:
    """The commits as if every fourth repository had been renamed on :data:`RENAMED_FROM`."""
    number = F.regexp_extract("repo", "/repo([0-9]+)$", 1).cast("bigint")
    moved = (number % 4 == 0) & (F.col("pushed_at") >= F.lit(RENAMED_FROM).cast("timestamp_ntz"))
    renamed = F.when(moved & F.col("repo").rlike("(?i)^org"), F.concat(F.lit("moved/repo"), number))
    return commits(spark, sf).withColumn("repo", F.coalesce(renamed, "repo"))


def renamed_sightings(spark: SparkSession, sf: str) -> DataFrame:
    """What fetches of those repositories saw: the old name leads to the new one after the day."""
    orders = table(spark, sf, "orders").selectExpr(*_select(_ORDER_KEYS, SPARK))
    return orders.selectExpr(
        "concat('org', ok % 60, '/repo', ok % 240) AS asked",
        f"if(ok % 4 = 0 AND {FETCH_DAY} >= DATE'{RENAMED_FROM}', concat('moved/repo', ok % 240), concat('org', ok % 60, '/repo', ok % 240)) AS reported",
        "ok % 240 AS repo_id",
        f"{FETCH_DAY} AS seen_on",
    )
