"""Attribution: which agent, if any, produced a change, and on what evidence.

Rules are unrolled into one expression per row; the message is parsed once and evidence
comes out already ordered because the rules are. No shuffle, no join, no Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aftermerge.functions.text import let, person_sql, quote, trailer_steps, trailers_sql
from aftermerge.operators.barrier import with_struct
from aftermerge.operators.rules import TRAILER_TYPES, Rule
from aftermerge.schemas import EVIDENCE

COMMIT_INPUTS = {
    "message": "message",
    "author_login": "author_login",
    "author_email": "author_email",
    "author_name": "author_name",
}
"""Rule input -> column, for commits that know their author's login."""

PUSH_INPUTS = {**COMMIT_INPUTS, "author_login": "pusher_login"}
"""Push events carry no author login; the pushing account stands in for it."""

PULL_INPUTS = {"message": "title", "author_login": "author_login", "pr_body": "body"}
"""Pull requests are judged by title, author login and body."""

_TRAILER_FIELD = {
    "trailer_present": "value",
    "trailer_name": "name",
    "trailer_email": "email",
}


def _keys(rules: Sequence[Rule]) -> list[str]:
    return sorted({r.trailer_key.lower() for r in rules if r.type in TRAILER_TYPES and r.trailer_key})


def _usable(rules: Sequence[Rule], inputs: Mapping[str, str]) -> list[Rule]:
    return [r for r in rules if r.type in inputs or (r.type in TRAILER_TYPES and "message" in inputs)]


def _evidence_sql(rules: Sequence[Rule], inputs: Mapping[str, str]) -> str:
    keys, usable = _keys(rules), _usable(rules, inputs)
    if any(r.requires for r in usable):
        found = _conjunctive_sql(usable, inputs)
    else:
        entries = ", ".join(let(_match_sql(r, inputs), "m", _entry_sql(r)) for r in usable)
        found = f"CAST(array_compact(array({entries})) AS {EVIDENCE})"
    if any(r.type in TRAILER_TYPES for r in usable):
        return let(_people_sql(inputs["message"], keys), "people", found)
    return found


def _conjunctive_sql(usable: Sequence[Rule], inputs: Mapping[str, str]) -> str:
    """The same where signals require others: all are matched once, then each looks at its own.

    What a signal requires is complete (see ``required_signals``), so one pass decides all. A signal
    that requires one these inputs cannot show never matches.
    """
    matches = ", ".join(f"{_match_sql(r, inputs)} AS m{i}" for i, r in enumerate(usable))
    entries = [
        let(f"CASE WHEN {met} THEN ms.m{i} END", "m", _entry_sql(usable[i])) for i, met in _met(usable, "ms.m")
    ]
    return let(f"struct({matches})", "ms", f"CAST(array_compact(array({', '.join(entries)})) AS {EVIDENCE})")


def _met(usable: Sequence[Rule], match: str) -> list[tuple[int, str]]:
    """Number of each signal that can count, and when it does; the matches are named by ``match``."""
    place = {(r.agent_id, r.signal_id): i for i, r in enumerate(usable)}
    needed = [[i, *(place.get((r.agent_id, signal)) for signal in r.requires)] for i, r in enumerate(usable)]
    return [
        (ks[0], " AND ".join(f"{match}{k} IS NOT NULL" for k in ks)) for ks in needed if None not in ks
    ]


_NOBODY = "CAST(array() AS array<struct<key:string,value:string,name:string,email:string>>)"


def _people_sql(message: str, keys: list[str]) -> str:
    """Trailers some rule asks for, each with its name and e-mail part."""
    # Most messages mention none of the keys at all; one search spares them the parse.
    return f"CASE WHEN {_mentions(message, keys)} THEN {_asked_sql(trailers_sql(message), keys)} ELSE {_NOBODY} END"


def _mentions(message: str, keys: list[str]) -> str:
    return " OR ".join(f"contains(lower({message}), {quote(k)})" for k in keys)


def _asked_sql(trailers: str, keys: list[str]) -> str:
    listed = ", ".join(quote(k) for k in keys)
    wanted = f"filter({trailers}, w -> lower(w.key) IN ({listed}))"
    # A value without <email> counts as a bare name.
    parts = (
        "struct(lower(w.key) AS key, w.value AS value,"
        " coalesce(who.name, w.value) AS name, who.email AS email)"
    )
    return f"transform({wanted}, w -> {let(person_sql('w.value'), 'who', parts)})"


def _match_sql(rule: Rule, inputs: Mapping[str, str], people: str = "people") -> str:
    """The text a rule matched on, or NULL."""
    pattern = quote(rule.java)
    if rule.type in TRAILER_TYPES:
        part = _TRAILER_FIELD[rule.type]
        key = quote((rule.trailer_key or "").lower())
        return f"get(filter({people}, p -> p.key = {key} AND p.{part} RLIKE {pattern}), 0).{part}"
    field = inputs[rule.type]
    return (
        f"CASE WHEN length({field}) > 0 AND {field} RLIKE {pattern}"
        f" THEN regexp_extract({field}, {pattern}, 0) END"
    )


def _guarded_sql(rule: Rule, inputs: Mapping[str, str]) -> str:
    """The same, without a look at the trailers where there are none."""
    found = _match_sql(rule, inputs, "_people")
    return f"CASE WHEN size(_people) > 0 THEN {found} END" if rule.type in TRAILER_TYPES else found


def _entry_sql(rule: Rule) -> str:
    return f"CASE WHEN m IS NOT NULL THEN {_fields_sql(rule, 'm')} END"


def _fields_sql(rule: Rule, matched: str) -> str:
    return (
        f"struct({quote(rule.agent_id)} AS agent_id,"
        f" {quote(rule.signal_id)} AS signal_id, {quote(rule.type)} AS signal_type,"
        f" {quote(rule.confidence)} AS confidence, {matched} AS matched)"
    )


def evidence_column(rules: Sequence[Rule], inputs: Mapping[str, str]) -> Column:
    """Matching signals of one row as ``array<struct>``, strongest first; empty if none."""
    return F.expr(_evidence_sql(rules, inputs))


def verdict_column(rules: Sequence[Rule], inputs: Mapping[str, str]) -> Column:
    """``struct<agent_id, confidence, evidence>``; agent NULL when the best evidence is low."""
    return F.expr(let(_evidence_sql(rules, inputs), "ev", _verdict_sql("ev")))


def _verdict_sql(evidence: str) -> str:
    best = f"get({evidence}, 0)"
    strong = f"{best}.confidence <> 'low'"
    return (
        f"struct(CASE WHEN {strong} THEN {best}.agent_id END AS agent_id,"
        f" CASE WHEN {strong} THEN {best}.confidence END AS confidence, {evidence} AS evidence)"
    )


def evaluate_signals(
    df: DataFrame, rules: Sequence[Rule], inputs: Mapping[str, str] = PUSH_INPUTS
) -> DataFrame:
    """Add ``evidence``: every matching signal, low-confidence ones included."""
    return with_struct(df, F.struct(evidence_column(rules, inputs)), ["evidence"])


def attribute(
    df: DataFrame, rules: Sequence[Rule], inputs: Mapping[str, str] = PUSH_INPUTS
) -> DataFrame:
    """Add ``agent_id``, ``attribution_confidence`` and ``evidence``.

    The verdict is that of :func:`verdict_column`, step by step: each step is a column that the next
    ones read, so all but the lines of a trailer block is compiled code.
    """
    names = ["agent_id", "attribution_confidence", "evidence"]
    kept = [F.col(f"`{name}`") for name in df.columns]
    usable = _usable(rules, inputs)
    stepped = df
    if any(r.type in TRAILER_TYPES for r in usable):
        keys = _keys(rules)
        for step in trailer_steps(inputs["message"], _mentions(inputs["message"], keys)):
            stepped = stepped.selectExpr("*", step)
        stepped = stepped.selectExpr("*", f"{_asked_sql('_pairs', keys)} AS _people")
    found = [f"{_guarded_sql(r, inputs)} AS _m{i}" for i, r in enumerate(usable)]
    stepped = stepped.selectExpr("*", *found)
    none = f"CAST(array() AS {EVIDENCE})"
    signals = _met(usable, "_m")
    entries = [
        f"CASE WHEN {met} THEN CAST(array({_fields_sql(usable[i], f'_m{i}')}) AS {EVIDENCE}) ELSE {none} END"
        for i, met in signals
    ]
    evidence = f"flatten(array({', '.join(entries)}))" if entries else none
    # The verdict is known from which signals match; evidence is made only where it is read.
    verdict = f"struct({_best_sql(usable, signals, 'agent_id')}, {_best_sql(usable, signals, 'confidence')})"
    held = with_struct(stepped, F.expr(verdict), names[:2])
    return held.select(*kept, *names[:2], F.expr(evidence).alias(names[2]))


def _best_sql(usable: Sequence[Rule], signals: Sequence[tuple[int, str]], field: str) -> str:
    """That field of the first signal that counts, NULL if its evidence is low."""
    none = "CAST(NULL AS STRING)"
    value = lambda rule: none if rule.confidence == "low" else quote(getattr(rule, field))
    cases = " ".join(f"WHEN {met} THEN {value(usable[i])}" for i, met in signals)
    return f"{f'CASE {cases} END' if signals else none} AS {field}"


def agent_ids(evidence: Column) -> Column:
    """Distinct agents in evidence order."""
    return F.array_distinct(evidence["agent_id"])


def evidence_json(evidence: Column, agent_id: Column) -> Column:
    """Evidence as a JSON array for flat storage; NULL for unattributed rows."""
    return F.when(agent_id.isNotNull(), F.to_json(evidence))


def evidence_table(
    df: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str] = ("repo", "sha"),
    inputs: Mapping[str, str] = PUSH_INPUTS,
) -> DataFrame:
    """One row per matching signal with its rank in the evidence list (0 = strongest)."""
    found = df.select(*keys, F.posexplode(evidence_column(rules, inputs)).alias("rank", "e"))
    return found.select(*keys, "rank", "e.*")


def agent_status(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Attach each row's agent status, so unverified agents can be reported apart.

    The agent list is configuration (one row per agent), which is what bounds the broadcast.
    """
    agents = rules.groupBy("agent_id").agg(
        F.min("status").alias("agent_status"), F.min("name").alias("agent_name")
    )
    return df.join(F.broadcast(agents), "agent_id", "left")
