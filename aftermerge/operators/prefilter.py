"""Cheap flags per commit derived from the rules, and the audit that compares the two.

Attribution is cheap here, so every commit is attributed exactly; the flags are a reported
property (and an optional pushdown), not a gate.

A push event shows four texts of a commit. :func:`channel_patterns` says what each rule looks
for in which of them; the patterns of a text are folded into one expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aftermerge.functions.patterns import NEVER, jvm_pattern
from aftermerge.functions.text import is_coarse_revert
from aftermerge.operators.attribution import PUSH_INPUTS, attribute
from aftermerge.operators.rules import TRAILER_TYPES, Rule, RuleError, pattern_problem

#: The column searched for each kind of signal; trailers are lines of the message.
SEARCHED = {
    **dict.fromkeys(TRAILER_TYPES, "message"),
    "message": "message",
    "author_email": "author_email",
    "author_name": "author_name",
    "author_login": "pusher_login",
}

#: The searched columns, and the flag for each.
HITS = {name: f"{name}_hit" for name in dict.fromkeys(SEARCHED.values())}


def unanchored(pattern: str) -> str:
    """``pattern`` without a ``^`` at its start and a ``$`` at its end that isn't escaped."""
    end = len(pattern) - 1
    escapes = len(pattern[: max(end, 0)]) - len(pattern[: max(end, 0)].rstrip("\\"))
    closed = pattern.endswith("$") and escapes % 2 == 0
    return pattern[pattern.startswith("^") : end if closed else None]


def channel_patterns(rules: Sequence[Rule]) -> Iterator[tuple[str, str]]:
    """(searched column, pattern) of each rule that a push can show, in the order of the ids.

    Raises :class:`RuleError` for a pattern outside the portable family, in any rule.
    """
    for rule in sorted(rules, key=lambda r: (r.agent_id, r.signal_id)):
        if problem := pattern_problem(rule.pattern):
            raise RuleError(f"{rule.agent_id}/{rule.signal_id}: {problem}")
        column = SEARCHED.get(rule.type)
        if column and rule.trailer_key:
            yield column, f"^{re.escape(rule.trailer_key)}\\s*:[^\\n]*{unanchored(rule.pattern)}"
        elif column:
            yield column, rule.pattern


def folded(rules: Sequence[Rule]) -> dict[str, str]:
    """One pattern per searched column that matches where any of its rules' patterns does."""
    found = list(channel_patterns(rules))
    return {
        column: "|".join(f"(?:{p})" for c, p in found if c == column) or NEVER for column in HITS
    }


def prefilter_flags(commits: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add a flag per searched column and ``revert_hit``; NULL counts as empty text."""
    flags = {
        HITS[column]: F.coalesce(F.col(column), F.lit("")).rlike(
            jvm_pattern(pattern, multiline=column == "message")
        )
        for column, pattern in folded(rules).items()
    }
    return commits.withColumns({**flags, "revert_hit": is_coarse_revert("message")})


def any_hit() -> Column:
    """Whether any searched column was hit, NULL counting as no."""
    return F.coalesce(F.greatest(*HITS.values()), F.lit(False))


def prefilter_audit(commits: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per deciding signal: commits attributed, and how many of them the flags would miss."""
    judged = attribute(prefilter_flags(commits, rules), rules, PUSH_INPUTS)
    best = judged.select(
        any_hit().alias("flagged"),
        "agent_id",
        F.get(F.col("evidence.signal_id"), F.lit(0)).alias("signal_id"),
    )
    counted = best.groupBy("agent_id", "signal_id").agg(
        F.count("*").alias("attributed"), F.count_if(~F.col("flagged")).alias("missed")
    )
    return counted.where(F.col("agent_id").isNotNull())
