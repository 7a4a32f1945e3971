"""The rule table: which agents exist and which marks they leave.

Rules are a small table (one row per signal). :func:`compile_rules` turns it into an ordered
tuple of :class:`Rule` that the attribution and prefilter operators unroll into literal
Column expressions, so no rule data is shipped to or looked up by the executors.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.functions.patterns import jvm_pattern, unportable
from aftermerge.schemas import RULES, columns

# The closed vocabularies of the rule table.
TRAILER_TYPES = ("trailer_name", "trailer_email", "trailer_present")
FIELD_TYPES = ("author_login", "author_email", "author_name", "message", "pr_body")
CONFIDENCE_RANK = {"high": 3, "medium": 2, "low": 1}
STATUSES = ("verified", "needs_verification", "deprecated")
SLUG = r"^[a-z0-9]+(?:-[a-z0-9]+)*\z"

MOST_RULES = 5_000
"""Default bound on the rules of a version: they become expressions of every row's plan."""


@dataclass(frozen=True)
class Rule:
    """One active signal, ready to be unrolled into an expression."""

    registry_version: int
    agent_id: str
    signal_id: str
    type: str
    trailer_key: str | None
    pattern: str
    confidence: str
    case_sensitive: bool
    requires: tuple[str, ...] = ()
    """Signals of the same agent that must match too, those that they require included."""

    @property
    def java(self) -> str:
        """The pattern in the JVM's dialect, with the rule's own case handling."""
        return jvm_pattern(self.pattern, case_sensitive=self.case_sensitive)


class RuleError(ValueError):
    """A rule table that cannot be used; the message lists every problem found."""


def rules_from_mapping(document: Mapping[str, Any]) -> list[dict[str, Any]]:
    """Flatten ``{version, agents: [{id, ..., signals: [...]}]}`` into rule rows.

    Raises:
        RuleError: listing each missing or malformed part with its location.
    """
    problems: list[str] = []
    rows: list[dict[str, Any]] = []
    version = document.get("version")
    if not isinstance(version, int) or isinstance(version, bool) or version < 1:
        problems.append("version: must be an integer of at least 1")
    agents = document.get("agents")
    if not isinstance(agents, list) or not agents:
        problems.append("agents: at least one agent is required")
        agents = []
    for i, agent in enumerate(agents):
        where = f"agents.{i}"
        if not isinstance(agent, Mapping):
            problems.append(f"{where}: must be a mapping")
            continue
        problems += _shape(agent, where, ("id", "name", "vendor"), ("homepage", "status", "signals"))
        signals = agent.get("signals")
        if not isinstance(signals, list) or not signals:
            problems.append(f"{where}.signals: at least one signal is required")
            continue
        for j, signal in enumerate(signals):
            place = f"{where}.signals.{j}"
            if not isinstance(signal, Mapping):
                problems.append(f"{place}: must be a mapping")
                continue
            problems += _shape(
                signal,
                place,
                ("id", "type", "pattern", "confidence"),
                ("trailer_key", "case_sensitive", "evidence", "notes", "requires"),
            )
            requires = signal.get("requires")
            if requires is not None and not (isinstance(requires, list) and all(map(_text, requires))):
                problems.append(f"{place}.requires: must be a list of signal ids")
                requires = None
            rows.append(
                {
                    "registry_version": version if isinstance(version, int) else None,
                    "agent_order": i,
                    "agent_id": agent.get("id"),
                    "name": agent.get("name"),
                    "vendor": agent.get("vendor"),
                    "status": agent.get("status", "needs_verification"),
                    "signal_order": j,
                    "signal_id": signal.get("id"),
                    "type": signal.get("type"),
                    "trailer_key": signal.get("trailer_key"),
                    "pattern": signal.get("pattern"),
                    "confidence": signal.get("confidence"),
                    "case_sensitive": bool(signal.get("case_sensitive", False)),
                    "evidence": signal.get("evidence"),
                    "notes": signal.get("notes"),
                    "requires": requires,
                }
            )
    if problems:
        raise RuleError("; ".join(problems))
    return rows


def _shape(
    part: Mapping[str, Any], where: str, needed: Iterable[str], optional: Iterable[str]
) -> list[str]:
    known = {*needed, *optional}
    missing = [f"{where}.{k}: required text is missing" for k in needed if not _text(part.get(k))]
    unknown = [f"{where}.{k}: unknown field" for k in part if k not in known]
    return missing + unknown


def _text(value: object) -> bool:
    return isinstance(value, str) and value != ""


def rules_frame(spark: SparkSession, rows: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Rule rows as a DataFrame with the :data:`~aftermerge.schemas.RULES` schema."""
    names = columns(RULES)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RULES)


def required_signals(requires: Mapping[str, Iterable[str]]) -> dict[str, tuple[str, ...]]:
    """Per signal all that must match with it: what it requires, what that requires, and so on.

    Signals are taken in the order of their dependencies.

    Raises:
        RuleError: when a required signal is unknown or requirements run in a circle.
    """
    full: dict[str, set[str]] = {}
    left = {name: set(needed) for name, needed in requires.items()}
    if unknown := sorted({n for needed in left.values() for n in needed} - set(left)):
        raise RuleError(f"requires an unknown signal: {', '.join(unknown)}")
    while left:
        ready = [name for name, needed in left.items() if needed <= full.keys()]
        if not ready:
            raise RuleError(f"requires itself in a circle: {', '.join(sorted(left))}")
        for name in ready:
            needed = left.pop(name)
            full[name] = needed.union(*(full[n] for n in needed))
    return {name: tuple(sorted(needed)) for name, needed in full.items()}


def compile_rules(
    rules: DataFrame | Iterable[Mapping[str, Any]],
    *,
    version: int | None = None,
    most: int = MOST_RULES,
) -> tuple[Rule, ...]:
    """Active rules of one version, strongest first: confidence, agent order, signal order.

    That order is the evidence order, so evidence never has to be sorted per row. Deprecated
    agents are left out, so the result may be empty. ``version`` picks one of several versions;
    without it the table must hold one only. A DataFrame is read here in full, as far as
    ``most`` rows; a larger version is refused.
    """
    if isinstance(rules, DataFrame):
        wanted = rules if version is None else rules.where(F.col("registry_version") == version)
        rows = [r.asDict() for r in wanted.limit(most + 1).collect()]
    else:
        rows = [dict(r) for r in rules if version in (None, r["registry_version"])]
    if len(rows) > most:
        raise RuleError(f"more than {most} rules; pass a higher bound if that is meant")
    if version is not None and not rows:
        raise RuleError(f"no rule has version {version}")
    versions = {r["registry_version"] for r in rows}
    if len(versions) > 1:
        raise RuleError(f"{len(versions)} versions in one table; say which to compile")
    problems = [p for r in rows for p in row_problems(r)]
    names = [(r["agent_id"], r["signal_id"]) for r in rows]
    problems += [(f"{a}/{s}", "defined twice") for a, s in sorted(set(names)) if names.count((a, s)) > 1]
    if problems:
        raise RuleError("; ".join(f"{where}: {text}" for where, text in problems))
    active = [r for r in rows if r["status"] != "deprecated"]
    needed: dict[tuple[str, str], tuple[str, ...]] = {}
    for agent in {r["agent_id"] for r in active}:
        own = {r["signal_id"]: r.get("requires") or () for r in active if r["agent_id"] == agent}
        try:
            needed |= {(agent, signal): full for signal, full in required_signals(own).items()}
        except RuleError as error:
            raise RuleError(f"{agent}: {error}") from None
    active.sort(
        key=lambda r: (-CONFIDENCE_RANK[r["confidence"]], r["agent_order"], r["signal_order"])
    )
    return tuple(
        Rule(
            registry_version=r["registry_version"],
            agent_id=r["agent_id"],
            signal_id=r["signal_id"],
            type=r["type"],
            trailer_key=r["trailer_key"],
            pattern=r["pattern"],
            confidence=r["confidence"],
            case_sensitive=bool(r["case_sensitive"]),
            requires=needed[r["agent_id"], r["signal_id"]],
        )
        for r in active
    )


def rules_version(rules: DataFrame, version: int | None = None) -> int:
    """The version compiled from a table: the one asked for, or its only one."""
    if version is not None:
        return version
    found = [r[0] for r in rules.select("registry_version").distinct().limit(2).collect()]
    if len(found) != 1:
        raise RuleError("a rule table of one version is needed; say which to compile")
    return found[0]


def pattern_problem(pattern: str | None, *, portable: bool = True) -> str | None:
    """Why a pattern cannot be used, or ``None``: it must compile and, if asked, be portable."""
    try:
        re.compile(pattern or "")
    except re.error as error:
        return f"invalid regular expression: {error}"
    bad = unportable(pattern or "") if portable else None
    return f"not portable: uses {bad}" if bad else None


def row_problems(row: Mapping[str, Any]) -> list[tuple[str, str]]:
    """Problems of one rule row that make it unusable, as (where, what)."""
    kind, trailer = row.get("type"), bool(row.get("trailer_key"))
    allowed = {
        "type": TRAILER_TYPES + FIELD_TYPES,
        "confidence": tuple(CONFIDENCE_RANK),
        "status": STATUSES,
    }
    found = [f"{name} is none of the known ones: {row.get(name)!r}" for name, known in allowed.items() if row.get(name) not in known]
    found += [
        f"{name} is no slug: {row.get(name)!r}"
        for name in ("agent_id", "signal_id")
        if not re.match(SLUG.replace("\\z", "\\Z"), row.get(name) or "")
    ]
    if (row.get("registry_version") or 0) < 1:
        found.append("its version is below 1")
    if kind in TRAILER_TYPES + FIELD_TYPES and trailer != (kind in TRAILER_TYPES):
        found.append(f"a signal of type {kind} {'has no' if trailer else 'needs a'} trailer_key")
    if row.get("status") == "verified" and row.get("confidence") == "high" and not (row.get("evidence") or row.get("notes")):
        found.append("it is verified without evidence or notes")
    if bad := pattern_problem(row.get("pattern"), portable=False):
        found.append(bad)
    where = f"{row.get('agent_id')}/{row.get('signal_id')}"
    return [(where, what) for what in found]


def validate_rules(rules: DataFrame) -> DataFrame:
    """Every problem in a rule table as rows ``(registry_version, agent_id, signal_id, problem)``.

    An empty result means the table can be used. Whole-table checks are grouped counts; only
    the question "does this regular expression compile" leaves the JVM.
    """

    def missing(name: str) -> Column:
        return F.coalesce(F.length(F.col(name)), F.lit(0)) == 0

    is_trailer = F.col("type").isin(*TRAILER_TYPES)
    is_field = F.col("type").isin(*FIELD_TYPES)
    checks = {
        "version below 1": F.coalesce(F.col("registry_version") < 1, F.lit(True)),
        "agent id is not a slug": ~F.coalesce(F.col("agent_id").rlike(SLUG), F.lit(False)),
        "signal id is not a slug": ~F.coalesce(F.col("signal_id").rlike(SLUG), F.lit(False)),
        "unknown type": ~F.coalesce(is_trailer | is_field, F.lit(False)),
        "trailer_key missing": is_trailer & missing("trailer_key"),
        "trailer_key not allowed": is_field & ~missing("trailer_key"),
        "unknown confidence": ~F.coalesce(
            F.col("confidence").isin(*CONFIDENCE_RANK), F.lit(False)
        ),
        "unknown status": ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)),
        "verified without evidence": (F.col("status") == "verified")
        & (F.col("confidence") == "high")
        & missing("evidence")
        & missing("notes"),
    }
    id_columns = ["registry_version", "agent_id", "signal_id"]
    per_row = rules.select(
        *id_columns,
        F.explode(
            F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()]))
        ).alias("problem"),
    )
    patterns = rules.select(*id_columns, "pattern").mapInPandas(
        _pattern_problems, "registry_version int, agent_id string, signal_id string, problem string"
    )
    same_signal = (
        rules.groupBy(*id_columns)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(*id_columns, F.lit("duplicate signal id").alias("problem"))
    )
    same_agent = (
        rules.groupBy("registry_version", "agent_id")
        .agg(F.count_distinct("agent_order").alias("n"))
        .where("n > 1")
        .select(
            "registry_version",
            "agent_id",
            F.lit(None).cast("string").alias("signal_id"),
            F.lit("duplicate agent id").alias("problem"),
        )
    )
    found = per_row.unionByName(patterns).unionByName(same_signal).unionByName(same_agent)
    return found.unionByName(requirement_problems(rules)) if "requires" in rules.columns else found


def requirement_problems(rules: DataFrame) -> DataFrame:
    """Signals that require one their agent doesn't have, or that lead into a circle."""
    keys = ["registry_version", "agent_id"]
    edges = rules.select(*keys, "signal_id", F.explode("requires").alias("needs")).distinct()
    known = rules.select(*keys, F.col("signal_id").alias("needs")).distinct()
    unknown = edges.join(known, [*keys, "needs"], "left_anti").select(
        *keys, "signal_id", F.lit("requires an unknown signal").alias("problem")
    )
    # An agent's requirements are configuration: a handful of rows.
    circles = edges.groupBy(*keys).applyInPandas(
        _circles, "registry_version int, agent_id string, signal_id string, problem string"
    )
    return unknown.distinct().unionByName(circles)


def _circles(edges: pd.DataFrame) -> pd.DataFrame:
    left: dict[str, set[str]] = {}
    for signal, needs in zip(edges["signal_id"], edges["needs"], strict=True):
        left.setdefault(signal, set()).add(needs)
    while ready := [s for s, needs in left.items() if not needs & left.keys()]:
        for signal in ready:
            del left[signal]
    rows = [(edges["registry_version"].iloc[0], edges["agent_id"].iloc[0], signal) for signal in sorted(left)]
    found = pd.DataFrame(rows, columns=["registry_version", "agent_id", "signal_id"], dtype=object)
    return found.assign(problem=pd.Series("requires itself in a circle", found.index, dtype=object))


def _pattern_problems(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    for batch in batches:
        found = [pattern_problem(p) for p in batch["pattern"]]
        kinds = pd.Series([f and f.partition(":")[0] for f in found], batch.index, dtype=object)
        yield batch.drop(columns="pattern").assign(problem=kinds)[kinds.notna()]


def fingerprint(rules: DataFrame) -> DataFrame:
    """One row per registry version: a 16-digit content hash that changes with any rule.

    A row's text is each value behind its length, or a dash for NULL, so no two rows share it.
    Row digests are added up, so rows combine in any order and no version's rows are gathered
    in one place.
    """
    # Requirements came later: a row without any has the hash it had before there were some.
    plain = [c for c in columns(RULES) if c != "requires"]
    texts = [F.col(c).cast("string") for c in plain]
    marked = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    if "requires" in rules.columns:
        listed = F.array_join("requires", ",")
        marked.append(F.coalesce(F.concat(F.length(listed).cast("string"), F.lit(":"), listed), F.lit("")))
    row = F.sha2(F.concat(*marked), 256)
    parts = [
        F.sum(F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(38,0)")).cast("string")
        for start in (1, 16, 31, 46)
    ]
    whole = F.sha2(F.concat_ws("-", F.count("*").cast("string"), *parts), 256)
    return rules.groupBy("registry_version").agg(F.substring(whole, 1, 16).alias("fingerprint"))
