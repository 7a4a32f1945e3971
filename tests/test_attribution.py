from __future__ import annotations

import copy

import pytest
from pyspark.sql import SparkSession

from aftermerge.functions.patterns import unportable
from aftermerge.operators import rules as R
from aftermerge.operators.attribution import (
    COMMIT_INPUTS,
    PULL_INPUTS,
    attribute,
    evidence_table,
    verdict_column,
)
from aftermerge.operators.prefilter import (
    any_hit,
    folded,
    prefilter_audit,
    prefilter_flags,
    unanchored,
)
from aftermerge.sources.readers import parse_rules
from workload.rules import RULES_V1, RULES_V3, compiled

SIGNED = "Fix\n\nBody.\n\nCo-Authored-By: Heron <bot@heron.example>"
FIELDS = "repo string, sha string, message string, author_login string, author_email string, author_name string"


def judge(spark: SparkSession, message: str = "", login: str | None = None, email: str | None = None,
          name: str | None = None, rules: tuple = compiled()) -> tuple:
    df = spark.createDataFrame([("o/r", "s", message, login, email, name)], FIELDS)
    row = attribute(df, rules, COMMIT_INPUTS).first()
    return row["agent_id"], row["attribution_confidence"], [(e["signal_id"], e["matched"]) for e in row["evidence"]]


def test_verdicts(spark: SparkSession) -> None:
    assert judge(spark, "plain") == (None, None, [])
    assert judge(spark, SIGNED) == ("heron", "high", [("heron-mail", "bot@heron.example"), ("heron-name", "Heron")])
    assert judge(spark, SIGNED.replace("<bot@heron.example>", "5 <x@y.z>"))[:2] == ("heron", "medium")
    assert judge(spark, "T\n\nCo-Authored-By: Heron")[2] == [("heron-name", "Heron")]
    assert judge(spark, SIGNED + "\nand prose")[0] is None
    assert judge(spark, "x generated with HERON y") == (None, None, [("heron-hint", "generated with HERON")])
    assert judge(spark, "x", login="dodo")[0] is None
    assert judge(spark, "", login="", email="", name="") == (None, None, [])
    assert judge(spark, "x", email="a@kestrel.example")[0] == "kestrel"
    assert judge(spark, "x", email="a@KESTREL.example")[0] is None  # case-sensitive rule


def test_strongest_wins_then_registry_order(spark: SparkSession) -> None:
    named = "T\n\nCo-Authored-By: Heron 9 <x@y.z>"
    both = judge(spark, named, login="kestrel-app[bot]")
    assert both[:2] == ("kestrel", "high")
    assert [s for s, _ in both[2]] == ["kestrel-login", "heron-name"]
    assert judge(spark, SIGNED, login="kestrel-app[bot]")[0] == "heron"


def test_first_matching_trailer_is_the_evidence(spark: SparkSession) -> None:
    message = "T\n\nCo-Authored-By: Ada <a@b.c>\nco-authored-by: Heron A <x@y>\nCo-Authored-By: Heron B <x@y>"
    assert judge(spark, message)[2] == [("heron-name", "Heron A")]


def test_pull_requests_use_title_and_body(spark: SparkSession) -> None:
    df = spark.createDataFrame([("t", None, "see kestrel.example/tasks/9")], "title string, author_login string, body string")
    assert attribute(df, compiled(), PULL_INPUTS).first()["agent_id"] == "kestrel"


def test_quotes_and_backslashes_in_patterns_survive(spark: SparkSession) -> None:
    document = copy.deepcopy(RULES_V1)
    document["agents"][0]["signals"][2]["pattern"] = r"it's \\ a \"bird\""
    rules = R.compile_rules(R.rules_from_mapping(document))
    assert judge(spark, 'so it\'s \\ a "bird"', rules=rules)[2] == [("heron-hint", 'it\'s \\ a "bird"')]


def test_evidence_rows_are_ranked(spark: SparkSession) -> None:
    df = spark.createDataFrame([("o/r", "s", SIGNED, None, None, None)], FIELDS)
    rows = evidence_table(df, compiled(), inputs=COMMIT_INPUTS).orderBy("rank").collect()
    assert [(r["rank"], r["signal_id"]) for r in rows] == [(0, "heron-mail"), (1, "heron-name")]


@pytest.mark.parametrize(
    ("pattern", "inner"), [("^a$", "a"), (r"^a(\s|$)", r"a(\s|$)"), (r"^a\$", r"a\$"), (r"a\\$", r"a\\"), ("a", "a"), ("a$", "a"), ("", "")]
)
def test_unanchored(pattern: str, inner: str) -> None:
    assert unanchored(pattern) == inner


def test_prefilter(spark: SparkSession) -> None:
    found = folded(compiled())
    assert "tasks" in found["message"] and "dodo" not in found["pusher_login"]
    none = folded([r for r in compiled() if r.type == "author_login"])
    assert none["message"] == r"[^\s\S]"
    messages = [SIGNED, "T\n\nCo-Authored-By: Heron\n  <bot@heron.example>", "T\r\rTask-Link: kestrel.example/tasks/", "x"]
    rows = [("o/r", str(i), m, None, None, None) for i, m in enumerate(messages)]
    df = spark.createDataFrame(rows, "repo string, sha string, message string, pusher_login string, author_email string, author_name string")
    flags = [r[0] for r in prefilter_flags(df, compiled()).orderBy("sha").select(any_hit()).collect()]
    assert flags == [True, True, False, False]  # a lone CR hides a line start from the scan
    audit = {r["signal_id"]: (r["attributed"], r["missed"]) for r in prefilter_audit(df, compiled()).collect()}
    assert audit == {"heron-name": (1, 0), "heron-mail": (1, 0), "kestrel-task": (1, 1)} or audit == {
        "heron-mail": (2, 0), "kestrel-task": (1, 1)}


def test_unportable_patterns_stop_the_prefilter() -> None:
    document = copy.deepcopy(RULES_V1)
    document["agents"][0]["signals"][2]["pattern"] = "(?=x)y"
    rules = R.compile_rules(R.rules_from_mapping(document))
    with pytest.raises(R.RuleError, match="not portable"):
        folded(rules)


def test_rule_documents_report_every_problem() -> None:
    with pytest.raises(R.RuleError) as caught:
        parse_rules('{"version": 0, "agents": [{"id": "a", "vendor": "v", "signals": [{"id": "s", "colour": 1}]}, {"id": "b"}]}')
    text = str(caught.value)
    for part in ("version", "agents.0.name", "signals.0.pattern", "signals.0.colour: unknown", "agents.1.signals"):
        assert part in text
    with pytest.raises(R.RuleError, match="mapping"):
        parse_rules("[1]")


def test_rule_rows_are_checked(spark: SparkSession) -> None:
    good = R.rules_from_mapping(RULES_V1)
    assert R.validate_rules(R.rules_frame(spark, good)).collect() == []
    bad = [dict(r) for r in good]
    bad[0]["trailer_key"] = None
    bad[1]["pattern"] = "("
    bad[2]["signal_id"] = "heron-name"
    bad[2]["trailer_key"] = "X"
    bad[3]["confidence"] = "sure"
    found = {(r["signal_id"], r["problem"]) for r in R.validate_rules(R.rules_frame(spark, bad)).collect()}
    assert found == {
        ("heron-mail", "trailer_key missing"),
        ("heron-name", "invalid regular expression"),
        ("heron-name", "trailer_key not allowed"),
        ("heron-name", "duplicate signal id"),
        ("kestrel-login", "unknown confidence"),
    }
    with pytest.raises(R.RuleError, match="needs a trailer_key"):
        R.compile_rules(bad)


def test_fingerprint_follows_content(spark: SparkSession) -> None:
    rows = R.rules_from_mapping(RULES_V1)
    changed = [dict(r) for r in rows]
    changed[0]["pattern"] = "other"
    prints = [R.fingerprint(R.rules_frame(spark, x)).first()["fingerprint"] for x in (rows, rows[::-1], changed)]
    assert prints[0] == prints[1] != prints[2]
    assert len(prints[0]) == 16


@pytest.mark.parametrize(
    ("pattern", "bad"),
    [(r"C:\\1", None), (r"(a)\1", r"\1"), (r"[\1(?=]", None), (r"[]\1]x", None), (r"a(?<!b)", "(?<!"), (r"\(?=", None),
     (r"(?P<n>a)(?P=n)", "(?P="), (r"(a)?(?(1)b|c)", "(?("), (r"[^]](?!x)", "(?!"), ("\\", None)],
)
def test_dialect(pattern: str, bad: str | None) -> None:
    assert unportable(pattern) == bad


def test_one_version_is_compiled_at_a_time() -> None:
    rows = R.rules_from_mapping(RULES_V1)
    later = [{**r, "registry_version": r["registry_version"] + 1} for r in rows]
    with pytest.raises(R.RuleError, match="versions"):
        R.compile_rules([*rows, *later])
    assert {r.registry_version for r in R.compile_rules([*rows, *later], version=later[0]["registry_version"])} == {
        later[0]["registry_version"]
    }
    with pytest.raises(R.RuleError, match="no rule"):
        R.compile_rules(rows, version=99)
    with pytest.raises(R.RuleError, match="more than 2"):
        R.compile_rules(rows, most=2)
    assert R.compile_rules([{**r, "status": "deprecated"} for r in rows]) == ()
    with pytest.raises(R.RuleError, match="slug"):
        R.compile_rules([{**r, "agent_id": "Not A Slug"} for r in rows])
    with pytest.raises(R.RuleError, match="twice"):
        R.compile_rules([*rows, rows[0]])


@pytest.mark.parametrize("document", [RULES_V1, RULES_V3])
def test_verdicts_by_steps_are_those_of_one_expression(spark: SparkSession, document: dict) -> None:
    blocks = [
        "Co-Authored-By: Heron <bot@heron.example>", "co-authored-by : Heron\n  <bot@heron.example>", "Task-Link:",
        "(cherry picked from commit abcdef0)\nTask-Link: https://kestrel.example/tasks/1",
        "(cherry picked from commit abcdef0)", "Co-Authored-By: Heron\nprose", " Co-Authored-By: Heron",
        "Signed-off-by: A <a@b.c>\nCo-Authored-By:  Heron 5 <x@y.z> \nTask-Link: kestrel.example/tasks/ \u3000",
    ]
    ends = ["", "\n", "\r\n\u2003", "\n\nCo-Authored-By: x"]
    messages = [None, "", "\n\n", *blocks, *(f"S{gap}{b}{e}" for gap in ("\n\n", "\r\r", "\n \t\n") for b in blocks for e in ends)]
    rows = [("o/r", f"{k}", m, "dodo" if k % 3 else None, "A@kestrel.example" if k % 4 else "", None) for k, m in enumerate(messages)]
    df, rules = spark.createDataFrame(rows, FIELDS), compiled(document)
    stepped = {r["sha"]: (r["agent_id"], r["attribution_confidence"], r["evidence"]) for r in attribute(df, rules, COMMIT_INPUTS).collect()}
    whole = df.select("sha", verdict_column(rules, COMMIT_INPUTS).alias("v")).collect()
    assert stepped == {r["sha"]: tuple(r["v"]) for r in whole}
    assert len({v[0] for v in stepped.values()}) > 2


def test_verdicts_are_compiled(spark: SparkSession) -> None:
    df = spark.createDataFrame([("o/r", "s", SIGNED, None, None, None)], FIELDS)
    plan = attribute(df, compiled(), COMMIT_INPUTS)._jdf.queryExecution().executedPlan().toString()
    generators = [line for line in plan.split("\n") if "Generate" in line]
    assert generators and all("inline(array(_held" in line for line in generators), "a generator evaluates nothing itself"


def test_evidence_is_made_only_where_it_is_read(spark: SparkSession) -> None:
    signed = attribute(spark.createDataFrame([("o/r", "s", SIGNED, "dodo", None, None)], FIELDS), compiled(), COMMIT_INPUTS)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "flatten" in plan(signed)
    assert "flatten" not in plan(signed.select("agent_id", "attribution_confidence"))
    assert signed.select("agent_id", "attribution_confidence").first() == signed.first()[-3:-1] == ("heron", "high")
