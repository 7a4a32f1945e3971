"""Signals that count only together: completion, circles, evidence and the prefilter."""

from __future__ import annotations

import copy
import random

import pytest
from pyspark.sql import SparkSession

from aftermerge.operators import rules as R
from aftermerge.operators.attribution import evaluate_signals
from aftermerge.operators.prefilter import any_hit, prefilter_flags
from workload.rules import RULES_V1, RULES_V3, compiled


def test_requirements_are_completed_in_order() -> None:
    assert R.required_signals({"a": ["b"], "b": ["c", "d"], "c": [], "d": []}) == {
        "a": ("b", "c", "d"), "b": ("c", "d"), "c": (), "d": (),
    }
    with pytest.raises(R.RuleError, match="circle: a, b, x"):
        R.required_signals({"a": ["b"], "b": ["a"], "x": ["a"], "y": []})
    with pytest.raises(R.RuleError, match="unknown signal: gone"):
        R.required_signals({"a": ["gone"]})


def test_documents_with_bad_requirements_are_refused() -> None:
    for requires, problem in ((["heron-mail"], "circle"), (["nothing"], "unknown"), ("heron-name", "must be a list")):
        document = copy.deepcopy(RULES_V1)
        document["agents"][0]["signals"][0]["requires"] = requires
        with pytest.raises(R.RuleError, match=problem):
            R.compile_rules(R.rules_from_mapping(document))


def test_a_rule_table_keeps_requirements(spark: SparkSession) -> None:
    table = R.rules_frame(spark, R.rules_from_mapping(RULES_V3))
    assert R.compile_rules(table) == compiled(RULES_V3)
    assert R.validate_rules(table).count() == 0
    plain = R.rules_frame(spark, R.rules_from_mapping(RULES_V1))
    assert R.fingerprint(plain).first() == R.fingerprint(plain.drop("requires")).first()
    assert R.fingerprint(plain).first()["fingerprint"] != R.fingerprint(table).first()["fingerprint"]


def test_problems_are_listed(spark: SparkSession) -> None:
    rows = [
        (1, "a", "x", ["y"]), (1, "a", "y", ["z", "x"]), (1, "a", "z", None), (1, "a", "in", ["x"]),
        (1, "b", "x", ["y"]), (1, "b", "self", ["self"]), (2, "b", "y", []),
    ]
    df = spark.createDataFrame(rows, "registry_version int, agent_id string, signal_id string, requires array<string>")
    found = {(r["registry_version"], r["agent_id"], r["signal_id"], r["problem"].split()[1]) for r in R.requirement_problems(df).collect()}
    assert found == {(1, "a", "x", "itself"), (1, "a", "y", "itself"), (1, "a", "in", "itself"), (1, "b", "x", "an"), (1, "b", "self", "itself")}


def test_evidence_needs_all_that_it_requires(spark: SparkSession) -> None:
    rng = random.Random(1)
    parts = ["Co-Authored-By: Heron <bot@heron.example>", "Co-Authored-By: Heron <x@else.example>", "Signed-off-by: A <a@b.example>"]
    rows = []
    for i in range(200):
        body = "generated with heron\n\n" if rng.random() < 0.5 else ""
        trailers = "\n".join(p for p in parts if rng.random() < 0.5)
        author = rng.choice([("A (kestrel)", "a@b.example"), ("A (kestrel)", "a@kestrel.example"), ("A", "a@kestrel.example")])
        rows.append((i, f"Add\n\n{body}{trailers}", *author, "ada"))
    df = spark.createDataFrame(rows, "id int, message string, author_name string, author_email string, pusher_login string")
    plain = {r["id"]: r["evidence"] for r in evaluate_signals(df, compiled()).collect()}
    got = {r["id"]: r["evidence"] for r in evaluate_signals(df, compiled(RULES_V3)).collect()}
    needs = {"heron-name": {"heron-mail"}, "heron-hint": {"heron-name", "heron-mail"}, "kestrel-author": {"kestrel-mail"}}
    fewer = 0
    for i, evidence in plain.items():
        shown = {e["signal_id"] for e in evidence}
        want = [e for e in evidence if needs.get(e["signal_id"], set()) <= shown]
        assert got[i] == want
        fewer += len(want) < len(evidence)
    assert fewer > 50
    judged = evaluate_signals(prefilter_flags(df, compiled(RULES_V3)), compiled(RULES_V3))
    assert judged.where("size(evidence) > 0").where(~any_hit()).isEmpty()  # the flags miss nothing
