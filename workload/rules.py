"""Synthetic rule sets for the registered queries: invented agents, two versions."""

from __future__ import annotations

import copy
from typing import Any

from aftermerge.operators.rules import Rule, compile_rules, rules_from_mapping

RULES_V1: dict[str, Any] = {
    "version": 1,
    "agents": [
        {
            "id": "heron",
            "name": "Heron",
            "vendor": "Heron Works",
            "status": "verified",
            "signals": [
                {
                    "id": "heron-mail",
                    "type": "trailer_email",
                    "trailer_key": "Co-Authored-By",
                    "pattern": r"^bot@heron\.example$",
                    "confidence": "high",
                    "evidence": "Default trailer of the tool.",
                },
                {
                    "id": "heron-name",
                    "type": "trailer_name",
                    "trailer_key": "Co-Authored-By",
                    "pattern": r"^Heron(\s|$)",
                    "confidence": "medium",
                },
                {
                    "id": "heron-hint",
                    "type": "message",
                    "pattern": "generated with heron",
                    "confidence": "low",
                },
            ],
        },
        {
            "id": "kestrel",
            "name": "Kestrel",
            "vendor": "Kestrel Labs",
            "status": "needs_verification",
            "signals": [
                {
                    "id": "kestrel-login",
                    "type": "author_login",
                    "pattern": r"^kestrel-app\[bot\]$",
                    "confidence": "high",
                },
                {
                    "id": "kestrel-task",
                    "type": "trailer_present",
                    "trailer_key": "Task-Link",
                    "pattern": r"kestrel\.example/tasks/",
                    "confidence": "medium",
                },
                {
                    "id": "kestrel-pr-link",
                    "type": "pr_body",
                    "pattern": r"kestrel\.example/tasks/",
                    "confidence": "medium",
                },
                {
                    "id": "kestrel-author",
                    "type": "author_name",
                    "pattern": r"\(kestrel\)$",
                    "confidence": "medium",
                },
                {
                    "id": "kestrel-mail",
                    "type": "author_email",
                    "pattern": r"@kestrel\.example$",
                    "confidence": "medium",
                    "case_sensitive": True,
                },
            ],
        },
        {
            "id": "dodo",
            "name": "Dodo",
            "vendor": "Dodo",
            "status": "deprecated",
            "signals": [
                {"id": "dodo-login", "type": "author_login", "pattern": "^dodo$", "confidence": "high"}
            ],
        },
    ],
}


def _second_version() -> dict[str, Any]:
    """Hints count as medium, bare names no longer count, and dodo is back."""
    rules = copy.deepcopy(RULES_V1)
    rules["version"] = 2
    heron, _, dodo = rules["agents"]
    heron["signals"] = [s for s in heron["signals"] if s["id"] != "heron-name"]
    heron["signals"][-1]["confidence"] = "medium"
    dodo["status"] = "needs_verification"
    return rules


RULES_V2 = _second_version()


def _conjunctive_version() -> dict[str, Any]:
    """A bare name counts only with the address, a hint only with a name that counts, and a marked
    author only with the agent's address."""
    rules = copy.deepcopy(RULES_V1)
    rules["version"] = 3
    needs = {"heron-name": ["heron-mail"], "heron-hint": ["heron-name"], "kestrel-author": ["kestrel-mail"]}
    for agent in rules["agents"]:
        for signal in agent["signals"]:
            if signal["id"] in needs:
                signal["requires"] = needs[signal["id"]]
    return rules


RULES_V3 = _conjunctive_version()


def compiled(document: dict[str, Any] = RULES_V1) -> tuple[Rule, ...]:
    """Rules ready to unroll."""
    return compile_rules(rules_from_mapping(document))
