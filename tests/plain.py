"""Plain-Python statements of the text rules, used as a second opinion in tests."""

from __future__ import annotations

import re

KEY_LINE = re.compile(r"([A-Za-z0-9][A-Za-z0-9-]*)\s*:\s*(.*)")
PICKED = re.compile(r"\(cherry picked from commit [0-9a-fA-F]{7,64}\)")


def unix(message: str) -> str:
    return re.sub(r"\r\n?", "\n", message).rstrip()


def subject(message: str) -> str:
    return unix(message).lstrip().partition("\n")[0].strip()


def trailers(message: str) -> list[tuple[str, str]]:
    text = unix(message)
    gaps = list(re.finditer(r"\n\s*\n", text))
    if not gaps:
        return []
    lines = [x for x in text[gaps[-1].end() :].split("\n") if not PICKED.fullmatch(x)]
    kinds = "".join("f" if x[:1].isspace() else "k" if KEY_LINE.fullmatch(x) else "?" for x in lines)
    if not re.fullmatch(r"(?:kf*)*", kinds):
        return []
    found = []
    for run in re.finditer(r"kf*", kinds):
        first, *folds = lines[run.start() : run.end()]
        key, value = KEY_LINE.fullmatch(first).groups()
        found.append((key, " ".join(x.strip() for x in [value, *folds]).strip()))
    return found

