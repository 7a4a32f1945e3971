"""Run Python-flavoured regular expressions inside the JVM with the same results.

Rule patterns are written for Python's ``re``. Spark evaluates ``java.util.regex``, which
by default treats ``\\r`` and ``\\u0085`` as line ends and keeps ``\\s \\d \\w`` and case
folding ASCII-only. The flags ``d`` (only ``\\n`` ends a line) and ``U`` (Unicode classes)
remove those differences; what is left is a handful of spellings handled here.
"""

from __future__ import annotations

import re

# The characters Python's str.strip() and \s treat as white space. Java's
# Unicode \s lacks the four information separators, so they are always added by hand.
SEPARATORS = r"\x1c-\x1f"
WS = r"\s" + SEPARATORS
WS_CHARS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + (
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

NEVER = r"[^\s\S]"
"""A pattern that matches nothing, used when a channel has no rules."""

# How the groups begin that a linear-time engine lacks: looking around, repeating
# a named group, and conditions.
_UNPORTABLE_GROUPS = ("(?=", "(?!", "(?<=", "(?<!", "(?P=", "(?(")


def unportable(pattern: str) -> str | None:
    """The first construct a linear-time regex engine would refuse, or ``None``.

    Reads one element at a time, so an escaped backslash before a digit is not a back-reference
    and a character class holds nothing but characters.
    """
    at, in_class = 0, False
    while at < len(pattern):
        if pattern[at] == "\\":
            if not in_class and pattern[at + 1 : at + 2] in set("123456789"):
                return pattern[at : at + 2]
            at += 2
            continue
        if in_class:
            in_class = pattern[at] != "]"
        elif pattern[at] == "[":
            in_class = True
            at += pattern[at + 1 : at + 2] == "^"
            at += pattern[at + 1 : at + 2] == "]"  # a bracket right at the start is a character
        else:
            for group in _UNPORTABLE_GROUPS:
                if pattern.startswith(group, at):
                    return group
        at += 1
    return None


def own(pattern: str) -> str:
    """Flags for this package's own patterns, already written with :data:`WS`."""
    return "(?dU)" + pattern


def jvm_pattern(pattern: str, *, case_sensitive: bool = False, multiline: bool = False) -> str:
    """``pattern`` (Python syntax) as a Java pattern that finds the same text."""
    flags = "dU" + ("" if case_sensitive else "i") + ("m" if multiline else "")
    return f"(?{flags})" + _respell(pattern)


# One alternative per spelling that differs; everything else is passed through unchanged.
_TOKEN = re.compile(
    r"""(?P<named>\(\?P<(?P<name>\w+)>)
      | (?P<backref>\(\?P=(?P<ref>\w+)\))
      | (?P<wide>\\U(?P<hex>[0-9a-fA-F]{8}))
      | (?P<esc>\\.)
      | (?P<upto>\{,(?P<max>\d+)\})
      | (?P<other>.)""",
    re.VERBOSE | re.DOTALL,
)


def _respell(pattern: str) -> str:
    groups = re.compile(pattern).groupindex if "(?P=" in pattern else {}
    out: list[str] = []
    in_class = False
    class_start = 0
    for token in _TOKEN.finditer(pattern):
        text = token.group(0)
        if token["wide"]:
            out.append(r"\x{" + token["hex"].lstrip("0").rjust(1, "0") + "}")
        elif token["esc"]:
            out.append(_escape(text, in_class))
        elif in_class:
            first = token.start() == class_start or (
                token.start() == class_start + 1 and pattern[class_start] == "^"
            )
            if text == "]" and not first:
                in_class = False
                out.append("]")
            else:
                # '[' and '&&' are set operators in Java classes, and a leading ']' closes.
                out.append("\\" + text if text in "[&" or (text == "]" and first) else text)
        elif token["named"]:
            out.append("(")
        elif token["backref"]:
            out.append("\\" + str(groups[token["ref"]]))
        elif token["upto"]:
            out.append("{0," + token["max"] + "}")
        else:
            if text == "[":
                in_class, class_start = True, token.end()
            out.append(text)
    return "".join(out)


def _escape(text: str, in_class: bool) -> str:
    if text == r"\s":
        return WS if in_class else f"[{WS}]"
    if text == r"\S" and not in_class:
        return f"[^{WS}]"
    return r"\z" if text == r"\Z" else text
