from __future__ import annotations

import random

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aftermerge.functions import identity, text
from aftermerge.functions.patterns import WS_CHARS, jvm_pattern, unportable
from tests import plain

SIGNED = "Signed-Off-By: Ada <ada@example.com>"


def parse(spark: SparkSession, messages: list[str | None]) -> list[dict]:
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i int, m string")
    rows = df.select(
        "i",
        text.subject("m").alias("subject"),
        text.trailers("m").alias("trailers"),
        text.revert("m").alias("undo"),
    ).collect()
    return [r.asDict(recursive=True) for r in sorted(rows, key=lambda r: r["i"])]


CASES: list[tuple[str, list[tuple[str, str]]]] = [
    (f"Title\n\nText.\n\n{SIGNED}\n", [("Signed-Off-By", "Ada <ada@example.com>")]),
    (SIGNED, []),
    (f"Title\r\n\r\n{SIGNED}\r\n", [("Signed-Off-By", "Ada <ada@example.com>")]),
    (f"Title\r\r{SIGNED}", [("Signed-Off-By", "Ada <ada@example.com>")]),
    ("T\n\nA: one\n  two\n\tthree \nB: x", [("A", "one two three"), ("B", "x")]),
    ("T\n\nA:\n  late", [("A", "late")]),
    (f"T\n\n{SIGNED}\n(cherry picked from commit 0123abc)", [("Signed-Off-By", "Ada <ada@example.com>")]),
    ("T\n\nA: x\n(cherry picked from commit 0123abc)\n  tail", [("A", "x tail")]),
    ("T\n\n(cherry picked from commit 0123abc)", []),
    ("T\n\n(cherry picked from commit 0123abc)\n  x\nA: b", []),
    (f"T\n\n{SIGNED}\nThanks all.", []),
    ("T\n\n  indented: no", []),
    ("T\n\nNote: a sentence: with colons", [("Note", "a sentence: with colons")]),
    ("T\n\nX-2-y : spaced", [("X-2-y", "spaced")]),
    ("T\n\n-bad: key", []),
    ("\n\nA: first paragraph is empty", [("A", "first paragraph is empty")]),
    ("T\n \t\n \nA: b", [("A", "b")]),
    ("T\n\nA: b c ", [("A", "b c")]),
    ("T\n\nA:\x1cb\x1f", [("A", "b")]),
    ("", []),
    ("  \r\n ", []),
]


def test_trailer_cases(spark: SparkSession) -> None:
    for (message, expected), row in zip(CASES, parse(spark, [m for m, _ in CASES]), strict=True):
        assert [(t["key"], t["value"]) for t in row["trailers"]] == expected, repr(message)
        assert plain.trailers(message) == expected, repr(message)


def test_null_message(spark: SparkSession) -> None:
    assert parse(spark, [None])[0] == {"i": 0, "subject": None, "trailers": None, "undo": None}


SHA = "ab12" * 10
UNDO: list[tuple[str, tuple | None]] = [
    (f'Revert "Cache it"\n\nThis reverts commit {SHA}.', (False, "Cache it", SHA, None, None)),
    (f'Revert "Cache it (#7)" (#9)\n\nThis reverts commit {SHA}.', (False, "Cache it (#7)", SHA, 7, 9)),
    ('Revert "Cache it (#7)"\n\nReverts o/r.x#8\n', (False, "Cache it (#7)", None, 8, None)),
    ('Revert "C"\n\nReverts #8', (False, "C", None, 8, None)),
    ('Reapply "C" (#4)\n\nThis reverts commit AB12AB12.', (True, "C", "ab12ab12", None, 4)),
    ('  \nRevert  "long\ntitle"\n\nx', (False, "long title", None, None, None)),
    ('Revert "say "hi" twice"', (False, 'say "hi" twice', None, None, None)),
    ('Revert "open', None),
    ("revert the cache", None),
    ('Fix: Revert "x"', None),
    (f"Oops\n\nThis reverts commit {SHA}.", None),
    ('Revert "C"\n\nThis reverts commit ab12ab.', (False, "C", None, None, None)),
    ('Revert "C (#99999999999999999999)"', (False, "C (#99999999999999999999)", None, None, None)),
    ("", None),
    ('Revert "A"\r\n\r\nThis reverts commit abcdef0.', (False, "A", "abcdef0", None, None)),
    ('Revert "A"\n \t\nReverts  x-y/z_z#12  \nReverts #13', (False, "A", None, 12, None)),
    ('Revert "A (#3) b"\n\nThis reverts commit 1234567 and This reverts commit 7654321', (False, "A (#3) b", "1234567", None, None)),
    ('Reapply "Revert "A (#3)""', (True, 'Revert "A (#3)"', None, None, None)),
    ('Revert " A " (#1)\n\nReverts a b#5', (False, "A", None, None, 1)),
    ('Revert "A" (#1) (#2)', None),
    ('Revert "A" x', None),
    ('Revert"A"', None),
    ("Revert \"A\"\nThis reverts commit abcdef0.", None),
]


def as_tuple(undo: dict | None) -> tuple | None:
    return None if undo is None else tuple(undo.values())


def test_undo_cases(spark: SparkSession) -> None:
    for (message, expected), row in zip(UNDO, parse(spark, [m for m, _ in UNDO]), strict=True):
        assert as_tuple(row["undo"]) == expected, repr(message)


def test_random_messages_agree_with_plain_python(spark: SparkSession) -> None:
    """Thousands of strings over the characters that matter, parsed both ways."""
    rng = random.Random(7)
    pieces = [*"ab:-<> \t\r\n\"#()", "\n\n", "\r\n", "\x1c", "\x85", "　", "Key: v\n", "K-1:", "\n  fold",
              'Revert "', 'Reapply "', '" (#12)', "(#3)", "\n\nThis reverts commit abcdef0123", "\nReverts a/b#5",
              "\n(cherry picked from commit abcdef0)"]
    messages = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(4000)]
    messages += [start + m for start in ('Revert "x', "T\n\nA: b\n", 'Reapply "y"\n\n') for m in messages[:800]]
    for message, row in zip(messages, parse(spark, messages), strict=True):
        assert row["subject"] == plain.subject(message), repr(message)
        assert [(t["key"], t["value"]) for t in row["trailers"]] == plain.trailers(message), repr(message)


def test_long_messages_are_parsed_whole(spark: SparkSession) -> None:
    many = "T\n\n" + "\n".join(f"K{i}: v{i}" for i in range(20_000))
    spaces = "T" + " " * 300_000 + "x\n\nA: b"
    rows = parse(spark, [many, spaces])
    assert [t["value"] for t in rows[0]["trailers"]] == [f"v{i}" for i in range(20_000)]
    assert rows[1]["trailers"] == [{"key": "A", "value": "b"}]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("Ada <ada@example.com>", ("Ada", "ada@example.com")),
        ("  Ada L.  < ada@example.com > ", ("Ada L.", "ada@example.com")),
        ("<bot@example.com>", ("", "bot@example.com")),
        ("a <b> <c@d>", ("a <b>", "c@d")),
        ("Ada", None),
        ("a <b> c", None),
        ("<>", None),
        ("", None),
    ],
)
def test_person(spark: SparkSession, value: str, expected: tuple | None) -> None:
    row = spark.createDataFrame([(value,)], "v string").select(text.person("v").alias("p")).first()
    assert (None if row["p"] is None else tuple(row["p"])) == expected


def test_trailer_values_ignore_case_and_keep_order(spark: SparkSession) -> None:
    df = spark.createDataFrame([("T\n\nA: 1\nb: 2\na: 3",)], "m string")
    assert df.select(text.trailer_values("m", "A").alias("v")).first()["v"] == ["1", "3"]


def test_white_space_is_pythons() -> None:
    assert sorted(WS_CHARS) == sorted(c for c in map(chr, range(0x110000)) if c.isspace())


PATTERNS = [
    (r"^a\sb$", "a\x1cb", True), (r"^a.b$", "a\rb", True), (r"^a$", "a\r", False), (r"^a$", "a\n", True),
    (r"a\Z", "a\n", False), (r"(?P<x>a)(?P=x)", "aa", True), (r"[[a]b", "ab", True), (r"[a&&b]", "&", True),
    (r"[]x]", "]", True), (r"[^]x]", "]", False), (r"^\d$", "٣", True), (r"STRASSE", "strasse", True),
    (r"é", "É", True), (r"a{,2}b", "aab", True), (r"\[bot\]$", "x[bot]", True), (r"[\s]", "\x1f", True),
]


@pytest.mark.parametrize(("pattern", "subject", "expected"), PATTERNS)
def test_patterns_mean_the_same_in_the_jvm(spark: SparkSession, pattern: str, subject: str, expected: bool) -> None:
    import re

    assert bool(re.search(pattern, subject, re.I)) is expected
    df = spark.createDataFrame([(subject,)], "s string")
    assert df.select(F.col("s").rlike(jvm_pattern(pattern))).first()[0] is expected


def test_case_sensitive_patterns(spark: SparkSession) -> None:
    df = spark.createDataFrame([("BOT",)], "s string")
    exact, loose = jvm_pattern("bot", case_sensitive=True), jvm_pattern("bot")
    assert df.select(F.col("s").rlike(exact), F.col("s").rlike(loose)).first()[:] == (False, True)


@pytest.mark.parametrize("bad", ["(?=x)", "(?!x)", "(?<=x)", "(?<!x)", r"(a)\1", "(?P<n>a)(?P=n)", "(a)?(?(1)b|c)"])
def test_unportable(bad: str) -> None:
    assert unportable(bad)
    assert unportable(r"(?i)a\d+(?P<n>x)[^\s]") is None


def test_identity(spark: SparkSession) -> None:
    import hashlib

    values = ["Ada@Example.com", "  ada@example.com ", "", None, "   ", "Äda"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(identity.hash_identity("v")).collect()]

    def plain_hash(v: str | None) -> str | None:
        return hashlib.sha256(v.strip().lower().encode()).hexdigest()[:16] if v else None

    assert got == [plain_hash(v) for v in values]
    assert got[0] == got[1]


def test_sample_key(spark: SparkSession) -> None:
    import hashlib

    repos = [f"o{i}/R{i * 7}" for i in range(3000)] + ["octo/repo", " Octo/Repo ", "é/ß"]
    df = spark.createDataFrame([(r,) for r in repos], "r string")
    rows = df.select("r", identity.sample_key("r").alias("k"), identity.in_sample("r", 0.1).alias("s")).collect()
    for row in rows:
        digest = hashlib.sha256(row["r"].strip().lower().encode()).digest()
        assert row["k"] == int.from_bytes(digest[:8], "big") % 10_000
        assert row["s"] == (row["k"] < 1000)
    assert {r["k"] for r in rows if r["r"].strip().lower() == "octo/repo"} == {9427}
    assert 0.08 < sum(r["s"] for r in rows) / len(rows) < 0.12


@pytest.mark.parametrize("rate", [-0.01, 1.01])
def test_bad_rates(rate: float) -> None:
    with pytest.raises(ValueError, match="between 0 and 1"):
        identity.sample_threshold(rate)


def test_formats(spark: SparkSession) -> None:
    shas = ["0" * 40, "F" * 40, "0" * 39, "0" * 41, "g" * 40, "0" * 40 + "\n", None]
    repos = ["a/b", "A-b/c.d_e-f", "a-/x", "-a/b", "a/b/c", "a/", "/b", "a b/c", "a/b\n"]
    s = spark.createDataFrame([(v,) for v in shas], "v string").select(identity.valid_sha("v")).collect()
    r = spark.createDataFrame([(v,) for v in repos], "v string").select(identity.valid_repo("v")).collect()
    assert [x[0] for x in s] == [True, True, False, False, False, False, False]
    assert [x[0] for x in r] == [True, True, True] + [False] * 6
