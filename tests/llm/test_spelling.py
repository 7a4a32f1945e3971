"""Spelling variants against all pairs, with and without large groups."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import SparkSession

from aftermerge.llm import spelling
from aftermerge.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def near(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(x != y for x, y in zip(u, v, strict=True)) == 1
    return len(u) + 1 == len(v) and any(u == v[:i] + v[i + 1 :] for i in range(len(v)))


def expected(n: dict[str, int]) -> dict[str, tuple]:
    words = sorted(n)
    found = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(found[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(found[w]), n[form[w]] if w in form else None)
    return out


def result(df) -> dict[str, tuple]:
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize(("hot", "rows", "cells"), [(2048, 128, 1 << 22), (3, 7, 40)])
@pytest.mark.parametrize(
    ("alphabet", "lengths", "many"),
    [("ab", range(6, 10), 300), ("abcé", (6, 7), 400), ("a", range(6, 200), 150), ("ab", (6, 40, 41), 60)],
)
def test_forms_match_all_pairs(
    spark: SparkSession, monkeypatch: pytest.MonkeyPatch, alphabet: str, lengths, many: int, hot: int, rows: int, cells: int
) -> None:
    rng = random.Random(3)
    n = {"".join(rng.choices(alphabet, k=rng.choice(lengths))): int(5 * 5 ** rng.uniform(0, 5)) for _ in range(many)}
    for word in [*n][:20]:  # ways of several forms, and ties
        n[word + "z"] = 5
        n["z" + word] = 5
    monkeypatch.setattr(spelling, "ROWS", rows)
    monkeypatch.setattr(spelling, "CELLS", cells)
    words = spark.createDataFrame([*n.items()], "word string, n long").repartition(3)
    assert result(spelling.spelling_groups(words, hot=hot)) == expected(n)


def test_refined_groups_stay_small(spark: SparkSession) -> None:
    """A thousand words with one half in common: dealt anew, no group holds more than the alphabet."""
    letters = "abcdefghij"
    words = [("common" + x + y + z, 5) for x in letters for y in letters for z in letters]
    df = spark.createDataFrame(words, "word string, n long")
    postings = spelling.half_postings(df)
    assert postings.groupBy("key").count().agg({"count": "max"}).first()[0] == 1000
    exact = spelling.exact_postings(postings)
    assert exact.groupBy("key").count().agg({"count": "max"}).first()[0] == len(letters)
    assert result(spelling.spelling_groups(df, hot=16)) == expected(dict(words))


def counted(rows: list[tuple], slip: int) -> Counter:
    out: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= spelling.LEAST_LENGTH:
                out[run] += 1
    return out


@pytest.mark.parametrize("slip", [0, 3, 199])
def test_words_are_counted_as_written(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, slip: int) -> None:
    rows = [
        (1, None),
        (2, ""),
        (None, "Fußgänger ÉCOLES écoles Écoles ×÷×÷×÷ don't-split under_scores"),
        (3, "letters123letters LETTERS" + "İstanbul Ÿpsilon Ārrows"),
        (3, "letters123letters LETTERS" + "İstanbul Ÿpsilon Ārrows"),
        (4, "x" * 50_000 + " " + "seldom " * 20_000),
    ]
    rows += [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(50).collect()]
    monkeypatch.setattr(spelling, "COUNTED", 100)
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = {r["word"]: r["n"] for r in spelling.count_words(df.repartition(2), slip=slip).collect()}
    assert got == counted(rows, slip)


def test_query_matches_all_pairs(spark: SparkSession) -> None:
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    n = {w: c for w, c in counted([tuple(r) for r in rows], spelling.SLIP).items() if c >= 5}
    out = QUERIES["op12_spelling_groups"](spark, SF)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(out) == expected(n)


def test_empty_table(spark: SparkSession) -> None:
    words = spelling.count_words(spark.createDataFrame([], "doc_id long, text string"), slip=199)
    assert spelling.spelling_groups(words).count() == 0
