"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A document is kept if no rule rejects it. The rules are tried in an order found on a sample: each
rule's rejections per cost, highest first. What a rule costs is estimated from the characters, words
and lines that its measures go over in the sample's texts, at the measured price of each, so the same
input always gives the same order. The order changes only the time it takes, never the verdict.

Defined cases: a null text counts as the empty text; the empty text has no words and fails the
base rule; repeated rows are judged each on its own; an empty table gives an empty result;
other columns of any name pass through ``filter_quality`` untouched and are not read by ``judge_quality``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aftermerge.llm.common import SPACES, free_name, let, once

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"


Measures = Mapping[str, Column]


@dataclass(frozen=True)
class Rule:
    """``rejects``: a condition over the measures of ``signals``; ``needs``: those it reads."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Measures], Column]


#: The base rules of the contract, then those of this operator.
BASE = (
    Rule("few_words", ("n_words",), lambda m: m["n_words"] < 50),
    Rule("repeats", ("n_repeat_words", "n_words"), lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
)
RULES = (
    Rule("symbols", ("n_symbols", "n_words"), lambda m: 10 * m["n_symbols"] > 2 * m["n_words"]),
    Rule("long_words", ("word_chars", "n_words"), lambda m: m["word_chars"] > 15 * m["n_words"]),
    Rule("short_words", ("word_chars", "n_words"), lambda m: 2 * m["word_chars"] < 3 * m["n_words"]),
    Rule("same_lines", ("n_dup_lines", "n_lines"), lambda m: 10 * m["n_dup_lines"] > 7 * m["n_lines"]),
    Rule("shouting", ("n_upper", "word_chars"), lambda m: 10 * m["n_upper"] > 5 * m["word_chars"]),
    Rule("exclaims", ("n_exclaims", "n_words"), lambda m: 10 * m["n_exclaims"] > 3 * m["n_words"]),
)


def words_of(text: Column) -> Column:
    """The words of a text in order."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def _repeats(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, the first occurrence included."""

    def covered(windows: Column) -> Column:
        return let(
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            lambda s: F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.filter(
                                s,
                                lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                                | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
                            ),
                            lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2),
                        )
                    )
                )
            ),
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    # A distinct count settles the many texts without a repeat; only the others are sorted.
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(
        let(
            windows,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
        )
    )


def _of_words(words: Column) -> dict[str, Column]:
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.concat_ws("", words)),
        "n_repeat_words": _repeats(words),
    }


def _of_lines(lines: Column) -> dict[str, Column]:
    return {
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
    }


def _of_text(text: Column) -> dict[str, Column]:
    return {
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_upper": F.length(text) - F.length(F.regexp_replace(text, "\\p{Lu}", "")),
        "n_exclaims": F.length(text) - F.length(F.translate(text, "!", "")),
    }


def signals(text: Column, wanted: Sequence[str]) -> Column:
    """A struct of the ``wanted`` measures as longs; splits happen once each."""

    def pick(measures: dict[str, Column]) -> Column:
        return F.struct(*(v.cast("long").alias(k) for k, v in measures.items() if k in wanted))

    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    parts: list[tuple[list[str], Column]] = []
    for source, of in ((words_of(whole), _of_words), (lines, _of_lines), (whole, _of_text)):
        names = [n for n in of(source) if n in wanted]
        if names:
            parts.append((names, let(source, _after(of, pick))))
    # Each group is a struct; the outer let binds it so that its fields do not repeat the work.
    return _merge(parts)


def _after(first: Callable, then: Callable) -> Callable[[Column], Column]:
    return lambda x: then(first(x))


def _merge(parts: list[tuple[list[str], Column]]) -> Column:
    def fold(i: int, fields: list[Column]) -> Column:
        if i == len(parts):
            return F.struct(*fields)
        names, group = parts[i]
        return let(group, lambda g: fold(i + 1, [*fields, *(g[n].alias(n) for n in names)]))

    return fold(0, [])


#: What a measure costs in nanoseconds: for each character, word and line of a text. Measured on one
#: core over 4,000 of the test documents; only their proportions matter.
PRICES: dict[str, tuple[float, float, float]] = {
    "n_words": (10.0, 280.0, 0.0),
    "word_chars": (10.0, 230.0, 0.0),
    "n_repeat_words": (10.0, 680.0, 0.0),
    "n_lines": (9.0, 0.0, 200.0),
    "n_dup_lines": (12.0, 0.0, 1600.0),
    "n_symbols": (47.0, 0.0, 0.0),
    "n_upper": (20.0, 0.0, 0.0),
    "n_exclaims": (35.0, 0.0, 0.0),
}
#: A comparison alone.
LEAST_PRICE = 5.0


def cascade_order(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    sample_rows: int = 1000,
    known: Sequence[str] = (),
) -> list[Rule]:
    """The rules by rejections per estimated cost on a sample of at most ``sample_rows`` rows.

    The sample tells what every rule rejects and what its measures go over; measures that are ``known`` already cost nothing. Equal ratios go by name. Only the order is
    estimated; the cascade judges every row in full.
    """
    names = sorted({n for rule in rules for n in rule.needs} | {"n_words", "n_lines"})
    measured = {n: F.col(n) for n in names}
    # Only numbers come here, from as few partitions as hold so many rows.
    rows = (
        once(docs.select("text"), signals(F.col("text"), names))
        .select(
            F.length(F.coalesce("text", F.lit(""))).alias("chars"),
            F.col("n_words").alias("words"),
            F.col("n_lines").alias("lines"),
            *(rule.rejects(measured).cast("int").alias(f"hit_{i}") for i, rule in enumerate(rules)),
        )
        .limit(sample_rows)
        .collect()
    )
    sizes = [sum(r[n] for r in rows) / max(len(rows), 1) for n in ("chars", "words", "lines")]
    scored = []
    for i, rule in enumerate(rules):
        prices = [PRICES[n] for n in rule.needs if n not in known]
        cost = LEAST_PRICE + sum(p * size for price in prices for p, size in zip(price, sizes, strict=True))
        hits = sum(r[f"hit_{i}"] for r in rows)
        scored.append(((hits + 0.5) / (len(rows) + 1) / cost, rule))
    return [rule for _, rule in sorted(scored, key=lambda x: (-x[0], x[1].name))]


def cascade(rules: Sequence[Rule], text: Column) -> Column:
    """Whether a rule rejects: each computes its own measures, and the first hit ends the row."""

    def step(rest: Sequence[Rule]) -> Column:
        if not rest:
            return F.lit(False)
        rule = rest[0]
        hit = let(signals(text, rule.needs), lambda s: rule.rejects({n: s[n] for n in rule.needs}))
        return F.when(hit, F.lit(True)).otherwise(step(rest[1:]))

    return step(list(rules))


def filter_quality(
    docs: DataFrame, rules: Sequence[Rule] = (*BASE, *RULES), sample_rows: int = 1000
) -> DataFrame:
    """The documents that no rule rejects, with their columns, in cascade order."""
    ordered = cascade_order(docs, rules, sample_rows)
    name = free_name(docs, "rejected")
    judged = once(docs, F.struct(cascade(ordered, F.col("text")).alias(name)))
    return judged.where(~F.col(name)).drop(name)


def judge_quality(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 1000
) -> DataFrame:
    """Per document the base measures, ``base_failed`` and the cascade's verdict ``kept``.

    The measures of the base are output of every row; the further rules short-circuit behind
    ``base_failed`` and among themselves. Rules over base measures reuse them.
    """
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    ordered = cascade_order(docs, rules, sample_rows, known=base)
    text = F.col("text")
    measured = once(docs.select("doc_id", "text"), signals(text, base))
    known = {n: F.col(n) for n in base}
    failed = reduce(lambda a, b: a | b, (r.rejects(known) for r in BASE))
    verdict = F.lit(True)
    for rule in reversed(ordered):
        hit = rule.rejects(known) if set(rule.needs) <= set(base) else cascade([rule], text)
        verdict = F.when(hit, F.lit(False)).otherwise(verdict)
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(verdict).alias("kept"),
    )
