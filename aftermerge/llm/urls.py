"""URL filter: rules first, then naive Bayes over segmented hosts and path tokens.

A host's labels are cut into words by unigram Viterbi: word counts come from the text of all
pages, and only the substrings of hosts, at lengths that words have, are looked up in them, by a
join. Multinomial naive Bayes is trained on the pages that rules decide and on a small lexicon; its
counts are kept in a hashed table of fixed size. What rules are made of is no token: the top-level
label and the words of the rules' paths, which would only teach where the rules hold. A host counts
a word once for either kind, however many pages it has, and hosts are dealt into folds, each judged
by what the other folds teach: that a rule blocks a part of a site says nothing about its other
pages. Only odds beyond ``ODDS`` to one block. ``held_out`` tells how the pages that rules decide
would be judged without them.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule and no
tokens, and is allowed; ties go to allow; repeated rows are judged each; empty pages give an
empty result; without any decided page the lexicon alone decides; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aftermerge.llm.common import once, stage
from aftermerge.operators.joins import lookup_join

#: Buckets of the table of token counts.
BUCKETS = 1 << 16
#: Runs of anything but letters, of any script, end a word.
NO_LETTERS = "[^\\p{L}]+"

#: Words of host names that tell unwanted from wanted sites, a prior for the classes.
BLOCK_WORDS = ("adult", "bet", "casino", "cheap", "free", "loan", "pills", "poker", "porn", "spam", "viagra", "xxx")
ALLOW_WORDS = ("archive", "blog", "docs", "edu", "forum", "journal", "library", "m", "news", "wiki", "www")
PSEUDO_COUNT = 20

#: Parts that hosts are dealt into.
FOLDS = 5
#: Odds of block against allow that a page needs to be blocked without a rule.
ODDS = 5


@dataclass(frozen=True)
class Rule:
    """``where``: a host and the start of a path, like ``example.net/en/``."""

    verdict: str
    where: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.where.partition("/")
        inside = (host == name) | host.endswith("." + name)
        return inside & path.startswith(slash + rest)


#: The rules of the contract.
RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)


def _parts(url: Column) -> Column:
    """Host and path of a URL."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    small = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.struct(small.alias("host"), path.alias("path"))


def apply_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, and the longest fitting rule with its verdict (null: none)."""
    split = once(pages.select("page_id", "url"), _parts(F.col("url")))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.where), r.where)):
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, r.where).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("decided"))


def word_counts(pages: DataFrame) -> DataFrame:
    """Words of letters in the pages' text, mark-up left out, with their counts."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "(?s)<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, NO_LETTERS)).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _pieces(host: Column) -> Column:
    """Runs of letters in the labels of a host before the last label."""
    labels = F.split(F.lower(host), "\\.")
    named = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0)))
    return F.filter(F.split(F.array_join(named, "."), NO_LETTERS), lambda p: p != "")


def viterbi(piece: str, words: Sequence[tuple[int, int, int]], total: int) -> list[str]:
    """The most likely split of ``piece``; ``words``: (start, length, count) of its known substrings.

    An unknown stretch costs as a word of its length that is rarer than any seen. Of equally
    likely splits the one with the longer last word wins. The time is that of the piece's length
    and its known words.
    """
    scale, letter = math.log(max(total, 1) + 1), math.log(10)
    known: dict[int, list[tuple[int, float]]] = {}
    for start, k, n in words:
        known.setdefault(start + k, []).append((start, scale - math.log(n)))
    best: list[tuple[float, int]] = [(0.0, 0)]
    # The cheapest begin of an unknown stretch, with what its letters before the end save.
    unknown = (0.0, 0)
    for end in range(1, len(piece) + 1):
        choices = [(unknown[0] + scale + letter * end, unknown[1])]
        choices += [(best[start][0] + cost, start) for start, cost in known.get(end, ())]
        best.append(min(choices))
        unknown = min(unknown, (best[end][0] - letter * end, end))
    out, end = [], len(piece)
    while end:
        start = best[end][1]
        out.append(piece[start:end])
        end = start
    return out[::-1]


def segment_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """Per distinct host the words of its labels in order: columns ``host`` and ``words``.

    ``counts`` is read several times: give it a stored table.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    # As many rows as words have different lengths.
    lengths = [r["k"] for r in counts.select(F.length("word").alias("k")).distinct().collect()]
    pieces = hosts.select("host", F.posexplode(_pieces(F.col("host"))).alias("pos", "piece"))
    at = F.array(*map(F.lit, sorted(lengths))).cast("array<int>")
    parts = (
        pieces.select("piece")
        .distinct()
        .select("piece", F.explode(at).alias("k"))
        .where(F.col("k") <= F.length("piece"))
        .select("piece", "k", F.explode(F.sequence(F.lit(1), F.length("piece") - F.col("k") + 1)).alias("s"))
        .withColumn("word", F.substring("piece", F.col("s"), F.col("k")))
    )
    found = F.struct((F.col("s") - 1).alias("s"), "k", "n")
    met = parts.join(counts, "word").groupBy("piece").agg(F.sort_array(F.collect_list(found)).alias("known"))
    none = F.array().cast("array<struct<s: int, k: int, n: bigint>>")
    every = pieces.select("piece").distinct().join(met, "piece", "left")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [
                viterbi(piece, [(w["s"], w["k"], w["n"]) for w in known], total)
                for piece, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["piece", "cut"]
            )

    split = every.select("piece", F.coalesce("known", none).alias("known")).mapInArrow(
        cut, "piece string, cut array<string>"
    )
    in_order = F.sort_array(F.collect_list(F.struct("pos", "cut")))
    return pieces.join(split, "piece").groupBy("host").agg(
        F.flatten(F.transform(in_order, lambda x: x["cut"])).alias("words")
    )


def _path_tokens(path: Column, rules: Sequence[Rule]) -> Column:
    """Lower-case letters and digits in runs; a number is just a number. The rules' words are none."""
    runs = F.split(F.lower(path), "[^\\p{L}\\p{N}]+")
    own = {t for r in rules for t in re.split("[\\W_]+", r.where.partition("/")[2].lower())} | {""}
    kept = F.filter(runs, lambda t: ~t.isin(sorted(own)))
    return F.transform(kept, lambda t: F.when(t.rlike("^\\d+$"), F.lit("0")).otherwise(t))


def _buckets(tokens: Column, kind: str) -> Column:
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(F.lit(kind), t), F.lit(BUCKETS)).cast("int"))


def tokenised(judged: DataFrame, counts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``judged`` with its tokens as buckets: the words of its host and those of its path."""
    segmented = segment_hosts(judged.select("host").distinct(), counts)
    hosts = stage(segmented.select("host", _buckets(F.col("words"), "host").alias("words")), "hosts")
    # A third of all pages may lie on one host.
    joined = lookup_join(judged, hosts, ["host"], "left")
    none = F.array().cast("array<int>")
    return joined.select(
        "page_id",
        "host",
        "path",
        "rule",
        "decided",
        F.concat(F.coalesce("words", none), _buckets(_path_tokens(F.col("path"), rules), "path")).alias("tokens"),
    )


def _lexicon(spark: SparkSession) -> list[np.ndarray]:
    """The buckets of the words that tell wanted (first) and unwanted hosts."""
    columns = [_buckets(F.array(*map(F.lit, w)), "host") for w in (ALLOW_WORDS, BLOCK_WORDS)]
    return [np.array(x) for x in spark.range(1).select(*columns).first()]


def log_odds(seen: np.ndarray, lexicon: Sequence[np.ndarray]) -> np.ndarray:
    """The log odds (block against allow) of each bucket, from counts by class and bucket."""
    seen = seen.astype(float)
    # The lexicon weighs as a share of what was learnt, so that it counts at every size.
    weight = max(PSEUDO_COUNT, 0.02 * seen.sum() / len(BLOCK_WORDS))
    for y, buckets in enumerate(lexicon):
        np.add.at(seen[y], buckets, weight)
    share = np.log((seen + 0.5) / (seen.sum(1, keepdims=True) + 0.5 * BUCKETS))
    return share[1] - share[0]


def fold_of(host: str = "host") -> Column:
    return F.pmod(F.xxhash64(host, F.lit(11)), F.lit(FOLDS)).cast("int")


def train(rows: DataFrame) -> np.ndarray:
    """For each fold of hosts the log odds (block against allow) of each bucket, from other folds."""
    counted = (
        rows.where("decided IS NOT NULL")
        .select("host", (F.col("decided") == "block").cast("int").alias("y"), F.explode("tokens").alias("b"))
        .distinct()
        .groupBy(fold_of().alias("f"), "y", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .toArrow()  # at most a row per fold, class and bucket
    )
    seen = np.zeros((FOLDS, 2, BUCKETS))
    np.add.at(seen, tuple(counted[c].to_numpy() for c in ("f", "y", "b")), counted["n"].to_numpy())
    lexicon = _lexicon(rows.sparkSession)
    return np.stack([log_odds(seen.sum(0) - own, lexicon) for own in seen])


def _scores(lists: pa.ListArray, fold: np.ndarray, odds: np.ndarray) -> np.ndarray:
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    flat = odds[np.repeat(fold, lengths), lists.flatten().to_numpy(zero_copy_only=False).astype(int)]
    ends = np.append(0, np.cumsum(lengths))
    sums = np.append(0.0, np.cumsum(flat))
    return sums[ends[1:]] - sums[ends[:-1]]


def scored(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, what a rule decided, and the classifier's log odds."""
    counts = stage(word_counts(pages), "page-words")
    rows = stage(tokenised(apply_rules(pages, rules), counts, rules), "urls")
    shared = pages.sparkSession.sparkContext.broadcast(train(rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = _scores(batch.column(6), batch.column(5).to_numpy(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(odds)], names=[*names, "log_odds"])

    names = ["page_id", "host", "path", "rule", "decided"]
    return rows.select(*names, fold_of().alias("fold"), "tokens").mapInArrow(
        run, "page_id long, host string, path string, rule string, decided string, log_odds double"
    )


def _blocks() -> Column:
    return F.col("log_odds") > math.log(ODDS)


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict (a rule's or the classifier's) and log odds."""
    own = F.when(_blocks(), "block").otherwise("allow")
    return scored(pages, rules).select(
        "page_id", "host", "path", "rule", F.coalesce("decided", own).alias("verdict"), "log_odds"
    )


def held_out(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """How the classifier, which never saw a page's own host, judges the pages that rules decide.

    Per verdict of the rules: ``pages``, and how many it would have judged alike (``right``).
    """
    right = (F.col("decided") == "block") == _blocks()
    told = scored(pages, rules).where("decided IS NOT NULL")
    return told.groupBy("decided").agg(F.count(F.lit(1)).alias("pages"), F.count_if(right).alias("right"))
