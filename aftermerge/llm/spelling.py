"""Spelling variants of a corpus's words by dense prefix-suffix tiling.

Two words are near if one code point inserted, deleted or replaced makes them equal. With ``p``
code points of common prefix, ``s`` of common suffix and ``size`` the longer length, that is so
exactly if ``p + s >= size - 1``. So one of the two reaches half of that, and words are
dealt into groups by their first or last half, once for each size they can be compared at. Within
the groups, words lie as rows of padded code-point matrices, one aligned left and one right, and
blocks of rows are compared with blocks of rows, column by column, to read off ``p`` and ``s``.

A pair counts in one group only: a group takes the pairs whose ``p`` lies in its range. Groups of
more than ``HOT`` words are dealt anew by prefix *and* suffix for every ``p`` of their range;
such a group holds no more words than the alphabet has letters, so no group is large and no rows
are multiplied by a group's size.

Defined cases: null and empty texts have no words; a null doc_id reads as no characters before the
colon of a slip's hash; repeated rows count each; ties go to the smallest word in code-point
order; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aftermerge.llm.common import as_bytes, by_group, mix, slices, stage

#: A word has at least so many code points and occurs at least so often ...
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: ... and takes the form of a near word that occurs at least so many times as often.
TIMES = 5
#: One run in so many loses a code point (the made slips of the query).
SLIP = 199

#: Words a task counts before it hands its counts on.
COUNTED = 300_000
#: Words of a group up to which it is compared as it is.
HOT = 2048
#: Rows of a tile, and its cells at most.
ROWS = 128
CELLS = 1 << 22

POSTED = "key long, size int, low int, high int, word string, n long"


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, slip: int = 0) -> DataFrame:
    """How often each word of at least ``least_length`` code points occurs: ``word``, ``n``.

    A word is a whole run of ``[A-Za-z\\u00C0-\\u00FF]``, with A-Z in lower case. With ``slip``, let
    h be the crc32 of ``<doc_id>:<word>``; where ``slip`` divides h, the word's code point
    h % length is deleted.
    """
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                if not text:
                    continue
                found = Counter(runs.findall(text.lower().decode("utf-8", "replace")))
                if slip:
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for word, n in [*found.items()]:
                        h = zlib.crc32(word.encode(), start)
                        if not h % slip:
                            at = h % len(word)
                            del found[word]
                            total[word[:at] + word[at + 1 :]] += n
                total.update(found)
            if len(total) >= COUNTED:
                yield _counts(total)
                total = Counter()
        yield _counts(total)

    parts = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    summed = parts.groupBy("word").agg(F.sum("n").alias("n"))
    return summed.where(F.length("word") >= least_length)


def _counts(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"]
    )


class _Hashes:
    """Hashes of parts of the words of a batch, read off prefix sums."""

    _BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, words: list[str]) -> None:
        data = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in words]
        self.length = np.array([len(d) for d in data], np.int64)
        self.start = np.cumsum(self.length) - self.length
        flat = np.concatenate([*data, np.empty(0, "<u4")]).astype(np.uint64) + np.uint64(1)
        n = len(flat)
        up, down = (np.full(n + 1, base, np.uint64) for base in (self._BASE, pow(self._BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        up, self.down = np.cumprod(up), np.cumprod(down)
        self.sums = np.append(np.uint64(0), np.cumsum(flat * up[:n]))

    def part(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of code points ``low`` up to ``high`` of each word."""
        low, high = self.start[word] + low, self.start[word] + high
        return mix((self.sums[high] - self.sums[low]) * self.down[low])


def _key(size: np.ndarray, side: int, *parts: np.ndarray) -> np.ndarray:
    key = mix(size.astype(np.uint64) * np.uint64(4) + np.uint64(side))
    for part in parts:
        key = mix(key * np.uint64(31) + part)
    return key.view(np.int64)


def _posted(batch: pa.RecordBatch, at: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    rows = pa.array(at)
    key, *numbers = columns
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key),
            *(pa.array(c.astype(np.int32)) for c in numbers),
            batch.column("word").take(rows),
            batch.column("n").take(rows),
        ],
        names=["key", "size", "low", "high", "word", "n"],
    )


def half_postings(words: DataFrame) -> DataFrame:
    """A row per word and group by half: four for each word."""

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            hashes = _Hashes(batch.column("word").to_pylist())
            at, zero = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for longer in (0, 1):  # as the longer word of a pair, and as the shorter one
                size = hashes.length + longer
                half = size // 2
                yield _posted(
                    batch, at, _key(size, 0, hashes.part(at, zero, half)), size, half, size - 1
                )
                tail = hashes.part(at, hashes.length - (size - half), hashes.length)
                yield _posted(batch, at, _key(size, 1, tail), size, zero, half - 1)

    return words.select("word", "n").mapInArrow(post, POSTED)


def exact_postings(postings: DataFrame) -> DataFrame:
    """The postings dealt anew: a row per possible length of the common prefix."""

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            hashes = _Hashes(batch.column("word").to_pylist())
            size, low, high = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "low", "high"))
            count = high - low + 1
            total = np.cumsum(count)
            for some in np.split(np.arange(len(size)), np.searchsorted(total, np.arange(1 << 18, total[-1] + 1, 1 << 18))):
                at = np.repeat(some, count[some])
                p = low[at] + np.arange(len(at)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
                length = hashes.length[at]
                head = hashes.part(at, np.zeros_like(p), p)
                tail = hashes.part(at, length - (size[at] - 1 - p), length)
                key = _key(size[at], 2, p.astype(np.uint64), head, tail)
                yield _posted(batch, at, key, size[at], p, p)

    return postings.mapInArrow(post, POSTED)


class Tiles:
    """The words of whole groups as padded matrices, and for each its near words."""

    def __init__(self, table: pa.Table) -> None:
        # Words of like size lie together, so that little is padded.
        order = pc.sort_indices(table, [("size", "ascending"), ("key", "ascending")])
        self.table = table = table.take(order).combine_chunks()
        self.key, self.size, self.low, self.high = (
            table[c].to_numpy() for c in ("key", "size", "low", "high")
        )
        self.words = [w.encode("utf-32-le") for w in table["word"].to_pylist()]
        self.length = np.array([len(w) // 4 for w in self.words])
        n = table.num_rows
        first = pc.sort_indices(table, [("n", "descending"), ("word", "ascending")]).to_numpy()
        self.rank = np.empty(n, np.int64)
        self.rank[first] = np.arange(n)
        self.by_rank = first
        self.near = np.zeros(n, np.int64)
        self.best = np.full(n, n, np.int64)

    def matrices(self, low: int, high: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Code points of words ``low`` to ``high``, aligned left and aligned right, 0 beyond."""
        wide = 4 * width
        out = []
        for pad in (bytes.ljust, bytes.rjust):
            flat = b"".join(pad(w, wide, b"\0") for w in self.words[low:high])
            out.append(np.frombuffer(flat, "<u4").reshape(high - low, width).T.copy())
        return out[0], out[1][::-1]

    @staticmethod
    def common(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many leading columns every row of ``one`` shares with every row of ``two``."""
        alive = np.ones((one.shape[1], two.shape[1]), bool)
        out = np.zeros(alive.shape, np.int32)
        for x, y in zip(one, two, strict=True):
            alive &= x[:, None] == y[None, :]
            if not alive.any():
                break
            out += alive
        return out

    def compare(self, a: slice, b: slice, left: list, right: list) -> None:
        """Read off the near pairs of two blocks."""
        p, s = self.common(left[0], right[0]), self.common(left[1], right[1])
        size = self.size[a][:, None]
        p = np.minimum(p, size - 1)
        near = p + s >= size - 1
        near &= (self.key[a][:, None] == self.key[b][None, :]) & (size == self.size[b][None, :])
        near &= (p >= self.low[a][:, None]) & (p <= self.high[a][:, None])
        # Of two words that are both shorter than the group's size, another group decides.
        near &= (self.length[a] == self.size[a])[:, None] | (self.length[b] == self.size[b])[None, :]
        if a == b:
            np.fill_diagonal(near, False)
        n = len(self.key)
        for block, other, hits in ((a, b, near), (b, a, near.T)):
            self.near[block] += hits.sum(1)
            best = np.where(hits, self.rank[other][None, :], n).min(1)
            self.best[block] = np.minimum(self.best[block], best)
            if a == b:
                break

    def run(self) -> pa.RecordBatch:
        n = len(self.key)
        cuts = [0]
        while cuts[-1] < n:
            rows = max(1, min(ROWS, CELLS // int(self.length[cuts[-1] : cuts[-1] + ROWS].max())))
            cuts.append(min(n, cuts[-1] + rows))
        for x, low in enumerate(cuts[:-1]):
            high = cuts[x + 1]
            for y in range(x, len(cuts) - 1):
                # Groups lie together: later blocks matter while the last group reaches into them.
                if y > x and self.key[cuts[y]] != self.key[high - 1]:
                    break
                width = int(max(self.length[low:high].max(), self.length[cuts[y] : cuts[y + 1]].max()))
                one = self.matrices(low, high, width)
                two = one if y == x else self.matrices(cuts[y], cuts[y + 1], width)
                self.compare(slice(low, high), slice(cuts[y], cuts[y + 1]), one, two)
        hit = np.flatnonzero(self.near)
        best = pa.array(self.by_rank[self.best[hit]])
        return pa.RecordBatch.from_arrays(
            [
                self.table["word"].combine_chunks().take(pa.array(hit)),
                pa.array(self.near[hit]),
                self.table["n"].combine_chunks().take(best),
                self.table["word"].combine_chunks().take(best),
            ],
            names=["word", "near", "best_n", "best"],
        )


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """Per word with near words their number ``n_near``, and the most frequent one (``best_n``,
    ``best``; of equally frequent ones the smallest). ``words``: distinct ``word`` with ``n``."""

    def tile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, "key"):
            yield Tiles(table).run()

    postings = half_postings(words)
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("words"))
    large = stage(sizes.where(F.col("words") > hot).select("key"), "hot-halves")
    dealt = postings.join(large, "key", "left_anti").unionByName(
        exact_postings(postings.join(large, "key", "left_semi"))
    )
    found = (
        dealt.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(tile, "word string, near long, best_n long, best string")
    )
    most = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("n_near"), most.alias("most"))
        .select("word", "n_near", (-F.col("most.n")).alias("best_n"), F.col("most.word").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """Where each word's forms end: ``word``, ``root``. ``forms``: ``word`` and ``form``, not null.

    Every round doubles how far a word has got; a form occurs several times as often as its word,
    so the longest way, and with it the rounds, grows with the logarithm of the counts.
    """
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = stage(moved, "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def spelling_groups(
    words: DataFrame, least_count: int = LEAST_COUNT, times: int = TIMES, hot: int = HOT
) -> DataFrame:
    """One row per word that occurs at least ``least_count`` times: its form, root and counts."""
    kept = stage(words.where(F.col("n") >= least_count), "words")
    formed = F.col("best_n") >= times * F.col("n")
    near = stage(
        kept.join(near_words(kept, hot), "word", "left").select(
            "word",
            F.when(formed, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "near-words",
    )
    ends = roots(near.where("form IS NOT NULL").select("word", "form"))
    return near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
