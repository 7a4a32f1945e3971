"""Line dedup as an exact set-similarity join of lines.

A line is the set of its words. Lines match at a Jaccard similarity of ``THRESHOLD`` or more; a
line is removed if an earlier one, in the order of doc_id and line number, matches.

1. Words are ordered by rarity, from counts over all texts in a hashed table of fixed size; the
   order is total and the same everywhere, so the filters below are exact.
2. Equal sets: each set's first line, from a partial aggregation of narrow rows.
3. Prefix filter: a set is posted under each word of its prefix, its rarest words. Sets that meet
   under a word must pass the length filter, the positional filter and a bound from sketches.
4. Only sets with a partner left are joined to their words, and the pairs are verified. A set
   needs one earlier match, so no pair is ever a row: a task returns the lines that it removes.

The postings of every word are counted, and a word with more than a block of them is dealt into
blocks, of which every pair is a task: no posting list is held whole, and a posting of any other
word is one row.

Defined cases: lines without words are kept; a null text stays null; repeated rows (same doc_id
and text) count as one document and are treated alike; documents without doc_id come last; an
empty table gives an empty result; other columns pass through in ``doc``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aftermerge.llm.common import by_group, mix, packed, raw_text, row_key, slices, stage, word_codes

THRESHOLD = 0.8

#: Buckets of the tables of counts: a fixed 1 MB each, whatever the corpus.
BUCKETS = 1 << 17

#: Sets of a posting list that meet in one block.
BLOCK = 2048

#: Hot words that are sent to all tasks (4 MB); more are joined.
HOT_WORDS = 1 << 18

#: A posting's columns, how many a task holds before it hands them on, and the bytes that a bucket of
#: them is meant to have.
POSTING = ("task", "s1", "b0", "b1", "meta")
HELD = 1 << 18
BUCKET_BYTES = 1 << 22

#: Pairs looked at together.
PAIRS = 1 << 19

#: Buckets of the filter that spares most documents the second join.
WANTED = 1 << 20

_LOW = np.uint64((1 << 30) - 1)
_NO_WORD = "[^\\x20\\x09-\\x0D]"


def least_overlap(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    """Words that sets of these sizes share at least when their Jaccard similarity is ``t``."""
    return np.ceil(t / (1 + t) * (a + b) - 1e-9).astype(np.int64)


def prefix_length(size: np.ndarray, t: float) -> np.ndarray:
    """Rarest words of a set, one of which any similar set has among its own rarest."""
    return size - np.ceil(t * size - 1e-9).astype(np.int64) + 1


def _buckets(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(47)).astype(np.int64)


def _table(rows: DataFrame) -> np.ndarray:
    """Columns b and n as an array of ``BUCKETS`` numbers."""
    out = np.zeros(BUCKETS, np.int64)
    found = rows.groupBy("b").agg(F.sum("n").alias("n")).toArrow()
    out[found["b"].to_numpy()] = found["n"].to_numpy()
    return out


def _bars(counts: np.ndarray) -> pa.RecordBatch:
    used = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["b", "n"])


def rarity(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The place of each bucket of words in the order of rarity over all texts; and how often the
    words of the bucket at each place occur."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, 128):
            codes, _ = word_codes(*raw_text(batch.column(0)))
            counts += np.bincount(_buckets(codes), minlength=BUCKETS)
        yield _bars(counts)

    counts = _table(docs.select("text").mapInArrow(count, "b long, n long"))
    ranks = np.empty(BUCKETS, np.uint64)
    order = np.argsort(counts, kind="stable")
    ranks[order] = np.arange(BUCKETS, dtype=np.uint64)
    return ranks, counts[order]


class Lines:
    """The word sets of the lines of some texts: flat arrays, each set rarest word first.

    ``words``: 47 bits each, the rarity of a word in the high 17. ``row`` and ``line``: where a set
    is; ``low``/``high``: its part of ``words``; ``s1``, ``s2``: its hash.
    """

    def __init__(self, texts: pa.Array, ranks: np.ndarray) -> None:
        data, starts = raw_text(texts)
        codes, first = word_codes(data, starts)
        feeds = np.flatnonzero(data == 10)
        text = np.searchsorted(starts, first, "right") - 1  # empty texts share their start
        line = np.searchsorted(feeds, first) + text  # a new text begins a new line
        new = np.ones(len(line), bool)
        new[1:] = line[1:] != line[:-1]
        owner = np.cumsum(new) - 1
        head = np.flatnonzero(new)
        self.row = text[head]
        self.line = (np.searchsorted(feeds, first[head]) - np.searchsorted(feeds, starts[self.row])).astype(np.int32)
        words = (ranks[_buckets(codes)] << np.uint64(30)) | (codes & _LOW)
        self.words, self.owner = self._distinct(words, owner)
        self.size = np.bincount(self.owner, minlength=len(head))
        self.high = np.cumsum(self.size)
        self.low = self.high - self.size
        if len(head):
            spread = mix(self.words)
            self.s1 = np.add.reduceat(spread, self.low).view(np.int64)
            self.s2 = np.add.reduceat(mix(spread + self.words), self.low).view(np.int64)
        else:
            self.s1 = self.s2 = np.empty(0, np.int64)

    @staticmethod
    def _distinct(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each owner's distinct words in order; owners beyond 17 bits go in turns."""
        out = []
        for turn in range(0, int(owner[-1]) + 1 if len(owner) else 0, 1 << 17):
            a, b = np.searchsorted(owner, (turn, turn + (1 << 17)))
            keyed = np.sort((owner[a:b] - turn).astype(np.uint64) << np.uint64(47) | words[a:b])
            fresh = np.ones(len(keyed), bool)
            fresh[1:] = keyed[1:] != keyed[:-1]
            keyed = keyed[fresh]
            out.append((keyed & np.uint64((1 << 47) - 1), (keyed >> np.uint64(47)).astype(np.int64) + turn))
        if not out:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return np.concatenate([w for w, _ in out]), np.concatenate([o for _, o in out])

    def sketch(self) -> list[np.ndarray]:
        """Twice 64 bits per set: each word flips one."""
        bit = mix(self.words) >> np.uint64(57)
        flip = np.uint64(1) << (bit & np.uint64(63))
        halves = (np.where(bit < 64, flip, 0), np.where(bit < 64, 0, flip))
        return [np.bitwise_xor.reduceat(h.astype(np.uint64), self.low).view(np.int64) for h in halves]


def _mapped(
    docs: DataFrame, ranks: np.ndarray, schema: str, give: Callable[..., Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``give(batch, Lines)`` for each slice of (doc_id, row, text); with None at the end."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            lines = Lines(batch.column(2), shared.value)
            if len(lines.row):
                yield from give(batch, lines)
        yield from give(None, None)

    return docs.select("doc_id", row_key().alias("row"), "text").mapInArrow(run, schema)


class _Fresh:
    """Which sets of a task's input are new to it, as far as a bounded memory tells."""

    def __init__(self, t: float) -> None:
        self.seen: set[int] = set()
        # Sets of n words that differ are similar by n / (n + 1) at most.
        self.least = np.ceil(t / (1 - t) - 1e-9) if t < 1 else np.inf

    def of(self, x: Lines) -> np.ndarray:
        if len(self.seen) > 500_000:
            self.seen = set()
        out = np.zeros(len(x.s1), bool)
        for i in np.flatnonzero(x.size >= self.least).tolist():
            name = int(x.s1[i])
            if name not in self.seen:
                self.seen.add(name)
                out[i] = True
        return out


def _prefixes(x: Lines, fresh: np.ndarray, t: float) -> np.ndarray:
    """Places in ``x.words`` of the prefix words of the fresh sets."""
    at = np.arange(len(x.words)) - x.low[x.owner]
    return np.flatnonzero(fresh[x.owner] & (at < prefix_length(x.size, t)[x.owner]))


def _posted(docs: DataFrame, ranks: np.ndarray, t: float, schema: str, columns: Callable) -> DataFrame:
    """``columns(Lines, places of prefix words)`` for the sets that are new to a task."""

    def make() -> Callable[..., Iterator[pa.RecordBatch]]:
        state: dict[str, _Fresh] = {}

        def give(batch: pa.RecordBatch | None, x: Lines | None) -> Iterator[pa.RecordBatch]:
            if batch is None:
                return
            put = _prefixes(x, state.setdefault("f", _Fresh(t)).of(x), t)
            names, arrays = zip(*columns(x, put).items(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], names=list(names))

        return give

    return _mapped(docs, ranks, schema, make())


def first_lines(
    docs: DataFrame, ranks: np.ndarray, often: np.ndarray, t: float, block: int
) -> tuple[DataFrame, DataFrame]:
    """The first line of every distinct set (s1, doc_id, row and line), and the hot words: those with
    more postings than a block holds (``word`` and its number of ``blocks``). One pass gives both.

    A word has no more postings than its bucket's words occur (``often``), so only words of buckets
    beyond a block are counted, map-side, each for itself.
    """
    shared = docs.sparkSession.sparkContext.broadcast(often > block)
    names = ["posting", "k1", "k2", "doc_id", "row", "line"]

    def make() -> Callable[..., Iterator[pa.RecordBatch]]:
        state: dict[str, _Fresh] = {}

        def give(batch: pa.RecordBatch | None, x: Lines | None) -> Iterator[pa.RecordBatch]:
            if batch is None:
                return
            rows = pa.array(x.row)
            of = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(x.line)]
            keys = [pa.array(np.zeros(len(x.row), bool)), pa.array(x.s1), pa.array(x.s2)]
            yield pa.RecordBatch.from_arrays([*keys, *of], names=names)
            words = x.words[_prefixes(x, state.setdefault("f", _Fresh(t)).of(x), t)]
            words = words[shared.value[(words >> np.uint64(30)).astype(np.int64)]].view(np.int64)
            n = len(words)
            keys = [pa.array(np.ones(n, bool)), pa.array(words), pa.array(np.zeros(n, np.int64))]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.nulls(n, c.type) for c in of)], names=names)

        return give

    schema = "posting boolean, k1 long, k2 long, doc_id long, row long, line int"
    order = F.struct(F.col("doc_id").isNull().alias("m"), "doc_id", "row", "line")
    found = (
        _mapped(docs, ranks, schema, make())
        .groupBy("posting", "k1", "k2")
        .agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("n"))
        .where(~F.col("posting") | (F.col("n") > block))
    )
    both = stage(found.select("posting", "k1", "f.doc_id", "f.row", "f.line", "n"), "lines")
    firsts = both.where("NOT posting").select(F.col("k1").alias("s1"), "doc_id", "row", "line")
    hot = both.where("posting").select(
        F.col("k1").alias("word"), F.ceil(F.col("n") / block).cast("int").alias("blocks")
    )
    return firsts, hot


def postings(
    docs: DataFrame, ranks: np.ndarray, hot: DataFrame, t: float, buckets: int = 1 << 10, most: int = HOT_WORDS
) -> DataFrame:
    """A posting per set and word of its prefix, for hot words one for every pair of blocks: task, s1, a
    sketch, and in ``meta`` the set's size, the word's place in it and the side of the task.

    Up to ``most`` hot words are looked up where the postings are made, and postings are handed on
    many at a time, as the bytes of each ``bucket`` of tasks; more hot words are joined to postings,
    a row each.
    """
    if hot.count() <= most:
        return _dealt(docs, ranks, hot, t, buckets)

    def columns(x: Lines, put: np.ndarray) -> dict[str, np.ndarray]:
        return {"word": x.words[put].view(np.int64), **_of_sets(x, put, x.owner[put])}

    posted = _posted(docs, ranks, t, "word long, s1 long, b0 long, b1 long, meta long", columns)
    mine = F.pmod(F.xxhash64("s1", F.lit(3)), F.col("blocks").cast("long")).cast("int")
    dealt = (
        posted.join(hot, "word", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    side = (F.col("mine") > F.col("other")).cast("long")
    return dealt.select(
        F.xxhash64("word", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"),
        "s1",
        "b0",
        "b1",
        F.col("meta").bitwiseOR(side).alias("meta"),
    )


def _of_sets(x: Lines, put: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
    b0, b1 = (h[owner] for h in x.sketch())
    at = np.minimum(put - x.low[owner], (1 << 30) - 1)
    return {"s1": x.s1[owner], "b0": b0, "b1": b1, "meta": (x.size[owner] << 31) | (at << 1)}


def _dealt(docs: DataFrame, ranks: np.ndarray, hot: DataFrame, t: float, buckets: int) -> DataFrame:
    found = hot.toArrow()
    order = np.argsort(found["word"].to_numpy())
    names = np.append(found["word"].to_numpy()[order], np.iinfo(np.int64).max)
    numbers = np.append(found["blocks"].to_numpy()[order], 1).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((names, numbers))

    def made(x: Lines, put: np.ndarray) -> np.ndarray:
        names, numbers = shared.value
        word, owner = x.words[put].view(np.int64), x.owner[put]
        mine = other = np.zeros(len(put), np.int64)
        if len(names) > 1:
            at = np.searchsorted(names[:-1], word)
            blocks = np.where(names[at] == word, numbers[at], 1)
            mine = (mix(x.s1[owner].view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
            copy = np.repeat(np.arange(len(put)), blocks)
            other = np.arange(len(copy)) - (np.cumsum(blocks) - blocks)[copy]
            mine, owner, word, put = mine[copy], owner[copy], word[copy], put[copy]
        pair = np.minimum(mine, other) * np.int64(1 << 31) + np.maximum(mine, other)
        out = _of_sets(x, put, owner)
        out["meta"] |= mine > other
        task = mix(word.view(np.uint64) ^ mix(pair.view(np.uint64))).view(np.int64)
        return np.stack([task, *(out[n] for n in POSTING[1:])], 1)

    def bytes_of(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate([np.empty((0, len(POSTING)), np.int64), *held])
        bucket = (rows[:, 0].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        which, first = np.unique(bucket[order], return_index=True)
        raw, wide = rows[order].tobytes(), 8 * len(POSTING)
        cuts = (np.append(first, len(rows)) * wide).tolist()
        parts = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(which), pa.array(parts, pa.binary())], names=["bucket", "postings"]
        )

    def make() -> Callable[..., Iterator[pa.RecordBatch]]:
        fresh, held = _Fresh(t), []

        def give(batch: pa.RecordBatch | None, x: Lines | None) -> Iterator[pa.RecordBatch]:
            if batch is not None:
                held.append(made(x, _prefixes(x, fresh.of(x), t)))
            if held and (batch is None or sum(map(len, held)) >= HELD):
                yield bytes_of(held)
                held.clear()

        return give

    return _mapped(docs, ranks, "bucket int, postings binary", make())


class Meeting:
    """The postings of whole tasks, a row per set and task, ordered by task and size."""

    def __init__(self, of: Mapping[str, np.ndarray]) -> None:
        task, s1, meta = (of[n] for n in ("task", "s1", "meta"))
        order = np.lexsort((s1, meta >> 31, task))
        new = np.ones(len(order), bool)  # another map task may have posted the same set
        new[1:] = (np.diff(task[order]) != 0) | (np.diff(s1[order]) != 0)
        self.order = order = order[new]
        self.task, self.s1 = task[order], s1[order]
        self.bits = [of[n][order].view(np.uint64) for n in ("b0", "b1")]
        meta = meta[order]
        self.size, self.at, self.side = meta >> 31, (meta >> 1) & ((1 << 30) - 1), meta & 1
        self.number = np.cumsum(np.concatenate([[0], np.diff(self.task) != 0]))
        sides = np.bincount(self.number, weights=self.side)
        total = np.bincount(self.number)
        self.mixed = ((sides > 0) & (sides < total))[self.number]
        # A task of a block with itself has side 0 only; side 1 alone met nothing.
        self.idle = (sides == total)[self.number]

    def pairs(self, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that may be similar, the smaller set first; a bounded number at a time."""
        n = len(self.task)
        if not n:
            return
        top = np.floor(self.size / t + 1e-9).astype(np.int64)
        place = self.number * np.int64(1 << 33)
        last = np.searchsorted(place + self.size, place + top, "right")
        count = np.where(self.idle, 0, last - np.arange(n) - 1)
        ends = np.cumsum(count)
        low = 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, "right")))
            each = count[low:high]
            i = np.repeat(np.arange(low, high), each)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(each) - each, each)
            low = high
            ok = ~self.mixed[i] | (self.side[i] != self.side[j])
            i, j = i[ok], j[ok]
            need = least_overlap(self.size[i], self.size[j], t)
            # At the first word that two sets share, none of the rarer ones are shared.
            ok = np.minimum(self.size[i] - self.at[i], self.size[j] - self.at[j]) >= need
            i, j, need = i[ok], j[ok], need[ok]
            apart = sum(np.bitwise_count(b[i] ^ b[j]).astype(np.int64) for b in self.bits)
            ok = self.size[i] + self.size[j] - apart >= 2 * need
            yield i[ok], j[ok]


def _alive(rows: DataFrame, t: float) -> DataFrame:
    """The postings that have a partner left in their task, a row each."""
    key = rows.columns[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, key):
            for part in _whole_tasks(table):
                of = dict(zip(POSTING, part, strict=True))
                x = Meeting(of)
                hit = np.zeros(len(x.task), bool)
                for i, j in x.pairs(t):
                    hit[i] = True
                    hit[j] = True
                if hit.any():
                    at = x.order[hit]
                    yield pa.RecordBatch.from_arrays([pa.array(of[n][at]) for n in POSTING], names=list(POSTING))

    schema = ", ".join(f"{n} long" for n in POSTING)
    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def _whole_tasks(table: pa.Table) -> Iterator[list[np.ndarray]]:
    """The columns of the postings in whole buckets, one after the other, or in rows as they are."""
    if "postings" not in table.column_names:
        yield [table[n].to_numpy() for n in POSTING]
        return
    bucket = table["bucket"].to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        raw = b"".join(table["postings"].slice(a, b - a).to_pylist())
        yield [c.copy() for c in np.frombuffer(raw, np.int64).reshape(-1, len(POSTING)).T]


def _shared(words: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that sets ``i`` and ``j`` share, pair by pair."""
    out = np.empty(len(i), np.int64)
    for low in range(0, len(i), 4096):
        a, b = i[low : low + 4096], j[low : low + 4096]
        both = [words[k] for k in np.stack([a, b], 1).ravel().tolist()]
        pair = np.repeat(np.arange(len(a), dtype=np.uint64), [len(p) + len(q) for p, q in zip(both[::2], both[1::2], strict=True)])
        keyed = np.sort(mix(np.concatenate(both) + mix(pair + np.uint64(1))) & ~np.uint64(4095) | pair)
        twice = keyed[1:][keyed[1:] == keyed[:-1]] & np.uint64(4095)
        out[low : low + 4096] = np.bincount(twice.astype(np.int64), minlength=len(a))
    return out


def _later_matches(rows: DataFrame, t: float) -> DataFrame:
    """Lines (row, line) whose set has a similar one before it, of postings with words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, "task"):
            x = Meeting({n: table[n].to_numpy() for n in POSTING})
            part = table.take(pa.array(x.order))
            ids = part["doc_id"]
            order = np.lexsort(
                (
                    part["line"].to_numpy(),
                    part["row"].to_numpy(),
                    ids.fill_null(0).to_numpy(),
                    ids.is_null().to_numpy(),
                )
            )
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            words = [np.frombuffer(w, "<u8") for w in part["words"].to_pylist()]
            gone = np.zeros(len(order), bool)
            for i, j in x.pairs(t):
                later = np.where(place[i] > place[j], i, j)
                earlier = i + j - later
                by = np.lexsort((place[earlier], later))
                later, earlier = later[by], earlier[by]
                width = 1  # a few candidates of each line at a time: most lines match early
                while len(later):
                    starts = np.flatnonzero(np.concatenate([[True], later[1:] != later[:-1]]))
                    nth = np.arange(len(later)) - np.repeat(starts, np.diff(np.append(starts, len(later))))
                    now = (nth < width) & ~gone[later]
                    a, b = later[now], earlier[now]
                    good = _shared(words, a, b) >= least_overlap(x.size[a], x.size[b], t)
                    gone[a[good]] = True
                    rest = (nth >= width) & ~gone[later]
                    later, earlier, width = later[rest], earlier[rest], 4 * width
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[n].to_numpy()[gone]) for n in ("row", "line")], names=["row", "line"]
            )

    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "row long, line int")


def _with_words(docs: DataFrame, ranks: np.ndarray, alive: DataFrame, firsts: DataFrame) -> DataFrame:
    """``alive`` with the place and the words of each set's first line."""
    wanted = stage(alive.select("s1").distinct().join(firsts, "s1"), "wanted")
    bucket = F.pmod(F.col("row"), F.lit(WANTED))
    marks = np.zeros(WANTED, bool)
    marks[wanted.select(bucket.alias("b")).distinct().toArrow()["b"].to_numpy()] = True
    shared, spread = (docs.sparkSession.sparkContext.broadcast(v) for v in (marks, ranks))

    def few(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value[batch.column(0).to_numpy() % WANTED]))

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            x = Lines(batch.column(0), spread.value)
            numbers = [set(v) for v in batch.column(1).to_pylist()]
            at = [k for k, (r, n) in enumerate(zip(x.row.tolist(), x.line.tolist(), strict=True)) if n in numbers[r]]
            raw = x.words.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(x.s1[at]),
                    pa.array([raw[8 * x.low[k] : 8 * x.high[k]] for k in at], pa.binary()),
                ],
                names=["s1", "words"],
            )

    texts = docs.select(row_key().alias("row"), "text").mapInArrow(few, "row long, text string")
    lines = wanted.groupBy("row").agg(F.collect_set("line").alias("lines"))
    # Repeated rows give a set's words more than once.
    found = texts.join(lines, "row").select("text", "lines").mapInArrow(words, "s1 long, words binary")
    sets = wanted.join(found.groupBy("s1").agg(F.first("words").alias("words")), "s1")
    return alive.join(sets, "s1")


def kept_lines(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Per document row with lines that are the first of their set: ``row``, the numbers of those
    lines (``firsts``), and of lines that match an earlier one (``gone``)."""
    ranks, often = rarity(docs)
    firsts, hot = first_lines(docs, ranks, often, threshold, block)
    # A tenth of all words, or so, is posted; buckets are many enough to be small.
    most = int(often.sum()) // 10 * 8 * len(POSTING) // BUCKET_BYTES
    buckets = min(1 << 30, max(1 << 10, 1 << most.bit_length()))
    alive = stage(_alive(postings(docs, ranks, hot, threshold, buckets), threshold), "alive")
    gone = _later_matches(_with_words(docs, ranks, alive, firsts), threshold)
    marked = firsts.select("row", "line", F.lit(True).alias("first")).unionByName(
        gone.select("row", "line", F.lit(False).alias("first"))
    )
    return marked.groupBy("row").agg(
        F.collect_list(F.when(F.col("first"), F.col("line"))).alias("firsts"),
        F.collect_set(F.when(~F.col("first"), F.col("line"))).alias("gone"),
    )


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Per row the input's columns as ``doc``, the kept lines as ``text``, and the numbers of lines
    ``n_lines`` and ``n_removed``."""
    whole = packed(docs).withColumn("key", row_key(F.col("doc")["doc_id"], F.col("doc")["text"]))
    kept = _flags(kept_lines(docs, threshold, block))
    joined = whole.join(kept, F.col("key") == F.col("row"), "left")
    lines = F.split(F.col("doc")["text"], "\n")
    # A line's flag is read by its number, so a text's lines cost one step each.
    left = F.filter(lines, lambda x, i: F.coalesce(F.get(F.col("stays"), i), F.lit(False)) | ~x.rlike(_NO_WORD))
    return joined.withColumn("left", left).select(
        "doc",
        F.array_join("left", "\n").alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size(lines) - F.size("left"), F.lit(0)).alias("n_removed"),
    )


def _flags(kept: DataFrame) -> DataFrame:
    """Line numbers as an array that holds, for each line up to the last first one, whether it stays."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            firsts, gone = batch.column(1), batch.column(2)
            many, less = (c.value_lengths().to_numpy() for c in (firsts, gone))
            # Lines of a batch lie in a row, each document's up to its last.
            line, lost = firsts.flatten().to_numpy(), gone.flatten().to_numpy()
            owner, loser = (np.repeat(np.arange(len(n)), n) for n in (many, less))
            size = np.zeros(len(many), np.int64)
            np.maximum.at(size, owner, line.astype(np.int64) + 1)
            np.maximum.at(size, loser, lost.astype(np.int64) + 1)
            start = np.append(0, np.cumsum(size))
            flags = np.zeros(start[-1], bool)
            flags[start[owner] + line] = True
            flags[start[loser] + lost] = False
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(flags))],
                names=["row", "stays"],
            )

    return kept.mapInArrow(run, "row long, stays array<boolean>")
