"""Sum-of-squares online packing of tokenised documents into windows of fixed length.

Each task packs its own input as it streams by: documents are neither shuffled nor gathered. A
document of a window or more first fills whole windows; its rest goes to the fill level that
minimises the sum of squared counts of partly filled windows, read off an array with a count per
level. At the end of a task the windows still open are merged by cutting pieces, which leaves
one partial window; that is cut at powers of two, which need no padding.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each; an empty
table gives an empty result; a null doc_id stays null; other columns are not read. The same
partition in the same order gives the same result again after a lost executor.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from aftermerge.llm.common import as_bytes, slices
from aftermerge.llm.tokens import END, word_ids

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)

#: A piece: doc_id, its document's ids before it, its ids as bytes, the document's ids in all.
Piece = tuple[int | None, int, bytes, int]


class SquaresPacker:
    """Online packing of pieces into windows of ``size`` ids; a full window is given out at once.

    At most ``most_open`` windows are open; beyond that the open ones are merged and given out, so
    memory is bounded and every piece is still placed whole or cut, never dropped.
    """

    def __init__(self, size: int = 4096, most_open: int = 2048) -> None:
        self.size, self.most_open = size, most_open
        self.counts = np.zeros(size + 1, np.int64)
        self.open: list[deque[list[Piece]]] = [deque() for _ in range(size)]
        self.n_open = 0
        self.full: list[list[Piece]] = []

    def level_for(self, length: int) -> int:
        """The fill level (0: a new window) that a piece of ``length`` < size goes to.

        Moving a window from level h to h + length changes the sum of squares by
        2 * (count[h + length] - count[h]) + 2; opening or completing a window drops the term of
        the level that isn't counted. Of equally good levels the fullest wins.
        """
        top = self.size - length
        here, there = self.counts[1 : top + 1], self.counts[1 + length : self.size + 1]
        change = 2 * (there - here) + 2
        change[-1] = 1 - 2 * here[-1]  # to the brim: only the old level loses a window
        change = np.where(here > 0, change, np.iinfo(np.int64).max)
        best = top - int(np.argmin(change[::-1]))
        return best if change[best - 1] <= 2 * self.counts[length] + 1 else 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Place a document of at least one id."""
        total, start, wide = len(ids) // 4, 0, 4 * self.size
        while total - start >= self.size:
            self.full.append([(doc_id, start, ids[4 * start : 4 * start + wide], total)])
            start += self.size
        if start == total:
            return
        piece = (doc_id, start, ids[4 * start :], total)
        length = total - start
        level = self.level_for(length)
        window = self.open[level].popleft() if level else []
        window.append(piece)
        self.counts[level] -= bool(level)
        self.n_open += not level
        if level + length == self.size:
            self.full.append(window)
            self.n_open -= 1
        else:
            self.open[level + length].append(window)
            self.counts[level + length] += 1
        if self.n_open > self.most_open:
            self.close()

    def close(self) -> None:
        """Give out the open windows: the fuller ones are completed with cuts of the emptier ones."""
        left = [w for level in self.open for w in level]  # by fill, the emptiest first
        room = self.size
        current: list[Piece] = []
        pieces = [p for w in reversed(left) for p in w]
        for doc_id, start, ids, total in pieces:
            while ids:
                cut = 4 * min(room, len(ids) // 4)
                current.append((doc_id, start, ids[:cut], total))
                start, ids, room = start + cut // 4, ids[cut:], room - cut // 4
                if not room:
                    self.full.append(current)
                    current, room = [], self.size
        self.full.extend(powers_of_two(current))
        self.counts[:] = 0
        self.open = [deque() for _ in range(self.size)]
        self.n_open = 0


def powers_of_two(window: list[Piece]) -> Iterator[list[Piece]]:
    """Cut a window into ones of falling powers of two in length."""
    left = sum(len(p[2]) for p in window) // 4
    rest = deque(window)
    while left:
        want = room = 1 << (left.bit_length() - 1)
        out: list[Piece] = []
        while room:
            doc_id, start, ids, total = rest.popleft()
            take = min(room, len(ids) // 4)
            out.append((doc_id, start, ids[: 4 * take], total))
            if 4 * take < len(ids):
                rest.appendleft((doc_id, start + take, ids[4 * take :], total))
            room -= take
        left -= want
        yield out


def pack(docs: DataFrame, tokenizer: str, size: int = 4096) -> DataFrame:
    """One row per piece: where it is cut from and where it lies. ``sequence_id`` is unique."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 32
        words, packer = word_ids(tokenizer), SquaresPacker(size)
        end = np.array([END], "<u4").tobytes()

        def out() -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for window in packer.full:
                offset = 0
                for doc_id, start, ids, total in window:
                    rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset))
                    offset += len(ids) // 4
                sequence += 1
            packer.full = []
            columns = zip(*rows, strict=True) if rows else [()] * len(SCHEMA)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA
            )

        for batch in slices(batches):
            for doc_id, text in zip(
                batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True
            ):
                packer.add(doc_id, words.of(text) + end)
            yield out()
        packer.close()
        yield out()

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long",
    )
