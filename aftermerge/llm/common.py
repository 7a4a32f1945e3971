"""What several operators share: words and their codes, staged tables, bounded groups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters outside this class; ``bytes.split()`` cuts at the same bytes.
SPACES = "[\\x20\\x09-\\x0D]+"

#: Entries a worker keeps in a cache of words before it starts anew.
CACHED_WORDS = 400_000


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(df: DataFrame, struct: Column) -> DataFrame:
    """Append a struct's fields, computed once a row: no filter or projection moves into it."""
    return df.select("*", F.inline(F.array(struct)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key(doc_id: Column | str = "doc_id", text: Column | str = "text") -> Column:
    """One long per (doc_id, text), nulls included; repeated rows share theirs."""
    doc_id, text = (F.col(c) if isinstance(c, str) else c for c in (doc_id, text))
    return F.xxhash64(doc_id, text, text.isNull())


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, made longer until it is none of the columns'."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def packed(docs: DataFrame) -> DataFrame:
    """All columns in one struct ``doc``, so that no name an operator adds can clash with theirs."""
    return docs.select(F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("doc"))


def unpacked(whole: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns of ``doc``, under their own names."""
    return whole.select(*(F.col("doc").getField(c).alias(c) for c in columns))


#: Multiplier of the word hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the multiplier and of its inverse; kept for up to some millions."""
    if _POWERS and len(_POWERS[0]) > n:
        return _POWERS[0], _POWERS[1]
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(max(n + 1, 1 << 16), base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    if n < 1 << 22:
        _POWERS[:] = made
    return made[0], made[1]


def _separators(extra: bytes = b"") -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(b" \t\n\x0b\x0c\r" + extra)] = True
    return table


#: Bytes that end a word: white space; for tokens, ASCII punctuation too.
WORD_ENDS = _separators()
TOKEN_ENDS = _separators(b"\"'`.,;:!?()[]{}<>*#$%&|/\\_~^=+-@")


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in a row, and where each text starts (and the last ends)."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _word_bounds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the texts in a row begin and end."""
    space = ends[data]
    edge = starts[:-1][starts[:-1] < starts[1:]]  # where texts that aren't empty start
    before = np.empty(len(data), bool)
    before[1:] = space[:-1]
    before[edge] = True
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    after[np.append(edge[1:] - 1, len(data) - 1)] = True
    return np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1


def word_prefix_codes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefixes: Sequence[int] = ()
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of every word and of its first bytes, a row each, and where the words begin.

    A word's code is a polynomial of its bytes, read off prefix sums, so that no word becomes a
    Python object.
    """
    if not len(data):
        return np.empty((1 + len(prefixes), 0), np.uint64), np.empty(0, np.int64)
    first, last = _word_bounds(data, starts, ends)
    up, down = _powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    stops = [last, *(np.minimum(first + k, last) for k in prefixes)]
    return np.stack([mix((sums[stop] - sums[first]) * down[first]) for stop in stops]), first


def word_codes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray = WORD_ENDS
) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code for every word of the texts in a row, and where it begins."""
    codes, first = word_prefix_codes(data, starts, ends)
    return codes[0], first


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """UTF-8 with its ASCII letters in lower case."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return lower[data]


def _by_text(codes: np.ndarray, first: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    return np.split(codes, np.searchsorted(first, starts[1:-1])) if len(starts) > 1 else []


def text_codes(column: pa.Array) -> list[np.ndarray]:
    """The codes of each text's words."""
    data, starts = raw_text(column)
    return _by_text(*word_codes(data, starts), starts)


def token_codes(column: pa.Array) -> list[np.ndarray]:
    """Codes of each text's tokens: words without ASCII punctuation, ASCII letters in lower case."""
    data, starts = raw_text(column)
    return _by_text(*word_codes(lower_ascii(data), starts, TOKEN_ENDS), starts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(codes: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row; fewer words give one shingle of them all."""
    n = len(codes)
    if not n:
        return np.empty(0, np.uint64)
    wide = min(width, n)
    out = np.zeros(n - wide + 1, np.uint64)
    for i in range(wide):
        out = mix(out + codes[i : n - wide + 1 + i] + np.uint64(wide * 7919 + i))
    return np.unique(out)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def byte_level() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, as character to byte.

    Printable characters of Latin-1 stand for themselves, the other bytes for U+0100 and on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in small slices, so that what is derived from one stays small too."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def by_group(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``; each holds one or more groups.

    Only the last group of a batch waits for the next batch, so memory is a batch and a group.
    """
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key)
        if kept and kept[-1].column(key)[-1] != column[0]:
            yield pa.Table.from_batches(kept)
            kept = []
        values = column.to_numpy(zero_copy_only=False)
        start = int(np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))[-1])
        if start:
            yield pa.Table.from_batches([*kept, batch.slice(0, start)])
            kept = []
        kept.append(batch.slice(start))
    if kept:
        yield pa.Table.from_batches(kept)


def block_tasks(sized: DataFrame, key: str, n: str, spread: str, block: int) -> DataFrame:
    """Cut groups into blocks and lay out every pair of blocks as a task of at most two blocks.

    ``sized`` has one row per member of group ``key`` and the group's size in column ``n``;
    ``spread`` is a long that tells members apart. A group of up to ``block`` members is one task;
    a larger one is dealt by hash into blocks of about that size. Adds ``task`` (long) and
    ``side`` (0 or 1; a task of a block with itself has only 0), and drops ``n``.
    """
    blocks = F.ceil(F.col(n) / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64(F.col(spread), F.lit(7)), F.col("_blocks").cast("long")).cast("int")
    return (
        sized.withColumn("_blocks", blocks)
        .withColumn("_mine", mine)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("side", F.when(F.col("_mine") <= F.col("_other"), 0).otherwise(1))
        .withColumn(
            "task",
            F.xxhash64(key, F.least("_mine", "_other"), F.greatest("_mine", "_other")),
        )
        .drop(n, "_blocks", "_mine", "_other")
    )
