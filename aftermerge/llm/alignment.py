"""Alignment of two tokenizers' tokens by diagonal run skipping, and how often ids stand together.

A text's tokens are given by where each one ends in its bytes, for both tokenizers. From a common
end on, the two arrays of ends are compared at the current index shift: windows of doubling width
are skipped while they are equal, token for token, and halved again to find the first difference.
There the irregular group is resolved by stepping whichever side is behind until the ends meet,
which sets the shift anew. The texts of a small batch lie in a row, so one run aligns them all.

Documents are dealt into chunks of bounded size as tasks read them. Only a chunk's distinct id
pairs, with the number of its documents that hold them, are shuffled to be counted; the counts
come back to the chunk, not to every document. No table of pairs is broadcast, only the best
count of each id of A, which has no more rows than A's vocabulary. The encoded chunks are staged,
so texts are encoded once.

Defined cases: texts that are null, empty, or whose tokens do not spell space + text have zeros
and an empty digest; repeated rows are documents of their own and count each; a null doc_id stays
null; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aftermerge.llm.common import CACHED_WORDS, byte_level, stage

#: Bytes of text aligned at a time, unless one text is longer.
BATCH_BYTES = 1 << 20
#: Distinct pairs of documents, added up over a chunk, from which it is closed.
CHUNK_PAIRS = 1 << 21
#: Links of a group that are laid out one by one; a larger group is taken by its distinct ids.
GROUP_LINKS = 4096
#: Links laid out at a time.
LINKS = 1 << 20

ENCODED = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<int>, times array<long>, a int, b int, place int, docs long"
)
_ENCODED = pa.schema(
    [
        *((n, pa.int64()) for n in ("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.string()),
        ("pairs", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int64())),
        ("a", pa.int32()),
        ("b", pa.int32()),
        ("place", pa.int32()),
        ("docs", pa.int64()),
    ]
)


# Fixed value: how byte-level vocabularies cut a text before merging (public format).
BYTE_LEVEL_CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The quick way recurses over white space; a text with a longer run takes the other.
LONG_SPACE = re.compile(r"\s{256}")


def ranked(document: dict, spelled: list[bytes]) -> dict[bytes, int] | None:
    """Ids by their bytes, if the vocabulary is plain: cut as above, and merged in the order of ids.

    Merging the pair that makes the least id is then the same as following the list of merges.
    """
    model, cut = document["model"], document["pre_tokenizer"] or {}
    plain = (
        (model["type"], cut.get("type"), cut.get("use_regex")) == ("BPE", "ByteLevel", True)
        and not cut["add_prefix_space"]
        and not document["normalizer"]
        and not model.get("ignore_merges")
    )
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"]["".join(pair)] for pair in pairs] if plain else [0]
    if ids != [*range(256, 256 + len(ids))] or len(model["vocab"]) != 256 + len(ids):
        return None
    return {spelled[i]: i for i in model["vocab"].values()}


def _joined(table: list[bytes], ids: list[int]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


class ByteSide:
    """A byte-level tokenizer (A): ids of space + text, and the bytes of every id."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        back = byte_level()
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for entry, i in self.tokenizer.get_vocab().items():
            known = all(c in back for c in entry)
            self.bytes[i] = bytes(map(back.__getitem__, entry)) if known else entry.encode()
        with open(path, encoding="utf-8") as file:
            ranks = ranked(json.load(file), self.bytes)
        self.quick = None
        if ranks:
            import tiktoken

            self.quick = tiktoken.Encoding(
                "a", pat_str=BYTE_LEVEL_CUT, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, texts: list[str]) -> list[list[int]]:
        spaced = [" " + t for t in texts]
        if self.quick is None:
            return [e.ids for e in self.tokenizer.encode_batch(spaced, add_special_tokens=False)]
        return [
            self.tokenizer.encode(t, add_special_tokens=False).ids
            if LONG_SPACE.search(t)
            else self.quick.encode_ordinary(t)
            for t in spaced
        ]

    def spells(self, text: str, ids: list[int]) -> bool:
        """Whether the ids' bytes are those of space + text; plain merging keeps all bytes."""
        return self.quick is not None or _joined(self.bytes, ids) == b" " + text.encode()


def piece_ranks(model) -> tuple[dict[bytes, int], list[tuple[int, ...]]]:
    """A sentencepiece model's merges over bytes: ranks by bytes, and the ids that each rank stands for.

    A space is one byte here. Bytes come first, then what joins them to the characters that have a
    piece, then the longer pieces by falling score, which is the order they are merged in. What is
    left of a character without a piece stands for its bytes' ids. Pieces of several spaces are
    left out: their scores tie.
    """
    n = model.get_piece_size()
    byte_ids, pieces = {}, {}
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and "▁▁" not in piece:
            pieces[piece.replace("▁", " ")] = i
    ranks = {bytes([b]): b for b in range(256)}
    ids: list[tuple[int, ...]] = [(pieces.get(chr(b)) if b < 128 and chr(b) in pieces else byte_ids[b],) for b in range(256)]
    chars = {c.encode(): i for c, i in pieces.items() if len(c) == 1 and not c.isascii()}
    for size in (2, 3, 4):
        for part in sorted({c[:size] for c in chars if len(c) >= size}):
            ranks[part] = len(ids)
            ids.append((chars[part],) if part in chars else tuple(byte_ids[b] for b in part))
    longer = [(piece, i) for piece, i in pieces.items() if len(piece) > 1]
    for piece, i in sorted(longer, key=lambda x: (-model.get_score(x[1]), x[1])):
        ranks[piece.encode()] = len(ids)
        ids.append((i,))
    return ranks, ids


class PieceSide:
    """A sentencepiece model (B), which adds the space itself, and the bytes of every id.

    Where no piece has a space after another character, merges never cross from a word to the
    space after it, so a text's ids are those of its words, each with the spaces before it; the
    ids of words met before are remembered (a bounded cache).
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.by_word = not any("▁" in piece.lstrip("▁") for piece in pieces)
        self.cache: dict[str, list[int]] = {}
        self.merge = self._merging(pieces) if self.by_word else None
        #: Words met whose ids don't spell them.
        self.changed: set[str] = set()

    def _merging(self, pieces: list[str]):
        """Words to ids by plain merging, if that gives the model's own ids for its pieces."""
        import tiktoken

        try:
            ranks, ids = piece_ranks(self.model)
        except KeyError:  # no bytes to fall back on
            return None
        made = tiktoken.Encoding("b", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        single = made._core_bpe.encode_single_piece
        merge = lambda word: [i for rank in single(word.encode()) for i in ids[rank]]
        some = [p[1:] for p in pieces[::7] if p.startswith("▁") and len(p.strip("▁")) == len(p) - 1]
        some += ["é" + p for p in some] + [p + "中🎉" for p in some]
        return merge if self.model.encode(some) == [merge(" " + p) for p in some] else None

    #: A word with the spaces before it; spaces alone at the end. Long words aren't remembered.
    WORD = re.compile(" +[^ ]*")
    LONGEST = 64

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.by_word:
            return self.model.encode(texts, num_threads=1)
        cut = [self.WORD.findall(" " + t) for t in texts]
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        new = {*chain.from_iterable(cut)}.difference(self.cache)
        met = {}
        if self.merge is not None:
            met = {w: self.merge(w) for w in new if len(w) > 1 and w[1] != " " and "▁" not in w}
        # The model adds a word's first space, but not to nothing.
        whole = [w for w in new if len(w) > 1 and w not in met]
        met.update(zip(whole, self.model.encode([w[1:] for w in whole], num_threads=1), strict=True))
        if " " in new:
            met[" "] = [self.model.piece_to_id("▁")]
        self.changed.update(w for w, ids in met.items() if _joined(self.bytes, ids) != w.encode())
        self.cache.update(met)
        out = [[*chain.from_iterable(map(self.cache.__getitem__, words))] for words in cut]
        for word in met:
            if len(word) > self.LONGEST:
                del self.cache[word]
        return out

    def spells(self, text: str, ids: list[int]) -> bool:
        """Whether the ids' bytes are those of space + text; for texts just encoded."""
        if self.by_word and (not self.changed or self.changed.isdisjoint(self.WORD.findall(" " + text))):
            return True
        return _joined(self.bytes, ids) == b" " + text.encode()


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of two rising arrays of ends whose last elements are equal.

    Returns, for every group, how many tokens of either side lie before its end.
    """
    a, b = (np.asarray(x, np.int64) for x in (ends_a, ends_b))
    # Windows are compared as memory, 8 bytes for each end.
    raw_a, raw_b, list_a, list_b = a.tobytes(), b.tobytes(), a.tolist(), b.tolist()
    i = j = 0
    n = len(list_a)
    # Where the shift changes: groups after a change are one-to-one up to the next irregular one.
    left, right, upto = [0], [0], []
    while i < n:
        width = 2
        while raw_a[8 * i : 8 * (i + width)] == raw_b[8 * j : 8 * (j + width)]:  # ahead at this shift
            i += width
            j += width
            if i >= n:  # both sides ended within the window
                i = n
                break
            width *= 2
        else:
            while width > 1:  # the first difference lies within the window
                width >>= 1
                if raw_a[8 * i : 8 * (i + width)] == raw_b[8 * j : 8 * (j + width)]:
                    i += width
                    j += width
        upto.append(i)
        if i >= n:
            break
        x, y = list_a[i], list_b[j]
        while x != y:  # an irregular group: whichever side is behind steps on
            if x < y:
                i += 1
                x = list_a[i]
            else:
                j += 1
                y = list_b[j]
        i += 1
        j += 1
        left.append(i)
        right.append(j)
        if i >= n:
            upto.append(i)
    starts, shift = np.array(left), np.array(right) - np.array(left)
    sizes = np.array(upto, np.int64) - starts
    # A stretch gives an end after each of its tokens; an irregular group one, where the next starts.
    run = np.repeat(np.arange(len(starts)), sizes + 1)
    ends = np.arange(len(run)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1) + starts[run]
    return ends[1:], (ends + shift[run])[1:]


def _spans(sizes: np.ndarray) -> np.ndarray:
    """0 up to each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def linked(
    a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, doc: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(document, id of A, id of B, times) of the links of groups; a pair can come several times.

    Without times each row is one link; with times the rows are different pairs, in order.
    """
    start_a, start_b = np.append(0, ends_a[:-1]), np.append(0, ends_b[:-1])
    p, q = ends_a - start_a, ends_b - start_b
    small = np.flatnonzero(p * q <= GROUP_LINKS)
    total = np.cumsum(p[small] * q[small])
    cuts = np.searchsorted(total, np.arange(LINKS, (total[-1] if len(total) else 0) + 1, LINKS))
    for some in np.split(small, cuts):
        if not len(some):
            continue
        # Every token of A once per token of B in its group ...
        at_a = np.repeat(start_a[some], p[some]) + _spans(p[some])
        width = np.repeat(q[some], p[some])
        row = np.repeat(at_a, width)
        # ... beside the group's tokens of B.
        other = np.repeat(np.repeat(start_b[some], p[some]), width) + _spans(width)
        owner = np.repeat(doc[some], p[some] * q[some])
        yield owner, a[row], b[other], None
    for g in np.flatnonzero(p * q > GROUP_LINKS):
        one, m = np.unique(a[start_a[g] : ends_a[g]], return_counts=True)
        two, k = np.unique(b[start_b[g] : ends_b[g]], return_counts=True)
        step = max(1, LINKS // len(two))
        for low in range(0, len(one), step):
            x, c = one[low : low + step], m[low : low + step]
            yield (
                np.full(len(x) * len(two), doc[g]),
                np.repeat(x, len(two)),
                np.tile(two, len(x)),
                np.outer(c, k).ravel(),
            )


class Aligner:
    """Both tokenizers, and what one batch of texts gives."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        for side in (self.a, self.b):  # an id without bytes spells no text: a byte UTF-8 hasn't
            side.bytes = [x or b"\xff" for x in side.bytes]
        self.len_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.len_b = np.array([len(x) for x in self.b.bytes], np.int64)
        self.n_b = len(self.len_b)
        # The strings that a listing of the groups is joined from: an id and what follows it.
        self.words = [
            f"{i}{mark}".encode() for n, marks in ((len(self.len_a), ",|"), (self.n_b, ",;")) for mark in marks for i in range(n)
        ]

    def batch(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """Per text n_a, n_b, n_groups, n_links, digest, its distinct pairs as codes and their times."""
        full = [i for i, t in enumerate(texts) if t]
        ids_a = self.a.encode([texts[i] for i in full])
        ids_b = self.b.encode([texts[i] for i in full])
        good = []
        for k, i in enumerate(full):
            if self.a.spells(texts[i], ids_a[k]) and self.b.spells(texts[i], ids_b[k]):
                good.append(k)
        none = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
        found = dict(zip((full[k] for k in good), self._aligned(ids_a, ids_b, good), strict=True))
        for i in range(len(texts)):
            yield found.get(i, none)

    def _aligned(self, ids_a: list[list[int]], ids_b: list[list[int]], good: list[int]) -> Iterator[tuple]:
        if not good:
            return
        a, b = (
            np.fromiter(chain.from_iterable(ids[k] for k in good), np.int64) for ids in (ids_a, ids_b)
        )
        ends_a, ends_b = align(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        # Texts end where both tokenizers do, so no group spans two texts.
        last_a = np.fromiter(accumulate(len(ids_a[k]) for k in good), np.int64, len(good))
        last_b = np.fromiter(accumulate(len(ids_b[k]) for k in good), np.int64, len(good))
        doc = np.searchsorted(last_a, ends_a, "left")
        p, q = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        n_groups = np.bincount(doc, minlength=len(good))
        n_links = np.zeros(len(good), np.int64)
        np.add.at(n_links, doc, p * q)
        keys, times = self._distinct(a, b, ends_a, ends_b, doc)
        cuts = np.searchsorted(keys // (len(self.len_a) * self.n_b), np.arange(1, len(good)))
        codes = keys % (len(self.len_a) * self.n_b)
        digests = self._digests(a, b, ends_a, ends_b, last_a + last_b)
        yield from zip(
            np.diff(last_a, prepend=0).tolist(),
            np.diff(last_b, prepend=0).tolist(),
            n_groups.tolist(),
            n_links.tolist(),
            digests,
            np.split(codes, cuts),
            np.split(times, cuts),
            strict=True,
        )

    def _distinct(self, a, b, ends_a, ends_b, doc) -> tuple[np.ndarray, np.ndarray]:
        """Document and pair as one code, sorted, and how often the document links the pair."""
        parts = []
        for owner, x, y, n in linked(a, b, ends_a, ends_b, doc):
            code = (owner * len(self.len_a) + x) * self.n_b + y
            parts.append(np.unique(code, return_counts=True) if n is None else (code, n))
        if len(parts) == 1:
            return parts[0]
        code, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return code, np.bincount(back, np.concatenate([n for _, n in parts]), len(code)).astype(np.int64)

    def _digests(self, a, b, ends_a, ends_b, last: np.ndarray) -> list[str]:
        """Per text the hash of its groups' ids, listed one group after the other."""
        closes_a, closes_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        closes_a[ends_a - 1] = closes_b[ends_b - 1] = True
        n_a = len(self.len_a)
        # A group's ids of B follow those of A: a token stands after the other side's tokens before.
        in_a = np.searchsorted(ends_a, np.arange(len(a)), "right")
        in_b = np.searchsorted(ends_b, np.arange(len(b)), "right")
        listed = np.empty(len(a) + len(b), np.int64)
        listed[np.arange(len(a)) + np.append(0, ends_b)[in_a]] = a + n_a * closes_a
        listed[np.arange(len(b)) + ends_a[in_b]] = 2 * n_a + b + self.n_b * closes_b
        out = []
        for low, high in zip(np.append(0, last[:-1]), last, strict=True):
            line = b"".join(map(self.words.__getitem__, listed[low:high].tolist()))
            out.append(hashlib.sha256(line[:-1]).hexdigest())
        return out


@functools.lru_cache(maxsize=1)
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """Both tokenizers, kept by a worker from task to task."""
    return Aligner(path_a, path_b)


def _small(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """Ids and texts, a bounded number of bytes at a time."""
    for batch in batches:
        size = batch.column(1).cast(pa.large_string())
        offsets = np.frombuffer(size.buffers()[1], np.int64)[size.offset : size.offset + len(size) + 1]
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + BATCH_BYTES, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows, low + 4096)
            part = batch.slice(low, high - low)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()
            low = high


def _chunk(chunk: int, docs: list[tuple], n_b: int) -> Iterator[pa.RecordBatch]:
    """A chunk's documents, and its distinct pairs with the number of its documents."""
    codes, place, held = np.unique(
        np.concatenate([d[6] for d in docs]), return_inverse=True, return_counts=True
    )
    cuts = np.concatenate([[0], np.cumsum([len(d[6]) for d in docs])]).astype(np.int32)
    times = np.concatenate([d[7] for d in docs])
    n = len(docs)
    columns = {
        "chunk": pa.array(np.full(n, chunk)),
        **{name: pa.array([d[k] for d in docs], _ENCODED.field(name).type) for k, name in enumerate(_ENCODED.names[1:7])},
        "pairs": pa.ListArray.from_arrays(pa.array(cuts), pa.array(place.astype(np.int32))),
        "times": pa.ListArray.from_arrays(pa.array(cuts), pa.array(times)),
    }
    yield _filled(columns, n)
    for low in range(0, len(codes), 1 << 16):
        some = codes[low : low + (1 << 16)]
        yield _filled(
            {
                "chunk": pa.array(np.full(len(some), chunk)),
                "a": pa.array((some // n_b).astype(np.int32)),
                "b": pa.array((some % n_b).astype(np.int32)),
                "place": pa.array(np.arange(low, low + len(some), dtype=np.int32)),
                "docs": pa.array(held[low : low + len(some)].astype(np.int64)),
            },
            len(some),
        )


def _filled(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _ENCODED], schema=_ENCODED
    )


def encoded(docs: DataFrame, path_a: str, path_b: str, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """Rows of two kinds, by chunk: documents (``place`` is null), and the chunk's distinct pairs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        chunk = (context.partitionId() if context else 0) << 32
        aligner = aligner_of(path_a, path_b)
        held: list[tuple] = []
        size = 0
        for ids, texts in _small(batches):
            for doc_id, made in zip(ids, aligner.batch(texts), strict=True):
                held.append((doc_id, *made))
                size += len(made[5]) + 1
            if size >= chunk_pairs:
                yield from _chunk(chunk, held, aligner.n_b)
                chunk, held, size = chunk + 1, [], 0
        if held:
            yield from _chunk(chunk, held, aligner.n_b)

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def pair_counts(coded: DataFrame) -> DataFrame:
    """Per chunk and place the pair's count, and whether it is its id of A's highest."""
    pairs = coded.where("place IS NOT NULL").select("chunk", "place", "a", "b", "docs")
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    # No more rows than A's vocabulary, whatever the corpus.
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    judged = counts.join(F.broadcast(best), "a").select(
        "a", "b", "count", (F.col("count") == F.col("most")).alias("best")
    )
    return pairs.join(judged, ["a", "b"]).select("chunk", "place", "count", "best")


_SCORED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string"
)


def _scores(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    count = np.zeros(pairs.num_rows, np.int64)
    best = np.zeros(pairs.num_rows, np.int64)
    place = pairs["place"].to_numpy()
    count[place] = pairs["count"].to_numpy()
    best[place] = pairs["best"].to_numpy().astype(np.int64)
    n_best, count_sum = [], []
    for part in docs.select(["pairs", "times"]).to_batches():
        at, times = part.column(0).flatten().to_numpy(), part.column(1).flatten().to_numpy()
        lengths = part.column(0).value_lengths().to_numpy()
        cuts = np.append(0, np.cumsum(lengths))
        for value, into in ((best, n_best), (count, count_sum)):
            sums = np.append(0, np.cumsum(value[at] * times))
            into.append(sums[cuts[1:]] - sums[cuts[:-1]])
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(np.concatenate(n_best)))
    out = out.append_column("count_sum", pa.array(np.concatenate(count_sum)))
    return out.append_column("groups_sha256", docs["groups_sha256"])


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, chunk_pairs: int = CHUNK_PAIRS
) -> DataFrame:
    """One row per document: its tokens, groups and links, and how its links stand in the corpus.

    ``n_best``: links whose pair is held linked by as many documents as any pair of its id of A;
    ``count_sum``: documents that hold the pair linked, added up over links. ``path_a`` is a
    byte-level vocabulary for tokenizers, ``path_b`` a sentencepiece model; every executor needs
    them at the same place.
    """
    coded = stage(encoded(docs, path_a, path_b, chunk_pairs), "aligned")
    # The two sides of the cogroup name their chunk anew: they come from one table.
    own = coded.where("place IS NULL").select(
        F.col("chunk").alias("own"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"
    )

    counts = pair_counts(coded).withColumnRenamed("chunk", "of")
    return own.groupBy("own").cogroup(counts.groupBy("of")).applyInArrow(_scores, _SCORED)


def vocabulary_map(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per id of A the ids of B that most documents hold linked to it, with their count; ties stay."""
    coded = encoded(docs, path_a, path_b).where("place IS NOT NULL")
    counts = coded.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    most = F.struct("count", "b")
    return (
        counts.groupBy("a")
        .agg(F.max("count").alias("count"), F.collect_list(most).alias("all"))
        .select("a", F.expr("sort_array(transform(filter(all, x -> x.count = count), x -> x.b))").alias("b"), "count")
    )
