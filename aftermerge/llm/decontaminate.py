"""Benchmark decontamination by spaced-seed hashing.

A seed is a mask over a window of tokens: it hashes the positions it keeps and ignores the others,
so a window still matches when an ignored token was substituted. Windows of the benchmark and of
the documents are joined on their hashes; around each hit the two token sequences are compared
in place, without gaps, and the longest stretch that tolerates few substitutions is kept.

Both sides are cut into tokens by the same code, in tasks. Documents are read once: a filter of
bounded size, made of the benchmark's hashes, lets through the windows that may match, and only
documents with such windows are written on, with their text. The rest is joins over those: hits
meet the benchmark's windows by hash, and pairs of a document and an item fetch both texts to be
verified. Equal windows in a row, as of one word repeated, are one row with a length, and a pair
of such rows is a range of shifts. Nothing of the benchmark passes through the driver but the
filter.

Defined cases: null and empty texts and items match nothing; an item shorter than the shortest
overlap is compared whole, its first and last tokens too may differ; Unicode white space cuts
tokens as ASCII white space does; repeated rows (same doc_id and text) count as one; an empty table
on either side gives an empty result; items are told apart by item_id, and equal item_ids are one
item's parts; other columns are not read, or pass through ``drop_contaminated`` untouched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aftermerge.llm.common import (
    TOKEN_ENDS,
    lower_ascii,
    mix,
    packed,
    raw_text,
    row_key,
    slices,
    stage,
    unpacked,
    word_codes,
)

#: An overlap counts from this many tokens (or the whole item if it is shorter) ...
LEAST_TOKENS = 13
#: ... of which at most this share differs.
MOST_DIFFERENT = 0.2

#: Seeds of weight 7 in at most 13 tokens: 1 keeps a position, 0 ignores it. Wherever a fifth of 13
#: to 25 tokens is substituted, one of them lies on kept tokens only (tested for every pattern); a
#: longer stretch can be cut into such ones, of which one differs in a fifth at most.
MASKS = ("1111111", "11110111", "110011111", "11101001011", "1110100010011", "1001001010111")

#: Bits of the filter for each window of the benchmark, and at most (32 MB). Beyond that it lets
#: more windows through, which costs time and changes nothing.
BITS_PER_WINDOW, MOST_BITS = 32, 1 << 28

#: The same for whole items of fewer tokens, by their number; below five none may differ.
SHORT_MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111"),
    8: ("111111", "1111011", "1101111"),
    9: ("1111111", "11111011", "11101111", "11011111"),
    10: ("1111011", "11001111", "110110011", "11110101", "10101111"),
    11: ("11101111", "110111011", "111110101", "1110100111", "11011010011", "1100011111", "1111111"),
    12: ("11110111", "1100101111", "11011001011", "1111111", "11111101"),
}


SCHEMA = (
    "doc_id long, row long, item_id long, doc_start long, item_start long, tokens long, different long"
)


def window_hashes(codes: np.ndarray, mask: str) -> np.ndarray:
    """A hash per window of ``codes``, over the positions that ``mask`` keeps."""
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i, kept in enumerate(mask):
        if kept == "1":
            out += codes[i : i + n] * mix(np.uint64([2 * i + 1]))
    return mix(out)


def run_mask(n: int, share: float) -> str:
    """Tokens in a row that are equal wherever at most ``share`` of ``n`` tokens differs."""
    wrong = int(share * n + 1e-9)
    return "1" * max(1, -(-(n - wrong) // (wrong + 1)))


def seeds(least: int, share: float) -> tuple[str, ...]:
    """Masks that miss no stretch of ``least`` tokens or more of which ``share`` differs."""
    if (least, share) == (LEAST_TOKENS, MOST_DIFFERENT):
        return MASKS
    return (min((run_mask(n, share) for n in range(least, 2 * least)), key=len),)


def short_seeds(n: int, share: float) -> tuple[str, ...]:
    """Masks that miss no whole item of ``n`` tokens of which ``share`` differs."""
    if share == MOST_DIFFERENT and n in SHORT_MASKS:
        return SHORT_MASKS[n]
    return (run_mask(n, share),)


def plain_spaces(data: np.ndarray) -> np.ndarray:
    """UTF-8 with the white space beyond ASCII replaced by as many ASCII spaces as it has bytes."""
    # The white space characters of Unicode, by their first bytes.
    two = {0xC2: (0x85, 0xA0)}
    three = {0xE1: (0x9A80,), 0xE2: (*range(0x8080, 0x808B), 0x80A8, 0x80A9, 0x80AF, 0x819F), 0xE3: (0x8080,)}
    out = data
    for lead, rest in (*two.items(), *three.items()):
        wide = 2 if lead in two else 3
        at = np.flatnonzero(data[: len(data) - wide + 1] == lead)
        if not len(at):
            continue
        value = data[at + 1].astype(np.int64)
        if wide == 3:
            value = value << 8 | data[at + 2]
        at = at[np.isin(value, rest)]
        if len(at):
            out = data.copy() if out is data else out
            out[(at[:, None] + np.arange(wide)).ravel()] = 0x20
    return out


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all tokens of the texts in a row, and where each text's begin (the last: end)."""
    data, starts = raw_text(column)
    codes, first = word_codes(lower_ascii(plain_spaces(data)), starts, TOKEN_ENDS)
    return codes, np.searchsorted(first, starts)


def windows(
    codes: np.ndarray, starts: np.ndarray, masks: Sequence[str], lets: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per mask (text, hash, place, length) of the windows of texts in a row.

    Equal windows one after the other are one, of that ``length``. ``lets``: a filter's words.
    """
    for mask in masks:
        own = window_hashes(codes, mask)
        own ^= mix(np.uint64([int("1" + mask, 2)]))
        at = np.arange(len(own)) if lets is None else passing(own, lets)
        text = np.searchsorted(starts, at, "right") - 1
        inside = at + len(mask) <= starts[text + 1]
        at, text = at[inside], text[inside]
        if not len(at):
            continue
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (own[at[1:]] != own[at[:-1]]) | (text[1:] != text[:-1])
        head = np.flatnonzero(new)
        yield text[head], own[at[head]], at[head] - starts[text[head]], np.diff(np.append(head, len(at)))


def probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The three bits of each hash in a filter of ``bits``, a power of two."""
    for turn in range(3):
        yield mix(hashes + np.uint64(turn)) & np.uint64(bits - 1)


def passing(hashes: np.ndarray, lets: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter lets through."""
    at = np.arange(len(hashes))
    for turn in range(3):
        bit = mix(hashes[at] + np.uint64(turn)) & np.uint64(64 * len(lets) - 1)
        at = at[(lets[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) != 0]
    return at


def filter_of(made: DataFrame) -> np.ndarray:
    """A filter that lets every hash ``h`` of ``made`` through, as 64-bit words."""
    want = max(1, made.count()) * BITS_PER_WINDOW
    bits = min(MOST_BITS, max(1 << 16, 1 << (want - 1).bit_length()))

    def set_bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            for bit in probes(hashes, bits):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(bit).view(np.int64))], names=["bit"])

    def block(table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << 16, np.uint8)
        bit = table["bit"].to_numpy()
        flags[bit & 0xFFFF] = 1
        raw = np.packbits(flags, bitorder="little").tobytes()
        return pa.table({"block": pa.array([int(bit[0]) >> 16]), "bits": pa.array([raw], pa.binary())})

    places = made.select("h").mapInArrow(set_bits, "bit long").distinct()
    blocks = places.groupBy(F.shiftright("bit", 16).alias("block")).applyInArrow(block, "block long, bits binary")
    lets = np.zeros(bits // 64, np.uint64)
    for row in blocks.toLocalIterator():  # 8 KB each, at most MOST_BITS together
        lets[row["block"] << 10 : (row["block"] + 1) << 10] = np.frombuffer(row["bits"], "<u8")
    return lets


def item_windows(benchmark: DataFrame, least: int, share: float) -> DataFrame:
    """The windows of the items: ``h``, ``item_row``, ``place``, ``length`` and the item's ``tokens``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            rows = batch.column(0).to_numpy()
            codes, starts = tokens(batch.column(1))
            sizes = np.diff(starts)
            for n in np.unique(np.minimum(sizes, least)).tolist():
                masks = seeds(least, share) if n >= least else short_seeds(n, share) if n else ()
                for text, h, place, length in windows(codes, starts, masks):
                    of = np.minimum(sizes[text], least) == n
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h[of].view(np.int64)),
                            pa.array(rows[text[of]]),
                            pa.array(place[of].astype(np.int32)),
                            pa.array(length[of].astype(np.int32)),
                            pa.array(np.minimum(sizes[text[of]], least).astype(np.int32)),
                        ],
                        names=["h", "item_row", "place", "length", "tokens"],
                    )

    items = benchmark.where("text IS NOT NULL").select(F.xxhash64("item_id", "text").alias("item_row"), "text")
    schema = "h long, item_row long, place int, length int, tokens int"
    return items.dropDuplicates(["item_row"]).mapInArrow(run, schema)


def hit_documents(docs: DataFrame, lets: np.ndarray, masks: Sequence[str]) -> DataFrame:
    """Documents with windows that the filter lets through: ``row``, ``doc_id``, ``text``, ``hits``."""
    shared = docs.sparkSession.sparkContext.broadcast(lets)
    kind = pa.struct([("h", pa.int64()), ("place", pa.int32()), ("length", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            codes, starts = tokens(batch.column(2))
            found = [*windows(codes, starts, masks, shared.value)]
            if not found:
                continue
            text, h, place, length = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(text, kind="stable")
            which, first = np.unique(text[order], return_index=True)
            hits = pa.StructArray.from_arrays(
                [
                    pa.array(h[order].view(np.int64)),
                    pa.array(place[order].astype(np.int32)),
                    pa.array(length[order].astype(np.int32)),
                ],
                fields=[*kind],
            )
            cuts = pa.array(np.append(first, len(order)).astype(np.int32))
            some = batch.take(pa.array(which))
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.ListArray.from_arrays(cuts, hits)], names=["row", "doc_id", "text", "hits"]
            )

    narrow = docs.select(row_key().alias("row"), "doc_id", "text")
    return narrow.mapInArrow(
        run, "row long, doc_id long, text string, hits array<struct<h: long, place: int, length: int>>"
    )


def tolerant_overlap(
    doc: np.ndarray, item: np.ndarray, shift: int, share: float = MOST_DIFFERENT
) -> tuple[int, int, int]:
    """The longest stretch, with the item moved by ``shift``, of which at most ``share`` differs.

    It begins and ends with equal tokens. Returns its start in the item, length and differences;
    the first of equally long ones.
    """
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if low >= high:
        return low, 0, 0
    same = item[low:high] == doc[low + shift : high + shift]
    ends = np.flatnonzero(same)
    if not len(ends):
        return low, 0, 0
    # value(i) = differences before i - share * i; a stretch [a, b) is good if value falls or stays.
    wrong = np.concatenate([[0], np.cumsum(~same)])
    value = wrong - share * np.arange(len(wrong))
    before, after = value[ends] + 1e-9, value[ends + 1]
    # The longest good stretch has its start among the running maxima of the starts.
    peaks = np.flatnonzero(before > np.concatenate([[-np.inf], np.maximum.accumulate(before)[:-1]]))
    best = (0, 0, 0)
    for j in reversed(range(len(ends))):
        k = int(np.searchsorted(before[peaks], after[j], "left"))
        if k < len(peaks) and peaks[k] <= j:
            start, length = int(ends[peaks[k]]), int(ends[j] + 1 - ends[peaks[k]])
            if length > best[1] or length == best[1] and start < best[0]:
                best = (start, length, int(wrong[ends[j] + 1] - wrong[ends[peaks[k]]]))
    return low + best[0], best[1], best[2]


def whole_overlap(doc: np.ndarray, item: np.ndarray, shift: int, share: float = MOST_DIFFERENT) -> tuple[int, int, int]:
    """The whole item, moved by ``shift``, if it lies in the document and at most ``share`` differs."""
    if shift < 0 or shift + len(item) > len(doc):
        return 0, 0, 0
    wrong = int((doc[shift : shift + len(item)] != item).sum())
    return (0, len(item), wrong) if wrong <= share * len(item) + 1e-9 else (0, 0, 0)


def longest_overlap(
    doc: np.ndarray, item: np.ndarray, shifts: np.ndarray, least: int, share: float
) -> tuple[int, int, int, int] | None:
    """Where the longest overlap over some shifts lies in both, its length and differences.

    Of equally long ones that of the least shift; None if none is long enough.
    """
    compare = tolerant_overlap if len(item) >= least else whole_overlap
    best = None
    for shift in np.unique(shifts).tolist():
        at, length, wrong = compare(doc, item, shift, share)
        if length >= min(least, len(item)) and (best is None or length > best[2]):
            best = (at + shift, at, length, wrong)
            if length == len(item):  # none is longer
                break
    return best


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    least_tokens: int = LEAST_TOKENS,
    most_different: float = MOST_DIFFERENT,
) -> DataFrame:
    """One row per different document row and item that overlap: the longest overlap of the two."""
    made = stage(item_windows(benchmark, least_tokens, most_different), "windows")
    masks: dict[str, None] = dict.fromkeys(seeds(least_tokens, most_different))
    # Lengths of short items: fewer than ``least_tokens`` values.
    for n in sorted(r["tokens"] for r in made.select("tokens").distinct().collect()):
        if n < least_tokens:
            masks |= dict.fromkeys(short_seeds(n, most_different))
    read = stage(hit_documents(docs, filter_of(made), [*masks]), "hit-documents")
    one = read.groupBy("row").agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "hits")])
    hits = read.select("row", F.inline("hits")).distinct()
    theirs = made.select("h", "item_row", F.col("place").alias("at"), F.col("length").alias("n"))
    shifts = F.struct(
        (F.col("place") - F.col("at") - F.col("n") + 1).alias("low"),
        (F.col("place") + F.col("length") - 1 - F.col("at")).alias("high"),
    )
    pairs = (
        hits.join(theirs, "h")
        .groupBy("row", "item_row")
        .agg(F.collect_set(shifts).alias("shifts"))
    )
    items = benchmark.where("text IS NOT NULL").select(
        F.xxhash64("item_id", "text").alias("item_row"), "item_id", F.col("text").alias("item")
    )
    met = pairs.join(items.dropDuplicates(["item_row"]), "item_row").join(one.drop("hits"), "row")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            (doc, cuts), (item, ends) = tokens(batch.column("text")), tokens(batch.column("item"))
            ranges = batch.column("shifts")
            flat, offsets = ranges.flatten(), np.append(0, np.cumsum(ranges.value_lengths().to_numpy()))
            low, high = (flat.field(i).to_numpy() for i in (0, 1))
            out, rows = [], []
            for k in range(batch.num_rows):
                own = slice(offsets[k], offsets[k + 1])
                found = longest_overlap(
                    doc[cuts[k] : cuts[k + 1]],
                    item[ends[k] : ends[k + 1]],
                    np.concatenate([np.arange(a, b + 1) for a, b in zip(low[own], high[own], strict=True)]),
                    least_tokens,
                    most_different,
                )
                if found:
                    out.append(found)
                    rows.append(k)
            columns = zip(*out, strict=True) if out else [()] * 4
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(c) for c in ("doc_id", "row", "item_id")] + [pa.array(c, pa.int64()) for c in columns],
                names=[f.split()[0] for f in SCHEMA.split(", ")],
            )

    names = ["doc_id", "row", "item_id", "shifts", "text", "item"]
    found = met.select(*names).mapInArrow(verify, SCHEMA)
    place = F.struct("doc_start", "item_start", "tokens", "different")
    return (
        found.groupBy("doc_id", "row", "item_id")
        .agg(F.max_by(place, F.struct("tokens", -F.col("doc_start"), -F.col("item_start"))).alias("p"))
        .select("doc_id", "row", "item_id", "p.*")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per contaminated document the items it overlaps with and its longest overlap.

    Repeated rows (same doc_id and text) give one row.
    """
    best = F.max_by(
        F.struct("item_id", "doc_start", "item_start", "tokens", "different"),
        F.struct("tokens", -F.col("different"), -F.col("item_id")),
    )
    return (
        overlaps(docs, benchmark)
        .groupBy("doc_id", "row")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), best.alias("best"))
        .select("doc_id", "item_ids", "best.*")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any overlap, with their columns."""
    bad = overlaps(docs, benchmark).select(F.col("row").alias("bad")).distinct()
    whole = packed(docs)
    key = row_key(F.col("doc")["doc_id"], F.col("doc")["text"])
    return unpacked(whole.join(bad, key == F.col("bad"), "left_anti"), docs.columns)
