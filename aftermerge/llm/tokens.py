"""Token ids by a public tokenizer, and the exact histogram of encoded lengths.

The tokenizer drops white space and never joins characters across it, so a text's ids are its
words' ids in a row; a worker remembers the ids of words it has met (a bounded cache).
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aftermerge.llm.common import CACHED_WORDS, as_bytes, byte_level, slices, stage

#: The id that ends every document.
END = 2


# How the one known kind of vocabulary with word ends normalises and cuts text.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"

#: Words of ASCII and Latin letters: nothing but case is normalised there, and this cuts them alike.
_PLAIN = re.compile("[!-~\u00c0-\u00ff]+")
_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+"
)

#: A byte that no UTF-8 holds stands for the end of a word.
_END_BYTE = b"\xff"


def merge_ranks(document: dict) -> dict[bytes, int] | None:
    """Ids by their bytes if a tokenizer's file is of the known kind, else None.

    Known: it normalises and cuts as above, ends words by a mark, and has an id for each merge in
    the order of the merges, so that merging the pair that makes the least id follows the list.
    """
    model, normal, cut = (document[k] or {} for k in ("model", "normalizer", "pre_tokenizer"))
    steps = cut.get("pretokenizers", [])
    if (
        model.get("type") != "BPE"
        or model.get("end_of_word_suffix") != _WORD_END
        or any(model.get(k) for k in ("unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "dropout"))
        or [n.get("type") for n in normal.get("normalizers", [])] != _NORMAL
        or [x.get("type") for x in steps] != ["Split", "ByteLevel"]
        or (steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"]) != ({"Regex": _CUT}, "Removed", True)
        or steps[1]["add_prefix_space"]
        or steps[1]["use_regex"]
    ):
        return None
    vocabulary = model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [vocabulary["".join(pair)] for pair in merges]
    if ids != [*range(512, 512 + len(ids))] or len(vocabulary) != 512 + len(ids):
        return None
    byte = byte_level()
    ranks = {}
    for entry, i in vocabulary.items():
        ends = entry.endswith(_WORD_END) and len(entry) > len(_WORD_END)
        spelled = entry[: -len(_WORD_END)] if ends else entry
        ranks[bytes(map(byte.__getitem__, spelled)) + _END_BYTE * ends] = i
    return ranks


class WordIds(dict):
    """Word (UTF-8) to its ids as little-endian unsigned 32-bit integers.

    Where the tokenizer is of the known kind, the pieces of a plain word are merged directly; any
    other word, and every word of another tokenizer, takes the whole way.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = None
        with open(path, encoding="utf-8") as file:
            ranks = merge_ranks(json.load(file))
        if ranks:
            import tiktoken

            made = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
            self.merge = made._core_bpe.encode_single_piece

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        text = word.decode("utf-8", "replace")
        # A special token's string in a text is that token, for the tokenizer.
        if self.merge is not None and "<|" not in text and _PLAIN.fullmatch(text):
            pieces = _PIECES.findall(text.lower())
            ids = [i for piece in pieces for i in self.merge(piece.encode() + _END_BYTE)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        packed = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return packed

    def of(self, text: bytes | None) -> bytes:
        """The ids of a whole text; none for null."""
        return b"".join(map(self.__getitem__, text.split())) if text else b""


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The ids of words, kept by a worker from task to task."""
    return WordIds(path)


def encoded_lengths(docs: DataFrame, tokenizer: str, keep: Sequence[str] = ()) -> DataFrame:
    """Per document the columns ``keep`` and ``tokens`` (null or empty text: 0)."""
    narrow = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[:-1]), "tokens long"])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer)
        for batch in slices(batches):
            lengths = [len(ids.of(t)) // 4 for t in as_bytes(batch.column(batch.num_columns - 1))]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lengths, pa.int64())], names=[*keep, "tokens"]
            )

    return narrow.mapInArrow(encode, schema)


def length_histogram(
    docs: DataFrame, tokenizer: str, by: Sequence[str] = (), block: int = 1024
) -> DataFrame:
    """Exact histogram of encoded lengths with suffix sums: one row per group and length.

    ``docs``, ``tokens``: documents of this ``length`` and their tokens. ``docs_over``,
    ``tokens_over``: those of longer documents. ``docs_up_to``: documents that fit whole into a
    context of this length. ``tokens_truncated``: tokens left if every document is cut at it.
    ``quantile``: the share of documents up to this length. For a limit L that no document has,
    the row of the next shorter length answers: with its ``docs_over``, the truncated total is
    ``total_tokens - tokens_over + L * docs_over``.

    Documents are counted before they are shuffled, a row per task and length; the histogram is
    staged, so texts are encoded once. Sums run within blocks of ``block`` lengths and over the blocks' totals, so no task sees all
    lengths. Null texts count as length 0; a null in a column of ``by`` is a group of its own; an
    empty table gives an empty result; repeated rows count each.
    """
    lengths = encoded_lengths(docs, tokenizer, by)
    counted = lengths.groupBy(*by, F.col("tokens").alias("length")).agg(F.count(F.lit(1)).alias("docs"))
    bars = (
        stage(counted, "lengths")
        .withColumn("tokens", F.col("length") * F.col("docs"))
        .withColumn("__block", F.floor(F.col("length") / block))
    )
    after = (Window.currentRow + 1, Window.unboundedFollowing)
    inner = Window.partitionBy(*by, "__block").orderBy("length").rowsBetween(*after)
    outer = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__block").rowsBetween(*after)
    everything = Window.partitionBy(*(by or [F.lit(0)]))
    totals = (
        bars.groupBy(*by, "__block")
        .agg(F.sum("docs").alias("__d"), F.sum("tokens").alias("__t"))
        .select(
            *by,
            "__block",
            F.coalesce(F.sum("__d").over(outer), F.lit(0)).alias("__docs_later"),
            F.coalesce(F.sum("__t").over(outer), F.lit(0)).alias("__tokens_later"),
            F.sum("__d").over(everything).alias("total_docs"),
            F.sum("__t").over(everything).alias("total_tokens"),
        )
    )
    a, b = bars.alias("a"), totals.alias("b")
    same = F.col("a.__block") == F.col("b.__block")
    for name in by:
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    later = (
        a.join(b, same)
        .select("a.*", "b.__docs_later", "b.__tokens_later", "b.total_docs", "b.total_tokens")
        .withColumn("docs_over", F.coalesce(F.sum("docs").over(inner), F.lit(0)) + F.col("__docs_later"))
        .withColumn(
            "tokens_over", F.coalesce(F.sum("tokens").over(inner), F.lit(0)) + F.col("__tokens_later")
        )
    )
    return later.select(
        *by,
        "length",
        "docs",
        "tokens",
        (F.col("total_docs") - F.col("docs_over")).alias("docs_up_to"),
        "docs_over",
        "tokens_over",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias(
            "tokens_truncated"
        ),
        ((F.col("total_docs") - F.col("docs_over")) / F.col("total_docs")).alias("quantile"),
        "total_docs",
        "total_tokens",
    )
