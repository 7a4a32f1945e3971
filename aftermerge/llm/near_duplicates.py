"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

A document is the set of its shingles of five words. Every tree of the forest is a trie of
signatures of ``DEPTH`` MinHash values; documents meet in a trie node if they share the prefix
that leads to it. Matching begins with whole signatures, the deepest nodes. Every pair that meets is
verified on its shingles, so the links found and their similarities are known exactly, and with
them how many links the prefixes are expected to have missed: a link of similarity s is met at
depth d with the chance 1 - (1 - s^d)^trees, so it stands for one over that many. While the
expected recall is below the target, all prefixes are shortened by a value and only pairs that
newly meet are verified; at the latest it ends where even a pair right at the threshold is met
with the wanted chance.

Equal shingle sets are one set throughout, so copies are never expanded. Nodes with the same
members are kept once. A large node is dealt into blocks, and every pair of blocks is a task
(``block_tasks``); a pair is verified only in the first tree where it meets, and a task returns
a row per set, with its links counted and a spanning forest of them. So no pair is ever a row.

Defined cases: fewer than five words are one shingle; a null text or one without words is a
class of its own without links; repeated rows share their class; a null doc_id comes last in the
choice of a class's representative; an empty table gives an empty result; other columns are not
read, or pass through ``keep_one`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aftermerge.llm.common import (
    block_tasks,
    by_group,
    mix,
    packed,
    row_key,
    shingles,
    slices,
    stage,
    text_codes,
    unpacked,
)

WIDTH = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 6
RECALL = 0.99999

#: Bins of similarity that links are counted in.
BINS = 200

#: Sets of a node that meet in one block; candidate pairs looked at together.
BLOCK = 1024
PAIRS = 1 << 16

#: Buckets of the filter that spares most documents the join with candidates.
WANTED = 1 << 20

_SEEDS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64)) | np.uint64(1)


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a set of shingles: a row per tree."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(found), 2048):
        least = np.minimum(least, (_SEEDS[:, None] * found[None, low : low + 2048]).min(1))
    return (mix(least) >> np.uint64(32)).astype(np.uint32).reshape(TREES, DEPTH)


def prefixes(signatures: np.ndarray, depth: int) -> np.ndarray:
    """The trie node of each signature in every tree, at ``depth``: (sets, trees)."""
    node = np.broadcast_to(np.arange(1, signatures.shape[1] + 1, dtype=np.uint64), signatures.shape[:2])
    for level in range(depth):
        node = mix(node * np.uint64(31) + signatures[:, :, level].astype(np.uint64))
    return node


def chance(similarity: np.ndarray | float, depth: int) -> np.ndarray:
    """The chance that a pair of this similarity shares a node at ``depth`` in some tree."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** TREES


def sets_of(docs: DataFrame) -> DataFrame:
    """Per document with words: doc_id, row, its set's hash (k1, k2), its text's and a signature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            at, k1, k2, signs = [], [], [], []
            for i, codes in enumerate(text_codes(batch.column(3))):
                if len(codes):
                    found = shingles(codes, WIDTH)
                    at.append(i)
                    k1.append(mix(found).sum(dtype=np.uint64))
                    k2.append(mix(found * np.uint64(3)).sum(dtype=np.uint64))
                    signs.append(signature(found).tobytes())
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(rows) for c in range(3)),
                    pa.array(np.array(k1, np.uint64).view(np.int64)),
                    pa.array(np.array(k2, np.uint64).view(np.int64)),
                    pa.array(signs, pa.binary()),
                ],
                names=["doc_id", "row", "t", "k1", "k2", "sign"],
            )

    narrow = docs.select("doc_id", row_key().alias("row"), F.xxhash64("text").alias("t"), "text")
    return narrow.mapInArrow(run, "doc_id long, row long, t long, k1 long, k2 long, sign binary")


def distinct_sets(found: DataFrame) -> DataFrame:
    """Per distinct set its first document (doc_id, row), signature and number of distinct texts."""
    first = F.struct(F.col("doc_id").isNull().alias("m"), "doc_id", "row")
    heads = (
        found.groupBy("k1", "k2", "t")
        .agg(F.min(first).alias("f"))
        .groupBy("k1", "k2")
        .agg(F.min("f").alias("f"), F.count(F.lit(1)).alias("texts"))
        .select("k1", "k2", "texts", "f.doc_id", "f.row")
    )
    signs = found.select("row", "sign").join(heads.select("row", "k1", "k2", "texts", "doc_id"), "row")
    return signs.dropDuplicates(["row"])  # repeated rows have equal signatures


def _members(sets: DataFrame, depth: int) -> DataFrame:
    """A row per set and tree: the node it lies in."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32)
            nodes = prefixes(signs.reshape(-1, TREES, DEPTH), depth)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes.ravel().view(np.int64)),
                    pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(nodes))),
                    pa.array(np.repeat(batch.column(0).to_numpy(), TREES)),
                ],
                names=["node", "tree", "k1"],
            )

    return sets.select("k1", "sign").mapInArrow(run, "node long, tree int, k1 long")


def _meetings(sets: DataFrame, depth: int, block: int) -> DataFrame:
    """The members of nodes with two sets or more as tasks; of equal nodes the first tree's."""
    members = _members(sets, depth)
    sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = stage(members.join(sizes, "node"), "members")
    spread = F.xxhash64("k1")
    nodes = (
        shared.groupBy("node", "_n")
        .agg(
            F.bit_xor(spread).alias("a"),
            F.bit_xor(F.xxhash64(spread, F.lit(1))).alias("b"),
            F.min("tree").alias("tree"),
        )
        .groupBy("_n", "a", "b")
        .agg(F.min(F.struct("tree", "node")).alias("f"))
        .select("f.node")
    )
    return block_tasks(shared.join(nodes, "node", "left_semi"), "node", "_n", "k1", block).drop("node")


def _texts(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the first documents of the wanted sets: k1, texts, text."""
    rows = stage(sets.select("k1", "row", "texts").join(wanted, "k1", "left_semi"), "wanted")
    marks = np.zeros(WANTED, bool)
    bucket = F.pmod(F.col("row"), F.lit(WANTED))
    marks[rows.select(bucket.alias("b")).distinct().toArrow()["b"].to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def few(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value[batch.column(0).to_numpy() % WANTED]))

    texts = docs.select(row_key().alias("row"), "text").mapInArrow(few, "row long, text string")
    # Repeated rows have the same text; one of them is enough.
    return (
        texts.join(rows, "row").groupBy("k1", "texts").agg(F.first("text").alias("text"))
    )


class _Task:
    """The sets of one task, and which pairs of them are its own to verify."""

    def __init__(
        self, sets: list[np.ndarray], side: np.ndarray, tree: int, depth: int, first: bool = True
    ) -> None:
        self.sets, self.side, self.tree = sets, side, tree
        self.size = np.array([len(s) for s in sets])
        signs = np.stack([signature(s) for s in sets])
        self.node = prefixes(signs, depth)
        #: The nodes one value deeper, where pairs met in an earlier round.
        self.deeper = None if first else prefixes(signs, depth + 1)

    def pairs(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate pairs, at most about ``PAIRS`` at a time."""
        n = len(self.sets)
        two = self.side.min() != self.side.max()
        left = np.flatnonzero(self.side == 0) if two else np.arange(n)
        right = np.flatnonzero(self.side == 1) if two else np.arange(n)
        step = max(1, PAIRS // max(1, len(right)))
        for low in range(0, len(left), step):
            i = np.repeat(left[low : low + step], len(right))
            j = np.tile(right, len(left[low : low + step]))
            small, large = np.minimum(self.size[i], self.size[j]), np.maximum(self.size[i], self.size[j])
            ok = small >= threshold * large - 1e-9
            if not two:
                ok &= i < j
            i, j = i[ok], j[ok]
            same = self.node[i] == self.node[j]
            ok = same.argmax(1) == self.tree
            if self.deeper is not None:
                ok[ok] = ~(self.deeper[i[ok]] == self.deeper[j[ok]]).any(1)
            if ok.any():
                yield i[ok], j[ok]

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Shingles that the pairs have in common."""
        if len(i) < 8:
            both = zip(i.tolist(), j.tolist(), strict=True)
            return np.array([len(np.intersect1d(self.sets[a], self.sets[b], True)) for a, b in both])
        others = np.unique(j)
        flat = np.concatenate([self.sets[k] for k in others])
        owner = np.repeat(np.arange(len(others)), self.size[others])
        by = np.argsort(flat)
        flat, owner = flat[by], owner[by]
        out = np.empty(len(i), np.int64)
        order = np.argsort(i, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(i[order]) != 0]))
        for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
            own = self.sets[i[order[a]]]
            low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
            count = high - low
            at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
            hits = np.bincount(owner[at], minlength=len(others))
            out[order[a:b]] = hits[np.searchsorted(others, j[order[a:b]])]
        return out


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each one's component under the links (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verified(tasks: DataFrame, depth: int, threshold: float, first: bool) -> DataFrame:
    """Per task and linked set the root of its component there and its number of linked texts; and,
    with ``bin`` set, how many links the task found of a similarity."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, "task"):
            task = table["task"].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1], [True]]))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = table.slice(a, b - a)
                side = part["side"].to_numpy()
                if len(side) < 2 or side.min() == 1:
                    continue
                found = [shingles(c, WIDTH) for c in text_codes(part["text"].combine_chunks())]
                group = _Task(found, side, int(part["tree"][0].as_py()), depth, first)
                names, texts = part["k1"].to_numpy(), part["texts"].to_numpy()
                left, right = [], []
                alike = np.zeros(BINS + 1, np.int64)
                for i, j in group.pairs(threshold):
                    both = group.shared(i, j)
                    either = group.size[i] + group.size[j] - both
                    good = both >= threshold * either - 1e-9
                    left.append(i[good])
                    right.append(j[good])
                    alike += np.bincount(BINS * both[good] // either[good], minlength=BINS + 1)
                if not sum(map(len, left)):
                    continue
                i, j = np.concatenate(left), np.concatenate(right)
                n = len(names)
                links = (np.bincount(i, texts[j], n) + np.bincount(j, texts[i], n)).astype(np.int64)
                at, bins = np.flatnonzero(links), np.flatnonzero(alike)
                none = pa.nulls(len(bins), pa.int64())
                for columns in (
                    (names[at], names[_roots(n, i, j)[at]], links[at], pa.nulls(len(at), pa.int64())),
                    (none, none, alike[bins], bins),
                ):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns], names=["k1", "root", "links", "bin"]
                    )

    parts = tasks.repartition("task").sortWithinPartitions("task")
    return parts.mapInArrow(run, "k1 long, root long, links long, bin long")


def last_depth(threshold: float, recall: float) -> int:
    """The longest prefix with which even a pair at the threshold is found with this chance."""
    good = [d for d in range(1, DEPTH + 1) if chance(threshold, d) >= recall]
    return max(good, default=1)


def expected_recall(alike: np.ndarray, threshold: float, depth: int) -> float:
    """The share of all links that was found, from the similarities (by bin) of those found.

    A link counts as no more similar than its bin begins, and as no less than the threshold.
    """
    similarity = np.maximum(np.arange(len(alike)) / BINS, threshold)
    stands_for = (alike / chance(similarity, depth)).sum()
    return float(alike.sum() / stands_for) if stands_for else 1.0


def link_sets(
    docs: DataFrame,
    sets: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """Links of the distinct sets, task by task: k1, root and links.

    The prefixes of all trees are shortened until the expected recall reaches ``recall``.
    """
    floor = last_depth(threshold, recall)
    alike = np.zeros(BINS + 1, np.int64)
    rounds: list[DataFrame] = []
    for depth in range(DEPTH, 0, -1):
        tasks = stage(_meetings(sets, depth, block), "nodes")
        texts = _texts(docs, sets, tasks.select("k1").distinct())
        made = stage(_verified(tasks.join(texts, "k1"), depth, threshold, not rounds), "links")
        rounds.append(made.where("bin IS NULL").select("k1", "root", "links"))
        counted = made.where("bin IS NOT NULL").groupBy("bin").agg(F.sum("links").alias("n")).toArrow()
        np.add.at(alike, counted["bin"].to_numpy(), counted["n"].to_numpy())  # at most a row per bin
        if depth <= floor or expected_recall(alike, threshold, depth) >= recall:
            break
    found = rounds[0]
    for more in rounds[1:]:
        found = found.unionByName(more)
    return found


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """The least member of each vertex's component: columns ``vertex`` and ``least``.

    Least labels spread along the edges and then along themselves (a label's own label), so the
    rounds grow with the logarithm of a component's diameter. Each round is staged.
    """
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = stage(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = stage(
        both.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("n")).select(
            "vertex", F.least("vertex", "n").alias("least")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels, F.col("u") == F.col("vertex"))
            .groupBy(F.col("v").alias("vertex"))
            .agg(F.min("least").alias("near"))
        )
        spread = labels.join(near, "vertex").select(
            "vertex", F.col("least").alias("old"), F.least("least", "near").alias("mid")
        )
        own = labels.select(F.col("vertex").alias("mid"), F.col("least").alias("far"))
        new = stage(
            spread.join(own, "mid").select("vertex", "old", F.least("mid", "far").alias("least")), "labels"
        )
        if not new.where("least <> old").limit(1).count():
            return new.select("vertex", "least")
        labels = new.select("vertex", "least")


def _classes(docs: DataFrame, threshold: float, recall: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Documents with words (doc_id, row, k1, k2), and per set its class's first document and links."""
    found = stage(sets_of(docs), "sets")
    sets = stage(distinct_sets(found), "distinct")
    links = stage(link_sets(docs, sets, threshold, recall, block), "all-links")
    least = components(links, "k1", "root")
    labelled = (
        sets.drop("sign")
        .join(links.groupBy("k1").agg(F.sum("links").alias("links")), "k1", "left")
        .join(least.withColumnRenamed("vertex", "k1"), "k1", "left")
        .withColumn("label", F.coalesce("least", "k1"))
    )
    labelled = stage(labelled, "labelled")
    first = F.struct(F.col("doc_id").isNull().alias("m"), "doc_id", "row")
    heads = labelled.groupBy("label").agg(F.min(first).alias("f")).select(
        "label", F.col("f.doc_id").alias("class_id"), F.col("f.row").alias("class_row")
    )
    classes = labelled.join(heads, "label").select(
        "k1",
        "k2",
        "class_id",
        "class_row",
        (F.coalesce("links", F.lit(0)) + F.col("texts") - 1).alias("n_links"),
    )
    return found.select("doc_id", "row", "k1", "k2"), classes


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """One row per document: its class (the least doc_id of its connected documents) and its number
    of links, counted in different texts, copies of its own text aside."""
    found, classes = _classes(docs, threshold, recall, block)
    worded = found.join(classes, ["k1", "k2"]).select("doc_id", "class_id", "n_links")
    alone = docs.where(~_has_words(F.col("text"))).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return worded.unionByName(alone)


def _has_words(text: Column) -> Column:
    return F.coalesce(text.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))


def keep_one(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """The first document of every class, with its columns; of repeated rows one stays.

    Documents without words are no one's duplicates and stay.
    """
    _, classes = _classes(docs, threshold, recall, block)
    heads = classes.select(F.col("class_row").alias("head")).distinct()
    text = F.col("doc")["text"]
    whole = packed(docs).withColumn("row", row_key(F.col("doc")["doc_id"], text))
    worded = whole.where(_has_words(text))
    stay = worded.join(heads, F.col("row") == F.col("head"), "left_semi").dropDuplicates(["row"])
    return unpacked(stay.unionByName(whole.where(~_has_words(text))), docs.columns)
