"""Cross-tokenizer alignment against groups found from the sets of ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aftermerge.llm import alignment
from aftermerge.llm.queries import QUERIES, public_tokenizer

SF = "/root/testdata/sf0.001"
A, B = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("piece_bpe_32k.model")
ODD = [
    None,
    "",
    " ",
    "\n",
    "Hello world",
    "Hello world",
    " lead",
    "a  b\n\tc",
    "<|endoftext|> <s> x </s> <0x41>",
    "é東京 🎉 zzz ﬁ ½ ①",
    "a mark ▁ that B reads as a space",
    "\x00nul",
    "the cat　sat",
    "a" * 3000,
    " " * 500,
    "🎉" * 700,
    "Straße und ΣΑΣ " * 300,
]
RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rising(rng: random.Random, last: int) -> list[int]:
    return [*sorted(rng.sample(range(1, last), rng.randint(0, last - 1))), last]


def test_align_finds_every_common_end() -> None:
    rng = random.Random(1)
    for _ in range(2000):
        last = rng.randint(1, 60)
        a, b = rising(rng, last), rising(rng, last)
        if rng.random() < 0.5:  # long one-to-one stretches with a few changes
            a = [*range(1, 200), *(x + 199 for x in a)]
            b = [*range(1, 200), *(x + 199 for x in b)]
            b.remove(rng.randint(1, 199))
        common = sorted({*a} & {*b})
        ends_a, ends_b = alignment.align(a, b)
        assert list(ends_a) == [a.index(c) + 1 for c in common]
        assert list(ends_b) == [b.index(c) + 1 for c in common]


def expected(texts: list[str | None]) -> list[tuple]:
    aligner = alignment.Aligner(A, B)
    made: list[tuple | None] = []
    for text in texts:
        made.append(None)
        if not text:
            continue
        ids = [side.encode([text])[0] for side in (aligner.a, aligner.b)]
        spelled = [[side.bytes[i] for i in own] for side, own in zip((aligner.a, aligner.b), ids, strict=True)]
        if any(b"".join(s) != b" " + text.encode() for s in spelled):
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        groups, at = [], (0, 0)
        for c in sorted({*ends[0]} & {*ends[1]}):
            upto = ends[0].index(c) + 1, ends[1].index(c) + 1
            groups.append((ids[0][at[0] : upto[0]], ids[1][at[1] : upto[1]]))
            at = upto
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        line = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        made[-1] = (*map(len, ids), len(groups), links, hashlib.sha256(line.encode()).hexdigest())
    counts = Counter(pair for m in made if m for pair in m[3])
    most: dict[int, int] = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if m is None
        else (
            *m[:3],
            sum(m[3].values()),
            sum(n for pair, n in m[3].items() if counts[pair] == most[pair[0]]),
            sum(n * counts[pair] for pair, n in m[3].items()),
            m[4],
        )
        for m in made
    ]


@pytest.mark.parametrize(("chunk_pairs", "group_links", "links"), [(1 << 21, 4096, 1 << 20), (200, 5, 37)])
def test_alignment_matches_brute_force(
    spark: SparkSession, monkeypatch: pytest.MonkeyPatch, chunk_pairs: int, group_links: int, links: int
) -> None:
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(30).collect()
    rows = [*enumerate([*ODD, *(r["text"] for r in docs)])]
    # Columns named like the operator's own are not read.
    df = spark.createDataFrame([(i, t, 1, "x", None) for i, t in rows], "doc_id long, text string, chunk int, pairs string, `a.b` int")
    monkeypatch.setattr(alignment, "GROUP_LINKS", group_links)
    monkeypatch.setattr(alignment, "LINKS", links)
    out = alignment.align_tokenizers(df.repartition(3), A, B, chunk_pairs).collect()
    got = {r["doc_id"]: tuple(r[c] for c in RESULT) for r in out}
    want = dict(zip((i for i, _ in rows), expected([t for _, t in rows]), strict=True))
    assert len(out) == len(rows)
    assert got == want


def test_quick_ways_give_the_tokenizers_ids() -> None:
    """Of every kind of character, beside letters, digits, spaces and itself."""
    aligner = alignment.Aligner(A, B)
    assert aligner.a.quick is not None and aligner.b.merge is not None
    kinds = [c for c in map(chr, [*range(0x3000), *range(0x3000, 0x30000, 97), 0x1F389]) if not "\ud800" <= c <= "\udfff"]
    texts = [f"a{c}b {c}1{c}{c} \n{c}! {c}" for c in kinds]
    rng = random.Random(7)
    texts += ["".join(rng.choices("aZé'’1中 \t\n.,!|<>\u0301\u00a0\u3000🎉'st'll", k=rng.randint(1, 80))) for _ in range(3000)]
    texts += [" " * 100_000, "a" * 100_000, "\n" * 5000 + "x", "x " * 400 + " " * 300 + "y", "1" * 5000]
    spaced = [" " + t for t in texts]
    whole = [e.ids for e in aligner.a.tokenizer.encode_batch(spaced, add_special_tokens=False)]
    assert aligner.a.encode(texts) == whole
    plain = [t for t in texts if "▁" not in t]  # which B reads as a space
    for _ in range(2):  # also from the cache
        assert aligner.b.encode(plain) == aligner.b.model.encode(plain)


def test_small_links_are_laid_out_alike(monkeypatch: pytest.MonkeyPatch) -> None:
    rng = np.random.default_rng(2)
    p, q = rng.integers(1, 9, 50), rng.integers(1, 9, 50)
    a, b = rng.integers(0, 5, p.sum()), rng.integers(0, 5, q.sum())
    ends_a, ends_b, doc = np.cumsum(p), np.cumsum(q), np.arange(50) // 7

    def counted() -> Counter:
        out: Counter = Counter()
        for owner, x, y, n in alignment.linked(a, b, ends_a, ends_b, doc):
            times = [1] * len(x) if n is None else n.tolist()
            for key, m in zip(zip(owner.tolist(), x.tolist(), y.tolist(), strict=True), times, strict=True):
                out[key] += m
        return out

    whole = counted()
    monkeypatch.setattr(alignment, "GROUP_LINKS", 9)
    monkeypatch.setattr(alignment, "LINKS", 11)
    assert counted() == whole
    assert sum(whole.values()) == (p * q).sum()


def test_nulls_and_empty_tables(spark: SparkSession) -> None:
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(empty, A, B).count() == 0
    odd = spark.createDataFrame([(None, "x y"), (None, None), (1, "x y"), (1, "x y")], "doc_id long, text string")
    out = alignment.align_tokenizers(odd, A, B).orderBy("n_a", "doc_id").collect()
    assert [r["doc_id"] for r in out] == [None, None, 1, 1]
    assert [r["count_sum"] for r in out] == [0, 6, 6, 6]  # repeated rows count each


def test_vocabulary_map_has_the_most_frequent_pairs(spark: SparkSession) -> None:
    docs = spark.createDataFrame([(1, "Hello world"), (2, "Hello there"), (3, "world")], "doc_id long, text string")
    aligner = alignment.Aligner(A, B)
    (a, _), (b, _) = (side.encode(["Hello world"])[0] for side in (aligner.a, aligner.b))
    found = {r["a"]: (r["b"], r["count"]) for r in alignment.vocabulary_map(docs, A, B).collect()}
    assert found[a] == ([b], 2)


def test_query(spark: SparkSession) -> None:
    out = QUERIES["op11_tokenizer_alignment"](spark, SF)
    assert out.columns == ["doc_id", *RESULT]
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.where((F.col("n_best") > F.col("n_links")) | (F.col("n_groups") > F.col("n_a"))).isEmpty()
