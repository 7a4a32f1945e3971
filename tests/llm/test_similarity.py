"""The joins against brute force, and the word codes against Python's own split."""

from __future__ import annotations

import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aftermerge.llm import common, decontaminate, lines, near_duplicates, quality

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, row long, word string"


def corpus(seed: int, n: int = 120) -> list[tuple]:
    """Texts with copies, near copies, repeated lines, odd white space, and empty and null ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "ß|", "x y", "ñ"]

    def line(k: int) -> list[str]:
        return [rng.choice(vocabulary) for _ in range(k)]

    bases = [[line(rng.randint(1, 40)) for _ in range(rng.randint(1, 6))] for _ in range(12)]
    rows = []
    for i in range(n):
        doc = [list(x) for x in rng.choice(bases)] if rng.random() < 0.7 else [line(rng.randint(0, 30)) for _ in range(4)]
        for _ in range(rng.randint(0, 4)):
            where = rng.choice(doc)
            if where:
                where[rng.randrange(len(where))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            doc.insert(rng.randrange(len(doc) + 1), rng.choice(rng.choice(bases)))
        text = "\n".join(rng.choice([" ", "  ", "\t"]).join(x) for x in doc)
        rows.append((i, text, "en", 1, "clash"))
    rows += [(n, "", None, 2, None), (n + 1, None, None, 3, None), (n + 2, " \n\t", "x", None, "")]
    rows += [rows[0], rows[3], (None, rows[5][1], "en", 1, None), (n + 3, "one two", "en", 1, "")]
    return rows


def test_codes_are_those_of_split_words() -> None:
    texts = ["a b  a\tb", "", None, "é a b\x0bc", "b", " lead", "x"]
    found = common.text_codes(pa.array(texts, pa.string()))
    words = [(t or "").encode().split() for t in texts]
    assert [len(f) for f in found] == [len(w) for w in words]
    names: dict[bytes, int] = {}
    for codes, ws in zip(found, words, strict=True):
        for code, w in zip(codes.tolist(), ws, strict=True):
            assert names.setdefault(w, code) == code
    assert len(set(names.values())) == len(names)
    cut = pa.array(["zz", *texts], pa.string()).slice(1, 4)
    assert [f.tolist() for f in common.text_codes(cut)] == [f.tolist() for f in found[:4]]


def removed_by_hand(rows: list[tuple], threshold: float = 0.8) -> dict[tuple, str | None]:
    """The text of each document after line dedup, by comparing every line with all before it."""
    docs = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    seen: list[set[bytes]] = []
    out = {}
    for doc_id, text in docs:
        if text is None:
            out[doc_id, text] = None
            continue
        kept = []
        for raw in text.split("\n"):
            words = set(raw.encode().split())
            if not words:
                kept.append(raw)
                continue
            if not any(len(words & s) >= threshold * len(words | s) - 1e-9 for s in seen):
                kept.append(raw)
            seen.append(words)
        out[doc_id, text] = "\n".join(kept)
    return out


@pytest.mark.parametrize("block", [4, 2048])
def test_line_dedup(spark: SparkSession, block: int) -> None:
    rows = corpus(1)
    got = lines.dedup_lines(spark.createDataFrame(rows, COLUMNS).repartition(3), block=block).collect()
    want = removed_by_hand(rows)
    assert len(got) == len(rows)
    assert all(r["text"] == want[r["doc"]["doc_id"], r["doc"]["text"]] for r in got)
    assert all(r["n_removed"] >= 0 for r in got) and sum(r["n_removed"] for r in got) > 50


def test_line_dedup_of_nothing(spark: SparkSession) -> None:
    assert lines.dedup_lines(spark.createDataFrame([], COLUMNS)).count() == 0


def shingles_by_hand(text: str | None) -> frozenset:
    words = (text or "").encode().split()
    wide = min(5, len(words))
    return frozenset(tuple(words[i : i + wide]) for i in range(len(words) - wide + 1)) if words else frozenset()


def near_by_hand(rows: list[tuple]) -> dict[tuple, tuple]:
    texts = {r[1] for r in rows if shingles_by_hand(r[1])}
    sets = {t: shingles_by_hand(t) for t in texts}
    links = {
        t: {u for u in texts if u != t and 5 * len(sets[t] & sets[u]) >= 4 * len(sets[t] | sets[u])} for t in texts
    }
    out = {}
    for r in rows:
        if r[1] not in texts:
            out[r[:2]] = (r[0], 0)
            continue
        group, todo = set(), [r[1]]
        while todo:
            if (t := todo.pop()) not in group:
                group.add(t)
                todo += links[t]
        ids = [q[0] for q in rows if q[1] in group and q[0] is not None]
        out[r[:2]] = (min(ids), len(links[r[1]]))
    return out


@pytest.mark.parametrize(("block", "recall"), [(3, 0.99999), (512, 0.9)])
def test_near_duplicates(spark: SparkSession, block: int, recall: float) -> None:
    rows = corpus(2)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = near_duplicates.near_duplicates(docs, recall=recall, block=block).collect()
    assert len(got) == len(rows)
    want = near_by_hand(rows)
    if recall > 0.999:
        by_id = {k[0]: v for k, v in want.items()}
        assert all((r["class_id"], r["n_links"]) == by_id[r["doc_id"]] for r in got)
        assert any(v[1] > 1 for v in want.values())


def test_expected_recall() -> None:
    near = near_duplicates
    floor = near.last_depth(0.8, 0.99999)
    assert near.chance(0.8, floor) >= 0.99999 > near.chance(0.8, floor + 1)
    alike = np.zeros(near.BINS + 1)
    assert near.expected_recall(alike, 0.8, near.DEPTH) == 1
    alike[near.BINS] = 1000
    assert near.expected_recall(alike, 0.8, near.DEPTH) == 1
    alike[int(0.8 * near.BINS)] = 1000
    got = near.expected_recall(alike, 0.8, near.DEPTH)
    assert got == pytest.approx(2000 / (1000 + 1000 / near.chance(0.8, near.DEPTH)))
    assert got < 0.99999 <= near.expected_recall(alike, 0.8, floor)


def made_pairs(rng: random.Random, many: int, low: float, high: float) -> list[tuple]:
    """Pairs of documents whose similarity lies in a range: shingles that begin or end differently."""
    rows = []
    for k in range(many):
        words = [f"p{k}x{j}" for j in range(rng.randint(60, 200))]
        shared, goal = len(words) - 4, rng.uniform(low, high)
        extra = round(shared * (1 / goal - 1))
        while extra and shared / (shared + extra) < low:
            extra -= 1
        rows += [(2 * k, " ".join(words), "", 1, ""), (2 * k + 1, " ".join([*words, *(f"e{k}x{j}" for j in range(extra))]), "", 1, "")]
    return rows


def test_recall_on_made_pairs(spark: SparkSession) -> None:
    """3,000 pairs between 0.8 and 0.95, which brute force would link one and all."""
    rows = made_pairs(random.Random(12), 3000, 0.8, 0.95)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    got = near_duplicates.near_duplicates(docs).where("class_id % 2 = 0").collect()
    found = sum(r["doc_id"] % 2 == 1 and r["class_id"] == r["doc_id"] - 1 for r in got)
    assert found >= 2999
    assert all(r["class_id"] // 2 == r["doc_id"] // 2 for r in got)


@pytest.mark.parametrize(("low", "high", "depths"), [(0.93, 0.99, [6]), (0.8, 0.82, [6, 5, 4])])
def test_prefixes_are_shortened_only_as_far_as_needed(
    spark: SparkSession, monkeypatch: pytest.MonkeyPatch, low: float, high: float, depths: list[int]
) -> None:
    near = near_duplicates
    used = []
    meet = near._meetings
    monkeypatch.setattr(near, "_meetings", lambda sets, depth, block: used.append(depth) or meet(sets, depth, block))
    docs = spark.createDataFrame(made_pairs(random.Random(3), 150, low, high), COLUMNS)
    got = near.near_duplicates(docs).collect()
    assert all((r["class_id"], r["n_links"]) == (r["doc_id"] // 2 * 2, 1) for r in got)
    assert used == depths


def test_near_duplicates_keeps_one(spark: SparkSession) -> None:
    rows = corpus(2)
    got = near_duplicates.keep_one(spark.createDataFrame(rows, COLUMNS)).collect()
    want = {v[0] for k, v in near_by_hand(rows).items() if shingles_by_hand(k[1])}
    assert sorted(r["doc_id"] for r in got if shingles_by_hand(r["text"])) == sorted(want)
    assert sum(not shingles_by_hand(r["text"]) for r in got) == 3
    assert near_duplicates.near_duplicates(spark.createDataFrame([], COLUMNS)).count() == 0


def test_lines_of_few_words_at_lower_thresholds(spark: SparkSession) -> None:
    docs = spark.createDataFrame([(1, "ab cd ef", "", 1, ""), (2, "ab cd ef gh\nij kl", "", 1, "")], COLUMNS)
    for threshold, left in [(0.7, "ij kl"), (0.8, "ab cd ef gh\nij kl")]:
        got = {r["doc"]["doc_id"]: r["text"] for r in lines.dedup_lines(docs, threshold=threshold).collect()}
        assert got == {1: "ab cd ef", 2: left}, threshold


def overlap_by_hand(doc: list[int], item: list[int]) -> int:
    """The longest stretch without gaps that starts and ends equal and differs in a fifth at most."""
    best = 0
    for shift in range(-len(item), len(doc)):
        same = [0 <= i + shift < len(doc) and doc[i + shift] == item[i] for i in range(len(item))]
        inside = [0 <= i + shift < len(doc) for i in range(len(item))]
        for a in range(len(item)):
            for b in range(a + 1, len(item) + 1):
                if same[a] and same[b - 1] and all(inside[a:b]) and 5 * (b - a - sum(same[a:b])) <= b - a:
                    best = max(best, b - a)
    return best


def test_tolerant_overlap() -> None:
    rng = random.Random(5)
    for _ in range(150):
        doc, item = ([rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(2))
        best = max(
            decontaminate.tolerant_overlap(np.array(doc), np.array(item), s)[1] for s in range(-len(item), len(doc))
        )
        assert best == overlap_by_hand(doc, item), (doc, item)


def missed(masks: tuple[str, ...], n: int, different: int) -> list[tuple[int, ...]]:
    """Substitution places among ``n`` tokens that leave no place for any of the masks."""
    kept = [{o + i for i, c in enumerate(m) if c == "1"} for m in masks for o in range(n - len(m) + 1)]
    return [p for p in itertools.combinations(range(n), different) if all(k & set(p) for k in kept)]


def test_seeds_miss_no_pattern() -> None:
    # A longer stretch is cut into stretches of 13 to 25 tokens; fewer tokens lie in more of the same.
    for n, different in [(13, 2), (15, 3), (20, 4), (25, 5)]:
        assert not missed(decontaminate.MASKS, n, different), n
    for least, share in [(5, 0.2), (6, 0.34), (8, 0.1)]:
        for n in range(least, 2 * least):
            assert not missed(decontaminate.seeds(least, share), n, int(share * n)), (least, share, n)


def test_every_substitution_is_found(spark: SparkSession) -> None:
    rows, items, want = [], [], set()
    for n, different in [(13, 2), (15, 3)]:
        item = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        for places in itertools.combinations(range(1, n - 1), different):
            text = " ".join(["a", "b", *("other" if i in places else w for i, w in enumerate(item)), "c"])
            want.add((len(rows), n, 2, n, different))
            rows.append((len(rows), text, "", 1, ""))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.overlaps(spark.createDataFrame(rows, COLUMNS).repartition(3), bench)
    columns = ("doc_id", "item_id", "doc_start", "tokens", "different")
    assert {tuple(r[c] for c in columns) for r in got.collect()} == want


def overlaps_by_hand(rows: list[tuple], items: list[tuple]) -> dict[tuple, int]:
    """The longest overlap of every document and item, over all shifts."""

    def cut(text: str | None) -> list[str]:
        return re.findall("[^\\s\"'`.,;:!?()\\[\\]{}<>*#$%&|/\\\\_~^=+@-]+", (text or "").lower())

    codes: dict[str, int] = {}
    coded = lambda text: np.array([codes.setdefault(w, len(codes)) for w in cut(text)], np.int64)
    out: dict[tuple, int] = {}
    for doc_id, text, *_ in rows:
        for item_id, passage in items:
            doc, item = coded(text), coded(passage)
            shifts = np.arange(-len(item), len(doc) + 1)
            found = decontaminate.longest_overlap(doc, item, shifts, 13, 0.2) if len(item) and len(doc) else None
            if found and (len(item) >= 5 or found[3] == 0):
                out[doc_id, item_id] = max(found[2], out.get((doc_id, item_id), 0))
    return out


def test_overlaps_match_all_shifts(spark: SparkSession) -> None:
    """Whole and partial copies with substitutions, one token repeated, and items in several parts."""
    rng = random.Random(11)
    word = lambda: rng.choice(["the", "of", *(f"t{i}" for i in range(60))])
    items = [(i % 9, " ".join(word() for _ in range(rng.choice([1, 3, 7, 12, 13, 14, 30, 80])))) for i in range(14)]
    items += [(20, "echo " * 40), (21, "echo " * 9 + "stop"), (22, "echo " * 15), (3, None), (None, "lone item of five words here")]
    rows = []
    for i in range(60):
        passage = [*rng.choice(items[:14])[1].split()]
        low = rng.randint(0, len(passage))
        part = passage if rng.random() < 0.5 else passage[low : low + rng.randint(1, 30)]
        part = [word() if rng.random() < 0.15 else w for w in part]
        text = " ".join([*(word() for _ in range(rng.randint(0, 30))), *part, *(word() for _ in range(5))])
        rows.append((i, text, "", 1, ""))
    rows += [(100, "echo " * 300, "", 1, ""), (101, "a " + "echo " * 14 + "b", "", 1, ""), (102, None, "", 1, ""), (103, "Lone item, of five words: here!", "", 1, "")]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = decontaminate.overlaps(spark.createDataFrame(rows, COLUMNS).repartition(3), bench)
    assert {(r["doc_id"], r["item_id"]): r["tokens"] for r in got.collect()} == overlaps_by_hand(rows, items)


def test_a_full_filter_changes_nothing(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    rng = random.Random(2)
    items = [(i, " ".join(f"q{rng.randint(0, 500)}" for _ in range(40))) for i in range(60)]
    rows = [(i, f"start {items[i % 60][1]} end", "", 1, "") for i in range(90)] + [(99, "q1 q2 q3 " * 20, "", 1, "")]
    docs, bench = spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: {(r["doc_id"], *r["item_ids"], r["tokens"]) for r in decontaminate.contaminated(docs, bench).collect()}
    whole = found()
    assert len(whole) == 90
    monkeypatch.setattr(decontaminate, "MOST_BITS", 1 << 16)
    monkeypatch.setattr(decontaminate, "BITS_PER_WINDOW", 1)
    assert found() == whole


@pytest.mark.parametrize("space", ["\u00a0", "\u3000", "\u2028", "\u0085", "\u2009", "\u202f", "\u205f", "\u1680"])
def test_white_space_beyond_ascii_cuts_tokens(spark: SparkSession, space: str) -> None:
    words = [f"w{i}" for i in range(40)]
    items = [(1, space.join(words)), (2, f"x{space}y z k l m n o p q r s t u"), (3, "é ß à ø å æ ü ö ä ñ ç ò ù ì")]
    rows = [
        (1, "before " + items[0][1] + " after", "", 1, ""),  # letter for letter
        (2, "before " + " ".join(words) + " after", "", 1, ""),  # with plain spaces
        (3, items[1][1], "", 1, ""),
        (4, "nothing of " + space + " this \u00e9" + space, "", 1, ""),
        (5, items[2][1].replace(" ", space), "", 1, ""),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(rows, COLUMNS), bench).collect()
    assert {(r["doc_id"], r["item_ids"][0], r["tokens"]) for r in got} == {(1, 1, 40), (2, 1, 40), (3, 2, 14), (5, 3, 14)}


def test_short_items_with_substitutions(spark: SparkSession) -> None:
    for n in range(1, 13):
        assert not missed(decontaminate.short_seeds(n, 0.2), n, n // 5), n
        assert not missed(decontaminate.short_seeds(n, 0.34), n, int(0.34 * n)), n
    items, rows, want = [], [], set()
    for n in range(1, 13):
        item = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        for different in (n // 5, n // 5 + 1):
            for places in itertools.combinations(range(n), different):
                doc = ["a", *("other" if i in places else w for i, w in enumerate(item)), "b"]
                if different <= n // 5:
                    want.add((len(rows), n, 1, different))
                rows.append((len(rows), " ".join(doc), "", 1, ""))
    rows.append((len(rows), " ".join(items[-1][1].split()[1:]), "", 1, ""))  # not whole
    docs = spark.createDataFrame(rows, COLUMNS)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["tokens"], r["doc_start"], r["different"]) for r in got.collect()} == want


def test_decontamination(spark: SparkSession) -> None:
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([20, 30, 5, 40, 1])]
    changed = items[1][1].split()
    changed[9] = changed[20] = "other"
    noise = [" ".join(word() for _ in range(50)) for _ in range(6)]
    rows = [
        (0, f"{noise[0]} {items[0][1].upper()}! {noise[1]}", "", 1, ""),
        (1, f"{noise[2]}\n{' '.join(changed)}", "", 1, ""),
        (2, noise[3], "", 1, ""),
        (3, f"{noise[4]}, {items[2][1]}. {noise[5]}", "", 1, ""),
        (4, " ".join(items[3][1].split()[:8]) + " " + noise[5], "", 1, ""),
        (5, None, "", 1, ""),
        (6, "", "", 1, ""),
    ]
    docs = spark.createDataFrame(rows, COLUMNS)
    bench = spark.createDataFrame([*items[:4], (9, None), (10, "")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contaminated(docs, bench).collect()}
    assert {k: v["item_ids"] for k, v in got.items()} == {0: [0], 1: [1], 3: [2]}
    assert (got[1]["tokens"], got[1]["different"], got[1]["doc_start"]) == (30, 2, 50)
    stay = decontaminate.drop_contaminated(docs, bench)
    assert stay.columns == docs.columns and sorted(r["doc_id"] for r in stay.collect()) == [2, 4, 5, 6]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


CLASH = (
    "doc_id long, text string, `doc` string, `key` string, `row` string, `__key` string, `__row` string, `__kept` string,"
    " `__text` string, `__rejected` string, `__head` string, `__bad` string, `head` int, `bad` int, `rejected` int,"
    " `left` int, `stays` int, `n_lines` int, `n_removed` int, `a.b` int, `x``y` int, `n_chars` long"
)


def test_columns_of_any_name_pass_through(spark: SparkSession) -> None:
    names = [c.split("` ")[0].strip("` ") for c in CLASH.split(", ")][2:-1]
    texts = [" ".join(f"v{i}x{j}" for j in range(60)) for i in range(4)]
    item = " ".join(f"bench{j}" for j in range(20))
    texts += [texts[0], texts[1] + " " + item, "few words", None]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, *(f"{i}{k}" for k in range(10)), *(i * 100 + k for k in range(9)), 7))
    docs = spark.createDataFrame(rows, CLASH)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    given = {r["doc_id"]: tuple(r) for r in docs.collect()}
    for made, left in (
        (quality.filter_quality(docs), {0, 1, 2, 3, 4, 5}),
        (near_duplicates.keep_one(docs), {0, 1, 2, 3, 5, 6, 7}),
        (decontaminate.drop_contaminated(docs, bench), {0, 1, 2, 3, 4, 6, 7}),
    ):
        assert made.columns == docs.columns
        assert {r["doc_id"]: tuple(r) for r in made.collect()} == {k: given[k] for k in left}
    deduped = {r["doc"]["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    assert {k: tuple(r["doc"]) for k, r in deduped.items()} == given and len(names) == 19
    assert (deduped[0]["n_removed"], deduped[4]["n_removed"], deduped[7]["text"]) == (0, 1, None)


def test_the_pipeline_passes_columns_of_any_name(spark: SparkSession) -> None:
    import corpus_pipeline as pipeline

    texts = [" ".join(f"v{i}x{j}" for j in range(60)) + f"\nsame line of every document here\nline {i}" for i in range(4)]
    rows = [(i, t, *(f"{i}{k}" for k in range(10)), *(i * 100 + k for k in range(9)), 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, CLASH)
    given = {r["doc_id"]: tuple(r)[2:-1] for r in docs.collect()}
    for _, stage in pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        got = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == [c.name for c in spark.createDataFrame([], CLASH).schema]
        assert {k: tuple(r)[2:-1] for k, r in got.items()} == given
        assert all(r["n_chars"] in (7, len(r["text"])) for r in got.values())
    assert sorted(r["text"].count("same line") for r in got.values()) == [0, 0, 0, 1]
    without = spark.createDataFrame([(1, texts[0])], "doc_id long, text string")
    assert pipeline.line_dedup(spark, without, SF).first()["text"] == texts[0]


def test_postings_of_rare_words_are_not_copied(spark: SparkSession) -> None:
    """However many words share a bucket of the counts, only a word that is hot itself is dealt out."""
    rows = [(i, "\n".join(f"only{i}a{j} two{i}b{j} common{j % 3}" for j in range(30)), "", 1, "") for i in range(60)]
    rows += [(100 + i, "\n".join(f"hot u{i}x{j}" for j in range(3)), "", 1, "") for i in range(20)]
    docs = spark.createDataFrame(rows, COLUMNS)
    ranks, often = lines.rarity(docs)
    _, hot = lines.first_lines(docs, ranks, often, 0.5, 40)
    _, every = lines.first_lines(docs, ranks, np.full_like(often, 10**9), 0.5, 40)
    assert {tuple(r) for r in hot.collect()} == {tuple(r) for r in every.collect()}
    wide = 8 * len(lines.POSTING)
    many = lambda df: df.agg(F.sum(F.length("postings"))).first()[0] // wide
    plain = many(lines.postings(docs, ranks, hot.limit(0), 0.5))
    dealt = many(lines.postings(docs, ranks, hot, 0.5))
    joined = lines.postings(docs, ranks, hot, 0.5, most=0).count()
    assert hot.count() <= 4 and plain <= dealt == joined < 1.2 * plain


@pytest.mark.parametrize("most", [0, 1 << 18])
def test_hot_words_are_dealt_alike(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, most: int) -> None:
    rows = [(i, "\n".join(f"hot warm u{i % 40}x{j} v{j}" for j in range(6)), "", 1, "") for i in range(90)]
    monkeypatch.setattr(lines.postings, "__defaults__", (16, most))
    got = lines.dedup_lines(spark.createDataFrame(rows, COLUMNS).repartition(3), 0.6, block=8).collect()
    want = removed_by_hand(rows, 0.6)
    assert all(r["text"] == want[r["doc"]["doc_id"], r["doc"]["text"]] for r in got)


def test_many_lines_cost_in_proportion(spark: SparkSession) -> None:
    def seconds(n: int) -> float:
        text = "\n".join(f"a{i} b{i} c{i % 7} d" for i in range(n)) + "\na1 b1 c1 d"
        docs = spark.createDataFrame([(1, text, "", 1, "")], COLUMNS)
        started = time.perf_counter()
        (row,) = lines.dedup_lines(docs).collect()
        assert (row["n_lines"], row["n_removed"]) == (n + 1, 1)
        return time.perf_counter() - started

    seconds(100)
    assert seconds(80_000) < 2.5 * max(seconds(40_000), 2.0)
