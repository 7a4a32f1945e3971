"""The remaining operators and the pipeline: brute force, exact round trips, held-out accuracy."""

from __future__ import annotations

import functools
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aftermerge.llm import licenses, packing, quality, sharding, tokens, toxicity, urls
from aftermerge.llm.queries import ORACLE, QUERIES, word_tokenizer

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, shard int, kept string"
ODD = [
    (1, None, "en", 9, "x"),
    (2, "", None, 9, None),
    (3, " \n ", "en", None, "x"),
    (None, "a b c", "fr", 9, "x"),
    (4, "Don't <|endoftext|> stop 123 é\u00a0Σ Σας\u2003x", "de", 9, "x"),
    (4, "Don't <|endoftext|> stop 123 é\u00a0Σ Σας\u2003x", "de", 9, "x"),
    (5, "word " * 6000, "en", 9, "x"),
]


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer())


def whole_ids(text: str | None) -> list[int]:
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def test_word_ids_are_those_of_whole_texts(spark: SparkSession) -> None:
    rng = random.Random(4)
    alphabet = "aZé'’1٣ß中 \t\n.,!|<>İΣ\u0301\u00a0\u2028"
    texts = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(150)] + [r[1] for r in ODD]
    letters = "abcXYZéÀßÿñÜ"
    texts += [" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) + rng.choice(["", ".", ",", "!"]) for _ in range(9)) for _ in range(100)]
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect()
    texts += [r["text"] for r in rows]
    ids = tokens.WordIds(word_tokenizer())
    for text in texts:
        raw = None if text is None else text.encode()
        assert list(struct.unpack(f"<{len(ids.of(raw)) // 4}I", ids.of(raw))) == whole_ids(text), text


def check_packing(rows: list, docs: dict[int | None, list[list[int]]], size: int) -> float:
    """Every id in one piece, checksums right, windows gapless; returns the share of padding."""
    windows: dict[int, list] = defaultdict(list)
    pieces: dict = defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    used = padded = 0
    for group in windows.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= size
        used += at
        padded += at if at & (at - 1) == 0 else size
    want: dict = defaultdict(list)
    for doc_id, versions in docs.items():
        for ids in versions:
            want[doc_id].append(len(ids))
    for doc_id, found in pieces.items():
        ids = docs[doc_id][0]
        assert sum(p[1] for p in found) == sum(want[doc_id])
        for start, length, crc, total in found:
            assert total == len(ids)
            assert zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc
    assert set(pieces) == set(docs)
    return 1 - used / max(padded, 1)


def test_packing(spark: SparkSession) -> None:
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    docs = {r["doc_id"]: [whole_ids(r["text"]) + [2]] for r in rows}
    got = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), word_tokenizer())
    assert check_packing(got.collect(), docs, 4096) < 0.002
    small = spark.createDataFrame(ODD, COLUMNS)
    docs = defaultdict(list)
    for r in ODD:
        docs[r[0]].append(whole_ids(r[1]) + [2])
    check_packing(packing.pack(small, word_tokenizer(), 64).collect(), docs, 64)
    assert packing.pack(small.limit(0), word_tokenizer()).count() == 0


def test_level_minimises_the_sum_of_squares() -> None:
    rng = random.Random(8)
    packer = packing.SquaresPacker(12, most_open=50)
    levels: Counter = Counter()
    for _ in range(400):
        length = rng.randint(1, 11)
        costs = {}
        for h in [0, *(k for k, n in levels.items() if n and k + length <= 12)]:
            after = levels.copy()
            if h:
                after[h] -= 1
            if h + length < 12:
                after[h + length] += 1
            costs[h] = sum(n * n for n in after.values())
        chosen = packer.level_for(length)
        assert costs[chosen] == min(costs.values())
        open_before = packer.n_open
        packer.add(0, bytes(4 * length))
        if packer.n_open == 0 and open_before:
            levels = Counter()
        else:
            if chosen:
                levels[chosen] -= 1
            if chosen + length < 12:
                levels[chosen + length] += 1


def test_length_histogram(spark: SparkSession) -> None:
    docs = spark.createDataFrame(ODD, COLUMNS).unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select(
            "doc_id", "text", "lang", F.lit(1).alias("shard"), F.lit("x").alias("kept")
        )
    )
    lengths = defaultdict(list)
    for r in docs.select("text", "lang").collect():
        lengths[r["lang"]].append(len(whole_ids(r["text"])))
    for block in (7, 1024):
        rows = tokens.length_histogram(docs, word_tokenizer(), ["lang"], block).collect()
        assert sum(r["docs"] for r in rows) == sum(map(len, lengths.values()))
        for r in rows:
            own, limit = lengths[r["lang"]], r["length"]
            assert r["docs"] == own.count(limit) and r["tokens"] == limit * r["docs"]
            assert r["docs_over"] == sum(n > limit for n in own) == r["total_docs"] - r["docs_up_to"]
            assert r["tokens_over"] == sum(n for n in own if n > limit)
            assert r["tokens_truncated"] == sum(min(n, limit) for n in own)
            assert r["total_tokens"] == sum(own) and abs(r["quantile"] - r["docs_up_to"] / len(own)) < 1e-12
    assert tokens.length_histogram(docs.limit(0), word_tokenizer()).count() == 0
    assert tokens.length_histogram(docs, word_tokenizer()).count() > 0


def test_sharding(spark: SparkSession) -> None:
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(ODD, COLUMNS).select("doc_id", "text", "shard")
    for df in (docs, odd, docs.limit(0), spark.createDataFrame([(7, "x")] * 301, "doc_id long, text string")):
        rows = sharding.assign_shards(df, 8).collect()
        assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter(
            (r["doc_id"], len((r["text"] or "").encode()) + 1) for r in df.collect()
        )
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots.get(k, ())) for k in range(8)]
        assert max(counts) - min(counts) <= 1
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = sharding.assign_shards(docs, 8).collect()
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in rows)


def test_a_new_shard_moves_few() -> None:
    owners, grown = sharding.ring_owners(8), sharding.ring_owners(9)
    assert all(b in (a, 8) for a, b in zip(owners, grown, strict=True))
    counts = {cell: 25 for cell in range(sharding.CELLS)}

    def places(owner: list[int], shards: int) -> dict[tuple[int, int], int]:
        spans = sharding.fill_clockwise(counts, owner, shards)
        assert sum(h - lo for _, lo, h, _, _ in spans) == sum(counts.values())
        return {(c, k): s for c, lo, h, s, _ in spans for k in range(lo, h)}

    before, after = places(owners, 8), places(grown, 9)
    moved = sum(before[k] != after[k] for k in before) / len(before)
    assert moved < 0.4  # a ninth must move; assignment by remainder would move eight ninths


def quality_by_hand(text: str | None) -> tuple:
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if n[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality(spark: SparkSession) -> None:
    rng = random.Random(2)
    made = [
        (100 + i, "".join(rng.choice(["a ", "b\t", "c\n", "é  ", "#|", "\u00a0", "d "]) for _ in range(rng.randint(0, 60))), "x", 1, "")
        for i in range(150)
    ]
    docs = spark.createDataFrame([*ODD, *made], COLUMNS)
    rows = quality.judge_quality(docs).collect()
    text = {r[0]: r[1] for r in [*ODD, *made]}
    assert len(rows) == len(ODD) + len(made)
    for r in rows:
        want = quality_by_hand(text[r["doc_id"]])
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == want, text[r["doc_id"]]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in rows if r["kept"])
    assert quality.judge_quality(docs.limit(0)).count() == 0
    plan = quality.judge_quality(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_order_of_the_cascade_follows_the_sample(spark: SparkSession) -> None:
    docs = spark.createDataFrame([(i, "word! " * 60, "x", 1, "") for i in range(40)], COLUMNS)
    order = [r.name for r in quality.cascade_order(docs)]
    assert all([r.name for r in quality.cascade_order(docs)] == order for _ in range(3))  # no clock decides
    assert sorted(order) == sorted(r.name for r in quality.RULES) and order[0] == "exclaims"
    # What is measured anyway costs next to nothing, and comes first where little is rejected.
    calm = spark.createDataFrame([(i, f"word number {i} " * 60, "x", 1, "") for i in range(40)], COLUMNS)
    known = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines")
    late = [r.name for r in quality.cascade_order(calm, known=known)][-2:]
    assert set(late) == {"exclaims", "shouting"}


def viterbi_by_hand(piece: str, words: dict[str, int], total: int) -> float:
    """The least cost over all splits."""
    if not piece:
        return 0.0
    scale = np.log(total + 1)
    return min(
        (scale - np.log(words[piece[:k]]) if piece[:k] in words else scale + np.log(10) * k)
        + viterbi_by_hand(piece[k:], words, total)
        for k in range(1, len(piece) + 1)
    )


def test_viterbi() -> None:
    words = {"cheap": 50, "pills": 40, "he": 90, "a": 200, "pill": 30, "s": 5}
    total = sum(words.values())
    for piece in ("cheappills", "apills", "xqz", "sheap", "a"):
        known = [(s, k, words[piece[s : s + k]]) for s in range(len(piece)) for k in range(1, 21) if piece[s : s + k] in words and s + k <= len(piece)]
        cut = urls.viterbi(piece, known, total)
        assert "".join(cut) == piece
        cost = sum(
            np.log(total + 1) - np.log(words[w]) if w in words else np.log(total + 1) + np.log(10) * len(w) for w in cut
        )
        assert abs(cost - viterbi_by_hand(piece, words, total)) < 1e-9
    assert urls.viterbi("cheappills", [(0, 5, 50), (5, 5, 40)], 90) == ["cheap", "pills"]


def test_urls(spark: SparkSession) -> None:
    cases = {
        "http://A.Example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "https://net/": ("net", "/", "net/", "block"),
        "https://xnet/": ("xnet", "/", None, None),
        "https://b.net?q=/": ("b.net", "", None, None),
        "https://www.example.com/de/1": ("www.example.com", "/de/1", "example.com/de/", "block"),
        "x://a.org/fr/#:://": ("a.org", "/fr/", "org/fr/", "allow"),
        "https://É.org/FR/": ("É.org", "/FR/", None, None),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, "<p>cheap pills spam</p>" if i % 2 else None, "v") for i, u in enumerate(cases)]
    rows.append((99, "https://cheap-spam.example.org/x", "spam", "v"))
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string, verdict string")
    got = urls.judge_urls(pages).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r["page_id"] < 99:
            host, path, rule, verdict = cases[rows[r["page_id"]][1]]
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
            assert verdict is None and r["verdict"] in ("allow", "block") or r["verdict"] == verdict
        else:
            assert r["verdict"] == "block"
    assert urls.judge_urls(pages.limit(0)).count() == 0


def odds_by_hand(rows: list[tuple], folds: dict[str, int]) -> dict[int, float]:
    """Naive Bayes over words as words, without buckets: page_id to log odds."""
    counts: Counter = Counter()
    for _, _, html in rows:
        counts.update(re.findall(r"[^\W\d_]+", re.sub(r"(?s)<[^>]*>", " ", html or "").lower()))
    total = sum(counts.values())
    tokens, learnt_from, of = {}, {}, {}
    for page, url, _ in rows:
        host, path = re.fullmatch(r"[a-z]+://([^/?#]*)([^?#]*).*", url).groups()
        found = []
        for piece in re.findall(r"[^\W\d_]+", host.rpartition(".")[0]):
            known = [(s, k, counts[piece[s : s + k]]) for s in range(len(piece)) for k in range(1, len(piece) - s + 1) if piece[s : s + k] in counts]
            found += [("host", w) for w in urls.viterbi(piece, known, total)]
        runs = [t for t in re.split(r"[\W_]+", path.lower()) if t not in ("", "en", "de", "fr")]
        tokens[page] = found + [("path", "0" if t.isdigit() else t) for t in runs]
        of[page] = folds[host]
        blocked = host.endswith(".net") or host.endswith("example.com") and path.startswith("/de/")
        if blocked or host.endswith(".org") and path.startswith("/fr/"):
            learnt_from.setdefault((host, int(blocked)), set()).update(tokens[page])
    out = {}
    for fold in range(urls.FOLDS):
        seen = (Counter(), Counter())
        for (host, y), found in learnt_from.items():  # once for a host, however many pages
            if folds[host] != fold:
                seen[y].update(found)
        learnt = sum(map(sum, (c.values() for c in seen)))
        weight = max(urls.PSEUDO_COUNT, 0.02 * learnt / len(urls.BLOCK_WORDS))
        for y, words in enumerate((urls.ALLOW_WORDS, urls.BLOCK_WORDS)):
            for w in words:
                seen[y]["host", w] += weight
        totals = [sum(c.values()) + 0.5 * urls.BUCKETS for c in seen]
        share = lambda y, t: np.log((seen[y][t] + 0.5) / totals[y])  # noqa: B023, E731
        out |= {page: sum(share(1, t) - share(0, t) for t in found) for page, found in tokens.items() if of[page] == fold}
    return out


def made_pages(seed: int, many: int) -> list[tuple]:
    rng = random.Random(seed)
    good, bad = ["garten", "bücher", "history", "donaudampfschifffahrtsgesellschaft", "наука"], ["win", "прайс", "casino", "cheap", "deal"]
    rows = []
    for i in range(many):
        unwanted = rng.random() < 0.5
        words = rng.choices(bad if unwanted else good, k=rng.randint(1, 2))
        suffix = rng.choice(["net", "example.com"] if unwanted else ["org", "example.com"])
        area = "de" if unwanted else "fr"
        label = "".join(words) + rng.choice(["", "-x", "2"]) + f".{rng.choice('abcdefgh')}"
        path = rng.choice([f"/{area}/{rng.randint(1, 99)}/{rng.choice(words)}", f"/es/{rng.choice(words)}.html"])
        rows.append((i, f"https://{label}.{suffix}{path}?q", f"<p class='x'>{' '.join(words)} und {words[0]}</p>"))
    return rows


def test_url_odds_match_counts_by_hand(spark: SparkSession) -> None:
    rows = made_pages(4, 300)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    hosts = urls.apply_rules(pages).select("host", urls.fold_of().alias("f")).distinct()
    want = odds_by_hand(rows, {r["host"]: r["f"] for r in hosts.collect()})
    got = urls.judge_urls(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["log_odds"] == pytest.approx(want[r["page_id"]], abs=1e-6), r
        if r["rule"] is None:
            assert r["verdict"] == ("block" if want[r["page_id"]] > np.log(5) else "allow")


def test_long_and_foreign_words_stay_whole(spark: SparkSession) -> None:
    long = "donaudampfschifffahrtsgesellschaftskapitän"
    counts = spark.createDataFrame([(long, 3), ("наука", 2), ("cheap", 5), ("pills", 5)], "word string, n long")
    hosts = spark.createDataFrame([(f"www.{long}.наукаcheap.example.org",), ("pills-cheappills.x",), ("",)], "host string")
    got = {r["host"]: r["words"] for r in urls.segment_hosts(hosts, counts).collect()}
    assert got == {f"www.{long}.наукаcheap.example.org": ["www", long, "наука", "cheap", "example"], "pills-cheappills.x": ["pills", "cheap", "pills"]}


def test_what_is_learnt_carries_over_to_other_hosts(spark: SparkSession) -> None:
    pages = spark.createDataFrame(made_pages(9, 600), "page_id long, url string, html string")
    found = {r["decided"]: r for r in urls.held_out(pages).collect()}
    assert set(found) == {"allow", "block"}
    assert all(r["right"] >= 0.95 * r["pages"] > 50 for r in found.values())


def test_a_site_with_a_blocked_part_is_not_blocked(spark: SparkSession) -> None:
    rows = [(i, f"https://garten.example.com/{'de' if i % 4 == 0 else 'fr'}/{i}", None) for i in range(80)]
    rows += [(100 + i, f"https://deal{i}.example.net/de/{i}", None) for i in range(40)]
    rows += [(200, "https://cheap-pills.example.com/en/", None), (201, "https://deal.example.org/es/", None)]
    rows += [(400 + i, f"https://seite{i}.example.org/fr/{i}", None) for i in range(40)]
    rows += [(300 + i, f"https://cheap-bets.example.com/en/{i}", None) for i in range(60)]  # nor is a large one let off
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == ("block" if i % 4 == 0 else "allow") for i in range(80))
    assert got[200] == got[201] == "block" and all(got[300 + i] == "block" for i in range(60))


def test_the_words_of_rules_are_no_tokens(spark: SparkSession) -> None:
    """One host has its German pages blocked by a rule; that says nothing about its French ones."""
    rows = [(i, f"https://garten.example.com/de/{i}", None) for i in range(50)] + [(99, "https://bücher.example.org/fr/1", None)]
    rows += [(100, "https://other.example.org/de/1", None), (101, "https://other.example.org/es/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    odds = {r["page_id"]: r["log_odds"] for r in urls.judge_urls(pages).collect()}
    assert odds[100] != 0 and odds[101] != odds[100]  # a number and a word that no rule holds
    plain = spark.createDataFrame([*rows[:51], (100, "https://other.example.org/de/", None), (101, "https://other.example.org/", None)], pages.schema)
    odds = {r["page_id"]: r["log_odds"] for r in urls.judge_urls(plain).collect()}
    assert odds[100] == odds[101]


def test_increasing() -> None:
    rng = random.Random(1)
    for _ in range(50):
        values = rng.sample(range(30), 10)
        best = [1] * 10
        for i in range(10):
            for j in range(i):
                if values[j] < values[i]:
                    best[i] = max(best[i], best[j] + 1)
        got = [values[k] for k in licenses.increasing(values)]
        assert got == sorted(got) and len(got) == max(best)


def test_licenses(spark: SparkSession) -> None:
    mit = licenses.TEMPLATES["MIT"][1].split()
    mit[5:7] = ["with", "changes"]
    noise = "lorem the of license " * 30
    rows = [
        (1, f"{noise} {' '.join(mit)} {noise}", "", 1, ""),
        (2, "LICENSED UNDER THE\nAPACHE LICENSE, VERSION 2.0", "", 1, ""),
        (3, noise, "", 1, ""),
        (4, f"{' '.join(mit[: len(mit) // 2])} {noise}", "", 1, ""),
        (5, None, "", 1, ""),
        (6, "", "", 1, ""),
        (7, "Released under the MIT License. Licensed under CC BY-NC 4.0.", "", 1, ""),
    ]
    found = licenses.scan_licenses(spark.createDataFrame(rows, COLUMNS)).collect()
    assert sorted((r["doc_id"], r["license"]) for r in found) == [
        (1, "MIT"), (2, "Apache-2.0"), (7, "CC-BY-NC-4.0"), (7, "MIT"),
    ]
    one = next(r for r in found if r["doc_id"] == 1)
    assert one["start"] == 120 and one["template"] == 1 and one["matched"] == len(" ".join(mit).replace("/", " ").split()) - 2
    assert licenses.scan_licenses(spark.createDataFrame([], COLUMNS)).count() == 0


def test_licenses_by_their_own_names(spark: SparkSession) -> None:
    forms = licenses.TEMPLATES
    texts = {
        (name, k): f"Some words before. {form} And some after."
        for name, many in forms.items()
        for k, form in enumerate(many)
    }
    want = [{name} for name, _ in texts]
    cases = {
        "Released under the BSD License.": {"BSD"},
        "Released under the proprietary License.": set(),
        "Licensed under the Apache License, Version 1.1.": set(),
        "Licensed under CC BY-NC-ND 4.0.": {"CC-BY-NC-ND-4.0"},
        "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.": {"CC-BY-4.0", "CC-BY-NC-4.0"},
        "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL-3.0"},
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0"},
        forms["BSD-3-Clause"][1].replace("binary", "other") + " x" * 9 + forms["BSD-2-Clause"][1]: {
            "BSD-2-Clause", "BSD-3-Clause",
        },
    }
    rows = [(i, text, "", 1, "") for i, text in enumerate([*texts.values(), *cases])]
    got = [set() for _ in rows]
    for r in licenses.scan_licenses(spark.createDataFrame(rows, COLUMNS)).collect():
        got[r["doc_id"]].add(r["license"])
    names = [*texts, *(text[:60] for text in cases)]
    assert [(n, g) for n, g in zip(names, got, strict=True)] == list(zip(names, [*want, *cases.values()], strict=True))


def test_toxicity_on_held_out_rows(spark: SparkSession) -> None:
    """Words mark toxic texts, some met only by their first letters; accuracy on unseen rows."""
    rng = random.Random(6)
    plain = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["Vile!", "vilest", f"gruft{rng.choice(plain)}"]))
        rows.append((i, " ".join(words), "de" if i % 3 else "en", 1, ""))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame([*rows, *[(10_000 + k, *r[1:]) for k, r in enumerate(ODD)], (None, "x", "", 1, "")], COLUMNS)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    unseen = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in set(unseen)) for i in range(900))
    right = sum(got[i]["predicted"] == labels[i][2] for i in unseen) / len(unseen)
    assert right > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    nothing = toxicity.train(docs, marks.where("toxic = 0"))
    assert {r["score"] for r in toxicity.score(docs, nothing).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_gradient() -> None:
    """Every array's gradient against differences of the loss."""
    rng = np.random.default_rng(3)
    model = toxicity.Model.start()
    model.table, model.out = model.table.astype(float), model.out.astype(float)
    model.filters = [w.astype(float) for w in model.filters]
    model.shifts = [rng.normal(size=len(s)) * 0.1 for s in model.shifts]
    model.bias = 0.2
    texts = pa.array(["a bb ccc dddd", "", "d e vile", None, "e f a a bb", "longer words here and there"], pa.string())
    buckets, bounds = toxicity.features(texts)
    labels = np.array([0, 1, 1, 0, 0, 1.0])

    def loss() -> float:
        z = model.logits(buckets, bounds)
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    found = toxicity.gradients(model, buckets, bounds, labels)
    arrays = {"out": model.out, **{f"w{k}": w for k, w in enumerate(model.filters)}, **{f"s{k}": s for k, s in enumerate(model.shifts)}}
    whole = np.zeros_like(model.table)
    whole[found["rows"]] = found["table"]
    checked = 0
    for value, grad in [*((arrays[n], found[n]) for n in arrays), (model.table, whole)]:
        places = np.argwhere(grad != 0)
        for place in rng.permutation(places)[:25]:
            at, step = tuple(place), 1e-6
            value[at] += step
            up = loss()
            value[at] -= 2 * step
            down = loss()
            value[at] += step
            assert (up - down) / (2 * step) == pytest.approx(grad[at], abs=1e-6)
            checked += 1
    model.bias += 1e-6
    up = loss()
    model.bias -= 2e-6
    assert (up - loss()) / 2e-6 == pytest.approx(found["bias"][0], abs=1e-6)
    assert checked > 100


def test_greatest_responses() -> None:
    """The greatest responses are those of a plain loop over windows, text ends included."""
    model = toxicity.Model.start()
    buckets, bounds = toxicity.features(pa.array(["a bb ccc", "", "d", None, "e f"], pa.string()))
    top, at = model.responses(buckets, bounds, where=True)
    for row in range(5):
        x = model.table[buckets[bounds[row] : bounds[row + 1]]].sum(1)
        for k, weights in enumerate(model.filters):
            z = [
                sum(x[t + j] @ weights[j] for j in range(len(weights)) if t + j < len(x)) for t in range(len(x))
            ]
            want = np.maximum(np.max(z, 0), 0) if len(z) else np.zeros(toxicity.FILTERS)
            part = slice(k * toxicity.FILTERS, (k + 1) * toxicity.FILTERS)
            assert np.allclose(top[row, part], want, atol=1e-5)
            assert ((at[row, part] >= 0) == (want > 0)).all()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark: SparkSession, name: str) -> None:
    from workload.check import connect, rows_of

    frame, found = QUERIES[name](spark, SF), connect(SF).execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, found.fetchall())


def test_pipeline(spark: SparkSession) -> None:
    import corpus_pipeline
    from tests.llm.test_similarity import near_by_hand, removed_by_hand, shingles_by_hand

    raw = spark.read.parquet(f"{SF}/documents.parquet")
    docs, kept = raw, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == raw.columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
            docs = spark.createDataFrame(docs.collect(), raw.schema)
        last = before
    assert set(kept["quality_rules"]) == {r["doc_id"] for r in quality.judge_quality(raw).where("kept").collect()}
    by_hand = removed_by_hand(list(kept["quality_rules"].items()))
    want = {i: t for (i, _), t in by_hand.items() if t.split()}
    assert kept["line_dedup"] == want
    heads = {v[0] for k, v in near_by_hand(list(want.items())).items() if shingles_by_hand(k[1])}
    assert set(kept["ngram_join"]) == heads
    items = [r["text"].split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, text in kept["ngram_join"].items():
        words = f" {' '.join(text.split())} "
        leaked = any(f" {' '.join(item)} " in words for item in items)
        assert leaked <= (i not in kept["decontamination"])
    ids = {i: [whole_ids(t) + [2]] for i, t in kept["decontamination"].items()}
    assert check_packing(packing.pack(last, word_tokenizer()).collect(), ids, 4096) < 0.01
    assert corpus_pipeline.run(spark, SF).count() >= len(ids)


def test_toxicity_learns_from_all_rows(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    """A mark of a few rows among thousands is learnt, over several shards and in any partitions."""
    rng = random.Random(8)
    plain = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(9000):
        bad = i % 2 == 0
        mark = "quorf" if i % 300 == 0 else "vile"
        words = [rng.choice(plain) for _ in range(6)] + ([mark] if bad else [])
        rows.append((i, " ".join(words), "en", 1, ""))
        labels.append((i, 1, int(bad)))
    rare = [(20_000 + i, " ".join(rng.choice(plain) for _ in range(6)) + " quorf", "en", 1, "") for i in range(20)]
    docs, marks = spark.createDataFrame([*rows, *rows[:50], *rare], COLUMNS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    learnt = {r["doc_id"] for s in toxicity.shards(docs, marks.selectExpr("doc_id AS __id", "toxic AS __toxic"), 9000).collect() for r in s["rows"]}
    assert learnt == {i for i in range(9000) if zlib.crc32(str(i).encode()) % 5}
    model = toxicity.train(docs, marks)
    monkeypatch.setattr(toxicity, "BROADCAST_LABELS", 0)
    again = toxicity.train(docs.repartition(3), marks.repartition(5))
    assert np.array_equal(toxicity.flat(model), toxicity.flat(again)) and model.thresholds == again.thresholds
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert all(got[20_000 + i] for i in range(20))
    assert sum(got[i] == (i % 2 == 0) for i in range(9000)) > 8950
