"""License scans by patience alignment of texts with license templates.

A template and a stretch of text are anchored on the words that occur once in each; the longest
increasing subsequence of the anchors is kept, and the gaps between them are aligned the same
way, down to equal words at their ends. Coverage is the share of a template's words aligned.

A text is looked at in overlapping stretches of three templates' length, and only in those that
hold enough of the template's words for the least coverage: a bound, so nothing is missed that
lies within twice the template's length. Short forms are looked for around their name instead, and
their name and version must match whole. Where places of several licenses overlap, the one whose
matched words outnumber its missing ones most wins.

Defined cases: null and empty texts match nothing; repeated rows give a row each; of several
places in one text the one with the highest coverage counts, the first of equals; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aftermerge.llm.common import slices, token_codes
from aftermerge.llm.license_forms import NAME_WORDS, TEMPLATES

#: A license counts as found from this share of its template's words.
LEAST_COVERAGE = 0.8

#: In forms of up to this many words, those that name the license or its version must all match.
SHORT = 60


def increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[pile], piles[pile] = value, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: Sequence[int], template: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of places (in the text, in the template) that patience alignment matches, in order."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        once = {w for w in in_template if in_template[w] == 1 and in_text.get(w) == 1}
        if once:
            place = {text[i]: i for i in range(a, b) if text[i] in once}
            anchors = [(place[template[j]], j) for j in range(c, d) if template[j] in once]
            chosen = [anchors[k] for k in increasing([i for i, _ in anchors])]
            pairs += chosen
            edges = [(a - 1, c - 1), *chosen, (b, d)]
            todo += [
                (i + 1, k, j + 1, m)
                for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True)
                if k > i + 1 and m > j + 1
            ]
            continue
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
    return sorted(pairs)


def densest(pairs: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """The most pairs whose places in the text lie within ``width`` words."""
    best, low = (0, 0), 0
    for high in range(len(pairs)):
        while pairs[high][0] - pairs[low][0] >= width:
            low += 1
        if high + 1 - low > best[1] - best[0]:
            best = (low, high + 1)
    return pairs[best[0] : best[1]]


@dataclass(frozen=True)
class Form:
    """A template in numbers of words; ``named``: places of the words that must match."""

    license: str
    number: int
    words: np.ndarray
    named: frozenset[int]
    anchor: int | None


class Forms:
    """All templates over one vocabulary."""

    def __init__(self, templates: Mapping[str, Sequence[str]]) -> None:
        listed = [(name, k, form) for name, texts in templates.items() for k, form in enumerate(texts)]
        codes = token_codes(pa.array([f for _, _, f in listed], pa.string()))
        self.codes = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.uint64)
        names = np.concatenate(token_codes(pa.array([" ".join(sorted(NAME_WORDS))], pa.string())))
        numbers = np.concatenate(token_codes(pa.array([" ".join(map(str, range(10)))], pa.string())))
        versioned = [f"{g}v{n}" for g in ("", "gpl", "lgpl", "agpl") for n in range(10)]
        names = np.concatenate([names, *token_codes(pa.array(versioned, pa.string()))])
        by, cc = (token_codes(pa.array([w], pa.string()))[0][0] for w in ("by", "cc"))
        self.forms: list[Form] = []
        self.counts = np.zeros((len(listed), len(self.codes)), np.float32)
        for row, ((name, k, _), c) in enumerate(zip(listed, codes, strict=True)):
            named: list[int] = []
            anchor = None
            if len(c) <= SHORT:
                word = np.isin(c, names)
                named = np.flatnonzero(word | np.isin(c, numbers)).tolist()
                named += [i for i in range(1, len(c)) if c[i] == by and c[i - 1] == cc]
                anchor = int(np.flatnonzero(word)[0]) if word.any() else None
            words = np.searchsorted(self.codes, c)
            self.forms.append(Form(name, k, words, frozenset(named), anchor))
            np.add.at(self.counts[row], words, 1)
        self.needs = np.array([len(f.words) for f in self.forms])

    def numbered(self, text: np.ndarray) -> np.ndarray:
        """Words as numbers in the vocabulary; -1 is none of it."""
        if not len(self.codes):
            return np.full(len(text), -1)
        at = np.minimum(np.searchsorted(self.codes, text), len(self.codes) - 1)
        return np.where(self.codes[at] == text, at, -1)

    def possible(self, texts: Sequence[np.ndarray], least: float) -> np.ndarray:
        """Per text and form whether the text has enough of the form's words."""
        there = np.zeros((len(texts), len(self.codes) + 1), np.float32)
        for i, text in enumerate(texts):
            there[i, text] = 1
        return (there[:, :-1] @ self.counts.T >= least * self.needs - 1e-6) & (self.needs > 0)


def find(text: np.ndarray, form: Form, least: float) -> list[tuple[float, int, int, int]]:
    """Coverage, start, length in the text and matched words of the places of a form."""
    n = len(form.words)
    need = int(np.ceil(least * n - 1e-9))
    sums = np.concatenate([[0], np.cumsum(np.isin(text, form.words))])
    if form.anchor is None:
        looks = [(low, min(len(text), low + 3 * n)) for low in range(0, max(1, len(text) - n), n)]
    else:
        at = np.flatnonzero(text == form.words[form.anchor]).tolist()
        looks = [(max(0, i - n), min(len(text), i + n)) for i in at]
    wanted = form.words.tolist()
    places = set()
    for low, high in looks:
        if sums[high] - sums[low] < need:
            continue
        pairs = densest(align(text[low:high].tolist(), wanted), 2 * n)
        if len(pairs) >= need and form.named <= {j for _, j in pairs}:
            places.add((len(pairs) / n, low + pairs[0][0], pairs[-1][0] + 1 - pairs[0][0], len(pairs)))
    return sorted(places, key=lambda p: p[1])


def winners(places: list[tuple[Form, tuple[float, int, int, int]]]) -> list[tuple[Form, tuple[float, int, int, int]]]:
    """The places that no better one of another license overlaps."""
    order = sorted(places, key=lambda p: (len(p[0].words) - 2 * p[1][3], p[1][1]))
    kept: list[tuple[Form, tuple[float, int, int, int]]] = []
    for form, place in order:
        low, high = place[1], place[1] + place[2]
        if all(f.license == form.license or high <= p[1] or p[1] + p[2] <= low for f, p in kept):
            kept.append((form, place))
    return kept


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    least: float = LEAST_COVERAGE,
) -> DataFrame:
    """A row per document and license found: doc_id, license, the template's number, its coverage,
    and the start, length and matched words of the place, counted in tokens of the text."""
    shared = docs.sparkSession.sparkContext.broadcast({k: tuple(v) for k, v in templates.items()})
    schema = "doc_id long, license string, template int, coverage double, start long, length long, matched long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = Forms(shared.value)
        for batch in slices(batches, 256):
            rows = []
            codes = token_codes(batch.column(1))
            ends = np.cumsum([len(c) for c in codes])[:-1]
            texts = np.split(forms.numbered(np.concatenate(codes)), ends) if codes else []
            possible = forms.possible(texts, least)
            for doc_id, text, able in zip(batch.column(0).to_pylist(), texts, possible, strict=True):
                tried = [forms.forms[k] for k in np.flatnonzero(able)]
                places = winners([(f, place) for f in tried for place in find(text, f, least)])
                best: dict[str, tuple] = {}
                for f, place in sorted(places, key=lambda p: (-p[1][0], -p[1][3], p[1][1])):
                    best.setdefault(f.license, (doc_id, f.license, f.number, *place))
                rows += best.values()
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[f.split()[0] for f in schema.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
