"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy.

A word's vector is the sum of three rows of one hashed table: of the word, and of its first four
and six bytes. Filters of several widths run over the words, the greatest response of each is
kept, and a logistic unit joins them. The model is fitted on all labelled rows: these are dealt into
shards of about ``SHARD`` rows, in every round each shard goes on from the common model by itself, and
the changes of all shards are averaged. It is calibrated on a part of the rows that the fit doesn't
see, and then scores every whole text. Labels, language, source and doc_id are no input of a score; language
only picks the threshold behind ``flagged``.

Defined cases: a null or empty text scores what no word gives (the bias alone); rows without a
label or with a null doc_id are not learnt from; different labels of one doc_id count each; with
no labelled row of one kind every score is 0 (or 1, if all are toxic); repeated rows are learnt
from once and score alike;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aftermerge.llm.common import TOKEN_ENDS, lower_ascii, raw_text, slices, stage, word_prefix_codes

#: Rows of a shard, about, and how often the shards' models are averaged.
SHARD = 1024
ROUNDS = 4

#: Labels that are broadcast at most (some 50 MB); more are joined by shuffling.
BROADCAST_LABELS = 2_000_000

#: Averages are sums of whole steps of this size, so that the order of the tasks doesn't show in them.
STEP = 2.0**-32

#: Logits are counted in steps of this size for the thresholds.
LOGIT_STEP = 1 / 512

BUCKETS = 1 << 15
SIZE = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
PREFIXES = (4, 6)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The three buckets of every word, and where each text's words start (and the last end)."""
    data, starts = raw_text(texts)
    codes, first = word_prefix_codes(lower_ascii(data), starts, TOKEN_ENDS, PREFIXES)
    salt = np.arange(1, len(codes) + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    buckets = ((codes ^ salt) % np.uint64(BUCKETS)).astype(np.int32).T
    return buckets, np.searchsorted(first, starts)


@dataclass
class Model:
    """The parameters; ``thresholds`` by language on the score, ``bias`` on the logit."""

    table: np.ndarray
    filters: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)
    constant: float | None = None

    @classmethod
    def start(cls, seed: int = 11) -> Model:
        rng = np.random.default_rng(seed)
        return cls(
            (rng.standard_normal((BUCKETS, SIZE)) * 0.05).astype(np.float32),
            [(rng.standard_normal((w, SIZE, FILTERS)) / np.sqrt(w * SIZE)).astype(np.float32) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32),
        )

    def responses(
        self, buckets: np.ndarray, bounds: np.ndarray, where: bool = False
    ) -> tuple[np.ndarray, np.ndarray | None]:
        """The greatest response of each filter per text (0 at least), and the word where it starts."""
        texts, n = len(bounds) - 1, len(buckets)
        top = np.zeros((texts, FILTERS * len(WIDTHS)), self.table.dtype)
        at = np.full(top.shape, -1, np.int64) if where else None
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        if not n:
            return top, at
        x = self.table[buckets].sum(1)
        end = np.repeat(bounds[1:][full], np.diff(bounds)[full])
        for k, (weights, shift) in enumerate(zip(self.filters, self.shifts, strict=True)):
            z = x @ weights[0] + shift
            for j in range(1, len(weights)):
                inside = np.flatnonzero(np.arange(n) + j < end)  # beyond a text's end is nothing
                z[inside] += x[inside + j] @ weights[j]
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            best = np.maximum.reduceat(z, bounds[:-1][full], axis=0)
            top[full, part] = np.maximum(best, 0)
            if at is not None:
                for row in full:
                    a, b = bounds[row], bounds[row + 1]
                    first = z[a:b].argmax(0)
                    at[row, part] = np.where(z[a + first, np.arange(FILTERS)] > 0, a + first, -1)
        return top, at

    def logits(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.responses(buckets, bounds)[0] @ self.out + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(*features(texts)).astype(float), -30, 30)))


class _Adam:
    """Adam over a list of arrays; rows of the table are updated where they have gradients."""

    def __init__(self, rate: float) -> None:
        self.rate, self.state, self.step = rate, {}, 0

    def update(self, name: str, value: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        m, v = self.state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        pick = slice(None) if rows is None else rows
        m[pick] = 0.9 * m[pick] + 0.1 * grad
        v[pick] = 0.98 * v[pick] + 0.02 * grad * grad
        t = self.step
        value[pick] -= self.rate * (m[pick] / (1 - 0.9**t)) / (np.sqrt(v[pick] / (1 - 0.98**t)) + 1e-6)


def presence(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """In how many texts of either label each bucket is."""
    seen = np.zeros((2, BUCKETS), np.int64)
    for buckets, label in zip(docs, labels.astype(int), strict=True):
        seen[label, np.unique(buckets)] += 1
    return seen


def warm_start(model: Model, seen: np.ndarray, n: np.ndarray) -> None:
    """Put the log odds of each bucket's presence into one coordinate that one filter reads."""
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    sure = (seen.sum(0) / (seen.sum(0) + 3)) * np.clip(odds, -3, 4)
    model.table[:, 0] += sure.astype(np.float32) / 3
    model.filters[0][0, 0, 0], model.shifts[0][0], model.out[0] = 1.0, -1.0, 1.5
    model.bias = -1.5


def gradients(
    model: Model, buckets: np.ndarray, bounds: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None
) -> dict[str, np.ndarray]:
    """The gradient of the mean logistic loss of some texts, for every array of the model.

    ``weights``: how much a text of either label counts (once without them).

    ``table`` has a row for each of ``rows``, the buckets that any greatest response rests on.
    """
    kind = model.table.dtype
    top, at = model.responses(buckets, bounds, where=True)
    p = 1 / (1 + np.exp(-np.clip(top @ model.out + kind.type(model.bias), -30, 30)))
    each = 1 if weights is None else weights[labels.astype(int)]
    error = (each * (p - labels) / len(labels)).astype(kind)
    back = error[:, None] * model.out[None, :] * (at >= 0)
    found = {"out": top.T @ error, "bias": error.sum(keepdims=True)}
    hit_words, hit_grads = [], []
    for k, weights in enumerate(model.filters):
        part = slice(k * FILTERS, (k + 1) * FILTERS)
        g, where = back[:, part], at[:, part]
        grad = np.zeros_like(weights)
        for j in range(len(weights)):
            row, col = np.nonzero((g != 0) & (where + j < bounds[1:, None]))
            word, value = where[row, col] + j, g[row, col]
            x = model.table[buckets[word]].sum(1)
            np.add.at(grad[j].T, col, value[:, None] * x)
            hit_words.append(word)
            hit_grads.append(value[:, None] * weights[j][:, col].T)
        found[f"w{k}"], found[f"s{k}"] = grad, g.sum(0)
    words, grads = np.concatenate(hit_words), np.concatenate(hit_grads)
    found["rows"], place = np.unique(buckets[words], return_inverse=True)
    found["table"] = np.zeros((len(found["rows"]), SIZE), kind)
    np.add.at(found["table"], place.reshape(len(words), -1), grads[:, None, :])
    return found


def flat(model: Model) -> np.ndarray:
    """All parameters as rows of ``SIZE`` numbers: the table, then the others."""
    rest = np.concatenate([*(w.ravel() for w in model.filters), *model.shifts, model.out, [model.bias]])
    rest = np.pad(rest.astype(float), (0, -len(rest) % SIZE))
    return np.concatenate([model.table.astype(float), rest.reshape(-1, SIZE)])


def unflat(rows: np.ndarray) -> Model:
    """The model of :func:`flat`."""
    model, rest = Model.start(), rows[BUCKETS:].ravel()
    model.table = rows[:BUCKETS].astype(np.float32)
    at = 0
    for value in (*model.filters, *model.shifts, model.out):
        value[...] = rest[at : at + value.size].reshape(value.shape)
        at += value.size
    model.bias = float(rest[at])
    return model


def fit_shard(model: Model, docs: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int, batch: int = 32) -> None:
    """Go on training once over texts given as their words' buckets."""
    rng, adam = np.random.default_rng(seed), _Adam(0.005)
    bias = np.array([model.bias], np.float32)
    order = rng.permutation(len(docs))
    for low in range(0, len(order), batch):
        chosen = order[low : low + batch]
        bounds = np.cumsum([0, *(len(docs[k]) for k in chosen)])
        buckets = np.concatenate([docs[k] for k in chosen])
        model.bias = float(bias[0])
        found = gradients(model, buckets, bounds, labels[chosen], weights)
        adam.step += 1
        adam.update("out", model.out, found["out"] + 1e-4 * model.out)
        adam.update("bias", bias, found["bias"])
        for k, filters in enumerate(model.filters):
            adam.update(f"w{k}", filters, found[f"w{k}"])
            adam.update(f"s{k}", model.shifts[k], found[f"s{k}"])
        adam.update("table", model.table, found["table"], found["rows"])
    model.bias = float(bias[0])


def best_threshold(logits: np.ndarray, labels: np.ndarray, share: float, counts: np.ndarray) -> float:
    """The logit that splits best, with toxic rows weighted to be ``share`` of all; in mid-gap.

    ``counts``: how many rows have a logit and label.
    """
    order = np.argsort(logits)
    z, y, n = logits[order], labels[order].astype(bool), counts[order]
    weight = n * np.where(y, share / max(n[y].sum(), 1), (1 - share) / max(n[~y].sum(), 1))
    wrong = np.concatenate([[0], np.cumsum(np.where(y, weight, 0))]) + np.concatenate(
        [np.cumsum(np.where(y, 0, weight)[::-1])[::-1], [0]]
    )
    good = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    k = int(good[len(good) // 2])
    edges = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    return float((edges[k] + edges[k + 1]) / 2)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learnt from: those whose checksum of the doc_id is divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def shards(docs: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """All rows to learn from, staged: ``shard`` and ``rows``, some ``SHARD`` of ``n`` in an array.

    The array's structs are in the order of their hashes (``__order``). A row is dealt out by
    its doc_id and hash, so repeated rows meet, of which one is kept.
    """
    usable = docs.select("doc_id", "text", "lang").where("doc_id IS NOT NULL").where(~held_out())
    if n <= BROADCAST_LABELS:
        known = F.broadcast(known)
    met = usable.join(known, F.col("doc_id") == F.col("__id")).withColumn(
        "__order", F.xxhash64("doc_id", "text", F.lit(3))
    )
    dealt = met.withColumn("shard", F.pmod(F.xxhash64("__order", "doc_id"), F.lit(max(1, n // SHARD))))
    one = (
        dealt.repartition("shard")
        .groupBy("shard", "__order", "doc_id", "__toxic")
        .agg(F.min("text").alias("text"), F.min("lang").alias("lang"))
    )
    row = F.struct("__order", "doc_id", F.col("__toxic").cast("int").alias("toxic"), "text", "lang")
    return stage(one.groupBy("shard").agg(F.sort_array(F.collect_list(row)).alias("rows")), "toxicity")


def _words(rows: pa.StructArray) -> list[np.ndarray]:
    """The words' buckets of each row's text."""
    texts, words = rows.field("text"), []
    for low in range(0, len(texts), 64):  # a few texts at a time: what is derived from them is large
        buckets, bounds = features(texts.slice(low, 64))
        words += np.split(buckets, bounds[1:-1])
    return words


def _each_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.StructArray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.column(0)[k].as_py(), batch.column(1).slice(k, 1).flatten()


def _aside(rows: pa.StructArray, some: bool) -> np.ndarray:
    order = rows.field("__order").to_numpy()
    return (order % 5 == 0) if some else np.zeros(len(order), bool)


def _summed(df: DataFrame, run: object, width: int) -> np.ndarray:
    """The sums of what all tasks yield, as a matrix: arrays of a row's number and ``width`` longs."""
    names = [f"v{k}" for k in range(width)]
    parts = df.mapInArrow(run, ", ".join(["at int", *(f"{n} long" for n in names)]))
    table = parts.groupBy("at").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    out = np.zeros((len(flat(Model.start())), width), np.int64)
    out[table["at"].to_numpy()] = np.stack([table[n].to_numpy() for n in names], 1)
    return out


def _rows_of(sums: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(sums.any(1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(at), *(pa.array(np.ascontiguousarray(sums[at, k])) for k in range(sums.shape[1]))],
        names=["at", *(f"v{k}" for k in range(sums.shape[1]))],
    )


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Fit and calibrate on all labelled rows that aren't held out."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic")).where(
        "__id IS NOT NULL AND __toxic IN (0, 1)"
    )
    totals = {
        r["__toxic"]: r["n"]
        for r in known.where(~held_out("__id")).groupBy("__toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    own = shards(docs, known.where(~held_out("__id")).distinct(), sum(totals.values()))
    one = F.col("r.toxic") == 1
    counted = own.select(F.explode("rows").alias("r")).agg(F.count_if(~one), F.count_if(one)).first()
    sizes = np.array([counted[0], counted[1]])
    if not sizes.all():
        model = Model.start()
        model.constant = float(sizes[1] > 0)
        return model
    some = bool(sizes.min() >= 50)
    context = docs.sparkSession.sparkContext

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((BUCKETS + 1, 2), np.int64)
        for _, rows in _each_shard(batches):
            seen = ~_aside(rows, some)
            y = rows.field("toxic").to_numpy()[seen]
            found[:BUCKETS] += presence(_words(rows.filter(pa.array(seen))), y).T
            found[BUCKETS] += np.bincount(y, minlength=2)
        yield _rows_of(found)

    seen = _summed(own, count, 2)
    n, model = seen[BUCKETS], Model.start()
    warm_start(model, seen[:BUCKETS].T, n)
    weights = np.clip(n.sum() / np.maximum(2 * n, 1), 0.1, 10)
    for turn in range(rounds):
        shared = context.broadcast(flat(model))

        def learn(batches: Iterable[pa.RecordBatch], turn: int = turn, shared: object = shared) -> Iterator[pa.RecordBatch]:
            start = shared.value
            sums = np.zeros((len(start), SIZE + 1), np.int64)
            for shard, rows in _each_shard(batches):
                learnt = ~_aside(rows, some)
                if not learnt.any():
                    continue
                rows = rows.filter(pa.array(learnt))
                local = unflat(start)
                y = rows.field("toxic").to_numpy().astype(np.float32)
                fit_shard(local, _words(rows), y, weights, 1000 * shard + turn)
                change = flat(local) - start.astype(np.float32)
                sums[:, :SIZE] += np.round(change / STEP).astype(np.int64)
                touched = change.any(1)
                touched[BUCKETS:] = True
                sums[:, SIZE] += touched
            yield _rows_of(sums)

        sums = _summed(own, learn, SIZE + 1)
        # A bucket's change is the mean over the shards that changed it.
        model = unflat(flat(model) + sums[:, :SIZE] * STEP / np.maximum(sums[:, SIZE:], 1))
        shared.destroy()
    shared = context.broadcast(model)

    def logits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _each_shard(batches):
            tune = _aside(rows, some) if some else np.ones(len(rows), bool)
            rows = rows.filter(pa.array(tune))
            for low in range(0, len(rows), 64):
                part = rows.slice(low, 64)
                z = shared.value.logits(*features(part.field("text")))
                steps = np.round(np.clip(z, -30, 30) / LOGIT_STEP).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.field("lang"), part.field("toxic"), pa.array(steps)], names=["lang", "toxic", "step"]
                )

    # A row per language, label and step of the logit, whatever the rows.
    found = (
        own.mapInArrow(logits, "lang string, toxic int, step int")
        .groupBy("lang", "toxic", "step")
        .agg(F.count(F.lit(1)).alias("n"))
        .toArrow()
        .sort_by([("step", "ascending"), ("toxic", "ascending")])
    )
    z, y, n = (found[c].to_numpy() for c in ("step", "toxic", "n"))
    z = z * LOGIT_STEP
    share = totals.get(1, 0) / max(sum(totals.values()), 1)
    middle = best_threshold(z, y, share, n)
    model.bias -= middle  # a score of one half splits best over all
    langs = np.array(found["lang"].to_pylist(), object)
    for lang in set(langs.tolist()):
        at = langs == lang
        if 5 <= (n * y)[at].sum() <= n[at].sum() - 5:
            cut = best_threshold(z[at] - middle, y[at], share, n[at])
            model.thresholds[lang] = 1 / (1 + float(np.exp(-cut)))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted and, with its language's threshold, flagged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, 64):
            found = own.scores(batch.column(2))
            cut = np.array([own.thresholds.get(lang, 0.5) for lang in batch.column(3).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(found),
                    pa.array((found >= 0.5).astype(np.int32)),
                    pa.array(found >= cut),
                ],
                names=["doc_id", "held_out", "score", "predicted", "flagged"],
            )

    narrow = docs.select("doc_id", held_out().alias("held_out"), "text", "lang")
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, flagged boolean")
