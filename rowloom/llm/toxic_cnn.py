"""Toxicity by a convolutional classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of the vectors of its hashed form and of its hashed beginnings (4 and 5 letters). Filters of one,
two and three words slide over the whole text, each keeps its largest answer, and a logistic layer makes a chance of them.
Everything is trained on the driver by Adam on at most ``max_rows`` labelled rows, half of them of either label where there
are enough, picked by a hash of their id; weights of the rows bring the true shares back. The first coordinates of a
vector start at how much more often its bucket stands in toxic texts than chance would have it, the rest at small numbers.
A fifth of the rows is kept from training: on it the score is calibrated and a threshold chosen for each language, the one
with the best F1 (of all languages together where a language has fewer than ``MIN_LANGUAGE`` toxic rows).

Scores depend on the text alone. Labels of rows with crc32(doc_id) mod 4 = 2 are never read when ``held_out`` is on.

Defined results: null and empty texts are one blank word and get a score as any other text. Labels without a document,
documents without a label and null labels are not learnt from. If a label is missing altogether, every score is the share
of toxic labels (0 without any). Rows without ``doc_id`` are scored and not held out. Repeated rows get equal scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import for_workers, whole_text

BUCKETS, SIZE = 2**19, 8
WIDTHS, FILTERS = (1, 2, 3), 12
BEGINNINGS = (4, 5)
MAX_ROWS = 8_000  # labelled rows that are learnt from
MIN_LANGUAGE = 30
CACHE = 300_000  # words whose vectors a task remembers before it starts anew
WORD = re.compile(r"\w+")
PAD = max(WIDTHS) - 1


def word_buckets(word: str) -> tuple[int, ...]:
    """The buckets of a word and of its beginnings; 0 is blank, as for the beginnings of a short word."""
    found = [word, *(word[:k] + "~" if len(word) > k else "" for k in BEGINNINGS)]
    return tuple(1 + zlib.crc32(f.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) if f else 0 for f in found)


class Vocabulary(dict):
    """Numbers the words as they come; ``buckets`` holds the buckets of each number, and number 0 is blank."""

    def __init__(self):
        super().__init__()
        self.buckets = [(0,) * (1 + len(BEGINNINGS))]

    def __missing__(self, word: str) -> int:
        value = self[word] = len(self.buckets)
        self.buckets.append(word_buckets(word))
        return value


def numbered(text: str, words: Vocabulary) -> np.ndarray:
    found = WORD.findall(text.lower())
    return np.fromiter(map(words.__getitem__, found), np.int32, len(found))


def joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in one row with blanks after each text, where each text starts, and which places a filter may stand on."""
    lengths = np.array([max(1, len(d)) for d in docs])
    starts = np.concatenate([[0], np.cumsum(lengths + PAD)])
    row, stands = np.zeros(starts[-1], np.int64), np.zeros(starts[-1], bool)
    for start, length, doc in zip(starts, lengths, docs, strict=False):
        row[start : start + len(doc)] = doc
        stands[start : start + length] = True
    return row, starts[:-1], stands


@dataclass
class Net:
    """The layers: filters by width (width x size x filters), their offsets, and the logistic layer on the maxima."""

    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [*self.filters, *self.offsets, self.out, self.bias]

    def answers(self, vectors: np.ndarray, stands: np.ndarray) -> list[np.ndarray]:
        """The answer of every filter at every place, minus infinity where it may not stand."""
        found = []
        for width, weights, offset in zip(WIDTHS, self.filters, self.offsets, strict=True):
            n = len(vectors) - width + 1
            answer = vectors[:n] @ weights[0] + offset
            for j in range(1, width):
                answer += vectors[j : j + n] @ weights[j]
            answer[~stands[:n]] = -np.inf
            found.append(answer)
        return found

    def numbers(self, vectors: np.ndarray, starts: np.ndarray, stands: np.ndarray) -> np.ndarray:
        best = [np.maximum.reduceat(a, starts, axis=0) for a in self.answers(vectors, stands)]
        return np.maximum(np.concatenate(best, axis=1), 0) @ self.out + self.bias[0]


@dataclass
class ToxicModel:
    """The vectors of the buckets that were seen, the net, the calibration and the thresholds."""

    seen: np.ndarray
    vectors: np.ndarray
    net: Net | None
    slope: float = 1.0
    shift: float = 0.0
    share: float = 0.0
    threshold: float = 0.5
    thresholds: dict[str, float] = field(default_factory=dict)

    def table(self) -> np.ndarray:
        full = np.zeros((BUCKETS, SIZE), np.float32)
        full[self.seen] = self.vectors
        return full


class Scorer:
    """Scores texts, remembering the vectors of words."""

    def __init__(self, model: ToxicModel):
        self.model, self.table = model, model.table() if model.net else None
        self.clear()

    def clear(self) -> None:
        self.words, self.vectors = Vocabulary(), np.zeros((1, SIZE), np.float32)

    def numbers(self, texts: list[str]) -> np.ndarray:
        docs = [numbered(t, self.words) for t in texts]
        known, count = len(self.vectors), len(self.words.buckets)
        if count > known:
            fresh = np.array(self.words.buckets[known:], np.int64)
            grown = np.empty((count, SIZE), np.float32)
            grown[:known], grown[known:] = self.vectors, self.table[fresh].sum(axis=1)
            self.vectors = grown
        row, starts, stands = joined(docs)
        out = self.model.net.numbers(self.vectors[row], starts, stands)
        if count > CACHE:
            self.clear()
        return out

    def scores(self, texts: list[str], step: int = 128) -> np.ndarray:
        if self.model.net is None:
            return np.full(len(texts), self.model.share)
        found = [self.numbers(texts[i : i + step]) for i in range(0, len(texts), step)]
        number = np.concatenate([np.empty(0), *found]).astype(float)
        return 1 / (1 + np.exp(-np.clip(self.model.slope * number + self.model.shift, -30, 30)))


def surprise(docs: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """For every bucket in texts: how far the toxic texts it is in exceed what its frequency would give, in deviations."""
    everywhere, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for doc, label in zip(docs, toxic, strict=True):
        found = np.unique(buckets[doc])
        everywhere[found] += 1
        bad[found] += label
    due = everywhere * toxic.mean()
    return (bad - due) / np.sqrt(due + 1)


def train_net(
    docs: list[np.ndarray], buckets: np.ndarray, toxic: np.ndarray, weight: np.ndarray, epochs: int, rate: float, seed: int
) -> tuple[np.ndarray, np.ndarray, Net]:
    """Vectors of the seen buckets and the layers, by Adam on batches of texts."""
    random = np.random.default_rng(seed)
    seen, place = np.unique(buckets, return_inverse=True)
    place = place.reshape(buckets.shape)
    start = surprise(docs, toxic, weight, buckets)[seen]
    vectors = random.normal(0, 0.05, (len(seen), SIZE))
    for column in range(buckets.shape[1]):  # a coordinate of its own for the word and for each beginning
        own = np.unique(place[:, column])
        vectors[own, column] = np.clip(start[own], -3, 8) / 4
    vectors[seen == 0] = 0
    net = Net(
        [random.normal(0, 0.3, (w, SIZE, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        random.normal(0, 0.1, FILTERS * len(WIDTHS)),
        np.array([-1.0]),
    )
    parts = net.parts()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    table_sum = np.zeros(len(seen))
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(docs))
        for first in range(0, len(order), 64):
            batch = order[first : first + 64]
            step += 1
            row, starts, stands = joined([docs[i] for i in batch])
            used = vectors[place[row]].sum(axis=1)
            answers = net.answers(used, stands)
            ends = [*starts[1:], len(row)]
            spots = [
                np.stack([s + a[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)]) for a in answers
            ]
            best = np.concatenate([np.take_along_axis(a, s, axis=0) for a, s in zip(answers, spots, strict=True)], axis=1)
            hidden = np.maximum(best, 0)
            chance = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.bias[0], -30, 30)))
            fault = (chance - toxic[batch]) * weight[batch] / len(batch)
            back = fault[:, None] * net.out[None, :] * (best > 0)
            slopes_filter, slopes_offset = [], []
            slope_used = np.zeros_like(used)
            for k, width in enumerate(WIDTHS):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                slope = np.zeros_like(net.filters[k])
                for j in range(width):
                    slope[j] = np.einsum("bfd,bf->df", used[spots[k] + j], own)
                    pull = own[:, :, None] * net.filters[k][j].T[None]
                    np.add.at(slope_used, (spots[k] + j).ravel(), pull.reshape(-1, SIZE))
                slopes_filter.append(slope)
                slopes_offset.append(own.sum(axis=0))
            slopes = [*slopes_filter, *slopes_offset, hidden.T @ fault, np.array([fault.sum()])]
            for part, slope, (m, v) in zip(parts, slopes, moments, strict=True):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope**2 - v)
                part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            moved = np.flatnonzero(np.abs(slope_used).sum(axis=1))
            for column in range(buckets.shape[1]):  # AdaGrad by row: only few vectors move in a batch
                at = place[row[moved], column]
                np.add.at(table_sum, at, (slope_used[moved] ** 2).mean(axis=1))
                np.add.at(vectors, at, -0.3 * rate * slope_used[moved] / (np.sqrt(table_sum[at]) + 1e-6)[:, None])
            vectors[seen == 0] = 0
    return seen, vectors.astype(np.float32), net


def calibrated(number: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits the numbers best (Newton steps, weakly held to 1 and 0)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(a * number + b, -30, 30)))
        fault, bend = weight * (toxic - chance), weight * chance * (1 - chance)
        gradient = np.array([(fault * number).sum() - (a - 1), fault.sum() - 0.1 * b])
        matrix = np.array([[(bend * number**2).sum() + 1, (bend * number).sum()], [(bend * number).sum(), bend.sum() + 0.1]])
        change = np.clip(np.linalg.solve(matrix, gradient), -1, 1)
        a, b = max(0.05, a + change[0]), b + change[1]
    return float(a), float(b)


def best_threshold(score: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The threshold with the best F1; the middle of the equally good ones."""
    steps = np.linspace(0.02, 0.98, 97)
    hits = np.array([(weight * toxic * (score >= s)).sum() for s in steps])
    taken = np.array([(weight * (score >= s)).sum() for s in steps])
    f1 = 2 * hits / np.maximum(taken + (weight * toxic).sum(), 1e-9)
    good = steps[f1 >= f1.max() - 1e-9]
    return float(good[len(good) // 2])


def fit(
    texts: list[str], toxic: list[int], langs: list[str | None], share: float, epochs: int = 6, rate: float = 0.01, seed: int = 7
) -> ToxicModel:
    """A model from labelled texts; ``share`` is the share of toxic labels that the score must reflect."""
    label = np.array(toxic, float)
    if not len(label) or label.min() == label.max():
        return ToxicModel(np.empty(0, np.int64), np.empty((0, SIZE), np.float32), None, share=share)
    kept = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % 5 == 0 for t in texts])
    if label[kept].sum() < 5 or label[~kept].min() == label[~kept].max():
        kept = np.zeros(len(texts), bool)
    own = label.mean()
    weight = np.where(label > 0, share / own, (1 - share) / (1 - own))
    words = Vocabulary()
    docs = [numbered(t, words) for t in texts]
    buckets = np.array(words.buckets, np.int64)
    learnt = np.flatnonzero(~kept)
    model = ToxicModel(
        *train_net([docs[i] for i in learnt], buckets, label[learnt], np.ones(len(learnt)), epochs, rate, seed), share=share
    )
    judged = np.flatnonzero(kept) if kept.any() else learnt
    scorer = Scorer(model)
    sample = [texts[i] for i in judged]
    number = np.concatenate([scorer.numbers(sample[i : i + 128]) for i in range(0, len(sample), 128)]).astype(float)
    model.slope, model.shift = calibrated(number, label[judged], weight[judged])
    score = scorer.scores(sample)
    model.threshold = best_threshold(score, label[judged], weight[judged])
    for lang in sorted({langs[i] for i in judged} - {None}):
        at = np.array([langs[i] == lang for i in judged])
        if label[judged][at].sum() >= MIN_LANGUAGE:
            model.thresholds[lang] = best_threshold(score[at], label[judged][at], weight[judged][at])
    return model


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, hold_out: bool = True) -> ToxicModel:
    """A model from ``docs`` (doc_id, text, lang) and ``labels`` (doc_id, toxic)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.filter(~held_out()) if hold_out else known
    counts = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    share = (counts["bad"] or 0) / max(1, counts["n"])
    half, order = max_rows // 2, [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.filter("toxic = 1").orderBy(*order).limit(half)
    picked = picked.unionByName(known.filter("toxic = 0").orderBy(*order).limit(half))  # bounded by the parameter
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), lang.alias("lang"))
    rows = own.join(F.broadcast(picked), "doc_id").orderBy(*order, "text").limit(max_rows).collect()
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], [r["lang"] for r in rows], share)


def scored(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, held_out, score, the threshold of the row's language, and whether the score reaches it."""
    for_workers(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value)
        for batch in batches:
            yield pd.Series(scorer.scores(batch.tolist()), dtype="float64")

    threshold = F.lit(float(model.threshold))
    if "lang" in docs.columns:
        for name, value in model.thresholds.items():  # one for each language with enough labels
            threshold = F.when(F.col("lang").cast("string") == name, F.lit(value)).otherwise(threshold)
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        score(whole_text()).alias("score"),
        threshold.alias("threshold"),
    )
    return out.withColumn("flagged", F.col("score") >= F.col("threshold"))
