"""Quality grades by ordinal regression with cumulative links.

A text gets one number: the mean, over its words, of a weight for the hashed word and one for its hashed shape (letters,
capitals, digits and marks, runs folded), plus weights of hashed page features (share of repeated words and lines, of
marks, of capitals, length). Ordered thresholds cut that number into grades: P(grade >= k) is the logistic of number minus
threshold k, with the same weights for all k. The weights and the thresholds are fitted together, in numpy on the driver,
on at most ``max_rows`` labelled rows picked by a hash of their id; texts become counted buckets in tasks, and only these
reach the driver. The expected grade and the tail probability come out
for every text; a text is accepted if it reaches grade ``least`` with probability ``accept`` or more.

Defined results: null and empty texts have no words and are graded by their page features alone. Labels without a
document, documents without a label and rows with a null label are not fitted. If fewer than two grades are left, nothing
can be learnt and every text is accepted. Repeated rows get equal grades. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import for_workers, map_batches, texts, whole_text

BUCKETS = 2**16
MAX_ROWS = 6_000  # labelled rows that are fitted
MIN_TEXTS = 5  # words in fewer of the fitted texts get no weight
PULL = 3.0  # a word's share of its text is multiplied by this, so that single words are learnt in few steps
CACHE = 400_000  # words whose buckets a task remembers before it starts anew


RUN_OF_LETTERS, RUN_OF_DIGITS, RUN_OF_MARKS = (re.compile(x) for x in (r"[^\W\d_]+", r"\d+", r"([^\w\s])\1+"))


def shape(word: str) -> str:
    """The case of the letters, then the word with letters as @, digits as 0 and runs of equal marks folded to two."""
    kind = "a" if word.islower() else "A" if word.isupper() and len(word) > 1 else "Aa"
    if word.isalpha():
        return kind
    if word[:-1].isalpha():
        return f"{kind}@{word[-1]}"
    marks = RUN_OF_DIGITS.sub("0", RUN_OF_LETTERS.sub("@", word))
    return kind + RUN_OF_MARKS.sub(r"\1\1", marks)


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


class WordBuckets(dict):
    """The buckets of a word and of its shape, as one number, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = bucket("w:" + word.lower()) << 16 | bucket("s:" + shape(word))
        return value


def page_features(text: str, words: list[str]) -> list[int]:
    """Buckets of the features of a text as a whole, each a share in tenths or the order of magnitude of a length."""
    lines = [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    shares = {
        "repeated": 1 - len(set(words)) / n,
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
        "alone": (lengths == 1).sum() / n,
        "long": (lengths > 20).sum() / n,
        "digits": sum(map(str.isdigit, words)) / n,
    }
    found = [bucket(f"{name}:{int(10 * share)}") for name, share in shares.items()]
    return [*found, bucket(f"length:{len(words).bit_length()}"), bucket(f"line:{(n // max(1, len(lines))).bit_length()}")]


def features(text: str, known: WordBuckets) -> tuple[np.ndarray, list[int]]:
    words = text.split()
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), page_features(text, words)


@dataclass
class OrdinalModel:
    """Weights of the buckets and the ordered thresholds of the grades 1, 2 and so on."""

    weights: np.ndarray
    cuts: np.ndarray
    grades: list[int]

    def tails(self, texts: list[str], known: WordBuckets) -> np.ndarray:
        """P(grade >= k) for each text and each grade but the lowest."""
        numbers = np.zeros(len(texts))
        for i, text in enumerate(texts):
            words, page = features(text, known)
            numbers[i] = self.weights[page].sum()
            if len(words):
                numbers[i] += PULL * (self.weights[words >> 16].sum() + self.weights[words & 0xFFFF].sum()) / len(words)
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - numbers[:, None], -60, 60)))


def counted(text: str, known: WordBuckets) -> tuple[np.ndarray, np.ndarray, int]:
    """The buckets of a text, how often each stands in it, with 0 for those of the page, and its number of words."""
    words, page = features(text, known)
    used, counts = np.unique(np.concatenate([words >> 16, words & 0xFFFF]), return_counts=True)
    return np.concatenate([used, np.array(page, np.int64)]), np.concatenate([counts, np.zeros(len(page), np.int64)]), len(words)


def fit(texts: list[str], grades: list[int], epochs: int = 150, rate: float = 0.05, decay: float = 1e-4) -> OrdinalModel:
    """The most likely weights and thresholds of ``texts``."""
    known = WordBuckets()
    rows = [counted(text, known) for text in texts] or [(np.empty(0, np.int64), np.empty(0, np.int64), 0)]
    places, counts, words = zip(*rows, strict=True)
    sizes = [len(p) for p in places]
    return fit_counted(np.concatenate(places), np.concatenate(counts), sizes, words, grades, epochs, rate, decay)


def fit_counted(
    place: np.ndarray, counts: np.ndarray, sizes, words, grades, epochs: int = 150, rate: float = 0.05, decay: float = 1e-4
) -> OrdinalModel:
    """The most likely weights and thresholds, by Adam on all rows at once.

    ``place`` and ``counts`` are what ``counted`` gives of all texts, end to end, ``sizes`` and ``words`` the buckets and
    words of each.
    """
    levels = sorted(set(grades))
    if len(levels) < 2:
        return OrdinalModel(np.zeros(BUCKETS), np.empty(0), levels)
    row = np.repeat(np.arange(len(grades)), sizes)
    texts_with = np.bincount(place[counts > 0], minlength=BUCKETS)
    value = np.where(counts > 0, PULL * counts / np.maximum(1, words)[row], 1.0)
    often = np.maximum(texts_with[place], (value == 1) * MIN_TEXTS) >= MIN_TEXTS
    row, place, value = row[often], place[often], value[often]
    seen, column = np.unique(place, return_inverse=True)
    grade = np.searchsorted(levels, grades)
    k = len(levels) - 1
    reached = grade[:, None] > np.arange(k)[None, :]
    weights, gaps = np.zeros(len(seen)), np.zeros(k)
    share = np.clip(reached.mean(axis=0), 0.01, 0.99)
    first = -np.log(share[0] / (1 - share[0]))
    base = np.array([first, *np.log(np.maximum(0.1, np.diff(-np.log(share / (1 - share)))))])
    moments = [np.zeros((2, len(seen))), np.zeros((2, k))]
    for step in range(1, epochs + 1):
        raw = base + gaps
        cuts = raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])
        number = np.bincount(row, weights[column] * value, len(grades))
        upper = 1 / (1 + np.exp(np.clip(cuts[None, :] - number[:, None], -60, 60)))
        tail = np.concatenate([np.ones((len(grades), 1)), upper, np.zeros((len(grades), 1))], axis=1)
        slope = tail * (1 - tail)
        at = np.arange(len(grades))
        chance = np.maximum(1e-9, tail[at, grade] - tail[at, grade + 1])
        above, below = slope[at, grade] / chance, slope[at, grade + 1] / chance
        pull = above - below  # of the log likelihood by the number
        by_cut = np.zeros((len(grades), k + 2))
        by_cut[at, grade] -= above
        by_cut[at, grade + 1] += below
        by_cut = by_cut[:, 1:-1].mean(axis=0)
        by_raw = np.array([by_cut.sum(), *(np.exp(raw[j]) * by_cut[j:].sum() for j in range(1, k))])
        by_weight = np.bincount(column, pull[row] * value, len(seen)) / len(grades) - decay * weights
        for target, slope_of, moment in ((weights, by_weight, moments[0]), (gaps, by_raw, moments[1])):
            moment[0] = 0.9 * moment[0] + 0.1 * slope_of
            moment[1] = 0.99 * moment[1] + 0.01 * slope_of**2
            target += rate * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(BUCKETS)
    full[seen] = weights
    raw = base + gaps
    return OrdinalModel(full, raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))]), levels)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 for low quality, 1 for good but toxic texts, 2 for good texts that are not."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))


def sampled(docs: DataFrame, rated: DataFrame, max_rows: int) -> DataFrame:
    """What ``counted`` gives of the texts that are fitted, and their grades: at most ``max_rows``, those with the smallest hashes of their ids."""
    known = rated.filter("grade IS NOT NULL AND doc_id IS NOT NULL")
    known = known.select(F.col("doc_id").cast("long").alias("rated_id"), F.col("grade").cast("int").alias("grade"))
    picked = known.orderBy(F.xxhash64("rated_id"), "rated_id", "grade").limit(max_rows)  # bounded by the parameter
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = own.join(F.broadcast(picked), F.col("doc_id") == F.col("rated_id")).select("doc_id", "text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets()
        for batch in batches:
            for start, part in texts(batch.column(1)):
                places, counts, words = zip(*[counted(text, buckets) for text in part], strict=True)
                columns = [pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())), pa.array(words, pa.int64())]
                names = [*batch.schema.names, "places", "counts", "words"]
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(part)).columns, *columns], names=names)

    found = map_batches(rows, run, "doc_id long, text string, grade int, places array<int>, counts array<int>, words long")
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "text", "grade").limit(max_rows)
    return found.select("grade", "places", "counts", "words")


def train(docs: DataFrame, rated: DataFrame, max_rows: int = MAX_ROWS) -> OrdinalModel:
    """A model from ``docs`` (doc_id, text) and ``rated`` (doc_id, grade)."""
    rows = sampled(docs, rated, max_rows).toArrow().combine_chunks()
    flat = {name: pc.list_flatten(rows[name]).to_numpy().astype(np.int64) for name in ("places", "counts")}
    sizes = pc.list_value_length(rows["places"]).to_numpy()
    return fit_counted(flat["places"], flat["counts"], sizes, rows["words"].to_numpy(), rows["grade"].to_pylist())


def tail_column(docs: DataFrame, model: OrdinalModel):
    """The tail probabilities of a row's text, as an array column."""
    for_workers(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def tails(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = WordBuckets()
        for batch in batches:
            yield pd.Series(list(sent.value.tails(batch.tolist(), known)))

    return tails(whole_text())


def chance_of(tails, model: OrdinalModel, least: int):
    """The chance of grade ``least`` or better."""
    at = next((i for i, g in enumerate(model.grades) if g >= least), None)
    if len(model.grades) < 2 or at == 0:
        return F.lit(1.0)
    return F.lit(0.0) if at is None else tails[at - 1]


def graded(docs: DataFrame, model: OrdinalModel, least: int = 1, accept: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probability (of grade ``least`` or better) and accepted, for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tail_column(docs, model).alias("tails"))
    lowest = float(model.grades[0]) if model.grades else 0.0
    steps = np.diff(model.grades).astype(float).tolist()
    expected = sum((F.col("tails")[i] * s for i, s in enumerate(steps)), F.lit(lowest))
    chance = chance_of(F.col("tails"), model, least)
    out = rows.select("doc_id", expected.alias("expected_grade"), chance.alias("tail_probability"))
    return out.withColumn("accepted", F.col("tail_probability") >= accept)


def accepted_rows(docs: DataFrame, model: OrdinalModel, least: int = 1, accept: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that reach grade ``least`` with probability ``accept`` or more."""
    return docs.filter(chance_of(tail_column(docs, model), model, least) >= accept)
