"""Benchmark decontamination by spaced seeds.

A mask of ones and zeros is laid on every run of words: the words under the ones are hashed together, those under the
zeros are ignored, so a replaced word under a zero does not change the hash. Items and documents are hashed with the same
fixed masks and joined on the hashes. Around each hit the document's words are compared with the item's along the hit's
diagonal, and the longest stretch with at least ``similarity`` equal words is taken; it counts if it has ``min_overlap``
equal words (or the whole item has fewer words, and the stretch covers it).

Documents send only hashes that pass a Bloom filter of the items' hashes. The filter has a fixed number of bits whatever
the benchmark's size, so it may be broadcast; a larger benchmark lets more hashes through to the exact join, and no hit is
ever lost. It is put together in Spark, and what reaches the driver is its words, at most BLOOM_BITS / 32 rows.

An item of fewer than two mask spans is cut into one piece more than words may differ in it, so one piece is always whole,
and the pieces are hashed as well; with ``similarity`` 0.8, an item of up to four words is one piece and is found verbatim,
however common it is. Scripts without spaces are read by characters, each a word.

Defined results: null and empty texts have no words and no hits. Equal texts are checked once and give the same rows. Equal items each give
their row. Rows without ``doc_id`` are returned with a null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import map_batches, stored, texts

MASKS = ("110010101", "101100011", "111000101", "100110110")
FLANK = 64  # words kept on either side of a run of hits, for the check
BLOOM_BITS = 2**24
WORD = re.compile(r"\w+")
UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
ANY_UNSPACED = re.compile(f"[{UNSPACED}]")
WORD_OR_SIGN = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+")
CACHE = 500_000  # words whose hashes a task remembers before it starts anew


class WordHashes(dict):
    """The hash of a word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        data = word.encode("utf-8")
        value = self[word] = zlib.crc32(data) | (zlib.crc32(data, 0x9E3779B9) << 32)
        return value


def word_hashes(text: str, known: WordHashes) -> np.ndarray:
    unspaced = not text.isascii() and ANY_UNSPACED.search(text)
    words = (WORD_OR_SIGN if unspaced else WORD).findall(text.lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E6C63D0876A9A47)
    return values ^ (values >> np.uint64(29))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash under the mask at every position where the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, zlib.crc32(mask.encode()), np.uint64)
    for offset in (i for i, bit in enumerate(mask) if bit == "1"):
        total = total * np.uint64(0x100000001B3) + words[offset : offset + n]
    return mixed(total)


def bloom_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.uint64(BLOOM_BITS - 1)
    return hashes & top, (hashes >> np.uint64(32)) & top


def longest_like(equal: np.ndarray, similarity: float) -> tuple[int, int]:
    """Start and end of the longest stretch whose share of equal words is at least ``similarity``, trimmed to equal words."""
    gain = np.where(equal, 1 - similarity, -similarity)
    sums = np.concatenate([[0.0], np.cumsum(gain)]) + np.arange(len(equal) + 1) * 1e-12
    lowest = np.minimum.accumulate(sums)
    starts = np.searchsorted(-lowest, -sums, side="left")
    end = int(np.argmax(np.arange(len(sums)) - starts))
    start = int(starts[end])
    hits = np.flatnonzero(equal[start:end])
    return (start + int(hits[0]), start + int(hits[-1]) + 1) if len(hits) else (0, 0)


def pieces(n: int, similarity: float) -> tuple[int, int]:
    """Number and words of the pieces of a short item: one more than words may differ, so one is always whole."""
    if not 0 < n < 2 * len(MASKS[0]):
        return 0, 0
    number = min(n, n - int(np.ceil(similarity * n - 1e-9)) + 1)
    return number, n // number


def item_words(benchmark: DataFrame, similarity: float) -> DataFrame:
    """The hashed words, the seeds and the words in a piece (0: no pieces) of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            words, places, hashes, sizes = [], [], [], []
            for _, part in texts(batch.column(1)):
                for text in part:
                    own = word_hashes(text, known)
                    found = [seeds(own, m) for m in MASKS]
                    at = [np.arange(len(f), dtype=np.int32) for f in found]
                    number, size = pieces(len(own), similarity)
                    if number:
                        at.append(np.arange(number, dtype=np.int32) * np.int32(size))
                        found.append(seeds(own, "1" * size)[at[-1]])
                    sizes.append(size)
                    words.append(own.view(np.int64))
                    places.append(np.concatenate(at))
                    hashes.append(np.concatenate(found).view(np.int64))
            arrays = [batch.column(0), pa.array(words, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))]
            arrays += [pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["item_id", "item", "places", "hashes", "piece"])

    picked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return map_batches(picked, run, "item_id long, item array<long>, places array<int>, hashes array<long>, piece int")


def bloom_filter(item_seeds: DataFrame) -> np.ndarray:
    """The filter as bytes: of a fixed size, from at most BLOOM_BITS / 32 rows."""
    low = F.col("hash").bitwiseAND(F.lit(BLOOM_BITS - 1))
    high = F.shiftrightunsigned("hash", 32).bitwiseAND(F.lit(BLOOM_BITS - 1))
    places = item_seeds.select(F.explode(F.array(low, high)).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 31 AS int))")
    words = places.groupBy(F.shiftright("place", 5).alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros(BLOOM_BITS // 32, "<u4")
    out[[w["at"] for w in words]] = [w["bits"] for w in words]
    return out.view(np.uint8)


def runs_of_hits(docs: DataFrame, bloom: np.ndarray, masks: tuple[str, ...]) -> DataFrame:
    """For each run of positions that pass the filter: the words around it and its hashes, under the text's MD5."""
    sent = docs.sparkSession.sparkContext.broadcast(bloom)
    span = max(map(len, masks))

    def hits(words: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places, hashes = [], []
        for mask in masks:
            found = seeds(words, mask)
            low, high = bloom_places(found)
            passed = (bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1
            at = np.flatnonzero(passed)
            if len(at):
                high = high[at]
                at = at[((bits[high >> np.uint64(3)] >> (high & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)]
                places.append(at)
                hashes.append(found[at])
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        place, value = np.concatenate(places), np.concatenate(hashes)
        order = np.argsort(place, kind="stable")
        return place[order], value[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = WordHashes(), sent.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for first, part in texts(batch.column(1)):
                for number, text in enumerate(part, first):
                    words = word_hashes(text, known)
                    place, value = hits(words, bits)
                    if not len(place):
                        continue
                    key = hashlib.md5(text.encode("utf-8")).hexdigest()
                    gaps = np.flatnonzero(np.diff(place) > FLANK) + 1
                    for at, own in zip(np.split(place, gaps), np.split(value, gaps), strict=True):
                        start = max(0, int(at[0]) - FLANK)
                        window = words[start : int(at[-1]) + span + FLANK].view(np.int64)
                        rows.append((ids[number], key, start, window, at.astype(np.int32), own.view(np.int64)))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), RUN_TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "start", "words", "at", "hashes"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, key string, start int, words array<long>, at array<int>, hashes array<long>"
    return map_batches(picked, run, schema)


RUN_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]


def verified(candidates: DataFrame, similarity: float, min_overlap: int) -> DataFrame:
    """The longest like stretch of each candidate along its diagonal, where it is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            keys, item_ids, starts, shifts, words, items = (c.to_pylist() for c in batch.columns)
            for key, item_id, start, shift, own, item in zip(keys, item_ids, starts, shifts, words, items, strict=True):
                low, high = max(shift, start), min(shift + len(item), start + len(own))
                if high <= low:
                    continue
                equal = np.array(own[low - start : high - start]) == np.array(item[low - shift : high - shift])
                first, last = longest_like(equal, similarity)
                matched = int(equal[first:last].sum())
                if matched >= min(min_overlap, similarity * len(item)):
                    rows.append((key, item_id, low + first, low + last, low + first - shift, matched))
            if rows:
                names = ["key", "item_id", "doc_start", "doc_end", "item_start", "matched"]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=VERIFIED)

    schema = "key string, item_id long, doc_start int, doc_end int, item_start int, matched int"
    picked = candidates.select("key", "item_id", "start", "shift", "words", "item")
    return map_batches(picked, run, schema)


VERIFIED = pa.schema(
    [("key", pa.string()), ("item_id", pa.int64())]
    + [(n, pa.int32()) for n in ("doc_start", "doc_end", "item_start", "matched")]
)


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_overlap: int = 12) -> DataFrame:
    """Texts (by MD5) with the items they hold, the longest stretch of each, and the ids of the documents."""
    items = stored(item_words(benchmark, similarity), "seed-items")
    sizes = sorted(r.piece for r in items.filter("piece > 0").select("piece").distinct().collect())  # at most 17
    zipped = F.explode(F.arrays_zip("places", "hashes"))
    item_seeds = items.select("item_id", zipped.alias("seed"))
    item_seeds = item_seeds.select("item_id", F.col("seed.places").alias("place"), F.col("seed.hashes").alias("hash"))
    runs = stored(runs_of_hits(docs, bloom_filter(item_seeds), (*MASKS, *("1" * n for n in sizes))), "seed-runs")
    windows = runs.dropDuplicates(["key", "start"])
    hits = windows.select("key", "start", F.explode(F.arrays_zip("at", "hashes")).alias("hit"))
    hits = hits.select("key", "start", F.col("hit.at").alias("at"), F.col("hit.hashes").alias("hash"))
    met = hits.join(item_seeds, "hash").select("key", "start", "item_id", (F.col("at") - F.col("place")).alias("shift"))
    met = stored(met.distinct(), "seed-met")
    candidates = met.join(windows.select("key", "start", "words"), ["key", "start"])
    candidates = candidates.join(items.select("item_id", "item"), "item_id")
    best = F.max_by(F.struct("doc_start", "doc_end", "item_start", "matched"), F.struct("matched", "doc_start", "item_start"))
    found = verified(candidates, similarity, min_overlap).groupBy("key", "item_id").agg(best.alias("best"))
    return runs.select("doc_id", "key").distinct().join(found, "key").select("doc_id", "key", "item_id", "best.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_overlap: int = 12) -> DataFrame:
    """One row per document and benchmark item that it holds: where, how many words are equal, and which share."""
    found = leaks(docs, benchmark, similarity, min_overlap)
    length = F.col("doc_end") - F.col("doc_start")
    return found.drop("key").withColumn("similarity", F.col("matched") / length)


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, min_overlap: int = 12) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item."""
    bad = stored(leaks(docs, benchmark, similarity, min_overlap).select(F.col("key").alias("bad_key")).distinct(), "seed-bad")
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("doc"), F.md5("text").alias("own_key"))
    return rows.join(bad, F.col("own_key") == F.col("bad_key"), "left_anti").select("doc.*")
