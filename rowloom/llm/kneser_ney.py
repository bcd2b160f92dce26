"""Perplexity by an interpolated n-gram model with modified Kneser-Ney smoothing.

**Counting.** Tasks cut texts into words, hash these to 64 bits, count the n-grams of about ``HELD`` words and send them on in
compressed pieces, one for each part. A part takes all n-grams of its contexts (the words before the last), so it knows the
counts of every n-gram and how many n-grams of each context have the count 1, 2, or 3 and more. It hands the ends of its
n-grams (without the first word) on to the parts of the next lower order, where they are counted by kinds of first words;
those after the start of a text, by occurrences. Contexts of nothing but very frequent words are spread over all parts and
their sums put together afterwards, so no part takes more than a bounded share.

**Model.** Each part of each order writes one file: the ascending hashes, and their counts beside them. One byte holds a count;
greater ones stand in a list of their own. Workers map the files into memory, look up the sorted n-grams of some hundred
thousand words at a time, and interpolate all orders down to the uniform distribution over the known words and one unknown.
Files are written to the shared folder under a name of their own and then renamed, so a task that is run again does no harm.

Two words with equal hashes would be taken for one: with 10**9 known words the chance that any two are is 3 %.

Defined results: null and empty texts are the end alone. Rows without ``doc_id`` are scored and not learned from. With nothing
to learn from, every token has the probability 1. Repeated rows are counted and scored as often as they stand. Texts are
never cut; memory grows with the longest one. No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import map_batches, stored, texts
from rowloom.session import scratch_dir

ORDER = 2
PART_BYTES = 16 << 20  # of text for each part; the words of that many bytes fit into a task many times over
HELD = 1 << 21
SCORED = 1 << 18
START, END = (np.uint64(xxhash.xxh64_intdigest(mark)) for mark in (b" start", b" end"))  # no word holds a space
SPREAD, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
HIDE, SHARE = 5, 1  # one document in HIDE is held out: those with that remainder
ROWS = ("kind string, part int, key long, total long, ones long, twos long, threes long, fours long, grams long, blob binary")
NAMES = [c.split()[0] for c in ROWS.split(", ")]


def tokens(text: str) -> np.ndarray:
    """The hashes of the words of a text, in lower case, and of its end."""
    words = text.encode().lower().split()
    return np.array([*map(xxhash.xxh64_intdigest, words), int(END)], np.uint64)


def folded(grams: np.ndarray) -> np.ndarray:
    """One hash for each row of word hashes."""
    out = grams[:, 0]
    for i in range(1, grams.shape[1]):
        mixed = out * SPREAD + grams[:, i]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * TURN
        out = mixed ^ (mixed >> np.uint64(29))
    return out


def bucket(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of a hash; it rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(values.shape, bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def places(grams: np.ndarray, hashes: np.ndarray, parts: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of every n-gram, and whether it is of a spread context."""
    if grams.shape[1] == 1:
        return bucket(hashes, parts), np.zeros(len(grams), bool)
    spread = among(grams[:, :-1], frequent).all(axis=1)
    return bucket(np.where(spread, hashes, folded(grams[:, :-1])), parts), spread


def summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams by ascending hash, their hashes and the sums of their counts."""
    hashes = folded(grams)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else order
    sums = np.add.reduceat(counts[order], first) if len(first) else counts
    return grams[order[first]], ranked[first], sums


def planes(values: np.ndarray) -> bytes:
    """Non-negative integers as their number of bytes and then all lowest bytes, all second ones and so on."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(data: memoryview, n: int) -> tuple[np.ndarray, memoryview]:
    width = data[0]
    rows = np.zeros((n, 8), np.uint8)
    rows[:, :width] = np.frombuffer(data[1 : 1 + width * n], np.uint8).reshape(width, n).T
    return rows.reshape(-1).view("<u8"), data[1 + width * n :]


def packed(grams: np.ndarray, counts: np.ndarray) -> bytes:
    """N-grams and counts as a piece: the distinct words once, then their numbers column by column."""
    words, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    order = np.lexsort(at.T[::-1])
    head = np.array([*grams.shape, len(words)], "<u8").tobytes() + words.astype("<u8").tobytes()
    body = [planes(at[order, i]) for i in range(grams.shape[1])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, *body, planes(counts[order])]))


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    n, k, m = np.frombuffer(data[:24], "<u8").tolist()
    words, data = np.frombuffer(data[24 : 24 + 8 * m], "<u8"), data[24 + 8 * m :]
    columns = []
    for _ in range(k):
        at, data = from_planes(data, n)
        columns.append(words[at.astype(np.int64)])
    return np.stack(columns, axis=1), from_planes(data, n)[0].astype(np.int64)


def local_folder(uri: str) -> str:
    """The path of a shared folder that workers can map files of."""
    parsed = urlparse(uri)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"models are mapped into memory: spark.checkpoint.dir must be mounted on all workers, not {uri}")
    return unquote(parsed.path) if parsed.scheme else uri


def write_table(path: str, keys: np.ndarray, values: np.ndarray) -> None:
    """Ascending keys and rows of counts: sizes, keys, one byte a count, and the rows with greater counts."""
    large = np.flatnonzero((values > 254).any(axis=1))
    small = values.astype(np.uint8)
    small[large] = 255
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(np.array([len(keys), len(large), values.shape[1]], "<u8").tobytes())
        for array, kind in ((keys, "<u8"), (large, "<u8"), (values[large], "<u8"), (small, "u1")):
            out.write(np.ascontiguousarray(array, kind).data)
    os.replace(own, path)


@functools.lru_cache(maxsize=8192)
def opened(path: str):
    """The mapped keys, small counts, and places and values of large counts of a file; None where there is none."""
    if not os.path.exists(path):
        return None
    raw = np.memmap(path, np.uint8, "r")
    n, large, columns = raw[:24].view("<u8").tolist()
    ends = np.cumsum([24, 8 * n, 8 * large, 8 * large * columns, n * columns])
    keys, at, values = (raw[a:b].view("<u8") for a, b in zip(ends[:3], ends[1:4], strict=True))
    return keys, raw[ends[3] : ends[4]].reshape(n, columns), at, values.reshape(large, columns)


def looked_up(folder: str, kind: str, part: np.ndarray, keys: np.ndarray, columns: int = 1) -> np.ndarray:
    """The counts of keys in the files of one kind, zeros for unknown ones."""
    out = np.zeros((len(keys), columns), np.int64)
    if not len(keys):
        return out
    order = np.lexsort((keys, part))
    keys, part = keys[order], part[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (part[1:] != part[:-1])])
    which, keys, part = np.cumsum(new) - 1, keys[new], part[new]
    found = np.zeros((len(keys), columns), np.int64)
    bounds = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    for a, b in zip(bounds, bounds[1:], strict=False):
        table = opened(f"{folder}/{kind}/{part[a]}")
        if table is None or not len(table[0]):
            continue
        known, small, at, large = table
        place = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
        hit = np.flatnonzero(known[place] == keys[a:b])
        place = place[hit]
        got = small[place].astype(np.int64)
        big = np.flatnonzero((got == 255).any(axis=1))
        got[big] = large[np.searchsorted(at, place[big])]
        found[a + hit] = got
    out[order] = found[which]
    return out


def lines(parts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each after ``order - 1`` starts, and the places of the tokens."""
    pad = np.full(order - 1, START)
    flat = np.concatenate([x for own in parts for x in (pad, own)])
    return flat, np.flatnonzero(flat != START)


def grams_at(flat: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    return np.stack([flat[at - i] for i in range(k - 1, -1, -1)], axis=1)


def pieces(docs: DataFrame, k: int, parts: int, frequent: np.ndarray) -> DataFrame:
    """The counted k-grams of ``docs`` (one column of text), in pieces for each part."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        flat, at = lines(held, k)
        grams, hashes, counts = summed(grams_at(flat, at, k), np.ones(len(at), np.int64))
        return sent(grams, hashes, counts, parts, frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, part in texts(batch.column(0)):
                for text in part:
                    held.append(tokens(text))
                    size += len(held[-1])
                    if size >= HELD:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return map_batches(docs, run, "part int, blob binary")


def sent(grams: np.ndarray, hashes: np.ndarray, counts: np.ndarray, parts: int, frequent: np.ndarray) -> pa.RecordBatch:
    """Distinct k-grams as one piece for each part they go to."""
    part, _ = places(grams, hashes, parts, frequent)
    order = np.argsort(part, kind="stable")
    part, grams, counts = part[order], grams[order], counts[order]
    bounds = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else [0]
    blobs = [packed(grams[a:b], counts[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    numbers = part[bounds[:-1]] if len(part) else part
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])


def of_counts(counts: np.ndarray) -> list[np.ndarray]:
    return [counts == 1, counts == 2, counts >= 3, counts == 4]


def merged(sent_pieces: DataFrame, name: str, k: int, parts: int, frequent: np.ndarray, folder: str, often: int) -> DataFrame:
    """Write the files of one order and return its rows.

    ``sum``: counts of counts of a part. ``spread``: the part of a spread context's sums. ``often``: a word counted that
    often or more. ``next``: a piece for the order below.
    """

    def row(kind: str, part: int, key: int = 0, numbers=(0,) * 6, blob: bytes | None = None) -> dict:
        return dict(zip(NAMES, (kind, part, key, *map(int, numbers), blob), strict=True))

    def written(part: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        grams, hashes, counts = summed(*(np.concatenate(c) for c in zip(*held, strict=True)))
        write_table(f"{folder}/{name}/{part}", hashes, counts[:, None])
        ones, twos, threes, fours = of_counts(counts)
        rows = [row("sum", part, 0, (counts.sum(), ones.sum(), twos.sum(), (counts == 3).sum(), fours.sum(), len(counts)))]
        if often:
            at = np.flatnonzero(counts >= often)
            rows += [row("often", part, key) for key in grams[at, 0].view(np.int64).tolist()]
        if k > 1:
            context = folded(grams[:, :-1])
            order = np.argsort(context, kind="stable")
            ranked = context[order]
            first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            sums = np.stack([np.add.reduceat(x[order].astype(np.int64), first) for x in (counts, ones, twos, threes)], axis=1)
            keys, spread = ranked[first], places(grams[order[first]], hashes[order[first]], parts, frequent)[1]
            write_table(f"{folder}/context{k - 1}/{part}", keys[~spread], sums[~spread])
            homes = bucket(keys[spread], parts).tolist()
            for home, key, numbers in zip(homes, keys[spread].view(np.int64).tolist(), sums[spread].tolist(), strict=True):
                rows.append(row("spread", home, key, (*numbers, 0, 0)))
            ends = grams[:, 1:]
            kinds = np.where(grams[:, 1] == START, counts, 1) if k > 2 else np.ones(len(counts), np.int64)
            lower = sent(*summed(ends, kinds), parts, frequent)
            rows += [row("next", p, blob=b) for p, b in zip(*(c.to_pylist() for c in lower.columns), strict=True)]
        for start in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist(rows[start : start + 64], schema=kinds_of_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size: dict[int, int] = {}
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(part, []).append(unpacked(blob))
                size[part] = size.get(part, 0) + len(held[part][-1][1])
                if size[part] > 2 * HELD and len(held[part]) > 1:
                    grams, _, counts = summed(*(np.concatenate(c) for c in zip(*held[part], strict=True)))
                    held[part], size[part] = [(grams, counts)], 0
        for part in list(held):
            yield from written(part, held.pop(part))

    long, text = pa.int64(), pa.string()
    kinds_of_rows = pa.schema([(n, {"kind": text, "part": pa.int32(), "blob": pa.binary()}.get(n, long)) for n in NAMES])
    gathered = sent_pieces.repartitionById(parts, F.col("part"))
    return stored(map_batches(gathered, run, ROWS), f"{name}-counts")


def write_spread(rows: DataFrame, k: int, parts: int, folder: str) -> None:
    """Put the sums of the spread contexts together and write them, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        part, keys = table["part"].to_numpy(), table["key"].to_numpy().view(np.uint64)
        values = np.stack([table[c].to_numpy() for c in ("total", "ones", "twos", "threes")], axis=1)
        for p in np.unique(part).tolist():
            at = np.flatnonzero(part == p)
            at = at[np.argsort(keys[at])]
            write_table(f"{folder}/spread{k - 1}/{p}", keys[at], values[at])
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(keys)], pa.int64())})

    columns = ("total", "ones", "twos", "threes")
    sums = rows.filter("kind = 'spread'").groupBy("part", "key").agg(*[F.sum(c).alias(c) for c in columns])
    stored(map_batches(sums.repartitionById(parts, F.col("part")), run, "n long"), "spread-counts")


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """What is taken from counts of 1, 2, and 3 or more; 0.5, 1 and 1.5 where the counts of counts give no such numbers."""
    if min(ones, twos, threes) > 0:
        y = ones / (ones + 2 * twos)
        found = tuple(n + 1 - (n + 2) * y * b / a for n, (a, b) in enumerate(((ones, twos), (twos, threes), (threes, fours))))
        if all(0 < d <= n + 1 for n, d in enumerate(found)):
            return found
    return 0.5, 1.0, 1.5


@dataclass(frozen=True)
class Level:
    """The counts of counts of one order."""

    total: int
    ones: int
    twos: int
    threes: int
    fours: int
    grams: int

    @property
    def taken(self) -> np.ndarray:
        return np.array([0.0, *discounts(self.ones, self.twos, self.threes, self.fours)])


@dataclass(frozen=True)
class Model:
    """Where the files are, and what holds for all of them."""

    folder: str
    order: int
    parts: int
    frequent: np.ndarray
    words: Level
    levels: tuple[Level, ...]  # of the orders from 1 up

    def log10(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The log10 probability of the tokens at some places."""
        p = np.full(len(at), 1 / (self.words.grams + 1))
        for k, level in enumerate(self.levels, 1):
            grams = grams_at(flat, at, k)
            hashes = folded(grams)
            part, spread = places(grams, hashes, self.parts, self.frequent)
            counts = looked_up(self.folder, f"order{k}", part, hashes)[:, 0]
            if k == 1:
                above = level.grams - level.ones - level.twos
                sums = np.broadcast_to(np.array([level.total, level.ones, level.twos, above]), (len(at), 4))
            else:
                context = folded(grams[:, :-1])
                home = bucket(context, self.parts)
                sums = np.zeros((len(at), 4), np.int64)
                for name, chosen in ((f"context{k - 1}", ~spread), (f"spread{k - 1}", spread)):
                    sums[chosen] = looked_up(self.folder, name, home[chosen], context[chosen], 4)
            seen = np.maximum(sums[:, 0], 1)
            own = (counts - level.taken[np.minimum(counts, 3)]) / seen
            rest = (sums[:, 1:] @ level.taken[1:]) / seen
            p = np.where(sums[:, 0] > 0, own + rest * p, p)
        return np.log10(p)

    def base(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often tokens were counted, and their log10 probability by that alone."""
        counts = looked_up(self.folder, "words", bucket(words, self.parts), words)[:, 0]
        return counts, np.log10((counts + 0.5) / (self.words.total + 0.5 * (self.words.grams + 1)))


def held_out(doc_id: Column) -> Column:
    """Whether a document is not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HIDE == SHARE, F.lit(True))


def train(docs: DataFrame, order: int = ORDER, part_bytes: int = PART_BYTES) -> Model:
    """Count the n-grams of the texts of ``docs`` that are not held out and write the model."""
    if order < 2:
        raise ValueError("the order must be 2 or more")
    spark = docs.sparkSession
    own = docs.filter(~held_out(F.col("doc_id"))).select(F.col("text").cast("string").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    folder, none = local_folder(scratch_dir(spark, "kneser-ney")), np.zeros(0, np.uint64)

    def level(rows: DataFrame) -> Level:
        names = ("total", "ones", "twos", "threes", "fours", "grams")
        sums = rows.filter("kind = 'sum'").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
        return Level(**sums.first().asDict())

    words = merged(pieces(own, 1, parts, none), "words", 1, parts, none, folder, max(1, part_bytes // 32))
    known = [r.key for r in words.filter("kind = 'often'").select("key").collect()]  # a few for each part at most
    frequent = np.sort(np.array([*known, int(START.view(np.int64))], np.int64).view(np.uint64))
    levels, sent_pieces = [], pieces(own, order, parts, frequent)
    for k in range(order, 0, -1):
        rows = merged(sent_pieces, f"order{k}", k, parts, frequent, folder, 0)
        levels.append(level(rows))
        if k > 1:
            write_spread(rows, k, parts, folder)
        sent_pieces = rows.filter("kind = 'next'").select("part", "blob")
    return Model(folder, order, parts, frequent, level(words), tuple(levels[::-1]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row."""

    def answer(ids: list, held: list[np.ndarray]) -> pa.RecordBatch:
        flat, at = lines(held, model.order)
        counts, base = model.base(flat[at])
        sizes = np.array([len(x) for x in held])
        first = np.cumsum(sizes) - sizes
        sums = [np.add.reduceat(x, first) for x in ((counts > 0).astype(np.int64), base, model.log10(flat, at))]
        arrays = [pa.array(ids, pa.int64()), pa.array(sizes.astype(np.int64)), *map(pa.array, sums)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = [], [], 0
        for batch in batches:
            for start, part in texts(batch.column(1)):
                for doc_id, text in zip(batch.column(0).slice(start, len(part)).to_pylist(), part, strict=True):
                    ids.append(doc_id)
                    held.append(tokens(text))
                    size += len(held[-1])
                    if size >= SCORED:
                        yield answer(ids, held)
                        ids, held, size = [], [], 0
        if ids:
            yield answer(ids, held)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = map_batches(picked, run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.words.total).cast("long").alias("train_tokens"), "base_score", "score", perplexity.alias("perplexity"),
    )
