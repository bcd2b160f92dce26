"""SpotSigs fingerprints and their likeness.

A spot is an anchor, one of a fixed list of common words, together with the chain of the next ``chain`` content words after
it, ``distance`` content words apart. Boilerplate is poor in such words, prose is full of them. The set of a text's spots,
each hashed to 32 bits, is its fingerprint, and the likeness of two texts is the Jaccard similarity of their sets. The
beginning of a text is an anchor too, with chains of one word as well, and in a stretch without anchors every ``DRY``-th
word stands in for one, so that lists and very short texts have spots.

``near_pairs`` joins a corpus with itself. Sets are put into partitions by length whose bounds grow by the threshold, so that
like sets are in one or in neighbouring partitions; inside, sets meet by the rarest of their spots, as many as the threshold
asks for; a pair is skipped where the lengths alone rule the threshold out, and the rest is compared spot by spot. Texts
with equal fingerprints are one class and are compared once.

Defined results: null and empty texts, and texts without a spot, have one spot made of their characters, so that equal ones
are alike and others are not. Rows without ``doc_id`` come last. Repeated ids follow each other, ordered by a hash of their
text. A single document is its own next one. No rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import cut_points, map_batches, shuffle_parts, stored, texts, whole_text, with_bucket

# Common words of English, French, German and Spanish.
ANCHORS = frozenset(
    """a an and are as at be by for from in is it of on or that the this to was with
    au avec ce dans de des du elle en est et il la le les ne par pas plus pour que qui se sur un une
    als auch auf das dass dem den der des die ein eine er es für ich im ist mit nicht sich sie so und von zu
    al como con del el es las lo los más no o para por se su sus una y""".split()
)
CHAIN, DISTANCE = 2, 1
DRY = 8
CACHE = 400_000  # words whose hashes a task remembers before it starts anew
WORD = re.compile(r"\w+")


class WordMarks(dict):
    """The hash of a word, with the lowest bit set for anchors, remembered."""

    def __init__(self, anchors: frozenset[str]):
        super().__init__()
        self.anchors = anchors

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        data = word.encode("utf-8")
        code = zlib.crc32(data) | (zlib.crc32(data, 0x5BD1E995) << 32)
        value = self[word] = (code & ~1) | (word in self.anchors)
        return value


def spots(text: str, known: WordMarks, chain: int = CHAIN, distance: int = DISTANCE) -> np.ndarray:
    """The sorted distinct spots of a text as unsigned 32-bit numbers."""
    words = WORD.findall(text.lower())
    marks = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    is_anchor = (marks & np.uint64(1)).astype(bool)
    content = np.flatnonzero(~is_anchor)
    places = np.arange(len(words))
    since = places - np.maximum.accumulate(np.where(is_anchor, places, -1))
    anchors = np.flatnonzero(is_anchor | ((since > 0) & (since % DRY == 0)))
    after = np.searchsorted(content, anchors, side="right") + distance - 1
    anchors, after = np.append(anchors, len(words)), np.append(after, distance - 1)  # the beginning of the text
    marks = np.append(marks, np.uint64(0))
    fits = after + distance * (chain - 1) < len(content)
    anchors, after = anchors[fits], after[fits]
    total = marks[anchors]
    for i in range(chain):
        total = chained(total, marks[content[after + distance * i]])
    if len(content):  # the beginning and one word, for texts of a few words
        total = np.append(total, chained(np.zeros(1, np.uint64), marks[content[:1]]))
    if not len(total):
        return np.array([zlib.crc32(text.encode("utf-8"))], np.uint32)
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique((total >> np.uint64(32)).astype(np.uint32))


def chained(total: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes of chains that go on with a word."""
    return (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """The Jaccard similarity of two sorted sets; 0 without comparing them where their lengths rule ``least`` out."""
    short, long = sorted((len(a), len(b)))
    if not long or short < least * long:
        return 0.0
    both = np.intersect1d(a, b, assume_unique=True).size
    return both / (short + long - both)


def digits(found: np.ndarray) -> str:
    """A fingerprint as text: eight hexadecimal digits for each spot, in rising order."""
    return found.astype(">u4").tobytes().hex()


def followed(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (place, tail, doc_id, text) of partitions in which every row stands before the one with the next smaller id.

    ``place`` is a range of ids. The first row of a place is also sent, as its tail, to the place before it (the very first
    to the last place), so no place needs another.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    own = with_bucket(own.withColumn("tie", F.xxhash64("text")), "doc_id", cut_points(own, "doc_id", parts), "bucket")
    own = own.withColumn("place", F.when(F.col("doc_id").isNull(), parts + 1).otherwise(parts - F.col("bucket")))
    first = F.min_by(F.struct("doc_id", "tie"), F.struct(-F.coalesce("doc_id", F.lit(0)), F.col("tie")))
    heads = own.groupBy("place").agg(first.alias("head")).orderBy("place").collect()  # one row for each place
    rows = [(h["head"]["doc_id"], h["head"]["tie"], heads[i - 1]["place"]) for i, h in enumerate(heads)]
    session = docs.sparkSession
    sent = F.broadcast(session.createDataFrame(rows, "head_id long, head_tie long, before int"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    here = F.struct(F.col("place").cast("int").alias("place"), F.lit(0).alias("tail"))
    there = F.struct(F.col("before").alias("place"), F.lit(1).alias("tail"))
    spread = F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, there))
    out = own.join(sent, is_head, "left").select(F.explode(spread).alias("at"), "doc_id", "tie", "text")
    out = out.select("at.place", "at.tail", "doc_id", "tie", "text").repartitionById(parts, F.col("place"))
    out = out.sortWithinPartitions("place", "tail", F.col("doc_id").desc_nulls_last(), "tie")
    return out.select("place", "tail", "doc_id", "text")


def fingerprints(docs: DataFrame, anchors: frozenset[str] = ANCHORS) -> DataFrame:
    """For every row: its fingerprint, that of its edited text, and their and the next row's likeness to it.

    The next row is the one with the next smaller doc_id, after the smallest the largest. The edited text is the text with
    the last half of its characters (rounded down) replaced by the first as many of the next text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordMarks(anchors)
        held = None  # place, doc_id, text and spots of the row that waits for its next one
        for batch in batches:
            places, tails, ids = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for first, part in texts(batch.column(3)):
                for number, text in enumerate(part, first):
                    if tails[number] and (held is None or held[0] != places[number]):
                        continue
                    own = spots(text, known)
                    if held is not None and held[0] == places[number]:
                        out.append(compared(*held[1:], text, own, known))
                    held = None if tails[number] else (places[number], ids[number], text, own)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=FOUND)

    rows = followed(docs, shuffle_parts(docs.sparkSession))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
    return map_batches(rows, run, f"{schema}, near_edited double, near_next double")


def compared(doc_id, text: str, own: np.ndarray, after: str, after_spots: np.ndarray, known: WordMarks) -> dict:
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    found = spots(edited, known)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode("utf-8")).hexdigest(),
        "fingerprint": digits(own),
        "edited_fingerprint": digits(found),
        "near_edited": jaccard(own, found),
        "near_next": jaccard(own, after_spots),
    }


FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [(n, pa.float64()) for n in ("near_edited", "near_next")]
)


def spot_sets(docs: DataFrame, anchors: frozenset[str] = ANCHORS) -> DataFrame:
    """doc_id and the sorted spots of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordMarks(anchors)
        for batch in batches:
            found = [spots(t, known).astype(np.int64) for _, part in texts(batch.column(1)) for t in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "spots"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(own, run, "doc_id long, spots array<long>")


def length_partition(length: Column, threshold: float) -> Column:
    """The number of the partition of a length; the bounds grow by the threshold, so like sets are at most one apart."""
    return F.floor(F.log(length.cast("double")) / F.lit(-np.log(threshold)) + F.lit(1e-9)).cast("int")


def near_pairs(docs: DataFrame, threshold: float = 0.8, anchors: frozenset[str] = ANCHORS) -> tuple[DataFrame, DataFrame]:
    """Classes (doc_id, class_id) of equal fingerprints, and pairs (a < b) of classes with their likeness.

    A class is named by its smallest doc_id; rows without an id are in the class of their fingerprint, if it has a name.
    """
    sets = stored(spot_sets(docs, anchors).withColumn("code", F.xxhash64("spots")), "spot-sets")
    classes = sets.groupBy("code", "spots").agg(F.min("doc_id").alias("class_id")).filter("class_id IS NOT NULL")
    classes = stored(classes, "spot-classes")
    members = sets.join(classes.select("code", "spots", "class_id"), ["code", "spots"], "left").select("doc_id", "class_id")
    spread = classes.select("class_id", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    common = spread.groupBy("spot").agg(F.count("*").alias("classes"))
    rarest = Window.partitionBy("class_id").orderBy("classes", "spot")  # the spots of one text
    needed = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    ranked = spread.join(common, "spot").withColumn("rank", F.row_number().over(rarest))
    probes = ranked.filter(F.col("rank") <= needed).select("class_id", "n", "spot")
    probes = stored(probes.withColumn("part", length_partition(F.col("n"), threshold)), "spot-probes")
    a = probes.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), "spot", "part")
    b = probes.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), "spot", F.explode(F.array("part", F.col("part") - 1)).alias("part"))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    fits = F.col("n_a") >= F.lit(threshold) * F.col("n_b") - 1e-9
    met = (a["spot"] == b["spot"]) & (a["part"] == b["part"]) & ordered & fits
    pairs = a.join(b, met).select("a", "b").distinct()
    own = classes.select("class_id", "spots")
    pairs = pairs.join(own.select(F.col("class_id").alias("a"), F.col("spots").alias("spots_a")), "a")
    pairs = pairs.join(own.select(F.col("class_id").alias("b"), F.col("spots").alias("spots_b")), "b")
    both = F.size(F.array_intersect("spots_a", "spots_b"))
    like = both / (F.size("spots_a") + F.size("spots_b") - both)
    pairs = pairs.select("a", "b", like.alias("likeness")).filter(F.col("likeness") >= threshold)
    return members, pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")
