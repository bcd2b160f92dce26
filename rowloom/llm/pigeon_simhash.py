"""SimHash near-duplicates found by pigeonring filtering.

A fingerprint has 64 bits; a bit is set if it is set in over half of the hashes of the text's word shingles (repeats
included). Two texts are linked if at most ``MAX_BITS`` (2) bits differ.

Cut the bits into a ring of four segments of 16. If two fingerprints differ in at most 2 bits, then from some segment on
every chain of 1, 2, 3 and 4 neighbouring segments keeps to its share of the difference: 0, 1, 1 and 2 bits. So that
segment is equal, and of the two after it at least one is equal too. Pairs are found by these two equal segments (32
bits, eight keys for each fingerprint), and only a pair whose chains keep to all budgets reaches the full check, which is
the last budget. Two fingerprints that are linked always meet under some key; nothing is capped.

Only distinct fingerprints are compared, so copies never make pairs. Classes come from contracting the graph of the links,
round by round; each round is written to the shared folder. No link or class reaches the driver.

``one_of_each`` joins classes further: texts whose five-word shingles are alike (0.8 and more) may differ in more bits than
any equal segments can tell, so they are found by min-hash bands; all texts of a band that are alike come into one class.

Defined results: null and empty texts have no words and the fingerprint zero, which links like any other; texts shorter
than a shingle hash their whole sequence. Rows without ``doc_id`` get the class of their fingerprint, or null if no row
with an id is in it; they link others like any row. Repeated rows are returned as often as they stand. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import map_batches, stored, texts

SHINGLE, SEED, MAX_BITS = 3, 42, 2
SEGMENTS, SEGMENT_BITS = 4, 16
SIMILARITY, COPY_SHINGLE, COPY_BITS = 0.8, 5, 14
BANDS, BAND_ROWS, SKETCH, SLOTS, BLOCK = 8, 3, 256, 64, 64
EDGES = 100_000  # that a task contracts at once


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """The SimHash of a text: ASCII letters in lower case, words cut at ASCII white space, shingles of words."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(words[i:] for i in range(width)), strict=False)
    hashes = np.array([digest(join(g), SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65_536):
        block = hashes[start : start + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, text_hash: bool = False) -> DataFrame:
    """doc_id and the 64 bits of its text as a long; with ``text_hash`` a hash of the text as own_text, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(t, width) for _, part in texts(batch.column(1)) for t in part]
            signed = np.array(bits, dtype=np.uint64).view(np.int64)
            columns = [batch.column(0), pa.array(signed), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "bits", "own_text"][: len(columns)])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         *[own_text().alias("own_text")] * text_hash)
    return map_batches(picked, run, "doc_id long, bits long" + ", own_text long" * text_hash)


def segment(bits: Column, i: int) -> Column:
    return F.shiftrightunsigned(bits, SEGMENT_BITS * (i % SEGMENTS)).bitwiseAND(F.lit(2**SEGMENT_BITS - 1))


def chain_keys(bits: Column) -> Column:
    """The keys of a fingerprint: a start segment, and which of the two segments after it is equal as well."""
    keys = []
    for start in range(SEGMENTS):
        for step in (1, 2):
            equal = F.shiftleft(segment(bits, start), SEGMENT_BITS).bitwiseOR(segment(bits, start + step))
            keys.append(F.struct(F.lit(2 * start + step - 1).alias("chain"), equal.alias("equal")))
    return F.array(*keys)


def differ(a: Column, b: Column, chain: Column, length: int) -> Column:
    """How many bits differ in the first ``length`` segments of the chain that starts at a key's segment."""
    turned = F.lit(0).cast("long")
    changed = a.bitwiseXOR(b)
    for start in range(SEGMENTS):
        mask = 0
        for i in range(start, start + length):
            mask |= (2**SEGMENT_BITS - 1) << (SEGMENT_BITS * (i % SEGMENTS))
        mask -= 2**64 if mask >= 2**63 else 0
        here = F.floor(chain / 2) == start
        turned = F.when(here, F.bit_count(changed.bitwiseAND(F.lit(mask)))).otherwise(turned)
    return turned


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a < b) of the distinct ``bits`` that differ in at most MAX_BITS bits, each once."""
    keyed = distinct.select("bits", F.explode(chain_keys(F.col("bits"))).alias("key"))
    keyed = keyed.select("bits", "key.chain", "key.equal")
    left, right = keyed.withColumnRenamed("bits", "a"), keyed.withColumnRenamed("bits", "b")
    a, b = F.col("a"), F.col("b")
    chain = left["chain"]
    within = differ(a, b, chain, 2) <= MAX_BITS * 2 // SEGMENTS
    within &= differ(a, b, chain, 3) <= MAX_BITS * 3 // SEGMENTS
    within &= F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS
    met = (left["chain"] == right["chain"]) & (left["equal"] == right["equal"]) & (a < b)
    return left.join(right, met & within).select("a", "b").distinct()


def owners(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``vertices`` (bits and other columns) with the owner of each: one vertex of its component of ``edges`` (a, b; stored).

    Each round contracts the graph: tasks of about ``EDGES`` edges join the ends of their own, a vertex goes over to the first
    of those that any task joined it with, and edges between what is left are the next round's. First is by a hash that each
    round draws anew, so a share of the vertices goes in every round, however the labels lie; what one task holds takes one.
    """
    owned, left, round_no = vertices.withColumn("owner", F.col("bits")), True, 0
    while left and (n := edges.count()):
        left = n >= EDGES  # else one task joins all of them
        joined = joined_within(edges.coalesce(-(-n // EDGES)), round_no)
        firsts = joined
        if left:
            joined = stored(joined, "simhash-joined")
            firsts = joined.groupBy("bits").agg(F.min(F.struct("rank", "root")).alias("first")).select("bits", "first.root")
        firsts = stored(firsts.select("bits", F.col("root").alias("next")), "simhash-firsts")
        moves = firsts.withColumnRenamed("bits", "owner")
        owned = owned.join(moves, "owner", "left").withColumn("owner", F.coalesce("next", "owner")).drop("next")
        if left:
            moved = joined.select("bits", "root").join(firsts.withColumnRenamed("next", "a"), "bits")
            moved = moved.join(firsts.withColumnRenamed("bits", "root"), "root", "left").select("a", F.coalesce("next", "root").alias("b"))
            ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
            edges = stored(moved.filter("a <> b").select(*ends).distinct(), "simhash-edges")
        round_no += 1
    return stored(owned.select(*vertices.columns, "owner"), "simhash-owners")


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``vertices`` (bits, label) with the smallest label of each component of ``edges`` (a, b; stored) as root."""
    owned = owners(vertices, edges)
    return owned.join(owned.groupBy("owner").agg(F.min("label").alias("root")), "owner").select("bits", "root")


def joined_within(edges: DataFrame, round_no: int) -> DataFrame:
    """For each vertex that the edges (a, b) of a task join with others: the first of them by a hash, as root with its rank."""

    def rows(above: dict[tuple[int, int], tuple[int, int]]) -> pa.RecordBatch:
        found = [(end[1], *top(above, end)) for end in list(above)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["bits", "rank", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above = {}
        for batch in batches:
            a, rank_a, b, rank_b = (c.to_pylist() for c in batch.columns)
            for one, other in zip(zip(rank_a, a, strict=True), zip(rank_b, b, strict=True), strict=True):
                low, high = sorted((top(above, one), top(above, other)))
                if low != high:
                    above[high] = low
            if len(above) >= EDGES:  # so a task holds no more, however much it reads
                yield rows(above)
                above = {}
        if above:
            yield rows(above)

    ranks = {side: F.xxhash64(side, F.lit(round_no)) for side in ("a", "b")}
    ranked = edges.select("a", ranks["a"].alias("rank_a"), "b", ranks["b"].alias("rank_b"))
    return map_batches(ranked, run, "bits long, rank long, root long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    marked = stored(fingerprints(docs, width), "simhash-bits")
    named = classed(marked)
    digits = F.lpad(F.lower(F.hex("bits")), 16, "0")
    return named.select("doc_id", digits.alias("fingerprint"), "component_id")


def classed(marked: DataFrame) -> DataFrame:
    """``marked`` (stored, with doc_id and bits) with the component_id of its class."""
    least = stored(marked.groupBy("bits").agg(F.min("doc_id").alias("label")), "simhash-distinct")
    named = components(least, stored(links(least.select("bits")), "simhash-links"))
    return marked.join(named.withColumnRenamed("root", "component_id"), "bits")


def one_of_each(docs: DataFrame, similarity: float | None = SIMILARITY) -> DataFrame:
    """One row of ``docs`` of each class: the smallest doc_id, of rows with that id the least text; rows without an id stay.

    Classes are those of ``near_duplicates``, joined where texts are ``similarity`` alike or more (``near_copies``).
    """
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("doc"), F.col("doc_id").cast("long").alias("own_id"),
                       own_text().alias("own_text"))
    marked = stored(fingerprints(docs, text_hash=True), "simhash-bits")
    distinct = stored(marked.select("bits").distinct(), "simhash-distinct")
    edges = links(distinct)
    if similarity is not None:
        edges = edges.unionByName(near_copies(docs, marked, similarity)).distinct()
    owned = marked.join(owners(distinct, stored(edges, "simhash-links")), "bits")
    first = F.min(F.struct("doc_id", "own_text")).alias("first")
    kept = owned.filter("doc_id IS NOT NULL").groupBy("owner").agg(first).select("first.*")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("own_text").alias("kept_text"))
    chosen = rows.join(kept, (F.col("own_id") == F.col("kept_id")) & (F.col("own_text") == F.col("kept_text")), "left_semi")
    chosen = chosen.dropDuplicates(["own_id", "own_text"])
    return chosen.unionByName(rows.filter("own_id IS NULL")).select("doc.*")


def own_text() -> Column:
    """A hash that tells texts apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def sketches(docs: DataFrame) -> DataFrame:
    """own_text of every distinct text, the fingerprint of its set of words, its least shingle hashes and its band keys.

    Shingles have ``COPY_SHINGLE`` words. Of each permutation of their hashes the least one is taken, and ``BAND_ROWS`` of
    them make a key.
    """
    odd = np.random.default_rng(SEED).integers(1, 2**62, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in texts(batch.column(1)):
                bits, least, keys = [], [], []
                for text in part:
                    words = text.encode().lower().split()
                    bits.append(fingerprint(b" ".join(set(words)).decode("utf-8", "replace"), 1))
                    grams = zip(*(words[i:] for i in range(COPY_SHINGLE)), strict=False)
                    hashes = np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams], np.uint64))
                    if not len(hashes):
                        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
                    least.append(hashes[:SKETCH].astype("<u8").tobytes())
                    lowest = [int(((hashes * m) ^ (hashes * m) >> np.uint64(29)).min()) for m in odd]
                    bands = [lowest[i : i + BAND_ROWS] for i in range(0, len(lowest), BAND_ROWS)]
                    keys.append([xxhash.xxh64_intdigest(repr((n, b))) - 2**63 for n, b in enumerate(bands)])
                signed = pa.array(np.array(bits, np.uint64).view(np.int64))
                arrays = [batch.column(0).slice(start, len(part)), signed, pa.array(least, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["own_text", "words", "least", "keys"])

    distinct = docs.select(own_text().alias("own_text"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_batches(distinct, run, "own_text long, words long, least binary, keys array<long>")


def chains(a: Column, b: Column, most: int, segments: int = 8) -> Column:
    """Whether from some segment on all chains of neighbouring segments keep to their share of ``most`` differing bits."""
    width = 64 // segments
    changed, some = a.bitwiseXOR(b), F.lit(False)
    part = [F.bit_count(F.shiftrightunsigned(changed, width * i).bitwiseAND(F.lit(2**width - 1))) for i in range(segments)]
    for first in range(segments):
        total, within = F.lit(0), F.lit(True)
        for length in range(1, segments + 1):
            total = total + part[(first + length - 1) % segments]
            within &= total * segments <= most * length
        some |= within
    return some


def near_copies(docs: DataFrame, marked: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of the fingerprints of texts whose sets of five-word shingles are alike.

    Texts meet under equal band keys, and all of a key that are alike come into one class; links that classes already imply
    are left out. First each text meets the least one of its key and its neighbour by words and number, so a group of n copies
    makes at most 2 n pairs, pruned by pigeonring chains over the fingerprints of their words with a budget of ``COPY_BITS``
    bits. What these leave in several classes is compared whole (``links_across``). Texts are compared by their ``SKETCH``
    least shingle hashes, which is the exact similarity of texts with no more shingles than that.
    """
    own = stored(sketches(docs).dropDuplicates(["own_text"]), "simhash-sketches")
    met = own.select(F.explode("keys").alias("key"), F.struct("words", "own_text").alias("one"))
    first = met.groupBy("key").agg(F.min("one").alias("other"), F.count("*").alias("n")).filter("n > 1").drop("n")
    shared = stored(met.join(first, "key").select("key", "one", "other"), "simhash-shared")
    leading = shared.filter("one > other").select("one", "other")
    ranked = Window.partitionBy("key", "slot").orderBy("one")
    slot = F.pmod(F.xxhash64("one.own_text"), F.lit(SLOTS)).alias("slot")  # a large group is many small windows
    beside = shared.select("key", "one", slot).select("one", F.lag("one").over(ranked).alias("other")).filter("other IS NOT NULL")
    pairs = leading.unionByName(beside).distinct()
    pairs = pairs.filter(chains(F.col("one.words"), F.col("other.words"), COPY_BITS))
    pairs = pairs.filter(F.bit_count(F.col("one.words").bitwiseXOR(F.col("other.words"))) <= COPY_BITS)
    pairs = stored(pairs.select(F.col("one.own_text").alias("x"), F.col("other.own_text").alias("y")), "simhash-pairs")
    shared = shared.select("key", F.col("one.own_text").alias("own_text"))
    least = own.select("own_text", "least").join(shared.select("own_text").distinct(), "own_text", "left_semi")
    least = least.join(marked.groupBy("own_text").agg(F.min("bits").alias("bits")), "own_text")
    least = stored(least.select("own_text", "least", "bits"), "simhash-least")  # the only ones that are compared
    held, other = least.toDF("x", "x_least", "a"), least.toDF("y", "y_least", "b")
    both = pairs.join(held, "x").join(other, "y").select("x", "y", "a", "b", "x_least", "y_least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = [jaccard(a, b) >= similarity for a, b in zip(*(c.to_pylist() for c in batch.columns[4:]), strict=True)]
            yield batch.select([0, 1, 2, 3]).filter(pa.array(alike, pa.bool_()))

    linked = stored(map_batches(both, run, "x long, y long, a long, b long"), "simhash-near")
    linked = linked.select("a", "b").unionByName(links_across(shared, least, linked.select("x", "y"), similarity))
    return linked.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def links_across(shared: DataFrame, least: DataFrame, linked: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of the fingerprints of all texts alike that share a key (``shared``: key, own_text) but no class of ``linked``.

    ``least`` has own_text, least and bits of the texts that share a key, ``linked`` (x, y) the links found so far.

    The texts of a key that is left with several classes are cut into blocks of about ``BLOCK``, those of a large class by
    themselves. Each two blocks of a key meet in a row, but for two of one class, and are compared as matrices, so a group of
    n texts makes (n / BLOCK)^2 / 2 rows at most and one of few classes as many as its blocks. A row gives fewer links than it
    has classes, as the others follow from them.
    """
    rooted = owners(least.select(F.col("own_text").alias("bits")), linked.toDF("a", "b")).toDF("own_text", "root")
    held = shared.join(rooted, "own_text")
    sizes = stored(held.groupBy("key", "root").agg(F.count("*").alias("n")), "simhash-class-sizes")
    large = F.col("n") >= BLOCK
    mixed = sizes.groupBy("key").agg(F.count("*").alias("classes"), F.sum(F.when(~large, F.col("n"))).alias("few")).filter("classes > 1")
    parts = F.when(large, F.ceil(F.col("n") / BLOCK)).otherwise(F.ceil(F.col("few") / BLOCK))
    named = sizes.join(mixed, "key").select("key", "root", F.when(large, F.col("root")).alias("whole"), parts.alias("parts"))
    held = held.join(named, ["key", "root"]).join(least, "own_text")
    part = F.pmod(F.xxhash64(F.when(F.col("whole").isNull(), F.col("root")).otherwise(F.col("own_text"))), F.col("parts")).alias("part")
    held = held.select("key", "whole", part, F.struct("bits", "root", "least").alias("one"))
    blocks = stored(held.groupBy("key", "whole", "part").agg(F.collect_list("one").alias("some")), "simhash-blocks")
    left, right = blocks.select("key", "whole", "part", "some"), blocks.toDF("key", "whole_b", "part_b", "some_b")
    place, place_b = F.struct("whole", "part"), F.struct("whole_b", "part_b")
    apart = (place < place_b) & ~F.coalesce(F.col("whole") == F.col("whole_b"), F.lit(False))
    within = (place == place_b) & F.col("whole").isNull()
    met = left.join(right, "key").filter(apart | within).select("some", "some_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                some, other = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                alike = similarities([m["least"] for m in some], [m["least"] for m in other]) >= similarity
                above, found = {}, []  # a link of classes that others of this row have joined already says nothing new
                for a, b in zip(*np.nonzero(alike), strict=True):
                    ends = some[a]["root"], other[b]["root"]
                    low, high = sorted(top(above, end) for end in ends)
                    if low != high:
                        above[high] = low
                        found.append((some[a]["bits"], other[b]["bits"], *sorted(ends)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b", "low", "high"])

    found = map_batches(met, run, "a long, b long, low long, high long").groupBy("low", "high")  # one for two classes
    return stored(found.agg(F.min(F.struct("a", "b")).alias("one")).select("one.a", "one.b"), "simhash-across")


def top(above: dict, end):
    """The last of the chain above a class; the chain is halved on the way."""
    while end in above:
        up = above[end]
        above[end] = end = above.get(up, up)
    return end


def similarities(some: list[bytes], other: list[bytes]) -> np.ndarray:
    """``jaccard`` of each of ``some`` with each of ``other``."""
    sets = [np.frombuffer(v, "<u8") for v in (*some, *other)]
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    sizes, n = np.array([len(v) for v in sets]), len(some)
    has = np.zeros((len(sets), len(values)), np.float32)
    has[np.repeat(np.arange(len(sets)), sizes), at] = 1
    both = has[:n] @ has[n:].T
    ends = np.array([np.searchsorted(values, v[-1]) if len(v) >= SKETCH else len(values) - 1 for v in sets])
    end, known = np.minimum(ends[:n, None], ends[None, n:]), has.cumsum(axis=1, dtype=np.float32)
    union = known[np.arange(n)[:, None], end] + known[np.arange(n, len(sets))[None, :], end] - both
    return both.astype(np.float64) / union


def jaccard(a: bytes, b: bytes) -> float:
    """The similarity of two sets by the least hashes of each: exact where neither has more than ``SKETCH``."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    union = np.union1d(x, y)
    if len(x) >= SKETCH or len(y) >= SKETCH:  # below the lesser of both ends all of both sets is known
        ends = [s[-1] for s in (x, y) if len(s) >= SKETCH]
        union = union[union <= min(ends)]
    return len(np.intersect1d(np.intersect1d(x, y), union)) / len(union)
