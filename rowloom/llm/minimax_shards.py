"""Shards of whole documents, equal texts together, with the smallest possible largest shard.

Groups of equal texts stand in the order of their smallest ``doc_id``. A shard is a run of neighbouring groups. The
smallest capacity that ``shards`` runs can keep to is found by binary search; a capacity is checked greedily, by filling
one shard after the other. The greedy check needs only one question answered: which is the last group that ends at or
before byte x? The ends of the groups stay in Spark. The driver holds a summary of bounded size: first end, last end and
count of at most ``SUMMARY`` byte ranges. Where the summary leaves a capacity open, the ranges that the greedy check can
touch are summarised again with finer ranges, until the answer is exact.

Defined results: a null text counts as empty, so as size 1. Rows without ``doc_id`` come last. Repeated rows are rows of
their own and share a group. No rows give no rows. Extra columns are ignored. A group that is larger than the even share
makes its shard larger, because groups are never cut.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import cut_points, shuffle_parts, stored, whole_text, with_bucket

SUMMARY = 16_384  # byte ranges that the driver holds for each refinement; 24 bytes each


@dataclass
class Range:
    """What is known of the group ends in one range: the first, the last and how many there are."""

    first: int
    last: int
    count: int


class Ends:
    """Bounds for "the last group end at or before x", from ranges that together cover every group end."""

    def __init__(self, ranges: list[Range]):
        self.ranges = sorted(ranges, key=lambda r: r.first)
        self.firsts = [r.first for r in self.ranges]
        self.lasts = [r.last for r in self.ranges]

    def at_most(self, x: int) -> tuple[int, int]:
        """A lower and an upper bound of the last end at or before x (0 if there is none)."""
        i = bisect_right(self.firsts, x) - 1
        if i < 0:
            return 0, 0
        r = self.ranges[i]
        if x >= r.last:
            return r.last, r.last
        return (r.first, r.first) if r.count <= 2 else (r.first, x)

    def open_between(self, low: int, high: int) -> list[Range]:
        """Ranges with ends that are not known one by one, and that hold some x from low to high."""
        found = self.ranges[bisect_left(self.lasts, low) : bisect_right(self.firsts, high)]
        return [r for r in found if r.count > 2]


def fill(ends: Ends, capacity: int, shards: int, side: int) -> list[int]:
    """Where each shard ends if it is filled up to ``capacity``; side 0 is the lower, 1 the upper bound."""
    at, cuts = 0, []
    for _ in range(shards):
        at = ends.at_most(at + capacity)[side]
        cuts.append(at)
    return cuts


def smallest(low: int, high: int, holds) -> int:
    """The smallest number from low to high for which ``holds``; high if there is none below it."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle + 1, high)
    return low


def summary(groups: DataFrame, spans: list[tuple[int, int]]) -> list[Range]:
    """First end, last end and count for ranges of one width inside the spans: at most SUMMARY and one per span."""
    width = max(1, -(-sum(high - low + 1 for low, high in spans) // SUMMARY))
    inside = F.lit(False)
    span = F.lit(None).cast("int")
    for number, (low, high) in enumerate(spans):
        here = F.col("end").between(low, high)
        inside, span = inside | here, F.when(here, number).otherwise(span)
    rows = (
        groups.filter(inside)
        .groupBy(span.alias("span"), F.floor(F.col("end") / F.lit(width)).alias("place"))
        .agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("n"))
    )
    return [Range(r["first"], r["last"], r["n"]) for r in rows.collect()]


def cut_at(groups: DataFrame, total: int, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the byte at which each shard ends under it."""
    ends = Ends(summary(groups, [(1, total)]))
    while True:
        even = -(-total // shards)
        sure = smallest(even, total, lambda c: fill(ends, c, shards, 0)[-1] >= total)
        may = smallest(even, sure, lambda c: fill(ends, c, shards, 1)[-1] >= total)
        lows, highs = fill(ends, may, shards, 0), fill(ends, sure, shards, 1)
        if may == sure and lows == highs:
            return sure, highs
        touched = {}
        for low, high in zip([0, *lows], [0, *highs], strict=False):
            touched.update({r.first: r for r in ends.open_between(low + may, high + sure)})
        fine = summary(groups, merged(touched.values()))
        ends = Ends([r for r in ends.ranges if r.first not in touched] + fine)


def merged(ranges) -> list[tuple[int, int]]:
    """Neighbouring ranges as one span, so the filter of a refinement stays short."""
    spans: list[tuple[int, int]] = []
    for r in sorted(ranges, key=lambda r: r.first):
        if spans and r.first - spans[-1][1] <= 1:
            spans[-1] = (spans[-1][0], r.last)
        else:
            spans.append((r.first, r.last))
    return spans


def running_total(df: DataFrame, bucket: str, order: list[str], amount: str, within: list[str], name: str) -> DataFrame:
    """The sum of ``amount`` up to each row: inside its bucket by a window, plus the sums of the buckets before.

    Only one row per ``within`` and bucket is ever gathered, and there are at most as many buckets as cuts.
    """
    keys = [*within, bucket]
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys).agg(F.sum(amount).alias("bucket_sum"))
    if not within:  # a window over a constant would move all rows to one task; this is one row per bucket
        before = Window.partitionBy(F.lit(0)).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("bucket_sum").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn(name, F.sum(amount).over(inside)).join(F.broadcast(offsets), keys)  # buckets x shards rows
    return out.withColumn(name, F.col(name) + F.col("offset")).drop("offset")


def minimax_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row, by the smallest feasible capacity."""
    spark = docs.sparkSession
    text = whole_text()
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "shard-rows",
    )
    parts = shuffle_parts(spark)
    cuts = cut_points(rows, "doc_id", parts)
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"))
    groups = with_bucket(groups, "first_id", cuts, "bucket")
    groups = stored(groups.repartition(parts, "bucket"), "shard-groups")
    groups = stored(
        running_total(groups, "bucket", ["first_id", "digest"], "bytes", [], "end").select("digest", "end"),
        "shard-ends",
    )
    total = groups.agg(F.max("end")).first()[0] or 0
    ends = cut_at(groups, total, shards)[1] if total else [0] * shards
    shard = sum((F.when(F.col("end") > e, 1).otherwise(0) for e in ends[:-1]), F.lit(0)).cast("int")
    placed = rows.join(groups.select("digest", shard.alias("shard")), "digest").drop("digest")
    placed = stored(with_bucket(placed, "doc_id", cuts, "bucket").withColumn("one", F.lit(1).cast("long")), "shard-docs")
    numbered = running_total(placed, "bucket", ["doc_id", "text_crc32", "size"], "one", ["shard"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1).alias("slot"))
