"""Token ids in files of shuffled planes.

Documents are encoded in ascending ``doc_id`` order and their ids, each document closed by an end id, form one long
sequence, cut into segments (ranges of ``doc_id``) and these into blocks of a fixed number of ids. A block is transposed:
all lowest bytes of its ids, then all second bytes and so on (``plane="byte"``), or all lowest bits, all second bits and
so on (``plane="bit"``). Neighbouring values of one plane are alike, and high planes are often all zeros. Each plane is
compressed by itself with zstandard; a plane of zeros is kept as nothing.

Format, under one folder: ``blocks`` holds one Parquet row per block and is the data together with its chunk index:
segment, block, first (place of its first id in the segment), n_ids, width (bytes per id), kind, the compressed planes,
the CRC of its ids, and where the documents stand in it: doc_ids, doc_firsts (place of the document's first id in the
segment), doc_totals (its length) and doc_from (place of its part in the block). A block can be read by itself.

Reading decodes block by block. A document inside one block is finished there; parts of a document that lies across
blocks are put together by the place of its first id. No document is read twice and no block needs its neighbours.

Defined results: null and empty texts are the end id alone. Rows without ``doc_id`` come last. Repeated ids stand next to
each other, ordered by text. No rows give no blocks. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.llm.common import cut_points, map_batches, shuffle_parts, texts, with_bucket
from rowloom.llm.word_encoder import encoder
from rowloom.session import shared_dir

BLOCK = 65_536
END = 2
LEVEL = 3

BLOCKS = pa.schema(
    [
        ("segment", pa.int32()),
        ("block", pa.int64()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        ("width", pa.int32()),
        ("kind", pa.string()),
        ("planes", pa.list_(pa.binary())),
        ("crc", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_firsts", pa.list_(pa.int64())),
        ("doc_totals", pa.list_(pa.int64())),
        ("doc_from", pa.list_(pa.int32())),
    ]
)
BLOCKS_SQL = (
    "segment int, block long, first long, n_ids int, width int, kind string, planes array<binary>, crc long,"
    " doc_ids array<long>, doc_firsts array<long>, doc_totals array<long>, doc_from array<int>"
)


def to_planes(ids: np.ndarray, kind: str = "byte", level: int = LEVEL) -> tuple[int, list[bytes]]:
    """Bytes per id, and the compressed planes from the lowest up; a plane of zeros is empty."""
    ids = np.ascontiguousarray(ids, "<u4")
    width = max(1, (int(ids.max()).bit_length() + 7) // 8) if len(ids) else 1
    rows = ids.view(np.uint8).reshape(-1, 4)[:, :width]
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        planes = [np.packbits(bits[:, i], bitorder="little") for i in range(8 * width)]
    else:
        planes = [np.ascontiguousarray(rows[:, i]) for i in range(width)]
    pack = zstandard.ZstdCompressor(level=level)
    return width, [pack.compress(p.tobytes()) if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n_ids: int, width: int, kind: str) -> np.ndarray:
    """The ids of a block."""
    unpack = zstandard.ZstdDecompressor()
    size = (n_ids + 7) // 8 if kind == "bit" else n_ids
    raw = [np.frombuffer(unpack.decompress(p, size), np.uint8) if p else np.zeros(size, np.uint8) for p in planes]
    rows = np.zeros((n_ids, 4), np.uint8)
    if kind == "bit":
        bits = np.stack([np.unpackbits(r, count=n_ids, bitorder="little") for r in raw], axis=1)
        rows[:, :width] = np.packbits(bits, axis=1, bitorder="little")
    else:
        rows[:, :width] = np.stack(raw, axis=1)
    return rows.reshape(-1).view("<u4")


class BlockWriter:
    """Cuts the ids of one segment into blocks of a fixed size."""

    def __init__(self, segment: int, size: int, kind: str, level: int):
        self.segment, self.size, self.kind, self.level = segment, size, kind, level
        self.block, self.first, self.parts, self.held = 0, 0, [], 0
        self.docs: list[tuple] = []  # doc_id, first, total, place in the block

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        start, at = self.first + self.held, 0
        while at < len(ids):
            take = min(len(ids) - at, self.size - self.held)
            self.docs.append((doc_id, start, len(ids), self.held))
            self.parts.append(ids[at : at + take])
            self.held, at = self.held + take, at + take
            if self.held == self.size:
                yield self.close()

    def close(self) -> dict:
        ids = np.concatenate(self.parts)
        width, planes = to_planes(ids, self.kind, self.level)
        names = ("doc_ids", "doc_firsts", "doc_totals", "doc_from")
        row = dict(zip(names, map(list, zip(*self.docs, strict=True)), strict=True))
        row |= {"segment": self.segment, "block": self.block, "first": self.first, "n_ids": len(ids), "width": width}
        row |= {"kind": self.kind, "planes": planes, "crc": zlib.crc32(ids.astype("<u4").tobytes())}
        self.block, self.first, self.parts, self.held, self.docs = self.block + 1, self.first + len(ids), [], 0, []
        return row


def write_ids(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    block: int = BLOCK,
    kind: str = "byte",
    end_id: int = END,
    level: int = LEVEL,
) -> None:
    """Encode the texts of ``docs`` with the tokenizer file and write the blocks under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).ids, np.array([end_id], "<u4").tobytes()
        writer, rows = None, []
        for batch in batches:
            segments, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, part in texts(batch.column(2), 64):
                for number, text in enumerate(part, first):
                    if writer is None or writer.segment != segments[number]:
                        if writer is not None and writer.held:
                            rows.append(writer.close())
                        writer = BlockWriter(segments[number], block, kind, level)
                    rows += writer.add(ids[number], np.frombuffer(encode(text) + end, "<u4"))
                if len(rows) >= 16:
                    yield pa.RecordBatch.from_pylist(rows, schema=BLOCKS)
                    rows = []
        if writer is not None and writer.held:
            rows.append(writer.close())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=BLOCKS)

    parts = shuffle_parts(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = with_bucket(own, "doc_id", cut_points(own, "doc_id", parts), "segment").select("segment", "doc_id", "text")
    placed = placed.repartitionById(parts, F.col("segment"))
    placed = placed.sortWithinPartitions("segment", F.col("doc_id").asc_nulls_last(), "text")
    blocks = map_batches(placed, run, BLOCKS_SQL)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")  # the planes are compressed already


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """segment, doc_id, first and total of every document, with the CRC of its ids, or its ids where a block cuts it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["segment", "doc_id", "first", "total", "at", "crc", "ids"]
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"], row["width"], row["kind"])
                if zlib.crc32(ids.tobytes()) != row["crc"]:
                    raise ValueError(f"block {row['block']} of segment {row['segment']} is damaged")
                ends = [*row["doc_from"][1:], row["n_ids"]]
                whole, parts = [], []
                for at, total, start, end in zip(row["doc_firsts"], row["doc_totals"], row["doc_from"], ends, strict=True):
                    own = ids[start:end].tobytes()
                    whole.append(zlib.crc32(own) if end - start == total else None)
                    parts.append(None if end - start == total else own)
                n = len(ends)
                columns = [
                    pa.array([row["segment"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["doc_firsts"], pa.int64()),
                    pa.array(row["doc_totals"], pa.int64()),
                    pa.array([row["first"]] * n, pa.int64()),
                    pa.array(whole, pa.int64()),
                    pa.array(parts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "segment int, doc_id long, first long, total long, at long, crc long, ids binary"
    return map_batches(spark.read.schema(BLOCKS_SQL).parquet(f"{path}/blocks"), run, schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, from the files."""
    index = spark.read.schema(BLOCKS_SQL).parquet(f"{path}/blocks")
    sizes = index.groupBy("segment").agg(F.sum("n_ids").alias("size"))
    before = Window.partitionBy(F.lit(0)).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("segment", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    pieces = decoded(spark, path)
    whole = pieces.filter("crc IS NOT NULL").select("segment", "doc_id", "first", "total", "crc")
    cut = pieces.filter("crc IS NULL").groupBy("segment", "first").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"),  # the parts of one document
    )
    joined = F.aggregate("parts", F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    cut = cut.select("segment", "doc_id", "first", "total", F.crc32(joined).alias("crc"))
    found = whole.unionByName(cut).join(F.broadcast(offsets), "segment")  # one row per segment
    start = F.col("first") + F.col("offset")
    return found.select("doc_id", start.alias("start"), F.col("total").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and the ids of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"], row["width"], row["kind"]).astype(np.int64)
                ends = [*row["doc_from"][1:], row["n_ids"]]
                own = [ids[a:b] for a, b in zip(row["doc_from"], ends, strict=True)]
                names = ["segment", "first", "doc_id", "at", "ids"]
                columns = [pa.array([row["segment"]] * len(own), pa.int32()), pa.array(row["doc_firsts"], pa.int64())]
                columns += [pa.array(row["doc_ids"], pa.int64()), pa.array([row["first"]] * len(own), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(own, pa.list_(pa.int64()))], names=names)

    blocks = spark.read.schema(BLOCKS_SQL).parquet(f"{path}/blocks")
    parts = map_batches(blocks, run, "segment int, first long, doc_id long, at long, ids array<long>")
    ordered = F.array_sort(F.collect_list(F.struct("at", "ids")))
    rows = parts.groupBy("segment", "first").agg(F.first("doc_id").alias("doc_id"), ordered.alias("parts"))
    return rows.select("doc_id", F.flatten("parts.ids").alias("ids"))


def round_trip(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Write the ids of ``docs`` and return what ``read_documents`` finds in the files."""
    spark = docs.sparkSession
    path = path or shared_dir(spark, "token-ids")
    write_ids(docs, tokenizer, path, **options)
    return read_documents(spark, path)
