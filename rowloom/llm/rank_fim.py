"""Fill-in-the-middle texts cut through a learned rank index.

Every boundary between two units of a text (code points, words or lines) has a byte offset. A piecewise-linear function
from the number of a boundary to its offset is fitted to all of them: a segment whose line misses some offset by more than
``error`` bytes is halved, until none does. What the lines miss is stored, one small integer a boundary, so a cut is found
by predicting its offset from its segment and adding the stored residual, which makes it exact.

A text is cut twice, at boundaries drawn from a digest of its id, and its parts are written in one of two orders, with tags
before the parts: prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``). Texts that hold a tag stay as they
are (``plain``), as do some drawn ones, so ``restored`` can always put the text together again.

Defined results: null and empty texts are plain with no units. Rows without ``doc_id`` are drawn for an empty id. Repeated
rows give repeated results. Texts of any length are cut whole; the index takes a byte or two a boundary. No rows give no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import map_batches, texts

ERROR = 127  # a residual takes one byte
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
TAGS = (PREFIX, SUFFIX, MIDDLE)
SPACES = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)


def boundaries(data: bytes, unit: str = "char") -> np.ndarray:
    """Offsets of the n + 1 boundaries of the n units of a UTF-8 text: its start, between any two units, and its end."""
    raw = np.frombuffer(data, np.uint8)
    if unit == "char":
        starts = np.flatnonzero((raw & 0xC0) != 0x80)
    elif unit == "word":
        space = np.isin(raw, SPACES)
        starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(raw) else np.zeros(0, np.int64)
    elif unit == "line":
        starts = np.concatenate([[0], np.flatnonzero(raw[:-1] == 10) + 1]) if len(raw) else np.zeros(0, np.int64)
    else:
        raise ValueError(f"unknown unit {unit!r}; use char, word or line")
    if len(starts):
        starts[0] = 0  # white space before the first word belongs to it
    return np.concatenate([starts, [len(raw)]])


@dataclass(frozen=True)
class RankIndex:
    """Segments (first boundary, offset and bytes a boundary there) and the residual of every boundary."""

    firsts: np.ndarray
    bases: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """An index none of whose predictions misses its offset by more than ``error``."""
        count = len(offsets)
        open_, done = [np.array([[0, count]])], []
        residuals = np.zeros(count, np.int16 if error > 127 else np.int8)
        while open_:
            spans = np.concatenate(open_)
            first, end = spans[:, 0], spans[:, 1]
            bases, slopes = offsets[first], _slopes(offsets, first, end)
            length = end - first
            starts = np.cumsum(length) - length
            inside = np.arange(length.sum()) - np.repeat(starts, length)
            at = inside + np.repeat(first, length)
            missed = offsets[at] - _predicted(np.repeat(bases, length), np.repeat(slopes, length), inside)
            good = np.maximum.reduceat(np.abs(missed), starts) <= error
            kept = np.repeat(good, length)
            residuals[at[kept]] = missed[kept]
            done.append(np.stack([first[good], bases[good], slopes[good]]))
            first, end = first[~good], end[~good]
            half = (first + end) // 2
            open_ = [np.stack([first, half], 1), np.stack([half, end], 1)] if len(first) else []
        firsts, bases, slopes = np.concatenate(done, axis=1)
        order = np.argsort(firsts)
        return cls(firsts[order].astype(np.int64), bases[order].astype(np.int64), slopes[order], residuals)

    def offset(self, rank: int) -> int:
        """The exact offset of a boundary: the prediction of its segment, put right by its residual."""
        i = int(np.searchsorted(self.firsts, rank, side="right")) - 1
        return int(_predicted(self.bases[i], self.slopes[i], rank - self.firsts[i]) + self.residuals[rank])

    def packed(self) -> dict[str, bytes | int]:
        """The index as it is stored: little-endian arrays, compressed."""
        press = zstandard.ZstdCompressor(level=3).compress
        width = self.residuals.itemsize
        found = {"firsts": self.firsts.astype("<i8"), "bases": self.bases.astype("<i8"), "slopes": self.slopes.astype("<f8")}
        found["residuals"] = self.residuals.astype(f"<i{width}")
        return {name: press(array.tobytes()) for name, array in found.items()} | {"residual_bytes": width}

    @classmethod
    def unpacked(cls, row: dict) -> RankIndex:
        """The index that was stored."""
        kinds = {"firsts": "<i8", "bases": "<i8", "slopes": "<f8", "residuals": f"<i{row['residual_bytes']}"}
        open_ = zstandard.ZstdDecompressor().decompress
        return cls(*[np.frombuffer(open_(row[name]), kind) for name, kind in kinds.items()])


def _slopes(offsets: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (offsets[end - 1] - offsets[first]) / np.maximum(end - 1 - first, 1)


def _predicted(base, slope, steps):
    return base + np.rint(slope * steps).astype(np.int64)


def draws(doc_id: int | None, seed: str) -> list[int]:
    """Four numbers of 32 bits from the digest of a seed and an id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def cut(data: bytes, doc_id: int | None, unit: str = "char", seed: str = "1", error: int = ERROR) -> tuple:
    """n, form, prefix and middle code points (None where plain) and the output of one text."""
    offsets = boundaries(data, unit)
    n, (h1, h2, h3, h4) = len(offsets) - 1, draws(doc_id, seed)
    if not data or h3 % 100 >= PLAIN_FROM or any(tag in data for tag in TAGS):
        return n, "plain", None, None, data
    index = RankIndex.fit(offsets, error)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = index.offset(low), index.offset(high)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    chars = (low, high - low) if unit == "char" else (len(prefix.decode()), len(middle.decode()))
    if h4 % 100 < SPM_BELOW:
        return n, "spm", *chars, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", *chars, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fill_in_middle(docs: DataFrame, unit: str = "char", seed: str = "1", error: int = ERROR) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every row."""
    if not 0 < error < 2**15:
        raise ValueError("the error must be from 1 to 32767 bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for start, part in texts(batch.column(1)):
                ids = batch.column(0).slice(start, len(part))
                rows = [cut(t.encode(), i, unit, seed, error) for t, i in zip(part, ids.to_pylist(), strict=True)]
                columns = zip(*[(*r[:-1], r[-1].decode()) for r in rows], strict=True)
                arrays = [ids, *[pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_batches(_picked(docs), run, schema)


def rank_indexes(docs: DataFrame, unit: str = "char", error: int = ERROR) -> DataFrame:
    """The stored index of every row's text, for cuts at other places: doc_id, n and the columns of ``RankIndex.packed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in texts(batch.column(1)):
                ids, rows = batch.column(0).slice(start, len(part)).to_pylist(), []
                for doc_id, text in zip(ids, part, strict=True):
                    offsets = boundaries(text.encode(), unit)
                    rows.append({"doc_id": doc_id, "n": len(offsets) - 1} | RankIndex.fit(offsets, error).packed())
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("firsts", pa.binary()), ("bases", pa.binary()),
                       ("slopes", pa.binary()), ("residuals", pa.binary()), ("residual_bytes", pa.int32())])
    schema = "doc_id long, n long, firsts binary, bases binary, slopes binary, residuals binary, residual_bytes int"
    return map_batches(_picked(docs), run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, from nothing but the output and its form."""
    parts = F.split(output, "|".join(tag.decode() for tag in TAGS), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(docs)
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
