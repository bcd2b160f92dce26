"""Aggregates that are kept over batches by a declared merge.

An aggregate is four expressions over a buffer of a fixed type: ``of_batch`` makes the buffer of a batch, ``merge`` makes one
buffer of many, ``finish`` gives the value of a buffer, and ``start`` is the buffer of nothing.  ``merge`` must give the same
for any grouping of the buffers and skip nulls, as Spark's aggregate functions do.  The buffer is what a state's log holds,
so replays, compaction, lives and the value before the last batch work as for counts and sums.

    StateStore(spark, root, ["user_id"], {"mean": average("value"), "last": latest("props", "ts"), "n": Aggregate("count")})
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Expression = Callable[[Column], Column]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _same(buffer: Column) -> Column:
    return buffer


@dataclass(frozen=True)
class Declared:
    """An aggregate by its expressions.  ``dtype`` is the type of the buffer."""

    of_batch_: Column
    merge: Expression
    dtype: T.DataType
    finish: Expression = _same
    start: Column | None = None

    def of_batch(self) -> Column:
        return self.of_batch_.cast(self.dtype)

    def merged(self, buffer: str | Column) -> Column:
        return self.merge(_col(buffer)).cast(self.dtype)

    def finished(self, buffer: str | Column) -> Column:
        """The value of a buffer; a missing one counts as ``start``."""
        found = _col(buffer)
        return self.finish(found if self.start is None else F.coalesce(found, self.start.cast(self.dtype)))


def average(of: str | Column, dtype: T.DataType = T.DoubleType()) -> Declared:
    """The mean of the values that are set; null if none is.  ``dtype`` is the type of the sum: a decimal sums exactly."""
    value = _col(of)
    buffer = T.StructType([T.StructField("total", dtype), T.StructField("n", T.LongType())])
    return Declared(
        F.struct(F.sum(value).alias("total"), F.count(value).alias("n")),
        lambda b: F.struct(F.sum(b["total"]).alias("total"), F.sum(b["n"]).alias("n")),
        buffer,
        lambda b: F.when(b["n"] > 0, b["total"].cast("double") / b["n"]),
    )


def latest(of: str | Column, by: str | Column, dtype: T.DataType = T.StringType(),
           by_type: T.DataType = T.TimestampNTZType()) -> Declared:
    """The value with the greatest ``by``; rows without one do not count, and on a tie the greater value wins."""
    newest = F.when(_col(by).isNotNull(), F.struct(_col(by).alias("at"), _col(of).alias("value")))
    buffer = T.StructType([T.StructField("at", by_type), T.StructField("value", dtype)])
    return Declared(F.max(newest), F.max, buffer, lambda b: b["value"])


def approx_distinct(of: str | Column, lg_size: int = 12) -> Declared:
    """About how many values were seen, by a sketch of 2**``lg_size`` registers; a few of them are counted exactly."""
    return Declared(
        F.hll_sketch_agg(of, lg_size), lambda b: F.hll_union_agg(b), T.BinaryType(),
        lambda b: F.coalesce(F.hll_sketch_estimate(b), F.lit(0).cast("long")),
    )


def quantile(of: str | Column, rank: float, size: int = 200) -> Declared:
    """About the value at a rank (0 to 1) of the numbers that were seen, by a sketch; up to ``size`` of them exactly."""
    if not 0 <= rank <= 1:
        raise ValueError("a rank is from 0 to 1")
    value = _col(of).cast("double")
    filled = lambda b: F.when(F.kll_sketch_get_n_double(b) > 0, b)  # noqa: E731  the sketch of nothing has no quantile
    return Declared(
        F.kll_sketch_agg_double(value, F.lit(size)), lambda b: F.kll_merge_agg_double(b), T.BinaryType(),
        lambda b: F.kll_sketch_get_quantile_double(filled(b), F.lit(float(rank))),
    )


def members() -> Declared:
    """Exactly how many members, as a bitmap of the integers in ``member_bit``, see ``StateStore.distinct``."""
    return Declared(F.bitmap_construct_agg(F.col("member_bit")), lambda b: F.bitmap_or_agg(b), T.BinaryType(), F.bitmap_count)
