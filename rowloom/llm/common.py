"""Helpers shared by the operators: stored intermediates, ordered buckets and text columns of Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from math import inf

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.session import scratch_dir


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def for_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it, if it is not installed."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [env.get("PYTHONPATH")])])


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` whose workers can import this package."""
    for_workers(df.sparkSession)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here, and a lost executor loses nothing.

    ``rowloom.session.release`` removes what was written, once the results are no longer needed.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def cut_points(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` values that cut the column into nearly equal shares; the nulls are left out."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    row = df.agg(F.percentile_approx(column, shares, max(1000, 20 * parts)).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def with_bucket(df: DataFrame, column: str, cuts: list[int], bucket: str) -> DataFrame:
    """Add the number of the share that a row is in: ``bucket`` rises with ``column``, and nulls come last.

    Equal values are always in one share.
    """
    if not cuts:
        return df.withColumn(bucket, F.when(F.col(column).isNull(), 1).otherwise(0))
    splits = [-inf, *sorted({float(c) for c in cuts}), inf]
    number, placed = f"{bucket}_in", f"{bucket}_out"
    out = df.withColumn(number, F.col(column).cast("double"))
    out = Bucketizer(splits=splits, inputCol=number, outputCol=placed, handleInvalid="keep").transform(out)
    return out.withColumn(bucket, F.coalesce(F.col(placed).cast("int"), F.lit(len(splits) - 1))).drop(number, placed)


def texts(column: pa.Array, step: int = 256) -> Iterator[tuple[int, list[str]]]:
    """The texts of a column in slices of ``step`` rows, with the first row's number; null is the empty text."""
    for start in range(0, len(column), step):
        yield start, [t or "" for t in column.slice(start, step).to_pylist()]


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
