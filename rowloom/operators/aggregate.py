"""Counts and sums over words, keys and requests."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import state_key
from rowloom.operators.lookup import multi_get
from rowloom.plans.skew import SkewOptions, key_counts, key_hash, skew_join


def split_words(df: DataFrame, sentence: str, word: str = "word", keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-empty word of a sentence, split on one space."""
    return df.select(*keep, F.explode(F.split(sentence, " ")).alias(word)).where(F.col(word) != "")


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def sum_by(df: DataFrame, column: str, *keys: str, name: str = "sum") -> DataFrame:
    """Sum per key; a sum over nothing is 0."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum(column), F.lit(0)).alias(name))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Only the rows in which all the columns are set."""
    return df.dropna(subset=list(columns))


def count_distinct(df: DataFrame, request: str, member: str, name: str = "count") -> DataFrame:
    """Distinct members per request.

    Duplicates are dropped per task and then per ``(request, member)``, so one large request is still spread.
    """
    return df.groupBy(request).agg(F.countDistinct(member).alias(name))


def state_get_sum(requests: DataFrame, argument: str, state: DataFrame, value: str, ids: Sequence[str],
                  options: SkewOptions | None = None) -> DataFrame:
    """Per request, the sum of the state values of the words of its argument; unknown words do not count.

    A word that stands twice counts twice; its uses are counted before the lookup, so they travel as one row.  A request
    without any known word gives 0.
    """
    asked = count_by(split_words(requests, argument, keep=ids), *ids, "word", name="__uses")
    got = multi_get(asked.select(*ids, "__uses", state_key("word").alias("key")), state, options)
    sums = not_null(got, value).groupBy(*ids).agg(F.sum(F.col("__uses") * F.col(value)).alias("sum"))
    every = skew_join(requests.select(*ids), sums, ids, "left", options, unique_right=True)
    return every.withColumn("sum", F.coalesce("sum", F.lit(0).cast("long")))


def _ordinal(df: DataFrame, order: str) -> Column:
    """A number that never falls as the order rises; equal numbers for close values do no harm."""
    kind, c = df.schema[order].dataType, F.col(order)
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # By its parts: as an instant, a local time could run backwards where clocks change.
        day = F.unix_date(c.cast("date")).cast("double")
        return day * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    raise TypeError(f"order column {order!r} must be a number or a time, not {kind}")


def _doubles(values: Sequence[float]) -> Column:
    """One literal array, instead of a literal per value."""
    return F.split(F.lit(" ".join("Infinity" if v == math.inf else repr(v) for v in values)), " ").cast("array<double>")


def _quantiles(df: DataFrame, column: str, parts: int) -> list[float]:
    """``parts`` - 1 ascending values that cut a column into parts of about the same size, by a bounded sketch."""
    sketch = F.kll_sketch_agg_double(column, F.lit(min(max(4 * parts, 200), 65535)))
    ranks = _doubles([i / parts for i in range(1, parts)])
    (cuts,) = df.dropna().agg(F.kll_sketch_get_quantile_double(sketch, ranks)).first()
    return sorted(cuts) if cuts else [math.inf] * (parts - 1)


def _with_bucket(df: DataFrame, ordinal: Column, marks: Sequence[float], name: str) -> DataFrame:
    """Number of marks at or below ``ordinal``, by binary search; there are 2**n - 1 ascending marks."""
    table = _doubles(marks)
    df = df.withColumn(name, F.lit(0))
    step = (len(marks) + 1) // 2
    while step:
        mark = F.get(table, F.col(name) + (step - 1))
        df = df.withColumn(name, F.col(name) + F.when(mark <= ordinal, step).otherwise(0))
        step //= 2
    return df


def running_count(df: DataFrame, key: str, order: str, options: SkewOptions | None = None,
                  name: str = "count") -> DataFrame:
    """Each row with the number of rows of its key so far, by ``order`` (unique within a key).

    Rows of a heavy key are cut along ``order`` into buckets at quantiles of the whole table, counted inside each
    bucket, and raised by the sizes of the buckets before it; other keys stay in one piece.  Where the quantiles fall
    steers only the balance, not the result.
    """
    options = options or SkewOptions(min_rows=10_000_000)
    ordinal = _ordinal(df, order)
    heavy, rows = key_counts(df, [key], options)
    if not heavy:
        upto = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.count("*").over(upto))

    buckets = 2 ** min(max(math.ceil(math.log2(rows / options.min_rows)), 4), 14)  # steers only the balance
    cuts = _quantiles(df.select(ordinal.alias("o")), "o", buckets)
    is_heavy = key_hash([key]).isin(list(heavy))
    cut = _with_bucket(df, F.when(is_heavy, ordinal), cuts, "__b")
    slot = [key, "__b"]
    upto = Window.partitionBy(*slot).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = cut.withColumn(name, F.count("*").over(upto))

    # One row per heavy key and bucket, partitioned like the counted rows, so these are not shuffled again.
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.where(is_heavy).groupBy(*slot).agg(F.count("*").alias("__n"))
    offsets = sizes.select(F.col(key).alias("__key"), F.col("__b").alias("__at"), F.sum("__n").over(before).alias("__before"))
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__b") == F.col("__at"))
    raised = counted.join(offsets, same, "left")
    return raised.select(*df.columns, (F.col(name) + F.coalesce("__before", F.lit(0))).alias(name))
