"""Joins that hold up when one key has a large share of the rows.

A join whose smaller side fits under Spark's own broadcast threshold is left to Spark.  Otherwise the heavy keys of both
sides are found in one pass with bounded sketches, and only their rows are spread over several partitions, the more the
heavier the key: the heavy side by a hash of its other columns, the other side by copying its rows of that key.  Rows of
a heavy key that are copies of each other hash alike, so where those are many they are counted, and travel as pieces of
limited size.  The sketches only steer the spread; the result is exact whatever they say.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.session import scratch_dir

SALT = "__salt"
HASH = "__key_hash"
PIECE = "__piece"
COPIES = "__copies"
COPIES_PER_PIECE = 10_000

# These steer only how rows are spread, never which rows come out.
# Below the number of groups from which Spark's object hash aggregate sorts instead.
SKETCHES = 64
KEYS_PER_SKETCH = 200
TRACKED_PER_SKETCH = 4096


@dataclass(frozen=True)
class SkewOptions:
    """A key is heavy from ``share`` of the rows, but not below ``min_rows``; about that many rows of it stay together.

    ``left_keys`` and ``right_keys`` may name a cheaper source of a side's keys to look for heavy ones in, such as the
    versions of cells that are yet to be folded.  With ``always``, heavy keys are looked for even in small sides.
    """

    min_rows: int = 1_000_000
    share: float = 1 / 10_000
    max_salts: int = 4096
    left_keys: DataFrame | None = None
    right_keys: DataFrame | None = None
    always: bool = False

    def floor(self, rows: int) -> float:
        return max(self.min_rows, rows * self.share)

    def salts(self, count: int, rows: int) -> int:
        """A power of two, so that few different numbers of salts occur."""
        return min(2 ** max(1, math.ceil(math.log2(count / self.floor(rows)))), self.max_salts)


def key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*on)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own estimate of the size of a result; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark would broadcast this side by itself."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= limit


def key_counts(df: DataFrame, on: Sequence[str], options: SkewOptions) -> tuple[dict[int, int], int]:
    """Hashes of the heavy keys and their estimated counts, and the number of rows.

    One pass over the key columns.  Keys fall into groups by their hash and each group has its own sketch of fixed size,
    so the sketches of all tasks are merged by several reducers; at most ``1 / share`` keys come back.
    """
    found = (
        df.select(key_hash(on).alias(HASH))
        .groupBy(F.pmod(F.col(HASH), F.lit(SKETCHES)))
        .agg(F.expr(f"approx_top_k({HASH}, {KEYS_PER_SKETCH}, {TRACKED_PER_SKETCH})").alias("top"), F.count("*").alias("n"))
        .collect()
    )
    rows = sum(group.n for group in found)
    counts = {item[0]: item[1] for group in found for item in group.top}
    return {h: n for h, n in counts.items() if n >= options.floor(rows)}, rows


def heavy_keys(df: DataFrame, on: Sequence[str], options: SkewOptions) -> dict[int, int]:
    """Hashes of the heavy keys and their numbers of salts."""
    counts, rows = key_counts(df, on, options)
    return {h: options.salts(n, rows) for h, n in counts.items()}


def _has_map(kind: T.DataType) -> bool:
    """Whether a type holds a map anywhere; such values can be neither hashed nor grouped."""
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def hashable(df: DataFrame) -> list[str]:
    """The columns that can be hashed."""
    return [f.name for f in df.schema if not _has_map(f.dataType)]


def _salted(df: DataFrame, on: Sequence[str], own: Mapping[int, int], other: Mapping[int, int]) -> DataFrame:
    """Rows of the keys in ``own`` get one of the key's salts each, rows of the keys in ``other`` are copied to all."""
    rest = [c for c in hashable(df) if c not in on]
    row_hash = F.xxhash64(*rest) if rest else F.lit(0)
    salts = F.array(F.lit(0))
    for spread, keys in ((True, own), (False, other)):
        for number in sorted(set(keys.values())):
            chosen = F.array(F.pmod(row_hash, F.lit(number)).cast("int"))
            if not spread:
                chosen = F.sequence(F.lit(0), F.lit(number - 1))
            salts = F.when(key_hash(on).isin([h for h, n in keys.items() if n == number]), chosen).otherwise(salts)
    return df.withColumn(SALT, F.explode(salts))


def _counted(df: DataFrame, on: Sequence[str], own: Mapping[int, int], options: SkewOptions) -> DataFrame:
    """The rows, or where copies of a row are heavy, each distinct row with a number of copies, in pieces.

    Rows with a map cannot be counted; they are spread by their other columns alone.
    """
    if not own or len(hashable(df)) < len(df.columns):
        return df
    if not heavy_keys(df.where(key_hash(on).isin(list(own))), df.columns, options):
        return df
    counted = df.groupBy(*df.columns).agg(F.count("*").alias(COPIES))
    last = F.floor((F.col(COPIES) - 1) / COPIES_PER_PIECE)
    pieces = counted.withColumn(PIECE, F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(F.col(COPIES) - F.col(PIECE) * COPIES_PER_PIECE, F.lit(COPIES_PER_PIECE))
    return pieces.withColumn(COPIES, size.cast("int"))


def _recopied(df: DataFrame) -> DataFrame:
    """The opposite of ``_counted``, after the join."""
    if COPIES not in df.columns:
        return df
    return df.withColumn(COPIES, F.explode(F.array_repeat(F.lit(0), F.col(COPIES)))).drop(COPIES, PIECE)


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
              options: SkewOptions | None = None, unique_right: bool = False) -> DataFrame:
    """Equi join on equally named columns, inner or left; heavy keys are spread, see above.

    With ``unique_right`` the right side has one row per key, so only the left side can have heavy ones.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    on = list(on)
    options = options or SkewOptions()
    look_left, look_right = True, not unique_right
    if not options.always:
        small_left, small_right = fits_broadcast(left), fits_broadcast(right)
        if how == "left" and small_left and (unique_right or not small_right):
            # Spark cannot broadcast the left side of a left join, but it can leave out what that side does not ask for.
            right = right.join(left.select(*on).distinct(), on, "left_semi")
        if small_right or (how == "inner" and small_left):
            return left.join(right, on, how)
        look_left = not small_left
    in_left = in_right = {}
    if look_left:
        in_left = heavy_keys(left if options.left_keys is None else options.left_keys, on, options)
    if look_right:
        in_right = heavy_keys(right if options.right_keys is None else options.right_keys, on, options)
    left_heavy = {h: n for h, n in in_left.items() if n >= in_right.get(h, 0)}
    right_heavy = {h: n for h, n in in_right.items() if h not in left_heavy}
    if not left_heavy and not right_heavy:
        return left.join(right, on, how)

    def spread(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        salted_a = _salted(_counted(a, on, left_heavy, options), on, left_heavy, right_heavy)
        salted_b = _salted(b, on, right_heavy, left_heavy)
        return _recopied(salted_a.join(salted_b, [*on, SALT], how).drop(SALT))

    if how == "inner" or not right_heavy:
        return spread(left, right, how)
    # A left row copied to every salt would come out unmatched from some: join those keys inner, add the unmatched.
    heavy = key_hash(on).isin(list(right_heavy))
    left_h, right_h = left.where(heavy), right.where(heavy)
    unmatched = left_h.join(right_h.select(*on).distinct(), on, "left_anti")
    return (
        spread(left.where(~heavy), right.where(~heavy), "left")
        .unionByName(spread(left_h, right_h, "inner"))
        .unionByName(unmatched, allowMissingColumns=True)
    )


def stored(df: DataFrame) -> DataFrame:
    """A result written to the session's shared folder and read back, to be used several times without its lineage."""
    path = scratch_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
