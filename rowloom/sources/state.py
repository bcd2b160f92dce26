"""Keyed aggregate state kept as a log of per-batch aggregates.

A batch is aggregated by key and written; the state is the merge of the batches.  So only aggregates that merge are
taken: counts, sums and extremes by name, others by a declared merge of a typed buffer (``sources.merges``).
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import state_key
from rowloom.model import DEFAULT_STATE_TTL_SECONDS, GLOBAL_KEY
from rowloom.operators.mappers import Write, map_custom
from rowloom.sources.cells import CellStore
from rowloom.sources.commits import in_ranges
from rowloom.sources.log import BatchLog
from rowloom.sources.merges import Declared, members

NON_TRANSACTIONAL, TRANSACTIONAL, OPAQUE = "non-transactional", "transactional", "opaque"
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Aggregate:
    """One aggregate of a state: its kind, its input (none for a count) and its type."""

    kind: str
    of: str | Column | None = None
    dtype: T.DataType = T.LongType()

    def __post_init__(self):
        if self.kind not in MERGES:
            raise ValueError(f"{self.kind!r} does not merge; use one of {', '.join(MERGES)}")

    def of_batch(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1) if self.of is None else self.of)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.of).cast(self.dtype)

    def merged(self, name: str | Column) -> Column:
        return MERGES[self.kind](name).cast(self.dtype)

    def finished(self, buffer: str | Column) -> Column:
        return F.col(buffer) if isinstance(buffer, str) else buffer


@dataclass(frozen=True)
class StateOptions:
    """How a state treats replays, how long a key lives after its last update, and the key of an ungrouped state.

    ``opaque``: a batch written again replaces its earlier attempt.  ``transactional``: a batch already written is left
    alone.  ``non-transactional``: it is added again, under batch ids of the store's own.  A ``ttl_seconds`` of None or less than one never expires.
    """

    mode: str = OPAQUE
    ttl_seconds: int | None = DEFAULT_STATE_TTL_SECONDS
    global_key: str = GLOBAL_KEY
    table: str = "state"
    column: str = "value"

    def __post_init__(self):
        if self.mode not in (NON_TRANSACTIONAL, TRANSACTIONAL, OPAQUE):
            raise ValueError(f"unknown mode {self.mode!r}")

    @property
    def ttl(self) -> Column | None:
        if self.ttl_seconds is None or self.ttl_seconds <= 0:
            return None
        return F.make_interval(secs=F.lit(self.ttl_seconds))


class StateStore:
    """Aggregates by key, updated batch by batch.  Without ``keys`` there is one global row."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str | Column],
                 aggregates: Mapping[str, Aggregate | Declared], options: StateOptions = StateOptions()):
        self.options = options
        self.keys = list(keys) or [F.lit(options.global_key)]
        self.aggregates = dict(aggregates)
        fields = [T.StructField("key", T.ArrayType(T.StringType()))]
        fields += [T.StructField(name, a.dtype) for name, a in self.aggregates.items()]
        fields += [T.StructField("write_ts", T.TimestampNTZType())]
        self.before = T.StructType([T.StructField(name, a.dtype) for name, a in self.aggregates.items()])
        fields += [T.StructField("prev", self.before)]
        if options.ttl is not None:
            time = T.StructField("first_ts", T.TimestampNTZType())
            life = [time, fields[-2], T.StructField("batch_id", T.LongType()), *self.before, fields[-1]]
            fields += [time, T.StructField("older", T.ArrayType(T.StructType(life)))]
        self.own, self.updates = uuid.uuid4().hex, itertools.count()
        self.log = BatchLog(spark, f"{root}/{options.table}", T.StructType(fields), (), ("key",))

    def update(self, df: DataFrame, batch_id: int, write_ts: str | Column, writer: str = "main") -> DataFrame:
        """Aggregate a batch by key and write it; hands the rows on.  ``write_ts`` is the time of a row."""
        if self.options.mode == NON_TRANSACTIONAL:
            writer, batch_id = f"{writer}-{self.own}", next(self.updates)  # one writer, and never the same batch again
        if self.options.mode == TRANSACTIONAL and self.log.has(writer, batch_id):
            return df
        aggregates = [a.of_batch().alias(name) for name, a in self.aggregates.items()]
        keyed = df.groupBy(state_key(*self.keys).alias("key"))
        found = keyed.agg(*aggregates, F.max(write_ts).alias("write_ts"))
        unset = {f.name: F.lit(None).cast(f.dataType) for f in self.log.schema if f.name not in found.columns}
        self.log.append(found.withColumns(unset), batch_id, writer)
        return df

    def _lives(self, rows: DataFrame) -> DataFrame:
        """The lives that rows hold, each with the number of the life of its key that it belongs to.

        A key that had expired before an update starts a new life. A batch holds one update of a key, a folded row all
        lives of it, each from its first update to its last. Two of them are one life if the later begins before the
        earlier has expired, so lives join the same in any order and grouping, also where a late update closes a gap.
        """
        if self.options.ttl is None:
            return rows.withColumn("__life", F.lit(0))
        first = F.coalesce("first_ts", "write_ts").alias("first_ts")
        own = F.struct(first, "write_ts", "batch_id", *self.aggregates, "prev")
        held = F.when(F.size("older") > 0, F.concat("older", F.array(own))).otherwise(F.array(own))
        rows = rows.select("key", F.explode(held).alias("held")).select("key", "held.*")
        # As many rows for a key as it has lives and later batches, whatever the number of input rows.
        by_time = Window.partitionBy("key").orderBy("first_ts", "write_ts")
        until = F.max("write_ts").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
        fresh = F.col("first_ts") >= until + self.options.ttl
        rows = rows.withColumn("__fresh", F.coalesce(fresh, F.lit(False)).cast("int"))
        return rows.withColumn("__life", F.sum("__fresh").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))

    def _merge(self, rows: DataFrame) -> DataFrame:
        """One row per key with the aggregates of its last life."""
        if self.options.ttl is not None:
            rows = self._lives(rows)
            rows = rows.withColumn("__last", F.max("__life").over(Window.partitionBy("key")))
            rows = rows.where(F.col("__life") == F.col("__last"))
        merged = [a.merged(name).alias(name) for name, a in self.aggregates.items()]
        return rows.groupBy("key").agg(
            *merged, F.max("write_ts").alias("write_ts"), F.max("batch_id").alias("batch_id")
        )

    def _merge_lives(self, rows: DataFrame) -> DataFrame:
        """One row per life, with the aggregates before its last batch in ``prev``.

        A folded row brings its own ``prev``, which counts where no later batch touched the life, and adds to what is
        older otherwise.
        """
        # All windows and the aggregate share one shuffle by key.
        rows = self._lives(rows).withColumn("__batch", F.max("batch_id").over(Window.partitionBy("key", "__life")))
        older = F.col("batch_id") < F.col("__batch")
        now, before = [], []
        for name, a in self.aggregates.items():
            now.append(a.merged(name).alias(name))
            before.append(a.merged(F.when(older, F.col(name)).otherwise(F.col(f"prev.{name}"))).alias(name))
        had = F.max(F.when(older, True).otherwise(F.col("prev").isNotNull()))
        first = [] if self.options.ttl is None else [F.min("first_ts").alias("first_ts")]
        return rows.groupBy("key", "__life").agg(
            *now,
            *first,
            F.max("write_ts").alias("write_ts"),
            F.max("batch_id").alias("batch_id"),
            F.when(had, F.struct(*before)).cast(self.before).alias("prev"),
        )

    def _fold(self, rows: DataFrame) -> DataFrame:
        """One row per key as a snapshot holds it: its last life, and in ``older`` the lives before it."""
        lives = self._merge_lives(rows)
        if self.options.ttl is None:
            return lives.drop("__life")
        life = F.struct("first_ts", "write_ts", "batch_id", *self.aggregates, "prev")
        lives = lives.withColumn("__last", F.max("__life").over(Window.partitionBy("key")))
        is_older = F.col("__life") < F.col("__last")
        found = lives.groupBy("key").agg(
            F.max_by(life, "__life").alias("own"), F.collect_list(F.when(is_older, life)).alias("older")
        )
        return found.select("key", "own.*", "older")

    def current(self, as_of: Column | None = None) -> DataFrame:
        """The state of every live key: ``key`` and the aggregates."""
        state, ttl = self.log.folded(self._merge, ["key"]), self.options.ttl
        if ttl is not None and as_of is not None:
            state = state.where(F.col("write_ts") + ttl > as_of)
        return state.select("key", *[a.finished(name).alias(name) for name, a in self.aggregates.items()])

    def without(self, keys: DataFrame, batch_id: int, writer: str = "main") -> DataFrame:
        """The state of some keys (distinct, in a column ``key``) without one batch, which may have been written before.

        For an open batch: what a snapshot has taken in cannot be told apart any more.
        """
        if in_ranges(self.log.state().covered, writer, batch_id):
            raise ValueError(f"batch {batch_id} of {writer!r} is part of a snapshot")
        narrow = lambda rows: rows.join(keys, "key", "left_semi")
        state = self.log.folded(self._merge, ["key"], narrow, skip=[(writer, batch_id)])
        return state.select("key", *[a.finished(name).alias(name) for name, a in self.aggregates.items()])

    def history(self) -> DataFrame:
        """Each key's value, the id of the last batch that touched it, and the value before that batch (``prev_*``)."""
        lives = self._merge_lives(self.log.read())
        lives = lives.withColumn("__batch", F.max("batch_id").over(Window.partitionBy("key")))
        own = F.struct(*self.aggregates)
        was = F.when(F.col("batch_id") < F.col("__batch"), own).otherwise(F.col("prev"))
        found = lives.groupBy("key").agg(
            F.max_by(own, "__life").alias("now"),
            F.max("batch_id").alias("batch_id"),
            F.max_by(was, F.when(was.isNotNull(), F.col("__life"))).alias("prev"),
        ).select("key", "batch_id", "now.*", "prev")
        had = F.col("prev").isNotNull()
        now = [a.finished(name).alias(name) for name, a in self.aggregates.items()]
        before = [F.when(had, a.finished(F.col("prev")[name])).alias(f"prev_{name}") for name, a in self.aggregates.items()]
        return found.select("key", F.col("batch_id").alias("txid"), *now, *before)

    def compact(self, keep_last: int = 1, full: bool | None = None) -> int | None:
        """Fold batches into a snapshot; answers stay as they are.

        A snapshot keeps all lives of a key, so that late updates find theirs; ``purge_before`` drops old ones.  A
        non-transactional batch is never written again, so none is left open.
        """
        if self.options.mode == NON_TRANSACTIONAL:
            keep_last = 0
        return self.log.compact(self._fold, ["key"], keep_last=keep_last, full=full)

    def purge_before(self, time: Column, keep_last: int = 1) -> int | None:
        """Fold, and drop for good the lives whose last update was before ``time``; needs a time to live.

        Updates that come later must not be older than that, as they would find their life gone.
        """
        if self.options.ttl is None:
            raise ValueError("a state without a time to live has one life for each key")
        if self.options.mode == NON_TRANSACTIONAL:
            keep_last = 0

        def fold(rows: DataFrame) -> DataFrame:
            return self._fold(rows).withColumn("older", F.filter("older", lambda life: life["write_ts"] >= time))

        return self.log.compact(fold, ["key"], keep=F.col("write_ts") >= time, keep_last=keep_last)

    def vacuum(self) -> list[str]:
        """Remove the files that a snapshot has replaced."""
        return self.log.vacuum()


class DistinctStore:
    """Exact numbers of distinct members by key, kept over batches.

    Members are integers, dense ones at best.  Those of a key are kept as bitmaps of 32,768 members each, one row for a key
    and range of members, so a key with very many members is spread over many rows, and two batches merge by OR.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str | Column], member: str,
                 options: StateOptions = StateOptions(ttl_seconds=None)):
        if options.ttl is not None:
            raise ValueError("members do not expire: the ranges of a key would do so one by one")
        self.member, self.width = member, len(keys)
        place = F.bitmap_bucket_number(F.col(member))
        self.state = StateStore(spark, root, [*keys, place], {"bits": members()}, options)

    def update(self, df: DataFrame, batch_id: int, write_ts: str | Column, writer: str = "main") -> DataFrame:
        """Add the members of a batch; rows without a member do not count.  Hands the rows on."""
        rows = df.where(F.col(self.member).isNotNull())
        rows = rows.withColumn("member_bit", F.bitmap_bit_position(F.col(self.member)))
        self.state.update(rows, batch_id, write_ts, writer)
        return df

    def current(self, name: str = "members") -> DataFrame:
        """``key`` and its number of members."""
        found = self.state.current().select(F.slice("key", 1, self.width).alias("key"), "bits")
        return found.groupBy("key").agg(F.sum("bits").alias(name))

    def compact(self, keep_last: int = 1, full: bool | None = None) -> int | None:
        return self.state.compact(keep_last, full)

    def vacuum(self) -> list[str]:
        """Remove the files that a snapshot has replaced."""
        return self.state.vacuum()


def put_values(store: CellStore, df: DataFrame, keys: Sequence[str | Column], value: str | Column, batch_id: int,
               write_ts: str | Column, seq: str | Column | None = None, options: StateOptions = StateOptions(),
               writer: str = "main") -> DataFrame:
    """Set the value of each key as it is, in one fixed column and with the state's time to live."""
    write = Write(write_ts, seq, table=options.table, ttl_seconds=options.ttl_seconds)
    content = F.col(value) if isinstance(value, str) else value
    return store.put(
        df, lambda rows: map_custom(rows, state_key(*keys), {options.column: content}, write), batch_id, writer
    )


def get_values(store: CellStore, options: StateOptions = StateOptions(), as_of: Column | None = None) -> DataFrame:
    """The live values set by ``put_values``: ``key`` and the state's column."""
    cells = store.cells(table=options.table, as_of=as_of).where(F.col("column_name") == options.column)
    return cells.select(F.col("row_key").alias("key"), F.col("value").alias(options.column))
