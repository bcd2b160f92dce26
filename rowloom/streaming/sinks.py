"""Streams into stores, and lookups of streams.

Every sink is a ``foreachBatch`` whose write replaces the directory of its batch id, and the checkpoint is committed
after the write.  A batch that fails is run again after a restart and leaves the store as one run would.  Each streaming
query needs its own ``writer`` name, and a new checkpoint a new one, because the checkpoint owns the batch numbers.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowloom.functions.text import state_key
from rowloom.operators.aggregate import running_count
from rowloom.operators.mappers import Write, map_default
from rowloom.operators.rejects import EMPTY, IGNORE, REASON, REJECT, ErrorPolicy, with_reason
from rowloom.sources.cells import CellStore, CounterStore, Mapper
from rowloom.plans.skew import SkewOptions, skew_join
from rowloom.sources.log import BatchLog
from rowloom.sources.state import Aggregate, StateOptions, StateStore

Batch = Callable[[DataFrame, int], None]
log = logging.getLogger(__name__)


def each_batch(stream: DataFrame, handle: Batch, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` on every micro-batch."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _checked(write: Batch, rules: Mapping[str, Column] | None, policy: ErrorPolicy | None, report: Batch | None,
             then: Batch | None) -> Batch:
    """Write what passes the rules.  Refused rows go to ``report``, and rows that may be ignored are counted and logged.

    Without a policy every broken rule refuses its row, so rows never go unseen.
    """
    policy = policy or ErrorPolicy(default=REJECT)
    if rules:
        chosen = {policy.actions.get(reason, policy.default) for reason in rules}
        if REJECT in chosen and report is None:
            raise ValueError("rows may be rejected: give a report that takes them, or another action")
        if EMPTY in chosen:
            raise ValueError("a write has no empty results; 'empty' is for lookups")
    ignored = [r for r in rules or () if policy.actions.get(r, policy.default) == IGNORE]

    def count_ignored(batch: DataFrame, batch_id: int) -> None:
        found = with_reason(batch, rules).where(F.col(REASON).isin(ignored)).groupBy(REASON).count().collect()
        for row in found:  # one row for each rule at most
            log.warning("batch %s: %s rows ignored for %s", batch_id, row["count"], row[REASON])

    def handle(batch: DataFrame, batch_id: int) -> None:
        shared = report is not None or then is not None or bool(ignored)
        if shared:
            batch = batch.persist()
        try:
            good = batch
            if rules:
                parts = policy.apply(batch, rules)
                good = parts["good"]
                if report is not None:
                    report(parts["reject"], batch_id)
                if ignored:
                    count_ignored(batch, batch_id)
            write(good, batch_id)
            if then is not None:
                then(good, batch_id)
        finally:
            if shared:
                batch.unpersist()

    return handle


def put_stream(stream: DataFrame, store: CellStore, mapper: Mapper, checkpoint: str, writer: str = "main",
               rules: Mapping[str, Column] | None = None, policy: ErrorPolicy | None = None,
               report: Batch | None = None, then: Batch | None = None, available_now: bool = True,
               many_tables: bool = False, fold: bool = True) -> StreamingQuery:
    """Upsert and delete cells.

    Rows are checked by ``rules`` and ``policy``; ``report`` gets the rejected rows, and ``then`` the written rows of
    each batch.  ``many_tables`` and ``fold`` are those of ``CellStore.put``.
    """

    def write(good: DataFrame, batch_id: int) -> None:
        store.put(good, mapper, batch_id, writer, many_tables, fold)

    return each_batch(stream, _checked(write, rules, policy, report, then), checkpoint, available_now)


def increment_stream(stream: DataFrame, store: CounterStore, mapper: Mapper, checkpoint: str, writer: str = "main",
                     rules: Mapping[str, Column] | None = None, policy: ErrorPolicy | None = None,
                     report: Batch | None = None, then: Batch | None = None, available_now: bool = True,
                     many_tables: bool = False) -> StreamingQuery:
    """Increment counters; a replayed batch is not counted twice."""

    def write(good: DataFrame, batch_id: int) -> None:
        store.increment(good, mapper, batch_id, writer, many_tables)

    return each_batch(stream, _checked(write, rules, policy, report, then), checkpoint, available_now)


def state_stream(stream: DataFrame, state: StateStore, write_ts: str | Column, checkpoint: str, writer: str = "main",
                 then: Batch | None = None, available_now: bool = True, rules: Mapping[str, Column] | None = None,
                 policy: ErrorPolicy | None = None, report: Batch | None = None) -> StreamingQuery:
    """Keep keyed aggregates of a stream; rows are checked as in ``put_stream``."""

    def write(good: DataFrame, batch_id: int) -> None:
        state.update(good, batch_id, write_ts, writer)

    return each_batch(stream, _checked(write, rules, policy, report, then), checkpoint, available_now)


def lookup_stream(stream: DataFrame, lookup: Callable[[DataFrame], DataFrame], out: Batch, checkpoint: str,
                  available_now: bool = True, rules: Mapping[str, Column] | None = None,
                  policy: ErrorPolicy | None = None, report: Batch | None = None) -> StreamingQuery:
    """Answer the requests of each micro-batch with one join and hand the answers to ``out``.

    Requests are checked as the rows of ``put_stream`` are.

    ``lookup`` must open the cells itself, as ``CellStore.lookup`` does: it is called for every batch, and a table opened
    before the stream would never show later writes.  The batch is kept and counted first, so Spark knows its size and
    broadcasts it when it is small.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.count()
            out(lookup(batch), batch_id)
        finally:
            batch.unpersist()

    return each_batch(stream, _checked(answer, rules, policy, report, None), checkpoint, available_now)


def running_count_stream(stream: DataFrame, key: str) -> DataFrame:
    """The count so far of each key that a micro-batch touched; to be written in update mode."""
    return stream.groupBy(key).count()


def put_running_count(stream: DataFrame, key: str, store: CellStore, table: str, checkpoint: str, writer: str = "main",
                      available_now: bool = True) -> StreamingQuery:
    """Upsert a row per key with the columns ``key`` and ``count`` as the counts grow.

    All keys are kept in Spark's state store: name RocksDB in ``spark.sql.streaming.stateStore.providerClass`` where they
    do not fit into memory, or count with a ``StateStore`` and ``state_stream``, whose state is files.  A greater count is a later one, so the order of the writes comes from the data.
    """
    write = Write(F.lit("1970-01-01").cast("timestamp_ntz"), "count", table=table)

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.put(batch, lambda rows: map_default(rows, key, [key, "count"], write), batch_id, writer)

    counts = running_count_stream(stream, key).writeStream.outputMode("update").foreachBatch(handle)
    counts = counts.option("checkpointLocation", checkpoint)
    return (counts.trigger(availableNow=True) if available_now else counts).start()


def running_rows(stream: DataFrame, key: str, order: str, root: str, checkpoint: str, name: str = "count",
                 writer: str = "main", options: SkewOptions | None = None, available_now: bool = True) -> RunningRows:
    """Every row of a stream with the number of rows of its key so far, as ``running_count`` gives it for a table.

    Rows count in the order of their micro-batches and, inside one, by ``order``.  A batch is counted by itself and raised by
    the counts of the batches before it, of which only those of its keys are read.  The answers and the counts of a batch
    replace those of an earlier attempt, and the earlier attempt is never counted, so a replay leaves the same rows.
    """
    spark = stream.sparkSession
    rows = BatchLog(spark, f"{root}/rows", T.StructType([*stream.schema, T.StructField(name, T.LongType())]))
    counts = StateStore(spark, root, [key], {"n": Aggregate("count")}, StateOptions(ttl_seconds=None, table="counts"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            own = running_count(batch, key, order, options, "__own").withColumn("key", state_key(key))
            before = counts.without(own.select("key").distinct(), batch_id, writer)
            found = skew_join(own, before, ["key"], "left", options, unique_right=True)
            total = (F.col("__own") + F.coalesce("n", F.lit(0))).alias(name)
            rows.append(found.select(*batch.columns, total), batch_id, writer)
            counts.update(batch, batch_id, F.lit("1970-01-01").cast("timestamp_ntz"), writer)
        finally:
            batch.unpersist()

    return RunningRows(rows, counts, each_batch(stream, handle, checkpoint, available_now))


@dataclass(frozen=True)
class RunningRows:
    """The answers of ``running_rows``, the counts behind them, and the running query."""

    rows: BatchLog
    counts: StateStore
    query: StreamingQuery
