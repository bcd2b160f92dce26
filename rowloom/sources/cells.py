"""Wide-row tables kept as a log of cells."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.model import CELL_ID, ROUTE, cell_schema, counter_schema
from rowloom.operators.resolve import fold_counters, latest_versions, live
from rowloom.plans.skew import SkewOptions
from rowloom.sources.log import BatchLog, Keys, few_keys

Mapper = Callable[[DataFrame], DataFrame]


def _checked(cells: DataFrame) -> DataFrame:
    """A cell without a row key, a column name, or a named keyspace and table stops the write; keyspaces are lower case."""
    for name in CELL_ID:
        stop = F.raise_error(F.lit(f"null {name.replace('_', ' ')}")).cast(cells.schema[name].dataType)
        cells = cells.withColumn(name, F.coalesce(name, stop))
    for name in ROUTE:
        stop = F.raise_error(F.lit(f"empty {name} name")).cast("string")
        cells = cells.withColumn(name, F.when(F.coalesce(name, F.lit("")) == "", stop).otherwise(F.col(name)))
    return cells.withColumn("keyspace", F.lower("keyspace"))


def _routed(rows: DataFrame, keyspace: str | None, table: str | None) -> DataFrame:
    """Rows of one keyspace (in any case) or table; these are directories, so nothing else is read."""
    for name, wanted in zip(ROUTE, (keyspace if keyspace is None else keyspace.lower(), table)):
        if wanted is not None:
            rows = rows.where(F.col(name) == wanted)
    return rows


class CellStore:
    """Tables of cells under one root, told apart by keyspace and table name."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, file_rows: int | None = None):
        self.log = BatchLog(spark, root, schema or cell_schema(), ROUTE, CELL_ID, file_rows)

    def put(self, df: DataFrame, mapper: Mapper, batch_id: int, writer: str = "main",
            many_tables: bool = False, fold: bool = True) -> DataFrame:
        """Map rows to cells, write them as one batch, and hand the rows on.

        Only the last version of each cell in the batch is written; without ``fold`` all are, which saves a shuffle where
        few cells are written twice, and reads the same.  With ``many_tables`` rows are first gathered by table, so a task
        does not write a small file per table; AQE splits large tables again.
        """
        cells = _checked(mapper(df))
        cells = _gathered(latest_versions(cells) if fold else cells, many_tables)
        self.log.append(cells, batch_id, writer)
        return df

    def put_then_emit(self, df: DataFrame, mapper: Mapper, batch_id: int, field: str, value,
                      writer: str = "main") -> DataFrame:
        """Write, then give each row a constant in a new field; with None no row is handed on."""
        self.put(df, mapper, batch_id, writer)
        return emit_constant(df, field, value)

    def versions(self, keyspace: str | None = None, table: str | None = None, only: Keys | None = None) -> DataFrame:
        """Written cells that are not yet folded."""
        return _routed(self.log.read(only), keyspace, table)

    def _few(self, requests: DataFrame | None) -> Keys | None:
        """The keys that few requests ask for, where there are sorted files that need not all be opened for them."""
        if requests is None or self.log.state().fold is None:
            return None
        if requests.schema["row_key"].dataType != self.log.schema["row_key"].dataType:
            return None
        return few_keys(requests, "row_key")

    def cells(self, keyspace: str | None = None, table: str | None = None, as_of: Column | None = None,
              requests: DataFrame | None = None) -> DataFrame:
        """The current cells; with ``requests``, those of the requested rows and no others.

        Rows that nobody asks for are left out before the fold, so only the cells that are asked for are shuffled for it.
        The keys of few requests are handed to the scan: only files of a snapshot whose bounds hold one are opened, and
        row groups without one are passed over by their bounds or Bloom filters.
        """
        return self._cells(keyspace, table, as_of, requests, self._few(requests))

    def _cells(self, keyspace: str | None, table: str | None, as_of: Column | None, requests: DataFrame | None,
               only: Keys | None) -> DataFrame:
        keys = None if requests is None or only is not None else requests.select("row_key").distinct()

        def narrow(rows: DataFrame) -> DataFrame:
            rows = _routed(rows, keyspace, table)
            return rows if keys is None else rows.join(keys, "row_key", "left_semi")

        versions = self.log.folded(latest_versions, (*ROUTE, *CELL_ID), narrow, only=only)
        return live(versions, as_of).select(*ROUTE, *CELL_ID, "value")

    def lookup(self, requests: DataFrame, how: Callable[..., DataFrame], keyspace: str | None = None,
               table: str | None = None, as_of: Column | None = None, **bounds) -> DataFrame:
        """Answer requests from one table with one of the lookup operators.

        Heavy rows are looked for in the unfolded log, so the fold runs once.
        """
        only = self._few(requests)
        cells = self._cells(keyspace, table, as_of, requests, only).drop(*ROUTE)
        return how(requests, cells, options=SkewOptions(right_keys=self.versions(keyspace, table, only)), **bounds)

    def compact(self, keep_last: int = 1, purge_before: Column | None = None, full: bool | None = None) -> int | None:
        """Fold batches into a snapshot.  Deleted cells are kept, since an older write may still arrive.

        ``purge_before`` drops those deleted or expired before a time.  It takes ``keep_last=0``: a batch left out may hold
        an older version of a deleted cell, which would come back.  The caller vouches that no older write is due.
        """
        keep = None
        if purge_before is not None:
            if keep_last:
                raise ValueError("purge_before needs keep_last=0, or older versions in open batches would come back")
            deleted = F.col("is_deleted") & (F.col("write_ts") < purge_before)
            keep = ~(deleted | F.coalesce(F.col("expires_at") <= purge_before, F.lit(False)))
        return self.log.compact(latest_versions, (*ROUTE, *CELL_ID), keep, keep_last, full)

    def vacuum(self) -> list[str]:
        """Remove the files that a snapshot has replaced."""
        return self.log.vacuum()


def _gathered(rows: DataFrame, many_tables: bool) -> DataFrame:
    return rows.hint("rebalance", *ROUTE) if many_tables else rows


def emit_constant(df: DataFrame, field: str, value) -> DataFrame:
    """Every row with a constant in a new field, or no row at all for None."""
    return df.limit(0) if value is None else df.withColumn(field, F.lit(value))


class CounterStore:
    """Counters kept as a log of increments, one sum per counter and batch."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, file_rows: int | None = None):
        self.log = BatchLog(spark, root, schema or counter_schema(), ROUTE, CELL_ID, file_rows)

    def increment(self, df: DataFrame, mapper: Mapper, batch_id: int, writer: str = "main",
                  many_tables: bool = False) -> DataFrame:
        """Map rows to increments, write their sums as one batch, and hand the rows on.  A null amount stops the write."""
        deltas = _checked(mapper(df))
        deltas = deltas.withColumn("amount", F.coalesce("amount", F.raise_error(F.lit("null amount")).cast("long")))
        self.log.append(_gathered(fold_counters(deltas), many_tables), batch_id, writer)
        return df

    def counters(self, keyspace: str | None = None, table: str | None = None) -> DataFrame:
        """The current counters."""
        columns = [*ROUTE, *CELL_ID, "amount"]
        narrow = lambda rows: _routed(rows, keyspace, table).select(*columns)
        return self.log.folded(fold_counters, (*ROUTE, *CELL_ID), narrow)

    def compact(self, keep_last: int = 1, full: bool | None = None) -> int | None:
        return self.log.compact(fold_counters, (*ROUTE, *CELL_ID), keep_last=keep_last, full=full)

    def vacuum(self) -> list[str]:
        """Remove the files that a snapshot has replaced."""
        return self.log.vacuum()
