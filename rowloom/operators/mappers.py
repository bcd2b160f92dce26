"""Rows to cells.

Every mapper is one narrow projection: the cells of a row are built as an array of structs and inlined, so nothing is
shuffled and only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import key_part, text


def _expr(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _name(c: str | Column) -> Column:
    return F.lit(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Write:
    """Where and when the cells of a row are written, as expressions over that row.

    ``(write_ts, seq)`` orders the writes of a cell, also inside one batch, so the result never depends on partitioning.
    ``table`` and ``keyspace`` are one name for all rows, or expressions that choose one per row.  A row for which
    ``delete_when`` holds deletes the columns it maps to.  ``ttl_seconds`` of None or less than one
    means the cells never expire.
    """

    write_ts: str | Column
    seq: str | Column | None = None
    table: str | Column = "cells"
    keyspace: str | Column = "main"
    delete_when: Column | None = None
    ttl_seconds: int | None = None

    def columns(self) -> list[Column]:
        ts = _expr(self.write_ts)
        expires = F.when(F.lit(False), ts)
        if self.ttl_seconds is not None and self.ttl_seconds > 0:
            expires = ts + F.make_interval(secs=F.lit(self.ttl_seconds))
        deleted = F.lit(False) if self.delete_when is None else F.coalesce(self.delete_when, F.lit(False))
        return [
            _name(self.keyspace).alias("keyspace"),
            _name(self.table).alias("table"),
            ts.alias("write_ts"),
            (F.lit(0) if self.seq is None else _expr(self.seq)).cast("long").alias("seq"),
            deleted.alias("is_deleted"),
            expires.alias("expires_at"),
        ]


def _cells(df: DataFrame, row_key: Column, entries: Column, write: Write | None, keep: Sequence[str]) -> DataFrame:
    stamp = [] if write is None else write.columns()
    return df.select(*keep, row_key.alias("row_key"), *stamp, F.inline(entries))


def _entry(name: Column, value: Column) -> Column:
    return F.struct(name.alias("column_name"), value.alias("value"))


def map_default(df: DataFrame, key: str, fields: Sequence[str] | None = None, write: Write | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """One cell per field, the key field included; everything becomes text and null becomes the empty string."""
    names = list(fields or df.columns)
    entries = F.array(*[_entry(F.lit(f), text(f)) for f in names])
    return _cells(df, F.col(key).cast("string"), entries, write, keep)


def map_composite_key(df: DataFrame, keys: Sequence[str], fields: Sequence[str] | None = None,
                      write: Write | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One cell per field that is not part of the key; the row key is the list of the key parts as text."""
    names = [f for f in (fields or df.columns) if f not in set(keys)]
    entries = F.array(*[_entry(F.lit(f), text(f)) for f in names])
    return _cells(df, F.array(*[key_part(k) for k in keys]), entries, write, keep)


def map_custom(df: DataFrame, row_key: Column, columns: Mapping[str, Column] | Column, write: Write | None = None,
               keep: Sequence[str] = ()) -> DataFrame:
    """Cells from the caller's own expressions, with their own types.

    ``columns`` names the columns of a row, or is an array of ``struct(column_name, value)`` where the names themselves
    come from the data.  Table, keyspace and deletes come from ``write``.
    """
    entries = columns
    if not isinstance(columns, Column):
        entries = F.array(*[_entry(F.lit(n), v) for n, v in columns.items()])
    return _cells(df, row_key, entries, write, keep)


def map_composite_column(df: DataFrame, row_key: Column, name: Column, value: Column, write: Write | None = None,
                         keep: Sequence[str] = ()) -> DataFrame:
    """One cell per row whose column name is a composite."""
    stamp = [] if write is None else write.columns()
    return df.select(*keep, row_key.alias("row_key"), *stamp, name.alias("column_name"), value.alias("value"))


def map_requests(df: DataFrame, row_key: Column, slice: Column | None = None, start: Column | None = None,
                 end: Column | None = None) -> DataFrame:
    """Lookup requests: the row itself plus the row key and the wanted column names or bounds, each possibly null."""
    wanted = {"row_key": row_key}
    for name, c in (("slice", slice), ("start", start), ("end", end)):
        if c is not None:
            wanted[name] = c
    return df.withColumns(wanted)


def map_counter(df: DataFrame, key: str, amount: str, fields: Sequence[str] | None = None,
                table: str | Column = "counters", keyspace: str | Column = "main") -> DataFrame:
    """Counter increments: each *value* of the other fields names a counter column of the row."""
    if not isinstance(df.schema[amount].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        raise TypeError(f"counter amount {amount!r} must be a whole number, not {df.schema[amount].dataType}")
    names = [f for f in (fields or df.columns) if f not in (key, amount)]
    return df.select(
        _name(keyspace).alias("keyspace"),
        _name(table).alias("table"),
        F.col(key).cast("string").alias("row_key"),
        F.explode(F.array(*[F.col(f).cast("string") for f in names])).alias("column_name"),
        F.col(amount).cast("long").alias("amount"),
    )
