"""Columns found by a lookup to rows.

Results of a lookup are already one row per column, so the mappers are projections of it.  The id of the request stays
on the row through the lookup, so it can be put in front of every output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import split_parts


def columns_to_rows(found: DataFrame, rows: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Rows from the caller's own array of structs over ``row_key``, ``column_name``, ``value`` and the request.

    A null or empty array gives no row.
    """
    return found.select(*keep, F.inline(rows))


def columns_to_row(found: DataFrame, request_id: str | Sequence[str], names: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """One row per request with its named columns side by side, null where a request's row lacks one.

    ``names`` are column names, or output names by column name.  It is one grouped aggregate: no map of a row's columns is
    built.  Requests whose row has none of the columns give no row, unless their lookup kept them (``state_query``).
    """
    ids = [request_id] if isinstance(request_id, str) else list(request_id)
    wanted = dict(names) if isinstance(names, Mapping) else {n: n for n in names}
    value = lambda n: F.max(F.when(F.col("column_name") == n, F.col("value")))
    return found.groupBy(*ids).agg(*[value(n).alias(out) for n, out in wanted.items()])


RowMapper = Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def columns_together(found: DataFrame, request_id: str | Sequence[str], mapper: RowMapper, schema: str) -> DataFrame:
    """Rows from a Python function over all columns of a request's row at once, for what no expression can say.

    ``mapper`` gets the request's id as a tuple and the columns (``column_name``, ``value``) in the order of their names, a
    batch at a time, and yields batches of ``schema``.  A row is never held as a whole, but one task reads all of it; requests
    without columns give nothing, and requests with equal ids are one.  Where an expression will do, ``columns_to_rows`` and
    ``columns_to_row`` are faster.
    """
    ids = [request_id] if isinstance(request_id, str) else list(request_id)
    rows = found.select(*ids, "column_name", "value").repartition(*ids).sortWithinPartitions(*ids, "column_name")

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from mapper(tuple(k.as_py() for k in key), (b.select(["column_name", "value"]) for b in batches))

    return rows.groupBy(*ids).applyInArrow(run, schema)


def valueless(found: DataFrame, key_field: str, name_field: str, request_id: str | None = None) -> DataFrame:
    """One row per column *name* of the row that was read; values are not looked at."""
    ids = [] if request_id is None else [request_id]
    return found.select(*ids, F.col("row_key").alias(key_field), F.col("column_name").alias(name_field))


def delimited(found: DataFrame, column: str, regex: str, key_field: str, value_field: str,
              request_id: str | None = None) -> DataFrame:
    """One row per part of the named column's value, split on a regular expression; see ``split_parts``."""
    ids = [] if request_id is None else [request_id]
    return found.where(F.col("column_name") == column).select(
        *ids, F.col("row_key").alias(key_field), F.explode(split_parts("value", regex)).alias(value_field)
    )
