"""Folding logs of cells and counters into their current state.

Both folds are grouped aggregates with a map-side part, so a cell that was written a billion times reaches the shuffle
as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.model import CELL_ID, ROUTE

VERSION = ("write_ts", "seq", "is_deleted", "value", "expires_at")


def _cell_keys(df: DataFrame) -> list[str]:
    return [c for c in (*ROUTE, *CELL_ID) if c in df.columns]


def latest_versions(cells: DataFrame) -> DataFrame:
    """The last version of every cell, deleted and expired ones included.

    Versions are ordered by ``(write_ts, seq)``; on a tie a delete wins, then the greater value.
    """
    best = F.max(F.struct(*VERSION)).alias("v")
    keys = _cell_keys(cells)
    return cells.groupBy(*keys).agg(best).select(*keys, "v.*")


def live(versions: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The cells that are neither deleted nor, at ``as_of``, expired."""
    kept = versions.where(~F.col("is_deleted"))
    if as_of is not None:
        kept = kept.where(F.col("expires_at").isNull() | (F.col("expires_at") > as_of))
    return kept


def resolve_latest(cells: DataFrame, as_of: Column | None = None, requests: DataFrame | None = None) -> DataFrame:
    """The current cells of a log.  Deletes and expiry are applied after the last version is picked, never before.

    With ``requests``, the current cells of the rows they ask for: the others are left out before the fold, which Spark
    does not do by itself because it does not move a join below the filter on deletes.
    """
    if requests is not None:
        cells = cells.join(requests.select("row_key").distinct(), "row_key", "left_semi")
    return live(latest_versions(cells), as_of).select(*_cell_keys(cells), "value")


def fold_counters(deltas: DataFrame) -> DataFrame:
    """The current counters of a log of increments."""
    return deltas.groupBy(*_cell_keys(deltas)).agg(F.sum("amount").alias("amount"))
