"""Composite (multi-part) keys and column names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def composite(**parts: str | Column) -> Column:
    """A composite: a struct whose fields stand in ordinal order."""
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in parts.items()])


def in_composite_range(name: Column, start: Column, end: Column, parts: Sequence[str]) -> Column:
    """Whether a composite column name lies between two composite bounds.

    A part counts when it is set in both bounds.  Every counted part but the last must equal the one in ``start``; the
    last must lie between ``start`` and ``end``, both included.  Parts that do not count are skipped, and no counted
    part at all means no bound.  This is not the order of structs: ``end`` gives only its last counted part.
    """
    given = [start[p].isNotNull() & end[p].isNotNull() for p in parts]
    tests = []
    for i, p in enumerate(parts):
        later = reduce(Column.__or__, given[i + 1 :], F.lit(False))
        test = F.when(later, name[p] == start[p]).otherwise(name[p].between(start[p], end[p]))
        tests.append(~given[i] | test)
    inside = reduce(Column.__and__, tests, F.lit(True))
    return start.isNotNull() & end.isNotNull() & inside
