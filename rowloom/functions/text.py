"""Text rules of cells, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.model import NULL_PART


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: str | Column) -> Column:
    """A column value as text; null is the empty string."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def key_part(c: str | Column) -> Column:
    """A part of a composite key as text; null is ``[NULL]``."""
    return F.coalesce(_col(c).cast("string"), F.lit(NULL_PART))


def state_key(*parts: str | Column) -> Column:
    """A state key: the list of its parts as text, so ``1`` and ``'1'`` are the same key."""
    return F.array(*[key_part(p) for p in parts])


def split_parts(c: str | Column, regex: str) -> Column:
    """Split on a regular expression and drop the empty parts at the end (only there).

    The empty string gives one empty part; a string of nothing but delimiters gives none; null gives null.
    """
    value = _col(c)
    parts = F.split(value, regex)
    last = F.array_max(F.transform(parts, lambda e, i: F.when(e != "", i + 1).otherwise(0)))
    return F.when(value == "", F.array(F.lit(""))).otherwise(F.slice(parts, 1, last))


def words(c: str | Column) -> Column:
    """The non-empty words of a sentence, split on one space."""
    return F.filter(F.split(_col(c), " "), lambda w: w != "")
