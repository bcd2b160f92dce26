"""Word count kept as a wide-row table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.aggregate import count_by, split_words
from rowloom.operators.mappers import map_default
from rowloom.sources.state import Aggregate, StateOptions, StateStore


def word_count_cells(sentences: DataFrame, sentence: str) -> DataFrame:
    """One row per word with the columns ``word`` and ``count``, as cells."""
    return map_default(count_by(split_words(sentences, sentence), "word"), "word")


def word_state(spark, root: str, options: StateOptions = StateOptions()) -> StateStore:
    """The state word -> count."""
    return StateStore(spark, root, ["word"], {"count": Aggregate("count")}, options)


def word_cells(state: StateStore) -> DataFrame:
    """A word state as cells, like ``word_count_cells``."""
    counts = state.current().select(F.col("key")[0].alias("word"), "count")
    return map_default(counts, "word")
