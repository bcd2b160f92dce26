"""rowloom: wide-row keyed tables for PySpark, in batch and in streams.

Rows become cells (row key, column name, value); cells are kept as an append-only log and folded when read.  Every
operator takes and returns DataFrames.
"""

from rowloom.model import GLOBAL_KEY, NULL_PART, cell_schema, counter_schema

__all__ = ["GLOBAL_KEY", "NULL_PART", "cell_schema", "counter_schema"]
