"""Every operator as a query over the given tables, most with the SQL that must give the same rows."""

from rowloom.suite import lookups, mapping, state, writes, streams  # isort: skip  # noqa: F401
from rowloom.suite.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
