from rowloom.sources.cells import CellStore, CounterStore, emit_constant
from rowloom.sources.log import BatchLog
from rowloom.sources.merges import Declared, approx_distinct, average, latest, quantile
from rowloom.sources.state import Aggregate, DistinctStore, StateOptions, StateStore, get_values, put_values

__all__ = ["Aggregate", "BatchLog", "CellStore", "CounterStore", "Declared", "DistinctStore", "StateOptions", "StateStore",
           "approx_distinct", "average", "emit_constant", "get_values", "latest", "put_values", "quantile"]
