"""Operators on rows, cells and requests."""
# ruff: noqa: F401
from rowloom.operators.aggregate import (
    count_by,
    count_distinct,
    not_null,
    running_count,
    split_words,
    state_get_sum,
    sum_by,
)
from rowloom.operators.columns import columns_to_row, columns_to_rows, columns_together, delimited, valueless
from rowloom.operators.lookup import (
    count_columns,
    lookup_composite_range,
    lookup_composite_slice,
    lookup_dispatch,
    lookup_filtered,
    lookup_range,
    lookup_row,
    lookup_slice,
    multi_get,
    state_query,
)
from rowloom.operators.mappers import (
    Write,
    map_composite_column,
    map_composite_key,
    map_counter,
    map_custom,
    map_default,
    map_requests,
)
from rowloom.operators.rejects import (
    ErrorPolicy,
    counter_rules,
    key_rules,
    keyspace_rules,
    lookup_or_empty,
    split_rejects,
    with_reason,
)
from rowloom.operators.resolve import fold_counters, latest_versions, live, resolve_latest
