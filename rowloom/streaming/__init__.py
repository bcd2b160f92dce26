from rowloom.streaming.sinks import (
    each_batch,
    increment_stream,
    lookup_stream,
    put_running_count,
    put_stream,
    running_count_stream,
    running_rows,
    state_stream,
)

__all__ = ["each_batch", "increment_stream", "lookup_stream", "put_running_count", "put_stream",
           "running_count_stream", "running_rows", "state_stream"]
