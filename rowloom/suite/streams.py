"""Queries: the same results by way of streams."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom import jobs
from rowloom.operators import ErrorPolicy, Write, lookup_row, map_counter, map_default, split_words
from rowloom.session import shared_dir
from rowloom.sources import Aggregate, BatchLog, CellStore, CounterStore, StateOptions, StateStore
from rowloom.sources.streams import file_stream
from rowloom.streaming import (
    increment_stream,
    lookup_stream,
    put_running_count,
    put_stream,
    running_rows,
    state_stream,
)
from rowloom.suite.lookups import CUSTOMER, CUSTOMER_CELLS, FOUND, ORDER_REQUESTS
from rowloom.suite.registry import SQL, query
from rowloom.suite.writes import LATEST_EVENT, event_cells, shown


def stream_of(t, name):
    """A given table, laid out in eight files, as a stream of four micro-batches."""
    folder = shared_dir(t.spark, f"files-{name}")
    table = getattr(t, name)
    table.repartition(8).write.parquet(folder)
    return file_stream(t.spark, folder, table.schema, max_files=2)


@query(SQL["upsert_latest"])
def stream_upsert(t):
    root = shared_dir(t.spark, "stream-upsert")
    store = CellStore(t.spark, f"{root}/store")
    put_stream(stream_of(t, "events"), store, event_cells, f"{root}/checkpoint").awaitTermination()
    return shown(store.cells())


@query(SQL["delete_columns"])
def stream_delete(t):
    root = shared_dir(t.spark, "stream-delete")
    store = CellStore(t.spark, f"{root}/store")
    mapper = lambda rows: event_cells(rows, delete_when=F.col("value") < 2)
    put_stream(stream_of(t, "events"), store, mapper, f"{root}/checkpoint").awaitTermination()
    return shown(store.cells())


@query(f"""WITH {LATEST_EVENT.replace('FROM events', "FROM events WHERE event_type <> 'error'")}
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS column_name, props AS value, 'good' AS kind
    FROM latest WHERE nth = 1
    UNION ALL SELECT CAST(event_id AS VARCHAR), 'error', 'error_event', 'rejected' FROM events
    WHERE event_type = 'error'""")
def stream_rejects(t):
    """Errors are rejected and reported beside the good rows."""
    root = shared_dir(t.spark, "stream-rejects")
    store = CellStore(t.spark, f"{root}/store")
    schema = t.events.select("event_id", F.lit("").alias("reason")).schema
    log = BatchLog(t.spark, f"{root}/rejects", schema)
    rules = {"error_event": F.col("event_type") == "error"}
    put_stream(stream_of(t, "events"), store, event_cells, f"{root}/checkpoint", rules=rules,
               policy=ErrorPolicy().reject_on("error_event"), report=log.append).awaitTermination()
    rejected = log.read().select(F.col("event_id").cast("string").alias("row_key"), F.lit("error").alias("column_name"),
                                 F.col("reason").alias("value"), F.lit("rejected").alias("kind"))
    return shown(store.cells()).withColumn("kind", F.lit("good")).unionByName(rejected)


@query(SQL["counter_sum"])
def stream_counter(t):
    root = shared_dir(t.spark, "stream-counter")
    store = CounterStore(t.spark, f"{root}/store")

    def mapper(rows):
        return map_counter(rows.select("user_id", "event_type", F.floor("value").alias("n")), "user_id", "n")

    increment_stream(stream_of(t, "events"), store, mapper, f"{root}/checkpoint").awaitTermination()
    return store.counters().select("row_key", "column_name", "amount")


@query(SQL["counter_sum"])
def stream_replay(t):
    """The same where a batch fails after its write: the stream stops, and runs the batch again from its checkpoint."""
    root = shared_dir(t.spark, "stream-replay")
    store = CounterStore(t.spark, f"{root}/store")
    failed = []

    def mapper(rows):
        return map_counter(rows.select("user_id", "event_type", F.floor("value").alias("n")), "user_id", "n")

    def fail_once(rows, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    rows = stream_of(t, "events")
    start = lambda: increment_stream(rows, store, mapper, f"{root}/checkpoint", then=fail_once)
    try:
        start().awaitTermination()
    except StreamingQueryException:
        start().awaitTermination()
    if not failed:
        raise RuntimeError("no batch was replayed")
    return store.counters().select("row_key", "column_name", "amount")


@query(SQL["persistent_word_count"])
def stream_word_count(t):
    root = shared_dir(t.spark, "stream-words")
    state = jobs.word_state(t.spark, root, StateOptions(ttl_seconds=None))
    words = split_words(stream_of(t, "documents"), "text")
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    state_stream(words, state, at, f"{root}/checkpoint").awaitTermination()
    return jobs.word_cells(state)


@query("""WITH counts AS (SELECT CAST(user_id AS VARCHAR) AS k, count(*) AS n FROM events GROUP BY 1)
    SELECT k AS row_key, 'user_id' AS column_name, k AS value FROM counts
    UNION ALL SELECT k, 'count', CAST(n AS VARCHAR) FROM counts""")
def stream_running_count(t):
    root = shared_dir(t.spark, "stream-running")
    store = CellStore(t.spark, f"{root}/store")
    put_running_count(stream_of(t, "events"), "user_id", store, "users", f"{root}/checkpoint").awaitTermination()
    return shown(store.cells(table="users"))


def arriving(t, name, order):
    """A given table as a stream of four micro-batches of two files, laid out one after the other in ascending order."""
    folder, table = shared_dir(t.spark, f"arriving-{name}"), getattr(t, name)
    cuts = [None, *table.agg(F.percentile_approx(order, [0.25, 0.5, 0.75])).first()[0], None]
    for low, high in zip(cuts, cuts[1:]):
        above = F.lit(True) if low is None else F.col(order) > low
        upto = F.lit(True) if high is None else F.col(order) <= high
        table.where(above & upto).repartition(2).write.mode("append").parquet(folder)
    return file_stream(t.spark, folder, table.schema, max_files=2)


@query(SQL["running_count"])
def stream_running_rows(t):
    """Every event as it comes, with the number of its user's events so far; the batches are counted on a running state."""
    root = shared_dir(t.spark, "stream-running-rows")
    events = arriving(t, "events", "event_id").select("event_id", "user_id")
    found = running_rows(events, "user_id", "event_id", root, f"{root}/checkpoint", "seen")
    found.query.awaitTermination()
    return found.rows.read().select("event_id", "user_id", "seen")


@query(SQL["global_count"])
def stream_global_count(t):
    root = shared_dir(t.spark, "stream-global")
    state = StateStore(t.spark, root, [], {"n": Aggregate("count")}, StateOptions(ttl_seconds=None))
    state_stream(stream_of(t, "events"), state, "ts", f"{root}/checkpoint").awaitTermination()
    return state.current().select(F.col("key")[0].alias("key"), "n")


@query(f"WITH {CUSTOMER_CELLS}, {ORDER_REQUESTS} {FOUND}")
def stream_lookup(t):
    """Orders as a stream of requests; the customers are read from a store, anew for each batch."""
    root = shared_dir(t.spark, "stream-lookup")
    store = CellStore(t.spark, f"{root}/store")
    write = Write(F.lit("2024-01-01").cast("timestamp_ntz"), table="customer")
    store.put(t.customer, lambda rows: map_default(rows, "c_custkey", CUSTOMER, write), 0)
    asked = stream_of(t, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("row_key")
    )
    schema = T.StructType([T.StructField("id", T.LongType())])
    for name in ("row_key", "column_name", "value"):
        schema = schema.add(name, T.StringType())
    out = BatchLog(t.spark, f"{root}/found", schema)
    lookup_stream(asked, lambda batch: store.lookup(batch, lookup_row, table="customer"), out.append,
                  f"{root}/checkpoint").awaitTermination()
    return out.read().select("id", "row_key", "column_name", "value")
