"""Queries: upserts, deletes, expiry, routing, counters and rejects."""

from pyspark.sql import functions as F

from rowloom.operators import (
    ErrorPolicy,
    Write,
    columns_together,
    counter_rules,
    fold_counters,
    key_rules,
    keyspace_rules,
    lookup_row,
    map_counter,
    map_custom,
    map_default,
    resolve_latest,
    split_rejects,
)
from rowloom.session import shared_dir
from rowloom.sources import CellStore, CounterStore
from rowloom.suite.registry import query

LATEST_EVENT = """latest AS (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS nth FROM events)"""


def event_cells(events, **write):
    """A row per user, a column per event type, the props as value; later events win."""
    entry = F.array(F.struct(F.col("event_type").alias("column_name"), F.col("props").alias("value")))
    return map_custom(events, F.col("user_id").cast("string"), entry, Write("ts", "event_id", **write))


def shown(cells):
    return cells.select("row_key", "column_name", "value")


@query(f"""WITH {LATEST_EVENT}
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS column_name, props AS value FROM latest WHERE nth = 1""")
def upsert_latest(t):
    return shown(resolve_latest(event_cells(t.events)))


@query(f"""WITH {LATEST_EVENT}
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS column_name, props AS value
    FROM latest WHERE nth = 1 AND NOT value < 2""")
def delete_columns(t):
    return shown(resolve_latest(event_cells(t.events, delete_when=F.col("value") < 2)))


@query(f"""WITH {LATEST_EVENT}
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS column_name, props AS value
    FROM latest WHERE nth = 1 AND ts + INTERVAL 1 DAY > TIMESTAMP '2024-01-30 00:00:00'""")
def ttl_live(t):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    return shown(resolve_latest(event_cells(t.events, ttl_seconds=86400), as_of))


@query("""
    SELECT event_type AS "table", CAST(user_id AS VARCHAR) AS row_key, 'props' AS column_name,
           arg_max(props, event_id) AS value FROM events GROUP BY 1, 2""")
def route_tables(t):
    store = CellStore(t.spark, shared_dir(t.spark, "route"))
    write = Write("ts", "event_id", F.col("event_type"), "events")
    store.put(t.events, lambda rows: map_custom(rows, F.col("user_id").cast("string"), {"props": F.col("props")}, write),
              0, many_tables=True)
    return store.cells("events").select("table", "row_key", "column_name", "value")


@query("""
    SELECT 'sales' AS keyspace, 'customer' AS "table", CAST(c_custkey AS VARCHAR) AS row_key, 'c_name' AS column_name,
           c_name AS value FROM customer
    UNION ALL SELECT 'sales', 'customer', CAST(c_custkey AS VARCHAR), 'c_mktsegment', c_mktsegment FROM customer
    UNION ALL SELECT 'supply', 'supplier', CAST(s_suppkey AS VARCHAR), 's_name', s_name FROM supplier
    UNION ALL SELECT 'supply', 'supplier', CAST(s_suppkey AS VARCHAR), 's_nationkey', CAST(s_nationkey AS VARCHAR)
    FROM supplier""")
def put_batch(t):
    store = CellStore(t.spark, shared_dir(t.spark, "put"))
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    customers = Write(at, table="customer", keyspace="sales")
    suppliers = Write(at, table="supplier", keyspace="supply")
    store.put(t.customer, lambda rows: map_default(rows, "c_custkey", ["c_name", "c_mktsegment"], customers), 0)
    store.put(t.supplier, lambda rows: map_default(rows, "s_suppkey", ["s_name", "s_nationkey"], suppliers), 1)
    return store.cells()


@query(f"""WITH {LATEST_EVENT}
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS column_name, props AS value
    FROM latest WHERE nth = 1 AND NOT value < 2""")
def compacted_store(t):
    """Two batches, the later events first; both are folded into a snapshot that keeps deletes."""
    store = CellStore(t.spark, shared_dir(t.spark, "compact"))
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    mapper = lambda rows: event_cells(rows, delete_when=F.col("value") < 2)
    store.put(t.events.where(late), mapper, 0)
    store.compact(keep_last=0)
    store.put(t.events.where(~late), mapper, 1)
    store.compact(keep_last=0)
    return shown(store.cells())


@query(f"""WITH {LATEST_EVENT}
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS column_name, props AS value
    FROM latest WHERE nth = 1 AND NOT value < 2""")
def compacted_often(t):
    """Four batches with a compaction after each: a base, deltas after it, and no replaced file left."""
    store = CellStore(t.spark, shared_dir(t.spark, "often"))
    mapper = lambda rows: event_cells(rows, delete_when=F.col("value") < 2)
    for batch_id in range(4):
        store.put(t.events.where(F.col("event_id") % 4 == batch_id), mapper, batch_id)
        store.compact(keep_last=0, full=batch_id == 0)
        store.vacuum()
    return shown(store.cells())


@query(f"""WITH {LATEST_EVENT}
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS column_name, props AS value
    FROM latest WHERE nth = 1 AND NOT value < 2""")
def purged_store(t):
    """Deleted cells are dropped once no open batch can hold an older version of them."""
    store = CellStore(t.spark, shared_dir(t.spark, "purge"))
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    mapper = lambda rows: event_cells(rows, delete_when=F.col("value") < 2)
    store.put(t.events.where(late), mapper, 0)
    store.put(t.events.where(~late), mapper, 1)
    store.compact(keep_last=0, purge_before=F.lit("2025-01-01").cast("timestamp_ntz"))
    store.vacuum()
    return shown(store.versions())


@query("""
    SELECT lower(c_mktsegment) AS keyspace, CAST(c_custkey AS VARCHAR) AS row_key, 'c_name' AS column_name, c_name AS value
    FROM customer WHERE c_mktsegment = 'FURNITURE'""")
def keyspace_case(t):
    """Keyspaces are the same in any case; the table is routed by the data."""
    store = CellStore(t.spark, shared_dir(t.spark, "case"))
    write = Write(F.lit("2024-01-01").cast("timestamp_ntz"), table="customer", keyspace=F.col("c_mktsegment"))
    store.put(t.customer, lambda rows: map_default(rows, "c_custkey", ["c_name"], write), 0, many_tables=True)
    return store.cells("Furniture").select("keyspace", "row_key", "column_name", "value")


@query("""
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS column_name, CAST(sum(n) AS BIGINT) AS amount
    FROM (SELECT user_id, event_type, CAST(floor(value) AS BIGINT) AS n FROM events) GROUP BY 1, 2""")
def counter_sum(t):
    rows = t.events.select("user_id", "event_type", F.floor("value").alias("n"))
    return fold_counters(map_counter(rows, "user_id", "n")).select("row_key", "column_name", "amount")


@query("""
    SELECT column_name, row_key, CAST(2 * sum(n) AS BIGINT) AS amount FROM (
        SELECT CAST(l_suppkey AS VARCHAR) AS row_key, l_returnflag AS column_name, CAST(l_quantity AS BIGINT) AS n
        FROM lineitem
        UNION ALL SELECT CAST(l_suppkey AS VARCHAR), l_linestatus, CAST(l_quantity AS BIGINT) FROM lineitem)
    GROUP BY 1, 2""")
def increment_batches(t):
    """Two batches with the same increments count twice; a batch that is written again does not."""
    store = CounterStore(t.spark, shared_dir(t.spark, "increment"))
    rows = t.lineitem.select("l_suppkey", F.col("l_quantity").cast("long").alias("n"), "l_returnflag", "l_linestatus")
    for batch_id in (0, 1, 1):
        store.increment(rows, lambda df: map_counter(df, "l_suppkey", "n"), batch_id)
    return store.counters().select("row_key", "column_name", "amount")


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'ok' AS outcome FROM orders""")
def put_then_emit(t):
    store = CellStore(t.spark, shared_dir(t.spark, "emit"))
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    write = Write(F.lit("2024-01-01").cast("timestamp_ntz"), table="orders")
    return store.put_then_emit(rows, lambda df: map_default(df, "o_orderkey", write=write), 0, "outcome", "ok")


@query("""
    SELECT reason, count(*) AS n FROM (
        SELECT CASE WHEN event_type = 'error' THEN 'null_row_key' WHEN value < 2 THEN 'small_value' ELSE 'good' END
        AS reason FROM events) GROUP BY 1""")
def rejects(t):
    """Good and rejected rows, counted by reason; the first rule that holds gives the reason."""
    rows = t.events.withColumn("row_key", F.when(F.col("event_type") != "error", F.col("user_id").cast("string")))
    good, bad = split_rejects(rows, {**key_rules("row_key"), "small_value": F.col("value") < 2})
    labels = good.select(F.lit("good").alias("reason")).unionByName(bad.select("reason"))
    return labels.groupBy("reason").agg(F.count("*").alias("n"))


@query("""
    SELECT part, count(*) AS n FROM (
        SELECT CASE WHEN event_type = 'error' THEN 'reject' WHEN value < 2 THEN 'empty' WHEN props IS NULL THEN NULL
        ELSE 'good' END AS part FROM events) GROUP BY 1""")
def error_policy(t):
    """Rows sent on, reported and passed empty, by the action of their reason."""
    rows = t.events.withColumn("row_key", F.when(F.col("event_type") != "error", F.col("user_id").cast("string")))
    rules = {**key_rules("row_key"), "small_value": F.col("value") < 2, "no_props": F.col("props").isNull()}
    policy = ErrorPolicy().reject_on("null_row_key").empty_on("small_value").fail_on("no_props")
    parts = policy.apply(rows, rules, write_once=True)
    named = [part.select(F.lit(name).alias("part")) for name, part in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2]).groupBy("part").agg(F.count("*").alias("n"))


@query("""
    SELECT CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'good' ELSE 'unknown_keyspace' END AS reason,
           count(*) AS n FROM customer GROUP BY 1""")
def unknown_keyspace(t):
    rows = t.customer.withColumn("keyspace", F.col("c_mktsegment"))
    good, bad = split_rejects(rows, keyspace_rules(["furniture", "Machinery"]))
    labels = good.select(F.lit("good").alias("reason")).unionByName(bad.select("reason"))
    return labels.groupBy("reason").agg(F.count("*").alias("n"))


@query("""
    SELECT reason, count(*) AS n FROM (
        SELECT CASE WHEN event_type = 'error' THEN 'null_counter_column' WHEN value < 2 THEN 'null_amount'
        ELSE 'good' END AS reason FROM events) GROUP BY 1""")
def counter_rejects(t):
    name = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    amount = F.when(F.col("value") >= 2, F.floor("value")).alias("n")
    increments = map_counter(t.events.select("user_id", name, amount), "user_id", "n")
    good, bad = split_rejects(increments, counter_rules(increments))
    labels = good.select(F.lit("good").alias("reason")).unionByName(bad.select("reason"))
    return labels.groupBy("reason").agg(F.count("*").alias("n"))


def order_cells(rows, value="o_orderpriority", seq=0):
    """Orders as wide rows: a customer has a column for each order."""
    entry = F.array(F.struct(F.col("o_orderkey").cast("string").alias("column_name"), F.col(value).alias("value")))
    write = Write(F.lit("2024-01-01").cast("timestamp_ntz"), F.lit(seq), table="orders")
    return map_custom(rows, F.col("o_custkey").cast("string"), entry, write)


@query("""SELECT CAST(o_custkey AS VARCHAR) AS row_key, CAST(o_orderkey AS VARCHAR) AS column_name,
        CASE WHEN o_orderstatus = 'P' THEN o_orderstatus ELSE o_orderpriority END AS value FROM orders""")
def compacted_ranges(t):
    """Small sorted files by key range; scattered changes wait in the delta, then a range with many is rewritten."""
    store = CellStore(t.spark, shared_dir(t.spark, "ranges"), file_rows=2000)
    store.put(t.orders, order_cells, 0)
    store.compact(keep_last=0)
    changed = t.orders.where("o_orderstatus = 'P'")
    for batch_id, part in ((1, F.col("o_custkey") % 3 != 0), (2, F.col("o_custkey") % 3 == 0)):
        store.put(changed.where(part), lambda rows, n=batch_id: order_cells(rows, "o_orderstatus", n), batch_id)
        store.compact(keep_last=0)
        store.vacuum()
    return store.cells().select("row_key", "column_name", "value")


@query("""SELECT n_nationkey AS id, CAST(n_nationkey AS VARCHAR) AS row_key, CAST(o_orderkey AS VARCHAR) AS column_name,
        CASE WHEN o_orderstatus = 'P' THEN o_orderstatus ELSE o_orderpriority END AS value
    FROM nation JOIN orders ON o_custkey = n_nationkey""")
def lookup_store_indexed(t):
    """Few rows of a large store: only files whose key bounds hold one are opened."""
    store = CellStore(t.spark, shared_dir(t.spark, "indexed"), file_rows=2000)
    store.put(t.orders, order_cells, 0)
    store.compact(keep_last=0)
    store.put(t.orders.where("o_orderstatus = 'P'"), lambda rows: order_cells(rows, "o_orderstatus", 1), 1)
    asked = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_nationkey").cast("string").alias("row_key"))
    return store.lookup(asked, lookup_row, table="orders").select("id", "row_key", "column_name", "value")


@query("""SELECT c_custkey AS id, name, next_name, next_value FROM (
        SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS name, lead(CAST(o_orderkey AS VARCHAR)) OVER w AS next_name,
            lead(o_orderpriority) OVER w AS next_value
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS VARCHAR)))
    JOIN customer ON c_custkey = o_custkey WHERE next_name IS NOT NULL""")
def columns_together_pairs(t):
    """Each column of a customer's row of orders with the one after it; their names are not known beforehand."""
    import pyarrow as pa

    def pairs(request, batches):
        last = None
        for batch in batches:
            names, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            before = [last, *names[:-1]]
            first = 1 if last is None else 0
            last = names[-1]
            columns = {"id": [request[0]] * (len(names) - first), "name": before[first:], "next_name": names[first:],
                       "next_value": values[first:]}
            kinds = [("id", pa.int64()), ("name", pa.string()), ("next_name", pa.string()), ("next_value", pa.string())]
            yield pa.RecordBatch.from_pydict(columns, schema=pa.schema(kinds))

    cells = resolve_latest(order_cells(t.orders)).select("row_key", "column_name", "value")
    asked = t.customer.select(F.col("c_custkey").cast("long").alias("id"), F.col("c_custkey").cast("string").alias("row_key"))
    return columns_together(lookup_row(asked, cells), "id", pairs, "id long, name string, next_name string, next_value string")
