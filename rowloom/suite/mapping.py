"""Queries: rows to cells, and columns back to rows."""

from pyspark.sql import functions as F

from rowloom.functions import composite
from rowloom.operators import (
    Write,
    columns_to_rows,
    delimited,
    lookup_row,
    map_composite_column,
    map_composite_key,
    map_counter,
    map_custom,
    map_default,
    map_requests,
    split_words,
    valueless,
)
from rowloom.plans import SkewOptions
from rowloom.suite.registry import query


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS row_key, u.column_name, u.value
    FROM orders, LATERAL (VALUES
        ('o_orderkey', CAST(o_orderkey AS VARCHAR)), ('o_custkey', coalesce(CAST(o_custkey AS VARCHAR), '')),
        ('o_orderstatus', coalesce(o_orderstatus, '')), ('o_orderpriority', coalesce(o_orderpriority, ''))
    ) u(column_name, value)""")
def map_default_orders(t):
    return map_default(t.orders, "o_orderkey", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query("""
    SELECT CAST(l_orderkey AS VARCHAR) AS k0, CAST(l_linenumber AS VARCHAR) AS k1, 'l_partkey' AS column_name,
           CAST(l_partkey AS VARCHAR) AS value FROM lineitem
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), 'l_suppkey',
           CAST(l_suppkey AS VARCHAR) FROM lineitem
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), 'l_returnflag',
           l_returnflag FROM lineitem""")
def map_composite_key_lineitem(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    cells = map_composite_key(rows, ["l_orderkey", "l_linenumber"])
    return cells.select(F.col("row_key")[0].alias("k0"), F.col("row_key")[1].alias("k1"), "column_name", "value")


@query("""
    SELECT 'returns' AS keyspace, l_returnflag AS "table", l_suppkey AS row_key, 'orderkey' AS column_name,
           l_orderkey AS value FROM lineitem
    UNION ALL SELECT 'returns', l_returnflag, l_suppkey, 'partkey', l_partkey FROM lineitem""")
def map_custom_typed(t):
    write = Write("l_shipdate", "l_orderkey", F.col("l_returnflag"), "returns")
    columns = {"orderkey": F.col("l_orderkey"), "partkey": F.col("l_partkey")}
    cells = map_custom(t.lineitem, F.col("l_suppkey"), columns, write)
    return cells.select("keyspace", "table", "row_key", "column_name", "value")


@query("""
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS "table", 'props' AS column_name, props AS value,
           event_id AS seq, value < 2 AS is_deleted FROM events""")
def map_custom_stream(t):
    write = Write("ts", "event_id", F.col("event_type"), delete_when=F.col("value") < 2)
    cells = map_custom(t.events, F.col("user_id").cast("string"), {"props": F.col("props")}, write)
    return cells.select("row_key", "table", "column_name", "value", "seq", "is_deleted")


def order_name():
    return composite(status="o_orderstatus", priority="o_orderpriority")


@query("""
    SELECT o_custkey AS row_key, o_orderstatus AS c0, o_orderpriority AS c1, CAST(o_orderkey AS VARCHAR) AS value
    FROM orders""")
def map_composite_column_orders(t):
    value = F.col("o_orderkey").cast("string")
    cells = map_composite_column(t.orders, F.col("o_custkey"), order_name(), value)
    return cells.select("row_key", F.col("column_name.status").alias("c0"), F.col("column_name.priority").alias("c1"),
                        "value")


@query("""
    SELECT CAST(l_suppkey AS VARCHAR) AS row_key, l_returnflag AS column_name, CAST(l_quantity AS BIGINT) AS amount
    FROM lineitem
    UNION ALL SELECT CAST(l_suppkey AS VARCHAR), l_linestatus, CAST(l_quantity AS BIGINT) FROM lineitem""")
def map_counter_lineitem(t):
    rows = t.lineitem.select("l_suppkey", F.col("l_quantity").cast("long").alias("n"), "l_returnflag", "l_linestatus")
    return map_counter(rows, "l_suppkey", "n").select("row_key", "column_name", "amount")


@query("""
    SELECT DISTINCT p_partkey AS id, l_partkey AS part, l_suppkey AS supplier
    FROM part JOIN lineitem ON l_partkey = p_partkey""")
def valueless_edges(t):
    lines = t.lineitem.select(F.col("l_partkey").alias("row_key"), F.col("l_suppkey").alias("column_name"))
    asked = t.part.select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("row_key"))
    found = lookup_row(asked, lines.distinct(), SkewOptions(right_keys=lines))
    return valueless(found, "part", "supplier", "id")


@query("""
    WITH p AS (SELECT page_id, regexp_split_to_array(url, '[/?&=]') AS parts FROM pages),
    u AS (SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM p),
    last AS (SELECT page_id, max(i) AS n FROM u WHERE part <> '' GROUP BY page_id)
    SELECT u.page_id AS id, CAST(u.page_id AS VARCHAR) AS page, part
    FROM u JOIN last USING (page_id) WHERE i <= n""")
def delimited_split(t):
    cells = map_default(t.pages, "page_id", ["page_id", "url"])
    asked = t.pages.select(F.col("page_id").alias("id"), F.col("page_id").cast("string").alias("row_key"))
    return delimited(lookup_row(asked, cells), "url", "[/?&=]", "page", "part", "id")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS customer, 'name' AS what, length(c_name) AS n FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'segment', length(c_mktsegment) FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'short segment', length(c_mktsegment) FROM customer
    WHERE length(c_mktsegment) < 9""")
def columns_to_rows_custom(t):
    cells = map_custom(t.customer, F.col("c_custkey").cast("string"),
                       {"name": F.col("c_name"), "segment": F.col("c_mktsegment")})
    asked = t.customer.select(F.col("c_custkey").cast("string").alias("row_key"))
    found = lookup_row(asked, cells)
    size = F.length("value").cast("long")
    row = F.struct(F.col("row_key").alias("customer"), F.col("column_name").alias("what"), size.alias("n"))
    short = F.struct(F.col("row_key").alias("customer"), F.lit("short segment").alias("what"), size.alias("n"))
    is_short = (F.col("column_name") == "segment") & (size < 9)
    return columns_to_rows(found, F.when(is_short, F.array(row, short)).otherwise(F.array(row)))


@query("""
    SELECT doc_id, w AS word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) WHERE w <> ''""")
def word_split(t):
    return split_words(t.documents, "text", keep=["doc_id"])


@query("""
    SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS row_key,
           CASE WHEN o_orderstatus = 'F' THEN 'c_name' END AS first_name,
           CASE WHEN o_orderstatus = 'O' THEN 'c_m' END AS "start",
           CASE WHEN o_orderstatus = 'O' THEN 'c_n~' END AS "end" FROM orders""")
def map_requests_orders(t):
    asked = order_requests(t)
    return asked.select("id", "row_key", F.get("slice", F.lit(0)).alias("first_name"), "start", "end")


def order_requests(t):
    """Each order asks for its customer: by names, by range or whole, depending on its status."""
    rows = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus")
    names = F.array(F.lit("c_name"), F.lit("c_mktsegment"), F.lit("c_absent"))
    status = F.col("o_orderstatus")
    asked = map_requests(rows, F.col("o_custkey").cast("string"), F.when(status == "F", names),
                         F.when(status == "O", F.lit("c_m")), F.when(status == "O", F.lit("c_n~")))
    return asked.select("id", "row_key", "slice", "start", "end")
