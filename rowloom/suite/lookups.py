"""Queries: lookups by key, names, ranges and composite ranges."""

from pyspark.sql import functions as F

from rowloom import jobs
from rowloom.functions import composite
from rowloom.operators import (
    ErrorPolicy,
    columns_to_row,
    count_columns,
    count_distinct,
    lookup_composite_range,
    lookup_composite_slice,
    lookup_dispatch,
    lookup_filtered,
    lookup_or_empty,
    lookup_range,
    lookup_row,
    lookup_slice,
    map_default,
    resolve_latest,
    state_query,
)
from rowloom.operators.mappers import Write, map_composite_column
from rowloom.plans import SkewOptions
from rowloom.suite.mapping import order_name, order_requests
from rowloom.suite.registry import query

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]

CUSTOMER_CELLS = """cells AS (
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, u.column_name, u.value FROM customer, LATERAL (VALUES
        ('c_custkey', CAST(c_custkey AS VARCHAR)), ('c_name', c_name),
        ('c_nationkey', CAST(c_nationkey AS VARCHAR)), ('c_mktsegment', c_mktsegment)) u(column_name, value))"""

ORDER_REQUESTS = """asked AS (
    SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS row_key, o_orderstatus FROM orders)"""

FOUND = "SELECT a.id, a.row_key, c.column_name, c.value FROM asked a JOIN cells c ON a.row_key = c.row_key"

LABEL_CELLS = """cells AS (
    SELECT CAST(doc_id AS VARCHAR) AS row_key, 'quality' AS column_name, CAST(quality AS VARCHAR) AS value FROM labels
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'toxic', CAST(toxic AS VARCHAR) FROM labels)"""


def customer_cells(t):
    return map_default(t.customer, "c_custkey", CUSTOMER)


def customer_requests(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("row_key"))


def label_cells(t):
    return map_default(t.labels, "doc_id", ["quality", "toxic"])


def document_requests(t):
    return t.documents.select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("row_key"))


@query(f"""
    WITH {LABEL_CELLS}
    SELECT d.doc_id AS id, c.row_key, c.column_name, c.value
    FROM documents d JOIN cells c ON c.row_key = CAST(d.doc_id AS VARCHAR)""", "lookup_row")
def row_of_labels(t):
    return lookup_row(document_requests(t), label_cells(t))


@query(f"WITH {CUSTOMER_CELLS}, {ORDER_REQUESTS} {FOUND} AND c.column_name IN ('c_name', 'c_mktsegment', 'c_absent')",
       "lookup_slice")
def slice_of_customer(t):
    return lookup_slice(customer_requests(t), customer_cells(t), ["c_name", "c_mktsegment", "c_absent"])


@query(f"""WITH {CUSTOMER_CELLS}, {ORDER_REQUESTS} {FOUND}
    AND ((a.o_orderstatus = 'F' AND c.column_name IN ('c_name', 'c_mktsegment'))
         OR (a.o_orderstatus = 'O' AND c.column_name = 'c_nationkey'))""")
def lookup_slice_per_request(t):
    status = F.col("o_orderstatus")
    wanted = F.when(status == "F", F.array(F.lit("c_name"), F.lit("c_mktsegment"), F.lit("c_name"))).when(
        status == "O", F.array(F.lit("c_nationkey"), F.lit("c_absent"))
    )
    asked = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("row_key"),
                            wanted.alias("slice"))
    found = lookup_slice(asked, customer_cells(t))
    return found.select("id", "row_key", "column_name", "value")


@query(f"WITH {CUSTOMER_CELLS}, {ORDER_REQUESTS} {FOUND} AND c.column_name BETWEEN 'c_m' AND 'c_n~'", "lookup_range")
def range_of_customer(t):
    return lookup_range(customer_requests(t), customer_cells(t), "c_m", "c_n~")


@query(f"""WITH {CUSTOMER_CELLS}, {ORDER_REQUESTS} {FOUND} AND a.o_orderstatus = 'O'
    AND c.column_name BETWEEN 'c_m' AND 'c_n~'""")
def lookup_range_per_request(t):
    asked = order_requests(t).drop("slice")
    return lookup_range(asked, customer_cells(t)).select("id", "row_key", "column_name", "value")


@query(f"""WITH {CUSTOMER_CELLS}, {ORDER_REQUESTS} {FOUND} AND CASE a.o_orderstatus
        WHEN 'F' THEN c.column_name IN ('c_name', 'c_mktsegment', 'c_absent')
        WHEN 'O' THEN c.column_name BETWEEN 'c_m' AND 'c_n~' ELSE TRUE END""", "lookup_dispatch")
def dispatch_by_status(t):
    found = lookup_dispatch(order_requests(t), customer_cells(t))
    return found.select("id", "row_key", "column_name", "value")


@query(f"""WITH {CUSTOMER_CELLS}, {ORDER_REQUESTS} {FOUND} AND a.o_orderstatus <> 'P'
    UNION ALL SELECT id, row_key, '', '' FROM asked WHERE o_orderstatus = 'P'""", "lookup_filtered")
def filtered_by_status(t):
    asked = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("row_key"),
                            "o_orderstatus")
    found = lookup_filtered(asked, customer_cells(t), F.col("o_orderstatus") != "P", ["column_name", "value"])
    return found.drop("o_orderstatus")


@query(f"""WITH {LABEL_CELLS}, asked AS (
        SELECT doc_id AS id, CASE WHEN lang = 'en' THEN CAST(doc_id AS VARCHAR) END AS row_key FROM documents)
    {FOUND} UNION ALL SELECT id, row_key, '', '' FROM asked WHERE row_key IS NULL""")
def lookup_empty_on_error(t):
    key = F.when(F.col("lang") == "en", F.col("doc_id").cast("string"))
    asked = t.documents.select(F.col("doc_id").alias("id"), key.alias("row_key"))
    rules = {"null_row_key": F.col("row_key").isNull()}
    policy = ErrorPolicy().empty_on("null_row_key")
    cells = label_cells(t)
    return lookup_or_empty(asked, rules, policy, lambda good: lookup_row(good, cells), ["column_name", "value"])


@query(f"""
    WITH {LABEL_CELLS}
    SELECT d.doc_id AS id, CAST(d.doc_id AS VARCHAR) AS row_key, c.column_name, c.value
    FROM documents d LEFT JOIN cells c ON c.row_key = CAST(d.doc_id AS VARCHAR)""", "state_query")
def labels_or_nothing(t):
    return state_query(document_requests(t), label_cells(t))


@query(f"""
    WITH {LABEL_CELLS}
    SELECT d.doc_id AS id, CAST(d.doc_id AS VARCHAR) AS row_key, count(c.column_name) AS cols_n
    FROM documents d LEFT JOIN cells c ON c.row_key = CAST(d.doc_id AS VARCHAR) GROUP BY 1, 2""")
def state_query_counts(t):
    return count_columns(document_requests(t), label_cells(t))


COMPOSITE_CELLS = """cells AS (
    SELECT o_custkey AS row_key, o_orderstatus AS c0, o_orderpriority AS c1, max(o_orderkey) AS value
    FROM orders GROUP BY 1, 2, 3)"""


def composite_cells(t):
    """The current cells of the orders, and where to look for customers with very many orders."""
    written = map_composite_column(t.orders, F.col("o_custkey"), order_name(), F.col("o_orderkey"),
                                   Write(F.lit("2000-01-01").cast("timestamp_ntz"), "o_orderkey"))
    return resolve_latest(written, requests=composite_requests(t)).select("row_key", "column_name", "value"), SkewOptions(right_keys=written)


def composite_requests(t):
    return t.customer.select(F.col("c_custkey").alias("row_key"))


def composite_result(found):
    return found.select("row_key", F.col("column_name.status").alias("c0"), F.col("column_name.priority").alias("c1"),
                        "value")


@query(f"""WITH {COMPOSITE_CELLS}
    SELECT c.* FROM customer JOIN cells c ON c_custkey = c.row_key
    WHERE c0 = 'F' AND c1 BETWEEN '2-HIGH' AND '3-MEDIUM'""", "lookup_composite_range")
def composite_range_of_orders(t):
    cells, options = composite_cells(t)
    bounds = ("F", "2-HIGH"), ("O", "3-MEDIUM")
    return composite_result(lookup_composite_range(composite_requests(t), cells, *bounds, options))


@query(f"""WITH {COMPOSITE_CELLS}
    SELECT c.* FROM customer JOIN cells c ON c_custkey = c.row_key
    WHERE CASE c_mktsegment WHEN 'FURNITURE' THEN c0 BETWEEN 'F' AND 'O'
        WHEN 'MACHINERY' THEN c1 BETWEEN '2-HIGH' AND '3-MEDIUM'
        ELSE c0 = 'F' AND c1 BETWEEN '2-HIGH' AND '3-MEDIUM' END""")
def lookup_composite_range_per_request(t):
    segment = F.col("c_mktsegment")
    first = F.when(segment != "MACHINERY", F.lit("F"))
    second = F.when(segment != "FURNITURE", F.lit("2-HIGH"))
    asked = t.customer.select(
        F.col("c_custkey").alias("row_key"),
        composite(status=first, priority=second).alias("start"),
        composite(status=F.lit("O"), priority=F.lit("3-MEDIUM")).alias("end"),
    )
    cells, options = composite_cells(t)
    return composite_result(lookup_composite_range(asked, cells, options=options))


@query(f"""WITH {COMPOSITE_CELLS}
    SELECT c.* FROM customer JOIN cells c ON c_custkey = c.row_key
    WHERE c0 = 'P' OR (c0 = 'O' AND c1 = '5-LOW')""", "lookup_composite_slice")
def composite_slice_of_orders(t):
    cells, options = composite_cells(t)
    return composite_result(lookup_composite_slice(composite_requests(t), cells, [("P", None), ("O", "5-LOW")], options))


@query(f"""WITH {COMPOSITE_CELLS}
    SELECT c.* FROM customer JOIN cells c ON c_custkey = c.row_key
    WHERE CASE c_mktsegment WHEN 'FURNITURE' THEN c0 = 'F' AND c1 BETWEEN '2-HIGH' AND '3-MEDIUM'
        WHEN 'MACHINERY' THEN c0 = 'P' OR (c0 = 'O' AND c1 = '5-LOW')
        WHEN 'BUILDING' THEN c1 = '1-URGENT' ELSE TRUE END""")
def lookup_dispatch_composite(t):
    """Composite names: a range, a slice with null parts, a range over the second part, or the whole row."""
    segment, kind = F.col("c_mktsegment"), "struct<status:string,priority:string>"
    name = lambda status, priority: composite(status=F.lit(status), priority=F.lit(priority)).cast(kind)
    start = F.when(segment == "FURNITURE", name("F", "2-HIGH")).when(segment == "BUILDING", name(None, "1-URGENT"))
    end = F.when(segment == "FURNITURE", name("O", "3-MEDIUM")).when(segment == "BUILDING", name("O", "1-URGENT"))
    names = F.when(segment == "MACHINERY", F.array(name("P", None), name("O", "5-LOW")))
    asked = t.customer.select(F.col("c_custkey").alias("row_key"), names.alias("slice"), start.alias("start"),
                              end.alias("end"))
    cells, options = composite_cells(t)
    return composite_result(lookup_dispatch(asked, cells, options))


@query("""SELECT o_orderkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS absent
    FROM orders JOIN customer ON c_custkey = o_custkey""", "columns_to_row")
def name_and_segment(t):
    """Two columns of each order's customer side by side, and one that no row has."""
    found = lookup_slice(customer_requests(t), customer_cells(t), ["c_name", "c_mktsegment", "c_absent"])
    return columns_to_row(found, "id", {"c_name": "name", "c_mktsegment": "segment", "c_absent": "absent"})


@query("""WITH cells AS (SELECT l_returnflag AS row_key, l_orderkey AS column_name, max(l_partkey) AS value FROM lineitem GROUP BY 1, 2)
    SELECT o_orderkey AS id, c.* FROM orders JOIN cells c ON row_key = CASE o_orderstatus WHEN 'F' THEN 'R' ELSE 'N' END
        AND column_name BETWEEN o_orderkey AND o_orderkey + 30""")
def lookup_range_wide_row(t):
    """Three rows hold all lines; every order asks for a short range of one of them, and meets little more than that."""
    wide = t.lineitem.groupBy(F.col("l_returnflag").alias("row_key"), F.col("l_orderkey").alias("column_name"))
    cells = wide.agg(F.max("l_partkey").alias("value"))
    row = F.when(F.col("o_orderstatus") == "F", "R").otherwise("N")
    asked = t.orders.select(F.col("o_orderkey").alias("id"), row.alias("row_key"), F.col("o_orderkey").alias("start"),
                            (F.col("o_orderkey") + 30).alias("end"))
    options = SkewOptions(min_rows=1000, share=1 / 100, always=True)
    return lookup_range(asked, cells, options=options).select("id", "row_key", "column_name", "value")


REACH_EDGES = """
    sharers AS (SELECT DISTINCT l_orderkey AS url, l_partkey AS source FROM lineitem),
    followers AS (SELECT DISTINCT l_partkey AS source, l_suppkey AS follower FROM lineitem)"""


def reach_tables(t):
    """Orders as links, their parts as the sources, and the suppliers of a part as its followers."""
    asked = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("url"))
    sharers = t.lineitem.select(F.col("l_orderkey").alias("url"), F.col("l_partkey").alias("source"))
    followers = t.lineitem.select(F.col("l_partkey").alias("source"), F.col("l_suppkey").alias("follower"))
    return asked, sharers, followers


@query(f"""WITH {REACH_EDGES}
    SELECT o_orderkey AS id, o_orderkey AS url, count(DISTINCT follower) AS reach
    FROM orders LEFT JOIN sharers ON url = o_orderkey LEFT JOIN followers USING (source) GROUP BY 1, 2""", "reach")
def reach_of_orders(t):
    return jobs.reach(*reach_tables(t))


@query(f"""WITH {REACH_EDGES}
    SELECT o_orderkey AS id, o_orderkey AS url, count(DISTINCT CASE WHEN follower IS NOT NULL THEN source END) AS sources
    FROM orders LEFT JOIN sharers ON url = o_orderkey LEFT JOIN followers USING (source) GROUP BY 1, 2""",
       "active_sources")
def active_sources_of_orders(t):
    return jobs.active_sources(*reach_tables(t))


@query("SELECT user_id AS id, count(DISTINCT props) AS members FROM events GROUP BY 1", "count_distinct")
def distinct_props(t):
    return count_distinct(t.events.withColumnRenamed("user_id", "id"), "id", "props", "members")
