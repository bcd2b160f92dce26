"""Queries: keyed state, word counts and running counts."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom import jobs
from rowloom.functions import state_key, words
from rowloom.model import cell_schema
from rowloom.operators import count_by, multi_get, not_null, running_count, split_words, state_get_sum, sum_by
from rowloom.plans import SkewOptions
from rowloom.session import shared_dir
from rowloom.sources import (
    Aggregate,
    CellStore,
    DistinctStore,
    StateOptions,
    StateStore,
    approx_distinct,
    average,
    get_values,
    latest,
    put_values,
    quantile,
)
from rowloom.sources.state import NON_TRANSACTIONAL, OPAQUE, TRANSACTIONAL
from rowloom.suite.registry import query

WORDS = """words AS (
    SELECT w AS word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
    WHERE w <> '' GROUP BY 1)"""

ASKED = """asked AS (
    SELECT item_id, w AS word, row_number() OVER (PARTITION BY item_id ORDER BY i) AS place FROM (
        SELECT item_id, unnest(p) AS w, generate_subscripts(p, 1) AS i FROM (
            SELECT item_id, string_split(text, ' ') AS p FROM benchmark)) WHERE w <> '')"""


def document_words(t):
    """The state word -> count over the documents."""
    counts = count_by(split_words(t.documents, "text"), "word", name="n")
    return counts.select(state_key("word").alias("key"), "n")


@query(f"WITH {WORDS} SELECT word AS row_key, 'word' AS column_name, word AS value FROM words "
       "UNION ALL SELECT word, 'count', CAST(n AS VARCHAR) FROM words")
def persistent_word_count(t):
    return jobs.word_count_cells(t.documents, "text")


@query(f"""WITH {WORDS}, {ASKED}
    SELECT item_id, place, word, n FROM asked LEFT JOIN words USING (word)""", "multi_get")
def word_counts_in_order(t):
    asked = t.benchmark.select("item_id", F.posexplode(words("text")).alias("at", "word"))
    asked = asked.select("item_id", (F.col("at") + 1).cast("long").alias("place"), "word",
                         state_key("word").alias("key"))
    return multi_get(asked, document_words(t)).select("item_id", "place", "word", "n")


@query(f"""WITH {WORDS}, {ASKED}, sums AS (
        SELECT item_id, CAST(sum(n) AS BIGINT) AS total FROM asked JOIN words USING (word) GROUP BY 1)
    SELECT b.item_id, coalesce(total, 0) AS "sum" FROM benchmark b LEFT JOIN sums USING (item_id)""", "state_get_sum")
def known_words_of_items(t):
    return state_get_sum(t.benchmark, "text", document_words(t), "n", ["item_id"])


@query("""
    SELECT user_id, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total, min(value) AS low,
           max(value) AS high FROM events GROUP BY 1, 2""")
def persistent_aggregate(t):
    aggregates = {
        "n": Aggregate("count"),
        "total": Aggregate("sum", "event_id"),
        "low": Aggregate("min", "value", t.events.schema["value"].dataType),
        "high": Aggregate("max", "value", t.events.schema["value"].dataType),
    }
    options = StateOptions(ttl_seconds=None)
    state = StateStore(t.spark, shared_dir(t.spark, "state"), ["user_id", "event_type"], aggregates, options)
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    state.update(t.events.where(~late), 0, "ts")
    state.update(t.events.where(late), 1, "ts")
    state.compact()
    key = F.col("key")
    return state.current().select(key[0].cast("long").alias("user_id"), key[1].alias("event_type"), *aggregates)


def four_batches(t, store, purpose):
    """Events in four batches: the third is written twice, first with other rows, and compacted after the second."""
    store = store(shared_dir(t.spark, purpose))
    part = F.col("event_id") % 4
    for batch_id, rows in ((0, part == 0), (1, part == 1), (2, part >= 1), (2, part == 2), (3, part == 3)):
        store.update(t.events.where(rows), batch_id, "ts")
        if batch_id == 1:
            store.compact(keep_last=0)
    return store.current()


@query("""SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) / count(value) AS mean
    FROM events GROUP BY 1""")
def state_average(t):
    """A count and a mean kept side by side; the mean's buffer is a sum and a count."""
    exact = average(F.col("value").cast("decimal(18,4)"), T.DecimalType(28, 4))
    store = lambda root: StateStore(t.spark, root, ["user_id"], {"n": Aggregate("count"), "mean": exact},
                                    StateOptions(ttl_seconds=None))
    return four_batches(t, store, "average").select(F.col("key")[0].cast("long").alias("user_id"), "n", "mean")


@query("""SELECT user_id, props AS last_props, event_type AS last_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth FROM events) WHERE nth = 1""")
def state_latest(t):
    """The properties and the type of each user's last event."""
    by = {"by": "event_id", "by_type": T.LongType()}
    kept = {"last_props": latest("props", **by), "last_type": latest("event_type", **by)}
    store = lambda root: StateStore(t.spark, root, ["user_id"], kept, StateOptions(ttl_seconds=None))
    return four_batches(t, store, "latest").select(F.col("key")[0].cast("long").alias("user_id"), *kept)


@query("SELECT event_type, CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM events GROUP BY 1")
def state_distinct(t):
    """Users of each type of event, exactly, as bitmaps that batches add to."""
    store = lambda root: DistinctStore(t.spark, root, ["event_type"], "user_id")
    found = four_batches(t, store, "distinct")
    return found.select(F.col("key")[0].alias("event_type"), F.col("members").alias("users"))


@query("""SELECT user_id, CAST(count(DISTINCT event_type) AS BIGINT) AS kinds, min(value) AS low, max(value) AS high FROM events GROUP BY 1""")
def state_sketches(t):
    """Sketches that stay small for every user: distinct types (few, so exact), and the lowest and greatest value as quantiles."""
    kept = {"kinds": approx_distinct("event_type"), "low": quantile("value", 0.0), "high": quantile("value", 1.0)}
    store = lambda root: StateStore(t.spark, root, ["user_id"], kept, StateOptions(ttl_seconds=None))
    return four_batches(t, store, "sketches").select(F.col("key")[0].cast("long").alias("user_id"), *kept)


def replayed(t, mode):
    """Events by type: a batch, and the same batch again with the rest of the rows."""
    state = StateStore(t.spark, shared_dir(t.spark, mode), ["event_type"], {"n": Aggregate("count")},
                       StateOptions(mode, ttl_seconds=None))
    state.update(t.events.where("value < 20"), 7, "ts")
    state.update(t.events, 7, "ts")
    return state.current().select(F.col("key")[0].alias("event_type"), "n")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def state_opaque(t):
    return replayed(t, OPAQUE)


@query("SELECT event_type, count(*) AS n FROM events WHERE value < 20 GROUP BY 1")
def state_transactional(t):
    return replayed(t, TRANSACTIONAL)


@query("""SELECT event_type, count(*) + count(CASE WHEN value < 20 THEN 1 END) AS n FROM events GROUP BY 1""")
def state_non_transactional(t):
    return replayed(t, NON_TRANSACTIONAL)


@query("""SELECT event_type, count(*) + count(CASE WHEN value < 20 THEN 1 END) AS n FROM events GROUP BY 1""")
def state_non_transactional_compacted(t):
    """The same after compaction and removal of what it replaced, with the last update after it."""
    state = StateStore(t.spark, shared_dir(t.spark, "folded"), ["event_type"], {"n": Aggregate("count")},
                       StateOptions(NON_TRANSACTIONAL, ttl_seconds=None))
    state.update(t.events.where("value < 20"), 7, "ts")
    state.update(t.events.where("value >= 10"), 7, "ts")
    state.compact()
    state.vacuum()
    state.update(t.events.where("value < 10"), 7, "ts")
    return state.current().select(F.col("key")[0].alias("event_type"), "n")


HISTORY = """
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(CASE WHEN late > 0 THEN 2 ELSE 1 END AS BIGINT) AS txid, early + late AS n,
           CASE WHEN late > 0 THEN nullif(early, 0) END AS prev_n
    FROM (SELECT user_id, count(CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 1 END) AS early,
                 count(CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 1 END) AS late FROM events GROUP BY 1)"""


def two_batches(t, purpose):
    state = StateStore(t.spark, shared_dir(t.spark, purpose), ["user_id"], {"n": Aggregate("count")},
                       StateOptions(ttl_seconds=None))
    early = F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    state.update(t.events.where(early), 1, "ts")
    state.update(t.events.where(~early), 2, "ts")
    return state


def history_of(state):
    return state.history().select(F.col("key")[0].alias("user_id"), "txid", "n", "prev_n")


@query(HISTORY)
def state_history(t):
    return history_of(two_batches(t, "history"))


@query(HISTORY)
def state_history_compacted(t):
    """The value before the last batch is still known when only a snapshot is left."""
    state = two_batches(t, "history-folded")
    state.compact(keep_last=0)
    state.vacuum()
    return history_of(state)


LIVES = """
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(sum(CASE WHEN day >= last_start THEN n END) AS BIGINT) AS n FROM (
        SELECT *, max(CASE WHEN starts THEN day END) OVER (PARTITION BY user_id) AS last_start FROM (
            SELECT *, coalesce(upd >= lag(upd) OVER (PARTITION BY user_id ORDER BY day) + INTERVAL 3 HOUR, TRUE) AS starts
            FROM (SELECT user_id, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 1 WHEN ts < TIMESTAMP '2024-01-20' THEN 2
                         ELSE 3 END AS day, max(ts) AS upd, count(*) AS n FROM events GROUP BY 1, 2)))
    GROUP BY 1"""


def expiring(t, purpose, after=lambda state: None):
    """Three batches of a state whose keys expire after three hours; ``after`` each of them."""
    state = StateStore(t.spark, shared_dir(t.spark, purpose), ["user_id"], {"n": Aggregate("count")},
                       StateOptions(ttl_seconds=3 * 3600))
    first, second = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-10", "2024-01-20"))
    ts = F.col("ts")
    for batch_id, rows in enumerate((ts < first, (ts >= first) & (ts < second), ts >= second)):
        state.update(t.events.where(rows), batch_id, "ts")
        after(state)
    return state.current().select(F.col("key")[0].alias("user_id"), "n")


@query(LIVES)
def state_ttl(t):
    """Three batches; a key that had expired before a batch starts anew with it."""
    return expiring(t, "ttl")


@query(LIVES)
def state_ttl_compacted(t):
    """The lives of a key are folded batch by batch and stay the same."""
    return expiring(t, "ttl-folded", lambda state: state.compact(keep_last=0))


@query("""
    SELECT l_orderkey, l_linenumber, s_name AS value FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def multi_put(t):
    """Supplier names put under their key, and read back for every line."""
    options = StateOptions(ttl_seconds=3600)
    store = CellStore(t.spark, shared_dir(t.spark, "values"), cell_schema(key="dynamic composite"))
    written, asked_at = (F.lit(at).cast("timestamp_ntz") for at in ("2024-01-01 00:00:00", "2024-01-01 00:59:59"))
    put_values(store, t.supplier, ["s_suppkey"], "s_name", 0, written, options=options)
    asked = t.lineitem.select("l_orderkey", "l_linenumber", state_key("l_suppkey").alias("key"))
    return multi_get(asked, get_values(store, options, asked_at)).drop("key")


@query("SELECT 'globalkey' AS \"key\", count(*) AS n FROM events")
def global_count(t):
    state = StateStore(t.spark, shared_dir(t.spark, "global"), [], {"n": Aggregate("count")},
                       StateOptions(ttl_seconds=None))
    state.update(t.events, 0, "ts")
    return state.current().select(F.col("key")[0].alias("key"), "n")


RUNNING = """SELECT event_id, {0}, count(*) OVER (PARTITION BY {0} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS seen
    FROM events"""


@query(RUNNING.format("user_id"), "running_count")
def running_count_by_user(t):
    return running_count(t.events.select("event_id", "user_id"), "user_id", "event_id", name="seen")


@query(RUNNING.format("event_type"))
def running_count_heavy(t):
    """The same with few, heavy keys, all of which are cut into buckets."""
    options = SkewOptions(min_rows=100, share=1 / 20)
    return running_count(t.events.select("event_id", "event_type"), "event_type", "event_id", options, name="seen")


@query("SELECT event_type, count(value) AS n, CAST(sum(user_id) AS BIGINT) AS \"sum\" "
       "FROM events WHERE value IS NOT NULL AND props IS NOT NULL GROUP BY 1")
def count_sum_not_null(t):
    rows = not_null(t.events, "value", "props")
    counts = count_by(rows, "event_type", name="n")
    return counts.join(sum_by(rows, "user_id", "event_type"), "event_type")
