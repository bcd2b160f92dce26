"""Streams give what a batch gives, in any number of micro-batches, also after a replay."""

import os

import pytest
from pyspark.sql import functions as F

from rowloom import jobs
from rowloom.operators import (
    ErrorPolicy,
    Write,
    count_by,
    lookup_row,
    map_counter,
    map_custom,
    map_default,
    resolve_latest,
)
from rowloom.sources import Aggregate, BatchLog, CellStore, CounterStore, StateOptions, StateStore
from rowloom.sources.streams import file_stream, requests
from rowloom.streaming import increment_stream, lookup_stream, put_running_count, put_stream, state_stream
from tests.util import plan, rows, ts

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """The events, shuffled over a number of files."""
    events = spark.read.parquet(EVENTS)

    def make(n):
        path = str(tmp_path_factory.mktemp("files") / "events")
        events.repartition(n, F.xxhash64("event_id")).write.parquet(path)
        return file_stream(spark, path, events.schema, max_files=1)

    return events, make


def mapper(rows_):
    entry = F.array(F.struct(F.col("event_type").alias("column_name"), F.col("props").alias("value")))
    return map_custom(rows_, F.col("user_id").cast("string"), entry, Write("ts", "event_id", delete_when=F.col("value") < 5))


def counters(rows_):
    return map_counter(rows_.select("user_id", "event_type", F.floor("value").alias("n")), "user_id", "n")


CELL = ("row_key", "column_name", "value")


def rerun_last(checkpoint, start):
    """Forget that the last micro-batch was done, and start again."""
    commits = os.path.join(checkpoint, "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    os.unlink(os.path.join(commits, last))
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    start().awaitTermination()


@pytest.mark.parametrize("n", [1, 4, 10])
def test_upserts(spark, files, tmp_path, n):
    events, make = files
    store, checkpoint = CellStore(spark, str(tmp_path / "store")), str(tmp_path / "checkpoint")
    stream = make(n)
    start = lambda: put_stream(stream, store, mapper, checkpoint)
    start().awaitTermination()
    want = rows(resolve_latest(mapper(events)), *CELL)
    assert len(store.log.batches()) == n
    assert rows(store.cells(), *CELL) == want
    rerun_last(checkpoint, start)
    assert rows(store.cells(), *CELL) == want
    store.compact()
    assert rows(store.cells(), *CELL) == want


def test_counters_are_not_counted_twice(spark, files, tmp_path):
    events, make = files
    store, checkpoint = CounterStore(spark, str(tmp_path / "store")), str(tmp_path / "checkpoint")
    stream = make(4)
    start = lambda: increment_stream(stream, store, counters, checkpoint)
    start().awaitTermination()
    rerun_last(checkpoint, start)
    want = counters(events).groupBy("row_key", "column_name").agg(F.sum("amount"))
    assert rows(store.counters().drop("keyspace", "table")) == rows(want)


@pytest.mark.parametrize("mode", ["opaque", "transactional"])
def test_state_after_replay(spark, files, tmp_path, mode):
    events, make = files
    state = StateStore(spark, str(tmp_path / "state"), ["event_type"], {"n": Aggregate("count")}, StateOptions(mode, None))
    checkpoint = str(tmp_path / "checkpoint")
    stream = make(4)
    start = lambda: state_stream(stream, state, "ts", checkpoint)
    start().awaitTermination()
    rerun_last(checkpoint, start)
    want = [([t], n) for t, n in rows(count_by(events, "event_type"))]
    assert rows(state.current()) == want


def test_rejects_are_reported_and_rows_handed_on(spark, files, tmp_path):
    events, make = files
    store = CellStore(spark, str(tmp_path / "store"))
    schema = events.select("event_id", F.lit("").alias("reason")).schema
    rejected, passed = BatchLog(spark, str(tmp_path / "rejects"), schema), []
    put_stream(make(3), store, mapper, str(tmp_path / "checkpoint"), rules={"error": F.col("event_type") == "error"},
               policy=ErrorPolicy().reject_on("error"), report=rejected.append,
               then=lambda good, n: passed.append(good.count())).awaitTermination()
    n = events.where("event_type = 'error'").count()
    assert (rejected.read().count(), sum(passed)) == (n, events.count() - n)
    assert rows(store.cells(), *CELL) == rows(resolve_latest(mapper(events.where("event_type <> 'error'"))), *CELL)


def test_failing_policy_stops_the_stream_and_keeps_nothing_of_the_batch(spark, files, tmp_path):
    _, make = files
    store = CellStore(spark, str(tmp_path / "store"))
    query = put_stream(make(1), store, mapper, str(tmp_path / "checkpoint"),
                       rules={"error": F.col("event_type") == "error"}, policy=ErrorPolicy().fail_on("error"))
    with pytest.raises(Exception, match="row refused"):
        query.awaitTermination()
    assert store.log.batches() == []


def test_lookup_sees_writes_of_earlier_batches(spark, tmp_path):
    store = CellStore(spark, str(tmp_path / "store"))
    source = str(tmp_path / "asked")
    for i in range(3):
        spark.createDataFrame([(i, "k")], "id long, row_key string").coalesce(1).write.mode("append").parquet(source)
    stream = file_stream(spark, source, spark.read.parquet(source).schema, max_files=1)
    seen = []

    def lookup(batch):
        found = store.lookup(batch, lookup_row)
        seen.append(found.select("column_name").distinct().count())
        assert "LeftSemi" in plan(found) or not seen[-1]
        return found

    def out(found, batch_id):
        row = spark.createDataFrame([("k", f"c{batch_id}")], "k string, c string")
        write = Write(ts("2024-01-01"))
        store.put(row, lambda d: map_custom(d, F.col("k"), F.array(F.struct(F.col("c").alias("column_name"), F.lit("").alias("value"))), write), batch_id)

    lookup_stream(stream, lookup, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert seen == [0, 1, 2]


def test_word_count_of_a_stream(spark, tmp_path):
    words = spark.range(300).select("id", F.concat(F.lit("w"), F.col("id") % 7).alias("word"))
    words.repartition(3, "id").write.parquet(str(tmp_path / "words"))
    stream = file_stream(spark, str(tmp_path / "words"), words.schema, max_files=1)
    state = jobs.word_state(spark, str(tmp_path / "state"))
    state_stream(stream, state, ts("2024-01-01"), str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(jobs.word_cells(state)) == rows(map_default(count_by(words, "word"), "word"))


def test_running_count_stream_ends_at_the_total(spark, files, tmp_path):
    events, make = files
    stream, store, checkpoint = make(4), CellStore(spark, str(tmp_path / "store")), str(tmp_path / "checkpoint")
    start = lambda: put_running_count(stream, "event_type", store, "types", checkpoint)
    start().awaitTermination()
    want = rows(map_default(count_by(events, "event_type"), "event_type"))
    assert rows(store.cells(table="types"), *CELL) == want
    assert len(store.log.batches()) >= 4 and store.versions().count() > len(want)
    rerun_last(checkpoint, start)
    assert rows(store.cells(table="types"), *CELL) == want


def test_requests(spark):
    df = requests(spark.createDataFrame([(1, "x")], "n int, url string"), "url", "n")
    assert rows(df) == [(1, "x")] and df.columns == ["id", "arg"]
