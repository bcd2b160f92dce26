"""Running counts of every row of a stream: replays, restarts, compaction, many rows of one key."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rowloom.plans import SkewOptions
from rowloom.sources.streams import file_stream
from rowloom.streaming import running_rows
from tests.util import rows

SCHEMA = "o long, k string"


def laid_out(spark, folder, batches):
    """One file for each batch; the stream takes one after the other."""
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{folder}")
    return file_stream(spark, str(folder), df.schema, max_files=1)


def expected(batches):
    seen, out = {}, []
    for batch in batches:
        for o, k in sorted(batch):
            seen[k] = seen.get(k, 0) + 1
            out.append((o, k, seen[k]))
    return sorted(out, key=repr)


BATCHES = [
    [(5, "a"), (1, "a"), (3, "b")],
    [(2, "b"), (9, "a"), (8, "a"), (4, "c")],
    [(7, None), (6, "c")],
    [(20, "a"), (21, None), (22, "b")],
]


@pytest.mark.parametrize("options", [None, SkewOptions(min_rows=1, share=0.01, always=True)])
def test_counts_go_on_over_batches(spark, tmp_path, options):
    stream = laid_out(spark, tmp_path / "in", [[r for r in b if r[1] is not None] for b in BATCHES])
    found = running_rows(stream, "k", "o", str(tmp_path / "s"), str(tmp_path / "c"), "n", options=options)
    found.query.awaitTermination()
    assert rows(found.rows.read(), "o", "k", "n") == expected([[r for r in b if r[1] is not None] for b in BATCHES])


def test_null_keys_count_as_one(spark, tmp_path):
    stream = laid_out(spark, tmp_path / "in", BATCHES)
    found = running_rows(stream, "k", "o", str(tmp_path / "s"), str(tmp_path / "c"), "n")
    found.query.awaitTermination()
    assert rows(found.rows.read(), "o", "k", "n") == expected(BATCHES)


@pytest.mark.parametrize("compact", [False, True])
def test_a_batch_that_fails_after_its_rows_is_counted_once(spark, tmp_path, monkeypatch, compact):
    """The third batch stops between its rows and its counts, and again after its counts; more files come meanwhile."""
    from rowloom.sources.state import StateStore

    update, stops = StateStore.update, ["before", "after"]

    def stopping(self, df, batch_id, *args):
        if batch_id == 2 and stops:
            if stops.pop(0) == "after":
                update(self, df, batch_id, *args)
            raise RuntimeError("lost")
        return update(self, df, batch_id, *args)

    monkeypatch.setattr(StateStore, "update", stopping)
    stream = laid_out(spark, tmp_path / "in", BATCHES)
    start = lambda: running_rows(stream, "k", "o", str(tmp_path / "s"), str(tmp_path / "c"), "n")
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            start().query.awaitTermination()
    found = start()
    found.query.awaitTermination()
    if compact:
        found.counts.compact()
    more = [[(30, "a"), (31, "c")]]
    spark.createDataFrame(more[0], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    again = start()
    again.query.awaitTermination()
    assert not stops and rows(again.rows.read(), "o", "k", "n") == expected(BATCHES + more)


def test_state_without_a_batch(spark, tmp_path):
    from rowloom.sources import Aggregate, StateOptions, StateStore
    from tests.util import ts

    state = StateStore(spark, str(tmp_path), ["k"], {"n": Aggregate("count")}, StateOptions(ttl_seconds=None))
    for batch_id, keys in enumerate(["aab", "abc"]):
        state.update(spark.createDataFrame([(k,) for k in keys], "k string"), batch_id, ts("2024-01-01"))
    asked = spark.createDataFrame([(["a"],), (["c"],)], "key array<string>")
    assert rows(state.without(asked, 1)) == [(["a"], 2)] and rows(state.without(asked, 0)) == [(["a"], 1), (["c"], 1)]
    assert rows(state.without(asked, 7)) == [(["a"], 3), (["c"], 1)]
    state.compact(keep_last=0)
    with pytest.raises(ValueError):
        state.without(asked, 1)
