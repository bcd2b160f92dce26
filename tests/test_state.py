"""Keyed state: modes, replays, history, expiry, global state, sums over words, running counts."""

import random

import pytest
from pyspark.sql import functions as F

from rowloom import jobs
from rowloom.operators import running_count, split_words, state_get_sum
from rowloom.plans import SkewOptions
from rowloom.sources import Aggregate, StateOptions, StateStore
from tests.util import plan, rows, ts

SENTENCES = [
    "a red boat left a cold harbour",
    "rain fell on a boat",
    "we mended nets",
    "seven gulls slept",
]


def word_batches(spark, size=3):
    made = [SENTENCES[i : i + size] for i in range(0, len(SENTENCES), size)]
    return [split_words(spark.createDataFrame([(s,) for s in b], "sentence string"), "sentence") for b in made]


@pytest.mark.parametrize("mode", ["opaque", "transactional", "non-transactional"])
def test_word_count_query(spark, tmp_path, mode):
    state = jobs.word_state(spark, str(tmp_path), StateOptions(mode, ttl_seconds=None))
    for batch_id, batch in enumerate(word_batches(spark)):
        state.update(batch, batch_id, ts("2024-01-01"))
    questions = ["owl fox a nets", "owl", "fox", "a", "nets", "", "a a"]
    asked = spark.createDataFrame(list(enumerate(questions)), "id int, args string")
    found = state_get_sum(asked, "args", state.current(), "count", ["id"])
    assert [r[1] for r in rows(found)] == [4, 0, 0, 3, 1, 0, 6]
    cells = rows(jobs.word_cells(state))
    assert ("a", "count", "3") in cells and ("a", "word", "a") in cells
    text = " ".join(SENTENCES)
    whole = jobs.word_count_cells(spark.createDataFrame([(text,)], "t string"), "t")
    assert cells == rows(whole)


@pytest.mark.parametrize(("mode", "n"), [("opaque", 3), ("transactional", 2), ("non-transactional", 5)])
def test_replay_with_other_content(spark, tmp_path, mode, n):
    state = StateStore(spark, str(tmp_path), ["k"], {"n": Aggregate("count")}, StateOptions(mode))
    for size in (2, 3):
        state.update(spark.range(size).withColumn("k", F.lit(1)), 7, ts("2024-01-01"))
    assert rows(state.current()) == [(["1"], n)]


def test_history(spark, tmp_path):
    aggregates = {"n": Aggregate("count"), "low": Aggregate("min", "v")}
    state = StateStore(spark, str(tmp_path), ["k"], aggregates, StateOptions(ttl_seconds=None))
    for batch_id, content in enumerate(([("a", 5), ("a", 3)], [("a", 9), ("b", 1)], [("a", 2)])):
        state.update(spark.createDataFrame(content, "k string, v long"), batch_id, ts("2024-01-01"))
    want = [(["a"], 2, 4, 2, 3, 3), (["b"], 1, 1, 1, None, None)]
    assert rows(state.history(), "key", "txid", "n", "low", "prev_n", "prev_low") == want
    state.compact()
    assert rows(state.history(), "key", "txid", "n", "low", "prev_n", "prev_low") == want


@pytest.mark.parametrize("ttl", [None, 60])
def test_history_takes_one_shuffle(spark, tmp_path, ttl):
    state = StateStore(spark, str(tmp_path), ["k"], {"n": Aggregate("count")}, StateOptions(ttl_seconds=ttl))
    for batch_id in range(3):
        state.update(spark.createDataFrame([("a",), ("b",)][: batch_id + 1], "k string"), batch_id, ts("2024-01-01"))
    found = state.history()
    assert plan(found).split("Initial Plan")[0].count("Exchange") == 1 and "Join" not in plan(found)
    assert rows(found, "key", "txid", "n", "prev_n") == [(["a"], 2, 3, 2), (["b"], 2, 2, 1)]


def test_only_mergeable_aggregates():
    with pytest.raises(ValueError):
        Aggregate("avg", "v")


def test_global_key(spark, tmp_path):
    state = StateStore(spark, str(tmp_path), [], {"n": Aggregate("count")})
    state.update(spark.range(4), 0, ts("2024-01-01"))
    assert rows(state.current()) == [(["globalkey"], 4)]


def expected_lives(batches, ttl):
    state = {}
    for seconds, keys in batches:
        for k in keys:
            n, last = state.get(k, (0, seconds))
            state[k] = (1 if seconds >= last + ttl and n else n + 1, seconds)
    return {k: n for k, (n, _) in state.items()}


@pytest.mark.parametrize("compact_after", [None, 1, 3])
def test_expired_keys_start_anew(spark, at, tmp_path, compact_after):
    rnd, ttl = random.Random(3), 10
    times = [0, 4, 13, 23, 24, 40]
    batches = [(t, [k for k in "abcde" if rnd.random() < 0.6]) for t in times]
    state = StateStore(spark, str(tmp_path), ["k"], {"n": Aggregate("count")}, StateOptions(ttl_seconds=ttl))
    for batch_id, (seconds, keys) in enumerate(batches):
        df = spark.createDataFrame([(k, at(seconds)) for k in keys], "k string, at timestamp_ntz")
        state.update(df, batch_id, "at")
        if batch_id == compact_after:
            state.compact(keep_last=0)
    assert {k[0]: n for k, n in rows(state.current())} == expected_lives(batches, ttl)
    live = rows(state.current(ts("2024-01-01 00:00:45")))
    assert {k[0] for k, _ in live} == set(batches[-1][1])


def brute_running_count(data):
    seen, out = {}, []
    for k, o in sorted(data, key=lambda r: r[1]):
        seen[k] = seen.get(k, 0) + 1
        out.append((k, o, seen[k]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [SkewOptions(), SkewOptions(min_rows=10, share=0.2), SkewOptions(min_rows=1, share=0.01)])
@pytest.mark.parametrize("kind", ["long", "timestamp_ntz", "double"])
def test_running_count(spark, at, options, kind):
    rnd = random.Random(5)
    make = at if kind == "timestamp_ntz" else float if kind == "double" else int
    order = [make(o) for o in rnd.sample(range(10_000), 400)]
    data = [("hot" if rnd.random() < 0.4 else None if rnd.random() < 0.3 else f"k{rnd.randrange(30)}", o) for o in order]
    df = spark.createDataFrame(data, f"k string, o {kind}").repartition(3)
    found = running_count(df, "k", "o", options, name="n")
    assert rows(found) == brute_running_count(data)
    assert "Python" not in plan(found)


def test_running_count_needs_a_number_or_a_time(spark):
    with pytest.raises(TypeError):
        running_count(spark.createDataFrame([("a", "b")], "k string, o string"), "k", "o")
