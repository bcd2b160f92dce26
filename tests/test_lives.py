"""Lives of expiring keys: folded in any order and grouping they are what all updates at once give."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.sources import Aggregate, StateOptions, StateStore
from rowloom.sources.merges import latest
from tests.util import plan, rows, ts

TTL = 10


def store(spark, path, **options):
    aggregates = {"n": Aggregate("count"), "low": Aggregate("min", "v")}
    return StateStore(spark, str(path), ["k"], aggregates, StateOptions(ttl_seconds=TTL, **options))


def put(spark, at, state, batch_id, updates):
    """``updates``: (key, value, seconds), of one time for each key."""
    found = [(k, v, at(s)) for k, v, s in updates]
    state.update(spark.createDataFrame(found, "k string, v long, t timestamp_ntz"), batch_id, "t")


def lives_of(batches, key):
    """The lives of a key, each a list of (seconds, batch, values)."""
    seen = {}
    for batch_id, updates in batches.items():
        for k, v, s in updates:
            if k == key:
                seen.setdefault((s, batch_id), []).append(v)
    lives = []
    for (s, batch_id), values in sorted(seen.items()):
        if not lives or s >= lives[-1][-1][0] + TTL:
            lives.append([])
        lives[-1].append((s, batch_id, values))
    return lives


def summed(updates):
    values = [v for _, _, found in updates for v in found]
    return (len(values), min(values)) if values else (None, None)


def expected(batches):
    out = []
    for key in sorted({k for updates in batches.values() for k, _, _ in updates}):
        lives = lives_of(batches, key)
        txid = max(b for life in lives for _, b, _ in life)
        older = [[u for u in life if u[1] < txid] for life in lives]
        before = next((life for life in reversed(older) if life), [])
        out.append(([key], txid, *summed(lives[-1]), *summed(before)))
    return out


def history(state):
    return rows(state.history(), "key", "txid", "n", "low", "prev_n", "prev_low")


@pytest.mark.parametrize("seed", range(3))
def test_lives_fold_in_any_grouping(spark, at, tmp_path, seed):
    rnd, state, batches = random.Random(seed), store(spark, tmp_path), {}
    for batch_id in range(7):
        times = {k: rnd.randrange(60) for k in "abcd"}  # late updates too
        updates = [(k, rnd.randrange(100), times[k]) for k in rnd.choices("abcd", k=4)]
        batches[batch_id] = updates
        put(spark, at, state, batch_id, updates)
        if rnd.random() < 0.6:
            state.compact(full=rnd.choice([None, False, True]))
    assert history(state) == expected(batches)
    assert rows(state.current()) == [(r[0], *r[2:4]) for r in expected(batches)]
    state.compact(keep_last=0, full=True)
    assert history(state) == expected(batches)


def test_a_late_update_joins_two_folded_lives(spark, at, tmp_path):
    state, batches = store(spark, tmp_path), {}
    for batch_id, seconds in enumerate((0, 18, 9, 40, 31)):
        batches[batch_id] = [("a", batch_id, seconds), ("b", 5, batch_id)]
        put(spark, at, state, batch_id, batches[batch_id])
        state.compact(keep_last=0)
        assert history(state) == expected(batches)
    held = state.log.read().where("key[0] = 'a'").select(F.size("older").alias("n")).collect()
    assert [len(life) for life in lives_of(batches, "a")] == [3, 2] and sum(r.n for r in held) >= 1


def test_files_of_untouched_keys_are_carried_on(spark, at, tmp_path):
    state = store(spark, tmp_path)
    many = [(f"k{i:04d}", i, 0) for i in range(400)]
    put(spark, at, state, 0, many)
    put(spark, at, state, 1, [("k0007", 1, 2)])
    state.compact(keep_last=0)
    before = set(state.log.files(state.log.state().fold, 2))
    put(spark, at, state, 2, [("k0007", 0, 50)])
    state.compact(keep_last=0)
    fold = state.log.state().fold
    assert before and set(state.log.files(fold, 2)) == before and state.log.files(fold, 1)
    found = {r[0][0]: r[1] for r in rows(state.current())}
    assert found["k0007"] == 1 and len(found) == 400 and set(found.values()) == {1}


def test_reading_a_snapshot_takes_no_window_and_no_older_lives(spark, at, tmp_path):
    state = store(spark, tmp_path)
    for batch_id in range(3):
        put(spark, at, state, batch_id, [("a", 1, 20 * batch_id)])
    state.compact(keep_last=0)
    text = plan(state.current())
    assert "Window" not in text and "older" not in text and "Exchange" not in text
    assert rows(state.current()) == [(["a"], 1, 1)]


def test_old_lives_can_be_purged(spark, at, tmp_path):
    state = store(spark, tmp_path)
    for batch_id, updates in enumerate(([("a", 1, 0), ("old", 1, 0)], [("a", 2, 30)], [("a", 3, 60), ("b", 1, 60)])):
        put(spark, at, state, batch_id, updates)
    state.purge_before(ts("2024-01-01 00:00:20"), keep_last=0)
    assert rows(state.current()) == [(["a"], 1, 3), (["b"], 1, 1)]
    assert [(r.key[0], [x.low for x in r.older]) for r in state.log.read().orderBy("key").collect()] == [("a", [2]), ("b", [])]
    with pytest.raises(ValueError, match="one life"):
        StateStore(spark, str(tmp_path / "x"), ["k"], {"n": Aggregate("count")}, StateOptions(ttl_seconds=None)).purge_before(ts("2024-01-01"))


def test_declared_aggregates_keep_their_lives(spark, at, tmp_path):
    state = StateStore(spark, str(tmp_path), ["k"], {"last": latest("v", "t", T.LongType())}, StateOptions(ttl_seconds=TTL))
    for batch_id, seconds in enumerate((0, 30, 5)):
        put(spark, at, state, batch_id, [("a", batch_id, seconds)])
        state.compact(keep_last=0, full=None)
    assert rows(state.history(), "last", "prev_last") == [(1, 1)]
    assert state.log.read().selectExpr("explode(older) AS life").selectExpr("life.last.value").first()[0] == 2
