"""Aggregates with a declared merge: any cut into batches, replays, compaction, history, lives."""

import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.sources import (
    Aggregate,
    Declared,
    DistinctStore,
    StateOptions,
    StateStore,
    approx_distinct,
    average,
    latest,
    quantile,
)
from tests.util import rows, ts

ROWS = "k string, v long, s string, at timestamp_ntz"


def kept_aggregates():
    """Every kind, and one of its own: how many different values, as bits of a long."""
    return {
        "n": Aggregate("count"),
        "mean": average("v"),
        "last": latest("s", "at"),
        "kinds": approx_distinct("s"),
        "middle": quantile("v", 0.5),
        "values": Declared(F.bit_or(F.expr("shiftleft(1L, cast(v as int))")), F.bit_or, T.LongType(), F.bit_count, F.lit(0)),
    }


def made(at, n=80, seed=2):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        v = None if pick.random() < 0.2 else pick.randrange(1, 4)
        out.append((pick.choice("abc"), v, pick.choice(["x", "y", "z", None]), None if pick.random() < 0.1 else at(pick.randrange(40))))
    return out


def expected(data):
    out = []
    for k in sorted({r[0] for r in data}):
        own = [r for r in data if r[0] == k]
        values = sorted(r[1] for r in own if r[1] is not None)
        timed = max(((r[3], r[2] is not None, r[2] or "", r[2]) for r in own if r[3] is not None), default=None)
        out.append(([k], len(own), statistics.fmean(values) if values else None, timed and timed[3],
                    len({r[2] for r in own if r[2] is not None}), len(set(values))))
    return out


@pytest.mark.parametrize("cuts", [[80], [3, 40, 80], [20, 20, 50, 80]])
@pytest.mark.parametrize("compact_after", [None, 0, 1])
def test_any_cut_into_batches(spark, at, tmp_path, cuts, compact_after):
    data = made(at)
    state = StateStore(spark, str(tmp_path), ["k"], kept_aggregates(), StateOptions(ttl_seconds=None))
    low = 0
    for batch_id, high in enumerate(cuts):
        batch = spark.createDataFrame(data[low:high], ROWS)
        state.update(spark.createDataFrame(data[:5], ROWS), batch_id, ts("2024-01-01"))  # replaced by the replay
        state.update(batch, batch_id, ts("2024-01-01"))
        if batch_id == compact_after:
            state.compact(keep_last=0)
        low = high
    found = rows(state.current(), "key", "n", "mean", "last", "kinds", "values")
    assert [(*r[:2], r[2] and round(r[2], 9), *r[3:]) for r in found] == [(*r[:2], r[2] and round(r[2], 9), *r[3:]) for r in expected(data)]
    middles = {k[0]: m for k, m in rows(state.current(), "key", "middle")}
    for k, m in middles.items():
        values = sorted(r[1] for r in data if r[0] == k and r[1] is not None)
        assert m in {values[(len(values) - 1) // 2], values[len(values) // 2]}


def test_value_before_the_last_batch(spark, at, tmp_path):
    kept = {"mean": average("v"), "last": latest("s", "at"), "kinds": approx_distinct("s")}
    state = StateStore(spark, str(tmp_path), ["k"], kept, StateOptions(ttl_seconds=None))
    for batch_id, content in enumerate(([("a", 1, "x", at(1)), ("b", 5, "y", at(1))], [("a", 3, "z", at(0))])):
        state.update(spark.createDataFrame(content, ROWS), batch_id, ts("2024-01-01"))
    want = [(["a"], 1, 2.0, "x", 2, 1.0, "x", 1), (["b"], 0, 5.0, "y", 1, None, None, None)]
    columns = ("key", "txid", "mean", "last", "kinds", "prev_mean", "prev_last", "prev_kinds")
    assert rows(state.history(), *columns) == want
    state.compact(keep_last=0)
    state.vacuum()
    assert rows(state.history(), *columns) == want


def test_lives_of_declared_aggregates(spark, at, tmp_path):
    state = StateStore(spark, str(tmp_path), ["k"], {"mean": average("v")}, StateOptions(ttl_seconds=10))
    for batch_id, (seconds, v) in enumerate([(0, 1), (5, 3), (30, 8), (32, 10)]):
        state.update(spark.createDataFrame([("a", v, None, at(seconds))], ROWS), batch_id, "at")
    assert rows(state.current()) == [(["a"], 9.0)]


def test_many_distinct_values_and_ranks(spark, tmp_path):
    kept = {"kinds": approx_distinct("id"), "tenth": quantile("id", 0.1)}
    state = StateStore(spark, str(tmp_path), [], kept, StateOptions(ttl_seconds=None))
    for batch_id in range(3):
        state.update(spark.range(batch_id * 20_000, batch_id * 20_000 + 40_000), batch_id, ts("2024-01-01"))
    ((_, kinds, tenth),) = rows(state.current())
    assert abs(kinds - 80_000) < 4_000 and abs(tenth - 9_000) < 3_000
    with pytest.raises(ValueError):
        quantile("id", 2)


@pytest.mark.parametrize("mode", ["opaque", "transactional", "non-transactional"])
def test_distinct_members(spark, tmp_path, mode):
    """Members of far apart ranges, repeated, negative and missing ones, in batches that repeat each other."""
    pick = random.Random(8)
    data = [(pick.choice("ab"), pick.choice([None, pick.randrange(50), pick.randrange(-99, 10**12)])) for _ in range(400)]
    store = DistinctStore(spark, str(tmp_path), ["k"], "m", StateOptions(mode, ttl_seconds=None))
    for batch_id, low in enumerate(range(0, 400, 100)):
        batch = spark.createDataFrame(data[max(0, low - 50) : low + 100], "k string, m long")
        store.update(batch, batch_id, ts("2024-01-01"))
        if batch_id == 1:
            store.compact(keep_last=0)
            store.vacuum()
    want = [([k], len({m for kk, m in data if kk == k and m is not None})) for k in "ab"]
    assert rows(store.current()) == want
    with pytest.raises(ValueError):
        DistinctStore(spark, str(tmp_path), ["k"], "m", StateOptions(ttl_seconds=5))
