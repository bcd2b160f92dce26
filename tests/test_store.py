"""Cell, counter and value stores: order of writes, deletes, expiry, replay, compaction, routing."""

import random
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowloom.model import cell_schema
from rowloom.operators import Write, lookup_row, lookup_slice, map_counter, map_custom, map_default, resolve_latest
from rowloom.sources import CellStore, CounterStore, StateOptions, emit_constant, get_values, put_values
from tests.util import plan, rows, ts

WRITES = "k string, c string, v string, at timestamp_ntz, n long, gone boolean, t string"


def cells_of(df, **write):
    entry = F.array(F.struct(F.col("c").alias("column_name"), F.col("v").alias("value")))
    options = {"delete_when": F.col("gone"), "table": F.col("t"), **write}
    return map_custom(df, F.col("k"), entry, Write("at", "n", **options))


def random_writes(at, n=300, seed=1):
    rnd = random.Random(seed)
    return [
        (rnd.choice("kl"), rnd.choice("abc"), rnd.choice("xyz"), at(rnd.randrange(12)), rnd.randrange(3),
         rnd.random() < 0.3, "t")
        for _ in range(n)
    ]


def expected(writes):
    last = {}
    for k, c, v, at, n, gone, _ in writes:
        version = (at, n, gone, v)
        last[k, c] = max(last.get((k, c), version), version)
    return sorted(((k, c, x[3]) for (k, c), x in last.items() if not x[2]), key=repr)


def test_latest_version_whatever_the_order(spark, at):
    writes = random_writes(at)
    for seed in range(3):
        random.Random(seed).shuffle(writes)
        df = spark.createDataFrame(writes, WRITES).repartition(5)
        found = resolve_latest(cells_of(df))
        assert rows(found, "row_key", "column_name", "value") == expected(writes)


def test_delete_wins_at_the_same_time_and_older_put_stays_deleted(spark, at):
    writes = [("k", "a", "z", at(5), 0, False, "t"), ("k", "a", "x", at(5), 0, True, "t"), ("k", "a", "y", at(4), 9, False, "t")]
    assert rows(resolve_latest(cells_of(spark.createDataFrame(writes, WRITES)))) == []


def test_delete_leaves_other_columns(spark, at):
    writes = [("k", "a", "1", at(1), 0, False, "t"), ("k", "b", "2", at(1), 0, False, "t"), ("k", "a", "", at(2), 0, True, "t")]
    found = resolve_latest(cells_of(spark.createDataFrame(writes, WRITES)))
    assert rows(found, "column_name", "value") == [("b", "2")]


@pytest.mark.parametrize(("ttl", "alive"), [(None, True), (0, True), (-5, True), (10, False), (11, True)])
def test_expiry(spark, at, ttl, alive):
    df = spark.createDataFrame([("k", "a", "1", at(0), 0, False, "t")], WRITES)
    found = resolve_latest(cells_of(df, ttl_seconds=ttl), ts("2024-01-01 00:00:10"))
    assert (found.count() == 1) is alive


def test_expired_last_version_does_not_bring_back_an_older_one(spark, at):
    df = spark.createDataFrame([("k", "a", "old", at(0), 0, False, "t")], WRITES)
    newer = spark.createDataFrame([("k", "a", "new", at(1), 0, False, "t")], WRITES)
    both = cells_of(df).unionByName(cells_of(newer, ttl_seconds=5))
    assert rows(resolve_latest(both, ts("2024-01-01 01:00:00"))) == []


def test_stopped_and_repeated_batches(spark, at, tmp_path):
    writes = random_writes(at)
    store = CellStore(spark, str(tmp_path / "cells"))
    for batch in (0, 1, 2, 1):
        store.put(spark.createDataFrame(writes[batch * 100 : batch * 100 + 100], WRITES), cells_of, batch)
    assert rows(store.cells(), "row_key", "column_name", "value") == expected(writes)
    unfinished = tmp_path / "cells" / "writer=main" / "batch_id=3"
    unfinished.mkdir()
    assert (unfinished.name, store.log.batches()) == ("batch_id=3", [("main", 0), ("main", 1), ("main", 2)])


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_compaction_at_any_point_keeps_the_result(spark, at, tmp_path, order):
    writes = random_writes(at, seed=4)
    store = CellStore(spark, str(tmp_path / "cells"))
    for batch in order:
        store.put(spark.createDataFrame(writes[batch * 100 : batch * 100 + 100], WRITES), cells_of, batch)
        store.compact(keep_last=0)
    assert store.log.snapshots() == [1, 2, 3]
    assert rows(store.cells(), "row_key", "column_name", "value") == expected(writes)
    with pytest.raises(ValueError, match="part of a snapshot"):
        store.put(spark.createDataFrame(writes[:100], WRITES), cells_of, 0)
    assert rows(store.cells(), "row_key", "column_name", "value") == expected(writes)


def test_compaction_leaves_the_newest_batch_open(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    row = lambda v: spark.createDataFrame([("k", "a", v, at(1), 0, False, "t")], WRITES)
    store.put(row("a"), cells_of, 0)
    assert store.compact() is None
    store.put(row("b"), cells_of, 1)
    store.compact()
    store.put(row("0"), cells_of, 1)
    assert rows(store.cells(), "value") == [("a",)]
    assert store.compact() is None


def test_covered_batches_may_be_removed(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    writes = random_writes(at, seed=9)
    for batch in range(3):
        store.put(spark.createDataFrame(writes[batch * 100 : batch * 100 + 100], WRITES), cells_of, batch)
        store.compact(keep_last=0)
        shutil.rmtree(tmp_path / "cells" / "writer=main" / f"batch_id={batch}")
    assert (store.log.batches(), store.compact()) == ([], None)
    assert rows(store.cells(), "row_key", "column_name", "value") == expected(writes)


def test_reading_a_snapshot_needs_no_shuffle(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    writes = random_writes(at, seed=2)
    store.put(spark.createDataFrame(writes[:200], WRITES), cells_of, 0)
    store.compact(keep_last=0)
    assert "Exchange" not in plan(store.cells())
    store.put(spark.createDataFrame(writes[200:], WRITES).where("k = 'l'"), cells_of, 1)
    found = store.cells()
    want = expected(writes[:200] + [w for w in writes[200:] if w[0] == "l"])
    assert rows(found, "row_key", "column_name", "value") == want
    text = plan(found)
    assert "LeftAnti" in text and "LeftSemi" in text and "SortMergeJoin" not in text and "NestedLoop" not in text
    store.compact(keep_last=0)
    assert rows(store.cells(), "row_key", "column_name", "value") == want


def test_purge_drops_old_deletes(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    writes = [("k", "a", "", at(1), 0, True, "t"), ("k", "b", "", at(9), 0, True, "t"), ("k", "c", "1", at(1), 0, False, "t")]
    store.put(spark.createDataFrame(writes, WRITES), cells_of, 0)
    store.compact(keep_last=0, purge_before=ts("2024-01-01 00:00:05"))
    assert rows(store.versions(), "column_name") == [("b",), ("c",)]


def test_writers_do_not_overwrite_each_other(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    for writer, v in (("w1", "a"), ("w2", "b")):
        store.put(spark.createDataFrame([("k", writer, v, at(1), 0, False, "t")], WRITES), cells_of, 0, writer)
    assert rows(store.cells(), "column_name", "value") == [("w1", "a"), ("w2", "b")]


def test_tables_and_keyspaces_are_directories(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    writes = [("k", "a", "1", at(1), 0, False, t) for t in ("t1", "t2", "2024")]
    mapper = lambda df: cells_of(df, keyspace=F.concat(F.lit("ks_"), "t"))
    back = store.put(spark.createDataFrame(writes, WRITES), mapper, 0, many_tables=True)
    assert back.count() == 3
    assert rows(store.cells(), "keyspace", "table") == [("ks_2024", "2024"), ("ks_t1", "t1"), ("ks_t2", "t2")]
    one = store.cells("ks_t1", "t1")
    assert rows(one, "table") == [("t1",)]
    assert "PartitionFilters: [isnotnull(keyspace" in plan(one)


def test_lookup_filters_reach_the_scan(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    store.put(spark.createDataFrame(random_writes(at), WRITES), cells_of, 0)
    asked = spark.createDataFrame([("k",)], "row_key string").persist()
    assert asked.count() == 1
    text = plan(lookup_slice(asked, store.cells(table="t"), ["a"]))
    assert "EqualTo(column_name,a)" in text
    found = store.lookup(asked, lookup_row, table="t")
    assert {r.row_key for r in found.collect()} == {"k"}
    text = plan(found)
    assert text.index("LeftSemi") > text.index("Exchange hashpartitioning")  # rows are left out below the fold
    assert "NestedLoop" not in text and "Python" not in text


def test_missing_key_stops_the_write(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    with pytest.raises(PySparkException):
        store.put(spark.createDataFrame([(None, "a", "1", at(1), 0, False, "t")], WRITES), cells_of, 0)
    assert store.log.batches() == [] and store.cells().count() == 0


def test_wrong_type_is_refused(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"), cell_schema(value="long"))
    with pytest.raises(TypeError):
        store.put(spark.createDataFrame([("k", "a", "1", at(1), 0, False, "t")], WRITES), cells_of, 0)


def test_typed_and_composite_cells_come_back(spark, at, tmp_path):
    key = "struct<a:string,b:int>"
    df = spark.createDataFrame([(("x", 1), 5, at(1))], f"k {key}, v long, at timestamp_ntz")
    store = CellStore(spark, str(tmp_path / "cells"), cell_schema(df.schema["k"].dataType, "string", "long"))
    store.put(df, lambda d: map_custom(d, F.col("k"), {"v": F.col("v")}, Write("at")), 0)
    assert rows(store.cells(), "row_key.a", "row_key.b", "value") == [("x", 1, 5)]


@pytest.mark.parametrize(("order", "values"), [("long", [1, 2]), ("date", ["2024-01-01", "2024-01-02"])])
def test_other_orders_of_writes(spark, tmp_path, order, values):
    store = CellStore(spark, str(tmp_path / "cells"), cell_schema(order=order))
    kind = store.log.schema["write_ts"].dataType
    df = spark.createDataFrame([("k", str(v)) for v in values], "k string, v string")
    df = df.withColumn("o", F.col("v").cast(kind))
    store.put(df, lambda d: map_custom(d, F.col("k"), {"v": F.col("v")}, Write("o")), 0)
    assert rows(store.cells(), "value") == [(str(values[1]),)]


def test_put_then_emit(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "cells"))
    df = spark.createDataFrame([("k", at(1))], "k string, at timestamp_ntz")
    out = store.put_then_emit(df, lambda d: map_default(d, "k", ["k"], Write("at")), 0, "done", "ok")
    assert rows(out, "k", "done") == [("k", "ok")]
    assert rows(store.cells(), "value") == [("k",)]
    assert emit_constant(df, "done", None).count() == 0


def test_counters(spark, tmp_path):
    store = CounterStore(spark, str(tmp_path / "counters"))
    df = spark.createDataFrame([("1", 1, "c"), ("1", 2, "c"), ("2", -5, "d")], "k string, n long, c string")
    mapper = lambda d: map_counter(d, "k", "n")
    for batch in (0, 1, 1):
        store.increment(df, mapper, batch)
    want = [("1", "c", 6), ("2", "d", -10)]
    assert rows(store.counters(), "row_key", "column_name", "amount") == want
    store.compact()
    store.increment(df, mapper, 1)
    assert rows(store.counters("main", "counters"), "row_key", "column_name", "amount") == want
    with pytest.raises(PySparkException):
        store.increment(spark.createDataFrame([("1", 1, None)], "k string, n long, c string"), mapper, 2)


def test_values_by_key_with_time_to_live(spark, at, tmp_path):
    store = CellStore(spark, str(tmp_path / "values"), cell_schema(key="dynamic composite"))
    df = spark.createDataFrame([(1, None, "v", at(0))], "a int, b string, v string, at timestamp_ntz")
    options = StateOptions(ttl_seconds=10)
    put_values(store, df, ["a", "b"], "v", 0, "at", options=options)
    assert rows(get_values(store, options, ts("2024-01-01 00:00:09"))) == [(["1", "[NULL]"], "v")]
    assert rows(get_values(store, options, ts("2024-01-01 00:00:10"))) == []
