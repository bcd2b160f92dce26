"""Lookups by key, names and ranges, checked against plain Python."""

import pytest
from pyspark.sql import functions as F

from rowloom.functions import composite
from rowloom.operators import (
    ErrorPolicy,
    count_columns,
    lookup_composite_range,
    lookup_composite_slice,
    lookup_dispatch,
    lookup_filtered,
    lookup_or_empty,
    lookup_range,
    lookup_row,
    lookup_slice,
    map_composite_column,
    map_custom,
    multi_get,
    state_query,
)
from rowloom.plans import SkewOptions
from tests.util import NO_PYTHON, plan, rows

CELLS = "row_key string, column_name string, value string"


@pytest.fixture(scope="module")
def simple(spark):
    """The row with a composite key and four columns."""
    df = spark.createDataFrame([("north", "17", "red", "matt")], "zone string, plot string, hue string, gloss string")
    key = composite(zone="zone", plot="plot")
    cells = map_custom(df, key, {c: F.col(c) for c in df.columns})
    return df.select(key.alias("row_key")), cells


def names(found):
    return {r.column_name: r.value for r in found.collect()}


def test_row_by_composite_key(simple):
    requests, cells = simple
    assert names(lookup_row(requests, cells)) == {"zone": "north", "plot": "17", "hue": "red", "gloss": "matt"}


def test_range_includes_both_ends(simple):
    requests, cells = simple
    assert set(names(lookup_range(requests, cells, "gloss", "hue"))) == {"hue", "gloss"}
    asked = requests.withColumns({"start": F.lit("gloss"), "end": F.lit("hue")})
    assert set(names(lookup_range(asked, cells))) == {"hue", "gloss"}


def test_range_without_a_bound_gives_nothing(simple):
    requests, cells = simple
    asked = requests.withColumns({"start": F.lit("gloss"), "end": F.lit(None).cast("string")})
    assert names(lookup_range(asked, cells)) == {}
    assert names(lookup_range(requests, cells, "gloss", None)) == names(lookup_range(requests, cells, end="hue")) == {}


def test_slice_ignores_absent_names(simple):
    requests, cells = simple
    assert set(names(lookup_slice(requests, cells, ["hue", "gloss", "zone"]))) == {"hue", "gloss", "zone"}
    asked = requests.withColumn("slice", F.array(F.lit("hue"), F.lit("nope"), F.lit("hue")))
    assert rows(lookup_slice(asked, cells), "column_name", "value") == [("hue", "red")]


def test_missing_row(spark):
    cells = spark.createDataFrame([("a", "c", "1")], CELLS)
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, row_key string")
    assert rows(lookup_row(asked, cells), "id", "value") == [(1, "1")]
    assert rows(state_query(asked, cells), "id", "value") == [(1, "1"), (2, None), (3, None)]
    assert rows(count_columns(asked, cells), "id", "cols_n") == [(1, 1), (2, 0), (3, 0)]


PAIRS = ["pr", "qq", "ps", "pp", "rq", "pq", "sp", "rr"]
NAME = "struct<a:string,b:string>"


@pytest.fixture(scope="module")
def pairs(spark):
    df = spark.createDataFrame([("shelf", p[0], p[1], p) for p in PAIRS], "place string, a string, b string, value string")
    cells = map_composite_column(df, F.col("place"), composite(a="a", b="b"), F.col("value"))
    return df.select(F.col("place").alias("row_key")).distinct(), cells


def in_range(pair, start, end):
    """The rule in plain Python: parts count where both bounds are set, and only the last of them is a range."""
    given = [i for i in range(len(pair)) if start[i] is not None and end[i] is not None]
    return all(start[i] <= pair[i] <= end[i] if i == given[-1] else pair[i] == start[i] for i in given)


def as_name(parts):
    return composite(**{n: F.lit(v).cast("string") for n, v in zip("ab", parts)})


BOUNDS = [("pq", "pr"), ("pq", "rs"), ("p-", "r-"), ("-p", "-q"), ("p-", "rs"), ("--", "ss"), ("zz", "aa")]


@pytest.mark.parametrize(("start", "end"), BOUNDS)
@pytest.mark.parametrize("look", [lookup_composite_range, lookup_range, lookup_dispatch])
def test_composite_range(pairs, start, end, look):
    requests, cells = pairs
    lower, upper = ([None if c == "-" else c for c in bound] for bound in (start, end))
    want = sorted(p for p in PAIRS if in_range(p, lower, upper))
    if look is not lookup_dispatch:
        assert [r[0] for r in rows(look(requests, cells, lower, upper), "value")] == want
    asked = requests.withColumns({"start": as_name(lower), "end": as_name(upper)})
    assert [r[0] for r in rows(look(asked, cells), "value")] == want


@pytest.mark.parametrize("wanted", [[("p", None), ("r", "q"), ("x", None)], [("q", "q")], [(None, "q")], [(None, None)], []])
def test_composite_slice_matches_prefixes(pairs, wanted):
    requests, cells = pairs
    want = sorted({p for p in PAIRS for w in wanted if in_range(p, w, w)})
    for look in (lookup_composite_slice, lookup_slice):
        assert [r[0] for r in rows(look(requests, cells, wanted), "value")] == want
    names_ = F.array(*[as_name(w) for w in wanted]).cast(f"array<{NAME}>")
    asked = requests.withColumn("slice", names_)
    for look in (lookup_composite_slice, lookup_slice, lookup_dispatch):
        assert [r[0] for r in rows(look(asked, cells), "value")] == want


def test_three_part_range(spark):
    triples = [(a, b, c) for a in "uvwx" for b in "uvwx" for c in "uvwx"]
    df = spark.createDataFrame(triples, "a string, b string, c string")
    cells = map_composite_column(df, F.lit("cube"), composite(a="a", b="b", c="c"), F.concat("a", "b", "c"))
    asked = spark.createDataFrame([("cube",)], "row_key string")
    found = lookup_composite_range(asked, cells, ("v", "w", "u"), ("x", "x", "w"))
    assert rows(found, "value") == [("vwu",), ("vwv",), ("vww",)]


@pytest.fixture(scope="module")
def wide(spark):
    cells = spark.createDataFrame([(k, c, k + c) for k in "xyz" for c in "abcd"], CELLS)
    schema = "id int, row_key string, slice array<string>, start string, end string"
    asked = spark.createDataFrame(
        [
            (1, "x", ["a", "q"], "b", "c"),
            (2, "x", None, "b", "c"),
            (3, "y", None, "b", None),
            (4, "z", [], None, None),
            (5, "absent", None, None, None),
        ],
        schema,
    )
    return asked, cells


DISPATCHED = [(1, "a"), (2, "b"), (2, "c"), (3, "a"), (3, "b"), (3, "c"), (3, "d")]


@pytest.mark.parametrize("options", [None, SkewOptions(min_rows=1, share=0.01, always=True)])
def test_dispatch_per_request(wide, options):
    asked, cells = wide
    assert rows(lookup_dispatch(asked, cells, options), "id", "column_name") == DISPATCHED


def test_dispatch_has_only_keyed_joins(wide):
    text = plan(lookup_dispatch(*wide))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert not any(p in text for p in NO_PYTHON)


def test_filtered_requests_pass_with_empty_strings(wide):
    asked, cells = wide
    found = lookup_filtered(asked, cells, F.col("id") < 3, ["column_name", "value"])
    assert rows(found, "id", "column_name") == [(1, "a"), (2, "b"), (2, "c"), (3, ""), (4, ""), (5, "")]


def test_refused_requests_pass_with_empty_strings(wide):
    asked, cells = wide
    rules = {"odd": F.col("id") == 5, "four": F.col("id") == 4}
    policy = ErrorPolicy().empty_on("odd")
    found = lookup_or_empty(asked, rules, policy, lambda good: lookup_dispatch(good, cells), ["column_name", "value"])
    assert rows(found, "id", "column_name") == [*DISPATCHED, (5, "")]


def test_multi_get_keeps_order_and_repeats(spark):
    state = spark.createDataFrame([(["a"], 1), (["b"], 2)], "key array<string>, n int")
    asked = spark.createDataFrame([(1, ["b"]), (2, ["zz"]), (3, ["b"]), (4, ["a"])], "place int, key array<string>")
    assert rows(multi_get(asked, state), "place", "n") == [(1, 2), (2, None), (3, 2), (4, 1)]
