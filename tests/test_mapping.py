"""Rows to cells, null and text rules, columns back to rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowloom.functions import composite, split_parts, state_key, words
from rowloom.model import CELL_TYPES, cell_type
from rowloom.operators import (
    Write,
    columns_to_rows,
    delimited,
    map_composite_column,
    map_composite_key,
    map_counter,
    map_custom,
    map_default,
    valueless,
)
from tests.util import plan, rows


def test_default_mapping_writes_the_key_field_too(spark):
    cells = map_default(spark.createDataFrame([(42,)], "VALUE int"), "VALUE")
    assert rows(cells) == [("42", "VALUE", "42")]


def test_null_value_is_the_empty_string(spark):
    cells = map_default(spark.createDataFrame([("k", None)], "k string, v int"), "k")
    assert rows(cells) == [("k", "k", "k"), ("k", "v", "")]


def test_composite_key_leaves_out_its_fields_and_marks_nulls(spark):
    df = spark.createDataFrame([(1, None, "x", None)], "a int, b string, c string, d string")
    assert rows(map_composite_key(df, ["a", "b"])) == [(["1", "[NULL]"], "c", "x"), (["1", "[NULL]"], "d", "")]


def test_state_key_parts_are_text(spark):
    df = spark.range(1).select(state_key(F.lit(1), F.lit(None)).alias("a"), state_key(F.lit("1"), F.lit(None)).alias("b"))
    assert rows(df) == [(["1", "[NULL]"], ["1", "[NULL]"])]


def test_counter_names_are_values(spark):
    df = spark.createDataFrame([("gate 7", 4, "Arrivals")], "gate string, people bigint, direction string")
    cells = map_counter(df, "gate", "people", table="Gates")
    assert rows(cells, "table", "row_key", "column_name", "amount") == [("Gates", "gate 7", "Arrivals", 4)]


def test_counter_amount_must_be_whole(spark):
    df = spark.createDataFrame([("1", 1.5, "c")], "k string, n double, c string")
    with pytest.raises(TypeError):
        map_counter(df, "k", "n")


def test_custom_mapping_with_names_from_data(spark):
    df = spark.createDataFrame([("k", "n", 5, True)], "k string, n string, v bigint, gone boolean")
    entry = F.array(F.struct(F.col("n").alias("column_name"), F.col("v").alias("value")))
    write = Write(F.lit("2024-01-01").cast("timestamp_ntz"), table=F.col("n"), keyspace="ks", delete_when=F.col("gone"))
    cells = map_custom(df, F.col("k"), entry, write)
    assert rows(cells, "keyspace", "table", "row_key", "column_name", "value", "is_deleted") == [
        ("ks", "n", "k", "n", 5, True)
    ]


def test_composite_column(spark):
    df = spark.createDataFrame([("r", "a", "b", "ab")], "rowkey string, a string, b string, value string")
    cells = map_composite_column(df, F.col("rowkey"), composite(a="a", b="b"), F.col("value"))
    assert rows(cells, "row_key", "column_name.a", "column_name.b", "value") == [("r", "a", "b", "ab")]


def test_mapping_is_narrow_and_stays_in_the_jvm(spark):
    text = plan(map_default(spark.range(10).withColumn("v", F.col("id") * 2), "id"))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize(
    ("value", "parts"),
    [("a:b::", ["a", "b"]), ("", [""]), (":::", []), (":a", ["", "a"]), ("a::b", ["a", "", "b"]), (None, None)],
)
def test_split_drops_empty_parts_at_the_end_only(spark, value, parts):
    df = spark.createDataFrame([(value,)], "v string").select(split_parts("v", ":"))
    assert df.first()[0] == parts


def test_split_takes_a_regular_expression(spark):
    df = spark.createDataFrame([("a|b1c",)], "v string").select(split_parts("v", r"\||\d"))
    assert df.first()[0] == ["a", "b", "c"]


def test_words(spark):
    assert spark.createDataFrame([(" red  kite ",)], "s string").select(words("s")).first()[0] == ["red", "kite"]


EDGES = {"ines": "otto:pia", "karl": "pia:ugo:vera", "none": ""}


def test_delimited_and_valueless_give_the_same_edges(spark):
    joined = spark.createDataFrame([(k, "followers", v) for k, v in EDGES.items() if v], "row_key string, column_name string, value string")
    long = spark.createDataFrame([(k, n, "") for k, v in EDGES.items() if v for n in v.split(":")],
                                 "row_key string, column_name string, value string")
    a = delimited(joined.withColumn("id", F.lit(7)), "followers", ":", "source", "follower", "id")
    b = valueless(long.withColumn("id", F.lit(7)), "source", "follower", "id")
    assert rows(a) == rows(b)
    assert a.columns == ["id", "source", "follower"]


def test_delimited_without_the_column_gives_nothing(spark):
    df = spark.createDataFrame([("k", "other", "a:b")], "row_key string, column_name string, value string")
    assert rows(delimited(df, "followers", ":", "k", "v")) == []


def test_columns_to_rows_may_give_none_or_many(spark):
    df = spark.createDataFrame([("k", "a", 2), ("k", "b", 0), ("k", "c", None)], "row_key string, column_name string, value int")
    many = F.when(F.col("value").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("value")), lambda i: F.struct(i.alias("i"))))
    made = columns_to_rows(df.where("value is null or value >= 0"), many, ["column_name"])
    assert rows(made) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]


def test_cell_types():
    assert cell_type("big integer").simpleString() == "decimal(38,0)"
    assert len(CELL_TYPES) == 13
    with pytest.raises(ValueError):
        cell_type("interval")


def test_big_integer_out_of_range_raises(spark):
    df = spark.createDataFrame([("9" * 39,)], "v string").select(F.col("v").cast(cell_type("big integer")))
    with pytest.raises(PySparkException):
        df.collect()
