"""Rejected rows and error policies."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowloom.operators import ErrorPolicy, counter_rules, key_rules, keyspace_rules, map_counter, split_rejects
from tests.util import rows


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([("a", 1), (None, 2), ("c", None), (None, None)], "k string, v int")


def rules():
    return {**key_rules("k"), "null_value": F.col("v").isNull(), "two": F.col("v") == 2}


def test_first_rule_gives_the_reason(numbers):
    good, bad = split_rejects(numbers, rules())
    assert rows(good) == [("a", 1)]
    assert rows(bad, "reason") == [("null_row_key",), ("null_row_key",), ("null_value",)]


def test_actions(numbers):
    parts = ErrorPolicy().reject_on("null_row_key").empty_on("null_value").apply(numbers, rules())
    assert {name: part.count() for name, part in parts.items()} == {"good": 1, "reject": 2, "empty": 1}
    assert parts["good"].columns == ["k", "v"]


def test_default_is_to_ignore(numbers):
    parts = ErrorPolicy().apply(numbers, rules())
    assert {name: part.count() for name, part in parts.items()} == {"good": 1, "reject": 0, "empty": 0}
    assert ErrorPolicy().with_default("reject").apply(numbers, rules())["reject"].count() == 3


def test_fail_stops_the_job_but_only_for_its_reason(numbers):
    with pytest.raises(PySparkException, match="null_value"):
        ErrorPolicy().fail_on("null_value").apply(numbers, rules())["good"].collect()
    assert ErrorPolicy().fail_on("two").apply(numbers, rules())["good"].count() == 1


def test_a_reason_has_one_action():
    with pytest.raises(ValueError):
        ErrorPolicy().fail_on("a").reject_on("b", "a")
    with pytest.raises(ValueError):
        ErrorPolicy({"a": "retry"})


def test_keyspaces_in_lower_case(spark):
    df = spark.createDataFrame([("Main",), ("other",), (None,)], "keyspace string")
    good, bad = split_rejects(df, keyspace_rules(["mAin"]))
    assert (rows(good), bad.count()) == ([("Main",)], 2)


def test_counter_rules(spark):
    df = spark.createDataFrame([("k", 1, "c"), (None, 1, "c"), ("k", None, "c"), ("k", 1, None)], "k string, n long, c string")
    increments = map_counter(df, "k", "n")
    _, bad = split_rejects(increments, counter_rules(increments))
    assert rows(bad, "reason") == [("null_amount",), ("null_counter_column",), ("null_row_key",)]
