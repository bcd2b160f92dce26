"""A Python mapper over all columns of a row."""

import pyarrow as pa
import pytest

from rowloom.operators import columns_together
from tests.util import rows


SCHEMA = "id long, n long, batches long, rising boolean, ends string"


def mapper():
    """How many columns and batches, whether names rise, and the first and last of them."""

    def run(request, batches):
        names = [b.column(0).to_pylist() for b in batches]
        flat = [n for part in names for n in part]
        columns = {"id": [request[0]], "n": [len(flat)], "batches": [len(names)], "rising": [flat == sorted(flat)], "ends": [f"{flat[0]}-{flat[-1]}"]}
        kinds = {"id": pa.int64(), "n": pa.int64(), "batches": pa.int64(), "rising": pa.bool_(), "ends": pa.string()}
        yield pa.RecordBatch.from_pydict(columns, schema=pa.schema(kinds))

    return run


def test_a_row_wider_than_a_batch(spark):
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        wide = spark.range(1050).selectExpr("7L AS id", "format_string('%05d', 1049 - id) AS column_name", "'v' AS value", "'k' AS row_key")
        few = spark.createDataFrame([(8, "b", "1", "k"), (8, "a", None, "k"), (None, "x", "2", "k")], "id long, column_name string, value string, row_key string")
        found = columns_together(wide.unionByName(few).repartition(6), "id", mapper(), SCHEMA)
        assert rows(found) == [(7, 1050, 11, True, "00000-01049"), (8, 2, 1, True, "a-b"), (None, 1, 1, True, "x-x")]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_several_ids_and_no_rows(spark):
    found = spark.createDataFrame([(1, "p", "n", "v"), (1, "q", "m", "v")], "id long, part string, column_name string, value string")

    def both():
        def run(request, batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"id": [request[0]], "part": [request[1]], "name": [b.column(0)[0].as_py()]})

        return run

    out = columns_together(found, ["id", "part"], both(), "id long, part string, name string")
    assert rows(out) == [(1, "p", "n"), (1, "q", "m")]
    assert columns_together(found.limit(0), ["id", "part"], both(), "id long, part string, name string").count() == 0


def test_a_failing_mapper_stops_the_query(spark):
    def stops(request, batches):
        raise ValueError("no mapping")
        yield

    found = spark.createDataFrame([(1, "n", "v")], "id long, column_name string, value string")
    with pytest.raises(Exception, match="no mapping"):
        columns_together(found, "id", stops, "id long").collect()
