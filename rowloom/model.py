"""The cell model: schemas, fixed values and the supported types."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
NULL_PART = "[NULL]"
GLOBAL_KEY = "globalkey"
DEFAULT_STATE_TTL_SECONDS = 86400

# The cell types a key, column name or value may have, and their Spark types.  A date is an instant.  A
# big integer outside decimal(38,0) raises under ANSI mode instead of turning into null.
CELL_TYPES = {
    "uuid": T.StringType(),
    "string": T.StringType(),
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "big integer": T.DecimalType(38, 0),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
    "date": T.TimestampType(),
    "dynamic composite": T.ArrayType(T.StringType()),
}

ROUTE = ("keyspace", "table")
CELL_ID = ("row_key", "column_name")


def cell_type(name: str | T.DataType) -> T.DataType:
    """The Spark type of a cell type name.  A composite is given as its ``StructType``."""
    if isinstance(name, T.DataType):
        return name
    if name not in CELL_TYPES:
        raise ValueError(f"unknown cell type {name!r}; known: {', '.join(CELL_TYPES)}, or a StructType")
    return CELL_TYPES[name]


def cell_schema(key="string", name="string", value="string", order=T.TimestampNTZType()) -> T.StructType:
    """Schema of a cell log with typed key, column name, value and write order."""
    return T.StructType(
        [
            T.StructField("keyspace", T.StringType()),
            T.StructField("table", T.StringType()),
            T.StructField("row_key", cell_type(key)),
            T.StructField("column_name", cell_type(name)),
            T.StructField("value", cell_type(value)),
            T.StructField("write_ts", cell_type(order)),
            T.StructField("seq", T.LongType()),
            T.StructField("is_deleted", T.BooleanType()),
            T.StructField("expires_at", cell_type(order)),
        ]
    )


def counter_schema(key="string", name="string") -> T.StructType:
    """Schema of a counter delta log."""
    return T.StructType(
        [
            T.StructField("keyspace", T.StringType()),
            T.StructField("table", T.StringType()),
            T.StructField("row_key", cell_type(key)),
            T.StructField("column_name", cell_type(name)),
            T.StructField("amount", T.LongType()),
        ]
    )
