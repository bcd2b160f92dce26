"""Sources: requests, and files as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A folder of Parquet files, or a single file, as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(place).isFile():
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def requests(df: DataFrame, argument: str, request_id: str) -> DataFrame:
    """Requests: an id and an argument."""
    return df.select(F.col(request_id).alias("id"), F.col(argument).alias("arg"))
