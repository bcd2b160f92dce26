"""The corpus pipeline: documents go through the stages in order, each written as Parquet and read again.

Low quality goes, one document of each class of near-duplicates stays, documents that hold benchmark items go, sources are
mixed to damped shares, and what is left is put into shards. Every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm.minimax_shards import minimax_shards
from rowloom.llm.ordinal_quality import accepted_rows, ratings, train
from rowloom.llm.pigeon_simhash import one_of_each
from rowloom.llm.poisson_mix import poisson_mix
from rowloom.llm.spaced_seeds import without_leaks
from rowloom.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are at least of grade 1 with a chance of one half or more."""
    rated = ratings(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return accepted_rows(docs, train(docs, rated))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the smallest doc_id."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources have damped shares, in random order."""
    return poisson_mix(docs, counted=False)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and the slot of every row."""
    return minimax_shards(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", dedup),
    ("benchmark decontamination", decontaminate),
    ("source mix", mix),
    ("shards", shard),
]

ORACLE_SQL = None  # a trained classifier has no SQL form; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
