"""From raw documents to the shards of a training corpus, in five stages.

Each stage calls one operator of ``rebasket.llm`` on all rows that the stage
before it kept, and its result is written and read again.  The stages carry
every column of ``documents`` along; the last one adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.llm.decontaminate import clean
from rebasket.llm.minhash import keep_one_per_class
from rebasket.llm.mixing import mixed_documents
from rebasket.llm.sharding import sharded_rows
from rebasket.llm.toxicity import accepted, fit, held_out
from rebasket.session import new_path

SHARDS = 16
SHINGLE_WORDS = 5


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier does not reject (operator 7)."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return accepted(docs, fit(docs, labels, ~held_out()))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest doc_id (operator 2)."""
    return keep_one_per_class(docs, SHINGLE_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without their benchmark passages (operator 3)."""
    return clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What the mix takes of each document, a row per pass over its source (operator 1)."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All rows with their shard of equal bytes and their slot in it (operator 8)."""
    return sharded_rows(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None  # learned scores, sketches and a seeded mix: tested by brute force


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each read from what the one before it wrote."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
