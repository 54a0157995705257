"""The training-data pipeline: five operators in a row over the table ``documents``.

Each stage takes (spark, docs, folder of the tables) and returns documents again; its result is written
as Parquet and read back as the next one's input. A stage works on everything its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulyard.llm import decontaminate, mixing, pii, quality, simhash
from haulyard.llm.frames import table
from haulyard.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.filter_documents(docs, table(spark, folder, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that repeat benchmark passages go."""
    return decontaminate.drop_documents(docs, table(spark, folder, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data, and terms that give it away, are replaced in the texts."""
    return pii.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix takes, with their copies."""
    return mixing.mix(docs).where("copies > 0")


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixed),
]

#: the fingerprints' hash is not in DuckDB, so SQL cannot express the second stage; a brute-force version stands in the tests
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
