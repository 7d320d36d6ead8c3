"""From raw documents to a training mix: five stages, each on all that the one before kept.

Toxic documents go, of exact copies and of near copies one stays, documents with benchmark
passages go, and what is left is mixed to target weights. Every stage's result is written as
Parquet to the folder that driver and executors share and read again, so no stage depends on
the tasks of an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from episeries.llm import decontamination, exact_dedup, mixing, simhash, toxicity
from episeries.llm.common import table
from episeries.sources.storage import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected: a calibrated toxicity of 0.5 or more, learned from this stage's documents."""
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def exact_copies_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.keep(docs)


def near_copies_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fingerprints connected through 4 bits or fewer the smallest doc_id stays."""
    return simhash.keep(docs)


def benchmark_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window stay."""
    return decontamination.keep(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies``."""
    return mixing.select(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_removed),
    ("exact dedup", exact_copies_removed),
    ("SimHash near-dedup", near_copies_removed),
    ("benchmark decontamination", benchmark_removed),
    ("mixing", mixed),
]

# Fitting trees is beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
