"""A corpus pipeline: each stage is an operator applied to all that the stage before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfstrata.llm.common import shared_folder, table
from shelfstrata.llm.decontamination import drop_contaminated
from shelfstrata.llm.language import drop_rejected
from shelfstrata.llm.mixing import taken_per_document
from shelfstrata.llm.ngram_join import keep_one_of_each
from shelfstrata.llm.secrets import mask_secrets

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go."""
    return drop_rejected(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return mask_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document, what the mix takes of it."""
    return taken_per_document(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret_scans", secret_stage),
    ("mixing", mixing_stage),
]

#: Language models and MinHash signatures have no SQL: tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
