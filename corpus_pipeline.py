"""The corpus pipeline: each stage reads what the one before it kept, written as Parquet.

run(spark, sf_dir) applies the stages to `documents`. No SQL expresses the first stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.common import table
from feedloom.llm.decontaminate import without_benchmark
from feedloom.llm.language import fit_network, fold, keep_identified
from feedloom.llm.mixing import mixed
from feedloom.llm.secrets import without_secrets
from feedloom.llm.simhash import keep_one_of_each_group
from feedloom.session import ensure_checkpoint_dir, prepare


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network determines; those it rejects go."""
    net = fit_network(docs.where(fold(docs["doc_id"], 5) != 0))
    return keep_identified(docs, net)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    return keep_one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a secret in a text is replaced by its kind."""
    return without_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with what it takes of them, in training order."""
    return mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result but the last is written to the shared folder and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    ensure_checkpoint_dir(spark)
    shared = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{shared}/{name}")
        docs = spark.read.parquet(f"{shared}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
