"""From raw documents to packed training sequences.

Language ID rejects texts without a language, exact dedup keeps one row of equal
texts, near-dedup one document of each SimHash group, the secret scan replaces
secrets by their kind, and packing cuts the rest into sequences. Each stage reads
all that the one before it kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cliploom.llm import binpack, bksimhash, exthash, hdlang, secretidx
from cliploom.llm.common import delete, held, release_since, shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hdlang.with_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exthash.dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bksimhash.dedup(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secretidx.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return binpack.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL can't express the learned language model, fingerprints' majorities and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage is written and read again; what it needed
    besides, and the stage before it, is deleted as soon as it stands."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_dir(spark)}/cliploom-pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        mark = held()
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        release_since(spark, mark)
        if before:
            delete(spark, f"{folder}/{before}")
        docs, before = spark.read.parquet(f"{folder}/{name}"), name
    return docs
