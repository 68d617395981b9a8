"""The queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import binpack, bksimhash, bpedp, dcsuffix, exthash, hdlang, mih, secretidx, superkmer, toxseg
from .common import table


def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.self_search(table(spark, sf_dir, "embeddings"))


def op2_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.kept_words(table(spark, sf_dir, "documents"), texts=False)


def op3_hd_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hdlang.identify(table(spark, sf_dir, "documents"))


def op4_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxseg.score(docs, toxseg.fit(docs, table(spark, sf_dir, "labels")))


def op5_bpe_prefix_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpedp.encode_digests(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dcsuffix.kept_bytes(table(spark, sf_dir, "documents"))


def op7_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binpack.pack(table(spark, sf_dir, "documents"))


def op8_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bksimhash.near_groups(table(spark, sf_dir, "documents"))


def op9_extendible_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exthash.exact_groups(table(spark, sf_dir, "documents")).drop("bucket")


def op10_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretidx.secret_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_multi_index_hashing,
        op2_superkmer_dedup,
        op3_hd_language_id,
        op4_toxic_segments,
        op5_bpe_prefix_dp,
        op6_suffix_array_dedup,
        op7_bounded_packing,
        op8_simhash_bk_trees,
        op9_extendible_hash_dedup,
        op10_trigram_secret_scan,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op9_extendible_hash_dedup": """
        SELECT doc_id,
               max(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
