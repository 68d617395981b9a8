"""Manual rejections and the ledger of finished work, as semi and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import or_blank, stem


def _keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.trim(column).alias(column)).where(F.col(column) != "").distinct()


def resolved(rejections: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Utterance ids and audio file names of rejections, resolved to paths and
    hashes through the metadata of an earlier export; and the ids not found."""
    ids = rejections.select(F.explode(F.array(F.trim("utterance_id"), stem(F.trim("audio_filename")))).alias("utterance_id")).where(F.col("utterance_id") != "").distinct()
    known = metadata.select("utterance_id", "candidate_path", "sha1")
    return known.join(ids, "utterance_id", "left_semi"), ids.join(known, "utterance_id", "left_anti")


def mark_rejected(candidates: DataFrame, rejections: DataFrame) -> DataFrame:
    """candidates with manual_rejected (0 or 1): by path, by hash, and by the hash
    of any candidate that is rejected by path, so that all copies go."""
    paths, hashes = _keys(rejections, "candidate_path"), _keys(rejections, "sha1")
    of_paths = candidates.join(paths, "candidate_path", "left_semi").select("sha1").where(F.trim("sha1") != "")
    hashes = hashes.union(of_paths).distinct().withColumn("__hash", F.lit(1))
    out = candidates.join(paths.withColumn("__path", F.lit(1)), "candidate_path", "left").join(hashes, "sha1", "left")
    return out.withColumn("manual_rejected", (F.col("__path").isNotNull() | F.col("__hash").isNotNull()).cast("int")).drop("__path", "__hash")


def not_done(units: DataFrame, ledger: DataFrame) -> DataFrame:
    """Units of a speaker that the ledger doesn't hold."""
    return units.join(ledger.select("speaker_id", "processing_unit_id").distinct(), ["speaker_id", "processing_unit_id"], "left_anti")


def existing(candidates: DataFrame, files: DataFrame, path: str = "candidate_path") -> DataFrame:
    """candidates with file_exists, by a listing of files."""
    listed = files.select(F.col("path").alias(path)).distinct().withColumn("__there", F.lit(1))
    return candidates.join(listed, path, "left").withColumn("file_exists", F.col("__there").isNotNull()).drop("__there")


def digest(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn("digest", or_blank("sha1", "candidate_path"))
