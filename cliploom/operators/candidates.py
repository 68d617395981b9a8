"""From verified segments to candidate rows, utterances and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.columns import padded
from ..schema import CANDIDATES, conform
from .gates import candidate_rank


def candidate_rows(segments: DataFrame, windows: DataFrame, s: Settings) -> DataFrame:
    """Segments (with speaker, track and audio columns, in window time) as candidate
    rows in video time, numbered in each (speaker, video) in the order of their windows
    (visit, where windows have it)."""
    placed = F.col("visit") if "visit" in windows.columns else F.col("start")
    begin = F.col("start")
    of = windows.select("video_id", F.col("tag").alias("chunk_tag"), begin.alias("chunk_start"), (begin + F.col("duration")).alias("chunk_end"), placed.alias("__visit"))
    both = segments.drop("chunk_start", "chunk_end").join(of, ["video_id", "chunk_tag"])
    local = both.withColumnsRenamed({"start": "local_start", "end": "local_end"})
    timed = local.withColumn("start", F.col("chunk_start") + F.col("local_start")).withColumn("end", F.col("chunk_start") + F.col("local_end"))
    unit = timed.withColumn("processing_unit_id", F.concat_ws("::", "video_id", "chunk_tag"))
    unit = unit.withColumn("duration", F.coalesce(F.col("duration") if "duration" in segments.columns else F.lit(None), F.col("end") - F.col("start")))
    ties = [c for c in ("track_id", "candidate_path") if c in segments.columns]
    order = Window.partitionBy("speaker_id", "video_id").orderBy("__visit", "start", "end", *ties)
    numbered = unit.withColumn("candidate_idx", F.row_number().over(order) - 1).withColumn("pipeline_version", F.lit(s.pipeline_version))
    ranked = candidate_rank(numbered, s)
    relaxed = F.lit(s.candidate_profile == "relaxed")
    review = F.coalesce(F.col("requires_manual_validation"), F.lit(False)) | relaxed if "requires_manual_validation" in ranked.columns else relaxed
    ranked = ranked.withColumn("requires_manual_validation", review)
    return conform(ranked, CANDIDATES, {"approved": 0, "candidate_profile": s.candidate_profile}, keep=False)


def with_utterances(approved: DataFrame, split: str = "dev", root: str = "wav") -> DataFrame:
    """Approved rows with utterance_id, set, audio_path and export_path, numbered in
    each (speaker, video) by approved_index, else by selection order. The export path
    begins with wav, the audio path with `root`."""
    order = "approved_index" if "approved_index" in approved.columns else "selection_rank"
    at = F.row_number().over(Window.partitionBy("speaker_id", "video_id").orderBy(order)) - 1
    named = approved.where("approved = 1").withColumn("utterance_id", F.concat_ws("_", "video_id", padded(at, 5))).withColumn("set", F.lit(split))
    path = F.concat(F.concat_ws("/", "speaker_id", "video_id", "utterance_id"), F.lit(".wav"))
    return named.withColumn("export_path", F.concat_ws("/", F.lit("wav"), path)).withColumn("audio_path", F.concat_ws("/", F.lit(root.rstrip("/")), path))


def copy_plan(utterances: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source, target) of files to copy, and stale files of exported speakers."""
    copies = utterances.select(F.col("candidate_path").alias("source"), F.col("audio_path").alias("target"))
    speakers = utterances.select("speaker_id").distinct()
    of = listed.withColumn("speaker_id", F.element_at(F.split("path", "/"), -3)).join(speakers, "speaker_id", "left_semi")
    return copies, of.join(utterances.select(F.col("audio_path").alias("path")), "path", "left_anti").select("path")


def train_list(utterances: DataFrame) -> DataFrame:
    return utterances.select(F.concat_ws(" ", "speaker_id", "export_path").alias("value")).orderBy("value")


def located(metadata: DataFrame, listed: DataFrame, root: str) -> DataFrame:
    """metadata (audio_path) with source: the listed file below `root`, else the one
    at the path itself, else null."""
    files = listed.select("path").distinct()
    below = files.select(F.col("path").alias("__below"), F.lit(1).alias("__b"))
    there = files.select(F.col("path").alias("__there"), F.lit(1).alias("__t"))
    relative = F.concat(F.lit(root.rstrip("/") + "/"), F.col("audio_path"))
    out = metadata.join(below, relative == F.col("__below"), "left").join(there, F.col("audio_path") == F.col("__there"), "left")
    return out.withColumn("source", F.coalesce("__below", "__there")).drop("__below", "__b", "__there", "__t")


def with_names(rows: DataFrame, speakers: DataFrame) -> DataFrame:
    """rows with the name and gender of their speaker, else their own, else unknown."""
    known = speakers.select("speaker_id", F.col("name").alias("__name"), F.col("gender").alias("__gender"))
    own = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    out = rows.join(known, "speaker_id", "left")
    return out.withColumn("speaker_name", F.coalesce("__name", own("speaker_name"), "speaker_id")).withColumn("gender", F.coalesce("__gender", own("gender"), F.lit("unknown"))).drop("__name", "__gender")
