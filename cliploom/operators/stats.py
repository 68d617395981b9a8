"""Coverage, summaries, expectations and the export gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number
from .intervals import overlap_pairs


def completed(df: DataFrame, target: int) -> DataFrame:
    """Speakers with at least `target` approved rows."""
    done = df.where(number("approved", 0) >= 1).groupBy("speaker_id").agg(F.count("*").alias("n"))
    return done.where(F.col("n") >= target)


def coverage(speakers: DataFrame, approved: DataFrame) -> DataFrame:
    """A row for every speaker, zeros where nothing is approved; clips count if their
    file is there, with their duration (unknown or negative: none)."""
    seconds = F.greatest(F.lit(0.0), number("duration", 0.0)) if "duration" in approved.columns else F.lit(0.0)
    there = F.coalesce(F.col("file_exists"), F.lit(False))
    per = approved.groupBy("speaker_id").agg(
        F.count_if(there).alias("n_clips"),
        F.sum(F.when(there, seconds).otherwise(0.0)).alias("duration_sec"),
        F.countDistinct(F.when(there, F.col("video_id"))).alias("n_videos"),
        F.count_if(~there).alias("missing_files"),
    )
    return speakers.select("speaker_id").join(per, "speaker_id", "left").fillna(0)


def insufficient(covered: DataFrame, clips: int, duration: float, videos: int) -> DataFrame:
    return covered.where((F.col("n_clips") < clips) | (F.col("duration_sec") < duration) | (F.col("n_videos") < videos))


def ensure_coverage(
    attempt: Callable[[DataFrame, int], None],
    speakers: DataFrame,
    approve: Callable[[], DataFrame],
    clips: int,
    duration: float,
    videos: int,
    tries: int,
    hold: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Calls attempt(short speakers, number) and approves again while some are short, at
    most `tries` times. A row for each speaker: coverage at first and at the end, what
    was asked for, how often it was tried, and the status. Where approving replaces a
    table, `hold` must store what is read from it."""
    first = hold(coverage(speakers, approve()))
    found, used = first, first.select("speaker_id", F.lit(0).alias("attempts_used"))
    for n in range(1, tries + 1):
        short = hold(insufficient(found, clips, duration, videos).select("speaker_id"))
        if short.isEmpty():
            break
        attempt(short, n)
        tried = short.withColumn("again", F.lit(n))
        used = used.join(tried, "speaker_id", "left").select("speaker_id", F.coalesce("again", "attempts_used").alias("attempts_used"))
        found = hold(coverage(speakers, approve()))
    before = first.select("speaker_id", F.col("n_clips").alias("initial_clips"), F.col("duration_sec").alias("initial_duration_sec"))
    asked = (F.lit(clips).alias("required_clips"), F.lit(float(duration)).alias("required_duration_sec"), F.lit(videos).alias("required_source_videos"))
    enough = (F.col("n_clips") >= clips) & (F.col("duration_sec") >= duration) & (F.col("n_videos") >= videos)
    out = found.join(before, "speaker_id").join(used, "speaker_id")
    return out.select("*", *asked, F.when(enough, "sufficient").otherwise("insufficient").alias("status"))


def speaker_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("speaker_id").agg(
        F.count("*").alias("n_utterances"),
        F.countDistinct("video_id").alias("n_videos"),
        F.sum("duration").alias("duration_sec"),
        F.avg("duration").alias("mean_duration"),
        F.avg(number("snr_db")).alias("mean_snr"),
        F.avg(number("vad_ratio")).alias("mean_vad"),
    )


def video_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("speaker_id", "video_id").agg(F.count("*").alias("n_utterances"), F.sum("duration").alias("duration_sec"))


def summary(stats: DataFrame, df: DataFrame, target: int, least: int | None = None) -> DataFrame:
    """One row over all speakers; `least` utterances (else the target) are reported as
    the threshold that speakers may lie below."""
    least = target if least is None else least
    of_rows = df.agg(
        F.countDistinct("video_id").alias("n_videos"),
        F.count("*").alias("n_utterances"),
        (F.sum("duration") / 3600.0).alias("duration_hours"),
        F.avg("duration").alias("mean_duration"),
    )
    of_speakers = stats.agg(
        F.count("*").alias("n_speakers"),
        F.count_if(F.col("n_utterances") < least).alias("speakers_below_min_utt"),
        F.count_if(F.col("n_utterances") != target).alias("speakers_not_exact_target"),
    )
    both = of_rows.crossJoin(of_speakers)  # one row each
    return both.withColumn("min_utt_threshold", F.lit(least))


def video_distribution(df: DataFrame) -> DataFrame:
    per = df.groupBy("speaker_id", "video_id").agg(F.count("*").alias("n"))
    said = F.concat_ws("=", "video_id", F.col("n").cast("string"))
    listed = F.array_join(F.array_sort(F.collect_list(said)), ", ")
    return per.groupBy("speaker_id").agg(listed.alias("distribution"))


def speaker_videos(df: DataFrame) -> DataFrame:
    """The distinct videos of each speaker, sorted."""
    return df.where("video_id is not null").groupBy("speaker_id").agg(F.array_sort(F.collect_set("video_id")).alias("videos"))


def candidate_counts(df: DataFrame) -> DataFrame:
    """How many candidates each (speaker, video) has already."""
    return df.groupBy("speaker_id", "video_id").agg(F.count("*").alias("n_candidates"))


def speaker_metadata(df: DataFrame, id_name: str = "Speaker ID") -> DataFrame:
    per = df.groupBy("speaker_id").agg(
        F.first("gender").alias("Gender"),
        F.first("set").alias("Set"),
        F.first("speaker_name").alias("Name"),
        F.count("*").alias("Num utterances"),
        F.countDistinct("video_id").alias("Num videos"),
        F.sum("duration").alias("Total duration"),
    )
    return per.withColumnRenamed("speaker_id", id_name)


def expectations(df: DataFrame, version: str, longest: float, bucket: float = 10.0, most_iou: float = 0.05) -> DataFrame:
    """rule and its number of violations, zero included. Missing columns break their
    rule in every row."""
    low = lambda c: number(c, 0) < 1 if c in df.columns else F.lit(True)
    said = F.col("pipeline_version").cast("string") if "pipeline_version" in df.columns else F.lit(None)
    rules = {
        "version": ~F.coalesce(said == version, F.lit(False)),
        "verified": low("syncnet_verified"),
        "unambiguous": low("syncnet_unambiguous"),
        "duration": F.coalesce(number("duration") > longest + 1e-3, F.lit(True)),
        "file": ~F.coalesce(F.col("file_exists"), F.lit(False)) if "file_exists" in df.columns else F.lit(True),
    }
    one = df.agg(*(F.count_if(bad).alias(k) for k, bad in rules.items()))
    copies = df.groupBy(F.coalesce(F.trim("sha1"), F.lit("")).alias("h")).agg(F.count("*").alias("n"))
    copies = copies.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("sha1"))
    pairs = overlap_pairs(df, ["speaker_id", "video_id"], "row_ord", bucket, most_iou).agg(F.count("*").alias("overlap"))
    wide = one.crossJoin(copies).crossJoin(pairs)  # one row each
    each = (F.struct(F.lit(c).alias("rule"), F.col(c).cast("long").alias("violations")) for c in wide.columns)
    return wide.select(F.explode(F.array(*each)).alias("x")).select("x.*")


def export_gate(covered: DataFrame, clips: int, videos: int) -> DataFrame:
    """Speakers that can't be exported: not exactly `clips`, or too few videos."""
    return covered.where((F.col("n_clips") != clips) | (F.col("n_videos") < videos))
