"""Active-speaker proposals: fused windows, merged sessions, fallback windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from .gates import proposal_score
from .intervals import merge_sessions, slices
from .selection import suppress


def score_windows(tracks: DataFrame, window: float, hop: float) -> DataFrame:
    """Windows (track_id, start, end) each hop over a track's span."""
    n = F.greatest(F.lit(0), F.floor((F.col("end_time") - F.col("start_time") - window) / hop + F.lit(1e-9))).cast("int")
    spread = tracks.withColumn("i", F.explode(F.sequence(F.lit(0), n)))
    start = F.col("start_time") + F.col("i") * F.lit(hop)
    return spread.select("track_id", start.alias("start"), F.least(F.col("end_time"), start + window).alias("end"))


def propose(windows: DataFrame, s: Settings) -> DataFrame:
    """Segments of active windows (track_id, start, end, confidence, audio, visual)."""
    active = windows.where((F.col("confidence") >= s.active_threshold) & (F.col("audio") >= s.min_audio_score) & (F.col("visual") >= s.min_visual_score) & (F.col("visual") > 0))
    merged = merge_sessions(active, ["track_id"], s.merge_gap_seconds, "confidence", "audio", "visual")
    return merged.where(F.col("end") - F.col("start") >= s.min_segment_seconds).withColumn("method", F.lit("active_speaker"))


def fallback(windows: DataFrame, proposed: DataFrame, s: Settings) -> DataFrame:
    """For tracks without a proposal: consecutive windows of the target length that
    are at least a little audible and moving."""
    left = windows.join(proposed.select("track_id").distinct(), "track_id", "left_anti")
    span = left.groupBy("track_id").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cut = slices(span, s.target_segment_seconds, s.min_segment_seconds).select("track_id", "start", "end")
    parts = left.select("track_id", F.col("start").alias("w0"), "audio", "visual", "confidence")
    met = cut.join(parts, "track_id").where((F.col("w0") >= F.col("start")) & (F.col("w0") < F.col("end")))
    means = met.groupBy("track_id", "start", "end").agg(F.avg("confidence").alias("confidence"), F.avg("audio").alias("audio"), F.avg("visual").alias("visual"))
    return means.where((F.col("audio") >= 0.20) & (F.col("visual") >= max(0.01, s.min_visual_score / 2))).withColumn("method", F.lit("track_window_proposal"))


def to_windows(found: DataFrame, s: Settings) -> DataFrame:
    """Segments cut to clips, centred where a little too long, the best of each
    track without overlap, by greedy suppression."""
    length = F.col("end") - F.col("start")
    middle = (F.col("start") + F.col("end")) / 2
    trim = (length > s.target_segment_seconds) & (length <= s.max_segment_seconds)
    half = s.target_segment_seconds / 2
    trimmed = found.withColumn("__a", F.when(trim, middle - half).otherwise(F.col("start"))).withColumn("end", F.when(trim, middle + half).otherwise(F.col("end"))).withColumn("start", F.col("__a")).drop("__a")
    cut = slices(trimmed, s.target_segment_seconds, s.min_segment_seconds)
    scored = cut.withColumn("score", proposal_score(F.col("confidence"), F.col("visual"), F.col("audio"), F.col("end") - F.col("start"), s.target_segment_seconds))
    ordered = scored.withColumn("row_ord", F.row_number().over(Window.partitionBy("track_id").orderBy("start", "end")).cast("long"))
    return suppress(ordered, ["track_id"], s.candidate_nms_iou, s.max_candidates_per_video)


def in_time(found: DataFrame) -> DataFrame:
    """Segments by their start, the surer first."""
    return found.orderBy("start", F.desc("confidence"))


def detected_only(tracks: DataFrame, least: float, seconds: float) -> DataFrame:
    """tracks with the confidence that detection alone gives, 0.49 at most, and whether
    that and their duration are enough."""
    confidence = F.least(F.coalesce("avg_det_score", F.lit(0.0)), F.lit(0.49))
    return tracks.withColumn("active_conf", confidence).withColumn("active", (confidence >= least) & (F.col("duration") >= seconds))


def known_active(tracks: DataFrame, least: float) -> DataFrame:
    """Tracks of a known speaker whose activity (0 where it is unknown) is enough."""
    return tracks.where((F.col("speaker_id") != "unknown") & (F.coalesce("active_conf", F.lit(0.0)) >= least))


def active_tracks(tracks: DataFrame, windows: DataFrame, least: float, det_score: float) -> DataFrame:
    """Tracks with an active window; where none of a video's tracks has one, those
    detected well enough."""
    found = windows.where(F.col("confidence") >= least).select("track_id").distinct()
    active = tracks.join(found, "track_id", "left_semi")
    rest = tracks.join(active.select("video_id").distinct(), "video_id", "left_anti").where(F.col("avg_det_score") >= det_score)
    return active.unionByName(rest)
