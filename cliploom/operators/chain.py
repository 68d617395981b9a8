"""From detected faces to candidates: tracks, identities, probes, sync, audio, rivals.

Every step is an operator of its own; this chains them over tables of any size. Models
stay outside: `sync` gives the distances of probes, whichever way they are made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.columns import safe_key
from . import audio as sound
from . import gates, intervals, selection, sync, tracking, vectors

#: probes (probe_id, window_id, track_id, start, end, duration) to probe_id, frame, dist
Sync = Callable[[DataFrame], DataFrame]
#: Stores what several steps read, so that a model or a tracking pass runs once.
Hold = Callable[[DataFrame], DataFrame]


def as_it_is(df: DataFrame) -> DataFrame:
    return df


FACE = ("face_conf", "face_other_conf", "face_margin", "face_track_consistency")


def known_templates(references: DataFrame, s: Settings) -> DataFrame:
    """speaker_id, template and template_count from reference faces (speaker_id,
    reference_id, embedding); of an image its best face should be in it alone."""
    return vectors.templates(references, "speaker_id", "reference_id", "embedding", s.inlier_similarity, s.min_references)


def identified(points: DataFrame, templates: DataFrame, s: Settings) -> DataFrame:
    """Valid tracks with the speaker each is taken for, or unknown, and the scores."""
    tracks = tracking.tracks(points, s)
    scored = vectors.identify(tracks, templates, "track_id", "avg_emb", s.identity_threshold, s.identity_margin)
    told = vectors.with_consistency(scored, tracks, "track_id", s.identity_consistency)
    return tracks.join(told, "track_id")


def targets(tracks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Identified tracks of windows (pairs: window_id, speaker_id) whose speaker it is."""
    known = tracks.where("is_identified")
    return known.join(pairs.select("window_id", "speaker_id").distinct(), ["window_id", "speaker_id"], "left_semi")


def probes_of(tracks: DataFrame, points: DataFrame, s: Settings) -> DataFrame:
    """Probes of target tracks, with the faces' scores. A track's last frame lasts as
    long as any."""
    spans = tracks.withColumn("start_time", F.col("start_frame") / s.detect_fps)
    spans = spans.withColumn("end_time", (F.col("end_frame") + 1) / s.detect_fps)
    limits = (s.detect_fps, s.probe_seconds, s.probe_hop_seconds, s.probe_min_seconds, s.probe_coverage, s.max_probes)
    found = intervals.probes(spans.select("track_id", "window_id", "start_time", "end_time", "face_conf"), points, *limits)
    named = found.withColumn("probe_id", F.concat_ws("_", "track_id", F.lit("probe"), F.lpad(F.col("position").cast("string"), 5, "0")))
    timed = named.withColumn("duration", F.col("end") - F.col("start"))
    return timed.join(tracks.select("track_id", "speaker_id", *FACE), "track_id")


def verified_segments(probes: DataFrame, run: Sync, s: Settings, hold: Hold = as_it_is) -> DataFrame:
    """Segments of accepted probes in window time, with what sync says of them."""
    probes = hold(probes)
    distances = hold(run(probes.select("probe_id", "window_id", "track_id", "start", "end", "duration")))
    found, said = sync.verify(distances, probes.select("probe_id", "duration"), s)
    accepted = said.where("accepted").select("probe_id", F.col("confidence").alias("syncnet_global_confidence"), F.col("min_distance").alias("syncnet_min_distance"))
    segments = found.select(
        "probe_id",
        "ordinal",
        F.col("start").alias("from"),
        F.col("end").alias("upto"),
        F.col("confidence").alias("syncnet_confidence"),
        F.col("high_ratio").alias("syncnet_framewise_high_ratio"),
        F.col("offset_frames").alias("syncnet_offset_frames"),
    )
    of = probes.select("probe_id", "window_id", "track_id", "speaker_id", F.col("start").alias("__start"), *FACE)
    both = segments.join(accepted, "probe_id").join(of, "probe_id")
    timed = both.withColumn("start", F.col("__start") + F.col("from")).withColumn("end", F.col("__start") + F.col("upto"))
    return timed.withColumn("segment_id", F.concat_ws("_", "probe_id", F.col("ordinal").cast("string"))).drop("__start", "from", "upto")


def without_rivals(segments: DataFrame, tracks: DataFrame, points: DataFrame, run: Sync, s: Settings, hold: Hold = as_it_is) -> DataFrame:
    """segments during which no other face of the window is in sync too, with how many
    were checked and the largest confidence among them (-99: none)."""
    if not s.competitor_check:
        return segments.withColumn("syncnet_competitors_checked", F.lit(0)).withColumn("syncnet_competitor_confidence", F.lit(-99.0))
    asked = segments.select("segment_id", F.col("window_id").alias("video_id"), "track_id", "start", "end")
    there = tracks.select("track_id", F.col("window_id").alias("video_id"))
    rivals = hold(vectors.competitors(asked, there, points, s.detect_fps, s.competitor_coverage, s.max_competitors))
    spans = segments.select("segment_id", "window_id", "start", "end")
    probes = rivals.select("segment_id", "track_id", "place").join(spans, "segment_id")
    probes = probes.withColumn("probe_id", F.concat_ws("_", "segment_id", F.lit("competitor"), F.col("place").cast("string")))
    probes = hold(probes.withColumn("duration", F.col("end") - F.col("start")))
    distances = hold(run(probes.select("probe_id", "window_id", "track_id", "start", "end", "duration")))
    found, said = sync.verify(distances, probes.select("probe_id", "duration"), s)
    best = found.groupBy("probe_id").agg(F.max("confidence").alias("best"))
    checked = distances.select("probe_id").distinct().withColumn("checked", F.lit(1))  # a probe that failed counts for nothing
    told = probes.select("probe_id", "segment_id", "track_id").join(said.select("probe_id", "accepted"), "probe_id")
    told = hold(told.join(best, "probe_id", "left").join(checked, "probe_id", "left"))
    per = told.groupBy("segment_id").agg(F.sum(F.coalesce("checked", F.lit(0))).cast("int").alias("n"), F.max("best").alias("best"))
    clear = sync.unambiguous(segments, rivals, told.select("segment_id", "track_id", "accepted"))
    out = clear.join(per, "segment_id", "left")
    out = out.withColumn("syncnet_competitors_checked", F.coalesce("n", F.lit(0)))
    return out.withColumn("syncnet_competitor_confidence", F.coalesce("best", F.lit(-99.0))).drop("n", "best")


def within_budget(segments: DataFrame, windows: DataFrame, s: Settings, existing: DataFrame | None = None) -> DataFrame:
    """segments that the early stop lets a window give, in the order of its probes and
    segments: windows (video_id, window_id, visit) in the order they are visited, those
    without a segment too. existing: video_id, n_candidates made before."""
    if not (s.early_stop and s.early_stop_candidates > 0):
        return segments
    counts = segments.groupBy("speaker_id", "window_id").agg(F.count("*").alias("n"))
    speakers = windows.select("speaker_id", "video_id", "window_id", "visit")
    per = speakers.join(counts, ["speaker_id", "window_id"], "left")
    scope = F.concat_ws("|", "speaker_id", "video_id")
    per = per.select(scope.alias("video_id"), "speaker_id", "window_id", "visit", F.coalesce("n", F.lit(0)).alias("n_candidates"))
    if existing is not None:
        before = existing.select(scope.alias("video_id"), F.col("n_candidates").alias("existing"))
        per = per.join(before, "video_id", "left").fillna(0, ["existing"])
    allowed = selection.budgeted(per, s.early_stop_candidates, s.early_stop_regions).where("visited")
    of = per.select("video_id", "visit", "speaker_id", "window_id").join(allowed, ["video_id", "visit"]).select("speaker_id", "window_id", "taken")
    order = Window.partitionBy("speaker_id", "window_id").orderBy("probe_id", "ordinal")
    ranked = segments.withColumn("__n", F.row_number().over(order)).join(of, ["speaker_id", "window_id"])
    return ranked.where(F.col("__n") <= F.col("taken")).drop("__n", "taken")


def candidate_segments(
    windows: DataFrame,
    detections: DataFrame,
    references: DataFrame,
    audio: DataFrame,
    run: Sync,
    s: Settings,
    existing: DataFrame | None = None,
    hold: Hold = as_it_is,
) -> DataFrame:
    """Segments that passed identity, sync, audio quality, rivals and budget, as
    candidates.candidate_rows takes them, with their samples.

    windows: speaker_id, video_id, tag, window_id, visit; detections: schema.DETECTIONS;
    references: speaker_id, reference_id, embedding, rivals of the gallery too; audio:
    window_id, samples at s.audio_sr."""
    pairs = windows.select("window_id", "speaker_id").distinct()
    templates = hold(known_templates(references, s))
    has_target = lambda points: targets(identified(points, templates, s), pairs)
    points = hold(tracking.with_recovery(detections.join(pairs, "window_id", "left_semi"), s, has_target))
    tracks = hold(identified(points, templates, s))
    wanted = targets(tracks, pairs)
    segments = hold(verified_segments(probes_of(wanted, points, s), run, s, hold))
    heard = sound.measured(sound.chunks(segments, audio, s.audio_sr, "window_id"), s, s.audio_sr)
    good = hold(gates.audio_quality(heard, s).where("quality_ok").drop("quality_ok"))
    clear = hold(without_rivals(good, tracks, points, run, s, hold))
    kept = within_budget(clear, windows, s, existing)
    of = windows.select("speaker_id", "window_id", "video_id", F.col("tag").alias("chunk_tag"))
    told = kept.join(of, ["speaker_id", "window_id"])
    return told.select(
        "*",
        F.col("syncnet_framewise_high_ratio").alias("active_confidence"),
        F.col("vad_ratio").alias("audio_score"),
        F.lit(0.0).alias("visual_score"),
        F.lit(s.framewise_threshold).alias("syncnet_framewise_threshold"),
        F.lit(1).alias("syncnet_verified"),
        F.lit(1).alias("syncnet_unambiguous"),
        F.lit("syncnet_framewise_target_track").alias("active_speaker_method"),
        safe_key("segment_id").alias("clip_key"),
    )
