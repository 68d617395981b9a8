"""Quality scores, gates and approval scores of candidates.

Values are made comparable first (NaN and text become the default), since NaN
passes every `>=` here. Thresholds come from Settings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.arrays import median
from ..functions.columns import clip, number, or_blank

#: What the quality column says, in this order, of each rule that a clip
#: breaks, and of a clip that breaks none.
EMPTY, QUIET, LITTLE_SPEECH, NOISY, CLIPPED, FINE = "audio vacío", "RMS bajo", "poca voz", "SNR bajo", "clipping", "ok"
#: The first rule that a segment breaks, in this order.
SHORT, RMS, VAD, SNR, OVERLAP = "short", "rms", "vad", "snr", "overlap"


def _levels() -> tuple[Column, ...]:
    defaults = (("duration", 0.0), ("rms", 0.0), ("vad_ratio", 0.0), ("snr_db", -99.0))
    return tuple(number(c, v) for c, v in defaults)


def audio_quality(df: DataFrame, s: Settings) -> DataFrame:
    """df (duration, vad_ratio, snr_db, rms, clipping_ratio) with quality_score,
    quality_reason and quality_ok. Overlap is no part of it."""
    duration, rms, vad, snr = _levels()
    clipping = number("clipping_ratio", 0.0)
    rules = [
        (EMPTY, duration <= 0),
        (QUIET, rms < s.min_rms),
        (LITTLE_SPEECH, vad < s.min_speech_ratio),
        (NOISY, snr < s.min_snr_db),
        (CLIPPED, clipping > s.max_clipping),
    ]
    speech = clip((vad - s.min_speech_ratio) / max(1e-6, 1.0 - s.min_speech_ratio))
    level = clip(rms / max(4 * s.min_rms, 1e-6))
    unclipped = 1 - clip(clipping / max(s.max_clipping, 1e-6))
    score = 0.40 * speech + 0.30 * clip((snr - s.min_snr_db) / 20.0) + 0.20 * level + 0.10 * unclipped
    broken = F.concat_ws(", ", *(F.when(bad, F.lit(name)) for name, bad in rules))
    out = df.withColumn("quality_score", score).withColumn("quality_ok", broken == "")
    return out.withColumn("quality_reason", F.when(broken == "", FINE).otherwise(broken))


def chunk_accepted(s: Settings) -> Column:
    """Whether a chunk passes with its overlap; its length only has to be positive."""
    duration, rms, vad, snr = _levels()
    loud = (duration > 0) & (rms >= s.min_rms)
    return loud & (vad >= s.min_speech_ratio) & (snr >= s.min_snr_db) & (number("overlap_ratio", 0.0) <= s.max_overlap)


def segment_rules(s: Settings) -> list[tuple[str, Column]]:
    """What rejects a segment, the first rule that it breaks counting."""
    duration, rms, vad, snr = _levels()
    return [
        (SHORT, duration < s.least_chunk_seconds),
        (RMS, rms < s.min_rms),
        (VAD, vad < s.min_speech_ratio),
        (SNR, snr < s.min_snr_db),
        (OVERLAP, number("overlap_ratio", 0.0) > s.max_overlap),
    ]


def first_failure(df: DataFrame, rules: list[tuple[str, Column]], name: str = "reject_reason") -> DataFrame:
    """df with the first rule that a row breaks, else 'accepted'."""
    out = F.lit("accepted")
    for said, broken in reversed(rules):
        out = F.when(F.coalesce(broken, F.lit(False)), F.lit(said)).otherwise(out)
    return df.withColumn(name, out)


def rejection_counts(df: DataFrame, name: str = "reject_reason") -> DataFrame:
    return df.groupBy(name).agg(F.count("*").alias("n"))


def candidate_rank(df: DataFrame, s: Settings) -> DataFrame:
    """The score candidates are shown by; selection uses the balanced one."""
    sync = clip((number("syncnet_confidence", 0.0) - 4.0) / 4.0)
    snr = clip((number("snr_db", -99.0) - s.min_snr_db) / 20.0)
    score = 0.35 * number("quality_score", 0.0) + 0.35 * sync + 0.20 * number("active_confidence", 0.0) + 0.10 * snr
    return df.withColumn("rank_score", score)


def _of(df: DataFrame, name: str, default: float) -> Column:
    """A number; a missing column is its default throughout."""
    return number(name, default) if name in df.columns else F.lit(float(default))


def relaxed_profile(df: DataFrame) -> Column:
    if "candidate_profile" not in df.columns:
        return F.lit(False)
    return F.lower(F.coalesce(F.col("candidate_profile").cast("string"), F.lit("standard"))) == "relaxed"


def approval_scores(df: DataFrame, s: Settings) -> DataFrame:
    """The thresholds of each row's profile, its scores and their balance."""
    relaxed = relaxed_profile(df)
    pick = lambda loose, strict: F.when(relaxed, F.lit(float(loose))).otherwise(F.lit(float(strict)))
    out = df.withColumn("approval_face_threshold", pick(s.relaxed_identity_threshold, s.identity_threshold))
    out = out.withColumn("approval_snr_threshold", pick(s.relaxed_min_snr_db, s.min_snr_db))
    out = out.withColumn("approval_active_threshold", pick(s.relaxed_min_active, s.min_active))
    bar = F.col("approval_face_threshold")
    face = clip((_of(df, "face_conf", -1.0) - bar) / F.greatest(0.80 - bar, F.lit(0.01)))
    snr = clip((_of(df, "snr_db", -99.0) - F.col("approval_snr_threshold")) / 20.0)
    sync = clip((_of(df, "syncnet_confidence", -99.0) - s.sync_confidence) / 7.0)
    out = out.withColumn("approval_face_score", face).withColumn("approval_snr_score", snr).withColumn("approval_syncnet_score", sync)
    quality, active = clip(_of(df, "quality_score", 0.0)), clip(_of(df, "active_confidence", 0.0))
    scores = (F.col(f"approval_{c}_score") for c in ("face", "syncnet", "snr"))
    face, sync, snr = scores
    return out.withColumn("balanced_rank_score", 0.30 * face + 0.20 * quality + 0.35 * sync + 0.10 * active + 0.05 * snr)


def eligibility(df: DataFrame, s: Settings) -> DataFrame:
    """df (with approval_scores) with one column for each gate, and `eligible` where all
    hold. A missing column counts as its default: the version as legacy, numbers as what
    fails; only file and rejection, which other operators add, count as there and none."""
    sync = (
        (_of(df, "syncnet_verified", 0) >= 1)
        & (_of(df, "syncnet_confidence", -99.0) >= s.sync_confidence)
        & (F.abs(_of(df, "syncnet_offset_frames", 999.0)) <= s.sync_max_offset)
        & ((_of(df, "syncnet_unambiguous", 0) >= 1) if s.competitor_check else F.lit(True))
    )
    proposal = (
        (clip(_of(df, "active_confidence", 0.0)) >= F.col("approval_active_threshold"))
        & (clip(_of(df, "audio_score", 0.0)) >= s.min_audio_score)
        & (clip(_of(df, "visual_score", 0.0)) >= s.min_visual_score)
    )
    version = F.col("pipeline_version").cast("string") if "pipeline_version" in df.columns else F.lit(None).cast("string")
    gates = {
        "gate_file": F.col("file_exists").cast("boolean") if "file_exists" in df.columns else F.lit(True),
        "gate_version": F.coalesce(version, F.lit("legacy")) == s.pipeline_version,
        "gate_manual": _of(df, "manual_rejected", 0) == 0,
        "gate_face": _of(df, "face_conf", -1.0) >= F.col("approval_face_threshold"),
        "gate_margin": _of(df, "face_margin", -1.0) >= s.identity_margin,
        "gate_consistency": _of(df, "face_track_consistency", 0.0) >= s.identity_consistency,
        "gate_proposal": F.lit(True) if s.real_asd_required else proposal,
        "gate_vad": clip(_of(df, "vad_ratio", 0.0)) >= s.approve_speech_ratio,
        "gate_snr": _of(df, "snr_db", -99.0) >= F.col("approval_snr_threshold"),
        "gate_sync": sync if s.real_asd_required else F.lit(True),
    }
    held = {k: F.coalesce(g, F.lit(False)) for k, g in gates.items()}
    every = F.lit(True)
    for g in held.values():
        every = every & g
    return df.select("*", *(g.alias(k) for k, g in held.items()), every.alias("eligible"))


def force_filter(old: DataFrame, chosen: DataFrame) -> DataFrame:
    """Earlier candidates but those of the chosen speakers, which are made anew."""
    return old.join(chosen.select("speaker_id").distinct(), "speaker_id", "left_anti")


def reprocess_filter(old: DataFrame, chosen: DataFrame, s: Settings) -> DataFrame:
    """Earlier candidates that stay beside those made again: of the chosen speakers only
    rows of this version that are verified where sync is required; all of the others."""
    version = F.coalesce(F.col("pipeline_version").cast("string"), F.lit("legacy")) if "pipeline_version" in old.columns else F.lit("legacy")
    fine = version == s.pipeline_version
    fine = fine & (_of(old, "syncnet_verified", 0) >= 1) if s.real_asd_required else fine
    own = old.join(chosen.select("speaker_id").distinct(), "speaker_id", "left_semi").where(fine)
    return force_filter(old, chosen).unionByName(own)


def audio_score(rms: Column, floor: Column) -> Column:
    return clip((F.log1p(1000 * rms) - F.log1p(1000 * floor)) / 3.0)


def fused_confidence(audio: Column, visual: Column) -> Column:
    return F.when(visual > 0, F.sqrt(audio * visual)).otherwise(0.0)


def proposal_score(confidence: Column, visual: Column, audio: Column, duration: Column, target: float) -> Column:
    return confidence + 0.10 * visual + 0.05 * audio - 0.10 * F.abs(duration - target) / target


def selection_digest(df: DataFrame) -> DataFrame:
    return df.withColumn("digest", or_blank("sha1", "candidate_path"))


def visual_score(differences: Column) -> Column:
    """Median mouth difference over 0.035, within 0 and 1; 0 with fewer than two."""
    return F.when(F.size(differences) >= 2, clip(median(differences) / 0.035)).otherwise(0.0)
