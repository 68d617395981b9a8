"""Explicit schemas of the logical tables, and a tolerant conversion to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPEAKERS = "speaker_id string, name string, reference_images array<string>, gender string, category string, region string, birth_year int, use string, exclude_from_train string, notes string"
VIDEOS = "speaker_id string, youtube_id string, url string, split string, priority int, use string, notes string"
WINDOWS = "video_id string, idx int, start double, duration double, tag string, video_duration double"
DETECTIONS = "window_id string, frame int, face_ord int, bbox struct<x1:float,y1:float,x2:float,y2:float>, embedding array<float>, det_score double"
TRACKS = "track_id string, video_id string, start_frame int, end_frame int, start_time double, end_time double, duration double, avg_det_score double, embedding_consistency double, track_coverage double, avg_emb array<float>"
IDENTITIES = TRACKS + ", speaker_id string, face_conf double, face_other_conf double, face_margin double, face_track_consistency double, is_identified boolean"
PROBES = "track_id string, start double, end double, duration double, confidence double, audio_score double, visual_score double, face_conf double, face_other_conf double, face_margin double, face_track_consistency double, method string"
DISTANCES = "probe_id string, frame int, dist array<float>"
_IDS = ("pipeline_version", "speaker_id", "speaker_name", "gender", "category", "region", "video_id", "processing_unit_id", "chunk_tag", "url", "candidate_path", "sha1")
_REALS = ("chunk_start", "chunk_end", "start", "end", "local_start", "local_end", "duration", "active_confidence", "audio_score", "visual_score", "face_conf", "face_other_conf", "face_margin", "face_track_consistency", "vad_ratio", "snr_db", "rms", "peak", "clipping_ratio", "quality_score", "syncnet_confidence", "syncnet_global_confidence", "syncnet_framewise_high_ratio", "syncnet_framewise_threshold", "syncnet_min_distance", "syncnet_competitor_confidence")
_INTS = ("candidate_idx", "syncnet_offset_frames", "syncnet_verified", "syncnet_competitors_checked", "syncnet_unambiguous", "approved")
CANDIDATES = ", ".join([*(f"{c} string" for c in _IDS), *(f"{c} double" for c in _REALS), *(f"{c} int" for c in _INTS), "quality_reason string", "candidate_profile string", "active_speaker_method string", "requires_manual_validation boolean", "rank_score double"])
PROCESSED = "processing_unit_id string, speaker_id string, video_id string, chunk_tag string, candidate_profile string, n_candidates int, processed_at timestamp"
REJECTIONS = "sha1 string, candidate_path string, utterance_id string, audio_filename string"
SPLITS = "speaker_id string, speaker_name string, gender string, category string, split string"
METRICS = "model string, metric string, trial string, `group` string, base double, adapted double"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str, defaults: dict[str, object] | None = None, keep: bool = True) -> DataFrame:
    """df with the columns of `ddl`: missing ones get their default (else null),
    values that don't convert become null. Other columns stay if `keep`."""
    defaults, out = defaults or {}, []
    for f in struct(ddl).fields:
        name = f"`{f.name}`"
        value: Column = F.lit(None) if f.name not in df.columns else F.expr(f"try_cast({name} AS {f.dataType.simpleString()})") if isinstance(f.dataType, T.AtomicType) else F.col(name)
        if f.name in defaults:
            value = F.coalesce(value, F.lit(defaults[f.name]))
        out.append(value.cast(f.dataType).alias(f.name))
    known = {f.name for f in struct(ddl).fields}
    return df.select(*out, *(F.col(f"`{c}`") for c in df.columns if keep and c not in known))


def require(df: DataFrame, *columns: str) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
