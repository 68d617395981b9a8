"""Settings: defaults, a YAML file over them, and environment variables in it."""

from __future__ import annotations

import logging
import os
import re
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any

log = logging.getLogger("cliploom")
_VARIABLE = re.compile(r"\$\{([^}:]+)(?::-(.*?))?\}")


def expand_env(value: Any, env: dict[str, str] | None = None) -> Any:
    """`${NAME}` and `${NAME:-default}` in every string of a nested value. A variable
    that is set counts as it is, also if empty."""
    env = os.environ if env is None else env
    if isinstance(value, dict):
        return {k: expand_env(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expand_env(v, env) for v in value]
    if isinstance(value, str):
        return _VARIABLE.sub(lambda m: env.get(m[1], m[2] or ""), value)
    return value


@dataclass(frozen=True)
class Settings:
    """Thresholds of all operators. Fixed values that results depend on."""

    pipeline_version: str = "1"
    candidate_profile: str = "standard"
    # sampling and windows
    detect_fps: float = 5.0
    frame_width: int = 640
    audio_sr: int = 16000
    window_mode: str = "windowed"
    window_strategy: str = "sliding"
    window_seconds: float = 600.0
    window_hop_seconds: float = 600.0
    window_start_seconds: float = 0.0
    min_remaining_seconds: float = 60.0
    max_windows: int = 0
    # tracks
    min_face_size: float = 80.0
    track_min_iou: float = 0.15
    track_min_similarity: float = 0.30
    track_similarity_weight: float = 0.35
    track_min_points: int = 10
    track_max_lost: int = 5
    inlier_similarity: float = 0.45
    # the second pass over windows without a target track
    recovery_enabled: bool = True
    recovery_min_face_size: float = 48.0
    recovery_max_lost: int = 8
    recovery_min_iou: float = 0.08
    recovery_min_similarity: float = 0.40
    # identity
    identity_threshold: float = 0.60
    identity_margin: float = 0.08
    identity_consistency: float = 0.75
    min_references: int = 2
    # segments and quota
    min_segment_seconds: float = 2.0
    target_segment_seconds: float = 3.0
    max_segment_seconds: float = 5.0
    target_per_speaker: int = 50
    max_per_video: int = 20
    min_per_video: int = 5
    max_candidates_per_video: int = 80
    max_selected_iou: float = 0.05
    candidate_nms_iou: float = 0.70
    allow_video_cap_overflow: bool = True
    early_stop: bool = True
    early_stop_candidates: int = 25
    early_stop_regions: int = 3
    # audio
    min_speech_ratio: float = 0.55
    approve_speech_ratio: float = 0.45
    min_snr_db: float = 8.0
    max_clipping: float = 0.02
    min_rms: float = 0.003
    vad_frame_ms: float = 30.0
    max_overlap: float = 0.10
    min_audio_score: float = 0.20
    min_visual_score: float = 0.04
    least_chunk_seconds: float = 0.5
    # proposals
    active_window_seconds: float = 1.0
    active_hop_seconds: float = 0.5
    active_threshold: float = 0.30
    min_active: float = 0.45
    merge_gap_seconds: float = 1.10
    bbox_gap_frames: int = 3
    fallback_windows: bool = True
    # approval of rows of the relaxed profile
    relaxed_identity_threshold: float = 0.50
    relaxed_min_snr_db: float = 5.0
    relaxed_min_active: float = 0.40
    # sync
    sync_fps: float = 25.0
    sync_confidence: float = 4.0
    sync_max_offset: int = 3
    sync_vshift: int = 10
    crop_size: int = 224
    crop_margin: float = 0.40
    framewise: bool = True
    framewise_threshold: float = 4.0
    local_offset: bool = True
    sync_min_span_seconds: float = 1.20
    sync_min_active_seconds: float = 0.80
    sync_bridge_seconds: float = 0.32
    sync_smooth_seconds: float = 2.0
    sync_high_ratio: float = 0.30
    sync_offset_share: float = 0.60
    real_asd_enabled: bool = True
    real_asd_required: bool = True
    # probes and competitors
    probe_seconds: float = 12.0
    probe_hop_seconds: float = 10.0
    probe_min_seconds: float = 2.0
    probe_coverage: float = 0.70
    max_probes: int = 160
    competitor_check: bool = True
    competitor_coverage: float = 0.65
    max_competitors: int = 2
    # coverage and reports
    min_clips: int = 50
    min_duration: float = 0.0
    min_source_videos: int = 2
    retries: int = 1
    retry_relaxed: bool = False
    fail_if_insufficient: bool = True
    exact_export: bool = True
    report_min_utterances: int = 50
    # trials
    target_trials: int = 5000
    non_target_trials: int = 50000
    max_trials: int = 200000
    seed: int = 2026
    #: Folders by their names in the file, and keys that no setting has.
    folders: dict[str, str] = field(default_factory=dict)
    other: dict[str, Any] = field(default_factory=dict)

    def check(self) -> None:
        """Raises where quotas contradict each other."""
        if self.target_per_speaker < 1 or self.max_per_video < 1 or self.min_per_video < 0:
            raise ValueError("quotas must be positive")
        if self.min_per_video > self.max_per_video:
            raise ValueError("min_per_video exceeds max_per_video")
        if not 0 <= self.max_selected_iou < 1:
            raise ValueError("max_selected_iou lies in [0, 1)")
        if self.early_stop and self.early_stop_candidates < self.max_per_video:
            raise ValueError("the early stop leaves no room for a video's cap")

    def relaxed(self) -> Settings:
        """The looser profile for speakers short of clips; not with real sync."""
        if self.real_asd_required:
            raise ValueError("the relaxed profile is not allowed where sync is required")
        return replace(
            self,
            candidate_profile="relaxed",
            detect_fps=5.0,
            min_face_size=60.0,
            track_min_points=8,
            track_max_lost=8,
            identity_threshold=0.50,
            min_segment_seconds=2.0,
            target_segment_seconds=6.0,
            min_active=0.40,
            min_audio_score=0.20,
            min_visual_score=0.04,
            min_speech_ratio=0.45,
            min_snr_db=5.0,
        )

    def recovery(self) -> Settings:
        """The second tracking pass over windows without a target track."""
        return replace(
            self,
            min_face_size=min(self.min_face_size, self.recovery_min_face_size),
            track_max_lost=max(self.track_max_lost, self.recovery_max_lost),
            track_min_iou=min(self.track_min_iou, self.recovery_min_iou),
            track_min_similarity=max(self.track_min_similarity, self.recovery_min_similarity),
        )


#: Names that configuration files use for settings of another name here.
KEYS = {
    "long_video_mode": "window_mode",
    "long_video_strategy": "window_strategy",
    "long_video_window_seconds": "window_seconds",
    "long_video_hop_seconds": "window_hop_seconds",
    "long_video_start_seconds": "window_start_seconds",
    "long_video_min_remaining_seconds": "min_remaining_seconds",
    "long_video_max_windows": "max_windows",
    "min_track_frames": "track_min_points",
    "max_lost_frames": "track_max_lost",
    "track_min_association_iou": "track_min_iou",
    "track_min_embedding_similarity": "track_min_similarity",
    "face_recovery_enabled": "recovery_enabled",
    "face_recovery_min_face_size": "recovery_min_face_size",
    "face_recovery_max_lost_frames": "recovery_max_lost",
    "face_recovery_min_association_iou": "recovery_min_iou",
    "face_recovery_min_embedding_similarity": "recovery_min_similarity",
    "face_template_threshold": "identity_threshold",
    "face_template_margin": "identity_margin",
    "face_min_track_consistency": "identity_consistency",
    "face_template_min_refs": "min_references",
    "relaxed_face_template_threshold": "relaxed_identity_threshold",
    "segment_min_duration": "min_segment_seconds",
    "segment_target_duration": "target_segment_seconds",
    "segment_max_duration": "max_segment_seconds",
    "segments_per_video": "max_per_video",
    "min_selected_per_video": "min_per_video",
    "target_clips_per_speaker": "target_per_speaker",
    "early_stop_candidates_enabled": "early_stop",
    "early_stop_candidates_per_video": "early_stop_candidates",
    "early_stop_min_temporal_windows": "early_stop_regions",
    "max_selected_temporal_iou": "max_selected_iou",
    "max_clipping_ratio": "max_clipping",
    "max_overlap_ratio": "max_overlap",
    "active_min_audio_score": "min_audio_score",
    "active_min_visual_score": "min_visual_score",
    "active_step_seconds": "active_hop_seconds",
    "active_proposal_threshold": "active_threshold",
    "active_merge_gap_seconds": "merge_gap_seconds",
    "active_max_bbox_gap_frames": "bbox_gap_frames",
    "active_fallback_to_track_windows": "fallback_windows",
    "syncnet_threshold": "min_active",
    "syncnet_confidence_threshold": "sync_confidence",
    "syncnet_max_abs_offset_frames": "sync_max_offset",
    "syncnet_crop_fps": "sync_fps",
    "syncnet_crop_size": "crop_size",
    "syncnet_crop_margin": "crop_margin",
    "syncnet_vshift": "sync_vshift",
    "syncnet_framewise_enabled": "framewise",
    "syncnet_framewise_threshold": "framewise_threshold",
    "syncnet_framewise_min_high_seconds": "sync_min_active_seconds",
    "syncnet_framewise_min_span_seconds": "sync_min_span_seconds",
    "syncnet_framewise_bridge_gap_seconds": "sync_bridge_seconds",
    "syncnet_framewise_min_high_ratio": "sync_high_ratio",
    "syncnet_local_offset_enabled": "local_offset",
    "syncnet_local_offset_window_seconds": "sync_smooth_seconds",
    "syncnet_local_offset_min_stability_ratio": "sync_offset_share",
    "syncnet_probe_duration_seconds": "probe_seconds",
    "syncnet_probe_hop_seconds": "probe_hop_seconds",
    "syncnet_probe_min_duration_seconds": "probe_min_seconds",
    "syncnet_probe_min_track_coverage": "probe_coverage",
    "syncnet_max_probes_per_window": "max_probes",
    "syncnet_competitor_check": "competitor_check",
    "syncnet_competitor_min_coverage": "competitor_coverage",
    "syncnet_max_competitors": "max_competitors",
    "min_clips_per_speaker": "min_clips",
    "min_duration_per_speaker_sec": "min_duration",
    "min_source_videos_per_speaker": "min_source_videos",
    "max_speaker_retry_attempts": "retries",
    "speaker_retry_relaxed": "retry_relaxed",
    "fail_if_insufficient_coverage": "fail_if_insufficient",
    "require_exact_balanced_export": "exact_export",
    "min_utterances_per_speaker_report": "report_min_utterances",
    "max_internal_trials": "max_trials",
}
#: The folders of a file, and where they lie if it doesn't say.
FOLDERS = {
    "download_path": "videos",
    "output_base": "output",
    "data_raw": "data/raw",
    "data_processed": "data/processed",
    "data_candidates": "data/candidates",
    "temp_frames_dir": "temp/frames",
    "models_dir": "models",
    "logs_dir": "logs",
    "reports_dir": "reports",
    "references_dir": "references",
}
#: The keys under which a file lists its speakers.
LISTS = ("speakers", "celebrities")


@dataclass(frozen=True)
class Manifest:
    """Flat speakers and videos of a nested configuration."""

    speakers: list[dict] = field(default_factory=list)
    videos: list[dict] = field(default_factory=list)


def _text(value: Any, default: str = "") -> str:
    return str(value if value is not None else "").strip() or default


def _year(value: Any) -> int | None:
    try:
        return int(value) if value not in (None, "") else None
    except (TypeError, ValueError):
        return None


def parse_speakers(nested: list[dict], base: Path = Path(), references: Path | None = None) -> Manifest:
    """Speakers with an id, a name and at least one video, in the order of the file."""
    out = Manifest()
    for s in nested or []:
        key, name = _text((s or {}).get("id")), _text((s or {}).get("name"))
        videos = [v for v in (s or {}).get("videos") or [] if v and _text(v.get("youtube_id"))]
        if not key or not name or not videos:
            continue
        told = {k: _text(s.get(k), "unknown") for k in ("gender", "category", "region")}
        images = [str(resolve_reference(p, base, references)) for p in s.get("reference_images") or []]
        out.speakers.append({"speaker_id": key, "name": name, **told, "birth_year": _year(s.get("birth_year")), "reference_images": images})
        for v in videos:
            use = v.get("use", True)
            use = use.strip().lower() not in ("0", "false", "no", "n") if isinstance(use, str) else bool(use)
            row = {"youtube_id": _text(v["youtube_id"]), "url": _text(v.get("url")), "split": _text(v.get("split", "train"))}
            out.videos.append({"speaker_id": key, **row, "priority": int(v.get("priority") or 1), "use": use})
    return out


def resolve_reference(path: str, base: Path, references: Path | None = None) -> Path:
    """Absolute, else next to the YAML file if it is there; else, of a bare file name,
    in `references`."""
    given = Path(path).expanduser()
    beside = base / given
    if given.is_absolute():
        return given
    if beside.exists() or references is None or len(given.parts) > 1:
        return beside
    return references / given


def load(path: str | Path) -> tuple[Settings, Manifest]:
    """Settings and manifest of a file. Sections only group keys; a key that no setting
    has is kept in `other` and told in the log."""
    import yaml

    said = expand_env(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
    base = Path(path).expanduser().resolve().parent
    known = {f.name: f.type for f in fields(Settings) if f.name not in ("folders", "other")}
    flat, folders, other = {}, {k: str(base / v) for k, v in FOLDERS.items()}, {}

    def gather(part: dict) -> None:
        for k, v in part.items():
            name = KEYS.get(k, k)
            if isinstance(v, dict):
                gather(v)
            elif k in FOLDERS:
                folders[k] = str(Path(str(v)).expanduser())
            elif name in known:
                flat[name] = float(v) if known[name] == "float" and v is not None else v
            else:
                other[k] = v

    gather({k: v for k, v in said.items() if k not in LISTS})
    if other:
        log.warning("keys without a setting: %s", ", ".join(sorted(other)))
    nested = [s for name in LISTS for s in said.get(name) or []]
    return replace(Settings(), **flat, folders=folders, other=other), parse_speakers(nested, base, Path(folders["references_dir"]))


def make_folders(settings: Settings) -> list[Path]:
    """The folders of a configuration, made where they are missing."""
    made = [Path(p) for p in settings.folders.values()]
    for p in made:
        p.mkdir(parents=True, exist_ok=True)
    return made


def save(path: str | Path, data: dict) -> None:
    import yaml

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(yaml.safe_dump(data, allow_unicode=True, sort_keys=False), encoding="utf-8")
