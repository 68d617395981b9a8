"""Audio of segments: cut from the samples of a file, measured, and filtered.

Samples are array columns and stay inside the JVM; a file's samples are joined to its
segments by path, so that one file's audio meets its own segments alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import arrays
from .gates import audio_score, first_failure, segment_rules
from .intervals import overlap_depth


def measured(df: DataFrame, s: Settings, rate: int, samples: str = "samples") -> DataFrame:
    """df with duration, rms, peak, clipping_ratio, vad_ratio and snr_db of its samples;
    without samples levels are 0 and the ratio to noise is -99."""
    x = arrays.doubles(samples)
    out = df.withColumn("__x", x).withColumn("__mask", arrays.speech_mask(F.col("__x"), rate, s.vad_frame_ms, s.min_rms))
    x, mask, some = F.col("__x"), F.col("__mask"), F.size("__x") > 0
    or_zero = lambda c: F.when(some, c).otherwise(0.0)
    told = {
        "duration": F.greatest(F.lit(0), F.size(x)) / float(rate),
        "rms": or_zero(arrays.rms(x)),
        "peak": or_zero(arrays.peak(x)),
        "clipping_ratio": or_zero(arrays.clipping(x)),
        "vad_ratio": or_zero(arrays.mean(F.transform(mask, lambda m: m.cast("double")))),
        "snr_db": F.when(some, arrays.snr_db(x, mask)).otherwise(-99.0),
    }
    return out.select("*", *(c.alias(n) for n, c in told.items())).drop("__x", "__mask")


def chunks(segments: DataFrame, audio: DataFrame, rate: int, by: str = "path") -> DataFrame:
    """segments (a key, start, end) with the samples between their times."""
    own = audio.where("samples is not null").select(by, F.col("samples").alias("__all"))
    cut = arrays.stretch(F.col("__all"), rate, F.col("start"), F.col("end"))
    return segments.join(own, by).withColumn("samples", cut).drop("__all")


def judged(segments: DataFrame, audio: DataFrame, s: Settings, rate: int, speech: DataFrame | None = None, key: str = "id", by: str = "path") -> DataFrame:
    """segments (key, path, start, end) with their levels, the share of time in which
    several speakers talk (speech: key, start, end; without it 0), and the first rule
    that rejects each, else 'accepted'."""
    levels = measured(chunks(segments, audio, rate, by), s, rate).drop("samples")
    if speech is None:
        with_overlap = levels.withColumn("overlap_ratio", F.lit(0.0))
    else:
        with_overlap = levels.join(overlap_depth(segments.select(key, "start", "end"), speech, key), key, "left")
    return first_failure(with_overlap, segment_rules(s))


def filtered(segments: DataFrame, audio: DataFrame, s: Settings, rate: int, speech: DataFrame | None = None, key: str = "id", by: str = "path") -> DataFrame:
    """The accepted segments with their levels."""
    return judged(segments, audio, s, rate, speech, key, by).where("reject_reason = 'accepted'").drop("reject_reason")


def activity(windows: DataFrame, audio: DataFrame, rate: int, by: str = "path") -> DataFrame:
    """windows (a key, start, end) with `audio`, how far their level lies above the
    file's noise floor."""
    own = audio.where("samples is not null").select(by, arrays.doubles("samples").alias("__all"))
    floors = own.withColumn("__floor", arrays.noise_floor(F.col("__all"), rate))
    cut = arrays.stretch(F.col("__all"), rate, F.col("start"), F.col("end"))
    level: Column = F.when(F.size(cut) > 0, arrays.rms(cut)).otherwise(0.0)
    return windows.join(floors, by).withColumn("audio", audio_score(level, F.col("__floor"))).drop("__all", "__floor")
