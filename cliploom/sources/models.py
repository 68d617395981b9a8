"""The boundary to models: detectors, sync scorers and voice activity.

A model is a factory, called once in each worker, that returns a function from a
list of inputs to a list of outputs. The engine ships stand-ins that need none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Factory = Callable[[], Callable[[list], list]]
_loaded: dict[int, Callable[[list], list]] = {}


def _model(factory: Factory) -> Callable[[list], list]:
    key = id(factory)
    if key not in _loaded:
        _loaded[key] = factory()
    return _loaded[key]


def detect(frames: DataFrame, factory: Factory) -> DataFrame:
    """frames (window_id, frame, jpeg) as detections, a row a face. The model gives
    for each image a list of (x1, y1, x2, y2, embedding, score)."""
    schema = "window_id string, frame int, face_ord int, bbox struct<x1:float,y1:float,x2:float,y2:float>, embedding array<float>, det_score double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = _model(factory)
        for pdf in batches:
            rows = []
            for w, f, faces in zip(pdf["window_id"], pdf["frame"], call(list(pdf["jpeg"])), strict=True):
                rows += [(w, f, i, dict(zip(("x1", "y1", "x2", "y2"), face[:4], strict=True)), list(face[4]), float(face[5])) for i, face in enumerate(faces)]
            yield pd.DataFrame(rows, columns=["window_id", "frame", "face_ord", "bbox", "embedding", "det_score"])

    return frames.select("window_id", "frame", "jpeg").mapInPandas(run, schema)


def sync_distances(probes: DataFrame, factory: Factory, clip: str = "clip") -> DataFrame:
    """probe_id, frame, dist: the model gives frames times shifts for each clip."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = _model(factory)
        for pdf in batches:
            rows = [(p, i, [float(x) for x in row]) for p, matrix in zip(pdf["probe_id"], call(list(pdf[clip])), strict=True) for i, row in enumerate(matrix)]
            yield pd.DataFrame(rows, columns=["probe_id", "frame", "dist"])

    return probes.select("probe_id", clip).mapInPandas(run, "probe_id string, frame int, dist array<float>")


def voice_mask(audio: DataFrame, factory: Factory) -> DataFrame:
    """audio (samples) with mask, from a model instead of functions.arrays.speech_mask."""

    @F.pandas_udf("array<boolean>")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = _model(factory)
        for x in batches:
            yield pd.Series([list(map(bool, m)) for m in call(list(x))])

    return audio.withColumn("mask", masked("samples"))


def flat_sync() -> Callable[[list], list]:
    """A stand-in: no shift is nearer than another."""
    return lambda clips: [np.ones((len(c), 21), np.float32) for c in clips]


def ready(factories: dict[str, Factory]) -> dict[str, str]:
    """What hinders models from loading, by their names; empty where all load. A model
    that cannot run where it is told to may fall back itself; what it raises counts."""
    out = {}
    for name, factory in factories.items():
        try:
            _model(factory)
        except Exception as e:  # a model's loader may raise anything
            out[name] = f"{type(e).__name__}: {e}"
    return out


def frame_mask(x: np.ndarray, rate: int, decide: Callable[[bytes, int], bool], frame_ms: int = 30) -> np.ndarray:
    """Samples in a frame that is speech, of frames half a frame apart; a frame that the
    model fails on counts as speech, audio under a frame is all speech."""
    size = int(rate * frame_ms / 1000)
    if len(x) < size:
        return np.ones(len(x), bool)
    pcm = (np.clip(x, -1.0, 1.0) * 32767).astype("<i2")
    mask = np.zeros(len(x), bool)
    for a in range(0, len(x) - size + 1, max(1, size // 2)):
        try:
            speech = decide(pcm[a : a + size].tobytes(), rate)
        except Exception:  # whatever the model raises
            speech = True
        if speech:
            mask[a : a + size] = True
    return mask


def frame_voice_mask(audio: DataFrame, factory: Callable[[], Callable[[bytes, int], bool]], rate: int, frame_ms: int = 30, to: int = 16000) -> DataFrame:
    """audio (samples at `rate`) with mask, from a model that judges frames of 16-bit PCM
    at `to` samples a second; the mask is brought back to the audio's own samples."""
    from .media import resample

    @F.pandas_udf("array<boolean>")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decide = _model(factory)
        for series in batches:
            out = []
            for samples in series:
                x = np.asarray(samples, np.float32)
                mask = frame_mask(resample(x, rate, to), to, decide, frame_ms)
                if len(mask) != len(x):
                    mask = resample(mask.astype(np.float32), len(mask), len(x)) > 0.5
                out.append(mask.tolist())
            yield pd.Series(out)

    return audio.withColumn("mask", masked("samples"))
