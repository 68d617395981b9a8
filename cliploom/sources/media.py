"""Audio and video files behind Arrow functions.

WAV files are read and written with the standard library. Probing and cutting
videos call ffprobe and ffmpeg on the executors; without them a probe gives 0 and
a cut an error in its own column, so that one bad file never ends a job.
"""

from __future__ import annotations

import hashlib
import io
import shutil
import subprocess
import wave
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_wav(raw: bytes) -> tuple[np.ndarray, int]:
    """Mono samples in [-1, 1] and the rate; raises ValueError if there are none."""
    with wave.open(io.BytesIO(raw)) as w:
        kind = {1: np.uint8, 2: np.int16, 4: np.int32}[w.getsampwidth()]
        x = np.frombuffer(w.readframes(w.getnframes()), kind).reshape(-1, w.getnchannels())
        rate = w.getframerate()
    return to_mono(x), rate


def to_mono(x: np.ndarray) -> np.ndarray:
    """Channels averaged, integers scaled, infinities cut, scaled by the peak where
    it exceeds 1.5."""
    if x.size == 0:
        raise ValueError("no samples")
    if x.dtype == np.uint8:
        x = (x.astype(np.float64) - 128) / 128
    elif np.issubdtype(x.dtype, np.integer):
        x = x / float(np.iinfo(x.dtype).max + 1)
    x = np.nan_to_num(x.astype(np.float64), nan=0.0, posinf=1.0, neginf=-1.0)
    x = x.mean(axis=1) if x.ndim > 1 else x
    peak = np.abs(x).max()
    return (x / peak if peak > 1.5 else x).astype(np.float32)


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """16-bit PCM."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


def resample(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """By cutting or padding the spectrum; the length by truncation, one sample at least."""
    if rate == to or not len(x):
        return x
    n = max(1, int(len(x) * to / rate))
    spectrum = np.fft.rfft(x)
    wide = np.zeros(n // 2 + 1, complex)
    m = min(len(x), n)
    wide[: m // 2 + 1] = spectrum[: m // 2 + 1]
    if m % 2 == 0:  # the middle frequency stands for both of its signs
        wide[m // 2] *= 2.0 if n < len(x) else 0.5 if n > len(x) else 1.0
    return (np.fft.irfft(wide, n) * (n / len(x))).astype(np.float32)


def cut(x: np.ndarray, rate: int, start: float, end: float) -> np.ndarray:
    return x[max(0, int(start * rate)) : max(0, int(end * rate))]


def read_wavs(spark: SparkSession, path: str, rate: int = 16000) -> DataFrame:
    """path, rate, samples, error of every WAV file below a folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, raw in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    x, own = decode_wav(raw)
                    rows.append((p, rate, resample(x, own, rate).tolist(), None))
                except (ValueError, wave.Error, EOFError, KeyError) as e:
                    rows.append((p, rate, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "rate", "samples", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, rate int, samples array<float>, error string")


def clips(audio: DataFrame, segments: DataFrame) -> DataFrame:
    """segments (path, start, end) with the clip as 16-bit PCM and its SHA-1."""

    @F.pandas_udf("wav binary, sha1 string")
    def made(x: pd.Series, rate: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        raw = [encode_wav(cut(np.asarray(s, np.float32), r, p, q), r) for s, r, p, q in zip(x, rate, a, b, strict=True)]
        return pd.DataFrame({"wav": raw, "sha1": [hashlib.sha1(w).hexdigest() for w in raw]})

    both = segments.join(audio.where("samples is not null").select("path", "rate", "samples"), "path")
    return both.withColumn("clip", made("samples", "rate", "start", "end")).select("*", "clip.wav", "clip.sha1").drop("samples", "clip")


def encoded(df: DataFrame, rate: int, samples: str = "samples") -> DataFrame:
    """df with wav, its samples as 16-bit PCM, and their SHA-1, instead of the samples."""

    @F.pandas_udf("wav binary, sha1 string")
    def made(x: pd.Series) -> pd.DataFrame:
        raw = [encode_wav(np.asarray(v, np.float32), rate) for v in x]
        return pd.DataFrame({"wav": raw, "sha1": [hashlib.sha1(w).hexdigest() for w in raw]})

    return df.withColumn("clip", made(F.col(samples).cast("array<float>"))).select("*", "clip.wav", "clip.sha1").drop("clip", samples)


def _run(*command: str) -> str:
    if not shutil.which(command[0]):
        raise OSError(f"{command[0]} is not installed")
    return subprocess.run(command, capture_output=True, text=True, check=True, timeout=3600).stdout


def durations(videos: DataFrame) -> DataFrame:
    """videos (path) with video_duration in seconds, 0.0 where it can't be told."""

    @F.pandas_udf("double")
    def seconds(paths: pd.Series) -> pd.Series:
        def one(path: str) -> float:
            try:
                return float(_run("ffprobe", "-v", "error", "-show_entries", "format=duration", "-of", "default=nw=1:nk=1", path))
            except (OSError, ValueError, subprocess.SubprocessError):
                return 0.0

        return paths.map(one)

    return videos.withColumn("video_duration", seconds("path"))


def window_audio(windows: DataFrame, rate: int = 16000) -> DataFrame:
    """windows (path, start, duration) with wav (mono PCM) and error."""

    @F.pandas_udf("wav binary, error string")
    def made(path: pd.Series, start: pd.Series, duration: pd.Series) -> pd.DataFrame:
        rows = []
        for p, a, d in zip(path, start, duration, strict=True):
            try:
                if not shutil.which("ffmpeg"):
                    raise OSError("ffmpeg is not installed")
                command = ["ffmpeg", "-v", "error", "-ss", str(a), "-t", str(d), "-i", p, "-vn", "-ac", "1", "-ar", str(rate), "-f", "wav", "-"]
                rows.append((subprocess.run(command, capture_output=True, check=True, timeout=3600).stdout, None))
            except (OSError, subprocess.SubprocessError) as e:
                rows.append((None, str(e)))
        return pd.DataFrame(rows, columns=["wav", "error"])

    return windows.withColumn("audio", made("path", "start", "duration")).select("*", "audio.*").drop("audio")


def window_frames(windows: DataFrame, fps: float = 5.0, width: int = 640) -> DataFrame:
    """windows (path, start, duration) as one row a frame: frame, jpeg. A window
    without frames gives one row with its error."""
    schema = T.StructType([*windows.schema.fields, *(T.StructField(n, t) for n, t in (("frame", T.IntegerType()), ("jpeg", T.BinaryType()), ("error", T.StringType())))])
    own = windows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                try:
                    if not shutil.which("ffmpeg"):
                        raise OSError("ffmpeg is not installed")
                    command = ["ffmpeg", "-v", "error", "-ss", str(row.start), "-t", str(row.duration), "-i", row.path, "-vf", f"fps={fps},scale={width}:-2", "-f", "image2pipe", "-c:v", "mjpeg", "-"]
                    stream = subprocess.run(command, capture_output=True, check=True, timeout=3600).stdout
                    found = [b"\xff\xd8" + x for x in stream.split(b"\xff\xd8")[1:]]
                    rows += [(*row, i, x, None) for i, x in enumerate(found)] or [(*row, 0, None, "no frames")]
                except (OSError, subprocess.SubprocessError) as e:
                    rows.append((*row, 0, None, str(e)))
            yield pd.DataFrame(rows, columns=[*own, "frame", "jpeg", "error"])

    return windows.mapInPandas(run, schema)


def copy_files(plan: DataFrame) -> DataFrame:
    """Copies source to target on a shared file system; (target, bytes, error)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for source, target in zip(pdf["source"], pdf["target"], strict=True):
                try:
                    Path(target).parent.mkdir(parents=True, exist_ok=True)
                    shutil.copyfile(source, f"{target}.part")
                    Path(f"{target}.part").replace(target)
                    rows.append((target, Path(target).stat().st_size, None))
                except OSError as e:
                    rows.append((target, 0, str(e)))
            yield pd.DataFrame(rows, columns=["target", "bytes", "error"])

    return plan.select("source", "target").mapInPandas(run, "target string, bytes long, error string")


def write_files(df: DataFrame) -> DataFrame:
    """Writes `content` to `path` on a shared file system, whole or not at all;
    (path, bytes, error)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    Path(path).parent.mkdir(parents=True, exist_ok=True)
                    Path(f"{path}.part").write_bytes(content)
                    Path(f"{path}.part").replace(path)
                    rows.append((path, len(content), None))
                except OSError as e:
                    rows.append((path, 0, str(e)))
            yield pd.DataFrame(rows, columns=["path", "bytes", "error"])

    return df.select("path", "content").mapInPandas(run, "path string, bytes long, error string")


def _cut_media(command: list[str], target: Path, keep_over: int = 0) -> str | None:
    """Runs ffmpeg into a file, whole or not at all; an error in words. A file with more
    bytes than `keep_over` is taken as it is, if that is over 0."""
    if keep_over and target.exists() and target.stat().st_size > keep_over:
        return None
    if not shutil.which("ffmpeg"):
        return "ffmpeg is not installed"
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f".{target.name}.part{target.suffix}")
    try:
        subprocess.run(["ffmpeg", "-v", "error", "-y", *command, str(part)], capture_output=True, check=True, timeout=3600)
        part.replace(target)
    except (OSError, subprocess.SubprocessError) as e:
        return str(e)
    return None


#: Bytes over which a file of audio is taken as made already.
CACHED_BYTES = 1024


def extracted(windows: DataFrame, folder: str, rate: int = 16000, fps: float = 5.0, width: int = 640) -> DataFrame:
    """windows (path, video_id, and start, duration, tag of a part; without a tag the
    whole video) with audio_path, frames_path, n_frames and error: audio and frames on a
    shared folder, made together. Audio that is there already is not made again, frames
    always are; a window without frames has an error."""
    part = "tag" in windows.columns
    more = [T.StructField("audio_path", T.StringType()), T.StructField("frames_path", T.StringType()), T.StructField("n_frames", T.IntegerType()), T.StructField("error", T.StringType())]
    schema = T.StructType([*windows.schema.fields, *more])

    def one(row) -> tuple:
        span = ["-ss", f"{row.start:.3f}", "-i", row.path, "-t", f"{row.duration:.3f}"] if part else ["-i", row.path]
        below = Path("windows") / row.video_id / row.tag if part else Path(row.video_id)
        audio, frames = Path(folder) / "audio" / f"{below}.wav", Path(folder) / "frames" / below
        error = _cut_media([*span, "-vn", "-ac", "1", "-ar", str(rate), "-acodec", "pcm_s16le"], audio, CACHED_BYTES)
        shutil.rmtree(frames, ignore_errors=True)
        if error is None:
            frames.mkdir(parents=True, exist_ok=True)
            command = ["ffmpeg", "-v", "error", "-y", *span, "-vf", f"fps={fps},scale={width}:-1", "-q:v", "5", str(frames / "frame_%06d.jpg")]
            try:
                subprocess.run(command, capture_output=True, check=True, timeout=3600)
            except (OSError, subprocess.SubprocessError) as e:
                error = str(e)
        n = len(list(frames.glob("frame_*.jpg"))) if frames.exists() else 0
        return str(audio), str(frames), n, error or (None if n else "no frames")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [one(r) for r in pdf.itertuples(index=False)]
            yield pdf.assign(**{f.name: [r[i] for r in rows] for i, f in enumerate(more)})

    return windows.mapInPandas(run, schema)


def deleted(paths: DataFrame, empty_parents: int = 0) -> DataFrame:
    """Deletes files and folders (path) of a shared file system, and up to so many folders
    above that are empty then; (path, gone)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in map(Path, pdf["path"]):
                if path.is_dir():
                    shutil.rmtree(path, ignore_errors=True)
                else:
                    path.unlink(missing_ok=True)
                for above in list(path.parents)[:empty_parents]:
                    try:
                        above.rmdir()
                    except OSError:
                        break
            yield pd.DataFrame({"path": pdf["path"], "gone": [not Path(p).exists() for p in pdf["path"]]})

    return paths.select("path").mapInPandas(run, "path string, gone boolean")
