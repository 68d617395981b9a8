"""Speakers and videos of a manifest: usable rows, joins, exclusions, checks."""

from __future__ import annotations

import importlib.util
import shutil
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.columns import OFF_LOCAL, flagged, folded, given, number, parts, stem, truthy, year
from ..schema import require


def usable_speakers(speakers: DataFrame) -> DataFrame:
    require(speakers, "speaker_id", "name", "reference_images")
    there = lambda c: F.col(c) if c in speakers.columns else F.lit("")
    named = given("speaker_id").isNotNull() & given("name").isNotNull()
    rows = speakers.where(named & truthy(there("use")) & ~flagged(there("exclude_from_train")))
    filled = [F.coalesce(given(there(c)), F.lit("unknown")).alias(c) for c in ("gender", "category", "region")]
    own = (given("speaker_id").alias("speaker_id"), given("name").alias("name"), parts("reference_images").alias("reference_images"))
    out = rows.select(*own, *filled, year(there("birth_year")).alias("birth_year"))
    return out.where(F.size("reference_images") > 0)


def usable_videos(videos: DataFrame) -> DataFrame:
    require(videos, "speaker_id", "youtube_id")
    there = lambda c: F.col(c) if c in videos.columns else F.lit("")
    rows = videos.where(given("speaker_id").isNotNull() & given("youtube_id").isNotNull() & truthy(there("use")))
    return rows.select(
        given("speaker_id").alias("speaker_id"),
        given("youtube_id").alias("youtube_id"),
        F.coalesce(given(there("url")), F.lit("")).alias("url"),
        F.coalesce(given(there("split")), F.lit("train")).alias("split"),
        number(there("priority"), 1).cast("int").alias("priority"),
    )


def without_excluded(speakers: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """Without those whose name is in `names` (column name), whatever case or accents."""
    keys = names.select(folded("name").alias("__name")).where(F.col("__name") != "").distinct()
    return speakers.join(keys, folded(speakers[name]) == F.col("__name"), "left_anti")


def with_enough_videos(speakers: DataFrame, videos: DataFrame, least: int = 2) -> DataFrame:
    """speakers joined to their videos, where a speaker has at least `least` rows of them."""
    counted = videos.groupBy("speaker_id").agg(F.count("youtube_id").alias("n_videos"))
    return speakers.join(counted.where(F.col("n_videos") >= least), "speaker_id").join(videos, "speaker_id")


def in_order(videos: DataFrame, *ties: str) -> DataFrame:
    """videos with their place by priority; ties by the columns given, else by id."""
    order = Window.partitionBy("speaker_id").orderBy("priority", *(ties or ("youtube_id",)))
    return videos.withColumn("position", F.row_number().over(order))


def first_videos(videos: DataFrame, n: int, speaker_order: str = "speaker_id") -> DataFrame:
    """The first n videos of all speakers: speaker by speaker, each by priority."""
    return in_order(videos).orderBy(speaker_order, "position").limit(n)


def subset(df: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the wanted speakers, and the wanted ids that don't exist."""
    return df.join(wanted, "speaker_id", "left_semi"), wanted.join(df, "speaker_id", "left_anti")


def of_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose (speaker, video) is configured."""
    return df.join(pairs.select("speaker_id", "video_id").distinct(), ["speaker_id", "video_id"], "left_semi")


def of_speakers(df: DataFrame, speakers: DataFrame) -> DataFrame:
    return df.join(speakers.select("speaker_id").distinct(), "speaker_id", "left_semi")


def references_of(files: DataFrame) -> DataFrame:
    """Reference images by the part of their file name before the first _."""
    named = files.select(F.substring_index(stem("path"), "_", 1).alias("speaker_id"), "path")
    return named.where("speaker_id <> ''").groupBy("speaker_id").agg(F.count("*").alias("n_references"))


def local_videos(videos: DataFrame, files: DataFrame) -> DataFrame:
    """Each wanted row with whether <id>.mp4 is there, its path, and else a file <id>.*
    of another kind, which doesn't count as there. `files`: path, of one folder."""
    wanted = videos.where(truthy("use", OFF_LOCAL) & given("youtube_id").isNotNull()).select(given("youtube_id").alias("youtube_id"))
    named = files.select("path", F.element_at(F.split("path", "/"), -1).alias("file"))
    exact = named.where(F.col("file").endswith(".mp4")).select(F.expr("left(file, length(file) - 4)").alias("youtube_id"), "path")
    exact = exact.groupBy("youtube_id").agg(F.min("path").alias("path"))
    dots = F.filter(F.sequence(F.lit(1), F.length("file")), lambda i: F.substr(F.col("file"), i, F.lit(1)) == ".")
    heads = named.select("path", F.explode(F.transform(dots, lambda i: F.substr(F.col("file"), F.lit(1), i - 1))).alias("youtube_id"))
    near = heads.groupBy("youtube_id").agg(F.min("path").alias("near"))
    out = wanted.join(exact, "youtube_id", "left").join(near, "youtube_id", "left")
    missing = F.col("path").isNull()
    return out.select("youtube_id", "path", F.when(missing, F.col("near")).alias("near"), missing.alias("missing"))


def preflight(speakers: DataFrame, videos: DataFrame, references: DataFrame, target: int, cap: int, least: int, min_references: int = 2, min_videos: int = 2) -> DataFrame:
    """speaker_id and problem, a row for each thing that can't work. Of `videos` with a
    column `local` only those with a file count as sources, all as what quotas rest on; a
    video named by several rows counts once."""
    local = F.col("local") if "local" in videos.columns else F.lit(True)
    own = videos.groupBy("speaker_id", "youtube_id").agg(F.coalesce(F.bool_or(local), F.lit(False)).alias("local"))
    n = own.groupBy("speaker_id").agg(F.count("youtube_id").alias("n_videos"), F.count_if("local").alias("n_local"))
    both = speakers.select("speaker_id").join(n, "speaker_id", "left").join(references, "speaker_id", "left")
    both = both.fillna(0, ["n_videos", "n_local", "n_references"])
    rules: list[tuple[str, Column]] = [
        ("too few references", F.col("n_references") < min_references),
        ("too few videos", F.col("n_local") < min_videos),
        ("caps can't reach the target", F.col("n_videos") * cap < target),
        ("reserves exceed the target", F.col("n_videos") * least > target),
    ]
    said = F.array_compact(F.array(*(F.when(broken, F.lit(name)) for name, broken in rules)))
    return both.select("speaker_id", F.explode(said).alias("problem"))


#: Programs that cut media.
PROGRAMS = ("ffmpeg", "ffprobe")


def environment_problems(s: Settings, n_speakers: int, packages: tuple[str, ...] = (), files: tuple[str, ...] = (), programs: tuple[str, ...] = PROGRAMS) -> list[str]:
    """What the machine or the configuration lacks, all of it: programs, packages and
    model files, speakers, and an early stop that leaves no room for a video's cap."""
    out = [f"{p} is not installed" for p in programs if shutil.which(p) is None]
    out += [f"package {p} is missing" for p in packages if importlib.util.find_spec(p) is None]
    out += [f"model file {p} is missing" for p in files if not Path(p).is_file()]
    if not n_speakers:
        out.append("no speakers are configured")
    if s.early_stop and s.early_stop_candidates < s.max_per_video:
        out.append("the early stop leaves no room for a video's cap")
    return out
