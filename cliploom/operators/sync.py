"""Audio-visual sync: from frame distances per shift to verified segments.

A probe has one row a frame with the distance at each of 2 * vshift + 1 shifts.
Rolling means and medians replicate the edges, so that every frame has a value.
All of it is window functions over (probe, frame) and small array functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.arrays import median, running_median
from ..functions.columns import CORNERS, box_of, crop_box
from .intervals import bridge_gaps, interpolated


def smoothed(df: DataFrame, by: str, at: str, value: Column, half: int) -> Column:
    """Mean of the 2 * half + 1 values around each row, the edge values repeated."""
    order = Window.partitionBy(by).orderBy(at)
    place, n = F.row_number().over(order), F.count("*").over(Window.partitionBy(by))
    inner = F.sum(value).over(order.rowsBetween(-half, half))
    first = F.first(value).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.last(value).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before, after = F.greatest(F.lit(0), half - (place - 1)), F.greatest(F.lit(0), half - (n - place))
    return (inner + before * first + after * last) / (2 * half + 1)


def smoothing_half(seconds: float, fps: float) -> int:
    return max(3, round(seconds * fps) | 1) // 2


def framewise(distances: DataFrame, s: Settings) -> DataFrame:
    """probe_id, frame, confidence, offset: at the shift whose smoothed distance is
    least, the median over shifts less the frame's own distance there; implausible
    offsets count as -99; a running median of 9 over frames."""
    shifts, half = 2 * s.sync_vshift + 1, smoothing_half(s.sync_smooth_seconds, s.sync_fps)
    wide = distances.select("probe_id", "frame", *(F.col("dist")[i].cast("double").alias(f"d{i}") for i in range(shifts)))
    order = Window.partitionBy("probe_id").orderBy("frame")
    wide = wide.select("*", *(smoothed(wide, "probe_id", "frame", F.col(f"d{i}"), half).alias(f"s{i}") for i in range(shifts)))
    both = wide.select("probe_id", "frame", F.array(*(f"d{i}" for i in range(shifts))).alias("d"), F.array(*(f"s{i}" for i in range(shifts))).alias("s"))
    best = both.withColumn("best", F.array_position("s", F.array_min("s")).cast("int"))
    raw = best.select("probe_id", "frame", (F.lit(s.sync_vshift + 1) - F.col("best")).cast("int").alias("offset"), (median(F.col("s")) - F.element_at("d", F.col("best"))).alias("raw"))
    raw = raw.withColumn("raw", F.when(F.abs("offset") > s.sync_max_offset, -99.0).otherwise(F.col("raw")))
    return edge_median(raw, "probe_id", order, "raw", 9).withColumnRenamed("raw_median", "confidence").drop("raw")


def edge_median(df: DataFrame, by: str, order, value: str, kernel: int) -> DataFrame:
    """df with <value>_median, over rows, the edge values repeated."""
    half = kernel // 2
    frame = order.rowsBetween(-half, half)
    near = F.collect_list(value).over(frame)
    place, n = F.row_number().over(order), F.count("*").over(Window.partitionBy(by))
    left, right = F.greatest(F.lit(0), half - (place - 1)), F.greatest(F.lit(0), half - (n - place))
    filled = F.concat(F.array_repeat(F.element_at(near, 1), left.cast("int")), near, F.array_repeat(F.element_at(near, -1), right.cast("int")))
    return df.select("*", filled.alias("__near")).select("*", F.element_at(F.array_sort("__near"), half + 1).alias(f"{value}_median")).drop("__near")


def shift_means(distances: DataFrame, s: Settings) -> DataFrame:
    """probe_id and means: the mean distance of each probe at each shift."""
    shifts = range(2 * s.sync_vshift + 1)
    per = distances.groupBy("probe_id").agg(*(F.avg(F.col("dist")[i].cast("double")).alias(f"m{i}") for i in shifts))
    return per.select("probe_id", F.array(*(f"m{i}" for i in shifts)).alias("means"))


def global_scores(distances: DataFrame, s: Settings) -> DataFrame:
    """A row for each probe: the shift with the least mean distance as offset, what the
    median over shifts exceeds it by as confidence, and the least distance of all (NaN
    aside; infinite without any)."""
    means = shift_means(distances, s).withColumn("best", F.array_position("means", F.array_min("means")).cast("int"))
    numbers = F.filter(F.col("dist").cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x))
    least = distances.groupBy("probe_id").agg(F.coalesce(F.min(F.array_min(numbers)), F.lit(float("inf"))).alias("min_distance"))
    baseline = median(F.col("means"))
    scored = means.select(
        "probe_id",
        "best",
        baseline.alias("baseline"),
        (F.lit(s.sync_vshift + 1) - F.col("best")).cast("int").alias("offset"),
        (baseline - F.array_min("means")).alias("confidence"),
    )
    return scored.join(least, "probe_id")


def global_framewise(distances: DataFrame, s: Settings) -> DataFrame:
    """probe_id, frame, confidence at the one shift that is best for the whole probe:
    the median over shifts' means less the frame's own distance there, by a running
    median of 9."""
    of = global_scores(distances, s).select("probe_id", "best", "baseline")
    own = F.element_at(F.col("dist").cast("array<double>"), F.col("best"))
    raw = distances.join(of, "probe_id").select("probe_id", "frame", (F.col("baseline") - own).alias("raw"))
    order = Window.partitionBy("probe_id").orderBy("frame")
    return edge_median(raw, "probe_id", order, "raw", 9).withColumnRenamed("raw_median", "confidence").drop("raw")


def segments(frames: DataFrame, probes: DataFrame, s: Settings) -> DataFrame:
    """Verified segments (probe_id, ordinal, start, end, confidence, high_ratio,
    offset_frames), in seconds from the probe's start. probes: probe_id, duration. Frames
    without an offset count by their confidence alone."""
    fps, local = s.sync_fps, "offset" in frames.columns
    high = F.col("confidence") >= s.framewise_threshold
    high = high & (F.abs("offset") <= s.sync_max_offset) if local else high
    offset = F.col("offset") if local else F.lit(0)
    flagged = frames.withColumn("high", high).withColumn("offset", offset)
    bridged = bridge_gaps(flagged, ["probe_id"], "frame", "high", max(0, round(s.sync_bridge_seconds * fps)))
    order = Window.partitionBy("probe_id").orderBy("frame")
    change = F.when(F.lag("bridged").over(order).eqNullSafe(F.col("bridged")), 0).otherwise(1)
    numbered = bridged.withColumn("c", change).withColumn("run", F.sum("c").over(order))
    runs = numbered.where("bridged").groupBy("probe_id", "run").agg(
        F.min("frame").alias("first"), F.max("frame").alias("last"), F.count_if("high").alias("n_high")
    )
    spans = F.col("last") - F.col("first") + 1
    enough = max(1, round(s.sync_min_span_seconds * fps)), max(1, round(s.sync_min_active_seconds * fps))
    long = runs.where((spans >= enough[0]) & (F.col("n_high") >= enough[1]))
    # a descriptor covers five frames: + 2 is its middle
    timed = long.join(probes.select("probe_id", "duration"), "probe_id")
    timed = timed.withColumn("a", (F.col("first") + 2) / fps).withColumn("b", F.least(F.col("duration"), (F.col("last") + 3) / fps))
    target, least = min(s.target_segment_seconds, s.max_segment_seconds), s.min_segment_seconds
    span = F.col("b") - F.col("a")
    length = F.least(F.greatest(span, F.lit(least)), F.lit(target), F.col("duration"))
    begin = F.greatest(F.lit(0.0), F.least((F.col("a") + F.col("b")) / 2 - length / 2, F.col("duration") - length))
    one = F.array(F.struct(begin.alias("start"), (begin + length).alias("end")))
    n = F.floor(span / target + 1e-9).cast("int")
    rest = span - n * target
    upto = n + F.when(rest >= least - 1e-9, 1).otherwise(0) - 1
    piece = lambda i: F.struct((F.col("a") + i * target).alias("start"), F.least(F.col("b"), F.col("a") + (i + 1) * target).alias("end"))
    pieces = F.transform(F.sequence(F.lit(0), upto), piece)
    cut = timed.select("probe_id", F.explode(F.when(span <= target, one).otherwise(pieces)).alias("x")).select("probe_id", "x.start", "x.end")
    place = F.row_number().over(Window.partitionBy("probe_id").orderBy("start")) - 1
    ordered = cut.withColumn("ordinal", place)
    ranged = ordered.withColumn("f0", F.floor(F.col("start") * fps) - 2).withColumn("f1", F.ceil(F.col("end") * fps) - 2)
    inside = ranged.join(flagged, "probe_id").where((F.col("frame") >= F.col("f0")) & (F.col("frame") < F.col("f1")))
    own = F.when(F.col("high"), F.col("offset"))
    measured = inside.groupBy("probe_id", "ordinal", "start", "end").agg(
        F.avg(F.col("high").cast("int")).alias("high_ratio"),
        F.coalesce(F.median(F.when(F.col("high"), F.col("confidence"))), F.lit(-99.0)).alias("confidence"),
        F.mode(own, True).alias("offset_frames"),
        F.collect_list(own).alias("offsets"),
    )
    share = F.size(F.filter("offsets", lambda x: x == F.col("offset_frames"))) / F.greatest(F.lit(1), F.size("offsets"))
    kept = measured.where(F.col("high_ratio") >= s.sync_high_ratio)
    kept = kept.where(share >= s.sync_offset_share) if local else kept
    whole = F.coalesce(F.col("offset_frames"), F.lit(0)).cast("int").alias("offset_frames")
    return kept.select("probe_id", "ordinal", "start", "end", "confidence", "high_ratio", whole)


def verdicts(probes: DataFrame, found: DataFrame) -> DataFrame:
    """A row for each probe: accepted, confidence and offset of its best segment."""
    first = F.struct("confidence", -F.col("ordinal"))
    best = found.groupBy("probe_id").agg(F.max_by(F.struct("confidence", "offset_frames"), first).alias("x"), F.count("*").alias("n_segments"))
    return probes.join(best, "probe_id", "left").select(
        "probe_id",
        F.col("n_segments").isNotNull().alias("accepted"),
        F.coalesce("n_segments", F.lit(0)).alias("n_segments"),
        F.col("x.confidence").alias("confidence"),
        F.col("x.offset_frames").alias("offset_frames"),
    )


#: Why a probe is accepted or not, by the form of verification.
LOCAL = ("local_framewise_ok", "no_sustained_local_sync")
FRAMEWISE = ("framewise_ok", "no_sustained_framewise_sync_or_offset")
PLAIN = ("ok", "low_confidence_or_offset")


def verify(distances: DataFrame, probes: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Segments, and for each probe (probe_id, duration) accepted, the confidence of the
    whole, offset_frames, min_distance and the reason: by frames with local offsets, by
    frames at one offset, or by the whole probe alone, as the settings say. A probe
    without distances is not accepted."""
    scores = global_scores(distances, s).select("probe_id", "confidence", "offset", "min_distance")
    near = F.abs("offset") <= s.sync_max_offset
    if s.framewise and s.local_offset:
        found = segments(framewise(distances, s), probes, s)
        good, names = F.col("best").isNotNull(), LOCAL
    elif s.framewise:
        found = segments(global_framewise(distances, s), probes, s)
        found = found.join(scores.where(near).select("probe_id"), "probe_id", "left_semi")
        good, names = F.col("best").isNotNull() & near, FRAMEWISE
    else:
        fine = scores.where((F.col("confidence") >= s.sync_confidence) & near).select("probe_id", "confidence", "offset")
        whole = (F.lit(0).alias("ordinal"), F.lit(0.0).alias("start"), F.col("duration").alias("end"))
        found = fine.join(probes.select("probe_id", "duration"), "probe_id")
        found = found.select("probe_id", *whole, "confidence", F.lit(1.0).alias("high_ratio"), F.col("offset").alias("offset_frames"))
        good, names = F.col("best").isNotNull(), PLAIN
    best = verdicts(probes.select("probe_id"), found).where("accepted").select("probe_id", F.col("offset_frames").alias("best"))
    out = probes.select("probe_id").join(scores, "probe_id", "left").join(best, "probe_id", "left")
    good = F.coalesce(good, F.lit(False))
    told = F.coalesce("best", "offset") if s.local_offset and s.framewise else F.col("offset")
    return found, out.select(
        "probe_id",
        good.alias("accepted"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce(told, F.lit(999)).alias("offset_frames"),
        F.coalesce("min_distance", F.lit(float("inf"))).alias("min_distance"),
        F.when(good, names[0]).otherwise(names[1]).alias("reason"),
    )


def unambiguous(segments: DataFrame, rivals: DataFrame, verified: DataFrame) -> DataFrame:
    """segments without those for which a competing track (segment_id, track_id) is
    itself verified (segment_id, track_id, accepted); unchecked rivals don't count."""
    bad = rivals.join(verified.where("accepted"), ["segment_id", "track_id"], "left_semi").select("segment_id").distinct()
    return segments.join(bad, "segment_id", "left_anti")


def smooth_boxes(tracks: DataFrame, kernel: int = 5) -> DataFrame:
    """x1, y1, x2, y2 arrays of a track, each by a running median."""
    return tracks.select("track_id", *(running_median(F.col(c).cast("array<double>"), kernel).alias(c) for c in CORNERS))


def smooth_points(points: DataFrame, kernel: int = 5) -> DataFrame:
    """points (track_id, frame, x1, y1, x2, y2) with each corner by a running median over
    the track's points; tracks of fewer than `kernel` points stay as they are."""
    order = Window.partitionBy("track_id").orderBy("frame")
    n = F.count("*").over(Window.partitionBy("track_id"))
    out = points.select("track_id", "frame", *(F.col(c).cast("double").alias(c) for c in CORNERS), n.alias("__n"))
    for c in CORNERS:
        out = edge_median(out, "track_id", order, c, kernel)
    return out.select("track_id", "frame", *(F.when(F.col("__n") >= kernel, F.col(f"{c}_median")).otherwise(F.col(c)).alias(c) for c in CORNERS))


def clip_frames(probes: DataFrame, points: DataFrame, s: Settings, scale: tuple[float, float] = (1.0, 1.0), size: tuple[int, int] = (1920, 1080)) -> DataFrame:
    """For each frame of a probe's clip at sync_fps (probe_id, output_frame) the square to
    cut from the source, or null: the track's smoothed box at that time, interpolated
    between points and held for a second beyond its ends. probes: probe_id, track_id,
    start, duration; `scale` leads from the detections' pixels to the source's `size`."""
    total = F.greatest(F.lit(1), F.floor(F.col("duration") * s.sync_fps).cast("int"))
    spread = probes.select("probe_id", "track_id", "start", F.explode(F.sequence(F.lit(0), total - 1)).alias("output_frame"))
    position = (F.col("start") + F.col("output_frame") / s.sync_fps) * s.detect_fps
    asked = spread.select("probe_id", "track_id", "output_frame", position.alias("frame"))
    at = interpolated(asked, smooth_points(points), ["track_id"], "frame", list(CORNERS), s.detect_fps)
    box = box_of(*(F.col(c) * scale[i % 2] for i, c in enumerate(CORNERS)))
    return at.select("probe_id", "output_frame", crop_box(box, s.crop_margin, *size).alias("crop"))


def complete_clips(frames: DataFrame, share: float = 0.80, least: int = 10) -> DataFrame:
    """probe_id, total, written and complete: whether enough of a clip's frames have a
    square, `least` and `share` of them."""
    per = frames.groupBy("probe_id").agg(F.count("*").alias("total"), F.count("crop").alias("written"))
    wanted = F.greatest(F.lit(least), F.floor(F.col("total") * share))
    return per.withColumn("complete", F.col("written") >= wanted)
