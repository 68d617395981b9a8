"""Time: windows, islands, gaps, overlaps and nearest neighbours.

All windows are partitioned by a key the caller names; joins keep equality on it
(and, for overlaps, on a time bucket), so nothing becomes a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import temporal_iou


def _steps(start: Column, stop: Column, hop: float) -> Column:
    """0, 1, ... while start + i * hop lies before stop."""
    n = F.greatest(F.lit(1), F.ceil((stop - start) / hop - F.lit(1e-9)))
    return F.sequence(F.lit(0), n.cast("int") - 1)


#: The modes in which a video stays whole, and the tags of its one window.
WHOLE_MODES, WHOLE, SINGLE = ("off", "full", "false", "0"), "full", "w0000"


def video_windows(
    videos: DataFrame,
    window: float = 600.0,
    hop: float = 600.0,
    least: float = 60.0,
    begin: float = 0.0,
    most: int = 0,
    mode: str = "windowed",
    strategy: str = "sliding",
) -> DataFrame:
    """Windows of each video (video_id, video_duration): one of the full length if it
    fits or the mode says so, else each hop from `begin`, without a last one shorter
    than `least`, at most `most` (0: all); with the strategy uniform `most` windows
    spread evenly. An unknown length counts as one window."""
    known = F.when(F.col("video_duration") > 0, F.col("video_duration").cast("double")).otherwise(F.lit(float(window)))
    videos = videos.withColumn("video_duration", known)
    length = F.col("video_duration")
    columns = ("video_id", "idx", "start", "duration", "tag", "video_duration")
    whole = F.lit(True) if mode.lower() in WHOLE_MODES else length <= window
    tag = F.lit(WHOLE if mode.lower() in WHOLE_MODES else SINGLE)
    single = videos.where(whole).select("*", F.lit(0).alias("idx"), F.lit(0.0).alias("start"), length.alias("duration"), tag.alias("tag"))
    rest = videos.where(~whole)
    if most > 0 and strategy.lower() == "uniform":
        cut = uniform_windows(rest, most, window, begin, least)
    else:
        spread = rest.withColumn("idx", F.explode(_steps(F.lit(max(0.0, float(begin))), length, hop)))
        at = F.lit(max(0.0, float(begin))) + F.col("idx") * F.lit(float(hop))
        cut = spread.withColumn("start", at).withColumn("duration", F.least(F.lit(float(window)), length - F.col("start")))
        cut = cut.where((F.col("start") < length) & (length - F.col("start") >= least))
        cut = cut.where(F.col("idx") < most) if most > 0 else cut
    tagged = cut.withColumn("tag", F.format_string("w%04d_%06d", "idx", F.col("start").cast("long")))
    return single.select(*columns).unionByName(tagged.select(*columns))


def uniform_windows(videos: DataFrame, count: int, window: float = 600.0, begin: float = 0.0, least: float = 60.0) -> DataFrame:
    """`count` windows with starts spread evenly over each video, from `begin` to the
    last that fits."""
    length = F.col("video_duration")
    span = F.greatest(F.lit(0.0), length - window)
    first = F.least(F.lit(max(0.0, float(begin))), span)
    spread = videos.withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    even = first + (F.greatest(first, span) - first) * F.col("idx") / max(1, count - 1) if count > 1 else first
    start = F.greatest(F.lit(0.0), F.least(even, F.greatest(F.lit(0.0), length - least)))
    cut = spread.withColumn("start", start)
    return cut.withColumn("duration", F.least(F.lit(float(window)), F.greatest(F.lit(float(least)), length - F.col("start"))))


def stratified_order(n: int) -> list[int]:
    """First, middle (half to even) and last, then ever the index farthest from
    those chosen, the lowest of equals."""
    if n <= 2:
        return list(range(n))
    chosen = [0, round((n - 1) / 2), n - 1]
    distance = [min(abs(i - c) for c in chosen) for i in range(n)]
    while len(chosen) < n:
        best = max(range(n), key=lambda i: (distance[i], -i))
        chosen.append(best)
        distance = [min(d, abs(i - best)) for i, d in enumerate(distance)]
    return chosen


def stratified(windows: DataFrame, by: str = "video_id") -> DataFrame:
    """windows with `visit`, the 0-based place of each in the stratified order of
    its video; a video's windows are as many as its length allows."""
    size = windows.groupBy(by).agg(F.count("*").alias("__n"))
    ranked = windows.withColumn("__i", F.row_number().over(Window.partitionBy(by).orderBy("idx")) - 1)

    def orders(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame([(n, i, place) for n in pdf["__n"] for place, i in enumerate(stratified_order(int(n)))], columns=["__n", "__i", "visit"])

    table = size.select("__n").distinct().mapInPandas(orders, "__n long, __i int, visit int")
    return ranked.join(size, by).join(table, ["__n", "__i"]).drop("__n", "__i")


def probes(tracks: DataFrame, points: DataFrame, fps: float, length: float = 12.0, hop: float = 10.0, least: float = 2.0, coverage: float = 0.70, most: int = 160) -> DataFrame:
    """Windows of each track (track_id, window_id, start_time, end_time, face_conf)
    with enough of its points (track_id, frame): the first `most` of each window by
    start, then face_conf. The last is the one that reaches the track's end."""
    span = tracks.withColumn("i", F.explode(_steps(F.col("start_time"), F.col("end_time"), hop)))
    cut = span.withColumn("start", F.col("start_time") + F.col("i") * F.lit(float(hop))).withColumn("end", F.least(F.col("end_time"), F.col("start") + F.lit(float(length))))
    cut = cut.where((F.col("end") - F.col("start") >= least) & ((F.col("i") == 0) | (F.col("start") - hop + length < F.col("end_time"))))
    first, last = F.floor(F.col("start") * fps), F.ceil(F.col("end") * fps)
    ranged = cut.withColumn("first", first).withColumn("last", last)
    inside = (points["frame"] >= ranged["first"]) & (points["frame"] <= ranged["last"])
    counted = ranged.join(points, (ranged["track_id"] == points["track_id"]) & inside).groupBy(ranged["track_id"], ranged["i"]).agg(F.count("*").alias("n"))
    share = F.col("n") / F.greatest(F.lit(1), F.col("last") - F.col("first") + 1)
    kept = ranged.join(counted, ["track_id", "i"]).withColumn("coverage", share).where(F.col("coverage") >= coverage)
    at = F.row_number().over(Window.partitionBy("window_id").orderBy("start", F.desc("face_conf"), "track_id"))
    return kept.withColumn("position", at).where(F.col("position") <= most).select("track_id", "window_id", "start", "end", "coverage", "position")


def merge_sessions(df: DataFrame, by: list[str], gap: float, *means: str) -> DataFrame:
    """Intervals (start, end) whose start lies at most `gap` after the latest end
    so far, as one: with the number of parts and the means asked for."""
    order = Window.partitionBy(*by).orderBy("start", "end")
    so_far = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(so_far.isNull() | (F.col("start") > so_far + gap), 1).otherwise(0)
    numbered = df.withColumn("__new", new).withColumn("island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_parts"), *(F.avg(c).alias(c) for c in means))


def runs(df: DataFrame, by: list[str], at: str, flag: str) -> DataFrame:
    """Maximal runs of equal flags by position: by, run, flag, first, last, n."""
    order = Window.partitionBy(*by).orderBy(at)
    change = F.when(F.lag(flag).over(order).eqNullSafe(F.col(flag)), 0).otherwise(1)
    numbered = df.withColumn("__c", change).withColumn("run", F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "run").agg(F.first(flag).alias(flag), F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n"))


def bridge_gaps(df: DataFrame, by: list[str], at: str, flag: str, most: int) -> DataFrame:
    """df with `bridged`: inner runs of false of at most `most` rows become true."""
    order = Window.partitionBy(*by).orderBy(at)
    whole = Window.partitionBy(*by)
    change = F.when(F.lag(flag).over(order).eqNullSafe(F.col(flag)), 0).otherwise(1)
    numbered = df.withColumn("__c", change).withColumn("__run", F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sized = numbered.withColumn("__n", F.count("*").over(Window.partitionBy(*by, "__run"))).withColumn("__last", F.max("__run").over(whole))
    inner = (F.col("__run") > 1) & (F.col("__run") < F.col("__last")) & (F.col("__n") <= most)
    return sized.withColumn("bridged", F.col(flag) | inner).drop("__c", "__run", "__n", "__last")


def slices(df: DataFrame, length: float, least: float) -> DataFrame:
    """start, end cut into pieces of `length`; a rest shorter than `least` goes."""
    spread = df.withColumn("slice", F.explode(_steps(F.col("start"), F.col("end"), length)))
    begin = F.col("start") + F.col("slice") * F.lit(float(length))
    cut = spread.withColumn("__s", begin).withColumn("end", F.least(F.col("end"), begin + length)).withColumn("start", F.col("__s")).drop("__s")
    return cut.where(F.col("end") - F.col("start") >= least - 1e-9)


def overlap_pairs(df: DataFrame, by: list[str], key: str, bucket: float, more_than: float = 0.0) -> DataFrame:
    """Pairs a < b of a group that overlap in time by an IoU over `more_than`. Each
    interval goes to the time buckets it touches, and a pair is found in the first
    bucket of both, so the join is on (group, bucket) however long a group is."""
    b = F.explode(F.sequence(F.floor(F.col("start") / bucket), F.floor(F.col("end") / bucket)))
    spread = df.where(F.col("end") > F.col("start")).select(*by, key, "start", "end", b.alias("bucket"))
    left = spread.select(*by, "bucket", F.col(key).alias("a"), F.col("start").alias("a0"), F.col("end").alias("a1"))
    right = spread.select(*by, "bucket", F.col(key).alias("b"), F.col("start").alias("b0"), F.col("end").alias("b1"))
    met = left.join(right, [*by, "bucket"]).where((F.col("a") < F.col("b")) & (F.col("a0") < F.col("b1")) & (F.col("b0") < F.col("a1")) & (F.col("bucket") == F.floor(F.greatest("a0", "b0") / bucket)))
    return met.withColumn("iou", temporal_iou("a0", "a1", "b0", "b1")).where(F.col("iou") > more_than).drop("bucket")


def overlap_depth(spans: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Share of each span (key, start, end) where more than one part overlaps: 1
    for an empty span, 0 without parts. A sweep over the parts' ends."""
    cut = parts.withColumnsRenamed({"start": "p0", "end": "p1"}).join(spans.select(key, "start", "end"), key)
    inside = cut.select(key, F.greatest("p0", "start").alias("p0"), F.least("p1", "end").alias("p1")).where("p1 > p0")
    events = inside.select(key, F.explode(F.array(F.struct(F.col("p0").alias("t"), F.lit(1).alias("d")), F.struct(F.col("p1").alias("t"), F.lit(-1).alias("d")))).alias("e")).select(key, "e.t", "e.d")
    at = events.groupBy(key, "t").agg(F.sum("d").alias("d"))
    order = Window.partitionBy(key).orderBy("t")
    deep = at.withColumn("depth", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("upto", F.lead("t").over(order))
    total = deep.where("depth > 1 and upto is not null").groupBy(key).agg(F.sum(F.col("upto") - F.col("t")).alias("deep"))
    length = F.col("end") - F.col("start")
    share = F.when(length <= 0, 1.0).otherwise(F.coalesce("deep", F.lit(0.0)) / length)
    return spans.join(total, key, "left").select(key, share.alias("overlap_ratio"))


def nearest(left: DataFrame, right: DataFrame, by: list[str], at: str, value: str, most: float) -> DataFrame:
    """left with the value of the nearest right row of its group, the earlier of
    equally near ones; null beyond `most`. One sort of both, no join."""
    both = left.select(*by, F.col(at).alias("__t"), F.struct(*left.columns).alias("__l"), F.lit(None).cast(right.schema[value].dataType).alias("__v")).withColumn("__r", F.lit(None).cast("double"))
    both = both.unionByName(right.select(*by, F.col(at).alias("__t"), F.lit(None).cast(both.schema["__l"].dataType).alias("__l"), F.col(value).alias("__v"), F.col(at).cast("double").alias("__r")))
    pair = F.when(F.col("__r").isNotNull(), F.struct(F.col("__r").alias("t"), F.col("__v").alias("v")))
    order = Window.partitionBy(*by).orderBy("__t", F.col("__r").isNull())  # right rows before left ones of the same time
    prior = F.last(pair, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(pair, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    found = both.select("*", prior.alias("__p"), after.alias("__n")).where("__l is not null")
    back, on = F.col("__t") - F.col("__p.t"), F.col("__n.t") - F.col("__t")
    before = F.col("__p").isNotNull() & (F.col("__n").isNull() | (back <= on))
    gap = F.when(before, back).otherwise(on)
    return found.select("__l.*", F.when(gap <= most, F.when(before, F.col("__p.v")).otherwise(F.col("__n.v"))).alias(value), F.when(gap <= most, gap).alias("gap"))


def interpolated(left: DataFrame, right: DataFrame, by: list[str], at: str, value: str | list[str], beyond: float) -> DataFrame:
    """left with the right value (or values) interpolated at its time; the first and last
    hold for `beyond` outside of them, then null. One sort of both, no join."""
    values = [value] if isinstance(value, str) else value
    said = F.array(*(F.col(v).cast("double") for v in values))
    nothing = F.lit(None).cast("array<double>")
    both = left.select(*by, F.col(at).cast("double").alias("__t"), F.struct(*left.columns).alias("__l"), nothing.alias("__v"))
    none = F.lit(None).cast(both.schema["__l"].dataType).alias("__l")
    both = both.unionByName(right.where(F.col(values[0]).isNotNull()).select(*by, F.col(at).cast("double").alias("__t"), none, said.alias("__v")))
    pair = F.when(F.col("__v").isNotNull(), F.struct(F.col("__t").alias("t"), F.col("__v").alias("v")))
    order = Window.partitionBy(*by).orderBy("__t", F.col("__v").isNull())
    prior = F.last(pair, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(pair, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    found = both.select("*", prior.alias("__p"), after.alias("__n")).where("__l is not null")
    p, n, t = F.col("__p"), F.col("__n"), F.col("__t")

    def one(i: int) -> Column:
        share = (t - p["t"]) / (n["t"] - p["t"])
        between = F.when(n["t"] > p["t"], p["v"][i] + (n["v"][i] - p["v"][i]) * share).otherwise(p["v"][i])
        inside = F.when(p.isNotNull() & n.isNotNull(), between)
        return inside.when(p.isNull() & (n["t"] - t <= beyond), n["v"][i]).when(n.isNull() & (t - p["t"] <= beyond), p["v"][i])

    return found.select("__l.*", *(one(i).alias(v) for i, v in enumerate(values)))


def differences(df: DataFrame, by: list[str], at: str, value: str, scale: float = 255.0) -> DataFrame:
    """df with `difference`, the mean absolute change of an array (a region's pixels)
    from the row before, over `scale`; null in a group's first row."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(at))
    change = F.zip_with(F.col(value).cast("array<double>"), before.cast("array<double>"), lambda x, y: F.abs(x - y))
    mean = F.aggregate(change, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.lit(1), F.size(value))
    return df.withColumn("difference", F.when(before.isNotNull(), mean / scale))
