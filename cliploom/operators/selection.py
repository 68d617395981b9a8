"""Balanced selection of clips per speaker, and greedy suppression of overlaps.

The full form is a loop over ranked rows whose acceptance depends on what was
accepted: a reserve pass for each video, a capped fill and an uncapped overflow.
It runs once a speaker, in Python over Arrow. Of rows with one hash in one video and
the very same interval only the best can ever be taken, so the others are cut before,
by a window function; what is left of a speaker meets in one task. quota_simple is the
form without overlaps and hashes, in window functions alone.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("balanced_rank_score", "face_conf", "quality_score", "active_confidence")


def ranked(df: DataFrame) -> DataFrame:
    """df with `position` within the speaker: best first, ties by row_ord."""
    keys = [F.desc_nulls_last(F.when(~F.isnan(c), F.col(c))) for c in ORDER]
    return df.withColumn("position", F.row_number().over(Window.partitionBy("speaker_id").orderBy(*keys, "row_ord")))


def quota_simple(df: DataFrame, target: int, cap: int, least: int) -> DataFrame:
    """Rows selected by the reserve and the capped fill alone, with selection_rank.

    In each video the best `cap` rows may be taken; its best `least` come first,
    video by video, and then the rest by rank until the target."""
    place = F.row_number().over(Window.partitionBy("speaker_id", "video_id").orderBy("position"))
    best = F.min("position").over(Window.partitionBy("speaker_id", "video_id"))
    capped = df.withColumn("in_video", place).withColumn("video_best", best).where(F.col("in_video") <= cap)
    reserve = F.col("in_video") <= least
    order = Window.partitionBy("speaker_id").orderBy(F.when(reserve, 0).otherwise(1), F.when(reserve, F.col("video_best")), "position")
    return capped.withColumn("selection_rank", F.row_number().over(order) - 1).where(F.col("selection_rank") < target).drop("video_best", "in_video")


class Picker:
    """One speaker's selection so far."""

    def __init__(self, rows: pd.DataFrame, target: int, cap: int, most_iou: float):
        self.rows = list(rows[["video_id", "digest", "start", "end"]].itertuples(index=False, name=None))
        self.target, self.cap, self.most_iou = target, cap, most_iou
        self.taken: list[int] = []
        self.chosen, self.hashes = set(), set()
        self.count: dict[str, int] = {}
        self.spans: dict[str, list[tuple[float, float]]] = {}

    @property
    def full(self) -> bool:
        return len(self.taken) >= self.target

    def meets(self, video: str, start: float, end: float) -> bool:
        if not end > start:
            return False
        for a, b in self.spans.get(video, ()):
            hull = max(end, b) - min(start, a)
            if hull > 0 and max(0.0, min(end, b) - max(start, a)) / hull > self.most_iou:
                return True
        return False

    def offer(self, i: int, capped: bool) -> None:
        video, digest, start, end = self.rows[i]
        if self.full or i in self.chosen or digest in self.hashes or capped and self.count.get(video, 0) >= self.cap or self.meets(video, start, end):
            return
        self.chosen.add(i)
        self.hashes.add(digest)
        self.taken.append(i)
        self.count[video] = self.count.get(video, 0) + 1
        self.spans.setdefault(video, []).append((start, end))


def pick(rows: pd.DataFrame, processed: list[str], target: int, cap: int, least: int, most_iou: float, overflow: bool) -> list[int]:
    """Row numbers in the order they are selected; rows are ranked."""
    videos = list(dict.fromkeys([*processed, *rows["video_id"]]))
    if least * len(videos) > target:
        raise ValueError(f"{least} clips of each of {len(videos)} videos exceed the quota of {target}")
    p = Picker(rows, target, cap, most_iou)
    for video in videos if least else ():
        for i in (i for i, r in enumerate(p.rows) if r[0] == video):
            if p.count.get(video, 0) >= least:
                break
            p.offer(i, True)
    for capped in (True, False) if overflow else (True,):
        for i in range(len(p.rows)):
            if p.full:
                break
            p.offer(i, capped)
    return p.taken


def reachable(df: DataFrame) -> DataFrame:
    """Without rows that a better one of the same speaker, video, hash and interval
    makes impossible: the hash bars them whenever that one is taken, and whatever bars
    that one (quota, cap, hash or overlap) bars them too."""
    same = Window.partitionBy("speaker_id", "video_id", "digest", "start", "end").orderBy("position")
    return df.withColumn("__n", F.row_number().over(same)).where("__n = 1").drop("__n")


def select_balanced(
    df: DataFrame,
    processed: DataFrame | None = None,
    target: int = 50,
    cap: int = 20,
    least: int = 5,
    most_iou: float = 0.05,
    overflow: bool = True,
) -> DataFrame:
    """speaker_id, row_ord and selection_rank of the selected rows. df is eligible
    rows with position, digest, start and end; processed lists (speaker_id, video_id)
    whose reserve is kept first."""
    ready = df.select(
        "speaker_id",
        "position",
        "row_ord",
        F.coalesce("video_id", F.lit("")).alias("video_id"),
        "digest",
        F.coalesce("start", F.lit(-1.0)).alias("start"),
        F.coalesce("end", F.lit(-1.0)).alias("end"),
    )
    ready = reachable(ready)
    schema = "speaker_id string, row_ord long, selection_rank int"

    def choose(pdf: pd.DataFrame, videos: list[str]) -> pd.DataFrame:
        rows = pdf.sort_values("position").reset_index(drop=True)
        order = pick(rows, videos, target, cap, least, most_iou, overflow)
        return pd.DataFrame({"speaker_id": rows["speaker_id"].iloc[order], "row_ord": rows["row_ord"].iloc[order], "selection_rank": range(len(order))})

    if processed is None:
        return ready.groupBy("speaker_id").applyInPandas(lambda pdf: choose(pdf, []), schema)
    told = processed.where("video_id is not null").select("speaker_id", "video_id").distinct()

    def with_videos(pdf: pd.DataFrame, videos: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame({"speaker_id": [], "row_ord": [], "selection_rank": []})
        return choose(pdf, sorted(videos["video_id"]))

    return ready.groupBy("speaker_id").cogroup(told.groupBy("speaker_id")).applyInPandas(with_videos, schema)


def with_approval(df: DataFrame, selected: DataFrame) -> DataFrame:
    """df with approved, selection_rank (-1: not selected) and approved_index, the
    0-based place within (speaker, video)."""
    out = df.join(selected, ["speaker_id", "row_ord"], "left").withColumn("approved", F.col("selection_rank").isNotNull().cast("int"))
    place = F.row_number().over(Window.partitionBy("speaker_id", "video_id", "approved").orderBy("selection_rank")) - 1
    index = F.when(F.col("approved") == 1, place).otherwise(-1)
    return out.withColumn("approved_index", index).withColumn("selection_rank", F.coalesce("selection_rank", F.lit(-1)))


def suppress(df: DataFrame, by: list[str], most_iou: float, most: int) -> DataFrame:
    """Of each group the best rows by score whose temporal IoU with every better one
    kept is at most `most_iou`, `most` at most: a fold over the sorted rows."""
    item = F.struct((-F.col("score")).alias("o"), "row_ord", "start", "end")
    hull = lambda a, b: F.greatest(a["end"], b["end"]) - F.least(a["start"], b["start"])
    meets = lambda a, b: F.greatest(F.lit(0.0), F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"])) > most_iou * hull(a, b)
    items = df.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("items"))
    fold = F.aggregate("items", F.slice("items", 1, 0), lambda kept, x: F.when((F.size(kept) >= most) | F.exists(kept, lambda k: meets(k, x)), kept).otherwise(F.concat(kept, F.array(x))))
    return items.select(*by, F.posexplode(fold).alias("place", "x")).select(*by, "place", "x.row_ord", "x.start", "x.end")


def early_stop(df: DataFrame, candidates: int, regions: int) -> DataFrame:
    """Rows (video_id, visit, n_candidates a window) up to the window at which the
    candidates so far and the windows visited both suffice."""
    order = Window.partitionBy("video_id").orderBy("visit").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_candidates").over(order), F.lit(0))
    return df.withColumn("so_far", before).where((F.col("so_far") < candidates) | (F.col("visit") < regions))


def window_budget(remaining: Column, windows: Column) -> Column:
    """Candidates that the next window may give: an even share of those still wanted,
    at least one while any is."""
    share = F.ceil(remaining / F.greatest(F.lit(1), windows)).cast("int")
    return F.when(remaining > 0, F.greatest(F.lit(1), share)).otherwise(F.lit(0))


def budgeted(df: DataFrame, candidates: int, regions: int) -> DataFrame:
    """Rows (video_id, visit, n_candidates a window, and `existing` of the video, if
    there) with `visited`, `budget` and `taken`: windows are visited in order until the
    candidates so far suffice and enough regions were seen, and each gives its budget at
    most (one even if that is 0, as the count is held against it after each). A fold over
    the windows of a video, which number as many as its length allows."""
    has = "existing" in df.columns
    own = df.groupBy("video_id").agg(
        F.array_sort(F.collect_list(F.struct("visit", F.col("n_candidates").cast("int").alias("n")))).alias("windows"),
        (F.max("existing") if has else F.lit(0)).cast("int").alias("already"),
    )
    empty = F.lit(None).cast("array<struct<visit:int,visited:boolean,budget:int,taken:int>>")
    zero = F.struct(F.col("already").alias("total"), F.lit(0).alias("seen"), F.coalesce(empty, F.array().cast("array<struct<visit:int,visited:boolean,budget:int,taken:int>>")).alias("rows"))
    needed = F.least(F.lit(max(1, regions)), F.size("windows"))

    def step(state: Column, w: Column) -> Column:
        stop = (state["total"] >= candidates) & (state["seen"] >= needed)
        budget = window_budget(F.greatest(F.lit(0), candidates - state["total"]), needed - state["seen"])
        taken = F.when(stop, 0).otherwise(F.least(w["n"], F.greatest(F.lit(1), budget)))
        row = F.struct(
            w["visit"].cast("int").alias("visit"),
            (~stop).alias("visited"),
            F.when(stop, 0).otherwise(budget).cast("int").alias("budget"),
            taken.cast("int").alias("taken"),
        )
        seen = state["seen"] + F.when(stop, 0).otherwise(1)
        return F.struct((state["total"] + taken).cast("int").alias("total"), seen.cast("int").alias("seen"), F.concat(state["rows"], F.array(row)).alias("rows"))

    return own.select("video_id", F.explode(F.aggregate("windows", zero, step)["rows"]).alias("x")).select("video_id", "x.*")
