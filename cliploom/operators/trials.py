"""Verification trials: pairs of one speaker, sampled pairs of two.

Sampling is by hash order, md5 of the seed and the pair, so that a result doesn't
depend on partitioning. Pairs of one speaker are bounded by the quota; pairs of
two speakers are drawn by number (the i-th draw hashes to a speaker of a gender, a
second one, and a clip of each), so no product of clips is ever formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def target_pairs(clips: DataFrame, mode: str) -> DataFrame:
    """Unordered pairs of one speaker, path1 < path2: of one video (A) or two (B). All
    pairs are what is asked for, so they are as many as a speaker's clips squared; paths
    are told once each before, so that no pair comes twice."""
    own = clips.groupBy("speaker_id", "path").agg(F.min("video_id").alias("video_id"))
    left = own.select("speaker_id", F.col("video_id").alias("v1"), F.col("path").alias("path1"))
    right = own.select("speaker_id", F.col("video_id").alias("v2"), F.col("path").alias("path2"))
    met = left.join(right, "speaker_id").where(F.col("path1") < F.col("path2"))
    return met.where(F.col("v1") == F.col("v2") if mode == "A" else F.col("v1") != F.col("v2")).select("speaker_id", "path1", "path2")


def hashed(*columns: Column | str) -> Column:
    return F.md5(F.concat_ws("|", *(F.col(c) if isinstance(c, str) else c for c in columns)))


def sampled(pairs: DataFrame, seed: str, n: int) -> DataFrame:
    """The n pairs that hash lowest; a top-n, not a sort."""
    return pairs.orderBy(hashed(F.lit(seed), "path1", "path2"), "path1", "path2").limit(n)


def _draw(key: Column, of: Column) -> Column:
    """0 .. of - 1 from the first 8 hex digits of a hash."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), of)


def non_target_draws(clips: DataFrame, seed: str, draws: int) -> DataFrame:
    """draw, gender, path1, path2 of `draws` draws: a speaker uniformly, another of
    the same gender, then a clip of each uniformly. Draws of one video are void."""
    speakers = clips.select("speaker_id", "gender").distinct()
    order = Window.partitionBy("gender").orderBy("speaker_id")
    numbered = speakers.withColumn("k", F.row_number().over(order) - 1)
    sizes = numbered.groupBy("gender").agg(F.count("*").alias("n")).where("n > 1")
    overall = Window.orderBy("gender")
    ranges = sizes.withColumn("upto", F.sum("n").over(overall)).withColumn("total", F.sum("n").over(Window.partitionBy()))
    ids = clips.sparkSession.range(draws).select(F.col("id").alias("draw"))
    hashed_at = lambda tag: F.concat_ws("|", F.lit(seed), F.lit(tag), F.col("draw").cast("string"))
    some = ids.crossJoin(F.broadcast(ranges)).withColumn("u", _draw(hashed_at("a"), F.col("total"))).where("u < upto and u >= upto - n")
    first = some.withColumn("k1", F.col("u") - (F.col("upto") - F.col("n")))
    second = F.pmod(F.col("k1") + 1 + _draw(hashed_at("b"), F.col("n") - 1), F.col("n"))
    pairs = first.withColumn("k2", second).select("draw", "gender", "k1", "k2")
    one = lambda i: numbered.select("gender", F.col("k").alias(f"k{i}"), F.col("speaker_id").alias(f"s{i}"))
    pairs = pairs.join(one(1), ["gender", "k1"]).join(one(2), ["gender", "k2"])
    place = F.row_number().over(Window.partitionBy("speaker_id").orderBy("path")) - 1
    listed = clips.withColumn("c", place)
    counts = clips.groupBy("speaker_id").agg(F.count("*").alias("m"))
    for i in (1, 2):
        pairs = pairs.join(counts.select(F.col("speaker_id").alias(f"s{i}"), F.col("m").alias(f"m{i}")), f"s{i}")
        pairs = pairs.withColumn(f"c{i}", _draw(hashed_at(f"c{i}"), F.col(f"m{i}")))
        pairs = pairs.join(listed.select(F.col("speaker_id").alias(f"s{i}"), F.col("c").alias(f"c{i}"), F.col("path").alias(f"p{i}"), F.col("video_id").alias(f"v{i}")), [f"s{i}", f"c{i}"])
    return pairs.where("v1 <> v2").select("draw", "gender", F.least("p1", "p2").alias("path1"), F.greatest("p1", "p2").alias("path2"))


def non_targets(clips: DataFrame, seed: str, n: int, factor: float = 1.5) -> DataFrame:
    """n distinct drawn pairs, by draw order."""
    drawn = non_target_draws(clips, seed, int(n * factor) + 100).groupBy("path1", "path2").agg(F.min("draw").alias("draw"), F.first("gender").alias("gender"))
    return drawn.orderBy("draw").limit(n)


def hash_non_targets(speakers: DataFrame, seed: str, n: int) -> DataFrame:
    """For one clip a speaker (speaker_id, gender, video_id, path): neighbours in the
    hash order of a gender, paired once each; the n lowest hashes."""
    order = Window.partitionBy("gender").orderBy(hashed(F.lit(seed), "path"), "path")
    after = speakers.withColumn("next", F.lead(F.struct("path", "video_id")).over(order)).where("next is not null and next.video_id <> video_id")
    return sampled(after.select("gender", F.least("path", "next.path").alias("path1"), F.greatest("path", "next.path").alias("path2")), seed, n)


def unique_trials(trials: DataFrame) -> DataFrame:
    """One row of each (label, unordered pair), as (smaller, larger); no self-pairs."""
    out = trials.select("label", F.least("path1", "path2").alias("path1"), F.greatest("path1", "path2").alias("path2"))
    return out.where("path1 <> path2").distinct()


def gender_subset(trials: DataFrame, clips: DataFrame) -> DataFrame:
    """Trials whose two clips have one gender, with it."""
    of = clips.select("path", "gender").distinct()
    a, b = of.withColumnsRenamed({"path": "path1", "gender": "g1"}), of.withColumnsRenamed({"path": "path2", "gender": "g2"})
    return trials.join(a, "path1").join(b, "path2").where("g1 = g2").select("label", "path1", "path2", F.col("g1").alias("gender"))


def in_pipeline(clips: DataFrame, mode: str, seed: str = "1234", most: int = 200_000) -> DataFrame:
    """All target pairs and, per label, at most half of `most`: four times as many
    other pairs, between 1,000 and 20,000."""
    targets = target_pairs(clips, mode).select(F.lit(1).alias("label"), "path1", "path2")
    n = targets.count()
    goal = min(max(4 * n, 1000 if n else 0), 20_000)
    drawn = non_targets(clips.withColumn("gender", F.lit("any")), seed, goal)
    others = drawn.select(F.lit(0).alias("label"), "path1", "path2")
    return unique_trials(sampled(targets, seed, max(1, most - goal)).union(others))


#: The splits that have trials, the names of their files, and the genders
#: of which the last one has files of its own.
SPLITS, GENDERED, GENDERS = {"validation": "val", "test": "test"}, "test", ("female", "male")
#: Rows of a table of speakers that is broadcast at most.
SMALL = 1 << 20


def of_splits(metadata: DataFrame, splits: DataFrame) -> DataFrame:
    """metadata with gender and split of its speaker, those without one left out."""
    own = splits.select("speaker_id", "gender", "split")
    own = F.broadcast(own) if own.count() <= SMALL else own
    return metadata.drop("gender", "split").join(own, "speaker_id")


def train_rows(rows: DataFrame) -> DataFrame:
    """speaker_id and path of the training split, in this order."""
    return rows.where("split = 'train'").select("speaker_id", "path").orderBy("speaker_id", "path")


def protocol(metadata: DataFrame, splits: DataFrame, seed: int = 2026, targets: int = 5000, others: int = 50_000) -> dict[tuple[str, str], DataFrame]:
    """(split, mode): trials label, path1, path2 for validation and test; raises
    where a split has too few target pairs."""
    rows = of_splits(metadata, splits)
    out = {}
    for split in SPLITS:
        for mode in ("A", "B"):
            clips, name = rows.where(F.col("split") == split), f"{seed}-{split}-{mode}"
            found = target_pairs(clips, mode)
            if (n := found.count()) < targets:
                raise ValueError(f"{split} {mode}: {n} target pairs, {targets} asked for")
            drawn = non_targets(clips, name, others).select(F.lit(0).alias("label"), "path1", "path2")
            both = sampled(found, name, targets).select(F.lit(1).alias("label"), "path1", "path2").union(drawn)
            out[split, mode] = both.orderBy(hashed(F.lit(name), "path1", "path2"))
    return out
