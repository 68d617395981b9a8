"""Verification metrics from scores and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def roc(df: DataFrame, by: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """A point for each distinct score, from the highest: fpr and fnr if everything
    at or above it is accepted. Distinct scores are counted before the window."""
    at = df.groupBy(*by, F.col(score).alias("threshold")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    order, whole = Window.partitionBy(*by).orderBy(F.desc("threshold")), Window.partitionBy(*by)
    sums = at.select(*by, "threshold", F.sum("p").over(order).alias("tp"), F.sum("n").over(order).alias("fp"), F.sum("p").over(whole).alias("np"), F.sum("n").over(whole).alias("nn"))
    fine = sums.where("np > 0 and nn > 0")
    return fine.select(*by, "threshold", (F.col("fp") / F.col("nn")).alias("fpr"), (1 - F.col("tp") / F.col("np")).alias("fnr"))


def eer(df: DataFrame, by: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """Where fnr, linear between points, meets fpr; no row without both labels."""
    order = Window.partitionBy(*by).orderBy(F.desc("threshold"))
    points = roc(df, by, score, label)
    pairs = points.select(*by, F.lag("fpr", 1, 0.0).over(order).alias("x0"), F.lag("fnr", 1, 1.0).over(order).alias("y0"), F.col("fpr").alias("x1"), F.col("fnr").alias("y1"))
    d0, d1 = F.col("y0") - F.col("x0"), F.col("y1") - F.col("x1")
    crossing = pairs.where((d0 >= 0) & (d1 <= 0))
    share = F.when(d0 == d1, 0.0).otherwise(d0 / (d0 - d1))
    return crossing.groupBy(*by).agg(F.min(F.col("x0") + share * (F.col("x1") - F.col("x0"))).alias("eer"))


def min_dcf(df: DataFrame, by: list[str], target: float = 0.01, miss: float = 1.0, alarm: float = 1.0, score: str = "score", label: str = "label") -> DataFrame:
    """The least cost over thresholds, over that of always or never accepting.
    The costs are this engine's choice."""
    cost = F.least(F.lit(miss * target), miss * target * F.col("fnr") + alarm * (1 - target) * F.col("fpr"))
    return roc(df, by, score, label).groupBy(*by).agg((F.min(cost) / min(miss * target, alarm * (1 - target))).alias("min_dcf"))


def grouping(df: DataFrame, sets: list[list[str]], values: dict[str, str]) -> DataFrame:
    """Means of the values for each grouping set; null marks 'all'."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *(F.col(k) for k in keys)).agg(F.count("*").alias("n"), *(F.avg(v).alias(k) for k, v in values.items()))
