"""Connected components of a graph held as a table, in a few rounds.

Large and small stars alternate until nothing changes: every node's larger
neighbours are tied to its smallest, then its smaller ones are. Minima are partial
aggregates, never windows, and are written before they are joined: both sides of
the join are then plain shuffles, which Spark splits where a node has a third of
all edges. Each round is written to the shared folder; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written


def _tied(edges: DataFrame, directed: bool) -> tuple[DataFrame, DataFrame]:
    """Small star of edges u > v, or large star of edges both ways; and the minima,
    which the star reads until it is written."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    both = edges.join(least, "u")
    if directed:
        own = least.select("u", F.col("m").alias("v"))
        out = both.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)
    else:
        out = both.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct(), least


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """u, v: every node that has an edge and is not the smallest of its component,
    with that smallest node. `edges`: two long columns u and v."""
    held = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    said = None
    for _ in range(most_rounds):
        large, minima = _tied(held.union(held.select(F.col("v").alias("u"), F.col("u").alias("v"))), False)
        star, others = _tied(large, True)
        before, held = held, written(star, "star")
        release(before, minima, others)
        now = tuple(held.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == said:
            return held
        said = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
