"""Tables kept between runs: unions, keep-first and keep-last, scoped replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in this order; rank-limited before the shuffle."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__at", at).where("__at = 1").drop("__at")


def scoped_replace(old: DataFrame, new: DataFrame, owned: DataFrame, keys: list[str], scope: str = "speaker_id") -> DataFrame:
    """old without the owned scopes, and new, the last row of each key. New rows
    win; among old ones the larger `row_ord` does."""
    rest = old.join(owned.select(scope).distinct(), scope, "left_anti")
    both = rest.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return keep_one(both, keys, [F.desc("__new"), F.desc("row_ord")]).drop("__new")


def keep_first_digest(candidates: DataFrame, *before: Column) -> DataFrame:
    """One candidate of each (speaker, video, hash or path): the first by the order given,
    then by row_ord."""
    digest = F.coalesce(F.when(F.trim("sha1") != "", F.col("sha1")), F.col("candidate_path"))
    keys = ["speaker_id", "video_id", "__digest"]
    return keep_one(candidates.withColumn("__digest", digest), keys, [*before, F.asc("row_ord")]).drop("__digest")


#: The column that names a table's part, and how many parts a table has.
PART, PARTS = "__part", 64


def read_scoped(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def write_scoped(spark: SparkSession, path: str, new: DataFrame, owned: DataFrame, keys: list[str], scope: str = "speaker_id") -> None:
    """Replaces the owned scopes of a Parquet table. The table is partitioned by a hash of
    the scope; only parts that hold an owned or new scope are written again: first beside
    the table, whole, then over the old parts. A reader in between may miss scopes of
    those parts, never those of others; a run that broke off is simply repeated."""
    jvm = spark._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part = F.pmod(F.xxhash64(F.col(scope).cast("string")), F.lit(PARTS)).cast("int")
    scopes = owned.select(scope).unionByName(new.select(scope))
    touched = [r[0] for r in scopes.select(part).distinct().collect()]  # at most PARTS
    if not touched:
        return
    exists = fs.exists(at(path))
    old = spark.read.parquet(path).where(F.col(PART).isin(touched)).drop(PART) if exists else new.limit(0)
    result = scoped_replace(old, new, owned, keys, scope).withColumn(PART, part)
    beside = f"{path}.new"
    result.write.mode("overwrite").partitionBy(PART).parquet(beside)
    left = {int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(at(beside)) if s.isDirectory()}
    if left:
        whole = spark.read.schema(result.schema).parquet(beside)
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    elif not exists:
        fs.rename(at(beside), at(path))
    for empty in set(touched) - left:
        fs.delete(at(f"{path}/{PART}={empty}"), True)
    fs.delete(at(beside), True)
