"""What only shows on larger or odder tables."""

import os
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cliploom.operators import manifest, vectors
from cliploom.plans import catalogue
from cliploom.sources import tables


def test_competitors_pair_spans_not_segments(spark):
    """40 segments of one span and 40 tracks: products of both are never rows."""
    tracks = spark.range(40).select(F.format_string("t%02d", "id").alias("track_id"), F.lit("v").alias("video_id"))
    points = tracks.join(spark.range(10).select(F.col("id").cast("int").alias("frame"))).where("frame < 4 or track_id < 't03'").select("track_id", "frame")
    segments = tracks.select(F.concat(F.lit("s"), "track_id").alias("segment_id"), "video_id", "track_id", F.lit(0.0).alias("start"), F.lit(1.0).alias("end"))
    found = vectors.competitors(segments, tracks, points, 5.0, 0.5, 2)
    got = {(r["segment_id"], r["place"]): (r["track_id"], r["coverage"]) for r in found.collect()}
    for i in range(40):
        rivals = [t for t in ("t00", "t01", "t02") if t != f"t{i:02d}"][:2]
        assert [got[f"st{i:02d}", k + 1] for k in range(2)] == [(t, 1.0) for t in rivals]
    nodes, met = [found._jdf.queryExecution().optimizedPlan()], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join" and "bucket" in node.condition().toString():
            met.append(node.output().mkString(","))
    assert met and not any("segment_id" in columns for columns in met)


def test_preflight_counts_a_repeated_video_once(spark):
    videos = spark.createDataFrame([("a", "v1", True)] * 6 + [("b", "v1", False), ("b", "v1", True), ("b", "v2", False)], "speaker_id string, youtube_id string, local boolean")
    speakers = spark.createDataFrame([("a", 2), ("b", 2)], "speaker_id string, n_references int")
    told = lambda v: {(r["speaker_id"], r["problem"]) for r in manifest.preflight(speakers.select("speaker_id"), v, speakers, 50, 10, 9, 2, 2).collect()}
    few, caps = "too few videos", "caps can't reach the target"
    assert told(videos) == {("a", few), ("b", few), ("a", caps), ("b", caps)}
    assert told(videos.drop("local")) == {("a", few), ("a", caps), ("b", caps)}


def test_many_speaker_folders(spark, tmp_path):
    """None, which starts the workers, then 3,000 speakers and null, in a time that 18 ms
    a folder don't keep."""
    who = F.when(F.col("id") > 5, F.col("id") % 3000 - 1500)
    orders = spark.range(9000).select(who.alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), F.col("id").cast("double").alias("o_totalprice"))
    orders.limit(0).write.parquet(f"{tmp_path}/none/orders.parquet")
    assert catalogue.QUERIES["speaker_folders"](spark, f"{tmp_path}/none").count() == 0
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    want = {(r[0], r[1]) for r in orders.groupBy(F.col("o_custkey").cast("string")).count().collect()}
    start = time.monotonic()
    got = [tuple(r) for r in catalogue.QUERIES["speaker_folders"](spark, str(tmp_path)).collect()]
    took = time.monotonic() - start
    assert len(got) == len(want) == 3001 and set(got) == want
    assert took < 30, took


def test_speaker_folders_keep_names_and_rows(spark, tmp_path):
    """Names come back as they were, from folders that Spark's own reader finds too; a
    second write replaces the first, one that fails leaves it."""
    names = [None, "", "7", "007", "1.0", "2020-01-01", "a/b=c%2F", ".", "é x", "_", tables.NO_NAME, "%5F"]
    rows = [(n, i, [float(i)] * k, {"x": k}) for i, n in enumerate(names) for k in range(1, 4)]
    df = spark.createDataFrame(rows, "speaker_id string, i int, v array<double>, m map<string,int>").withColumn("at", F.timestamp_seconds("i"))
    path = f"file://{tmp_path}/by speaker"
    tables.write_by_speaker(df.union(df), path)
    tables.write_by_speaker(df, path)
    back = tables.read_by_speaker(spark, path, df.schema)
    said = lambda d: sorted(map(repr, d.collect()))
    assert back.schema.names == df.schema.names and said(back) == said(df)
    assert len(os.listdir(f"{tmp_path}/by speaker")) == len(names) - 1  # null and the empty name share one
    plain = spark.read.schema("i int, v array<double>, speaker_id string").parquet(path)
    assert said(plain.where("speaker_id is not null").select("speaker_id", "i", "v")) == said(df.where("speaker_id <> ''").select("speaker_id", "i", "v"))
    assert plain.where("speaker_id is null").count() == 6
    try:
        tables.write_by_speaker(df.withColumn("i", F.raise_error(F.lit("broken")).cast("int")), path)
        raise AssertionError("written")
    except Exception as e:
        assert "broken" in str(e)
    assert said(back) == said(df) and os.listdir(tmp_path) == ["by speaker"]


def test_a_speaker_of_many_batches(spark, tmp_path):
    """One speaker over many batches and row groups, between others."""
    df = spark.range(60000).select(F.when(F.col("id") % 10 > 0, "b").when(F.col("id") % 20 == 0, "a").otherwise("c").alias("speaker_id"), "id", F.repeat(F.md5(F.col("id").cast("string")), 12).alias("text"))
    tables.write_by_speaker(df, str(tmp_path / "t"))
    back = tables.read_by_speaker(spark, str(tmp_path / "t"), df.schema)
    total = lambda d: {tuple(r) for r in d.groupBy("speaker_id").agg(F.count("*"), F.sum(F.xxhash64("id", "text").cast("decimal(38,0)"))).collect()}
    assert total(back) == total(df)
    assert pq.ParquetFile(tmp_path / "t/speaker_id=b/rows.parquet").num_row_groups > 1
