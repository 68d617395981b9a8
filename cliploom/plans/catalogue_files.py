"""More of the catalogue: files and models. Each query writes what an operator writes to a
new folder of the shared one and gives what reading it again finds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..operators import candidates, store
from ..sources import media, models, tables
from .bindings import bound
from .registry import query, read, scratch


def _local(path: str) -> str:
    return path.removeprefix("file://")


# --- tables and lines -----------------------------------------------------------------


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'a "quoted", ' || chr(10) || 'line' END AS note FROM customer""")
def csv_strings(spark, sf):
    path = scratch(spark, "csv")
    note = F.when(F.col("c_custkey") % 3 != 0, 'a "quoted", \nline')
    rows = read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", note.alias("note"))
    rows.write.option("header", True).option("escape", '"').csv(path)
    return tables.csv_strings(spark, path)


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS speaker_id, CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE s_nationkey END AS priority, CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE round(s_acctbal, 2) END AS weight, CAST(NULL AS VARCHAR) AS notes FROM supplier""")
def csv_typed(spark, sf):
    path = scratch(spark, "typed")
    k = F.col("s_suppkey")
    rows = read(spark, sf, "supplier").select(
        k.alias("speaker_id"),
        F.when(k % 4 == 0, "many").otherwise(F.col("s_nationkey").cast("string")).alias("priority"),
        F.when(k % 4 == 1, "").otherwise(F.round("s_acctbal", 2).cast("string")).alias("weight"),
    )
    tables.write_csv(rows, path)
    return tables.csv_table(spark, path, "speaker_id string, priority int, weight double, notes string", {"priority": 1})


@query("SELECT 'name ' || n_name AS name FROM nation WHERE n_nationkey % 3 > 0")
def text_lines(spark, sf):
    path = scratch(spark, "lines")
    k = F.col("n_nationkey") % 3
    text = F.when(k == 0, F.when(F.col("n_nationkey") % 2 == 0, "   ").otherwise("# a comment")).otherwise(F.concat(F.lit("  name "), "n_name", F.lit(" ")))
    read(spark, sf, "nation").select(text.alias("value")).write.text(path)
    return tables.lines(spark, path)


@query("SELECT CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS VARCHAR) || ' c' || o_custkey || ' o' || o_orderkey AS value FROM orders")
def trials_text(spark, sf):
    path = scratch(spark, "trials")
    rows = read(spark, sf, "orders").select((F.col("o_orderkey") % 2 == 0).cast("int").alias("label"), F.concat(F.lit("c"), "o_custkey").alias("a"), F.concat(F.lit("o"), "o_orderkey").alias("b"))
    tables.write_lines(rows, path, "label", "a", "b")
    return spark.read.text(path)


@query("SELECT 'some' AS list, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS found FROM nation UNION ALL SELECT 'none', 0, 0")
def missing_lists(spark, sf):
    """A list, and one that was there and is removed as nothing is missing any more."""
    path = scratch(spark, "missing")
    names = read(spark, sf, "nation").select("n_name")
    n = tables.write_list(names, path, "n_name")
    found = spark.read.text(path).count()
    none = tables.write_list(names.limit(0), path, "n_name")
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    left = int(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path)))
    return spark.createDataFrame([("some", n, found), ("none", none, left)], "list string, n long, found long")


@query("""WITH old AS (SELECT o_custkey, o_orderkey, o_totalprice, 0 AS fresh FROM orders WHERE o_orderstatus <> 'P'), new AS (SELECT o_custkey, o_orderkey, o_totalprice, 1 AS fresh FROM orders WHERE o_orderstatus = 'P' AND o_custkey % 2 = 0),
    u AS (SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 6 = 0) AND o_custkey NOT IN (SELECT o_custkey FROM new) UNION ALL SELECT * FROM new)
    SELECT CAST(o_custkey AS VARCHAR) AS speaker_id, o_orderkey AS row_ord, o_totalprice AS v FROM u""")
def scoped_store(spark, sf):
    """A stored table whose owned scopes are replaced, some of them by nothing."""
    path = scratch(spark, "store")
    rows = read(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("speaker_id"), F.col("o_orderkey").alias("row_ord"), F.col("o_totalprice").alias("v"), "o_orderstatus", "o_custkey")
    old, new = rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus = 'P' and o_custkey % 2 = 0")
    keep = ("speaker_id", "row_ord", "v")
    store.write_scoped(spark, path, old.select(*keep), old.select("speaker_id"), ["speaker_id", "row_ord"])
    owned = rows.where("o_custkey % 6 = 0").select("speaker_id").union(new.select("speaker_id"))
    store.write_scoped(spark, path, new.select(*keep), owned, ["speaker_id", "row_ord"])
    return store.read_scoped(spark, path)


# --- configuration --------------------------------------------------------------------


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS speaker_id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'unknown' ELSE 'f' END AS gender, CASE s_suppkey % 3 WHEN 0 THEN 1985 END AS birth_year, 'v' || s_suppkey AS youtube_id, s_suppkey % 5 <> 0 AS use, CAST(greatest(1, s_nationkey) AS INTEGER) AS priority,
    'f/there/' || s_suppkey || '.jpg' AS reference, 40 AS target, 'told' AS told, 'else' AS other FROM supplier WHERE s_suppkey % 7 <> 0""")
def yaml_manifest(spark, sf):
    """A configuration is written and loaded; the file's own names, defaults and
    environment variables count."""
    folder = _local(scratch(spark, "config"))
    rows = read(spark, sf, "supplier").orderBy("s_suppkey").collect()  # a configuration's speakers
    people = []
    for r in rows:
        k = r["s_suppkey"]
        video = {"youtube_id": f"v{k}" if k % 7 else "", "use": "No" if k % 5 == 0 else "yes", "priority": r["s_nationkey"]}
        people.append({"id": f" {k}", "name": r["s_name"], "gender": "" if k % 2 == 0 else "f", "birth_year": {0: 1985, 1: "1985.0"}.get(k % 3), "reference_images": [f"{k}.jpg"], "videos": [video]})
    said = {"global": {"target_clips_per_speaker": 40, "references_dir": "f/there", "face_template_threshold": 0.5, "told": "${CLIPLOOM_NOT_SET:-told}"}, "celebrities": people, "other": "${CLIPLOOM_NOT_SET:-else}"}
    config.save(f"{folder}/config.yaml", said)
    settings, found = config.load(f"{folder}/config.yaml")
    by = {s["speaker_id"]: s for s in found.speakers}
    out = []
    for v in found.videos:
        s = by[v["speaker_id"]]
        out.append((s["speaker_id"], s["name"], s["gender"], s["birth_year"], v["youtube_id"], v["use"], v["priority"], s["reference_images"][0], settings.target_per_speaker, settings.other["told"], settings.other["other"]))
    return spark.createDataFrame(out, "speaker_id string, name string, gender string, birth_year int, youtube_id string, use boolean, priority int, reference string, target int, told string, other string")


# --- audio and other files -------------------------------------------------------------


def _clips(spark, sf, folder: str) -> DataFrame:
    """Clips of 64 samples written to files: vec_id, label, path."""
    rows = read(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("samples"))
    name = F.concat(F.lit(f"{folder}/"), F.concat_ws("/", F.concat(F.lit("s"), "label"), F.concat(F.lit("v"), (F.col("vec_id") % 3).cast("string")), F.concat("vec_id", F.lit(".wav"))))
    ready = media.encoded(rows, 16000).withColumn("path", name)
    media.write_files(ready.select("path", F.col("wav").alias("content"))).where("error is null").count()
    return read(spark, sf, "embeddings").select("vec_id", "label").withColumn("path", name)


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: round_even((x * 32767::FLOAT)::DOUBLE, 0) / 32768) AS v FROM embeddings) SELECT vec_id, 16000 AS rate, 64 AS n, round(sqrt(list_avg(list_transform(v, lambda x: x * x))), 6) AS level, round(v[5], 6) AS fifth FROM e""")
def wav_round_trip(spark, sf):
    folder = _local(scratch(spark, "wav"))
    _clips(spark, sf, folder)
    audio = media.read_wavs(spark, f"file://{folder}")
    key = F.regexp_extract("path", r"(\d+)\.wav$", 1).cast("long").alias("vec_id")
    square = F.aggregate("samples", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return audio.where("error is null").select(key, "rate", F.size("samples").alias("n"), F.round(F.sqrt(square / 64), 6).alias("level"), F.round(F.col("samples")[4].cast("double"), 6).alias("fifth"))


@query("""SELECT 's' || label AS speaker_id, count(*) AS n_references, CAST(count(*) * (44 + 128) AS BIGINT) AS bytes FROM embeddings GROUP BY 1""")
def file_listings(spark, sf):
    """WAV files by their speaker's folder, and their sizes."""
    folder = _local(scratch(spark, "listed"))
    _clips(spark, sf, folder)
    listed = tables.listing(spark, f"file://{folder}", ".wav")
    by = F.element_at(F.split("path", "/"), -3)
    return listed.groupBy(by.alias("speaker_id")).agg(F.count("*").alias("n_references"), F.sum("length").alias("bytes"))


@query("SELECT 'p' || n_regionkey AS speaker_id, count(*) AS n FROM nation WHERE n_nationkey % 4 < 3 GROUP BY 1")
def reference_images(spark, sf):
    folder = _local(scratch(spark, "images"))
    kind = F.element_at(F.array(*(F.lit(x) for x in (".jpg", ".PNG", ".webp", ".txt"))), (F.col("n_nationkey") % 4 + 1).cast("int"))
    name = F.concat(F.lit(f"{folder}/p"), F.col("n_regionkey").cast("string"), F.lit("_"), F.col("n_nationkey").cast("string"), kind)
    media.write_files(read(spark, sf, "nation").select(name.alias("path"), F.col("n_name").cast("binary").alias("content"))).count()
    return tables.reference_images(spark, f"file://{folder}").groupBy("speaker_id").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT label, vec_id, 's' || label AS s, 'v' || (vec_id % 3) AS v FROM embeddings), n AS (SELECT *, row_number() OVER (PARTITION BY s, v ORDER BY vec_id) - 1 AS i FROM a WHERE vec_id % 4 <> 0)
    SELECT s || '/' || v || '/' || v || '_' || lpad(CAST(i AS VARCHAR), 5, '0') || '.wav' AS path, CAST(172 AS BIGINT) AS bytes FROM n
    UNION ALL SELECT 'other/v/kept.wav', 172""")
def export_tree(spark, sf):
    """Clips are exported, then fewer of them: files of exported speakers that the second
    export doesn't have are removed, those of others stay."""
    folder = _local(scratch(spark, "export"))
    rows = _clips(spark, sf, f"{folder}/clips").select(F.concat(F.lit("s"), "label").alias("speaker_id"), F.concat(F.lit("v"), (F.col("vec_id") % 3).cast("string")).alias("video_id"), "vec_id", F.col("path").alias("candidate_path"))
    root = f"{folder}/wav"
    one = rows.limit(1).select(F.col("candidate_path").alias("source"), F.lit(f"{root}/other/v/kept.wav").alias("target"))
    media.copy_files(one).count()
    paths = lambda: tables.listing(spark, f"file://{root}", ".wav").select(F.regexp_replace("path", "^file:/*", "/").alias("path"))
    for some in (rows, rows.where("vec_id % 4 <> 0")):
        approved = some.withColumn("approved", F.lit(1)).withColumn("selection_rank", F.col("vec_id"))
        utterances = candidates.with_utterances(approved, root=root)
        copies, stale = candidates.copy_plan(utterances, paths())
        media.copy_files(copies).count()
        media.deleted(stale).count()
    listed = tables.listing(spark, f"file://{root}", ".wav")
    return listed.select(F.substring_index("path", "/", -3).alias("path"), F.col("length").alias("bytes"))


@query("SELECT n_nationkey, true AS gone FROM nation WHERE n_nationkey % 2 = 0")
def cleanup(spark, sf):
    """Files of a window are deleted, and folders that are empty then."""
    folder = _local(scratch(spark, "temp"))
    name = F.concat(F.lit(f"{folder}/"), F.col("n_nationkey").cast("string"), F.lit("/w0000/frame_000001.jpg"))
    rows = read(spark, sf, "nation").select("n_nationkey", name.alias("path"), F.col("n_name").cast("binary").alias("content"))
    media.write_files(rows.select("path", "content")).count()
    gone = media.deleted(rows.where("n_nationkey % 2 = 0").select("path"), 2)
    return gone.select(F.regexp_extract("path", r"/(\d+)/w0000/", 1).cast("int").alias("n_nationkey"), "gone")


@query("SELECT CAST(user_id AS VARCHAR) AS path, 0.0::DOUBLE AS video_duration, 600.0::DOUBLE AS duration, 'w0000' AS tag, true AS failed FROM (SELECT DISTINCT user_id FROM events)")
def media_failures(spark, sf):
    """Videos that can't be probed last 0 seconds, which makes one window of the usual
    length; what can't be cut carries its error."""
    from ..operators import intervals

    videos = read(spark, sf, "events").select(F.col("user_id").cast("string").alias("path")).distinct()
    probed = media.durations(videos)
    windows = intervals.video_windows(probed.withColumn("video_id", F.col("path")))
    cut = media.extracted(windows.withColumn("path", F.concat(F.lit("/nowhere/"), "video_id")), _local(scratch(spark, "media")))
    told = cut.select("video_id", "duration", "tag", F.col("error").isNotNull().alias("failed"))
    return probed.join(told, F.col("path") == F.col("video_id")).select("path", "video_duration", "duration", "tag", "failed")


# --- models ---------------------------------------------------------------------------


def _digits():
    """A detector that finds a face for each digit of what it is given."""
    return lambda images: [[(0.0, 0.0, 80.0 + int(c), 90.0, [1.0, float(c)], 0.5 + int(c) / 20) for c in bytes(i).decode()] for i in images]


@query("SELECT c_custkey AS frame, i - 1 AS face_ord, CAST(80 + CAST(substr(CAST(c_custkey AS VARCHAR), i, 1) AS INTEGER) AS DOUBLE) AS x2, round(0.5::DOUBLE + CAST(substr(CAST(c_custkey AS VARCHAR), i, 1) AS INTEGER) / 20, 6) AS det_score FROM (SELECT c_custkey, unnest(range(1, len(CAST(c_custkey AS VARCHAR)) + 1)) AS i FROM customer)")
def detector_boundary(spark, sf):
    frames = read(spark, sf, "customer").select(F.lit("w").alias("window_id"), F.col("c_custkey").cast("int").alias("frame"), F.col("c_custkey").cast("string").cast("binary").alias("jpeg"))
    found = models.detect(frames, _digits)
    return found.select(F.col("frame").cast("long").alias("frame"), F.col("face_ord").cast("long").alias("face_ord"), F.col("bbox.x2").cast("double").alias("x2"), F.round("det_score", 6).alias("det_score"))


def _ramps():
    """A scorer that gives a frame for each sample, its distance growing by shift."""
    return lambda clips: [np.asarray(c, np.float64)[:, None] + np.arange(21) for c in clips]


@query("SELECT CAST(vec_id AS VARCHAR) AS probe_id, CAST(i - 1 AS INTEGER) AS frame, 21 AS shifts, round((embedding[i]::DOUBLE + 20)::FLOAT::DOUBLE, 5) AS last FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)")
def sync_boundary(spark, sf):
    probes = read(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("probe_id"), F.col("embedding").cast("array<double>").alias("clip"))
    found = models.sync_distances(probes, _ramps)
    return found.select("probe_id", "frame", F.size("dist").alias("shifts"), F.round(F.col("dist")[20].cast("double"), 5).alias("last"))


def _signs():
    return lambda series: [[v > 0 for v in x] for x in series]


@query("SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS n FROM embeddings")
def voice_boundary(spark, sf):
    audio = read(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("samples"))
    found = models.voice_mask(audio, _signs)
    return found.select("vec_id", F.size(F.filter("mask", lambda m: m)).cast("long").alias("n"))


_SPLIT = "SELECT CAST(o_custkey AS STRING) AS speaker_id, o_orderpriority AS priority, o_totalprice AS v FROM {orders}"


@query("WITH+ SELECT speaker_id, count(*) AS n FROM o GROUP BY 1", o=_SPLIT)
def speaker_folders(spark, sf):
    """A table written by speaker, a folder each."""
    path = scratch(spark, "speakers")
    few = bound(spark, sf, _SPLIT)
    tables.write_by_speaker(few, path)
    return tables.read_by_speaker(spark, path, few.schema).groupBy("speaker_id").agg(F.count("*").alias("n"))
