"""The catalogue of queries, each bound to test tables, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import arrays
from ..functions.columns import bbox_iou, box_of, canonical_path, crop_box, number, spaced
from ..operators import candidates, gates, intervals, manifest, metrics, proposals, rejections, review, selection, stats, store, sync, trials, vectors
from .bindings import CANDIDATES, CLIPS, SEGMENTS, bound
from .registry import ORACLE_SQL, QUERIES, S, query, read, rounded

__all__ = ["ORACLE_SQL", "QUERIES"]

# --- manifest -----------------------------------------------------------------


@query("""
    WITH n AS (SELECT l_suppkey, count(DISTINCT l_returnflag || l_linestatus) AS n_videos FROM lineitem GROUP BY 1)
    SELECT CAST(s_suppkey AS VARCHAR) AS speaker_id, s_name AS name, n_videos, youtube_id
    FROM supplier JOIN n ON s_suppkey = n.l_suppkey
    JOIN (SELECT DISTINCT l_suppkey, l_returnflag || l_linestatus AS youtube_id FROM lineitem) v ON s_suppkey = v.l_suppkey
    WHERE n_videos >= 2 AND s_nationkey % 5 <> 0""")
def manifest_min_videos(spark, sf):
    usable = read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("speaker_id"), F.col("s_name").alias("name"), F.lit("a.jpg; b.jpg").alias("reference_images"), F.lit("").alias("gender"), F.lit("").alias("category"), F.lit("").alias("region"), F.lit("").alias("birth_year"), F.when(F.col("s_nationkey") % 5 == 0, "No").otherwise("").alias("use"), F.lit("").alias("exclude_from_train"))
    videos = read(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("speaker_id"), F.concat("l_returnflag", "l_linestatus").alias("youtube_id")).distinct()
    return manifest.with_enough_videos(manifest.usable_speakers(usable), videos, 2).select("speaker_id", "name", "n_videos", "youtube_id")


@query(r"""
    SELECT doc_id FROM documents d WHERE NOT EXISTS (
        SELECT 1 FROM benchmark b
        WHERE lower(strip_accents(split_part(trim(regexp_replace(b.text, '\s+', ' ', 'g')), ' ', 1))) = lower(strip_accents(split_part(trim(regexp_replace(d.text, '\s+', ' ', 'g')), ' ', 1))))""")
def exclusion_anti_join(spark, sf):
    first = lambda c: F.substring_index(spaced(c), " ", 1)
    docs = read(spark, sf, "documents").select("doc_id", first("text").alias("name"))
    return manifest.without_excluded(docs, read(spark, sf, "benchmark").select(first("text").alias("name"))).select("doc_id")


@query("SELECT row_number() OVER (PARTITION BY l_suppkey ORDER BY priority, youtube_id) AS position, CAST(l_suppkey AS VARCHAR) AS speaker_id, youtube_id, priority FROM (SELECT l_suppkey, l_returnflag || l_linestatus AS youtube_id, min(l_linenumber) AS priority FROM lineitem GROUP BY 1, 2)")
def videos_by_priority(spark, sf):
    videos = read(spark, sf, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("speaker_id"), F.concat("l_returnflag", "l_linestatus").alias("youtube_id")).agg(F.min("l_linenumber").alias("priority"))
    return manifest.in_order(videos).select(F.col("position").cast("long").alias("position"), "speaker_id", "youtube_id", "priority")


@query("""
    WITH c AS (SELECT s_suppkey, count(DISTINCT l_returnflag || l_linestatus) AS n_videos FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_quantity > 48 GROUP BY 1)
    SELECT CAST(s_suppkey AS VARCHAR) AS speaker_id, unnest(list_filter([
        CASE WHEN s_suppkey % 3 < 2 THEN 'too few references' END,
        CASE WHEN n_videos < 4 THEN 'too few videos' END,
        CASE WHEN n_videos * 10 < 50 THEN 'caps can''t reach the target' END,
        CASE WHEN n_videos * 9 > 50 THEN 'reserves exceed the target' END], lambda x: x IS NOT NULL)) AS problem FROM c""")
def preflight_problems(spark, sf):
    speakers = read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("speaker_id"))
    videos = read(spark, sf, "lineitem").where("l_quantity > 48").select(F.col("l_suppkey").cast("string").alias("speaker_id"), F.concat("l_returnflag", "l_linestatus").alias("youtube_id"))
    references = speakers.select("speaker_id", (F.col("speaker_id").cast("long") % 3).alias("n_references"))
    return manifest.preflight(speakers, videos, references, 50, 10, 9, 2, 4)


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS youtube_id, doc_id % 4 = 0 AS missing, CASE WHEN doc_id % 4 <> 0 THEN 'v/' || doc_id || '.mp4' END AS path,
           CASE WHEN doc_id % 8 = 0 THEN 'v/' || doc_id || '.f1.webm' END AS near
    FROM documents WHERE lang <> 'de'""")
def local_video_check(spark, sf):
    docs = read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("youtube_id"), F.when(F.col("lang") == "de", " False").otherwise("n").alias("use"))
    key = F.col("youtube_id").cast("long")
    name = F.concat(F.lit("v/"), "youtube_id", F.when(key % 8 == 0, ".f1.webm").when(key % 4 == 0, " copy.mp4").otherwise(".mp4"))
    files = docs.select(name.alias("path"))  # neither another kind nor another name counts
    return manifest.local_videos(docs, files).select("youtube_id", "missing", "path", "near")


# --- semi and anti joins, stores -------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = l_linestatus)")
def configured_pairs_semi(spark, sf):
    rows = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("speaker_id"), F.col("l_linestatus").alias("video_id"), "l_linenumber", "l_quantity")
    pairs = read(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("speaker_id"), F.col("o_orderstatus").alias("video_id"))
    return manifest.of_pairs(rows, pairs).select(F.col("speaker_id").alias("l_orderkey"), "l_linenumber", "l_quantity")


@query("""
    WITH c AS (SELECT doc_id, 'clip/' || doc_id AS candidate_path, sha1(coalesce(text, '')) AS sha1 FROM documents),
    bad AS (SELECT candidate_path, CASE WHEN l.doc_id % 10 = 0 THEN sha1 END AS sha1 FROM c JOIN labels l USING (doc_id) WHERE quality = 0),
    h AS (SELECT sha1 FROM bad WHERE sha1 IS NOT NULL UNION SELECT c.sha1 FROM c JOIN bad USING (candidate_path))
    SELECT doc_id, CAST(candidate_path IN (SELECT candidate_path FROM bad) OR sha1 IN (SELECT sha1 FROM h) AS INTEGER) AS manual_rejected FROM c""")
def manual_reject_transitive(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", F.concat(F.lit("clip/"), F.col("doc_id").cast("string")).alias("candidate_path"), F.sha1(F.coalesce("text", F.lit("")).cast("binary")).alias("sha1"))
    bad = rows.join(read(spark, sf, "labels").where("quality = 0").select("doc_id"), "doc_id").select("candidate_path", F.when(F.col("doc_id") % 10 == 0, F.col("sha1")).otherwise("").alias("sha1"))
    return rejections.mark_rejected(rows, bad).select("doc_id", "manual_rejected")


@query("""
    WITH m AS (SELECT 'u' || doc_id AS utterance_id FROM documents WHERE source <> 'src0'),
    r AS (SELECT DISTINCT 'u' || (doc_id * 2) AS utterance_id FROM labels WHERE quality = 0)
    SELECT utterance_id, m.utterance_id IS NOT NULL AS known FROM r LEFT JOIN m USING (utterance_id)""")
def rejections_resolved(spark, sf):
    docs = read(spark, sf, "documents").where("source <> 'src0'").select(F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("utterance_id"), F.lit("p").alias("candidate_path"), F.lit("h").alias("sha1"))
    bad = read(spark, sf, "labels").where("quality = 0").select(F.concat(F.lit("u"), (F.col("doc_id") * 2).cast("string")).alias("utterance_id"), F.lit("").alias("audio_filename"))
    found, unknown = rejections.resolved(bad, docs)
    return found.select("utterance_id", F.lit(True).alias("known")).union(unknown.select("utterance_id", F.lit(False)))


@query("SELECT e.speaker_id, e.processing_unit_id FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS speaker_id, event_type || '::' || (event_id % 4) AS processing_unit_id FROM events) e WHERE NOT EXISTS (SELECT 1 FROM events d WHERE value > 60 AND CAST(d.user_id AS VARCHAR) = e.speaker_id AND d.event_type || '::' || (d.event_id % 4) = e.processing_unit_id)")
def resume_ledger_anti(spark, sf):
    units = read(spark, sf, "events").select(F.col("user_id").cast("string").alias("speaker_id"), F.concat("event_type", F.lit("::"), (F.col("event_id") % 4).cast("string")).alias("processing_unit_id"), "value")
    return rejections.not_done(units.select("speaker_id", "processing_unit_id").distinct(), units.where("value > 60"))


@query("""
    WITH old AS (SELECT o_custkey AS speaker_id, o_orderpriority AS k, o_orderkey AS row_ord, o_totalprice AS v, 0 AS fresh FROM orders WHERE o_orderstatus <> 'P'),
    new AS (SELECT o_custkey AS speaker_id, o_orderpriority AS k, o_orderkey AS row_ord, o_totalprice AS v, 1 AS fresh FROM orders WHERE o_orderstatus = 'P'),
    u AS (SELECT * FROM old WHERE speaker_id NOT IN (SELECT speaker_id FROM new WHERE speaker_id % 2 = 0) UNION ALL SELECT * FROM new)
    SELECT speaker_id, k, row_ord, v FROM u QUALIFY row_number() OVER (PARTITION BY speaker_id, k ORDER BY fresh DESC, row_ord DESC) = 1""")
def scoped_replace(spark, sf):
    rows = read(spark, sf, "orders").select(F.col("o_custkey").alias("speaker_id"), F.col("o_orderpriority").alias("k"), F.col("o_orderkey").alias("row_ord"), F.col("o_totalprice").alias("v"), "o_orderstatus")
    new = rows.where("o_orderstatus = 'P'").drop("o_orderstatus")
    return store.scoped_replace(rows.where("o_orderstatus <> 'P'").drop("o_orderstatus"), new, new.where("speaker_id % 2 = 0"), ["speaker_id", "k"])


@query("SELECT doc_id, source, sha1(coalesce(text, '')) AS sha1 FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source, sha1(coalesce(text, '')) ORDER BY doc_id) = 1")
def dedup_keep_first_sha1(spark, sf):
    rows = read(spark, sf, "documents").select(F.col("lang").alias("speaker_id"), F.col("source").alias("video_id"), F.sha1(F.coalesce("text", F.lit("")).cast("binary")).alias("sha1"), F.lit("p").alias("candidate_path"), F.col("doc_id").alias("row_ord"))
    return store.keep_first_digest(rows).select(F.col("row_ord").alias("doc_id"), F.col("video_id").alias("source"), "sha1")


@query("SELECT row_ord, file_there FROM (SELECT CAST(page_id AS BIGINT) AS row_ord, page_id % 3 = 0 AS file_there FROM pages)")
def file_exists_mark(spark, sf):
    pages = read(spark, sf, "pages").select(F.col("page_id").cast("long").alias("row_ord"), F.col("url").alias("candidate_path"), "page_id")
    paths = pages.select("row_ord", F.concat("candidate_path", F.lit("#"), F.col("row_ord").cast("string")).alias("candidate_path"))
    files = paths.where("row_ord % 3 = 0").select(F.col("candidate_path").alias("path"))
    return rejections.existing(paths, files).select("row_ord", F.col("file_exists").alias("file_there"))


# --- intervals --------------------------------------------------------------------

_VIDEOS = "SELECT CAST(user_id AS STRING) AS video_id, floor(sum(value) * 10) AS video_duration FROM {events} GROUP BY user_id"


@query("""WITH+ , i AS (SELECT *, unnest(range(0, CAST(greatest(1, ceil(video_duration / 600)) AS BIGINT))) AS idx FROM v)
    SELECT video_id, CAST(idx AS INTEGER) AS idx, CAST(idx * 600 AS DOUBLE) AS start, least(600.0::DOUBLE, video_duration - idx * 600) AS duration,
           CASE WHEN video_duration <= 600 THEN 'w0000' ELSE 'w' || lpad(CAST(idx AS VARCHAR), 4, '0') || '_' || lpad(CAST(idx * 600 AS VARCHAR), 6, '0') END AS tag, video_duration
    FROM i WHERE (video_duration <= 600 AND idx = 0) OR (video_duration > 600 AND video_duration - idx * 600 >= 60)""", v=_VIDEOS)
def video_windows_hopping(spark, sf):
    return intervals.video_windows(bound(spark, sf, _VIDEOS))


@query("""WITH+ RECURSIVE , w AS (SELECT video_id, CAST(i AS INTEGER) AS idx FROM (SELECT *, unnest(range(0, CAST(greatest(1, ceil(video_duration / 600)) AS BIGINT))) AS i FROM v)
        WHERE (video_duration <= 600 AND i = 0) OR (video_duration > 600 AND video_duration - i * 600 >= 60)),
    n AS (SELECT video_id, count(*) AS n FROM w GROUP BY 1),
    st AS (
        SELECT n, CASE WHEN n <= 2 THEN range(0, n) ELSE [0, CAST(round_even((n - 1) / 2, 0) AS BIGINT), n - 1] END AS chosen FROM (SELECT DISTINCT n FROM n)
        UNION ALL
        SELECT n, list_append(chosen, -(list_max(list_transform(range(0, n), lambda i: {'d': list_min(list_transform(chosen, lambda c: abs(c - i))), 'i': -i})).i)) FROM st WHERE len(chosen) < n),
    o AS (SELECT n, chosen FROM st WHERE len(chosen) = n)
    SELECT video_id, CAST(chosen[k] AS INTEGER) AS idx, CAST(k - 1 AS INTEGER) AS visit FROM (SELECT video_id, chosen, unnest(range(1, n + 1)) AS k FROM n JOIN o USING (n))""", v=_VIDEOS)
def stratified_window_order(spark, sf):
    return intervals.stratified(intervals.video_windows(bound(spark, sf, _VIDEOS))).select("video_id", "idx", "visit")


@query("""WITH+ , w AS (SELECT video_id, CAST(idx AS INTEGER) AS idx, video_duration, least((video_duration - 600) * idx / 4, video_duration - 60) AS start FROM v, (SELECT unnest(range(0, 5)) AS idx) WHERE video_duration > 600)
    SELECT video_id, idx, round(start, 6) AS start, round(least(600.0::DOUBLE, greatest(60.0::DOUBLE, video_duration - start)), 6) AS duration, 'w' || lpad(CAST(idx AS VARCHAR), 4, '0') || '_' || lpad(CAST(CAST(floor(start) AS BIGINT) AS VARCHAR), 6, '0') AS tag FROM w
    UNION ALL SELECT video_id, 0, 0.0, video_duration, 'w0000' FROM v WHERE video_duration <= 600""", v=_VIDEOS)
def uniform_windows(spark, sf):
    found = intervals.video_windows(bound(spark, sf, _VIDEOS), most=5, strategy="uniform")
    return rounded(found.select("video_id", "idx", "start", "duration", "tag"), "start", "duration")


_TRACKS = "SELECT concat(CAST(user_id AS STRING), event_type) AS track_id, CAST(user_id AS STRING) AS window_id, min(CAST(event_id % 300 AS DOUBLE)) / 5 AS start_time, (max(CAST(event_id % 300 AS DOUBLE)) + 1) / 5 AS end_time, max(value) AS face_conf FROM {events} GROUP BY user_id, event_type"
_POINTS = "SELECT concat(CAST(user_id AS STRING), event_type) AS track_id, CAST(event_id % 300 AS INT) AS frame FROM {events}"


@query("""WITH+ , c AS (SELECT *, start_time + i * 10 AS start, least(end_time, start_time + i * 10 + 12) AS fin FROM (SELECT *, unnest(range(0, 8)) AS i FROM t)
        WHERE start_time + i * 10 < end_time - 1e-8 AND (i = 0 OR start_time + (i - 1) * 10 + 12 < end_time)),
    n AS (SELECT c.track_id, c.window_id, c.start, c.fin, c.face_conf, count(*) / greatest(1, any_value(ceil(c.fin * 5) - floor(c.start * 5) + 1)) AS coverage
          FROM c JOIN p ON p.track_id = c.track_id AND p.frame BETWEEN floor(c.start * 5) AND ceil(c.fin * 5) WHERE c.fin - c.start >= 2 GROUP BY ALL)
    SELECT track_id, window_id, start, fin AS "end", round(coverage, 6) AS coverage, row_number() OVER (PARTITION BY window_id ORDER BY start, face_conf DESC, track_id) AS position
    FROM n WHERE coverage >= 0.05 QUALIFY position <= 6""", t=_TRACKS, p=_POINTS)
def probe_windows_coverage(spark, sf):
    found = intervals.probes(bound(spark, sf, _TRACKS), bound(spark, sf, _POINTS), 5.0, coverage=0.05, most=6)
    return rounded(found.withColumn("position", F.col("position").cast("long")), "coverage")


@query("""WITH+ , f AS (SELECT *, max("end") OVER (PARTITION BY speaker_id, video_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM s),
    g AS (SELECT *, sum(CASE WHEN far IS NULL OR start > far + 43200 THEN 1 ELSE 0 END) OVER (PARTITION BY speaker_id, video_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM f)
    SELECT speaker_id, video_id, CAST(island AS BIGINT) AS island, min(start) AS start, max("end") AS "end", count(*) AS n_parts, round(avg(score), 6) AS score FROM g GROUP BY ALL""", s=SEGMENTS)
def session_merge_islands(spark, sf):
    return rounded(intervals.merge_sessions(bound(spark, sf, SEGMENTS), ["speaker_id", "video_id"], 43200.0, "score"), "score")


_FLAGS = "SELECT CAST(user_id AS STRING) AS speaker_id, event_id AS frame, value > 30 AS flag FROM {events}"
_RUNS = """, r AS (SELECT *, sum(CASE WHEN flag IS DISTINCT FROM prior THEN 1 ELSE 0 END) OVER (PARTITION BY speaker_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run
    FROM (SELECT *, lag(flag) OVER (PARTITION BY speaker_id ORDER BY frame) AS prior FROM f))"""


@query(f"WITH+ {_RUNS} SELECT speaker_id, CAST(run AS BIGINT) AS run, any_value(flag) AS flag, min(frame) AS first, max(frame) AS last, count(*) AS n FROM r GROUP BY speaker_id, run", f=_FLAGS)
def boolean_runs(spark, sf):
    return intervals.runs(bound(spark, sf, _FLAGS), ["speaker_id"], "frame", "flag")


@query(f"""WITH+ {_RUNS}, z AS (SELECT *, count(*) OVER (PARTITION BY speaker_id, run) AS n, max(run) OVER (PARTITION BY speaker_id) AS top FROM r)
    SELECT speaker_id, frame, flag, flag OR (run > 1 AND run < top AND n <= 2) AS bridged FROM z""", f=_FLAGS)
def bridge_gaps_runs(spark, sf):
    return intervals.bridge_gaps(bound(spark, sf, _FLAGS), ["speaker_id"], "frame", "flag", 2)


@query("""WITH+ SELECT a.speaker_id, a.video_id, a.row_ord AS a, b.row_ord AS b,
      round((least(a."end", b."end") - greatest(a.start, b.start)) / (greatest(a."end", b."end") - least(a.start, b.start)), 6) AS iou
    FROM s a JOIN s b ON a.speaker_id = b.speaker_id AND a.video_id = b.video_id AND a.row_ord < b.row_ord AND a.start < b."end" AND b.start < a."end"
    WHERE (least(a."end", b."end") - greatest(a.start, b.start)) / (greatest(a."end", b."end") - least(a.start, b.start)) > 0.05""", s=SEGMENTS)
def temporal_overlap_pairs(spark, sf):
    found = intervals.overlap_pairs(bound(spark, sf, SEGMENTS), ["speaker_id", "video_id"], "row_ord", 21600.0, 0.05)
    return rounded(found.select("speaker_id", "video_id", "a", "b", "iou"), "iou")


@query("""WITH+ , sp AS (SELECT speaker_id, min(start) AS s0, max("end") AS s1 FROM s GROUP BY 1),
    e AS (SELECT speaker_id, t, sum(d) AS d FROM (SELECT speaker_id, start AS t, 1 AS d FROM s WHERE "end" > start UNION ALL SELECT speaker_id, "end", -1 FROM s WHERE "end" > start) GROUP BY 1, 2),
    z AS (SELECT *, sum(d) OVER (PARTITION BY speaker_id ORDER BY t) AS depth, lead(t) OVER (PARTITION BY speaker_id ORDER BY t) AS upto FROM e)
    SELECT sp.speaker_id, round(CASE WHEN s1 <= s0 THEN 1 ELSE coalesce((SELECT sum(upto - t) FROM z WHERE z.speaker_id = sp.speaker_id AND depth > 1), 0) / (s1 - s0) END, 6) AS overlap_ratio FROM sp""", s=SEGMENTS)
def overlap_depth_sweep(spark, sf):
    parts = bound(spark, sf, SEGMENTS)
    spans = parts.groupBy("speaker_id").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return rounded(intervals.overlap_depth(spans, parts.select("speaker_id", "start", "end"), "speaker_id"), "overlap_ratio")


_NEAR = """WITH+ , l AS (SELECT row_ord, speaker_id, start FROM s WHERE video_id = 'click'), r AS (SELECT speaker_id, start AS t, score FROM s WHERE video_id = 'view'),
    p AS (SELECT l.row_ord, l.start, r.t, r.score FROM l LEFT JOIN r ON l.speaker_id = r.speaker_id)"""


@query(f"""{_NEAR} SELECT row_ord, CASE WHEN abs(t - start) <= 86400 THEN score END AS score FROM p
    QUALIFY row_number() OVER (PARTITION BY row_ord ORDER BY abs(t - start), t, score) = 1""", s=SEGMENTS)
def nearest_asof(spark, sf):
    rows = bound(spark, sf, SEGMENTS)
    right = rows.where("video_id = 'view'").groupBy("speaker_id", "start").agg(F.min("score").alias("score"))
    return intervals.nearest(rows.where("video_id = 'click'").drop("score"), right, ["speaker_id"], "start", "score", 86400.0).select("row_ord", "score")


@query("""WITH+ , l AS (SELECT row_ord, speaker_id, start FROM s WHERE video_id = 'click'), r AS (SELECT speaker_id, start AS t, min(score) AS v FROM s WHERE video_id = 'view' GROUP BY 1, 2),
    b AS (SELECT l.row_ord, l.start, (SELECT max(t) FROM r WHERE r.speaker_id = l.speaker_id AND t <= start) AS t0, (SELECT min(t) FROM r WHERE r.speaker_id = l.speaker_id AND t >= start) AS t1, l.speaker_id FROM l)
    SELECT row_ord, round(CASE WHEN t0 IS NOT NULL AND t1 IS NOT NULL THEN CASE WHEN t1 > t0 THEN a.v + (z.v - a.v) * (start - t0) / (t1 - t0) ELSE a.v END
        WHEN t0 IS NULL AND t1 - start <= 43200 THEN z.v WHEN t1 IS NULL AND start - t0 <= 43200 THEN a.v END, 6) AS score
    FROM b LEFT JOIN r a ON a.speaker_id = b.speaker_id AND a.t = t0 LEFT JOIN r z ON z.speaker_id = b.speaker_id AND z.t = t1""", s=SEGMENTS)
def interpolated_asof(spark, sf):
    rows = bound(spark, sf, SEGMENTS)
    right = rows.where("video_id = 'view'").groupBy("speaker_id", "start").agg(F.min("score").alias("score"))
    return rounded(intervals.interpolated(rows.where("video_id = 'click'").drop("score"), right, ["speaker_id"], "start", "score", 43200.0).select("row_ord", "score"), "score")


@query("""WITH+ SELECT row_ord, CAST(i AS INTEGER) AS slice, start + i * 3600 AS start, least("end", start + (i + 1) * 3600) AS "end"
    FROM s, (SELECT unnest(range(0, 100)) AS i) WHERE start + i * 3600 < "end" AND least("end", start + (i + 1) * 3600) - (start + i * 3600) >= 1800""", s=SEGMENTS)
def run_slices(spark, sf):
    return intervals.slices(bound(spark, sf, SEGMENTS).select("row_ord", "start", "end"), 3600.0, 1800.0).select("row_ord", "slice", "start", "end")


# --- vectors ----------------------------------------------------------------------

_FACES = """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM e)"""
_MEDOID = f"""{_FACES}, k AS (SELECT a.label, a.vec_id, quantile_cont(list_dot_product(a.u, b.u), 0.5) AS likeness FROM u a JOIN u b USING (label) GROUP BY 1, 2),
    m AS (SELECT label, vec_id AS medoid, likeness FROM k QUALIFY row_number() OVER (PARTITION BY label ORDER BY round(likeness, 9) DESC, vec_id) = 1)"""
_TEMPLATES = f"""{_MEDOID}, near AS (SELECT u.* FROM u JOIN m USING (label) JOIN u c ON c.vec_id = m.medoid WHERE list_dot_product(u.u, c.u) >= 0),
    d AS (SELECT label, i, avg(u[i]) AS x FROM (SELECT label, u, unnest(range(1, 65)) AS i FROM near) GROUP BY 1, 2),
    w AS (SELECT label, list(x ORDER BY i) AS v FROM d GROUP BY 1),
    t AS (SELECT label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS template FROM w)"""


def _faces(spark, sf):
    return read(spark, sf, "embeddings")


@query(f"{_MEDOID} SELECT label, medoid, round(likeness, 6) AS likeness FROM m")
def medoid_template(spark, sf):
    return rounded(vectors.medoids(_faces(spark, sf), "label", "vec_id", "embedding"), "likeness")


def _templates(spark, sf):
    return vectors.templates(_faces(spark, sf), "label", "vec_id", "embedding", 0.0)


@query(f"""{_TEMPLATES}, n AS (SELECT label, count(*) AS template_count FROM near GROUP BY 1)
    SELECT label, template_count, round(template[1], 6) AS first, round(list_sum(template), 5) AS total FROM t JOIN n USING (label)""")
def inlier_templates(spark, sf):
    return _templates(spark, sf).select("label", "template_count", F.round(F.col("template")[0], 6).alias("first"), F.round(F.aggregate("template", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@query(f"""{_TEMPLATES}, q AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    c AS (SELECT q.vec_id, label, list_dot_product(v, template) / sqrt(list_dot_product(v, v)) AS score FROM q, t),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 9) DESC, label) AS n, lead(score) OVER (PARTITION BY vec_id ORDER BY round(score, 9) DESC, label) AS second FROM c)
    SELECT vec_id, round(score, 6) AS face_conf, round(second, 6) AS face_other_conf, round(score - second, 6) AS face_margin,
           CASE WHEN score >= 0.3 AND score - second >= 0.08 THEN CAST(label AS VARCHAR) ELSE 'unknown' END AS speaker_id FROM r WHERE n = 1""")
def identify_top2_margin(spark, sf):
    known = _templates(spark, sf).select(F.col("label").cast("string").alias("speaker_id"), "template")
    found = vectors.identify(_faces(spark, sf), known, "vec_id", "embedding", 0.3, 0.08)
    return rounded(found, "face_conf", "face_other_conf", "face_margin")


@query("""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    d AS (SELECT label, i, sum(vec_id % 5 * v[i]) / nullif(sum(vec_id % 5), 0) AS x FROM (SELECT vec_id, label, v, unnest(range(1, 65)) AS i FROM e) GROUP BY 1, 2)
    SELECT label, round(sum(x), 5) AS total, round(max(x), 6) AS top FROM d GROUP BY 1""")
def weighted_mean_vector(spark, sf):
    rows = _faces(spark, sf).select("label", arrays.doubles("embedding").alias("v"), (F.col("vec_id") % 5).alias("w"))
    out = vectors.mean_vector(rows, ["label"], "v", "w")
    return out.select("label", F.round(F.aggregate("mean", F.lit(0.0), lambda a, x: a + x), 5).alias("total"), F.round(F.array_max("mean"), 6).alias("top"))


_OVER = "SELECT CAST(o_orderkey AS STRING) AS segment_id, CAST(o_custkey % 50 AS STRING) AS video_id, CAST(o_custkey AS STRING) AS track_id, CAST(o_orderkey % 40 AS DOUBLE) AS start, CAST(o_orderkey % 40 AS DOUBLE) + 3 AS `end` FROM {orders}"
_SEEN = "SELECT CAST(o_custkey AS STRING) AS track_id, CAST(o_orderkey % 215 AS INT) AS frame FROM {orders} GROUP BY o_custkey, CAST(o_orderkey % 215 AS INT)"
_OF = "SELECT DISTINCT CAST(o_custkey AS STRING) AS track_id, CAST(o_custkey % 50 AS STRING) AS video_id FROM {orders}"


@query("""WITH+ , m AS (SELECT s.segment_id, p.track_id, count(*) / 16.0::DOUBLE AS coverage FROM s JOIN o ON o.video_id = s.video_id AND o.track_id <> s.track_id
        JOIN p ON p.track_id = o.track_id AND p.frame BETWEEN s.start * 5 AND s."end" * 5 GROUP BY 1, 2)
    SELECT segment_id, track_id, coverage, row_number() OVER (PARTITION BY segment_id ORDER BY coverage DESC, track_id) AS place FROM m WHERE coverage >= 0.125 QUALIFY place <= 2""", s=_OVER, p=_SEEN, o=_OF)
def competitor_tracks(spark, sf):
    out = vectors.competitors(bound(spark, sf, _OVER), bound(spark, sf, _OF), bound(spark, sf, _SEEN), 5.0, 0.125, 2)
    return out.withColumn("place", F.col("place").cast("long"))


# --- gates and selection ------------------------------------------------------------

_NUM = """WITH+ , n AS (SELECT *, CASE WHEN isnan(snr_db) OR snr_db IS NULL THEN -99 ELSE snr_db END AS snr, lower(candidate_profile) = 'relaxed' AS relaxed FROM c),
    t AS (SELECT *, CASE WHEN relaxed THEN 0.5::DOUBLE ELSE 0.6::DOUBLE END AS face_thr, CASE WHEN relaxed THEN 5.0::DOUBLE ELSE 8.0::DOUBLE END AS snr_thr FROM n),
    a AS (SELECT *, greatest(0, least(1, (face_conf - face_thr) / greatest(0.8::DOUBLE - face_thr, 0.01::DOUBLE))) AS face_score, greatest(0, least(1, (snr - snr_thr) / 20)) AS snr_score, greatest(0, least(1, (syncnet_confidence - 4) / 7)) AS sync_score FROM t),
    sc AS (SELECT *, 0.30::DOUBLE * face_score + 0.20::DOUBLE * quality_score + 0.35::DOUBLE * sync_score + 0.10::DOUBLE * active_confidence + 0.05::DOUBLE * snr_score AS balanced FROM a),
    el AS (SELECT *, file_exists AND coalesce(pipeline_version, 'legacy') = '1' AND face_conf >= face_thr AND face_margin >= 0.08::DOUBLE AND face_track_consistency >= 0.75::DOUBLE
        AND vad_ratio >= 0.45::DOUBLE AND snr >= snr_thr AND syncnet_verified >= 1 AND syncnet_confidence >= 4 AND abs(syncnet_offset_frames) <= 3 AND syncnet_unambiguous >= 1 AS eligible FROM sc)"""


_CLEAN_SNR = "n AS (SELECT *, CASE WHEN isnan(snr_db) OR snr_db IS NULL THEN -99 ELSE snr_db END AS snr FROM c)"


@query(f"""WITH+ , {_CLEAN_SNR}
    SELECT row_ord, round(0.40::DOUBLE * greatest(0, least(1, (vad_ratio - 0.55::DOUBLE) / 0.45::DOUBLE)) + 0.30::DOUBLE * greatest(0, least(1, (snr - 8) / 20)) + 0.20::DOUBLE * least(1, rms / 0.012::DOUBLE) + 0.10::DOUBLE * (1 - least(1, clipping_ratio / 0.02::DOUBLE)), 6) AS quality_score,
      coalesce(nullif(concat_ws(', ', CASE WHEN duration <= 0 THEN 'audio vacío' END, CASE WHEN rms < 0.003::DOUBLE THEN 'RMS bajo' END, CASE WHEN vad_ratio < 0.55::DOUBLE THEN 'poca voz' END, CASE WHEN snr < 8 THEN 'SNR bajo' END, CASE WHEN clipping_ratio > 0.02::DOUBLE THEN 'clipping' END), ''), 'ok') AS quality_reason FROM n""", c=CANDIDATES)
def quality_score_gate(spark, sf):
    return rounded(gates.audio_quality(bound(spark, sf, CANDIDATES), S).select("row_ord", "quality_score", "quality_reason"), "quality_score")


@query(f"""WITH+ , {_CLEAN_SNR}, o AS (SELECT *, duration / 5 AS d, clipping_ratio * 10 AS overlap_ratio FROM n)
    SELECT CASE WHEN d < 0.5::DOUBLE THEN 'short' WHEN rms < 0.003::DOUBLE THEN 'rms' WHEN vad_ratio < 0.55::DOUBLE THEN 'vad' WHEN snr < 8 THEN 'snr' WHEN overlap_ratio > 0.10::DOUBLE THEN 'overlap' ELSE 'accepted' END AS reject_reason,
      count(*) AS n, count(*) FILTER (WHERE d > 0 AND rms >= 0.003::DOUBLE AND vad_ratio >= 0.55::DOUBLE AND snr >= 8 AND overlap_ratio <= 0.10::DOUBLE) AS n_accepted_chunks FROM o GROUP BY 1""", c=CANDIDATES)
def rejection_reason_counts(spark, sf):
    rows = bound(spark, sf, CANDIDATES).withColumn("duration", F.col("duration") / 5).withColumn("overlap_ratio", F.col("clipping_ratio") * 10)
    told = gates.first_failure(rows, gates.segment_rules(S)).withColumn("fine", gates.chunk_accepted(S))
    counts = gates.rejection_counts(told)
    return counts.join(told.groupBy("reject_reason").agg(F.count_if("fine").alias("n_accepted_chunks")), "reject_reason")


def _eligible(spark, sf) -> DataFrame:
    return gates.eligibility(gates.approval_scores(bound(spark, sf, CANDIDATES), S), S)


@query(f"{_NUM} SELECT row_ord, eligible, round(face_score, 6) AS approval_face_score, round(snr_score, 6) AS approval_snr_score, round(sync_score, 6) AS approval_syncnet_score, round(balanced, 6) AS balanced_rank_score FROM el", c=CANDIDATES)
def eligibility_scores(spark, sf):
    columns = ("approval_face_score", "approval_snr_score", "approval_syncnet_score", "balanced_rank_score")
    return rounded(_eligible(spark, sf).select("row_ord", "eligible", *columns), *columns)


@query(f"{_NUM} SELECT count(*) AS n, count(*) FILTER (WHERE eligible) AS n_eligible, count(*) FILTER (WHERE vad_ratio >= 0.45::DOUBLE) AS n_vad, count(*) FILTER (WHERE snr >= snr_thr) AS n_snr, count(*) FILTER (WHERE face_conf >= face_thr) AS n_face FROM el", c=CANDIDATES)
def gate_counts(spark, sf):
    return _eligible(spark, sf).agg(F.count("*").alias("n"), F.count_if("eligible").alias("n_eligible"), F.count_if("gate_vad").alias("n_vad"), F.count_if("gate_snr").alias("n_snr"), F.count_if("gate_face").alias("n_face"))


@query("""WITH+ SELECT row_ord, round(0.35::DOUBLE * quality_score + 0.35::DOUBLE * greatest(0, least(1, (syncnet_confidence - 4) / 4)) + 0.20::DOUBLE * active_confidence
    + 0.10::DOUBLE * greatest(0, least(1, (CASE WHEN isnan(snr_db) THEN -99 ELSE snr_db END - 8) / 20)), 6) AS rank_score FROM c""", c=CANDIDATES)
def candidate_rank_score(spark, sf):
    return rounded(gates.candidate_rank(bound(spark, sf, CANDIDATES), S).select("row_ord", "rank_score"), "rank_score")


_RANKED = f"""{_NUM}, rk AS (SELECT speaker_id, video_id, row_ord, start, "end", row_number() OVER (PARTITION BY speaker_id ORDER BY balanced DESC, face_conf DESC, quality_score DESC, active_confidence DESC, row_ord) AS position,
        CASE WHEN trim(sha1) <> '' THEN sha1 ELSE candidate_path END AS digest FROM (SELECT * REPLACE (round(balanced, 9) AS balanced) FROM el) WHERE __WHERE__)"""


def _ranked(spark, sf, where: str) -> DataFrame:
    rows = rejections.digest(_eligible(spark, sf).where(where)).withColumn("balanced_rank_score", F.round("balanced_rank_score", 9))
    return selection.ranked(rows)


@query(f"""{_RANKED.replace("__WHERE__", "file_exists")}, v AS (SELECT *, row_number() OVER (PARTITION BY speaker_id, video_id ORDER BY position) AS in_video, min(position) OVER (PARTITION BY speaker_id, video_id) AS best FROM rk)
    SELECT speaker_id, video_id, row_ord, row_number() OVER (PARTITION BY speaker_id ORDER BY CASE WHEN in_video <= 5 THEN 0 ELSE 1 END, CASE WHEN in_video <= 5 THEN best END, position) - 1 AS selection_rank
    FROM v WHERE in_video <= 20 QUALIFY selection_rank < 50""", c=CANDIDATES)
def selection_quota_simple(spark, sf):
    found = selection.quota_simple(_ranked(spark, sf, "file_exists"), 50, 20, 5)
    return found.select("speaker_id", "video_id", "row_ord", F.col("selection_rank").cast("long").alias("selection_rank"))


_FULL = f"""{_RANKED.replace("__WHERE__", "file_exists")}, vb AS (SELECT speaker_id, video_id, min(position) AS best FROM rk GROUP BY 1, 2),
    x AS (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY phase, vbest, position) AS n FROM (
        SELECT rk.*, 1 AS phase, best AS vbest FROM rk JOIN vb USING (speaker_id, video_id) UNION ALL SELECT *, 2, 0 FROM rk UNION ALL SELECT *, 3, 0 FROM rk)),
    step AS (
        SELECT speaker_id, 0::BIGINT AS n, []::STRUCT(r BIGINT, v VARCHAR, d VARCHAR, a DOUBLE, b DOUBLE)[] AS taken FROM (SELECT DISTINCT speaker_id FROM rk)
        UNION ALL
        SELECT s.speaker_id, x.n, CASE WHEN len(list_filter(taken, lambda t: t.d = x.digest)) = 0
            AND (phase = 3 OR len(list_filter(taken, lambda t: t.v = x.video_id)) < CASE phase WHEN 1 THEN 5 ELSE 20 END)
            AND len(list_filter(taken, lambda t: t.v = x.video_id AND greatest(0, least(x."end", t.b) - greatest(x.start, t.a)) / (greatest(x."end", t.b) - least(x.start, t.a)) > 0.05::DOUBLE)) = 0
            THEN list_append(taken, {{'r': x.row_ord, 'v': x.video_id, 'd': x.digest, 'a': x.start, 'b': x."end"}}) ELSE taken END
        FROM step s JOIN x ON x.speaker_id = s.speaker_id AND x.n = s.n + 1 WHERE len(taken) < 50),
    done AS (SELECT speaker_id, taken FROM step QUALIFY row_number() OVER (PARTITION BY speaker_id ORDER BY n DESC) = 1),
    sel AS (SELECT speaker_id, taken[i].r AS row_ord, CAST(i - 1 AS INTEGER) AS selection_rank FROM (SELECT *, unnest(range(1, len(taken) + 1)) AS i FROM done))"""


@query(f"{_FULL} SELECT speaker_id, row_ord, selection_rank FROM sel".replace("WITH+", "WITH+ RECURSIVE", 1), c=CANDIDATES)
def selection_balanced_full(spark, sf):
    return selection.select_balanced(_ranked(spark, sf, "file_exists"))


@query(f"""{_FULL} SELECT rk.speaker_id, rk.video_id, rk.row_ord, CAST(selection_rank IS NOT NULL AS INTEGER) AS approved, coalesce(selection_rank, -1) AS selection_rank,
    CAST(CASE WHEN selection_rank IS NULL THEN -1 ELSE row_number() OVER (PARTITION BY rk.speaker_id, rk.video_id, selection_rank IS NOT NULL ORDER BY selection_rank) - 1 END AS INTEGER) AS approved_index
    FROM rk LEFT JOIN sel USING (speaker_id, row_ord)""".replace("WITH+", "WITH+ RECURSIVE", 1), c=CANDIDATES)
def approved_index(spark, sf):
    rows = _ranked(spark, sf, "file_exists")
    done = selection.with_approval(rows, selection.select_balanced(rows))
    return done.select("speaker_id", "video_id", "row_ord", "approved", "selection_rank", "approved_index")


@query("""WITH+ RECURSIVE , x AS (SELECT *, row_number() OVER (PARTITION BY speaker_id, video_id ORDER BY score DESC, row_ord) AS n FROM s),
    step AS (
        SELECT speaker_id, video_id, 0::BIGINT AS n, []::STRUCT(r BIGINT, a DOUBLE, b DOUBLE)[] AS kept FROM (SELECT DISTINCT speaker_id, video_id FROM s)
        UNION ALL
        SELECT p.speaker_id, p.video_id, x.n, CASE WHEN len(kept) < 20 AND len(list_filter(kept, lambda t: greatest(0, least(x."end", t.b) - greatest(x.start, t.a)) > 0.05::DOUBLE * (greatest(x."end", t.b) - least(x.start, t.a)))) = 0
            THEN list_append(kept, {'r': x.row_ord, 'a': x.start, 'b': x."end"}) ELSE kept END
        FROM step p JOIN x ON x.speaker_id = p.speaker_id AND x.video_id = p.video_id AND x.n = p.n + 1),
    done AS (SELECT * FROM step QUALIFY row_number() OVER (PARTITION BY speaker_id, video_id ORDER BY n DESC) = 1)
    SELECT speaker_id, video_id, CAST(i - 1 AS INTEGER) AS place, kept[i].r AS row_ord, kept[i].a AS start, kept[i].b AS "end" FROM (SELECT *, unnest(range(1, len(kept) + 1)) AS i FROM done)""", s=SEGMENTS)
def greedy_nms(spark, sf):
    return selection.suppress(bound(spark, sf, SEGMENTS), ["speaker_id", "video_id"], 0.05, 20)


_VISITS = "SELECT CAST(l_suppkey AS STRING) AS video_id, l_linenumber AS visit, count(*) AS n_candidates FROM {lineitem} GROUP BY l_suppkey, l_linenumber"


@query("""WITH+ , z AS (SELECT *, coalesce(sum(n_candidates) OVER (PARTITION BY video_id ORDER BY visit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far FROM v)
    SELECT video_id, visit, n_candidates, CAST(so_far AS BIGINT) AS so_far FROM z WHERE so_far < 40 OR visit < 3""", v=_VISITS)
def early_stop_budget(spark, sf):
    return selection.early_stop(bound(spark, sf, _VISITS), 40, 3)


# --- stats and validation --------------------------------------------------------------


@query("""WITH+ , p AS (SELECT speaker_id, count(*) FILTER (WHERE file_exists) AS n_clips, coalesce(sum(duration) FILTER (WHERE file_exists), 0) AS duration_sec, count(DISTINCT video_id) FILTER (WHERE file_exists) AS n_videos, count(*) FILTER (WHERE NOT file_exists) AS missing_files
        FROM c GROUP BY 1)
    SELECT CAST(c_custkey AS VARCHAR) AS speaker_id, coalesce(n_clips, 0) AS n_clips, round(coalesce(duration_sec, 0), 4) AS duration_sec, coalesce(n_videos, 0) AS n_videos, coalesce(missing_files, 0) AS missing_files
    FROM customer LEFT JOIN p ON p.speaker_id = CAST(c_custkey AS VARCHAR)""", c=CANDIDATES)
def speaker_coverage(spark, sf):
    speakers = read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("speaker_id"))
    return rounded(stats.coverage(speakers, bound(spark, sf, CANDIDATES)), "duration_sec", places=4)


_PER = "SELECT speaker_id, count(*) AS n_utterances, count(DISTINCT video_id) AS n_videos, sum(duration) AS duration_sec, avg(duration) AS mean_duration, avg(CASE WHEN isnan(snr_db) THEN NULL ELSE snr_db END) AS mean_snr, avg(vad_ratio) AS mean_vad FROM c GROUP BY 1"


@query(f"WITH+ , p AS ({_PER}) SELECT speaker_id, n_utterances, n_videos, round(duration_sec, 4) AS duration_sec, round(mean_duration, 6) AS mean_duration, round(mean_snr, 6) AS mean_snr, round(mean_vad, 6) AS mean_vad FROM p", c=CANDIDATES)
def speaker_stats(spark, sf):
    out = stats.speaker_stats(bound(spark, sf, CANDIDATES))
    return rounded(rounded(out, "duration_sec", places=4), "mean_duration", "mean_snr", "mean_vad")


@query("WITH+ SELECT speaker_id, video_id, count(*) AS n_utterances, round(sum(duration), 4) AS duration_sec FROM c GROUP BY 1, 2", c=CANDIDATES)
def video_stats(spark, sf):
    return rounded(stats.video_stats(bound(spark, sf, CANDIDATES)), "duration_sec", places=4)


@query(f"""WITH+ , p AS ({_PER}) SELECT (SELECT count(*) FROM p) AS n_speakers, count(DISTINCT video_id) AS n_videos, count(*) AS n_utterances, round(sum(duration) / 3600, 6) AS duration_hours, round(avg(duration), 6) AS mean_duration,
    (SELECT count(*) FROM p WHERE n_utterances < 590) AS speakers_below_min_utt, (SELECT count(*) FROM p WHERE n_utterances <> 600) AS speakers_not_exact_target, 590 AS min_utt_threshold FROM c""", c=CANDIDATES)
def dataset_summary(spark, sf):
    rows = bound(spark, sf, CANDIDATES)
    return rounded(stats.summary(stats.speaker_stats(rows), rows, 600, 590), "duration_hours", "mean_duration")


@query("SELECT CAST(l_suppkey AS VARCHAR) AS speaker_id, string_agg(v || '=' || n, ', ' ORDER BY v || '=' || n) AS distribution FROM (SELECT l_suppkey, l_returnflag || l_linestatus AS v, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def video_distribution(spark, sf):
    return stats.video_distribution(bound(spark, sf, CANDIDATES))


@query("SELECT CAST(l_suppkey AS VARCHAR) AS speaker_id, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1 HAVING count(*) >= 480")
def completed_speakers(spark, sf):
    return stats.completed(bound(spark, sf, CANDIDATES).withColumn("approved", (F.col("face_conf") > 0.6).cast("int")), 480)


@query("""WITH+ , h AS (SELECT count(*) AS n FROM c GROUP BY coalesce(trim(sha1), '') HAVING count(*) > 1),
    o AS (SELECT count(*) AS n FROM c a JOIN c b ON a.speaker_id = b.speaker_id AND a.video_id = b.video_id AND a.row_ord < b.row_ord AND a.start < b."end" AND b.start < a."end"
        WHERE (least(a."end", b."end") - greatest(a.start, b.start)) / (greatest(a."end", b."end") - least(a.start, b.start)) > 0.05::DOUBLE)
    SELECT 'version' AS rule, count(*) FILTER (WHERE pipeline_version IS NULL OR pipeline_version <> '1') AS violations FROM c
    UNION ALL SELECT 'verified', count(*) FILTER (WHERE syncnet_verified < 1) FROM c UNION ALL SELECT 'unambiguous', count(*) FILTER (WHERE syncnet_unambiguous < 1) FROM c
    UNION ALL SELECT 'duration', count(*) FILTER (WHERE duration > 3.001::DOUBLE) FROM c UNION ALL SELECT 'file', count(*) FILTER (WHERE NOT file_exists) FROM c
    UNION ALL SELECT 'sha1', CAST(coalesce(sum(n), 0) AS BIGINT) FROM h UNION ALL SELECT 'overlap', n FROM o""", c=CANDIDATES)
def validation_expectations(spark, sf):
    return stats.expectations(bound(spark, sf, CANDIDATES), "1", 3.0)


@query(r"""WITH+ SELECT row_ord, video_id || '_' || lpad(CAST(row_number() OVER (PARTITION BY speaker_id, video_id ORDER BY row_ord) - 1 AS VARCHAR), 5, '0') AS utterance_id,
    'wav/' || speaker_id || '/' || video_id || '/' || utterance_id || '.wav' AS export_path FROM c""", c=CANDIDATES)
def utterance_ids(spark, sf):
    rows = bound(spark, sf, CANDIDATES).withColumn("approved", F.lit(1)).withColumn("selection_rank", F.col("row_ord"))
    return candidates.with_utterances(rows).select("row_ord", "utterance_id", "export_path")


@query("""SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'wav/s/v/u' || page_id || '.wav' WHEN 1 THEN 'wav/s/v/' || page_id || '.wav' WHEN 2 THEN 'wav/a/' || page_id || '.wav' WHEN 3 THEN 'wav/b/' || page_id || '.wav' ELSE 'wav/c/' || page_id || '.wav' END AS path FROM pages""")
def canonical_paths(spark, sf):
    pages = read(spark, sf, "pages").withColumn("k", F.col("page_id").cast("string")).withColumn("r", F.col("page_id") % 5)
    named = F.when(F.col("r") == 0, F.concat(F.lit(" u"), "k")).when(F.col("r") == 1, F.concat("k", F.lit(".wav"))).when(F.col("r") == 2, "  ")
    exported = F.when(F.col("r") == 2, F.concat(F.lit("/data/out\\dev\\wav\\a/"), "k", F.lit(".wav"))).when(F.col("r") == 3, F.concat(F.lit("dev/wav/b/"), "k", F.lit(".wav"))).otherwise("elsewhere")
    kept = F.when(F.col("r") == 4, F.concat(F.lit("wav/c/"), "k", F.lit(".wav"))).otherwise("")
    return pages.select("page_id", canonical_path(F.lit(" s"), F.lit("v "), named, exported, kept).alias("path"))


@query("""WITH+ , r AS (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY syncnet_confidence, face_margin, snr_db NULLS LAST, row_ord) AS place FROM (SELECT * REPLACE (CASE WHEN isnan(snr_db) THEN NULL ELSE snr_db END AS snr_db) FROM c)),
    d AS (SELECT *, row_number() OVER (PARTITION BY speaker_id, place > 5 ORDER BY md5('2026|' || row_ord), row_ord) AS draw FROM r)
    SELECT speaker_id, row_ord, CASE WHEN place > 5 THEN 'draw' ELSE 'head' END AS part FROM d WHERE place <= 5 OR draw <= 5""", c=CANDIDATES)
def boundary_sample(spark, sf):
    return review.boundary_sample(bound(spark, sf, CANDIDATES), 10, "2026", "row_ord").select("speaker_id", "row_ord", "part")


# --- trials and metrics -----------------------------------------------------------------

_TARGETS = "WITH+ SELECT DISTINCT a.speaker_id, a.path AS path1, b.path AS path2 FROM c a JOIN c b ON a.speaker_id = b.speaker_id AND a.path < b.path AND a.video_id {} b.video_id"


@query(_TARGETS.format("="), c=CLIPS)
def trials_targets_a(spark, sf):
    return trials.target_pairs(bound(spark, sf, CLIPS), "A")


@query(_TARGETS.format("<>"), c=CLIPS)
def trials_targets_b(spark, sf):
    return trials.target_pairs(bound(spark, sf, CLIPS), "B")


@query(f"SELECT * FROM ({_TARGETS.format('<>')}) ORDER BY md5('2026-test-B|' || path1 || '|' || path2), path1, path2 LIMIT 500", c=CLIPS)
def trials_targets_sampled(spark, sf):
    return trials.sampled(trials.target_pairs(bound(spark, sf, CLIPS), "B"), "2026-test-B", 500)


_ONE = "SELECT CAST(c_custkey AS STRING) AS speaker_id, c_mktsegment AS gender, CAST(c_nationkey AS STRING) AS video_id, concat('c', CAST(c_custkey AS STRING)) AS path FROM {customer}"


@query("""WITH+ , n AS (SELECT *, lead(path) OVER w AS p2, lead(video_id) OVER w AS v2 FROM c WINDOW w AS (PARTITION BY gender ORDER BY md5('2026|' || path), path)),
    t AS (SELECT gender, least(path, p2) AS path1, greatest(path, p2) AS path2 FROM n WHERE p2 IS NOT NULL AND v2 <> video_id)
    SELECT * FROM t ORDER BY md5('2026|' || path1 || '|' || path2), path1, path2 LIMIT 300""", c=_ONE)
def trials_nontarget_hash(spark, sf):
    return trials.hash_non_targets(bound(spark, sf, _ONE), "2026", 300)


_DRAW = "('0x' || substr(md5('2026-test-A|{}|' || draw), 1, 8))::BIGINT % {}"


@query(f"""WITH+ , nb AS (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY speaker_id) - 1 AS k FROM (SELECT DISTINCT speaker_id, gender FROM c)),
    sz AS (SELECT gender, count(*) AS n FROM nb GROUP BY 1 HAVING count(*) > 1), rg AS (SELECT *, sum(n) OVER (ORDER BY gender) AS upto, sum(n) OVER () AS total FROM sz),
    a AS (SELECT draw, gender, n, u - (upto - n) AS k1 FROM (SELECT *, {_DRAW.format("a", "total")} AS u FROM (SELECT unnest(range(0, 3100)) AS draw), rg) WHERE u < upto AND u >= upto - n),
    b AS (SELECT *, (k1 + 1 + {_DRAW.format("b", "(n - 1)")}) % n AS k2 FROM a),
    l AS (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY path) - 1 AS i, count(*) OVER (PARTITION BY speaker_id) AS m FROM c),
    p AS (SELECT draw, b.gender, least(x.path, y.path) AS path1, greatest(x.path, y.path) AS path2 FROM b JOIN nb s ON s.gender = b.gender AND s.k = k1 JOIN nb t ON t.gender = b.gender AND t.k = k2
        JOIN l x ON x.speaker_id = s.speaker_id AND x.i = {_DRAW.format("c1", "x.m")} JOIN l y ON y.speaker_id = t.speaker_id AND y.i = {_DRAW.format("c2", "y.m")} WHERE x.video_id <> y.video_id)
    SELECT path1, path2, min(draw) AS draw, any_value(gender) AS gender FROM p GROUP BY 1, 2 ORDER BY draw LIMIT 2000""", c=CLIPS)
def trials_nontarget_draws(spark, sf):
    return trials.non_targets(bound(spark, sf, CLIPS), "2026-test-A", 2000)


_PAIRS = "SELECT CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS label, concat('c', CAST(user_id AS STRING)) AS path1, concat('c', CAST(event_id % 200 AS STRING)) AS path2 FROM {events}"


@query("WITH+ SELECT DISTINCT label, least(path1, path2) AS path1, greatest(path1, path2) AS path2 FROM t WHERE path1 <> path2", t=_PAIRS)
def unique_trials(spark, sf):
    return trials.unique_trials(bound(spark, sf, _PAIRS))


@query("WITH+ SELECT label, path1, path2, a.gender FROM (SELECT DISTINCT label, least(path1, path2) AS path1, greatest(path1, path2) AS path2 FROM t WHERE path1 <> path2) JOIN c a ON path1 = a.path JOIN c b ON path2 = b.path WHERE a.gender = b.gender", t=_PAIRS, c=_ONE)
def gender_subset_trials(spark, sf):
    return trials.gender_subset(trials.unique_trials(bound(spark, sf, _PAIRS)), bound(spark, sf, _ONE))


_SCORED = "SELECT l_returnflag AS model, CASE WHEN l_tax > 0.03 THEN 1 ELSE 0 END AS label, CAST(floor(l_quantity + l_tax * 200) AS DOUBLE) AS score FROM {lineitem}"
_ROC = """WITH+ , a AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM s GROUP BY 1, 2),
    r AS (SELECT model, score, sum(n) OVER w / sum(n) OVER (PARTITION BY model) AS x, 1 - sum(p) OVER w / sum(p) OVER (PARTITION BY model) AS y FROM a WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""


@query(f"{_ROC} SELECT model, score AS threshold, round(x, 6) AS fpr, round(y, 6) AS fnr FROM r", s=_SCORED)
def roc_points(spark, sf):
    return rounded(metrics.roc(bound(spark, sf, _SCORED), ["model"]), "fpr", "fnr")


@query(f"""{_ROC}, l AS (SELECT model, lag(x, 1, 0) OVER w AS x0, lag(y, 1, 1) OVER w AS y0, x, y FROM r WINDOW w AS (PARTITION BY model ORDER BY score DESC))
    SELECT model, round(min(x0 + CASE WHEN (y0 - x0) = (y - x) THEN 0 ELSE (y0 - x0) / ((y0 - x0) - (y - x)) END * (x - x0)), 6) AS eer FROM l WHERE y0 >= x0 AND y <= x GROUP BY 1""", s=_SCORED)
def eer_roc(spark, sf):
    return rounded(metrics.eer(bound(spark, sf, _SCORED), ["model"]), "eer")


@query(f"{_ROC} SELECT model, round(min(least(0.01::DOUBLE, 0.01::DOUBLE * y + 0.99::DOUBLE * x)) / 0.01::DOUBLE, 6) AS min_dcf FROM r GROUP BY 1", s=_SCORED)
def min_dcf(spark, sf):
    return rounded(metrics.min_dcf(bound(spark, sf, _SCORED), ["model"]), "min_dcf")


@query("SELECT l_returnflag AS model, l_linestatus AS trial, coalesce(CAST(l_linenumber AS VARCHAR), 'all') AS \"group\", count(*) AS n, round(avg(l_discount), 6) AS base, round(avg(l_tax), 6) AS adapted FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag, l_linestatus, l_linenumber))")
def metrics_grouping_sets(spark, sf):
    rows = read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("trial"), F.col("l_linenumber").alias("group"), "l_discount", "l_tax")
    out = metrics.grouping(rows, [["model", "trial"], ["model", "trial", "group"]], {"base": "l_discount", "adapted": "l_tax"})
    return rounded(out.withColumn("group", F.coalesce(F.col("group").cast("string"), F.lit("all"))), "base", "adapted")


# --- signals, sync and tracking -----------------------------------------------------------

_SERIES = "SELECT CAST(user_id AS STRING) AS probe_id, event_id AS frame, value AS raw FROM {events}"


@query("""WITH+ , q AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY probe_id) AS n FROM s WINDOW w AS (PARTITION BY probe_id ORDER BY frame)),
    k AS (SELECT a.probe_id, a.frame, b.raw FROM q a, (SELECT unnest(range(-4, 5)) AS d) JOIN q b ON b.probe_id = a.probe_id AND b.i = greatest(1, least(a.n, a.i + d)))
    SELECT probe_id, frame, median(raw) AS raw_median FROM k GROUP BY 1, 2""", s=_SERIES)
def running_median(spark, sf):
    return sync.edge_median(bound(spark, sf, _SERIES), "probe_id", Window.partitionBy("probe_id").orderBy("frame"), "raw", 9).select("probe_id", "frame", "raw_median")


@query("""WITH+ , q AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY probe_id) AS n FROM s WINDOW w AS (PARTITION BY probe_id ORDER BY frame)),
    k AS (SELECT a.probe_id, a.frame, b.raw FROM q a, (SELECT unnest(range(-5, 6)) AS d) JOIN q b ON b.probe_id = a.probe_id AND b.i = greatest(1, least(a.n, a.i + d)))
    SELECT probe_id, frame, round(avg(raw), 6) AS smooth FROM k GROUP BY 1, 2""", s=_SERIES)
def rolling_mean(spark, sf):
    rows = bound(spark, sf, _SERIES)
    return rows.select("probe_id", "frame", F.round(sync.smoothed(rows, "probe_id", "frame", F.col("raw"), 5), 6).alias("smooth"))


@query("SELECT CAST(user_id AS VARCHAR) AS speaker_id, round(quantile_cont(value, 0.35::DOUBLE), 6) AS p35, round(quantile_cont(value, 0.2::DOUBLE), 6) AS p20 FROM events GROUP BY 1")
def percentile_floor(spark, sf):
    return read(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("speaker_id")).agg(F.round(F.percentile("value", F.lit(0.35)), 6).alias("p35"), F.round(F.percentile("value", F.lit(0.2)), 6).alias("p20"))


@query("""WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
    SELECT vec_id, round(sqrt(list_avg(list_transform(v, lambda x: x * x)) + 1e-12::DOUBLE), 6) AS rms, round(list_max(list_transform(v, lambda x: abs(x))), 6) AS peak, round(len(list_filter(v, lambda x: abs(x) >= 0.2::DOUBLE)) / 64, 6) AS clipping FROM w""")
def signal_levels(spark, sf):
    v = arrays.doubles("embedding")
    return rounded(read(spark, sf, "embeddings").select("vec_id", arrays.rms(v).alias("rms"), arrays.peak(v).alias("peak"), arrays.clipping(v, 0.2).alias("clipping")), "rms", "peak", "clipping")


@query("SELECT conv_id, turn, role, lag(role) OVER w AS before, coalesce(len(text) - len(lag(text) OVER w), 0) AS change FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def consecutive_difference(spark, sf):
    order = Window.partitionBy("conv_id").orderBy("turn")
    return read(spark, sf, "conversations").select("conv_id", "turn", "role", F.lag("role").over(order).alias("before"), F.coalesce(F.length("text") - F.lag(F.length("text")).over(order), F.lit(0)).cast("long").alias("change"))


# --- references, identities and exports ---------------------------------------------------


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice * (o_orderkey % 7 + 1) DESC, o_orderkey) = 1")
def best_face_reference(spark, sf):
    rows = read(spark, sf, "orders").select("o_custkey", "o_orderkey", F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), F.col("o_totalprice").alias("x2"), F.lit(1.0).alias("y2"), (F.col("o_orderkey") % 7 + 1).alias("det_score"), F.col("o_orderkey").alias("face_ord"))
    return vectors.best_faces(rows, "o_custkey").select("o_custkey", "o_orderkey")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS speaker_id, 'known' AS origin FROM supplier WHERE s_acctbal > 0 UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'rival' FROM supplier WHERE s_nationkey < 10 AND NOT s_acctbal > 0")
def gallery_union(spark, sf):
    rows = read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("speaker_id"), "s_acctbal", "s_nationkey")
    return vectors.gallery(rows.where("s_acctbal > 0").select("speaker_id", F.lit("known").alias("origin")), rows.where("s_nationkey < 10").select("speaker_id", F.lit("rival").alias("origin")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN 0.6 + l_discount * 4 >= 0.75 AND l_returnflag <> 'N' AND l_tax > 0.02 THEN l_returnflag ELSE 'unknown' END AS speaker_id,
    CASE WHEN l_tax > 0.02 THEN l_quantity ELSE 0 END AS face_conf, 0.6 + l_discount * 4 >= 0.75 AND l_returnflag <> 'N' AND l_tax > 0.02 AS is_identified FROM lineitem""")
def identity_consistency(spark, sf):
    rows = read(spark, sf, "lineitem").select(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate", "l_suppkey", "l_extendedprice").alias("k"), "l_returnflag", "l_tax", "l_quantity", (0.6 + F.col("l_discount") * 4).alias("embedding_consistency"))
    found = rows.where("l_tax > 0.02").select("k", F.when(F.col("l_returnflag") == "N", "unknown").otherwise(F.col("l_returnflag")).alias("speaker_id"), F.col("l_quantity").alias("face_conf"), F.lit(0.0).alias("face_other_conf"), F.lit(0.1).alias("face_margin"))
    return vectors.with_consistency(found, rows, "k", 0.75).select("k.l_orderkey", "k.l_linenumber", "k.l_partkey", "speaker_id", "face_conf", "is_identified")


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'root/a' || page_id || '.wav' WHEN page_id % 3 = 1 THEN 'a' || page_id || '.wav' ELSE '' END AS source FROM pages")
def export_source_lookup(spark, sf):
    rows = read(spark, sf, "pages").select("page_id", F.concat(F.lit("a"), F.col("page_id").cast("string"), F.lit(".wav")).alias("audio_path"))
    listed = rows.where("page_id % 3 = 0").select(F.concat(F.lit("root/"), "audio_path").alias("path")).union(rows.where("page_id % 3 < 2").select("audio_path"))
    return candidates.located(rows, listed, "root").select("page_id", F.coalesce("source", F.lit("")).alias("source"))


@query("SELECT o_orderkey, coalesce(s_name, 'speaker ' || o_custkey) AS speaker_name, CASE WHEN s_suppkey IS NULL THEN 'unknown' ELSE CASE WHEN s_nationkey % 2 = 0 THEN 'f' ELSE 'm' END END AS gender FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey")
def name_lookup(spark, sf):
    rows = read(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("speaker_id"), F.concat(F.lit("speaker "), F.col("o_custkey").cast("string")).alias("speaker_name"))
    speakers = read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("speaker_id"), F.col("s_name").alias("name"), F.when(F.col("s_nationkey") % 2 == 0, "f").otherwise("m").alias("gender"))
    return candidates.with_names(rows, speakers).select("o_orderkey", "speaker_name", "gender")


@query("SELECT CAST(user_id AS VARCHAR) AS track_id, CASE WHEN count(*) >= 2 THEN round(least(1, median(value / 2000) / 0.035::DOUBLE), 6) ELSE 0 END AS visual_score FROM events GROUP BY 1")
def mouth_motion_score(spark, sf):
    rows = read(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("track_id")).agg(F.collect_list(F.col("value") / 2000).alias("d"))
    return rows.select("track_id", F.round(gates.visual_score(F.col("d")), 6).alias("visual_score"))


@query("""WITH a AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 100), t AS (SELECT user_id, event_type, avg(value) AS s FROM events GROUP BY 1, 2)
    SELECT user_id || event_type AS track_id FROM t WHERE EXISTS (SELECT 1 FROM a WHERE a.user_id = t.user_id AND a.event_type = t.event_type) OR (user_id NOT IN (SELECT user_id FROM a) AND s >= 20)""")
def active_track_fallback(spark, sf):
    rows = read(spark, sf, "events").select(F.concat(F.col("user_id").cast("string"), "event_type").alias("track_id"), F.col("user_id").cast("string").alias("video_id"), "value")
    tracks = rows.groupBy("track_id", "video_id").agg(F.avg("value").alias("avg_det_score"))
    return proposals.active_tracks(tracks, rows.withColumn("confidence", F.col("value")).where("value > 100"), 100.0, 20.0).select("track_id")


_WIN = "SELECT CAST(user_id AS STRING) AS track_id, floor(CAST({us} AS DOUBLE) / 10000000000) AS w, floor(CAST({us} AS DOUBLE) / 10000000000) * 1.0 AS start, floor(CAST({us} AS DOUBLE) / 10000000000) + 1.5 AS `end`, least(1, value / 60) AS confidence, 0.5 AS audio, 0.5 AS visual FROM {events}"


@query("""WITH+ , a AS (SELECT track_id, CAST(start AS DOUBLE) AS start, CAST("end" AS DOUBLE) AS "end", confidence FROM w WHERE confidence >= 0.30),
    f AS (SELECT *, max("end") OVER (PARTITION BY track_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM a),
    g AS (SELECT *, sum(CASE WHEN far IS NULL OR start > far + 1.10::DOUBLE THEN 1 ELSE 0 END) OVER (PARTITION BY track_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM f),
    m AS (SELECT track_id, min(start) AS start, max("end") AS "end", avg(confidence) AS confidence FROM g GROUP BY track_id, island)
    SELECT track_id, start, "end", round(confidence, 6) AS confidence FROM m WHERE "end" - start >= 2""", w=_WIN)
def speech_proposals(spark, sf):
    rows = bound(spark, sf, _WIN)
    rows = rows.select("track_id", *(F.col(c).cast("double").alias(c) for c in ("start", "end", "confidence", "audio", "visual")))
    return rounded(proposals.propose(rows, S).select("track_id", "start", "end", "confidence"), "confidence")


_UTT = "SELECT CAST(l_suppkey AS STRING) AS speaker_id, concat(l_returnflag, l_linestatus) AS video_id, concat('n', CAST(l_suppkey AS STRING)) AS speaker_name, CASE WHEN l_suppkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender, 'dev' AS `set`, l_quantity AS duration, concat('wav/', CAST(l_suppkey AS STRING), '/', l_returnflag, l_linestatus, '/', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '.wav') AS export_path, l_orderkey AS k FROM {lineitem}"


@query("""WITH+ SELECT speaker_id AS "Speaker ID", any_value(gender) AS "Gender", any_value("set") AS "Set", any_value(speaker_name) AS "Name", count(*) AS "Num utterances", count(DISTINCT video_id) AS "Num videos", round(sum(duration), 3) AS "Total duration" FROM u GROUP BY 1""", u=_UTT)
def speaker_metadata(spark, sf):
    return rounded(stats.speaker_metadata(bound(spark, sf, _UTT)), "Total duration", places=3)


@query("WITH+ SELECT speaker_id || ' ' || export_path AS value FROM u", u=_UTT)
def train_list(spark, sf):
    return candidates.train_list(bound(spark, sf, _UTT))


@query("WITH+ SELECT DISTINCT export_path AS path FROM u WHERE k % 5 = 0 AND speaker_id IN (SELECT speaker_id FROM u WHERE k % 5 <> 0) AND export_path NOT IN (SELECT export_path FROM u WHERE k % 5 <> 0)", u=_UTT)
def stale_exports(spark, sf):
    rows = bound(spark, sf, _UTT)
    kept = rows.where("k % 5 <> 0").withColumn("candidate_path", F.col("export_path")).withColumn("audio_path", F.col("export_path"))
    return candidates.copy_plan(kept, rows.select(F.col("export_path").alias("path")).distinct())[1]


def _fourth(spark, sf) -> DataFrame:
    return read(spark, sf, "supplier").where("s_suppkey % 4 = 0").select(F.col("s_suppkey").cast("string").alias("speaker_id"))


@query("WITH+ SELECT row_ord FROM c WHERE CAST(speaker_id AS INTEGER) % 4 <> 0 OR (coalesce(pipeline_version, 'legacy') = '1' AND syncnet_verified >= 1)", c=CANDIDATES)
def reprocess_filter(spark, sf):
    return gates.reprocess_filter(bound(spark, sf, CANDIDATES), _fourth(spark, sf), S).select("row_ord")


@query("WITH+ SELECT row_ord FROM c WHERE CAST(speaker_id AS INTEGER) % 4 <> 0", c=CANDIDATES)
def force_filter(spark, sf):
    return gates.force_filter(bound(spark, sf, CANDIDATES), _fourth(spark, sf)).select("row_ord")


@query("""SELECT CAST(c AS VARCHAR) AS speaker_id, c IN (SELECT s_suppkey FROM supplier) AS known FROM (SELECT DISTINCT o_custkey AS c FROM orders)""")
def speaker_subset(spark, sf):
    wanted = read(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("speaker_id")).distinct()
    found, unknown = manifest.subset(read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("speaker_id")), wanted)
    return found.select("speaker_id", F.lit(True).alias("known")).union(unknown.select("speaker_id", F.lit(False)))


@query("""WITH+ , p AS (SELECT speaker_id, count(*) FILTER (WHERE file_exists) AS n_clips, count(DISTINCT video_id) FILTER (WHERE file_exists) AS n_videos, count(*) FILTER (WHERE NOT file_exists) AS n_missing FROM c GROUP BY 1)
    SELECT speaker_id, n_clips FROM p WHERE n_clips <> 545 OR n_videos < 6""", c=CANDIDATES)
def export_gate(spark, sf):
    rows = bound(spark, sf, CANDIDATES)
    return stats.export_gate(stats.coverage(rows.select("speaker_id").distinct(), rows), 545, 6).select("speaker_id", "n_clips")


_BOX = "SELECT o_orderkey, CAST(o_orderkey % 90 AS DOUBLE) AS x, CAST(o_custkey % 70 AS DOUBLE) AS y, 20 + CAST(o_orderkey % 60 AS DOUBLE) AS w FROM {orders}"


@query("""WITH+ , k AS (SELECT *, greatest(0, round_even(x + w / 2 - w * 0.9::DOUBLE, 0)) AS a, greatest(0, round_even(y + w / 2 - w * 0.9::DOUBLE, 0)) AS b2, least(200, round_even(x + w / 2 + w * 0.9::DOUBLE, 0)) AS c2, least(150, round_even(y + w / 2 + w * 0.9::DOUBLE, 0)) AS d2 FROM b)
    SELECT o_orderkey, round(greatest(0, least(x + w, 100) - greatest(x, 40)) * greatest(0, least(y + w, 100) - greatest(y, 40)) / (w * w + 3600 - greatest(0, least(x + w, 100) - greatest(x, 40)) * greatest(0, least(y + w, 100) - greatest(y, 40)) + 1e-6::DOUBLE), 6) AS iou,
    CAST(CASE WHEN c2 - a >= 32 AND d2 - b2 >= 32 THEN c2 - a ELSE -1 END AS INTEGER) AS crop_width FROM k""", b=_BOX)
def box_geometry(spark, sf):
    box = box_of(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("w"))
    crop = crop_box(box, 0.4, 200.0, 150.0)
    width = F.coalesce(crop["x2"] - crop["x1"], F.lit(-1))
    other = box_of(*(F.lit(v) for v in (40.0, 40.0, 100.0, 100.0)))
    return bound(spark, sf, _BOX).select("o_orderkey", F.round(bbox_iou(box, other), 6).alias("iou"), width.alias("crop_width"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(greatest(0, least(1, (ln(1 + 1000 * l_discount) - ln(1 + 1000 * 0.003::DOUBLE)) / 3)), 6) AS audio,
    round(CASE WHEN l_tax > 0 THEN sqrt(l_discount * l_tax) ELSE 0 END, 6) AS fused FROM lineitem""")
def activity_scores(spark, sf):
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(gates.audio_score(F.col("l_discount"), F.lit(0.003)), 6).alias("audio"), F.round(gates.fused_confidence(F.col("l_discount"), F.col("l_tax")), 6).alias("fused"))


@query("""WITH+ , i AS (SELECT track_id, start_time, end_time, unnest(range(0, CAST(floor(greatest(0, end_time - start_time - 1) / 0.5::DOUBLE + 1e-9::DOUBLE) AS BIGINT) + 1)) AS i FROM t)
    SELECT track_id, round(start_time + i * 0.5::DOUBLE, 6) AS start, round(least(end_time, start_time + i * 0.5::DOUBLE + 1), 6) AS "end" FROM i""", t=_TRACKS)
def sliding_score_windows(spark, sf):
    return rounded(proposals.score_windows(bound(spark, sf, _TRACKS), 1.0, 0.5), "start", "end")


from . import catalogue_details, catalogue_files  # noqa: E402, F401  (they register theirs)
