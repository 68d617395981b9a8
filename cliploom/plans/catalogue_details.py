"""More of the catalogue: signals, sync, tracks, boxes, small aggregates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import arrays, columns
from ..operators import audio, candidates, chain, gates, intervals, manifest, proposals, rejections, review, selection, stats, sync, tracking, trials, vectors
from .bindings import CANDIDATES, CLIPS, bound
from .registry import S, query, read, rounded

# --- signals ------------------------------------------------------------------------

_V = "e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_RMS = "sqrt(list_avg(list_transform({}, lambda x: x * x)) + 1e-12::DOUBLE)"


@query(f"""WITH {_V}, l AS (SELECT *, list_transform(range(0, 15), lambda k: {_RMS.format("v[k * 4 + 1 : k * 4 + 8]")}) AS levels FROM e),
    b AS (SELECT *, greatest(list_aggregate(levels, 'quantile_cont', 0.35::DOUBLE), 0.003::DOUBLE) AS bar FROM l),
    m AS (SELECT *, list_filter(range(0, 64), lambda i: len(list_filter(range(0, 15), lambda k: k * 4 <= i AND i < k * 4 + 8 AND levels[k + 1] >= bar)) > 0) AS loud FROM b),
    q AS (SELECT *, list_filter(range(0, 64), lambda i: NOT list_contains(loud, i)) AS still FROM m)
    SELECT vec_id, round(len(loud) / 64, 6) AS vad_ratio, round(CASE WHEN len(loud) = 0 THEN -99 WHEN len(still) = 0 THEN 30
        ELSE 10 * log10((list_avg(list_transform(loud, lambda i: v[i + 1] * v[i + 1])) + 1e-12::DOUBLE) / (list_avg(list_transform(still, lambda i: v[i + 1] * v[i + 1])) + 1e-12::DOUBLE)) END, 6) AS snr_db FROM q""")
def energy_vad_snr(spark, sf):
    own = Settings(vad_frame_ms=8.0)
    levels = audio.measured(read(spark, sf, "embeddings").select("vec_id", "embedding"), own, 1000, "embedding")
    return rounded(levels.select("vec_id", "vad_ratio", "snr_db"), "vad_ratio", "snr_db")


@query(f"""WITH {_V}, c AS (SELECT vec_id, v, CAST(floor((vec_id % 4) / 4 * 32) AS INTEGER) AS a, least(64, CAST(floor(((vec_id % 4) / 4 + 0.3::DOUBLE + (vec_id % 7) / 5) * 32) AS INTEGER)) AS b FROM e),
    x AS (SELECT *, v[a + 1 : b] AS s FROM c), r AS (SELECT *, len(s) / 32 AS duration, {_RMS.format("s")} AS rms FROM x)
    SELECT vec_id, round(duration, 6) AS duration, round(rms, 6) AS rms, round(list_max(list_transform(s, lambda z: abs(z))), 6) AS peak,
        CASE WHEN duration < 0.5::DOUBLE THEN 'short' WHEN rms < 0.125::DOUBLE THEN 'rms' ELSE 'accepted' END AS reject_reason FROM r""")
def segment_filter(spark, sf):
    rows = read(spark, sf, "embeddings")
    sound = rows.select(F.col("vec_id").alias("path"), F.col("embedding").alias("samples"))
    start = (F.col("vec_id") % 4) / 4
    segments = rows.select("vec_id", F.col("vec_id").alias("path"), start.alias("start"), (start + 0.3 + (F.col("vec_id") % 7) / 5).alias("end"))
    own = Settings(vad_frame_ms=4000.0, min_rms=0.125)  # no frame is so long: all is speech
    found = audio.judged(segments, sound, own, 32, key="vec_id")
    return rounded(found.select("vec_id", "duration", "rms", "peak", "reject_reason"), "duration", "rms", "peak")


@query(f"""WITH {_V}, f AS (SELECT *, greatest(list_aggregate(list_transform(range(0, 7), lambda k: {_RMS.format("v[k * 8 + 1 : k * 8 + 8]")}), 'quantile_cont', 0.2::DOUBLE), 1e-6::DOUBLE) AS floor FROM e)
    SELECT vec_id, round(floor, 6) AS noise_floor, round(greatest(0, least(1, (ln(1 + 1000 * {_RMS.format("v[11:30]")}) - ln(1 + 1000 * floor)) / 3)), 6) AS audio FROM f""")
def noise_floors(spark, sf):
    rows = read(spark, sf, "embeddings")
    sound = rows.select(F.col("vec_id").alias("path"), F.col("embedding").alias("samples"))
    windows = rows.select("vec_id", F.col("vec_id").alias("path"), F.lit(0.25).alias("start"), F.lit(0.75).alias("end"))
    floor = rows.select("vec_id", arrays.noise_floor(arrays.doubles("embedding"), 40).alias("noise_floor"))
    return rounded(floor.join(audio.activity(windows, sound, 40).select("vec_id", "audio"), "vec_id"), "noise_floor", "audio")


@query(f"""WITH {_V} SELECT a.vec_id, round(list_cosine_similarity(a.v, b.v), 6) AS cosine, round(list_distance(a.v, b.v), 6) AS euclidean FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""")
def vector_distances(spark, sf):
    rows = read(spark, sf, "embeddings").select("vec_id", arrays.doubles("embedding").alias("a"))
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    a, b = F.col("a"), F.col("b")
    return rounded(rows.join(after, "vec_id").select("vec_id", arrays.cosine(a, b).alias("cosine"), arrays.euclidean(a, b).alias("euclidean")), "cosine", "euclidean")


@query(f"""WITH {_V}, d AS (SELECT vec_id, list_avg(list_transform(range(1, 65), lambda i: abs(v[i] - lag_v[i]))) / 255 AS difference FROM (SELECT *, lag(v) OVER (PARTITION BY vec_id % 10 ORDER BY vec_id) AS lag_v FROM e))
    SELECT vec_id, round(coalesce(difference, -1), 9) AS difference FROM d""")
def frame_differences(spark, sf):
    rows = read(spark, sf, "embeddings").withColumn("track", F.col("vec_id") % 10)
    out = intervals.differences(rows, ["track"], "vec_id", "embedding")
    return out.select("vec_id", F.round(F.coalesce("difference", F.lit(-1.0)), 9).alias("difference"))


# --- sync ---------------------------------------------------------------------------

_DIST = "SELECT CAST(label AS STRING) AS probe_id, CAST(vec_id AS INT) AS frame, embedding AS dist FROM {embeddings}"
_SHIFTS = "list_transform(dist[1:21], lambda x: x::DOUBLE)"
#: SQL of an edge-padded running median of 9 of column raw of table {0}, as {1}.
_MEDIAN = """{0}_i AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY probe_id) AS n FROM {0} WINDOW w AS (PARTITION BY probe_id ORDER BY frame)),
    {1} AS (SELECT a.probe_id, a.frame, median(b.raw) AS confidence FROM {0}_i a, (SELECT unnest(range(-4, 5)) AS d) JOIN {0}_i b ON b.probe_id = a.probe_id AND b.i = greatest(1, least(a.n, a.i + d)) GROUP BY 1, 2)"""
#: SQL of frame-wise raw confidences and offsets of table d (probe_id, frame, v of 21 shifts).
_LOCAL = f"""q AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY probe_id) AS n FROM d WINDOW w AS (PARTITION BY probe_id ORDER BY frame)),
    k AS (SELECT a.probe_id, a.frame, unnest(range(1, 22)) AS s, unnest(b.v) AS x FROM q a, (SELECT unnest(range(-25, 26)) AS o) JOIN q b ON b.probe_id = a.probe_id AND b.i = greatest(1, least(a.n, a.i + o))),
    m AS (SELECT probe_id, frame, s, avg(x) AS x FROM k GROUP BY 1, 2, 3), z AS (SELECT probe_id, frame, list(x ORDER BY s) AS sm FROM m GROUP BY 1, 2),
    p AS (SELECT *, list_position(sm, list_min(sm)) AS best FROM z),
    raw AS (SELECT p.probe_id, p.frame, CAST(11 - best AS INTEGER) AS "offset", CASE WHEN abs(11 - best) > 3 THEN -99 ELSE list_aggregate(sm, 'median') - v[best] END AS raw FROM p JOIN d ON d.probe_id = p.probe_id AND d.frame = p.frame),
    {_MEDIAN.format("raw", "conf")}, fr AS (SELECT probe_id, frame, confidence, "offset" FROM conf JOIN raw USING (probe_id, frame))"""


def _segments_sql(threshold: float, bridge: int, span: int, active: int, share: float) -> str:
    """SQL of segments of table fr (probe_id, frame, confidence, offset) in probes pr
    (probe_id, duration), as table sg."""
    return f"""h AS (SELECT *, confidence >= {threshold} AND abs("offset") <= 3 AS high FROM fr),
    h1 AS (SELECT *, sum(CASE WHEN high IS DISTINCT FROM was THEN 1 ELSE 0 END) OVER (PARTITION BY probe_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(high) OVER (PARTITION BY probe_id ORDER BY frame) AS was FROM h)),
    h2 AS (SELECT *, high OR (run > 1 AND run < max(run) OVER (PARTITION BY probe_id) AND count(*) OVER (PARTITION BY probe_id, run) <= {bridge}) AS bridged FROM h1),
    h3 AS (SELECT *, sum(CASE WHEN bridged IS DISTINCT FROM was2 THEN 1 ELSE 0 END) OVER (PARTITION BY probe_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run2 FROM (SELECT *, lag(bridged) OVER (PARTITION BY probe_id ORDER BY frame) AS was2 FROM h2)),
    rn AS (SELECT probe_id, run2, min(frame) AS f, max(frame) AS l, count(*) FILTER (WHERE high) AS n_high FROM h3 WHERE bridged GROUP BY 1, 2),
    lg AS (SELECT rn.probe_id, duration, (f + 2) / 25.0::DOUBLE AS a, least(duration, (l + 3) / 25.0::DOUBLE) AS b FROM rn JOIN pr USING (probe_id) WHERE l - f + 1 >= {span} AND n_high >= {active}),
    ct AS (SELECT probe_id, unnest(CASE WHEN b - a <= 3 THEN [{{'s': greatest(0, least((a + b) / 2 - least(greatest(b - a, 2), 3, duration) / 2, duration - least(greatest(b - a, 2), 3, duration))), 'e': greatest(0, least((a + b) / 2 - least(greatest(b - a, 2), 3, duration) / 2, duration - least(greatest(b - a, 2), 3, duration))) + least(greatest(b - a, 2), 3, duration)}}]
        ELSE list_transform(range(0, CAST(floor((b - a) / 3 + 1e-9::DOUBLE) AS BIGINT) + CASE WHEN b - a - floor((b - a) / 3 + 1e-9::DOUBLE) * 3 >= 2 - 1e-9::DOUBLE THEN 1 ELSE 0 END), lambda i: {{'s': a + i * 3, 'e': least(b, a + (i + 1) * 3)}}) END) AS w FROM lg),
    od AS (SELECT probe_id, w.s AS start, w.e AS "end", row_number() OVER (PARTITION BY probe_id ORDER BY w.s) - 1 AS ordinal FROM ct),
    ms AS (SELECT od.probe_id, ordinal, start, "end", avg(CASE WHEN high THEN 1 ELSE 0 END) AS high_ratio, median(confidence) FILTER (WHERE high) AS confidence, list("offset" ORDER BY "offset") FILTER (WHERE high) AS os
        FROM od JOIN h ON h.probe_id = od.probe_id AND frame >= floor(start * 25) - 2 AND frame < ceil("end" * 25) - 2 GROUP BY ALL),
    mo AS (SELECT *, (list_max(list_transform(list_distinct(os), lambda o: {{'n': len(list_filter(os, lambda x: x = o)), 'o': -o}}))) AS top FROM ms WHERE high_ratio >= 0.30::DOUBLE),
    sg AS (SELECT probe_id, ordinal, start, "end", confidence, high_ratio, CAST(-(top.o) AS INTEGER) AS offset_frames FROM mo WHERE top.n / len(os) >= {share}::DOUBLE)"""


@query(f"WITH+ , d AS (SELECT probe_id, frame, {_SHIFTS} AS v FROM t), {_LOCAL} SELECT probe_id, frame, \"offset\", round(confidence, 6) AS confidence FROM fr", t=_DIST)
def sync_framewise(spark, sf):
    return rounded(sync.framewise(bound(spark, sf, _DIST), S), "confidence")


@query(f"""WITH+ , d AS (SELECT probe_id, frame, {_SHIFTS} AS v FROM t), g AS (SELECT probe_id, s, avg(x) AS x FROM (SELECT probe_id, unnest(range(1, 22)) AS s, unnest(v) AS x FROM d) GROUP BY 1, 2),
    m AS (SELECT probe_id, list(x ORDER BY s) AS means FROM g GROUP BY 1), b AS (SELECT probe_id, list_position(means, list_min(means)) AS best, list_aggregate(means, 'median') AS base FROM m),
    raw AS (SELECT d.probe_id, frame, base - v[best] AS raw FROM d JOIN b USING (probe_id)), {_MEDIAN.format("raw", "conf")}
    SELECT probe_id, frame, round(confidence, 6) AS confidence FROM conf""", t=_DIST)
def global_framewise(spark, sf):
    return rounded(sync.global_framewise(bound(spark, sf, _DIST), S), "confidence")


@query("""WITH+ , g AS (SELECT probe_id, s, avg(x) AS x, min(x) AS least FROM (SELECT probe_id, unnest(range(1, 22)) AS s, unnest(list_transform(dist[1:21], lambda x: x::DOUBLE)) AS x FROM t) GROUP BY 1, 2),
    m AS (SELECT probe_id, list(x ORDER BY s) AS means FROM g GROUP BY 1), n AS (SELECT probe_id, min(x::DOUBLE) AS min_distance FROM (SELECT probe_id, unnest(dist) AS x FROM t) GROUP BY 1)
    SELECT probe_id, CAST(11 - list_position(means, list_min(means)) AS INTEGER) AS "offset", round(list_aggregate(means, 'median') - list_min(means), 6) AS confidence, round(min_distance, 6) AS min_distance FROM m JOIN n USING (probe_id)""", t=_DIST)
def probe_scores(spark, sf):
    found = sync.global_scores(bound(spark, sf, _DIST), S).select("probe_id", "offset", "confidence", "min_distance")
    return rounded(found, "confidence", "min_distance")


_FRAMES = "SELECT CAST(user_id AS STRING) AS probe_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INT) AS frame, value / 2 AS confidence, CAST(event_id % 5 - 2 AS INT) AS `offset` FROM {events}"


@query(f"""WITH+ , pr AS (SELECT probe_id, count(*) / 25.0::DOUBLE + 0.2::DOUBLE AS duration FROM fr GROUP BY 1), {_segments_sql(4.0, 10, 20, 10, 0.2)}
    SELECT probe_id, CAST(ordinal AS INTEGER) AS ordinal, round(start, 6) AS start, round("end", 6) AS "end", round(confidence, 6) AS confidence, round(high_ratio, 6) AS high_ratio, offset_frames FROM sg""", fr=_FRAMES)
def sync_segments(spark, sf):
    frames = bound(spark, sf, _FRAMES)
    probes = frames.groupBy("probe_id").agg((F.count("*") / 25.0 + 0.2).alias("duration"))
    own = Settings(sync_bridge_seconds=0.4, sync_offset_share=0.2, sync_min_span_seconds=0.8, sync_min_active_seconds=0.4)
    return rounded(sync.segments(frames, probes, own), "start", "end", "confidence", "high_ratio")


#: A probe of which one shift is nearer than the others, by as much as an event's value.
_NEAR = "SELECT CAST(user_id AS STRING) AS probe_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INT) AS frame, CAST(user_id % 21 AS INT) AS near, value FROM {events}"


@query(f"""WITH+ , d AS (SELECT probe_id, frame, list_transform(range(0, 21), lambda i: CASE WHEN i = near THEN 10 - value / 5 ELSE 10 + i * 0.01::DOUBLE END) AS v FROM t), {_LOCAL},
    pr AS (SELECT probe_id, count(*) / 25.0::DOUBLE + 0.2::DOUBLE AS duration FROM fr GROUP BY 1), {_segments_sql(4.0, 8, 30, 20, 0.6)},
    bs AS (SELECT probe_id, arg_max(offset_frames, confidence * 1000 - ordinal / 1000) AS o FROM sg GROUP BY 1), g AS (SELECT probe_id, s, avg(x) AS x FROM (SELECT probe_id, unnest(range(1, 22)) AS s, unnest(v) AS x FROM d) GROUP BY 1, 2),
    mn AS (SELECT probe_id, list(x ORDER BY s) AS means FROM g GROUP BY 1)
    SELECT probe_id, o IS NOT NULL AS accepted, CAST(coalesce(o, 11 - list_position(means, list_min(means))) AS INTEGER) AS offset_frames, CASE WHEN o IS NULL THEN 'no_sustained_local_sync' ELSE 'local_framewise_ok' END AS reason,
        round(list_aggregate(means, 'median') - list_min(means), 6) AS confidence FROM mn LEFT JOIN bs USING (probe_id)""", t=_NEAR)
def probe_verification(spark, sf):
    rows = bound(spark, sf, _NEAR)
    shift = lambda i: F.when(F.col("near") == i, 10 - F.col("value") / 5).otherwise(F.lit(10 + i * 0.01))
    distances = rows.select("probe_id", "frame", F.array(*(shift(i) for i in range(21))).alias("dist"))
    probes = rows.groupBy("probe_id").agg((F.count("*") / 25.0 + 0.2).alias("duration"))
    found = sync.verify(distances, probes, S)[1].select("probe_id", "accepted", "offset_frames", "reason", "confidence")
    return rounded(found, "confidence")


@query("""SELECT o_orderkey AS segment_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber <= 2 AND l_discount > 0.05)""")
def ambiguous_segments(spark, sf):
    segments = read(spark, sf, "orders").select(F.col("o_orderkey").alias("segment_id"))
    rivals = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("segment_id"), F.col("l_linenumber").alias("track_id"), "l_discount")
    checked = rivals.where("track_id <= 2")
    return sync.unambiguous(segments, checked, rivals.select("segment_id", "track_id", (F.col("l_discount") > 0.05).alias("accepted")).where("track_id <= 2"))


_CLIP = "SELECT CAST(user_id AS STRING) AS track_id, CAST(event_id % 300 AS INT) AS frame FROM {events} GROUP BY user_id, CAST(event_id % 300 AS INT)"


@query("""WITH+ , r AS (SELECT track_id, min(frame) AS a, max(frame) AS b FROM p GROUP BY 1), q AS (SELECT track_id, a, b, CAST(track_id AS BIGINT) % 40 AS start, 4 + CAST(track_id AS BIGINT) % 9 AS duration FROM r),
    k AS (SELECT *, unnest(range(0, CAST(floor(duration * 25) AS BIGINT))) AS k FROM q), v AS (SELECT track_id, count(*) AS total, count(*) FILTER (WHERE (start + k / 25.0::DOUBLE) * 5 BETWEEN a - 5 AND b + 5) AS written FROM k GROUP BY 1)
    SELECT track_id AS probe_id, total, written, written >= greatest(10, floor(total * 0.8::DOUBLE)) AS complete FROM v""", p=_CLIP)
def clip_completeness(spark, sf):
    points = bound(spark, sf, _CLIP).select("track_id", "frame", *(F.lit(v).alias(c) for c, v in zip(columns.CORNERS, (100.0, 100.0, 300.0, 320.0), strict=True)))
    key = F.col("track_id").cast("long")
    probes = points.select("track_id").distinct().select(F.col("track_id").alias("probe_id"), "track_id", (key % 40).cast("double").alias("start"), (4 + key % 9).cast("double").alias("duration"))
    return sync.complete_clips(sync.clip_frames(probes, points, S))


# --- tracks and boxes ---------------------------------------------------------------

_FACES = "SELECT event_type AS window_id, CAST(floor(event_id / 50) AS INT) AS frame, user_id FROM {events} GROUP BY event_type, CAST(floor(event_id / 50) AS INT), user_id"


def _detections(spark, sf, wide) -> DataFrame:
    x = F.col("user_id") * 200.0
    box = columns.box_of(*(c.cast("float") for c in (x, F.lit(0.0), x + wide, F.lit(90.0))))
    vector = F.array(F.lit(1.0), F.col("user_id") % 3 * 0.1).cast("array<float>")
    return bound(spark, sf, _FACES).select("window_id", "frame", F.col("user_id").cast("int").alias("face_ord"), box.alias("bbox"), vector.alias("embedding"), F.lit(0.9).alias("det_score"))


@query("""WITH+ , g AS (SELECT *, sum(CASE WHEN was IS NULL OR frame - was > 6 THEN 1 ELSE 0 END) OVER (PARTITION BY window_id, user_id ORDER BY frame ROWS UNBOUNDED PRECEDING) AS part FROM (SELECT *, lag(frame) OVER (PARTITION BY window_id, user_id ORDER BY frame) AS was FROM f)),
    t AS (SELECT window_id, user_id, part, min(frame) AS a, max(frame) AS b, count(*) AS n FROM g GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY a, user_id) AS number FROM t)
    SELECT window_id, window_id || '_track_' || lpad(CAST(number AS VARCHAR), 4, '0') AS track_id, a AS start_frame, b AS end_frame, n AS n_points, round(a / 5, 6) AS start_time, round(b / 5, 6) AS end_time, round((b - a) / 5, 6) AS duration,
        round(n / (b - a + 1), 6) AS track_coverage, 1.0::DOUBLE AS embedding_consistency, round(1 / sqrt(1 + (user_id % 3 * 0.1::DOUBLE) * (user_id % 3 * 0.1::DOUBLE)), 6) AS first FROM k WHERE n >= 2""", f=_FACES)
def greedy_tracking(spark, sf):
    own = Settings(track_min_points=2)
    found = tracking.tracks(tracking.track(_detections(spark, sf, 90.0), own), own)
    told = found.withColumn("first", F.col("avg_emb")[0]).drop("avg_emb", "avg_det_score")
    return rounded(told, "start_time", "end_time", "duration", "track_coverage", "embedding_consistency", "first")


@query("WITH+ SELECT window_id, max(user_id % 3) > 0 AS normal, count(*) FILTER (WHERE user_id % 3 > 0) AS n_points FROM f WHERE window_id <> 'view' GROUP BY 1 UNION ALL SELECT window_id, false, count(*) FROM f WHERE window_id = 'view' GROUP BY 1", f=_FACES)
def recovery_tracks(spark, sf):
    """Faces of every third user are small; the window 'view' holds small ones only."""
    wide = F.when((F.col("user_id") % 3 == 0) | (F.col("window_id") == "view"), 60.0).otherwise(90.0)
    points = tracking.with_recovery(_detections(spark, sf, wide), S, lambda found: found)
    normal = ~F.col("track_id").contains("_recovery_")
    return points.groupBy("window_id").agg(F.max(normal).alias("normal"), F.count("*").alias("n_points"))


_MEDOIDS = f"""WITH {_V.replace("vec_id,", "vec_id, label,")}, u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM e),
    k AS (SELECT a.label, a.vec_id, quantile_cont(list_dot_product(a.u, b.u), 0.5) AS likeness FROM u a JOIN u b USING (label) GROUP BY 1, 2),
    m AS (SELECT label, vec_id AS medoid FROM k QUALIFY row_number() OVER (PARTITION BY label ORDER BY round(likeness, 9) DESC, vec_id) = 1),
    near AS (SELECT u.*, u.vec_id % 5 / 10 AS w FROM u JOIN m USING (label) JOIN u c ON c.vec_id = m.medoid WHERE list_dot_product(u.u, c.u) >= 0.05::DOUBLE)"""


@query(f"""{_MEDOIDS}, d AS (SELECT label, i, sum(w * u[i]) / sum(w) AS x FROM (SELECT label, w, u, unnest(range(1, 65)) AS i FROM near) GROUP BY 1, 2), t AS (SELECT label, list(x ORDER BY i) AS v FROM d GROUP BY 1),
    n AS (SELECT label, count(*) AS n FROM near GROUP BY 1), a AS (SELECT label, count(*) AS total FROM u GROUP BY 1)
    SELECT CAST(label AS VARCHAR) AS track_id, round(n / total, 6) AS embedding_consistency, round(v[1] / sqrt(list_dot_product(v, v)), 6) AS first FROM t JOIN n USING (label) JOIN a USING (label)""")
def track_templates(spark, sf):
    rows = read(spark, sf, "embeddings").select("vec_id", "label", arrays.unit(arrays.doubles("embedding")).alias("u"))
    points = rows.select(F.lit("w").alias("window_id"), F.col("label").cast("string").alias("track_id"), F.col("vec_id").alias("frame"), F.lit(0).alias("face_ord"), (F.col("vec_id") % 5 / 10).alias("det_score"), "u")
    found = tracking.templates(points, 0.05)
    return rounded(found.select("track_id", "embedding_consistency", F.col("avg_emb")[0].alias("first")), "embedding_consistency", "first")


_RECT = "SELECT o_orderkey, CAST(o_orderkey % 90 AS DOUBLE) AS x, CAST(o_custkey % 70 AS DOUBLE) + 0.5 AS y, CAST(o_orderkey % 61 AS DOUBLE) - 20 AS w FROM {orders}"


@query("""WITH+ , r AS (SELECT o_orderkey, x, y, CASE WHEN w <= x OR y + 30 <= y THEN x + greatest(1, w) ELSE w END AS x2, CASE WHEN w <= x THEN y + y + 30 ELSE y + 30 END AS y2 FROM b),
    i AS (SELECT o_orderkey, x2, y2, greatest(0, trunc(x)) AS a, greatest(0, trunc(y)) AS b, least(119, trunc(x2)) AS c, least(89, trunc(y2)) AS d, trunc(x) AS fx, trunc(y) AS fy, trunc(x2) AS gx, trunc(y2) AS gy FROM r),
    m AS (SELECT *, a + trunc(0.2::DOUBLE * (c - a)) AS l, c - trunc(0.2::DOUBLE * (c - a)) AS rr, b + trunc(0.55::DOUBLE * (d - b)) AS t, b + trunc(0.92::DOUBLE * (d - b)) AS lo FROM i),
    z AS (SELECT *, greatest(0, l - trunc(0.35::DOUBLE * (rr - l))) AS ma, greatest(0, t - trunc(0.35::DOUBLE * (lo - t))) AS mb, least(120, rr + trunc(0.35::DOUBLE * (rr - l))) AS mc, least(90, lo + trunc(0.35::DOUBLE * (lo - t))) AS md,
        greatest(0, fx - trunc((gx - fx) * 0.3::DOUBLE)) AS ca, greatest(0, fy - trunc((gy - fy) * 0.3::DOUBLE)) AS cb, least(120, gx + trunc((gx - fx) * 0.3::DOUBLE)) AS cc, least(90, gy + trunc((gy - fy) * 0.3::DOUBLE)) AS cd FROM m)
    SELECT o_orderkey, x2, y2, CASE WHEN c > a AND d > b AND mc > ma AND md > mb THEN concat_ws(',', CAST(ma AS INT), CAST(mb AS INT), CAST(mc AS INT), CAST(md AS INT)) ELSE '' END AS mouth,
        CASE WHEN cc > ca AND cd > cb THEN concat_ws(',', CAST(ca AS INT), CAST(cb AS INT), CAST(cc AS INT), CAST(cd AS INT)) ELSE '' END AS crop FROM z""", b=_RECT)
def face_boxes(spark, sf):
    rows = bound(spark, sf, _RECT).withColumn("box", columns.corner_box(columns.box_of(F.col("x"), F.col("y"), F.col("w"), F.col("y") + 30)))
    said = lambda b: F.coalesce(F.when(b.isNotNull(), F.concat_ws(",", *(b[c].cast("string") for c in columns.CORNERS))), F.lit(""))
    box = F.col("box")
    return rows.select("o_orderkey", box["x2"].alias("x2"), box["y2"].alias("y2"), said(columns.mouth_box(box, 120, 90)).alias("mouth"), said(columns.face_crop(box, 120, 90)).alias("crop"))


_TRACKS = "SELECT concat(CAST(user_id AS STRING), event_type) AS track_id, CAST(user_id AS STRING) AS window_id, concat('s', CAST(user_id % 7 AS STRING)) AS speaker_id, min(CAST(event_id % 300 AS INT)) AS start_frame, max(CAST(event_id % 300 AS INT)) AS end_frame, max(value) AS face_conf, -1.0 AS face_other_conf, 0.5 AS face_margin, 0.9 AS face_track_consistency FROM {events} GROUP BY user_id, event_type"
_POINTS = "SELECT concat(CAST(user_id AS STRING), event_type) AS track_id, CAST(event_id % 300 AS INT) AS frame FROM {events}"


@query("""WITH+ , s AS (SELECT *, start_frame / 5.0::DOUBLE AS t0, (end_frame + 1) / 5.0::DOUBLE AS t1 FROM t), c AS (SELECT *, t0 + i * 10 AS start, least(t1, t0 + i * 10 + 12) AS fin FROM (SELECT *, unnest(range(0, 8)) AS i FROM s) WHERE t0 + i * 10 < t1 - 1e-8 AND (i = 0 OR t0 + (i - 1) * 10 + 12 < t1)),
    n AS (SELECT c.track_id, window_id, speaker_id, start, fin, face_conf, count(*) / greatest(1, any_value(ceil(fin * 5) - floor(start * 5) + 1)) AS coverage FROM c JOIN p ON p.track_id = c.track_id AND p.frame BETWEEN floor(start * 5) AND ceil(fin * 5) WHERE fin - start >= 2 GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY start, face_conf DESC, track_id) AS position FROM n WHERE coverage >= 0.05::DOUBLE)
    SELECT track_id || '_probe_' || lpad(CAST(position AS VARCHAR), 5, '0') AS probe_id, speaker_id, round(fin - start, 6) AS duration, round(face_conf, 6) AS face_conf FROM k WHERE position <= 6""", t=_TRACKS, p=_POINTS)
def track_probe_lookup(spark, sf):
    tracks = bound(spark, sf, _TRACKS)
    found = chain.probes_of(tracks, bound(spark, sf, _POINTS), Settings(probe_coverage=0.05, max_probes=6))
    return rounded(found.select("probe_id", "speaker_id", "duration", "face_conf"), "duration", "face_conf")


@query("WITH+ SELECT track_id, speaker_id FROM t WHERE face_conf >= 30 AND speaker_id IN ('s1', 's2') AND CAST(window_id AS BIGINT) % 2 = 0", t=_TRACKS)
def target_tracks(spark, sf):
    tracks = bound(spark, sf, _TRACKS).withColumn("is_identified", F.col("face_conf") >= 30)
    windows = tracks.select("window_id").distinct().where(F.col("window_id").cast("long") % 2 == 0)
    pairs = windows.withColumn("speaker_id", F.explode(F.array(F.lit("s1"), F.lit("s2"))))
    return chain.targets(tracks, pairs).select("track_id", "speaker_id")


# --- budgets, trims and proposals ----------------------------------------------------

_VISITS = "SELECT CAST(l_suppkey AS STRING) AS video_id, l_linenumber AS visit, count(*) AS n_candidates, CAST(l_suppkey % 40 AS INT) AS existing FROM {lineitem} GROUP BY l_suppkey, l_linenumber"
_CAP = 300


@query(f"""WITH+ RECURSIVE , o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY visit) AS k, least(3, count(*) OVER (PARTITION BY video_id)) AS need FROM v),
    st AS (SELECT DISTINCT video_id, 0::BIGINT AS k, existing::BIGINT AS total, 0::BIGINT AS seen, NULL::INTEGER AS visit, false AS visited, 0::BIGINT AS budget, 0::BIGINT AS taken FROM v
        UNION ALL
        SELECT video_id, k, CAST(total + taken AS BIGINT), seen + CASE WHEN stop THEN 0 ELSE 1 END, visit, NOT stop, budget, taken FROM (
            SELECT *, CASE WHEN stop THEN 0 ELSE least(n, greatest(1, budget)) END::BIGINT AS taken FROM (
                SELECT *, CASE WHEN stop OR total >= {_CAP} THEN 0 ELSE greatest(1, ceil(({_CAP} - total) / greatest(1, need - seen))) END::BIGINT AS budget FROM (
                    SELECT s.video_id, o.k, s.total, s.seen, o.visit, o.need, o.n_candidates AS n, s.total >= {_CAP} AND s.seen >= o.need AS stop FROM st s JOIN o ON o.video_id = s.video_id AND o.k = s.k + 1))))
    SELECT video_id, visit, visited, CAST(budget AS INTEGER) AS budget, CAST(taken AS INTEGER) AS taken FROM st WHERE k > 0""", v=_VISITS)
def window_budgets(spark, sf):
    return selection.budgeted(bound(spark, sf, _VISITS), _CAP, 3)


_SPANS = "SELECT CAST(event_id AS BIGINT) AS row_ord, CAST(user_id AS DOUBLE) AS start, CAST(user_id AS DOUBLE) + 2 + CAST(event_id % 12 AS DOUBLE) / 4 AS `end`, least(1, value / 60) AS confidence, 0.5 AS visual, 0.25 AS audio FROM {events}"


@query("""WITH+ , t AS (SELECT *, CASE WHEN "end" - start > 3 AND "end" - start <= 5 THEN (start + "end") / 2 - 1.5 ELSE start END AS a, CASE WHEN "end" - start > 3 AND "end" - start <= 5 THEN (start + "end") / 2 + 1.5 ELSE "end" END AS b FROM s)
    SELECT row_ord, round(a, 6) AS start, round(b, 6) AS "end", round(confidence + 0.05::DOUBLE + 0.0125::DOUBLE - 0.1::DOUBLE * abs(b - a - 3) / 3, 6) AS score FROM t""", s=_SPANS)
def window_trims(spark, sf):
    rows = proposals.in_time(bound(spark, sf, _SPANS).withColumns({c: F.col(c).cast("double") for c in ("confidence", "visual", "audio")}))
    long = (F.col("end") - F.col("start") > 3) & (F.col("end") - F.col("start") <= 5)
    box = columns.centred(F.col("start"), F.col("end"), 3.0, F.col("start"), F.col("end"))
    cut = rows.withColumn("x", F.when(long, box).otherwise(F.struct("start", "end"))).select("row_ord", "x.start", "x.end", "confidence", "visual", "audio")
    score = gates.proposal_score(F.col("confidence"), F.col("visual"), F.col("audio"), F.col("end") - F.col("start"), 3.0)
    return rounded(cut.select("row_ord", "start", "end", score.alias("score")), "start", "end", "score")


@query("""SELECT CAST(user_id AS VARCHAR) || event_type AS track_id, round(least(avg(value) / 50, 0.49::DOUBLE), 6) AS active_conf, least(avg(value) / 50, 0.49::DOUBLE) >= 0.45::DOUBLE AND count(*) >= 3 AS active FROM events WHERE user_id % 4 <> 0 GROUP BY user_id, event_type HAVING least(avg(value) / 50, 0.49::DOUBLE) >= 0.3::DOUBLE""")
def detected_tracks(spark, sf):
    per = read(spark, sf, "events").groupBy(F.concat(F.col("user_id").cast("string"), "event_type").alias("track_id"), "user_id").agg((F.avg("value") / 50).alias("avg_det_score"), F.count("*").cast("double").alias("duration"))
    told = per.withColumn("speaker_id", F.when(F.col("user_id") % 4 == 0, "unknown").otherwise("s"))
    judged = proposals.known_active(proposals.detected_only(told, 0.45, 3.0), 0.3)
    return rounded(judged.select("track_id", "active_conf", "active"), "active_conf")


# --- manifest and small aggregates ----------------------------------------------------


@query("""SELECT CAST(c_custkey AS VARCHAR) AS speaker_id, trim(c_name) AS name, CASE WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE c_mktsegment END AS gender, CASE c_custkey % 4 WHEN 0 THEN 1985 WHEN 3 THEN NULL ELSE NULL END AS birth_year, 'a' || c_custkey || '.jpg|b.png' AS images
    FROM customer WHERE c_custkey % 7 <> 0 AND c_nationkey % 5 <> 0 AND c_custkey % 11 <> 0""")
def usable_speakers(spark, sf):
    k = F.col("c_custkey")
    rows = read(spark, sf, "customer").select(
        F.concat(F.lit(" "), k.cast("string")).alias("speaker_id"),
        F.concat("c_name", F.lit(" ")).alias("name"),
        F.concat(F.lit(" a"), k.cast("string"), F.lit(".jpg; ; b.png ;")).alias("reference_images"),
        F.when(k % 3 == 0, " ").otherwise(F.col("c_mktsegment")).alias("gender"),
        F.when(k % 4 == 0, "1985").when(k % 4 == 1, "1985.0").when(k % 4 == 2, "").alias("birth_year"),
        F.when(k % 7 == 0, " NO").when(k % 7 == 1, "n/a").alias("use"),
        F.when(F.col("c_nationkey") % 5 == 0, "Yes ").otherwise("0").alias("exclude_from_train"),
    )
    rows = rows.withColumn("reference_images", F.when(F.col("speaker_id").cast("long") % 11 == 0, " ; ").otherwise(F.col("reference_images")))
    return manifest.usable_speakers(rows).select("speaker_id", "name", "gender", "birth_year", F.array_join("reference_images", "|").alias("images"))


@query("""WITH v AS (SELECT l_suppkey, l_returnflag || l_linestatus AS youtube_id, min(l_linenumber) AS priority FROM lineitem GROUP BY 1, 2),
    p AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY priority, youtube_id) AS position FROM v)
    SELECT CAST(l_suppkey AS VARCHAR) AS speaker_id, youtube_id, position FROM p ORDER BY l_suppkey, position LIMIT 9""")
def first_videos(spark, sf):
    rows = read(spark, sf, "lineitem").groupBy("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("youtube_id")).agg(F.min("l_linenumber").alias("priority"))
    found = manifest.first_videos(rows.withColumn("speaker_id", F.col("l_suppkey").cast("string")), 9, "l_suppkey")
    return found.select("speaker_id", "youtube_id", F.col("position").cast("long").alias("position"))


@query("""SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier) AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey % 2 = 1""")
def configured_units(spark, sf):
    units = read(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("speaker_id"), F.col("o_orderpriority").alias("video_id"))
    speakers = read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("speaker_id"))
    odd = speakers.where(F.col("speaker_id").cast("long") % 2 == 1)
    pairs = odd.withColumn("video_id", F.explode(F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))))
    return manifest.of_pairs(manifest.of_speakers(units, speakers), pairs).select("o_orderkey")


@query("""SELECT CAST(user_id AS VARCHAR) AS speaker_id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS videos, CAST(max(n) AS BIGINT) AS most, min(n) AS least FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def speaker_videos(spark, sf):
    rows = read(spark, sf, "events").select(F.col("user_id").cast("string").alias("speaker_id"), F.col("event_type").alias("video_id"))
    listed = stats.speaker_videos(rows).select("speaker_id", F.array_join("videos", "|").alias("videos"))
    counts = stats.candidate_counts(rows).groupBy("speaker_id").agg(F.max("n_candidates").alias("most"), F.min("n_candidates").alias("least"))
    return listed.join(counts, "speaker_id")


@query("""WITH c AS (SELECT user_id, event_id % 5 AS o, count(*) AS n FROM events GROUP BY 1, 2), m AS (SELECT user_id, arg_max(o, n * 100 - o) AS common FROM c GROUP BY 1)
    SELECT CAST(e.user_id AS VARCHAR) AS track_id, common, round(median(value), 6) AS middle, round(max(value), 6) AS top FROM events e JOIN m USING (user_id) GROUP BY e.user_id, common""")
def score_summaries(spark, sf):
    rows = read(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("track_id"))
    return rounded(rows.agg(F.mode(F.col("event_id") % 5, True).alias("common"), F.median("value").alias("middle"), F.max("value").alias("top")), "middle", "top")


@query("""SELECT vec_id, CAST(list_position(v, list_min(v)) AS INTEGER) AS best, round(list_min(v), 6) AS least, round(list_aggregate(v, 'median'), 6) AS middle FROM (SELECT vec_id, list_transform(embedding[1:21], lambda x: x::DOUBLE) AS v FROM embeddings)""")
def shift_minima(spark, sf):
    v = F.slice(arrays.doubles("embedding"), 1, 21)
    return rounded(read(spark, sf, "embeddings").select("vec_id", F.array_position(v, F.array_min(v)).cast("int").alias("best"), F.array_min(v).alias("least"), arrays.median(v).alias("middle")), "least", "middle")


# --- names and reports ----------------------------------------------------------------


@query("""SELECT page_id, 'a' || page_id || '.jpg|b.png' AS images, CASE page_id % 3 WHEN 0 THEN 1985 END AS birth_year, 'u' || page_id || '.tar' AS stem, 'a_b_ñ-_' || page_id AS key, CASE WHEN page_id % 2 = 0 THEN 'x/' || page_id ELSE '/other/x/' || page_id END AS relative,
    '&lt;a href=&quot;' || page_id || '&quot;&gt;&amp;&#x27;' AS html FROM pages""")
def name_functions(spark, sf):
    k = F.col("page_id").cast("string")
    year = F.when(F.col("page_id") % 3 == 0, " 1985").when(F.col("page_id") % 3 == 1, "1985.0").otherwise("")
    path = F.concat(F.when(F.col("page_id") % 2 == 0, "/root/dev\\x/").otherwise("/other/x/"), k)
    return read(spark, sf, "pages").select(
        "page_id",
        F.array_join(columns.parts(F.concat(F.lit("a"), k, F.lit(".jpg ;; b.png;"))), "|").alias("images"),
        columns.year(year).alias("birth_year"),
        columns.stem(F.concat(F.lit("dir.x/u"), k, F.lit(".tar.gz"))).alias("stem"),
        columns.safe_key(F.concat(F.lit("a b/ñ-?"), k)).alias("key"),
        columns.relative_path(path, "/root/dev").alias("relative"),
        review.escaped(F.concat(F.lit('<a href="'), k, F.lit('">&\''))).alias("html"),
    )


@query("SELECT o_orderkey, 'coverage_' || strftime(o_orderdate, '%Y%m%d%H%M%S') AS tag FROM orders")
def run_tags(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", columns.run_tag(F.col("o_orderdate")).alias("tag"))


@query("""WITH+ , a AS (SELECT * FROM c WHERE face_conf >= 0.9::DOUBLE)
    SELECT speaker_id, 'm &amp; &lt;' || video_id || '&gt;' AS video_id, printf('%.2f-%.2f', start, "end") AS time, '0.000' AS rank_score, printf('%.2f', vad_ratio) AS vad_ratio, printf('%.3f', face_margin) AS face_margin, printf('%.3f', syncnet_confidence) AS syncnet_confidence, candidate_path AS audio FROM a""", c=CANDIDATES)
def review_rows(spark, sf):
    rows = bound(spark, sf, CANDIDATES).withColumn("approved", (F.col("face_conf") >= 0.9).cast("int")).withColumn("video_id", F.concat(F.lit("m & <"), "video_id", F.lit(">")))
    ordered = rows.where("approved = 1").orderBy(*review.risk_order(rows))
    return review.page_rows(ordered).select("speaker_id", "video_id", "time", "rank_score", "vad_ratio", "face_margin", "syncnet_confidence", "audio")


_WINDOWS = "SELECT DISTINCT concat(l_returnflag, l_linestatus) AS video_id, concat('w', CAST(l_linenumber AS STRING)) AS tag, CAST(l_linenumber * 600 AS DOUBLE) AS start, 600.0 AS duration FROM {lineitem}"


@query("""WITH+ , s AS (SELECT *, 'w' || CAST(CAST(round(rms * 1000) AS INTEGER) AS VARCHAR) AS chunk_tag FROM c), j AS (SELECT s.*, w.start AS w0, w.start + s.start AS gs, w.start + s."end" AS ge FROM s JOIN w ON w.video_id = s.video_id AND w.tag = s.chunk_tag)
    SELECT speaker_id, video_id, video_id || '::' || chunk_tag AS processing_unit_id, candidate_path, CAST(row_number() OVER (PARTITION BY speaker_id, video_id ORDER BY w0, gs, ge, candidate_path) - 1 AS INTEGER) AS candidate_idx, gs AS start, ge AS "end", start AS local_start, duration, 0 AS approved,
        round(0.35::DOUBLE * quality_score + 0.35::DOUBLE * greatest(0, least(1, (syncnet_confidence - 4) / 4)) + 0.20::DOUBLE * active_confidence + 0.10::DOUBLE * greatest(0, least(1, (CASE WHEN isnan(snr_db) THEN -99 ELSE snr_db END - 8) / 20)), 6) AS rank_score FROM j""", c=CANDIDATES, w=_WINDOWS)
def candidate_projection(spark, sf):
    rows = bound(spark, sf, CANDIDATES).withColumn("chunk_tag", F.concat(F.lit("w"), F.round(F.col("rms") * 1000).cast("int").cast("string")))
    made = candidates.candidate_rows(rows, bound(spark, sf, _WINDOWS).withColumn("duration", F.col("duration").cast("double")), S)
    return rounded(made.select("speaker_id", "video_id", "processing_unit_id", "candidate_path", "candidate_idx", "start", "end", "local_start", "duration", "approved", "rank_score"), "rank_score")


# --- trials, approval and coverage -----------------------------------------------------

_SPLITS = "SELECT CAST(c_custkey AS STRING) AS speaker_id, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender, CASE c_nationkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split FROM {customer} WHERE c_custkey % 5 <> 0"


@query("WITH+ SELECT c.speaker_id, c.path, s.gender FROM c JOIN s USING (speaker_id) WHERE split = 'train'", c=CLIPS, s=_SPLITS)
def train_split(spark, sf):
    rows = trials.of_splits(bound(spark, sf, CLIPS), bound(spark, sf, _SPLITS))
    return trials.train_rows(rows).join(rows.select("path", "gender"), "path").select("speaker_id", "path", "gender")


_DRAW = "('0x' || substr(md5('1234|{}|' || draw), 1, 8))::BIGINT % {}"


@query(f"""WITH+ , tg AS (SELECT DISTINCT a.path AS path1, b.path AS path2 FROM c a JOIN c b ON a.speaker_id = b.speaker_id AND a.path < b.path AND a.video_id = b.video_id), gl AS (SELECT CASE WHEN count(*) = 0 THEN 0 ELSE least(greatest(4 * count(*), 1000), 20000) END AS goal FROM tg),
    nb AS (SELECT speaker_id, row_number() OVER (ORDER BY speaker_id) - 1 AS k, count(*) OVER () AS n FROM (SELECT DISTINCT speaker_id FROM c)),
    a AS (SELECT draw, n, {_DRAW.format("a", "n")} AS k1 FROM (SELECT unnest(range(0, CAST(floor(goal * 1.5::DOUBLE) AS BIGINT) + 100)) AS draw FROM gl), (SELECT any_value(n) AS n FROM nb)),
    b AS (SELECT *, (k1 + 1 + {_DRAW.format("b", "(n - 1)")}) % n AS k2 FROM a),
    l AS (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY path) - 1 AS i, count(*) OVER (PARTITION BY speaker_id) AS m FROM c),
    p AS (SELECT draw, least(x.path, y.path) AS path1, greatest(x.path, y.path) AS path2 FROM b JOIN nb s ON s.k = k1 JOIN nb t ON t.k = k2 JOIN l x ON x.speaker_id = s.speaker_id AND x.i = {_DRAW.format("c1", "x.m")} JOIN l y ON y.speaker_id = t.speaker_id AND y.i = {_DRAW.format("c2", "y.m")} WHERE x.video_id <> y.video_id),
    o AS (SELECT path1, path2 FROM p GROUP BY 1, 2 ORDER BY min(draw) LIMIT (SELECT goal FROM gl))
    SELECT 1 AS label, path1, path2 FROM tg UNION ALL SELECT 0, path1, path2 FROM o""", c=CLIPS)
def in_pipeline_trials(spark, sf):
    return trials.in_pipeline(bound(spark, sf, CLIPS), "A")


@query("""WITH+ , a AS (SELECT speaker_id, count(*) FILTER (WHERE face_conf > 0.8::DOUBLE) AS n0, count(*) AS n1, coalesce(sum(duration) FILTER (WHERE face_conf > 0.8::DOUBLE), 0) AS d0, count(DISTINCT video_id) AS v FROM c WHERE file_exists GROUP BY 1)
    SELECT speaker_id, n0 AS initial_clips, CASE WHEN n0 >= 215 THEN n0 ELSE n1 END AS n_clips, CASE WHEN n0 >= 215 THEN 0 WHEN n1 >= 215 THEN 1 ELSE 2 END AS attempts_used, CASE WHEN greatest(n0, n1) >= 215 AND v >= 2 THEN 'sufficient' ELSE 'insufficient' END AS status FROM a""", c=CANDIDATES)
def coverage_report(spark, sf):
    """Short speakers get all their rows with the first retry."""
    rows = bound(spark, sf, CANDIDATES)
    tried: list[DataFrame] = []

    def approve() -> DataFrame:
        strict = rows.where("face_conf > 0.8")
        if not tried:
            return strict
        again = tried[0]
        return strict.join(again, "speaker_id", "left_anti").unionByName(rows.join(again, "speaker_id", "left_semi"))

    found = stats.ensure_coverage(lambda short, n: tried.append(short), rows.select("speaker_id").distinct(), approve, 215, 0.0, 2, 2)
    return found.select("speaker_id", "initial_clips", "n_clips", "attempts_used", "status")


@query("""WITH+ , n AS (SELECT *, CASE WHEN isnan(snr_db) THEN -99 ELSE snr_db END AS snr FROM c WHERE NOT (video_id = 'NF' AND CAST(speaker_id AS INTEGER) % 2 = 0)),
    bad AS (SELECT candidate_path, sha1 FROM n WHERE face_conf >= 0.98::DOUBLE AND syncnet_confidence > 9),
    g AS (SELECT *, file_exists AND pipeline_version = '1' AND face_conf >= CASE WHEN lower(candidate_profile) = 'relaxed' THEN 0.5::DOUBLE ELSE 0.6::DOUBLE END AND face_margin >= 0.08::DOUBLE AND face_track_consistency >= 0.75::DOUBLE AND vad_ratio >= 0.45::DOUBLE
        AND snr >= CASE WHEN lower(candidate_profile) = 'relaxed' THEN 5 ELSE 8 END AND syncnet_verified >= 1 AND syncnet_confidence >= 4 AND abs(syncnet_offset_frames) <= 3 AND syncnet_unambiguous >= 1
        AND candidate_path NOT IN (SELECT candidate_path FROM bad) AND (trim(sha1) = '' OR sha1 NOT IN (SELECT sha1 FROM bad WHERE trim(sha1) <> '')) AS ok FROM n)
    SELECT speaker_id, count(*) AS n_rows, count(*) FILTER (WHERE candidate_path IN (SELECT candidate_path FROM bad)) AS n_bad, count(*) FILTER (WHERE coalesce(ok, false)) AS n_eligible FROM g GROUP BY 1""", c=CANDIDATES)
def approval_chain(spark, sf):
    rows = bound(spark, sf, CANDIDATES)
    videos = rows.select("speaker_id", "video_id").distinct()
    configured = videos.where(~((F.col("video_id") == "NF") & (F.col("speaker_id").cast("int") % 2 == 0)))
    own = manifest.of_pairs(rows, configured)
    bad = own.where("face_conf >= 0.98 and syncnet_confidence > 9").select("candidate_path", F.lit("").alias("sha1"))
    marked = rejections.mark_rejected(own, bad)
    judged = gates.eligibility(gates.approval_scores(rejections.digest(marked), S), S)
    chosen = judged.join(bad.select("candidate_path", F.lit(1).alias("told")), "candidate_path", "left")
    return chosen.groupBy("speaker_id").agg(F.count("*").alias("n_rows"), F.count("told").alias("n_bad"), F.count_if("eligible").alias("n_eligible"))


@query("""WITH+ SELECT row_ord, active_confidence >= CASE WHEN lower(candidate_profile) = 'relaxed' THEN 0.40::DOUBLE ELSE 0.45::DOUBLE END AND rms * 40 >= 0.20::DOUBLE AND clipping_ratio * 4 >= 0.04::DOUBLE AS gate_proposal, false AS gate_version FROM c""", c=CANDIDATES)
def proposal_gate(spark, sf):
    """Without real sync the proposal decides; without a version all rows are legacy."""
    rows = bound(spark, sf, CANDIDATES).withColumn("audio_score", F.col("rms") * 40).withColumn("visual_score", F.col("clipping_ratio") * 4).drop("pipeline_version")
    own = Settings(real_asd_required=False)
    return gates.eligibility(gates.approval_scores(rows, own), own).select("row_ord", "gate_proposal", "gate_version")


@query("""SELECT * FROM (VALUES ('candidate_profile', 'relaxed'), ('detect_fps', '5'), ('identity_threshold', '0.5'), ('min_active', '0.4'), ('min_audio_score', '0.2'), ('min_face_size', '60'), ('min_segment_seconds', '2'), ('min_snr_db', '5'),
    ('min_speech_ratio', '0.45'), ('min_visual_score', '0.04'), ('target_segment_seconds', '6'), ('track_max_lost', '8'), ('track_min_iou', '0.15'), ('track_min_points', '8'), ('track_min_similarity', '0.3')) AS t(setting, value)""")
def relaxed_profile(spark, sf):
    own = Settings(real_asd_required=False).relaxed()
    names = ("candidate_profile", "detect_fps", "identity_threshold", "min_active", "min_audio_score", "min_face_size", "min_segment_seconds", "min_snr_db", "min_speech_ratio", "min_visual_score", "target_segment_seconds", "track_max_lost", "track_min_iou", "track_min_points", "track_min_similarity")
    said = lambda v: v if isinstance(v, str) else f"{v:g}"
    return spark.createDataFrame([(n, said(getattr(own, n))) for n in names], "setting string, value string")
