"""Hand-checked cases and invariants."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cliploom import config
from cliploom.functions import arrays, columns
from cliploom.operators import gates, intervals, metrics, review, selection, stats, store, sync, tracking, trials, vectors
from cliploom.schema import CANDIDATES, conform, require
from cliploom.sources import media

S = config.Settings()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def doubles(*values):
    return F.array(*(F.lit(float(v)) for v in values))


def test_temporal_iou(spark):
    assert one(spark, columns.temporal_iou(*(F.lit(x) for x in (0.0, 3.0, 1.0, 4.0)))) == 0.5


def test_greedy_suppression(spark):
    rows = [("a", 1, 0.0, 3.0, 9.0), ("a", 2, 1.0, 4.0, 8.0), ("a", 3, 3.0, 6.0, 7.0), ("a", 4, 3.1, 6.0, 6.0)]
    df = spark.createDataFrame(rows, "k string, row_ord long, start double, end double, score double")
    assert [r["row_ord"] for r in selection.suppress(df, ["k"], 0.05, 80).orderBy("place").collect()] == [1, 3]


def test_suppression_against_a_loop(spark):
    rng = random.Random(1)
    rows = [("k", i, float(a := rng.randint(0, 200)), a + rng.randint(1, 20) * 1.0, rng.random()) for i in range(80)]
    kept = []
    for r in sorted(rows, key=lambda r: -r[4]):
        iou = lambda a, b: max(0.0, min(a[3], b[3]) - max(a[2], b[2])) / (max(a[3], b[3]) - min(a[2], b[2]))
        if len(kept) < 15 and all(iou(k, r) <= 0.2 for k in kept):
            kept.append(r)
    df = spark.createDataFrame(rows, "k string, row_ord long, start double, end double, score double")
    assert [r["row_ord"] for r in selection.suppress(df, ["k"], 0.2, 15).orderBy("place").collect()] == [r[1] for r in kept]


def test_session_merge(spark):
    df = spark.createDataFrame([("k", 0.0, 1.0), ("k", 1.5, 2.5), ("k", 5.0, 6.0)], "k string, start double, end double")
    assert [(r["start"], r["end"]) for r in intervals.merge_sessions(df, ["k"], 1.10).orderBy("start").collect()] == [(0.0, 2.5), (5.0, 6.0)]


def test_bridge(spark):
    bits = [0, 1, 0, 0, 1, 0, 0, 0, 1, 0]
    df = spark.createDataFrame([("k", i, bool(b)) for i, b in enumerate(bits)], "k string, at int, flag boolean")
    out = [int(r["bridged"]) for r in intervals.bridge_gaps(df, ["k"], "at", "flag", 2).orderBy("at").collect()]
    assert out == [0, 1, 1, 1, 1, 0, 0, 0, 1, 0]


def test_medians_and_percentiles(spark):
    assert one(spark, arrays.running_median(doubles(5, 1, 9, 2), 3)) == [5, 5, 2, 2]
    assert one(spark, arrays.percentile(doubles(1, 5, 2, 9, 3, 7), 0.35)) == pytest.approx(2.75)
    assert one(spark, arrays.median(doubles(4, 1, 3, 2))) == 2.5
    assert one(spark, arrays.rolling_mean(doubles(1, 2, 3), 3)) == pytest.approx([4 / 3, 2, 8 / 3])


def test_row_medians_repeat_edges(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([("p", i, v) for i, v in enumerate([5.0, 1.0, 9.0, 2.0])], "p string, frame int, v double")
    out = sync.edge_median(df, "p", Window.partitionBy("p").orderBy("frame"), "v", 3).orderBy("frame").collect()
    assert [r["v_median"] for r in out] == [5, 5, 2, 2]


def test_stratified_order():
    assert intervals.stratified_order(4) == [0, 2, 3, 1]
    assert intervals.stratified_order(6) == [0, 2, 5, 1, 3, 4]
    assert sorted(intervals.stratified_order(17)) == list(range(17))


def test_windows(spark):
    df = spark.createDataFrame([("a", 1250.0), ("b", 30.0), ("c", 0.0)], "video_id string, video_duration double")
    rows = [(r["video_id"], r["start"], r["duration"]) for r in intervals.video_windows(df).orderBy("video_id", "idx").collect()]
    assert rows == [("a", 0.0, 600.0), ("a", 600.0, 600.0), ("b", 0.0, 30.0), ("c", 0.0, 600.0)]


def test_probes(spark):
    tracks = spark.createDataFrame([("t", "w", 0.0, 25.0, 0.9)], "track_id string, window_id string, start_time double, end_time double, face_conf double")
    points = spark.createDataFrame([("t", i) for i in range(126)], "track_id string, frame int")
    rows = intervals.probes(tracks, points, 5.0).orderBy("start").collect()
    assert [(r["start"], r["end"]) for r in rows] == [(0.0, 12.0), (10.0, 22.0), (20.0, 25.0)]


def test_overlap_depth(spark):
    spans = spark.createDataFrame([("s", 0.0, 10.0), ("t", 0.0, 5.0), ("e", 1.0, 1.0)], "id string, start double, end double")
    parts = spark.createDataFrame([("s", 0.0, 5.0), ("s", 3.0, 8.0)], "id string, start double, end double")
    assert {r["id"]: r["overlap_ratio"] for r in intervals.overlap_depth(spans, parts, "id").collect()} == {"s": pytest.approx(0.2), "t": 0.0, "e": 1.0}


def test_nearest_prefers_the_earlier(spark):
    left = spark.createDataFrame([("k", 5.0, 1), ("k", 20.0, 2)], "k string, t double, id int")
    right = spark.createDataFrame([("k", 4.0, "a"), ("k", 6.0, "b")], "k string, t double, v string")
    assert {r["id"]: r["v"] for r in intervals.nearest(left, right, ["k"], "t", "v", 3.0).collect()} == {1: "a", 2: None}


def test_snr_extremes(spark):
    x = doubles(1, 1)
    assert one(spark, arrays.snr_db(x, F.array(F.lit(False), F.lit(False)))) == -99.0
    assert one(spark, arrays.snr_db(x, F.array(F.lit(True), F.lit(True)))) == 30.0


def test_one_template_alone(spark):
    known = spark.createDataFrame([("s1", [1.0, 0.0])], "speaker_id string, template array<double>")
    faces = spark.createDataFrame([(1, [0.7, math.sqrt(1 - 0.49)])], "id int, e array<double>")
    r = vectors.identify(faces, known, "id", "e", 0.6, 0.08).first()
    assert (r["speaker_id"], r["face_other_conf"]) == ("s1", -1.0) and r["face_margin"] == pytest.approx(0.7)


def test_digest_falls_back_to_the_path(spark):
    df = spark.createDataFrame([("", "p1"), ("nan", "p2"), ("h", "p3"), (None, "p4")], "sha1 string, candidate_path string")
    assert [r["digest"] for r in gates.selection_digest(df).collect()] == ["p1", "p2", "h", "p4"]


def test_nan_never_passes(spark):
    row = {"face_conf": 0.9, "face_margin": 0.2, "face_track_consistency": 0.9, "vad_ratio": 0.9, "snr_db": float("nan"), "syncnet_confidence": 9.0, "syncnet_verified": 1, "syncnet_unambiguous": 1, "syncnet_offset_frames": 0, "quality_score": 0.9, "active_confidence": 0.9, "candidate_profile": "standard", "pipeline_version": "1"}
    df = spark.createDataFrame(pd.DataFrame([row, row | {"snr_db": 20.0}]))
    out = gates.eligibility(gates.approval_scores(df, S), S).orderBy("gate_snr").collect()
    assert [(r["gate_snr"], r["eligible"]) for r in out] == [(False, False), (True, True)]


def test_quota_that_cannot_be_met():
    rows = pd.DataFrame({"video_id": [str(i) for i in range(11)], "digest": [str(i) for i in range(11)], "start": 0.0, "end": 1.0})
    with pytest.raises(ValueError):
        selection.pick(rows, [], 50, 20, 5, 0.05, True)


def test_selection_invariants():
    rng = random.Random(3)
    rows = pd.DataFrame([{"video_id": f"v{rng.randint(0, 5)}", "digest": str(rng.randint(0, 150)), "start": (a := rng.random() * 500), "end": a + 3} for _ in range(300)])
    for overflow in (False, True):
        order = selection.pick(rows, ["v0"], 50, 12, 5, 0.05, overflow)
        got = rows.iloc[order]
        assert len(order) == len(set(order)) <= 50 and got["digest"].is_unique
        assert overflow or got["video_id"].value_counts().max() <= 12
        assert list(got["video_id"][:5]) == ["v0"] * 5
        for _, g in got.groupby("video_id"):
            for i, a in g.iterrows():
                for j, b in g.iterrows():
                    if i < j:
                        assert max(0, min(a["end"], b["end"]) - max(a["start"], b["start"])) / (max(a["end"], b["end"]) - min(a["start"], b["start"])) <= 0.05


def test_unique_trials(spark):
    df = spark.createDataFrame([(1, "b", "a"), (1, "a", "b"), (1, "a", "a")], "label int, path1 string, path2 string")
    assert [tuple(r) for r in trials.unique_trials(df).collect()] == [(1, "a", "b")]


def test_non_targets_differ_in_speaker_and_video(spark):
    clips = spark.createDataFrame([(f"s{i % 6}", f"v{i % 9}", "fm"[i % 2], f"p{i:03d}") for i in range(90)], "speaker_id string, video_id string, gender string, path string")
    got = trials.non_targets(clips, "x", 100)
    of = {r["path"]: r for r in clips.collect()}
    rows = got.collect()
    assert len({(r["path1"], r["path2"]) for r in rows}) == len(rows) == 100
    assert all(of[r["path1"]]["speaker_id"] != of[r["path2"]]["speaker_id"] and of[r["path1"]]["video_id"] != of[r["path2"]]["video_id"] and of[r["path1"]]["gender"] == of[r["path2"]]["gender"] for r in rows)


def test_overlap_is_a_violation(spark):
    df = spark.createDataFrame([("s", "v", 1, 0.0, 3.0), ("s", "v", 2, 1.0, 4.0)], "speaker_id string, video_id string, row_ord long, start double, end double")
    full = df.withColumns({"pipeline_version": F.lit("1"), "syncnet_verified": F.lit(1), "syncnet_unambiguous": F.lit(1), "duration": F.lit(3.0), "file_exists": F.lit(True), "sha1": F.col("row_ord").cast("string")})
    found = {r["rule"]: r["violations"] for r in stats.expectations(full, "1", 5.0).collect()}
    assert found.pop("overlap") == 1 and not any(found.values())


def test_eer(spark):
    df = spark.createDataFrame([("m", s, label) for s, label in [(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.5, 0), (0.4, 0)]], "m string, score double, label int")
    assert metrics.eer(df, ["m"]).first()["eer"] == pytest.approx(1 / 3)
    assert metrics.eer(df.where("label = 1"), ["m"]).count() == 0


def test_scoped_replace(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "speaker_id string, k int, row_ord int")
    new = spark.createDataFrame([("a", 2, 3)], "speaker_id string, k int, row_ord int")
    assert sorted((r["speaker_id"], r["k"]) for r in store.scoped_replace(old, new, new, ["speaker_id", "k"]).collect()) == [("a", 2), ("b", 1)]


def test_write_scoped_keeps_the_others(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda *r: spark.createDataFrame(list(r), "speaker_id string, k int, row_ord int")
    store.write_scoped(spark, path, rows(("a", 1, 1), ("b", 1, 2)), rows(("a", 0, 0)), ["speaker_id", "k"])
    store.write_scoped(spark, path, rows(("a", 2, 3)), rows(("a", 0, 0)), ["speaker_id", "k"])
    assert sorted((r["speaker_id"], r["k"]) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 1)]


def test_tracks_follow_a_face_and_close():
    frames = np.array([0, 0, 1, 1, 9, 9])
    boxes = np.array([[0, 0, 90, 90], [200, 0, 290, 90]] * 3, float)
    vectors_ = np.array([[1, 0], [0, 1]] * 3, float)
    assert tracking.associate(frames, boxes, vectors_, 0.15, 0.3, 0.35, 5).tolist() == [0, 1, 0, 1, 2, 3]
    assert tracking.associate(frames, boxes, vectors_, 0.15, 0.3, 0.35, 7).tolist() == [0, 1, 0, 1, 0, 1]


def test_sync_finds_a_steady_segment(spark):
    frames = [("p", i, 6.0 if 20 <= i < 90 else 0.0, 1) for i in range(120)]
    df = spark.createDataFrame(frames, "probe_id string, frame int, confidence double, offset int")
    probes = spark.createDataFrame([("p", 5.0)], "probe_id string, duration double")
    rows = sync.segments(df, probes, S).collect()
    assert len(rows) == 1 and rows[0]["offset_frames"] == 1 and rows[0]["confidence"] == 6.0
    assert (rows[0]["start"], rows[0]["end"]) == (pytest.approx((20 + 2) / 25), pytest.approx((90 + 2) / 25))
    assert sync.verdicts(probes, sync.segments(df, probes, S)).first()["accepted"]


def test_boundary_sample_is_bounded(spark):
    df = spark.createDataFrame([("s", i, float(i)) for i in range(50)], "speaker_id string, row_ord long, face_margin double")
    got = review.boundary_sample(df, 10, "7", "row_ord").collect()
    assert len(got) == 10 and {r["row_ord"] for r in got if r["part"] == "head"} == set(range(5))


def test_page_escapes(spark, tmp_path):
    df = spark.createDataFrame([("<b>&",)], "x string")
    assert review.html_page(df, tmp_path / "r.html") == 1
    assert "&lt;b&gt;&amp;" in (tmp_path / "r.html").read_text()


def test_conform_fills_and_converts(spark):
    df = spark.createDataFrame([("x", "1.5", "bad")], "speaker_id string, face_conf string, snr_db string")
    r = conform(df, CANDIDATES, {"approved": 0}).first()
    assert (r["face_conf"], r["snr_db"], r["approved"]) == (1.5, None, 0)
    with pytest.raises(ValueError):
        require(df, "nothing")


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("ROOT_X", "there")
    path = tmp_path / "c.yaml"
    path.write_text("quota: {target_per_speaker: 40}\nout: ${ROOT_X}\nname: ${MISSING_X:-else}\nspeakers:\n - {id: s1, name: n, birth_year: '1985.0', videos: [{youtube_id: a, use: 'no'}, {youtube_id: ''}]}\n - {id: s2, name: n}\n")
    settings, found = config.load(path)
    assert settings.target_per_speaker == 40 and len(found.speakers) == 1 and found.speakers[0]["birth_year"] is None
    assert found.videos[0]["use"] is False
    assert config.expand_env({"a": ["${ROOT_X}", "${MISSING_X:-else}"]}) == {"a": ["there", "else"]}
    with pytest.raises(ValueError):
        settings.relaxed()


def test_wav_round_trip():
    x = np.sin(np.arange(1600) / 20).astype(np.float32)
    y, rate = media.decode_wav(media.encode_wav(x, 16000))
    assert rate == 16000 and np.abs(x - y).max() < 1e-3
    assert len(media.resample(y, 16000, 8000)) == 800
    with pytest.raises(ValueError):
        media.to_mono(np.zeros(0, np.int16))


def test_wav_files(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(media.encode_wav(np.ones(1600, np.float32) * 0.5, 16000))
    (tmp_path / "b.wav").write_bytes(b"no")
    audio = media.read_wavs(spark, f"file://{tmp_path}")
    assert {r["error"] is None: r["rate"] for r in audio.collect()} == {True: 16000, False: 16000}
    path = audio.where("error is null").first()["path"]
    cut = media.clips(audio, spark.createDataFrame([(path, 0.0, 0.05)], "path string, start double, end double")).first()
    assert len(media.decode_wav(bytes(cut["wav"]))[0]) == 800 and len(cut["sha1"]) == 40


def test_truthy_words(spark):
    df = spark.createDataFrame([(x,) for x in ("", None, "No", "n", "0", "yes")], "x string")
    assert [r[0] for r in df.select(columns.truthy("x")).collect()] == [True, True, False, False, False, True]
    assert [r[0] for r in df.select(columns.truthy("x", columns.OFF_LOCAL)).collect()][3] is True


def test_streaming_sessions(spark, tmp_path):
    from cliploom.streaming import live

    events = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-01 00:20:00", 2.0), ("a", "2024-01-03 00:00:00", 4.0), ("a", "2024-01-09 00:00:00", 8.0)], "k string, t string, value double")
    path = str(tmp_path / "in")
    events.select("k", F.to_timestamp("t").alias("ts"), "value").write.parquet(path)
    stream = spark.readStream.schema("k string, ts timestamp, value double").parquet(path)
    q = live.sessions(stream, ["k"]).writeStream.outputMode("append").format("memory").queryName("sess").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r["total"] for r in spark.sql("select * from sess").collect())[:2] == [3.0, 4.0]


def test_speech_mask_and_snr_against_numpy(spark):
    g = np.random.default_rng(6)
    x = g.normal(size=(40, 64)) * g.choice([0.01, 1.0], size=(40, 64))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i long, v array<double>")
    out = df.withColumn("m", arrays.speech_mask(F.col("v"), 1000, 8.0, 0.003)).select("i", "m", arrays.snr_db(F.col("v"), F.col("m")).alias("snr")).collect()
    for r in out:
        v = x[r["i"]]
        levels = [math.sqrt((v[k : k + 8] ** 2).mean() + 1e-12) for k in range(0, 57, 4)]
        bar, mask = max(np.percentile(levels, 35), 0.003), np.zeros(64, bool)
        for k, level in enumerate(levels):
            if level >= bar:
                mask[4 * k : 4 * k + 8] = True
        assert r["m"] == mask.tolist()
        if mask.any() and not mask.all():
            assert r["snr"] == pytest.approx(10 * math.log10(((v[mask] ** 2).mean() + 1e-12) / ((v[~mask] ** 2).mean() + 1e-12)))


def test_framewise_against_numpy(spark):
    g = np.random.default_rng(8)
    d = g.random((70, 21))
    d[:, 11] -= 3.0
    d[30:40, 2] -= 40.0
    df = spark.createDataFrame([("p", i, [float(v) for v in r]) for i, r in enumerate(d)], "probe_id string, frame int, dist array<double>")
    pad = lambda a, h: np.concatenate([np.repeat(a[:1], h, 0), a, np.repeat(a[-1:], h, 0)])
    smooth = np.stack([pad(d, 25)[i : i + 51].mean(axis=0) for i in range(70)])
    best = smooth.argmin(axis=1)
    raw = np.median(smooth, axis=1) - d[np.arange(70), best]
    raw[np.abs(10 - best) > 3] = -99
    want = np.asarray([np.median(pad(raw, 4)[i : i + 9]) for i in range(70)])
    rows = sync.framewise(df, S).orderBy("frame").collect()
    assert [r["offset"] for r in rows] == (10 - best).tolist()
    assert [r["confidence"] for r in rows] == pytest.approx(want.tolist())


def test_stratified_table(spark):
    df = spark.createDataFrame([("v", i) for i in range(6)] + [("w", i) for i in range(4)], "video_id string, idx int")
    out = {(r["video_id"], r["visit"]): r["idx"] for r in intervals.stratified(df).collect()}
    assert [out["v", i] for i in range(6)] == [0, 2, 5, 1, 3, 4] and [out["w", i] for i in range(4)] == [0, 2, 3, 1]


def test_command_line_end_to_end(spark, tmp_path):
    from cliploom import cli
    from cliploom.operators import trials as trials_

    work, rng = tmp_path / "work", random.Random(2)
    (tmp_path / "c.yaml").write_text("quota: {target_per_speaker: 8, max_per_video: 5, min_per_video: 2, early_stop_candidates: 25}\nmin_clips: 8\nspeakers:\n" + "".join(f" - {{id: s{s}, name: n{s}, videos: [{{youtube_id: v{s}a}}, {{youtube_id: v{s}b}}]}}\n" for s in (1, 2)))
    windows = [(f"v{s}{v}", 0, 0.0, 600.0, "w0", 600.0) for s in (1, 2) for v in "ab"]
    spark.createDataFrame(windows, "video_id string, idx int, start double, duration double, tag string, video_duration double").write.parquet(str(work / "windows"))
    rows = [{"speaker_id": f"s{s}", "video_id": f"v{s}{v}", "chunk_tag": "w0", "start": 10.0 * i, "end": 10.0 * i + 3, "face_conf": 0.7 + rng.random() / 4, "face_margin": 0.3, "face_track_consistency": 0.9, "vad_ratio": 0.9, "snr_db": 20.0, "quality_score": 0.8, "active_confidence": 0.5, "syncnet_confidence": 6.0, "syncnet_verified": 1, "syncnet_unambiguous": 1, "syncnet_offset_frames": 0, "candidate_profile": "standard", "speaker_name": f"n{s}", "gender": "f", "candidate_path": f"{s}{v}{i}", "sha1": f"h{s}{v}{i}"} for s in (1, 2) for v in "ab" for i in range(7)]
    spark.createDataFrame(pd.DataFrame(rows)).write.parquet(str(work / "segments"))
    base = ["--config", str(tmp_path / "c.yaml"), "--workspace", str(work), "--out", str(tmp_path / "V.md")]
    assert cli.main(["all", *base]) == 0
    got = spark.read.parquet(str(work / "utterances"))
    assert {r["speaker_id"]: r["count"] for r in got.groupBy("speaker_id").count().collect()} == {"s1": 8, "s2": 8}
    assert "| overlap | 0 |" in (tmp_path / "V.md").read_text()
    assert cli.main(["candidates", *base]) == 0  # nothing is pending: the ledger holds every unit
    assert spark.read.parquet(str(work / "candidates")).count() == len(rows)
    assert cli.main(["review", *base, "--approved-only"]) == 0
    assert trials_.target_pairs(got.withColumn("path", F.col("export_path")), "A").count() > 0
    with pytest.raises(SystemExit):
        cli.main(["approve-auto", *base, "--speaker-id", "nobody"])


def test_proposals_fall_back_and_become_clips(spark):
    from cliploom.operators import proposals

    rows = [("a", float(i) / 2, float(i) / 2 + 1, 0.5, 0.5, 0.5) for i in range(14)] + [("b", float(i) / 2, float(i) / 2 + 1, 0.1, 0.3, 0.05) for i in range(14)]
    windows = spark.createDataFrame(rows, "track_id string, start double, end double, confidence double, audio double, visual double")
    found = proposals.propose(windows, S)
    assert [(r["track_id"], r["start"], r["end"]) for r in found.collect()] == [("a", 0.0, 7.5)]
    extra = proposals.fallback(windows, found, S)
    assert {r["track_id"] for r in extra.collect()} == {"b"}
    clips = proposals.to_windows(found, S).orderBy("start").collect()
    assert [(r["start"], r["end"]) for r in clips] == [(0.0, 3.0), (3.0, 6.0)]


def test_recovery_only_where_no_target_was_found(spark):
    box = lambda w: {"x1": 0.0, "y1": 0.0, "x2": w, "y2": w}
    rows = [("w1", i, 0, box(90.0), [1.0, 0.0], 0.9) for i in range(3)] + [("w2", i, 0, box(60.0), [1.0, 0.0], 0.9) for i in range(3)]
    faces = spark.createDataFrame(rows, "window_id string, frame int, face_ord int, bbox struct<x1:double,y1:double,x2:double,y2:double>, embedding array<double>, det_score double")
    assert {r["window_id"] for r in tracking.track(faces, S).collect()} == {"w1"}
    got = tracking.with_recovery(faces, S, lambda points: points.where("window_id = 'w1'")).groupBy("window_id").count().collect()
    assert {r["window_id"]: r["count"] for r in got} == {"w1": 3, "w2": 3}


def test_ambiguous_segments_go(spark):
    segments = spark.createDataFrame([(1,), (2,)], "segment_id int")
    rivals = spark.createDataFrame([(1, "t"), (2, "t")], "segment_id int, track_id string")
    verified = spark.createDataFrame([(1, "t", True), (2, "t", False)], "segment_id int, track_id string, accepted boolean")
    assert [r["segment_id"] for r in sync.unambiguous(segments, rivals, verified).collect()] == [2]


def test_files_are_written_and_copied_whole(spark, tmp_path):
    df = spark.createDataFrame([(f"{tmp_path}/a/x.bin", b"abc")], "path string, content binary")
    assert media.write_files(df).first()["bytes"] == 3
    plan = spark.createDataFrame([(f"{tmp_path}/a/x.bin", f"{tmp_path}/b/y.bin"), (f"{tmp_path}/none", f"{tmp_path}/b/z.bin")], "source string, target string")
    out = {r["target"][-5:]: r["error"] is None for r in media.copy_files(plan).collect()}
    assert out == {"y.bin": True, "z.bin": False} and (tmp_path / "b/y.bin").read_bytes() == b"abc" and not (tmp_path / "b/z.bin").exists()


def test_media_without_tools_reports(spark):
    df = spark.createDataFrame([("nothing.mp4", 0.0, 1.0)], "path string, start double, duration double")
    assert media.durations(df).first()["video_duration"] == 0.0
    assert media.window_audio(df).first()["error"] and media.window_frames(df).first()["error"]


def test_models_run_behind_the_boundary(spark):
    from cliploom.sources import models

    frames = spark.createDataFrame([("w", 0, b"x"), ("w", 1, b"yy")], "window_id string, frame int, jpeg binary")
    found = models.detect(frames, lambda: lambda images: [[(0, 0, 90, 90, [1.0, 0.0], 0.9)] * len(i) for i in images]).collect()
    assert len(found) == 3 and found[0]["bbox"]["x2"] == 90
    probes = spark.createDataFrame([("p", [0.0] * 4)], "probe_id string, clip array<double>")
    assert models.sync_distances(probes, models.flat_sync).count() == 4
    audio = spark.createDataFrame([([0.0, 1.0],)], "samples array<double>")
    assert models.voice_mask(audio, lambda: lambda xs: [[v > 0.5 for v in x] for x in xs]).first()["mask"] == [False, True]


def test_protocol_counts_and_refuses(spark):
    rows = [(f"s{s}", f"v{s}{v}", f"s{s}/v{s}{v}/{i}.wav") for s in range(8) for v in range(2) for i in range(4)]
    meta = spark.createDataFrame(rows, "speaker_id string, video_id string, path string")
    splits = spark.createDataFrame([(f"s{s}", "fm"[s % 2], "validation" if s < 4 else "test") for s in range(8)], "speaker_id string, gender string, split string")
    found = trials.protocol(meta, splits, 1, 20, 30)
    assert set(found) == {(a, b) for a in ("validation", "test") for b in "AB"}
    for df in found.values():
        got = df.collect()
        assert sum(r["label"] for r in got) == 20 and len(got) == 50 == len({(r["path1"], r["path2"]) for r in got})
    assert trials.gender_subset(found["test", "A"], meta.join(splits, "speaker_id")).count() == 50
    with pytest.raises(ValueError):
        trials.protocol(meta, splits, 1, 10_000, 1)


def test_streaming_store_and_ledger(spark, tmp_path):
    from cliploom.streaming import live

    rows = spark.createDataFrame([("s", "u1", 1, 1), ("s", "u1", 2, 1), ("t", "u2", 1, 1)], "speaker_id string, processing_unit_id string, candidate_idx int, row_ord int")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        live.keep_store(stream, str(tmp_path / "store"), str(tmp_path / "cp"), ["scope", "candidate_idx"]).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "store")).count() == 3
    units = spark.createDataFrame([("s", "u1", "2024-01-01 00:00:00")] * 2, "speaker_id string, processing_unit_id string, t string").withColumn("processed_at", F.to_timestamp("t"))
    units.write.parquet(str(tmp_path / "units"))
    stream = spark.readStream.schema(units.schema).parquet(str(tmp_path / "units"))
    live.new_units(stream).writeStream.outputMode("append").format("memory").queryName("units").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.sql("select * from units").count() == 1
