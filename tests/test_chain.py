"""From faces and audio to exported clips, and numbers computed by hand."""

import logging

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliploom import cli, config
from cliploom.config import Settings
from cliploom.functions import arrays, columns
from cliploom.operators import candidates, chain, gates, intervals, manifest, proposals, selection, sync, tracking, vectors
from cliploom.sources import media, models

S = Settings(audio_sr=400)
DETECTIONS = "window_id string, frame int, face_ord int, bbox struct<x1:float,y1:float,x2:float,y2:float>, embedding array<float>, det_score double"


def voice(seconds, rate):
    """Seven tenths of each second loud, the rest quiet; no two seconds are the same."""
    g, at = np.random.default_rng(1), np.arange(int(seconds * rate))
    loud = (at % rate) < 0.7 * rate
    return (np.where(loud, 0.4, 0.002) * g.choice([-1.0, 1.0], len(at))).astype(np.float32)


def faces(window, n=100):
    box = lambda x: {"x1": x, "y1": 0.0, "x2": x + 100, "y2": 100.0}
    return [(window, i, k, box(300.0 * k), [1.0 - k, float(k)], 0.9) for i in range(n) for k in (0, 1)]


@pytest.fixture(scope="module")
def tables(spark):
    windows = spark.createDataFrame([("s1", "v1", 0, 0.0, 20.0, "w0000", 20.0, "v1::w0000", 0)], "speaker_id string, video_id string, idx int, start double, duration double, tag string, video_duration double, window_id string, visit int")
    references = spark.createDataFrame([(s, i, v) for s, v in (("s1", [1.0, 0.0]), ("s2", [0.0, 1.0])) for i in range(2)], "speaker_id string, reference_id int, embedding array<float>")
    audio = spark.createDataFrame([("v1::w0000", voice(20, 400).tolist())], "window_id string, samples array<float>")
    return windows, spark.createDataFrame(faces("v1::w0000"), DETECTIONS), references, audio


def stub(near):
    """Distances that are small at no shift, or at the middle one for tracks named by it."""

    def run(probes):
        frames = probes.withColumn("frame", F.explode(F.sequence(F.lit(0), F.floor(F.col("duration") * 25).cast("int") - 1)))
        low = F.when(F.col("track_id").rlike(near), 2.0).otherwise(10.0)
        return frames.select("probe_id", "frame", F.array(*(low if i == 10 else F.lit(10.0) for i in range(21))).alias("dist"))

    return run


def test_faces_and_audio_become_candidates(spark, tables, tmp_path):
    held = []

    def hold(df):
        path = str(tmp_path / str(len(held)))
        df.write.parquet(path)
        held.append(path)
        return spark.read.parquet(path)

    found = hold(chain.candidate_segments(*tables, stub("_0001$"), S, hold=hold))
    rows = found.orderBy("start").collect()
    # probes 0-12 and 10-20: slices of 3 s from 0.08 s on, rests of 2.92 and 0.92 s
    assert [(round(r["start"], 2), round(r["end"], 2)) for r in rows] == [(0.08, 3.08), (3.08, 6.08), (6.08, 9.08), (9.08, 12.0), (10.08, 13.08), (13.08, 16.08), (16.08, 19.08)]
    for r in rows:
        assert (r["speaker_id"], r["video_id"], r["chunk_tag"], r["syncnet_offset_frames"]) == ("s1", "v1", "w0000", 0)
        assert r["face_conf"] == pytest.approx(1.0) and r["face_margin"] == pytest.approx(1.0) and r["syncnet_confidence"] == pytest.approx(8.0)
        assert (r["syncnet_competitors_checked"], r["syncnet_competitor_confidence"], r["quality_reason"]) == (1, -99.0, "ok")
    made = candidates.candidate_rows(found, tables[0], S).orderBy("candidate_idx").collect()
    assert [r["candidate_idx"] for r in made] == list(range(7)) and made[0]["processing_unit_id"] == "v1::w0000" and made[0]["rank_score"] > 0
    by = {tuple(df.columns): df for df in map(spark.read.parquet, held)}
    points, tracks, segments = (next(df for c, df in by.items() if mark in c) for mark in ("det_score", "is_identified", "rms"))
    assert chain.without_rivals(segments.drop("syncnet_competitors_checked"), tracks, points, stub("track"), S, hold).count() == 0  # both in sync
    few = Settings(early_stop_candidates=3, max_per_video=3)
    assert chain.within_budget(segments, tables[0], few).count() == 3


def test_command_line_from_faces_to_files(spark, tables, tmp_path):
    work = tmp_path / "work"
    (tmp_path / "c.yaml").write_text(
        "global: {target_clips_per_speaker: 3, segments_per_video: 5, min_selected_per_video: 0, audio_sr: 400, min_clips_per_speaker: 3, min_source_videos_per_speaker: 1, early_stop_candidates_per_video: 25}\n"
        "celebrities:\n - {id: s1, name: n1, gender: female, videos: [{youtube_id: v1}]}\n"
    )
    windows, *rest = tables
    windows.drop("speaker_id", "window_id", "visit").write.parquet(str(work / "windows"))
    for name, df in zip(("detections", "references", "audio"), rest, strict=True):
        df.write.parquet(str(work / name))
    base = ["--config", str(tmp_path / "c.yaml"), "--workspace", str(work), "--sync", "tests.syncstub:factory"]
    with pytest.raises(SystemExit):  # 50 clips can't be had; one retry looks at every unit again
        cli.main(["ensure-coverage", *base, "--min-clips-per-speaker", "50"])
    told = spark.read.parquet(str(work / "speaker_coverage")).first()
    assert (told["attempts_used"], told["status"], told["initial_clips"]) == (1, "insufficient", 3)
    assert spark.read.parquet(str(work / "candidates")).count() == 7  # the same clips again: the first stay
    assert cli.main(["export", *base]) == 0
    utterances = spark.read.parquet(str(work / "utterances")).orderBy("utterance_id").collect()
    files = sorted(p.name for p in (work / "export/wav/s1/v1").glob("*.wav"))
    assert files == [f"v1_0000{i}.wav" for i in range(3)] and utterances[0]["gender"] == "female"
    (work / "manual_rejections.csv").write_text("utterance_id\nv1_00000\nnobody\n")
    (work / "export/wav/s1/v1/v1_00009.wav").write_bytes(b"old")
    assert cli.main(["approve-auto", *base]) == 0 and cli.main(["export", *base]) == 0
    now = {r["candidate_path"] for r in spark.read.parquet(str(work / "utterances")).collect()}
    assert utterances[0]["candidate_path"] not in now and len(now) == 3
    assert sorted(p.name for p in (work / "export/wav/s1/v1").glob("*.wav")) == files
    assert list((work / "logs").glob("*.log")) and not (work / "_held").exists()
    with pytest.raises(SystemExit):
        cli.main(["candidates", *base[:-1], "tests.syncstub:broken", "--no-resume"])


def test_protocol_and_manifest_stages(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("global: {}\n")
    base = ["--config", str(tmp_path / "c.yaml"), "--workspace", str(tmp_path / "w")]
    lines = [f"s{s},v{s}{v},u{s}{v}{i}" for s in range(12) for v in range(2) for i in range(3)]
    (tmp_path / "m.csv").write_text("speaker_id,video_id,utterance_id\n" + "\n".join(lines) + "\n")
    (tmp_path / "s.csv").write_text("speaker_id,gender,split\n" + "".join(f"s{s},{('female', 'male')[s % 2]},{('train', 'validation', 'test')[s // 4]}\n" for s in range(12)))
    out = tmp_path / "out"
    assert cli.main(["protocol", *base, "--metadata", str(tmp_path / "m.csv"), "--split", str(tmp_path / "s.csv"), "--output-dir", str(out), "--target-trials", "5", "--non-target-trials", "8"]) == 0
    read = lambda name: [r[0] for r in spark.read.text(str(out / name)).collect()]
    assert sorted(read("train_list")) == read("train_list") and read("train_list")[0] == "s0 wav/s0/v00/u000.wav" and len(read("train_list")) == 24
    assert sorted(x.split()[0] for x in read("test_trials_B")) == ["0"] * 8 + ["1"] * 5
    both = read("test_trials_A_female") + read("test_trials_A_male")
    assert sorted(both) == sorted(read("test_trials_A")) and not (out / "val_trials_A_male").exists()
    (tmp_path / "videos").mkdir()
    for name in ("a.mp4", "b.webm", "cc.mp4"):
        (tmp_path / "videos" / name).write_bytes(b"x")
    (tmp_path / "v.csv").write_text("youtube_id,use\na,1\nb,\nc,yes\nd,no\n")
    check = ["check-videos", *base, "--videos", str(tmp_path / "v.csv"), "--video-dir", str(tmp_path / "videos"), "--out-missing", str(tmp_path / "missing")]
    with pytest.raises(SystemExit) as e:
        cli.main([*check, "--fail-if-missing"])
    assert e.value.code == 3 and [r[0] for r in spark.read.text(str(tmp_path / "missing")).collect()] == ["b", "c"]
    for name in ("b.mp4", "c.mp4"):
        (tmp_path / "videos" / name).write_bytes(b"x")
    assert cli.main(check) == 0 and not (tmp_path / "missing").exists()
    with pytest.raises(SystemExit) as e:
        cli.main(["preflight", *base, "--package", "surely_not_installed"])
    assert e.value.code == 2


def test_quality_by_hand(spark):
    rows = [(3.0, 0.775, 18.0, 0.006, 0.01), (0.0, 0.0, -99.0, 0.0, 0.5), (1.0, 0.6, 9.0, 0.003, 0.02)]
    df = spark.createDataFrame(rows, "duration double, vad_ratio double, snr_db double, rms double, clipping_ratio double")
    got = [(round(r["quality_score"], 6), r["quality_reason"], r["quality_ok"]) for r in gates.audio_quality(df, Settings()).orderBy(F.desc("duration")).collect()]
    # 0.40 * 0.5 + 0.30 * 0.5 + 0.20 * 0.5 + 0.10 * 0.5; 0.40 / 9 + 0.30 / 20 + 0.20 / 4 + 0
    assert got == [(0.5, "ok", True), (round(0.4 / 9 + 0.015 + 0.05, 6), "ok", True), (0.0, "audio vacío, RMS bajo, poca voz, SNR bajo, clipping", False)]


def test_gates_by_hand(spark):
    row = (0.7, 0.1, 0.8, 0.5, 9.0, 1.7, -0.2, 6.0, 2, 1, 0, "Relaxed")
    names = "face_conf double, face_margin double, face_track_consistency double, vad_ratio double, snr_db double, quality_score double, active_confidence double, syncnet_confidence double, syncnet_offset_frames int, syncnet_verified int, syncnet_unambiguous int, candidate_profile string"
    df = spark.createDataFrame([row], names).withColumn("pipeline_version", F.lit("1"))
    scored = gates.approval_scores(df, Settings()).first()
    # face (0.7 - 0.5) / 0.3, sync 2 / 7, snr (9 - 5) / 20; quality and activity are cut at 1 and 0
    assert scored["balanced_rank_score"] == pytest.approx(0.30 * 2 / 3 + 0.20 * 1 + 0.35 * 2 / 7 + 0 + 0.05 * 0.2)
    judged = lambda s, d=df: gates.eligibility(gates.approval_scores(d, s), s).first()
    assert not judged(Settings())["gate_sync"] and judged(Settings(competitor_check=False))["eligible"]
    assert not judged(Settings(competitor_check=False), df.drop("pipeline_version"))["gate_version"]
    assert not judged(Settings(real_asd_required=False))["gate_proposal"]


def test_settings_of_a_file(tmp_path, caplog, monkeypatch):
    monkeypatch.setenv("EMPTY_X", "")
    path = tmp_path / "c.yaml"
    (tmp_path / "here.jpg").write_bytes(b"")
    path.write_text("global: {face_template_threshold: 0.55, segments_per_video: 7, max_lost_frames: 9, nothing_of_ours: 1, note: '${EMPTY_X:-x}', references_dir: /refs}\ncelebrities:\n - {id: s1, name: n, reference_images: [here.jpg, away.jpg, sub/away.jpg, /abs.jpg], videos: [{youtube_id: a, priority: 0, use: 0}]}\n - {id: s2, name: ' ', videos: [{youtube_id: b}]}\n")
    with caplog.at_level(logging.WARNING, "cliploom"):
        s, found = config.load(path)
    assert (s.identity_threshold, s.max_per_video, s.track_max_lost, s.other) == (0.55, 7, 9, {"nothing_of_ours": 1, "note": ""})
    assert "nothing_of_ours" in caplog.text and s.folders["logs_dir"] == str(tmp_path / "logs")
    assert found.speakers[0]["reference_images"] == [str(tmp_path / "here.jpg"), "/refs/away.jpg", str(tmp_path / "sub/away.jpg"), "/abs.jpg"]
    assert found.videos == [{"speaker_id": "s1", "youtube_id": "a", "url": "", "split": "train", "priority": 1, "use": False}]
    loose = config.replace(s, real_asd_required=False).relaxed()
    assert (loose.min_face_size, loose.track_min_points, loose.target_segment_seconds, loose.min_active, loose.track_min_iou) == (60.0, 8, 6.0, 0.40, 0.15)
    assert all(p.is_dir() for p in config.make_folders(config.replace(s, folders={"logs_dir": str(tmp_path / "x/logs")})))


def test_tracks_by_hand(spark):
    df = spark.createDataFrame(faces("w", 12), DETECTIONS)
    rows = tracking.tracks(tracking.track(df, Settings()), Settings()).orderBy("track_id").collect()
    assert [r["track_id"] for r in rows] == ["w_track_0001", "w_track_0002"]
    assert (rows[0]["start_time"], rows[0]["end_time"], rows[0]["duration"], rows[0]["track_coverage"]) == (0.0, 2.2, 2.2, 1.0)
    assert rows[1]["avg_emb"] == [0.0, 1.0] and rows[1]["embedding_consistency"] == 1.0
    x = np.asarray([[1.0, 0.0], [0.8, 0.6], [0.6, 0.8], [-1.0, 0.0]])
    mean, share = tracking.inlier_mean(x, np.asarray([0.0, 1.0, 3.0, 5.0]), 0.45)
    want = (x[1] + 3 * x[2]) / 4  # the medoid is 0 or 1 by median likeness; -1 lies far from either
    assert mean == pytest.approx(want / np.linalg.norm(want)) and share == 0.75


def test_medoids_of_large_groups_in_blocks(spark, monkeypatch):
    g = np.random.default_rng(2)
    x = g.normal(size=(90, 6))
    df = spark.createDataFrame([("ab"[i % 3 == 0], i, r.tolist()) for i, r in enumerate(x)], "label string, k int, v array<double>")
    plain = sorted(map(tuple, vectors.medoids(df, "label", "k", "v").collect()))
    monkeypatch.setattr(vectors, "BLOCK", 7)
    assert [r[:2] for r in sorted(map(tuple, vectors.medoids(df, "label", "k", "v").collect()))] == [r[:2] for r in plain]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for label, medoid, likeness in plain:
        own = [i for i in range(90) if ("ab"[i % 3 == 0]) == label]
        medians = np.median(u[own] @ u[own].T, axis=1)
        assert own[int(medians.argmax())] == medoid and likeness == pytest.approx(medians.max())


def test_galleries_in_blocks_keep_the_two_best(spark, monkeypatch):
    g = np.random.default_rng(3)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    t, q = unit(g.normal(size=(40, 5))), unit(g.normal(size=(20, 5)))
    known = spark.createDataFrame([(f"s{i:02d}", r.tolist()) for i, r in enumerate(t)], "speaker_id string, template array<double>")
    faces_ = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)], "id int, e array<double>")
    monkeypatch.setattr(vectors, "GALLERY_BLOCK", 3)
    for r in vectors.identify(faces_, known, "id", "e", 0.0, 0.0).collect():
        scores = np.sort(t @ q[r["id"]])[::-1]
        assert (r["face_conf"], r["face_other_conf"]) == (pytest.approx(scores[0]), pytest.approx(scores[1]))


def test_verification_without_local_offsets(spark):
    d = np.full((100, 21), 10.0)
    d[:, 11] = 3.0  # one frame early
    d[0, 0] = np.nan
    rows = [(p, i, (v + (0 if p == "near" else 10 * (np.arange(21) == 2) * -1)).tolist()) for p in ("near", "far") for i, v in enumerate(d)]
    df = spark.createDataFrame(rows, "probe_id string, frame int, dist array<double>").fillna(0)
    df = df.withColumn("dist", F.transform("dist", lambda x: F.when(F.isnan(x), 10.0).otherwise(x)))
    probes = spark.createDataFrame([("near", 4.0), ("far", 4.0), ("none", 4.0)], "probe_id string, duration double")
    for s in (Settings(local_offset=False), Settings(framewise=False)):
        found, told = sync.verify(df, probes, s)
        by = {r["probe_id"]: r for r in told.collect()}
        assert (by["near"]["accepted"], by["near"]["offset_frames"], by["near"]["confidence"], by["near"]["min_distance"]) == (True, -1, pytest.approx(7.0), 3.0)
        assert not by["far"]["accepted"] and by["far"]["offset_frames"] == 8 and not by["none"]["accepted"] and by["none"]["offset_frames"] == 999
        assert {r["probe_id"] for r in found.collect()} == {"near"}
    nan = spark.createDataFrame([("p", 0, [float("nan"), 2.0] + [5.0] * 19)], "probe_id string, frame int, dist array<double>")
    assert sync.global_scores(nan, Settings()).first()["min_distance"] == 2.0


def test_clip_frames_interpolate_and_hold(spark):
    points = spark.createDataFrame([("t", f, 100.0 + 10 * f, 100.0, 200.0 + 10 * f, 200.0) for f in (10, 12)], "track_id string, frame int, x1 double, y1 double, x2 double, y2 double")
    probes = spark.createDataFrame([("p", "t", 0.0, 4.0)], "probe_id string, track_id string, start double, duration double")
    frames = {r["output_frame"]: r["crop"] for r in sync.clip_frames(probes, points, Settings()).collect()}
    # held for 5 detection frames around 10 to 12: from 1.0 s to 3.4 s
    assert len(frames) == 100 and [k for k, v in frames.items() if v is not None and (k < 25 or k > 85)] == []
    assert frames[55]["x1"] == 100 + 110 + 50 - 90 and frames[55]["x2"] - frames[55]["x1"] == 180  # frame 11: half way
    told = sync.complete_clips(sync.clip_frames(probes, points, Settings())).first()
    assert (told["total"], told["written"], told["complete"]) == (100, 61, False)


def test_budget_by_hand(spark):
    df = spark.createDataFrame([("v", i, n) for i, n in enumerate([20, 0, 30, 9, 9])], "video_id string, visit int, n_candidates int")
    rows = selection.budgeted(df, 25, 3).orderBy("visit").collect()
    # 25 in 3 windows: 9; 16 in 2: 8; 16 in 1: 16 of 30; then 25 are there
    assert [(r["budget"], r["taken"], r["visited"]) for r in rows] == [(9, 9, True), (8, 0, True), (16, 16, True), (0, 0, False), (0, 0, False)]
    full = selection.budgeted(df.withColumn("existing", F.lit(25)), 25, 3).orderBy("visit").collect()
    assert [r["taken"] for r in full] == [1, 0, 1, 0, 0]  # a region is looked at all the same


def test_windows_by_mode(spark):
    df = spark.createDataFrame([("a", 1250.0), ("b", 30.0)], "video_id string, video_duration double")
    told = lambda **k: [(r["video_id"], r["start"], r["duration"], r["tag"]) for r in intervals.video_windows(df, **k).orderBy("video_id", "idx").collect()]
    assert told() == [("a", 0.0, 600.0, "w0000_000000"), ("a", 600.0, 600.0, "w0001_000600"), ("b", 0.0, 30.0, "w0000")]
    assert told(mode="Off") == [("a", 0.0, 1250.0, "full"), ("b", 0.0, 30.0, "full")]
    assert told(begin=100.0, most=1)[0] == ("a", 100.0, 600.0, "w0000_000100")
    assert [r[1] for r in told(most=3, strategy="uniform") if r[0] == "a"] == [0.0, 325.0, 650.0]


def test_local_videos_want_their_own_kind(spark):
    videos = spark.createDataFrame([(x, "") for x in "abcd"], "youtube_id string, use string")
    files = spark.createDataFrame([("v/a.mp4",), ("v/b.f1.webm",), ("v/c copy.mp4",), ("v/dd.mp4",)], "path string")
    got = {r["youtube_id"]: (r["missing"], r["near"]) for r in manifest.local_videos(videos, files).collect()}
    assert got == {"a": (False, None), "b": (True, "v/b.f1.webm"), "c": (True, None), "d": (True, None)}


def test_boxes_by_hand(spark):
    box = columns.box_of(F.lit(10.0), F.lit(20.0), F.lit(0.4), F.lit(30.0))
    r = spark.range(1).select(columns.corner_box(box).alias("b"), columns.mouth_box(columns.box_of(*map(F.lit, (0.0, 0.0, 100.0, 100.0))), 200, 200).alias("m")).first()
    assert tuple(r["b"]) == (10.0, 20.0, 11.0, 50.0)
    assert tuple(r["m"]) == (0, 43, 101, 104)  # 20-80 and 55-92, with margins of 21 and 12


def test_voice_masks_of_frames():
    x = np.zeros(100, np.float32)
    x[40:60] = 1.0

    def decide(raw, rate):
        if raw == b"":
            raise ValueError
        return np.frombuffer(raw, "<i2").max() > 0

    mask = models.frame_mask(x, 1000, decide, 10)
    assert mask.tolist() == [35 <= i < 65 for i in range(100)]
    assert models.frame_mask(x[:5], 1000, decide, 10).all()
    assert models.frame_mask(x, 1000, lambda raw, rate: 1 / 0, 10).sum() == 100  # errors count as speech
    assert set(models.ready({"good": lambda: None, "bad": lambda: 1 / 0})) == {"bad"}


def test_resampling_keeps_the_tone_and_truncates():
    t = np.arange(800) / 800
    x = np.sin(2 * np.pi * 5 * t)
    for to in (400, 1600, 333):
        n = int(800 * to / 800)
        assert media.resample(x, 800, to) == pytest.approx(np.sin(2 * np.pi * 5 * np.arange(n) / to), abs=1e-3)
    assert len(media.resample(np.ones(3), 16000, 1000)) == 1
    even = np.asarray([1.0, -1.0] * 4)
    assert media.resample(even, 8, 16)[::2] == pytest.approx(even, abs=1e-6)


def test_stretches_and_floors(spark):
    v = F.array(*(F.lit(float(i)) for i in range(10)))
    r = spark.range(1).select(arrays.stretch(v, 4, F.lit(0.5), F.lit(1.3)).alias("a"), arrays.stretch(v, 4, F.lit(2.0), F.lit(1.0)).alias("b"), arrays.noise_floor(F.array(F.lit(1.0)), 100).alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == ([2.0, 3.0, 4.0], [], 1e-6)


def test_in_time_and_detected(spark):
    df = spark.createDataFrame([(1, 2.0, 0.1), (2, 1.0, 0.2), (3, 1.0, 0.9)], "id int, start double, confidence double")
    assert [r["id"] for r in proposals.in_time(df).collect()] == [3, 2, 1]
    assert columns.CORNERS == ("x1", "y1", "x2", "y2")
