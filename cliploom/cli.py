"""The command line: python -m cliploom.cli STAGE --config FILE ...

candidates makes clips of detected faces and audio (tables windows, detections,
references and audio, and distances or --sync) or takes verified segments (windows and
segments) as they are; approve selects, ensure-coverage makes candidates of short
speakers again, export copies and removes files, validate reports, preflight and
check-videos test manifests, build-config joins them, protocol writes trials, review a
page. Tables are Parquet folders below --workspace.
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import logging
import os
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .functions.columns import canonical_path, run_tag
from .operators import candidates, chain, gates, intervals, manifest, rejections, review, selection, stats, store, trials
from .schema import CANDIDATES, REJECTIONS, SPEAKERS, VIDEOS, conform, require
from .sources import media, models, tables

#: The names of the stages and options.
STAGES = ("candidates", "approve-auto", "ensure-coverage", "export", "validate", "all", "preflight", "build-config", "check-videos", "protocol", "review")
log = logging.getLogger("cliploom")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cliploom", description=__doc__)
    p.add_argument("stage", nargs="?", default="all", choices=STAGES)
    p.add_argument("--stage", dest="stage_too", choices=STAGES)
    p.add_argument("--config", "--base-config", dest="config", required=True)
    p.add_argument("--workspace", default="workspace")
    p.add_argument("--speaker-id", action="append", default=[])
    p.add_argument("--limit-videos", type=int)
    p.add_argument("--resume", action="store_true", help="leave finished units alone, as is done anyway")
    p.add_argument("--no-resume", action="store_true", help="process finished units again")
    p.add_argument("--force", action="store_true", help="replace earlier rows of the chosen speakers")
    p.add_argument("--skip-complete-speakers", action="store_true")
    p.add_argument("--relaxed-candidates", action="store_true")
    p.add_argument("--coverage-relaxed-retry", action=argparse.BooleanOptionalAction, default=None)
    p.add_argument("--min-clips-per-speaker", type=int)
    p.add_argument("--min-duration-per-speaker-sec", type=float)
    p.add_argument("--max-speaker-attempts", type=int)
    p.add_argument("--sync", help="module:factory of a model that gives the distances of clips")
    p.add_argument("--speakers")
    p.add_argument("--videos")
    p.add_argument("--exclude-speakers-file")
    p.add_argument("--min-videos-per-speaker", type=int, default=2)
    p.add_argument("--limit-speakers", type=int)
    p.add_argument("--video-dir")
    p.add_argument("--fail-if-missing", action="store_true")
    p.add_argument("--out-missing")
    p.add_argument("--metadata")
    p.add_argument("--split")
    p.add_argument("--output-dir")
    p.add_argument("--target-trials", type=int, default=5000)
    p.add_argument("--non-target-trials", type=int, default=50_000)
    p.add_argument("--seed", type=int, default=2026)
    p.add_argument("--candidates")
    p.add_argument("--sample-per-speaker", type=int, default=0)
    p.add_argument("--approved-only", action="store_true")
    p.add_argument("--package", action="append", default=[], help="a Python package that preflight asks for")
    p.add_argument("--model-file", action="append", default=[], help="a file that preflight asks for")
    p.add_argument("--out")
    return p


def log_to(folder: str | Path) -> Path:
    """Tells the log to a file of its own too, named by the time and process."""
    for old in [h for h in log.handlers if isinstance(h, logging.FileHandler)]:
        log.removeHandler(old)
        old.close()
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = Path(folder) / f"cliploom_{dt.datetime.now():%Y%m%d_%H%M%S}_{os.getpid()}.log"
    handler = logging.FileHandler(path, encoding="utf-8")
    handler.setFormatter(logging.Formatter("%(asctime)s [%(levelname)-8s] %(message)s", "%H:%M:%S"))
    log.addHandler(handler)
    return path


class Job:
    """One run over a workspace."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace):
        self.spark, self.args, self.root = spark, args, args.workspace.rstrip("/")
        self.settings, self.manifest = config.load(args.config)
        if args.relaxed_candidates:
            self.settings = self.settings.relaxed()
        self.settings.check()
        self.held: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def local(self, name: str) -> str:
        """As the file system that all machines mount names it."""
        return self.path(name).removeprefix("file://")

    def read(self, name: str) -> DataFrame:
        return store.read_scoped(self.spark, self.path(name))

    def hadoop(self, path: str):
        here = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return here.getFileSystem(self.spark._jsc.hadoopConfiguration()), here

    def has(self, name: str) -> bool:
        fs, here = self.hadoop(self.path(name))
        return fs.exists(here)

    def hold(self, df: DataFrame) -> DataFrame:
        """df, stored in the workspace until the stage ends."""
        path = self.path(f"_held/{len(self.held)}")
        df.write.mode("overwrite").parquet(path)
        self.held.append(path)
        return self.spark.read.parquet(path)

    def drop_held(self) -> None:
        fs, here = self.hadoop(self.path("_held"))
        fs.delete(here, True)
        self.held.clear()

    def speakers(self) -> DataFrame:
        rows = [(s["speaker_id"],) for s in self.manifest.speakers]
        out = self.spark.createDataFrame(rows, "speaker_id string")
        if self.args.speaker_id:
            wanted = self.spark.createDataFrame([(x,) for x in self.args.speaker_id], "speaker_id string")
            out, unknown = manifest.subset(out, wanted)
            if names := [r[0] for r in unknown.collect()]:
                raise SystemExit(f"unknown speakers: {', '.join(sorted(names))}")
        if self.args.skip_complete_speakers and self.has("approved_segments"):
            done = stats.completed(self.read("approved_segments"), self.settings.target_per_speaker)
            out = out.join(done, "speaker_id", "left_anti")
        return out

    def people(self) -> DataFrame:
        rows = [(s["speaker_id"], s["name"], s["gender"], s["category"], s["region"]) for s in self.manifest.speakers]
        return self.spark.createDataFrame(rows, "speaker_id string, name string, gender string, category string, region string")

    def videos(self) -> DataFrame:
        """Usable videos of the chosen speakers, speaker by speaker as the file has them,
        each by priority; the first ones alone if so many are asked for."""
        order = {s["speaker_id"]: i for i, s in enumerate(self.manifest.speakers)}
        rows = [(v["speaker_id"], v["youtube_id"], v["priority"], order[v["speaker_id"]], i, v["url"]) for i, v in enumerate(self.manifest.videos) if v["use"]]
        listed = self.spark.createDataFrame(rows, "speaker_id string, video_id string, priority int, speaker int, place int, url string")
        own = manifest.in_order(listed.join(self.speakers(), "speaker_id", "left_semi"), "place")
        if self.args.limit_videos is not None:
            own = own.orderBy("speaker", "position").limit(self.args.limit_videos)
        return own.select("speaker_id", "video_id", "url", "position")

    def pairs(self) -> DataFrame:
        return self.videos().select("speaker_id", "video_id")

    def every_pair(self) -> DataFrame:
        rows = [(v["speaker_id"], v["youtube_id"]) for v in self.manifest.videos if v["use"]]
        return self.spark.createDataFrame(rows, "speaker_id string, video_id string")

    def distances(self) -> chain.Sync:
        """The model of --sync, else a table distances (probe_id, frame, dist) that was
        made outside for the probes of the table probes."""
        if not self.args.sync:
            return lambda probes: self.read("distances").join(probes.select("probe_id").distinct(), "probe_id", "left_semi")
        module, _, name = self.args.sync.partition(":")
        factory = getattr(importlib.import_module(module), name)
        if problems := models.ready({"sync": factory}):
            raise SystemExit(f"the sync model does not load: {problems['sync']}")
        told = F.struct("window_id", "track_id", "start", "end", "duration")
        return lambda probes: models.sync_distances(probes.withColumn("clip", told), factory)

    def windows(self) -> DataFrame:
        """Windows of the configured videos, with the order in which they are visited."""
        visits = intervals.stratified(self.read("windows").select("video_id", "idx", "start", "duration", "tag", "video_duration"))
        return visits.join(self.pairs(), "video_id").withColumn("window_id", F.concat_ws("::", "video_id", "tag"))

    def made_segments(self, units: DataFrame, existing: DataFrame | None, tag: str) -> DataFrame:
        """Candidates of pending units from faces and audio, their clips written."""
        s = self.settings
        pending = units.select("speaker_id", F.col("processing_unit_id").alias("window_id"))
        windows = self.windows().join(pending, ["speaker_id", "window_id"], "left_semi")
        tables_ = (self.read(n) for n in ("detections", "references", "audio"))
        found = chain.candidate_segments(windows, *tables_, self.distances(), s, existing, self.hold)
        clips = self.hold(media.encoded(found, s.audio_sr))
        name = F.concat(F.concat_ws("/", F.lit(self.local("clips")), "speaker_id", "video_id", F.concat_ws("_", "clip_key", *([F.lit(tag)] if tag else []))), F.lit(".wav"))
        named = clips.withColumn("candidate_path", name)
        written = self.hold(media.write_files(named.select(F.col("candidate_path").alias("path"), F.col("wav").alias("content"))))
        if bad := written.where("error is not null").limit(5).collect():
            raise SystemExit(f"clips that can't be written: {', '.join(r['path'] for r in bad)}")
        people = self.people().withColumnRenamed("name", "speaker_name")
        told = named.drop("wav", "clip_key").join(people, "speaker_id", "left")
        return told.join(self.videos().select("speaker_id", "video_id", "url"), ["speaker_id", "video_id"], "left")

    def candidates(self, again: DataFrame | None = None, tag: str = "") -> None:
        """Segments of pending units become candidates; the ledger takes every unit that
        was looked at, with its number of candidates. `again`: speakers whose units are
        all made anew, beside what they have already."""
        s = self.settings
        windows = self.read("windows").join(self.pairs(), "video_id")
        unit = F.concat_ws("::", "video_id", "tag")
        units = windows.select("speaker_id", "video_id", F.col("tag").alias("chunk_tag"), unit.alias("processing_unit_id")).distinct()
        if again is not None:
            units = units.join(again.select("speaker_id").distinct(), "speaker_id", "left_semi")
        elif self.has("processed_units") and not self.args.no_resume and not self.args.force:
            units = rejections.not_done(units, self.read("processed_units"))
        units = self.hold(units)
        before = self.read("candidates") if self.has("candidates") else None
        kept = None
        if before is not None and again is not None:
            own = before.join(again.select("speaker_id").distinct(), "speaker_id", "left_semi")
            kept = self.hold(gates.reprocess_filter(own, again, s))
        if self.has("detections"):
            earlier = kept if kept is not None else before
            existing = None if earlier is None or self.args.force else stats.candidate_counts(earlier)
            found = self.made_segments(units, existing, tag)
        else:
            found = self.read("segments").join(units.select("speaker_id", "video_id", "chunk_tag"), ["speaker_id", "video_id", "chunk_tag"], "left_semi")
        rows = candidates.candidate_rows(found, intervals.stratified(self.read("windows")), s)
        rows = rows.withColumn("row_ord", F.xxhash64("speaker_id", "processing_unit_id", "candidate_idx", "candidate_path"))
        rows = rows.withColumn("fresh", F.lit(1))
        if kept is not None:
            rows = kept.withColumn("fresh", F.lit(0)).unionByName(rows, allowMissingColumns=True)
        rows = self.hold(store.keep_first_digest(rows, F.asc("fresh")).drop("fresh"))
        scope = lambda df: df.withColumn("scope", F.concat_ws("|", "speaker_id", "processing_unit_id"))
        counts = rows.groupBy("speaker_id", "processing_unit_id").agg(F.count("*").cast("int").alias("n_candidates"))
        ledger = units.join(counts, ["speaker_id", "processing_unit_id"], "left").fillna(0, ["n_candidates"])
        ledger = ledger.withColumn("candidate_profile", F.lit(s.candidate_profile))
        ledger = ledger.withColumn("processed_at", F.date_trunc("second", F.current_timestamp())).withColumn("row_ord", F.lit(0))
        owned = scope(units).select("scope")
        store.write_scoped(self.spark, self.path("candidates"), scope(rows.drop("scope")), owned, ["scope", "candidate_path", "row_ord"], "scope")
        store.write_scoped(self.spark, self.path("processed_units"), scope(ledger), owned, ["scope"], "scope")

    def rejected(self) -> DataFrame:
        """Manual rejections, those by utterance resolved through the latest export."""
        if not self.has("manual_rejections.csv"):
            return self.spark.createDataFrame([], REJECTIONS)
        bad = tables.csv_table(self.spark, self.path("manual_rejections.csv"), REJECTIONS).fillna("")
        if not self.has("utterances"):
            return bad
        found, unknown = rejections.resolved(bad, self.read("utterances"))
        if names := [r[0] for r in unknown.limit(20).collect()]:
            log.warning("rejections not found in the latest export: %s", ", ".join(sorted(names)))
        none = F.lit("")
        return bad.unionByName(found.select("sha1", "candidate_path", none.alias("utterance_id"), none.alias("audio_filename")))

    def clips(self, rows: DataFrame) -> DataFrame:
        """rows with file_exists, by what lies below clips; without that folder all do."""
        if not self.has("clips"):
            return rows.withColumn("file_exists", F.lit(True))
        fs, here = self.hadoop(self.path("clips"))
        whole = fs.makeQualified(here).toUri().getPath()
        listed = tables.listing(self.spark, self.path("clips"), ".wav").select(F.regexp_replace("path", "^[a-z]+:/*", "/").alias("path"))
        own = listed.select(F.replace("path", F.lit(whole), F.lit(self.local("clips"))).alias("path"))
        return rejections.existing(rows, own)

    def approve(self) -> DataFrame:
        s = self.settings
        rows = conform(self.read("candidates"), CANDIDATES).join(self.speakers(), "speaker_id", "left_semi")
        pairs = self.every_pair()
        rows = self.clips(rejections.mark_rejected(manifest.of_pairs(rows, pairs), self.rejected()))
        judged = gates.eligibility(gates.approval_scores(rejections.digest(rows), s), s)
        ranked = selection.ranked(judged.where("eligible"))
        processed = manifest.of_pairs(self.read("processed_units"), pairs) if self.has("processed_units") else None
        limits = (s.target_per_speaker, s.max_per_video, s.min_per_video, s.max_selected_iou, s.allow_video_cap_overflow)
        done = selection.with_approval(judged, selection.select_balanced(ranked, processed, *limits))
        store.write_scoped(self.spark, self.path("approved_segments"), done, self.speakers(), ["speaker_id", "row_ord"])
        return self.read("approved_segments").where("approved = 1")

    def retry(self, short: DataFrame, n: int) -> None:
        """All units of short speakers anew, beside what they have; at the looser profile
        if that is asked for."""
        asked = self.args.coverage_relaxed_retry
        strict = self.settings
        if strict.retry_relaxed if asked is None else asked:
            self.settings = strict.relaxed()
        try:
            tag = self.spark.range(1).select(run_tag(F.current_timestamp())).first()[0]
            self.candidates(short, f"{tag}_{n}")
        finally:
            self.settings = strict

    def coverage(self) -> None:
        a, s = self.args, self.settings
        if not self.has("candidates"):
            self.candidates()
        clips = s.min_clips if a.min_clips_per_speaker is None else a.min_clips_per_speaker
        seconds = s.min_duration if a.min_duration_per_speaker_sec is None else a.min_duration_per_speaker_sec
        tries = s.retries if a.max_speaker_attempts is None else a.max_speaker_attempts
        if clips < 1 or seconds < 0 or tries < 0:
            raise ValueError("coverage asks for at least one clip, and for no negative time or tries")
        found = stats.ensure_coverage(self.retry, self.speakers(), self.approve, clips, seconds, s.min_source_videos, tries, self.hold)
        named = found.join(self.people().select("speaker_id", F.col("name").alias("speaker_name")), "speaker_id", "left")
        named.write.mode("overwrite").parquet(self.path("speaker_coverage"))
        short = [r["speaker_id"] for r in self.read("speaker_coverage").where("status = 'insufficient'").collect()]
        if short and s.fail_if_insufficient:
            raise SystemExit(f"speakers short of clips: {', '.join(sorted(short))}")

    def export(self) -> None:
        """Utterances, their files, speakers, trials and the train list. Copies replace
        what the export folder held of the same speakers before."""
        s = self.settings
        approved = self.read("approved_segments").where("approved = 1")
        bad = stats.export_gate(stats.coverage(self.speakers(), approved), s.target_per_speaker, s.min_source_videos)
        if names := [r["speaker_id"] for r in bad.collect()]:
            if s.exact_export:
                raise SystemExit(f"speakers that can't be exported: {', '.join(sorted(names))}")
            log.warning("exported without their quota: %s", ", ".join(sorted(names)))
        named = candidates.with_names(approved.join(self.speakers(), "speaker_id", "left_semi"), self.people())
        utterances = candidates.with_utterances(named.where("file_exists"), root=self.local("export/wav"))
        if utterances.isEmpty():
            raise SystemExit("no approved clip has a file")
        utterances.write.mode("overwrite").parquet(self.path("utterances"))
        clips = self.read("utterances").withColumn("path", F.col("export_path"))
        if self.has("clips"):
            self.copy_clips(clips)
        stats.speaker_metadata(clips).write.mode("overwrite").parquet(self.path("speaker_metadata"))
        for mode in "AB":
            tables.write_lines(trials.in_pipeline(clips, mode, most=s.max_trials), self.path(f"trials_{mode}"), "label", "path1", "path2")
        tables.write_lines(candidates.train_list(clips), self.path("train_list"), "value")

    def copy_clips(self, clips: DataFrame) -> None:
        listed = self.spark.createDataFrame([], "path string")
        root = self.local("export/wav")
        if self.has("export/wav"):
            fs, here = self.hadoop(root)
            whole = fs.makeQualified(here).toUri().getPath()
            found = tables.listing(self.spark, root, ".wav").select(F.regexp_replace("path", "^[a-z]+:/*", "/").alias("path"))
            listed = self.hold(found.select(F.replace("path", F.lit(whole), F.lit(root)).alias("path")))
        copies, stale = candidates.copy_plan(clips, listed)
        done = self.hold(media.copy_files(copies))
        for r in done.where("error is not null").limit(20).collect():
            log.warning("not copied: %s (%s)", r["target"], r["error"])
        gone = self.hold(media.deleted(stale)).count()
        log.info("%d files copied, %d old ones removed", done.where("error is null").count(), gone)

    def validate(self) -> None:
        s = self.settings
        rows = self.read("utterances")
        if rows.isEmpty():
            raise SystemExit("there are no utterances")
        per = stats.speaker_stats(rows)
        per.orderBy("n_utterances", "speaker_id").write.mode("overwrite").parquet(self.path("speaker_stats"))
        stats.video_stats(rows).orderBy("n_utterances", "speaker_id", "video_id").write.mode("overwrite").parquet(self.path("video_stats"))
        rules = stats.expectations(rows, s.pipeline_version, s.max_segment_seconds, most_iou=s.max_selected_iou)
        told = stats.summary(per, rows, s.target_per_speaker, s.report_min_utterances)
        Path(self.args.out or "VALIDATION.md").write_text(review.markdown("Validation", told, rules), encoding="utf-8")
        if broken := [r["rule"] for r in rules.where("violations > 0").collect()]:
            raise SystemExit(f"rules broken: {', '.join(broken)}")

    def manifests(self) -> tuple[DataFrame, DataFrame]:
        told, listed = tables.csv_strings(self.spark, self.args.speakers), tables.csv_strings(self.spark, self.args.videos)
        require(told, "speaker_id", "name", "reference_images")
        require(listed, "speaker_id", "youtube_id")
        written = SPEAKERS.replace("reference_images array<string>", "reference_images string").replace("birth_year int", "birth_year string")
        videos = manifest.usable_videos(conform(listed, VIDEOS, {"priority": 1}))
        return manifest.usable_speakers(conform(told, written)), videos

    def build_config(self) -> None:
        speakers, videos = self.manifests()
        if self.args.exclude_speakers_file:
            speakers = manifest.without_excluded(speakers, tables.lines(self.spark, self.args.exclude_speakers_file))
        both = manifest.with_enough_videos(speakers, videos, self.args.min_videos_per_speaker)
        rows = both.groupBy("speaker_id").agg(*(F.first(c).alias(c) for c in ("name", "gender", "category", "region", "birth_year", "reference_images")), F.array_sort(F.collect_list(F.struct("priority", "youtube_id", "url", "split"))).alias("videos")).orderBy("speaker_id")
        found = (rows.limit(self.args.limit_speakers) if self.args.limit_speakers else rows).collect()
        import yaml

        if not found:
            raise SystemExit("no speakers left")
        names = ("name", "gender", "category", "region", "birth_year")
        listed = [{"id": r["speaker_id"], **{k: r[k] for k in names}, "reference_images": list(r["reference_images"]), "videos": [v.asDict() | {"use": True} for v in r["videos"]]} for r in found]
        base = yaml.safe_load(Path(self.args.config).read_text(encoding="utf-8")) or {}
        config.save(self.args.out, {k: v for k, v in base.items() if k not in config.LISTS} | {"speakers": listed})

    def preflight(self) -> None:
        """All that is missing, told at once. References and videos count if their files
        are there; without a folder of videos all configured ones do."""
        s = self.settings
        problems = manifest.environment_problems(s, len(self.manifest.speakers), tuple(self.args.package), tuple(self.args.model_file))
        images = [(p["speaker_id"], sum(Path(i).is_file() for i in p["reference_images"])) for p in self.manifest.speakers]
        known = Path(s.folders["download_path"])
        videos = [(v["speaker_id"], v["youtube_id"], not known.is_dir() or (known / f"{v['youtube_id']}.mp4").is_file()) for v in self.manifest.videos if v["use"]]
        speakers = self.spark.createDataFrame(images, "speaker_id string, n_references long")
        listed = self.spark.createDataFrame(videos, "speaker_id string, youtube_id string, local boolean")
        limits = (s.target_per_speaker, s.max_per_video, s.min_per_video, s.min_references, s.min_source_videos)
        found = manifest.preflight(speakers.select("speaker_id"), listed, speakers, *limits).orderBy("speaker_id", "problem").collect()
        for said in [*problems, *(f"{r['speaker_id']}: {r['problem']}" for r in found)]:
            log.error("%s", said)
        if problems or found:
            raise SystemExit(2)

    def check_videos(self) -> None:
        """The list of videos without <id>.mp4, or none if all are there."""
        if self.args.fail_if_missing and not self.hadoop(self.args.video_dir)[0].exists(self.hadoop(self.args.video_dir)[1]):
            raise SystemExit(2)
        videos = require(tables.csv_strings(self.spark, self.args.videos), "youtube_id")
        videos = videos if "use" in videos.columns else videos.withColumn("use", F.lit(""))
        found = manifest.local_videos(videos, tables.listing(self.spark, self.args.video_dir))
        for r in found.where("missing and near is not null").limit(20).collect():
            log.warning("%s is there, but %s.mp4 is asked for", r["near"], r["youtube_id"])
        missing = found.where("missing").select("youtube_id").orderBy("youtube_id")
        n = tables.write_list(missing, self.args.out_missing or self.args.out or "missing_videos", "youtube_id")
        if self.args.fail_if_missing and n:
            raise SystemExit(3)

    def protocol(self) -> None:
        """The train list, trials of validation and test, and of test those of each
        gender alone."""
        folder = (self.args.output_dir or self.path("evaluation")).rstrip("/")
        told = tables.csv_strings(self.spark, self.args.metadata) if self.args.metadata else self.read("utterances")
        splits = require(tables.csv_strings(self.spark, self.args.split), "speaker_id", "gender", "split")
        there = [F.col(c) if c in told.columns else F.lit(None) for c in ("utterance_id", "export_path", "audio_path")]
        rows = require(told, "speaker_id", "video_id").withColumn("path", canonical_path("speaker_id", "video_id", *there))
        tables.write_lines(trials.train_rows(trials.of_splits(rows, splits)), f"{folder}/train_list", "speaker_id", "path")
        made = trials.protocol(rows, splits, self.args.seed, self.args.target_trials, self.args.non_target_trials)
        of = trials.of_splits(rows, splits)
        for (split, mode), found in made.items():
            name = f"{folder}/{trials.SPLITS[split]}_trials_{mode}"
            tables.write_lines(found, name, "label", "path1", "path2")
            if split == trials.GENDERED:
                per = trials.gender_subset(found, of)
                for gender in trials.GENDERS:
                    tables.write_lines(per.where(F.col("gender") == gender), f"{name}_{gender}", "label", "path1", "path2")

    def review(self) -> None:
        rows = tables.csv_strings(self.spark, self.args.candidates) if self.args.candidates else self.read("approved_segments")
        if self.args.approved_only and "approved" in rows.columns:
            rows = rows.where(F.col("approved").cast("int") == 1)
        if self.args.sample_per_speaker:
            key = "row_ord" if "row_ord" in rows.columns else "candidate_path"
            rows = review.boundary_sample(rows, self.args.sample_per_speaker, str(self.args.seed), key)
        ordered = rows.orderBy(*review.risk_order(rows)) if review.risk_order(rows) else rows
        log.info("%d rows", review.review_page(ordered, self.args.out or "candidates_review.html"))

    def run(self, stage: str) -> None:
        steps = {
            "candidates": [self.candidates],
            "approve-auto": [self.approve],
            "ensure-coverage": [self.coverage],
            "export": [self.export],
            "validate": [self.validate],
            "all": [self.candidates, self.coverage, self.export, self.validate],
            "preflight": [self.preflight],
            "build-config": [self.build_config],
            "check-videos": [self.check_videos],
            "protocol": [self.protocol],
            "review": [self.review],
        }
        for step in steps[stage]:
            log.info("%s", step.__name__)
            try:
                step()
            finally:
                self.drop_held()


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    args.stage = args.stage_too or args.stage
    if args.relaxed_candidates and args.stage not in ("candidates", "all"):
        raise SystemExit("--relaxed-candidates goes with the stages candidates and all")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    folder = args.workspace.removeprefix("file://")
    if "://" not in folder:
        log_to(Path(folder) / "logs")
    spark = SparkSession.builder.appName("cliploom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    Job(spark, args).run(args.stage)
    return 0


if __name__ == "__main__":
    sys.exit(main())
