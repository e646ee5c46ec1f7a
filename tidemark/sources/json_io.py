"""Nested annotation documents at the edge: read, flatten to child tables, assemble, write, validate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import duration_bucket
from tidemark.operators.incremental import manifest_rows

SCHEMA = """
video_id string,
meta struct<genre: string, title: struct<zh: string, en: string>, duration_sec: double, duration_bucket: string, source: string, license: string, url: string, release_date: string, primary_lang: string, has_subtitle: boolean, subtitle_langs: array<string>>,
structure struct<
  shots: array<struct<id: bigint, start: double, end: double, desc: struct<zh: string, en: string>>>,
  scenes: array<struct<id: bigint, start: double, end: double, summary: struct<zh: string, en: string>>>,
  events: array<struct<id: string, span: array<double>, desc: struct<zh: string, en: string>, type: string, modality: array<string>, importance: string, boundary_state: string, causes: array<string>, scene_id: bigint>>,
  segments: array<struct<start: double, end: double, description: struct<zh: string, en: string>>>,
  subtitles: array<struct<start: double, end: double, text: string, lang: string>>,
  ocr: array<struct<start: double, end: double, text: string, confidence: double>>,
  audio_events: array<struct<start: double, end: double, type: string, confidence: double>>>,
qa array<struct<qid: string, task_type: string, capability: array<string>, question: struct<zh: string, en: string>, options: array<struct<id: string, text: struct<zh: string, en: string>>>, answer: string, temporal_target: array<double>, evidence_spans: array<array<double>>, min_watch: string, is_gold: boolean>>,
annotation_meta struct<review_status: string, gaps: array<struct<start: double, end: double, reason: string>>, schema_valid: boolean, stages: map<string, struct<state: string, error: string>>>
"""
TRACKS = ("shots", "scenes", "events", "segments", "subtitles", "ocr", "audio_events")
BAD = "_corrupt"


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Whole-document JSON files; manifests are skipped, unreadable files come with ``_corrupt`` and no questions."""
    found = spark.read.schema(f"{SCHEMA}, {BAD} string").json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD, pathGlobFilter="*.json")
    return found.where(~F.col("_metadata.file_name").endswith(".manifest.json"))


def usable(annotations: DataFrame) -> DataFrame:
    return annotations.where(f"{BAD} is null and qa is not null").drop(BAD)


def track(annotations: DataFrame, name: str) -> DataFrame:
    """A child table: one row an element, with its place."""
    return annotations.select("video_id", F.posexplode(F.col("qa") if name == "qa" else F.col(f"structure.{name}")).alias("ord", "x")).select("video_id", "ord", "x.*")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """``{"responses": [...]}`` files as rows; an interval becomes two columns."""
    rows = spark.read.schema("responses array<struct<qid: string, annotator: string, answer: string, interval: array<double>, text: string>>").json(path, multiLine=True)
    return rows.selectExpr("inline(responses)").select("qid", "annotator", "answer", F.try_element_at("interval", F.lit(1)).alias("iv_start"), F.try_element_at("interval", F.lit(2)).alias("iv_end"), "text")


def listing(files: DataFrame, extensions: tuple[str, ...]) -> DataFrame:
    """Files (path) with a known extension, by the extensions' order, then name."""
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    rank = F.array_position(F.array(*map(F.lit, extensions)), ext)
    return files.withColumn("ext_rank", rank).where("ext_rank > 0").withColumn("stem", F.regexp_extract("path", r"([^/]*)\.[A-Za-z0-9]+$", 1))


def default_meta(videos: DataFrame, metas: DataFrame, subtitles: DataFrame, lang: str = "zh", today: str | None = None) -> DataFrame:
    """A skeleton for videos (video_id, duration) without meta; the language is that of the first subtitle.

    Genre and license are placeholders, which people must fill before a release. ``today`` stamps the date. A language
    other than zh and en counts as the default ``lang``, and only those two are listed as subtitle languages.
    """
    first = subtitles.groupBy("video_id").agg(F.min_by("lang", "start").alias("first"))
    out = videos.join(metas.select("video_id"), "video_id", "left_anti").join(first, "video_id", "left").withColumn("first", F.coalesce("first", F.lit(lang)))
    seconds = F.round(F.coalesce("duration", F.lit(0.0)), 3)
    known = F.col("first").isin("zh", "en")
    return out.select(
        "video_id", F.lit("unknown").alias("genre"), seconds.alias("duration_sec"), duration_bucket(seconds).alias("duration_bucket"), F.lit("local").alias("source"), F.lit("UNSPECIFIED").alias("license"),
        F.lit(None).cast("string").alias("url"), F.lit(today).alias("release_date"), F.when(known, F.col("first")).otherwise("zh").alias("primary_lang"), F.lit(False).alias("has_subtitle"),
        F.when(known, F.array("first")).otherwise(F.array().cast("array<string>")).alias("subtitle_langs"),
    )


def assemble(videos: DataFrame, tracks: dict[str, DataFrame]) -> DataFrame:
    """Child tables back to one document a video, elements in order, missing tracks empty; ``_`` columns are left out."""
    out = videos
    for name, rows in tracks.items():
        fields = [c for c in rows.columns if c not in ("video_id", "ord") and not c.startswith("_")]
        items = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct(*fields).alias("x")))), lambda e: e["x"])
        out = out.join(rows.groupBy("video_id").agg(items.alias(name)), "video_id", "left")
        out = out.withColumn(name, F.coalesce(name, F.array().cast(out.schema[name].dataType)))
    return out


def final(videos: DataFrame, metas: DataFrame, tracks: dict[str, DataFrame], states: DataFrame, gaps: DataFrame, today: str | None = None) -> DataFrame:
    """The products: every video with its meta, all of ``TRACKS`` (missing ones empty), questions, and what the manifest
    says, as drafts."""
    given = {name: tracks[name] for name in TRACKS if name in tracks}
    out = assemble(videos.select("video_id"), given | ({"qa": tracks["qa"]} if "qa" in tracks else {}))
    empty = F.array().cast("array<string>")
    structure = F.struct(*(F.col(n) if n in given else empty.alias(n) for n in TRACKS)).alias("structure")
    out = out.select("video_id", structure, F.col("qa") if "qa" in tracks else empty.alias("qa"))
    meta = metas.select("video_id", F.struct(*(c for c in metas.columns if c != "video_id")).alias("meta"))
    out = out.join(meta, "video_id", "left").join(manifest_rows(states, gaps), "video_id", "left")
    return out.select("video_id", "meta", "structure", "qa", F.struct(F.lit("draft").alias("review_status"), F.lit(today).alias("created_date"), "stages", "gaps").alias("annotation_meta"))


def overwrite_tracks(old: DataFrame, new: DataFrame, names: list[str]) -> DataFrame:
    """New tracks over old ones; a null new track keeps the old."""
    fresh = new.select("video_id", *(F.col(n).alias(f"__{n}") for n in names))
    out = old.join(fresh, "video_id", "left")
    for n in names:
        out = out.withColumn(n, F.coalesce(f"__{n}", n)).drop(f"__{n}")
    return out


def write_version(documents: DataFrame, path: str) -> None:
    """A new dataset version as JSON lines; a version is never written over the one that it was read from."""
    documents.write.mode("errorifexists").json(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of the broken ones in order; a rule that is null counts as broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())))
    return rows.withColumn("violations", broken).where("size(violations) > 0")
