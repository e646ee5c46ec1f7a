"""Composite steps around model answers: drafts, consolidation, grading, verification, description, reuse.

An answer is a row keyed by its request; a step joins answers to what asked for them and falls back where none came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import segments
from tidemark.steps import shuffled


def ordered(order: list[str], value: str) -> Column:
    """The values of a group in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("__v")))), lambda x: x["__v"])


def mine_drafts(captions: DataFrame, subtitles: DataFrame, width: float, step: float, duration: float, similarity: float, gap: float) -> DataFrame:
    """Event drafts of each sliding window: merged captions, or its subtitles of half a second where it has no caption.

    ``captions`` (video_id, ord, t, txt), ``subtitles`` (video_id, ord, s, e, txt). Rows: video_id, k, s, e, txt, origin.
    """
    seen = segments.sliding_windows(captions, width, step, duration)
    w = Window.partitionBy("video_id", "k").orderBy("t", "ord")
    marked = seen.withColumn("last_t", F.lag("t").over(w)).withColumn("last", F.lag("txt").over(w))
    like = T.jaccard(T.ngrams(F.col("last")), T.ngrams(F.col("txt")))
    runs = segments.islands(marked, ["video_id", "k"], ["t", "ord"], F.col("last_t").isNull() | (like < similarity) | (F.col("t") - F.col("last_t") > gap))
    merged = runs.groupBy("video_id", "k", "island").agg(F.min("t").alias("s"), F.max("t").alias("e"), F.array_join(F.array_distinct(ordered(["t", "ord"], "txt")), "；").alias("txt"))
    drafts = merged.where(F.col("e") - F.col("s") >= 2).select("video_id", "k", "s", "e", F.left("txt", F.lit(120)).alias("txt"), F.lit("caption").alias("origin"))
    spoken = segments.sliding_windows(subtitles.withColumn("t", F.col("s")), width, step, duration).where(F.col("e") - F.col("s") >= 0.5)
    spoken = spoken.join(seen.select("video_id", "k").distinct(), ["video_id", "k"], "left_anti")
    return drafts.unionByName(spoken.select("video_id", "k", "s", "e", "txt", F.lit("subtitle").alias("origin")))


def with_fallback(drafts: DataFrame, answers: DataFrame, key: list[str]) -> DataFrame:
    """A group's answer rows where it has any, else its draft rows."""
    missing = drafts.join(answers.select(*key).distinct(), key, "left_anti")
    return answers.unionByName(missing.select(*answers.columns))


def apply_groups(events: DataFrame, groups: DataFrame) -> DataFrame:
    """Merge events by ``groups`` (video_id, cluster, keep, merge): unknown keepers and merges are ignored.

    ``events``: video_id, cluster, id. Kept rows come with the sorted ids that they took in.
    """
    wanted = groups.select("video_id", "cluster", "keep", F.explode("merge").alias("id")).where("id <> keep")
    known = wanted.join(events.select("video_id", "cluster", F.col("id").alias("keep")), ["video_id", "cluster", "keep"], "left_semi").join(events.select("video_id", "cluster", "id"), ["video_id", "cluster", "id"], "left_semi")
    taken = known.groupBy("video_id", F.col("keep").alias("id")).agg(F.array_sort(F.collect_set("id")).alias("sources"))
    return events.join(shuffled(known.select("video_id", "id").distinct()), ["video_id", "id"], "left_anti").join(shuffled(taken), ["video_id", "id"], "left")


def renamed(kept: DataFrame) -> DataFrame:
    """An event that took others in gets the id ``{id}_m{n}`` and keeps its old one."""
    n = F.size(F.coalesce("sources", F.array().cast("array<string>")))
    return kept.withColumn("dedup_id", F.when(n > 0, F.col("id"))).withColumn("id", F.when(n > 0, F.concat(F.col("id"), F.lit("_m"), n.cast("string"))).otherwise(F.col("id")))


def graded(events: DataFrame, grades: DataFrame) -> DataFrame:
    """Importance by id; unknown grades and missing ones are minor."""
    known = grades.select("video_id", "id", F.col("importance").alias("__g"))
    return events.join(known, ["video_id", "id"], "left").withColumn("importance", F.when(F.col("__g").isin("key", "minor"), F.col("__g")).otherwise("minor")).drop("__g")


def timeline(events: DataFrame, answers: DataFrame) -> DataFrame:
    """Per video the answered order of ids if it names exactly the known ones, else by start and id."""
    known = events.groupBy("video_id").agg(ordered(["s", "id"], "id").alias("ids"))
    told = F.filter("told", lambda x: F.array_contains("ids", x))
    out = known.join(answers.select("video_id", F.col("ids").alias("told")), "video_id", "left")
    use = F.coalesce(F.size(told) == F.size("ids"), F.lit(False))
    return out.select("video_id", F.when(use, told).otherwise(F.col("ids")).alias("ids"), use.alias("answered"))


def verification_kpis(verdicts: DataFrame, by: list[str]) -> DataFrame:
    """Of (task_type, verified, passed, regen, dropped, leaked): shares rounded to 3, null where nothing was verified.

    A dropped question has leaked into the synopsis, or its verifier disagreed to the end.
    """
    kind = lambda *t: F.col("task_type").isin(*t)
    n = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("int"))
    share = lambda k: F.round(n(k & F.col("verified") & F.col("passed")) / F.nullif(n(k & F.col("verified")), F.lit(0)), 3)
    return verdicts.groupBy(*by).agg(
        n(F.col("verified")).alias("verified"), F.sum("regen").alias("regen"), n(F.col("dropped")).alias("dropped"),
        n(F.col("dropped") & F.col("leaked")).alias("synopsis_leak_dropped"), n(F.col("dropped") & ~F.col("leaked")).alias("verify_mismatch_dropped"), share(kind("mcq")).alias("verify_agreement"),
        share(kind("temporal_grounding")).alias("temporal_miou_ratio"), share(kind("open", "summary")).alias("open_agreement"),
    )


def open_items(answers: DataFrame, similarity: Column, least: float = 0.5, share: float = 0.6) -> DataFrame:
    """Per open question: the share of non-empty answers that are like the reference, and whether it suffices."""
    told = answers.where("text <> ''").withColumn("like", (similarity >= least).cast("double"))
    out = told.groupBy("qid").agg(F.avg("like").alias("a"), F.count(F.lit(1)).alias("n_raters"))
    return out.select("qid", F.round("a", 3).alias("agreement"), "n_raters", (F.col("a") >= share).alias("passes"))


def evidence_times(spans: Column, most: int = 6) -> Column:
    """Sample times in the first two spans, ``most`` in all, evenly inside each."""
    inner = lambda s: F.transform(F.sequence(F.lit(1), F.lit(most)), lambda i: F.round(s["s"] + (s["e"] - s["s"]) * i / (most + 1), 3))
    return F.slice(F.flatten(F.transform(F.slice(spans, 1, 2), inner)), 1, most)


def mosaic(frames: Column, most: int = 64) -> Column:
    """The frames of a square tile: side floor(sqrt(n)), at least two; null under four frames."""
    side = F.floor(F.sqrt(F.least(F.size(frames), F.lit(most)))).cast("int")
    return F.when(F.size(frames) >= 4, F.slice(frames, F.lit(1), side * side))


def language_issues(zh: Column, en: Column) -> Column:
    """Missing sides and a length ratio outside 0.4 to 2.5, in order."""
    ratio = T.zh_len(zh) / F.greatest(F.lit(1), T.en_len(en))
    has = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return F.array_compact(F.array(F.when(~has(zh), F.lit("zh missing")), F.when(~has(en), F.lit("en missing")), F.when(has(zh) & has(en) & ~ratio.between(0.4, 2.5), F.lit("length ratio"))))


def two_level(parts: DataFrame, size: int) -> DataFrame:
    """Texts of a video joined in groups of ``size`` if there are more than that, then as a whole."""
    rank = F.row_number().over(Window.partitionBy("video_id").orderBy("s", "ord")) - 1
    grouped = parts.withColumn("g", F.floor(rank / size)).groupBy("video_id", "g").agg(F.array_join(ordered(["s", "ord"], "txt"), " ").alias("txt"), F.count(F.lit(1)).alias("n"))
    return grouped.groupBy("video_id").agg(F.array_join(ordered(["g"], "txt"), "\n").alias("txt"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_groups"))


def rendered(s: Column, speaker: Column, txt: Column) -> Column:
    """``[12s] (speaker) text``."""
    return F.concat(F.lit("["), F.round(s).cast("long").cast("string"), F.lit("s] "), F.coalesce(F.concat(F.lit("("), speaker, F.lit(") ")), F.lit("")), txt)


def other_provider(documents: DataFrame, provider: str) -> DataFrame:
    """Documents that weren't made by ``provider``, as read from ``auto:name`` marks."""
    return documents.where(~F.coalesce(F.array_contains(F.regexp_extract_all("annotator", F.lit("auto:([a-z0-9_-]+)"), 1), provider), F.lit(False)))


def duration_conflicts(metas: DataFrame, measured: DataFrame, tolerance: float = 5.0) -> DataFrame:
    """Rows whose two durations differ by more than ``tolerance``, to the microsecond: below that a difference of doubles
    is noise of their last digits."""
    return metas.join(measured, "video_id").where(F.round(F.abs(F.col("duration_sec") - F.col("measured")), 6) > tolerance)


def first_file(listing: DataFrame) -> DataFrame:
    """Of (stem, path, ext_rank) the file of the first extension of each stem."""
    return listing.groupBy("stem").agg(F.min_by("path", F.struct("ext_rank", "path")).alias("path"))


def deficits(coverage: DataFrame, quota: Column, least_layer: int = 2) -> DataFrame:
    """What a next round must ask for: missing layers and task types."""
    short = lambda want, have: F.greatest(F.lit(0), (want - have)).cast("long")
    return coverage.select("video_id", *(short(F.lit(least_layer), F.col(f"L{i}")).alias(f"L{i}") for i in range(1, 6)), short(F.floor(quota * 0.5), F.col("mcq")).alias("mcq"), short(F.floor(quota * 0.15), F.col("temporal_grounding")).alias("temporal_grounding"))


def reusable(manifest: DataFrame, products: DataFrame, stages: int) -> DataFrame:
    """Videos whose stages are all done and whose product exists; a skipped stage isn't done."""
    done = manifest.where("state = 'done'").groupBy("video_id").agg(F.countDistinct("stage").alias("n")).where(F.col("n") == stages)
    return done.join(products.select("video_id").distinct(), "video_id", "left_semi").select("video_id")


def next_questions(asked: DataFrame, known: DataFrame, key: str, quota: int) -> DataFrame:
    """A round of generation: new keys only, the first of each, up to a video's quota; numbered after the known ones."""
    fresh = asked.join(known.select("video_id", key).distinct(), ["video_id", key], "left_anti")
    fresh = fresh.groupBy("video_id", key).agg(F.min("ord").alias("ord"))
    have = known.groupBy("video_id").agg(F.count(F.lit(1)).alias("have"))
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("ord"))
    out = fresh.withColumn("n", n).join(have, "video_id", "left").withColumn("place", F.col("n") + F.coalesce("have", F.lit(0)))
    return out.where(F.col("place") <= quota).withColumn("qid", F.format_string("%s_q%02d", F.col("video_id").cast("string"), F.col("place"))).select("video_id", "ord", key, "qid")


def legible(ocr: DataFrame, confidence: float = 0.8) -> DataFrame:
    return ocr.where((F.col("conf") >= confidence) & (F.trim("text") != ""))


def anchor_pool(*tracks: DataFrame) -> DataFrame:
    """Events, described shots and sounds as anchors by start; key ones first among equal starts."""
    pool = tracks[0]
    for t in tracks[1:]:
        pool = pool.unionByName(t, allowMissingColumns=True)
    order = Window.partitionBy("video_id").orderBy("s", F.coalesce(F.col("importance") != "key", F.lit(True)), "id")
    return pool.withColumn("place", F.row_number().over(order))


def coverage_report(videos: DataFrame, windows: DataFrame, eps: float = 1.0) -> DataFrame:
    """Holes of the windows that worked, and the failed windows, each with its reason."""
    holes = segments.gaps(videos, windows.where("ok").select("video_id", "s", "e"), eps, eps, True)
    return holes.withColumn("reason", F.lit("uncovered")).unionByName(windows.where("not ok").select("video_id", "s", "e", F.lit("failed").alias("reason")))


def briefs(events: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Rows cut to ``fields`` as JSON, for prompts."""
    return events.select("video_id", F.to_json(F.struct(*fields)).alias("brief"))
