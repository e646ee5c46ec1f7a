"""The release gate: thirteen checks a video, with reasons, and its effect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULT, Thresholds
from tidemark.operators import agreement
from tidemark.operators.narrative import union_keep_first

GATES = ("coverage", "event_density", "key_span", "shot_desc", "segment_gate", "qa_count", "bilingual", "qa_coverage", "alpha", "miou", "open_agree", "stages", "schema")


def facts(
    videos: DataFrame, gaps: DataFrame, events: DataFrame, shots: DataFrame, segments: DataFrame, qa: DataFrame, matrix: DataFrame, responses: DataFrame, stages: DataFrame, validity: DataFrame, limits: Thresholds = DEFAULT
) -> DataFrame:
    """Every fact that ``release_gate`` decides on, one row a video of ``videos`` (video_id, duration, genre).

    ``gaps`` (video_id, ...): uncovered spans. ``events``: s, e, importance; a key event needs 0 <= s < e <= duration.
    ``shots``: desc. ``segments``: quiet. ``qa``: qid, task_type, zh and en (the question), has_target, miou (the
    pipeline's own check of a temporal question). ``matrix``: ok. ``responses``: qid, task_type, annotator, is_gold,
    response and answer (choices), s, e, rs, re (target and rater's interval), text and reference (free answers); each
    metric is that of the video's own responses, and null where it has none. ``stages``: state. ``validity``: valid. A
    video that a table doesn't name has a count of 0, no matrix (which fails), or an unknown validity (which passes).
    """
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    rows = F.count(F.lit(1))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    temporal = (F.col("task_type") == "temporal_grounding") & F.col("has_target")
    good = (F.col("s") >= 0) & (F.col("s") < F.col("e")) & (F.col("e") <= F.greatest("duration", F.lit(1e-9)))
    of = lambda *kinds: responses.where(F.col("task_type").isin(*kinds))
    own = lambda level, name, fact: level.where("not batch").select("video_id", F.col(name).alias(fact))
    interval = of("temporal_grounding").where("re > rs and e is not null and s is not null")
    choices = of("mcq").where("answer <> '' and not coalesce(is_gold, false) and response <> ''")
    parts = [
        gaps.groupBy("video_id").agg(rows.alias("n_gaps")),
        events.join(videos.select("video_id", "duration"), "video_id").groupBy("video_id").agg(rows.alias("n_events"), n((F.col("importance") == "key") & ~F.coalesce(good, F.lit(False))).alias("n_bad_key")),
        shots.groupBy("video_id").agg(rows.alias("n_shots"), n(blank("desc")).alias("n_empty_shots")),
        segments.groupBy("video_id").agg(rows.alias("n_segments"), n(F.col("quiet")).alias("n_quiet")),
        qa.groupBy("video_id").agg(rows.alias("n_qa"), n(temporal).alias("n_temporal"), n(~blank("zh") & ~blank("en")).alias("n_bilingual")),
        stages.groupBy("video_id").agg(n(F.col("state") == "failed").alias("n_failed")),
        matrix.select("video_id", F.col("ok").alias("coverage_ok")),
        validity.select("video_id", F.col("valid").alias("schema_valid")),
        agreement.pipeline_ratio(qa.where("task_type = 'temporal_grounding'"), limits.iou).withColumnRenamed("ratio", "pipeline_miou"),
        own(agreement.alpha_levels(choices.select("video_id", F.col("qid").alias("unit"), F.col("response").alias("value"))), "alpha", "alpha"),
        own(agreement.interval_levels(interval, limits), "ratio", "miou_ratio"),
        own(agreement.open_levels(of("open", "summary"), limits), "ratio", "open_ratio"),
    ]
    out = videos.select("video_id", "duration", "genre")
    for part in parts:
        out = out.join(part, "video_id", "left")
    return out.na.fill(0, [c for c in out.columns if c.startswith("n_")])


def release_gate(found: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    """One row a video from its facts: duration, genre, n_gaps, n_events, n_bad_key, n_shots, n_empty_shots, n_segments,
    n_quiet, n_qa, n_bilingual, coverage_ok, alpha, n_temporal, miou_ratio, pipeline_miou, open_ratio, n_failed,
    schema_valid.

    A null metric is not evaluated and passes, but temporal questions without any interval check fail; null schema
    validity passes.
    """
    hours = F.greatest(F.col("duration") / 3600, F.lit(1e-6))
    per_genre = F.create_map(*(F.lit(x) for kv in limits.genre_events_per_hour.items() for x in kv)) if limits.genre_events_per_hour else None
    density = F.coalesce(per_genre[F.col("genre")], F.lit(limits.events_per_hour)) if per_genre is not None else F.lit(limits.events_per_hour)
    metric = lambda c, least: F.col(c).isNull() | (F.col(c) >= least)
    temporal = F.coalesce("miou_ratio", F.when(F.col("n_temporal") > 0, F.col("pipeline_miou")))
    checks = {
        "coverage": F.col("n_gaps") == 0,
        "event_density": F.col("n_events") / hours >= density,
        "key_span": F.col("n_bad_key") == 0,
        "shot_desc": (F.col("n_shots") > 0) & (F.col("n_empty_shots") == 0),
        "segment_gate": (F.col("n_segments") > 0) & (F.col("n_quiet") == 0),
        "qa_count": F.col("n_qa") >= limits.qa_count,
        "bilingual": (F.col("n_qa") > 0) & (F.col("n_bilingual") >= limits.bilingual_share * F.col("n_qa")),
        "qa_coverage": F.coalesce("coverage_ok", F.lit(False)),
        "alpha": metric("alpha", limits.alpha),
        "miou": F.when(temporal.isNull(), F.col("n_temporal") == 0).otherwise(temporal >= limits.iou_share),
        "open_agree": metric("open_ratio", limits.open_share),
        "stages": F.col("n_failed") == 0,
        "schema": F.coalesce("schema_valid", F.lit(True)),
    }
    out = found.select("video_id", *(c.alias(g) for g, c in checks.items()), F.array_compact(F.array(F.when(F.col("alpha").isNull(), "alpha"), F.when(temporal.isNull() & (F.col("n_temporal") == 0), "miou"), F.when(F.col("open_ratio").isNull(), "open_agree"))).alias("unevaluated"))
    return out.select("*", F.expr(" and ".join(GATES)).alias("pass"), F.array_join(F.array_compact(F.array(*(F.when(~F.col(g), F.lit(g)) for g in GATES))), ",").alias("reasons"))


def effect(gated: DataFrame) -> DataFrame:
    """The decision's effect: passing videos are verified and lose earlier reasons, others are drafts with theirs.
    ``release_unevaluated``, where ``unevaluated`` is known, names the metrics that weren't evaluated, null where all were."""
    if "unevaluated" in gated.columns:
        gated = gated.withColumn("release_unevaluated", F.when(F.size("unevaluated") > 0, F.col("unevaluated")))
    return gated.withColumn("review_status", F.when(F.col("pass"), "verified").otherwise("draft")).withColumn("rejected_reasons", F.when(~F.col("pass"), F.col("reasons")))


def written_back(products: DataFrame, gated: DataFrame) -> DataFrame:
    """Products (video_id, annotation_meta, ...) with the gate's decision in their annotation_meta, as a new version.

    A product that wasn't judged stays as it is. Metrics that weren't evaluated are written as ``release_unevaluated``;
    where all were, what stood there stays.
    """
    judged = effect(gated)
    told = "release_unevaluated" in judged.columns
    verdict = judged.select("video_id", F.col("review_status").alias("__status"), F.col("rejected_reasons").alias("__reasons"), *([F.col("release_unevaluated").alias("__open")] if told else []))
    out = products.join(verdict, "video_id", "left")
    meta, names = F.col("annotation_meta"), products.schema["annotation_meta"].dataType.names
    status = F.coalesce("__status", meta["review_status"])
    made = ("review_status", "rejected_reasons", *(["release_unevaluated"] if told else []))
    open_ = [F.coalesce(F.col("__open"), *([meta["release_unevaluated"]] if "release_unevaluated" in names else [])).alias("release_unevaluated")] if told else []
    return out.select(*(c for c in products.columns if c != "annotation_meta"), F.struct(status.alias("review_status"), F.col("__reasons").alias("rejected_reasons"), *(meta[f].alias(f) for f in names if f not in made), *open_).alias("annotation_meta"))


def human_todo(noted: DataFrame, events: DataFrame, gaps: DataFrame) -> DataFrame:
    """What people must look at: (video_id, kind, event_id, s, e, reason), the first of each kind, event and span.

    ``noted`` are todos that steps have written, first in rank; then key events without a review, split and rejected
    boundaries of ``events`` (video_id, event_id, s, e, importance, boundary_state, reason), and ``gaps`` (video_id, s,
    e, reason).
    """
    columns = ("video_id", "kind", "event_id", "s", "e", "reason")
    key = events.where("importance = 'key' and boundary_state = 'unreviewed'").withColumn("kind", F.lit("key_event_unreviewed")).withColumn("reason", F.lit(None).cast("string"))
    edge = events.where("boundary_state in ('split', 'rejected_final')").withColumn("kind", F.concat(F.lit("boundary_"), "boundary_state"))
    holes = gaps.withColumn("kind", F.lit("uncovered_gap")).withColumn("event_id", F.lit(None).cast(events.schema["event_id"].dataType))
    out = union_keep_first(*(x.select(*columns) for x in (noted, key, edge, holes)), key=["video_id", "kind", "event_id", "s", "e"], order=["reason"])
    return out.select(*columns)


def batch_verdict(gated: DataFrame, todos: DataFrame) -> DataFrame:
    """One row a batch: videos, those that pass, whether all do, and how many todos people have."""
    verdict = gated.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("pass").cast("int")).alias("passed"), F.bool_and("pass").alias("all_pass"))
    return verdict.join(todos.agg(F.count(F.lit(1)).alias("human_todo_total")))  # one row each


def report(gated: DataFrame, todos: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    """The release report, one JSON row: the verdict, the thresholds that it was taken by, and each failed video's reasons."""
    failed = gated.where("not pass").agg(F.sort_array(F.collect_list(F.struct("video_id", "reasons"))).alias("failed"))
    used = {k: getattr(limits, k) for k in ("events_per_hour", "qa_count", "bilingual_share", "alpha", "iou_share", "open_share")}
    thresholds = F.struct(*(F.lit(v).alias(k) for k, v in used.items())).alias("thresholds")
    return batch_verdict(gated, todos).join(failed).select(F.to_json(F.struct("n", "passed", "all_pass", "human_todo_total", thresholds, "failed")).alias("report"))
