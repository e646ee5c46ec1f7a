"""Whole steps of annotation as compositions: the event engine, the global block, windows, captions.

What a model answers comes from callables or tables of answers keyed by what asked for them; a missing answer has a
defined outcome in each step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import incremental, joins, narrative, providers, segments, workflow
from tidemark.steps import Steps, shuffled

Answer = Callable[[DataFrame], DataFrame]


def event_engine(candidates: DataFrame, judges: list[Answer], grade: Answer, scenes: DataFrame, duration: float, group: Answer | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, todos) of ``candidates`` (video_id, id, s, e, txt).

    Boundaries are judged in as many rounds as there are ``judges`` (pending rows to verdicts); pairs of overlapping
    events with like texts become one, larger clusters as ``group`` answers (video_id, cluster, keep, merge); events that
    took others in are renamed; ``grade`` gives importance; spans are normalised; the first scene that holds an event's
    middle is its scene; events are numbered by start. Todos (video_id, kind, id, s, e): rejected and split boundaries,
    and spans that stay invalid, which aren't among the events. Every round's verdicts, the kept rows, the clusters and
    the graded events are written steps, so no plan grows with the number of rounds.
    """
    step = Steps(candidates.sparkSession, "events")
    texts = shuffled(candidates.select("video_id", F.col("id").alias("origin"), "txt"))
    kept, rejected = narrative.refine(candidates.withColumn("origin", F.col("id")), *judges, step=step)
    rows = step(kept.join(texts, ["video_id", "origin"]).withColumn("ord", F.row_number().over(Window.partitionBy("video_id").orderBy("s", "e", "id")).cast("long")))
    clusters = step(segments.first_fit_clusters(rows))
    merged = narrative.pair_dedup(rows, clusters)
    name = lambda c: rows.select("video_id", F.col("ord").alias(c), F.col("id").alias(f"{c}_id"))
    pairs = merged.join(name("kept"), ["video_id", "kept"]).join(name("merged"), ["video_id", "merged"])
    groups = pairs.join(clusters.select("video_id", F.col("ord").alias("kept"), "cluster"), ["video_id", "kept"]).select("video_id", "cluster", F.col("kept_id").alias("keep"), F.array("merged_id").alias("merge"))
    rows = rows.join(clusters, ["video_id", "ord"])
    if group is not None:
        large = clusters.groupBy("video_id", "cluster").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
        groups = groups.unionByName(group(rows.join(large, ["video_id", "cluster"])).select("video_id", "cluster", "keep", "merge"))
    deduped = step(workflow.renamed(workflow.apply_groups(rows, step(groups))))
    graded = workflow.graded(deduped, grade(deduped))
    spans = step(narrative.normalise_spans(graded, duration))
    valid = spans.where("not todo").withColumn("ord", F.row_number().over(Window.partitionBy("video_id").orderBy("s", "e", "id")).cast("long"))
    events = narrative.scene_of(valid, scenes, 60.0).withColumn("event_id", F.format_string("e%d", F.col("ord")))
    todo = lambda frame, kind: frame.select("video_id", F.lit(kind).alias("kind"), "id", "s", "e")
    todos = todo(rejected, "boundary_rejected").unionByName(todo(kept.where("boundary_state = 'split'"), "boundary_split")).unionByName(todo(spans.where("todo"), "event_span_invalid"))
    return events.drop("todo", "cluster", "ord"), todos


def global_block(videos: DataFrame, events: DataFrame, scenes: DataFrame, people: DataFrame, appearances: DataFrame, order: DataFrame) -> DataFrame:
    """One row a video of ``videos``: characters, unmerged names, valid causes, timeline, and events off their scenes.

    ``events``: video_id, ord, id, s, e, boundary_state, cause, scene_id. ``people`` (video_id, id, en, zh, aliases) get
    the screen statistics of the name in ``appearances`` (video_id, name, s, e) that stands for them. ``order``: an
    answered order of ids, taken where it names all. A video without events or answers has empty arrays. Events,
    appearances and matches are written steps, because several parts read them.
    """
    step = Steps(videos.sparkSession, "global")
    events, appearances = step(events), step(appearances)
    stats = narrative.character_stats(appearances)
    seen = appearances.groupBy("video_id", "name").agg(F.min("s").alias("ord"))
    matched = step(narrative.match_alias(people, seen))
    cast_ = matched.join(stats.withColumnRenamed("name", "alias"), ["video_id", "alias"], "left").groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("id", "alias", "first_seen", "screen_time", "appearances"))).alias("characters"))
    left = narrative.unmatched(matched, seen).groupBy("video_id").agg(F.sort_array(F.collect_list("name")).alias("unmerged"))
    causes = narrative.causal_faults(events).where("valid").groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("cause", "ord"))).alias("causes"))
    timeline = workflow.timeline(events, order).select("video_id", F.col("ids").alias("timeline"))
    off = narrative.alignment(events, scenes).where("ratio < 0.5").groupBy("video_id").agg(F.sort_array(F.collect_list("ord")).alias("misaligned"))
    out = videos.select("video_id")
    for part in (cast_, left, causes, timeline, off):
        out = out.join(part, "video_id", "left")
        column = part.columns[1]
        out = out.withColumn(column, F.coalesce(column, F.array().cast(part.schema[column].dataType)))
    return out


def annotated_windows(windows: DataFrame, cache: DataFrame, answer: Answer) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(annotated, gaps, fresh) of ``windows`` (video_id, s, e, prompt).

    A window whose key is in ``cache`` (key_hash, response) isn't asked again; ``answer`` adds response and ok to the
    others. Windows without an answer are gaps with a reason; the rest are numbered ``w0001`` in order of time. ``fresh``
    are rows to append to the cache.
    """
    keyed = windows.withColumn("key_hash", providers.request_hash(F.lit("window"), F.col("prompt")))
    held = keyed.join(cache.dropDuplicates(["key_hash"]), "key_hash").withColumn("ok", F.lit(True))
    asked = answer(incremental.misses(keyed, cache))
    rows = held.select("video_id", "s", "e", "key_hash", "response", "ok").unionByName(asked.select("video_id", "s", "e", "key_hash", "response", "ok"))
    annotated = narrative.numbered(rows.where("ok"), "w%04d", ["video_id"], ["s", "e"])
    gaps = rows.where("not ok").select("video_id", F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), F.lit("annotation failed").alias("reason"))
    return annotated, gaps, asked.where("ok").select("key_hash", "response").dropDuplicates(["key_hash"])


def caption_requests(videos: DataFrame, frames: DataFrame, subtitles: DataFrame, fps: float) -> DataFrame:
    """The frames to caption: (video_id, t, frame, key_hash) at evenly spread times inside each timeline.

    The frame is the last one at or before a time, or else the first; its key holds the rate and the subtitles, so a
    change of either asks anew. A video without frames has no requests.
    """
    n = F.greatest(F.lit(1), F.floor(F.col("duration") * fps)).cast("int")
    times = F.transform(F.sequence(F.lit(1), n), lambda i: F.round(F.col("duration") * i / (n + 1), 3))
    spoken = subtitles.groupBy("video_id").agg(F.md5(F.array_join(workflow.ordered(["s", "ord"], "txt"), "\n").cast("binary")).alias("spoken"))
    asked = videos.select("video_id", F.explode(times).alias("t")).join(frames.select("video_id").distinct(), "video_id", "left_semi")
    found = joins.asof_join(asked, frames.select("video_id", F.col("t").alias("ft"), F.col("t").alias("frame")), "t", "ft", "frame")
    out = found.join(spoken, "video_id", "left").select("video_id", "t", F.col("found").alias("frame"), "spoken")
    return out.withColumn("key_hash", providers.request_hash(F.lit("caption"), F.lit(str(fps)), F.coalesce("spoken", F.lit("")), F.col("video_id"), F.col("frame"))).drop("spoken")
