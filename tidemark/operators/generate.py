"""Generation of anchored questions in rounds, as carried state over a table of videos.

One state row a video holds what a round needs of all before it: how many questions there are, the counts of the
capability matrix, the anchors in use and the keys of accepted questions (bounded by the quota and one answer). A round
asks only for the videos that are open, so its plan is the same in every round; every round's questions are a step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import DEFAULT, Thresholds
from tidemark.functions import intervals as I
from tidemark.functions import text as T
from tidemark.operators import questions as Q
from tidemark.operators import segments
from tidemark.steps import Steps

Answer = Callable[[DataFrame], DataFrame]
LAYERS = ("L1", "L2", "L3", "L4", "L5")
TASKS = ("mcq", "temporal_grounding")
ASKED = ("place", "anchor_id", "task_type", "question_zh", "question_en", "evidence", "target", "options", "answer", "ref_zh", "ref_en", "capability", "min_watch")
NAMES = "array<string>"
KINDS = dict.fromkeys(("anchor_id", "task_type", "question_zh", "question_en", "answer", "ref_zh", "ref_en", "min_watch", "qid", "key"), "string") | {
    "place": "long", "round": "long", "evidence": "array<array<double>>", "target": "array<double>", "options": NAMES, "capability": NAMES,
}


def _named(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def checked(rows: DataFrame, anchors: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    """``rows`` with ``fault``: the first rule that a question breaks, then what its stem lacks to place itself."""
    stem = F.coalesce(T.first_text(F.col("question_zh"), F.col("question_en")), F.lit(""))
    found = Q.faults(rows.withColumn("question", stem).drop("fault"), anchors, limits)
    return found.withColumn("fault", F.coalesce("fault", T.referring_fault(F.col("question_zh"), F.col("question_en")))).drop("question")


def _counted(rows: DataFrame) -> DataFrame:
    """Per video what accepted questions add to the state."""
    layer = lambda name: F.sum(F.size(F.filter("capability", lambda c: c.startswith(name)))).cast("long").alias(f"+{name}")
    return rows.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("+n"), *map(layer, LAYERS), *(F.count_if(F.coalesce(F.col("task_type") == t, F.lit(False))).alias(f"+{t}") for t in TASKS),
        F.collect_set("anchor_id").alias("+used"), F.collect_set("key").alias("+keys"),
    )


def _advanced(state: DataFrame, added: DataFrame) -> DataFrame:
    """The state after ``added``: counts summed, sets united; a video that nothing was added to stays as it was."""
    out = state.join(added, "video_id", "left")
    for c in added.columns:
        if c.startswith("+"):
            old = c[1:]
            more = F.coalesce(c, F.array().cast(NAMES)) if old in ("used", "keys") else F.coalesce(F.col(c), F.lit(0))
            out = out.withColumn(old, F.array_union(old, more) if old in ("used", "keys") else F.col(old) + more).drop(c)
    return out


def requests(state: DataFrame, anchors: DataFrame, batch: int, cap: int, least_layer: int = 2) -> DataFrame:
    """What a round asks of each video of ``state``: how many (``need``), what the matrix lacks, anchors in use, and the
    anchors to choose from (``pool``, by start): at most ``cap`` in turn from four parts of the timeline, unused ones
    first; a cap of 0 takes all."""
    short = lambda want, have: F.greatest(F.lit(0), want - F.col(have)).cast("long").alias(f"lacks_{have}")
    half, some = F.floor(F.col("quota") * 0.5), F.floor(F.col("quota") * 0.15)
    rows = anchors.join(state.select("video_id", "used"), "video_id").withColumn("used", F.array_contains("used", F.col("anchor_id")))
    if cap > 0:
        rows = segments.round_robin_cap(rows, cap, F.col("duration"))
    pool = rows.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("s", "e", "anchor_id"))).alias("pool"))
    asked = state.select("video_id", "duration", "round", F.least(F.lit(batch), F.col("quota") - F.col("n")).cast("long").alias("need"), *(short(F.lit(least_layer), c) for c in LAYERS), short(half, "mcq"), short(some, "temporal_grounding"), F.array_sort("used").alias("used"))
    return asked.join(pool, "video_id", "left").withColumn("pool", F.coalesce("pool", F.array().cast("array<struct<s: double, e: double, anchor_id: string>>")))


def generated(videos: DataFrame, anchors: DataFrame, ask: Answer, rewrite: Answer, known: DataFrame | None = None, batch: int = 20, rewrites: int = 2, limits: Thresholds = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(questions, one row a video of the capability matrix and of what became of the answers).

    ``videos``: video_id, duration, quota. ``anchors``: video_id, anchor_id, ord, s, e, importance. ``known``: questions of
    before, in the columns of an answer and ``qid``; they count, and their keys and anchors are taken.
    ``ask`` gets ``requests`` and returns any number of rows a video (video_id and ``ASKED``; ``place`` tells a video's
    rows apart and orders them). Rows without an anchor are passed over. A row that breaks a rule goes to ``rewrite``
    with its ``fault`` and ``attempt``; an answer (video_id and ``ASKED``) replaces it and keeps the anchor if it names
    none; without an answer, or after the last attempt, the row is given up and counts as ``reused_anchor``. A row whose
    key is taken, or stands earlier in the same answer, counts as ``duplicates_dropped``. The rest are numbered on.

    A video is done at its quota, after 2 + ceil(quota / batch) rounds, or when an answer has no row at all. An answer
    may pass the quota; nothing of it is cut. A null or negative quota asks nothing. The driver sees the largest quota
    and whether a round has anything to ask.
    """
    step = Steps(videos.sparkSession, "questions")
    width = videos.select("video_id", "duration").dropDuplicates(["video_id"])
    anchors = step(anchors.join(width, "video_id"))
    spans = anchors.select("video_id", "anchor_id", "s", "e")
    zero = F.lit(0).cast("long")
    state = videos.dropDuplicates(["video_id"]).select(
        "video_id", "duration", F.coalesce("quota", F.lit(0)).cast("long").alias("quota"), zero.alias("n"), *(zero.alias(c) for c in (*LAYERS, *TASKS)), F.array().cast(NAMES).alias("used"), F.array().cast(NAMES).alias("keys"),
        zero.alias("reused_anchor"), zero.alias("duplicates_dropped"), zero.alias("anchors_prompted"), zero.alias("rounds"), F.lit(True).alias("open"),
    )
    key = T.answered_key(F.col("question_zh"), F.col("question_en"), F.col("answer"))
    kept = ["video_id", "qid", "round", *ASKED, "key"]
    done = []
    if known is not None:
        done.append(step(known.withColumn("round", zero).withColumn("key", key).select(kept)))
        state = _advanced(state, _counted(done[0]))
    state = step(state)
    largest = state.agg(F.max("quota")).first()[0] or 0
    for number in range(1, 3 + -(-max(largest, 0) // batch)):
        most = F.ceil(F.col("quota") / batch) + 2
        now = state.where(F.col("open") & (F.col("n") < F.col("quota")) & (number <= most)).withColumn("round", F.lit(number).cast("long"))
        asked = step(requests(now, anchors, batch, limits.anchor_cap))
        if asked.isEmpty():
            break
        raw = step(ask(asked).select("video_id", *ASKED).dropDuplicates(["video_id", "place"]))
        rows = step(checked(raw.where(_named(F.col("anchor_id"))).join(width, "video_id"), spans, limits))
        fine = [rows.where("fault is null")]
        for attempt in range(1, rewrites + 1):
            bad = rows.where("fault is not null").withColumn("attempt", F.lit(attempt))
            again = rewrite(bad).select("video_id", *ASKED).dropDuplicates(["video_id", "place"]).withColumnRenamed("anchor_id", "told")
            named = again.join(bad.select("video_id", "place", "duration", "anchor_id"), ["video_id", "place"]).withColumn("anchor_id", F.when(_named(F.col("told")), F.col("told")).otherwise(F.col("anchor_id"))).drop("told")
            rows = step(checked(named, spans, limits))
            fine.append(rows.where("fault is null"))
        good = fine[0]
        for part in fine[1:]:
            good = good.unionByName(part)
        good = step(good.withColumn("capability", Q.known_capabilities(F.col("capability"))).withColumn("key", key))
        first = good.groupBy("video_id", "key").agg(F.min("place").alias("place"))
        fresh = good.join(first, ["video_id", "key", "place"], "left_semi").join(now.select("video_id", "n", "keys", "round"), "video_id").where(~F.array_contains("keys", F.col("key")))
        n = F.row_number().over(Window.partitionBy("video_id").orderBy("place")) + F.col("n")
        fresh = step(fresh.withColumn("qid", F.format_string("%s_q%02d", F.col("video_id").cast("string"), n)).select(kept))
        done.append(fresh)
        told = raw.groupBy("video_id").agg(F.count_if(_named(F.col("anchor_id"))).alias("raw"))
        told = told.join(good.groupBy("video_id").agg(F.count(F.lit(1)).alias("good")), "video_id", "left")
        seen = asked.select("video_id", F.lit(True).alias("asked"), F.size("pool").cast("long").alias("pool")).join(told, "video_id", "left")
        after = _advanced(state, _counted(fresh).withColumn("new", F.col("+n"))).join(seen, "video_id", "left")
        have = lambda c: F.coalesce(F.col(c), zero)
        state = step(
            after.withColumn("reused_anchor", F.col("reused_anchor") + have("raw") - have("good")).withColumn("duplicates_dropped", F.col("duplicates_dropped") + have("good") - have("new"))
            .withColumn("anchors_prompted", F.coalesce("pool", "anchors_prompted")).withColumn("rounds", F.when(F.col("asked"), number).otherwise(F.col("rounds")).cast("long"))
            .withColumn("open", F.col("open") & (F.col("asked").isNull() | F.col("raw").isNotNull())).drop("raw", "good", "new", "asked", "pool")
        )
    if not done:
        done.append(spans.where("false").select("video_id", *(F.lit(None).cast(kind).alias(c) for c, kind in KINDS.items())).select(kept))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    spent = state.select("video_id", F.col("quota").alias("target"), "rounds", "reused_anchor", "duplicates_dropped", F.size("used").cast("long").alias("anchors_used"), "anchors_prompted")
    total = anchors.groupBy("video_id").agg(F.count(F.lit(1)).alias("anchors_total"))
    matrix = Q.coverage(out.withColumn("spans", F.filter(F.transform("evidence", I.pair), lambda p: p.isNotNull())).join(width, "video_id"), F.col("duration"))
    report = spent.join(total, "video_id", "left").join(matrix, "video_id", "left")
    return out, report.fillna(0).fillna(False)
