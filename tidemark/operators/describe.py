"""Dense description of timelines as a tree of requests: groups of shots, segments, groups of segments, the whole.

Each level asks one table of requests and builds the next from what came back. A request that no attempt satisfies is
quiet: it is listed with its reason, and its parent is made of the rest. Every level is a written step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import DEFAULT, Thresholds
from tidemark.functions import text as T
from tidemark.operators import joins, segments
from tidemark.steps import Steps, shuffled

Answer = Callable[[DataFrame], DataFrame]
KEY = ["video_id", "level", "ord"]
PART = "array<struct<s: double, e: double, zh: string, en: string>>"
TEXTS = "array<string>"


def _filled(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def gated(asked: DataFrame, ask: Answer, step: Steps, retries: int = 2, limits: Thresholds = DEFAULT) -> DataFrame:
    """``asked`` (``KEY``, ...) with zh, en and ``problem``, which is null where an answer passed.

    ``ask`` gets the open rows with ``attempt`` and the last ``problem`` and returns ``KEY``, zh, en, elements (how many
    groups of elements it touches). No row, no text, or what the quality rules of its level miss is a problem; only rows
    with one are asked again. After the last attempt both texts are null.
    """
    open_, done = asked.withColumn("problem", F.lit(None).cast("string")), []
    for attempt in range(retries + 1):
        now = open_.withColumn("attempt", F.lit(attempt))
        told = ask(now).dropDuplicates(KEY).select(*KEY, "zh", "en", F.coalesce("elements", F.lit(0)).alias("elements"), F.lit(True).alias("told"))
        faults = T.description_faults(F.col("level"), F.col("zh"), F.col("en"), F.col("elements"), limits)
        problem = F.when(F.col("told").isNull(), "no answer").when(~_filled(F.col("zh")) & ~_filled(F.col("en")), "no text").otherwise(F.nullif(faults, F.lit("")))
        judged = step(now.drop("problem", "attempt").join(shuffled(told), KEY, "left").withColumn("problem", problem).drop("told", "elements"))
        done.append(judged.where("problem is null"))
        open_ = judged.where("problem is not null").drop("zh", "en")
    out = open_.withColumn("zh", F.lit(None).cast("string")).withColumn("en", F.lit(None).cast("string"))
    for part in done:
        out = out.unionByName(part)
    return out


def aligned(rows: DataFrame, translate: Answer, back: Answer | None, step: Steps) -> DataFrame:
    """``rows`` (``KEY``, zh, en) with missing sides translated and ``issues``.

    ``translate`` gets rows with exactly one side as ``text`` and the language wanted as ``to``, and returns ``KEY``,
    text; no answer or an empty one is an issue. Then come a length ratio outside 0.4 to 2.5 and, where ``back`` is given
    (it gets the English text and ``to`` zh), a text that comes back with under half of its four-character pieces in
    common. Without an answer the text that comes back isn't checked. Blank sides become null.
    """
    has_zh, has_en = _filled(F.col("zh")), _filled(F.col("en"))
    one = rows.where(has_zh != has_en).select(*KEY, F.when(has_zh, F.col("zh")).otherwise(F.col("en")).alias("text"), F.when(has_zh, "en").otherwise("zh").alias("to"))
    told = translate(one).dropDuplicates(KEY).select(*KEY, F.trim("text").alias("__t"))
    side = lambda c, other: F.when(_filled(F.col(c)), F.trim(c)).when(_filled(F.col(other)) & _filled(F.col("__t")), F.col("__t"))
    out = rows.join(shuffled(told), KEY, "left").withColumn("lost", F.when(has_zh & ~has_en & ~_filled(F.col("__t")), "en fill failed").when(has_en & ~has_zh & ~_filled(F.col("__t")), "zh fill failed"))
    out = step(out.withColumn("new", side("zh", "en")).withColumn("en", side("en", "zh")).withColumn("zh", F.col("new")).drop("new", "__t"))
    both = F.col("zh").isNotNull() & F.col("en").isNotNull()
    ratio = T.zh_len(F.col("zh")) / F.greatest(F.lit(1), T.en_len(F.col("en")))
    issues = [F.col("lost"), F.when(both & ~ratio.between(0.4, 2.5), "length ratio")]
    if back is not None:
        seen = back(out.where(both).select(*KEY, F.col("en").alias("text"), F.lit("zh").alias("to"))).dropDuplicates(KEY).select(*KEY, F.col("text").alias("__b"))
        out = step(out.join(seen, KEY, "left"))
        issues.append(F.when(both & F.col("__b").isNotNull() & ~F.coalesce(T.jaccard(T.ngrams(F.col("zh"), 4), T.ngrams(F.col("__b"), 4)) >= 0.5, F.lit(False)), "back translation"))
    return out.withColumn("issues", F.array_compact(F.array(*issues))).drop("lost", "__b")


def grouped_shots(shots: DataFrame, most: float) -> DataFrame:
    """``shots`` (video_id, ord, s, e, ...) with the number of their group of ``most`` seconds, from 1, and its span."""
    place = Window.partitionBy("video_id").orderBy("s", "e", "ord")
    so_far = Window.partitionBy("video_id").orderBy("s", "e", "n")
    groups = segments.shot_groups(shots, most).withColumn("upto", F.sum("n").over(so_far)).withColumn("g", F.row_number().over(so_far).cast("long"))
    members = groups.select("video_id", "g", F.col("s").alias("gs"), F.col("e").alias("ge"), F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto"))).alias("place"))
    return shots.withColumn("place", F.row_number().over(place).cast("long")).join(shuffled(members), ["video_id", "place"]).drop("place")


def described(
    videos: DataFrame, shots: DataFrame, windows: DataFrame, describe: Answer, translate: Answer, combine: Answer, back: Answer | None = None, group: int = 15, least_zh: int = 1000, limits: Thresholds = DEFAULT
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(shots, segments, quiet, wholes) of ``videos`` (video_id).

    ``shots``: video_id, ord, s, e, zh, en (what is described already, or null). Groups of short shots are asked as one
    (level ``shot``), but for groups whose shots all have a text; the answer is every shot's description. ``windows``
    (video_id, s, e) become segments, asked with the described shots that they meet (``parts``). ``describe`` answers
    both as in ``gated``, ``translate`` and ``back`` as in ``aligned``. Over ``group`` segments are combined in groups
    (level ``group``) and those into the ``whole``; fewer at once. ``combine`` gets ``parts`` and returns ``KEY``, zh,
    en. Quiet rows (``KEY``, s, e, reason) are requests without a usable answer. A whole has zh, en, how many shots and
    segments were described of how many, what is quiet, and issues of its segments in order, its own, and ``short``
    under ``least_zh`` characters. A video without windows or answers has a row with null texts.
    """
    step = Steps(videos.sparkSession, "described")
    member = step(grouped_shots(shots, limits.shot_group_sec))
    asked = member.groupBy("video_id", F.col("g").alias("ord")).agg(F.min("gs").alias("s"), F.max("ge").alias("e"), F.bool_and(_filled(F.col("zh"))).alias("have")).where("not have").drop("have")
    part = F.struct("s", "e", "zh", "en")
    none = F.array().cast(PART)
    told = gated(asked.withColumn("level", F.lit("shot")).withColumn("parts", none), describe, step, limits=limits)
    group_texts = step(aligned(told, translate, back, step))
    given = group_texts.select("video_id", F.col("ord").alias("g"), F.col("zh").alias("z"), F.col("en").alias("n"), F.lit(True).alias("asked"))
    new = member.join(given, ["video_id", "g"], "left")
    keep = F.col("asked").isNull() | (F.col("z").isNull() & F.col("n").isNull())
    shots = step(new.select("video_id", "ord", "s", "e", "g", F.when(keep, F.col("zh")).otherwise(F.col("z")).alias("zh"), F.when(keep, F.col("en")).otherwise(F.col("n")).alias("en"), (F.col("asked").isNull() | ~keep).alias("ok")))

    numbered = step(windows.where("e > s").withColumn("ord", F.row_number().over(Window.partitionBy("video_id").orderBy("s", "e")).cast("long")))
    seen = shots.where(_filled(F.col("zh")) | _filled(F.col("en"))).select("video_id", F.col("s").alias("rs"), F.col("e").alias("re"), "zh", "en")
    met = joins.range_join(numbered, seen, limits.window_sec, strict=True)
    parts = met.groupBy("video_id", "ord").agg(F.array_sort(F.collect_list(F.struct(F.col("rs").alias("s"), F.col("re").alias("e"), "zh", "en"))).alias("parts"))
    wanted = numbered.join(parts, ["video_id", "ord"], "left").withColumn("parts", F.coalesce("parts", none)).withColumn("level", F.lit("segment"))
    told = step(aligned(gated(wanted, describe, step, limits=limits), translate, back, step))
    segs = told.where("problem is null")

    rank = F.row_number().over(Window.partitionBy("video_id").orderBy("ord"))
    many = segs.groupBy("video_id").agg((F.count(F.lit(1)) > group).alias("many"))
    placed = segs.withColumn("at", (F.floor((rank - 1) / group) + 1).cast("long")).join(many, "video_id")
    packed = lambda rows, by: rows.groupBy("video_id", by.alias("ord")).agg(F.min("s").alias("s"), F.max("e").alias("e"), F.array_sort(F.collect_list(part)).alias("parts"))
    first = step(packed(placed.where("many"), F.col("at")).withColumn("level", F.lit("group")))

    def put(rows: DataFrame) -> DataFrame:
        texts = combine(rows).dropDuplicates(KEY).select(*KEY, *(F.when(_filled(F.col(c)), F.col(c)).alias(c) for c in ("zh", "en")))
        return step(rows.join(texts, KEY, "left").withColumn("problem", F.when(F.col("zh").isNull() & F.col("en").isNull(), "no answer")))

    groups = put(first)
    below = groups.where("problem is null").select("video_id", "s", "e", "zh", "en").unionByName(placed.where("not many").select("video_id", "s", "e", "zh", "en"))
    whole = put(step(packed(below, F.lit(1).cast("long")).withColumn("level", F.lit("whole"))))
    final = aligned(whole, translate, back, step)

    quiet = group_texts.select(*KEY, "s", "e", F.col("problem").alias("reason"))
    for rows in (told, groups, final):
        quiet = quiet.unionByName(rows.select(*KEY, "s", "e", F.col("problem").alias("reason")))
    quiet = step(quiet.where("reason is not null"))
    counts = [
        shots.groupBy("video_id").agg(F.count_if("ok").alias("shot_ok"), F.count(F.lit(1)).alias("shot_total")),
        told.groupBy("video_id").agg(F.count_if(F.col("problem").isNull()).alias("segment_ok"), F.count(F.lit(1)).alias("segment_total")),
        quiet.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_quiet")),
    ]
    listed = told.groupBy("video_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", "issues"))), lambda x: x["issues"])).alias("below"))
    out = videos.select("video_id").join(final.select("video_id", "zh", "en", "issues"), "video_id", "left").join(listed, "video_id", "left")
    for c in counts:
        out = out.join(c, "video_id", "left").fillna(0)
    length = F.coalesce(T.zh_len(F.col("zh")), F.lit(0))
    texts = lambda c: F.coalesce(c, F.array().cast(TEXTS))
    out = out.withColumn("full_len_zh", length).withColumn("issues", F.concat(texts("below"), texts("issues"), F.when(length < least_zh, F.array(F.lit("short"))).otherwise(F.array().cast(TEXTS)))).drop("below")
    return shots, segs.select("video_id", "ord", "s", "e", "zh", "en", "issues"), quiet, out
