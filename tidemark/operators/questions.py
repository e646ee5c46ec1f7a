"""Rules on questions: shortcuts, difficulty, coverage, validation, renumbering, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import CAPABILITIES, DEFAULT, HARD_CAPABILITIES, SUBTITLE_CAPABILITIES, Thresholds
from tidemark.functions import intervals as I
from tidemark.functions import text as T

CHANNELS = ("blind", "subtitle", "single_frame", "synopsis", "language_prior", "subtitle_locate", "blind_similar")


def is_visual(capability: Column) -> Column:
    return ~F.arrays_overlap(capability, F.array(*map(F.lit, SUBTITLE_CAPABILITIES)))


def _flag(questions: DataFrame, channel: str) -> Column:
    return F.coalesce(F.col(channel), F.lit(False)) if channel in questions.columns else F.lit(False)


def with_drop(questions: DataFrame, keep_single_frame: bool = False, drop: bool = True) -> DataFrame:
    """Adds ``dropped``. Missing channels count as not hit; subtitle and single-frame hits count on visual questions."""
    hit = {c: _flag(questions, c) for c in CHANNELS}
    visual = is_visual(F.col("capability"))
    always = hit["blind"] | hit["synopsis"] | hit["language_prior"] | hit["subtitle_locate"] | hit["blind_similar"]
    rule = always | (hit["subtitle"] & visual) | (hit["single_frame"] & visual & F.lit(not keep_single_frame))
    return questions.withColumn("dropped", rule & F.lit(drop))


def drop_summary(judged: DataFrame) -> DataFrame:
    """One row: questions before a screening, those that stay, and those that go."""
    return judged.agg(F.count(F.lit(1)).alias("before"), F.sum((~F.col("dropped")).cast("int")).alias("after"), F.sum(F.col("dropped").cast("int")).alias("dropped"))


def drops_by_channel(questions: DataFrame) -> DataFrame:
    """Per channel, how many dropped questions it hit; ``unknown`` for those that none did."""
    named = F.array_compact(F.array(*(F.when(_flag(questions, c), F.lit(c)) for c in CHANNELS)))
    hit = F.when(F.size(named) == 0, F.array(F.lit("unknown"))).otherwise(named)
    return with_drop(questions).where("dropped").select(F.explode(hit).alias("channel")).groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


def difficulty(questions: DataFrame) -> Column:
    """hard by capability, several spans or a whole-video need; easy if one scene is enough and no channel hit."""
    hard = F.arrays_overlap("capability", F.array(*map(F.lit, HARD_CAPABILITIES))) | (F.size("spans") >= 2) | F.coalesce(F.col("min_watch") == "whole_video", F.lit(False))
    hit = _flag(questions, "blind") | _flag(questions, "single_frame") | _flag(questions, "subtitle") | _flag(questions, "synopsis") | _flag(questions, "language_prior")
    easy = F.coalesce(F.col("min_watch") == "single_scene", F.lit(True)) & ~hit
    return F.when(hard, "hard").when(easy, "easy").otherwise("medium")


def channels_of(task_type: Column) -> Column:
    """The channels that are tried on a kind of question."""
    mcq = ("blind", "subtitle", "single_frame", "synopsis", "language_prior")
    return F.when(task_type == "mcq", F.array(*map(F.lit, mcq))).when(task_type == "temporal_grounding", F.array(F.lit("subtitle_locate"))).when(
        task_type.isin("open", "summary"), F.array(F.lit("blind_similar"))
    ).otherwise(F.array().cast("array<string>"))


def rescreened(questions: DataFrame, second: DataFrame, provider: Column, keep_single_frame: bool = False, drop: bool = True) -> DataFrame:
    """``questions`` after a second run of the channels by another provider.

    ``questions``: qid, task_type, capability, a flag a channel as far as they were tried, checked_by. ``second``: qid and
    the second run's flags. Only the channels of a question's type count (``channels_of``): hit by either run is hit, and
    what is missing isn't hit. ``primary`` and ``secondary`` are the channels that each run hit, ``checked_by`` names both
    providers, and ``dropped`` is the decision on the combined flags. A question of another type is kept as it is, with
    its flags and without a record. A row of ``second`` for an unknown question is ignored.
    """
    known = [c for c in CHANNELS if c in second.columns]
    other = second.dropDuplicates(["qid"]).select("qid", *(F.col(c).alias(f"__{c}") for c in known))
    out = questions.join(other, "qid", "left").withColumn("__tried", channels_of(F.col("task_type"))).withColumn("__known", F.size("__tried") > 0)
    tried = lambda c: F.array_contains("__tried", c)
    one = {c: tried(c) & _flag(questions, c) for c in CHANNELS}
    two = {c: tried(c) & (F.coalesce(f"__{c}", F.lit(False)) if c in known else F.lit(False)) for c in CHANNELS}
    named = lambda hits: F.when(F.col("__known"), F.array_compact(F.array(*(F.when(h, F.lit(c)) for c, h in hits.items()))))
    by = F.when(F.col("__known"), F.concat(F.coalesce("checked_by", F.lit("auto:?")), F.lit("+auto:"), provider)).otherwise(F.col("checked_by"))
    kept = [c for c in questions.columns if c not in (*CHANNELS, "checked_by")]
    flags = [F.when(F.col("__known"), one[c] | two[c]).otherwise(_flag(questions, c)).alias(c) for c in CHANNELS]
    out = out.select(*kept, "__known", by.alias("checked_by"), named(one).alias("primary"), named(two).alias("secondary"), *flags)
    judged = with_drop(out, keep_single_frame, drop)
    return judged.withColumn("dropped", F.col("dropped") & F.col("__known")).drop("__known")


def rescreen(videos: DataFrame, questions: DataFrame, second: DataFrame, force: bool = False, **policy: bool) -> tuple[DataFrame, DataFrame]:
    """(kept questions, one row a screened video) of a second run by each video's ``provider``.

    ``videos``: video_id, provider, annotators (array of ``auto:<provider>:<model>``). A video whose provider is among its
    annotators' is left out, unless ``force``. Kept questions are numbered anew (``new_qid``) in the order of ``ord``. A
    video's row: review_status, which is draft again until people have looked, before, after, and the dropped qids.
    """
    first = F.transform("annotators", lambda a: F.regexp_extract(a, "^auto:([a-z0-9_-]+)", 1))
    screened = videos.where(F.lit(force) | ~F.coalesce(F.array_contains(first, F.col("provider")), F.lit(False)))
    judged = rescreened(questions.join(screened.select("video_id", "provider"), "video_id"), second, F.col("provider"), **policy)
    stats = judged.groupBy("video_id").agg(F.count(F.lit(1)).alias("before"), F.count_if(~F.col("dropped")).alias("after"), F.array_sort(F.collect_list(F.when(F.col("dropped"), F.struct("ord", "qid")))).alias("x"))
    stats = screened.select("video_id", "provider", F.lit("draft").alias("review_status")).join(stats, "video_id", "left")
    none = F.array().cast("array<string>")
    stats = stats.select("video_id", "provider", "review_status", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("before", "after")), F.coalesce(F.transform("x", lambda q: q["qid"]), none).alias("dropped"))
    return renumber(judged.where("not dropped")), stats


def renumber(questions: DataFrame) -> DataFrame:
    """qid becomes what stands before its last ``_q`` (all of it, if none does) with a running number of at least two
    digits, in the order of the list (``ord``)."""
    prefix = F.regexp_replace("qid", r"_q(?!.*_q)(?s:.*)$", "")
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("ord"))
    return questions.withColumn("new_qid", F.format_string("%s_q%02d", prefix, n))


def coverage(questions: DataFrame, duration: float | Column, least_layer: int = 2) -> DataFrame:
    """The capability matrix of each video, its five checks and whether all pass.

    Every capability of a question counts for its layer, and every span of its evidence (``spans``) for the quarter of
    the timeline that it starts in. Without any evidence the check of the quarters fails.
    """
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("int"))
    total = lambda c: F.coalesce(F.sum(F.size(c)), F.lit(0))
    layers = {f"L{i}": total(F.filter("capability", (lambda layer: lambda c: c.startswith(layer))(f"L{i}"))).alias(f"L{i}") for i in range(1, 6)}
    buckets = {f"b{i}": total(F.filter("spans", (lambda n: lambda x: I.time_bucket(x["s"], F.lit(duration)) == n)(i))).alias(f"b{i}") for i in range(4)}
    tasks = {t: count(F.col("task_type") == t).alias(t) for t in ("mcq", "temporal_grounding", "open", "summary")}
    out = questions.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), *layers.values(), count(F.col("min_watch").isin("cross_scene", "whole_video")).alias("cross"), *tasks.values(), *buckets.values())
    share = lambda c: F.col(c) / F.col("n")
    marks = sum((F.col(b) for b in list(buckets)[1:]), F.col("b0"))
    checks = {
        "ok_layers": F.least(*layers) >= least_layer, "ok_cross": share("cross") >= 0.5, "ok_mcq": share("mcq").between(0.5, 0.7), "ok_temporal": share("temporal_grounding").between(0.15, 0.25),
        "ok_buckets": (marks > 0) & (F.least(*buckets) >= 0.15 * marks),
    }
    for name, c in checks.items():
        out = out.withColumn(name, c)
    return out.withColumn("ok", F.expr(" and ".join(checks)))


def first_of_key(rows: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """Keep the first row of each key; min_by combines before the shuffle, so a common key is no hot group."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(key.alias("__key")).agg(F.min_by(whole, F.struct(*order)).alias("r"), F.count(F.lit(1)).alias("n_same")).select("r.*", "n_same")


def option_spread(lengths: Column) -> Column:
    """Population deviation over mean of an array of lengths."""
    mean = F.aggregate(lengths, F.lit(0.0), lambda s, x: s + x) / F.size(lengths)
    deviation = F.sqrt(F.aggregate(lengths, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / F.size(lengths))
    return F.when(mean > 0, deviation / F.when(mean > 0, mean)).otherwise(0.0)


def first_fault(q: DataFrame, spread: float = 0.35) -> Column:
    """The first rule that a question breaks, or null: question, type, span, options, answer, option lengths, target."""
    lengths = F.transform("options", lambda o: F.greatest(T.zh_len(o), T.en_len(o)).cast("double"))
    at = F.array_position(F.array(*map(F.lit, "ABCD")), F.col("answer")).cast("int")
    longest = F.array_max(lengths)
    own = F.try_element_at(lengths, at)
    alone = (own == longest) & (F.size(F.filter(lengths, lambda x: x == longest)) == 1)
    mcq = F.col("task_type") == "mcq"
    return F.coalesce(
        F.when(F.coalesce("question", F.lit("")) == "", "no question"),
        F.when(~F.col("task_type").isin("mcq", "temporal_grounding", "open", "summary"), "task type"),
        F.when(~F.coalesce(F.col("e") > F.col("s"), F.lit(False)), "span"),
        F.when(mcq & (F.size("options") != 4), "options"),
        F.when(mcq & (F.coalesce(at, F.lit(0)) == 0), "answer"),
        F.when(mcq & (option_spread(lengths) >= spread), "option lengths"),
        F.when(mcq & alone, "longest option"),
        F.when((F.col("task_type") == "temporal_grounding") & (F.col("e") - F.col("s") < 5), "target"),
    )


def faults(questions: DataFrame, anchors: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    """``questions`` with ``fault``, the first rule that each breaks, or null.

    ``questions``: video_id, qid, duration, task_type, question, evidence and target (arrays of two numbers), anchor_id,
    options, answer, ref_zh, ref_en. ``anchors``: video_id, anchor_id, s, e. Evidence must be valid, inside the
    timeline, inside some anchor of the video, and touch the question's own anchor; a temporal target must be inside
    that; then come the rules of each task type. A video without anchors is only checked against its timeline. A
    video's anchors are a bounded pool (capped when they are chosen), so they are joined as one array.
    """
    tol = limits.span_tolerance
    pool = anchors.groupBy("video_id").agg(F.collect_list(F.struct("s", "e")).alias("pool"))
    own = anchors.select("video_id", "anchor_id", F.struct("s", "e").alias("own")).dropDuplicates(["video_id", "anchor_id"])
    q = questions.join(pool, "video_id", "left").join(own, ["video_id", "anchor_id"], "left")
    q = q.withColumn("any", F.filter("pool", lambda a: a["e"] > a["s"])).withColumn("spans", F.transform("evidence", I.pair))
    outside = lambda p: (p["s"] < 0) | ((F.col("duration") > 0) & (p["e"] > F.col("duration") + tol))
    inside = lambda p: F.exists("any", lambda a: I.within(p["s"], p["e"], a["s"], a["e"], tol))
    a_span = lambda p: F.when(p.isNull(), "evidence").when(outside(p), "evidence outside").when((F.size("any") > 0) & ~inside(p), "evidence off anchors")
    first = F.try_element_at(F.filter(F.transform("spans", a_span), lambda x: x.isNotNull()), F.lit(1))
    good = F.col("own.e") > F.col("own.s")
    touches = F.exists("spans", lambda p: I.overlap_ratio(p["s"], p["e"], F.col("own.s"), F.col("own.e")) > 0)
    kind, target = F.col("task_type"), I.pair(F.col("target"))
    temporal, mcq, open_ = kind == "temporal_grounding", kind == "mcq", kind.isin("open", "summary")
    lengths = F.transform("options", lambda o: F.greatest(T.zh_len(o), T.en_len(o)).cast("double"))
    at = F.array_position(F.array(*map(F.lit, "ABCD")), F.col("answer")).cast("int")
    longest, mine = F.array_max(lengths), F.try_element_at(lengths, at)
    zh, en = F.coalesce("ref_zh", F.lit("")), F.coalesce("ref_en", F.lit(""))
    fault = F.coalesce(
        F.when((F.coalesce("question", F.lit("")) == "") | (F.coalesce(F.size("evidence"), F.lit(0)) <= 0), "no question or evidence"),
        F.when(~F.coalesce(kind.isin("mcq", "temporal_grounding", "open", "summary"), F.lit(False)), "task type"),
        first,
        F.when(F.col("own").isNotNull() & ~F.coalesce(good, F.lit(False)), "anchor"),
        F.when(F.col("pool").isNotNull() & F.col("own").isNull(), "unknown anchor"),
        F.when(good & ~touches, "evidence off own anchor"),
        F.when(temporal & target.isNull(), "target"),
        F.when(temporal & outside(target), "target outside"),
        F.when(temporal & good & ~I.within(target["s"], target["e"], F.col("own.s"), F.col("own.e"), tol), "target off anchor"),
        F.when(mcq & ((F.coalesce(F.size("options"), F.lit(0)) != 4) | (F.coalesce(at, F.lit(0)) == 0)), "options or answer"),
        F.when(mcq & (longest <= 0), "empty options"),
        F.when(mcq & (option_spread(lengths) >= limits.option_spread), "option lengths"),
        F.when(mcq & (mine == longest) & (F.size(F.filter(lengths, lambda x: x == longest)) == 1), "longest option"),
        F.when(temporal & (target["e"] - target["s"] < limits.target_sec), "target width"),
        F.when(open_ & (T.zh_len(zh) < limits.reference_zh) & (T.en_len(en) < limits.reference_en), "short reference"),
        F.when(open_ & (T.anchors(zh) + T.anchors(en) < 2) & ~F.concat(zh, en).contains('"'), "no details"),
    )
    return q.withColumn("fault", fault).drop("pool", "own", "any", "spans")


def known_capabilities(capability: Column) -> Column:
    """Unknown capabilities go; none left means causal."""
    kept = F.array_intersect(F.coalesce(capability, F.array().cast("array<string>")), F.array(*map(F.lit, CAPABILITIES)))
    return F.when(F.size(kept) == 0, F.array(F.lit("L3_causal"))).otherwise(kept)


def channel_requests(questions: DataFrame) -> DataFrame:
    """One request for each question and channel that is tried on its kind: qid, task_type, channel, request_hash."""
    from tidemark.operators.providers import request_hash

    rows = questions.select("qid", "task_type", F.explode(channels_of(F.col("task_type"))).alias("channel"))
    return rows.withColumn("request_hash", request_hash(F.col("channel"), F.col("qid")))


def channel_verdicts(answered: DataFrame, hit: Column) -> DataFrame:
    """A row a question with one flag a channel; null where the channel wasn't tried or answered."""
    return answered.withColumn("hit", hit).groupBy("qid").pivot("channel", list(CHANNELS)).agg(F.bool_or("hit"))
