"""Every query of the library by name, with the SQL that checks it on the same tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import CAPABILITIES, DEFAULT, GENRES, MODALITIES, Thresholds
from tidemark.functions import intervals as I
from tidemark.functions import text as T
from tidemark.operators import agreement, audio, engine, frames, gate, generate, incremental, joins, narrative, pairs, providers, questions, segments, verify, workflow
from tidemark.operators import describe as describe_tree
from tidemark.plans import checks
from tidemark.sources import fixtures as X
from tidemark.sources import json_io, schema
from tidemark.steps import Steps

QUERIES: dict = {}
ORACLES = checks.SQL
#: At most this many benchmark items, or candidates with their items, are broadcast; beyond it they are not.
BROADCAST_ITEMS = 10_000


def query(f):
    QUERIES[f.__name__] = f
    return f


def r6(c) -> object:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- agreement and gate


def _rater_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = X.table(spark, d, "labels").select(F.col("doc_id").alias("unit"), F.explode(F.array("quality", 1 - F.col("toxic"))).alias("value"))
    return rows


@query
def qc_krippendorff_alpha(spark, d):
    return agreement.alpha_nominal(_rater_labels(spark, d)).select(r6("alpha").alias("alpha"))


@query
def qc_alpha_ordinal(spark, d):
    ratings = X.responses(spark, d).select(F.col("qid").alias("unit"), F.col("response").alias("value"))
    return agreement.alpha_ordinal(ratings).select(r6("alpha").alias("alpha"))


@query
def qc_cohen_kappa(spark, d):
    return agreement.cohen_kappa(X.table(spark, d, "labels").select(F.col("quality").alias("a"), (1 - F.col("toxic")).alias("b"))).select(r6("kappa").alias("kappa"))


@query
def qc_gold_accuracy(spark, d):
    return agreement.gold_accuracy(X.responses(spark, d).where("task_type = 'mcq'")).withColumn("accuracy", r6("accuracy"))


@query
def qc_rework(spark, d):
    return agreement.rework(X.responses(spark, d).where("task_type = 'mcq'"), gold=True).withColumn("agreement", r6("agreement")).withColumn("answers", F.array_join("answers", ","))


@query
def qc_mcq_alpha_non_gold(spark, d):
    return agreement.alpha_nominal(X.responses(spark, d).where("task_type = 'mcq' and not is_gold").select(F.col("qid").alias("unit"), F.col("response").alias("value"))).select(r6("alpha").alias("alpha"))


@query
def qc_interval_miou(spark, d):
    items = agreement.interval_items(X.responses(spark, d).where("task_type = 'temporal_grounding'"))
    return agreement.pass_ratio(items, ["video_id"], DEFAULT.iou_share).withColumn("mean_iou", r6("mean_iou"))


def _pairs_of_turns(spark, d) -> DataFrame:
    c = X.table(spark, d, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    return c.withColumn("reply", F.lead("text").over(w)).withColumn("by", F.lead("role").over(w)).where("role = 'user' and by = 'assistant'")


@query
def qc_open_agreement(spark, d):
    grams = lambda c: T.ngrams(F.col(c))
    return _pairs_of_turns(spark, d).select("conv_id", "turn", grams("text").alias("a"), grams("reply").alias("b")).select("conv_id", "turn", r6(T.jaccard(F.col("a"), F.col("b"))).alias("similarity"))


@query
def text_rouge_l(spark, d):
    """ROUGE-L of the tokens of each benchmark item and the next."""
    b = X.table(spark, d, "benchmark")
    pairs = b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other")), "item_id")
    return pairs.select("item_id", r6(T.rouge_l(T.tokens(F.col("text")), T.tokens(F.col("other")))).alias("rouge_l"))


def _gate_responses(spark, d) -> DataFrame:
    """Responses of all kinds. In a third of the videos raters agree; some videos lack choices, intervals or texts."""
    v, o = F.col("video_id"), F.col("ord")
    k = o + F.substring("annotator", 2, 1).cast("int")
    r = X.responses(spark, d).join(X.spans(spark, d).select("video_id", "ord", F.col("txt").alias("reference")), ["video_id", "ord"])
    lacks = ((v % 5 == 2) & (F.col("task_type") == "mcq")) | ((v % 6 == 0) & (F.col("task_type") == "temporal_grounding")) | ((v % 4 == 1) & F.col("task_type").isin("open", "summary"))
    text = F.when(k % 4 == 0, "").when((k % 4 == 1) | (v % 3 == 0), F.col("reference")).otherwise(F.concat("reference", F.lit(" and other words")))
    return r.where(~lacks).withColumn("response", F.when(v % 3 == 0, F.col("answer")).otherwise(F.col("response"))).withColumn("text", text)


def _facts(spark, d) -> DataFrame:
    v, o = F.col("video_id"), F.col("ord")
    videos, e = X.videos(spark, d), X.events(spark, d)
    gaps = segments.gaps(videos, X.spans(spark, d), DEFAULT.coverage_eps, DEFAULT.coverage_eps, True)
    shots = X.shots(spark, d).withColumn("desc", F.when((v % 7 == 3) & (o % 9 == 0), "").otherwise("seen"))
    parts = X.scenes(spark, d).where("video_id % 17 <> 4").withColumn("quiet", (v % 11 == 5) & (F.col("scene_id") == 3))
    qa = X.qa(spark, d).select("video_id", "qid", "ord", "task_type", F.col("txt").alias("zh"), F.when(o % 30 != 0, F.col("txt")).alias("en"), (o % 20 != 13).alias("has_target"), F.when(o % 3 != 0, (o % 10) / 10.0).alias("miou"))
    stages = videos.select("video_id", F.explode(F.array(F.lit("S1"), F.lit("S6"))).alias("stage")).withColumn("state", F.when((v % 50 == 0) & (F.col("stage") == "S6"), "failed").otherwise("done"))
    validity = videos.where("video_id % 2 = 0 or video_id % 23 = 7").select("video_id", (v % 23 != 7).alias("valid"))
    return gate.facts(videos, gaps, e, shots, parts, qa, questions.coverage(_qa(spark, d), X.DURATION), _gate_responses(spark, d), stages, validity)


@query
def gate_facts(spark, d):
    """Every fact of the release gate of each video."""
    return _facts(spark, d).withColumn("alpha", r6("alpha"))


@query
def mcq_levels(spark, d):
    """Choice statistics of each video and of the batch."""
    out = agreement.mcq_levels(_gate_responses(spark, d).where("task_type = 'mcq'"))
    return out.withColumn("alpha", r6("alpha")).withColumn("flagged", F.array_join("flagged", ","))


@query
def open_levels(spark, d):
    """Open and temporal questions of each video and of the batch."""
    r = _gate_responses(spark, d)
    kinds = (("open", agreement.open_levels(r.where("task_type in ('open', 'summary')"))), ("interval", agreement.interval_levels(r.where("task_type = 'temporal_grounding'"))))
    one, other = (x.select(F.lit(k).alias("kind"), "video_id", "batch", "n", "ratio", "ok") for k, x in kinds)
    return one.unionByName(other)


@query
def qc_release_gate(spark, d):
    gated = gate.effect(gate.release_gate(_facts(spark, d)))
    return gated.select("video_id", *gate.GATES, F.array_join("unevaluated", ",").alias("unevaluated"), F.col("pass").alias("passes"), "reasons", "review_status")


@query
def qc_batch_verdict(spark, d):
    return gate.batch_verdict(gate.release_gate(_facts(spark, d)), _todos(spark, d))


def _todos(spark, d) -> DataFrame:
    """Todos that steps noted (some twice, some told again by the events), the events, and uncovered gaps."""
    e = X.events(spark, d).withColumn("event_id", F.col("ord").cast("string"))
    none = F.lit(None).cast("string")
    noted = e.where("ord % 6 = 3").select("video_id", F.when(F.col("ord") % 4 == 3, "key_event_unreviewed").otherwise("event_span_invalid").alias("kind"), "event_id", "s", "e", F.lit("noted").alias("reason"))
    gaps = segments.gaps(X.videos(spark, d), X.spans(spark, d), DEFAULT.coverage_eps, DEFAULT.coverage_eps, True).select("video_id", F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), F.lit("uncovered").alias("reason"))
    return gate.human_todo(noted.unionByName(noted), e.withColumn("reason", none), gaps)


@query
def human_todo(spark, d):
    return _todos(spark, d)


@query
def release_report(spark, d):
    out = gate.report(gate.release_gate(_facts(spark, d)), _todos(spark, d))
    get = lambda path: F.get_json_object("report", f"$.{path}")
    return out.select(get("n").cast("long").alias("n"), get("human_todo_total").cast("long").alias("todos"), get("thresholds.alpha").cast("double").alias("alpha"), F.size(F.from_json(get("failed"), "array<struct<video_id: bigint, reasons: string>>")).cast("long").alias("failed"))


@query
def mcq_stats(spark, d):
    return agreement.mcq_stats(X.responses(spark, d).where("task_type = 'mcq'")).withColumn("alpha", r6("alpha"))


@query
def answer_keys(spark, d):
    q = X.qa(spark, d).withColumn("answer", F.when(F.col("ord") % 10 != 1, F.col("answer")))
    every, gold = agreement.keys(q)
    return every.join(gold.select("qid", F.lit(True).alias("gold")), "qid", "left").select("qid", "answer", F.coalesce("gold", F.lit(False)).alias("gold"))


# --- ordered operators


@query
def span_union(spark, d):
    return segments.merge_spans(X.spans(spark, d), DEFAULT.coverage_eps)


@query
def span_coverage_gaps(spark, d):
    return segments.gaps(X.videos(spark, d), X.spans(spark, d), DEFAULT.coverage_eps, DEFAULT.coverage_eps, True).select("video_id", r6("s").alias("s"), r6("e").alias("e"))


@query
def nonspeech_gaps(spark, d):
    return segments.gaps(X.videos(spark, d), X.spans(spark, d), 0.0, DEFAULT.speech_gap_sec, False).select("video_id", r6("s").alias("s"), r6("e").alias("e"))


@query
def ocr_span_merge(spark, d):
    return segments.merge_same_text(X.points(spark, d), DEFAULT.ocr_gap_sec)


@query
def caption_merge(spark, d):
    return segments.merge_captions(X.points(spark, d), DEFAULT.caption_similarity, DEFAULT.caption_gap_sec)


@query
def sliding_windows_join(spark, d):
    w = segments.sliding_windows(X.points(spark, d), DEFAULT.event_window_sec, DEFAULT.event_step_sec, X.DURATION)
    return w.groupBy("video_id", "k", "ws", "we").agg(F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ords"))


@query
def fixed_windows(spark, d):
    return segments.fixed_windows(X.videos(spark, d), DEFAULT.window_sec)


@query
def build_windows(spark, d):
    return segments.greedy_windows(X.shots(spark, d), DEFAULT.window_sec)


@query
def shot_groups(spark, d):
    return segments.shot_groups(X.shots(spark, d), DEFAULT.shot_group_sec)


@query
def first_fit_clusters(spark, d):
    return segments.first_fit_clusters(X.spans(spark, d))


@query
def pair_dedup(spark, d):
    """Of clusters of two events with like descriptions the longer one stays."""
    e = X.spans(spark, d).withColumn("txt", F.concat(F.repeat(F.concat("txt", F.lit(" at the gate ")), 3), F.repeat(F.lit("!"), (F.col("ord") % 9).cast("int"))))
    return narrative.pair_dedup(e, segments.first_fit_clusters(e))


@query
def anchor_cap_roundrobin(spark, d):
    anchors = X.events(spark, d).withColumn("used", F.col("ord") % 5 == 0)
    return segments.round_robin_cap(anchors, 40, X.DURATION).select("video_id", "ord", "bucket", "used")


# --- joins


def _windows(spark, d):
    return segments.fixed_windows(X.videos(spark, d), DEFAULT.window_sec)


@query
def window_subtitle_join(spark, d):
    subs = X.spans(spark, d).select("video_id", "ord", F.col("s").alias("rs"), F.col("e").alias("re"), "txt")
    met = joins.range_join(_windows(spark, d), subs, DEFAULT.window_sec)
    return met.groupBy("video_id", "s", "e").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rs", "ord", "txt"))), lambda x: x["txt"]), "\n").alias("subtitles"))


@query
def window_ocr_join(spark, d):
    """Screen text of each window, joined by pipes; screen text counts by its point in time."""
    ocr = X.points(spark, d).where("ord % 4 = 1").select("video_id", "ord", F.col("t").alias("rs"), F.col("t").alias("re"), "txt")
    met = joins.range_join(_windows(spark, d), ocr, DEFAULT.window_sec)
    return met.groupBy("video_id", "s", "e").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rs", "ord", "txt"))), lambda x: x["txt"]), " | ").alias("ocr"))


@query
def shot_segment_join(spark, d):
    shots = X.shots(spark, d).select("video_id", "ord", F.col("s").alias("rs"), F.col("e").alias("re"))
    return joins.range_join(_windows(spark, d), shots, DEFAULT.window_sec, strict=True).select("video_id", "s", "ord")


@query
def asof_frame(spark, d):
    frames = X.points(spark, d).where("ord % 3 = 0").groupBy("video_id", F.col("t").alias("ft")).agg(F.min("t").alias("frame"))
    asked = X.points(spark, d).select("video_id", "ord", "t")
    return joins.asof_join(asked, frames, "t", "ft", "frame").select("video_id", "ord", "t", F.col("found").alias("frame"))


@query
def scene_link(spark, d):
    return narrative.scene_of(X.spans(spark, d), X.scenes(spark, d), 60.0).select("video_id", "ord", "scene_id")


@query
def scene_alignment(spark, d):
    linked = narrative.scene_of(X.spans(spark, d), X.scenes(spark, d), 60.0)
    return narrative.alignment(linked, X.scenes(spark, d)).select("video_id", "ord", "scene_id", r6("ratio").alias("ratio"), "aligned")


@query
def overlap_pairs(spark, d):
    return joins.self_overlaps(X.spans(spark, d), DEFAULT.overlap, 10.0).select("video_id", "a", "b", r6("ratio").alias("ratio"))


@query
def neighbour_alerts(spark, d):
    return narrative.neighbour_alerts(X.spans(spark, d)).withColumn("ratio", r6("ratio"))


@query
def evidence_subtitles(spark, d):
    """Text of the subtitles under each question's evidence, in order, and the middle of the evidence."""
    q = X.qa(spark, d).where("task_type = 'mcq'").select("video_id", "qid", "s", "e")
    subs = X.spans(spark, d).where("ord % 4 = 0").select("video_id", "ord", F.col("s").alias("rs"), F.col("e").alias("re"), "txt")
    met = joins.range_join(q, subs, 20.0)
    return met.groupBy("qid", "s", "e").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rs", "ord", "txt"))), lambda x: x["txt"]), " ").alias("txt")).select("qid", r6((F.col("s") + F.col("e")) / 2).alias("mid"), "txt")


@query
def responses_semi_anti(spark, d):
    """Responses to gold keys, to other questions, and to no question."""
    r, q = X.responses(spark, d).select("qid", "annotator"), X.qa(spark, d)
    gold = q.where("is_gold").select("qid")
    rest = r.join(gold, "qid", "left_anti")
    return r.join(gold, "qid", "left_semi").select("annotator", F.lit("gold").alias("part")).unionByName(rest.select("annotator", F.lit("other").alias("part"))).groupBy("annotator", "part").agg(F.count(F.lit(1)).alias("n"))


@query
def alias_match(spark, d):
    """Suppliers of a nation as persons, against mentions in several spellings, and the mentions that are left."""
    names, seen = _persons(spark, d)
    matched = narrative.match_alias(names, seen)
    return matched.select("video_id", "id", "alias").unionByName(narrative.unmatched(matched, seen).select("video_id", F.lit(None).cast("string").alias("id"), F.col("name").alias("alias")))


def _persons(spark, d) -> tuple[DataFrame, DataFrame]:
    s = X.table(spark, d, "supplier")
    k = F.col("s_suppkey")
    names = s.select(F.col("s_nationkey").alias("video_id"), k.cast("string").alias("id"), F.when(k % 2 == 0, F.col("s_name")).alias("en"), F.when(k % 5 == 0, F.concat(F.lit("J.R."), k.cast("string"))).alias("zh"), F.array(F.concat(F.lit("No-"), k.cast("string"))).alias("aliases"))
    spelt = F.array(F.col("s_name"), F.upper(F.regexp_replace("s_name", "#", "_ #")), F.concat(F.lit("no "), k.cast("string")), F.concat(F.lit("JR"), k.cast("string")), F.concat(F.lit("j.r.·"), k.cast("string")))
    seen = s.select(F.col("s_nationkey").alias("video_id"), k, F.posexplode(spelt).alias("p", "name")).where((k + F.col("p")) % 3 == 0)
    return names, seen.select("video_id", "name", (F.col("s_suppkey") * 10 + F.col("p")).alias("ord"))


# --- questions


def _qa(spark, d) -> DataFrame:
    """Questions with several capabilities and spans of evidence."""
    first, later = F.struct("s", "e"), F.struct((F.col("s") / 2).alias("s"), (F.col("s") / 2 + 4).alias("e"))
    return X.qa(spark, d).select(
        "*", F.when(F.col("ord") % 9 == 0, F.array(first, later)).otherwise(F.array(first)).alias("spans"), F.when(F.col("ord") % 5 == 0, F.array("capability", F.lit("L5_needle"))).otherwise(F.array("capability")).alias("caps")
    ).drop("capability").withColumnRenamed("caps", "capability")


@query
def coverage_matrix(spark, d):
    return questions.coverage(_qa(spark, d), X.DURATION)


@query
def drop_policy(spark, d):
    return questions.with_drop(_qa(spark, d)).select("qid", "dropped")


@query
def drop_by_channel(spark, d):
    return questions.drops_by_channel(_qa(spark, d))


@query
def difficulty(spark, d):
    q = _qa(spark, d)
    return q.groupBy(questions.difficulty(q).alias("difficulty")).agg(F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ords"))


@query
def channel_sets(spark, d):
    return X.qa(spark, d).select(F.explode(questions.channels_of(F.col("task_type"))).alias("channel")).groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


def _rescreen(spark, d) -> tuple[DataFrame, DataFrame]:
    """A second run over all channels: two videos in three are screened, one of the three names its own provider."""
    o = F.col("ord")
    every = lambda n: o % n == 0
    q = _qa(spark, d).select("*", every(19).alias("synopsis"), every(23).alias("language_prior"), every(6).alias("subtitle_locate"), every(14).alias("blind_similar"), F.when(o % 4 != 0, "auto:west").alias("checked_by"))
    flags = zip(questions.CHANNELS, (17, None, 5, 29, 31, 10, 9), strict=True)
    second = q.where("ord % 2 = 0").select("qid", *((every(n) if n else F.lit(None).cast("boolean")).alias(c) for c, n in flags))
    provider = X.pick(F.col("video_id") % 3, ("north", "south", "east"))
    return questions.rescreen(X.videos(spark, d).select("video_id", provider.alias("provider"), F.array(F.lit("auto:north:large"), F.lit("human:a")).alias("annotators")), q, second)


@query
def rescreen_combine(spark, d):
    return _rescreen(spark, d)[0].select("qid", "new_qid")


@query
def rescreen(spark, d):
    """The kept questions with the record of both runs, and a row a video."""
    kept, stats = _rescreen(spark, d)
    hits = F.array_compact(F.array(*(F.when(F.col(c), F.lit(c)) for c in questions.CHANNELS)))
    text = lambda c: F.array_join(c, ",")
    rows = kept.select("video_id", "qid", "new_qid", "checked_by", text("primary").alias("primary_hits"), text("secondary").alias("secondary_hits"), text(hits).alias("hits"))
    none = F.lit(None).cast("string")
    return rows.unionByName(stats.select("video_id", none.alias("qid"), none.alias("new_qid"), F.concat(F.lit("auto:"), "provider").alias("checked_by"), F.col("before").cast("string").alias("primary_hits"), F.col("after").cast("string").alias("secondary_hits"), text("dropped").alias("hits")))


@query
def question_dedup(spark, d):
    rows = X.table(spark, d, "documents").select("doc_id", "text", "lang")
    return questions.first_of_key(rows, F.md5(T.question_key(F.col("text")).cast("binary")), ["doc_id"]).select("doc_id", "n_same")


@query
def question_keys(spark, d):
    """The first question of each key of text and answer."""
    p = X.points(spark, d)
    zh = F.when(F.col("ord") % 5 == 0, F.lit("第 三 次？")).when(F.col("ord") % 5 == 1, " ，")
    rows = p.select("video_id", "ord", T.answered_key(zh, F.concat(F.upper("txt"), F.lit(" -- who_is it?")), F.when(F.col("ord") % 3 != 0, X.pick(F.col("ord") % 4, "ABCD"))).alias("key"))
    return questions.first_of_key(rows, F.concat_ws(":", "video_id", "key"), ["ord"]).select("video_id", "ord", "key", "n_same")


def _asked(spark, d) -> tuple[DataFrame, DataFrame]:
    """Questions with evidence, anchors and references of every kind of fault, and the anchors."""
    o, s, e = F.col("ord"), F.col("s"), F.col("e")
    two = lambda a, b: F.array(a, b)
    words = F.array(*(F.left(F.repeat(F.lit(c), 20), F.lit(6) + (o % m).cast("int")) for c, m in zip("abcd", (3, 5, 7, 4), strict=True)))
    evidence = F.when(o % 17 == 0, F.array(two(e, s))).when(o % 17 == 1, F.array().cast("array<array<double>>")).when(o % 17 == 2, F.array(two(s, s + 100_000))).when(o % 9 == 0, F.array(two(s, e), two(s / 2, s / 2 + 4))).otherwise(F.array(two(s, e)))
    target = F.when(o % 8 == 5, F.array().cast("array<double>")).when(o % 8 == 4, two(s, s + 40)).when(o % 16 == 6, two(s - 0.5, s + 5.5)).otherwise(two(s, e))
    q = X.qa(spark, d).select(
        "video_id", "ord", "qid", F.lit(X.DURATION).alias("duration"), F.when(o % 41 == 0, "essay").otherwise(F.col("task_type")).alias("task_type"), F.when(o % 37 == 0, "").otherwise(F.col("txt")).alias("question"),
        evidence.alias("evidence"), target.alias("target"), F.when(o % 3 == 1, o - 1).otherwise(o).alias("anchor_id"),
        F.when(o % 31 == 0, F.slice(words, 1, 3)).when(o % 43 == 0, F.array_repeat(F.lit("  "), 4)).otherwise(words).alias("options"), F.when(o % 29 == 0, "E").otherwise(F.col("answer")).alias("answer"),
        F.when(o % 4 == 0, F.concat(F.repeat(F.lit("字"), 80), F.lit(" 00:10 00:20"))).when(o % 4 == 2, "短").when(o % 4 == 3, F.repeat(F.lit("字"), 90)).alias("ref_zh"), F.when(o % 4 == 1, F.concat(F.repeat(F.lit("word "), 220), F.lit('"quoted"'))).alias("ref_en"),
    )
    anchors = X.events(spark, d).where("ord % 3 <> 1").select("video_id", o.alias("anchor_id"), (s - 3).alias("s"), F.when(o % 30 == 0, s - 3).otherwise(e + 3).alias("e"))
    return q, anchors


@query
def question_validation(spark, d):
    return questions.faults(*_asked(spark, d)).select("qid", "fault")


@query
def referring_check(spark, d):
    o = F.col("ord")
    zh = F.when(o % 3 == 0, F.concat(F.lit("第三次出现的是谁和谁在"), F.repeat(F.lit("字"), (o % 7).cast("int")))).when(o % 3 == 1, F.repeat(F.lit("字"), 16))
    en = F.when(o % 5 == 0, F.concat("txt", F.repeat(F.lit(" word"), (o % 12).cast("int")))).when(o % 5 == 1, "who enters the room at 12:30 and then leaves it with the box")
    return X.points(spark, d).select("ord", T.referring_fault(zh, en).alias("fault"))


@query
def question_faults(spark, d):
    q = X.qa(spark, d)
    words = F.array(*(F.left(F.repeat(F.lit(c), 20), F.lit(6) + (F.col("ord") % m).cast("int")) for c, m in zip("abcd", (3, 5, 7, 4), strict=True)))
    rows = q.withColumn("options", F.when(F.col("ord") % 31 == 0, F.slice(words, 1, 3)).otherwise(words)).withColumn("question", F.when(F.col("ord") % 37 == 0, "").otherwise(F.col("txt")))
    return rows.select("qid", questions.first_fault(rows).alias("fault"))


@query
def capability_defaults(spark, d):
    q = X.qa(spark, d).withColumn("c", F.when(F.col("ord") % 5 == 0, F.array(F.lit("L9_none"))).otherwise(F.array(F.col("capability"), F.lit("L9_none"))))
    return q.select(F.explode(questions.known_capabilities(F.col("c"))).alias("capability")).groupBy("capability").agg(F.count(F.lit(1)).alias("n"))


@query
def language_prior_leak(spark, d):
    """Benchmark items that stand word for word in a document: a key that an item has inside makes candidates, the whole
    text decides.

    Items of seven words and more have their second to sixth word as key, those of three to six their second: inner words
    stand whole in a document. Items of one or two words may begin or end inside a word, so their keys are the three first
    characters, or all of fewer. Keys of a document that no item has are dropped before they become rows, as long as the
    items' keys are few enough to be broadcast; otherwise both are joined by shuffle. Candidates are written once.
    """
    words = lambda c: F.filter(F.split(c, "[ \\n]"), lambda w: w != "")
    run = lambda w, i: F.array_join(F.slice(w, i, 5), " ")
    step = Steps(spark, "leak")
    w, n = F.col("w"), F.size("w")
    items = X.table(spark, d, "benchmark").select("item_id", F.col("text").alias("item"), words(F.col("text")).alias("w")).where("size(w) > 0")
    key = F.when(n >= 7, F.concat(F.lit("5:"), run(w, F.lit(2)))).when(n >= 3, F.concat(F.lit("1:"), w[1])).otherwise(F.concat(F.lit("c:"), F.substring("item", 1, 3)))
    items = step(items.select("item_id", "item", key.alias("key")))
    docs = X.table(spark, d, "documents").select("doc_id", "text", words(F.col("text")).alias("w"))
    kinds = {r[0] for r in items.select(F.left("key", F.lit(2))).distinct().collect()}  # of three
    none = F.array().cast("array<string>")
    parts = []
    if "5:" in kinds:
        parts.append(F.when(n >= 5, F.transform(F.sequence(F.lit(1), n - 4), lambda i: F.concat(F.lit("5:"), run(w, i)))).otherwise(none))
    if "1:" in kinds:
        parts.append(F.transform(w, lambda x: F.concat(F.lit("1:"), x)))
    if "c:" in kinds:
        size = F.length("text")
        grams = lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.concat(F.lit("c:"), F.substring(F.col("text"), i, F.lit(k))))
        parts += [F.when(size >= k, grams(k)).otherwise(none) for k in (1, 2, 3)]
    keys = items.select("key").distinct()
    few = items.limit(BROADCAST_ITEMS + 1).count() <= BROADCAST_ITEMS
    made = F.array_distinct(F.concat(none, *parts))
    if few:
        known = [r["key"] for r in keys.collect()]
        made = F.array_intersect(made, F.from_json(F.lit(json.dumps(known)), "array<string>"))
    runs = docs.select("doc_id", F.explode(made).alias("key"))
    met = step(runs.join(items.select("item_id", "key"), "key").select("doc_id", "item_id").distinct())
    rare = met.limit(BROADCAST_ITEMS + 1).count() <= BROADCAST_ITEMS
    met = met.join(items.select("item_id", "item"), "item_id")
    return docs.select("doc_id", "text").join(F.broadcast(met) if rare else met, "doc_id").where(F.col("text").contains(F.col("item"))).select("item_id", "doc_id")


# --- text


@query
def text_lengths(spark, d):
    text = F.col("text")
    return X.table(spark, d, "documents").select("doc_id", T.zh_len(text).alias("zh_len"), T.en_len(text).alias("en_len"), T.lang_len(text, F.col("lang")).alias("lang_len"))


@query
def anchor_counts(spark, d):
    p = X.points(spark, d)
    clock = F.format_string("at %d:%02d then %02d:%02d", F.floor(F.col("t") / 60), F.floor(F.col("t") % 60), F.floor(F.col("v") % 24), F.floor(F.col("v") % 60))
    return p.select("ord", T.anchors(F.when(F.col("ord") % 3 == 0, "none").otherwise(clock)).alias("n"))


@query
def referring_context(spark, d):
    p = X.points(spark, d)
    q = F.when(F.col("ord") % 4 == 0, F.concat(F.lit("the second "), "txt")).when(F.col("ord") % 4 == 1, F.concat(F.lit("he said “"), "txt", F.lit("”"))).when(F.col("ord") % 4 == 2, F.concat(F.lit("strengthen "), "txt")).otherwise(F.lit("第三次出现"))
    return p.select("ord", T.referring(q).alias("ok"))


@query
def tokens(spark, d):
    c = X.table(spark, d, "conversations").select("conv_id", "turn", T.tokens(F.concat("text", F.lit(" 约 12:30 新娘 it's 3.5"))).alias("w"))
    return c.select("conv_id", "turn", F.size("w").alias("n"), F.md5(F.array_join("w", " ").cast("binary")).alias("digest"))


@query
def ngram_neardup(spark, d):
    """All pairs of benchmark items and variants of them with like trigrams."""
    b = X.table(spark, d, "benchmark").select(F.col("item_id").cast("long").alias("id"), "text")
    longer = b.select((F.col("id") + 1_000_000).alias("id"), F.concat("text", F.lit(" and so on")).alias("text"))
    loud = b.where("id % 3 = 0").select((F.col("id") + 2_000_000).alias("id"), F.concat(F.lit("Q: "), F.upper("text")).alias("text"))
    every = b.unionByName(longer).unionByName(loud)
    return pairs.similar_sets(every.select("id", T.ngrams(F.col("text")).alias("items")), DEFAULT.similarity).withColumn("similarity", r6("similarity"))


@query
def embedding_neardup(spark, d):
    """A search: rows whose vec_id is divisible by 20 are the queries, against all rows of their label, cosine 0.4 or more."""
    e = X.table(spark, d, "embeddings").select("label", F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = pairs.vector_search(e.where("id % 20 = 0"), e, 0.4)
    return found.select(F.col("id").alias("vec_id"), "other", F.round("cosine", 5).alias("cosine"))


@query
def element_gate(spark, d):
    """Whole documents as segment descriptions, each in its language."""
    x = X.table(spark, d, "documents").select("doc_id", "text", "lang", T.elements(F.col("text")).alias("n"))
    faults = T.description_faults(F.lit("segment"), F.when(F.col("lang") == "zh", F.col("text")), F.when(F.col("lang") != "zh", F.col("text")), F.col("n"))
    return x.select("doc_id", F.col("n").cast("long").alias("n"), faults.alias("reasons"))


@query
def description_gate(spark, d):
    """Both levels, either language."""
    o = F.col("ord")
    zh = F.when(o % 4 == 0, F.concat(F.repeat(F.lit("字"), (60 + o % 50).cast("int")), F.lit(" 00:10"))).when(o % 4 == 1, F.concat(F.repeat(F.lit("镜"), 400), F.lit(" 约 00:10 约 00:20")))
    en = F.when(o % 4 == 2, F.concat(F.repeat(F.lit("word "), (50 + o % 20).cast("int")))).when(o % 4 == 3, F.concat(F.repeat(F.lit("word "), 350), F.lit("00:10 00:20")))
    return X.points(spark, d).select("ord", T.description_faults(F.when(o % 2 == 0, "shot").otherwise("segment"), zh, en, (o % 9).cast("int")).alias("faults"))


@query
def text_similarity(spark, d):
    o = F.col("ord")
    other = F.when(o % 7 == 0, "").when(o % 7 == 1, F.lit(None)).otherwise(F.concat("txt", F.lit(" again")))
    vector = lambda k: F.when(o % 3 != 0, F.array(*(((o * k) % m).cast("float") for m in (5, 7, 11))))
    return X.points(spark, d).select("ord", r6(T.similarity(F.col("txt"), other, vector(1), F.when(o % 2 == 0, vector(3)))).alias("similarity"))


@query
def option_prior(spark, d):
    q = X.points(spark, d)
    options = F.array("txt", F.lit("cat"), F.when(F.col("ord") % 5 == 0, " None of the above. ").otherwise("dog"), F.lit("tree"))
    return q.select("ord", T.language_prior(F.when(F.col("ord") % 7 == 0, F.slice(options, 1, 3)).otherwise(options), F.when(F.col("ord") % 3 == 0, F.concat(F.lit("why "), F.upper("txt"), F.lit("?")))).alias("hit"))


@query
def content_hashes(spark, d):
    return X.table(spark, d, "customer").select("c_custkey", incremental.content_hash(F.col("c_name"), F.col("c_nationkey"), F.col("c_mktsegment")).alias("hash"))


@query
def json_extract(spark, d):
    p = X.table(spark, d, "events")
    raw = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```"))).when(F.col("event_id") % 4 == 1, F.col("props")).when(F.col("event_id") % 4 == 2, F.concat(F.lit("the answer is "), "props", F.lit(" ok"))).otherwise(F.lit("no data"))
    return p.select("event_id", providers.json_body(raw).alias("body"))


# --- intervals and misc


@query
def time_buckets(spark, d):
    s = X.spans(spark, d)
    return s.groupBy("video_id", I.time_bucket(F.col("s"), F.lit(X.DURATION)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query
def duration_buckets(spark, d):
    o = X.table(spark, d, "orders").select(F.col("o_orderkey"), (F.col("o_totalprice") / 40).alias("sec"))
    asked = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderkey") % 50)
    return o.select("o_orderkey", I.duration_bucket(F.col("sec")).alias("bucket"), I.quota(F.col("sec")).alias("quota"), I.quota(F.col("sec"), override=asked).alias("wanted"))


@query
def pad_fractions(spark, d):
    return X.spans(spark, d).select("ord", r6(I.pad_fraction(F.concat_ws("|", F.col("ord").cast("string"), F.col("txt")))).alias("frac"))


@query
def frame_names(spark, d):
    p = X.points(spark, d).withColumn("name", I.frame_name(F.col("t")))
    return p.select("ord", "name", r6(I.frame_time(F.col("name"))).alias("back"))


@query
def paddings(spark, d):
    p = I.padding(F.concat_ws("|", F.col("ord").cast("string"), F.col("txt")), F.col("e") - F.col("s"), 4.0)
    return X.spans(spark, d).select("ord", p["before"].alias("before"), p["after"].alias("after"))


@query
def span_pairs(spark, d):
    o = F.col("ord")
    given = F.when(o % 4 == 0, F.array("e", "s")).when(o % 4 == 1, F.array("s")).when(o % 4 == 2, F.array("s", "e", "e")).otherwise(F.array("s", "e"))
    p = I.pair(given)
    return X.spans(spark, d).select("ord", p["s"].alias("s"), p["e"].alias("e"))


@query
def distinct_frames(spark, d):
    """At most five real frames around the middle of each span."""
    times = X.points(spark, d).groupBy("video_id").agg(F.array_sort(F.collect_set("t")).alias("times"))
    got = I.distinct_times(F.col("times"), F.col("s") - 30, F.col("e") + 30, 5)
    return X.spans(spark, d).join(times, "video_id").select("ord", F.size(got).alias("n"), F.array_join(F.transform(got, lambda t: F.format_string("%.3f", t)), " ").alias("times"))


def _names(spark, d) -> DataFrame:
    """Frame files of every video, and files that aren't frames."""
    return X.points(spark, d).select("video_id", F.when(F.col("ord") % 23 == 0, F.concat(F.lit("cover_"), "ord", F.lit(".jpg"))).otherwise(I.frame_name(F.col("t"))).alias("name"))


@query
def frame_index(spark, d):
    """At one frame in five seconds many times fall on one number."""
    return frames.index(_names(spark, d), 0.2)


@query
def frame_owners(spark, d):
    v = X.videos(spark, d).select(F.col("video_id").cast("string").alias("expected"), F.when(F.col("video_id") % 3 == 0, F.lit(None)).when(F.col("video_id") % 3 == 1, "other").otherwise(F.col("video_id").cast("string")).alias("video_id"), F.col("video_id").alias("k"))
    directory = F.when(F.col("k") % 2 == 0, F.col("expected")).otherwise("elsewhere")
    return frames.owned(v, directory).select("expected", "foreign")


@query
def frame_statistics(spark, d):
    """Of stored indexes, and of indexes built from names where none is stored."""
    p = X.points(spark, d).where("video_id % 2 = 0")
    stored = p.groupBy("video_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("ord").cast("string"), "t"))).alias("frames"))
    return frames.statistics(frames.loaded(stored, _names(spark, d), 0.2)).withColumn("step", r6("step"))


@query
def frame_index_check(spark, d):
    rows = X.points(spark, d).select("video_id", F.col("ord").alias("frame_no"), "t")
    return frames.verified(rows, F.lit(720.0), 0.5)


@query
def keyframes(spark, d):
    """Start, middle and end of each span, and three interior sample times."""
    times = X.spans(spark, d).select("ord", I.inside(F.col("s"), F.col("e"), 3).alias("inner"), r6(I.middle(F.col("s"), F.col("e"))).alias("mid"))
    return times.select("ord", "mid", *(r6(F.col("inner")[i]).alias(f"inner{i + 1}") for i in range(3)))


@query
def every_kth_point(spark, d):
    return segments.every_kth(X.points(spark, d), 4).select("video_id", "ord")


@query
def normalise_spans(spark, d):
    e = X.events(spark, d).withColumn("e", F.when(F.col("ord") % 10 == 0, F.col("s")).when(F.col("ord") % 10 == 1, F.col("s") - 5).otherwise(F.col("e")))
    return narrative.normalise_spans(e, 700.0).select("ord", r6("s").alias("s"), r6("e").alias("e"), "importance", "todo", "narrow")


@query
def causal_validate(spark, d):
    return narrative.causal_faults(X.events(spark, d))


@query
def character_stats(spark, d):
    o = X.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("video_id"), F.col("l_returnflag").alias("name"), F.col("l_quantity").alias("s"), (F.col("l_quantity") + F.col("l_discount") * 10 - 0.3).alias("e"))
    return narrative.character_stats(o).withColumn("screen_time", F.round("screen_time", 4))


def _verdicts(spark, d) -> DataFrame:
    o = F.col("ord")
    decision = X.pick(o % 5, ("verified", "refined", "split", "rejected", "odd"))
    return X.spans(spark, d).select("video_id", F.concat(F.lit("c"), o.cast("string")).alias("id"), "s", "e", decision.alias("decision"), (F.col("s") + 0.25).alias("rs"), (F.col("e") + 0.5).alias("re"), ((F.col("s") + F.col("e")) / 2).alias("at"))


@query
def boundary_apply(spark, d):
    return narrative.apply_verdicts(_verdicts(spark, d)).select("video_id", "id", r6("s").alias("s"), r6("e").alias("e"), "boundary_state")


@query
def boundary_stats(spark, d):
    v = _verdicts(spark, d)
    return narrative.boundary_stats(narrative.apply_verdicts(v), v.where("decision = 'rejected'"))


@query
def boundary_rounds(spark, d):
    """Two rounds: what the first refines or splits is judged again, halves by their own verdicts."""
    first = _verdicts(spark, d)
    o = F.length("id") + F.expr("cast(regexp_extract(id, '[0-9]+', 0) as bigint)")
    again = narrative.apply_verdicts(first).select("video_id", "id", X.pick(o % 4, ("verified", "refined", "split", "rejected")).alias("decision"), (F.col("s") + 0.1).alias("rs"), (F.col("e") - 0.1).alias("re"), ((F.col("s") * 3 + F.col("e")) / 4).alias("at"))
    kept, rejected = narrative.refine(first.select("video_id", "id", "s", "e"), first, again.where(F.length("id") % 5 != 0))
    return kept.unionByName(rejected.withColumn("boundary_state", F.lit("rejected"))).select("video_id", "id", r6("s").alias("s"), r6("e").alias("e"), "boundary_state")


@query
def event_density(spark, d):
    return narrative.density(X.events(spark, d), 0.2)


@query
def importance_batches(spark, d):
    return narrative.batched(X.events(spark, d), 40, ["video_id"], ["s", "ord"]).groupBy("video_id", F.col("batch").cast("long").alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))


@query
def candidate_union(spark, d):
    s = X.spans(spark, d)
    mined = s.where("ord % 3 = 0").select("video_id", "ord", "s", "e", F.lit("mined").alias("src"))
    window = s.where("ord % 3 <> 2").select("video_id", "ord", "s", "e", F.lit("window").alias("src"))
    sound = s.where("ord % 4 = 0").select("video_id", "ord", "s", "e", F.lit("audio").alias("src"))
    return narrative.numbered(narrative.union_keep_first(mined, window, sound, key=["video_id", "ord"], order=["s"]).where("e > s"), "e%d", ["video_id"], ["s", "ord"]).select("video_id", "ord", "src", "id")


def _number(c):
    return F.regexp_extract(c, "[0-9]+", 0).cast("long")


@query
def event_engine(spark, d):
    """Candidates to events: two boundary rounds, dedup, grading, spans, scenes, and the todos left."""
    o = F.col("ord")
    candidates = X.spans(spark, d).select("video_id", F.concat(F.lit("c"), o.cast("string")).alias("id"), "s", "e", F.concat(F.repeat(F.concat("txt", F.lit(" at the gate ")), 3), F.repeat(F.lit("!"), (o % 9).cast("int"))).alias("txt"))
    n = _number("id")
    shifted = lambda p, k: p.select("video_id", "id", X.pick((n + k) % 5, ("verified", "refined", "split", "rejected", "odd")).alias("decision"), (F.col("s") + 0.25).alias("rs"), (F.col("e") + 0.5).alias("re"), ((F.col("s") + F.col("e")) / 2).alias("at"))
    grade = lambda e: e.where(n % 4 != 0).select("video_id", "id", F.when(n % 3 == 0, "key").otherwise("minor").alias("importance"))
    group = lambda e: e.groupBy("video_id", "cluster").agg(F.min(F.struct("ord", "id")).alias("a"), F.max(F.struct("ord", "id")).alias("z")).select("video_id", "cluster", F.col("a.id").alias("keep"), F.array("z.id", F.lit("none")).alias("merge"))
    events, todos = engine.event_engine(candidates, [lambda p: shifted(p, 0), lambda p: shifted(p, F.length("id"))], grade, X.scenes(spark, d), 700.0, group)
    rows = events.select("video_id", F.lit("event").alias("kind"), "id", "s", "e", "event_id", "importance", "boundary_state", "scene_id", F.array_join("sources", ",").alias("sources"))
    return rows.unionByName(todos, allowMissingColumns=True).withColumn("s", r6("s")).withColumn("e", r6("e"))


@query
def global_block(spark, d):
    v = X.videos(spark, d)
    e = narrative.scene_of(X.events(spark, d), X.scenes(spark, d), 60.0).withColumn("id", F.col("ord").cast("string")).where("video_id % 4 <> 0")
    seen = X.spans(spark, d).where("video_id % 4 <> 0").select("video_id", F.when(F.col("ord") % 2 == 0, F.col("txt")).otherwise(F.upper("txt")).alias("name"), "s", "e")
    people = v.where("video_id % 3 <> 0").select("video_id", F.explode(F.array(*map(F.lit, ("click", "view", "Sign-Up", "nobody")))).alias("en")).select("video_id", F.concat(F.lit("p_"), "en").alias("id"), "en", F.lit(None).cast("string").alias("zh"), F.array(F.lit("ERROR")).alias("aliases"))
    order = e.where("video_id % 2 = 0").groupBy("video_id").agg(F.reverse(F.array_sort(F.collect_list("id"))).alias("ids"))
    out = engine.global_block(v, e, X.scenes(spark, d), people, seen, order)
    who = F.transform("characters", lambda c: F.concat_ws(":", "video_id", c["id"], F.coalesce(c["alias"], F.lit("-")), F.coalesce(c["appearances"], F.lit(0)).cast("string")))
    return out.select("video_id", F.array_join(who, " ").alias("characters"), F.array_join("unmerged", ",").alias("unmerged"), F.size("causes").alias("n_causes"), F.md5(F.array_join("timeline", ",").cast("binary")).alias("timeline"), F.size("misaligned").alias("n_misaligned"))


@query
def annotated_windows(spark, d):
    """Windows from the cache, from answers, and those that fail, which are gaps."""
    w = _windows(spark, d).withColumn("prompt", F.concat_ws("|", "video_id", (F.col("s") / 180).cast("int")))
    key = providers.request_hash(F.lit("window"), F.col("prompt"))
    n = (F.col("s") / 180).cast("int") + F.col("video_id")
    cache = w.where(n % 3 == 0).select(key.alias("key_hash"), F.lit("held").alias("response"))
    answer = lambda q: q.withColumn("response", F.when(n % 5 != 1, F.concat(F.lit("said "), "prompt"))).withColumn("ok", F.col("response").isNotNull())
    done, gaps, fresh = engine.annotated_windows(w, cache, answer)
    done = done.join(fresh.select("key_hash", F.lit(True).alias("fresh")), "key_hash", "left")
    return done.select("video_id", "s", "e", "id", "response", F.coalesce("fresh", F.lit(False)).alias("fresh")).unionByName(gaps.select("video_id", "s", "e", F.col("reason").alias("response")), allowMissingColumns=True)


@query
def caption_requests(spark, d):
    """One caption in twenty seconds; how many different frames are asked for."""
    frames_ = X.points(spark, d).where("video_id % 5 <> 0").select("video_id", "t")
    asked = engine.caption_requests(X.videos(spark, d), frames_, X.spans(spark, d).where("ord % 4 = 0"), 0.05)
    return asked.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key_hash").alias("n_frames"), F.sum("frame").alias("frames")).withColumn("frames", F.round("frames", 3))


# --- audio


def _frames(spark, d) -> DataFrame:
    """Loudness frames of half a second, numbered in a video, in segments of about a minute."""
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("t", "ord")) - 1
    return X.points(spark, d).select("video_id", n.alias("frame_no"), (F.col("v") / 100).alias("rms"), (F.col("ord") % 3 == 0).alias("speech"), F.floor(F.col("t") / 60).cast("long").alias("seg"))


@query
def rms_envelope(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    samples = X.table(spark, d, "events").select(F.col("user_id").alias("video_id"), (F.row_number().over(w) - 1).alias("i"), F.col("value").alias("x"))
    return audio.envelope(samples, 10).withColumn("rms", r6("rms"))


@query
def audio_baseline(spark, d):
    return audio.baseline(_frames(spark, d)).withColumn("baseline", r6("baseline"))


@query
def audio_events(spark, d):
    f = _frames(spark, d)
    out = audio.detect(f, audio.baseline(f), ["video_id", "seg"], frame_sec=0.5)
    return out.select("video_id", "seg", "a", "b", r6("peak").alias("peak"), r6("ratio").alias("ratio"), r6("burst").alias("burst"), "type", "confidence")


@query
def audio_active_bounds(spark, d):
    f = _frames(spark, d)
    return audio.active_bounds(f, audio.baseline(f), ["video_id", "seg"])


# --- incremental and providers


def _stage_hashes(spark, d) -> DataFrame:
    o = X.table(spark, d, "orders")
    return incremental.stage_hashes(o, ["o_custkey"], F.col("o_orderkey"), incremental.content_hash(F.col("o_orderkey"), F.col("o_orderstatus")))


@query
def stage_hashes(spark, d):
    return _stage_hashes(spark, d)


@query
def stage_cascade(spark, d):
    """Hashes of all stages of a video; one video in three has no description payload."""
    v = X.videos(spark, d).select("video_id", F.explode(F.array(*(F.lit(f"S{i}") for i in range(1, 8)))).alias("stage")).where("stage <> 'S2' or video_id % 3 <> 0")
    return incremental.cascaded(v.withColumn("digest", incremental.content_hash(F.col("stage"), F.col("video_id"))))


def _states(spark, d) -> DataFrame:
    e = X.table(spark, d, "events").select(F.col("user_id").alias("video_id"), F.col("event_type").alias("stage"), X.pick(F.col("event_id") % 3, ("failed", "done", "skipped")).alias("state"), F.md5(F.col("event_id").cast("string").cast("binary")).alias("input_hash"), "event_id")
    return incremental.latest(e, ["video_id", "stage"], "event_id")


@query
def manifest_rows(spark, d):
    gaps = segments.gaps(X.videos(spark, d), X.spans(spark, d), DEFAULT.coverage_eps, DEFAULT.coverage_eps, True).withColumn("reason", F.lit("uncovered"))
    out = incremental.manifest_rows(_states(spark, d), gaps)
    return out.select("video_id", F.array_join(F.transform("stages", lambda x: F.concat_ws(":", x["stage"], x["state"], x["input_hash"])), " ").alias("stages"), F.size("gaps").alias("n_gaps"), F.get("gaps", F.lit(0))["s"].alias("first_gap"))


@query
def restored_tracks(spark, d):
    """Tracks that a new run starts from: those whose stage is done."""
    kinds = ("click", "view", "purchase")
    old = X.points(spark, d).groupBy("video_id").agg(*(F.sum(F.when(F.col("txt") == k, F.col("ord"))).alias(k) for k in kinds))
    return incremental.restored(old, _states(spark, d), {k: k for k in kinds})


@query
def stage_needs_run(spark, d):
    now = _stage_hashes(spark, d)
    old = now.where("o_custkey % 4 <> 0").select("o_custkey", F.when(F.col("o_custkey") % 4 == 1, "failed").otherwise("done").alias("state"), F.when(F.col("o_custkey") % 4 == 2, "stale").otherwise(F.col("hash")).alias("input_hash"))
    return incremental.needs_run(now, old, ["o_custkey"]).select("o_custkey")


@query
def stage_downstream(spark, d):
    changed = X.videos(spark, d).select("video_id", X.pick(F.col("video_id") % 7, ("S1", "S2", "S3", "S4", "S5", "S6", "S7")).alias("stage"))
    return incremental.downstream(spark, changed)


@query
def manifest_latest(spark, d):
    e = X.table(spark, d, "events").select(F.col("user_id").alias("video_id"), F.col("event_type").alias("stage"), F.col("event_id").alias("updated"), F.round("value", 6).alias("v"))
    return incremental.latest(e, ["video_id", "stage"], "updated")


@query
def cache_misses(spark, d):
    p = X.table(spark, d, "part").select("p_partkey", F.md5(F.concat("p_brand", "p_type").cast("binary")).alias("key_hash"))
    cache = p.where("p_partkey % 50 = 0").select("key_hash")
    return incremental.misses(p, cache).groupBy("key_hash").agg(F.count(F.lit(1)).alias("n"))


@query
def provider_recorded(spark, d):
    p = X.table(spark, d, "part").select("p_partkey", providers.request_hash(F.lit("scene"), F.col("p_name")).alias("request_hash"))
    tape = p.where("p_partkey % 3 <> 0").select("request_hash", F.concat(F.lit("answer "), F.col("p_partkey").cast("string")).alias("response"))
    return providers.recorded(p, tape.groupBy("request_hash").agg(F.min("response").alias("response"))).select("p_partkey", "response", "ok")


@query
def usage_merge(spark, d):
    e = X.table(spark, d, "events").select(F.col("event_type").alias("client"), F.create_map(F.lit("prompt"), F.col("event_id") % 100, F.lit("completion"), F.col("event_id") % 10).alias("usage"))
    return providers.usage(e)


@query
def schema_violations(spark, d):
    o = X.table(spark, d, "orders")
    rules = {"status": F.col("o_orderstatus").isin("O", "F"), "price": F.col("o_totalprice") > 1000, "priority": F.col("o_orderpriority").rlike("^[1-3]")}
    return json_io.violations(o, rules).select("o_orderkey", F.array_join("violations", ",").alias("violations"))


#: Rules of the documents that ``_documents`` makes, with three depths of nesting, references and conditions.
DOCUMENT = {
    "type": "object", "required": ["video_id", "meta", "events"],
    "properties": {
        "video_id": {"type": "string", "pattern": "^v_[0-9]{1,3}$"},
        "meta": {"type": "object", "required": ["genre", "duration"], "properties": {"genre": {"enum": list(GENRES)}, "duration": {"type": "number", "exclusiveMinimum": 0, "maximum": 7200}}},
        "events": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/Event"}},
    },
    "$defs": {
        "Event": {
            "type": "object", "required": ["id", "importance"],
            "properties": {"id": {"type": "integer", "minimum": 0}, "importance": {"enum": ["key", "minor"]}, "span": {"type": "array", "minItems": 2, "maxItems": 2, "items": {"type": "number", "minimum": 0}}},
            "if": {"properties": {"importance": {"const": "key"}}}, "then": {"required": ["span"]},
        },
    },
}


def _documents(spark, d) -> DataFrame:
    """Documents with events inside, private fields at three depths, and faults planted by numbers."""
    o, v = F.col("ord"), F.col("video_id")
    e = X.events(spark, d).where("ord % 8 < 5").select("video_id", "ord", F.when(o % 29 != 0, o).otherwise(-o).alias("id"), F.when(o % 31 != 0, F.col("importance")).otherwise("odd").alias("importance"),
        F.when(o % 6 == 0, F.lit(None)).when(o % 37 == 0, F.array(o)).otherwise(F.array(o, F.when(o % 41 == 0, -1).otherwise(o + 1))).alias("span"), o.alias("_win"), F.struct(o.alias("n"), o.alias("_n")).alias("inner"))
    a_video = e.groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct("id", "importance", "span", "_win", "inner").alias("x")))), lambda y: y["x"]).alias("events"))
    out = X.videos(spark, d).join(a_video, "video_id", "left")
    meta = F.when(v % 13 != 0, F.struct(F.when(v % 7 != 0, F.col("genre")).otherwise("noise").alias("genre"), F.when(v % 5 != 0, v).otherwise(0).alias("duration"), v.alias("_cost")))
    return out.select(F.concat(F.when(v % 11 == 0, "x_").otherwise("v_"), v.cast("string")).alias("video_id"), meta.alias("meta"), "events", v.alias("_seen"))


@query
def schema_documents(spark, d):
    """Every fault of nested documents against their schema, with its path."""
    out = schema.validated(_documents(spark, d), DOCUMENT)
    return out.select("video_id", "schema_error", F.explode("errors").alias("e")).select("video_id", "schema_error", "e.depth", "e.path", "e.message")


@query
def public_documents(spark, d):
    """Documents without private fields at any depth."""
    out = schema.public(_documents(spark, d))
    return out.select("video_id", F.array_join(F.array(*map(F.lit, out.columns)), ",").alias("fields"), F.to_json("meta").alias("meta"), F.to_json("events").alias("events"))


@query
def described_documents(spark, d):
    """Descriptions written into read documents; what they held besides stays."""
    v = F.col("video_id")
    docs = X.videos(spark, d).select(
        v, F.struct(v.alias("shots"), F.lit("kept").alias("other")).alias("structure"),
        F.when(v % 5 != 0, F.struct(F.lit("verified").alias("review_status"), F.array(F.struct(F.lit("gap").alias("kind"), v.alias("at"))).alias("human_todo"), F.struct(v.alias("calls")).alias("stats"))).alias("annotation_meta"), v.alias("extra"),
    )
    issues = F.when(v % 4 == 0, F.array(F.lit("zh missing"), F.lit("en short"))).otherwise(F.array().cast("array<string>"))
    answers = X.videos(spark, d).where("video_id % 3 <> 0").select(v, F.array(F.concat(F.lit("s"), v.cast("string"))).alias("segments"), F.concat(F.lit("whole "), v.cast("string")).alias("detailed"), F.array(F.lit("q1")).alias("quiet"), (v % 7).alias("shot_ok"), F.lit(7).alias("shot_total"), v.alias("full_len_zh"), issues.alias("lang_issues"))
    out = schema.described(docs, answers)
    m = F.col("annotation_meta")
    todo = F.array_join(F.transform(m["human_todo"], lambda t: F.concat_ws(":", t["kind"], t["at"].cast("string"))), ",")
    return out.select(
        v, "extra", F.col("structure.shots").alias("shots"), F.col("structure.other").alias("other"), F.array_join("structure.segments", ",").alias("segments"), F.col("global.detailed_description").alias("detailed"), m["review_status"].alias("status"),
        todo.alias("todo"), m["stats"]["calls"].alias("calls"), m["stats"]["shot_desc_ok"].alias("shot_desc_ok"), F.array_join(m["stats"]["quiet_segments"], ",").alias("quiet"), m["stats"]["full_len_zh"].alias("full_len_zh"),
    )


@query
def todo_union(spark, d):
    e = X.events(spark, d)
    a = e.where("boundary_state = 'unreviewed'").select(F.lit("boundary").alias("kind"), "ord", "video_id")
    b = e.where("importance = 'key' and ord % 2 = 0").select(F.when(F.col("boundary_state") == "unreviewed", "boundary").otherwise("key").alias("kind"), "ord", "video_id")
    return narrative.union_keep_first(a, b, key=["kind", "ord"], order=["video_id"])


@query
def assemble_tracks(spark, d):
    """Documents back from child tables: how many elements and their order."""
    docs = json_io.assemble(X.videos(spark, d), {"events": X.spans(spark, d).select("video_id", "ord", "s", F.lit(1).alias("_private")), "few": X.spans(spark, d).where("ord % 997 = 0").select("video_id", "ord", "e")})
    return docs.select("video_id", F.size("events").alias("n"), F.size("few").alias("n_few"), F.element_at("events", 1)["s"].alias("first"))


# --- composite steps


def _captions(spark, d):
    """Captions leave out every eighth minute, so that windows without any exist."""
    return X.points(spark, d).where("floor(t / 90) % 4 <> 1").select("video_id", "ord", "t", "txt")


@query
def event_mining(spark, d):
    drafts = workflow.mine_drafts(_captions(spark, d), X.spans(spark, d), DEFAULT.event_window_sec, DEFAULT.event_step_sec, X.DURATION, DEFAULT.caption_similarity, DEFAULT.caption_gap_sec)
    answers = drafts.where("(video_id + k) % 3 = 0").select("video_id", "k", "s", "e", F.lit("answer").alias("txt"), F.lit("model").alias("origin"))
    return workflow.with_fallback(drafts, answers, ["video_id", "k"])


@query
def group_dedup(spark, d):
    e = X.spans(spark, d).select("video_id", F.floor(F.col("s") / 10).alias("cluster"), F.concat(F.lit("e"), F.col("ord").cast("string")).alias("id"), "ord")
    g = e.groupBy("video_id", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("n >= 3")
    name = lambda c: F.concat(F.lit("e"), F.col(c).cast("string"))
    answers = g.select("video_id", "cluster", F.when(F.col("lo") % 4 == 0, "unknown").otherwise(name("lo")).alias("keep"), F.array(name("hi"), F.lit("e-1"), name("lo")).alias("merge"))
    out = workflow.renamed(workflow.apply_groups(e.drop("ord"), answers))
    return out.select("video_id", "id", "dedup_id", F.array_join("sources", ",").alias("sources"))


@query
def importance_grading(spark, d):
    e = X.events(spark, d).select("video_id", F.col("ord").cast("string").alias("id"))
    grades = X.events(spark, d).where("ord % 4 <> 0").select("video_id", F.col("ord").cast("string").alias("id"), X.pick(F.col("ord") % 3, ("key", "minor", "great")).alias("importance"))
    return workflow.graded(e, grades)


@query
def timeline_order(spark, d):
    e = X.spans(spark, d).select("video_id", "s", F.col("ord").cast("string").alias("id"))
    answers = e.where("video_id % 3 <> 0").groupBy("video_id").agg(F.reverse(F.array_sort(F.collect_list("id"))).alias("ids"))
    answers = answers.select("video_id", F.when(F.col("video_id") % 3 == 1, F.concat("ids", F.array(F.lit("x")))).otherwise(F.slice("ids", 1, 2)).alias("ids"))
    out = workflow.timeline(e, answers)
    return out.select("video_id", "answered", F.md5(F.array_join("ids", ",").cast("binary")).alias("digest"))


@query
def verification_kpis(spark, d):
    v = X.qa(spark, d).select("video_id", "task_type", (F.col("ord") % 3 != 0).alias("verified"), (F.col("ord") % 5 != 0).alias("passed"), (F.col("ord") % 2).alias("regen"), (F.col("ord") % 15 == 1).alias("dropped"), (F.col("ord") % 2 == 1).alias("leaked"))
    return workflow.verification_kpis(v, ["video_id"])


@query
def open_item_agreement(spark, d):
    a = X.qa(spark, d).where("task_type in ('open', 'summary')").withColumn("r", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    a = a.withColumn("text", F.when((F.col("ord") + F.col("r")) % 4 == 0, "").when((F.col("ord") + F.col("r")) % 4 == 1, F.col("txt")).otherwise(F.concat("txt", F.lit(" and other words"))))
    return workflow.open_items(a, F.greatest(T.rouge_l(T.tokens(F.col("text")), T.tokens(F.col("txt"))), T.similarity(F.col("text"), F.col("txt"))))


def _verified(spark, d) -> tuple[DataFrame, DataFrame]:
    """Recorded answers that lead to every outcome: leaks, near and far intervals, like and unlike texts, choices that
    agree at once, after a rewrite or never, rewrites and verdicts that fail."""
    o = F.col("ord")
    q = X.qa(spark, d).select(
        "video_id", "qid", "ord", F.when(o % 47 == 0, "essay").otherwise(F.col("task_type")).alias("task_type"), F.col("txt").alias("question"), F.array(F.lit("w"), F.lit("x"), F.lit("y"), F.lit("z")).alias("options"),
        F.when(o % 10 != 1, F.col("answer")).otherwise("D").alias("answer"), "s", "e", F.when(o % 9 != 0, F.col("txt")).otherwise(" ").alias("reference"), (o % 8 != 3).alias("has_frames"), (o % 3 == 0).alias("has_synopsis"),
    )
    letter = lambda n: X.pick(n % 5, "ABCDE")
    leak = lambda r: r.where("ord % 2 = 0").select("qid", X.pick((o * 7) % 4, "ABCD").alias("answer"))
    shift = (o % 6) / 2.0
    locate = lambda r: r.where("ord % 7 <> 0").select("qid", (F.col("s") + shift).alias("a"), (F.col("e") + shift).alias("b"), (F.col("s") - 1).alias("lo"), (F.col("e") + 1).alias("hi"), F.lit(0.5).alias("confidence"))
    free = lambda r: r.where("ord % 5 <> 0").select("qid", F.when(o % 4 != 0, "words").otherwise(" ").alias("text"), ((o % 10) / 10.0).alias("similarity"), F.lit(None).cast("double").alias("confidence"))
    a = F.col("attempt")
    choose = lambda r: r.where((o + a) % 11 != 0).select("qid", letter(F.floor(o / 2) + a * 3).alias("answer"), ((o % 10) / 10.0 + a).alias("confidence"))
    rewrite = lambda r: r.where((o + a) % 13 != 0).select("qid", F.when(o % 2 == 0, F.concat("question", F.lit("!"))).alias("question"), F.array(F.lit("n"), a.cast("string")).alias("options"), letter(F.floor(o / 2) + a * (1 + 2 * (o % 2))).alias("answer"))
    return verify.verified(q, leak, locate, free, choose, rewrite)


@query
def verification_loop(spark, d):
    """What the checks of each type and at most two rewrites decide on every question."""
    out, _ = _verified(spark, d)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in ("agreed", "reason", "flag")]
    return out.select("qid", "outcome", *text, F.when(F.col("task_type") == "mcq", F.col("verifier")).alias("verifier"), F.round("score", 3).alias("score"), "confidence", "question", F.array_join("options", ",").alias("options"), "answer", "regen")


@query
def verification_counts(spark, d):
    return _verified(spark, d)[1]


@query
def pipeline_temporal_ratio(spark, d):
    q = X.qa(spark, d).where("task_type = 'temporal_grounding'").withColumn("miou", F.when(F.col("ord") % 3 != 0, (F.col("ord") % 10) / 10.0))
    return agreement.pipeline_ratio(q)


@query
def rescreen_summary(spark, d):
    return questions.drop_summary(questions.with_drop(_qa(spark, d)))


@query
def evidence_frame_times(spark, d):
    w = Window.partitionBy("video_id").orderBy("s", "ord")
    two = X.spans(spark, d).withColumn("s2", F.lead("s").over(w)).withColumn("e2", F.lead("e").over(w))
    one = F.struct("s", "e")
    spans = F.when(F.col("s2").isNull(), F.array(one)).otherwise(F.array(one, F.struct(F.col("s2").alias("s"), F.col("e2").alias("e"))))
    return two.select("ord", F.size(workflow.evidence_times(spans, 4)).alias("n"), r6(F.element_at(workflow.evidence_times(spans, 4), 1)).alias("first"))


@query
def mosaic_sizes(spark, d):
    a = X.points(spark, d).groupBy("video_id", F.floor(F.col("t") / 40).alias("w")).agg(F.array_sort(F.collect_list("ord")).alias("f"))
    tile = workflow.mosaic(F.col("f"))
    return a.select("video_id", "w", F.size(tile).alias("n"), F.element_at(tile, -1).alias("last")).where("last is not null")


@query
def language_alignment(spark, d):
    p = X.points(spark, d)
    zh = F.when(F.col("ord") % 5 == 0, F.lit(None)).otherwise(F.repeat(F.lit("字"), (F.col("ord") % 9).cast("int")))
    return p.select("ord", F.array_join(workflow.language_issues(zh, F.when(F.col("ord") % 7 == 0, "  ").otherwise(F.lit("two words"))), ",").alias("issues"))


@query
def description_rollup(spark, d):
    out = workflow.two_level(X.spans(spark, d), 15)
    return out.select("video_id", "n", "n_groups", F.md5(F.col("txt").cast("binary")).alias("digest"))


@query
def subtitle_rendering(spark, d):
    speaker = F.when(F.col("ord") % 3 == 0, F.concat(F.lit("S"), (F.col("ord") % 4).cast("string")))
    return X.spans(spark, d).select("ord", workflow.rendered(F.floor(F.col("s")), speaker, F.col("txt")).alias("line"))


@query
def provider_differs(spark, d):
    c = X.table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "auto:alpha-1 auto:beta").when(F.col("c_custkey") % 3 == 1, "human").alias("annotator"))
    return workflow.other_provider(c, "beta").select("c_custkey")


@query
def duration_guard(spark, d):
    o = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("video_id"), F.col("o_totalprice").alias("duration_sec"))
    return workflow.duration_conflicts(o, o.select("video_id", (F.col("duration_sec") + F.col("video_id") % 11 - 3).alias("measured"))).select("video_id")


@query
def video_file_lookup(spark, d):
    p = X.table(spark, d, "part").select(F.concat(F.lit("/v/"), (F.col("p_partkey") % 97).cast("string"), X.pick(F.col("p_partkey") % 4, (".mkv", ".mp4", ".txt", ".webm"))).alias("path")).distinct()
    return workflow.first_file(json_io.listing(p, ("mp4", "mkv", "webm")))


@query
def qa_deficits(spark, d):
    return workflow.deficits(questions.coverage(_qa(spark, d), X.DURATION), F.lit(150))


@query
def stage_reuse(spark, d):
    e = X.table(spark, d, "events").select(F.col("user_id").alias("video_id"), F.col("event_type").alias("stage"), F.when(F.col("event_id") % 3 == 0, "failed").when(F.col("event_id") % 3 == 1, "done").otherwise("skipped").alias("state"), "event_id")
    last = incremental.latest(e, ["video_id", "stage"], "event_id")
    return workflow.reusable(last, X.videos(spark, d).where("video_id % 2 = 0"), 5)


@query
def question_round(spark, d):
    q = X.spans(spark, d).select("video_id", "ord", F.concat(F.col("txt"), (F.col("ord") % 20).cast("string")).alias("key"))
    return workflow.next_questions(q.where("ord % 3 <> 0"), q.where("ord % 3 = 0").select("video_id", "key").distinct(), "key", 60)


@query
def shortcut_channels(spark, d):
    """Recorded answers of every channel, judged by kind: the letter, the interval, the likeness."""
    q = X.qa(spark, d)
    asked = questions.channel_requests(q).join(q.select("qid", "ord", "s", "e", "answer"), "qid")
    place = F.array_position(F.array(*map(F.lit, questions.CHANNELS)), F.col("channel"))
    tape = asked.where("ord % 10 <> 0").select("request_hash", F.concat_ws("|", X.pick((F.col("ord") * place) % 4, "ABCD"), ((F.col("ord") % 8) / 8.0).cast("string")).alias("response"))
    answered = providers.recorded(asked, tape)
    letter, shift = F.split("response", "\\|")[0], F.split("response", "\\|")[1].cast("double")
    near = I.iou(F.col("s"), F.col("e"), F.col("s") + shift, F.col("e") + shift) >= 0.6
    hit = F.when(F.col("ok"), F.when(F.col("task_type") == "mcq", letter == F.col("answer")).when(F.col("task_type") == "temporal_grounding", near).otherwise(shift >= 0.85))
    flags = questions.channel_verdicts(answered, hit)
    return flags.select("qid", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in questions.CHANNELS))


@query
def call_trace(spark, d):
    c = X.table(spark, d, "conversations").select(F.col("role").alias("model"), "text", F.array_repeat(F.lit("i"), (F.col("turn") % 4).cast("int")).alias("images"), (F.col("turn") % 3).alias("retries"), (F.col("turn") % 5 != 0).alias("ok"), F.lit(1).alias("usage"), F.col("text").alias("response"), "conv_id", "turn")
    return providers.trace(c).drop("usage")


# --- small filters and renderers


@query
def ocr_confidence_filter(spark, d):
    p = X.points(spark, d).select("ord", (F.col("ord") % 11 / 10.0).alias("conf"), F.when(F.col("ord") % 7 == 0, "  ").otherwise(F.col("txt")).alias("text"))
    return workflow.legible(p).select("ord")


@query
def modality_whitelist(spark, d):
    found = F.when(F.col("ord") % 4 == 0, F.array(F.lit("smell"))).when(F.col("ord") % 4 == 1, F.array(F.lit("audio"), F.lit("smell"))).when(F.col("ord") % 4 == 2, F.array(F.lit("speech"), F.lit("visual")))
    return X.points(spark, d).select("ord", F.array_join(T.modalities(found, MODALITIES), ",").alias("modality"))


@query
def language_coalesce(spark, d):
    zh = F.when(F.col("ord") % 3 == 0, "").when(F.col("ord") % 3 == 1, "字")
    return X.points(spark, d).select("ord", T.first_text(zh, F.col("txt")).alias("text"), T.description({"desc": zh, "detailed_description": F.lit("long")}).alias("description"))


@query
def event_briefs(spark, d):
    return workflow.briefs(X.events(spark, d), ("ord", "importance", "boundary_state"))


@query
def window_limit(spark, d):
    w = segments.fixed_windows(X.videos(spark, d), DEFAULT.window_sec)
    return narrative.batched(w, 3, ["video_id"], ["s"]).where("batch = 0").select("video_id", "s", "e")


@query
def coverage_report(spark, d):
    w = X.spans(spark, d).select("video_id", "s", "e", (F.col("ord") % 6 != 0).alias("ok"))
    return workflow.coverage_report(X.videos(spark, d), w).select("video_id", r6("s").alias("s"), r6("e").alias("e"), "reason")


@query
def anchor_pool(spark, d):
    e = X.events(spark, d)
    name = lambda c: F.concat(F.lit(c), F.col("ord").cast("string")).alias("id")
    tracks = e.where("ord % 2 = 0").select("video_id", name("e"), "s", "e", "importance"), e.where("ord % 3 = 0").select("video_id", name("s"), "s", "e"), e.where("ord % 5 = 0").select("video_id", name("a"), "s", "e")
    return workflow.anchor_pool(*tracks).select("video_id", "id", "place")


@query
def span_in_view(spark, d):
    v = I.in_view(F.col("s"), F.col("e"), F.floor(F.col("s") / 60) * 60.0 + 5, F.floor(F.col("s") / 60) * 60.0 + 55)
    return X.spans(spark, d).select("ord", r6(v["s"]).alias("s"), r6(v["e"]).alias("e")).where("s is not null")


@query
def options_rendering(spark, d):
    return X.points(spark, d).select("ord", T.options_text(F.array("txt", F.lit("cat"), F.lit("dog"))).alias("text"))


# --- rounds and trees of requests


def _generation(spark, d) -> tuple[DataFrame, DataFrame]:
    """Recorded answers to every round: repeated questions, rows without an anchor, faults that a first or second rewrite
    mends or none, rewrites that aren't given, and videos whose answer is empty."""
    i, v, o = F.col("i"), F.col("video_id"), F.col("ord")
    anchors = X.events(spark, d).select("video_id", F.concat(F.lit("e"), o.cast("string")).alias("anchor_id"), "ord", "s", F.round(F.col("e") + 6, 3).alias("e"), "importance")
    videos = X.videos(spark, d).select("video_id", "duration", (v % 30 + 10).alias("quota"))
    broken, long = (i % 5 < 3) & (i % 4 == 3), F.concat(F.repeat(F.lit("word "), 220), F.lit("00:10 00:20"))

    def ask(requests: DataFrame) -> DataFrame:
        rows = requests.where("not (video_id % 7 = 6 and round = 2)").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("need") + 1)))
        at = F.try_element_at("pool", ((i * 7 + F.col("round") * 3) % F.size("pool") + 1).cast("int"))
        kind = F.when(i % 5 < 3, "mcq").when(i % 5 == 3, "temporal_grounding").otherwise("open")
        span = F.array(at["s"], at["e"])
        options = F.when(broken, F.array(F.lit("aa"), F.lit("bb"))).otherwise(F.array(F.lit("aa"), F.lit("bb"), F.lit("cc"), F.lit("dd")))
        return rows.select(
            "video_id", i.alias("place"), F.when(i % 6 != 5, at["anchor_id"]).alias("anchor_id"), kind.alias("task_type"), F.lit(None).cast("string").alias("question_zh"),
            F.concat(F.lit("who enters the room at 12:30 and then leaves it with "), at["anchor_id"]).alias("question_en"), F.array(span).alias("evidence"), span.alias("target"), options.alias("options"),
            X.pick(i % 4, "ABCD").alias("answer"), F.lit("").alias("ref_zh"), long.alias("ref_en"), F.array(X.pick((i + F.col("round")) % 24, CAPABILITIES)).alias("capability"), X.pick(i % 3, ("single_scene", "cross_scene", "whole_video")).alias("min_watch"),
        )

    def rewrite(bad: DataFrame) -> DataFrame:
        rows = bad.where((F.col("place") + F.col("attempt")) % 3 != 0)
        mended = (F.col("attempt") == 2) | (F.col("place") % 8 == 3)
        options = F.when(mended, F.array(F.lit("aa"), F.lit("bb"), F.lit("cc"), F.lit("dd"))).otherwise(F.col("options"))
        named = F.when(F.col("place") % 2 == 0, F.col("anchor_id")).otherwise("")
        return rows.withColumn("options", options).withColumn("question_en", F.concat("question_en", F.lit(" again"))).withColumn("anchor_id", named)

    return generate.generated(videos, anchors, ask, rewrite, limits=Thresholds(anchor_cap=30))


@query
def question_generation(spark, d):
    """Every question that rounds of generation accept."""
    return _generation(spark, d)[0].select("video_id", "qid", "round", "anchor_id", "task_type", "key")


@query
def generation_report(spark, d):
    """The matrix that the rounds reach, and what became of the answers."""
    return _generation(spark, d)[1]


def _described(spark, d) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Recorded answers with failures at each level: no answer, no text, short or poor texts, sides that can't be filled,
    texts that come back unlike, groups and wholes without an answer."""
    v, o, level = F.col("video_id"), F.col("ord"), F.col("level")
    k = v + o
    full = F.when(level == "shot", F.repeat(F.lit("字"), 80)).when(level == "segment", F.concat(F.repeat(F.lit("镜"), 400), F.lit("00:10 00:20"))).otherwise(F.repeat(F.lit("全"), 10))

    def describe(rows: DataFrame) -> DataFrame:
        shot, m = level == "shot", F.when(level == "shot", (k + F.col("attempt")) % 4).otherwise((k + F.col("attempt")) % 5)
        zh = F.when(shot, F.when(m == 1, full).when(m == 3, "short")).otherwise(F.when(m < 3, full).when(m == 3, F.repeat(F.lit("镜"), 400)).otherwise(" "))
        words = F.concat(F.repeat(F.lit("word "), 350), F.when(m == 2, F.concat(F.lit("00:10 00:20 n"), F.size("parts").cast("string"))).otherwise(""))
        en = F.when(shot, F.when(m == 2, F.repeat(F.lit("word "), 60))).otherwise(F.when(m.isin(2, 3), words))
        return rows.where(m != 0).select("video_id", "level", "ord", zh.alias("zh"), en.alias("en"), F.when(k % 7 == 3, 2).otherwise(6).alias("elements"))

    translate = lambda r: r.where(k % 3 != 0).select("video_id", "level", "ord", F.when(k % 11 == 1, " ").when(F.col("to") == "zh", full).otherwise(F.repeat(F.lit("word "), F.when(k % 5 == 0, 10).otherwise(300))).alias("text"))
    back = lambda r: r.where(k % 4 != 0).select("video_id", "level", "ord", F.when(k % 4 == 1, "xyz").otherwise(full).alias("text"))

    def combine(rows: DataFrame) -> DataFrame:
        whole, n = level == "whole", F.size("parts")
        starts = F.concat(F.lit("whole "), F.array_join(F.transform("parts", lambda p: p["s"].cast("int").cast("string")), "|"))
        return rows.where(F.when(whole, v % 10 != 7).otherwise(k % 6 != 0)).select(
            "video_id", "level", "ord", F.when(whole, F.repeat(F.lit("全"), n * 200)).otherwise("组").alias("zh"), F.when(~whole | (v % 3 != 0), starts).alias("en")
        )

    windows = segments.fixed_windows(X.videos(spark, d), 20.0).where("video_id % 4 <> 1 or s < 240")
    shots = X.shots(spark, d).select("*", F.when(v % 5 == 0, "已有描述").alias("zh"), F.lit(None).cast("string").alias("en"))
    return describe_tree.described(X.videos(spark, d), shots, windows, describe, translate, combine, back)


@query
def dense_description(spark, d):
    """The whole description of each video with its counts and issues."""
    out = _described(spark, d)[3]
    return out.select("video_id", "full_len_zh", F.md5(F.coalesce("en", F.lit("-")).cast("binary")).alias("en"), F.array_join("issues", ",").alias("issues"), "shot_ok", "shot_total", "segment_ok", "segment_total", "n_quiet")


@query
def quiet_requests(spark, d):
    """What no attempt could describe, at every level."""
    return _described(spark, d)[2].select("video_id", "level", "ord", r6("s").alias("s"), r6("e").alias("e"), "reason")


@query
def manifest_log(spark, d):
    """What the logged states, todos, gaps and statistics of each video amount to."""
    o = F.col("ord")
    kind = F.when(o % 8 < 4, "stage").when(o % 8 == 4, "todo").when(o % 8 == 5, "gap").when(o % 8 == 6, "stats").when(o % 24 == 7, "clear_gaps").otherwise("frames")
    log = X.spans(spark, d).select(
        "video_id", (o * 7919 % 1000003).alias("at"), kind.alias("kind"), F.concat(F.lit("S"), (F.floor(o / 8) % 7 + 1).cast("string")).alias("stage"), X.pick(o % 3, ("done", "failed", "skipped")).alias("state"),
        F.concat(F.lit("h"), (o % 2).cast("string")).alias("input_hash"), F.lit(None).cast("string").alias("output"), F.lit(None).cast("string").alias("error"), F.col("txt").alias("name"), o.cast("string").alias("value"), "s", "e",
    )
    out = incremental.manifest(log.unionByName(log.where("at % 5 = 0")))
    shown = lambda c, *f: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *(x[n].cast("string") for n in f))), " ").alias(c)
    return out.select("video_id", shown("stages", "stage", "state", "input_hash", "at"), shown("todos", "created", "name", "value"), shown("gaps", "reason"), shown("stats", "name", "value"), "frames")
