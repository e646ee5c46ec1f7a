"""Verification of questions by a second model, as a state machine over a table of questions.

A question leaves the machine as soon as it is decided. What is open after a round is written as a step, and a round asks
only for that: first the leak check, then the check of its type, then at most so many rewrites of a choice question with
a new check after each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULT, Thresholds
from tidemark.functions import intervals as I
from tidemark.steps import Steps

Answer = Callable[[DataFrame], DataFrame]
LETTERS = ("A", "B", "C", "D")
OUT = ("video_id", "qid", "ord", "task_type", "question", "options", "answer", "outcome", "agreed", "reason", "flag", "verifier", "score", "confidence", "regen")


def _letter(c: Column) -> Column:
    """A valid choice, or null."""
    return F.when(c.isin(*LETTERS), c)


def _decided(rows: DataFrame, outcome: Column | str, agreed: Column | None = None, reason: Column | str | None = None, flag: Column | None = None, verifier: Column | None = None, score: Column | None = None, confidence: Column | None = None) -> DataFrame:
    """``rows`` with what was decided on them; what isn't given is null."""
    text = lambda c: F.lit(c) if isinstance(c, str) or c is None else c
    found = {
        "outcome": text(outcome).cast("string"), "agreed": text(agreed).cast("boolean"), "reason": text(reason).cast("string"), "flag": text(flag).cast("string"), "verifier": text(verifier).cast("string"),
        "score": text(score).cast("double"), "confidence": text(confidence).cast("double"),
    }
    return rows.select(*(found[c].alias(c) if c in found else F.col(c) for c in OUT))


def verified(
    questions: DataFrame, leak: Answer | None, locate: Answer | None, free: Answer | None, choose: Answer | None, rewrite: Answer | None, rounds: int = 2, drop_mismatch: bool = True, limits: Thresholds = DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(questions with their outcome, one row a video of counts).

    ``questions``: video_id, qid, ord, task_type, question, options, answer, s, e (the target), reference, has_frames,
    has_synopsis. Each callable asks for the rows that it is given and returns answers by qid; a missing row, or one that
    isn't valid, is no answer, and a callable that is None is a check that isn't available:
    ``leak`` (answer) sees question and synopsis: a choice question that it answers rightly is dropped. ``locate`` (a, b,
    lo, hi, confidence): the interval inside the view lo to hi. ``free`` (text, similarity, confidence). ``choose``
    (answer, confidence), asked with ``attempt`` 0 and after each rewrite. ``rewrite`` (question, options, answer),
    asked with ``attempt`` 1 and on and with the verifier's answer: it replaces what it gives, if its answer is a letter;
    otherwise the attempt is lost.

    outcome is kept or dropped; agreed is null where nothing could be verified, with the reason. Intervals under the
    least IoU and free answers under the least similarity are kept with a flag; a choice question that no rewrite
    reconciles has the flag ``verify_mismatch`` and is dropped, unless told otherwise. A repeated qid in an answer counts
    once. Questions of unknown type are kept unverified.
    """
    step = Steps(questions.sparkSession, "verify")
    asked = questions.withColumn("regen", F.lit(0))
    answers = lambda ask, rows, *names: ask(rows).dropDuplicates(["qid"]).select("qid", *(F.col(c).alias(f"__{c}") for c in names))
    mcq = F.col("task_type") == "mcq"
    done = []
    if leak is not None:
        tried = asked.where(mcq & F.col("has_synopsis"))
        known = answers(leak, tried, "answer")
        asked = step(asked.join(known, "qid", "left").withColumn("leaks", F.coalesce(mcq & F.col("has_synopsis") & (F.col("__answer") == F.col("answer")), F.lit(False))).drop("__answer"))
        done.append(_decided(asked.where("leaks"), "dropped", flag=F.lit("synopsis_leak")))
        asked = asked.where("not leaks")

    timed = asked.where("task_type = 'temporal_grounding'")
    if locate is None:
        done.append(_decided(timed, "kept", reason="not verified"))
    else:
        seen = timed.where("has_frames and e > s")
        found = step(timed.join(answers(locate, seen, "a", "b", "lo", "hi", "confidence"), "qid", "left"))
        inside = lambda c: F.least(F.greatest(F.col(c), F.col("__lo")), F.col("__hi"))
        valid = F.coalesce(F.col("has_frames") & (F.col("e") > F.col("s")) & (F.col("__b") > F.col("__a")) & (inside("__b") > inside("__a")), F.lit(False))
        score = F.round(I.iou(inside("__a"), inside("__b"), F.col("s"), F.col("e")), 3)
        agreed = F.when(valid, score >= limits.iou)
        why = F.when(~F.col("has_frames"), "not verified").when(~valid, "no valid answer")
        done.append(_decided(found, "kept", agreed, why, F.when(~agreed, "temporal_miou_low"), F.when(valid, F.concat_ws("-", F.round(inside("__a"), 3), F.round(inside("__b"), 3))), F.when(valid, score), F.when(valid, F.coalesce("__confidence", F.lit(0.0)))))

    told = asked.where("task_type in ('open', 'summary')")
    if free is None:
        done.append(_decided(told, "kept", reason="not verified"))
    else:
        usable = F.coalesce(F.trim("reference") != "", F.lit(False))
        found = step(told.join(answers(free, told.where(usable), "text", "similarity", "confidence"), "qid", "left"))
        valid = usable & F.coalesce(F.trim("__text") != "", F.lit(False)) & F.col("__similarity").isNotNull()
        score = F.round("__similarity", 3)
        agreed = F.when(valid, score >= limits.open_similarity)
        done.append(_decided(found, "kept", agreed, F.when(~valid, "no valid answer"), F.when(~agreed, "open_verify_low_agreement"), F.when(valid, F.left("__text", F.lit(400))), F.when(valid, score), F.when(valid, F.coalesce("__confidence", F.lit(0.0)))))

    done.append(_decided(asked.where("not coalesce(task_type in ('mcq', 'temporal_grounding', 'open', 'summary'), false)"), "kept"))
    choices = asked.where(mcq)
    if choose is None:
        done.append(_decided(choices, "kept", reason="not verified"))
    else:
        done.append(_decided(choices.where("not has_frames"), "kept", reason="no frames"))
        choices = choices.where("has_frames").withColumn("attempt", F.lit(0))
        first = step(choices.join(answers(choose, choices, "answer", "confidence"), "qid", "left").withColumn("verdict", _letter(F.col("__answer"))))
        sure = F.coalesce("__confidence", F.lit(0.0))
        done.append(_decided(first.where("verdict is null"), "kept", reason="verifier failed"))
        done.append(_decided(first.where("verdict = answer"), "kept", F.lit(True), verifier=F.col("verdict"), confidence=sure))
        open_ = first.where("verdict is not null and not verdict <=> answer").withColumn("sure", sure).drop("__answer", "__confidence")
        for attempt in range(1, rounds + 1 if rewrite is not None else 1):
            now = open_.withColumn("attempt", F.lit(attempt))
            again = now.join(answers(rewrite, now, "question", "options", "answer"), "qid", "left")
            good = F.coalesce(F.col("__answer").isin(*LETTERS), F.lit(False))
            again = step(again.select(
                *(c for c in now.columns if c not in ("question", "options", "answer", "regen")), *(F.when(good, F.coalesce(f"__{c}", c)).otherwise(F.col(c)).alias(c) for c in ("question", "options", "answer")),
                (F.col("regen") + good.cast("int")).alias("regen"), good.alias("fresh"),
            ))
            judged = again.join(answers(choose, again.where("fresh"), "answer", "confidence"), "qid", "left").withColumn("next", F.when(F.col("fresh"), _letter(F.col("__answer"))))
            judged = step(judged.withColumn("sure", F.when(F.col("next").isNotNull(), sure).otherwise(F.col("sure"))).withColumn("verdict", F.coalesce("next", "verdict")).drop("__answer", "__confidence"))
            agrees = F.coalesce(F.col("next") == F.col("answer"), F.lit(False))
            done.append(_decided(judged.where(agrees), "kept", F.lit(True), verifier=F.col("verdict"), confidence=F.col("sure")))
            open_ = judged.where(~agrees).drop("next", "fresh")
        done.append(_decided(open_, "dropped" if drop_mismatch else "kept", F.lit(False), flag=F.lit("verify_mismatch"), verifier=F.col("verdict"), confidence=F.col("sure")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = step(out)
    return out, counted(out)


def counted(out: DataFrame) -> DataFrame:
    """Per video how many questions were verified, agreed on, rewritten, dropped as leaks, and left with a mismatch."""
    tried, mcq = F.col("agreed").isNotNull(), F.col("task_type") == "mcq"
    timed, told = F.col("task_type") == "temporal_grounding", F.col("task_type").isin("open", "summary")
    yes = F.coalesce("agreed", F.lit(False))
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return out.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n"), n(F.col("outcome") == "kept").alias("kept"), n(mcq & tried).alias("verified"), n(mcq & yes).alias("agreed"), F.sum("regen").alias("regen"), n(F.col("flag") == "synopsis_leak").alias("leaks"),
        n(F.col("flag") == "verify_mismatch").alias("mismatch"), n(timed & tried).alias("temporal_verified"), n(timed & yes).alias("temporal_pass"), n(told & tried).alias("open_verified"), n(told & yes).alias("open_pass"),
    )
