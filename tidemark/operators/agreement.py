"""Inter-rater statistics. A metric that can't be evaluated is null, never NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import DEFAULT, Thresholds
from tidemark.functions import intervals as I
from tidemark.functions import text as T
from tidemark.steps import Steps


def _counts(ratings: DataFrame) -> DataFrame:
    """(unit, value, c, m) of units with two ratings or more."""
    c = ratings.where("value is not null").groupBy("unit", "value").agg(F.count(F.lit(1)).alias("c"))
    return c.withColumn("m", F.sum("c").over(Window.partitionBy("unit"))).where("m >= 2")


def alpha_nominal(ratings: DataFrame) -> DataFrame:
    """Krippendorff's alpha of (unit, value) rows: one row, null with fewer than two values or no pairs."""
    counts = _counts(ratings)
    units = counts.groupBy("unit").agg(F.sum(F.col("c") * (F.col("c") - 1) / (F.col("m") - 1)).alias("agree"), F.first("m").alias("m"))
    n = units.agg(F.sum("m").alias("n"), F.sum("agree").alias("agree"))
    values = counts.groupBy("value").agg(F.sum("c").alias("nv")).agg(F.sum(F.col("nv") * F.col("nv")).alias("squares"))
    kinds = ratings.where("value is not null").agg(F.countDistinct("value").alias("kinds"))
    return n.join(values).join(kinds).select(_alpha(F.col("n") - F.col("agree"), F.col("n") * F.col("n") - F.col("squares"), F.col("n"), F.col("kinds")).alias("alpha"))  # rows of one each


def _alpha(observed, expected, n, kinds):
    value = F.when(expected == 0, 1.0).otherwise(1 - (n - 1) * observed / F.when(expected != 0, expected))
    return F.when((kinds >= 2) & (n > 0), value)


def alpha_ordinal(ratings: DataFrame) -> DataFrame:
    """Alpha with squared rank distances of ordered values, one row; null as for ``alpha_nominal``.

    The distance of two values is that of their mid-ranks among all ratings that count, so a sum of squared distances is
    twice n * sum(r * r) - sum(r) ** 2: neither values nor ratings are paired, and a continuous scale costs a sort. Ranks
    come from a range partitioning of the values and the totals of its parts, a number a part on the driver.
    """
    step = Steps(ratings.sparkSession, "ordinal")
    counts = step(_counts(ratings))
    spread = counts.groupBy("value").agg(F.sum("c").alias("nv")).repartitionByRange("value")
    values = step(spread.withColumn("part", F.spark_partition_id()))
    before, n = {}, 0
    for r in values.groupBy("part").agg(F.sum("nv").alias("n")).orderBy("part").collect():
        before[r["part"]], n = n, n + r["n"]
    if not n:
        return ratings.sparkSession.createDataFrame([(None,)], "alpha double")
    offset = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))[F.col("part")]
    upto = F.sum("nv").over(Window.partitionBy("part").orderBy("value")) + offset
    ranks = values.select("value", "nv", (upto - F.col("nv") / 2 - n / 2).alias("r"))  # about the middle, for small sums
    expected = ranks.agg((2 * (n * F.sum(F.col("nv") * F.col("r") * F.col("r")) - F.pow(F.sum(F.col("nv") * F.col("r")), 2))).alias("expected"))
    c, r = F.col("c"), F.col("r")
    unit = (F.first("m") * F.sum(c * r * r) - F.pow(F.sum(c * r), 2)) * 2 / (F.first("m") - 1)
    observed = counts.join(ranks.select("value", "r"), "value").groupBy("unit").agg(unit.alias("d")).agg(F.sum("d").alias("observed"))
    kinds = ratings.where("value is not null").agg(F.countDistinct("value").alias("kinds"))
    return observed.join(expected).join(kinds).select(_alpha(F.col("observed"), F.col("expected"), F.lit(n), F.col("kinds")).alias("alpha"))  # rows of one each


def cohen_kappa(pairs: DataFrame) -> DataFrame:
    """Kappa of (a, b) rows without nulls: one row, null without rows, 1 where chance agreement is total."""
    cells = pairs.where("a is not null and b is not null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    n = cells.agg(F.sum("c").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("c")).otherwise(0)).alias("same"))
    rows = cells.groupBy(F.col("a").alias("v")).agg(F.sum("c").alias("ra"))
    cols = cells.groupBy(F.col("b").alias("v")).agg(F.sum("c").alias("rb"))
    chance = rows.join(cols, "v").agg(F.sum(F.col("ra") * F.col("rb")).alias("both"))
    po, pe = F.col("same") / F.col("n"), F.coalesce("both", F.lit(0)) / (F.col("n") * F.col("n"))
    return n.join(chance).select(F.when(F.col("n") > 0, F.when(pe == 1, 1.0).otherwise((po - pe) / F.when(pe != 1, 1 - pe))).alias("kappa"))


def gold_accuracy(responses: DataFrame, least: float = 0.9) -> DataFrame:
    """Of (annotator, response, answer, is_gold): accuracy on gold items; a missing response is wrong."""
    gold = responses.where("is_gold and annotator <> ''")
    right = F.coalesce(F.col("response") == F.col("answer"), F.lit(False)).cast("int")
    out = gold.groupBy("annotator").agg(F.count(F.lit(1)).alias("total"), F.sum(right).alias("correct"))
    accuracy = F.col("correct") / F.col("total")
    return out.select("annotator", "total", "correct", accuracy.alias("accuracy"), (accuracy < least).alias("flagged"))


def rework(responses: DataFrame, gold: bool = False) -> DataFrame:
    """Questions on which a response (qid, annotator, response, answer, is_gold) differs from the answer key, least
    agreement first.

    Rows without a response or without a key don't count. Gold questions, which measure raters, count only with
    ``gold``: the whole key, where the statistics of a batch take the rest of it. ``answers`` are the responses by
    annotator.
    """
    told = responses.where("response is not null and answer is not null")
    told = told if gold else told.where("not coalesce(is_gold, false)")
    answers = F.transform(F.array_sort(F.collect_list(F.struct("annotator", "response"))), lambda x: x["response"])
    out = told.groupBy("qid", "answer").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("response") == F.col("answer")).cast("double")).alias("agreement"), answers.alias("answers"))
    return out.where("agreement < 1").orderBy("agreement", "qid")


def keys(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(qid, answer) of the multiple-choice questions that have one, and of the gold ones among them."""
    known = questions.where("task_type = 'mcq' and answer <> ''")
    return known.select("qid", "answer"), known.where("is_gold").select("qid", "answer")


def pipeline_ratio(verified: DataFrame, least: float = 0.5) -> DataFrame:
    """Per video, of the verified temporal questions (video_id, miou) the share with ``least`` or more; null without any."""
    passes = F.when(F.col("miou").isNotNull(), (F.col("miou") >= least).cast("double"))
    return verified.groupBy("video_id").agg(F.round(F.avg(passes), 3).alias("ratio"))


def _levels(rows: DataFrame, *measures: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """``measures`` of each video and, with a null video_id and ``batch``, of all videos, from one pass over the rows."""
    return rows.groupingSets([["video_id", *by], [*by]], "video_id", *by).agg(F.grouping("video_id").cast("boolean").alias("batch"), *measures)


def alpha_levels(ratings: DataFrame) -> DataFrame:
    """(video_id, batch, n_items, alpha): nominal alpha of (video_id, unit, value) rows for each video and for the batch.

    Only units with two values or more count, also for how many values there are; with fewer than two alpha is null. A
    video without such units has no row. Coincidences of all videos are counted at once.
    """
    c = ratings.where("value is not null").groupBy("video_id", "unit", "value").agg(F.count(F.lit(1)).alias("c"))
    c = c.withColumn("m", F.sum("c").over(Window.partitionBy("video_id", "unit"))).where("m >= 2")
    units = c.groupBy("video_id", "unit").agg(F.sum(F.col("c") * (F.col("c") - 1) / (F.col("m") - 1)).alias("agree"), F.first("m").alias("m"))
    n = _levels(units, F.count(F.lit(1)).alias("n_items"), F.sum("m").alias("n"), F.sum("agree").alias("agree"))
    values = _levels(c, F.sum("c").alias("nv"), by=("value",)).groupBy("video_id", "batch").agg(F.sum(F.col("nv") * F.col("nv")).alias("squares"), F.count(F.lit(1)).alias("kinds"))
    alpha = _alpha(F.col("n") - F.col("agree"), F.col("n") * F.col("n") - F.col("squares"), F.col("n"), F.col("kinds")).alias("alpha")
    return n.join(values.withColumnRenamed("batch", "__b").withColumnRenamed("video_id", "__v"), F.col("__b").eqNullSafe(n["batch"]) & F.col("__v").eqNullSafe(n["video_id"])).select("video_id", "batch", "n_items", alpha)


def interval_levels(responses: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    """(video_id, batch, n, ratio, ok): the share of temporal questions whose mean IoU over raters suffices."""
    ratio = F.round(F.avg(F.col("passes").cast("double")), 3)
    return _levels(interval_items(responses, limits.iou), F.count(F.lit(1)).alias("n"), ratio.alias("ratio")).withColumn("ok", F.col("ratio") >= limits.iou_share)


def open_items(answers: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    """(video_id, qid, n_raters, agreement, passes) of free answers (video_id, qid, text, reference).

    An answer agrees where its ROUGE-L with the reference, or ``similarity`` where there is such a column, suffices;
    a question passes where enough of its answers agree. Empty answers and questions without a reference don't count.
    """
    given = answers.where("text <> '' and reference <> ''")
    like = T.rouge_l(T.tokens(F.col("text")), T.tokens(F.col("reference")))
    like = F.greatest(like, F.col("similarity")) if "similarity" in answers.columns else like
    share = F.avg((like >= limits.open_similarity).cast("double"))
    return given.groupBy("video_id", "qid").agg(F.count(F.lit(1)).alias("n_raters"), F.round(share, 3).alias("agreement"), (share >= limits.open_share).alias("passes"))


def open_levels(answers: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    """(video_id, batch, n, ratio, ok): the share of open questions whose raters agree with the reference."""
    ratio = F.round(F.avg(F.col("passes").cast("double")), 3)
    return _levels(open_items(answers, limits), F.count(F.lit(1)).alias("n"), ratio.alias("ratio")).withColumn("ok", F.col("ratio") >= limits.open_share)


def gold_levels(responses: DataFrame, least: float = DEFAULT.gold_accuracy) -> DataFrame:
    """(video_id, batch, flagged): the raters whose accuracy on gold items is too low, in each video and in the batch."""
    right = F.coalesce(F.col("response") == F.col("answer"), F.lit(False)).cast("double")
    raters = _levels(responses.where("is_gold and annotator <> ''").withColumn("right", right), F.avg("right").alias("accuracy"), by=("annotator",))
    return raters.groupBy("video_id", "batch").agg(F.array_sort(F.collect_list(F.when(F.col("accuracy") < least, F.col("annotator")))).alias("flagged"))


def mcq_stats(responses: DataFrame) -> DataFrame:
    """One row a batch of (qid, annotator, response, answer, is_gold): alpha of the items that aren't gold, raters whose
    gold accuracy is too low, and questions to rework."""
    alpha = alpha_nominal(responses.where("not is_gold and response <> ''").select(F.col("qid").alias("unit"), F.col("response").alias("value")))
    flagged = gold_accuracy(responses).agg(F.sum(F.col("flagged").cast("int")).alias("flagged"))
    return alpha.join(flagged).join(rework(responses).agg(F.count(F.lit(1)).alias("rework")))  # one row each


def mcq_levels(responses: DataFrame, limits: Thresholds = DEFAULT) -> DataFrame:
    """(video_id, batch, n_items, alpha, alpha_ok, flagged, rework) of (video_id, qid, annotator, response, answer,
    is_gold) for each video with responses, and for the batch."""
    known = responses.where("answer <> ''")
    ratings = known.where("not coalesce(is_gold, false) and response <> ''").select("video_id", F.col("qid").alias("unit"), F.col("response").alias("value"))
    again = rework(known.select("qid", "annotator", "response", "answer", "is_gold"))
    again = _levels(again.join(known.select("qid", "video_id").distinct(), "qid"), F.count(F.lit(1)).alias("rework"))
    out = _levels(responses, F.count(F.lit(1)).alias("n_responses"))
    for part in (alpha_levels(ratings), gold_levels(known, limits.gold_accuracy), again):
        names = [c for c in part.columns if c not in ("video_id", "batch")]
        part = part.select(F.col("video_id").alias("__v"), F.col("batch").alias("__b"), *names)
        out = out.join(part, F.col("__v").eqNullSafe(out["video_id"]) & (F.col("__b") == out["batch"]), "left").drop("__v", "__b")
    none = F.array().cast("array<string>")
    return out.select("video_id", "batch", F.coalesce("n_items", F.lit(0)).alias("n_items"), "alpha", F.coalesce(F.col("alpha") >= limits.alpha, F.lit(False)).alias("alpha_ok"), F.coalesce("flagged", none).alias("flagged"), F.coalesce("rework", F.lit(0)).alias("rework"))


def interval_items(responses: DataFrame, least: float = 0.5) -> DataFrame:
    """Mean IoU over raters of each temporal question (s, e against rs, re), and whether it passes."""
    mean = F.avg(I.iou(F.col("s"), F.col("e"), F.col("rs"), F.col("re")))
    return responses.groupBy("video_id", "qid").agg(mean.alias("miou"), F.count(F.lit(1)).alias("raters")).withColumn("passes", F.col("miou") >= least)


def pass_ratio(items: DataFrame, by: list[str], share: float) -> DataFrame:
    """Share of passing items, rounded to 3, and whether it suffices."""
    ratio = F.round(F.avg(F.col("passes").cast("double")), 3)
    return items.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg("miou").alias("mean_iou"), ratio.alias("ratio")).withColumn("ok", F.col("ratio") >= share)
