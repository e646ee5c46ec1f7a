"""Loudness envelopes: frames, speech baseline, features and rule classes of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def envelope(samples: DataFrame, size: int) -> DataFrame:
    """Root mean square of each full frame of ``size`` samples (video_id, i, x); a partial last frame goes."""
    frames = samples.groupBy("video_id", F.floor(F.col("i") / size).alias("frame_no")).agg(F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("rms"), F.count(F.lit(1)).alias("n"))
    return frames.where(F.col("n") == size).drop("n")


def baseline(frames: DataFrame) -> DataFrame:
    """Median loudness of speech frames (video_id, rms, speech), of all frames where there are none, never zero."""
    out = frames.groupBy("video_id").agg(F.expr("percentile(if(speech, rms, null), 0.5)").alias("a"), F.expr("percentile(rms, 0.5)").alias("b"))
    value = F.coalesce("a", "b")
    return out.select("video_id", F.when(value > 0, value).otherwise(1e-6).alias("baseline"))


def segment_features(frames: DataFrame, base: DataFrame, by: list[str]) -> DataFrame:
    """Of frames (video_id, ..., frame_no, rms) per segment: peak, mean, ratio of the mean to the baseline, and burst, the
    mean of the second half over that of the first (null with one frame)."""
    w = Window.partitionBy(*by)
    half = F.row_number().over(w.orderBy("frame_no")) > F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(w) / 2))
    marked = frames.withColumn("late", half)
    out = marked.groupBy(*by).agg(F.max("rms").alias("peak"), F.avg("rms").alias("mean"), F.avg(F.when(F.col("late"), F.col("rms"))).alias("second"), F.avg(F.when(~F.col("late"), F.col("rms"))).alias("first"), F.min("frame_no").alias("lo"), F.max("frame_no").alias("hi"))
    burst = F.col("second") / F.when(F.col("first") == 0, 1e-6).otherwise(F.col("first"))
    return out.join(base, "video_id").withColumn("ratio", F.col("mean") / F.col("baseline")).withColumn("burst", burst).drop("first", "second")


def classify(ratio: Column, mean: Column, burst: Column) -> Column:
    """The rule's class of a segment by its mean level, its ratio to the baseline, and its burst."""
    bursts = F.coalesce(burst >= 3, F.lit(False))
    return F.when((ratio >= 6) | (mean >= 0.5), "music").when(bursts & (ratio >= 2), "applause").when(ratio >= 2, "sfx").otherwise("noise")


def confidence(kind: Column) -> Column:
    return F.when(kind.isin("music", "applause"), 0.8).otherwise(0.6)


def active_bounds(frames: DataFrame, base: DataFrame, by: list[str], factor: float = 1.2, margin: int = 5) -> DataFrame:
    """First and last frame at ``factor`` times the baseline, widened by ``margin`` within the segment; a segment
    without such a frame has no row."""
    loud = F.when(F.col("rms") >= F.greatest(factor * F.col("baseline"), F.lit(1e-5)), F.col("frame_no"))
    out = frames.join(base, "video_id").groupBy(*by).agg(F.min("frame_no").alias("lo"), F.max("frame_no").alias("hi"), F.min(loud).alias("a"), F.max(loud).alias("b"))
    return out.where("a is not null").select(*by, F.greatest("lo", F.col("a") - margin).alias("a"), F.least("hi", F.col("b") + margin).alias("b"))


def detect(frames: DataFrame, base: DataFrame, by: list[str], frame_sec: float = 0.05, peak: float = 2.0, least_sec: float = 0.8) -> DataFrame:
    """Sounds in segments without speech: the active part of each segment whose peak reaches ``peak`` times the baseline,
    if it lasts ``least_sec``, with the class of the whole segment by the rule."""
    found = segment_features(frames, base, by).where(F.col("peak") >= peak * F.col("baseline")).join(active_bounds(frames, base, by), by)
    kind = classify(F.col("ratio"), F.col("mean"), F.col("burst"))
    return found.where((F.col("b") - F.col("a")) * frame_sec >= least_sec).withColumn("type", kind).withColumn("confidence", confidence(F.col("type")))
