"""Joins on a time axis without comparing every pair: buckets for ranges, a running value for as-of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _buckets(s: Column, e: Column, width: float) -> Column:
    return F.explode(F.sequence(F.floor(s / width), F.floor(e / width)))


def range_join(left: DataFrame, right: DataFrame, width: float, strict: bool = False) -> DataFrame:
    """Pairs of one video whose spans overlap; ``left`` (video_id, s, e, ...), ``right`` (video_id, rs, re, ...).

    Both sides are spread over time buckets of ``width`` and joined by (video_id, bucket), so a long timeline is many
    small joins; a pair is kept in the bucket of the later start only, so none comes twice. Spans that touch count
    unless ``strict``. Choose ``width`` near the usual span.
    """
    a = left.where("e >= s").withColumn("__b", _buckets(F.col("s"), F.col("e"), width))
    b = right.where("re >= rs").withColumn("__b", _buckets(F.col("rs"), F.col("re"), width))
    first = F.floor(F.greatest("s", "rs") / width) == F.col("__b")
    met = (F.col("rs") < F.col("e")) & (F.col("re") > F.col("s")) if strict else (F.col("rs") <= F.col("e")) & (F.col("re") >= F.col("s"))
    return a.join(b, ["video_id", "__b"]).where(first & met).drop("__b")


def self_overlaps(spans: DataFrame, ratio: float, width: float) -> DataFrame:
    """Pairs (a < b by ord) of one video that overlap by more than ``ratio`` of the shorter."""
    from tidemark.functions.intervals import overlap_ratio

    right = spans.select("video_id", F.col("ord").alias("b"), F.col("s").alias("rs"), F.col("e").alias("re"))
    pairs = range_join(spans.select("video_id", F.col("ord").alias("a"), "s", "e"), right, width, strict=True).where("a < b")
    return pairs.withColumn("ratio", overlap_ratio(F.col("s"), F.col("e"), F.col("rs"), F.col("re"))).where(F.col("ratio") > ratio)


def asof_join(left: DataFrame, right: DataFrame, time: str, right_time: str, value: str) -> DataFrame:
    """``left`` with the last ``value`` of ``right`` at or before its ``time``, or else the first one after.

    One sort of the union a video instead of a join of all pairs.
    """
    union = left.select("*", F.lit(None).cast(right.schema[value].dataType).alias("__v"), F.col(time).alias("__t"), F.lit(1).alias("__side")).unionByName(
        right.select("video_id", F.col(value).alias("__v"), F.col(right_time).alias("__t"), F.lit(0).alias("__side")), allowMissingColumns=True
    )
    w = Window.partitionBy("video_id").orderBy("__t", "__side")
    out = union.withColumn("found", F.last("__v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.withColumn("found", F.coalesce("found", F.first("__v", True).over(w.rowsBetween(0, Window.unboundedFollowing))))
    return out.where("__side = 1").drop("__v", "__t", "__side")
