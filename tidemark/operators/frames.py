"""Frame stores: numbers and times of frames, ownership, checks, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import intervals as I


def index(names: DataFrame, fps: float) -> DataFrame:
    """(video_id, frame_no, t) from file names (video_id, name); names that aren't frames are left out.

    A frame's number is its time in frames, rounded half to even. Where two times fall on one number the later takes
    the next after the highest so far; over frames in order of time that is a running maximum.
    """
    rows = names.where(F.col("name").rlike(r"f_\d{7}_\d{3}\.jpg$")).select("video_id", F.round(I.frame_time(F.col("name")), 3).alias("t")).distinct()
    w = Window.partitionBy("video_id").orderBy("t")
    rows = rows.withColumn("i", F.row_number().over(w)).withColumn("no", F.bround(F.col("t") * fps, 0).cast("long"))
    return rows.select("video_id", (F.col("i") + F.max(F.col("no") - F.col("i")).over(w)).alias("frame_no"), "t")


def owned(indexes: DataFrame, directory: Column) -> DataFrame:
    """``indexes`` (expected, video_id, ...) with ``foreign``: whether an index belongs to another video. One that doesn't
    say whose it is counts as its directory's."""
    return indexes.withColumn("foreign", ~F.coalesce(F.coalesce("video_id", directory) == F.col("expected"), F.lit(False)))


def verified(frames: DataFrame, duration: Column, fps: float = 1.0) -> DataFrame:
    """Per video of (video_id, frame_no, t): backward steps, and whether the index is whole: none, the first frame by 1.5 s
    and the last within a frame and a half second of the end."""
    w = Window.partitionBy("video_id").orderBy("frame_no")
    back = frames.withColumn("back", F.coalesce(F.col("t") < F.lag("t").over(w), F.lit(False)))
    a = back.groupBy("video_id").agg(F.sum(F.col("back").cast("int")).alias("backward"), F.min("t").alias("first"), F.max("t").alias("last"))
    near = F.lit(max(1.5, 1 / fps + 0.5))
    return a.select("video_id", "backward", ((F.col("backward") == 0) & (F.col("first") <= 1.5) & (duration - F.col("last") <= near)).alias("ok"))


def statistics(frames: DataFrame) -> DataFrame:
    """Per video: frames, first and last time, and the mean step."""
    out = frames.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first"), F.max("t").alias("last"))
    return out.withColumn("step", F.when(F.col("n") > 1, (F.col("last") - F.col("first")) / (F.col("n") - 1)))


def loaded(stored: DataFrame, names: DataFrame, fps: float) -> DataFrame:
    """Stored indexes (video_id, a map from number to time), with those that are missing or empty built from names."""
    rows = stored.select("video_id", F.explode("frames").alias("frame_no", "t")).select("video_id", F.col("frame_no").cast("long").alias("frame_no"), F.col("t").cast("double").alias("t"))
    return rows.unionByName(index(names.join(rows.select("video_id").distinct(), "video_id", "left_anti"), fps))
