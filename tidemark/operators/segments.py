"""Ordered operators on a timeline: islands, unions, gaps, windows, clusters.

Rows of one video are ordered within it, so every window here is partitioned by the video; a video is a bounded
timeline (hours), and videos spread over the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T


def islands(rows: DataFrame, by: list[str], order: list[str], fresh: Column) -> DataFrame:
    """Adds ``island``: how many rows up to this one start a new run; ``fresh`` may use lag over the same order."""
    return rows.withColumn("__fresh", fresh.cast("int")).withColumn("island", F.sum("__fresh").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).drop("__fresh")


def merge_spans(spans: DataFrame, eps: float = 0.0, duration: float | None = None) -> DataFrame:
    """Union of (video_id, s, e): spans that touch within ``eps`` become one; empty ones are dropped after clamping."""
    if duration is not None:
        spans = spans.select("video_id", F.greatest(F.lit(0.0), "s").alias("s"), F.least(F.lit(float(duration)), "e").alias("e"))
    spans = spans.where("e > s").select("video_id", "s", "e")
    before = F.max("e").over(Window.partitionBy("video_id").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("before", before)
    runs = islands(marked, ["video_id"], ["s", "e"], F.col("before").isNull() | (F.col("s") > F.col("before") + eps))
    return runs.groupBy("video_id", "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def gaps(videos: DataFrame, spans: DataFrame, eps: float, least: float, strict: bool) -> DataFrame:
    """What the union of ``spans`` leaves of [0, duration] in ``videos`` (video_id, duration), if over (or at) ``least``."""
    union = merge_spans(spans, eps)
    last = Window.partitionBy("video_id").orderBy("s")
    inner = union.select("video_id", F.lag("e", 1, 0.0).over(last).alias("s"), F.col("s").alias("e"))
    ends = videos.join(union.groupBy("video_id").agg(F.max("e").alias("e")), "video_id", "left").select("video_id", F.coalesce("e", F.lit(0.0)).alias("s"), F.col("duration").alias("e"))
    width = F.col("e") - F.col("s")
    return inner.unionByName(ends).where(width > least if strict else (width >= least) & (width > 0))


def merge_same_text(points: DataFrame, gap: float) -> DataFrame:
    """Runs of points (video_id, ord, t, txt, v) with the text of the row before and within ``gap`` of it."""
    w = Window.partitionBy("video_id").orderBy("t", "ord")
    fresh = F.lag("t").over(w).isNull() | (F.lag("txt").over(w) != F.col("txt")) | (F.col("t") - F.lag("t").over(w) > gap)
    runs = islands(points.withColumn("f", fresh), ["video_id"], ["t", "ord"], F.col("f"))
    return runs.groupBy("video_id", "island").agg(F.min("t").alias("s"), F.max("t").alias("e"), F.min_by("txt", F.struct("t", "ord")).alias("txt"), F.min_by("v", F.struct("t", "ord")).alias("v"), F.count(F.lit(1)).alias("n")).drop("island")


def merge_captions(points: DataFrame, similarity: float, gap: float, least: float = 2.0) -> DataFrame:
    """Drafts from captions: a new run where the text is unlike the row before or later than ``gap``; short ones go."""
    w = Window.partitionBy("video_id").orderBy("t", "ord")
    marked = points.withColumn("last_t", F.lag("t").over(w)).withColumn("last", F.lag("txt").over(w))
    like = T.jaccard(T.ngrams(F.col("last")), T.ngrams(F.col("txt")))
    runs = islands(marked, ["video_id"], ["t", "ord"], F.col("last_t").isNull() | (like < similarity) | (F.col("t") - F.col("last_t") > gap))
    texts = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("t", "ord", "txt"))), lambda x: x["txt"]))
    out = runs.groupBy("video_id", "island").agg(F.min("t").alias("s"), F.max("t").alias("e"), texts.alias("texts"))
    return out.where(F.col("e") - F.col("s") >= least).select("video_id", "s", "e", F.left(F.array_join("texts", "；"), F.lit(120)).alias("txt"))


def sliding_windows(points: DataFrame, width: float, step: float, duration: float) -> DataFrame:
    """One row for each window, closed at both ends, that holds a point; window k starts at k * step before the end."""
    low = F.greatest(F.lit(0), F.ceil((F.col("t") - width) / step)).cast("long")
    high = F.least(F.floor(F.col("t") / step), F.lit(-(-duration // step) - 1)).cast("long")
    return points.where(low <= high).withColumn("k", F.explode(F.sequence(low, high))).withColumn("ws", F.col("k") * step).withColumn("we", F.least(F.col("ws") + width, F.lit(duration))).where("t <= we")


def fixed_windows(videos: DataFrame, width: float) -> DataFrame:
    k = F.explode(F.sequence(F.lit(0).cast("long"), (F.ceil(F.col("duration") / width) - 1).cast("long")))
    return videos.where("duration > 0").select("video_id", "duration", k.alias("k")).select("video_id", (F.col("k") * width).alias("s"), F.least((F.col("k") + 1) * width, F.col("duration")).alias("e"))


def greedy_windows(shots: DataFrame, most: float) -> DataFrame:
    """Shots (video_id, s, e) packed in order into windows of at most ``most`` seconds; longer shots are cut hard.

    State depends on the window being built, so it is a fold over a video's sorted shots, in the plan.
    """
    n = F.ceil((F.col("e") - F.col("s")) / most).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct((F.col("s") + i * most).alias("s"), F.least(F.col("s") + (i + 1) * most, F.col("e")).alias("e"), (n > 1).alias("hard")))
    pieces = shots.where("e > s").select("video_id", F.explode(cut).alias("p"))
    a_video = pieces.groupBy("video_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    start = F.expr("cast(array() as array<struct<s: double, e: double, hard: boolean>>)")

    def add(acc: Column, p: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joins = (F.size(acc) > 0) & ~last["hard"] & ~p["hard"] & (p["e"] - last["s"] <= most)
        grown = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["s"].alias("s"), p["e"].alias("e"), last["hard"].alias("hard"))))
        return F.when(F.coalesce(joins, F.lit(False)), grown).otherwise(F.concat(acc, F.array(p)))

    return a_video.select("video_id", F.explode(F.aggregate("p", start, add)).alias("w")).select("video_id", F.round("w.s", 3).alias("s"), F.round("w.e", 3).alias("e"))


def shot_groups(shots: DataFrame, most: float) -> DataFrame:
    """Consecutive shots while the group, from its first start to this end, is shorter than ``most``."""
    a_video = shots.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("p"))
    start = F.expr("cast(array() as array<struct<s: double, e: double, n: bigint>>)")

    def add(acc: Column, p: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joins = (F.size(acc) > 0) & (p["e"] - last["s"] < most)
        grown = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["s"].alias("s"), p["e"].alias("e"), (last["n"] + 1).alias("n"))))
        return F.when(F.coalesce(joins, F.lit(False)), grown).otherwise(F.concat(acc, F.array(F.struct(p["s"].alias("s"), p["e"].alias("e"), F.lit(1).cast("long").alias("n")))))

    return a_video.select("video_id", F.explode(F.aggregate("p", start, add)).alias("g")).select("video_id", "g.s", "g.e", "g.n")


def _first_fit(ratio: float):
    def run(video: pd.DataFrame) -> pd.DataFrame:
        video = video.sort_values(["s", "e", "ord"], kind="stable")
        s, e, found, fresh = video["s"].to_numpy(), video["e"].to_numpy(), np.zeros(len(video), dtype=np.int64), 0
        live = np.zeros(0, dtype=np.int64)  # spans that a span which starts now can overlap
        for i in range(len(video)):
            live = live[e[live] > s[i]]
            short = np.minimum(e[i] - s[i], e[live] - s[live])
            met = live[(short > 0) & (np.minimum(e[i], e[live]) - s[i] > ratio * short)]
            found[i] = found[met].min() if len(met) else fresh
            fresh += not len(met)
            live = np.append(live, i)
        return pd.DataFrame({"video_id": video["video_id"], "ord": video["ord"], "cluster": found})

    return run


def first_fit_clusters(spans: DataFrame, ratio: float = 0.5) -> DataFrame:
    """Each span joins the first cluster with a member that it overlaps by more than ``ratio``.

    Order matters and clusters are not components, so each video's spans are folded in one pandas group. A sweep in order
    of starts drops ended spans, so a span meets only those that can overlap it.
    """
    return spans.select("video_id", "ord", "s", "e").groupBy("video_id").applyInPandas(_first_fit(ratio), "video_id bigint, ord bigint, cluster bigint")


def every_kth(points: DataFrame, k: int) -> DataFrame:
    """Every ``k``-th point of a video in order of time, from the first."""
    place = F.row_number().over(Window.partitionBy("video_id").orderBy("t", "ord")) - 1
    return points.withColumn("__p", place).where(F.col("__p") % k == 0).drop("__p")


def round_robin_cap(anchors: DataFrame, cap: int, duration: float | Column) -> DataFrame:
    """At most ``cap`` anchors a video, taken in turn from four parts of the timeline.

    Within a part unused anchors come first, then key events, then early ones. Videos within the cap keep all.
    """
    scale = F.greatest(F.lit(duration).cast("double"), F.max("e").over(Window.partitionBy("video_id")), F.lit(1.0))
    part = F.least(F.lit(3), F.floor((F.col("s") + F.col("e")) / 2 / scale * 4)).cast("int")
    ranked = anchors.withColumn("bucket", part).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("video_id")))
    ranked = ranked.withColumn("turn", F.row_number().over(Window.partitionBy("video_id", "bucket").orderBy("used", F.col("importance") != "key", "s", "ord")))
    taken = ranked.withColumn("place", F.row_number().over(Window.partitionBy("video_id").orderBy("turn", "bucket")))
    return taken.where(F.col("place") <= cap).drop("turn", "place", "n")
