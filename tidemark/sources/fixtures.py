"""The driver's tables as timeline data: one user is one video, one real hour one timeline second, 720 s each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import BOUNDARY_STATES, CAPABILITIES, GENRES

DURATION = 720.0


def pick(index: Column, values) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (index + 1).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, ord, t, txt, v: captions, raw screen text, audio frames."""
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("video_id"), F.col("event_id").alias("ord"), F.round(micros / 3.6e9 - 473352, 3).alias("t"), F.col("event_type").alias("txt"), F.col("value").alias("v")
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, ord, s, e, txt, v: candidate events, subtitles."""
    return points(spark, sf_dir).select("video_id", "ord", F.col("t").alias("s"), F.round(F.col("t") + F.col("v") / 10, 3).alias("e"), "txt", "v")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).select("video_id").distinct().select("video_id", F.lit(DURATION).alias("duration"), pick(F.col("video_id") % 12, GENRES).alias("genre"))


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video_id, ord, s, e between consecutive points; the last runs to the end."""
    following = F.lead("t").over(Window.partitionBy("video_id").orderBy("t", "ord"))
    return points(spark, sf_dir).select("video_id", "ord", F.col("t").alias("s"), F.coalesce(following, F.lit(DURATION)).alias("e"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve scenes of a minute each; their list runs backwards (``place``)."""
    k = F.explode(F.sequence(F.lit(0), F.lit(11)))
    return videos(spark, sf_dir).select("video_id", k.alias("k")).select(
        "video_id", (F.col("k") + 1).cast("long").alias("scene_id"), (F.col("k") * 60.0).alias("s"), (F.col("k") * 60.0 + 60).alias("e"), (11 - F.col("k")).alias("place")
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lag("ord").over(Window.partitionBy("video_id").orderBy("s", "ord"))
    return spans(spark, sf_dir).select(
        "*", F.when(F.col("ord") % 3 == 0, "key").otherwise("minor").alias("importance"), pick(F.col("ord") % 4, BOUNDARY_STATES).alias("boundary_state"), F.when(F.col("ord") % 2 == 0, before).alias("cause")
    )


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions on the spans: type, watch need, channel flags, gold flag, answer letter."""
    o = F.col("ord")
    kind = F.when(o % 20 < 12, "mcq").when(o % 20 < 16, "temporal_grounding").when(o % 20 < 18, "open").otherwise("summary")
    return spans(spark, sf_dir).select(
        "video_id", "ord", "s", "e", "txt", F.concat_ws("_q", F.col("video_id").cast("string"), o.cast("string")).alias("qid"), kind.alias("task_type"),
        pick(o % 24, CAPABILITIES).alias("capability"), pick(o % 3, ("single_scene", "cross_scene", "whole_video")).alias("min_watch"),
        (F.col("v") < 2).alias("blind"), (o % 11 == 0).alias("subtitle"), (o % 13 == 0).alias("single_frame"), (o % 7 == 0).alias("is_gold"), pick(o % 4, "ABCD").alias("answer"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three raters' letters and intervals for every question."""
    r = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    x = qa(spark, sf_dir).withColumn("r", r)
    letter = pick((F.col("ord") + F.when((F.col("ord") + F.col("r")) % 5 == 0, 1).otherwise(0)) % 4, "ABCD")
    return x.select("video_id", "qid", "ord", "task_type", "is_gold", F.concat(F.lit("r"), F.col("r").cast("string")).alias("annotator"), letter.alias("response"), F.col("answer"), "s", "e",
                    (F.col("s") + F.col("r") * 0.1).alias("rs"), (F.col("e") + F.col("r") * 0.2).alias("re"))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


#: The same views for the SQL that checks the queries.
SQL = f"""
v_points AS (SELECT user_id AS video_id, event_id AS ord, round(epoch_us(ts) / 3.6e9 - 473352, 3) AS t, event_type AS txt, value AS v FROM events),
v_spans AS (SELECT video_id, ord, t AS s, round(t + v / 10, 3) AS e, txt, v FROM v_points),
v_videos AS (SELECT DISTINCT video_id, 720.0::DOUBLE AS duration, ({_list(GENRES)})[(video_id % 12 + 1)::INT] AS genre FROM v_points),
v_shots AS (SELECT video_id, ord, t AS s, coalesce(lead(t) OVER (PARTITION BY video_id ORDER BY t, ord), 720.0) AS e FROM v_points),
v_scenes AS (SELECT video_id, (k + 1)::BIGINT AS scene_id, k * 60.0::DOUBLE AS s, k * 60.0::DOUBLE + 60 AS e, 11 - k AS place FROM v_videos, range(12) r(k)),
v_events AS (SELECT *, CASE WHEN ord % 3 = 0 THEN 'key' ELSE 'minor' END AS importance, ({_list(BOUNDARY_STATES)})[(ord % 4 + 1)::INT] AS boundary_state,
  CASE WHEN ord % 2 = 0 THEN lag(ord) OVER (PARTITION BY video_id ORDER BY s, ord) END AS cause FROM v_spans),
v_qa AS (SELECT video_id, ord, s, e, txt, video_id || '_q' || ord AS qid,
  CASE WHEN ord % 20 < 12 THEN 'mcq' WHEN ord % 20 < 16 THEN 'temporal_grounding' WHEN ord % 20 < 18 THEN 'open' ELSE 'summary' END AS task_type,
  ({_list(CAPABILITIES)})[(ord % 24 + 1)::INT] AS capability, (['single_scene','cross_scene','whole_video'])[(ord % 3 + 1)::INT] AS min_watch,
  v < 2 AS blind, ord % 11 = 0 AS subtitle, ord % 13 = 0 AS single_frame, ord % 7 = 0 AS is_gold, substr('ABCD', (ord % 4 + 1)::INT, 1) AS answer FROM v_spans),
v_responses AS (SELECT video_id, qid, ord, task_type, is_gold, 'r' || r AS annotator, substr('ABCD', ((ord + CASE WHEN (ord + r) % 5 = 0 THEN 1 ELSE 0 END) % 4 + 1)::INT, 1) AS response,
  answer, s, e, s + r * 0.1::DOUBLE AS rs, e + r * 0.2::DOUBLE AS re FROM v_qa, range(3) x(r))
"""
