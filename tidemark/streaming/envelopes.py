"""Streaming variants: loudness frames per tumbling window, and idempotent manifest upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.incremental import latest


def windowed_levels(stream: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Root mean square and count by (user_id, tumbling window) of a stream of (ts, user_id, value)."""
    return (
        stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy("user_id", F.window("ts", width))
        .agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms"), F.count(F.lit(1)).alias("n")).select("user_id", F.col("window.start").alias("start"), "rms", "n")
    )


def upsert_states(stream: DataFrame, path: str, checkpoint: str, key: tuple[str, ...] = ("video_id", "stage"), at: str = "updated") -> StreamingQuery:
    """Manifest rows of a stream: each batch is cut to the last row of a key before it is written to its own folder, so
    a repeated batch changes nothing; ``current`` gives the last of all."""

    def put(batch: DataFrame, number: int) -> None:
        latest(batch, list(key), at).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, key: tuple[str, ...] = ("video_id", "stage"), at: str = "updated") -> DataFrame:
    """The last row of each key of what ``upsert_states`` has written."""
    return latest(spark.read.parquet(path).drop("batch"), list(key), at)


def append_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once files: a batch overwrites its own folder, so a repeated batch leaves one copy."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
