"""Manifests as a stateful stream: each video's log in keyed state, its manifest rewritten where a batch touches it."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators import incremental
from tidemark.operators.incremental import LOG, LOG_KINDS


def needed(log: set[tuple]) -> list[tuple]:
    """The rows of a video's log that can still count: of what is replaced (stats by name, frames, clearings) the last
    only, no gap before the last clearing. Stages keep all, since a late row can change which hash came before which."""
    order = lambda r: tuple((x is not None, x) for x in r)
    last, cleared = {}, None
    for r in log:
        kind, name = r[1], r[7]
        if kind in ("stats", "frames", "clear_gaps"):
            at = (kind, name if kind == "stats" else None)
            mine = (r[0], order((r[8],)))
            if at not in last or mine > last[at][0]:
                last[at] = (mine, r)
            if kind == "clear_gaps":
                cleared = r[0] if cleared is None else max(cleared, r[0])
    kept = {r for _, r in last.values()}
    kept |= {r for r in log if r[1] in ("stage", "todo") or (r[1] == "gap" and (cleared is None or r[0] > cleared))}
    return sorted(kept, key=order)


def logs(stream: DataFrame) -> DataFrame:
    """A stream of (video_id, log) of the videos that a batch touches; ``stream`` has video_id and ``LOG``. State is one
    log a video, without expiry; rows without a time or a video are passed over."""

    def put(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        log = {tuple(r) for r in json.loads(state.get[0])} if state.exists else set()
        for frame in frames:
            for row in frame["row"]:
                log.add(tuple(json.loads(row)))
        rows = needed(log)
        state.update((json.dumps(rows),))
        yield pd.DataFrame({"video_id": [key[0]], "log": [json.dumps([dict(zip(LOG, r, strict=True)) for r in rows])]})

    # fields as JSON texts in one array, so that numbers and nulls reach Python as they are
    field = lambda c: F.coalesce(F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2), F.lit("null"))
    row = F.concat(F.lit("["), F.concat_ws(",", *map(field, LOG)), F.lit("]"))
    out = StructType([StructField("video_id", stream.schema["video_id"].dataType), StructField("log", StringType())])
    rows = stream.where("at is not null and video_id is not null").select("video_id", row.alias("row"))
    return rows.groupBy("video_id").applyInPandasWithState(put, out, "log string", "update", "NoTimeout")


def keep(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the manifests of the videos that each batch touches to the batch's own folder, so a repeated batch changes
    nothing; a late or repeated row changes only what it would have changed in its place."""

    def put(batch: DataFrame, number: int) -> None:
        rows = batch.select("video_id", F.explode(F.from_json("log", f"array<struct<{', '.join(c.replace(' ', ': ', 1) for c in LOG_KINDS.split(', '))}>>")).alias("r")).select("video_id", "r.*")
        incremental.manifest(rows).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return logs(stream).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    """The last manifest of each video of what ``keep`` has written."""
    return incremental.latest(spark.read.parquet(path), ["video_id"], "batch").drop("batch")
