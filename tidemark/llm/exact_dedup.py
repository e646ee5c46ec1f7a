"""Exact dedup as a stateful stream.

The stream's state is keyed by the SHA-256 of the normalised text (the six ASCII white-space characters deleted),
lives in RocksDB on the executors' disks, never expires, and holds per digest the group's size and of the row that
stays: code points, stable id and content locator (file and row in it). A micro-batch pre-aggregates before its
shuffle, so a digest with a third of all rows is one row a task. Every row whose digest occurs twice or more is then
checked byte for byte against the text that its group's locator names; rows that only share the digest are regrouped by
their full text. Only the texts of such rows are read again and moved, found by their locators.

Only DataFrame functions run here: no Python code touches a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.located import integer_ids, located, picked, without
from tidemark.llm.scratch import Scratch

#: State on the executors' disks. Without preallocation an empty store takes kilobytes, not megabytes.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SPACE = " \t\n\x0b\x0c\r"


def keep_states(prints: DataFrame, scratch: Scratch, max_bytes_per_trigger: int, digest_chars: int) -> DataFrame:
    """(digest, size, best): streams the saved fingerprint table through the keyed state."""
    spark, path = prints.sparkSession, scratch.at("states")
    was = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        state = (
            spark.readStream.schema(prints.schema).option("maxBytesPerTrigger", str(max_bytes_per_trigger)).parquet(scratch.at("prints"))
            .withColumn("digest", F.substring("sha", 1, digest_chars)).groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("points", F.bitwise_not("id").alias("order"), "id", "file", "at")).alias("best"))
        )

        def put(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

        query = state.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", scratch.at("stream")).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # a digest that several batches touched has a row from each; its size only grows
    found = spark.read.schema(state.schema).parquet(path)
    return found.groupBy("digest").agg(F.max(F.struct("size", "best")).alias("s")).select("digest", "s.size", "s.best")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes_per_trigger: int = 64 << 30, digest_chars: int = 64) -> DataFrame:
    """A verdict for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, file, at.

    Rows are equal when their texts are, after deleting ASCII white space; null counts as empty, and all empty texts
    are one group. The row with most code points in the original text stays, then the least id, then the greatest
    (file, at), so exactly one row of a group is kept even where rows repeat an id. A row without an id loses ties.
    (file, at) locates the row in its file. Other columns are ignored. The id is an integer column.
    ``max_bytes_per_trigger`` bounds a micro-batch; ``digest_chars`` shortens the state's key, which tests use to make
    digests collide.
    """
    integer_ids(docs, id_col)
    scratch = Scratch(docs.sparkSession, "exact")
    docs, file, at = located(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), scratch)
    norm = F.translate("text", SPACE, "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    rows = docs.select("id", F.col(file).alias("file"), F.col(at).alias("at"), norm.alias("norm"), F.length("text").alias("points"))
    prints = scratch.save(rows.select("id", "file", "at", sha(F.col("norm")).alias("sha"), "points"), "prints")
    states = scratch.save(keep_states(prints, scratch, max_bytes_per_trigger, digest_chars), "groups")
    prints = prints.withColumn("digest", F.substring("sha", 1, digest_chars))

    several = states.where("size > 1").select("digest", F.col("best.file").alias("kfile"), F.col("best.at").alias("kat"))
    twice = scratch.save(prints.join(several, "digest").select("file", "at"), "twice")
    hits = picked(rows, twice, "left_semi").withColumn("digest", F.substring(sha(F.col("norm")), 1, digest_chars)).join(several, "digest")
    hits = scratch.save(hits.select("id", "file", "at", "digest", "norm", "points", F.expr("file = kfile and at = kat").alias("stays")), "hits")
    first = hits.where("stays").select("digest", F.col("norm").alias("first"))
    # no aggregate on the joined rows, so that a large group of copies can be split among tasks
    differ = scratch.save(hits.where("not stays").join(first, "digest").where("norm <> first").select("digest"), "differ")

    out = prints.join(states, "digest").select("id", "file", "at", "sha", "digest", "size", "best")
    if not differ.isEmpty():
        differ = differ.distinct()
        mixed = hits.join(differ, "digest", "left_semi")
        anew = mixed.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("points", F.bitwise_not("id").alias("order"), "id", "file", "at")).alias("best"))
        anew = mixed.join(anew, ["digest", "norm"]).select("id", "file", "at", sha(F.col("norm")).alias("sha"), "digest", "size", "best")
        out = out.join(differ, "digest", "left_anti").unionByName(anew)
    else:
        scratch.drop("hits")
    return out.select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.expr("file = best.file and at = best.at")).alias("kept"), F.col("sha").alias("text_sha256"), "file", "at",
    )


def op3_streaming_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's query over every whole text of ``documents``."""
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("file", "at")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row that stays of each group of equal texts; rows are told by their places."""
    scratch = Scratch(spark, "exact-stage")
    docs, file, at = located(docs, scratch)
    gone = scratch.save(exact_duplicates(docs.select("doc_id", "text")).where("not kept").select("file", "at"), "gone")
    return without(docs, file, at, gone)
