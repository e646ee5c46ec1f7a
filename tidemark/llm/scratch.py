"""Shared scratch tables: lineage is cut by writing to the folder that every executor sees."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group that a task holds while it writes.
ROW_GROUP = 32 << 20


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most ``rows`` rows to Python workers of what runs inside, which bounds memory where rows are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def give_back() -> None:
    """Return a worker's freed memory to the system at the end of a task. Workers live on beside each other and serve
    one stage after another, and else keep what their largest task took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


class Scratch:
    """A fresh folder under ``spark.checkpoint.dir``; a local temporary folder only where that is unset (tests)."""

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = "file://" + tempfile.mkdtemp(prefix="spark-")
        self.spark = spark
        self.path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a reader of the files, whose lineage is the files alone."""
        df.write.option("parquet.block.size", str(ROW_GROUP)).parquet(self.at(name))
        return self.spark.read.schema(df.schema).parquet(self.at(name))

    def drop(self, name: str) -> None:
        """Delete one table that is no longer read."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.at(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
