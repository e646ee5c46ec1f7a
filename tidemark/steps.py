"""Written steps: tables between the steps of a long composition, so that each step's plan stays small.

A frame that later steps use several times is written once to the folder that driver and executors share and read back,
which also cuts its lineage to files: a lost executor costs tasks of one step, not of all.

Sorted keys and repeated texts shrink to a small part of their rows in Parquet, so Spark, which judges by files, would
broadcast through the driver what has no room there. Joins of steps are shuffled instead.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join by shuffle, however small its files are: for sides that grow with the input."""
    return df.hint("merge")


class Steps:
    """A fresh folder under ``spark.checkpoint.dir``; a local temporary folder only where that is unset and Spark is local."""

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = "file://" + tempfile.mkdtemp(prefix="spark-")
        self.spark, self.n = spark, 0
        self.path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame) -> DataFrame:
        """``df``, written as the next step and read from its files, which the next join doesn't broadcast."""
        self.n += 1
        at = f"{self.path}/{self.n}"
        df.write.parquet(at)
        return shuffled(self.spark.read.schema(df.schema).parquet(at))
