"""Connected components of a link table as a Spark loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``links`` (a, b) to (id, component), the smallest id reachable; ids without a link don't appear.

    Each round gives a node the least label among itself and its neighbours, then the label of that label, so a chain
    shortens by a constant factor a round. Links and labels stay in tables of the shared folder; the driver sees only
    whether a round changed anything. Links of a hot node are narrow rows, which the adaptive skew join splits, and the
    minimum is combined before its shuffle. No links give no rows.
    """
    both = scratch.save(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).where("u <> v").distinct(), f"{name}_links"
    )
    label = scratch.save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("l")), f"{name}_0")
    step = 0
    while True:
        step += 1
        near = both.join(label.withColumnRenamed("u", "v"), "v").select("u", "l")
        least = near.unionByName(label).groupBy("u").agg(F.min("l").alias("l"))
        jump = label.select(F.col("u").alias("l"), F.col("l").alias("to"))
        new = least.join(jump, "l", "left").select("u", F.least("l", F.coalesce("to", "l")).alias("l"))
        new = scratch.save(new, f"{name}_{step}")
        changed = new.join(label.withColumnRenamed("l", "was"), "u").where("l <> was").limit(1).count()
        if step > 1:
            scratch.drop(f"{name}_{step - 2}")
        label = new
        if not changed:
            return label.select(F.col("u").alias("id"), F.col("l").alias("component"))
