"""Similar pairs: exact search of vectors in blocks, and an exact similarity join of sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a side in one cell of the vector search.
BLOCK = 2048


def _cell(least: float):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = {"id": [], "other": [], "cosine": []}
        if len(queries) and len(rows):
            q, r = (np.stack([np.asarray(v, dtype=np.float64) for v in x]) for x in (queries["q_vector"], rows["r_vector"]))
            ids, others = queries["q_id"].to_numpy(), rows["r_id"].to_numpy()
            length = lambda x: np.maximum(np.linalg.norm(x, axis=1), 1e-300)
            cosine = (q @ r.T) / length(q)[:, None] / length(r)[None, :]
            a, b = np.nonzero((cosine >= least) & (ids[:, None] != others[None, :]))
            found = {"id": ids[a], "other": others[b], "cosine": cosine[a, b]}
        return pd.DataFrame(found).astype({"id": "int64", "other": "int64", "cosine": "float64"})

    return run


def vector_search(queries: DataFrame, rows: DataFrame, least: float) -> DataFrame:
    """(id, other, cosine) of each query's rows of its label with a cosine of ``least`` or more; both have (label, id,
    vector), ids are unique, and a row isn't its own neighbour.

    Exact: both sides are cut into blocks by a hash of the id, and each pair of a query block and a row block of a label
    is one cell of bounded size, so no label, however common, is one task's. Vectors of zeros are near nothing (cosine
    0); rows without a label or vector meet none.
    """
    queries, rows = (x.where("label is not null and vector is not null").select("label", "id", "vector") for x in (queries, rows))
    blocks = lambda x, name: x.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    sizes = blocks(queries, "nq").join(blocks(rows, "nr"), "label")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    named = lambda c: [F.col(x).alias(f"{c}_{x}") for x in ("label", "id", "vector")]
    q = queries.join(sizes, "label").select(*named("q"), block("nq").alias("qx"), every("nr").alias("qy"))
    r = rows.join(sizes, "label").select(*named("r"), every("nq").alias("rx"), block("nr").alias("ry"))
    return q.groupBy("q_label", "qx", "qy").cogroup(r.groupBy("r_label", "rx", "ry")).applyInPandas(_cell(least), "id long, other long, cosine double")


def similar_sets(sets: DataFrame, least: float) -> DataFrame:
    """(id, other, similarity), id < other, of all rows (id, items) whose sets of distinct items have a Jaccard
    similarity of ``least`` or more. Equal ids never pair; empty sets meet nothing.

    Exact, by prefix filter: items are ordered by how many sets have them, rarest first; the larger set of a pair looks
    up the first n - ceil(least * n) + 1 of its items among the first n - ceil(2 * least / (1 + least) * n) + 1 of the
    smaller's. Sets move once for the order and only candidates meet.
    """
    rows = sets.where(F.size("items") > 0).select("id", F.size("items").alias("n"), F.explode("items").alias("item"))
    often = rows.groupBy("item").agg(F.count(F.lit(1)).alias("often"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("often", "item"))
    ranked = rows.join(often.where("often > 1"), "item").withColumn("alone", F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("id"))).withColumn("place", place + F.col("alone"))
    first = ranked.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).select("id", "n", "item", (F.col("place") <= F.col("n") - F.ceil(F.col("n") * (2 * least / (1 + least)) - 1e-9) + 1).alias("leads"))
    small = first.where("leads").select(F.col("id").alias("b"), F.col("n").alias("nb"), "item")
    met = first.select(F.col("id").alias("a"), F.col("n").alias("na"), "item").join(small, "item").where("a <> b and na >= nb").where(F.col("nb") >= F.col("na") * least - 1e-9)
    pairs = met.select(F.least("a", "b").alias("id"), F.greatest("a", "b").alias("other")).distinct()
    whole = sets.select("id", "items")
    both = pairs.join(whole, "id").join(whole.select(F.col("id").alias("other"), F.col("items").alias("more")), "other")
    shared = F.size(F.array_intersect("items", "more"))
    return both.select("id", "other", (shared / (F.size("items") + F.size("more") - shared)).alias("similarity")).where(F.col("similarity") >= least)
