"""Centroid clustering by delta Lloyd rounds.

Assignments (owner, distance) are persisted beside the vectors, and the sums of all clusters are kept as exact integers.
A round compares each vector with the centroids that changed only: while its owner stands still or came no farther from
it, no unchanged centroid can have become the nearest. A vector whose owner moved away meets all of them. What a round
moves is summed as signed integer transfers (out of the old owner, into the new one), first a batch at a time in the
tasks and then by (cluster, component), and added to the kept sums.

Scale: vectors stay where the scan put them and are never shuffled; a round reads and writes each once. What crosses the
network or reaches the driver are k * (dims + 1) sums, a bound set by the parameters, and copies of one vector are rows
like any others, so there is no hot key. Two tables of a round live at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

#: Scaled components lie inside this, so a squared distance of up to 2**9 components is exact in 64 bits.
MOST = 1 << 26


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def nearest(v: np.ndarray, centroids: np.ndarray, owner: np.ndarray | None = None, dist: np.ndarray | None = None, changed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Owner and squared distance of each vector; given the former ones, only what ``changed`` can alter is compared."""
    away = lambda rows, j: ((rows - centroids[j]) ** 2).sum(axis=1)
    if owner is None:
        best, at = away(v, 0), np.zeros(len(v), dtype=np.int64)
        first, rest = range(1, len(centroids)), ()
        lost = np.zeros(0, dtype=np.int64)
    else:
        best, at = dist.copy(), owner.astype(np.int64)
        moved = np.flatnonzero(changed[at])
        best[moved] = ((v[moved] - centroids[at[moved]]) ** 2).sum(axis=1)
        lost = np.flatnonzero(best > dist)
        first, rest = np.flatnonzero(changed), np.flatnonzero(~changed)
    own = at.copy()
    for which, rows in ((first, None), (rest, lost)):
        some = v if rows is None else v[rows]
        for j in which if len(some) else ():
            d = away(some, j)
            b, a = (best, at) if rows is None else (best[rows], at[rows])
            better = ((d < b) | ((d == b) & (j < a))) & ((own if rows is None else own[rows]) != j)
            where = np.flatnonzero(better) if rows is None else rows[better]
            best[where], at[where] = d[better], j
    return at, best


def _first(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column(1))
                if np.abs(v).max(initial=0) >= MOST:
                    raise ValueError("a scaled component is too large for exact distances in 64 bits")
                at, best = nearest(v, centroids)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int32()), pa.array(best), pa.nulls(len(v), pa.int32())], ["id", "v", "owner", "dist", "was"])

    return run


def _again(centroids: np.ndarray, changed: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at, best = nearest(_matrix(b.column(1)), centroids, b.column(2).to_numpy(), b.column(3).to_numpy(), changed)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int32()), pa.array(best), b.column(2)], ["id", "v", "owner", "dist", "was"])

    return run


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cluster, sums and count) of what a batch's rows (v, owner, was) take out of one cluster and put into another."""
    for b in batches:
        if not b.num_rows:
            continue
        v = _matrix(b.column(0))
        v = np.column_stack([v, np.ones(len(v), dtype=np.int64)])
        into, was = b.column(1).to_numpy(), b.column(2).fill_null(-1).to_numpy()
        clusters = np.union1d(into, was[was >= 0])
        sums = [v[into == c].sum(axis=0) - v[was == c].sum(axis=0) for c in clusters]
        yield pa.RecordBatch.from_arrays([pa.array(clusters, pa.int32()), pa.array([s.tolist() for s in sums], pa.list_(pa.int64()))], ["cluster", "sums"])


def _moved(rows: DataFrame, k: int, dims: int) -> np.ndarray:
    """The signed sums of all moves in ``rows``, k x (dims + 1) Python integers."""
    part = rows.where("was is null or was <> owner").select("v", "owner", "was").mapInArrow(_transfers, "cluster int, sums array<long>")
    total = part.select("cluster", F.posexplode("sums").alias("i", "x")).groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = np.zeros((k, dims + 1), dtype=object)
    for r in total.collect():
        out[r["cluster"], r["i"]] = int(r["x"])
    return out


def delta_lloyd(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, salt: str = "1:") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector with exactly ``dims`` components,
    all finite; other rows (null vectors, other lengths, null or non-finite components) have no row.

    Each component becomes floor(scale * x). Centroids start as the k vectors with the least SHA-256 of ``salt`` and the
    id; of rows that repeat an id the smaller vector comes first, and rows without an id come last of all. With fewer
    than k vectors there are as many centroids. Ties in distance go to the smaller number; a centroid without vectors
    stays. All sums are exact. Scaled components of 2**26 and more are refused, since their distances have no place in a
    long. No vectors give no rows. Other columns are ignored, whatever their names.
    """
    x = F.col(vector_col)
    whole = (F.size(x) == dims) & F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    kept = vectors.where(F.coalesce(whole, F.lit(False))).select(F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int")).alias("v"))
    named = f"{id_col} {vectors.schema[id_col].dataType.simpleString()}"
    order = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256)
    seeds = kept.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    spark = vectors.sparkSession
    if not seeds:
        return spark.createDataFrame([], f"{named}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([s["v"] for s in seeds], dtype=np.int64)
    n = len(centroids)
    scratch = Scratch(spark, "lloyd")
    schema = f"id {vectors.schema[id_col].dataType.simpleString()}, v array<int>, owner int, dist long, was int"
    rows = scratch.save(kept.mapInArrow(_first(centroids), schema), "0")
    sums = _moved(rows, n, dims)
    for step in range(1, rounds + 1):
        new = np.array([[int(s) // int(t[-1]) for s in t[:-1]] if t[-1] else c.tolist() for t, c in zip(sums, centroids, strict=True)], dtype=np.int64)
        changed = (new != centroids).any(axis=1)
        centroids = new
        if not changed.any():
            break
        rows = scratch.save(rows.mapInArrow(_again(centroids, changed), schema), str(step))
        scratch.drop(str(step - 1))
        if step < rounds:
            sums = sums + _moved(rows, n, dims)
    inertia = {r["owner"]: r["d"] for r in rows.groupBy("owner").agg(F.sum("dist").alias("d")).collect()}
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    every = sum(inertia.values())
    clusters = spark.createDataFrame([(j, d, every, text[j]) for j, d in sorted(inertia.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = rows.select(F.col("id").alias(id_col), F.col("owner").alias("cluster"), F.col("dist").alias("distance"))
    return out.join(F.broadcast(clusters), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_delta_lloyd(spark, sf_dir: str) -> DataFrame:
    """The contract's query: 16 centroids and 3 rounds over all embeddings of 64 components."""
    return delta_lloyd(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
