"""Variable-capacity best-fit packing.

Documents, cut where they exceed the largest sequence length, go into sequences of several permitted lengths. Within a
shard pieces are placed longest first into the open bin with the least room that still holds them. Where no bin does,
the size to open is chosen jointly over all permitted ones: for each, the pieces still to come that would fill it are
looked up until it is full or none fits (run by run of equal pieces), and the size with the least cost for each token it
would carry is opened. At the end every bin is downsized
to the least permitted length that holds its contents. A bin costs ``overhead + size + size**2 / attention``.

Scale: only (id, length) rows are shuffled, into shards of about ``SHARD`` pieces by a hash of the row, which no key or
source can skew; a shard is one group of bounded size.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bitplanes, words
from tidemark.llm.scratch import Scratch, arrow_rows

SIZES = (512, 1024, 2048, 4096, 8192)
OVERHEAD, ATTENTION = 32.0, 32768.0
SHARD = 16_384
#: Of the query and the stage.
TOKENIZER = "byte_bpe_50k.json"
#: Encoded pieces that a worker of the stage remembers.
REMEMBERED = 100_000


def cost(size: int) -> float:
    return OVERHEAD + size + size * size / ATTENTION


def pack(lengths: list[int], sizes: tuple[int, ...] = SIZES) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and each bin's size, for ``lengths`` in descending order."""
    ascending = lengths[::-1]
    n = len(lengths)
    open_: dict[int, list[int]] = {}  # room left: bins
    rooms: list[int] = []  # the keys of open_, sorted
    where, offset, room, opened = [0] * n, [0] * n, [], []
    for i, length in enumerate(lengths):
        k = bisect_left(rooms, length)
        if k < len(rooms):
            left = rooms[k]
            b = open_[left].pop()
            if not open_[left]:
                del open_[left]
                rooms.pop(k)
        else:
            best = None
            for size in sizes:
                if size < length:
                    continue
                left, upto = size - length, n - i - 1  # ascending[:upto] are still to come
                while upto := bisect_right(ascending, left, 0, upto):
                    piece = ascending[upto - 1]
                    take = min(left // piece, upto - bisect_left(ascending, piece, 0, upto))  # of the run of equal pieces
                    left -= take * piece
                    upto -= take
                rate = cost(size) / max(size - left, 1)
                if best is None or rate < best[0]:
                    best = (rate, size)
            left, b = best[1], len(opened)
            opened.append(best[1])
            room.append(left)
        where[i], offset[i] = b, opened[b] - left
        room[b] = left - length
        if room[b]:
            if room[b] not in open_:
                insort(rooms, room[b])
            open_.setdefault(room[b], []).append(b)
    final = [next(s for s in sizes if s >= size - left) for size, left in zip(opened, room, strict=True)]
    return where, offset, final


def _packed(sizes: tuple[int, ...]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        where, offset, final = pack(group["length"].tolist(), sizes)
        where = np.array(where, dtype=np.int64)
        return pd.DataFrame({
            "id": group["id"], "piece": group["piece"], "start": group["start"], "length": group["length"],
            "bin_id": group["shard"].to_numpy() * np.int64(2**32) + where, "bin_size": np.array(final, dtype=np.int64)[where], "bin_offset": np.array(offset, dtype=np.int64),
        })

    return run


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text, and one for the end of the document."""
    for batch in batches:
        raw, offsets = words.buffer_of(batch.column(1))
        n = np.zeros(len(offsets) - 1, dtype=np.int64)
        for lo, hi in words.blocks(offsets):
            part = raw[offsets[lo] : offsets[hi]]
            inside = words.NON_SPACE[part]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            at = offsets[lo:hi] - offsets[lo]
            at = at[at < len(part)]
            first[at] = inside[at]
            total = np.append(0, np.cumsum(first))
            n[lo:hi] = np.diff(total[offsets[lo : hi + 1] - offsets[lo]])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n + 1)], ["id", "n"])


def _token_lengths(path: str, remembered: int):
    """Token ids of each text by the tokenizer file at ``path``, and one for the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(ids) + 1 for ids in bitplanes.encode(batch.column(1), path, remembered)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["id", "n"])
        bitplanes.forget()  # the worker goes on to other work

    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: str | None = None, sizes: tuple[int, ...] = SIZES, tokenizer: str | None = None, remembered: int = bitplanes.CACHE) -> DataFrame:
    """One row a piece: id, piece, start (in the document), length, bin_id, bin_size, bin_offset (in the bin).

    A document's length is column ``length``, or its token ids by the file ``tokenizer`` plus one for the end id, or
    without either its white-space words plus one for its end, so null and empty texts are pieces of length one. Sizes
    are in the same unit: where they are sequence lengths of a model, only the first two make them hold. Longer documents than the largest size are cut into pieces of that size and
    a rest. Pieces of a bin don't overlap and fit its size; every token is in one piece. Documents of length null or
    below one have no piece. Repeated rows are packed each. Other columns are ignored. bin_id is unique in the result.
    A worker remembers at most ``remembered`` encoded pieces of text.
    Rows are dealt to shards by their places in the input, so other partitions of the same rows can give other bins.
    """
    sizes = tuple(sorted(sizes))
    scratch = Scratch(docs.sparkSession, "packing")
    kind = docs.schema[id_col].dataType.simpleString()
    if length:
        counted = docs.select(F.col(id_col).alias("id"), F.col(length).cast("long").alias("n"))
    else:
        counted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_token_lengths(tokenizer, remembered) if tokenizer else _lengths, f"id {kind}, n long")
    with arrow_rows(docs.sparkSession, bitplanes.ROWS_A_BATCH):
        counted = scratch.save(counted.where("n >= 1").withColumn("row", F.monotonically_increasing_id()), "lengths")
    most = sizes[-1]
    pieces = counted.select("id", "n", "row", F.explode(F.expr(f"sequence(0L, (n - 1) div {most})")).alias("piece"))
    pieces = pieces.select("id", "row", "piece", (F.col("piece") * most).alias("start"), F.least(F.lit(most).cast("long"), F.col("n") - F.col("piece") * most).alias("length"))
    total = counted.agg(F.sum(F.expr(f"(n - 1) div {most} + 1"))).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    return pieces.groupBy("shard").applyInPandas(
        _packed(sizes), f"id {kind}, piece long, start long, length long, bin_id long, bin_size long, bin_offset long"
    ).withColumnRenamed("id", id_col)


def op9_variable_best_fit(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, measured in token ids by ``TOKENIZER`` plus the end id."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer=public_tokenizers.path(TOKENIZER))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all that the stages before have kept, measured in token ids by ``TOKENIZER`` plus the end id.

    Workers remember fewer pieces than in ``op9``: the executor's heap is as large as the stages before have made it.
    """
    import public_tokenizers

    return pack_documents(docs, tokenizer=public_tokenizers.path(TOKENIZER), remembered=REMEMBERED)
