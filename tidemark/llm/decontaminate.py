"""Benchmark decontamination with suffix arrays of the training text.

Each task cuts its documents into shards of bounded size and builds the suffix array of each shard's words: suffixes
are ranked by prefix doubling, and only those whose prefix is still shared are ranked further, up to the length of the
longest benchmark item. Every suffix of every benchmark item is then binary-searched in the shard, one word deeper at a
time, which yields its longest verbatim match and all the places where it occurs; occurrences of a whole window mark
the words that they cover.

Scale: documents never move; a shard is about as long as the benchmark block that is searched in it, between
``SHARD_BYTES`` and ``MOST_SHARD_BYTES`` (a longer document is one shard), whatever its source or copies. The benchmark is the query set, sent to the tasks in blocks of about ``BLOCK_BYTES`` of text. The
driver holds one block and the next, whatever the benchmark's size; with several blocks the documents are scanned once a
block, what a block finds is written, and the covered spans are merged by row.

Words are compared as 64-bit hashes, so two different words count as one with a probability of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.located import located
from tidemark.llm.scratch import Scratch, arrow_rows, give_back

#: A task holds about twenty times its shard's bytes, and the suffixes of the benchmark are searched once a shard: shards
#: are small unless the benchmark is large.
SHARD_BYTES = 2 << 20
MOST_SHARD_BYTES = 6 << 20
BLOCK_BYTES = 16 << 20
#: Rows of an Arrow batch of the stage; a row has a text.
ROWS_A_BATCH = 1000
WINDOW = 10
#: Names of items that an output batch holds, about.
NAMES = 200_000


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``tokens`` (uint64) in the order of their suffixes, compared over at least ``depth`` tokens."""
    n = len(tokens)
    order = np.argsort(tokens)
    rank = np.empty(n, dtype=np.int64)
    run = np.empty(n, dtype=bool)  # in sorted order: a suffix starts a new group
    run[:1] = True
    run[1:] = tokens[order[1:]] != tokens[order[:-1]]
    first = np.flatnonzero(run)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))  # a group's rank is its first place
    length = 1
    while length < depth:
        open_ = ~(run & np.append(run[1:], True))  # in groups of two or more
        places = np.flatnonzero(open_)
        if not len(places):
            break
        at = order[places]
        nxt = at + length
        key = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0)
        group = rank[at]
        sub = np.argsort(group * np.int64(n + 1) + key)
        at, group, key = at[sub], group[sub], key[sub]
        order[places] = at
        new = np.empty(len(at), dtype=bool)
        new[:1] = True
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        run[places] = new
        begins = places[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        rank[at] = begins
        length *= 2
    return order


def narrowed(tokens: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, offset: int, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each range [lo, hi) of suffixes, the part whose token at ``offset`` equals ``want``: two binary searches."""
    n = len(tokens)
    ends = []
    for right in (False, True):
        a, b = lo.copy(), hi.copy()
        while True:
            live = a < b
            if not live.any():
                break
            mid = (a + b) >> 1
            at = order[np.minimum(mid, n - 1)] + offset
            got = np.where(at < n, tokens[np.minimum(at, n - 1)], 0)
            less = live & ((got <= want) & (at < n) if right else (got < want) | (at >= n))
            if right:
                less |= live & (at >= n)
            a = np.where(less, mid + 1, a)
            b = np.where(live & ~less, mid, b)
        ends.append(a)
    return ends[0], ends[1]


class Queries:
    """All suffixes of a block of benchmark items as word hashes."""

    def __init__(self, ids: list, texts: list[str | None], window: int):
        raw, offsets = words.buffer_of(pa.array(texts, pa.large_string()))
        h, _, _, at = words.hashes(raw, offsets, words.ALNUM)
        self.bytes = len(raw)
        self.tokens = np.where(h == 0, 1, h)
        size = np.diff(at).astype(np.int32)
        self.item = np.repeat(np.arange(len(ids), dtype=np.int32), size)
        place = (np.arange(len(h)) - at[self.item]).astype(np.int32)
        self.left = size[self.item] - place
        # a suffix that starts a window: ten more words, or a shorter item from its first word on
        self.needed = np.minimum(window, size[self.item]).astype(np.int32)
        self.starts = self.left >= self.needed
        # equal windows are one: its number at each suffix that starts it, and its items
        self.window = np.full(len(h), -1, dtype=np.int64)
        key = np.zeros(len(h), dtype=np.uint64)
        for n in np.unique(self.needed[self.starts]).tolist():
            at_n = np.flatnonzero(self.starts & (self.needed == n))
            key[at_n] = words.sequences(self.tokens, n)[at_n]
        begins = np.flatnonzero(self.starts)
        _, self.window[begins] = np.unique(key[begins], return_inverse=True)
        pairs = np.unique(np.stack([self.window[begins], self.item[begins]], axis=1), axis=0) if len(begins) else np.zeros((0, 2), dtype=np.int64)
        self.items = pairs[:, 1]
        self.items_of = np.searchsorted(pairs[:, 0], np.arange(self.window.max(initial=-1) + 2))
        self.depth = int(size.max(initial=1))
        self.ids = ids


def search(tokens: np.ndarray, q: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Binary-search every suffix of ``q`` in the suffix array of ``tokens``.

    Returns occurrences of distinct windows (position, length, window) and, of each suffix with a match, (its index, match
    length, first place, last place) of its longest one, with the array itself.
    """
    order = suffix_array(tokens, q.depth)
    live = np.arange(len(q.tokens))
    lo, hi = np.zeros(len(live), dtype=np.int64), np.full(len(live), len(tokens), dtype=np.int64)
    where, length, window, best = [], [], [], []
    offset = 0
    while len(live):
        a, b = narrowed(tokens, order, lo, hi, offset, q.tokens[live + offset])
        ended = a >= b
        if offset:
            best.append((live[ended], np.full(ended.sum(), offset), lo[ended], hi[ended]))
        live, lo, hi = live[~ended], a[~ended], b[~ended]
        offset += 1
        full = np.flatnonzero(q.starts[live] & (q.needed[live] == offset))
        _, first = np.unique(q.window[live[full]], return_index=True)  # all suffixes with a window have its places
        for i in full[first]:
            where.append(order[lo[i] : hi[i]])
            length.append(np.full(hi[i] - lo[i], offset))
            window.append(np.full(hi[i] - lo[i], q.window[live[i]]))
        done = q.left[live] == offset
        best.append((live[done], np.full(done.sum(), offset), lo[done], hi[done]))
        live, lo, hi = live[~done], lo[~done], hi[~done]
    cat = lambda x, kind=np.int64: np.concatenate(x).astype(kind) if x else np.zeros(0, dtype=kind)
    return cat(where), cat(length), cat(window), (*(cat([x[i] for x in best]) for i in range(4)), order)


def _shards(offsets: np.ndarray, q: Queries) -> Iterator[tuple[int, int]]:
    return words.blocks(offsets, max(SHARD_BYTES, min(q.bytes, MOST_SHARD_BYTES)))


def _found(column: pa.Array, q: Queries) -> Iterator[tuple[int, int, np.ndarray, tuple]]:
    """Of each shard of a text column: its first row, rows, hit words of each, and what ``matches`` tells of them, with
    windows in the place of items. What it holds grows with the shard's words and places of distinct windows, however
    many items have them."""
    raw, offsets = words.buffer_of(column)
    for lo, hi in _shards(offsets, q):
        part = offsets[lo : hi + 1]
        h, _, _, at = words.hashes(raw[part[0] : part[-1]], part - part[0], words.ALNUM)
        rows = hi - lo
        # a zero, which no word has, stands after each document
        tokens = np.insert(np.where(h == 0, 1, h), at[1:], 0).astype(np.uint64)
        begin = at[:-1] + np.arange(rows)
        where, length, window, (suffix, longest, first, last, order) = search(tokens, q)
        cover = np.zeros(len(tokens) + 1, dtype=np.int64)
        np.add.at(cover, where, 1)
        np.add.at(cover, where + length, -1)
        covered = np.cumsum(cover)[:-1] > 0
        hit = np.append(0, np.cumsum(covered))
        edges = np.append(begin, len(tokens))
        n_hit = hit[edges[1:]] - hit[edges[:-1]]
        doc = np.searchsorted(begin, where, side="right") - 1
        pairs = np.unique(np.stack([doc, window], axis=1), axis=0) if len(doc) else np.zeros((0, 2), dtype=np.int64)
        cut = np.searchsorted(pairs[:, 0], np.arange(rows + 1))
        # longest match of a document with any suffix, and where: only suffixes that reach a window are told, and of
        # those that match the same words the first
        told = np.flatnonzero(longest >= q.needed[suffix])
        told = told[np.argsort(suffix[told], kind="stable")]
        _, one = np.unique(np.stack([first[told], longest[told]], axis=1), axis=0, return_index=True)
        told = told[one]
        many = (last - first)[told]
        spread = np.repeat(told, many)
        place = order[first[spread] + np.arange(len(spread)) - np.repeat(np.cumsum(many) - many, many)]
        owner = np.searchsorted(begin, place, side="right") - 1
        best, best_at, best_item = np.zeros(rows, dtype=np.int64), np.full(rows, -1), np.full(rows, -1)
        rank = np.lexsort((place, -longest[spread], owner))
        lead = rank[np.append(True, owner[rank][1:] != owner[rank][:-1])] if len(rank) else rank
        best[owner[lead]], best_at[owner[lead]], best_item[owner[lead]] = longest[spread[lead]], place[lead] - begin[owner[lead]], q.item[suffix[spread[lead]]]
        spans = [[] for _ in range(rows)]
        for d in np.flatnonzero(n_hit):
            mine = covered[edges[d] : edges[d + 1]].astype(np.int8)
            spans[d] = np.flatnonzero(np.diff(np.concatenate(([0], mine, [0])))).tolist()
        yield lo, rows, n_hit, (np.diff(at).astype(np.int64), spans, [pairs[cut[i] : cut[i + 1], 1] for i in range(rows)], best, best_at, best_item)


def _names(q: Queries, windows: np.ndarray) -> list[str]:
    """The items of some windows, sorted as text; an item without an id has no name."""
    items = {int(i) for w in windows for i in q.items[q.items_of[w] : q.items_of[w + 1]]}
    return sorted({str(q.ids[i]) for i in items if q.ids[i] is not None})


def _scan(q: Queries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, rows, _, (n_words, spans, windows, best, best_at, best_item) in _found(batch.column(1), q):
                held: tuple[bytes, list[str]] = (b"", [])
                names, n, start = [], 0, 0
                for i in range(rows):
                    if (key := windows[i].tobytes()) != held[0]:  # documents with the same windows often stand together
                        held = (key, _names(q, windows[i]))
                    names.append(held[1])
                    n += len(held[1])
                    if n >= NAMES or i == rows - 1:  # a batch holds about so many names at most
                        part = slice(start, i + 1)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).slice(lo + start, i + 1 - start), pa.array(n_words[part]), pa.array(spans[part], pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string())), pa.array(best[part]),
                             pa.array([int(x) if x >= 0 else None for x in best_at[part]], pa.int64()), pa.array([str(q.ids[x]) if x >= 0 and q.ids[x] is not None else None for x in best_item[part]], pa.string())],
                            ["id", "n_words", "spans", "items", "longest", "longest_at", "longest_item"],
                        )
                        names, n, start = [], 0, i + 1

    return run


def _clean(q: Queries, text_at: int):
    """The rows without any hit word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, rows, n_hit, _ in _found(batch.column(text_at), q):
                yield batch.slice(lo, rows).filter(pa.array(n_hit == 0))
        give_back()

    return run


_SCHEMA = "id {}, n_words long, spans array<long>, items array<string>, longest long, longest_at long, longest_item string"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of bounded size, one at a time on the driver; one empty block if it has no texts."""
    ids, texts, size, none = [], [], 0, True
    for row in benchmark.select(item_col, text_col).where(F.col(text_col).isNotNull()).orderBy(item_col).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += 4 * len(row[1])
        if size >= block_bytes:
            yield ids, texts
            ids, texts, size, none = [], [], 0, False
    if none or ids:
        yield ids, texts


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each row of ``docs``: id, n_words, spans (covered words as [start, end) in flat pairs), items (sorted), and
    the longest match with a benchmark suffix: its length, word place and item (null without one).

    Words are runs of ASCII letters and digits (A-Z as a-z) and non-ASCII characters. A window is ``window`` words of an
    item in a row, or all words of a shorter item. Null and empty texts have no words; items without words never match.
    An empty benchmark matches nothing. Repeated items count once by their id; an item without an id hits words as any
    other but isn't among the items. Of several items with the longest match the first in order is named. Rows that repeat an id, or have none,
    come back each; with several benchmark blocks they are told apart by their places in files. Other columns of both
    tables are ignored.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return docs.mapInArrow(_scan(Queries(*first, window)), _SCHEMA.format(kind))
    scratch = Scratch(docs.sparkSession, "decontaminate")
    docs, file, at = located(docs, scratch)
    keyed = docs.select(F.struct(F.col(file).alias("file"), F.col(at).alias("at"), "id").alias("id"), "text")
    rows = None
    for number, block in enumerate(chain((first, second), blocks)):
        part = keyed.mapInArrow(_scan(Queries(*block, window)), _SCHEMA.format(f"struct<file: string, at: long, id: {kind}>"))
        part = scratch.save(part.where("longest > 0") if number else part, f"block_{number}")  # all rows once, then those with a window
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("id").agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max(F.struct("longest", "longest_at", "longest_item")).alias("m"),
    ).mapInArrow(_merged, _SCHEMA.format(kind))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unite the spans that the blocks found; one document at a time."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            pairs, out = sorted(zip(r["spans"][::2], r["spans"][1::2], strict=True)), []
            for a, b in pairs:
                if out and a <= out[-1]:
                    out[-1] = max(out[-1], b)
                else:
                    out += [a, b]
            r["spans"] = out
        kind = batch.schema.field("id").type.field("id").type
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["id"]["id"] for r in rows], kind), *(pa.array([r[c] for r in rows], t) for c, t in (("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string())))),
             *(pa.array([r["m"][c] for r in rows], t) for c, t in (("longest", pa.int64()), ("longest_at", pa.int64()), ("longest_item", pa.string())))],
            ["id", "n_words", "spans", "items", "longest", "longest_at", "longest_item"],
        )


def op8_suffix_array_decontamination(spark, sf_dir: str) -> DataFrame:
    """The contract's digest columns of ``matches``; items are sorted as strings."""
    found = matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.expr("aggregate(spans, 0L, (s, x) -> x - s)")  # ends minus starts: alternating signs over flat pairs
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove the rows with any benchmark window; the rest, rows without an id or text among them, stay.

    Each row is judged in the scan and goes on or not, so none is looked up by an id or a place. With several benchmark
    blocks a scan takes what the one before has left. What is left is written here, since the size of batches to the
    workers is a setting of the moment in which it is.
    """
    scratch = Scratch(spark, "decontaminate")
    for number, block in enumerate(_blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "item_id", "text", BLOCK_BYTES)):
        with arrow_rows(spark, ROWS_A_BATCH):
            docs = scratch.save(docs.mapInArrow(_clean(Queries(*block, WINDOW), docs.columns.index("text")), docs.schema), f"left_{number}")
        if number:
            scratch.drop(f"left_{number - 1}")
    return docs
