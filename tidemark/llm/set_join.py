"""N-gram Jaccard join by prefixes of token combinations.

A token is a shingle of k words. All sets order their tokens alike: by how often the corpus has them, rare ones first,
counted for all documents in a table of fixed size, so that tokens share counters; the order costs time where it is
bad, never a link. Two sets of which the larger has n tokens and that are similar enough share at least percent / 100 * n of them,
so they share one among the first n - o + 1 (prefix filter). Documents are indexed by the tokens of that prefix.

Rare tokens index alone: the members of their buckets are compared. Where a bucket holds many members that aren't of one
component yet, its token is of a frequent class, and its members are indexed by combinations of it with a second token,
a third and so on. With each, the prefix is taken anew in the order of frequency among the bucket's members, which
extends it to what tells them apart, until a bucket is small or all of one component (``near_dedup.combined``).

Comparing: equal sets are one representative. First each document meets the one document that leads most of its
buckets, which joins groups of copies of any size at a row a member. After that only buckets with several components
count, one of those that have the same members, in cells of two blocks. A cell first drops members that no other can
be similar to, by size and by parity bits: a bit per hash bucket tells whether an odd number of tokens fell into it, so two
sets differ in at least as many tokens as bits. That filter loses nothing. The rest is verified on full sets.

Scale: no row holds more than one set, no bucket is one task's, a prefix is 100 - percent parts of a hundred of a set,
and nothing grows with the square of a group's size but cells, which ``combined`` bounds. Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import near_dedup as nd
from tidemark.llm import words
from tidemark.llm.components import components
from tidemark.llm.located import integer_ids, located
from tidemark.llm.scratch import Scratch, arrow_rows

#: Counters of the table that orders tokens, and the pieces in which it is summed.
COUNTERS, SLICES = 1 << 18, 64
#: Bits of the map that tells which tokens may be in several prefixes; it is of fixed size, in slices.
MARKS = 1 << 26
#: Bits of a parity signature, by the set's size between these.
LEAST_BITS, MOST_BITS = 512, 8192


def counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(46)).astype(np.int64) % COUNTERS


def _sets_of(batch: pa.RecordBatch, column: int, k: int) -> Iterator[tuple[int, np.ndarray]]:
    raw, offsets = words.buffer_of(batch.column(column))
    for lo, hi in words.blocks(offsets):
        part = offsets[lo : hi + 1]
        h, _, _, at = words.hashes(raw[part[0] : part[-1]], part - part[0], words.NON_SPACE)
        for i in range(hi - lo):
            yield lo + i, nd.shingles(h[at[i] : at[i + 1]], k)


def _counts(k: int):
    """The counters of a task's sets, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            held, n = [], 0
            for _, found in _sets_of(batch, 0, k):
                held.append(counter(found))
                n += len(found)
                if n > COUNTERS:
                    total += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held, n = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=COUNTERS)
        if total.any():
            pieces = total.astype("<u8").reshape(SLICES, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())], ["slice", "counts"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(counts.as_buffer(), dtype="<u8")
            total[s] = total[s] + x if s in total else x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["slice", "counts"])


def frequencies(docs: DataFrame, k: int) -> np.ndarray:
    """How many sets of all ``docs`` (text) have tokens of each counter; a table of fixed size."""
    rows = docs.select("text").mapInArrow(_counts(k), "slice int, counts binary").repartition(SLICES, "slice").mapInArrow(_summed, "slice int, counts binary")
    out = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.uint64)
    for r in rows.collect():
        out[r["slice"]] = np.frombuffer(r["counts"], dtype="<u8")
    return out.ravel()


def n_bits(n: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(n // 2 - 1, 0).bit_length()))


def parity(tokens: np.ndarray, bits: int) -> np.ndarray:
    odd = np.bincount(((tokens >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def folded(signature: np.ndarray, size: int) -> np.ndarray:
    """A signature (the last axis) of fewer bytes: bits that fall together are added modulo 2."""
    while signature.shape[-1] > size:
        half = signature.shape[-1] // 2
        signature = signature[..., :half] ^ signature[..., half:]
    return signature


def _sketch(k: int, percent: int, often: np.ndarray):
    """Sizes, sums over the set that tell equal sets, prefixes in the common order, and parity bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, high, low, first, bits = [], [], [], [], []
            for _, found in _sets_of(batch, 1, k):
                n.append(len(found))
                high.append(found.sum(dtype=np.uint64).astype(np.int64))
                low.append(words.mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
                if not len(found):
                    first.append(None)
                    bits.append(None)
                    continue
                order = np.lexsort((found, often[counter(found)]))
                first.append(found[order[: len(found) + percent * len(found) // -100 + 1]].tobytes())
                bits.append(parity(found, n_bits(len(found))).tobytes())
            own = [batch.column(c) for c in (0, 2, 3)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(first, pa.binary()), pa.array(bits, pa.binary())], ["id", "file", "at", "n", "high", "low", "first", "bits"])

    return run


def _first_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of the prefixes (first)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.int64))], ["key"])


def _bit(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) >> np.uint64(8)).astype(np.int64) % MARKS


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices of the map of the keys (slice, key)."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        which, bit = batch.column(0).to_numpy(), _bit(batch.column(1).to_numpy()) % (MARKS // SLICES)
        for s in np.unique(which).tolist():
            held.setdefault(s, np.zeros(MARKS // SLICES, dtype=bool))[bit[which == s]] = True
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())], ["slice", "bits"])


def marks(keys: DataFrame) -> np.ndarray:
    """The map of ``keys`` (key): a bit that isn't set tells that no key has it."""
    bit = F.pmod(F.shiftrightunsigned("key", 8), F.lit(MARKS))
    rows = keys.select(F.floor(bit / (MARKS // SLICES)).cast("int").alias("slice"), "key").repartition(SLICES, "slice").mapInArrow(_slices, "slice int, bits binary")
    out = np.zeros((SLICES, MARKS // SLICES // 8), dtype=np.uint8)
    for r in rows.collect():
        out[r["slice"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.ravel()


def _tokens(percent: int, marked: np.ndarray):
    """(key, id, n, lead, place) of the prefixes (id, n, first), without tokens that are not in ``marked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in batch.column(2)]
            size, keys = np.array([len(x) for x in first]), np.concatenate(first)
            at = np.repeat(np.arange(len(first)), size)
            place = np.arange(len(at)) - np.repeat(np.append(0, np.cumsum(size)[:-1]), size)
            bit = _bit(keys)
            kept = np.flatnonzero(marked[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            keys, at, place = keys[kept], at[kept], place[kept]
            n = batch.column(1).to_numpy().astype(np.int64)
            leading = n + 2 * percent * n // -(100 + percent) + 1
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(place < leading[at]), pa.array(place, pa.int32())], ["key", "id", "n", "lead", "place"])

    return run


def _possible(percent: int):
    """The members of a cell that may be similar to one of another component, by sizes and parity bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in nd._groups(batches):
            c = rows["c"].to_numpy()
            if (c == c[0]).all():
                continue
            n = rows["n"].to_numpy().astype(np.int64)
            signs = [np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in rows["bits"]]
            width = np.array([len(s) for s in signs])
            # at each width, the signatures of at least that width
            level = {w: np.stack([folded(s, w) if len(s) >= w else np.zeros(w, np.uint8) for s in signs]).view(np.uint64) for w in np.unique(width).tolist()}
            keep = np.zeros(len(n), dtype=bool)
            for i in range(len(n) - 1):
                rest = slice(i + 1, None)
                close = (c[rest] != c[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
                at = i + 1 + np.flatnonzero(close)
                at = at[~(keep[at] & keep[i])]
                for w, sign in level.items():
                    which = at[np.minimum(width[at], width[i]) == w]
                    if len(which):
                        both = n[i] + n[which]
                        most = both + 2 * (percent * both // -(100 + percent))
                        near = which[np.bitwise_count(sign[which] ^ sign[i]).sum(axis=1, dtype=np.int64) <= most]
                        keep[near] = True
                        keep[i] |= len(near) > 0
            if keep.any():
                yield rows.select(["key", "id"]).filter(pa.array(keep)).combine_chunks().to_batches()[0]

    return run


def _links(rows: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Confirmed links (a, b) between components of rows (key, id, n, c, lead): each leading member of a key is compared with
    all its members."""
    dealt = nd.cells(rows).join(classes.select("id", "bits"), "id")
    likely = scratch.save(nd.by_cell(dealt).mapInArrow(_possible(percent), "key long, id long").distinct(), f"{name}_possible")
    sets = nd._full_sets(likely.select("id"), classes, docs, k, scratch, name)
    # what is left of several keys is often the same few members, which are compared once
    left = rows.join(likely, ["key", "id"], "left_semi").select("key", "id", "n", "c", F.lit(True).alias("lead"), F.lit(0).alias("place"), F.lit(False).alias("whole"), F.col("key").alias("old"))
    left = scratch.save(left, f"{name}_left")
    left = left.join(nd.distinct_mixed(left), "key").select("key", "id", "c", (F.col("c") != F.col("top")).alias("lead"))
    dealt = nd.cells(left).join(sets, "id")
    out = scratch.save(nd.by_cell(dealt).mapInArrow(nd._joined(percent), "a long, b long").distinct(), f"{name}_links")
    scratch.drop(f"{name}_sets")
    return out


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) for each row of ``docs``.

    Two rows are linked when 100 * |A & B| >= percent * |A | B| over their sets of distinct ``k``-word shingles of the
    ASCII-lower-cased text; a text of fewer words has its whole sequence as the one shingle. component_id is the least
    id reachable over links, itself included. Null, empty and blank texts have no shingles and no links. Each row is a
    node: an id on two texts doesn't link them. A row without an id is linked like any other; a group of such rows alone
    has a null component_id. The id is an integer column; other types are refused. Other columns are ignored.
    """
    integer_ids(docs, id_col)
    with arrow_rows(docs.sparkSession, nd.ROWS_A_BATCH):
        return _joined(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), id_col, k, percent)


def _joined(docs: DataFrame, id_col: str, k: int, percent: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "join")
    docs, file, at = located(docs, scratch)
    docs = docs.select("id", "text", F.col(file).alias("file"), F.col(at).alias("at"))
    often = frequencies(docs, k)
    sketch = docs.mapInArrow(_sketch(k, percent, often), "id long, file string, at long, n long, high long, low long, first binary, bits binary")
    sketch = scratch.save(sketch.withColumn("row", F.monotonically_increasing_id()), "sketch")
    named = F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("named")
    classes = sketch.where("n > 0").select("high", "low", "n", named, "first", "bits", "file", "at").groupBy("high", "low", "n")
    classes = classes.agg(F.min("named").alias("named"), F.min_by(F.struct("first", "bits", "file", "at"), "named").alias("x"))
    classes = scratch.save(classes.select("high", "low", F.col("n").cast("int").alias("n"), "named", F.col("named.row").alias("id"), "x.*"), "classes")

    # the index: tokens of prefixes that several documents have, and who leads their buckets
    several = scratch.save(classes.select("first").mapInArrow(_first_tokens, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key"), "several")
    tokens = classes.select("id", "n", "first").mapInArrow(_tokens(percent, marks(several)), "key long, id long, n int, lead boolean, place int")
    index = scratch.save(tokens.join(several, "key", "left_semi"), "index")
    rank = F.min(F.struct(F.xxhash64("id"), "id"))
    leaders = index.groupBy("key").agg(F.max("lead").alias("any"), rank.alias("first")).where("any").select("key", F.col("first.id").alias("leader"))

    # each document meets the leader of most of its buckets
    met = index.join(leaders, "key").where("id <> leader").groupBy("id", "n", "leader").agg(F.count(F.lit(1)).alias("k"))
    met = scratch.save(met.groupBy("id", "n").agg(F.max_by("leader", F.struct("k", "leader")).alias("key")), "met")
    leaders = met.select("key").distinct().join(classes.select(F.col("id").alias("key"), "n"), "key")
    star = met.select("key", "id", "n", F.col("id").alias("c"), F.lit(False).alias("lead")).unionByName(leaders.select("key", F.col("key").alias("id"), "n", F.col("key").alias("c"), F.lit(True).alias("lead")))
    links = _links(star, classes, docs, k, percent, scratch, "star")
    found = components(links, scratch, "star_groups")

    # then buckets with several components are compared whole: small ones as they are, others by combinations
    labelled = index.join(found, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("c"), "lead", "place", F.lit(False).alias("whole"), F.lit(0).cast("long").alias("old"))
    labelled = scratch.save(labelled, "labelled")
    rest = labelled.join(nd.distinct_mixed(labelled), "key").withColumn("large", F.least("leads", "outside") > F.greatest(F.lit(nd.LARGE), nd.WORTH * F.col("mean")))
    rest = scratch.save(rest, "mixed")
    rare = rest.where("not large").select("key", "id", "n", "c", F.when(F.col("leads") <= F.col("outside"), F.col("lead")).otherwise(F.col("c") != F.col("top")).alias("lead"))
    frequent = scratch.save(rest.where("large").select("key", "id", "n", "c"), "frequent")
    if not frequent.isEmpty():
        sets = nd._full_sets(frequent.select("id"), classes, docs, k, scratch, "frequent")
        rare = scratch.save(rare.unionByName(nd.combined(frequent, sets, percent, scratch, "frequent")), "rare")
    links = links.unionByName(_links(rare, classes, docs, k, percent, scratch, "rest"))
    found = components(links, scratch, "groups")

    own = classes.select("id", "high", "low", "n", "named").join(found, "id", "left")
    least = own.where("component is not null").groupBy("component").agg(F.min("named").alias("least"))
    own = own.join(least, "component", "left").select("high", "low", F.col("n").cast("long").alias("n"), F.coalesce("least", "named").alias("named"))
    rows = sketch.select("id", "n", "high", "low").join(scratch.save(own, "named"), ["high", "low", "n"], "left")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("named.id")).otherwise(F.col("id")).alias("component_id"))


def op12_combination_join(spark, sf_dir: str) -> DataFrame:
    """The contract's query: 4-word shingles of every whole text, similarity of 0.85."""
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=85)
