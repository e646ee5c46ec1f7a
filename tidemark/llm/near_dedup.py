"""MinHash near-dedup on SetSketch registers.

A document's set of word shingles is sketched into ``m`` registers. Register i holds floor(1 - log_b(x_i / a)) of the
least exponential variate x_i over the set, truncated to [0, q + 1]: the spacing is exponential in the set size, two
sketches merge by the larger register, and equal registers are about as likely as the Jaccard similarity. Runs of
registers form bands; documents that share a band are candidates; the similarity of a candidate pair is first
estimated from all registers and both set sizes by maximum likelihood, and the pairs that the estimate can't rule out
are confirmed on their full shingle sets.

Scale: equal sets collapse to one representative before banding, so a group of copies of any size costs one row.
Within a bucket each member meets the bucket's first one (a star, not all pairs). Buckets whose members are then in
several components are compared in cells of two blocks inside tasks, which return links, not pairs: the first pass
keeps the members that the likelihood leaves a partner in another component, the second one confirms on full sets.
Members of the bucket's largest component meet only those outside of it, so a group of near copies of any size costs
a row a member for each block outside. Blocks hold ``BLOCK`` members at most, so no bucket is one task's. A mixed
bucket with more than ``LARGE`` members outside, as one template makes of many unlike texts, isn't compared all against
all: its members are dealt anew by the rarest shingles of their full sets. Two sets that are similar enough share one
among the first of them (prefix filter), so the new buckets lose no link, and shingles of the template, which are
frequent, make none. A new bucket that is mixed and as large again, as a piece of text from a common pool makes, is
dealt on by the shingles that are rare among its own members, until its members are few or all of one component.
Components run as a Spark loop. No cap exists anywhere.

Recall: with r = 7 and 48 bands a pair at similarity 0.80 shares no band with probability 1e-5, at 0.85 below 1e-8. The
likelihood cut of 0.65 lies more than six standard errors under 0.8. Shingles are compared as 64-bit hashes, and sets
count as equal when their sizes and two sums of 64 bits over them are, so unequal ones are mixed up with a probability
of about 2**-60 a pair of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.components import components
from tidemark.llm.located import integer_ids, located, picked, without
from tidemark.llm.scratch import Scratch, arrow_rows, give_back, parts

B, A, Q = 1.02, 20.0, 2**16 - 3
ROWS, BANDS = 7, 48
M = ROWS * BANDS
CUT = 0.65
#: Least share of equal registers for which the likelihood is worked out; six standard errors under that of 0.8.
SCREEN = 0.66
#: Members of a bucket that are compared within one task, and columns of the incidence matrix at a time.
BLOCK, COLUMNS = 384, 8192
#: Members outside a mixed bucket's largest component up to which they meet all its members; buckets of longer texts
#: wait until they are so many times the mean set size, when dealing their shingles out is the cheaper way.
LARGE, WORTH = 3072, 32
#: Rows of an Arrow batch; a row has a text or whole sets.
ROWS_A_BATCH = 1000

_RNG = np.random.Generator(np.random.PCG64(77))
_MULT = (_RNG.integers(0, 2**31, M, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[None, :]
_XOR = _RNG.integers(0, 2**32, M, dtype=np.uint32)[None, :]
_BAND = _RNG.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``k`` words; fewer words form one run, none none."""
    if not len(h):
        return h
    return np.unique(words.sequences(h, min(k, len(h))))


def registers(found: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of 64-bit hashes."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(M, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(x), 96):
        u = (x[at : at + 96, None] ^ _XOR) * _MULT
        np.minimum(least, u.min(axis=0), out=least)
    e = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32)
    return np.clip(np.floor(1 - np.log(e / A) / np.log(B)), 0, Q + 1).astype(np.uint16)


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, other)


def likeliest(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray) -> np.ndarray:
    """Jaccard estimates of pairs (rows) by maximum likelihood over a grid, given both set sizes."""
    up = (one > other).sum(axis=1)[:, None]
    down = (one < other).sum(axis=1)[:, None]
    same = one.shape[1] - up - down
    u = (n_one / (n_one + n_other))[:, None]
    v = 1 - u
    j = np.minimum(np.linspace(0, 1, 101)[None, :], np.minimum(u, v) / np.maximum(u, v))
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)
    higher, lower = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
    score = up * np.log(higher) + down * np.log(lower) + same * np.log(np.maximum(1 - higher - lower, 1e-12))
    return np.take_along_axis(j, score.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = words.buffer_of(batch.column(1))
            for lo, hi in words.blocks(offsets):
                part = offsets[lo : hi + 1]
                h, _, _, at = words.hashes(raw[part[0] : part[-1]], part - part[0], words.NON_SPACE)
                n, high, low, regs = [], [], [], []
                for i in range(hi - lo):
                    found = shingles(h[at[i] : at[i + 1]], k)
                    n.append(len(found))
                    high.append(found.sum(dtype=np.uint64).astype(np.int64))
                    low.append(words.mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
                    regs.append(registers(found).tobytes() if len(found) else None)
                own = [batch.column(c).slice(lo, hi - lo) for c in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(regs, pa.binary())], ["id", "file", "at", "n", "high", "low", "regs"])
        give_back()

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint16).reshape(-1, BANDS, ROWS)
        keys = words.mix((regs.astype(np.uint64) * _BAND[None]).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)[None]).astype(np.int64)
        which = np.repeat(np.arange(batch.num_rows), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column(0).take(pa.array(which)), batch.column(1).take(pa.array(which))], ["key", "id", "n"])


def _likely(cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = []
            for at in range(0, batch.num_rows, 512):
                x = batch.slice(at, 512)
                one, other = (np.frombuffer(b"".join(x.column(c).to_pylist()), dtype=np.uint16).reshape(-1, M) for c in ("ra", "rb"))
                keep.append(likeliest(one, other, *(x.column(c).to_numpy().astype(float) for c in ("na", "nb"))) >= cut)
            yield batch.select(["a", "b"]).filter(pa.array(np.concatenate(keep)))

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = words.buffer_of(batch.column(1))
            for lo, hi in words.blocks(offsets):
                part = offsets[lo : hi + 1]
                h, _, _, at = words.hashes(raw[part[0] : part[-1]], part - part[0], words.NON_SPACE)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([shingles(h[at[i] : at[i + 1]], k).tobytes() for i in range(hi - lo)], pa.binary())], ["id", "s"])
        give_back()

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
                one, other = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(one) + len(other) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (key, x, y) from batches sorted by it."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        k = np.stack([rows[c].to_numpy() for c in ("key", "x", "y")], axis=1)
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        for a, b in zip(np.append(0, cuts)[:-1], cuts, strict=True):
            yield rows.slice(a, b - a)
        held = rows.slice(cuts[-1] if len(cuts) else 0)
    if held is not None:
        yield held


def _partnered(percent: int):
    """The members of a block that have a likely partner in another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            n, c = rows["n"].to_numpy(), rows["c"].to_numpy()
            if (c == c[0]).all():
                continue
            regs = np.frombuffer(b"".join(rows["regs"].to_pylist()), dtype=np.uint16).reshape(-1, M)
            keep = np.zeros(len(n), dtype=bool)
            for i in range(len(n) - 1):
                rest = slice(i + 1, None)
                close = (c[rest] != c[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
                at = i + 1 + np.flatnonzero(close)
                at = at[~(keep[at] & keep[i])]
                at = at[(regs[at] == regs[i]).mean(axis=1) >= SCREEN] if len(at) else at
                if len(at):
                    at = at[likeliest(np.broadcast_to(regs[i], (len(at), M)), regs[at], np.full(len(at), float(n[i])), n[at].astype(float)) >= CUT]
                    keep[at] = True
                    keep[i] |= len(at) > 0
            if keep.any():
                yield rows.select(["key", "id"]).filter(pa.array(keep)).combine_chunks().to_batches()[0]

    return run


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted sets, by an incidence matrix a few columns at a time."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    several = times[column] > 1
    column, owner = column[several], owner[several]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column)
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _joined(percent: int):
    """Confirmed links between components of a block; of several between the same components one is enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            c, ids = rows["c"].to_numpy(), rows["id"].to_numpy()
            if (c == c[0]).all():
                continue
            sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in rows["s"]]
            size = np.array([len(s) for s in sets])
            both = shared(sets)
            near = (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (c[:, None] < c[None, :])
            root: dict[int, int] = {}

            def top(x: int, root: dict[int, int] = root) -> int:
                while x in root:
                    x = root[x]
                return x

            a, b = [], []
            for i, j in zip(*np.nonzero(near), strict=True):
                x, y = top(int(c[i])), top(int(c[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    a.append(ids[i])
                    b.append(ids[j])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        give_back()

    return run


def cells(rows: DataFrame) -> DataFrame:
    """Rows (key, id, lead, ...) dealt out so that each leading member of a key meets all its members in some cell
    (x, y) of a leading block and a block."""
    size, leaders = F.count(F.lit(1)), F.sum(F.col("lead").cast("int"))
    of = rows.groupBy("key").agg(F.ceil(size / BLOCK).cast("int").alias("blocks"), F.ceil(leaders / BLOCK).cast("int").alias("leading"), (size == leaders).alias("alike"))
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    cell = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    as_member = F.transform(every("leading"), lambda x: cell(x, block("blocks")))
    as_leader = F.transform(every("blocks"), lambda y: cell(block("leading"), y))
    both = F.when(F.col("lead"), F.array_union(as_member, as_leader)).otherwise(as_member)
    # where all lead, a cell serves two blocks both ways
    whole = F.transform(every("blocks"), lambda y: cell(F.least(block("blocks"), y), F.greatest(block("blocks"), y)))
    dealt = rows.join(of.where("leading > 0"), "key").withColumn("cell", F.explode(F.when(F.col("alike"), whole).otherwise(both)))
    return dealt.select(*rows.columns, "cell.x", "cell.y").drop("lead")


def by_cell(dealt: DataFrame) -> DataFrame:
    """Rows of ``cells``, each cell in one partition and sorted by it."""
    return dealt.repartition(parts(dealt.sparkSession), "key", "x", "y").sortWithinPartitions("key", "x", "y")


def _in_blocks(rows: DataFrame) -> DataFrame:
    return by_cell(cells(rows))


def _full_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, k: int, scratch: Scratch, name: str) -> DataFrame:
    """(id, s) with the whole shingle sets of the representatives ``ids``."""
    wanted = scratch.save(classes.join(ids.distinct(), "id", "left_semi").select("id", "file", "at"), f"{name}_ids")
    return scratch.save(picked(docs.select("file", "at", "text"), wanted).select("id", "text").mapInArrow(_sets(k), "id long, s binary"), f"{name}_sets")


def _verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    one, other = (classes.select(F.col("id").alias(c), F.col("n").cast("int").alias(f"n{c}"), F.col("regs").alias(f"r{c}")) for c in "ab")
    likely = scratch.save(pairs.join(other, "b").join(one, "a").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely(CUT), pairs.select("a", "b").schema), f"{name}_likely")
    sets = _full_sets(likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))), classes, docs, k, scratch, name)
    one, other = (sets.select(F.col("id").alias(c), F.col("s").alias(f"s{c}")) for c in "ab")
    out = scratch.save(likely.join(other, "b").join(one, "a").select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), likely.schema), f"{name}_links")
    scratch.drop(f"{name}_sets")
    return out


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id, n, c, shingle) of the sets (key, id, n, c, s)."""
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), dtype=np.int64) for s in batch.column(4)]
        at = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in range(4)), pa.array(np.concatenate([*sets, np.zeros(0, dtype=np.int64)]))], ["key", "id", "n", "c", "shingle"])


def least_overlaps(percent: int) -> tuple[Column, Column]:
    """What a set of size n shares at least with a similar one that isn't larger, and with one that isn't smaller."""
    return F.ceil(F.lit(percent) * F.col("n") / 100).cast("int"), F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent)).cast("int")


def _dealt_on(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Members (key, id, n, c) of buckets dealt on: rows (key, id, n, c, lead, place, whole, old), a row for each of a set's
    rarest shingles in its bucket. The new keys combine the old one and the shingle.

    With the shingles of a bucket in one order, by how many members have them, two sets whose overlap is o or more share
    one of the first n - o + 1 shingles of both. Shingles that all members have are left out of the order, since they tell
    no members apart, and count towards the overlap: only members for which they alone could be enough get one more
    key, the ``whole`` one, besides. A new bucket that isn't ``whole`` is smaller than its old one.
    """
    rows = scratch.save(members.join(sets, "id").select("key", "id", "n", "c", "s").mapInArrow(_shingles, "key long, id long, n int, c long, shingle long"), f"{name}_rows")
    size = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    often = rows.groupBy("key", "shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1").join(size, "key").select("key", "shingle", "often", (F.col("often") == F.col("size")).alias("all"))
    ordered = rows.join(often, ["key", "shingle"], "left").groupBy("key", "id", "n", "c").agg(
        F.count_if(F.coalesce("all", F.lit(False))).alias("u"),
        F.array_sort(F.collect_list(F.when(~F.coalesce("all", F.lit(False)), F.struct(F.coalesce("often", F.lit(1)).alias("often"), "shingle")))).alias("s"),
    )
    larger, smaller = least_overlaps(percent)
    ordered = scratch.save(ordered.select("key", "id", "n", "c", F.slice("s", F.lit(1), F.col("n") - larger + 1).alias("s"), (F.col("n") - smaller + 1).alias("leading"), (F.col("u") >= larger).alias("some"), (F.col("u") >= smaller).alias("most")), f"{name}_ordered")
    scratch.drop(f"{name}_rows")
    dealt = ordered.select("key", "id", "n", "c", "leading", F.posexplode("s").alias("place", "x")).where("x.often > 1")
    dealt = dealt.select(F.xxhash64("key", "x.shingle").alias("key"), "id", "n", "c", (F.col("place") < F.col("leading")).alias("lead"), "place", F.lit(False).alias("whole"), F.col("key").alias("old"))
    whole = ordered.where("some").select(F.xxhash64("key", F.lit("whole")).alias("key"), "id", "n", "c", F.col("most").alias("lead"), F.lit(0).alias("place"), F.lit(True).alias("whole"), F.col("key").alias("old"))
    return scratch.save(dealt.unionByName(whole), f"{name}_dealt")


def combined(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Members (key, id, n, c) of large mixed buckets under keys that combine ever more of their shingles: rows
    (key, id, n, c, lead) of buckets that are mixed and worth comparing as they are.

    A bucket is dealt on while the members that must meet all others are more than ``LARGE``, and more than ``WORTH``
    times as many as a set has shingles, which is about when comparing costs more than dealing on. Of buckets with the
    same members one is kept.
    """
    out, step = None, 0
    while True:
        step += 1
        rows = _dealt_on(members, sets, percent, scratch, f"{name}_{step}")
        rows = rows.join(distinct_mixed(rows), "key")
        least = F.least("leads", "outside")
        again = ~F.col("whole") & (least > F.greatest(F.lit(LARGE), WORTH * F.col("mean")))
        rows = scratch.save(rows.withColumn("again", again), f"{name}_{step}_mixed")
        lead = F.when(F.col("leads") <= F.col("outside"), F.col("lead") | F.col("several")).otherwise(F.col("c") != F.col("top"))
        done = rows.where("not again").select("key", "id", "n", "c", lead.alias("lead"))
        out = done if out is None else out.unionByName(done)
        members = scratch.save(rows.where("again").select("key", "id", "n", "c"), f"{name}_{step}_again")
        if members.isEmpty():
            return out


def mixed(rows: DataFrame) -> DataFrame:
    """Keys of rows (key, id, c, lead) whose members are in several components: top, the component with most members
    in the bucket, the number outside of it, and the number of leading members."""
    a_part = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("lead").cast("int")).alias("leads"))
    a_key = a_part.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "c")).alias("most"), F.sum("n").alias("n"), F.sum("leads").alias("leads"))
    return a_key.where("parts > 1").select("key", F.col("most.c").alias("top"), (F.col("n") - F.col("most.n")).alias("outside"), "leads")


def distinct_mixed(rows: DataFrame) -> DataFrame:
    """``mixed`` of rows (key, id, n, c, lead, place, whole, old) that have a leading member, with the mean set size, and one
    key for all that have the same members.

    Of keys made from one old key that is the one whose shingle comes first: all that lead in another lead in it. Where
    the old keys differ, and so their orders, ``several`` tells that all its members have to lead.
    """
    a_part = rows.groupBy("key", "c").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("lead").cast("int")).alias("leads"), F.sum("n").alias("size"), F.sum("place").alias("place"), F.min("whole").alias("whole"), F.min("old").alias("old"),
        F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64("id", F.lit(7))).alias("other"),
    )
    a_key = a_part.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("k", "c")).alias("most"), F.sum("k").alias("k"), F.sum("leads").alias("leads"), F.sum("size").alias("size"), F.sum("place").alias("place"),
        F.min("whole").alias("whole"), F.min("old").alias("old"), F.bit_xor("one").alias("one"), F.bit_xor("other").alias("other"),
    ).where("parts > 1 and leads > 0")
    stats = F.struct("place", "key", F.col("most.c").alias("top"), (F.col("k") - F.col("most.k")).alias("outside"), "leads", (F.col("size") / F.col("k")).alias("mean"))
    kept = a_key.groupBy("k", "one", "other", "whole").agg(F.min(stats).alias("x"), (F.min("old") < F.max("old")).alias("several"))
    return kept.select("x.key", "x.top", "x.outside", F.when(F.col("several"), F.col("k")).otherwise(F.col("x.leads")).alias("leads"), "x.mean", "several")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept, file, at) for each row of ``docs``.

    Two rows are linked when 100 * |A & B| >= percent * |A | B| over their sets of distinct ``k``-word shingles of the
    ASCII-lower-cased text. component_id is the least id reachable over links, itself included; kept marks exactly one
    row of each group, one of that id. Null and empty texts have no shingles and no links, so each is a group. Every row
    is a node of its own: rows that repeat an id are linked only if their texts are, and of equal ones the first read
    is kept. A row without an id is linked like any other and kept only where no row with an id is in its group, whose
    component_id is then null. The id is an integer column; any other type is refused. (file, at) locates the row in its
    file. Other columns of ``docs`` are ignored, whatever their names.
    """
    integer_ids(docs, id_col)
    with arrow_rows(docs.sparkSession, ROWS_A_BATCH):
        return _grouped(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), id_col, k, percent)


def _grouped(docs: DataFrame, id_col: str, k: int, percent: int) -> DataFrame:
    """``near_duplicates`` of (id, text); all but the last join is done when it returns."""
    scratch = Scratch(docs.sparkSession, "near")
    docs, file, at = located(docs, scratch)
    docs = docs.select("id", "text", F.col(file).alias("file"), F.col(at).alias("at"))
    sketch = docs.mapInArrow(_sketch(k), "id long, file string, at long, n long, high long, low long, regs binary")
    sketch = scratch.save(sketch.withColumn("row", F.monotonically_increasing_id()), "sketch")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("first")
    classes = sketch.where("n > 0").select("high", "low", "n", first, "regs", "file", "at").groupBy("high", "low", "n")
    classes = classes.agg(F.min("first").alias("first"), F.min_by(F.struct("regs", "file", "at"), "first").alias("x"))
    classes = scratch.save(classes.select("high", "low", F.col("n").cast("int").alias("n"), "first", F.col("first.row").alias("id"), "x.*"), "classes")
    bands = scratch.save(classes.select("id", "n", "regs").mapInArrow(_bands, "key long, id long, n int"), "bands")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("lead")).where("c > 1").select("key", "lead")
    members = scratch.save(bands.join(shared, "key"), "members")
    scratch.drop("bands")

    star = scratch.save(members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct(), "star")
    links = _verify(star, docs, classes, k, percent, scratch, "star")
    found = components(links, scratch, "first")

    labelled = members.join(found, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("c"), F.lit(True).alias("lead"))
    labelled = scratch.save(labelled, "labelled")
    rest = scratch.save(labelled.join(mixed(labelled), "key"), "mixed")
    large = scratch.save(rest.where(F.col("outside") > LARGE).select("id", "n", "c").distinct(), "large")
    # two members of one component need not meet, so all but those of the largest one lead
    rest = rest.where(F.col("outside") <= LARGE).select("key", "id", "n", "c", (F.col("c") != F.col("top")).alias("lead"))
    if not large.isEmpty():
        sets = _full_sets(large.select("id"), classes, docs, k, scratch, "large")
        anew = combined(large.withColumn("key", F.lit(0).cast("long")), sets, percent, scratch, "rare")
        rest = scratch.save(rest.unionByName(anew), "rest")
    likely = scratch.save(_in_blocks(rest.join(classes.select("id", "regs"), "id")).mapInArrow(_partnered(percent), "key long, id long").distinct(), "partnered")
    sets = _full_sets(likely.select("id"), classes, docs, k, scratch, "cross")
    full = rest.join(likely, ["key", "id"], "left_semi").join(sets, "id")
    cross = scratch.save(_in_blocks(full).mapInArrow(_joined(percent), "a long, b long").distinct(), "cross_links")
    found = components(links.unionByName(cross), scratch, "last")

    named = classes.select("id", "high", "low", "n", "first").join(found, "id", "left")
    leads = named.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    named = scratch.save(named.join(leads, "component", "left").select("high", "low", F.col("n").cast("long").alias("n"), F.coalesce("least", "first").alias("first")), "named")
    rows = sketch.select("id", "file", "at", "row", "n", "high", "low").join(named, ["high", "low", "n"], "left")
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first.id")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"), "file", "at",
    )


def op2_setsketch_near_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's query: 4-word shingles of every whole text."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4).drop("file", "at")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate group (5-word shingles, 0.8): of least id, of those the first read.

    Rows are told by their places, so rows that repeat an id are judged apart.
    """
    scratch = Scratch(spark, "near-stage")
    docs, file, at = located(docs, scratch)
    gone = scratch.save(near_duplicates(docs.select("doc_id", "text")).where("not kept").select("file", "at"), "gone")
    return without(docs, file, at, gone)
