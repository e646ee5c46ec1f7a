"""Conversation prefix trie from polynomial rolling fingerprints.

The fingerprint of the first d turns is the sum of mix(turn i) * B**i modulo 2**64 over i < d, a running sum that numpy
scans work out over rows sorted by conversation and turn. Positions are absolute, so a conversation that range
partitions split continues with the sum and the power that the partitions before it hand over: a number each.

Rows of one (depth, fingerprint) are candidates for one node. A turn's identity is exact: turns of one hash are compared
by role and text, and differing ones are numbered. A group is verified against its representative turn by turn: all of
its rows must have the representative's last turn and come from the group of the representative's parent, which is
itself verified, so by induction all turns agree. Groups that don't hold are split by parent and turn until all do.

Rollup: a node's members with the same representative form a chain, since the least member of a node stays the least
of every node below on its path. So sums over a subtree are suffix sums along the representative's chain and whole
chains of the other members, and no loop over depths is needed.

Scale: sorting is by range with a salt, so neither a long conversation nor many equal rows make one task. Groups are
pre-aggregated before they are shuffled, and hold numbers only; texts never move but for the check of equal hashes,
which is pre-aggregated, too. Ids that end at one node are packed into pieces by several tasks and hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.located import integer_ids
from tidemark.llm.scratch import Scratch, parts

BASE = 0x9E3779B97F4A7C15
#: Ids of a packed piece, and depths of a block of suffix sums.
IDS, DEPTHS = 1 << 16, 1024


def powers_of(exponents: np.ndarray) -> np.ndarray:
    """BASE to each exponent modulo 2**64."""
    e, base = exponents.astype(np.uint64), BASE
    out = np.ones(len(e), dtype=np.uint64)
    for bit in range(int(e.max(initial=0)).bit_length()):
        out = np.where(e >> np.uint64(bit) & np.uint64(1), out * np.uint64(base), out)
        base = base * base % 2**64
    return out


def _term(batch: pa.RecordBatch) -> np.ndarray:
    turn, sub = (batch.column(c).to_numpy().astype(np.uint64) for c in ("turn", "sub"))
    return words.mix(turn + sub * np.uint64(0xD1B54A32D192ED03))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, turn, sub, points) with their place in the run of the conversation and the running sum."""
    conv, n, total = None, 0, 0
    part = TaskContext.get().partitionId()
    for b in batches:
        if not b.num_rows:
            continue
        c = b.column(0).to_numpy()
        starts = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        first = np.repeat(starts, np.diff(np.append(starts, len(c))))
        place = np.arange(len(c)) - first
        of_first = first == 0
        if c[0] != conv:
            n, total = 0, 0
        place[of_first] += n
        run = np.cumsum(_term(b) * powers_of(place))
        before = np.append(np.zeros(1, dtype=np.uint64), run)[first]
        run = run - before
        run[of_first] += np.uint64(total)
        conv, n, total = c[-1], int(place[-1]) + 1, int(run[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), part, np.int32)), b.column(0), pa.array(place), *(b.column(i) for i in (1, 2, 3)), pa.array(run.astype(np.int64))], ["part", "conv", "place", "turn", "sub", "points", "run"])


def _finish(handed: dict[int, tuple[int, int, int]], bits: int):
    """Depths and fingerprints of scanned rows; ``handed``: the conversation that a partition continues, with its rows
    and its sum so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64((1 << bits) - 1)
        for b in batches:
            part, conv, place = (b.column(c).to_numpy() for c in ("part", "conv", "place"))
            total, place = b.column("run").to_numpy().astype(np.uint64), place.copy()
            for p in np.unique(part).tolist():
                if p in handed:  # only a partition's first conversation can have begun before it
                    c, n, before = handed[p]
                    at = np.flatnonzero((part == p) & (conv == c))
                    total[at] = total[at] * np.uint64(pow(BASE, n, 2**64)) + np.uint64(before)
                    place[at] += n
            up = np.where(place > 0, words.mix(total - _term(b) * powers_of(place)) & mask, np.uint64(0))
            here = words.mix(total) & mask
            yield pa.RecordBatch.from_arrays([b.column("conv"), pa.array(place + 1), pa.array(here.astype(np.int64)), pa.array(up.astype(np.int64)), *(b.column(c) for c in ("turn", "sub", "points"))], ["conv", "d", "f", "pf", "turn", "sub", "points"])

    return run


def identified(conversations: DataFrame, scratch: Scratch, id_col: str, turn_col: str, role_col: str, text_col: str, bits: int) -> DataFrame:
    """Light rows (conv, at, role, tie, turn, sub, points): (turn, sub) is equal for equal (role, text) and only for them."""
    mask = F.lit((1 << bits) - 1 if bits < 64 else -1).cast("long")
    rows = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("at"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("turn", F.xxhash64("role", "text").bitwiseAND(mask))
    differ = F.max(F.struct("role", "text")) != F.min(F.struct("role", "text"))
    mixed = scratch.save(rows.groupBy("turn").agg(differ.alias("differ")).where("differ").select("turn"), "mixed")
    if mixed.isEmpty():
        rows = rows.withColumn("sub", F.lit(0).cast("long"))
    else:
        contents = rows.join(mixed, "turn", "left_semi").select("turn", "role", "text").distinct()
        subs = scratch.save(contents.withColumn("sub", F.monotonically_increasing_id() + 1), "subs")
        rows = rows.join(subs, ["turn", "role", "text"], "left").withColumn("sub", F.coalesce("sub", F.lit(0).cast("long")))
    return rows.select("conv", "at", "role", F.md5(F.col("text").cast("binary")).alias("tie"), "turn", "sub", F.char_length("text").cast("long").alias("points"))


def _runs(light: DataFrame, scratch: Scratch, name: str, *order: Column, bits: int = 64) -> DataFrame:
    """(conv, d, f, pf, turn, sub, points) of rows (conv, turn, sub, points) in ``order`` within each conversation."""
    spark = scratch.spark
    rows = light.withColumn("salt", F.monotonically_increasing_id())
    keys = [F.col("conv").asc(), *order, F.col("salt").asc()]
    rows = rows.repartitionByRange(parts(spark), *keys).sortWithinPartitions(*keys).select("conv", "turn", "sub", "points")
    rows = scratch.save(rows.mapInArrow(_scan, "part int, conv long, place long, turn long, sub long, points long, run long"), f"{name}_scan")
    # a conversation in several partitions ends one of them and begins the next, so there are fewer such than partitions
    ends = sorted(tuple(r) for r in rows.groupBy("part").agg(F.min("conv"), F.max("conv")).collect())
    split = sorted({a[2] for a, b in zip(ends, ends[1:], strict=False) if a[2] == b[1]})
    handed: dict[int, tuple[int, int, int]] = {}
    if split:
        some = rows.join(F.broadcast(spark.createDataFrame([(c,) for c in split], "conv long")), "conv")
        so_far: dict[int, tuple[int, int]] = {}
        for r in sorted(some.groupBy("conv", "part").agg(F.max(F.struct("place", "run")).alias("last")).collect(), key=lambda r: (r["conv"], r["part"])):
            n, total = so_far.get(r["conv"], (0, 0))
            if n:
                handed[r["part"]] = (r["conv"], n, total)
            so_far[r["conv"]] = (n + r["last"]["place"] + 1, (total + r["last"]["run"] * pow(BASE, n, 2**64)) % 2**64)
    out = scratch.save(rows.mapInArrow(_finish(handed, bits), "conv long, d long, f long, pf long, turn long, sub long, points long"), f"{name}_rows")
    scratch.drop(f"{name}_scan")
    return out


def _groups(rows: DataFrame) -> DataFrame:
    same = lambda c: F.min(c) == F.max(c)
    return rows.groupBy("d", "f").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("pf").alias("pf"), F.min("points").alias("points"), (same("pf") & same("turn") & same("sub")).alias("holds"))


def _split(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with the least member of the true node instead of fingerprints: groups are split by parent and turn."""
    named = rows.groupBy("d", "f").agg(F.min("conv").alias("g"))
    rows = scratch.save(rows.join(named, ["d", "f"]).select("conv", "d", "turn", "sub", "points", "g"), "split_0")
    step, was = 0, named.count()
    while True:
        step += 1
        up = rows.select("conv", (F.col("d") + 1).alias("d"), F.col("g").alias("pf"))
        from_ = scratch.save(rows.join(up, ["conv", "d"], "left").withColumn("pf", F.coalesce("pf", F.lit(0).cast("long"))), f"from_{step}")
        keys = ["d", "g", "pf", "turn", "sub"]
        named = from_.groupBy(*keys).agg(F.min("conv").alias("f"))
        now = named.count()
        if now == was:
            return from_.withColumnRenamed("g", "f")
        rows = scratch.save(from_.join(named, keys).select("conv", "d", "turn", "sub", "points", F.col("f").alias("g")), f"split_{step}")
        was = now


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of rows sorted by (d, f, conv), joined by commas in pieces of one node."""
    key, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], ["d", "f", "first", "ids"])

    for b in batches:
        d, f, c = (b.column(i).to_numpy() for i in range(3))
        cuts = np.flatnonzero((d[1:] != d[:-1]) | (f[1:] != f[:-1])) + 1
        for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(c)), strict=True):
            if lo == hi:
                continue
            here = (int(d[lo]), int(f[lo]))
            if key != here or len(ids) >= IDS:
                if ids:
                    yield piece()
                key, ids = here, []
            ids += c[lo:hi].tolist()
    if ids:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, in order of their first ids, as a stream."""
    key, digest = None, None
    for b in batches:
        out = []
        for d, f, text in zip(*(b.column(c).to_pylist() for c in ("d", "f", "ids")), strict=True):
            if key != (d, f):
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = (d, f), hashlib.sha256(text.encode())
            else:
                digest.update(f",{text}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["d", "f", "ends"])
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([digest.hexdigest()])], ["d", "f", "ends"])


def _rolled_up(rows: DataFrame, nodes: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """One row a node from verified ``rows`` and their groups ``nodes``."""
    n = parts(scratch.spark)
    kids = nodes.groupBy((F.col("d") - 1).alias("d"), F.col("pf").alias("f")).agg(F.count(F.lit(1)).alias("kids"))
    nodes = scratch.save(nodes.join(kids, ["d", "f"], "left").select("d", "f", "pf", "rep", "n", F.coalesce("kids", F.lit(0)).alias("kids"), ((F.col("n") - 1) * F.col("points")).alias("w")), "nodes")
    chains = scratch.save(nodes.groupBy("rep").agg(F.min("d").alias("s"), F.sum("w").alias("w"), F.sum((F.col("kids") == 0).cast("long")).alias("leaves"), F.min_by("pf", "d").alias("pf")), "chains")

    # chains of other members: all that a member is the least of lies below the depth at which its chain begins
    others = rows.join(chains.select(F.col("rep").alias("conv"), "s", "w", "leaves"), "conv").where("d < s").groupBy("d", "f").agg(F.sum("w").alias("other_w"), F.sum("leaves").alias("other_leaves"))
    block = F.floor(F.col("d") / DEPTHS).alias("block")
    blocks = nodes.groupBy("rep", block).agg(F.sum("w").alias("w"), F.sum((F.col("kids") == 0).cast("long")).alias("leaves"))
    later = Window.partitionBy("rep").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    blocks = blocks.select("rep", "block", zero(F.sum("w").over(later)).alias("after_w"), zero(F.sum("leaves").over(later)).alias("after_leaves"))
    within = Window.partitionBy("rep", "block").orderBy(F.col("d").desc()).rowsBetween(Window.unboundedPreceding, 0)
    own = nodes.withColumn("block", block).join(blocks, ["rep", "block"])
    own = own.withColumn("own_w", F.sum("w").over(within) + F.col("after_w")).withColumn("own_leaves", F.sum((F.col("kids") == 0).cast("long")).over(within) + F.col("after_leaves"))

    last = rows.groupBy("conv").agg(F.max(F.struct("d", "f")).alias("x"))
    none = F.lit(0).cast("long")
    ends = members.join(last, "conv", "left").select(F.coalesce("x.d", none).alias("d"), F.coalesce("x.f", none).alias("f"), "conv")
    pieces = ends.repartitionByRange(n, "d", "f", "conv").sortWithinPartitions("d", "f", "conv").mapInArrow(_pack, "d long, f long, first long, ids string")
    ends = scratch.save(pieces.repartition(n, "d", "f").sortWithinPartitions("d", "f", "first").mapInArrow(_digests, "d long, f long, ends string"), "ends")

    root = members.agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 0").first()
    if root is None:
        return scratch.spark.createDataFrame([], OUT)
    under = chains.agg(zero(F.sum("w")).alias("w"), zero(F.sum("leaves")).alias("leaves")).first()
    n_kids = nodes.where("d = 1").count()
    top = scratch.spark.createDataFrame([(0, 0, root["rep"], None, root["n"], n_kids, under["leaves"] if n_kids else 1, under["w"])], "d long, f long, rep long, up long, n long, kids long, leaves long, saved long")

    # inside a chain the parent has the same representative; only its first node has another one
    heads = chains.select("rep", "s", "pf").join(nodes.select((F.col("d") + 1).alias("s"), F.col("f").alias("pf"), F.col("rep").alias("up")), ["s", "pf"], "left").select("rep", F.col("s").alias("d"), F.coalesce("up", F.lit(root["rep"])).alias("up"))
    below = own.join(heads, ["rep", "d"], "left").join(others, ["d", "f"], "left").select(
        "d", "f", "rep", F.coalesce("up", "rep").alias("up"), "n", "kids", (F.col("own_leaves") + zero("other_leaves")).alias("leaves"), (F.col("own_w") + zero("other_w")).alias("saved")
    )
    return below.unionByName(top).join(ends, ["d", "f"], "left").select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


OUT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _trie(light: DataFrame, members: DataFrame, scratch: Scratch, *order: Column, bits: int = 64) -> DataFrame:
    rows = _runs(light, scratch, "trie", *order, bits=bits)
    nodes = scratch.save(_groups(rows), "groups")
    if not nodes.where("not holds").isEmpty():
        rows = _split(rows, scratch)
        nodes = scratch.save(_groups(rows), "split_groups")
    return _rolled_up(rows, nodes, members, scratch)


def _in_turn() -> list[Column]:
    return [F.col("at").asc_nulls_first(), F.col("role").asc(), F.col("tie").asc()]


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", bits: int = 64) -> DataFrame:
    """The trie of all turn sequences of ``conversations``, one row a node.

    A node is a distinct sequence of (role, text) with which conversations begin; the root is the empty one. conv_id: the
    node's smallest member; (conv_id, depth) is unique. parent_conv_id: the parent's conv_id, null for the root. n_convs:
    members. n_children. n_leaves: childless nodes in the subtree, the node included. saved_tokens: the code points of
    last texts that the subtree's nodes store once instead of once a member. ends_sha256: SHA-256 of the ascending,
    comma-joined ids of members that end here.

    Turns are ordered by the turn column, null first; rows that tie in it by role, then by the MD5 of their text, and
    rows that repeat all of these stand one after another. Null roles and texts count as empty; empty texts are turns.
    Rows without an id belong to no conversation and are left out. Ids are integers; other types are refused. No rows
    give no nodes. Other columns are ignored, whatever their names. ``bits``: bits of hashes that are used; fewer make
    collisions frequent and change no result.
    """
    integer_ids(conversations, id_col)
    scratch = Scratch(conversations.sparkSession, "trie")
    light = scratch.save(identified(conversations, scratch, id_col, turn_col, role_col, text_col, bits), "light")
    return _trie(light, light.select("conv").distinct(), scratch, *_in_turn(), bits=bits)


def shared_heads(conversations: DataFrame, most: int = 6, block: int = 100, bits: int = 64) -> DataFrame:
    """``prefix_trie`` of conversations rebuilt so that they share heads: conversation c has the first
    h = crc32(c in decimal) % ``most`` turns of conversation c - c % ``block`` (all if fewer, none if that is absent) and
    then its own turns after its first h. A conversation that has no turns then is a member of the root alone."""
    integer_ids(conversations, "conv_id")
    scratch = Scratch(conversations.sparkSession, "trie")
    light = scratch.save(identified(conversations, scratch, "conv_id", "turn", "role", "text", bits), "light")
    placed = _runs(light, scratch, "own", *_in_turn()).select("conv", "d", "turn", "sub", "points")
    members = scratch.save(placed.select("conv").distinct(), "members")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h")
    base = (F.col("conv") - F.col("conv") % block).alias("base")
    heads = placed.where((F.col("d") < most) & (F.col("conv") % block == 0)).withColumnRenamed("conv", "base")
    given = members.select("conv", base, h).join(heads, "base").where("d <= h").select(*placed.columns)
    rebuilt = placed.where(F.col("d") > h).unionByName(given)
    return _trie(rebuilt, members, scratch, F.col("d").asc(), bits=bits)


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The contract's query over all conversations."""
    return shared_heads(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
