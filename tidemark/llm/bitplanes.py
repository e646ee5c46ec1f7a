"""Token ids in bit planes.

Container files ("TPL1", named part-PPPPPP-NNNNNN.tpl). All integers are little endian.

    magic     4 bytes  "TPL1"
    header    u32 ids a block, u32 bits an id, u64 ids, u32 blocks, u32 documents
    index     for each block and plane: u32 length of the compressed plane
    documents u32 ids of each document, then i64 name of each document (the least i64: none), if bit 30 of bits is set
    planes    zstandard frames, block by block, plane by plane

A block of ids is transposed: plane p holds bit p of every id, eight ids a byte (or, with ``unit="byte"``, byte p of
every id). High planes of a vocabulary are nearly constant and shrink to a few bytes. The index gives the place of every
plane, so a reader can fetch one block, or only some planes, without the others.

Scale: documents are range-partitioned by id (then by a hash of the text and the place in the input, so that neither one
id nor rows without any fill a range) and encoded in order; a file is closed at ``SHARD_IDS`` ids, so memory is bounded
whatever a document's length or source. Tasks write their files themselves, under a name of their own first, then move
them to the final name: a task that runs again writes the same bytes to the same place. Files are read back as Spark's
``binaryFile``. Places of documents come from two running sums over files, never from one over documents.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.located import integer_ids
from tidemark.llm.scratch import Scratch, arrow_rows, give_back, parts

MAGIC = b"TPL1"
BLOCK_IDS = 65_536
SHARD_IDS = 1 << 21
END = 2
#: Texts of an Arrow batch.
ROWS_A_BATCH = 2000
#: The places of at most this many containers (24 bytes each) are broadcast; beyond it the containers are shuffled.
BROADCAST_CONTAINERS = 500_000


def planes_of(ids: np.ndarray, bits: int, unit: str) -> list[bytes]:
    """The planes of one block, lowest first."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        return [raw[:, p].tobytes() for p in range((bits + 7) // 8)]
    by_bit = np.unpackbits(raw, axis=1, bitorder="little")[:, :bits]
    return [x.tobytes() for x in np.packbits(by_bit.T, axis=1, bitorder="little")]


def ids_of(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    """The block of ``n`` ids with these planes."""
    raw = np.zeros((n, 4), dtype=np.uint8)
    if unit == "byte":
        for p, x in enumerate(planes):
            raw[:, p] = np.frombuffer(x, dtype=np.uint8)
    elif n:
        by_bit = np.zeros((n, 32), dtype=np.uint8)
        stacked = np.frombuffer(b"".join(planes), dtype=np.uint8).reshape(len(planes), -1)
        by_bit[:, : len(planes)] = np.unpackbits(stacked, axis=1, count=n, bitorder="little").T
        raw = np.packbits(by_bit, axis=1, bitorder="little")
    return raw.reshape(-1).view("<u4")


_HEAD = struct.Struct("<IIQII")
_BYTES, _NAMED = 1 << 31, 1 << 30
_NO_NAME = -(2**63)


def write_container(ids: np.ndarray, sizes: np.ndarray, bits: int = 16, unit: str = "bit", block: int = BLOCK_IDS, level: int = 3, names: list | None = None) -> bytes:
    """The bytes of a container. An id that needs more than ``bits`` bits is refused."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    press = zstandard.ZstdCompressor(level=level)
    frames = [press.compress(p) for at in range(0, len(ids), block) for p in planes_of(ids[at : at + block], bits, unit)]
    head = _HEAD.pack(block, bits | (_BYTES if unit == "byte" else 0) | (0 if names is None else _NAMED), len(ids), -(-len(ids) // block), len(sizes))
    named = b"" if names is None else np.array([_NO_NAME if x is None else x for x in names], dtype="<i8").tobytes()
    return b"".join([MAGIC, head, np.array([len(f) for f in frames], dtype="<u4").tobytes(), sizes.astype("<u4").tobytes(), named, *frames])


def count_of(content: bytes) -> int:
    """How many ids a container holds."""
    if content[:4] != MAGIC:
        raise ValueError("not a TPL1 container")
    return _HEAD.unpack_from(content, 4)[2]


def _layout(content: bytes) -> tuple[int, int, int, bool, str, int]:
    """(ids a block, blocks, planes a block, whether documents have names, unit, place of the documents' sizes)."""
    block, flags, _, count, _ = _HEAD.unpack_from(content, 4)
    bits, unit = flags & ~(_BYTES | _NAMED), "byte" if flags & _BYTES else "bit"
    width = (bits + 7) // 8 if unit == "byte" else bits
    return block, count, width, bool(flags & _NAMED), unit, 4 + _HEAD.size + 4 * count * width


def names_of(content: bytes) -> list | None:
    """The names of a container's documents, if it has them."""
    *_, named, _, at = _layout(content)
    documents = _HEAD.unpack_from(content, 4)[4]
    if named:
        return [None if x == _NO_NAME else x for x in np.frombuffer(content, dtype="<i8", count=documents, offset=at + 4 * documents).tolist()]
    return None


def read_container(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids of each document)."""
    n, documents = count_of(content), _HEAD.unpack_from(content, 4)[4]
    block, count, width, named, unit, at = _layout(content)
    lengths = np.frombuffer(content, dtype="<u4", count=count * width, offset=4 + _HEAD.size).reshape(count, width)
    sizes = np.frombuffer(content, dtype="<u4", count=documents, offset=at)
    at += (12 if named else 4) * documents
    open_ = zstandard.ZstdDecompressor()
    out = []
    for b in range(count):
        planes = []
        for size in lengths[b]:
            planes.append(open_.decompress(content[at : at + int(size)]))
            at += int(size)
        out.append(ids_of(planes, min(block, n - b * block), unit))
    return (np.concatenate(out) if out else np.zeros(0, dtype="<u4")), sizes


#: Encoded pieces that a worker remembers, about 50 bytes each. When there are more, those in use stay.
CACHE = 500_000
#: Bytes whose pieces are hashed at a time.
HASHED = 1 << 17
#: Bytes of new pieces that are one text to the tokenizer.
RUN = 1 << 16
_RNG = np.random.Generator(np.random.PCG64(31))
_VALUES = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A piece may begin at a space between two of these: no white space, nor a byte that can be part of any.
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x21:0x7F] = _PLAIN[0x80:] = True
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


class _Joined(Exception):
    """Pieces can't be told apart after encoding."""


class Pieces:
    """A tokenizer file with a memory of the pieces that it has encoded, keyed by two 64-bit hashes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.spaced = np.array([(self.tok.id_to_token(i) or "").startswith("Ġ") for i in range(self.tok.get_vocab_size())])
        self.clear()
        self.most = CACHE
        #: Whether texts must be encoded whole, because this tokenizer joins over spaces.
        self.direct = False
        probe = [b"The", b" 1st", b" word,", b" an", " É-word".encode(), b" and", b" (x)", b" y's", b" end."]
        apart = [i for p in probe for i in self.tok.encode(p.decode(), add_special_tokens=False).ids]
        self.direct = apart != self.tok.encode(b"".join(probe).decode(), add_special_tokens=False).ids

    def clear(self) -> None:
        self.key, self.check = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.start, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.used = np.zeros(0, dtype=bool)
        self.ids = np.zeros(0, dtype=np.uint32)

    def drop_unused(self) -> None:
        """Forget the pieces that no block has had again since the last time."""
        kept = np.flatnonzero(self.used)
        start, size = self.start[kept], self.size[kept]
        self.key, self.check, self.size = self.key[kept], self.check[kept], size
        self.start = np.cumsum(size) - size
        self.ids = self.ids[np.arange(size.sum()) + np.repeat(start - self.start, size)]
        self.used = np.zeros(len(kept), dtype=bool)

    def remember(self, key: np.ndarray, check: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Take in new pieces; where there are too many, those in use stay, and if they are too many none do."""
        if len(self.key) + len(key) > self.most:
            self.drop_unused()
        if len(self.key) + len(key) > self.most:
            self.clear()
            return
        start = len(self.ids) + np.cumsum(size) - size
        order = np.argsort(np.concatenate((self.key, key)), kind="stable")
        self.key, self.check, self.start, self.size, self.used = (
            np.concatenate(x)[order] for x in ((self.key, key), (self.check, check), (self.start, start), (self.size, size), (self.used, np.zeros(len(key), dtype=bool)))
        )
        self.ids = np.concatenate((self.ids, ids))

    def hashed(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> list[np.ndarray]:
        """Two hashes of each piece, about ``HASHED`` bytes of pieces at a time; a piece has them wherever it stands."""
        keys = [np.empty(len(starts), dtype=np.uint64) for _ in _VALUES]
        i = 0
        while i < len(starts):
            lo = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, lo + HASHED, side="right")))
            size = int(ends[j - 1] - lo)
            up, down = words.powers(size + 1)
            a, b = starts[i:j] - lo, ends[i:j] - lo
            for key, values in zip(keys, _VALUES, strict=True):
                total = np.zeros(size + 1, dtype=np.uint64)
                np.cumsum(values[raw[lo : lo + size]] * up[:size], out=total[1:])
                key[i:j] = words.mix((total[b] - total[a]) * down[a] + odd[i:j].astype(np.uint64))
            i = j
        return keys

    def encode_new(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each piece). Pieces that begin with their only space are encoded in runs: each has one token
        that begins with a space, its first. The others (odd) are encoded one by one."""
        sizes = np.zeros(len(starts), dtype=np.int64)
        plain = np.flatnonzero(~odd)
        length = (ends - starts)[plain]
        to = np.cumsum(length)
        joined = raw[np.arange(length.sum()) + np.repeat(starts[plain] - (to - length), length)].tobytes()
        cuts = [0, *np.unique(to[np.searchsorted(to, np.arange(RUN, len(joined), RUN))]).tolist(), len(joined)]
        texts = [joined[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
        runs = [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        run = np.concatenate(runs) if runs else np.zeros(0, dtype=np.uint32)
        begins = np.flatnonzero(self.spaced[run])
        if len(begins) != len(plain):
            raise _Joined
        sizes[plain] = np.diff(np.append(begins, len(run)))
        others = [raw[a:b].tobytes().decode() for a, b in zip(starts[odd].tolist(), ends[odd].tolist(), strict=True)]
        single = [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(others, add_special_tokens=False)]
        sizes[odd] = [len(x) for x in single]
        ids = np.empty(sizes.sum(), dtype=np.uint32)
        mine = np.repeat(odd, sizes)
        ids[~mine] = run
        ids[mine] = np.concatenate(single) if single else ids[mine]
        return ids, sizes

    def whole(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, each text through the tokenizer as it is."""
        blob = raw.tobytes()
        found = self.tok.encode_batch_fast([blob[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], add_special_tokens=False)
        ids = [np.array(e.ids, dtype=np.uint32) for e in found]
        return np.concatenate([*ids, np.zeros(0, dtype=np.uint32)]), np.append(0, np.cumsum([len(x) for x in ids]))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of the block, place of each text's first id and of the end)."""
        rows, n = len(offsets) - 1, len(raw)
        if not n:
            return np.zeros(0, dtype=np.uint32), np.zeros(rows + 1, dtype=np.int64)
        if self.direct:
            return self.whole(raw, offsets)
        near = np.concatenate((np.zeros(3, dtype=np.uint8), raw, np.zeros(1, dtype=np.uint8)))
        cut = (raw == 0x20) & _PLAIN[near[2 : n + 2]] & _PLAIN[near[4 : n + 4]] & ~_LEADS[near[4 : n + 4]] & ~_LEADS[near[1 : n + 1]] & ~_LEADS[near[:n]]
        head = np.zeros(n + 1, dtype=bool)
        head[offsets] = True
        ends_text = head[1:]
        cut &= ~head[:n] & ~ends_text
        starts = np.flatnonzero(cut | head[:n])
        ends = np.append(starts[1:], n)
        spaces = np.append(0, np.cumsum(raw == 0x20))
        first = head[starts]
        odd = first | (spaces[ends] - spaces[starts] != 1)
        keys = self.hashed(raw, starts, ends, odd)
        unique, at, back = np.unique(keys[0], return_index=True, return_inverse=True)
        check = keys[1][at]
        if (check[back] != keys[1]).any():  # two pieces share a 64-bit hash
            return self.whole(raw, offsets)
        place = np.minimum(np.searchsorted(self.key, unique), max(len(self.key) - 1, 0))
        known = (self.key[place] == unique) & (self.check[place] == check) if len(self.key) else np.zeros(len(unique), dtype=bool)
        fresh = np.flatnonzero(~known)
        try:
            ids, sizes = self.encode_new(raw, starts[at[fresh]], ends[at[fresh]], odd[at[fresh]])
        except _Joined:
            self.direct = True
            return self.whole(raw, offsets)
        base = len(self.ids)
        table = np.concatenate((self.ids, ids))
        size, start = np.empty(len(unique), dtype=np.int64), np.empty(len(unique), dtype=np.int64)
        size[fresh], start[fresh] = sizes, base + np.cumsum(sizes) - sizes
        if known.any():
            size[known], start[known] = self.size[place[known]], self.start[place[known]]
            self.used[place[known]] = True
        self.remember(unique[fresh], check[fresh], sizes, ids)
        count = size[back]
        total = np.append(0, np.cumsum(count))
        source = np.arange(total[-1]) - np.repeat(total[:-1] - start[back], count)
        return table[source], total[np.append(np.searchsorted(starts, offsets[:-1]), len(starts))]


@lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def forget() -> None:
    """Give back the memory of encoded pieces and of the tokenizer."""
    _pieces.cache_clear()
    give_back()


def encode(texts: pa.Array, path: str, remembered: int = CACHE) -> Iterator[np.ndarray]:
    """Ids of each text by the tokenizer file at ``path``; a worker holds at most ``remembered`` encoded pieces.

    Byte-level BPE never merges over a single space between two characters that are not white space: the space starts
    the next piece. Texts are cut there, and each distinct piece goes through the tokenizer once.
    """
    raw, offsets = words.buffer_of(texts)
    _pieces(path).most = remembered
    for lo, hi in words.blocks(offsets):
        ids, at = _pieces(path).encode(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        for i in range(hi - lo):
            yield ids[at[i] : at[i + 1]]


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI and the folder's path in it; Hadoop's ``file:/x`` counts as ``file:///x``."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _write(to: str, path: str, bits: int, unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, store, folder = task.partitionId(), None, None
        held, names, size, count = [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal store, folder
            if store is None:
                store, folder = _store(to)
            content = write_container(np.concatenate(held), np.array([len(x) for x in held]), bits, unit, names=names)
            name = f"part-{part:06d}-{count:06d}.tpl"
            own = f"{folder}/_{name}.{task.taskAttemptId()}"
            with store.open_output_stream(own) as file:
                file.write(content)
            store.move(own, f"{folder}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size])], ["name", "n_ids"])

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1), path), strict=True):
                ids = np.append(ids, np.uint32(END))
                if size and size + len(ids) > SHARD_IDS:
                    yield close()
                    held, names, size, count = [], [], 0, count + 1
                held.append(ids)
                names.append(name)
                size += len(ids)
        if held:
            yield close()

    return run


def write_planes(docs: DataFrame, to: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None, unit: str = "bit", partitions: int | None = None) -> int:
    """Encode every text and write container files into the folder ``to``, in ascending id order; returns all ids' number.

    ``to`` is a URI of a store that driver and executors share (file, hdfs, s3, gs, abfs). Null and empty texts are the
    end id alone. Rows without an id come first; rows that repeat an id follow each other by a hash of their texts. The
    id is an integer column. Other columns are ignored. ``bits`` is that of the tokenizer's largest id, if not given;
    an id that needs more is refused.
    """
    integer_ids(docs, id_col)
    if bits is None:
        bits = max(_pieces(tokenizer).tok.get_vocab_size() - 1, END).bit_length()
    store, folder = _store(to)
    store.create_dir(folder, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["id", "hash", "place"]
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions or parts(docs.sparkSession), *order).sortWithinPartitions(*order).select("id", "text")
    with arrow_rows(docs.sparkSession, ROWS_A_BATCH):
        return rows.mapInArrow(_write(to, tokenizer, bits, unit), "name string, n_ids long").agg(F.sum("n_ids")).first()[0] or 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([count_of(x.as_py()) for x in batch.column(2)], pa.int64())], ["part", "number", "n_ids"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, before in zip(batch.column("content"), batch.column("before"), strict=True):
            content = content.as_py()
            ids, sizes = read_container(content)
            ends = np.cumsum(sizes, dtype=np.int64)
            starts = ends - sizes
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names_of(content), pa.int64()), pa.array(starts + before.as_py()), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])


def read_planes(spark: SparkSession, at: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the container files in the folder ``at``."""
    number = lambda i: F.regexp_extract("path", r"part-(\d+)-(\d+)\.tpl$", i).cast("long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tpl").load(at).select(number(1).alias("part"), number(2).alias("number"), "content")
    counts = Scratch(spark, "places").save(files.mapInArrow(_counts, "part long, number long, n_ids long"), "counts")
    a_part = counts.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = a_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))  # a row a write task
    inside = counts.withColumn("in_part", F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids"))
    before = inside.join(before_part, "part").select("part", "number", (F.col("base") + F.col("in_part")).alias("before"))
    if counts.count() <= BROADCAST_CONTAINERS:
        before = F.broadcast(before)
    return files.join(before, ["part", "number"]).select("content", "before").mapInArrow(_read, "id long, start long, n_tokens long, ids_crc32 long")


def op4_bit_planes(spark, sf_dir: str) -> DataFrame:
    """The contract's query: every whole text of ``documents`` into files and back."""
    import public_tokenizers

    at = Scratch(spark, "planes").at("containers")
    write_planes(spark.read.parquet(f"{sf_dir}/documents.parquet"), at, public_tokenizers.path("byte_bpe_50k.json"))
    return read_planes(spark, at).withColumnRenamed("id", "doc_id")
