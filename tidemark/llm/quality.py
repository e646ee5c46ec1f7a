"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Vocabulary. Every white-space word yields three tokens: the word, its shape (classes of its first two and last two
bytes), and its state (repeats the word before it, ends a three-word run that the document had before, or new). Tokens
are hashed into ``VOCABULARY`` buckets, so the table of vectors has a fixed size. Each bucket has a sparse ternary
index vector; a bucket's word vector is the sum of the index vectors of the words and shapes around all its occurrences
in the whole corpus, scaled to length one, plus its own index vector. A document's features are the mean word, shape
and state vectors. A network of one hidden layer is trained in numpy on at most ``MOST_LABELLED`` labelled documents
and its temperature is fitted on labelled documents that training did not see.

Scale: texts are cut into words twice, for the vectors and for the scores; between them the labelled sample alone is
picked out by its broadcast ids. Vectors are summed in each task before the shuffle (integers, so the sum is exact in
any order) and are a table of fixed size on the driver; the labelled sample has one row an id and is bounded; no
document meets another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.scratch import Scratch, arrow_rows, give_back

WORDS, SHAPES, STATES = 3072, 1016, 8
VOCABULARY = WORDS + SHAPES + STATES
DIM, NONZERO = 64, 2
MOST_LABELLED = 20_000
HIDDEN, EPOCHS, BATCH, RATE = 32, 40, 128, 3e-3
THRESHOLD = 0.3
BLOCK = 1 << 20
#: Texts that a worker holds and scores at a time; it keeps much of the memory that larger batches once took.
ROWS_A_BATCH = 1000

_RNG = np.random.Generator(np.random.PCG64(5))
#: Places and signs of the index vectors; the last row, of no token, has none.
_PLACE = np.stack([_RNG.permutation(DIM)[:NONZERO] for _ in range(VOCABULARY + 1)])
_SIGN = _RNG.choice([-1.0, 1.0], (VOCABULARY + 1, NONZERO))
_SIGN[-1] = 0

#: Byte classes: lower, upper, digit, non-ASCII, white space, and each punctuation mark by itself.
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 4


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, shape, state bucket of each word, row of each word)."""
    h, starts, ends, at = words.hashes(raw, offsets, words.NON_SPACE)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    c, last = _CLASS[raw] if len(raw) else np.zeros(0, dtype=np.uint64), ends - 1
    shape = ((c[starts] * np.uint64(131) + c[np.minimum(starts + 1, last)]) * np.uint64(131) + c[np.maximum(last - 1, starts)]) * np.uint64(131) + c[last]
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    seen = np.zeros(len(h), dtype=bool)
    if len(h) > 2:
        run = words.mix(words.sequences(h, 3) + row[2:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(run, kind="stable")
        again = np.zeros(len(run), dtype=bool)
        again[order[1:]] = run[order[1:]] == run[order[:-1]]
        seen[2:] = again & (row[2:] == row[:-2])
    state = same.astype(np.int64) + 2 * seen
    return (h % np.uint64(WORDS)).astype(np.int64), WORDS + (words.mix(shape) % np.uint64(SHAPES)).astype(np.int64), WORDS + SHAPES + state, row


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a bucket: the sum of the index vectors around its occurrences in this task's documents."""
    total = np.zeros(VOCABULARY * DIM)
    for batch in batches:
        raw, offsets = words.buffer_of(batch.column(0))
        for lo, hi in words.blocks(offsets, BLOCK):
            part = offsets[lo : hi + 1]
            word, shape, state, row = tokens(raw[part[0] : part[-1]], part - part[0])
            for step in (-2, -1, 1, 2):
                for kind in (word, shape) if abs(step) == 1 else (shape,):
                    near = np.full(len(word), VOCABULARY)
                    to, of = (slice(step, None), slice(None, -step)) if step > 0 else (slice(None, step), slice(-step, None))
                    near[of] = np.where(row[of] == row[to], kind[to], VOCABULARY)
                    for j in range(NONZERO):
                        place, sign = _PLACE[near, j], _SIGN[near, j]
                        for target in (word, shape, state):
                            total += np.bincount(target * DIM + place, weights=sign, minlength=VOCABULARY * DIM)
    used = np.flatnonzero(total.reshape(VOCABULARY, DIM).any(axis=1))
    values = total.reshape(VOCABULARY, DIM)[used].astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(np.ascontiguousarray(values[:, d])) for d in range(DIM))], ["bucket", *(f"v{d}" for d in range(DIM))])
    give_back()


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The table of word vectors (VOCABULARY, DIM) over all texts."""
    schema = "bucket long, " + ", ".join(f"v{d} long" for d in range(DIM))
    sums = docs.select(text_col).mapInArrow(_context, schema).groupBy("bucket").agg(*(F.sum(f"v{d}").alias(f"v{d}") for d in range(DIM)))
    own = np.zeros((VOCABULARY, DIM))
    np.put_along_axis(own, _PLACE[:-1], _SIGN[:-1], axis=1)
    around = np.zeros((VOCABULARY, DIM))
    with arrow_rows(docs.sparkSession, ROWS_A_BATCH):
        for r in sums.collect():  # at most VOCABULARY rows
            around[r["bucket"]] = r[1:]
    around /= np.maximum(np.linalg.norm(around, axis=1, keepdims=True), 1e-9)
    return own / np.sqrt(NONZERO) + around


def pooled(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean word, shape and state vectors of each row; zeros for a row without words."""
    rows = len(offsets) - 1
    word, shape, state, row = tokens(raw, offsets)
    out = []
    for kind, base, size in ((word, 0, WORDS), (shape, WORDS, SHAPES), (state, WORDS + SHAPES, STATES)):
        counts = np.bincount(row * size + kind - base, minlength=rows * size).reshape(rows, size).astype(np.float32)
        out.append(counts @ table[base : base + size].astype(np.float32) / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    return np.concatenate(out, axis=1)


def features_of(column: pa.Array, table: np.ndarray) -> np.ndarray:
    raw, offsets = words.buffer_of(column)
    parts = [pooled(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], table) for lo, hi in words.blocks(offsets, BLOCK)]
    return np.concatenate(parts) if parts else np.zeros((0, 3 * DIM), dtype=np.float32)


class Network:
    """Two layers with a temperature; a constant where the labels have one class or none."""

    def __init__(self, x: np.ndarray, y: np.ndarray, fit: np.ndarray):
        self.base = float(y.mean()) if len(y) else 0.5
        self.live = 0 < y[fit].sum() < fit.sum() and len(set(y[~fit])) == 2
        if not self.live:
            return
        self.mean, self.scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
        rng = np.random.Generator(np.random.PCG64(11))
        a, b = (x[fit] - self.mean) / self.scale, y[fit].astype(float)
        p = [rng.normal(0, np.sqrt(2 / a.shape[1]), (a.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(a))
            for at in range(0, len(a), BATCH):
                i = order[at : at + BATCH]
                hidden = np.maximum(a[i] @ p[0] + p[1], 0)
                d = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30))) - b[i]) / len(i)
                back = d[:, None] * p[2] * (hidden > 0)
                step += 1
                for k, g in enumerate((a[i].T @ back + 1e-4 * p[0], back.sum(axis=0), hidden.T @ d + 1e-4 * p[2], d.sum(keepdims=True))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.p = p
        z, t = self.logits(x[~fit]), y[~fit]
        grid = np.geomspace(0.25, 8, 61)
        self.temperature = grid[np.argmin([np.mean(np.logaddexp(0, -np.where(t == 1, z, -z) / g)) for g in grid])]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.live:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(float)) / self.temperature, -30, 30)))


def _few(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS_A_BATCH):
        yield batch.slice(at, ROWS_A_BATCH)


def _features(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features_of(batch.column(1), table).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "x"])

    return run


def _scores(table: np.ndarray, model: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _few(batch):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.score(features_of(rows.column(1), table)), pa.float64())], ["id", "score"])
        give_back()

    return run


def part_of(col):
    """crc32 of the id as text modulo 5; part 0 is held out."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    """(word vectors, network). ``docs``: id, text; ``labels``: id, label 0 or 1.

    Labels of held-out ids, null labels and null ids are not used; an id's label is its labels' rounded mean. Of rows
    that repeat a labelled id the one of least features counts. Ids of part 1 set the temperature, the others train.
    """
    table = word_vectors(docs)
    known = labels.where("id is not null and label is not null").where(part_of(F.col("id")) != 0).groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("y"))
    share = min(1.0, 0.95 * MOST_LABELLED / max(1, known.count()))  # of the ids by their hash: MOST_LABELLED rows at most
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < round(share * 1_000_000))
    sample = docs.select("id", "text").join(F.broadcast(chosen.select("id")), "id", "left_semi").mapInArrow(_features(table), f"id {docs.schema['id'].dataType.simpleString()}, x binary")
    sample = sample.groupBy("id").agg(F.min("x").alias("x")).join(F.broadcast(chosen), "id")
    with arrow_rows(docs.sparkSession, ROWS_A_BATCH):
        got = sample.select("id", "x", "y", part_of(F.col("id")).alias("part")).toPandas().sort_values("id")
    x = np.frombuffer(b"".join(bytes(b) for b in got["x"]), dtype=np.float16).reshape(-1, 3 * DIM).astype(float)
    return table, Network(x, got["y"].to_numpy(dtype=int), (got["part"] != 1).to_numpy())


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, held_out, score, predicted) for each row: the calibrated probability that the text has label 1.

    Only the text is an input of a score. Null and empty texts have zero features and the network's score of those.
    Without labels of both classes every score is the share of label 1 (0.5 without any). Repeated rows are scored
    each; rows without an id are scored and never train. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table, model = fit(docs, labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")))
    scored = docs.mapInArrow(_scores(table, model), docs.select("id", F.lit(0.0).alias("score")).schema)
    return scored.select(F.col("id").alias(id_col), (part_of(F.col("id")) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op6_random_indexing_quality(spark, sf_dir: str) -> DataFrame:
    """The contract's query over every whole text of ``documents``."""
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _accepted(table: np.ndarray, model: Network, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _few(batch):
                yield rows.filter(pa.array(model.score(features_of(rows.column(text_at), table)) >= THRESHOLD))
        give_back()

    return run


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject the documents that the classifier predicts as label 0; each row is judged in place.

    Where the usable labels are not of both classes nothing was learnt, and all documents stay. The rest is written
    here, since the size of batches to the workers is a setting of the moment in which it is.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    table, model = fit(docs.select(F.col("doc_id").alias("id"), "text"), labels)
    if not model.live:
        return docs
    with arrow_rows(spark, ROWS_A_BATCH):
        return Scratch(spark, "quality").save(docs.mapInArrow(_accepted(table, model, docs.columns.index("text")), docs.schema), "accepted")
