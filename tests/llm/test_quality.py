import numpy as np
import pytest

from tidemark.llm import quality

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = quality.op6_random_indexing_quality(spark, DATA).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 50 and (got.predicted == got.quality).mean() > 0.95
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


@pytest.mark.parametrize(("labels", "want"), [([], 0.5), ([(1, 1), (2, 1), (3, None), (None, 0)], 1.0)])
def test_without_two_classes(spark, labels, want):
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "c"), (4, "x " * 200_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS label", "3 AS x")
    got = quality.quality_scores(frame, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == 6 and {r["score"] for r in got} == {want}


def test_held_out_labels_are_not_used(spark):
    import zlib

    rows = [(i, "good plain words here" if i % 2 else "BAD!! $$$ ###") for i in range(200)]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    score = lambda wrong: {r["doc_id"]: r["score"] for r in quality.quality_scores(frame, spark.createDataFrame([(i, (i % 2) ^ (wrong and i in held)) for i in range(200)], "doc_id long, quality int")).collect()}
    assert score(False) == score(True)


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert quality.quality_scores(frame, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_tokens_do_not_cross_rows():
    raw = np.frombuffer(b"same same", dtype=np.uint8)
    state = lambda offsets: quality.tokens(raw, np.array(offsets))[2] - quality.WORDS - quality.SHAPES
    assert state([0, 9]).tolist() == [0, 1] and state([0, 5, 9]).tolist() == [0, 0]


def slowly(texts):
    """Tokens and word vectors worked out word by word."""
    import math

    def shape(w):
        kind = lambda b: 1 if 97 <= b <= 122 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else 4 if b > 127 else b
        value = 0
        for b in (w[0], w[1] if len(w) > 1 else w[0], w[-2] if len(w) > 1 else w[0], w[-1]):
            value = (value * 131 + kind(b)) % 2**64
        return quality.WORDS + int(quality.words.mix(np.array([value], dtype=np.uint64))[0]) % quality.SHAPES

    docs = []
    for text in texts:
        ws = [w for w in (text or "").encode().replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if w]
        seen, rows = set(), []
        for i, w in enumerate(ws):
            low = lambda x: x.decode().translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            run = tuple(map(low, ws[i - 2 : i + 1])) if i > 1 else None
            state = (i > 0 and low(w) == low(ws[i - 1])) + 2 * (run in seen)
            if run:
                seen.add(run)
            h = quality.words.hashes(np.frombuffer(w, dtype=np.uint8), np.array([0, len(w)]), quality.words.NON_SPACE)[0]
            rows.append((int(h[0]) % quality.WORDS, shape(w), quality.WORDS + quality.SHAPES + state))
        docs.append(rows)
    around = {}
    for rows in docs:
        for i, targets in enumerate(rows):
            for step in (-2, -1, 1, 2):
                if 0 <= i + step < len(rows):
                    for kind in (0, 1) if abs(step) == 1 else (1,):
                        near = rows[i + step][kind]
                        for j in range(quality.NONZERO):
                            for t in targets:
                                around.setdefault(t, [0] * quality.DIM)[quality._PLACE[near, j]] += quality._SIGN[near, j]

    def vector(t):
        v = [0.0] * quality.DIM
        for j in range(quality.NONZERO):
            v[quality._PLACE[t, j]] = quality._SIGN[t, j] / math.sqrt(quality.NONZERO)
        sums = around.get(t, [0] * quality.DIM)
        length = max(math.sqrt(sum(x * x for x in sums)), 1e-9)
        return [a + b / length for a, b in zip(v, sums, strict=True)]

    return [[sum(vector(r[k])[x] for r in rows) / max(len(rows), 1) for k in range(3) for x in range(quality.DIM)] for rows in docs]


def test_features_against_brute_force(spark):
    import pyarrow as pa

    texts = ["the red moon the red moon the", "Don't go\tgo GO 12 a!\n\nÉt é", None, "", "one", "x y x y x y x y"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = quality.features_of(pa.array(texts), quality.word_vectors(frame))
    assert np.allclose(got, slowly(texts), atol=1e-5)


def test_a_repeated_labelled_id_trains_once(spark):
    rows = [(i, "good plain words here" if i % 2 else "BAD!! $$$ ###") for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    many = rows + [rows[7]] * 500
    assert quality.fit(*(spark.createDataFrame(x, "id long, text string") for x in (many,)), labels.selectExpr("doc_id AS id", "quality AS label"))[1].live


def test_stage_keeps_all_where_nothing_was_learnt(spark, tmp_path):
    spark.createDataFrame([(i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(20)], "doc_id long, text string")
    assert quality.stage(spark, docs, str(tmp_path)).count() == 20


def test_short_texts_in_a_large_batch_hold_little():
    """20,000 texts of three words: under 100 MB, where all rows at once took 756 MB."""
    import tracemalloc

    import pyarrow as pa

    model = quality.Network(np.random.default_rng(1).normal(size=(40, 3 * quality.DIM)), np.arange(40) % 2, np.arange(40) % 3 > 0)
    batch = pa.RecordBatch.from_arrays([pa.array(range(20_000)), pa.array([f"a b{i % 7} c" for i in range(20_000)])], ["id", "text"])
    table = np.ones((quality.VOCABULARY, quality.DIM))
    for run, rows in ((quality._scores(table, model), 20_000), (quality._accepted(table, model, 1), None)):
        tracemalloc.start()
        n = sum(x.num_rows for x in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100e6 and n == (rows or n), peak
