import random

import numpy as np
import pytest

from helpers import DATA, rows
from test_near_dedup import brute, corpus, templates
from tidemark.llm import near_dedup as nd
from tidemark.llm import oracles
from tidemark.llm import set_join as sj


def joined(spark, docs, **how):
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "5 AS n", "'x' AS id", "0 AS key", "1 AS c", "2 AS first")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in sj.jaccard_join(frame, **how).collect()}


def pooled_texts():
    """Texts of whole pieces from a small pool, so that all their shingles are frequent, and some changed ones."""
    r = random.Random(11)
    pieces = [" ".join(f"p{p}w{i}" for i in range(12)) for p in range(12)]
    docs = [" ".join(["head " * 4 + "of all texts", *r.sample(pieces, 5)]) for _ in range(120)]
    for i in range(0, 40, 2):
        w = docs[i].split()
        w[r.randrange(len(w))] = "other"
        docs.append(" ".join(w))
    long = [f"long{r.randrange(3000)}" for _ in range(4000)]
    docs += [" ".join(long), " ".join(long[:3900]), " ".join(long[:3000])]
    return [(i * 2 + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize(("k", "percent", "block", "large", "make"), [(4, 85, 384, 3072, corpus), (5, 80, 3, 2, corpus), (4, 80, 3, 4, templates), (4, 85, 4, 3, pooled_texts)])
def test_against_brute_force(spark, monkeypatch, k, percent, block, large, make):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "LARGE", large)
    if large < 100:
        monkeypatch.setattr(nd, "WORTH", 0)
    docs = make()
    assert joined(spark, docs, k=k, percent=percent) == brute(docs, k, percent)


def test_parity_bits_never_exceed_the_difference():
    r = np.random.default_rng(5)
    for n in (3, 200, 2000, 30_000):
        x = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        y = np.unique(np.concatenate((x[: int(0.9 * len(x))], r.integers(0, 2**63, n // 20, dtype=np.uint64))))
        a, b = (sj.parity(v, sj.n_bits(len(v))) for v in (x, y))
        size = min(len(a), len(b))
        bits = np.bitwise_count(sj.folded(a, size) ^ sj.folded(b, size)).sum(dtype=int)
        assert bits <= len(np.setxor1d(x, y))
        assert (sj.folded(sj.parity(x, 4096), 64) == sj.parity(x, 512)).all()


def test_nulls_repeats_and_types(spark):
    text = " ".join(f"t{i}" for i in range(50))
    docs = [(None, text), (5, text), (5, "other words stand here in this one"), (9, text + " more"), (7, None), (7, ""), (8, " \n ")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((str(r[0]), r[1], str(r[2])) for r in sj.jaccard_join(frame).collect())
    assert got == [("5", 3, "5"), ("5", 46, "5"), ("7", 0, "7"), ("7", 0, "7"), ("8", 0, "8"), ("9", 47, "5"), ("None", 46, "5")]
    assert sj.jaccard_join(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="integer"):
        sj.jaccard_join(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_query(spark, duck):
    got, want = sj.op12_combination_join(spark, DATA).toPandas(), duck.execute(oracles.OP12).df()
    assert rows(got) == rows(want)
