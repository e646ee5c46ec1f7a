import hashlib
import math
import random

import numpy as np
import pytest

from helpers import DATA, rows
from tidemark.llm import delta_lloyd as dl
from tidemark.llm import oracles


def brute(vectors, dims, k, rounds):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors if v and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in order[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        own = assigned()
        for j in range(len(c)):
            if mine := [v for (_, v), (_, o) in zip(kept, own, strict=True) if o == j]:
                c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    own = assigned()
    total = [sum(d for d, o in own if o == j) for j in range(len(c))]
    text = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted((str(i), o, d, total[o], sum(total), text[o]) for (i, _), (d, o) in zip(kept, own, strict=True))


def some(n, dims, r):
    base = [[r.gauss(0, 0.3) for _ in range(dims)] for _ in range(5)]
    out = [(i * 7 - 20, [x + r.gauss(0, 0.05) for x in r.choice(base)]) for i in range(n)]
    out += [(900 + i, list(out[0][1])) for i in range(n // 3)]  # copies: centroids that start equal, and stay empty
    out += [(5, [1.0] * dims), (5, [-1.0] * dims), (None, [0.1] * dims), (None, [0.2] * dims)]
    out += [(1, None), (2, []), (3, [0.5] * (dims - 1)), (4, [0.5] * (dims + 1)), (6, [None] + [0.5] * (dims - 1)), (7, [float("nan")] + [0.5] * (dims - 1)), (8, [float("-inf")] * dims)]
    return out


@pytest.mark.parametrize(("n", "k", "rounds"), [(200, 16, 3), (60, 4, 12), (9, 16, 3), (40, 3, 0), (3, 1, 2)])
def test_against_plain_lloyd(spark, n, k, rounds):
    vectors = some(n, 6, random.Random(n))
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS owner", "'x' AS v").repartition(3)
    got = dl.delta_lloyd(frame, dims=6, k=k, rounds=rounds).collect()
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == brute(vectors, 6, k, rounds)


def test_only_what_can_change_is_compared():
    """The rounds by changes give what comparing all gives, ties included, whichever centroids changed."""
    r = np.random.default_rng(1)
    for _ in range(300):
        v, c = r.integers(-3, 4, (40, 2)), r.integers(-3, 4, (6, 2))
        owner, dist = dl.nearest(v, c)
        new = c.copy()
        which = r.random(6) < 0.4
        new[which] += r.integers(-1, 2, (which.sum(), 2))
        got = dl.nearest(v, new, owner, dist, (new != c).any(axis=1))
        want = dl.nearest(v, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_empty_large_and_text_ids(spark):
    none = spark.createDataFrame([(1, None), (2, [0.5])], "vec_id long, embedding array<double>")
    out = dl.delta_lloyd(none)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and not out.count()
    named = spark.createDataFrame([("a", [0.5, 1.0]), ("b", [0.0, 0.0])], "name string, x array<float>")
    assert {r["name"]: r["distance"] for r in dl.delta_lloyd(named, "name", "x", dims=2).collect()} == {"a": 0, "b": 0}
    with pytest.raises(Exception, match="too large"):
        dl.delta_lloyd(spark.createDataFrame([(1, [1e7])], "vec_id long, embedding array<double>"), dims=1).collect()


def test_query(spark, duck):
    got, want = dl.op11_delta_lloyd(spark, DATA).toPandas(), duck.execute(oracles.OP11).df()
    assert len(got) == 500 and rows(got) == rows(want)
