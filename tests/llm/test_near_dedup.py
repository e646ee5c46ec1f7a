import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import near_dedup as nd
from tidemark.llm.components import components
from tidemark.llm.scratch import Scratch


def brute(docs, k, percent=80):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in docs:
        for c in "\t\n\x0b\x0c\r":
            text = (text or "").replace(c, " ")
        w = [x for x in text.translate(low).split(" ") if x]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    at = {i: i for i in sets}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                at[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus():
    r = random.Random(3)
    vocabulary = [f"w{i}é" for i in range(400)]
    docs, base = [], [[r.choice(vocabulary) for _ in range(r.randint(30, 300))] for _ in range(25)]
    for b in base:
        for _ in range(r.choice((1, 1, 2, 6))):
            w = list(b)
            for _ in range(r.randint(0, max(1, len(w) // 60))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            docs.append(r.choice((" ", "\n", "  ")).join(w))
    docs += [docs[0].upper().replace("É", "é")] * 3 + [None, "", " \n ", "one", "ONE", "one two", "a b c d", "A  B\tC D"]
    return [(i * 3 + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("k", [4, 5])
def test_against_brute_force(spark, k):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "5 AS n", "'x' AS id", "0 AS key", "1 AS c")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(frame, k=k).collect()}
    assert got == brute(docs, k)


def test_null_and_repeated_ids(spark):
    """Rows are nodes: an id that stands on two texts doesn't link them, and each group keeps one row."""
    text, other = " ".join(f"t{i}" for i in range(50)), "other words stand here in this one"
    rows = [(None, text), (None, text), (5, text), (5, other), (9, text), (4, other), (None, "no id but words of its own stand here"), (None, None), (7, ""), (7, "")]
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [
        ("4", "4", True), ("5", "4", False), ("5", "5", True), ("7", "7", True), ("7", "7", True), ("9", "5", False),
        ("None", "5", False), ("None", "5", False), ("None", "None", True), ("None", "None", True),
    ]


@pytest.mark.parametrize("exploded", [False, True])
def test_stage_loses_no_text_to_repeated_ids(spark, tmp_path, exploded):
    t, u = " ".join(f"t{i}" for i in range(40)), " ".join(f"u{i}" for i in range(40))
    rows = [(5, t), (5, u), (4, u), (None, t), (6, u + " u40")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__at", F.lit(1))
    if exploded:  # all rows stand in one row of a file
        frame.agg(F.collect_list(F.struct("doc_id", "text", "__at")).alias("x")).write.parquet(str(tmp_path / "d"))
        frame = spark.read.parquet(str(tmp_path / "d")).selectExpr("inline(x)")
    else:
        frame.write.parquet(str(tmp_path / "d"))
        frame = spark.read.parquet(str(tmp_path / "d"))
    out = nd.stage(spark, frame, "")
    assert out.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(4, u), (5, t)]


def test_ids_must_be_integers(spark):
    with pytest.raises(ValueError, match="integer"):
        nd.near_duplicates(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def templates():
    """Texts that share most of a template, at and under the similarity, so that buckets hold many components."""
    r = random.Random(8)
    base = [f"t{i}" for i in range(90)]
    docs = [" ".join(base)]
    for i in range(60):
        w = base + [f"own{i}x{j}" for j in range(r.choice((8, 14, 18, 22, 26, 40)))]
        docs.append(" ".join(w))
        if i % 5 == 0:
            docs.append(" ".join(w[:-2] + ["end", "here"]))
    return [(i * 2, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize(("block", "large", "make"), [(3, 10_000, templates), (3, 4, templates), (384, 2, corpus)])
def test_several_blocks_and_rare_shingles(spark, monkeypatch, block, large, make):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "LARGE", large)
    docs = make()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=4).collect()}
    assert got == brute(docs, 4)


def test_cells_hold_every_pair_with_a_leader(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 3)
    rows = [(k, 100 * k + i, i < lead) for k, (n, lead) in enumerate(((10, 10), (10, 1), (10, 0), (11, 4), (6, 5), (2, 2))) for i in range(n)]
    cells = {}
    for r in nd._in_blocks(spark.createDataFrame(rows, "key long, id long, lead boolean")).collect():
        cells.setdefault((r["key"], r["x"], r["y"]), []).append(r["id"])
    met = {(a, b) for ids in cells.values() for a in ids for b in ids if a < b}
    assert all((a, b) in met for k, a, one in rows for j, b, two in rows if k == j and a < b and (one or two))
    assert all(len(ids) == len(set(ids)) for ids in cells.values())


def test_a_large_component_meets_only_what_is_outside(spark):
    """A bucket of 5000 near copies in one component and two other members: a row or two a member, not one a block."""
    rows = spark.range(5002).selectExpr("7L AS key", "id", "if(id < 5000, 0L, id) AS c", "true AS lead")
    top = nd.mixed(rows).first()
    assert (top["top"], top["outside"]) == (0, 2)
    dealt = nd._in_blocks(rows.withColumn("lead", F.col("c") != 0).repartition(2))
    assert dealt.count() <= 5002 + 2 * (5002 // nd.BLOCK + 2)


def members_of(spark, sets):
    """Members (key, id, n, c) of one bucket and their sets (id, s)."""
    rows = [(i, len(s), np.sort(np.array(s, dtype=np.int64)).tobytes()) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "id long, n int, s binary")
    return frame.selectExpr("0L AS key", "id", "n", "id AS c"), frame.select("id", "s")


def test_a_template_of_many_texts_is_dealt_in_proportion(spark):
    """Members that share 84 of 100 shingles: under the similarity, and no bucket is left by rare ones."""

    def dealt(n):
        r = np.random.default_rng(1)
        base = r.integers(0, 2**62, 84)
        members, sets = members_of(spark, [np.concatenate((base, r.integers(0, 2**62, 16))) for _ in range(n)])
        return nd._dealt_on(members, sets, 80, Scratch(spark, "t"), "t")

    small, large = dealt(300).where("lead and not whole").count(), dealt(2000)
    assert small == large.where("lead").count() == 0
    assert large.count() <= 2000 * 21


def pooled(n, r):
    """Sets that share 60 of 100 shingles and take 4 of 50 pieces of 10 shingles: buckets of a piece grow with n."""
    return [[*range(60), *(1000 + 10 * p + j for p in r.sample(range(50), 4) for j in range(10))] for _ in range(n)]


def test_pieces_from_a_pool_are_dealt_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 48)
    monkeypatch.setattr(nd, "LARGE", 96)
    monkeypatch.setattr(nd, "WORTH", 0)

    def cells(n):
        members, sets = members_of(spark, pooled(n, random.Random(1)))
        return nd._in_blocks(nd.combined(members, sets, 80, Scratch(spark, "t"), "t")).count() / n

    a, b = cells(1000), cells(4000)
    print("cells a member", a, b)
    assert b < 2 * a


@pytest.mark.parametrize("percent", [80, 85])
def test_combined_keys_lose_no_pair(spark, monkeypatch, percent):
    """Every pair that is similar enough meets in a cell of a bucket in which one of them leads, whatever the levels."""
    monkeypatch.setattr(nd, "BLOCK", 4)
    monkeypatch.setattr(nd, "LARGE", 5)
    monkeypatch.setattr(nd, "WORTH", 0)
    r = random.Random(percent)
    sets = pooled(150, r)
    sets += [s[: r.randint(88, 100)] + [r.randrange(10**6, 10**9) for _ in range(r.randint(0, 9))] for s in sets[:60]]
    sets += [[*range(90), *(r.randrange(10**6, 10**9) for _ in range(r.randint(2, 12)))] for _ in range(40)]
    members, full = members_of(spark, sets)
    met = set()
    cells = {}
    for x in nd._in_blocks(nd.combined(members, full, percent, Scratch(spark, "t"), "t")).collect():
        cells.setdefault((x["key"], x["x"], x["y"]), []).append(x["id"])
    for ids in cells.values():
        met |= {(a, b) for a in ids for b in ids if a < b}
    whole = [set(s) for s in sets]
    similar = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(whole[a] & whole[b]) >= percent * len(whole[a] | whole[b])}
    assert similar and similar <= met


def test_empty(spark):
    assert nd.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_word_hashes_don_t_depend_on_pieces(monkeypatch):
    text = " ".join(f"w{i}é" * (i % 7) for i in range(3000)).encode() + b" " + b"x" * 5000 + b" end"
    raw, offsets = np.frombuffer(text, dtype=np.uint8), np.array([0, 40, len(text)])
    want = nd.words.hashes(raw, offsets, nd.words.NON_SPACE)
    monkeypatch.setattr(nd.words, "BLOCK_BYTES", 64)
    got = nd.words.hashes(raw, offsets, nd.words.NON_SPACE)
    assert all((a == b).all() for a, b in zip(want, got, strict=True)) and len(nd.words._POWERS[0]) > 64


def test_registers_merge_and_estimate():
    r = np.random.default_rng(2)
    x = np.unique(r.integers(0, 2**63, 900, dtype=np.uint64) * np.uint64(2))
    a, b = x[:600], x[300:]
    assert (nd.merge(nd.registers(a), nd.registers(b)) == nd.registers(x)).all()
    got = nd.likeliest(nd.registers(a)[None], nd.registers(b)[None], np.array([600]), np.array([600]))[0]
    assert abs(got - 1 / 3) < 0.1


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(100)] + [(200, 300)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"), "c").collect()}
    assert got == {**dict.fromkeys(range(101), 0), 200: 200, 300: 200}
