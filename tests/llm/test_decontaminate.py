import random
import tracemalloc
import re

import numpy as np
import pytest

from tidemark.llm import decontaminate as d


def split(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w = split(text)
        hit, found, longest = set(), set(), 0
        for name, item in items:
            v = split(item)
            n = min(window, len(v))
            if not n:
                continue
            wanted = {tuple(v[a : a + n]) for a in range(len(v) - n + 1)}
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in wanted:
                    hit |= set(range(a, a + n))
                    found.add(str(name))
                    for b in range(len(v) - n + 1):
                        m = 0
                        while a + m < len(w) and b + m < len(v) and w[a + m] == v[b + m]:
                            m += 1
                        longest = max(longest, m if m >= n else 0)
        out.append((str(i), len(w), len(hit), tuple(sorted(found)), longest))
    return sorted(out)


def corpus():
    r = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["é", "Ü9"]
    pick = lambda n: [r.choice(words) for _ in range(n)]
    items = [(i, " ".join(pick(n))) for i, n in enumerate((30, 25, 12, 10, 9, 3, 1, 40))] + [(20, None), (21, "!!"), (3, "second text of item three is here w1")]
    docs = []
    for i in range(60):
        w = pick(r.randint(0, 80))
        if i % 3 == 0:
            v = split(items[i % 8][1])
            a = r.randrange(max(1, len(v) - 12))
            at = r.randint(0, len(w))
            w[at:at] = [x.upper() for x in v[a : a + r.randint(8, 20)]]
        docs.append((i, r.choice((" ", ", ", "-\n")).join(w)))
    return docs + [(None, items[0][1]), (5, items[0][1]), (61, None), (62, ""), (63, " ".join(pick(20_000)))], items


@pytest.mark.parametrize("block", [d.BLOCK_BYTES, 200])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(d, "SHARD_BYTES", 900)
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS item_id", "3 AS spans")
    got = d.matches(frame, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block).collect()
    mine = sorted((str(r["id"]), r["n_words"], sum(r["spans"][1::2]) - sum(r["spans"][::2]), tuple(r["items"]), r["longest"]) for r in got)
    assert mine == brute(docs, items)


@pytest.mark.parametrize("block", [d.BLOCK_BYTES, 200])
def test_stage_judges_each_row(spark, tmp_path, monkeypatch, block):
    """Also rows that an explode makes of one row of a file, and with a benchmark of several blocks."""
    monkeypatch.setattr(d, "BLOCK_BYTES", block)
    docs, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, [[t, "clean and short"]]) for i, t in docs], "doc_id long, x array<array<string>>").write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d")).selectExpr("doc_id", "explode(x[0]) AS text", "1 AS id", "2 AS spans")
    out = d.stage(spark, frame, str(tmp_path))
    assert out.columns == frame.columns
    bad = {i for i, row in enumerate(docs) if any(r[2] for r in brute([row], items))}
    want = [(str(i), t or "") for n, (i, t) in enumerate(docs) if n not in bad] + [(str(i), "clean and short") for i, _ in docs]
    assert bad and sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect()) == sorted(want)


def test_text_columns_have_their_own_names(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, body string")
    items = spark.createDataFrame([(1, "b c")], "item_id long, question string")
    assert d.matches(docs, items, text_col="body", item_text_col="question").first()["items"] == ["1"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["items"]) for r in d.matches(docs, none).collect()] == [(2, [])]
    assert d.matches(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 50, 400])
def test_suffix_array(n):
    t = np.random.default_rng(n).integers(1, 4, n).astype(np.uint64)
    order = d.suffix_array(t, n)
    assert order.tolist() == sorted(range(n), key=lambda i: t[i:].tolist())


def test_items_without_an_id_hit_but_have_no_name(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x y")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "b c"), (7, "c d"), (None, "x y")], "item_id long, text string")
    got = {r["id"]: (r["spans"], r["items"], r["longest_item"]) for r in d.matches(docs, items).collect()}
    assert got == {1: ([1, 4], ["7"], None), 2: ([0, 2], [], None)}


def test_equal_items_cost_places_plus_items():
    """2,000 items under one line and 2,000 documents with it: under 200 MB, where each pair's 11 windows took 350 MB."""
    line = " ".join(f"line{i}" for i in range(20))
    items = d.Queries(list(range(2000)), [f"{line} own{i}" for i in range(2000)], 10)
    docs = d.pa.array([f"doc{i} {line} end{i}" for i in range(2000)], d.pa.large_string())
    tracemalloc.start()
    ((_, rows, n_hit, (_, spans, windows, best, best_at, best_item)),) = d._found(docs, items)
    batches = sum(b.num_rows for b in d._scan(items)(iter([d.pa.RecordBatch.from_arrays([d.pa.array(range(2000)), docs], ["id", "text"])])) if set(map(len, b.column(3).to_pylist())) == {2000})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == batches == 2000 and (n_hit == 20).all() and spans[5] == [1, 21] and {len(w) for w in windows} == {11}
    assert set(best) == {20} and set(best_at) == {1} and set(best_item) == {0}
    assert peak < 200e6, peak


def test_a_search_holds_little_of_a_large_batch():
    """6 MB of text under a small benchmark: under 70 MB, where one shard of all took 148 MB."""
    items = d.Queries([1], ["one two three four five six seven eight nine ten"], 10)
    text = " ".join(f"w{i}" for i in range(1000))
    docs = d.pa.array([text] * 1200, d.pa.large_string())
    tracemalloc.start()
    n = sum(rows for _, rows, n_hit, _ in d._found(docs, items) if not n_hit.any())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1200 and peak < 70e6, peak
