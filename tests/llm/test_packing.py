import random
from itertools import product

import pytest

from tidemark.llm import packing as p


def check(lengths, where, offset, final, sizes):
    used = {}
    for n, b, o in zip(lengths, where, offset, strict=True):
        used.setdefault(b, []).append((o, n))
    for b, parts in used.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= final[b] and final[b] == min(s for s in sizes if s >= at)
    assert sorted(used) == list(range(len(final)))


@pytest.mark.parametrize("seed", range(6))
def test_bins_hold_and_are_small(seed):
    r = random.Random(seed)
    lengths = sorted((r.randint(1, 8192) if r.random() < 0.1 else r.randint(1, 900) for _ in range(2000)), reverse=True)
    where, offset, final = p.pack(lengths)
    check(lengths, where, offset, final, p.SIZES)
    single = p.pack(lengths, (8192,))[2]
    assert sum(map(p.cost, final)) < sum(map(p.cost, single))
    assert sum(lengths) / sum(final) > 0.97


def test_near_the_optimum_of_tiny_cases():
    r = random.Random(9)
    for _ in range(40):
        lengths = sorted((r.randint(1, 1000) for _ in range(5)), reverse=True)
        best = min(sum(p.cost(next(s for s in p.SIZES if s >= t)) for t in totals.values()) for a in product(range(5), repeat=5) if max((totals := {b: sum(n for n, x in zip(lengths, a, strict=True) if x == b) for b in set(a)}).values()) <= 8192)
        assert sum(map(p.cost, p.pack(lengths)[2])) <= 1.5 * best


def test_documents(spark):
    rows = [(i % 40, " ".join(["w"] * (i * 37 % 900))) for i in range(300)] + [(None, "x"), (None, None), (7, ""), (8, "y " * 20_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS length", "3 AS n", "4 AS shard")
    got = p.pack_documents(frame).toPandas()
    want = sum(len((t or "").split()) + 1 for _, t in rows)
    assert got.length.sum() == want and got.doc_id.isna().sum() == 2
    long = got[(got.doc_id == 8) & (got.length > 2000)].sort_values("piece")
    assert long.length.tolist() == [8192, 8192, 20001 - 16384] and long.start.tolist() == [0, 8192, 16384]
    for _, g in got.groupby("bin_id"):
        g = g.sort_values("bin_offset")
        assert (g.bin_offset.diff().dropna().to_numpy() == g.length.to_numpy()[:-1]).all() and g.length.sum() <= g.bin_size.iloc[0]
    assert p.pack_documents(frame.limit(0)).count() == 0


def test_own_lengths(spark):
    frame = spark.createDataFrame([(1, 5), (2, None), (3, 0), (4, 9000)], "doc_id long, n_tokens long")
    got = sorted((r["doc_id"], r["start"], r["length"]) for r in p.pack_documents(frame, length="n_tokens").collect())
    assert got == [(1, 0, 5), (4, 0, 8192), (4, 8192, 808)]


def test_query_measures_token_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    data = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{data}/documents.parquet").toPandas().set_index("doc_id").text
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {int(i): len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    got = p.op9_variable_best_fit(spark, data).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == ids
    bins = got.groupby("bin_id")
    assert (bins.length.sum() <= bins.bin_size.first()).all()


def test_tokens_of_awkward_rows(spark):
    import public_tokenizers

    rows = [(1, None), (2, ""), (3, "漢字" * 30_000), (None, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS length", "3 AS n")
    got = p.pack_documents(frame, tokenizer=public_tokenizers.path("byte_bpe_50k.json")).toPandas()
    assert got[got.doc_id.isin([1, 2])].length.tolist() == [1, 1] and got.doc_id.isna().sum() == 1
    assert got[got.doc_id == 3].length.sum() >= 60_001 // 2 and got.length.max() == 8192


@pytest.mark.parametrize("length, size", [(1, 1024), (5, 1024), (30, 1024), (100, 1024), (250, 1024), (400, 2048)])
def test_sizes_for_many_short_pieces(length, size):
    lengths = [length] * (size // length * 40)
    where, offset, final = p.pack(lengths)
    check(lengths, where, offset, final, p.SIZES)
    rates = {s: p.cost(s) / (s // length * length) for s in p.SIZES}
    assert min(rates, key=rates.get) == size and final == [size] * 40


def test_remainder_over_many_runs():
    lengths = sorted((1 + i % 60 for i in range(6000)), reverse=True)
    where, offset, final = p.pack(lengths)
    check(lengths, where, offset, final, p.SIZES)
    assert sum(map(p.cost, final)) / sum(lengths) < 1.065


def plain(lengths):
    """The same best fit by looking at every bin and every piece to come."""
    bins, stamp = [], 0
    for i, length in enumerate(lengths):
        stamp += 1
        fitting = [b for b in bins if b["room"] >= length]
        if fitting:
            b = min(fitting, key=lambda b: (b["room"], -b["stamp"]))
        else:
            best = None
            for size in p.SIZES:
                if size >= length:
                    room = size - length
                    for piece in lengths[i + 1 :]:
                        room -= piece if piece <= room else 0
                    rate = p.cost(size) / (size - room)
                    if best is None or rate < best[0]:
                        best = (rate, size)
            b = {"size": best[1], "room": best[1], "held": []}
            bins.append(b)
        b["room"] -= length
        b["stamp"] = stamp
        b["held"].append(length)
    return sorted((min(s for s in p.SIZES if s >= sum(b["held"])), tuple(b["held"])) for b in bins)


def test_query_against_brute_force(spark):
    got = p.op9_variable_best_fit(spark, "/root/testdata/sf0.001").toPandas()
    for _, shard in got.groupby(got.bin_id // 2**32):
        bins = shard.sort_values("bin_offset").groupby("bin_id")
        assert sorted((b.bin_size.iloc[0], tuple(b.length)) for _, b in bins) == plain(sorted(shard.length, reverse=True))
