import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bitplanes as bp
from tidemark.llm.scratch import Scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("unit", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000, 1001])
def test_container_round_trip(unit, n):
    ids = np.random.default_rng(n).integers(0, 2**17, n).astype("<u4")
    sizes = np.array([n // 3, 0, n - n // 3])
    back, got = bp.read_container(bp.write_container(ids, sizes, bits=17, unit=unit, block=256))
    assert (back == ids).all() and (got == sizes).all()


def test_high_planes_shrink():
    ids = np.random.default_rng(1).integers(0, 256, 100_000)
    assert len(bp.write_container(ids, np.array([len(ids)]), bits=32)) < 110_000


def test_query_against_the_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(bp, "SHARD_IDS", 64)
    texts = [None, "", " ", "a", "two  spaces", " lead and trail ", "tab\t x \n y", "don't <|endoftext|> stop", "é à ü　z", "’ x ‘ y — z", "​ zero", "long " * 400, "same words same words", "x y z"]
    rows = [(i * 7 % 50, t) for i, t in enumerate(texts)] + [(None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS part")
    at = Scratch(spark, "t").at("c")
    total = bp.write_planes(frame, at, PATH, partitions=3)
    got = sorted((r["start"], r["id"], r["n_tokens"], r["ids_crc32"]) for r in bp.read_planes(spark, at).collect())
    files = spark.read.format("binaryFile").load(at).collect()
    assert len(files) > 3 and all(bytes(f["content"][:4]) == bp.MAGIC and re.search(r"/part-\d{6}-\d{6}\.tpl$", f["path"]) for f in files)
    assert total == sum(r[2] for r in got)
    tok, at, want = Tokenizer.from_file(PATH), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((at, i, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_repeated_and_missing_ids_fill_no_range_alone(spark, monkeypatch):
    rows = [(None, "x")] * 300 + [(7, f"text {i}") for i in range(300)] + [(8, "y")]
    at = Scratch(spark, "t").at("c")
    bp.write_planes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), at, PATH, partitions=6)
    got = bp.read_planes(spark, at).toPandas().sort_values("start")
    assert len(got) == 601 and got.id.isna().to_list() == [True] * 300 + [False] * 301 and got.id.iloc[-1] == 8
    assert (got.start.to_numpy()[1:] == (got.start + got.n_tokens).to_numpy()[:-1]).all()
    assert len({f["path"] for f in spark.read.format("binaryFile").load(at).select("path").collect()}) > 3


def test_ids_over_the_bits_are_refused():
    with pytest.raises(ValueError, match="16 bits"):
        bp.write_container(np.array([70_000]), np.array([1]), bits=16)


def test_names_stay():
    content = bp.write_container(np.arange(5), np.array([2, 0, 3]), names=[4, None, -1])
    assert bp.names_of(content) == [4, None, -1] and [x.tolist() for x in bp.read_container(content)] == [[0, 1, 2, 3, 4], [2, 0, 3]]
    assert bp.names_of(bp.write_container(np.arange(5), np.array([5]))) is None


def test_a_tokenizer_that_joins_over_spaces_gets_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models

    vocabulary = {c: i for i, c in enumerate(["a", "b", " ", "a ", "a b", "[UNK]"])}
    Tokenizer(models.BPE(vocabulary, [("a", " "), ("a ", "b")], unk_token="[UNK]")).save(str(tmp_path / "t.json"))
    import pyarrow as pa

    assert [x.tolist() for x in bp.encode(pa.array(["a b", "b a", None, ""]), str(tmp_path / "t.json"))] == [[4], [1, 2, 0], [], []]


def test_very_long_text_is_one_document(spark):
    at = Scratch(spark, "t").at("c")
    text = "word é1 " * 200_000
    bp.write_planes(spark.createDataFrame([(1, text), (0, None)], "doc_id long, text string"), at, PATH)
    got = sorted((r["id"], r["start"], r["n_tokens"]) for r in bp.read_planes(spark, at).collect())
    n = len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids) + 1
    assert got == [(0, 0, 1), (1, 1, n)]


def test_empty(spark):
    at = Scratch(spark, "t").at("c")
    assert bp.write_planes(spark.createDataFrame([], "doc_id long, text string"), at, PATH) == 0
    assert bp.read_planes(spark, at).count() == 0


@pytest.mark.parametrize("most", [bp.CACHE, 40, 3])
def test_pieces_in_use_stay(most, monkeypatch):
    """Of many pieces the rare ones are forgotten, not all; ids are the same with any memory."""
    import pyarrow as pa

    asked = []
    own = Tokenizer.from_file(PATH)
    texts = [" ".join(["start", *(f"one{i}x{j} and the same" for j in range(4)), "end"]) for i in range(60)] + ["é  à\n two", "", None]
    bp.forget()
    pieces = bp._pieces(PATH)
    new = pieces.encode_new
    monkeypatch.setattr(pieces, "encode_new", lambda raw, starts, ends, odd: asked.extend(raw[a:b].tobytes() for a, b in zip(starts, ends, strict=True)) or new(raw, starts, ends, odd))
    for at in range(0, len(texts), 2):
        got = [x.tolist() for x in bp.encode(pa.array(texts[at : at + 2], pa.string()), PATH, most)]
        assert got == [own.encode(t or "", add_special_tokens=False).ids for t in texts[at : at + 2]]
    bp.forget()
    assert most < 40 or asked.count(b" same") == asked.count(b" the") == 1
