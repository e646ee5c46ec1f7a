import hashlib

import pytest

from tidemark.llm import exact_dedup, located

ROWS = [(1, "a b"), (2, "ab"), (3, "a\nb \t"), (4, None), (5, ""), (6, " \r"), (7, "x"), (7, "x"), (8, "é b"), (9, "éb"), (None, "q"), (None, "q "), (10, "A b"), (11, "ab "), (12, "z" * 5000), (13, "z " * 5000)]


def brute():
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in ROWS:
        groups.setdefault(norm(t), []).append((i, t))
    best = {g: sorted(m, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0][0] for g, m in groups.items()}
    return sorted((str(i), str(best[norm(t)]), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in ROWS)


@pytest.mark.parametrize(("chars", "trigger"), [(64, 64 << 30), (1, 64 << 30), (64, 1), (1, 1)])
def test_against_brute_force(spark, tmp_path, chars, trigger):
    """Also with digests that collide, and with a micro-batch for each file."""
    spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS size", "'f' AS file").repartition(4).write.parquet(str(tmp_path / "d"))
    got = exact_dedup.exact_duplicates(spark.read.parquet(str(tmp_path / "d")), digest_chars=chars, max_bytes_per_trigger=trigger).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == brute()
    assert sum(r["kept"] for r in got) == len({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_frame_without_files_and_stage(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "doc_id AS at")
    kept = exact_dedup.stage(spark, frame, "")
    assert kept.columns == ["doc_id", "text", "at"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["3", "6", "7", "8", "None", "10", "11", "13"])


@pytest.mark.parametrize("most", [located.BROADCAST_ROWS, 0])
def test_rows_of_one_file_row(spark, tmp_path, monkeypatch, most):
    """Rows that an explode makes of one row of a file are told apart, whether verdicts are broadcast or shuffled."""
    monkeypatch.setattr(located, "BROADCAST_ROWS", most)
    frame = spark.createDataFrame([(1, ["aaa", "bbb", "aaa"], 5), (2, ["b bb", None, ""], 6)], "doc_id long, texts array<string>, __file int")
    frame.coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d")).selectExpr("doc_id", "explode(texts) AS text", "__file")
    out = exact_dedup.stage(spark, docs, "")
    assert out.columns == docs.columns and sorted((r["doc_id"], r["text"] or "") for r in out.collect()) == [(1, "aaa"), (2, ""), (2, "b bb")]


def test_ids_must_be_integers(spark):
    with pytest.raises(ValueError, match="integer"):
        exact_dedup.exact_duplicates(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_very_long_text(spark):
    rows = [(1, "ab " * 1_000_000), (2, "a b" * 1_000_000), (3, "ab")]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 1)}


def test_empty(spark):
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
