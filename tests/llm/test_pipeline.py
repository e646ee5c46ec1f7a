"""The pipeline against plain Python on the smallest tables, and its stages on awkward rows."""

import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_decontaminate import brute as contaminated
from test_near_dedup import brute as near
from tidemark.llm import quality

DATA = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs = pd.read_parquet(f"{DATA}/documents.parquet")
    scored = quality.op6_random_indexing_quality(spark, DATA).toPandas().set_index("doc_id")
    left = docs[docs.doc_id.map(scored.predicted) == 1].copy()
    left["norm"] = left.text.map(lambda t: "".join(c for c in t if c not in " \t\n\x0b\x0c\r"))
    left = left.sort_values("doc_id").assign(n=lambda x: -x.text.str.len()).sort_values(["norm", "n", "doc_id"]).drop_duplicates("norm")
    groups = near(list(zip(left.doc_id, left.text, strict=True)), 5)
    left = left[left.doc_id.map(lambda i: groups[i][1] == i)]
    items = list(pd.read_parquet(f"{DATA}/benchmark.parquet").itertuples(index=False, name=None))
    bad = {int(r[0]) for r in contaminated(list(zip(left.doc_id, left.text, strict=True)), items) if r[2]}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {int(i): len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in zip(left.doc_id, left.text, strict=True) if i not in bad}
    got = corpus_pipeline.run(spark, DATA).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == want
    assert (got.groupby("bin_id").length.sum() <= got.groupby("bin_id").bin_size.first()).all()


def test_stages_keep_columns_and_awkward_rows(spark, tmp_path):
    rows = [(1, "good plain words in a row here", "en", None, 3), (1, "good plain words in a row here", "en", "s", 3), (None, None, None, None, None), (3, "", "en", "s", 0), (None, "no id but a text", None, None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS id", "'k' AS key").write.parquet(str(tmp_path / "d"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.read.parquet(str(tmp_path / "d"))
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
        got = out.count()
        assert got == {"exact_dedup": 3, "near_dedup": 4}.get(name, 5), name
    assert corpus_pipeline.STAGES[-1][1](spark, spark.read.parquet(str(tmp_path / "d")), DATA).count() == 5


@pytest.mark.parametrize("name", ["op1_quote_linking", "op2_setsketch_near_dedup", "op3_streaming_exact_dedup", "op8_suffix_array_decontamination", "op10_temporal_url_lists"])
def test_queries_against_sql(spark, duck, name):
    from helpers import rows
    from tidemark.llm.catalog import ORACLES, QUERIES

    got, want = QUERIES[name](spark, DATA).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
