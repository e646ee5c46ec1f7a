"""Every query of the catalog against its SQL on the smallest tables."""

import pytest

from helpers import DATA, rows
from tidemark.plans import catalog
from tidemark.steps import Steps


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    if name in catalog.ORACLES:
        want = duck.execute(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", ["event_engine", "dense_description", "quiet_requests"])
def test_steps_are_joined_by_shuffle(spark, monkeypatch, name):
    """Their files are small beside their rows, so a broadcast by the size of files can fill the driver."""
    plans, write = [], Steps.__call__
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())

    def seen(self, df):
        plan(df)
        return write(self, df)

    monkeypatch.setattr(Steps, "__call__", seen)
    plan(catalog.QUERIES[name](spark, DATA))
    assert len(plans) > 5 and any("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "Broadcast" in p]


@pytest.mark.parametrize("most", [10_000, 0])
def test_short_items_leak(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(catalog, "BROADCAST_ITEMS", most)
    items = [(1, "moon"), (2, "red moon"), (3, "the red moon"), (4, "a b c d"), (5, "a b c d e"), (6, "a b c d e f"), (7, "a b c d e f g"), (8, ""), (9, None), (10, " \n"), (11, "not there")]
    docs = [(1, "so the red moons rise"), (2, "x a b c d e f g y"), (3, "moon"), (4, None), (5, ""), (6, "a b\nc d"), (6, "a  b c d e f")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.language_prior_leak(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted((i, d) for i, item in items for d, text in docs if item and item.split() and item in (text or ""))
