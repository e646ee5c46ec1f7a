import duckdb
import pandas as pd
import pytest

from helpers import DATA, rows
from tidemark.llm import oracles, quotes

TALK = [
    (1, 0, "user", "Hello there.\nHow are you?"),
    (1, 1, "assistant", "> How  ARE you?\nFine, thanks."),
    (1, 2, "user", "On Monday you wrote:\n> > How are you?\n> Fine, thanks.\nGood."),
    (1, 3, "assistant", ">> How are you?\r\n>Fine, thanks.\r\n>Good.\r\nBye."),
    (1, 4, "user", ">\n> \nonly blank quotes"),
    (2, 0, "user", "Fine, thanks."),
    (2, 1, "assistant", "> Good.\n\n> never said\nquoting another talk"),
    (2, 2, "user", "> self\nself"),
    (2, 2, "user", "> Fine, thanks.\nsecond text of the same turn"),
    (3, 0, "user", None),
    (3, 1, "user", ""),
    (3, None, "user", "> Hello there.\nno turn"),
    (None, 4, None, "> Hello there."),
]


def compare(spark, talk):
    frame = pd.DataFrame(talk, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", frame)
    want = con.execute(oracles.OP1_LINKS).df()
    source = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    got = quotes.link_quotes(source.selectExpr("*", "1 AS runs", "2 AS hash", "3 AS conv")).toPandas()
    assert rows(got) == rows(want)
    return got


def test_against_sql(spark):
    got = compare(spark, TALK)
    one = got[(got.conv_id == 1) & (got.turn == 2)].iloc[0]
    assert (one.reply, one.n_quotes, one.max_level, one.n_linked, one.parent_turn, one.thread_turn, one.depth) == ("On Monday you wrote:\nGood.", 2, 2, 2, 1, 0, 2)
    other = got[(got.conv_id == 2) & (got.turn == 1)].iloc[0]
    assert (other.source_conv, other.source_turn, other.n_linked) == (1, 2, 1) and pd.isna(other.parent_turn)


def test_long_chain_and_hot_passage(spark):
    """Turns over several buckets, one passage in all of them, each turn quoting the one before."""
    talk = [(7, i, "user", f"the common line\nmine {i}" + (f"\n> mine {i - 1}" if i % 2 else f"\n> the common line\n> mine {i - 1}" if i else "")) for i in range(0, 1300)]
    got = compare(spark, talk)
    assert (got.sort_values("turn").parent_turn.to_list()[1:] == [float(i - 1) for i in range(1, 1300)]) and got.depth.max() == 1299


def test_conversations(spark):
    source = spark.createDataFrame(TALK + [TALK[0]], "conv_id long, turn long, role string, text string")
    links = quotes.link_quotes(source)
    got = quotes.reply_ordered(links).collect()
    assert sum(r["n_messages"] for r in got) == len(TALK) + 1
    threads = {(r["conv_id"], r["thread_turn"], r["part"]): [(m["turn"], m["role"], m["reply"], m["copies"]) for m in r["messages"]] for r in got if r["part"] is not None}
    assert threads[1, 0, 0] == [
        (0, "user", "Hello there.\nHow are you?", 2), (1, "assistant", "Fine, thanks.", 1), (2, "user", "On Monday you wrote:\nGood.", 1), (3, "assistant", "Bye.", 1),
    ]
    assert threads[1, 4, 0] == [(4, "user", "only blank quotes", 1)]
    assert sorted(r["messages"][0]["reply"] for r in got if r["part"] is None) == ["", "no turn"]
    assert quotes.reply_ordered(links.limit(0)).count() == 0


def test_a_long_thread_comes_in_parts(spark):
    talk = [(7, i, "user", f"mine {i}" + (f"\n> mine {i - 1}" if i else "")) for i in range(1100)]
    got = sorted((r["part"], len(r["messages"])) for r in quotes.reply_ordered(quotes.link_quotes(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"))).collect())
    assert got == [(0, 512), (1, 512), (2, 76)]


def test_very_long_message(spark):
    text = "line of words\n" * 20_000 + "end"
    talk = [(1, 0, "user", text), (1, 1, "assistant", "> " + text.replace("\n", "\n> ") + "\nreply")]
    got = {r["turn"]: r for r in quotes.link_quotes(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).collect()}
    assert (got[1]["reply"], got[1]["parent_turn"], got[1]["n_linked"], got[0]["reply"]) == ("reply", 0, 1, text)


def test_most_conversations_of_the_query_are_linked(spark):
    got = quotes.op1_quote_linking(spark, DATA).toPandas()
    assert got.groupby("conv_id").n_linked.sum().gt(0).mean() > 0.5 and got.max_depth.max() > 1
    assert got.n_linked.sum() < got.n_quotes.sum()


def test_empty(spark):
    assert quotes.link_quotes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_ids_must_be_integers(spark):
    with pytest.raises(ValueError, match="integer"):
        quotes.link_quotes(spark.createDataFrame([("a", 1, "user", "x")], "conv_id string, turn long, role string, text string"))
