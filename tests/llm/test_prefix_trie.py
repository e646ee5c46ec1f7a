import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from helpers import DATA, rows
from tidemark.llm import oracles
from tidemark.llm import prefix_trie as pt


def own_turns(data):
    """Ordered (role, text) of each conversation."""
    out = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            out[c].append(((turn is not None, turn or 0), role, hashlib.md5(text.encode()).hexdigest(), text))
    return {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in out.items()}


def with_heads(own):
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def brute(conversations):
    nodes = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(nodes[k]) - 1) * len(k[-1][1]) if k else 0)
    ends = {k: ",".join(map(str, sorted(c for c in m if len(conversations[c]) == len(k)))) for k, m in nodes.items()}
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else -(10**9), len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in nodes.items())


def got(frame):
    return sorted((r[0], r[1], -(10**9) if r[2] is None else r[2], *tuple(r)[3:]) for r in frame.collect())


def some(r, n):
    data = []
    for i in range(n):
        c = r.choice((i, i * 3, -i, 100 * (i % 7)))
        for t in range(r.choice((0, 1, 2, 3, 9))):
            data.append((c, r.choice((t, t, t, None, 1)), r.choice(("user", "user", "bot", None)), r.choice(("", "hi", "hé", "thé long text " * 5, None))))
    data += [(4, 1, "user", "hi")] * 5 + [(None, 1, "user", "no id")]
    r.shuffle(data)
    return data


@pytest.fixture
def frame(spark):
    def make(data):
        return spark.createDataFrame(data, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "2 AS d", "'x' AS f", "3 AS points")

    return make


@pytest.mark.parametrize("bits", [64, 3])
def test_against_brute_force(frame, bits):
    """Three bits make almost every group a collision of several nodes, and of several turns."""
    data = some(random.Random(bits), 60)
    own = own_turns(data)
    assert got(pt.prefix_trie(frame(data), bits=bits)) == brute(own)
    assert got(pt.shared_heads(frame(data), bits=bits)) == brute(with_heads(own))


def test_long_conversation_over_partitions(frame, monkeypatch):
    """A conversation that several range partitions share, and one that differs from it in its last turn."""
    monkeypatch.setattr(pt, "DEPTHS", 64)
    data = [(c, t, "user", f"t{t}") for c in (7, 8, 9) for t in range(1500)] + [(8, 1500, "bot", "end"), (9, 1500, "bot", "other end"), (10, 1, "user", "t0")]
    assert got(pt.prefix_trie(frame(data).repartition(5))) == brute(own_turns(data))


def test_ids_that_end_at_one_node(frame, monkeypatch):
    data = [(c, 1, "user", "same") for c in range(3000)]
    assert got(pt.prefix_trie(frame(data))) == brute(own_turns(data))
    out = [b.to_pylist() for b in pt._digests(iter(pt.pa.RecordBatch.from_arrays([pt.pa.array(x) for x in ([1, 1], [2, 2], [0, 3], ["0,1,2", "3,4"])], ["d", "f", "first", "ids"]) for _ in range(1)))]
    assert out == [[{"d": 1, "f": 2, "ends": hashlib.sha256(b"0,1,2,3,4").hexdigest()}]]


def test_packed_pieces(monkeypatch):
    monkeypatch.setattr(pt, "IDS", 4)
    batch = lambda d, f, c: pt.pa.RecordBatch.from_arrays([pt.pa.array(x) for x in (d, f, c)], ["d", "f", "conv"])
    pieces = [b.to_pylist()[0] for b in pt._pack(iter([batch([1] * 5, [0] * 5, range(5)), batch([1, 2], [0, 0], [9, 1])]))]
    assert [p["ids"] for p in pieces] == ["0,1,2,3,4", "9", "1"]


def test_empty_and_turnless(spark, frame):
    assert pt.prefix_trie(frame([(None, 1, "a", "b")])).count() == 0
    assert pt.shared_heads(frame([])).count() == 0
    lonely = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 == 5)
    data = [(lonely, 0, "user", "x"), (lonely, 1, "user", "y")]
    assert got(pt.shared_heads(frame(data))) == [(lonely, 0, -(10**9), 1, 0, 1, 0, hashlib.sha256(str(lonely).encode()).hexdigest())]
    with pytest.raises(ValueError, match="integer"):
        pt.prefix_trie(spark.createDataFrame([("a", 1, "b", "c")], "conv_id string, turn long, role string, text string"))


def test_query(spark, duck):
    got_, want = pt.op13_prefix_trie(spark, DATA).toPandas(), duck.execute(oracles.OP13).df()
    assert rows(got_) == rows(want)
