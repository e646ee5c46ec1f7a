import datetime as dt
import random

import pytest

from tidemark.llm import url_lists


def brute(captures, entries):
    rank = {"block": 3, "allow": 2}
    log = {}
    for key, action, day in entries:
        if key is not None and day is not None:
            days = log.setdefault(key.lower(), {})
            days[day] = max(days.get(day, 0), rank.get(action, 1))
    out = []
    for host, url, day in captures:
        best = None
        labels = host.split(".") if host else []
        for i in range(len(labels)):
            key = ".".join(labels[i:])
            past = [d for d in log.get(key, {}) if day and d <= day]
            if past and log[key][max(past)] > 1:
                best = (key, {3: "block", 2: "allow"}[log[key][max(past)]], max(past))
                break
        out.append((str(url), str(day), host, bool(best and best[1] == "block"), *map(str, best or (None,) * 3)))
    return sorted(out)


def test_against_brute_force(spark):
    r = random.Random(4)
    day = lambda: dt.date(2023, 12, 1) + dt.timedelta(r.randint(0, 120))
    hosts = ["a.example.com", "b.example.com", "example.com", "x.y.z.example.org", "hot.net"]
    captures = [(h := r.choice(hosts + ["hot.net"] * 5), f"https://u@{h.upper()}:80/p{i}?q=http://b.example.com", day()) for i in range(300)]
    captures += [("", None, day()), ("", "/relative", day()), ("hot.net", "http://hot.net./x", None), captures[0], captures[0]]
    entries = [(r.choice(["example.com", "A.example.com", "com", "hot.net", "z.example.org", "ample.com"]), r.choice(["block", "allow", "none"]), day()) for _ in range(60)]
    entries += [(None, "block", day()), ("hot.net", "block", None), entries[0]]
    frame = spark.createDataFrame([(u, d) for _, u, d in captures], "url string, fetched date").selectExpr("*", "1 AS key", "2 AS month", "3 AS n")
    got = url_lists.evaluate(frame, spark.createDataFrame(entries, "key string, action string, date date")).collect()
    assert sorted((str(x["url"]), str(x["fetched"]), x["host"], x["blocked"], str(x["key"]), str(x["action"]), str(x["valid_from"])) for x in got) == brute(captures, entries)


@pytest.mark.parametrize("most", [url_lists.BROADCAST_KEYS, 0])
def test_time_of_day(spark, monkeypatch, most):
    monkeypatch.setattr(url_lists, "BROADCAST_KEYS", most)
    r = random.Random(6)
    at = lambda: dt.datetime(2024, 1, r.randint(29, 31), r.randint(0, 23), r.choice((0, 30))) + dt.timedelta(r.randint(0, 2))
    captures = [(h := r.choice(["a.example.com", "example.com", "hot.net"]), f"http://{h}/{i}", at()) for i in range(200)]
    captures += [("hot.net", "http://hot.net/x", dt.datetime(2024, 3, 1, 8)), ("hot.net", "http://hot.net/y", dt.datetime(2024, 3, 1, 21))]
    entries = [(r.choice(["a.example.com", "example.com", "com"]), r.choice(["block", "allow", "none"]), at()) for _ in range(60)] + [("hot.net", "block", dt.datetime(2024, 3, 1, 20)), ("hot.net", "none", dt.datetime(2024, 1, 1))]
    frame = spark.createDataFrame([(u, d) for _, u, d in captures], "url string, fetched timestamp_ntz").selectExpr("*", "1 AS __host", "2 AS __fetch", "3 AS fetch")
    got = url_lists.evaluate(frame, spark.createDataFrame(entries, "key string, action string, date timestamp_ntz")).collect()
    assert sorted((str(x["url"]), str(x["fetched"]), x["host"], x["blocked"], str(x["key"]), str(x["action"]), str(x["valid_from"])) for x in got) == brute(captures, entries)
    assert {x["url"]: x["blocked"] for x in got if x["url"][-1] in "xy"} == {"http://hot.net/x": False, "http://hot.net/y": True}


def test_very_long_urls(spark):
    url = "http://" + ".".join(["a" * 60] * 300) + ".example.com/" + "x" * 500_000
    captures = spark.createDataFrame([(url, dt.date(2024, 1, 2)), (url, dt.date(2024, 1, 2))], "url string, fetched date")
    entries = spark.createDataFrame([("example.com", "block", dt.date(2024, 1, 1))], "key string, action string, date date")
    assert [r["blocked"] for r in url_lists.evaluate(captures, entries).collect()] == [True, True]


def test_empty(spark):
    captures = spark.createDataFrame([("http://a.b/", dt.date(2024, 1, 1))], "url string, fetched date")
    entries = spark.createDataFrame([], "key string, action string, date date")
    assert [r["blocked"] for r in url_lists.evaluate(captures, entries).collect()] == [False]
    assert url_lists.evaluate(captures.limit(0), entries).count() == 0
