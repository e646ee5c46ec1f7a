"""URL filters by a temporal list join.

A list is a log of dated entries (key, action, date): from its instant on, a key has that action, until its next entry.
Entries become half-open validity intervals; every capture is then evaluated against the entries that were active when
it was fetched. A key is a host or a parent domain; of the active keys that cover a capture's host the longest decides.
An entry of action ``none`` ends the one before it.

Scale: the domains of distinct hosts are first matched with the list's keys, so a capture whose domains no list names is
never shuffled by a domain; the others are reduced to distinct (host, instant) pairs; intervals are cut at month borders
and joined by (key, month), so one key's history never meets all captures of the key at once; the verdicts are joined
back by (host, instant). The log, its intervals and the matched hosts are written once. The log itself is ordered within (key, month) and over the months of a key, so no key's log is
one task's. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.located import unused
from tidemark.llm.scratch import Scratch

#: Up to this many distinct listed keys are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 500_000


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, valid_from, valid_to) of ``entries`` (key, action, date); valid_to is exclusive, null if open.

    ``date`` is a date, which counts from its midnight on, or a timestamp; the bounds have its type. Of several entries
    of a key at one instant a block counts first, then an allowance, then ``none``. Rows with a null key or date are no
    entries. Keys are lower-cased.
    """
    rank = F.when(F.col("action") == "block", 3).when(F.col("action") == "allow", 2).otherwise(1)
    at_once = entries.where("key is not null and date is not null").groupBy(F.lower("key").alias("key"), "date").agg(F.max(rank).alias("rank"))
    at_once = at_once.withColumn("month", F.trunc(F.col("date").cast("date"), "month"))
    firsts = at_once.groupBy("key", "month").agg(F.min("date").alias("first"))
    following = firsts.select("key", "month", F.lead("first").over(Window.partitionBy("key").orderBy("month")).alias("then"))
    inside = at_once.withColumn("next", F.lead("date").over(Window.partitionBy("key", "month").orderBy("date")))
    action = F.when(F.col("rank") == 3, "block").when(F.col("rank") == 2, "allow").otherwise("none")
    return inside.join(following, ["key", "month"]).select("key", action.alias("action"), F.col("date").alias("valid_from"), F.coalesce("next", "then").alias("valid_to"))


def host_of(url):
    """Lower-cased host of a URL without user, port and trailing dot; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)), r"\.+$", "")


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", fetched_col: str = "fetched") -> DataFrame:
    """``captures`` with host, blocked, key, action and valid_from of the deciding entry (null where none is active).

    Fetch times are dates, which count as their midnights, or timestamps. A null or relative URL has the empty host,
    which no key covers; a null fetch time meets no entry. Both stay in the result, not blocked, as do repeated rows.
    Captures' own columns stay; columns named like the added ones are replaced.
    """
    added = ("host", "blocked", "key", "action", "valid_from")
    own = [c for c in captures.columns if c.lower() not in added]
    captures = captures.select(*own, host_of(F.col(url_col)).alias("host"))
    kind = captures.schema[fetched_col].dataType
    last = captures.agg(F.max(fetched_col).cast("string")).first()[0]  # nothing after it is asked for
    last = F.lit(last).cast(kind)
    scratch = Scratch(captures.sparkSession, "lists")
    log = scratch.save(entries.select("key", "action", "date"), "log")  # read several times below, as are the next two
    active = scratch.save(intervals(log).where("action <> 'none'").where(F.col("valid_from") <= last), "active")

    hosts = captures.select("host").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    listed = active.select("key").distinct()
    few = listed.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    named = scratch.save(hosts.select("host", F.explode(names).alias("key")).join(F.broadcast(listed) if few else listed, "key", "left_semi"), "named")

    pairs = captures.select("host", F.col(fetched_col).alias("fetch")).where("fetch is not null").join(named.select("host").distinct(), "host", "left_semi").distinct()
    keyed = pairs.join(named, "host").withColumn("month", F.trunc(F.col("fetch").cast("date"), "month"))
    month = lambda c: F.trunc(c.cast("date"), "month")
    months = F.sequence(month(F.col("valid_from")), month(F.least(F.col("valid_to"), last)), F.expr("interval 1 month"))
    active = active.select("key", "action", "valid_from", "valid_to", F.explode(months).alias("month"))
    met = keyed.join(active, ["key", "month"]).where("fetch >= valid_from and (valid_to is null or fetch < valid_to)")
    decided = met.groupBy("host", "fetch").agg(F.max(F.struct(F.length("key").alias("n"), "key", "action", "valid_from")).alias("d"))
    host, fetch = unused(captures, "__host"), unused(captures, "__fetch")
    decided = decided.select(F.col("host").alias(host), F.col("fetch").alias(fetch), "d.key", "d.action", "d.valid_from")
    out = captures.join(decided, (F.col("host") == F.col(host)) & (F.col(fetched_col) == F.col(fetch)), "left")
    return out.select(*own, "host", (F.coalesce(F.col("action"), F.lit("")) == "block").alias("blocked"), "key", "action", "valid_from")


def _number(text, below: int):
    """A fixed number of a text, the same in any engine."""
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long") % below


def op10_temporal_url_lists(spark, sf_dir: str) -> DataFrame:
    """Every row of ``pages`` against a list log made from the hosts in ``pages``.

    The tables hold neither fetch times nor lists, so both are derived from the data by fixed rules: a page is fetched
    at an hour of a day of 2024, both numbers of its page_id; every third host is blocked from an instant of its own on
    and every second of those is released 90 days later; every fifth host is allowed from an instant on; every fourth
    host has a block and an allowance some hours apart on one day; the registered domain is blocked for the second half
    of the year where its number says so.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    at = lambda day, hour: start + F.make_dt_interval(day.cast("int"), hour.cast("int"))
    own = lambda what: F.concat(F.lit(what), F.col("page_id").cast("string"))
    captures = pages.withColumn("fetched", at(_number(own("day "), 365), _number(own("hour "), 24)))
    hosts = Scratch(spark, "hosts").save(pages.select(host_of(F.col("url")).alias("key")).where("key <> ''").distinct(), "hosts").withColumn("n", _number(F.col("key"), 30030)).withColumn("h", F.col("n") % 24)
    domains = hosts.select(F.regexp_extract("key", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("key")).where("key <> ''").distinct().withColumn("n", _number(F.concat(F.lit("domain "), "key"), 30030))
    n, h = F.col("n"), F.col("h")
    entry = lambda rows, action, day, hour: rows.select("key", F.lit(action).alias("action"), at(day, hour).alias("date"))
    blocked, twice = hosts.where("n % 3 = 0"), hosts.where("n % 4 = 0")
    entries = (
        entry(blocked, "block", n % 200, h).unionByName(entry(blocked.where("n % 2 = 0"), "none", n % 200 + 90, h))
        .unionByName(entry(hosts.where("n % 5 = 0"), "allow", n % 300, h)).unionByName(entry(domains.where("n % 7 = 0"), "block", F.lit(182), F.lit(12)))
        .unionByName(entry(twice, "block", n % 250, h % 12)).unionByName(entry(twice, "allow", n % 250, h % 12 + 6))
    )
    return evaluate(captures, entries).withColumn("fetched", F.col("fetched").cast("string")).withColumn("valid_from", F.col("valid_from").cast("string"))
