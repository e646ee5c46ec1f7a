"""Events and scenes: alignment, causal edges, characters, boundaries, normalisation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import VERIFIED_STATES
from tidemark.functions import intervals as I
from tidemark.functions import text as T
from tidemark.steps import shuffled


def scene_of(events: DataFrame, scenes: DataFrame, width: float) -> DataFrame:
    """The first scene, in list order (``place``), that holds an event's middle; null without one. Joined by time bucket."""
    mid = events.withColumn("mid", (F.col("s") + F.col("e")) / 2).withColumn("__b", F.floor(F.col("mid") / width))
    spread = scenes.select("video_id", "scene_id", "place", F.col("s").alias("ss"), F.col("e").alias("se"), F.explode(F.sequence(F.floor(F.col("s") / width), F.floor(F.col("e") / width))).alias("__b"))
    met = mid.join(spread, ["video_id", "__b"]).where("ss <= mid and mid <= se")
    found = met.groupBy("video_id", "ord").agg(F.min_by("scene_id", "place").alias("scene_id"))
    return events.join(found, ["video_id", "ord"], "left")


def alignment(events: DataFrame, scenes: DataFrame, least: float = 0.5) -> DataFrame:
    """Overlap ratio of each event with its scene; those under ``least`` are reported."""
    s = scenes.select("video_id", "scene_id", F.col("s").alias("ss"), F.col("e").alias("se"))
    out = events.join(s, ["video_id", "scene_id"], "left").withColumn("ratio", I.overlap_ratio(F.col("s"), F.col("e"), F.col("ss"), F.col("se")))
    return out.withColumn("aligned", F.coalesce(F.col("ratio") >= least, F.lit(False)))


def causal_faults(events: DataFrame) -> DataFrame:
    """Each edge cause -> event with the first rule it breaks: missing, self loop, unverified boundary, order.

    Both ends must have a verified or refined boundary; a split one doesn't count.
    """
    edges = events.where("cause is not null").select("video_id", "ord", "cause", F.col("s").alias("es"), F.col("boundary_state").alias("eb"))
    causes = events.select("video_id", F.col("ord").alias("cause"), F.col("e").alias("ce"), F.col("boundary_state").alias("cb"))
    fault = (
        F.when(F.col("cb").isNull(), "missing").when(F.col("cause") == F.col("ord"), "self loop")
        .when(~(F.col("cb").isin(*VERIFIED_STATES) & F.coalesce(F.col("eb").isin(*VERIFIED_STATES), F.lit(False))), "unverified").when(F.col("ce") > F.col("es") + 1e-6, "order")
    )
    return edges.join(causes, ["video_id", "cause"], "left").select("video_id", "ord", "cause", fault.alias("fault"), fault.isNull().alias("valid"))


def character_stats(appearances: DataFrame) -> DataFrame:
    """Of (video_id, name, s, e): first sight, screen time, appearances by the raw name."""
    return appearances.groupBy("video_id", "name").agg(F.min("s").alias("first_seen"), F.sum(F.greatest(F.lit(0.0), F.col("e") - F.col("s"))).alias("screen_time"), F.count(F.lit(1)).alias("appearances"))


def match_alias(names: DataFrame, seen: DataFrame) -> DataFrame:
    """``names`` (id, en, zh, aliases) of each video with the name of ``seen`` (name, ord) that each stands for.

    A person's candidates are tried in order: en, zh, id, then the aliases. Each is looked up as it is, then
    normalised; of several seen names with one normal form the first counts. ``alias`` is null without a hit.
    """
    tried = F.filter(F.concat(F.array("en", "zh", "id"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda c: F.coalesce(c, F.lit("")) != "")
    tried = names.select("video_id", "id", F.posexplode(tried).alias("p", "c")).withColumn("key", T.name_key(F.col("c")))
    exact = seen.select("video_id", F.col("name").alias("c"), F.col("name").alias("hit")).distinct()
    normal = seen.groupBy("video_id", T.name_key(F.col("name")).alias("key")).agg(F.min_by("name", "ord").alias("near"))
    met = tried.join(exact, ["video_id", "c"], "left").join(normal, ["video_id", "key"], "left").withColumn("alias", F.coalesce("hit", "near"))
    best = met.where("alias is not null").groupBy("video_id", "id").agg(F.min_by("alias", "p").alias("alias"))
    return names.join(best, ["video_id", "id"], "left")


def unmatched(matched: DataFrame, seen: DataFrame) -> DataFrame:
    """Names of ``seen`` that no person of ``match_alias`` stands for, for merging by hand."""
    return seen.join(matched.select("video_id", F.col("alias").alias("name")), ["video_id", "name"], "left_anti")


def normalise_spans(events: DataFrame, duration: float, key_width: float = 3.0) -> DataFrame:
    """Clamp to the timeline; an empty span gets a second on both sides of its start; a key event that is still bad or
    too narrow becomes minor, and bad ones are told."""
    s, e = I.clamp(F.col("s"), 0.0, duration), I.clamp(F.col("e"), 0.0, duration)
    out = events.withColumn("ns", s).withColumn("ne", e)
    empty = F.col("ns") >= F.col("ne")
    out = out.withColumn("ns2", F.when(empty, F.greatest(F.lit(0.0), F.col("ns") - 1)).otherwise(F.col("ns"))).withColumn("ne2", F.when(empty, F.least(F.lit(duration), F.col("ns") + 1)).otherwise(F.col("ne")))
    bad = F.col("ns2") >= F.col("ne2")
    narrow = (F.col("importance") == "key") & (F.col("ne2") - F.col("ns2") < key_width)
    out = out.withColumn("todo", bad).withColumn("narrow", narrow & ~bad)
    return out.withColumn("importance", F.when(F.col("todo") | F.col("narrow"), "minor").otherwise(F.col("importance"))).drop("s", "e", "ns", "ne").withColumnRenamed("ns2", "s").withColumnRenamed("ne2", "e")


def apply_verdicts(candidates: DataFrame) -> DataFrame:
    """One boundary round on (video_id, id, s, e, decision, rs, re, at, ...): refined spans move, split ones become two
    rows, rejected ones leave, verified and unknown ones stay."""
    row = lambda i, s, e, state: F.struct(i.alias("id"), s.alias("s"), e.alias("e"), F.lit(state).alias("boundary_state"))
    i, s, e = F.col("id"), F.col("s"), F.col("e")
    rows = (
        F.when(F.col("decision") == "rejected", F.array().cast("array<struct<id:string,s:double,e:double,boundary_state:string>>"))
        .when(F.col("decision") == "refined", F.array(row(i, F.col("rs"), F.col("re"), "refined")))
        .when((F.col("decision") == "split") & (F.col("at") > s) & (F.col("at") < e), F.array(row(F.concat(i, F.lit("a")), s, F.col("at"), "split"), row(F.concat(i, F.lit("b")), F.col("at"), e, "split")))
        .when(F.col("decision") == "verified", F.array(row(i, s, e, "verified")))
        .otherwise(F.array(row(i, s, e, "unreviewed")))
    )
    own = [c for c in candidates.columns if c not in ("id", "s", "e", "decision", "rs", "re", "at", "boundary_state")]
    return candidates.select(*own, F.explode(rows).alias("r")).select(*own, "r.*")


def refine(candidates: DataFrame, *rounds: DataFrame | Callable[[DataFrame], DataFrame], step: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of ``candidates`` (video_id, id, s, e, ...) after each round of verdicts (video_id, id, decision,
    rs, re, at), given as a table or made from the pending rows. The first round reviews all, a later one what the one
    before has refined or split; a row without a verdict is unreviewed. The kept rows have their boundary_state; both
    have ``origin``, if candidates have it. ``step`` writes each round's judged rows."""
    own = ["video_id", "id", "s", "e"] + [c for c in candidates.columns if c == "origin"]
    pending, kept, rejected = candidates.select(*own), None, None
    both = lambda one, other: other if one is None else one.unionByName(other)
    for i, verdicts in enumerate(rounds):
        verdicts = verdicts(pending) if callable(verdicts) else verdicts
        judged = pending.join(shuffled(verdicts.select("video_id", "id", "decision", "rs", "re", "at")), ["video_id", "id"], "left")
        judged = judged if step is None else step(judged)
        rejected = both(rejected, judged.where("decision = 'rejected'").select(*own))
        rows = apply_verdicts(judged.withColumn("decision", F.coalesce("decision", F.lit("unreviewed"))))
        again = F.col("boundary_state").isin("refined", "split") & F.lit(i + 1 < len(rounds))
        kept = both(kept, rows.where(~again))
        pending = rows.where(again).select(*own)
    return kept, rejected


def pair_dedup(events: DataFrame, clusters: DataFrame, least: float = 0.85) -> DataFrame:
    """(video_id, kept, merged) of clusters of two events (video_id, ord, s, txt) whose texts are alike: the longer text
    stays, of equal ones the earlier."""
    sized = clusters.join(clusters.groupBy("video_id", "cluster").agg(F.count(F.lit(1)).alias("n")).where("n = 2"), ["video_id", "cluster"])
    both = sized.join(events.select("video_id", "ord", "s", "e", "txt"), ["video_id", "ord"]).groupBy("video_id", "cluster").agg(F.array_sort(F.collect_list(F.struct("s", "e", "ord", "txt"))).alias("x"))
    one, other = F.col("x")[0], F.col("x")[1]
    alike = both.where(T.similarity(one["txt"], other["txt"]) >= least)
    first = F.length(one["txt"]) >= F.length(other["txt"])
    return alike.select("video_id", F.when(first, one["ord"]).otherwise(other["ord"]).alias("kept"), F.when(first, other["ord"]).otherwise(one["ord"]).alias("merged"))


def boundary_stats(kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per video, of the rows after a split and the rejected ones: the share of refined and split, and of rejected."""
    rows = kept.select("video_id", "boundary_state").unionByName(rejected.select("video_id", F.lit("rejected").alias("boundary_state")))
    share = lambda *d: F.round(F.avg(F.col("boundary_state").isin(*d).cast("double")), 3)
    return rows.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), share("refined", "split").alias("refined_ratio"), share("rejected").alias("rejected_ratio"))


def density(events: DataFrame, hours: float) -> DataFrame:
    """Events an hour, to one decimal, and key events of each video; ``hours`` is its length."""
    return events.groupBy("video_id").agg(F.round(F.count(F.lit(1)) / F.lit(max(hours, 1e-6)), 1).alias("per_hour"), F.sum((F.col("importance") == "key").cast("int")).alias("n_key"))


def neighbour_alerts(events: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Neighbours by start that overlap by more than ``ratio``."""
    w = Window.partitionBy("video_id").orderBy("s", "ord")
    out = events.withColumn("next", F.lead("ord").over(w)).withColumn("s2", F.lead("s").over(w)).withColumn("e2", F.lead("e").over(w))
    return out.withColumn("ratio", I.overlap_ratio(F.col("s"), F.col("e"), F.col("s2"), F.col("e2"))).where(F.col("next").isNotNull() & (F.col("ratio") > ratio)).select("video_id", "ord", "next", "ratio")


def numbered(rows: DataFrame, form: str, by: list[str], order: list[str], base: int = 1) -> DataFrame:
    """Adds ``id`` from a running number, as ``e%d`` or ``w%04d``."""
    return rows.withColumn("id", F.format_string(form, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1 + base))


def batched(rows: DataFrame, size: int, by: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / size))


def union_keep_first(*parts: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Union of parts in rank order; of equal keys the first part's first row stays."""
    out = parts[0].withColumn("__rank", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("__rank", F.lit(i)), allowMissingColumns=True)
    names = [c for c in out.columns if c not in (*key, "__rank")]
    best = out.groupBy(*key).agg(F.min_by(F.struct(*names, "__rank"), F.struct("__rank", *order)).alias("r"))
    return best.select(*key, *(F.col(f"r.{c}").alias(c) for c in names), F.col("r.__rank").alias("source"))
