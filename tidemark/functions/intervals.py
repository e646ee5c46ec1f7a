"""Scalar functions of spans on a time axis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def intersection(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(e1, e2) - F.greatest(s1, s2))


def overlap_ratio(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared length over the shorter span; 0 for an empty one."""
    shorter = F.least(e1 - s1, e2 - s2)
    return F.when(shorter <= 0, 0.0).otherwise(intersection(s1, e1, s2, e2) / F.when(shorter > 0, shorter))


def iou(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared length over the hull; 0 for an empty hull."""
    hull = F.greatest(e1, e2) - F.least(s1, s2)
    return F.when(hull <= 0, 0.0).otherwise(intersection(s1, e1, s2, e2) / F.when(hull > 0, hull))


def within(s: Column, e: Column, low: Column, high: Column, tolerance: float = 1.0) -> Column:
    return (s >= low - tolerance) & (e <= high + tolerance)


def pair(span: Column) -> Column:
    """A span given as an array of two numbers, as a struct; null unless its end is after its start."""
    a, b = F.try_element_at(span, F.lit(1)), F.try_element_at(span, F.lit(2))
    return F.when((F.size(span) == 2) & (b > a), F.struct(a.alias("s"), b.alias("e")))


def distinct_times(times: Column, low: Column, high: Column, most: int) -> Column:
    """At most ``most`` of the sorted frame times in [low, high], evenly by place; places round half to even."""
    last = F.element_at(times, -1)
    a, b = clamp(low, 0.0, last), clamp(high, 0.0, last)
    seen = F.filter(times, lambda t: (t >= a) & (t <= b))
    place = lambda i: F.bround(i * (F.size(seen) - 1) / F.lit(max(most - 1, 1)), 0).cast("int")
    some = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.get(seen, place(i)))
    return F.when((F.size(times) == 0) | (b <= a), F.array().cast("array<double>")).when(F.size(seen) <= most, seen).otherwise(some)


def time_bucket(t: Column, duration: Column, buckets: int = 4) -> Column:
    """Which of ``buckets`` equal parts of the timeline ``t`` is in."""
    return F.when(duration <= 0, F.lit(0)).otherwise(F.least(F.lit(buckets - 1), F.floor(t / F.when(duration > 0, duration) * buckets))).cast("int")


def duration_bucket(seconds: Column) -> Column:
    return F.when(seconds < 300, "<5m").when(seconds < 900, "5-15m").when(seconds < 2400, "15-40m").when(seconds <= 7200, "40m-2h").otherwise(">2h")


def quota(seconds: Column, per_hour: int = 24, least: int = 10, override: Column | None = None) -> Column:
    """Questions for a timeline; an ``override`` that isn't null wins."""
    n = F.greatest(F.lit(least), F.ceil(seconds / 3600 * per_hour)).cast("int")
    return n if override is None else F.coalesce(override.cast("int"), n)


def pad_fraction(seed: Column) -> Column:
    """A fixed fraction in [0.2, 0.8] of a text, for uneven padding."""
    return 0.2 + 0.6 * (F.conv(F.substring(F.sha2(seed, 256), 1, 8), 16, 10).cast("long") % 1000) / 999.0


def padding(seed: Column, width: Column, least: float) -> Column:
    """Uneven room on both sides of a span: twice its width (or ``least``) in all, cut by the fraction of its seed."""
    total = 2.0 * F.greatest(F.lit(least), width)
    left = F.round(total * pad_fraction(seed), 3)
    return F.struct(left.alias("before"), F.round(total - total * pad_fraction(seed), 3).alias("after"))


def middle(s: Column, e: Column) -> Column:
    return (s + e) / 2


def inside(s: Column, e: Column, n: int) -> Column:
    """``n`` times evenly inside a span, without its ends."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: s + (e - s) * i / (n + 1))


def frame_name(t: Column) -> Column:
    """``f_{seconds:07}_{milliseconds:03}.jpg`` with a carry when milliseconds round to 1000."""
    ms = F.round(t * 1000).cast("long")
    return F.format_string("f_%07d_%03d.jpg", F.floor(ms / 1000).cast("long"), ms % 1000)


def frame_time(name: Column) -> Column:
    return F.regexp_extract(name, r"f_(\d{7})_(\d{3})\.jpg$", 1).cast("double") + F.regexp_extract(name, r"f_(\d{7})_(\d{3})\.jpg$", 2).cast("double") / 1000


def in_view(s: Column, e: Column, low: Column, high: Column, least: float = 2.0) -> Column:
    """The span clamped to a view, or null if less than ``least`` is left."""
    a, b = F.greatest(s, low), F.least(e, high)
    return F.when(b - a >= least, F.struct(a.alias("s"), b.alias("e")))
