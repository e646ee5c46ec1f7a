"""Hash-keyed recomputation: what has to run again, and what that invalidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Which stage is read by which. S1 structure, S2 descriptions, S3 events, S4 the whole, S5 questions,
# S6 verification, S7 filters.
DEPENDS = (
    ("S1", "S2"), ("S1", "S3"), ("S2", "S3"), ("S1", "S4"), ("S3", "S4"), ("S1", "S5"), ("S3", "S5"), ("S4", "S5"), ("S5", "S6"), ("S5", "S7"), ("S6", "S7"),
)


def content_hash(*columns: Column) -> Column:
    """A digest of a row's values, the same in any engine: fields joined by a unit separator, null as its own mark."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)), 256)


def stage_hashes(rows: DataFrame, by: list[str], order: Column, digest: Column) -> DataFrame:
    """One hash a group over its rows' digests in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), digest.alias("d")))), lambda x: x["d"])
    return rows.groupBy(*by).agg(F.sha2(F.array_join(parts, ""), 256).alias("hash"))


def cascaded(payloads: DataFrame, depends=DEPENDS) -> DataFrame:
    """Stage hashes of ``payloads`` (video_id, stage, digest) that change with anything upstream: a stage's hash is over
    its name, its own digest, and the hashes of the stages that it reads. A stage without a payload has digest ''."""
    stages = sorted({s for pair in depends for s in pair})
    out = payloads.groupBy("video_id").pivot("stage", stages).agg(F.first("digest"))
    for stage in stages:  # names are in an order that has each stage after what it reads
        upstream = [F.col(src) for src, dst in depends if dst == stage]
        out = out.withColumn(stage, F.sha2(F.concat_ws("|", F.lit(stage), F.coalesce(stage, F.lit("")), *upstream), 256))
    return out.select("video_id", F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.col(s).alias("hash")) for s in stages))).alias("x")).select("video_id", "x.*")


def manifest_rows(states: DataFrame, gaps: DataFrame) -> DataFrame:
    """What a product carries of its manifest, one row a video: its stages as (stage, state, first 12 characters of the
    hash), and its gaps rounded to milliseconds."""
    stages = states.groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("stage", "state", F.left(F.coalesce("input_hash", F.lit("")), F.lit(12)).alias("input_hash")))).alias("stages"))
    holes = gaps.groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct(F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), "reason"))).alias("gaps"))
    return stages.join(holes, "video_id", "left").withColumn("gaps", F.coalesce("gaps", F.array().cast("array<struct<s: double, e: double, reason: string>>")))


def restored(previous: DataFrame, states: DataFrame, made_by: dict[str, str]) -> DataFrame:
    """The tracks of a previous product (video_id, one column a track) that a new run starts from: those whose stage is
    done, others null. ``made_by``: track to stage."""
    done = states.where("state = 'done'").groupBy("video_id").agg(F.collect_set("stage").alias("__done"))
    out = previous.join(done, "video_id", "left")
    return out.select("video_id", *(F.when(F.array_contains("__done", stage), F.col(track)).alias(track) for track, stage in made_by.items()))


def needs_run(current: DataFrame, manifest: DataFrame, key: list[str]) -> DataFrame:
    """``current`` (key, hash) rows that aren't done with the same hash in ``manifest`` (key, state, input_hash)."""
    met = current.join(manifest, key, "left")
    return met.where(~F.coalesce((F.col("state") == "done") & F.col("hash").eqNullSafe(F.col("input_hash")), F.lit(False))).select(*current.columns)


def latest(manifest: DataFrame, key: list[str], at: str) -> DataFrame:
    """Of an append-only manifest the last row of each key."""
    rest = [c for c in manifest.columns if c not in key]
    return manifest.groupBy(*key).agg(F.max_by(F.struct(*rest), at).alias("r")).select(*key, "r.*")


def downstream(spark: SparkSession, changed: DataFrame, depends=DEPENDS) -> DataFrame:
    """(video_id, stage): everything that reads, directly or not, a changed stage. The stage graph is a constant."""
    edges = spark.createDataFrame(list(depends), "src string, dst string")
    reach = found = changed.select("video_id", "stage").distinct()
    for _ in range(len(depends)):
        found = found.join(F.broadcast(edges), F.col("stage") == F.col("src")).select("video_id", F.col("dst").alias("stage")).distinct()
        reach = reach.unionByName(found)
    return reach.distinct().join(changed.select("video_id", "stage").distinct(), ["video_id", "stage"], "left_anti")


def misses(requests: DataFrame, cache: DataFrame, key: str = "key_hash") -> DataFrame:
    return requests.join(cache.select(key).distinct(), key, "left_anti")


#: A row of a manifest's log: when (seconds), what kind, and what that kind needs.
LOG = ("at", "kind", "stage", "state", "input_hash", "output", "error", "name", "value", "s", "e")
LOG_KINDS = "at long, kind string, stage string, state string, input_hash string, output string, error string, name string, value string, s double, e double"


def manifest(log: DataFrame, depends=DEPENDS) -> DataFrame:
    """One row a video of what its ``log`` (video_id and ``LOG``) amounts to, whatever its order; repeated rows count once.

    ``stage`` rows set a stage; the last of each counts. Where a row's input hash differs from that of the row before, all
    that reads the stage, directly or not, is pending again unless it was set later. ``todo`` rows (name, value) are a list
    in order of time with their day; ``gap`` rows (s, e, value) count after the last ``clear_gaps``; of ``stats`` rows the
    last of each name counts, of ``frames`` rows the last. Other kinds, and rows without a time, are passed over. Ties in
    time go by the rest of the row. A video's log is bounded: its runs times its stages.
    """
    rows = log.select("video_id", *LOG).where("at is not null").distinct()
    whole = F.struct("at", *(c for c in LOG if c not in ("at", "kind")))
    before = Window.partitionBy("video_id", "stage").orderBy("at", whole)
    sets = rows.where("kind = 'stage' and stage is not null").withColumn("moved", (F.row_number().over(before) > 1) & ~F.col("input_hash").eqNullSafe(F.lag("input_hash").over(before)))
    last = sets.groupBy("video_id", "stage").agg(F.max(whole).alias("x"), F.max(F.when(F.col("moved"), F.col("at"))).alias("moved_at"))
    reads: dict[str, set[str]] = {}
    for _ in depends:  # the stage graph is a constant: all that each stage reads, at any distance
        for src, dst in depends:
            reads.setdefault(dst, set()).update({src}, reads.get(src, set()))
    moves = F.map_from_entries(F.collect_list(F.struct("stage", "moved_at")))
    above = F.map_from_entries(F.array(*(F.struct(F.lit(d), F.array(*map(F.lit, sorted(up)))) for d, up in sorted(reads.items()))))
    held = last.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("stage", "x"))).alias("all"), moves.alias("moves"))
    stale = lambda z: F.exists(F.coalesce(F.try_element_at(above, z["stage"]), F.array().cast("array<string>")), lambda u: F.coalesce(F.try_element_at("moves", u) > z["x"]["at"], F.lit(False)))
    shown = lambda z: F.struct(z["stage"].alias("stage"), z["x"]["state"].alias("state"), z["x"]["input_hash"].alias("input_hash"), z["x"]["output"].alias("output"), z["x"]["error"].alias("error"), z["x"]["at"].alias("at"))
    stages = held.select("video_id", F.transform(F.filter("all", lambda z: ~stale(z)), shown).alias("stages"))
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("at") / 86400).cast("int")), "yyyy-MM-dd")
    todos = rows.where("kind = 'todo'").groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("at", "name", "value", day.alias("created")))).alias("todos"))
    cleared = rows.where("kind in ('gap', 'clear_gaps')").withColumn("clear", F.max(F.when(F.col("kind") == "clear_gaps", F.col("at"))).over(Window.partitionBy("video_id")))
    holes = cleared.where("kind = 'gap' and (clear is null or at > clear)").groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("at", F.round("s", 3).alias("s"), F.round("e", 3).alias("e"), F.col("value").alias("reason")))).alias("gaps"))
    stats = rows.where("kind = 'stats' and name is not null").groupBy("video_id", "name").agg(F.max(F.struct("at", "value"))["value"].alias("value"))
    stats = stats.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("name", "value"))).alias("stats"))
    frames = rows.where("kind = 'frames'").groupBy("video_id").agg(F.max(F.struct("at", "value"))["value"].alias("frames"))
    out = rows.select("video_id").distinct()
    for part in (stages, todos, holes, stats, frames):
        out = out.join(part, "video_id", "left")
    for c in ("stages", "todos", "gaps", "stats"):
        out = out.withColumn(c, F.coalesce(c, F.array().cast(out.schema[c].dataType)))
    return out
