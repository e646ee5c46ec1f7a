import json

import pytest
from pyspark.sql import functions as F

from helpers import DATA
from tidemark.operators import incremental
from tidemark.sources import json_io
from tidemark.streaming import envelopes


def test_annotations_round_trip(spark, tmp_path):
    doc = {"video_id": "v", "structure": {"subtitles": [{"start": 0.5, "end": 2.0, "text": "a", "lang": "en"}]}, "qa": [{"qid": "v_q1", "answer": "A"}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/v.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "in/v.manifest.json").write_text("{}")
    (tmp_path / "in/bad.json").write_text("{no")
    found = json_io.usable(json_io.read_annotations(spark, str(tmp_path / "in")).cache())
    assert [r["video_id"] for r in found.collect()] == ["v"]
    subtitles = json_io.track(found, "subtitles")
    assert [(r["ord"], r["text"]) for r in subtitles.collect()] == [(0, "a")]
    back = json_io.assemble(found.select("video_id"), {"subtitles": subtitles})
    json_io.write_version(back, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).select(F.explode("subtitles.text")).first()[0] == "a"


def test_responses(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"responses": [{"qid": "q", "annotator": "x", "interval": [1.0, 2.5]}, {"qid": "p", "annotator": "y", "answer": "B"}]}))
    assert sorted((r["qid"], r["answer"], r["iv_end"]) for r in json_io.read_responses(spark, str(tmp_path / "r.json")).collect()) == [("p", "B", None), ("q", None, 2.5)]


def test_meta_and_tracks(spark):
    videos = spark.createDataFrame([("a", 5.0), ("b", 6.0)], "video_id string, duration double")
    metas = spark.createDataFrame([("a",)], "video_id string")
    subs = spark.createDataFrame([("b", 3.0, "fr"), ("b", 1.0, "en")], "video_id string, start double, lang string")
    (made,) = json_io.default_meta(videos, metas, subs, today="2024-05-01").collect()
    assert (made["video_id"], made["primary_lang"], made["duration_bucket"], made["genre"], made["license"], made["release_date"], made["subtitle_langs"]) == ("b", "en", "<5m", "unknown", "UNSPECIFIED", "2024-05-01", ["en"])
    (other,) = json_io.default_meta(videos.where("video_id = 'b'"), metas.limit(0), subs.where("lang = 'fr'")).collect()
    assert (other["primary_lang"], other["subtitle_langs"]) == ("zh", [])
    old = spark.createDataFrame([("a", [1]), ("b", [2])], "video_id string, t array<int>")
    new = spark.createDataFrame([("a", None), ("b", [3])], "video_id string, t array<int>")
    assert {r["video_id"]: r["t"] for r in json_io.overwrite_tracks(old, new, ["t"]).collect()} == {"a": [1], "b": [3]}


def test_needs_run_is_null_safe(spark):
    now = spark.createDataFrame([("a", "h"), ("b", "h"), ("c", "h"), ("d", None)], "k string, hash string")
    then = spark.createDataFrame([("a", "done", "h"), ("b", "failed", "h"), ("d", "done", None)], "k string, state string, input_hash string")
    assert sorted(r["k"] for r in incremental.needs_run(now, then, ["k"]).collect()) == ["b", "c"]


def test_windowed_levels_stream(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").select("ts", "user_id", "value")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    envelopes.append_batches(envelopes.windowed_levels(stream), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = events.groupBy("user_id", F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w")).agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms"), F.count(F.lit(1)).alias("n"))
    # windows that the watermark hasn't closed are still open; all others are there once, with their values
    last = events.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    closed = want.where(F.col("w.end") < F.lit(last) - F.expr("interval 2 hours")).select("user_id", F.col("w.start").alias("start"), F.round("rms", 6).alias("rms"), "n")
    key = lambda frame: {(r["user_id"], r["start"], r["rms"], r["n"]) for r in frame.collect()}
    mine = key(got.select("user_id", "start", F.round("rms", 6).alias("rms"), "n"))
    assert len(mine) == got.count() and key(closed) <= mine <= key(want.select("user_id", F.col("w.start").alias("start"), F.round("rms", 6).alias("rms"), "n"))


def test_states_of_a_stream_are_upserted(spark, tmp_path):
    schema = "video_id long, stage string, state string, updated long"
    first = [(1, "S1", "failed", 1), (1, "S1", "done", 2), (2, "S1", "done", 1)]
    for n, rows in enumerate((first, [(1, "S1", "stale", 3), (1, "S2", "done", 1)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        envelopes.upsert_states(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        if not n:
            assert sorted((r["video_id"], r["state"]) for r in envelopes.current(spark, str(tmp_path / "out")).collect()) == [(1, "done"), (2, "done")]
    got = sorted((r["video_id"], r["stage"], r["state"]) for r in envelopes.current(spark, str(tmp_path / "out")).collect())
    assert got == [(1, "S1", "stale"), (1, "S2", "done"), (2, "S1", "done")]


def test_log_and_final_products(spark, tmp_path):
    json_io.append_log(spark.createDataFrame([("a", 1)], "model string, retries int"), str(tmp_path / "log"))
    json_io.append_log(spark.createDataFrame([("b", 2)], "model string, retries int"), str(tmp_path / "log"))
    assert sorted((r["model"], r["retries"]) for r in spark.read.json(str(tmp_path / "log")).collect()) == [("a", 1), ("b", 2)]
    videos = spark.createDataFrame([("v",), ("w",)], "video_id string")
    metas = spark.createDataFrame([("v", "movie")], "video_id string, genre string")
    shots = spark.createDataFrame([("v", 1, 5.0, 9.0, "x"), ("v", 0, 0.0, 5.0, "x")], "video_id string, ord int, start double, end double, _win string")
    states = spark.createDataFrame([("v", "S1", "done", "0123456789abcdef")], "video_id string, stage string, state string, input_hash string")
    gaps = spark.createDataFrame([("v", 1.00049, 2.0, "why")], "video_id string, s double, e double, reason string")
    got = {r["video_id"]: r for r in json_io.final(videos, metas, {"shots": shots}, states, gaps).collect()}
    v = got["v"]
    assert [x["start"] for x in v["structure"]["shots"]] == [0.0, 5.0] and "_win" not in v["structure"]["shots"][0] and v["structure"]["ocr"] == [] and v["meta"]["genre"] == "movie"
    assert v["annotation_meta"]["stages"][0]["input_hash"] == "0123456789ab" and v["annotation_meta"]["gaps"][0]["s"] == 1.0 and v["annotation_meta"]["review_status"] == "draft"
    assert got["w"]["structure"]["shots"] == [] and got["w"]["meta"] is None


def test_schema_rules_at_every_depth(spark):
    from tidemark.sources import schema

    rules = {
        "type": "object", "required": ["id", "tags"], "properties": {
            "id": {"type": "integer"}, "tags": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"type": "string", "minLength": 2}}, "size": {"type": ["number", "null"], "minimum": 1}, "on": {"const": True},
            "text": {"anyOf": [{"$ref": "#/$defs/Short"}, {"pattern": "^long"}]}, "when": {"type": "object", "required": ["day"], "properties": {"day": {"type": "string"}}},
        }, "$defs": {"Short": {"type": "string", "maxLength": 3}}, "allOf": [{"required": ["id"]}],
    }
    kind = "id double, tags array<string>, size string, on boolean, text string, when struct<day: int, _x: int>"
    rows = [(1.0, ["ab"], None, True, "abc", None), (1.5, [], "x", False, "other", (3, 1)), (None, ["a", None, "cc", "dd"], None, None, "long one", (None, None)), (2.0, None, None, None, None, None)]
    out = schema.validated(spark.createDataFrame(rows, kind), rules).collect()
    assert [r["schema_valid"] for r in out] == [True, False, False, False] and [r["schema_error"] for r in out][0] == ""
    told = [[f"{e['path']}: {e['message']}" for e in r["errors"]] for r in out]
    assert told[1] == [
        "id: 1.5 is not of type 'integer'", "tags: [] is too short", "size: 'x' is not of type 'number', 'null'", "on: true was expected", "text: 'other' is not valid under any of the given schemas", "when/day: 3 is not of type 'string'",
    ]
    assert told[2] == [
        "<root>: 'id' is a required property", 'tags: ["a",null,"cc","dd"] is too long', "tags/0: 'a' is too short", "tags/1: null is not of type 'string'", "when: 'day' is a required property", "<root>: 'id' is a required property",
    ]
    assert out[3]["schema_error"] == "<root>: 'tags' is a required property"
    with pytest.raises(ValueError, match="uniqueItems"):
        schema.validated(spark.createDataFrame(rows, kind), {"uniqueItems": True})


def test_private_fields_go_at_every_depth(spark):
    from tidemark.sources import schema

    kind = "_a int, b struct<_c: int, d: array<struct<e: int, _f: int>>, m: map<string, struct<g: int, _h: int>>>, only: struct<_z: int>"
    out = schema.public(spark.createDataFrame([(1, (2, [(3, 4), None], {"k": (5, 6), "_k": (7, 8)}), (9,)), (1, None, None)], kind))
    assert out.schema.simpleString() == "struct<b:struct<d:array<struct<e:int>>,m:map<string,struct<g:int>>>,only:struct<_z:int>>"
    first, second = out.collect()
    assert first["b"]["d"] == [(3,), None] and first["b"]["m"] == {"k": (5,)} and second["b"] is None


@pytest.mark.parametrize("size", [3, 11, 1000])
def test_manifest_stream_is_the_batch_whatever_the_split(spark, tmp_path, size):
    import random

    from tidemark.streaming import manifests

    r = random.Random(7)
    rows = [(1, 1, "stage", "S1", "done", "a", None, None, None, None, None, None), (1, 2, "stage", "S2", "done", "b", "o", None, None, None, None, None), (1, 3, "stage", "S1", "done", "c", None, None, None, None, None, None),
            (1, 4, "stage", "S5", "failed", None, None, "why", None, None, None, None), (2, 90_000, "todo", None, None, None, None, None, "q", '{"a": "é\\""}', None, None), (2, None, "todo", None, None, None, None, None, "q", "x", None, None)]
    for _ in range(60):
        v, at, kind = r.randrange(3), r.randrange(40), r.choice(["stage", "stage", "stage", "todo", "gap", "clear_gaps", "stats", "frames", "other"])
        rows.append((v, at, kind, f"S{r.randrange(1, 8)}", r.choice(["done", "failed"]), r.choice(["a", "b", None]), None, None, r.choice(["x", "y", None]), r.choice(["1", "2", None]), at / 7, at / 3))
    rows += r.sample(rows, 15)
    r.shuffle(rows)
    schema = "video_id long, " + incremental.LOG_KINDS
    for at in range(0, len(rows), size):
        spark.createDataFrame(rows[at : at + size], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if at in (0, size):
            manifests.keep(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    manifests.keep(spark.readStream.schema(schema).option("maxFilesPerTrigger", 9).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    want = {x["video_id"]: x for x in incremental.manifest(spark.createDataFrame(rows, schema)).collect()}
    got = {x["video_id"]: x for x in manifests.current(spark, str(tmp_path / "out")).select(*next(iter(want.values())).asDict()).collect()}
    assert got == want and len(want) == 3


def test_a_changed_hash_sends_what_reads_it_back(spark):
    row = lambda at, stage, h: (1, at, "stage", stage, "done", h, None, None, None, None, None, None)
    schema = "video_id long, " + incremental.LOG_KINDS
    told = lambda rows: [s["stage"] for s in incremental.manifest(spark.createDataFrame(rows, schema)).first()["stages"]]
    first = [row(1, "S1", "a"), row(2, "S2", "b"), row(3, "S3", "c"), row(4, "S6", "d")]
    assert told(first) == ["S1", "S2", "S3", "S6"] and told([*first, row(5, "S1", "a")]) == ["S1", "S2", "S3", "S6"]
    assert told([*first, row(5, "S1", "x")]) == ["S1"] and told([*first, row(5, "S2", "x"), row(6, "S3", "c")]) == ["S1", "S2", "S3"]
    assert incremental.manifest(spark.createDataFrame([], schema)).count() == 0
