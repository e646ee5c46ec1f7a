"""Rounds of generation and trees of description on small hand-made cases."""

import pytest
from pyspark.sql import functions as F

from tidemark.config import Thresholds
from tidemark.operators import describe, generate
from tidemark.steps import Steps

STEM = "who enters the room at 12:30 and then leaves it with "


def _answers(rows, spark):
    """(video_id, place, anchor_id, stem, options, answer) as an answer."""
    kind = "video_id long, place long, anchor_id string, question_en string, options array<string>, answer string"
    return spark.createDataFrame(rows, kind).select(
        "*", F.lit("mcq").alias("task_type"), F.lit(None).cast("string").alias("question_zh"), F.expr("array(array(0.0D, 9.0D))").alias("evidence"), F.lit(None).cast("array<double>").alias("target"),
        F.lit("").alias("ref_zh"), F.lit("").alias("ref_en"), F.array(F.lit("L1_object")).alias("capability"), F.lit("cross_scene").alias("min_watch"),
    )


def test_rounds_carry_their_state(spark):
    four = ["aa", "bb", "cc", "dd"]
    videos = spark.createDataFrame([(1, 100.0, 3), (2, 100.0, 2), (3, 100.0, 0), (4, 100.0, None)], "video_id long, duration double, quota int")
    anchors = spark.createDataFrame([(v, f"e{i}", i, 0.0, 10.0 + i, "minor") for v in (1, 2) for i in range(3)], "video_id long, anchor_id string, ord long, s double, e double, importance string")
    asked = []

    def ask(requests):
        got = {r["video_id"]: r for r in requests.collect()}
        asked.append(got)
        rows = []
        if 1 in got and got[1]["round"] == 1:  # one good, its repeat, one without anchor, one to mend, one past mending
            rows += [(1, 0, "e0", STEM + "it", four, "A"), (1, 1, "e1", STEM + "it!", four, "A"), (1, 2, " ", STEM + "x", four, "A"), (1, 3, "e1", STEM + "y", four[:2], "A"), (1, 4, "e2", STEM + "z", four[:3], "A")]
        elif 1 in got:  # a key of the round before, and two new ones: the answer may pass the quota
            rows += [(1, 0, "e0", STEM + "it", four, "A"), (1, 1, "e2", STEM + "it", four, "B"), (1, 2, "e2", STEM + "w", four, "C")]
        return _answers(rows, spark)

    def rewrite(bad):
        mended = bad.where("place = 3 and attempt = 2 or place = 4 and attempt < 3 or place = 3")
        return mended.withColumn("options", F.when((F.col("place") == 3) & (F.col("attempt") == 2), F.array(*map(F.lit, four))).otherwise(F.col("options"))).withColumn("anchor_id", F.lit(None).cast("string"))

    out, report = generate.generated(videos, anchors, ask, rewrite, limits=Thresholds(anchor_cap=2))
    got = [(r["qid"], r["round"], r["anchor_id"], r["answer"]) for r in out.orderBy("qid").collect()]
    assert got == [("1_q01", 1, "e0", "A"), ("1_q02", 1, "e1", "A"), ("1_q03", 2, "e2", "B"), ("1_q04", 2, "e2", "C")]
    facts = {r["video_id"]: r for r in report.collect()}
    one = facts[1]
    assert (one["rounds"], one["reused_anchor"], one["duplicates_dropped"], one["anchors_used"], one["anchors_prompted"], one["anchors_total"], one["n"]) == (2, 1, 2, 3, 2, 3, 4)
    assert (facts[2]["rounds"], facts[2]["n"], facts[2]["ok"]) == (1, 0, False) and facts[3]["rounds"] == facts[4]["rounds"] == 0
    assert set(asked[0]) == {1, 2} and set(asked[1]) == {1}  # an empty answer ends a video, the others go on
    assert [p["anchor_id"] for p in asked[1][1]["pool"]][-1] == "e2" and asked[1][1]["used"] == ["e0", "e1"] and (asked[1][1]["need"], asked[1][1]["lacks_L1"], asked[1][1]["lacks_L2"]) == (1, 0, 2)


@pytest.mark.parametrize("empty", [True, False])
def test_known_questions_count(spark, empty):
    videos = spark.createDataFrame([] if empty else [(1, 100.0, 1)], "video_id long, duration double, quota int")
    anchors = spark.createDataFrame([(1, "e0", 0, 0.0, 10.0, "key")], "video_id long, anchor_id string, ord long, s double, e double, importance string")
    known = _answers([] if empty else [(1, 0, "e0", STEM, ["a", "b", "c", "d"], "A")], spark).withColumn("qid", F.lit("old"))
    out, report = generate.generated(videos, anchors, None, None, known=known)  # at its quota, so nothing is asked
    assert [r["qid"] for r in out.collect()] == ([] if empty else ["old"]) and [r["n"] for r in report.collect()] == ([] if empty else [1])


def test_failed_parts_are_quiet_and_parents_are_built_of_the_rest(spark):
    v = "video_id long"
    videos = spark.createDataFrame([(1,), (2,)], v)
    shots = spark.createDataFrame([(1, 0, 0.0, 4.0, None), (1, 1, 4.0, 9.0, "已"), (1, 2, 9.0, 30.0, "已"), (1, 3, 30.0, 60.0, None)], f"{v}, ord long, s double, e double, zh string").withColumn("en", F.lit(None).cast("string"))
    windows = spark.createDataFrame([(1, 10.0 * k, 10.0 * k + 10) for k in range(6)] + [(1, 70.0, 70.0)], f"{v}, s double, e double")
    seen = []

    def ask(rows):
        seen.extend((r["level"], r["ord"], r["attempt"], len(r["parts"]), r["problem"]) for r in rows.collect())
        zh = F.when(F.col("level") == "shot", F.repeat(F.lit("字"), 80)).otherwise(F.concat(F.repeat(F.lit("镜"), 400), F.lit("00:10 00:20")))
        good = rows.where("not (level = 'shot' and ord = 3) and not (level = 'segment' and ord in (2, 3))")
        return good.select("video_id", "level", "ord", F.when((F.col("ord") == 1) & (F.col("attempt") == 0), "").otherwise(zh).alias("zh"), F.lit(None).cast("string").alias("en"), F.lit(6).alias("elements"))

    none = lambda rows: rows.where("false").select("video_id", "level", "ord", F.lit("").alias("text"))
    combine = lambda rows: rows.where("not (level = 'group' and ord = 2)").select("video_id", "level", "ord", F.array_join(F.transform("parts", lambda p: p["s"].cast("int").cast("string")), " ").alias("zh"), F.lit("en").alias("en"))
    done, segs, quiet, wholes = describe.described(videos, shots, windows, ask, none, combine, group=2, least_zh=3)
    assert [(r["ord"], r["ok"], r["zh"] and r["zh"][0]) for r in done.orderBy("ord").collect()] == [(0, True, "字"), (1, True, "字"), (2, True, "已"), (3, False, None)]
    assert [r["ord"] for r in segs.orderBy("ord").collect()] == [1, 4, 5, 6]
    assert sorted((r["level"], r["ord"], r["reason"]) for r in quiet.collect()) == [("group", 2, "no answer"), ("segment", 2, "no answer"), ("segment", 3, "no answer"), ("shot", 3, "no answer")]
    assert ("shot", 1, 1, 0, "no text") in seen and ("segment", 1, 0, 2, None) not in seen and ("segment", 1, 0, 3, None) in seen and ("segment", 6, 0, 0, None) in seen and not [x for x in seen if x[:2] == ("shot", 2)]
    one, two = wholes.orderBy("video_id").collect()
    assert (one["zh"], one["en"], one["shot_ok"], one["shot_total"], one["segment_ok"], one["segment_total"], one["n_quiet"]) == ("0", "en", 3, 4, 4, 6, 4)
    assert one["issues"] == ["en fill failed"] * 4 + ["short"] and (two["zh"], two["full_len_zh"], two["issues"], two["n_quiet"]) == (None, 0, ["short"], 0)


def test_sides_are_filled_and_checked(spark):
    rows = spark.createDataFrame([(1, "x", 1, "四个字啊", " "), (1, "x", 2, None, "two words"), (1, "x", 3, "一二三四五六", "one two three"), (1, "x", 4, "字", "a b c d e"), (1, "x", 5, None, None), (1, "x", 6, "好", None)], "video_id long, level string, ord long, zh string, en string")
    told = lambda r: r.where("ord <> 6").select("video_id", "level", "ord", F.when(F.col("to") == "en", " two words ").otherwise("两个词").alias("text"))
    back = lambda r: r.where("ord in (1, 3, 4)").select("video_id", "level", "ord", F.when(F.col("ord") == 1, "别的话呢").when(F.col("ord") == 3, "一二三四五六").alias("text"))
    got = {r["ord"]: (r["zh"], r["en"], r["issues"]) for r in describe.aligned(rows, told, back, Steps(spark, "sides")).collect()}
    assert got == {
        1: ("四个字啊", "two words", ["back translation"]), 2: ("两个词", "two words", []), 3: ("一二三四五六", "one two three", []), 4: ("字", "a b c d e", ["length ratio"]), 5: (None, None, []), 6: ("好", None, ["en fill failed"]),
    }
