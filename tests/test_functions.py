"""Literal vectors of the scalar functions and ordered operators."""

import pytest
from pyspark.sql import functions as F

from helpers import DATA
from tidemark.functions import intervals as I
from tidemark.functions import text as T
from tidemark.operators import agreement, audio, frames, gate, incremental, narrative, providers, questions, segments, workflow
from tidemark.plans import catalog


def value(spark, expr, **columns):
    frame = spark.range(1)
    for k, v in columns.items():
        frame = frame.withColumn(k, v if hasattr(v, "_jc") else F.lit(v))
    return frame.select(expr).first()[0]


def test_intervals(spark):
    lit = [F.lit(x) for x in (12.0, 34.5, 10.0, 30.0)]
    assert value(spark, I.iou(*lit)) == pytest.approx(0.7346938775510204)
    assert value(spark, I.overlap_ratio(*lit)) == pytest.approx(0.9)
    assert value(spark, I.overlap_ratio(F.lit(3.0), F.lit(3.0), F.lit(1.0), F.lit(9.0))) == 0
    assert [value(spark, I.duration_bucket(F.lit(x))) for x in (299.9, 300.0, 900.0, 2400.0, 7200.0, 7200.1)] == ["<5m", "5-15m", "15-40m", "40m-2h", "40m-2h", ">2h"]
    assert [value(spark, I.quota(F.lit(x))) for x in (600.0, 3600.0, 3601.0)] == [10, 24, 25]
    assert value(spark, I.frame_name(F.lit(1.9996))) == "f_0000002_000.jpg"
    assert value(spark, I.frame_time(F.lit("f_0000002_250.jpg"))) == 2.25
    assert 0.2 <= value(spark, I.pad_fraction(F.lit("x"))) <= 0.8


def test_text(spark):
    sim = lambda a, b: value(spark, T.jaccard(T.ngrams(F.lit(a)), T.ngrams(F.lit(b))))
    assert sim("abcdef", "abcxef") == pytest.approx(1 / 7)
    assert sim("ab", "ab") == sim("", "") == 1
    arr = lambda s: F.array(*map(F.lit, s))
    assert value(spark, T.lcs(arr("abcde"), arr("bdxe"))) == 3
    assert value(spark, T.rouge_l(arr("abcde"), arr("bdxe"))) == pytest.approx(2 / 3)
    assert value(spark, T.tokens(F.lit("约 12:30 新娘 said it's 3.5"))) == ["约", "12", "30", "新", "娘", "said", "it's", "3.5"]
    assert value(spark, T.anchors(F.lit("约 12:30 then 01:02:03"))) == 2
    assert value(spark, T.zh_len(F.lit("a　b  c"))) == 3 and value(spark, T.en_len(F.lit(" a　b  c "))) == 3
    assert value(spark, T.referring(F.lit("strengthen the rope"))) is False and value(spark, T.referring(F.lit("第三次出现"))) is True
    assert value(spark, T.cosine(arr([0.0, 0.0]), arr([1.0, 0.0]))) == 0
    assert value(spark, T.language_prior(arr(["None of the above.", "b", "c", "d"]), F.lit("q"))) is True
    assert value(spark, T.language_prior(arr(["x", "b", "c"]), F.lit("q"))) is False
    assert value(spark, providers.json_body(F.lit('so ```json\n{"a": 1}\n``` ok'))) == '{"a": 1}'
    assert value(spark, providers.json_body(F.lit("nothing"))) is None


def test_alpha(spark):
    units = [("1", "B"), ("1", "B"), ("2", "C"), ("2", "A"), ("3", "A"), ("3", "D")]
    assert agreement.alpha_nominal(spark.createDataFrame(units, "unit string, value string")).first()[0] == pytest.approx(1 - 5 * 4 / 26)
    same = [(str(i), "A") for i in (1, 1, 2, 2)]
    assert agreement.alpha_nominal(spark.createDataFrame(same, "unit string, value string")).first()[0] is None
    assert agreement.alpha_nominal(spark.createDataFrame([], "unit string, value string")).first()[0] is None


def test_gaps_and_windows(spark):
    spans = spark.createDataFrame([(1, 0.0, 10.0), (1, 10.9, 20.0), (1, 25.0, 30.0)], "video_id long, s double, e double")
    videos = spark.createDataFrame([(1, 40.0), (2, 5.0)], "video_id long, duration double")
    got = {tuple(r) for r in segments.gaps(videos, spans, 1.0, 1.0, True).collect()}
    assert got == {(1, 20.0, 25.0), (1, 30.0, 40.0), (2, 0.0, 5.0)}
    shots = lambda *x: spark.createDataFrame([(1, *p) for p in x], "video_id long, s double, e double")
    out = lambda frame: sorted((r["s"], r["e"]) for r in frame.collect())
    assert out(segments.greedy_windows(shots((0.0, 100.0), (100.0, 170.0), (170.0, 190.0)), 180)) == [(0, 170), (170, 190)]
    assert out(segments.greedy_windows(shots((0.0, 400.0)), 180)) == [(0, 180), (180, 360), (360, 400)]
    point = spark.createDataFrame([(1, 60.0)], "video_id long, t double")
    assert sorted((r["ws"], r["we"]) for r in segments.sliding_windows(point, 60, 30, 70).collect()) == [(0, 60), (30, 70), (60, 70)]


def test_first_fit(spark):
    spans = spark.createDataFrame([(1, 0, 7.0, 18.0), (1, 1, 15.0, 23.0), (1, 2, 19.0, 27.0), (1, 3, 20.0, 24.0)], "video_id long, ord long, s double, e double")
    got = {r["ord"]: r["cluster"] for r in segments.first_fit_clusters(spans).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 1}


def test_renumber(spark):
    """In list order, not by time; what stands before the last _q stays."""
    rows = [("v", "v_q1", 50.0, 1), ("v", "v_q2", 10.0, 2), ("v", "a_q_b_q9", 0.0, 3), ("w", "plain", 1.0, 1)]
    frame = spark.createDataFrame(rows, "video_id string, qid string, s double, ord long")
    got = {r["qid"]: r["new_qid"] for r in questions.renumber(frame).collect()}
    assert got == {"v_q1": "v_q01", "v_q2": "v_q02", "a_q_b_q9": "a_q_b_q03", "plain": "plain_q01"}


def test_rescreen_uses_the_channels_of_each_type(spark):
    q = [
        ("v", 1, "v_q1", "mcq", ["L1_detail"], None, False, False, True, None), ("v", 2, "v_q2", "temporal_grounding", ["L1_detail"], "auto:a", True, False, False, None),
        ("v", 3, "v_q3", "open", ["L1_detail"], "auto:a", None, None, None, None), ("v", 4, "v_q4", "odd", ["L1_detail"], "auto:a", True, False, False, None), ("w", 1, "w_q1", "mcq", ["L1_detail"], None, False, False, False, None),
        ("v", 5, "v_q5", "mcq", ["L1_ocr"], "auto:a", False, False, False, False),
    ]
    q = spark.createDataFrame(q, "video_id string, ord long, qid string, task_type string, capability array<string>, checked_by string, blind boolean, subtitle boolean, subtitle_locate boolean, blind_similar boolean")
    second = spark.createDataFrame([("v_q2", False, True, False), ("v_q3", True, False, True), ("v_q5", False, True, False), ("x", True, True, True)], "qid string, blind boolean, subtitle boolean, blind_similar boolean")
    videos = spark.createDataFrame([("v", "b", ["auto:a:m1", "human:x"]), ("w", "a", ["auto:a"]), ("u", "b", None)], "video_id string, provider string, annotators array<string>")
    kept, stats = questions.rescreen(videos, q, second)
    rows = {r["qid"]: r for r in kept.collect()}
    # a temporal question isn't judged by blind or subtitle hits; an odd one keeps its flags and stays
    assert {k: (r["new_qid"], r["checked_by"], r["primary"], r["secondary"]) for k, r in rows.items()} == {
        "v_q1": ("v_q01", "auto:?+auto:b", [], []), "v_q2": ("v_q02", "auto:a+auto:b", [], []), "v_q4": ("v_q03", "auto:a", None, None), "v_q5": ("v_q04", "auto:a+auto:b", [], ["subtitle"]),
    }
    assert rows["v_q4"]["blind"] and not rows["v_q2"]["blind"] and not rows["v_q1"]["subtitle_locate"] and rows["v_q5"]["subtitle"]
    assert sorted(map(tuple, stats.collect())) == [("u", "b", "draft", 0, 0, []), ("v", "b", "draft", 5, 4, ["v_q3"])]
    assert questions.rescreen(videos, q, second, force=True)[1].count() == 3


def test_rework_leaves_gold_questions_out(spark):
    rows = [("g", "a", "B", "A", True), ("q", "a", "B", "A", False), ("r", "a", "A", "A", None)]
    got = agreement.rework(spark.createDataFrame(rows, "qid string, annotator string, response string, answer string, is_gold boolean")).collect()
    assert [r["qid"] for r in got] == ["q"]


def test_rework_over_the_whole_key(spark):
    """The query reports every question of the key, gold ones too; the statistics of a batch go on without them."""
    rows = [("g", "a", "B", "A", True), ("q", "a", "B", "A", False), ("r", "a", "A", "A", None), ("h", "a", None, "A", True)]
    got = agreement.rework(spark.createDataFrame(rows, "qid string, annotator string, response string, answer string, is_gold boolean"), gold=True).collect()
    assert sorted(r["qid"] for r in got) == ["g", "q"]
    asked = catalog.qc_rework(spark, DATA).select(F.split("qid", "_q")[1].cast("long").alias("ord"))
    assert asked.where("ord % 7 = 0").count() > 0  # the gold ones of the fixtures
    n = asked.where("ord % 7 <> 0").count()
    assert catalog.mcq_stats(spark, DATA).first()["rework"] == n


def test_coverage_without_evidence_fails(spark):
    q = spark.createDataFrame([("v", "mcq", ["L1_detail"], "whole_video", [])], "video_id string, task_type string, capability array<string>, min_watch string, spans array<struct<s: double, e: double>>")
    assert questions.coverage(q, 100.0).first()["ok_buckets"] is False


def test_aliases(spark):
    names = spark.createDataFrame([(1, "p1", "Ann Lee", "安", ["Annie"]), (1, "p2", "ann-lee", None, []), (1, "p3", None, "J.R.", None), (1, "p4", "Zed", None, ["annie"])], "video_id long, id string, en string, zh string, aliases array<string>")
    seen = spark.createDataFrame([(1, n, i) for i, n in enumerate(("ann-lee", "ANN LEE", "annie", "安", "zoe", "JR"))], "video_id long, name string, ord long")
    matched = narrative.match_alias(names, seen)
    assert {r["id"]: r["alias"] for r in matched.collect()} == {"p1": "ann-lee", "p2": "ann-lee", "p3": None, "p4": "annie"}
    assert sorted(r["name"] for r in narrative.unmatched(matched, seen).collect()) == ["ANN LEE", "JR", "zoe", "安"]


def test_rework_compares_with_the_key(spark):
    rows = [("q1", "a", "B", "A"), ("q1", "b", "B", "A"), ("q2", "a", "A", "A"), ("q2", "b", "A", "A"), ("q3", "b", "C", "A"), ("q3", "a", "A", "A"), ("q4", "a", None, "A"), ("q5", "a", "B", None)]
    got = [tuple(r) for r in agreement.rework(spark.createDataFrame(rows, "qid string, annotator string, response string, answer string").selectExpr("*", "false AS is_gold")).collect()]
    assert got == [("q1", "A", 2, 0.0, ["B", "B"]), ("q3", "A", 2, 0.5, ["A", "C"])]


def test_downstream_of_descriptions(spark):
    changed = spark.createDataFrame([(1, "S2"), (2, "S5")], "video_id long, stage string")
    got = sorted(tuple(r) for r in incremental.downstream(spark, changed).collect())
    assert got == [(1, "S3"), (1, "S4"), (1, "S5"), (1, "S6"), (1, "S7"), (2, "S6"), (2, "S7")]


def test_causes_need_verified_boundaries(spark):
    rows = [(1, 0, 0.0, 1.0, "verified", None), (1, 1, 2.0, 3.0, "split", 0), (1, 2, 2.0, 3.0, "refined", 0), (1, 3, 4.0, 5.0, "verified", 1), (1, 4, 2.5, 5.0, "verified", 2), (1, 5, 9.0, 9.5, "verified", 77), (1, 6, 9.0, 9.5, "verified", 6)]
    got = {r["ord"]: r["fault"] for r in narrative.causal_faults(spark.createDataFrame(rows, "video_id long, ord long, s double, e double, boundary_state string, cause long")).collect()}
    assert got == {1: "unverified", 2: None, 3: "unverified", 4: "order", 5: "missing", 6: "self loop"}


def test_empty_spans_widen_around_their_start(spark):
    rows = [(0, 10.0, 5.0, "minor"), (1, 10.0, 10.0, "key"), (2, 900.0, 950.0, "key"), (3, 5.0, 7.0, "key"), (4, -5.0, -1.0, "minor")]
    got = {r["ord"]: (r["s"], r["e"], r["importance"], r["todo"]) for r in narrative.normalise_spans(spark.createDataFrame(rows, "ord long, s double, e double, importance string"), 700.0).collect()}
    assert got == {0: (9.0, 11.0, "minor", False), 1: (9.0, 11.0, "minor", False), 2: (699.0, 700.0, "minor", False), 3: (5.0, 7.0, "minor", False), 4: (0.0, 1.0, "minor", False)}


def test_boundary_shares_count_both_halves(spark):
    rows = [(1, "a", 0.0, 9.0, "split", None, None, 4.0), (1, "b", 0.0, 9.0, "rejected", None, None, None), (1, "c", 0.0, 9.0, "verified", None, None, None), (1, "d", 0.0, 9.0, "refined", 1.0, 8.0, None)]
    v = spark.createDataFrame(rows, "video_id long, id string, s double, e double, decision string, rs double, re double, at double")
    got = narrative.boundary_stats(narrative.apply_verdicts(v), v.where("decision = 'rejected'")).first()
    assert (got["n"], got["refined_ratio"], got["rejected_ratio"]) == (5, 0.6, 0.2)


def test_coverage_counts_capabilities_and_spans(spark):
    rows = [(1, "mcq", ["L1_ocr", "L1_action", "L5_needle"], "single_scene", [(0.0, 1.0), (90.0, 95.0)]), (1, "open", ["L2_counting"], "whole_video", [(30.0, 31.0)])]
    q = spark.createDataFrame(rows, "video_id long, task_type string, capability array<string>, min_watch string, spans array<struct<s: double, e: double>>")
    got = questions.coverage(q, 100.0).first()
    assert (got["n"], got["L1"], got["L2"], got["L5"], got["b0"], got["b1"], got["b3"], got["cross"]) == (2, 2, 1, 1, 1, 1, 1, 1)


def test_sounds(spark):
    levels = {1: [0.1] * 10 + [0.9] * 10, 2: [0.1] * 20, 3: [0.1, 0.3, 0.1, 0.1] * 5, 4: [0.9]}
    rows = [(1, seg, seg * 100 + i, x) for seg, xs in levels.items() for i, x in enumerate(xs)]
    f = spark.createDataFrame(rows, "video_id long, seg long, frame_no long, rms double")
    base = spark.createDataFrame([(1, 0.1)], "video_id long, baseline double")
    got = {r["seg"]: (r["a"], r["b"], r["type"]) for r in audio.detect(f, base, ["video_id", "seg"], 0.1).collect()}
    # 1: mean 0.5 is loud enough for music; 2: no peak; 3: the mean is 1.5 times the baseline; 4: one frame is too short
    assert got == {1: (105, 119, "music"), 3: (300, 319, "noise")}
    assert audio.active_bounds(f.where("seg = 2"), spark.createDataFrame([(1, 0.2)], "video_id long, baseline double"), ["video_id", "seg"]).count() == 0


def test_names_keep_dots(spark):
    assert value(spark, T.name_key(F.lit("J.R. Ewing\u3000-x_·Y"))) == "j.r.ewingxy"


def test_reuse_needs_done_stages(spark):
    m = spark.createDataFrame([(1, "a", "done"), (1, "b", "done"), (2, "a", "done"), (2, "b", "skipped"), (3, "a", "done"), (3, "b", "done")], "video_id long, stage string, state string")
    assert [r[0] for r in workflow.reusable(m, spark.createDataFrame([(1,), (2,)], "video_id long"), 2).collect()] == [1]


def test_durations_exactly_at_the_tolerance_agree(spark):
    m = spark.createDataFrame([(1, 262141.9, 262141.9 + 8 - 3), (2, 262141.9, 262146.901), (3, 10.0, 15.0), (4, 15.001, 10.0), (5, 0.1, 5.1)], "video_id long, duration_sec double, measured double")
    assert sorted(r[0] for r in workflow.duration_conflicts(m.drop("measured"), m.drop("duration_sec")).select("video_id").collect()) == [2, 4]


def test_scenes_by_list_order(spark):
    scenes = spark.createDataFrame([(1, 7, 0.0, 60.0, 1), (1, 3, 60.0, 120.0, 2)], "video_id long, scene_id long, s double, e double, place int")
    events = spark.createDataFrame([(1, 0, 50.0, 70.0), (1, 1, 200.0, 201.0)], "video_id long, ord long, s double, e double")
    assert {r["ord"]: r["scene_id"] for r in narrative.scene_of(events, scenes, 60.0).collect()} == {0: 7, 1: None}


def test_frame_numbers_that_collide(spark):
    times = [0.0, 0.4, 0.6, 1.0, 4.0, 4.4]
    names = spark.createDataFrame([(1, f"f_{int(t):07d}_{round(t % 1 * 1000):03d}.jpg") for t in times] + [(1, "cover.jpg")], "video_id long, name string")
    assert sorted((r["t"], r["frame_no"]) for r in frames.index(names, 1.0).collect()) == [(0.0, 0), (0.4, 1), (0.6, 2), (1.0, 3), (4.0, 4), (4.4, 5)]


def test_distinct_times_round_half_to_even(spark):
    times = F.array(*(F.lit(float(x)) for x in range(10)))
    assert value(spark, I.distinct_times(times, F.lit(0.0), F.lit(9.0), 3)) == [0.0, 4.0, 9.0]
    assert value(spark, I.distinct_times(times, F.lit(2.0), F.lit(3.0), 3)) == [2.0, 3.0]
    assert value(spark, I.distinct_times(times, F.lit(5.0), F.lit(5.0), 3)) == []


def test_backoff_and_fatal_statuses(spark):
    assert [providers.backoff(0, None, 1.0), providers.backoff(9, None, 0.0), providers.backoff(1, 500.0, 0.0), providers.backoff(1, -1.0, 0.0)] == [1.0, 15.0, 60.0, 0.0]

    class Refuses:
        calls = 0

        def complete(self, prompts):
            self.calls += 1
            e = RuntimeError("no")
            e.status_code = 401 if self.calls > 1 else 429
            raise e

    got = providers.complete(spark.createDataFrame([("1", "a")], "request_hash string, prompt string"), Refuses, wait=lambda s: None).first()
    assert got["ok"] is False and got["response"] is None


def test_hashes_cascade(spark):
    rows = [(1, f"S{i}", "x") for i in range(1, 8)]
    a = {r["stage"]: r["hash"] for r in incremental.cascaded(spark.createDataFrame(rows, "video_id long, stage string, digest string")).collect()}
    rows[1] = (1, "S2", "other")
    b = {r["stage"]: r["hash"] for r in incremental.cascaded(spark.createDataFrame(rows, "video_id long, stage string, digest string")).collect()}
    assert {s for s in a if a[s] != b[s]} == {"S2", "S3", "S4", "S5", "S6", "S7"} and len(set(a.values())) == 7


def test_provider_retries(spark):
    class Flaky:
        def __init__(self):
            self.calls = 0

        def complete(self, prompts):
            self.calls += 1
            return [None if self.calls < 2 or p == "bad" else p.upper() for p in prompts]

    asked = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "bad")], "request_hash string, prompt string")
    got = sorted(tuple(r) for r in providers.complete(asked, Flaky, wait=lambda s: None).select("request_hash", "response", "ok").collect())
    assert got == [("1", "A", True), ("1", "A", True), ("2", None, False)]


def test_gate_loop(spark):
    asked = spark.createDataFrame([("a",), ("bb",)], "prompt string")
    answer = lambda f: f.withColumn("response", F.col("prompt"))
    fault = F.when(F.length("response") < 2, "short")
    got = {r["prompt"].split("\n")[0]: r["response"] for r in providers.gate_loop(asked, answer, fault, 2, lambda f, _: f).collect()}
    assert got["bb"] == "bb" and got["a"] == "a\nEarlier answer failed: short"


def test_embeddings(spark):
    class Lengths:
        def embed(self, texts):
            return [[float(len(t)), 1.0] for t in texts]

    got = providers.embed(spark.createDataFrame([(1, "a"), (2, "bcd")], "id long, text string"), Lengths).collect()
    assert sorted((r["id"], r["embedding"]) for r in got) == [(1, [1.0, 1.0]), (2, [3.0, 1.0])]


def test_sets_and_vectors_against_brute_force(spark, monkeypatch):
    import random

    import numpy as np

    from tidemark.operators import pairs

    r = random.Random(2)
    sets = {i: r.sample(range(40), r.randint(0, 25)) for i in range(60)} | {100 + i: list(range(i, i + 20)) for i in range(5)}
    frame = spark.createDataFrame(list(sets.items()), "id long, items array<long>")
    for least in (0.3, 0.85):
        want = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len({*sets[a]} & {*sets[b]}) / len({*sets[a]} | {*sets[b]}) >= least}
        assert {(x["id"], x["other"]) for x in pairs.similar_sets(frame, least).collect()} == want
    monkeypatch.setattr(pairs, "BLOCK", 7)
    g = np.random.default_rng(1)
    rows = [(int(i % 3) if i % 11 else None, int(i), [float(x) for x in g.normal(size=4)] if i % 13 else [0.0] * 4) for i in range(80)]
    table = spark.createDataFrame(rows, "label long, id long, vector array<double>")
    cosine = lambda a, b: np.dot(a, b) / max(np.linalg.norm(a) * np.linalg.norm(b), 1e-300)
    want = {(q[1], x[1]) for q in rows if q[1] % 20 == 0 for x in rows if q[0] is not None and q[0] == x[0] and q[1] != x[1] and cosine(q[2], x[2]) >= 0.4}
    assert want and {(x["id"], x["other"]) for x in pairs.vector_search(table.where("id % 20 = 0"), table, 0.4).collect()} == want


def test_decisions_are_written_back(spark):
    products = spark.sql("SELECT * FROM VALUES (1, named_struct('review_status', 'draft', 'rejected_reasons', 'old', 'kept', 1)), (2, named_struct('review_status', 'verified', 'rejected_reasons', cast(null as string), 'kept', 2)), (3, named_struct('review_status', 'draft', 'rejected_reasons', 'x', 'kept', 3)) AS t(video_id, annotation_meta)")
    gated = spark.createDataFrame([(1, True, ""), (2, False, "alpha")], "video_id int, pass boolean, reasons string")
    got = {r["video_id"]: tuple(r["annotation_meta"]) for r in gate.written_back(products, gated).collect()}
    assert got == {1: ("verified", None, 1), 2: ("draft", "alpha", 2), 3: ("draft", None, 3)}


def test_verification_reaches_each_outcome(spark):
    """Choices: wrong, then rewritten to the verifier's letter; a lost rewrite; never reconciled; a leak; no answer."""
    from tidemark.operators import verify

    row = lambda q, kind, answer, frames=True, synopsis=False, reference=None: ("v", q, len(q), kind, f"{q}?", ["w", "x"], answer, 10.0, 20.0, reference, frames, synopsis)
    rows = [
        row("agree", "mcq", "A"), row("fixed", "mcq", "A"), row("late", "mcq", "A"), row("never", "mcq", "A"), row("leak", "mcq", "C", synopsis=True), row("silent", "mcq", "A"), row("blind", "mcq", "A", frames=False),
        row("near", "temporal_grounding", None), row("far", "temporal_grounding", None), row("like", "open", None, reference="r"), row("unlike", "summary", None, reference="r"), row("bare", "open", None), row("odd", "essay", None),
    ]
    q = spark.createDataFrame(rows, "video_id string, qid string, ord int, task_type string, question string, options array<string>, answer string, s double, e double, reference string, has_frames boolean, has_synopsis boolean")
    asked = []

    def table(name, schema, data):
        def ask(frame):
            asked.append((name, sorted(r["qid"] for r in frame.select("qid").collect())))
            attempt = frame.first()["attempt"] if "attempt" in frame.columns and frame.count() else 0
            return spark.createDataFrame([x for x in data(attempt)], schema)

        return ask

    choose = table("choose", "qid string, answer string, confidence double", lambda n: [("agree", "A", 0.9), ("fixed", "B" if n == 0 else "D", 0.8), ("late", "B", None), ("never", "B", 0.1 * n), ("silent", "F", 1.0)])
    rewrite = table("rewrite", "qid string, question string, options array<string>, answer string", lambda n: [("fixed", "new", ["y"], "D"), ("late", None, None, "Q" if n == 1 else "B"), ("never", None, ["z"], "C")])
    out, counts = verify.verified(
        q, table("leak", "qid string, answer string", lambda n: [("leak", "C"), ("agree", "A")]),
        table("locate", "qid string, a double, b double, lo double, hi double, confidence double", lambda n: [("near", 5.0, 21.0, 9.0, 30.0, 0.7), ("far", 25.0, 29.0, 9.0, 30.0, None)]),
        table("free", "qid string, text string, similarity double, confidence double", lambda n: [("like", "t", 0.5, 0.2), ("unlike", "t", 0.4996, 0.2), ("bare", "t", 0.9, 0.2)]), choose, rewrite,
    )
    got = {r["qid"]: (r["outcome"], r["agreed"], r["flag"] or r["reason"], r["answer"], r["regen"]) for r in out.collect()}
    assert got == {
        "agree": ("kept", True, None, "A", 0), "fixed": ("kept", True, None, "D", 1), "late": ("kept", True, None, "B", 1), "never": ("dropped", False, "verify_mismatch", "C", 2), "leak": ("dropped", None, "synopsis_leak", "C", 0),
        "silent": ("kept", None, "verifier failed", "A", 0), "blind": ("kept", None, "no frames", "A", 0), "near": ("kept", True, None, None, 0), "far": ("kept", False, "temporal_miou_low", None, 0), "like": ("kept", True, None, None, 0),
        "unlike": ("kept", True, None, None, 0), "bare": ("kept", None, "no valid answer", None, 0), "odd": ("kept", None, None, None, 0),
    }
    final = {r["qid"]: r for r in out.collect()}
    assert final["fixed"]["question"] == "new" and final["never"]["question"] == "never?" and final["never"]["options"] == ["z"] and final["never"]["confidence"] == pytest.approx(0.2)
    assert [x for x in asked if x[0] == "rewrite"] == [("rewrite", ["fixed", "late", "never"]), ("rewrite", ["late", "never"])]
    assert [x for x in asked if x[0] == "choose"][1:] == [("choose", ["fixed", "never"]), ("choose", ["late", "never"])]
    c = counts.first()
    assert (c["n"], c["kept"], c["verified"], c["agreed"], c["regen"], c["leaks"], c["mismatch"], c["temporal_pass"], c["open_pass"]) == (13, 11, 4, 3, 4, 1, 1, 1, 2)


def test_unevaluated_metrics_are_written_back(spark):
    products = spark.createDataFrame([(1, ("draft", None, ["old"])), (2, ("draft", None, ["old"])), (3, ("x", None, ["old"]))], "video_id long, annotation_meta struct<review_status: string, rejected_reasons: string, release_unevaluated: array<string>>")
    gated = spark.createDataFrame([(1, True, "", ["alpha"]), (2, False, "schema", [])], "video_id long, pass boolean, reasons string, unevaluated array<string>")
    got = {r["video_id"]: tuple(r["annotation_meta"]) for r in gate.written_back(products, gated).collect()}
    assert got == {1: ("verified", None, ["alpha"]), 2: ("draft", "schema", ["old"]), 3: ("x", None, ["old"])}
