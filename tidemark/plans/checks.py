"""DuckDB SQL that computes the same rows as the queries of the catalog."""

from __future__ import annotations

from tidemark.config import CAPABILITIES, GENRES
from tidemark.functions import text as T
from tidemark.operators.incremental import DEPENDS
from tidemark.sources.fixtures import SQL as VIEWS

_IOU = "CASE WHEN greatest({e1},{e2}) - least({s1},{s2}) <= 0 THEN 0.0 ELSE greatest(0.0, least({e1},{e2}) - greatest({s1},{s2})) / (greatest({e1},{e2}) - least({s1},{s2})) END"
_RATIO = "CASE WHEN least({e1}-{s1},{e2}-{s2}) <= 0 THEN 0.0 ELSE greatest(0.0, least({e1},{e2}) - greatest({s1},{s2})) / least({e1}-{s1},{e2}-{s2}) END"
_BLANK = r"[\s\x0b\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"




def _name_key(c: str) -> str:
    return f"lower(regexp_replace({c}, '[_·\\-]|{_BLANK}', '', 'g'))"


_PERSONS = f"""
persons AS (SELECT s_nationkey AS video_id, s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS en, CASE WHEN s_suppkey % 5 = 0 THEN 'J.R.' || s_suppkey END AS zh, ['No-' || s_suppkey] AS aliases FROM supplier),
seen AS (SELECT video_id, name, ord, {_name_key("name")} AS key FROM (SELECT s_nationkey AS video_id, s_suppkey * 10 + p AS ord, ([s_name, upper(replace(s_name, '#', '_ #')), 'no ' || s_suppkey, 'JR' || s_suppkey, 'j.r.·' || s_suppkey])[p + 1] AS name
  FROM supplier, range(5) r(p) WHERE (s_suppkey + p) % 3 = 0)),
tried AS (SELECT video_id, id, p, c, {_name_key("c")} AS key FROM (SELECT video_id, id, unnest(list_concat([en, zh, id], aliases)) AS c, generate_subscripts(list_concat([en, zh, id], aliases), 1) AS p FROM persons) WHERE c <> '')
"""


def _sql(body: str, views: str = "") -> str:
    return f"WITH RECURSIVE {VIEWS.strip()}{',' if views else ''} {views} {body}"


def _alpha(ratings: str) -> str:
    return f"""
WITH RECURSIVE {VIEWS.strip()}, ratings AS ({ratings}),
c AS (SELECT unit, value, count(*) AS c, sum(count(*)) OVER (PARTITION BY unit) AS m FROM ratings WHERE value IS NOT NULL GROUP BY unit, value),
p AS (SELECT * FROM c WHERE m >= 2),
n AS (SELECT sum(c) AS n, sum(c * (c - 1) / (m - 1)) AS agree FROM p),
v AS (SELECT sum(nv * nv) AS squares FROM (SELECT sum(c) AS nv FROM p GROUP BY value)),
k AS (SELECT count(DISTINCT value) AS kinds FROM ratings)
SELECT round(CASE WHEN kinds < 2 OR coalesce(n, 0) = 0 THEN NULL WHEN n * n = squares THEN 1.0 ELSE 1 - (n - 1) * (n - agree)::DOUBLE / (n * n - squares) END, 6) AS alpha FROM n, v, k
"""


def _like(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def _ngrams(c: str, n: int = 3) -> str:
    x = f"regexp_replace({c}, '{_BLANK}', '', 'g')"
    return f"CASE WHEN length({x}) <= {n} THEN [{x}] ELSE list_distinct(list_transform(range(1, length({x}) - {n} + 2), lambda i: substr({x}, i, {n}))) END"


_JACCARD = "len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b})))::DOUBLE"

#: Questions to rework among those that aren't gold, as the statistics of a batch count them.
_REWORK_NON_GOLD = _sql("""
SELECT qid, answer, count(*) AS n, round(avg((response = answer)::INT::DOUBLE), 6) AS agreement, string_agg(response, ',' ORDER BY annotator) AS answers FROM v_responses WHERE task_type = 'mcq' AND NOT is_gold GROUP BY qid, answer HAVING avg((response = answer)::INT) < 1
""")

_UNION = """
u0 AS (SELECT video_id, s, e, max(e) OVER (PARTITION BY video_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v_spans WHERE e > s),
u1 AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before + {eps} THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM u0),
u AS (SELECT video_id, min(s) AS s, max(e) AS e FROM u1 GROUP BY video_id, island)
"""
_GAPS = """
SELECT video_id, round(s, 6) AS s, round(e, 6) AS e FROM (
  SELECT video_id, lag(e, 1, 0.0) OVER (PARTITION BY video_id ORDER BY s) AS s, s AS e FROM u
  UNION ALL SELECT v.video_id, coalesce(max(u.e), 0.0), v.duration FROM v_videos v LEFT JOIN u USING (video_id) GROUP BY v.video_id, v.duration
) WHERE {test}
"""

_LINK = """
linked AS (SELECT p.video_id, p.ord, p.s, p.e, arg_min(c.scene_id, c.place) AS scene_id FROM v_spans p LEFT JOIN v_scenes c ON p.video_id = c.video_id AND c.s <= (p.s + p.e) / 2 AND (p.s + p.e) / 2 <= c.e GROUP BY ALL)
"""

_VERDICTS = """
v_verdicts AS (SELECT video_id, 'c' || ord AS id, s, e, (['verified','refined','split','rejected','odd'])[(ord % 5 + 1)::INT] AS decision, s + 0.25::DOUBLE AS rs, e + 0.5::DOUBLE AS re, (s + e) / 2 AS at_ FROM v_spans)
"""

_FRAMES = "v_frames AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY t, ord) - 1 AS frame_no, v / 100 AS rms, ord % 3 = 0 AS speech, floor(t / 60)::BIGINT AS seg FROM v_points)"
_BASE = """
base AS (SELECT video_id, CASE WHEN b > 0 THEN b ELSE 1e-6 END AS baseline FROM (SELECT video_id, coalesce(quantile_cont(rms, 0.5) FILTER (WHERE speech), quantile_cont(rms, 0.5)) AS b FROM v_frames GROUP BY video_id))
"""

_BOUNDS = """
bounds AS (SELECT video_id, seg, greatest(lo, first - 5) AS a, least(hi, last + 5) AS b FROM (SELECT video_id, seg, min(frame_no) AS lo, max(frame_no) AS hi, min(frame_no) FILTER (WHERE loud) AS first, max(frame_no) FILTER (WHERE loud) AS last
  FROM (SELECT *, rms >= greatest(1.2 * baseline, 1e-5) AS loud FROM v_frames JOIN base USING (video_id)) GROUP BY video_id, seg) WHERE first IS NOT NULL)
"""

_FLAGS = """
q AS (SELECT *, NOT (capability IN ('L1_audio_asr','L1_ocr','L4_subtitle_visual','L4_narration_align')) AS visual,
  CASE WHEN ord % 9 = 0 THEN 2 ELSE 1 END AS n_spans, CASE WHEN ord % 5 = 0 THEN [capability, 'L5_needle'] ELSE [capability] END AS caps FROM v_qa),
dq AS (SELECT *, blind OR (subtitle AND visual) OR (single_frame AND visual) AS dropped FROM q)
"""

_COVERAGE = """
cq AS (SELECT *, CASE WHEN ord % 5 = 0 THEN [capability, 'L5_needle'] ELSE [capability] END AS caps, CASE WHEN ord % 9 = 0 THEN [s, s / 2] ELSE [s] END AS starts FROM v_qa),
cv AS (SELECT video_id, count(*) AS n, {layers}, count(*) FILTER (WHERE min_watch IN ('cross_scene','whole_video')) AS "cross", {tasks}, {buckets} FROM cq GROUP BY video_id),
cm AS (SELECT *, least(L1, L2, L3, L4, L5) >= 2 AS ok_layers, "cross" / n::DOUBLE >= 0.5 AS ok_cross, mcq / n::DOUBLE BETWEEN 0.5 AND 0.7 AS ok_mcq, temporal_grounding / n::DOUBLE BETWEEN 0.15 AND 0.25 AS ok_temporal,
  least(b0, b1, b2, b3) / (b0 + b1 + b2 + b3)::DOUBLE >= 0.15 AS ok_buckets FROM cv)
""".format(
    layers=", ".join(f"sum(len(list_filter(caps, lambda c: starts_with(c, 'L{i}'))))::BIGINT AS L{i}" for i in range(1, 6)),
    tasks=", ".join(f"count(*) FILTER (WHERE task_type = '{t}') AS {t}" for t in ("mcq", "temporal_grounding", "open", "summary")),
    buckets=", ".join(f"sum(len(list_filter(starts, lambda x: least(3, floor(x / 720 * 4)) = {i})))::BIGINT AS b{i}" for i in range(4)),
)

_MIOU = "items AS (SELECT video_id, qid, avg(" + _IOU.format(s1="s", e1="e", s2="rs", e2="re") + ") AS miou FROM v_responses WHERE task_type = 'temporal_grounding' GROUP BY video_id, qid)"

_ALL = ["blind", "subtitle", "single_frame", "synopsis", "language_prior", "subtitle_locate", "blind_similar"]
_RESCREEN = f""",
screened AS (SELECT video_id, (['north','south','east'])[(video_id % 3 + 1)::INT] AS provider FROM v_videos WHERE video_id % 3 <> 0),
ch AS (SELECT q.*, provider, CASE WHEN task_type = 'mcq' THEN ['blind','subtitle','single_frame','synopsis','language_prior'] WHEN task_type = 'temporal_grounding' THEN ['subtitle_locate'] ELSE ['blind_similar'] END AS tried,
  list_filter([{", ".join(f"CASE WHEN {c} THEN '{c}' END" for c in _ALL[:3])}, {", ".join(f"CASE WHEN ord % {m} = 0 THEN '{c}' END" for c, m in zip(_ALL[3:], (19, 23, 6, 14), strict=True))}], lambda x: x IS NOT NULL) AS p,
  CASE WHEN ord % 2 = 0 THEN list_filter([{", ".join(f"CASE WHEN {f'ord % {m} = 0' if m else 'false'} THEN '{c}' END" for c, m in zip(_ALL, (17, None, 5, 29, 31, 10, 9), strict=True))}], lambda x: x IS NOT NULL) ELSE [] END AS s2 FROM q JOIN screened USING (video_id)),
r0 AS (SELECT *, list_filter(p, lambda x: list_contains(tried, x)) AS one, list_filter(s2, lambda x: list_contains(tried, x)) AS two FROM ch),
r1 AS (SELECT *, list_filter([{", ".join(f"'{c}'" for c in _ALL)}], lambda x: list_contains(one, x) OR list_contains(two, x)) AS hit FROM r0),
r AS (SELECT *, len(list_filter(hit, lambda x: visual OR x NOT IN ('subtitle', 'single_frame'))) > 0 AS gone,
  CASE WHEN ord % 4 = 0 THEN 'auto:?' ELSE 'auto:west' END || '+auto:' || provider AS checked_by FROM r1),
kept AS (SELECT qid, regexp_extract(qid, '^(.*)_q[^_]*$', 1) || '_q' || CASE WHEN rn < 10 THEN '0' ELSE '' END || rn AS new_qid FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ord) AS rn FROM r WHERE NOT gone))
"""

_GATES = ("coverage", "event_density", "key_span", "shot_desc", "segment_gate", "qa_count", "bilingual", "qa_coverage", "alpha", "miou", "open_agree", "stages", "schema")
def _tokens(c: str) -> str:
    return f"list_transform(regexp_extract_all({c}, '{T.TOKEN.replace("'", "''")}'), lambda x: lower(x))"


def _rouge(pairs: str) -> str:
    """CTEs that give ROUGE-L of the distinct pairs (a, b) of a query as rl (a, b, f1)."""
    return f"""
pr AS (SELECT a, b, {_tokens("a")} AS x, {_tokens("b")} AS y FROM (SELECT DISTINCT a, b FROM ({pairs}))),
lc(a, b, i, r) AS (SELECT a, b, 0, list_transform(range(0, len(y) + 1), lambda k: 0) FROM pr
  UNION ALL SELECT a, b, i, list_transform(range(1, len(c) + 1), lambda j: list_max(c[1:j])) FROM (
    SELECT pr.a, pr.b, i + 1 AS i, list_transform(range(1, len(y) + 2), lambda j: CASE WHEN j > 1 AND y[j - 1] = x[i + 1] THEN r[j - 1] + 1 ELSE r[j] END) AS c FROM lc JOIN pr ON pr.a = lc.a AND pr.b = lc.b WHERE i < len(x))),
rl AS (SELECT pr.a, pr.b, CASE WHEN lc.r[-1] = 0 THEN 0.0 ELSE 2.0 * lc.r[-1] / (len(x) + len(y)) END::DOUBLE AS f1 FROM pr JOIN lc ON lc.a = pr.a AND lc.b = pr.b AND lc.i = len(x))
"""


_ANSWERS = """
gr AS (SELECT video_id, qid, ord, task_type, is_gold, annotator, CASE WHEN video_id % 3 = 0 THEN answer ELSE response END AS response, answer, s, e, rs, re, txt AS reference,
  CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 OR video_id % 3 = 0 THEN txt ELSE txt || ' and other words' END AS text
  FROM (SELECT r.*, x.txt, r.ord + right(annotator, 1)::INT AS k FROM v_responses r JOIN v_spans x USING (video_id, ord))
  WHERE NOT ((video_id % 5 = 2 AND task_type = 'mcq') OR (video_id % 6 = 0 AND task_type = 'temporal_grounding') OR (video_id % 4 = 1 AND task_type IN ('open', 'summary')))),
gc AS (SELECT video_id, qid, response, count(*) AS c, sum(count(*)) OVER (PARTITION BY video_id, qid) AS m FROM gr WHERE task_type = 'mcq' AND NOT is_gold GROUP BY video_id, qid, response),
gu AS (SELECT video_id, grouping(video_id) = 1 AS batch, count(DISTINCT qid) AS n_items, sum(c) AS n, sum(c * (c - 1) / (m - 1)) AS agree FROM gc WHERE m >= 2 GROUP BY GROUPING SETS ((video_id), ())),
gv AS (SELECT video_id, batch, sum(nv * nv) AS squares, count(*) AS kinds FROM (SELECT video_id, grouping(video_id) = 1 AS batch, sum(c) AS nv FROM gc WHERE m >= 2 GROUP BY GROUPING SETS ((video_id, response), (response))) GROUP BY ALL),
al AS (SELECT gu.video_id, gu.batch, n_items, CASE WHEN kinds < 2 THEN NULL WHEN n * n = squares THEN 1.0 ELSE 1 - (n - 1) * (n - agree)::DOUBLE / (n * n - squares) END AS alpha FROM gu JOIN gv ON gu.batch = gv.batch AND gu.video_id IS NOT DISTINCT FROM gv.video_id),
oi AS (SELECT video_id, qid, avg((f1 >= 0.5)::INT) >= 0.6 AS passes FROM gr JOIN rl ON rl.a = text AND rl.b = reference WHERE task_type IN ('open', 'summary') AND text <> '' GROUP BY video_id, qid),
ol AS (SELECT video_id, grouping(video_id) = 1 AS batch, count(*) AS n, round(avg(passes::INT), 3) AS ratio FROM oi GROUP BY GROUPING SETS ((video_id), ())),
ii AS (SELECT video_id, qid, avg(""" + _IOU.format(s1="s", e1="e", s2="rs", e2="re") + """) >= 0.5 AS passes FROM gr WHERE task_type = 'temporal_grounding' GROUP BY video_id, qid),
il AS (SELECT video_id, grouping(video_id) = 1 AS batch, count(*) AS n, round(avg(passes::INT), 3) AS ratio FROM ii GROUP BY GROUPING SETS ((video_id), ()))
"""
_GATE = f"""
{_UNION.format(eps=1.0)},
gp AS (SELECT video_id, count(*) AS n_gaps FROM ({_GAPS.format(test="e - s > 1.0")}) GROUP BY video_id),
ev AS (SELECT video_id, count(*) AS n_events, count(*) FILTER (WHERE importance = 'key' AND NOT (s >= 0 AND s < e AND e <= 720)) AS n_bad_key FROM v_events GROUP BY video_id),
sn AS (SELECT video_id, count(*) AS n_shots, count(*) FILTER (WHERE video_id % 7 = 3 AND ord % 9 = 0) AS n_empty_shots FROM v_shots GROUP BY video_id),
pm AS (SELECT video_id, round(avg((ord % 10 >= 5)::INT), 3) AS pipeline_miou FROM v_qa WHERE task_type = 'temporal_grounding' AND ord % 3 <> 0 GROUP BY video_id),
qn AS (SELECT video_id, count(*) AS n_qa, count(*) FILTER (WHERE task_type = 'temporal_grounding' AND ord % 20 <> 13) AS n_temporal, count(*) FILTER (WHERE ord % 30 <> 0) AS n_bilingual FROM v_qa GROUP BY video_id), {_COVERAGE},
{{rouge}} {_ANSWERS},
fa AS (SELECT v.video_id, v.duration, v.genre, coalesce(n_gaps, 0) AS n_gaps, n_events, n_bad_key, n_shots, n_empty_shots, CASE WHEN v.video_id % 17 <> 4 THEN 12 ELSE 0 END::BIGINT AS n_segments,
  CASE WHEN v.video_id % 17 <> 4 AND v.video_id % 11 = 5 THEN 1 ELSE 0 END::BIGINT AS n_quiet, n_qa, n_temporal, n_bilingual, CASE WHEN v.video_id % 50 = 0 THEN 1 ELSE 0 END::BIGINT AS n_failed,
  ok_layers AND ok_cross AND ok_mcq AND ok_temporal AND ok_buckets AS coverage_ok, CASE WHEN v.video_id % 2 = 0 OR v.video_id % 23 = 7 THEN v.video_id % 23 <> 7 END AS schema_valid,
  pipeline_miou, round(alpha, 6) AS alpha, il.ratio AS miou_ratio, ol.ratio AS open_ratio
  FROM v_videos v LEFT JOIN gp USING (video_id) JOIN ev USING (video_id) JOIN sn USING (video_id) JOIN qn USING (video_id) JOIN cm USING (video_id) LEFT JOIN pm USING (video_id)
  LEFT JOIN al ON al.video_id = v.video_id LEFT JOIN il ON il.video_id = v.video_id LEFT JOIN ol ON ol.video_id = v.video_id),
ft AS (SELECT *, coalesce(miou_ratio, CASE WHEN n_temporal > 0 THEN pipeline_miou END) AS found FROM fa),
g AS (SELECT video_id, n_gaps = 0 AS coverage, n_events / 0.2::DOUBLE >= 45 AS event_density, n_bad_key = 0 AS key_span, n_shots > 0 AND n_empty_shots = 0 AS shot_desc, n_segments > 0 AND n_quiet = 0 AS segment_gate, n_qa >= 8 AS qa_count,
  n_qa > 0 AND n_bilingual >= 0.95 * n_qa AS bilingual, coverage_ok AS qa_coverage, coalesce(alpha >= 0.8, true) AS alpha, CASE WHEN found IS NULL THEN n_temporal = 0 ELSE found >= 0.9 END AS miou,
  coalesce(open_ratio >= 0.6, true) AS open_agree, n_failed = 0 AS stages, coalesce(schema_valid, true) AS schema,
  array_to_string(list_filter([CASE WHEN alpha IS NULL THEN 'alpha' END, CASE WHEN found IS NULL AND n_temporal = 0 THEN 'miou' END, CASE WHEN open_ratio IS NULL THEN 'open_agree' END], lambda x: x IS NOT NULL), ',') AS unevaluated FROM ft),
gd AS (SELECT *, {" AND ".join(_GATES)} AS passes, array_to_string(list_filter([{", ".join(f"CASE WHEN NOT {x} THEN '{x}' END" for x in _GATES)}], lambda x: x IS NOT NULL), ',') AS reasons FROM g)
"""

_GATE = _GATE.replace("{rouge}", _rouge("SELECT DISTINCT txt || t AS a, txt AS b FROM v_spans, (VALUES (''), (' and other words')) x(t)") + ",")

_LETTER = "substr('ABCDE', (({0}) % 5 + 1)::INT, 1)"
_VERIFIED = f"""
vq AS (SELECT video_id, qid, ord, s, e, CASE WHEN ord % 47 = 0 THEN 'essay' ELSE task_type END AS kind, txt, CASE WHEN ord % 10 <> 1 THEN answer ELSE 'D' END AS answer, ord % 9 <> 0 AS has_ref, ord % 8 <> 3 AS frames FROM v_qa),
lk AS (SELECT *, kind = 'mcq' AND ord % 3 = 0 AND ord % 2 = 0 AND substr('ABCD', (ord * 7 % 4 + 1)::INT, 1) = answer AS leaks FROM vq),
tm AS (SELECT *, least(greatest(s + ord % 6 / 2.0::DOUBLE, s - 1), e + 1) AS a, least(greatest(e + ord % 6 / 2.0::DOUBLE, s - 1), e + 1) AS b FROM lk WHERE kind = 'temporal_grounding'),
tv AS (SELECT *, frames AND e > s AND ord % 7 <> 0 AND b > a AS valid, round({_IOU.format(s1="a", e1="b", s2="s", e2="e")}, 3) AS iou FROM tm),
ov AS (SELECT *, has_ref AND ord % 5 <> 0 AND ord % 4 <> 0 AS valid, ord % 10 / 10.0::DOUBLE AS sim FROM lk WHERE kind IN ('open', 'summary')),
st(qid, ord, attempt, question, options, answer, verdict, sure, regen, agreed) AS (
  SELECT qid, ord, 0, txt, 'w,x,y,z', answer, CASE WHEN ord % 11 <> 0 THEN nullif({_LETTER.format("ord // 2")}, 'E') END, ord % 10 / 10.0::DOUBLE, 0, CASE WHEN ord % 11 <> 0 AND {_LETTER.format("ord // 2")} <> 'E' THEN {_LETTER.format("ord // 2")} = answer END
  FROM lk WHERE kind = 'mcq' AND frames AND NOT leaks
  UNION ALL
  SELECT qid, ord, attempt, question, options, answer, coalesce(nxt, verdict), CASE WHEN nxt IS NOT NULL THEN ord % 10 / 10.0::DOUBLE + attempt ELSE sure END, regen, coalesce(nxt = answer, false) FROM (
    SELECT *, CASE WHEN good AND (ord + attempt) % 11 <> 0 THEN nullif({_LETTER.format("ord // 2 + attempt * 3")}, 'E') END AS nxt FROM (
      SELECT qid, ord, attempt + 1 AS attempt, good, CASE WHEN good AND ord % 2 = 0 THEN question || '!' ELSE question END AS question, CASE WHEN good THEN 'n,' || (attempt + 1) ELSE options END AS options,
        CASE WHEN good THEN told ELSE answer END AS answer, verdict, sure, regen + good::INT AS regen FROM (
        SELECT *, {_LETTER.format("ord // 2 + (attempt + 1) * (1 + 2 * (ord % 2))")} AS told, (ord + attempt + 1) % 13 <> 0 AND {_LETTER.format("ord // 2 + (attempt + 1) * (1 + 2 * (ord % 2))")} <> 'E' AS good FROM st WHERE NOT agreed AND attempt < 2)))),
fin AS (SELECT * FROM st WHERE agreed IS NULL OR agreed OR attempt = 2),
vd AS (
  SELECT video_id, kind, qid, 'dropped' AS outcome, NULL::BOOLEAN AS agreed, NULL::VARCHAR AS reason, 'synopsis_leak'::VARCHAR AS flag, NULL::VARCHAR AS verifier, NULL::DOUBLE AS score, NULL::DOUBLE AS confidence, txt AS question, 'w,x,y,z' AS options, answer, 0 AS regen FROM lk WHERE leaks
  UNION ALL SELECT video_id, kind, qid, 'kept', NULL::BOOLEAN, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, NULL::DOUBLE, NULL::DOUBLE, txt, 'w,x,y,z', answer, 0 FROM lk WHERE kind = 'essay'
  UNION ALL SELECT video_id, kind, qid, 'kept', CASE WHEN valid THEN iou >= 0.5 END, CASE WHEN NOT frames THEN 'not verified' WHEN NOT valid THEN 'no valid answer' END, CASE WHEN valid AND iou < 0.5 THEN 'temporal_miou_low' END,
    NULL::VARCHAR, CASE WHEN valid THEN iou END, CASE WHEN valid THEN 0.5 END, txt, 'w,x,y,z', answer, 0 FROM tv
  UNION ALL SELECT video_id, kind, qid, 'kept', CASE WHEN valid THEN sim >= 0.5 END, CASE WHEN NOT valid THEN 'no valid answer' END, CASE WHEN valid AND sim < 0.5 THEN 'open_verify_low_agreement' END, NULL::VARCHAR, CASE WHEN valid THEN sim END, CASE WHEN valid THEN 0.0 END, txt, 'w,x,y,z', answer, 0 FROM ov
  UNION ALL SELECT video_id, kind, qid, 'kept', NULL::BOOLEAN, 'no frames', NULL::VARCHAR, NULL::VARCHAR, NULL::DOUBLE, NULL::DOUBLE, txt, 'w,x,y,z', answer, 0 FROM lk WHERE kind = 'mcq' AND NOT leaks AND NOT frames
  UNION ALL SELECT lk.video_id, kind, qid, CASE WHEN agreed IS NULL OR agreed THEN 'kept' ELSE 'dropped' END, agreed, CASE WHEN agreed IS NULL THEN 'verifier failed' END, CASE WHEN NOT agreed THEN 'verify_mismatch' END,
    CASE WHEN agreed IS NOT NULL THEN verdict END, NULL::DOUBLE, CASE WHEN agreed IS NOT NULL THEN sure END, question, options, fin.answer, regen FROM fin JOIN lk USING (qid))
"""

_DOCUMENTS = """
dv AS (SELECT video_id, CASE WHEN video_id % 11 = 0 THEN 'x_' ELSE 'v_' END || video_id AS doc_id, CASE WHEN video_id % 7 <> 0 THEN genre ELSE 'noise' END AS genre, CASE WHEN video_id % 5 <> 0 THEN video_id ELSE 0 END AS duration FROM v_videos),
ed AS (SELECT video_id, ord, CASE WHEN ord % 29 <> 0 THEN ord ELSE -ord END AS id, CASE WHEN ord % 31 <> 0 THEN importance ELSE 'odd' END AS importance,
  CASE WHEN ord % 6 = 0 THEN NULL WHEN ord % 37 = 0 THEN [ord] ELSE [ord, CASE WHEN ord % 41 = 0 THEN -1 ELSE ord + 1 END] END AS span, row_number() OVER (PARTITION BY video_id ORDER BY ord) - 1 AS i FROM v_events WHERE ord % 8 < 5)
"""
_GENRE_LIST = "[" + ", ".join(f'"{g}"' for g in GENRES) + "]"
_FAULTS = f""",
fe AS (
  SELECT video_id, i, 1 AS inner_, 3 AS depth, 'events/' || i || '/id' AS where_, id || ' is less than the minimum of 0' AS message FROM ed WHERE id < 0
  UNION ALL SELECT video_id, i, 2, 3, 'events/' || i || '/importance', $$'odd' is not one of ["key", "minor"]$$ FROM ed WHERE importance = 'odd'
  UNION ALL SELECT video_id, i, 3, 3, 'events/' || i || '/span', '[' || span[1] || '] is too short' FROM ed WHERE len(span) = 1
  UNION ALL SELECT video_id, i, 3 + j, 4, 'events/' || i || '/span/' || (j - 1), x || ' is less than the minimum of 0' FROM (SELECT video_id, i, unnest(span) AS x, generate_subscripts(span, 1) AS j FROM ed WHERE span IS NOT NULL) WHERE x < 0
  UNION ALL SELECT video_id, i, 9, 2, 'events/' || i, $$'span' is a required property$$ FROM ed WHERE importance = 'key' AND span IS NULL),
faults AS (SELECT doc_id AS video_id, f.* EXCLUDE (video_id) FROM dv JOIN (
  SELECT video_id, 0 AS i, 0 AS inner_, 0 AS nr, 0 AS depth, '<root>' AS where_, $$'meta' is a required property$$ AS message FROM dv WHERE video_id % 13 = 0
  UNION ALL SELECT video_id, 0, 0, 1, 0, '<root>', $$'events' is a required property$$ FROM dv WHERE NOT EXISTS (SELECT 1 FROM ed WHERE ed.video_id = dv.video_id)
  UNION ALL SELECT video_id, 0, 0, 2, 1, 'video_id', $$'$$ || doc_id || $$' does not match '^v_[0-9]{{1,3}}$'$$ FROM dv WHERE NOT regexp_matches(doc_id, '^v_[0-9]{{1,3}}$')
  UNION ALL SELECT video_id, 0, 0, 3, 2, 'meta/genre', $$'noise' is not one of {_GENRE_LIST}$$ FROM dv WHERE video_id % 13 <> 0 AND genre = 'noise'
  UNION ALL SELECT video_id, 0, 0, 4, 2, 'meta/duration', '0 is less than or equal to the minimum of 0' FROM dv WHERE video_id % 13 <> 0 AND duration = 0
  UNION ALL SELECT video_id, 0, 0, 5, 2, 'meta/duration', duration || ' is greater than the maximum of 7200' FROM dv WHERE video_id % 13 <> 0 AND duration > 7200
  UNION ALL SELECT video_id, i, inner_, 6, depth, where_, message FROM fe) f ON f.video_id = dv.video_id)
"""

_HASH = "sha256(concat_ws(chr(31), {0}))"
_STAGE = "sh AS (SELECT o_custkey, sha256(string_agg(" + _HASH.format("o_orderkey::VARCHAR, o_orderstatus") + ", '' ORDER BY o_orderkey)) AS hash FROM orders GROUP BY o_custkey)"

_WORDS = "[" + ", ".join(f"left(repeat('{c}', 20), (6 + ord % {m})::INT)" for c, m in zip("abcd", (3, 5, 7, 4), strict=True)) + "]"

_R = "least(x.e - x.s, o.e - o.s) > 0 AND (least(x.e, o.e) - greatest(x.s, o.s)) / least(x.e - x.s, o.e - o.s) > 0.5"
_FIRST_FIT_FROM = f"""
o AS (SELECT video_id, ord, s, e, txt, row_number() OVER (PARTITION BY video_id ORDER BY s, e, ord) AS rn FROM {{source}}),
w AS (SELECT video_id, rn, ord, 0 AS c, [{{{{'s': s, 'e': e, 'c': 0}}}}] AS cl FROM o WHERE rn = 1
  UNION ALL SELECT video_id, rn, ord, k, list_append(cl, {{{{'s': s, 'e': e, 'c': k}}}}) FROM (SELECT o.*, w.cl,
    coalesce(list_min(list_transform(list_filter(w.cl, lambda x: {_R}), lambda x: x.c)), list_max(list_transform(w.cl, lambda x: x.c)) + 1) AS k FROM w JOIN o ON o.video_id = w.video_id AND o.rn = w.rn + 1))
"""
_FIRST_FIT = _FIRST_FIT_FROM.format(source="v_spans")

SQL: dict[str, str] = {
    "qc_krippendorff_alpha": _alpha("SELECT doc_id AS unit, quality AS value FROM labels UNION ALL SELECT doc_id, 1 - toxic FROM labels"),
    "qc_mcq_alpha_non_gold": _alpha("SELECT qid AS unit, response AS value FROM v_responses WHERE task_type = 'mcq' AND NOT is_gold"),
    "qc_alpha_ordinal": _sql("""
SELECT round(1 - (sum(nv) OVER () - 1) * d_o / d_e, 6) AS alpha FROM t, (SELECT sum(coalesce(o, 0) * d) AS d_o, sum(na * nb * d) AS d_e FROM sc LEFT JOIN ob USING (va, vb)) LIMIT 1
""", """
c AS (SELECT qid AS unit, response AS value, count(*) AS c, sum(count(*)) OVER (PARTITION BY qid) AS m FROM v_responses GROUP BY qid, response),
t AS (SELECT value, sum(c)::DOUBLE AS nv FROM c WHERE m >= 2 GROUP BY value),
sc AS (SELECT a.value AS va, b.value AS vb, a.nv AS na, b.nv AS nb, CASE WHEN a.value = b.value THEN 0 ELSE pow((SELECT sum(nv) FROM t WHERE value BETWEEN least(a.value, b.value) AND greatest(a.value, b.value)) - (a.nv + b.nv) / 2, 2) END AS d FROM t a, t b),
ob AS (SELECT a.value AS va, b.value AS vb, sum(a.c * b.c / (a.m - 1)::DOUBLE) AS o FROM c a JOIN c b ON a.unit = b.unit AND a.value <> b.value WHERE a.m >= 2 GROUP BY a.value, b.value)
"""),
    "qc_cohen_kappa": """
WITH x AS (SELECT quality AS a, 1 - toxic AS b FROM labels), n AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE a = b) AS same FROM x),
pe AS (SELECT sum(ra * rb) AS both_ FROM (SELECT a AS v, count(*) AS ra FROM x GROUP BY a) JOIN (SELECT b AS v, count(*) AS rb FROM x GROUP BY b) USING (v))
SELECT round((same / n - both_ / (n * n)) / (1 - both_ / (n * n)), 6) AS kappa FROM n, pe
""",
    "qc_gold_accuracy": _sql("""
SELECT annotator, count(*) AS total, count(*) FILTER (WHERE response = answer) AS correct, round(count(*) FILTER (WHERE response = answer) / count(*)::DOUBLE, 6) AS accuracy, count(*) FILTER (WHERE response = answer) / count(*)::DOUBLE < 0.9 AS flagged
FROM v_responses WHERE task_type = 'mcq' AND is_gold GROUP BY annotator
"""),
    "qc_rework": _sql("""
SELECT qid, answer, count(*) AS n, round(avg((response = answer)::INT::DOUBLE), 6) AS agreement, string_agg(response, ',' ORDER BY annotator) AS answers FROM v_responses WHERE task_type = 'mcq' GROUP BY qid, answer HAVING avg((response = answer)::INT) < 1
"""),
    "qc_interval_miou": _sql("""
SELECT *, ratio >= 0.9 AS ok FROM (SELECT video_id, count(*) AS n, round(avg(miou), 6) AS mean_iou, round(avg(CASE WHEN miou >= 0.5 THEN 1.0::DOUBLE ELSE 0 END), 3) AS ratio FROM items GROUP BY video_id)
""", _MIOU),
    "qc_open_agreement": f"""
WITH t AS (SELECT *, lead(text) OVER w AS reply, lead(role) OVER w AS by_ FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT conv_id, turn, {_ngrams("text")} AS a, {_ngrams("reply")} AS b FROM t WHERE role = 'user' AND by_ = 'assistant')
SELECT conv_id, turn, round({_JACCARD.format(a="a", b="b")}, 6) AS similarity FROM g
""",
    "qc_release_gate": _sql(f"SELECT video_id, {', '.join(_GATES)}, unevaluated, passes, reasons, CASE WHEN passes THEN 'verified' ELSE 'draft' END AS review_status FROM gd", _GATE),
    "gate_facts": _sql("SELECT * FROM fa", _GATE),
    "mcq_levels": _sql("""
SELECT video_id, batch, coalesce(n_items, 0) AS n_items, round(alpha, 6) AS alpha, coalesce(alpha >= 0.8, false) AS alpha_ok, coalesce(flagged, '') AS flagged, coalesce(rework, 0) AS rework
FROM (SELECT video_id, grouping(video_id) = 1 AS batch FROM gr WHERE task_type = 'mcq' GROUP BY GROUPING SETS ((video_id), ())) r
LEFT JOIN al ON al.batch = r.batch AND al.video_id IS NOT DISTINCT FROM r.video_id
LEFT JOIN (SELECT video_id AS v, batch AS b, string_agg(annotator, ',' ORDER BY annotator) FILTER (WHERE accuracy < 0.9) AS flagged FROM (SELECT video_id, annotator, grouping(video_id) = 1 AS batch, avg((response = answer)::INT) AS accuracy
  FROM gr WHERE task_type = 'mcq' AND is_gold GROUP BY GROUPING SETS ((video_id, annotator), (annotator))) GROUP BY ALL) f ON f.b = r.batch AND f.v IS NOT DISTINCT FROM r.video_id
LEFT JOIN (SELECT video_id AS v, grouping(video_id) = 1 AS b, count(*) AS rework FROM (SELECT video_id, qid FROM gr WHERE task_type = 'mcq' AND NOT is_gold GROUP BY ALL HAVING avg((response = answer)::INT) < 1) GROUP BY GROUPING SETS ((video_id), ())) w
  ON w.b = r.batch AND w.v IS NOT DISTINCT FROM r.video_id
""".replace("video_id, batch, coalesce(n_items", "r.video_id, r.batch, coalesce(n_items", 1), _GATE),
    "open_levels": _sql("SELECT 'open' AS kind, *, ratio >= 0.6 AS ok FROM ol UNION ALL SELECT 'interval', *, ratio >= 0.9 FROM il", _GATE),
    "span_union": _sql("SELECT * FROM u", _UNION.format(eps=1.0)),
    "span_coverage_gaps": _sql(_GAPS.format(test="e - s > 1.0"), _UNION.format(eps=1.0)),
    "nonspeech_gaps": _sql(_GAPS.format(test="e - s >= 0.5"), _UNION.format(eps=0.0)),
    "ocr_span_merge": _sql("""
SELECT video_id, min(t) AS s, max(t) AS e, arg_min(txt, (t, ord)) AS txt, arg_min(v, (t, ord)) AS v, count(*) AS n FROM b GROUP BY video_id, island
""", """
a AS (SELECT *, lag(t) OVER w AS lt, lag(txt) OVER w AS ltxt FROM v_points WINDOW w AS (PARTITION BY video_id ORDER BY t, ord)),
b AS (SELECT *, sum(CASE WHEN lt IS NULL OR ltxt <> txt OR t - lt > 3.0 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY t, ord) AS island FROM a)
"""),
    "caption_merge": _sql("""
SELECT video_id, min(t) AS s, max(t) AS e, left(array_to_string(list_distinct_ordered(list(txt ORDER BY t, ord)), '；'), 120) AS txt FROM c GROUP BY video_id, island HAVING max(t) - min(t) >= 2
""".replace("list_distinct_ordered(list(txt ORDER BY t, ord))", "(SELECT list(x ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(list(txt ORDER BY t, ord)) AS x, generate_subscripts(list(txt ORDER BY t, ord), 1) AS i) GROUP BY x))"), f"""
a AS (SELECT *, lag(t) OVER w AS lt, {_ngrams("txt")} AS g FROM v_points WINDOW w AS (PARTITION BY video_id ORDER BY t, ord)),
b AS (SELECT *, lag(g) OVER (PARTITION BY video_id ORDER BY t, ord) AS lg FROM a),
c AS (SELECT *, sum(CASE WHEN lt IS NULL OR {_JACCARD.format(a="g", b="lg")} < 0.3 OR t - lt > 25 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY t, ord) AS island FROM b)
"""),
    "sliding_windows_join": _sql("""
SELECT video_id, k, k * 30.0::DOUBLE AS ws, least(k * 30.0::DOUBLE + 60, 720.0) AS we, count(*) AS n, sum(ord)::BIGINT AS ords FROM v_points, (SELECT range AS k FROM range(24)) WHERE t >= k * 30.0 AND t <= least(k * 30.0 + 60, 720.0) GROUP BY video_id, k
"""),
    "fixed_windows": _sql("SELECT video_id, k * 180.0::DOUBLE AS s, least((k + 1) * 180.0, duration)::DOUBLE AS e FROM v_videos, range(4) r(k)"),
    "build_windows": _sql("SELECT video_id, round(ws, 3) AS s, round(max(e), 3) AS e FROM w GROUP BY video_id, ws", """
p AS (SELECT video_id, s + i * 180.0::DOUBLE AS s, least(s + (i + 1) * 180.0::DOUBLE, e) AS e, e - s > 180 AS hard FROM (SELECT *, unnest(range(0, greatest(ceil((e - s) / 180)::INT, 1))) AS i FROM v_shots WHERE e > s)),
o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY s, e, hard) AS rn FROM p),
w AS (SELECT video_id, rn, s AS ws, e, hard FROM o WHERE rn = 1
  UNION ALL SELECT o.video_id, o.rn, CASE WHEN NOT w.hard AND NOT o.hard AND o.e - w.ws <= 180 THEN w.ws ELSE o.s END, o.e, o.hard FROM w JOIN o ON o.video_id = w.video_id AND o.rn = w.rn + 1)
"""),
    "shot_groups": _sql("SELECT video_id, gs AS s, max(e) AS e, count(*) AS n FROM w GROUP BY video_id, gs, g", """
o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY s, e) AS rn FROM v_shots),
w AS (SELECT video_id, rn, s AS gs, e, 1 AS g FROM o WHERE rn = 1
  UNION ALL SELECT o.video_id, o.rn, CASE WHEN o.e - w.gs < 15 THEN w.gs ELSE o.s END, o.e, CASE WHEN o.e - w.gs < 15 THEN w.g ELSE w.g + 1 END FROM w JOIN o ON o.video_id = w.video_id AND o.rn = w.rn + 1)
"""),
    "anchor_cap_roundrobin": _sql("""
SELECT video_id, ord, bucket, used FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY turn, bucket) AS place FROM b) WHERE place <= 40
""", """
a AS (SELECT *, ord % 5 = 0 AS used, least(3, floor((s + e) / 2 / greatest(720.0, max(e) OVER (PARTITION BY video_id), 1.0) * 4))::INT AS bucket FROM v_events),
b AS (SELECT *, row_number() OVER (PARTITION BY video_id, bucket ORDER BY used, importance <> 'key', s, ord) AS turn FROM a)
"""),
    "window_subtitle_join": _sql("""
SELECT w.video_id, w.s, w.e, count(*) AS n, string_agg(p.txt, chr(10) ORDER BY p.s, p.ord) AS subtitles FROM (SELECT video_id, k * 180.0::DOUBLE AS s, least((k + 1) * 180.0, 720.0)::DOUBLE AS e FROM v_videos, range(4) r(k)) w JOIN v_spans p ON p.video_id = w.video_id AND p.e >= w.s AND p.s <= w.e GROUP BY w.video_id, w.s, w.e
"""),
    "shot_segment_join": _sql("""
SELECT w.video_id, w.s, p.ord FROM (SELECT video_id, k * 180.0::DOUBLE AS s, least((k + 1) * 180.0, 720.0)::DOUBLE AS e FROM v_videos, range(4) r(k)) w JOIN v_shots p ON p.video_id = w.video_id AND p.s < w.e AND p.e > w.s
"""),
    "asof_frame": _sql("""
SELECT p.video_id, p.ord, p.t, coalesce(f.t, m.t) AS frame FROM v_points p ASOF LEFT JOIN f ON p.video_id = f.video_id AND p.t >= f.t LEFT JOIN (SELECT video_id, min(t) AS t FROM f GROUP BY video_id) m ON m.video_id = p.video_id
""", "f AS (SELECT DISTINCT video_id, t FROM v_points WHERE ord % 3 = 0)"),
    "scene_link": _sql("SELECT video_id, ord, scene_id FROM linked", _LINK),
    "scene_alignment": _sql(f"""
SELECT video_id, ord, scene_id, round(ratio, 6) AS ratio, coalesce(ratio >= 0.5, false) AS aligned FROM (SELECT l.video_id, l.ord, l.scene_id, CASE WHEN c.s IS NULL THEN {_RATIO.format(s1="l.s", e1="l.e", s2="c.s", e2="c.e")} ELSE {_RATIO.format(s1="l.s", e1="l.e", s2="c.s", e2="c.e")} END AS ratio FROM linked l LEFT JOIN v_scenes c ON c.video_id = l.video_id AND c.scene_id = l.scene_id)
""", _LINK),
    "overlap_pairs": _sql(f"""
SELECT * FROM (SELECT p.video_id, p.ord AS a, q.ord AS b, round({_RATIO.format(s1="p.s", e1="p.e", s2="q.s", e2="q.e")}, 6) AS ratio FROM v_spans p JOIN v_spans q ON p.video_id = q.video_id AND p.ord < q.ord WHERE {_RATIO.format(s1="p.s", e1="p.e", s2="q.s", e2="q.e")} > 0.5)
"""),
    "neighbour_alerts": _sql(f"""
SELECT video_id, ord, "next", round(ratio, 6) AS ratio FROM (SELECT video_id, ord, "next", {_RATIO.format(s1="s", e1="e", s2="s2", e2="e2")} AS ratio FROM (SELECT *, lead(ord) OVER w AS "next", lead(s) OVER w AS s2, lead(e) OVER w AS e2 FROM v_spans WINDOW w AS (PARTITION BY video_id ORDER BY s, ord)) WHERE "next" IS NOT NULL) WHERE ratio > 0.8
"""),
    "evidence_subtitles": _sql("""
SELECT q.qid, round((q.s + q.e) / 2, 6) AS mid, string_agg(p.txt, ' ' ORDER BY p.s, p.ord) AS txt FROM v_qa q JOIN v_spans p ON p.video_id = q.video_id AND p.e >= q.s AND p.s <= q.e AND p.ord % 4 = 0 WHERE q.task_type = 'mcq' GROUP BY q.qid, q.s, q.e
"""),
    "responses_semi_anti": _sql("SELECT annotator, CASE WHEN is_gold THEN 'gold' ELSE 'other' END AS part, count(*) AS n FROM v_responses GROUP BY ALL"),
    "alias_match": f"""
WITH {_PERSONS},
n1 AS (SELECT video_id, key, arg_min(name, ord) AS near FROM seen GROUP BY ALL),
hit AS (SELECT t.video_id, t.id, arg_min(coalesce(x.name, n1.near), t.p) AS alias FROM tried t LEFT JOIN (SELECT DISTINCT video_id, name FROM seen) x ON x.video_id = t.video_id AND x.name = t.c
  LEFT JOIN n1 ON n1.video_id = t.video_id AND n1.key = t.key WHERE coalesce(x.name, n1.near) IS NOT NULL GROUP BY ALL)
SELECT persons.video_id, persons.id, hit.alias FROM persons LEFT JOIN hit USING (video_id, id)
UNION ALL SELECT video_id, NULL, name FROM seen WHERE NOT EXISTS (SELECT 1 FROM hit WHERE hit.video_id = seen.video_id AND hit.alias = seen.name)
""",
    "coverage_matrix": _sql("SELECT *, ok_layers AND ok_cross AND ok_mcq AND ok_temporal AND ok_buckets AS ok FROM cm", _COVERAGE),
    "drop_policy": _sql("SELECT qid, dropped FROM dq", _FLAGS),
    "drop_by_channel": _sql("""
SELECT channel, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN blind THEN 'blind' END, CASE WHEN subtitle THEN 'subtitle' END, CASE WHEN single_frame THEN 'single_frame' END], lambda x: x IS NOT NULL)) AS channel FROM dq WHERE dropped) GROUP BY channel
""", _FLAGS),
    "difficulty": _sql("""
SELECT CASE WHEN list_has_any(caps, ['L2_counting','L2_ordering','L3_causal','L3_counterfactual','L3_prediction','L5_needle','L5_foreshadow']) OR n_spans >= 2 OR min_watch = 'whole_video' THEN 'hard'
  WHEN min_watch = 'single_scene' AND NOT blind AND NOT single_frame AND NOT subtitle THEN 'easy' ELSE 'medium' END AS difficulty, count(*) AS n, sum(ord)::BIGINT AS ords FROM q GROUP BY 1
""", _FLAGS),
    "channel_sets": _sql("""
SELECT channel, count(*) AS n FROM (SELECT unnest(CASE WHEN task_type = 'mcq' THEN ['blind','subtitle','single_frame','synopsis','language_prior'] WHEN task_type = 'temporal_grounding' THEN ['subtitle_locate'] ELSE ['blind_similar'] END) AS channel FROM v_qa) GROUP BY channel
"""),
    "rescreen_combine": _sql("""
SELECT qid, new_qid FROM kept
""", _FLAGS + _RESCREEN),
    "rescreen": _sql("""
SELECT r.video_id, r.qid, new_qid, checked_by, array_to_string(one, ',') AS primary_hits, array_to_string(two, ',') AS secondary_hits, array_to_string(hit, ',') AS hits FROM r JOIN kept USING (qid)
UNION ALL SELECT video_id, NULL, NULL, 'auto:' || provider, before::VARCHAR, after::VARCHAR, coalesce(dropped, '') FROM screened LEFT JOIN (
  SELECT video_id, count(*) AS before, count(*) FILTER (WHERE NOT gone) AS after, string_agg(qid, ',' ORDER BY ord) FILTER (WHERE gone) AS dropped FROM r GROUP BY video_id) USING (video_id)
""", _FLAGS + _RESCREEN),
    "question_dedup": """
SELECT min(doc_id) AS doc_id, count(*) AS n_same FROM documents GROUP BY regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', '', 'g')
""",
    "question_faults": _sql(f"""
SELECT qid, CASE WHEN ord % 37 = 0 THEN 'no question' WHEN NOT e > s THEN 'span' WHEN task_type = 'mcq' AND len(o) <> 4 THEN 'options'
  WHEN task_type = 'mcq' AND list_stddev_pop(l) / list_avg(l) >= 0.35 THEN 'option lengths'
  WHEN task_type = 'mcq' AND l[(ord % 4 + 1)::INT] = list_max(l) AND len(list_filter(l, lambda x: x = list_max(l))) = 1 THEN 'longest option'
  WHEN task_type = 'temporal_grounding' AND e - s < 5 THEN 'target' END AS fault
FROM (SELECT *, CASE WHEN ord % 31 = 0 THEN o4[1:3] ELSE o4 END AS o, list_transform(CASE WHEN ord % 31 = 0 THEN o4[1:3] ELSE o4 END, lambda x: length(x)::DOUBLE) AS l FROM (SELECT *, {_WORDS} AS o4 FROM v_qa))
"""),
    "capability_defaults": _sql("SELECT CASE WHEN ord % 5 = 0 THEN 'L3_causal' ELSE capability END AS capability, count(*) AS n FROM v_qa GROUP BY 1"),
    "language_prior_leak": """
SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text) WHERE len(list_filter(string_split_regex(b.text, '[ \\n]'), lambda w: w <> '')) > 0
""",
    "text_lengths": f"""
SELECT doc_id, length(regexp_replace(text, '{_BLANK}', '', 'g'))::INT AS zh_len, len(list_filter(string_split_regex(text, '{_BLANK}+'), lambda w: w <> ''))::INT AS en_len,
  CASE WHEN lang = 'zh' THEN length(regexp_replace(text, '{_BLANK}', '', 'g')) ELSE len(list_filter(string_split_regex(text, '{_BLANK}+'), lambda w: w <> '')) END::INT AS lang_len FROM documents
""",
    "anchor_counts": _sql("""
SELECT ord, len(regexp_extract_all(CASE WHEN ord % 3 = 0 THEN 'none' ELSE format('at {}:{:02d} then {:02d}:{:02d}', floor(t / 60)::INT, floor(t % 60)::INT, floor(v % 24)::INT, floor(v % 60)::INT) END, '\\d{1,2}:\\d{2}'))::INT AS n FROM v_points
"""),
    "referring_context": _sql(
        "SELECT ord, " + " OR ".join(f"regexp_matches(q, '{p}')" for p in (T.ANCHOR, T.ZH_ORDINAL, T.EN_ORDINAL, T.QUOTED))
        + " AS ok FROM (SELECT ord, CASE ord % 4 WHEN 0 THEN 'the second ' || txt WHEN 1 THEN 'he said “' || txt || '”' WHEN 2 THEN 'strengthen ' || txt ELSE '第三次出现' END AS q FROM v_points)"
    ),
    "tokens": f"""
SELECT conv_id, turn, len(w)::INT AS n, md5(array_to_string(w, ' ')) AS digest FROM (SELECT conv_id, turn, list_transform(regexp_extract_all(text || ' 约 12:30 新娘 it''s 3.5', '{T.TOKEN.replace("'", "''")}'), lambda x: lower(x)) AS w FROM conversations)
""",
    "element_gate": f"""
SELECT doc_id, n, concat_ws('; ', CASE WHEN (lang IS DISTINCT FROM 'zh' OR size_ < 400) AND (lang = 'zh' OR words < 350) THEN 'length' END, CASE WHEN anchors < 2 THEN 'anchors' END, CASE WHEN n < 6 THEN 'elements ' || n END) AS reasons FROM (
SELECT doc_id, lang, ({" + ".join(_like("lower(text)", w) + "::BIGINT" for w in T.ELEMENTS.values())})::BIGINT AS n, length(regexp_replace(text, '{_BLANK}', '', 'g')) AS size_,
  len(list_filter(string_split_regex(text, '{_BLANK}+'), lambda w: w <> '')) AS words, len(regexp_extract_all(text, '[0-9]{{1,2}}:[0-9]{{2}}')) AS anchors FROM documents)
""",
    "option_prior": _sql("SELECT ord, ord % 7 <> 0 AND (ord % 5 = 0 OR (ord % 3 = 0 AND length(txt) >= 4)) AS hit FROM v_points"),
    "content_hashes": "SELECT c_custkey, " + _HASH.format("c_name, c_nationkey::VARCHAR, c_mktsegment") + " AS hash FROM customer",
    "json_extract": "SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN props END AS body FROM events",
    "time_buckets": _sql("SELECT video_id, least(3, floor(s / 720 * 4))::INT AS bucket, count(*) AS n FROM v_spans GROUP BY ALL"),
    "duration_buckets": """
SELECT o_orderkey, CASE WHEN x < 300 THEN '<5m' WHEN x < 900 THEN '5-15m' WHEN x < 2400 THEN '15-40m' WHEN x <= 7200 THEN '40m-2h' ELSE '>2h' END AS bucket, greatest(10, ceil(x / 3600 * 24))::INT AS quota,
  CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 50 ELSE greatest(10, ceil(x / 3600 * 24)) END::INT AS wanted FROM (SELECT o_orderkey, o_totalprice / 40 AS x FROM orders)
""",
    "pad_fractions": _sql("SELECT ord, round(0.2::DOUBLE + 0.6::DOUBLE * (('0x' || substr(sha256(ord || '|' || txt), 1, 8))::BIGINT % 1000) / 999.0::DOUBLE, 6) AS frac FROM v_spans"),
    "frame_names": _sql("SELECT ord, 'f_' || lpad((round(t * 1000)::BIGINT // 1000)::VARCHAR, 7, '0') || '_' || lpad((round(t * 1000)::BIGINT % 1000)::VARCHAR, 3, '0') || '.jpg' AS name, round(round(t * 1000) / 1000, 6) AS back FROM v_points"),
    "frame_index_check": _sql("""
SELECT video_id, backward, backward = 0 AND first <= 1.5 AND 720 - last <= 2.5 AS ok FROM (SELECT video_id, count(*) FILTER (WHERE t < lt) AS backward, min(t) AS first, max(t) AS last FROM (SELECT *, lag(t) OVER (PARTITION BY video_id ORDER BY ord) AS lt FROM v_points) GROUP BY video_id)
"""),
    "keyframes": _sql("SELECT ord, round((s + e) / 2, 6) AS mid, round(s + (e - s) * 1 / 4, 6) AS inner1, round(s + (e - s) * 2 / 4, 6) AS inner2, round(s + (e - s) * 3 / 4, 6) AS inner3 FROM v_spans"),
    "every_kth_point": _sql("SELECT video_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY t, ord) AS rn FROM v_points) WHERE (rn - 1) % 4 = 0"),
    "normalise_spans": _sql("""
SELECT ord, round(a, 6) AS s, round(b, 6) AS e, CASE WHEN a >= b OR (importance = 'key' AND b - a < 3) THEN 'minor' ELSE importance END AS importance, a >= b AS todo, importance = 'key' AND b - a < 3 AND NOT a >= b AS narrow
FROM (SELECT ord, importance, CASE WHEN s >= e THEN greatest(0.0, s - 1) ELSE s END AS a, CASE WHEN s >= e THEN least(700.0, s + 1) ELSE e END AS b FROM (SELECT ord, importance, greatest(0.0, least(700.0, s)) AS s, greatest(0.0, least(700.0, CASE ord % 10 WHEN 0 THEN s WHEN 1 THEN s - 5 ELSE e END)) AS e FROM v_events))
"""),
    "causal_validate": _sql("""
SELECT video_id, ord, cause, fault, fault IS NULL AS valid FROM (SELECT x.video_id, x.ord, x.cause, CASE WHEN c.ord IS NULL THEN 'missing' WHEN x.cause = x.ord THEN 'self loop' WHEN c.boundary_state NOT IN ('verified', 'refined') OR x.boundary_state NOT IN ('verified', 'refined') THEN 'unverified' WHEN c.e > x.s + 1e-6 THEN 'order' END AS fault
FROM v_events x LEFT JOIN v_events c ON c.video_id = x.video_id AND c.ord = x.cause WHERE x.cause IS NOT NULL)
"""),
    "character_stats": """
SELECT l_suppkey AS video_id, l_returnflag AS name, min(l_quantity) AS first_seen, round(sum(greatest(0.0, l_quantity + l_discount * 10 - 0.3::DOUBLE - l_quantity)), 4) AS screen_time, count(*) AS appearances FROM lineitem GROUP BY ALL
""",
    "boundary_apply": _sql("""
SELECT video_id, id, round(s, 6) AS s, round(e, 6) AS e, decision AS boundary_state FROM v_verdicts WHERE decision = 'verified'
UNION ALL SELECT video_id, id, round(rs, 6), round(re, 6), 'refined' FROM v_verdicts WHERE decision = 'refined'
UNION ALL SELECT video_id, id || 'a', round(s, 6), round(at_, 6), 'split' FROM v_verdicts WHERE decision = 'split' AND at_ > s AND at_ < e
UNION ALL SELECT video_id, id || 'b', round(at_, 6), round(e, 6), 'split' FROM v_verdicts WHERE decision = 'split' AND at_ > s AND at_ < e
UNION ALL SELECT video_id, id, round(s, 6), round(e, 6), 'unreviewed' FROM v_verdicts WHERE decision = 'odd' OR (decision = 'split' AND NOT (at_ > s AND at_ < e))
""", _VERDICTS),
    "boundary_stats": _sql("""
SELECT video_id, sum(w)::BIGINT AS n, round(sum(w) FILTER (WHERE decision = 'refined' OR w = 2) / sum(w)::DOUBLE, 3) AS refined_ratio, round(coalesce(sum(w) FILTER (WHERE decision = 'rejected'), 0) / sum(w)::DOUBLE, 3) AS rejected_ratio
FROM (SELECT *, CASE WHEN decision = 'split' AND at_ > s AND at_ < e THEN 2 ELSE 1 END AS w FROM v_verdicts) GROUP BY video_id
""", _VERDICTS),
    "event_density": _sql("SELECT video_id, round(count(*) / 0.2::DOUBLE, 1) AS per_hour, count(*) FILTER (WHERE importance = 'key') AS n_key FROM v_events GROUP BY video_id"),
    "importance_batches": _sql("SELECT video_id, ((rn - 1) // 40)::BIGINT AS batch, count(*) AS n, min(ord) AS first FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY s, ord) AS rn FROM v_events) GROUP BY ALL"),
    "candidate_union": _sql("""
SELECT video_id, ord, src, 'e' || row_number() OVER (PARTITION BY video_id ORDER BY s, ord) AS id FROM (SELECT *, CASE WHEN ord % 3 = 0 THEN 'mined' WHEN ord % 3 <> 2 THEN 'window' ELSE 'audio' END AS src FROM v_spans WHERE (ord % 3 <> 2 OR ord % 4 = 0) AND e > s)
"""),
    "rms_envelope": """
SELECT video_id, frame_no, round(sqrt(avg(x * x)), 6) AS rms FROM (SELECT user_id AS video_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS frame_no, value AS x FROM events) GROUP BY ALL HAVING count(*) = 10
""",
    "audio_baseline": _sql("SELECT video_id, round(baseline, 6) AS baseline FROM base", _FRAMES + "," + _BASE),
    "audio_events": _sql("""
SELECT *, CASE WHEN type IN ('music', 'applause') THEN 0.8 ELSE 0.6 END::DOUBLE AS confidence FROM (
SELECT video_id, seg, a, b, round(peak, 6) AS peak, round(r, 6) AS ratio, round(burst, 6) AS burst, CASE WHEN r >= 6 OR mean >= 0.5 THEN 'music' WHEN burst >= 3 AND r >= 2 THEN 'applause' WHEN r >= 2 THEN 'sfx' ELSE 'noise' END AS type
FROM h JOIN bounds USING (video_id, seg) WHERE peak >= 2 * baseline AND (b - a) * 0.5 >= 0.8)
""", _FRAMES + "," + _BASE + "," + _BOUNDS + """,
f AS (SELECT *, row_number() OVER (PARTITION BY video_id, seg ORDER BY frame_no) > greatest(1, count(*) OVER (PARTITION BY video_id, seg) // 2) AS late FROM v_frames),
h AS (SELECT video_id, seg, peak, mean, baseline, mean / baseline AS r, second / CASE WHEN first = 0 THEN 1e-6 ELSE first END AS burst FROM (SELECT video_id, seg, max(rms) AS peak, avg(rms) AS mean, avg(rms) FILTER (WHERE late) AS second, avg(rms) FILTER (WHERE NOT late) AS first FROM f GROUP BY video_id, seg) JOIN base USING (video_id))
"""),
    "audio_active_bounds": _sql("SELECT * FROM bounds", _FRAMES + "," + _BASE + "," + _BOUNDS),
    "stage_hashes": f"WITH {_STAGE} SELECT * FROM sh",
    "stage_needs_run": "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 4 <> 3",
    "stage_downstream": _sql("SELECT video_id, dst AS stage FROM v_videos JOIN closure ON src = 'S' || (video_id % 7 + 1)", """
edges(src, dst) AS (VALUES ('S1','S2'),('S1','S3'),('S2','S3'),('S1','S4'),('S3','S4'),('S1','S5'),('S3','S5'),('S4','S5'),('S5','S6'),('S5','S7'),('S6','S7')),
closure(src, dst) AS (SELECT src, dst FROM edges UNION SELECT c.src, x.dst FROM closure c JOIN edges x ON x.src = c.dst)
"""),
    "manifest_latest": "SELECT user_id AS video_id, event_type AS stage, max(event_id) AS updated, round(arg_max(value, event_id), 6) AS v FROM events GROUP BY ALL",
    "cache_misses": "SELECT key_hash, count(*) AS n FROM (SELECT p_partkey, md5(p_brand || p_type) AS key_hash FROM part) WHERE key_hash NOT IN (SELECT md5(p_brand || p_type) FROM part WHERE p_partkey % 50 = 0) GROUP BY key_hash",
    "provider_recorded": """
WITH t AS (SELECT p_name, min('answer ' || p_partkey) AS response FROM part WHERE p_partkey % 3 <> 0 GROUP BY p_name) SELECT p_partkey, response, response IS NOT NULL AS ok FROM part LEFT JOIN t USING (p_name)
""",
    "usage_merge": "SELECT event_type AS client, 'prompt' AS kind, sum(event_id % 100)::BIGINT AS n FROM events GROUP BY 1 UNION ALL SELECT event_type, 'completion', sum(event_id % 10)::BIGINT FROM events GROUP BY 1",
    "schema_violations": """
SELECT * FROM (SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT o_orderstatus IN ('O', 'F') THEN 'status' END, CASE WHEN NOT o_totalprice > 1000 THEN 'price' END, CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-3]') THEN 'priority' END], lambda x: x IS NOT NULL), ',') AS violations FROM orders) WHERE violations <> ''
""",
    "todo_union": _sql("""
SELECT CASE WHEN boundary_state = 'unreviewed' THEN 'boundary' ELSE 'key' END AS kind, ord, video_id, CASE WHEN boundary_state = 'unreviewed' THEN 0 ELSE 1 END::INT AS source FROM v_events WHERE boundary_state = 'unreviewed' OR (importance = 'key' AND ord % 2 = 0)
"""),
    "assemble_tracks": _sql("SELECT video_id, count(*)::INT AS n, (count(*) FILTER (WHERE ord % 997 = 0))::INT AS n_few, arg_min(s, ord) AS first FROM v_spans GROUP BY video_id"),
    "event_mining": _sql("""
SELECT d.video_id, d.k, d.s, d.e, CASE WHEN (d.video_id + d.k) % 3 = 0 THEN 'answer' ELSE d.txt END AS txt, CASE WHEN (d.video_id + d.k) % 3 = 0 THEN 'model' ELSE d.origin END AS origin FROM drafts d
""", f"""
cap AS (SELECT *, {_ngrams("txt")} AS g FROM v_points WHERE floor(t / 90) % 4 <> 1),
seen AS (SELECT c.*, k FROM cap c, (SELECT range AS k FROM range(24)) WHERE t >= k * 30.0 AND t <= least(k * 30.0 + 60, 720.0)),
mk AS (SELECT *, lag(t) OVER w AS lt, lag(g) OVER w AS lg FROM seen WINDOW w AS (PARTITION BY video_id, k ORDER BY t, ord)),
rn AS (SELECT *, sum(CASE WHEN lt IS NULL OR {_JACCARD.format(a="g", b="lg")} < 0.3 OR t - lt > 25 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id, k ORDER BY t, ord) AS island FROM mk),
di AS (SELECT video_id, k, island, txt, min((t, ord)) AS o FROM rn GROUP BY ALL),
tx AS (SELECT video_id, k, island, left(string_agg(txt, '；' ORDER BY o), 120) AS txt FROM di GROUP BY ALL),
drafts AS (SELECT video_id, k, s, e, txt, 'caption' AS origin FROM (SELECT video_id, k, island, min(t) AS s, max(t) AS e FROM rn GROUP BY ALL HAVING max(t) - min(t) >= 2) JOIN tx USING (video_id, k, island)
  UNION ALL SELECT p.video_id, w.k, p.s, p.e, p.txt, 'subtitle' FROM v_spans p, (SELECT range AS k FROM range(24)) w WHERE p.s >= w.k * 30.0 AND p.s <= least(w.k * 30.0 + 60, 720.0) AND p.e - p.s >= 0.5 AND NOT EXISTS (SELECT 1 FROM seen x WHERE x.video_id = p.video_id AND x.k = w.k))
"""),
    "group_dedup": _sql("""
SELECT e.video_id, CASE WHEN t.src IS NOT NULL THEN e.id || '_m1' ELSE e.id END AS id, CASE WHEN t.src IS NOT NULL THEN e.id END AS dedup_id, t.src AS sources
FROM ev e LEFT JOIN (SELECT video_id, 'e' || lo AS id, 'e' || hi AS src FROM gr WHERE lo % 4 <> 0) t USING (video_id, id) WHERE NOT EXISTS (SELECT 1 FROM gr WHERE gr.video_id = e.video_id AND lo % 4 <> 0 AND e.id = 'e' || hi)
""", """
ev AS (SELECT video_id, floor(s / 10) AS cluster, 'e' || ord AS id, ord FROM v_spans),
gr AS (SELECT video_id, cluster, min(ord) AS lo, max(ord) AS hi FROM ev GROUP BY video_id, cluster HAVING count(*) >= 3)
"""),
    "importance_grading": _sql("SELECT video_id, ord::VARCHAR AS id, CASE WHEN ord % 4 <> 0 AND ord % 3 = 0 THEN 'key' ELSE 'minor' END AS importance FROM v_events"),
    "timeline_order": _sql("""
SELECT video_id, video_id % 3 = 1 OR (video_id % 3 = 2 AND count(*) <= 2) AS answered, md5(CASE WHEN video_id % 3 = 1 OR (video_id % 3 = 2 AND count(*) <= 2) THEN string_agg(ord::VARCHAR, ',' ORDER BY ord::VARCHAR DESC) ELSE string_agg(ord::VARCHAR, ',' ORDER BY s, ord::VARCHAR) END) AS digest FROM v_spans GROUP BY video_id
"""),
    "schema_documents": _sql("""
SELECT video_id, first_value(where_ || ': ' || message) OVER (PARTITION BY video_id ORDER BY depth, nr, i, inner_) AS schema_error, depth::INT AS depth, where_ AS path, message FROM faults
""", _DOCUMENTS + _FAULTS),
    "public_documents": _sql("""
SELECT doc_id AS video_id, 'video_id,meta,events' AS fields, CASE WHEN video_id % 13 <> 0 THEN '{"genre":"' || genre || '","duration":' || duration || '}' END AS meta,
  (SELECT '[' || string_agg('{"id":' || id || ',"importance":"' || importance || '"' || CASE WHEN span IS NULL THEN '' ELSE ',"span":[' || array_to_string(span, ',') || ']' END || ',"inner":{"n":' || ord || '}}', ',' ORDER BY ord) || ']' FROM ed WHERE ed.video_id = dv.video_id) AS events FROM dv
""", _DOCUMENTS),
    "described_documents": _sql("""
SELECT video_id, video_id AS extra, video_id AS shots, 'kept' AS other, CASE WHEN m THEN 's' || video_id END AS segments, CASE WHEN m THEN 'whole ' || video_id END AS detailed, CASE WHEN m THEN 'draft' WHEN h THEN 'verified' END AS status,
  concat_ws(',', CASE WHEN h THEN 'gap:' || video_id END, CASE WHEN m AND video_id % 4 = 0 THEN 'lang_issue,lang_issue' END) AS todo, CASE WHEN h THEN video_id END AS calls, CASE WHEN m THEN (video_id % 7) || '/7' END AS shot_desc_ok, CASE WHEN m THEN 'q1' END AS quiet, CASE WHEN m THEN video_id END AS full_len_zh
FROM (SELECT *, video_id % 3 <> 0 AS m, video_id % 5 <> 0 AS h FROM v_videos)
"""),
    "verification_loop": _sql("SELECT qid, outcome, coalesce(agreed::VARCHAR, '-') AS agreed, coalesce(reason, '-') AS reason, coalesce(flag, '-') AS flag, verifier, score, confidence, question, options, answer, regen FROM vd", _VERIFIED),
    "verification_counts": _sql("""
SELECT video_id, count(*) AS n, count(*) FILTER (WHERE outcome = 'kept') AS kept, count(*) FILTER (WHERE kind = 'mcq' AND agreed IS NOT NULL) AS verified, count(*) FILTER (WHERE kind = 'mcq' AND agreed) AS agreed, sum(regen)::BIGINT AS regen,
  count(*) FILTER (WHERE flag = 'synopsis_leak') AS leaks, count(*) FILTER (WHERE flag = 'verify_mismatch') AS mismatch, count(*) FILTER (WHERE kind = 'temporal_grounding' AND agreed IS NOT NULL) AS temporal_verified,
  count(*) FILTER (WHERE kind = 'temporal_grounding' AND agreed) AS temporal_pass, count(*) FILTER (WHERE kind IN ('open', 'summary') AND agreed IS NOT NULL) AS open_verified, count(*) FILTER (WHERE kind IN ('open', 'summary') AND agreed) AS open_pass
FROM vd GROUP BY video_id
""", _VERIFIED),
    "verification_kpis": _sql("""
SELECT video_id, count(*) FILTER (WHERE ord % 3 <> 0) AS verified, sum(ord % 2)::BIGINT AS regen, count(*) FILTER (WHERE ord % 15 = 1) AS dropped,
  count(*) FILTER (WHERE ord % 15 = 1 AND ord % 2 = 1) AS synopsis_leak_dropped, count(*) FILTER (WHERE ord % 15 = 1 AND ord % 2 = 0) AS verify_mismatch_dropped, """ + ", ".join(
        f"round(count(*) FILTER (WHERE {k} AND ord % 3 <> 0 AND ord % 5 <> 0)::DOUBLE / nullif(count(*) FILTER (WHERE {k} AND ord % 3 <> 0), 0), 3) AS {n}"
        for k, n in (("task_type = 'mcq'", "verify_agreement"), ("task_type = 'temporal_grounding'", "temporal_miou_ratio"), ("task_type IN ('open', 'summary')", "open_agreement"))
    ) + " FROM v_qa GROUP BY video_id"),
    "pipeline_temporal_ratio": _sql("SELECT video_id, round(avg((ord % 10 >= 5)::INT::DOUBLE) FILTER (WHERE ord % 3 <> 0), 3) AS ratio FROM v_qa WHERE task_type = 'temporal_grounding' GROUP BY video_id"),
    "rescreen_summary": _sql("SELECT count(*) AS before, count(*) FILTER (WHERE NOT dropped) AS after, count(*) FILTER (WHERE dropped) AS dropped FROM dq", _FLAGS),
    "evidence_frame_times": _sql("SELECT ord, 4::INT AS n, round(round(s + (e - s) / 5, 3), 6) AS first FROM v_spans"),
    "mosaic_sizes": _sql("""
SELECT video_id, w, pow(floor(sqrt(least(n, 64))), 2)::INT AS n, f[pow(floor(sqrt(least(n, 64))), 2)::INT] AS last FROM (SELECT video_id, floor(t / 40)::BIGINT AS w, list(ord ORDER BY ord) AS f, count(*) AS n FROM v_points GROUP BY ALL) WHERE n >= 4
"""),
    "language_alignment": _sql("""
SELECT ord, array_to_string(list_filter([CASE WHEN ord % 5 = 0 OR ord % 9 = 0 THEN 'zh missing' END, CASE WHEN ord % 7 = 0 THEN 'en missing' END, CASE WHEN ord % 5 <> 0 AND ord % 9 <> 0 AND ord % 7 <> 0 AND NOT (ord % 9) / 2.0 BETWEEN 0.4 AND 2.5 THEN 'length ratio' END], lambda x: x IS NOT NULL), ',') AS issues FROM v_points
"""),
    "description_rollup": _sql("""
SELECT video_id, sum(n)::BIGINT AS n, count(*) AS n_groups, md5(string_agg(txt, chr(10) ORDER BY g)) AS digest FROM (SELECT video_id, g, string_agg(txt, ' ' ORDER BY s, ord) AS txt, count(*) AS n FROM (SELECT *, (row_number() OVER (PARTITION BY video_id ORDER BY s, ord) - 1) // 15 AS g FROM v_spans) GROUP BY video_id, g) GROUP BY video_id
"""),
    "subtitle_rendering": _sql("SELECT ord, '[' || floor(s)::BIGINT || 's] ' || CASE WHEN ord % 3 = 0 THEN '(S' || ord % 4 || ') ' ELSE '' END || txt AS line FROM v_spans"),
    "provider_differs": "SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0",
    "duration_guard": "SELECT o_orderkey AS video_id FROM orders WHERE o_orderkey % 11 - 3 > 5",
    "video_file_lookup": """
SELECT stem, arg_min(path, (r, path)) AS path FROM (SELECT DISTINCT '/v/' || p_partkey % 97 || (['.mkv', '.mp4', '.txt', '.webm'])[(p_partkey % 4 + 1)::INT] AS path, (p_partkey % 97)::VARCHAR AS stem, ([2, 1, 0, 3])[(p_partkey % 4 + 1)::INT] AS r FROM part) WHERE r > 0 GROUP BY stem
""",
    "qa_deficits": _sql("SELECT video_id, " + ", ".join(f"greatest(0, 2 - L{i})::BIGINT AS L{i}" for i in range(1, 6)) + ", greatest(0, 75 - mcq)::BIGINT AS mcq, greatest(0, 22 - temporal_grounding)::BIGINT AS temporal_grounding FROM cm", _COVERAGE),
    "stage_reuse": """
SELECT video_id FROM (SELECT user_id AS video_id, event_type AS stage, max(event_id) AS i FROM events GROUP BY ALL) WHERE i % 3 = 1 AND video_id % 2 = 0 GROUP BY video_id HAVING count(DISTINCT stage) = 5
""",
    "question_round": _sql("""
SELECT video_id, ord, key, video_id || '_q' || CASE WHEN place < 10 THEN '0' ELSE '' END || place AS qid FROM (SELECT f.*, row_number() OVER (PARTITION BY video_id ORDER BY ord) + coalesce(have, 0) AS place FROM f LEFT JOIN (SELECT video_id, count(*) AS have FROM known GROUP BY video_id) USING (video_id)) WHERE place <= 60
""", """
qk AS (SELECT video_id, ord, txt || ord % 20 AS key FROM v_spans),
known AS (SELECT DISTINCT video_id, key FROM qk WHERE ord % 3 = 0),
f AS (SELECT video_id, key, min(ord) AS ord FROM qk WHERE ord % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM known n WHERE n.video_id = qk.video_id AND n.key = qk.key) GROUP BY video_id, key)
"""),
    "shortcut_channels": _sql("""
SELECT qid, """ + ", ".join(f"coalesce((bool_or(hit) FILTER (WHERE channel = '{c}'))::VARCHAR, '') AS {c}" for c in ("blind", "subtitle", "single_frame", "synopsis", "language_prior", "subtitle_locate", "blind_similar")) + f""" FROM (
SELECT qid, channel, CASE WHEN ord % 10 = 0 THEN NULL WHEN task_type = 'mcq' THEN (ord * place) % 4 = ord % 4 WHEN task_type = 'temporal_grounding' THEN {_IOU.format(s1="s", e1="e", s2="(s + x)", e2="(e + x)")} >= 0.6 ELSE x >= 0.85 END AS hit
FROM (SELECT *, (ord % 8) / 8.0::DOUBLE AS x, list_position(['blind','subtitle','single_frame','synopsis','language_prior','subtitle_locate','blind_similar'], channel) AS place
  FROM (SELECT *, unnest(CASE WHEN task_type = 'mcq' THEN ['blind','subtitle','single_frame','synopsis','language_prior'] WHEN task_type = 'temporal_grounding' THEN ['subtitle_locate'] ELSE ['blind_similar'] END) AS channel FROM v_qa))) GROUP BY qid
"""),
    "call_trace": "SELECT role AS model, sha256(text) AS input_hash, (turn % 4)::INT AS images, turn % 3 AS retries, turn % 5 <> 0 AS ok, left(text, 200) AS out_summary FROM conversations",
    "first_fit_clusters": _sql("SELECT video_id, ord, c::BIGINT AS cluster FROM w", _FIRST_FIT),
    "ocr_confidence_filter": _sql("SELECT ord FROM v_points WHERE ord % 11 >= 8 AND ord % 7 <> 0"),
    "modality_whitelist": _sql("SELECT ord, CASE ord % 4 WHEN 1 THEN 'audio' WHEN 2 THEN 'speech,visual' ELSE 'visual' END AS modality FROM v_points"),
    "language_coalesce": _sql("SELECT ord, CASE WHEN ord % 3 = 1 THEN '字' ELSE txt END AS text, CASE WHEN ord % 3 = 1 THEN '字' ELSE 'long' END AS description FROM v_points"),
    "event_briefs": _sql("SELECT video_id, '{\"ord\":' || ord || ',\"importance\":\"' || importance || '\",\"boundary_state\":\"' || boundary_state || '\"}' AS brief FROM v_events"),
    "window_limit": _sql("SELECT video_id, k * 180.0::DOUBLE AS s, (k + 1) * 180.0::DOUBLE AS e FROM v_videos, range(3) r(k)"),
    "coverage_report": _sql("SELECT *, 'uncovered' AS reason FROM (" + _GAPS.format(test="e - s > 1.0") + ") UNION ALL SELECT video_id, round(s, 6), round(e, 6), 'failed' FROM v_spans WHERE ord % 6 = 0", _UNION.format(eps=1.0).replace("WHERE e > s", "WHERE e > s AND ord % 6 <> 0")),
    "anchor_pool": _sql("""
SELECT video_id, id, row_number() OVER (PARTITION BY video_id ORDER BY s, coalesce(importance <> 'key', true), id) AS place FROM (SELECT video_id, 'e' || ord AS id, s, importance FROM v_events WHERE ord % 2 = 0 UNION ALL SELECT video_id, 's' || ord, s, NULL FROM v_events WHERE ord % 3 = 0 UNION ALL SELECT video_id, 'a' || ord, s, NULL FROM v_events WHERE ord % 5 = 0)
"""),
    "span_in_view": _sql("SELECT ord, round(a, 6) AS s, round(b, 6) AS e FROM (SELECT ord, greatest(s, floor(s / 60) * 60 + 5) AS a, least(e, floor(s / 60) * 60 + 55) AS b FROM v_spans) WHERE b - a >= 2"),
    "options_rendering": _sql("SELECT ord, 'A. ' || txt || chr(10) || 'B. cat' || chr(10) || 'C. dog' AS text FROM v_points"),
}

# --- longest common subsequences, by rows of the table


_TODOS = f"""
noted AS (SELECT video_id, CASE WHEN ord % 4 = 3 THEN 'key_event_unreviewed' ELSE 'event_span_invalid' END AS kind, ord::VARCHAR AS event_id, s, e, 'noted' AS reason FROM v_events WHERE ord % 6 = 3),
told AS (SELECT *, 0 AS rank FROM noted
  UNION ALL SELECT video_id, 'key_event_unreviewed', ord::VARCHAR, s, e, NULL, 1 FROM v_events WHERE importance = 'key' AND boundary_state = 'unreviewed'
  UNION ALL SELECT video_id, 'boundary_' || boundary_state, ord::VARCHAR, s, e, NULL, 2 FROM v_events WHERE boundary_state IN ('split', 'rejected_final')
  UNION ALL SELECT video_id, 'uncovered_gap', NULL, round(s, 3), round(e, 3), 'uncovered', 3 FROM ({_GAPS.format(test="e - s > 1.0")})),
todo AS (SELECT video_id, kind, event_id, s, e, arg_min(coalesce(reason, ''), rank) AS reason FROM told GROUP BY ALL)
"""

_ASKED = f"""
aq AS (SELECT video_id, ord, qid, CASE WHEN ord % 41 = 0 THEN 'essay' ELSE task_type END AS kind, CASE WHEN ord % 37 = 0 THEN '' ELSE txt END AS question,
  CASE WHEN ord % 17 = 0 THEN [[e, s]] WHEN ord % 17 = 1 THEN [] WHEN ord % 17 = 2 THEN [[s, s + 100000]] WHEN ord % 9 = 0 THEN [[s, e], [s / 2, s / 2 + 4]] ELSE [[s, e]] END::DOUBLE[][] AS ev,
  CASE WHEN ord % 8 = 5 THEN [] WHEN ord % 8 = 4 THEN [s, s + 40] WHEN ord % 16 = 6 THEN [s - 0.5, s + 5.5] ELSE [s, e] END::DOUBLE[] AS target, CASE WHEN ord % 3 = 1 THEN ord - 1 ELSE ord END AS anchor_id,
  CASE WHEN ord % 31 = 0 THEN ({_WORDS})[1:3] WHEN ord % 43 = 0 THEN ['  ', '  ', '  ', '  '] ELSE {_WORDS} END AS options, CASE WHEN ord % 29 = 0 THEN 'E' ELSE answer END AS answer,
  CASE ord % 4 WHEN 0 THEN repeat('字', 80) || ' 00:10 00:20' WHEN 2 THEN '短' WHEN 3 THEN repeat('字', 90) ELSE '' END AS zh, CASE ord % 4 WHEN 1 THEN repeat('word ', 220) || '"quoted"' ELSE '' END AS en FROM v_qa),
av AS (SELECT video_id, ord AS anchor_id, s - 3 AS s, CASE WHEN ord % 30 = 0 THEN s - 3 ELSE e + 3 END AS e FROM v_events WHERE ord % 3 <> 1),
pools AS (SELECT video_id, list([s, e]) FILTER (WHERE e > s) AS pool FROM av GROUP BY video_id),
met AS (SELECT aq.*, pools.video_id IS NOT NULL AS pooled, coalesce(pool, []::DOUBLE[][]) AS pool, av.anchor_id IS NOT NULL AS known, av.s AS s, av.e AS e,
  list_transform(options, lambda o: greatest(length(regexp_replace(o, '{_BLANK}', '', 'g')), len(list_filter(string_split_regex(o, '{_BLANK}+'), lambda w: w <> '')))) AS size_,
  target[2] > target[1] AS aimed FROM aq LEFT JOIN pools USING (video_id) LEFT JOIN av USING (video_id, anchor_id)),
ruled AS (SELECT *, list_position(['A', 'B', 'C', 'D'], answer) AS at_, list_filter(list_transform(ev, lambda p: CASE WHEN NOT p[2] > p[1] THEN 'evidence' WHEN p[1] < 0 OR p[2] > 721 THEN 'evidence outside'
  WHEN len(pool) > 0 AND len(list_filter(pool, lambda a: p[1] >= a[1] - 1 AND p[2] <= a[2] + 1)) = 0 THEN 'evidence off anchors' END), lambda x: x IS NOT NULL)[1] AS off,
  len(list_filter(ev, lambda p: least(p[2], e) > greatest(p[1], s))) > 0 AS touches FROM met)
"""

SQL |= {
    "text_rouge_l": "WITH RECURSIVE "
    + _rouge("SELECT x.text AS a, y.text AS b FROM benchmark x JOIN benchmark y ON y.item_id = x.item_id + 1")
    + "SELECT x.item_id, round(f1, 6) AS rouge_l FROM benchmark x JOIN benchmark y ON y.item_id = x.item_id + 1 JOIN rl ON rl.a = x.text AND rl.b = y.text",
    "open_item_agreement": _sql(f"""
SELECT qid, round(avg(l), 3) AS agreement, count(*) AS n_raters, avg(l) >= 0.6 AS passes FROM (
  SELECT qid, (greatest(f1, {_JACCARD.format(a="g", b="h")}) >= 0.5)::INT::DOUBLE AS l FROM (SELECT qid, text, txt, {_ngrams("text")} AS g, {_ngrams("txt")} AS h FROM ops WHERE text <> '') JOIN rl ON rl.a = text AND rl.b = txt) GROUP BY qid
""", "ops AS (SELECT qid, txt, CASE (ord + r) % 4 WHEN 0 THEN '' WHEN 1 THEN txt ELSE txt || ' and other words' END AS text FROM v_qa, range(3) x(r) WHERE task_type IN ('open', 'summary'))," + _rouge("SELECT text AS a, txt AS b FROM ops")),
    "text_similarity": _sql(f"""
SELECT ord, round(CASE WHEN coalesce(b, '') = '' THEN 0.0 WHEN ord % 3 <> 0 AND ord % 2 = 0 THEN CASE WHEN vv * ww > 0 THEN vw / (sqrt(vv) * sqrt(ww)) ELSE 0 END ELSE {_JACCARD.format(a="g", b="h")} END, 6) AS similarity
FROM (SELECT *, x * x + y * y + z * z AS vv, p * p + q * q + r * r AS ww, x * p + y * q + z * r AS vw, {_ngrams("txt")} AS g, {_ngrams("coalesce(b, '')")} AS h FROM (
  SELECT ord, txt, CASE ord % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE txt || ' again' END AS b, (ord % 5)::DOUBLE AS x, (ord % 7)::DOUBLE AS y, (ord % 11)::DOUBLE AS z,
  (ord * 3 % 5)::DOUBLE AS p, (ord * 3 % 7)::DOUBLE AS q, (ord * 3 % 11)::DOUBLE AS r FROM v_points))
"""),
    "pair_dedup": _sql(f"""
SELECT video_id, CASE WHEN first THEN x[1].ord ELSE x[2].ord END AS kept, CASE WHEN first THEN x[2].ord ELSE x[1].ord END AS merged FROM (SELECT video_id, x, length(x[1].t) >= length(x[2].t) AS first FROM (
  SELECT video_id, c, list({{'ord': ord, 't': t, 'g': g}} ORDER BY s, e, ord) AS x FROM (SELECT *, {_ngrams("t")} AS g FROM (SELECT w.video_id, w.c, o.ord, o.s, o.e, repeat(o.txt || ' at the gate ', 3) || repeat('!', (o.ord % 9)::INT) AS t FROM w JOIN o USING (video_id, ord))) GROUP BY video_id, c HAVING count(*) = 2)
  WHERE {_JACCARD.format(a="x[1].g", b="x[2].g")} >= 0.85)
""", _FIRST_FIT),
    "human_todo": _sql("SELECT video_id, kind, event_id, s, e, nullif(reason, '') AS reason FROM todo", _UNION.format(eps=1.0) + "," + _TODOS),
    "qc_batch_verdict": _sql("SELECT count(*) AS n, count(*) FILTER (WHERE passes) AS passed, bool_and(passes) AS all_pass, (SELECT count(*) FROM todo) AS human_todo_total FROM gd", _GATE + "," + _TODOS),
    "release_report": _sql("SELECT count(*) AS n, (SELECT count(*) FROM todo) AS todos, 0.8::DOUBLE AS alpha, count(*) FILTER (WHERE NOT passes) AS failed FROM gd", _GATE + "," + _TODOS),
    "mcq_stats": "WITH al AS (" + SQL["qc_mcq_alpha_non_gold"] + """),
g AS (SELECT * FROM (""" + SQL["qc_gold_accuracy"] + """)), r AS (SELECT * FROM (""" + _REWORK_NON_GOLD + """))
SELECT alpha, (SELECT sum(flagged::INT) FROM g)::BIGINT AS flagged, (SELECT count(*) FROM r) AS rework FROM al
""",
    "answer_keys": _sql("SELECT qid, answer, is_gold AS gold FROM v_qa WHERE task_type = 'mcq' AND ord % 10 <> 1"),
    "window_ocr_join": _sql("""
SELECT w.video_id, w.s, w.e, count(*) AS n, string_agg(p.txt, ' | ' ORDER BY p.t, p.ord) AS ocr FROM (SELECT video_id, k * 180.0::DOUBLE AS s, least((k + 1) * 180.0, 720.0)::DOUBLE AS e FROM v_videos, range(4) r(k)) w
JOIN v_points p ON p.video_id = w.video_id AND p.t >= w.s AND p.t <= w.e AND p.ord % 4 = 1 GROUP BY w.video_id, w.s, w.e
"""),
    "question_keys": _sql("""
SELECT video_id, min(ord) AS ord, key, count(*) AS n_same FROM (SELECT video_id, ord, CASE WHEN ord % 5 = 0 THEN '第三次' ELSE regexp_replace(lower(txt || ' -- who_is it?'), '[^\\p{L}\\p{N}]+', '', 'g') END || '|' || CASE WHEN ord % 3 <> 0 THEN substr('ABCD', (ord % 4 + 1)::INT, 1) ELSE '' END AS key FROM v_points) GROUP BY video_id, key
"""),
    "question_validation": _sql("""
SELECT qid, CASE WHEN question = '' OR len(ev) = 0 THEN 'no question or evidence' WHEN kind = 'essay' THEN 'task type' WHEN off IS NOT NULL THEN off WHEN known AND NOT e > s THEN 'anchor' WHEN pooled AND NOT known THEN 'unknown anchor'
  WHEN known AND NOT touches THEN 'evidence off own anchor' WHEN kind = 'temporal_grounding' AND aimed IS NOT TRUE THEN 'target' WHEN kind = 'temporal_grounding' AND (target[1] < 0 OR target[2] > 721) THEN 'target outside'
  WHEN kind = 'temporal_grounding' AND known AND NOT (target[1] >= s - 1 AND target[2] <= e + 1) THEN 'target off anchor' WHEN kind = 'mcq' AND (len(options) <> 4 OR coalesce(at_, 0) = 0) THEN 'options or answer'
  WHEN kind = 'mcq' AND list_max(size_) <= 0 THEN 'empty options' WHEN kind = 'mcq' AND list_stddev_pop(size_) / list_avg(size_) >= 0.35 THEN 'option lengths'
  WHEN kind = 'mcq' AND size_[at_] = list_max(size_) AND len(list_filter(size_, lambda x: x = size_[at_])) = 1 THEN 'longest option' WHEN kind = 'temporal_grounding' AND target[2] - target[1] < 5 THEN 'target width'
  WHEN kind IN ('open', 'summary') AND length(regexp_replace(zh, '\\s', '', 'g')) < 80 AND len(list_filter(string_split(en, ' '), lambda w: w <> '')) < 220 THEN 'short reference'
  WHEN kind IN ('open', 'summary') AND len(regexp_extract_all(zh || en, '\\d{1,2}:\\d{2}')) < 2 AND NOT contains(zh || en, '"') THEN 'no details' END AS fault FROM ruled
""", _ASKED),
    "referring_check": _sql("""
SELECT ord, CASE WHEN length(zh) < 15 AND len(list_filter(string_split(en, ' '), lambda w: w <> '')) < 10 THEN 'short' WHEN NOT (contains(zh, '第三次') OR regexp_matches(en, '\\d{1,2}:\\d{2}')) THEN 'no context' END AS fault FROM (
SELECT ord, CASE ord % 3 WHEN 0 THEN '第三次出现的是谁和谁在' || repeat('字', (ord % 7)::INT) WHEN 1 THEN repeat('字', 16) ELSE '' END AS zh,
  CASE ord % 5 WHEN 0 THEN txt || repeat(' word', (ord % 12)::INT) WHEN 1 THEN 'who enters the room at 12:30 and then leaves it with the box' ELSE '' END AS en FROM v_points)
"""),
    "description_gate": _sql("""
SELECT ord, concat_ws('; ', CASE WHEN CASE WHEN shot THEN nz < 80 AND ne < 60 ELSE nz < 400 AND ne < 350 END THEN 'length' END, CASE WHEN NOT shot AND az < 2 AND ae < 2 THEN 'anchors' END, CASE WHEN n < 6 THEN 'elements ' || n END) AS faults FROM (
SELECT ord, ord % 2 = 0 AS shot, ord % 9 AS n, length(regexp_replace(zh, '\\s', '', 'g')) AS nz, len(list_filter(string_split(en, ' '), lambda w: w <> '')) AS ne, len(regexp_extract_all(zh, '\\d{1,2}:\\d{2}')) AS az, len(regexp_extract_all(en, '\\d{1,2}:\\d{2}')) AS ae FROM (
SELECT ord, CASE ord % 4 WHEN 0 THEN repeat('字', (60 + ord % 50)::INT) || ' 00:10' WHEN 1 THEN repeat('镜', 400) || ' 约 00:10 约 00:20' ELSE '' END AS zh, CASE ord % 4 WHEN 2 THEN repeat('word ', (50 + ord % 20)::INT) WHEN 3 THEN repeat('word ', 350) || '00:10 00:20' ELSE '' END AS en FROM v_points))
"""),
    "paddings": _sql("""
SELECT ord, round(total * f, 3) AS before, round(total - total * f, 3) AS after FROM (SELECT ord, 2.0::DOUBLE * greatest(4.0::DOUBLE, e - s) AS total, 0.2::DOUBLE + 0.6::DOUBLE * (('0x' || substr(sha256(ord || '|' || txt), 1, 8))::BIGINT % 1000) / 999.0::DOUBLE AS f FROM v_spans)
"""),
    "span_pairs": _sql("SELECT ord, CASE WHEN k AND b > a THEN a END AS s, CASE WHEN k AND b > a THEN b END AS e FROM (SELECT ord, ord % 4 IN (0, 3) AS k, CASE WHEN ord % 4 = 0 THEN e ELSE s END AS a, CASE WHEN ord % 4 = 0 THEN s ELSE e END AS b FROM v_spans)"),
    "distinct_frames": _sql("""
SELECT ord, len(g)::INT AS n, array_to_string(list_transform(g, lambda t: format('{:.3f}', t)), ' ') AS times FROM (SELECT ord, CASE WHEN hi <= lo THEN [] WHEN len(f) <= 5 THEN f ELSE list_transform(range(0, 5), lambda i: f[(round_even(i * (len(f) - 1) / 4.0, 0) + 1)::INT]) END AS g FROM (
SELECT *, list_filter(times, lambda t: t >= lo AND t <= hi) AS f FROM (SELECT p.ord, times, greatest(0.0, least(times[-1], p.s - 30)) AS lo, greatest(0.0, least(times[-1], p.e + 30)) AS hi FROM v_spans p JOIN (SELECT video_id, list(DISTINCT t ORDER BY t) AS times FROM v_points GROUP BY video_id) USING (video_id))))
"""),
    "frame_index": _sql("""
SELECT video_id, (i + max(no - i) OVER (PARTITION BY video_id ORDER BY t))::BIGINT AS frame_no, t FROM (SELECT video_id, t, row_number() OVER (PARTITION BY video_id ORDER BY t) AS i, round_even(t * 0.2, 0) AS no FROM (SELECT DISTINCT video_id, t FROM v_points WHERE ord % 23 <> 0))
"""),
    "frame_owners": _sql("SELECT video_id::VARCHAR AS expected, CASE video_id % 3 WHEN 0 THEN video_id % 2 <> 0 WHEN 1 THEN true ELSE false END AS foreign FROM v_videos"),
    "frame_statistics": _sql("""
SELECT video_id, count(*) AS n, min(t) AS first, max(t) AS last, CASE WHEN count(*) > 1 THEN round((max(t) - min(t)) / (count(*) - 1), 6) END AS step FROM (
SELECT video_id, t FROM v_points WHERE video_id % 2 = 0 UNION ALL SELECT DISTINCT video_id, t FROM v_points WHERE video_id % 2 <> 0 AND ord % 23 <> 0) GROUP BY video_id
"""),
    "boundary_rounds": _sql("""
SELECT video_id, id, round(s, 6) AS s, round(e, 6) AS e, state AS boundary_state FROM done
UNION ALL SELECT video_id, id, round(s, 6), round(e, 6), 'rejected' FROM v_verdicts WHERE decision = 'rejected'
UNION ALL SELECT video_id, id, round(s, 6), round(e, 6), 'rejected' FROM two WHERE d = 'rejected'
""", _VERDICTS + """,
one AS (SELECT video_id, id, s, e, 'verified' AS state FROM v_verdicts WHERE decision = 'verified' UNION ALL SELECT video_id, id, rs, re, 'refined' FROM v_verdicts WHERE decision = 'refined'
  UNION ALL SELECT video_id, id || 'a', s, at_, 'split' FROM v_verdicts WHERE decision = 'split' AND at_ > s AND at_ < e UNION ALL SELECT video_id, id || 'b', at_, e, 'split' FROM v_verdicts WHERE decision = 'split' AND at_ > s AND at_ < e
  UNION ALL SELECT video_id, id, s, e, 'unreviewed' FROM v_verdicts WHERE decision = 'odd' OR (decision = 'split' AND NOT (at_ > s AND at_ < e))),
two AS (SELECT *, (s * 3 + e) / 4 AS cut, CASE WHEN length(id) % 5 <> 0 THEN (['verified', 'refined', 'split', 'rejected'])[((length(id) + regexp_extract(id, '[0-9]+')::BIGINT) % 4 + 1)::INT] ELSE 'unreviewed' END AS d FROM one WHERE state IN ('refined', 'split')),
done AS (SELECT video_id, id, s, e, state FROM one WHERE state NOT IN ('refined', 'split') UNION ALL SELECT video_id, id, s, e, 'verified' FROM two WHERE d = 'verified' UNION ALL SELECT video_id, id, s + 0.1::DOUBLE, e - 0.1::DOUBLE, 'refined' FROM two WHERE d = 'refined'
  UNION ALL SELECT video_id, id || 'a', s, cut, 'split' FROM two WHERE d = 'split' AND cut > s AND cut < e UNION ALL SELECT video_id, id || 'b', cut, e, 'split' FROM two WHERE d = 'split' AND cut > s AND cut < e
  UNION ALL SELECT video_id, id, s, e, 'unreviewed' FROM two WHERE d = 'unreviewed' OR (d = 'split' AND NOT (cut > s AND cut < e)))
"""),
    "stage_cascade": _sql("SELECT video_id, unnest(['S1', 'S2', 'S3', 'S4', 'S5', 'S6', 'S7']) AS stage, unnest([h1, h2, h3, h4, h5, h6, h7]) AS hash FROM h7_", """
p0 AS (SELECT video_id, list_transform(range(1, 8), lambda i: CASE WHEN i = 2 AND video_id % 3 = 0 THEN '' ELSE sha256('S' || i || chr(31) || video_id) END) AS p FROM v_videos),
h1_ AS (SELECT *, sha256('S1|' || p[1]) AS h1 FROM p0), h2_ AS (SELECT *, sha256('S2|' || p[2] || '|' || h1) AS h2 FROM h1_), h3_ AS (SELECT *, sha256('S3|' || p[3] || '|' || h1 || '|' || h2) AS h3 FROM h2_),
h4_ AS (SELECT *, sha256('S4|' || p[4] || '|' || h1 || '|' || h3) AS h4 FROM h3_), h5_ AS (SELECT *, sha256('S5|' || p[5] || '|' || h1 || '|' || h3 || '|' || h4) AS h5 FROM h4_),
h6_ AS (SELECT *, sha256('S6|' || p[6] || '|' || h5) AS h6 FROM h5_), h7_ AS (SELECT *, sha256('S7|' || p[7] || '|' || h5 || '|' || h6) AS h7 FROM h6_)
"""),
    "manifest_rows": _sql(f"""
SELECT m.video_id, stages, coalesce(n, 0)::INT AS n_gaps, first AS first_gap FROM (SELECT video_id, string_agg(stage || ':' || (['failed', 'done', 'skipped'])[(i % 3 + 1)::INT] || ':' || left(md5(i::VARCHAR), 12), ' ' ORDER BY stage) AS stages FROM lastst GROUP BY video_id) m
LEFT JOIN (SELECT video_id, count(*) AS n, round(min(s), 3) AS first FROM ({_GAPS.format(test="e - s > 1.0")}) GROUP BY video_id) USING (video_id)
""", _UNION.format(eps=1.0) + ", lastst AS (SELECT user_id AS video_id, event_type AS stage, max(event_id) AS i FROM events GROUP BY ALL)"),
    "restored_tracks": "WITH lastst AS (SELECT user_id AS video_id, event_type AS stage, max(event_id) AS i FROM events GROUP BY ALL), o AS (SELECT user_id AS video_id, " + ", ".join(f"sum(event_id) FILTER (WHERE event_type = '{k}')::BIGINT AS {k}" for k in ("click", "view", "purchase")) + " FROM events GROUP BY user_id) SELECT o.video_id, "
    + ", ".join(f"CASE WHEN EXISTS (SELECT 1 FROM lastst x WHERE x.video_id = o.video_id AND x.stage = '{k}' AND x.i % 3 = 1) THEN {k} END AS {k}" for k in ("click", "view", "purchase")) + " FROM o",
    "ngram_neardup": f"""
WITH b AS (SELECT item_id::BIGINT AS id, text FROM benchmark UNION ALL SELECT item_id + 1000000, text || ' and so on' FROM benchmark UNION ALL SELECT item_id + 2000000, 'Q: ' || upper(text) FROM benchmark WHERE item_id % 3 = 0),
g AS (SELECT id, {_ngrams("text")} AS g FROM b)
SELECT x.id, y.id AS other, round({_JACCARD.format(a="x.g", b="y.g")}, 6) AS similarity FROM g x JOIN g y ON x.id < y.id AND least(len(x.g), len(y.g)) >= 0.8 * greatest(len(x.g), len(y.g)) WHERE {_JACCARD.format(a="x.g", b="y.g")} >= 0.85
""",
    "embedding_neardup": """
SELECT vec_id, other, round(c, 5) AS cosine FROM (SELECT a.vec_id, b.vec_id AS other, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.vec_id % 20 = 0) WHERE c >= 0.4
""",
    "event_engine": _sql("""
SELECT video_id, 'event' AS kind, id, round(s, 6) AS s, round(e, 6) AS e, 'e' || row_number() OVER (PARTITION BY video_id ORDER BY s, e, id) AS event_id, CASE WHEN importance = 'key' AND e - s < 3 THEN 'minor' ELSE importance END AS importance, state AS boundary_state, scene_id, sources FROM (
  SELECT n.*, (SELECT arg_min(c.scene_id, c.place) FROM v_scenes c WHERE c.video_id = n.video_id AND c.s <= (n.s + n.e) / 2 AND (n.s + n.e) / 2 <= c.e) AS scene_id FROM norm n WHERE e > s)
UNION ALL SELECT video_id, 'boundary_rejected', id, round(s, 6), round(e, 6), NULL, NULL, NULL, NULL, NULL FROM rejected
UNION ALL SELECT video_id, 'boundary_split', id, round(s, 6), round(e, 6), NULL, NULL, NULL, NULL, NULL FROM done WHERE state = 'split'
UNION ALL SELECT video_id, 'event_span_invalid', id, round(s, 6), round(e, 6), NULL, NULL, NULL, NULL, NULL FROM norm WHERE NOT e > s
""", f"""
cand AS (SELECT video_id, 'c' || ord AS id, 'c' || ord AS origin, s, e, repeat(txt || ' at the gate ', 3) || repeat('!', (ord % 9)::INT) AS txt, ord % 5 AS d FROM v_spans),
one AS (SELECT video_id, id, origin, s, e, 'verified' AS state FROM cand WHERE d = 0 UNION ALL SELECT video_id, id, origin, s + 0.25::DOUBLE, e + 0.5::DOUBLE, 'refined' FROM cand WHERE d = 1
  UNION ALL SELECT video_id, id || 'a', origin, s, (s + e) / 2, 'split' FROM cand WHERE d = 2 AND e > s UNION ALL SELECT video_id, id || 'b', origin, (s + e) / 2, e, 'split' FROM cand WHERE d = 2 AND e > s
  UNION ALL SELECT video_id, id, origin, s, e, 'unreviewed' FROM cand WHERE d = 4 OR (d = 2 AND NOT e > s)),
two AS (SELECT *, (regexp_extract(id, '[0-9]+')::BIGINT + length(id)) % 5 AS d FROM one WHERE state IN ('refined', 'split')),
done AS (SELECT video_id, id, origin, s, e, state FROM one WHERE state NOT IN ('refined', 'split') UNION ALL SELECT video_id, id, origin, s, e, 'verified' FROM two WHERE d = 0 UNION ALL SELECT video_id, id, origin, s + 0.25::DOUBLE, e + 0.5::DOUBLE, 'refined' FROM two WHERE d = 1
  UNION ALL SELECT video_id, id || 'a', origin, s, (s + e) / 2, 'split' FROM two WHERE d = 2 AND e > s UNION ALL SELECT video_id, id || 'b', origin, (s + e) / 2, e, 'split' FROM two WHERE d = 2 AND e > s
  UNION ALL SELECT video_id, id, origin, s, e, 'unreviewed' FROM two WHERE d = 4 OR (d = 2 AND NOT e > s)),
rejected AS (SELECT video_id, id, s, e FROM cand WHERE d = 3 UNION ALL SELECT video_id, id, s, e FROM two WHERE d = 3),
rows_ AS (SELECT done.*, cand.txt, row_number() OVER (PARTITION BY done.video_id ORDER BY done.s, done.e, done.id) AS ord FROM done JOIN cand ON cand.video_id = done.video_id AND cand.id = done.origin),
{_FIRST_FIT_FROM.format(source="rows_")},
cl AS (SELECT r.*, w.c, count(*) OVER (PARTITION BY r.video_id, w.c) AS n FROM rows_ r JOIN w USING (video_id, ord)),
two_ AS (SELECT video_id, c, list({{'id': id, 't': txt, 'g': {_ngrams("txt")}}} ORDER BY s, e, ord) AS x FROM cl WHERE n = 2 GROUP BY video_id, c),
take AS (SELECT video_id, CASE WHEN length(x[1].t) >= length(x[2].t) THEN x[1].id ELSE x[2].id END AS keep, CASE WHEN length(x[1].t) >= length(x[2].t) THEN x[2].id ELSE x[1].id END AS gone FROM two_ WHERE {_JACCARD.format(a="x[1].g", b="x[2].g")} >= 0.85
  UNION ALL SELECT video_id, arg_min(id, ord), arg_max(id, ord) FROM cl WHERE n > 2 GROUP BY video_id, c),
kept AS (SELECT r.video_id, r.id || CASE WHEN t.gone IS NULL THEN '' ELSE '_m1' END AS id, r.s, r.e, r.state, t.gone AS sources FROM rows_ r LEFT JOIN take t ON t.video_id = r.video_id AND t.keep = r.id WHERE NOT EXISTS (SELECT 1 FROM take z WHERE z.video_id = r.video_id AND z.gone = r.id)),
norm AS (SELECT video_id, id, state, sources, CASE WHEN a >= b THEN greatest(0.0, a - 1) ELSE a END AS s, CASE WHEN a >= b THEN least(700.0, a + 1) ELSE b END AS e, CASE WHEN k % 4 <> 0 AND k % 3 = 0 THEN 'key' ELSE 'minor' END AS importance FROM (
  SELECT *, regexp_extract(id, '[0-9]+')::BIGINT AS k, greatest(0.0, least(700.0, s)) AS a, greatest(0.0, least(700.0, e)) AS b FROM kept))
"""),
    "global_block": _sql(f"""
SELECT v.video_id, coalesce(who, '') AS characters, coalesce(loose, '') AS unmerged, coalesce(n_causes, 0)::INT AS n_causes, md5(coalesce(ids, '')) AS timeline, coalesce(n_misaligned, 0)::INT AS n_misaligned FROM v_videos v
LEFT JOIN (SELECT h.video_id, string_agg(h.video_id || ':' || h.id || ':' || coalesce(h.alias, '-') || ':' || coalesce(n, 0), ' ' ORDER BY h.id) AS who FROM hit h LEFT JOIN (SELECT video_id, name, count(*) AS n FROM app GROUP BY ALL) s ON s.video_id = h.video_id AND s.name = h.alias GROUP BY h.video_id) USING (video_id)
LEFT JOIN (SELECT video_id, string_agg(name, ',' ORDER BY name) AS loose FROM (SELECT DISTINCT video_id, name FROM app) a WHERE NOT EXISTS (SELECT 1 FROM hit WHERE hit.video_id = a.video_id AND hit.alias = a.name) GROUP BY video_id) USING (video_id)
LEFT JOIN (SELECT x.video_id, count(*) AS n_causes FROM v_events x JOIN v_events c ON c.video_id = x.video_id AND c.ord = x.cause WHERE x.cause <> x.ord AND c.boundary_state IN ('verified', 'refined') AND x.boundary_state IN ('verified', 'refined') AND c.e <= x.s + 1e-6 AND x.video_id % 4 <> 0 GROUP BY x.video_id) USING (video_id)
LEFT JOIN (SELECT video_id, CASE WHEN video_id % 2 = 0 THEN string_agg(ord::VARCHAR, ',' ORDER BY ord::VARCHAR DESC) ELSE string_agg(ord::VARCHAR, ',' ORDER BY s, ord::VARCHAR) END AS ids FROM v_events WHERE video_id % 4 <> 0 GROUP BY video_id) USING (video_id)
LEFT JOIN (SELECT l.video_id, count(*) AS n_misaligned FROM linked l JOIN v_scenes c ON c.video_id = l.video_id AND c.scene_id = l.scene_id WHERE l.video_id % 4 <> 0 AND CASE WHEN least(l.e - l.s, c.e - c.s) <= 0 THEN 0 ELSE greatest(0.0, least(l.e, c.e) - greatest(l.s, c.s)) / least(l.e - l.s, c.e - c.s) END < 0.5 GROUP BY l.video_id) USING (video_id)
""", _LINK + f""",
app AS (SELECT video_id, CASE WHEN ord % 2 = 0 THEN txt ELSE upper(txt) END AS name, s FROM v_spans WHERE video_id % 4 <> 0),
person AS (SELECT video_id, 'p_' || en AS id, en FROM v_videos, (SELECT unnest(['click', 'view', 'Sign-Up', 'nobody']) AS en) WHERE video_id % 3 <> 0),
tried AS (SELECT video_id, id, unnest([1, 3, 4]) AS p, unnest([en, id, 'ERROR']) AS c FROM person),
near AS (SELECT video_id, {_name_key("name")} AS key, arg_min(name, s) AS name FROM app GROUP BY ALL),
hit AS (SELECT t.video_id, t.id, arg_min(coalesce(x.name, n.name), t.p) FILTER (WHERE coalesce(x.name, n.name) IS NOT NULL) AS alias FROM tried t LEFT JOIN (SELECT DISTINCT video_id, name FROM app) x ON x.video_id = t.video_id AND x.name = t.c
  LEFT JOIN near n ON n.video_id = t.video_id AND n.key = {_name_key("t.c")} GROUP BY t.video_id, t.id)
"""),
    "annotated_windows": _sql("""
SELECT video_id, s, e, 'w' || lpad(row_number() OVER (PARTITION BY video_id ORDER BY s, e)::VARCHAR, 4, '0') AS id, CASE WHEN n % 3 = 0 THEN 'held' ELSE 'said ' || video_id || '|' || k END AS response, n % 3 <> 0 AS fresh FROM win WHERE n % 3 = 0 OR n % 5 <> 1
UNION ALL SELECT video_id, s, e, NULL, 'annotation failed', NULL FROM win WHERE n % 3 <> 0 AND n % 5 = 1
""", "win AS (SELECT video_id, k, k + video_id AS n, k * 180.0::DOUBLE AS s, least((k + 1) * 180.0, 720.0)::DOUBLE AS e FROM v_videos, range(4) r(k))"),
    "caption_requests": _sql("""
SELECT video_id, count(*) AS n, count(DISTINCT frame) AS n_frames, round(sum(frame), 3) AS frames FROM (SELECT a.video_id, a.t, coalesce((SELECT max(p.t) FROM v_points p WHERE p.video_id = a.video_id AND p.t <= a.t), (SELECT min(p.t) FROM v_points p WHERE p.video_id = a.video_id)) AS frame
FROM (SELECT video_id, round(720.0::DOUBLE * i / 37, 3) AS t FROM v_videos, range(1, 37) r(i) WHERE video_id % 5 <> 0) a) GROUP BY video_id
"""),
}


def _rounds(most: int) -> str:
    """The rounds of ``_generation`` one after the other, as far as the largest quota goes."""
    keep = "CASE WHEN NOT inside THEN 0 WHEN NOT broken THEN 1 WHEN (i + 1) % 3 = 0 THEN 0 WHEN i % 8 = 3 THEN 2 WHEN (i + 2) % 3 = 0 THEN 0 ELSE 3 END"
    out = ["""
anc AS MATERIALIZED (SELECT video_id, 'e' || ord AS aid, ord, s, round(e + 6, 3) AS e, importance, greatest(720.0, max(round(e + 6, 3)) OVER (PARTITION BY video_id)) AS scale FROM v_events),
st0 AS MATERIALIZED (SELECT video_id, video_id % 30 + 10 AS quota, 0::BIGINT AS n, []::VARCHAR[] AS used, []::VARCHAR[] AS keys, 0::BIGINT AS reused, 0::BIGINT AS dups, 0::BIGINT AS prompted, 0::BIGINT AS rounds, true AS open FROM v_videos)"""]
    for r in range(1, most + 1):
        out.append(f"""
rq{r} AS MATERIALIZED (SELECT *, least(20, quota - n) AS need FROM st{r - 1} WHERE open AND n < quota AND {r} <= 2 + ceil(quota / 20.0)),
tn{r} AS (SELECT a.*, least(3, floor((a.s + a.e) / 2 / scale * 4)) AS b, row_number() OVER (PARTITION BY a.video_id, least(3, floor((a.s + a.e) / 2 / scale * 4)) ORDER BY list_contains(q.used, aid), importance <> 'key', s, ord) AS turn FROM anc a JOIN rq{r} q USING (video_id)),
pl{r} AS MATERIALIZED (SELECT video_id, list({{'aid': aid, 's': s, 'e': e}} ORDER BY s, e, aid) AS pool FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY turn, b) AS place FROM tn{r}) WHERE place <= 30 GROUP BY video_id),
rw{r} AS MATERIALIZED (SELECT video_id, i, CASE WHEN i % 6 <> 5 THEN a.aid END AS aid, a.s AS s, a.e <= 721 AND a.s >= 0 AS inside, i % 5 < 3 AND i % 4 = 3 AS broken, 'who enters the room at 12:30 and then leaves it with ' || a.aid AS stem, substr('ABCD', (i % 4 + 1)::INT, 1) AS answer
  FROM (SELECT video_id, i, pool[((i * 7 + {r} * 3) % len(pool) + 1)::INT] AS a FROM (SELECT video_id, unnest(range(0, (need + 2)::BIGINT)) AS i FROM rq{r} WHERE NOT (video_id % 7 = 6 AND {r} = 2)) JOIN pl{r} USING (video_id))),
gd{r} AS MATERIALIZED (SELECT *, regexp_replace(lower(stem || CASE k WHEN 2 THEN ' again' WHEN 3 THEN ' again again' ELSE '' END), '[^\\p{{L}}\\p{{N}}]+', '', 'g') || '|' || answer AS key FROM (SELECT *, {keep} AS k FROM rw{r} WHERE aid IS NOT NULL) WHERE k > 0),
fr{r} AS MATERIALIZED (SELECT g.video_id, {r}::BIGINT AS round, i, aid, s, key, q.n + row_number() OVER (PARTITION BY g.video_id ORDER BY i) AS place FROM (SELECT *, row_number() OVER (PARTITION BY video_id, key ORDER BY i) AS c FROM gd{r}) g JOIN rq{r} q ON q.video_id = g.video_id WHERE c = 1 AND NOT list_contains(q.keys, key)),
st{r} AS MATERIALIZED (SELECT o.video_id, quota, o.n + coalesce(f.n, 0) AS n, list_distinct(list_concat(o.used, coalesce(f.used, []))) AS used, list_concat(o.keys, coalesce(f.keys, [])) AS keys, reused + coalesce(w.n, 0) - coalesce(g.n, 0) AS reused, dups + coalesce(g.n, 0) - coalesce(f.n, 0) AS dups,
  coalesce(len(p.pool), prompted) AS prompted, CASE WHEN q.video_id IS NOT NULL THEN {r} ELSE rounds END AS rounds, open AND (q.video_id IS NULL OR w.video_id IS NOT NULL) AS open FROM st{r - 1} o LEFT JOIN (SELECT video_id FROM rq{r}) q USING (video_id) LEFT JOIN pl{r} p USING (video_id)
  LEFT JOIN (SELECT video_id, count(aid) AS n FROM rw{r} GROUP BY video_id) w USING (video_id) LEFT JOIN (SELECT video_id, count(*) AS n FROM gd{r} GROUP BY video_id) g USING (video_id) LEFT JOIN (SELECT video_id, count(*) AS n, list(aid) AS used, list(key) AS keys FROM fr{r} GROUP BY video_id) f USING (video_id))""")
    out.append("""
gq AS (SELECT *, CASE WHEN i % 5 < 3 THEN 'mcq' WHEN i % 5 = 3 THEN 'temporal_grounding' ELSE 'open' END AS task_type, ({caps})[((i + round) % 24 + 1)::INT] AS capability FROM ({all}))""".format(caps=str(list(CAPABILITIES)), all=" UNION ALL ".join(f"SELECT * FROM fr{r}" for r in range(1, most + 1))))
    return ",".join(out)


_GENERATION = _rounds(4)
_MATRIX = {
        "ok_layers": "least(L1, L2, L3, L4, L5) >= 2", "ok_cross": '"cross" / m.n >= 0.5', "ok_mcq": "mcq / m.n BETWEEN 0.5 AND 0.7", "ok_temporal": "temporal_grounding / m.n BETWEEN 0.15 AND 0.25", "ok_buckets": "least(b0, b1, b2, b3) >= 0.15 * m.n",
    }
SQL["question_generation"] = _sql("SELECT video_id, video_id || '_q' || CASE WHEN place < 10 THEN '0' ELSE '' END || place AS qid, round, aid AS anchor_id, task_type, key FROM gq", _GENERATION)
SQL["generation_report"] = _sql("""
SELECT s.video_id, quota AS target, rounds, reused AS reused_anchor, dups AS duplicates_dropped, len(used) AS anchors_used, prompted AS anchors_prompted, (SELECT count(*) FROM anc WHERE anc.video_id = s.video_id) AS anchors_total, coalesce(m.n, 0) AS n, {counts}, {checks},
  {all_} AS ok FROM st4 s LEFT JOIN (SELECT video_id, count(*) AS n, {layers}, count(*) FILTER (WHERE i % 3 > 0) AS "cross", {tasks}, {buckets} FROM gq GROUP BY video_id) m USING (video_id)
""".format(
    counts=", ".join(f'coalesce(m."{c}", 0)::BIGINT AS "{c}"' for c in ("L1", "L2", "L3", "L4", "L5", "cross", "mcq", "temporal_grounding", "open", "summary", "b0", "b1", "b2", "b3")),
    checks=", ".join(f"coalesce({c}, false) AS {n}" for n, c in _MATRIX.items()),
    all_=" AND ".join(f"coalesce({c}, false)" for c in _MATRIX.values()),
    layers=", ".join(f"count(*) FILTER (WHERE starts_with(capability, 'L{i}')) AS L{i}" for i in range(1, 6)), tasks=", ".join(f"count(*) FILTER (WHERE task_type = '{t}') AS {t}" for t in ("mcq", "temporal_grounding", "open", "summary")),
    buckets=", ".join(f"count(*) FILTER (WHERE least(3, floor(s / 720 * 4)) = {i}) AS b{i}" for i in range(4)),
), _GENERATION)

_TREE = """
o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY s, e) AS rn FROM v_shots),
w AS (SELECT video_id, rn, s, s AS gs, e, 1::BIGINT AS g FROM o WHERE rn = 1
  UNION ALL SELECT o.video_id, o.rn, o.s, CASE WHEN o.e - w.gs < 15 THEN w.gs ELSE o.s END, o.e, CASE WHEN o.e - w.gs < 15 THEN w.g ELSE w.g + 1 END FROM w JOIN o ON o.video_id = w.video_id AND o.rn = w.rn + 1),
sh AS MATERIALIZED (SELECT *, video_id % 5 = 0 OR (video_id + g) % 7 <> 3 AS ok FROM w),
qs AS (SELECT video_id, 'shot' AS level, g AS ord, min(gs) AS s, max(e) AS e, CASE (video_id + g + 2) % 4 WHEN 0 THEN 'no answer' WHEN 3 THEN 'length; elements 2' ELSE 'elements 2' END AS reason FROM sh WHERE NOT ok GROUP BY video_id, g),
wn AS (SELECT video_id, k + 1 AS ord, video_id + k + 1 AS kk, k * 20.0::DOUBLE AS s, k * 20.0::DOUBLE + 20 AS e FROM v_videos, range(36) r(k) WHERE video_id % 4 <> 1 OR k < 12),
sg AS MATERIALIZED (SELECT *, CASE WHEN kk % 7 = 3 THEN 0 WHEN kk % 5 IN (0, 1, 4) THEN 1 WHEN kk % 5 = 2 THEN 2 ELSE 0 END AS sides, CASE WHEN kk % 5 = 3 THEN 'no answer' WHEN (kk + 2) % 5 IN (1, 2) THEN 'elements 2' WHEN (kk + 2) % 5 = 3 THEN 'anchors; elements 2' ELSE 'no text' END AS reason FROM wn),
si AS (SELECT *, CASE WHEN sides = 1 AND (kk % 3 = 0 OR kk % 11 = 1) THEN 0 WHEN sides = 1 THEN CASE WHEN kk % 5 = 0 THEN 10 ELSE 300 END ELSE 353 END AS words FROM sg WHERE sides > 0),
sl AS (SELECT video_id, string_agg(concat_ws(',', CASE WHEN words = 0 THEN 'en fill failed' END, CASE WHEN words = 10 THEN 'length ratio' END, CASE WHEN words > 0 AND kk % 4 = 1 THEN 'back translation' END), ',' ORDER BY ord) FILTER (WHERE words IN (0, 10) OR kk % 4 = 1) AS below FROM si GROUP BY video_id),
rk AS (SELECT *, (row_number() OVER (PARTITION BY video_id ORDER BY ord) - 1) // 15 + 1 AS part, count(*) OVER (PARTITION BY video_id) > 15 AS many FROM si),
gr AS MATERIALIZED (SELECT video_id, part AS ord, min(s) AS s, max(e) AS e FROM rk WHERE many GROUP BY video_id, part),
wh AS MATERIALIZED (SELECT video_id, count(*) AS n, min(s) AS s, max(e) AS e, string_agg(s::INT::VARCHAR, '|' ORDER BY s) AS starts FROM (SELECT video_id, s, e FROM gr WHERE (video_id + ord) % 6 <> 0 UNION ALL SELECT video_id, s, e FROM rk WHERE NOT many) GROUP BY video_id),
qt AS MATERIALIZED (SELECT * FROM qs UNION ALL SELECT video_id, 'segment', ord, s, e, reason FROM sg WHERE sides = 0 UNION ALL SELECT video_id, 'group', ord, s, e, 'no answer' FROM gr WHERE (video_id + ord) % 6 = 0 UNION ALL SELECT video_id, 'whole', 1, s, e, 'no answer' FROM wh WHERE video_id % 10 = 7),
wx AS (SELECT *, video_id + 1 AS kk, CASE WHEN video_id % 3 <> 0 THEN 2 WHEN (video_id + 1) % 3 = 0 OR (video_id + 1) % 11 = 1 THEN 0 WHEN (video_id + 1) % 5 = 0 THEN 10 ELSE 300 END AS words FROM wh WHERE video_id % 10 <> 7)
"""
SQL["quiet_requests"] = _sql("SELECT video_id, level, ord, round(s, 6) AS s, round(e, 6) AS e, reason FROM qt", _TREE)
SQL["dense_description"] = _sql("""
SELECT v.video_id, coalesce(x.n * 200, 0) AS full_len_zh, md5(CASE WHEN coalesce(words, 0) = 0 THEN '-' WHEN words = 2 THEN 'whole ' || starts ELSE rtrim(repeat('word ', words)) END) AS en,
  concat_ws(',', below, CASE WHEN words = 0 THEN 'en fill failed' END, CASE WHEN words > 0 AND NOT x.n * 200 / words BETWEEN 0.4 AND 2.5 THEN 'length ratio' END, CASE WHEN words > 0 AND kk % 4 = 1 THEN 'back translation' END, CASE WHEN coalesce(x.n * 200, 0) < 1000 THEN 'short' END) AS issues,
  shot_ok, shot_total, segment_ok, segment_total, coalesce(n_quiet, 0) AS n_quiet FROM v_videos v LEFT JOIN wx x USING (video_id) LEFT JOIN sl USING (video_id) LEFT JOIN (SELECT video_id, count(*) FILTER (WHERE ok) AS shot_ok, count(*) AS shot_total FROM sh GROUP BY video_id) USING (video_id)
  LEFT JOIN (SELECT video_id, count(*) FILTER (WHERE sides > 0) AS segment_ok, count(*) AS segment_total FROM sg GROUP BY video_id) USING (video_id) LEFT JOIN (SELECT video_id, count(*) AS n_quiet FROM qt GROUP BY video_id) USING (video_id)
""", _TREE)

SQL["manifest_log"] = _sql("""
SELECT v.video_id, coalesce(stages, '') AS stages, coalesce(todos, '') AS todos, coalesce(gaps, '') AS gaps, coalesce(stats, '') AS stats, frames FROM (SELECT DISTINCT video_id FROM lg) v
LEFT JOIN (SELECT video_id, string_agg(stage || ':' || state || ':' || hash || ':' || tm, ' ' ORDER BY stage) AS stages FROM lt x WHERE NOT EXISTS (SELECT 1 FROM reach c JOIN lt u ON u.stage = c.src WHERE c.dst = x.stage AND u.video_id = x.video_id AND u.moved_at > x.tm) GROUP BY video_id) USING (video_id)
LEFT JOIN (SELECT video_id, string_agg(strftime(DATE '1970-01-01' + (tm // 86400)::INT, '%Y-%m-%d') || ':' || txt || ':' || ord, ' ' ORDER BY tm) AS todos FROM lg WHERE ord % 8 = 4 GROUP BY video_id) USING (video_id)
LEFT JOIN (SELECT video_id, string_agg(ord::VARCHAR, ' ' ORDER BY tm) AS gaps FROM lg g WHERE ord % 8 = 5 AND NOT EXISTS (SELECT 1 FROM lg c WHERE c.video_id = g.video_id AND c.ord % 24 = 7 AND c.tm >= g.tm) GROUP BY video_id) USING (video_id)
LEFT JOIN (SELECT video_id, string_agg(txt || ':' || o, ' ' ORDER BY txt) AS stats FROM (SELECT video_id, txt, arg_max(ord, tm) AS o FROM lg WHERE ord % 8 = 6 GROUP BY ALL) GROUP BY video_id) USING (video_id)
LEFT JOIN (SELECT video_id, arg_max(ord, tm)::VARCHAR AS frames FROM lg WHERE ord % 8 = 7 AND ord % 24 <> 7 GROUP BY video_id) USING (video_id)
""", """
lg AS MATERIALIZED (SELECT *, ord * 7919 % 1000003 AS tm, 'S' || (ord // 8 % 7 + 1) AS stage, (['done', 'failed', 'skipped'])[(ord % 3 + 1)::INT] AS state, 'h' || ord % 2 AS hash FROM v_spans),
lt AS MATERIALIZED (SELECT video_id, stage, max(tm) AS tm, arg_max(state, tm) AS state, arg_max(hash, tm) AS hash, max(CASE WHEN moved THEN tm END) AS moved_at FROM (SELECT *, lag(hash) OVER (PARTITION BY video_id, stage ORDER BY tm) <> hash AS moved FROM lg WHERE ord % 8 < 4) GROUP BY ALL),
edge AS (SELECT unnest([EDGES]) AS p),
reach AS (SELECT p[1] AS src, p[2] AS dst FROM edge UNION SELECT r.src, p[2] FROM reach r JOIN edge ON p[1] = r.dst)
""".replace("EDGES", ", ".join(f"['{a}', '{b}']" for a, b in DEPENDS)))
