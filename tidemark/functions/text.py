"""Scalar functions of text, arrays and vectors."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tidemark.config import DEFAULT, Thresholds

#: Unicode white space.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
ANCHOR = r"\d{1,2}:\d{2}"
# Ordinals and positions that place a question, and quoted phrases.
ZH_ORDINAL = (
    "第[一二三四五六七八九十百]+次?|最后一?次?|最初|最先|首次|再一次|又一次|"
    "初次|初始|先前|此前|之后|随后|后来|开场|结尾|片尾|片头"
)
EN_ORDINAL = (
    r"(?i)\b(first|second|third|fourth|fifth|last|final|finally|again|initial|initially|"
    r"earlier|previously|later|afterwards?|beginning|ending)\b"
)
QUOTED = "[“\"『「][^”\"』」]{2,}[”\"』」]"
# Fixed value: CJK, kana and hangul one by one, Latin words, numbers. The number part has no backslash, which the SQL of
# the checks would need twice.
TOKEN = "[一-鿿㐀-䶿぀-ヿ가-힯]|[A-Za-z]+(?:'[A-Za-z]+)?|[0-9]+(?:[.][0-9]+)?"

# Keywords of the eight elements of a description.
ELEMENTS = {
    "characters": ("人物", "角色", "男人", "女人", "男孩", "女孩", "穿着", "衣服", "man", "woman", "boy", "girl", "wear", "character"),
    "action": ("动作", "走", "跑", "说", "拿", "吃", "打", "抱", "开", "关", "walk", "run", "speak", "talk", "hold", "fight"),
    "objects": ("物体", "物品", "桌子", "车", "房子", "机器", "书", "杯子", "object", "table", "car", "house", "machine", "book"),
    "camera": ("镜头", "特写", "远景", "中景", "摇", "推", "拉", "切", "跟拍", "close-up", "wide", "pan", "zoom", "track", "cut"),
    "scene_light": ("场景", "光线", "灯光", "室内", "室外", "夜景", "黄昏", "阳光", "scene", "light", "indoor", "outdoor", "night", "sunlight"),
    "text": ("字幕", "文字", "屏幕上", "标题", "标语", "subtitle", "text", "title"),
    "audio": ("声音", "音乐", "音效", "背景声", "对白", "掌声", "sound", "music", "audio", "dialogue", "applause"),
    "mood": ("氛围", "情绪", "紧张", "温馨", "压抑", "欢快", "悲伤", "mood", "tense", "warm", "gloomy", "joyful"),
}

# Option texts that give an answer away.
PRIOR_TEMPLATES = (
    "以上都不对", "以上都对", "以上均不正确", "以上均正确", "none of the above",
    "all of the above", "not listed", "不是以上任何一项", "无法确定", "cannot be determined",
)


def zh_len(x: Column) -> Column:
    return F.length(F.translate(x, BLANKS, ""))


def en_len(x: Column) -> Column:
    return F.size(F.filter(F.split(F.translate(x, BLANKS, " " * len(BLANKS)), " "), lambda w: w != ""))


def lang_len(x: Column, lang: Column) -> Column:
    return F.when(lang == "zh", zh_len(x)).otherwise(en_len(x))


def anchors(x: Column) -> Column:
    """Number of clock times in a text."""
    return F.size(F.regexp_extract_all(x, F.lit(ANCHOR), 0))


def referring(x: Column) -> Column:
    """Whether a question places itself: a clock time, an ordinal or a quotation."""
    return x.rlike(ANCHOR) | x.rlike(ZH_ORDINAL) | x.rlike(EN_ORDINAL) | x.rlike(QUOTED)


def tokens(x: Column) -> Column:
    """CJK characters one by one, words with apostrophes, numbers; lower case."""
    return F.transform(F.regexp_extract_all(x, F.lit(TOKEN), 0), F.lower)


def ngrams(x: Column, n: int = 3) -> Column:
    """Distinct character n-grams without white space; a shorter text is its own."""
    chars = F.filter(F.split(F.translate(x, BLANKS, ""), ""), lambda c: c != "")

    def grams(c: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.concat(*(c[i + j] for j in range(n))))
        return F.when(F.size(c) <= n, F.array(F.array_join(c, ""))).otherwise(F.array_distinct(runs))

    return F.transform(F.array(chars), grams)[0]  # a lambda's argument is computed once, not once a gram


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def cosine(a: Column, b: Column) -> Column:
    """0 for a zero vector."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / F.when(norm > 0, norm)).otherwise(0.0)


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, a bit a place of ``b``: each item of ``a`` costs one add and mask of
    whole words, so the time is len(a) * len(b) / 64."""
    places: dict = {}
    for i, item in enumerate(b):
        places[item] = places.get(item, 0) | 1 << i
    full = open_ = (1 << len(b)) - 1
    for item in a:
        if met := open_ & places.get(item, 0):
            open_ = ((open_ + met) | (open_ - met)) & full
    return len(b) - open_.bit_count()


def lcs(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two arrays; null for a null array."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else common_length(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)], dtype="Int32")

    return F.pandas_udf(run, IntegerType())(a, b)


def rouge_l(a: Column, b: Column) -> Column:
    """F1 of the longest common subsequence; 0 where either side is empty."""
    shared = lcs(a, b)
    return F.when(shared == 0, 0.0).otherwise(2.0 * shared / (F.size(a) + F.size(b)))


def elements(x: Column) -> Column:
    """Number of element groups that a description touches; a group is left at its first word found."""
    low = F.lower(x)
    hits = [reduce(or_, (low.contains(w) for w in words)).cast("int") for words in ELEMENTS.values()]
    return reduce(add, hits)


def name_key(x: Column) -> Column:
    """A name without white space, underscores, dashes and middle dots; lower case."""
    return F.lower(F.translate(x, BLANKS + "_-·", ""))


def question_key(x: Column) -> Column:
    """Letters and digits of a question, lower case."""
    return F.regexp_replace(F.lower(x), "[^\\p{L}\\p{N}]+", "")


def answered_key(zh: Column, en: Column, answer: Column) -> Column:
    """What makes a question the same: letters and digits of the first filled side, and the answer."""
    side = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), "[^\\p{L}\\p{N}]+", "")
    return F.concat(F.when(side(zh) != "", side(zh)).otherwise(F.lower(side(en))), F.lit("|"), F.coalesce(answer, F.lit("")))


def similarity(a: Column, b: Column, one: Column | None = None, other: Column | None = None) -> Column:
    """Likeness of two texts: the cosine of their embeddings where both have one, else of their trigrams; 0 if one is
    empty."""
    grams = jaccard(ngrams(a), ngrams(b))
    value = grams if one is None else F.when(one.isNotNull() & other.isNotNull(), cosine(one, other)).otherwise(grams)
    return F.when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == ""), 0.0).otherwise(value)


def description_faults(level: Column, zh: Column, en: Column, n_elements: Column, limits: Thresholds = DEFAULT) -> Column:
    """What a description lacks, joined: length (either language is enough), clock times (segments only; either language),
    elements."""
    zh, en = F.coalesce(zh, F.lit("")), F.coalesce(en, F.lit(""))
    shot = level == "shot"
    short = F.when(shot, (zh_len(zh) < limits.shot_zh) & (en_len(en) < limits.shot_en)).otherwise((zh_len(zh) < limits.segment_zh) & (en_len(en) < limits.segment_en))
    few = ~shot & (anchors(zh) < limits.anchors) & (anchors(en) < limits.anchors)
    return F.concat_ws("; ", F.when(short, "length"), F.when(few, "anchors"), F.when(n_elements < limits.elements, F.concat(F.lit("elements "), n_elements.cast("string"))))


def referring_fault(zh: Column, en: Column) -> Column:
    """Why a question stem isn't accepted: too short in both languages, or nothing in either places it; null if fine."""
    zh, en = F.coalesce(zh, F.lit("")), F.coalesce(en, F.lit(""))
    return F.when((zh_len(zh) < 15) & (en_len(en) < 10), "short").when(~(referring(zh) | referring(en)), "no context")


def first_text(*sides: Column) -> Column:
    """The first side that is neither null nor empty."""
    return F.coalesce(*(F.when(s != "", s) for s in sides))


# Fixed value: punctuation that may close an option.
CLOSING = "。.,，;；!！?？、"


def option_key(x: Column) -> Column:
    """An option without outer white space and closing punctuation; lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(x, r"^[\s　]*", ""), f"[\\s　{CLOSING}]*$", ""))


def language_prior(options: Column, *questions: Column) -> Column:
    """Four options of which one is a template, or stands in the question (4 characters, 6 with CJK)."""
    least = lambda o: F.when(o.rlike("[一-鿿]"), 6).otherwise(4)
    leaks = F.exists(options, lambda o: (F.length(o) >= least(o)) & F.greatest(*(F.lower(F.coalesce(q, F.lit(""))).contains(F.lower(o)) for q in questions), F.lit(False)))
    return (F.size(options) == 4) & (F.exists(options, lambda o: option_key(o).isin(*PRIOR_TEMPLATES)) | leaks)


def description(fields: dict[str, Column]) -> Column:
    """The first filled of the keys that answers use for a description."""
    return first_text(*(fields[k] for k in ("description", "desc", "detailed_description") if k in fields))


def options_text(options: Column) -> Column:
    """``A. text`` a line."""
    return F.array_join(F.transform(options, lambda o, i: F.concat(F.substring(F.lit("ABCDEFGH"), i + 1, F.lit(1)), F.lit(". "), o)), "\n")


def modalities(found: Column, known: tuple[str, ...]) -> Column:
    """Known modalities only; none left means visual."""
    kept = F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda m: m.isin(*known))
    return F.when(F.size(kept) == 0, F.array(F.lit(known[0]))).otherwise(kept)
