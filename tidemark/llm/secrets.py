"""Secret scan with an assignment-aware lexer.

Three base patterns are matched as they stand. Beside them a lexer reads assignments of source and configuration
syntax (``name = "literal"``, ``name: literal``, ``"name": "literal"``, ``name := 'literal'``, ``export NAME=literal``,
typed assignments, subscripts, strings with prefixes or triple quotes, brackets, lists, continued lines, defaults of
environment lookups, attributes and elements of markup, ``key``/``name`` attributes beside a ``value``, block scalars)
into name-literal pairs, propagates constants (a name assigned from other names and literals, joined by ``+``), and
scores a literal by how sensitive the names are that it reaches and by its own make-up, from its first character to its
last. A key that only says ``value`` or the like is named with what it stands in: an object, a block, a section. Only a bare word is ever a name on the right: what
stands in quotes is a literal. A pair at or over ``LEAST_SCORE`` adds a span of kind ``lexed``; base spans always stay.

Scale: one scan, row by row, no shuffle; the scan is linear in the text and holds one text.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "lexed")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: An assignment: the name, the operator, and what stands on its right up to the line's end.
_PAIR = re.compile(r"(?:^|(?<=[^A-Za-z0-9_.$-]))[\"']?([A-Za-z_$][A-Za-z0-9_.$-]*+)[\"']?[ \t]*(?::=|=>|=(?!=)|:(?!:))[ \t]*")
_STRING = re.compile(r"\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`")
_BARE = re.compile(r"[^\s,;#\"'`)}\]&|<>(]+")
_NAME = re.compile(r"[$]?\{?([A-Za-z_][A-Za-z0-9_.-]*)\}?$")
_PLUS = re.compile(r"[ \t]*\+(?!=)[ \t]*(?:\\?\n[ \t]*)?")
#: After a colon: a type and an equals sign that begins a value.
_TYPED = re.compile(r"[A-Za-z_][A-Za-z0-9_.?\[\]<>]*+(?:[ \t]*[|,][ \t]*[A-Za-z_][A-Za-z0-9_.?\[\]<>]*+)*(?:[ \t]+=(?![=>~])[ \t]*|=[ \t]*(?=[rbfuRBFU]{0,2}[\"'`]))")
_SUBSCRIPT = re.compile(r"\[[ \t]*[\"']([A-Za-z_$][A-Za-z0-9_.$-]*+)[\"'][ \t]*\][ \t]*(?::=|=(?![=>~]))[ \t]*")
_PREFIX = re.compile(r"(?:[rRbBfFuU]{1,2}|[@$L])(?=[\"'`])")
_CONTINUED = re.compile(r"\\\n[ \t]*")
_OPEN = re.compile(r"[(\[][ \t\n]*")
_COMMA = re.compile(r"[ \t\n]*,[ \t\n]*")
_GAP = re.compile(r"[ \t\n]*")
#: A lookup with a name and a default, and an expression with a default behind it.
_LOOKUP = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*+\([ \t\n]*(?:\"([^\"\n]*)\"|'([^'\n]*)')[ \t\n]*,[ \t\n]*(?=[rbfuRBFU]{0,2}[\"'`])")
_LOOKING = re.compile(r"(?i)(?:getenv|get|getordefault|getenvironmentvariable|env|config)$")
_OTHERWISE = re.compile(r"(?:\([^()\n]*\))?[ \t]*(?:\|\||\?\?|\?:|\bor\b)[ \t]*(?=[rbfuRBFU]{0,2}[\"'`])")
#: Names that tell nothing of what they hold, and what can stand around them.
GENERIC = frozenset(("value", "val", "default", "data", "content", "text", "raw", "string", "plain"))
_ANY_GENERIC = re.compile(r"(?i)(?<![A-Za-z0-9_.$-])(?:" + "|".join(sorted(GENERIC)) + r")(?![A-Za-z0-9_.$-])")
_BRACES = re.compile(r"(?<![A-Za-z0-9_.$-])[\"']?([A-Za-z_$][A-Za-z0-9_.$-]*+)[\"']?[ \t]*+(?::|=>?)[ \t]*+\{|[{}]")
_HEADER = re.compile(r"[ \t]*\[[ \t]*([A-Za-z_][A-Za-z0-9_. :-]*+)\][ \t]*$")
_KEY_LINE = re.compile(r"( *)(?:- +)?[\"']?([A-Za-z_][A-Za-z0-9_.-]*+)[\"']?:[ \t]*$")
_TAG = re.compile(r"<[A-Za-z][^<>\n]*>")
_ATTRIBUTE = re.compile(r"(?<![A-Za-z0-9_.:-])([A-Za-z_][A-Za-z0-9_.:-]*+)[ \t]*=[ \t]*(?:\"([^\"\n]*)\"|'([^'\n]*)')")
_ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:-]*+)>([^<>\n]+)</\1>")
_SCALAR = re.compile(r"[|>][+-]?[1-9]?[+-]?[ \t]*(?=\n)")

#: Words in a name, with the weight that they give a literal assigned to it.
SENSITIVE = (
    ("password", 1.0), ("passwd", 1.0), ("passphrase", 1.0), ("pwd", 0.8), ("secret", 1.0), ("token", 0.9), ("apikey", 1.0), ("privatekey", 1.0),
    ("accesskey", 0.9), ("credential", 0.8), ("auth", 0.6), ("bearer", 0.8), ("signature", 0.6), ("salt", 0.5), ("key", 0.4), ("pin", 0.4),
)
LEAST_SCORE = 0.55
#: Above this strength a literal of mixed characters lifts the weight of its name, in proportion up to one.
LIFTED = 0.85
#: Whole texts, and beginnings, of what stands for a secret that isn't there.
PLACEHOLDERS = frozenset(("changeme", "example", "none", "null", "true", "false"))
LEADING = ("your-", "your_", "your ", "<", "$")


def sensitivity(name: str) -> float:
    """0 to 1 by the most sensitive word of a name; camel case, underscores, dots and dashes are ignored."""
    flat = re.sub(r"[^a-z]", "", name.lower())
    parts = set(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name).lower()))
    return max((w for word, w in SENSITIVE if (word in flat if len(word) > 4 else word in parts)), default=0.0)


class Made:
    """What a value is made of: its length, its characters and how often each stands in it, and its two ends. All of these
    add up, so a value made of others is scored whole, however long it has become."""

    __slots__ = ("size", "counts", "head", "tail")

    def __init__(self, text: str = ""):
        self.size, self.counts, self.head, self.tail = len(text), Counter(text), text[:9], text[-1:]

    def add(self, other: Made) -> None:
        self.head = self.head if self.size >= 9 else (self.head + other.head)[:9]
        self.tail = other.tail or self.tail
        self.size += other.size
        for c, n in other.counts.items():
            self.counts[c] += n

    def placeholder(self) -> bool:
        kinds = set(self.counts) - {"\n"}
        if kinds and (kinds <= {"x", "X"} or kinds == {"*"} or kinds == {"."}):
            return True
        low = self.head.lower()
        return (self.size <= 9 and low.strip("\n") in PLACEHOLDERS) or (low.startswith(LEADING) and self.counts.get("\n", 0) <= (self.tail == "\n"))


def _strength(made: Made) -> float:
    if made.size < 6 or made.placeholder():
        return 0.0
    entropy = -sum(p * math.log2(p) for n in made.counts.values() if (p := n / made.size) > 0)
    kinds = sum(any(map(test, made.counts)) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, min(made.size, 20) / 20) * 0.4 + min(1.0, entropy / 4) * 0.4 + min(1.0, kinds / 3) * 0.2 - (0.3 if made.counts.get(" ") else 0)


def strength(literal: str) -> float:
    """0 to 1 by length, entropy a character, and kinds of characters."""
    return _strength(Made(literal))


def _score(weight: float, made: Made) -> float:
    s = _strength(made)
    mixed = sum(any(map(test, made.counts)) for test in (str.islower, str.isupper, str.isdigit)) > 1
    lift = max(0.0, s - LIFTED) / (1 - LIFTED) if mixed else 0.0
    return weight * s + (1 - weight) * lift * s


def score(weight: float, literal: str) -> float:
    """Weight times strength, and for strong literals of two kinds of letters and digits a part of the missing weight."""
    return _score(weight, Made(literal))


Term = tuple[int, int, str, bool]  # start, end, content, whether it stood in quotes


def _string(text: str, at: int) -> tuple[Term, int] | None:
    """The string literal at ``at``, with its prefix and any quotes, and where it ends."""
    if p := _PREFIX.match(text, at):
        at = p.end()
    if text.startswith(('"""', "'''"), at):
        end = text.find(text[at : at + 3], at + 3)
        return ((at + 3, end, text[at + 3 : end], True), end + 3) if end >= 0 else None
    if s := _STRING.match(text, at):
        k = s.lastindex
        return (s.start(k), s.end(k), s[k], True), s.end()
    return None


def _terms(text: str, at: int, closing: str = "") -> tuple[list[Term], int]:
    """The literals and bare words of an expression that begins at ``at``, joined by plus signs, and where it ends; inside
    brackets strings that follow each other are joined as well."""
    out: list[Term] = []
    while True:
        if c := _CONTINUED.match(text, at):
            at = c.end()
        if s := _string(text, at):
            out.append(s[0])
            at = s[1]
        elif text.startswith("(", at) and not closing:
            inner, end = _terms(text, _OPEN.match(text, at).end(), ")")
            out += inner
            at = _GAP.match(text, end).end() if inner else end
            at += text.startswith(")", at)
        elif b := _BARE.match(text, at):
            if otherwise := _OTHERWISE.match(text, b.end()):
                at = otherwise.end()
                continue
            call = text[b.end() : b.end() + 1] == "(" or b[0][-1] in "[{"
            out.append((b.start(), b.end(), "" if call else b[0], False))
            at = b.end()
        else:
            return out, at
        if closing:
            gap = _GAP.match(text, at).end()
            if _string(text, gap):
                at = gap
                continue
        plus = _PLUS.match(text, at)
        if not plus:
            return out, at
        at = plus.end()


def _values(text: str, at: int) -> tuple[list[tuple[str, list[Term]]], int]:
    """The values of a right side at ``at``, each with the name that it brings along or '', and where they end: one, or
    every element of a list. A lookup's default is a value by the name looked up, too."""
    if c := _CONTINUED.match(text, at):
        at = c.end()
    if (look := _LOOKUP.match(text, at)) and _LOOKING.search(text, look.start(), text.index("(", look.start())):
        if s := _string(text, look.end()):
            return [(look[look.lastindex], [s[0]]), ("", [s[0]])], s[1]
    if not text.startswith("[", at):
        terms, end = _terms(text, at)
        return ([("", terms)] if terms else []), end
    out = []
    at = _OPEN.match(text, at).end()
    while s := _string(text, at):
        out.append(("", [s[0]]))
        at = s[1]
        if not (comma := _COMMA.match(text, at)):
            break
        at = comma.end()
    return out, at


class Surroundings:
    """What a place stands in: the named object, block or section. Found in one pass over the text, if it is asked for."""

    def __init__(self, text: str):
        self.at, self.named = [0], [""]
        if not _ANY_GENERIC.search(text):
            return
        marks: list[tuple[int, str]] = []
        stack: list[str] = []
        for m in _BRACES.finditer(text):
            if m[0][-1] == "{":
                stack.append(m[1] or (stack[-1] if stack else ""))
            elif stack:
                stack.pop()
            marks.append((m.end(), stack[-1] if stack else ""))
        lines: list[tuple[int, str]] = []
        section, blocks, begin = "", [], 0
        for line in text.split("\n"):
            if header := _HEADER.match(line):
                section, blocks = header[1], []
            elif line.strip():
                indent = len(line) - len(line.lstrip(" "))
                while blocks and blocks[-1][0] >= indent:
                    blocks.pop()
                lines.append((begin, blocks[-1][1] if blocks else section))
                if key := _KEY_LINE.match(line):
                    blocks.append((indent, key[2]))
            begin += len(line) + 1
        self.braces = ([0] + [m[0] for m in marks], [""] + [m[1] for m in marks])
        self.at, self.named = [0] + [x[0] for x in lines], [""] + [x[1] for x in lines]

    def name(self, name: str, at: int) -> str:
        if name.lower() not in GENERIC or len(self.at) == 1:
            return name
        around = self.braces[1][bisect_right(self.braces[0], at) - 1] or self.named[bisect_right(self.at, at) - 1]
        return f"{around}.{name}" if around else name


def _block(text: str, at: int, end: int) -> tuple[int, int, str] | None:
    """The block scalar after a ``|`` or ``>`` that ends a line at ``end``; its key stands at ``at``: the deeper lines."""
    indent = at - (text.rfind("\n", 0, at) + 1)
    lines, lo, hi = [], None, end
    while (begin := hi + 1) <= len(text):
        stop = text.find("\n", begin)
        stop = len(text) if stop < 0 else stop
        line = text[begin:stop]
        depth = len(line) - len(line.lstrip(" "))
        if line.strip(" ") and depth <= indent:
            break
        if line.strip(" "):
            lo = begin + depth if lo is None else lo
            lines.append((line.strip(), begin + depth + len(line.strip())))
        hi = stop
    return (lo, lines[-1][1], "".join(x for x, _ in lines)) if lines else None


def pairs(text: str) -> list[tuple[str, list[Term]]]:
    """(name, terms of its value) of every assignment, in the order of the names."""
    out, inside = [], 0
    tags = {}  # place of an attribute named key or name: nothing, or the pair that its tag makes
    if "<" in text:
        for tag in _TAG.finditer(text):
            attributes = {m[1].lower(): m for m in _ATTRIBUTE.finditer(text, *tag.span())}
            named = attributes.get("key") or attributes.get("name")
            if named and (value := attributes.get("value")):
                k, v = named.lastindex, value.lastindex
                tags[named.start(1)], tags[value.start(1)] = None, (named[k], [(value.start(v), value.end(v), value[v], True)])
        out += [(m.start(), m[1], [(m.start(2), m.end(2), m[2], True)]) for m in _ELEMENT.finditer(text)]
    for m in _PAIR.finditer(text):
        if m.start(1) < inside:
            continue
        if m.start(1) in tags:
            if pair := tags[m.start(1)]:
                out.append((m.start(), *pair))
            continue
        scalar = _SCALAR.match(text, m.end())
        if scalar:
            if block := _block(text, m.start(), scalar.end()):
                inside = block[1]
                out.append((m.start(), m[1], [(*block, True)]))
            continue
        typed = _TYPED.match(text, m.end()) if m[0].rstrip(" \t").endswith(":") else None
        values, end = _values(text, typed.end() if typed else m.end())
        out += [(m.start(), name or m[1], terms) for name, terms in values]
        if len(values) > 1 or any("\n" in t[2] for _, terms in values for t in terms if t[3]):
            inside = end
    if "]" in text:
        for m in _SUBSCRIPT.finditer(text):
            values, _ = _values(text, m.end())
            out += [(m.start(), name or m[1], terms) for name, terms in values]
    around = Surroundings(text)
    return [(around.name(name, at), terms) for at, name, terms in sorted(out, key=lambda x: x[0])]


class Value:
    """What an expression stands for: its literals, shared with the constants that it was made of, and its make-up."""

    __slots__ = ("parts", "made", "told")

    def __init__(self, parts: list, made: Made):
        self.parts, self.made, self.told = parts, made, 0.0

    def literals(self, got: float) -> Iterator[tuple[int, int]]:
        """Places of the literals that weren't told with a score of ``got`` or more; they count as told."""
        open_ = [self]
        while open_:
            value = open_.pop()
            if value.told < got:
                value.told = got
                for part in value.parts:
                    if isinstance(part, Value):
                        open_.append(part)
                    else:
                        yield part


def resolved(terms: list[Term], constants: dict[str, Value]) -> Value | None:
    """The value of a right side; quoted literals that follow each other are one.

    A bare word that is a constant stands for its literals. Any other is a literal where it stands alone, and unknown,
    like the result of a call, in a sum.
    """
    parts: list = []
    made = Made()
    was_quoted = False
    for lo, hi, value, quoted in terms:
        if quoted:
            if was_quoted:
                parts[-1] = (parts[-1][0], hi)
            else:
                parts.append((lo, hi))
            made.add(Made(value))
        else:
            names = [m[1] if (m := _NAME.match(v)) else "" for v in value.split("+")]
            if all(n in constants for n in names):
                parts += [constants[n] for n in names]
                for n in names:
                    made.add(constants[n].made)
            elif len(terms) == 1 and value:
                parts.append((lo, hi))
                made.add(Made(value))
        was_quoted = quoted
    return Value(parts, made) if parts else None


def lexed(text: str) -> list[tuple[int, int, str, str, float]]:
    """(start, end, name, text, score) of the literals whose score is enough.

    A value is what its literals give together; it is scored by every name it reaches, and each of its literals is told
    once, by its best score. A name that is assigned anew stands for its last value.
    """
    if "=" not in text and ":" not in text and "<" not in text:
        return []
    constants: dict[str, Value] = {}
    best: dict[tuple[int, int], tuple[str, str, float]] = {}
    for name, terms in pairs(text):
        value = resolved(terms, constants)
        if value is None:
            constants.pop(name, None)
            continue
        constants[name] = value
        if w := sensitivity(name):
            got = _score(w, value.made)
            if got >= LEAST_SCORE:
                for place in value.literals(got):
                    if got > best.get(place, ("", "", 0.0))[2]:
                        best[place] = (name, text[slice(*place)], got)
    return [(a, b, *rest) for (a, b), rest in sorted(best.items())]


def base(text: str) -> list[tuple[str, int, int]]:
    """Base spans of the three patterns: (kind, start, end)."""
    out = []
    if any(w in low for low in (text.lower(),) for w in _WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, digest, told = [], [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            found, more = base(text), lexed(text)
            digest.append(hashlib.sha256(joined(found).encode()).hexdigest())
            told.append(joined(found + [("lexed", a, b) for a, b, *_ in more]))
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found] + [{"kind": "lexed", "start": a, "end": b, "name": n, "score": s} for a, b, n, _, s in more])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _TYPE), pa.array(digest), pa.array(told)], ["id", "found", "base_sha256", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id, found (kind, start, end, and for lexed spans name and score), base_sha256, spans.

    Offsets are code points, ends exclusive; a base span is the whole match. Null and empty texts have none; repeated
    rows and rows without an id are scanned like any other; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(_scan, f"id {kind}, found array<struct<kind: string, start: bigint, end: bigint, name: string, score: double>>, base_sha256 string, spans string")


def op7_assignment_secrets(spark, sf_dir: str) -> DataFrame:
    """The contract's columns over every whole text of ``documents``, with the number of lexed spans."""
    n = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"), "base_sha256", "spans", n("lexed").alias("n_lexed"))
