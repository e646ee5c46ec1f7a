"""Nested documents by their schema: validation compiled from a JSON Schema, and rewrites by recursion over Spark types."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR = "array<struct<depth: int, path: string, message: string>>"
KNOWN = {
    "$ref", "type", "required", "properties", "items", "enum", "const", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minItems", "maxItems", "minLength", "maxLength", "allOf", "anyOf", "if", "then", "else",
}
IGNORED = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples", "format"}


def _none() -> Column:
    return F.array().cast(ERROR)


def _error(bad: Column, path: Column, depth: int, message: Column) -> Column:
    """One error where ``bad`` holds, else none."""
    where = F.when(path == "", "<root>").otherwise(path)
    return F.when(F.coalesce(bad, F.lit(False)), F.array(F.struct(F.lit(depth).alias("depth"), where.alias("path"), message.alias("message"))).cast(ERROR)).otherwise(_none())


def _all(parts: list[Column]) -> Column:
    parts = [p for p in parts if p is not None]
    return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else _none()


def _shown(value: Column, kind: T.DataType) -> Column:
    """A value as messages show it."""
    if isinstance(kind, T.StringType):
        return F.concat(F.lit("'"), value, F.lit("'"))
    return value.cast("string") if not isinstance(kind, T.ArrayType | T.StructType | T.MapType) else F.to_json(value)


def _is(kind: T.DataType, value: Column, name: str) -> Column | bool:
    """Whether a value of a Spark type is of a JSON type."""
    number = isinstance(kind, T.NumericType)
    if name == "integer" and isinstance(kind, T.FractionalType):
        return value == F.floor(value)
    return {
        "object": isinstance(kind, T.StructType | T.MapType), "array": isinstance(kind, T.ArrayType), "string": isinstance(kind, T.StringType | T.DateType | T.TimestampType), "boolean": isinstance(kind, T.BooleanType),
        "number": number, "integer": isinstance(kind, T.IntegralType), "null": isinstance(kind, T.NullType),
    }[name]


class Compiler:
    """Turns a JSON Schema into one expression of errors over a column of a Spark type.

    A field that is null, or that the type hasn't, is missing. Keywords outside ``KNOWN`` and ``IGNORED`` are refused, so
    no rule is passed over.
    """

    def __init__(self, schema: dict):
        self.root = schema

    def resolved(self, schema: dict) -> dict:
        while "$ref" in schema:
            rest = {k: v for k, v in schema.items() if k != "$ref"}
            schema = rest | reduce(lambda at, key: at[key], schema["$ref"].removeprefix("#/").split("/"), self.root)
        return schema

    def errors(self, schema: dict, value: Column, kind: T.DataType, path: Column, depth: int = 0) -> Column:
        """The errors of a value that isn't null; of a null one, those of a missing element are told by its parent."""
        schema = self.resolved(schema)
        if odd := set(schema) - KNOWN - IGNORED:
            raise ValueError(f"keywords without an expression: {sorted(odd)}")
        fail = lambda bad, *text: _error(bad, path, depth, F.concat(*(F.lit(t) if isinstance(t, str) else t for t in text)))
        shown, parts = _shown(value, kind), []
        if "type" in schema:
            names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            fits = [_is(kind, value, n) for n in names]
            if not any(f is True for f in fits):
                right = reduce(lambda a, b: a | b, [f for f in fits if not isinstance(f, bool)], F.lit(False))
                parts.append(fail(~right, shown, " is not of type ", ", ".join(f"'{n}'" for n in names)))
        text, number = isinstance(kind, T.StringType), isinstance(kind, T.NumericType)
        if "enum" in schema:
            parts.append(fail(~self.equal_to_any(value, kind, schema["enum"]), shown, f" is not one of {json.dumps(schema['enum'], ensure_ascii=False)}"))
        if "const" in schema:
            parts.append(fail(~self.equal_to_any(value, kind, [schema["const"]]), f"{json.dumps(schema['const'], ensure_ascii=False)} was expected"))
        if "pattern" in schema and text:
            parts.append(fail(~value.rlike(schema["pattern"]), shown, f" does not match '{schema['pattern']}'"))
        for word, bad, told in (("minLength", lambda n: F.char_length(value) < n, "is too short"), ("maxLength", lambda n: F.char_length(value) > n, "is too long")):
            if word in schema and text:
                parts.append(fail(bad(schema[word]), shown, f" {told}"))
        limits = (
            ("minimum", lambda n: value < n, "less than the minimum of"), ("maximum", lambda n: value > n, "greater than the maximum of"),
            ("exclusiveMinimum", lambda n: value <= n, "less than or equal to the minimum of"), ("exclusiveMaximum", lambda n: value >= n, "greater than or equal to the maximum of"),
        )
        for word, bad, told in limits:
            if word in schema and number:
                parts.append(fail(bad(schema[word]), shown, f" is {told} {schema[word]}"))
        if isinstance(kind, T.StructType):
            parts += self.fields(schema, value, kind, path, depth)
        if isinstance(kind, T.ArrayType):
            for word, bad, told in (("minItems", lambda n: F.size(value) < n, "is too short"), ("maxItems", lambda n: F.size(value) > n, "is too long")):
                if word in schema:
                    parts.append(fail(bad(schema[word]), shown, f" {told}"))
            if "items" in schema:
                parts.append(F.flatten(F.transform(value, lambda x, i: self.element(schema["items"], x, kind.elementType, self.under(path, i.cast("string")), depth + 1))))
        for part in schema.get("allOf", ()):
            parts.append(self.errors(part, value, kind, path, depth))
        if "anyOf" in schema:
            each = [F.size(self.errors(part, value, kind, path, depth)) > 0 for part in schema["anyOf"]]
            parts.append(fail(reduce(lambda a, b: a & b, each), shown, " is not valid under any of the given schemas"))
        if "if" in schema:
            holds = F.size(self.errors(schema["if"], value, kind, path, depth)) == 0
            then, other = (self.errors(schema[w], value, kind, path, depth) if w in schema else _none() for w in ("then", "else"))
            parts.append(F.when(holds, then).otherwise(other))
        return F.when(value.isNull(), _none()).otherwise(_all(parts))

    @staticmethod
    def under(path: Column, name: Column | str) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        return F.when(path == "", name).otherwise(F.concat(path, F.lit("/"), name))

    @staticmethod
    def equal_to_any(value: Column, kind: T.DataType, allowed: list) -> Column:
        numbers = [a for a in allowed if isinstance(a, int | float) and not isinstance(a, bool)]
        fitting = {T.StringType: [a for a in allowed if isinstance(a, str)], T.BooleanType: [a for a in allowed if isinstance(a, bool)]}.get(type(kind), numbers if isinstance(kind, T.NumericType) else [])
        return value.isin(fitting) if fitting else F.lit(False)

    def element(self, schema: dict, value: Column, kind: T.DataType, path: Column, depth: int) -> Column:
        """An element of an array, where null is a value."""
        names = self.resolved(schema).get("type", "null")
        nulls = "null" in ([names] if isinstance(names, str) else names)
        bad = F.lit(False) if nulls else value.isNull()
        return F.concat(_error(bad, path, depth, F.lit(f"null is not of type {names!r}")), self.errors(schema, value, kind, path, depth))

    def fields(self, schema: dict, value: Column, kind: T.StructType, path: Column, depth: int) -> list[Column]:
        types = {f.name: f.dataType for f in kind.fields}
        out = []
        for name in schema.get("required", ()):
            gone = value[name].isNull() if name in types else F.lit(True)
            out.append(_error(gone, path, depth, F.lit(f"'{name}' is a required property")))
        for name, rule in schema.get("properties", {}).items():
            if name in types:
                out.append(self.errors(rule, value[name], types[name], self.under(path, name), depth + 1))
        return out


def validated(documents: DataFrame, schema: dict) -> DataFrame:
    """``documents`` with ``errors`` (depth, path, message), in the order of the schema, ``schema_valid``, and
    ``schema_error``: ``path: message`` of the first of the least deep errors, at most 300 characters, or an empty text.

    The rules are one expression over the nested columns: nothing is collected, and nothing leaves the JVM.
    """
    row = F.struct(*(F.col(c) for c in documents.columns))
    found = Compiler(schema).errors(schema, row, documents.schema, F.lit(""))
    out = documents.withColumn("errors", found)
    least = F.array_min(F.transform("errors", lambda e: e["depth"]))
    first = F.filter("errors", lambda e: e["depth"] == least)[0]
    text = F.when(F.size("errors") > 0, F.left(F.concat(first["path"], F.lit(": "), first["message"]), F.lit(300))).otherwise("")
    return out.withColumn("schema_valid", F.size("errors") == 0).withColumn("schema_error", text)


def loaded(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _public(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        kept = [_public(value[f.name], f.dataType).alias(f.name) for f in kind.fields if not f.name.startswith("_")]
        return F.when(value.isNotNull(), F.struct(*kept)) if kept else value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _public(x, kind.elementType)) if _has_private(kind.elementType) else value
    if isinstance(kind, T.MapType):
        value = F.map_filter(value, lambda k, _: ~k.startswith("_")) if isinstance(kind.keyType, T.StringType) else value
        return F.transform_values(value, lambda _, v: _public(v, kind.valueType)) if _has_private(kind.valueType) else value
    return value


def _has_private(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(f.name.startswith("_") or _has_private(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_private(kind.elementType)
    return isinstance(kind, T.MapType)


def public(documents: DataFrame) -> DataFrame:
    """``documents`` without fields and map keys that begin with ``_``, at every depth. Null structs and arrays stay null;
    a struct with nothing but such fields stays as it is, since Spark has no empty struct."""
    kept = [f for f in documents.schema.fields if not f.name.startswith("_")]
    return documents.select(*(_public(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if _has_private(f.dataType) else F.col(f"`{f.name}`") for f in kept))


def _with(documents: DataFrame, name: str, **fields: Column) -> Column:
    """The struct ``name`` with fields replaced or added; unknown ones stay. A missing or null struct has only these."""
    fresh = F.struct(*(c.alias(k) for k, c in fields.items()))
    if name.split(".")[-1] not in _names(documents, name):
        return fresh
    out = F.col(name)
    kind = _kind(documents, name)
    blank = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields))
    out = F.coalesce(out, blank)
    for k, c in fields.items():
        out = out.withField(f"`{k}`", c)
    return out


def _kind(documents: DataFrame, name: str) -> T.DataType:
    return reduce(lambda kind, part: kind[part].dataType, name.split("."), documents.schema)


def _names(documents: DataFrame, name: str) -> list[str]:
    """The fields beside ``name``, none if its parent is missing."""
    kind: T.DataType = documents.schema
    for part in name.split(".")[:-1]:
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return []
        kind = kind[part].dataType
    return kind.names if isinstance(kind, T.StructType) else []


def described(documents: DataFrame, answers: DataFrame) -> DataFrame:
    """Read ``documents`` with a description of ``answers`` written into them, as drafts; all other fields stay.

    ``answers``: video_id, segments, detailed, quiet (array), shot_ok, shot_total, full_len_zh, lang_issues (array). They
    become structure.segments, global.detailed_description, annotation_meta.stats (quiet_segments, shot_desc_ok,
    full_len_zh), a todo for each issue after those that stand there, and review_status draft. A document without an
    answer stays as it is but for fields that its type didn't have, which are null.
    """
    own = documents.columns
    given = answers.select("video_id", F.struct(*(c for c in answers.columns if c != "video_id")).alias("__a"))
    out = documents.join(given, "video_id", "left")
    a, met = F.col("__a"), F.col("__a").isNotNull()
    old = lambda name: F.col(name) if name.split(".")[-1] in _names(documents, name) else F.lit(None)
    pick = lambda new, name: F.when(met, new).otherwise(old(name))
    structure = _with(documents, "structure", segments=pick(a["segments"], "structure.segments"))
    whole = _with(documents, "global", detailed_description=pick(a["detailed"], "global.detailed_description"))
    stats_at = "annotation_meta.stats"
    stats = _with(
        documents, stats_at, quiet_segments=pick(a["quiet"], f"{stats_at}.quiet_segments"), full_len_zh=pick(a["full_len_zh"], f"{stats_at}.full_len_zh"),
        shot_desc_ok=pick(F.concat_ws("/", a["shot_ok"].cast("string"), a["shot_total"].cast("string")), f"{stats_at}.shot_desc_ok"),
    )
    todo_at = "annotation_meta.human_todo"
    held = _kind(documents, todo_at).elementType if "human_todo" in _names(documents, todo_at) else T.StructType.fromDDL("kind string, reason string")
    entry = lambda issue: F.struct(*({"kind": F.lit("lang_issue"), "reason": issue}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in held.fields))
    none = F.array().cast(T.ArrayType(held))
    todos = F.concat(F.coalesce(old(todo_at).cast(T.ArrayType(held)), none), F.transform(F.coalesce(a["lang_issues"], F.array().cast("array<string>")), entry))
    meta = _with(documents, "annotation_meta", review_status=pick(F.lit("draft"), "annotation_meta.review_status"), stats=stats, human_todo=todos)
    made = {"structure": structure, "global": whole, "annotation_meta": meta}
    return out.select(*(made.pop(c).alias(c) if c in made else F.col(c) for c in own), *(c.alias(n) for n, c in list(made.items())))
