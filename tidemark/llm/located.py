"""Rows by their place in files: a locator that is unique by construction, and lookups by it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

#: Up to this many locators are broadcast, as two 64-bit hashes each; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def _one_row_each(docs: DataFrame) -> bool:
    """Whether ``docs`` only selects, filters and renames the rows of files, none of them read twice."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation" or not hasattr(plan.relation(), "location"):
        return False
    paths = plan.relation().location().rootPaths()
    return paths.size() == paths.distinct().size()


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def integer_ids(docs: DataFrame, id_col: str) -> None:
    """Refuse an id column of any type but the integer ones."""
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{id_col} must be an integer column")


def located(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns, and their names: the file of each row and its number in that file.

    A frame whose rows aren't those of files one by one (a join, a union, an explode, rows made in memory) is written
    to the scratch folder first, so no two rows share a locator.
    """
    if not _one_row_each(docs):
        docs = scratch.save(docs, "content")
    file, at = unused(docs, "__file"), unused(docs, "__at")
    place = docs.metadataColumn("_metadata")
    return docs.withColumns({file: place["file_path"], at: place["row_index"]}), file, at


def _hashes(file: str, at: str) -> list[Column]:
    return [F.xxhash64(file, at).alias("__k1"), F.xxhash64(at, F.lit(1), file).alias("__k2")]


def picked(docs: DataFrame, wanted: DataFrame, how: str = "inner") -> DataFrame:
    """Join (inner or left_semi) of ``docs`` with a saved table ``wanted``, both with (file, at).

    Up to ``BROADCAST_ROWS`` wanted rows are broadcast by 128 bits of hashes, so that ``docs`` doesn't move and no path
    is held; beyond that bound both sides are shuffled by the locator itself.
    """
    if wanted.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return docs.join(wanted, ["file", "at"], how)
    rest = [c for c in wanted.columns if c not in ("file", "at")]
    small = F.broadcast(wanted.select(*_hashes("file", "at"), *rest))
    return docs.select("*", *_hashes("file", "at")).join(small, ["__k1", "__k2"], how).drop("__k1", "__k2")


def without(docs: DataFrame, file: str, at: str, gone: DataFrame) -> DataFrame:
    """``docs`` as ``located`` gives it, without the rows of the saved table ``gone`` (file, at) and without locators."""
    gone = gone.select(F.col("file").alias(file), F.col("at").alias(at))
    names = [c for c in docs.columns if c not in (file, at)]
    if gone.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return docs.join(gone, [file, at], "left_anti").select(*names)
    small = F.broadcast(gone.select(*_hashes(file, at)))
    one, other = _hashes(file, at)
    return docs.join(small, (one == small["__k1"]) & (other == small["__k2"]), "left_anti").select(*names)
