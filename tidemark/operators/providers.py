"""The boundary to external models: request rows in, response rows out.

A provider is an object with ``complete(prompts) -> list[str | None]``; it runs inside tasks over Arrow batches. The
recorded provider answers from a table by request hash, so tests and re-runs are deterministic. Requests are keyed by
their hash, answered once, and joined back.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def request_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def recorded(requests: DataFrame, recordings: DataFrame) -> DataFrame:
    """``requests`` (request_hash, ...) with response and ok from ``recordings`` (request_hash, response)."""
    return requests.join(recordings.dropDuplicates(["request_hash"]), "request_hash", "left").withColumn("ok", F.col("response").isNotNull())


# Statuses that no repetition mends, and the longest waits in seconds.
FATAL = (400, 401, 403, 404, 413, 415, 422)
LONGEST_BACKOFF, LONGEST_RETRY_AFTER = 30.0, 60.0


def backoff(attempt: int, retry_after: float | None, share: float) -> float:
    """Seconds before the next try: what the provider asks for, else doubling; ``share`` in [0, 1] spreads tasks apart."""
    if retry_after is not None:
        return min(max(0.0, retry_after), LONGEST_RETRY_AFTER)
    return min(2.0**attempt, LONGEST_BACKOFF) * (0.5 + 0.5 * share)


def complete(requests: DataFrame, make: Callable[[], object], tries: int = 4, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """Answer ``prompt`` of each request by a provider made once a task; failures come back with ok false.

    Open prompts are asked again after ``backoff``. An error with a ``status_code`` in ``FATAL`` ends the tries; one
    with ``retry_after`` says how long to wait.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        for batch in batches:
            answers: list[str | None] = [None] * len(batch)
            for attempt in range(tries):
                open_ = [i for i, a in enumerate(answers) if a is None]
                if not open_:
                    break
                after = None
                try:
                    for i, a in zip(open_, provider.complete([batch["prompt"].iloc[i] for i in open_]), strict=True):
                        answers[i] = a
                except Exception as e:
                    if getattr(e, "status_code", None) in FATAL:
                        break
                    after = getattr(e, "retry_after", None)
                if None in answers and attempt + 1 < tries:
                    wait(backoff(attempt, after, random.random()))
            yield pd.DataFrame({"request_hash": batch["request_hash"], "response": answers, "ok": [a is not None for a in answers]})

    distinct = requests.select("request_hash", "prompt").dropDuplicates(["request_hash"])
    answered = distinct.mapInPandas(run, "request_hash string, response string, ok boolean")
    return requests.join(answered, "request_hash", "left")


def json_body(text: Column) -> Column:
    """The JSON in a model's answer: fenced, whole, the outer object, or the outer array; null without any."""
    tries = (F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*```", 1), F.trim(text), F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.regexp_extract(text, r"(?s)(\[.*\])", 1))
    ok = lambda t: F.when(F.try_parse_json(t).isNotNull() & (t != ""), t)
    return F.coalesce(*map(ok, tries))


def usage(calls: DataFrame) -> DataFrame:
    """Token counts of (client, usage map) summed by key."""
    return calls.select("client", F.explode("usage").alias("kind", "n")).groupBy("client", "kind").agg(F.sum("n").alias("n"))


def gate_loop(requests: DataFrame, answer: Callable[[DataFrame], DataFrame], fault: Column, rounds: int, save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Ask, check, and ask again only for what failed, with the fault added to the first prompt.

    ``answer`` adds ``response`` to rows with ``prompt``; ``fault`` is null for a good row; ``save`` cuts lineage
    between rounds. Rows that fail to the end have a null response and their last fault.
    """
    todo, done = requests.withColumn("first_prompt", F.col("prompt")), None
    for i in range(rounds):
        got = save(answer(todo).withColumn("fault", fault), f"round{i}")
        good = got.where("fault is null")
        done = good if done is None else done.unionByName(good)
        todo = got.where("fault is not null")
        if i + 1 < rounds:
            todo = todo.withColumn("prompt", F.concat_ws("\n", "first_prompt", F.concat(F.lit("Earlier answer failed: "), "fault"))).drop("response", "fault")
    return done.unionByName(todo.withColumn("response", F.lit(None).cast("string"))).drop("first_prompt")


def embed(texts: DataFrame, make: Callable[[], object], column: str = "text") -> DataFrame:
    """``texts`` with ``embedding`` from a provider's ``embed(texts) -> list[list[float]]``, made once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        for batch in batches:
            yield batch.assign(embedding=provider.embed(batch[column].tolist()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    return texts.mapInPandas(run, f"{fields}, embedding array<float>")


def trace(calls: DataFrame) -> DataFrame:
    """Log rows of calls (model, text, images, retries, ok, usage, response): texts as digests, images as a count."""
    return calls.select("model", F.sha2("text", 256).alias("input_hash"), F.size("images").alias("images"), "retries", "ok", "usage", F.left("response", F.lit(200)).alias("out_summary"))
