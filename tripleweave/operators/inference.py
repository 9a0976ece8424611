"""One model call per row, and reading the answers.

The model is a user function; nothing here opens a connection. Filters belong
in front of ``infer``: Spark cannot move them through a Python stage. Put
``sources.storage.stage`` behind it, so that answers are not asked for again
when a later task is lost.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions import json as J
from ..functions.slices import slices
from .triples import has_entities, long_enough

Model = Callable[[list[dict]], str]
ANSWER = pa.struct([("response", pa.string()), ("failure", pa.string())])
#: Bytes of messages that a Python worker holds as objects, unless a single row has more.
CHATS_AT_ONCE = 4 << 20


def call_with_retry(model: Model, messages: list[dict], tries: int, wait: float) -> str:
    """Call until it works, doubling the wait; the last failure is raised."""
    for attempt in range(tries):
        try:
            return model(messages)
        except Exception:
            if attempt + 1 >= tries:
                raise
            time.sleep(wait * 2**attempt)
    raise ValueError("tries must be positive")


def chat_bytes(chats: pa.Array) -> np.ndarray:
    """Bytes of the messages of each row; none of a null."""
    offsets = np.asarray(chats.offsets).astype(np.int64)
    content = chats.values.field("content")
    sums = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.binary_length(content), 0)).astype(np.int64))))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def infer(
    df: DataFrame,
    load: Callable[[], Model],
    messages: str = "messages",
    tries: int = 5,
    wait: float = 1.0,
    on_error: str = "raise",
    default: str | None = None,
    at_once: int = 1,
) -> DataFrame:
    """Add ``response`` and ``failure``; ``load`` builds the client once per worker.

    A worker runs up to ``at_once`` calls at a time (the client must allow
    it); answers keep the order of their rows. With ``raise`` the first
    failure ends the task, and calls not begun by then are not made.

    ``on_error``: ``raise`` fails the task, ``default`` answers with
    ``default``, ``record`` keeps the row with the message in ``failure``.
    """
    if on_error not in ("raise", "default", "record"):
        raise ValueError(f"unknown on_error: {on_error}")
    if at_once < 1:
        raise ValueError("at_once must be positive")

    def ask(model: Model, chat) -> dict:
        if chat is None:
            return {"response": None, "failure": None}
        try:
            turns = [{"role": m["role"], "content": m["content"]} for m in chat]
            return {"response": call_with_retry(model, turns, tries, wait), "failure": None}
        except Exception as error:
            if on_error == "raise":
                raise
            if on_error == "default":
                return {"response": default, "failure": None}
            return {"response": None, "failure": str(error)}

    @F.arrow_udf("struct<response:string,failure:string>")
    def answers(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                for part in slices(batch, chat_bytes(batch), CHATS_AT_ONCE):
                    calls = [pool.submit(ask, model, chat) for chat in part.to_pylist()]
                    try:
                        yield pa.array([c.result() for c in calls], ANSWER)
                    finally:
                        for c in calls:
                            c.cancel()

    # one call per row, even if a later step uses the answer twice
    asked = df.withColumn("_answer", answers.asNondeterministic()(F.col(messages)))
    return asked.withColumns({"response": F.col("_answer.response"), "failure": F.col("_answer.failure")}).drop("_answer")


def prefilter_short_text(df: DataFrame, text: str = "text", least: int = 5) -> DataFrame:
    """Drop texts below ``least`` characters."""
    return df.filter(long_enough(F.col(text), least))


def prefilter_has_entities(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Drop records without any entity."""
    return df.filter(has_entities(F.col(entities)))


def parse_entities(df: DataFrame, mode: str = "strict", raw: str = "response") -> DataFrame:
    """Answers to ``entities`` (map), ``error`` and ``raw``.

    ``strict`` keeps a failure as error and raw text; ``lenient`` turns any
    empty result into the categories with empty lists.
    """
    if mode == "strict":
        parsed = df.withColumn("_value", J.parse_object_strict(F.col(raw)))
        failed = F.col("_value").isNull()
        return parsed.withColumns({
            "entities": J.entity_map(F.col("_value")),
            "error": F.when(failed, F.lit("no JSON in the response")),
            "raw": F.when(failed, F.col(raw)),
        }).drop("_value")
    empty = F.create_map(*[x for c in L.CATEGORIES for x in (F.lit(c), F.array().cast("array<string>"))])
    parsed = df.withColumn("_value", J.parse_object_lenient(F.col(raw)))
    filled = F.when(J.is_falsy(F.col("_value")), empty).otherwise(J.entity_map(F.col("_value")))
    none = F.lit(None).cast("string")
    return parsed.withColumns({"entities": F.coalesce(filled, empty), "error": none, "raw": none}).drop("_value")


def parse_triplets(df: DataFrame, mode: str = "strict", raw: str = "response") -> DataFrame:
    """Answers to ``triplets`` (VARIANT), ``error`` and ``raw``."""
    value = (J.parse_array_strict if mode == "strict" else J.parse_array_lenient)(F.col(raw))
    parsed = df.withColumn("triplets", value)
    failed = F.col("triplets").isNull()
    return parsed.withColumns({
        "error": F.when(failed, F.lit("no JSON array in the response")),
        "raw": F.when(failed, F.col(raw)),
    })
