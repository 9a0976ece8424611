"""Chat messages as array<struct<role, content>> columns."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lexicon as L
from .json import json_string, python_json


def fill(template: str, **values: str | Column) -> Column:
    """Fill ``{name}`` marks of a template with columns or plain strings."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        value = values[piece] if i % 2 else piece
        if isinstance(value, Column):
            parts.append(value)
        elif value:
            parts.append(F.lit(value))
    return F.concat(*parts)


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def ner_messages(text: Column, mode: str = "strict", hub: str = L.HUB) -> Column:
    """System text, one worked example, the text to tag. ``lenient`` names the hub."""
    lenient = mode == "lenient"
    system = L.NER_HUB_SYSTEM if lenient else L.NER_SYSTEM
    shown = L.NER_HUB_EXAMPLE if lenient else L.NER_EXAMPLE
    given = L.NER_HUB_EXAMPLE_INPUT if lenient else L.NER_EXAMPLE_INPUT
    answer = L.NER_HUB_EXAMPLE_OUTPUT if lenient else L.NER_EXAMPLE_OUTPUT
    user = L.NER_HUB_USER if lenient else L.NER_USER
    return F.array(
        _message("system", fill(system, hub=hub)),
        _message("user", fill(shown, input=given, output=json.dumps(answer, ensure_ascii=False))),
        _message("user", fill(user, hub=hub, text=text)),
    )


def re_messages(text: Column, entities: Column, error: Column | None = None, raw: Column | None = None) -> Column:
    """System text, then text and entity map as JSON.

    Where the entities failed, their ``error`` and ``raw`` answer stand in
    place of the map; without any of them it is empty.
    """
    shown = python_json(entities)
    if error is not None:
        field = lambda name, value: F.concat(F.lit(f'"{name}": '), F.coalesce(json_string(value), F.lit("null")))
        failed = F.concat(F.lit("{"), field("error", error), F.lit(", "), field("raw", F.lit(None).cast("string") if raw is None else raw), F.lit("}"))
        shown = F.coalesce(shown, F.when(error.isNotNull(), failed))
    return F.array(
        _message("system", F.lit(L.RE_SYSTEM)),
        _message("user", fill(L.RE_USER, text=text, entities=F.coalesce(shown, F.lit("{}")))),
    )


def re_messages_hub(text: Column, entities: Column, hub: str = L.HUB) -> Column:
    """Entities as one flat list around the hub; NULL if there is no entity."""
    flat = F.flatten(F.map_values(entities))
    messages = F.array(
        _message("system", fill(L.RE_HUB_SYSTEM, hub=hub)),
        _message("user", fill(L.RE_HUB_USER, hub=hub, text=text, entities=F.array_join(flat, ", "))),
    )
    return F.when(F.size(flat) > 0, messages)


def first_text(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))


def core_prompt(
    text: Column,
    dep: Sequence[Column],
    con: Sequence[Column],
    concepts: Column | Sequence[str] | str = tuple(L.CORE_CONCEPTS),
    answer_format: str = L.CORE_FORMAT,
) -> Column:
    """Extraction prompt from text, syntax strings and core concepts.

    ``dep`` and ``con`` list the columns to fall back through. ``concepts`` is
    an array<string> column, a list, or one string.
    """
    if isinstance(concepts, Column):
        shown = F.array_join(concepts, ", ")
    elif isinstance(concepts, str):
        shown = concepts
    else:
        shown = ", ".join(map(str, concepts))
    return fill(
        L.CORE_PROMPT, text=text, dep=first_text(*dep), con=first_text(*con), concepts=shown, format=answer_format
    )


def core_messages(prompt: Column) -> Column:
    return F.array(_message("user", prompt))
