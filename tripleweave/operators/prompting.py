"""Render chat messages for tables of chunks and entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions import prompts as P
from ..functions.text import rows_of


def render_ner(df: DataFrame, mode: str = "strict", hub: str = L.HUB) -> DataFrame:
    return df.withColumn("messages", P.ner_messages(F.col("text"), mode, hub))


def render_re(df: DataFrame, mode: str = "strict", hub: str = L.HUB) -> DataFrame:
    """``lenient`` lists the entities around the hub; NULL messages without any.

    In strict mode columns ``entities_error`` and ``entities_raw``, if there, stand for entities that failed.
    """
    text, entities = F.col("text"), F.col("entities")
    failed = [F.col(c) for c in ("entities_error", "entities_raw") if c in df.columns]
    chat = P.re_messages(text, entities, *failed) if mode == "strict" else P.re_messages_hub(text, entities, hub)
    return df.withColumn("messages", chat)


def render_core(df: DataFrame, concepts=tuple(L.CORE_CONCEPTS), answer_format: str = L.CORE_FORMAT) -> DataFrame:
    """Prompt from ``text`` and the ``syntax`` struct of ``analyze_syntax``."""
    prompt = P.core_prompt(
        F.col("text"), [F.col("syntax.dep")], [F.col("syntax.con_pos")], concepts, answer_format
    )
    return df.withColumn("messages", P.core_messages(prompt))


def explode_messages(df: DataFrame, *keys: str) -> DataFrame:
    """One row per message: keys, turn, role, content."""
    rows = df.select(*keys, F.posexplode(rows_of(F.col("messages"))).alias("turn", "m"))
    return rows.select(*keys, "turn", "m.role", "m.content")
