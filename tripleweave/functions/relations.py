"""Expressions on entities and relations: validity, normal form, type name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lexicon as L
from .text import strip


def contains_any(value: Column, words: Sequence[str]) -> Column:
    """True if any word occurs; plain substring search, stays in codegen."""
    return reduce(or_, [value.contains(w) for w in words], F.lit(False))


def is_placeholder(part: Column, words: Sequence[str] = L.PLACEHOLDER_WORDS) -> Column:
    """Empty, or containing one of the demonstration words."""
    return (part == "") | contains_any(part, words)


def valid_entity(part: Column, singles: Sequence[str] = L.SINGLE_CHAR_ENTITIES) -> Column:
    """Has a letter or digit, and is no single character unless a direction."""
    return stripped_entity_valid(strip(part), singles)


def stripped_entity_valid(s: Column, singles: Sequence[str] = L.SINGLE_CHAR_ENTITIES) -> Column:
    return ((F.length(s) != 1) | s.isin(list(singles))) & s.rlike(r"[\p{L}\p{N}]")


def has_relation_keyword(rel: Column, keywords: Sequence[str] = L.RELATION_KEYWORDS) -> Column:
    return contains_any(rel, keywords)


def normalize_relation(rel: Column, groups: Sequence[tuple] = L.RELATION_GROUPS) -> Column:
    """Canonical relation of the first group with a hit, else the stripped text."""
    return canonical_relation(strip(rel), groups)


def canonical_relation(s: Column, groups: Sequence[tuple] = L.RELATION_GROUPS) -> Column:
    """``normalize_relation`` of a stripped text."""
    branch = F
    for words, canonical in groups:
        branch = branch.when(contains_any(s, words), F.lit(canonical))
    return branch.otherwise(s) if groups else s


def sanitize_relation(rel: Column) -> Column:
    """Relation as a graph type name: word characters, letter first, upper case."""
    s = F.btrim(F.regexp_replace(rel, r"[^\p{L}\p{N}_]+", "_"), F.lit("_"))
    named = F.when(s == "", F.lit(L.EMPTY_RELATION_TYPE)).otherwise(s)
    typed = F.when(named.rlike("^[A-Za-z]"), named).otherwise(F.concat(F.lit(L.RELATION_TYPE_PREFIX), named))
    return F.upper(typed)
