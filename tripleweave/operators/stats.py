"""Counts, top lists and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import relation_items
from ..functions.order import order_key
from ..functions.text import rows_of


def triplet_stats(records: DataFrame, triplets: Column) -> DataFrame:
    """One row: records, and triples in list-valued fields (NULL size is no list)."""
    size = F.coalesce(F.size(triplets), F.lit(0)).cast("bigint")
    return records.agg(F.count("*").alias("records"), F.coalesce(F.sum(size), F.lit(0)).alias("triplets"))


def top_relations(triples: DataFrame, *order: str, n: int = 10) -> DataFrame:
    """Most frequent raw relations, ties by first occurrence."""
    return (
        triples.filter("rel is not null")
        .select("rel", order_key(triples, *order).alias("_first"))
        .groupBy("rel")
        .agg(F.count("*").alias("n"), F.min("_first").alias("first"))
        .orderBy(F.desc("n"), "first")
        .limit(n)
        .select("rel", "n")
    )


def relation_list(records: DataFrame, *keys: str, triplets: str = "triplets") -> DataFrame:
    """Relations of a VARIANT list for ``top_relations``: keys, pos, rel, of every item with two parts or more."""
    rows = records.select(*keys, F.inline(rows_of(relation_items(F.col(triplets)))))
    return rows.select(*keys, "pos", "rel")


def triplet_preview(records: DataFrame, rec: str, triplets: Column, n: int = 5, width: int = 200, most: int = 10):
    """First records: start of the text on one line, triple count, first triples."""
    size = F.coalesce(F.size(triplets), F.lit(0))
    shown = F.coalesce(F.slice(triplets, 1, most), F.slice(triplets, 1, 0))
    line = F.substring(F.translate(F.coalesce("text", F.lit("")), "\n", " "), 1, width)
    return records.orderBy(rec).limit(n).select(rec, line.alias("preview"), size.alias("n"), shown.alias("triplets"))


def chunk_total(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("*").alias("chunks"))


def chunk_inspect(chunks: DataFrame, n: int = 5) -> DataFrame:
    """First chunks by id: file, chunk_index and text length."""
    return chunks.orderBy("id").limit(n).select(
        "id", "file", "chunk_index", F.length(F.coalesce("text", F.lit(""))).alias("len")
    )


def entity_type_counts(entities: DataFrame) -> DataFrame:
    """Entities per category from the long form."""
    return entities.groupBy("category").agg(F.count("*").alias("n"))


def run_summary(records: DataFrame, *order: str, width: int = 100, most: int = 5) -> DataFrame:
    """One row over records with ``text``, ``entities`` and a ``triplets`` list.

    chunks, triplets (totals); preview (the first ``width`` characters of the
    first chunk in ``order``), entities (its map by type) and first (its first
    ``most`` triples), NULL without records. One pass.
    """
    first = F.struct(
        *order, F.substring("text", 1, width).alias("_preview"), F.to_json("entities").alias("_entities"),
        F.slice("triplets", 1, most).alias("_first"),
    )
    total = F.coalesce(F.sum(F.size("triplets").cast("bigint")), F.lit(0))
    one = records.agg(F.count("*").alias("chunks"), total.alias("triplets"), F.min(first).alias("_one"))
    return one.select(
        "chunks", "triplets", F.col("_one._preview").alias("preview"),
        F.from_json("_one._entities", "map<string,array<string>>").alias("entities"), F.col("_one._first").alias("first"),
    )
