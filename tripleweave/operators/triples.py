"""Triples from entities: rules, hub link, joining entities back.

A triple list is array<struct<head, rel, tail>> in a record, so generating,
testing and repairing triples never leaves the row. The long forms
(one row per triple) are for tables that already are long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions.text import rows_of

TRIPLES = "array<struct<head:string,rel:string,tail:string>>"


def triple(head: Column | str, rel: Column | str, tail: Column | str) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(as_col(head).alias("head"), as_col(rel).alias("rel"), as_col(tail).alias("tail"))


def _names(entities: Column, category: str) -> Column:
    return F.coalesce(F.try_element_at(entities, F.lit(category)), F.array().cast("array<string>"))


def location_activity(entities: Column, goal: str = L.ACTIVITY_GOAL) -> Column:
    """Every location with every activity of the same record."""
    activities = _names(entities, "Planned activity")
    return F.flatten(
        F.transform(
            _names(entities, "Location"),
            lambda place: F.transform(activities, lambda act: triple(place, act, goal)),
        )
    ).cast(TRIPLES)


def function_concept(entities: Column) -> Column:
    """One triple per land use function and concept; the concept is not shown."""
    concepts = _names(entities, "Concept")
    return F.flatten(
        F.transform(
            _names(entities, "Land use function"),
            lambda use: F.array_repeat(triple(L.FUNCTION_HEAD, L.FUNCTION_RELATION, use), F.size(concepts)),
        )
    ).cast(TRIPLES)


def activity(entities: Column) -> Column:
    """One triple per activity."""
    return F.transform(
        _names(entities, "Planned activity"), lambda act: triple(L.ACTIVITY_HEAD, L.ACTIVITY_RELATION, act)
    ).cast(TRIPLES)


def placeholder(triples: Column) -> Column:
    """A single demonstration triple where there is none."""
    return F.when(F.size(triples) == 0, F.array(triple(*L.PLACEHOLDER_TRIPLE)).cast(TRIPLES)).otherwise(triples)


def rule_triples(entities: Column) -> Column:
    """All rules in order, with the placeholder for records without a triple."""
    return placeholder(F.concat(location_activity(entities), function_concept(entities), activity(entities)))


def generate_triples(records: DataFrame, entities: str = "entities") -> DataFrame:
    """Add the ``triplets`` list of the rules to every record."""
    return records.withColumn("triplets", rule_triples(F.col(entities)))


def explode_triples(records: DataFrame, *keys: str, triplets: str = "triplets") -> DataFrame:
    """Long form: keys, pos, head, rel, tail."""
    rows = records.select(*keys, F.posexplode(rows_of(F.col(triplets))).alias("pos", "t"))
    return rows.select(*keys, "pos", "t.head", "t.rel", "t.tail")


def touches_hub(t: Column, hub: str = L.HUB) -> Column:
    return F.coalesce(t["head"].contains(hub), F.lit(False)) | F.coalesce(t["tail"].contains(hub), F.lit(False))


def hub_candidates(entities: Column) -> Column:
    """Concepts, then locations."""
    return F.concat(_names(entities, "Concept"), _names(entities, "Location"))


def link_hub(records: DataFrame, hub: str = L.HUB, triplets: str = "triplets", entities: str = "entities") -> DataFrame:
    """Append a weak link from the first candidate to the hub if none exists."""
    candidates = hub_candidates(F.col(entities))
    missing = ~F.exists(triplets, lambda t: touches_hub(t, hub)) & (F.size(candidates) > 0)
    link = F.array(triple(F.get(candidates, F.lit(0)), L.HUB_RELATION, hub)).cast(TRIPLES)
    return records.withColumn(triplets, F.when(missing, F.concat(F.col(triplets), link)).otherwise(F.col(triplets)))


def hub_linked(triples: DataFrame, hub: str = L.HUB, rec: str = "rec") -> DataFrame:
    """Long form: does any triple of the record touch the hub? Combined before the shuffle."""
    hit = touches_hub(F.struct("head", "tail"), hub)
    return triples.groupBy(rec).agg(F.bool_or(hit).alias("linked"))


def hub_links(triples: DataFrame, entities: DataFrame, hub: str = L.HUB, rec: str = "rec") -> DataFrame:
    """Long form: the links to add, one per record without a hub link.

    ``entities`` has rec, category, pos, entity. The filters run before the
    shuffles, which carry one row per record.
    """
    rank = F.when(F.col("category") == "Concept", 0).otherwise(1)
    first = (
        entities.filter(F.col("category").isin("Concept", "Location"))
        .groupBy(rec)
        .agg(F.min_by("entity", F.struct(rank, F.col("pos"))).alias("head"))
    )
    linked = triples.filter(touches_hub(F.struct("head", "tail"), hub)).select(rec).distinct()
    return first.join(linked, rec, "left_anti").select(
        rec, "head", F.lit(L.HUB_RELATION).alias("rel"), F.lit(hub).alias("tail")
    )


def attach_entities(records: DataFrame, entities: DataFrame, key: str = "id", order: str = "rec") -> DataFrame:
    """Left join of the entity maps; the last of equal ids wins, none gives an empty map.

    One row per id is left before the join, so a repeated id cannot multiply
    records.
    """
    last = entities.groupBy(key).agg(F.max_by("entities", order).alias("entities"))
    empty = F.create_map().cast("map<string,array<string>>")
    return records.join(last, key, "left").withColumn("entities", F.coalesce("entities", empty))


def has_entities(entities: Column) -> Column:
    """Filter: at least one category is non-empty."""
    return F.exists(F.map_values(entities), lambda v: F.size(v) > 0)


def long_enough(text: Column, least: int = 5) -> Column:
    """Filter: at least ``least`` characters."""
    return F.length(text) >= least
