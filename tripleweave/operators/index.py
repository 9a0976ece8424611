"""Inverted index from entities to the triples that mention them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import rows_of, strip
from ..sources.storage import stage


def postings(triples: DataFrame, *keys: str) -> DataFrame:
    """Post every triple under its head (role 0) and its tail (role 1).

    Keys are stripped, blank ones skipped; the triple itself is kept as it is.
    A narrow operation. Rows with a missing part are no valid triples.
    """
    both = F.array(
        F.struct(F.lit(0).alias("role"), strip(F.col("head")).alias("entity")),
        F.struct(F.lit(1).alias("role"), strip(F.col("tail")).alias("entity")),
    )
    valid = triples.filter("head is not null and rel is not null and tail is not null")
    rows = valid.select(*keys, "pos", "head", "rel", "tail", F.inline(both))
    return rows.filter("entity <> ''").select("entity", *keys, "pos", "role", "head", "rel", "tail")


def inverted_index(posted: DataFrame, *keys: str, most: int = 1 << 16, whole: int = 1 << 16) -> DataFrame:
    """Posting lists per entity, cut into blocks of ``most`` postings; keys of any type.

    ``block`` numbers the blocks of an entity from 0 in the order of the keys,
    so together they are its whole list, each full but the last. Postings are
    stored once and counted by entity. Lists of up to ``whole`` postings are made
    by one shuffle on the entity and cut where they are made. An entity with more,
    which may own a third of all postings, is never built as one value: see ``ranged_blocks``.
    """
    order = [*keys, "pos", "role", "head", "rel", "tail"]
    stored = stage(posted, "postings")
    hot = stage(stored.groupBy("entity").agg(F.count("*").alias("_n")).where(F.col("_n") > whole).select("entity"), "hot_entities")
    some_hot = bool(hot.head(1))
    light = stored.join(hot, "entity", "left_anti") if some_hot else stored
    lists = light.groupBy("entity").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_all"))
    cut = F.transform(F.sequence(F.lit(0), (F.size("_all") - 1).cast("int"), F.lit(int(most))), lambda i: F.slice("_all", i + 1, F.lit(int(most))))
    blocks = lists.select("entity", F.posexplode(rows_of(cut)).alias("block", "postings"))
    blocks = blocks.select("entity", F.col("block").cast("bigint").alias("block"), F.size("postings").alias("n"), "postings")
    return blocks.unionByName(ranged_blocks(stored.join(hot, "entity", "left_semi"), order, most)) if some_hot else blocks


def ranged_blocks(posted: DataFrame, order: list[str], most: int) -> DataFrame:
    """Blocks of entities with long lists: postings are sorted over all tasks, and counted per entity and range.

    The counts before a range tell each posting its rank, and so its block, whatever the number of tasks its entity is spread over.
    """
    ranged = stage(
        posted.repartitionByRange("entity", *order).sortWithinPartitions("entity", *order)
        .withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()),
        "sorted_postings",
    )
    # one row per entity and range it has postings in
    held = ranged.groupBy("entity", "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("entity").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begin = held.select("entity", "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        ranged.join(begin, ["entity", "_range"])
        .groupBy("entity", F.expr(f"(_before + _at - _first) div {int(most)}").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("postings"))
        .select("entity", "block", F.size("postings").alias("n"), "postings")
    )


def lookup(index: DataFrame, entities: str | Iterable[str] | DataFrame) -> DataFrame:
    """Rows of some entities; the filter reaches the scan, a table is semi-joined."""
    if isinstance(entities, DataFrame):
        return index.join(entities, "entity", "left_semi")
    names = [entities] if isinstance(entities, str) else list(entities)
    return index.filter(F.col("entity").isin(names))


def with_text(posted: DataFrame, records: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """Join the record texts back to the postings, last, for an export."""
    return posted.join(records.select(*keys, text), list(keys))


def write_index(posted: DataFrame, table: str, files: int = 64, path: str | None = None) -> None:
    """Store postings in about ``files`` files, sorted by entity over all of them.

    A lookup reads the files whose range holds the entity, which their
    statistics tell; an entity with a large share of all postings spreads
    over as many files as its share, cut by the other columns.
    """
    rest = [c for c in posted.columns if c != "entity"]
    writer = posted.repartitionByRange(files, "entity", *rest).sortWithinPartitions("entity").write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
