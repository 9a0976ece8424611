"""A stored property graph: batches are appended as sorted runs, merged level by level, read as the latest name per edge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.runs import RunStore
from .graph import EDGE_KEY, graph_edges

STORED = "head string, rel_type string, tail string, rel_name string, stamp long"


def latest(edges: DataFrame) -> DataFrame:
    """One row per edge with the name that was written last; equal edges are combined before the shuffle."""
    last = edges.groupBy(*EDGE_KEY).agg(F.max(F.struct("stamp", "rel_name")).alias("_last"))
    return last.select(*EDGE_KEY, "_last.rel_name", "_last.stamp")


class EdgeStore:
    """Edges under ``path``, sorted by head.

    A batch costs its own size: it becomes one run, and ``compact`` merges
    ``fanout`` runs of a level into one of the next, so an edge is rewritten
    once per level. A read merges the runs that are left, whose number grows
    with the logarithm of the batches. ``neighbours`` opens only the files whose range
    holds the heads asked for.
    """

    def __init__(self, spark: SparkSession, path: str, file_rows: int = 1_000_000):
        self.spark = spark
        self.runs = RunStore(spark, path, "head", ["rel_type", "tail"], file_rows)

    def import_batch(self, triples: DataFrame, name: str, *order: str) -> bool:
        """Merge a batch of triples; False, and nothing done, if a batch of this name is in the store.

        Later batches win over earlier ones, later rows (by ``order``) over
        earlier ones of their batch. A second import of the same rows is a batch of
        another name.
        """
        if self.runs.committed(name):
            return False
        edges = graph_edges(triples, *order).drop("support")
        return self.runs.add(edges.withColumn("stamp", F.lit(self.runs.stamp()).cast("long")), name)

    def edges(self) -> DataFrame:
        """Current edges: head, rel_type, tail, rel_name."""
        stored = self.runs.scan()
        rows = stored if stored is not None else self.spark.createDataFrame([], STORED)
        return latest(rows).drop("stamp")

    def nodes(self) -> DataFrame:
        """Distinct ends of the edges."""
        stored = self.runs.scan()
        rows = stored if stored is not None else self.spark.createDataFrame([], STORED)
        return rows.select(F.explode(F.array("head", "tail")).alias("name")).distinct()

    def neighbours(self, heads: Sequence[str]) -> DataFrame:
        """Current edges that leave some nodes."""
        found = self.runs.lookup(heads)
        return latest(found if found is not None else self.spark.createDataFrame([], STORED)).drop("stamp")

    def compact(self, fanout: int = 4) -> int:
        """Merge full levels; returns the number of merges. Edges read before and after are the same."""
        return self.runs.merge_levels(latest, fanout)
