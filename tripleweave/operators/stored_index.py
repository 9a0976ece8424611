"""An inverted index on disk: look-ups open the files of the entity, new postings come as deltas that are merged into the main part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.runs import RunStore


class StoredIndex:
    """Postings (as ``index.postings`` makes them) under ``path``, sorted by entity, then by their other columns.

    ``add`` writes a sorted run: the first is the main part, later ones are
    deltas, and ``merge`` takes deltas level by level into larger runs. An entity with
    more postings than a file holds spreads over several files of a run, cut by the
    further columns, so no list is ever one task's or one value.
    """

    def __init__(self, spark: SparkSession, path: str, *order: str, file_rows: int = 1_000_000):
        self.spark = spark
        self.runs = RunStore(spark, path, "entity", order, file_rows)

    def add(self, posted: DataFrame, name: str | None = None, files: int | None = None, stored: bool = False) -> bool:
        """Append postings; a name that is in the index already is left alone (False). ``stored``: they come from a table."""
        return self.runs.add(posted, name, files=files, stored=stored)

    def merge(self, fanout: int = 4) -> int:
        """Merge full levels of runs; postings are kept as they are."""
        return self.runs.merge_levels(fanout=fanout)

    def postings(self) -> DataFrame | None:
        """All postings; None if there are none."""
        return self.runs.scan()

    def lookup(self, entities: str | Sequence[str] | DataFrame) -> DataFrame | None:
        """Postings of some entities, or of those in a table with a column ``entity``; None if no file can hold one."""
        if isinstance(entities, DataFrame):
            return self.runs.lookup_join(entities)
        return self.runs.lookup([entities] if isinstance(entities, str) else list(entities))

    def files_read(self, entities: Sequence[str]) -> tuple[int, int]:
        """Number of files that a look-up of these entities opens, and of files of the index."""
        hit = F.exists(F.array(*map(F.lit, entities)), lambda e: e.between(F.col("least"), F.col("most")))
        every = self.runs.files().where("file is not null")
        return tuple(every.agg(F.count_if(hit), F.count("*")).first())
