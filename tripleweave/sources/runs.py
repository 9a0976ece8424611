"""A store of sorted runs with a log: batches are appended at their own cost, look-ups open only files that can hold the key.

Layout under ``path``: ``runs/<name>`` holds the files of one run, each a
sorted range of it; ``log`` holds one small file per commit, whose rows name
the files that come and the runs that go. A run that no commit names does not
exist: one left behind by a lost driver is never read. Commits are made by one
writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import stage

#: ``least`` and ``most`` are the first and the last key of the file; ``gone`` says that the run is no longer read.
LOG = "at long, run string, level int, file string, rows long, least string, most string, gone boolean"
#: Files of a look-up are listed by the driver one by one; beyond this many the whole runs are scanned under a filter instead.
LISTED = 10_000


def file_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, first and last key of each file in a batch: a row per batch and file, since Spark would sort all rows for the ends of strings."""
    for batch in batches:
        if not len(batch):
            continue
        got = pa.Table.from_batches([batch]).group_by("file").aggregate([("key", "count", pc.CountOptions(mode="all")), ("key", "min"), ("key", "max")])
        yield from got.select(["file", "key_count", "key_min", "key_max"]).rename_columns(["file", "rows", "least", "most"]).to_batches()


class RunStore:
    """Runs sorted by ``key`` (a string column) and the further columns ``order``, in files of about ``file_rows`` rows.

    The log is read anew at each call, so a store may be opened at the same
    place by another session. Files of one run do not overlap, except that a
    key with more rows than a file spreads over several.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, order: Sequence[str] = (), file_rows: int = 1_000_000):
        self.spark, self.path, self.key, self.order, self.file_rows = spark, path.rstrip("/"), key, list(order), file_rows

    # --- log ---

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).json(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def files(self) -> DataFrame:
        """Files of the present runs: at (number of the commit), run, level, file, rows, least, most."""
        log = self.log()
        gone = log.where("gone").select("run").distinct()
        return log.where("not gone").join(gone, "run", "left_anti").drop("gone")

    def runs(self) -> list:
        """Present runs in the order of their commits: run, at, level, rows; one row per run, whose number grows with the logarithm of the batches."""
        return self.files().groupBy("run", "at", "level").agg(F.sum("rows").alias("rows")).orderBy("at").collect()

    def committed(self, run: str) -> bool:
        """Whether a run of this name was ever committed, also one that has been merged away since."""
        return bool(self.log().where(F.col("run") == run).head(1))

    def commit(self, rows: DataFrame) -> None:
        """One file, put in place by one rename: all of it or nothing."""
        rows.select(*[f.split()[0] for f in LOG.split(", ")]).coalesce(1).write.mode("append").json(f"{self.path}/log")

    # --- writing ---

    def add(self, rows: DataFrame, run: str | None = None, level: int = 0, replaces: Sequence[str] = (), files: int | None = None, stored: bool = False) -> bool:
        """Write a run and commit it; a name that is committed already is left alone (False).

        ``replaces`` names runs that go in the same commit. The number of
        ranges, and so of files, follows the number of rows; ``files`` is the least. ``stored``
        says that the rows are those of a table, which may be read again; otherwise they are stored first.
        """
        run = run or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.-]+", run):
            raise ValueError(f"a run is named by letters, digits, _, . and -: {run}")
        if self.committed(run):
            return False
        data = f"{self.path}/runs/{run}"
        if not stored:
            rows = stage(rows, "run")  # counted, sampled and sorted, but computed once
        files = max(files or 1, -(-rows.count() // self.file_rows))
        sort = [self.key, *self.order]
        ranged = rows.repartitionByRange(files, *sort) if files > 1 else rows.coalesce(1)
        ranged.sortWithinPartitions(*sort).write.mode("overwrite").parquet(data)
        at = self.stamp()
        keys = self.spark.read.schema(rows.schema).parquet(data).select(F.col("_metadata.file_path").alias("file"), F.col(self.key).alias("key"))
        written = keys.mapInArrow(file_ranges, "file string, rows long, least string, most string").groupBy("file").agg(
            F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("most").alias("most")
        ).withColumns({"at": F.lit(at).cast("long"), "run": F.lit(run), "level": F.lit(level), "gone": F.lit(False)})
        # the name is logged for itself as well: an empty run has no file, and yet is done
        out = written.unionByName(self._marks(at, [(run, level, False), *((r, level, True) for r in replaces)]))
        self.commit(out)
        return True

    def merge_levels(self, merged: Callable[[DataFrame], DataFrame] | None = None, fanout: int = 4) -> int:
        """While some level has ``fanout`` runs, merge its oldest ones into one of the next; returns the number of merges.

        ``merged`` gets the rows of these runs and returns those that stay, in
        the same columns; without it all do. Each row is rewritten once per level, and a level
        holds less than ``fanout`` runs, so a read meets a logarithmic number of runs.
        """
        done = 0
        while True:
            by_level: dict[int, list] = {}
            for r in self.runs():
                by_level.setdefault(r["level"], []).append(r)
            full = next((level for level, runs in sorted(by_level.items()) if len(runs) >= fanout), None)
            if full is None:
                return done
            names = [r["run"] for r in by_level[full][:fanout]]
            rows = self.scan(names)
            # the name is made from the runs that go, so a merge that is tried again is the same one
            name = f"level{full + 1}-{uuid.uuid5(uuid.NAMESPACE_OID, ' '.join(names)).hex}"
            if rows is None:
                self.commit(self._marks(self.stamp(), [(name, full + 1, False), *((r, full, True) for r in names)]))
            else:
                self.add(merged(rows) if merged else rows, name, full + 1, names, stored=merged is None)
            done += 1

    def stamp(self) -> int:
        """Number of the next commit; later runs have larger ones."""
        return 1 + (self.log().agg(F.max("at")).first()[0] or 0)

    def _marks(self, at: int, runs: list[tuple[str, int, bool]]) -> DataFrame:
        return self.spark.createDataFrame([(at, run, level, None, 0, None, None, gone) for run, level, gone in runs], LOG)

    # --- reading ---

    def scan(self, runs: Sequence[str] | None = None) -> DataFrame | None:
        """Rows of the named runs (all present ones); None if there is no row at all."""
        files = self.files().where("file is not null")
        files = files.where(F.col("run").isin(list(runs))) if runs is not None else files
        parts = [r[0] for r in files.select("run").distinct().collect()]
        return self._rows([f"{self.path}/runs/{r}" for r in parts])

    def _rows(self, paths: list[str]) -> DataFrame | None:
        if not paths:
            return None
        return self.spark.read.option("basePath", self.path).parquet(*paths)

    def files_for(self, keys: Sequence[str]) -> DataFrame:
        """Files whose range holds one of some keys."""
        wanted = F.array(*map(F.lit, keys)).cast("array<string>")
        return self.files().where("file is not null").where(F.exists(wanted, lambda k: k.between(F.col("least"), F.col("most"))))

    def lookup(self, keys: Sequence[str]) -> DataFrame | None:
        """Rows of some keys, from the files whose range holds one; None if no file does."""
        found = [r[0] for r in self.files_for(keys).select("file").limit(LISTED + 1).collect()]
        rows = self.scan() if len(found) > LISTED else self._rows(found)
        return rows.where(F.col(self.key).isin(list(keys))) if rows is not None else None

    def lookup_join(self, wanted: DataFrame, listed: int = 1000) -> DataFrame | None:
        """Rows whose key stands in a table (a column named like the key); up to ``listed`` keys are looked up, more are semi-joined."""
        keys = wanted.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        some = [r[0] for r in keys.limit(listed + 1).collect()]
        if len(some) <= listed:
            return self.lookup(some)
        rows = self.scan()
        return rows.join(keys, self.key, "left_semi") if rows is not None else None
