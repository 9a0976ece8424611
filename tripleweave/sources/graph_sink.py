"""Hand a batch of edges to an external graph store, all of it or nothing.

The store is the user's: an object with the three methods of ``GraphStore``.
Tasks stage their rows under the name of the batch and of their own attempt;
only when all tasks are done does the driver commit, naming the attempts that
count. A task that is run again, or an attempt that died half way, leaves rows no
commit names.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SOURCE = "tripleweave_graph"


class GraphStore(Protocol):
    """What a store must do; it travels with the tasks, so it must be picklable and connect where it is called."""

    def stage(self, batch: str, attempt: str, rows: list[dict]) -> None:
        """Keep rows of one attempt where no reader sees them; called several times."""

    def commit(self, batch: str, attempts: Sequence[str]) -> None:
        """Make the rows of these attempts visible at once, by merging; a batch that is committed already is left alone."""

    def abort(self, batch: str) -> None:
        """Forget all that is staged for the batch."""


@dataclass
class Staged(WriterCommitMessage):
    attempt: str
    rows: int


def source_for(store: GraphStore, batch: str, batch_rows: int) -> type[DataSource]:
    """A data source of Spark that writes one batch to the store."""

    class Writer(DataSourceArrowWriter):
        def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
            task = TaskContext.get()
            attempt = f"{task.partitionId()}-{task.taskAttemptId()}"
            rows = 0
            for part in iterator:
                for at in range(0, len(part), batch_rows):
                    some = part.slice(at, batch_rows).to_pylist()
                    store.stage(batch, attempt, some)
                    rows += len(some)
            return Staged(attempt, rows)

        def commit(self, messages: list) -> None:
            store.commit(batch, [m.attempt for m in messages if m is not None and m.rows])

        def abort(self, messages: list) -> None:
            store.abort(batch)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return SOURCE

        def writer(self, schema, overwrite: bool) -> Writer:
            return Writer()

    return Source


def send_batch(edges: DataFrame, store: GraphStore, batch: str, batch_rows: int = 1000, partitions: int | None = None) -> None:
    """Write edges to the store as one batch; if a task fails for good, the batch is aborted and the error raised.

    ``partitions`` limits the number of tasks that write at a time. The same
    batch sent again is for the store to recognise by its name.
    """
    edges.sparkSession.dataSource.register(source_for(store, batch, batch_rows))
    rows = edges.repartition(partitions, "head") if partitions else edges
    rows.write.format(SOURCE).mode("append").save()


class FolderStore:
    """A store of JSON lines in a folder that the driver and all executors mount: one folder per committed batch.

    A commit is one rename of the folder that holds the rows and the list of the attempts that count.
    """

    def __init__(self, path: str):
        self.path = path

    def _staged(self, batch: str) -> str:
        return os.path.join(self.path, "staged", batch)

    def stage(self, batch: str, attempt: str, rows: list[dict]) -> None:
        os.makedirs(self._staged(batch), exist_ok=True)
        with open(os.path.join(self._staged(batch), f"{attempt}.jsonl"), "a", encoding="utf-8") as f:
            f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)

    def commit(self, batch: str, attempts: Sequence[str]) -> None:
        done = os.path.join(self.path, "batches", batch)
        if os.path.exists(done):
            self.abort(batch)
            return
        os.makedirs(self._staged(batch), exist_ok=True)
        with open(os.path.join(self._staged(batch), "attempts.json"), "w") as f:
            json.dump(sorted(attempts), f)
        os.makedirs(os.path.dirname(done), exist_ok=True)
        os.rename(self._staged(batch), done)

    def abort(self, batch: str) -> None:
        if os.path.isdir(self._staged(batch)):
            for name in os.listdir(self._staged(batch)):
                os.unlink(os.path.join(self._staged(batch), name))

    def batches(self) -> list[str]:
        folder = os.path.join(self.path, "batches")
        return sorted(os.listdir(folder)) if os.path.isdir(folder) else []

    def edges(self) -> dict[tuple, str]:
        """Edges of all committed batches with their name, later batches (by name) over earlier ones; for small stores and tests."""
        out: dict[tuple, str] = {}
        for batch in self.batches():
            folder = os.path.join(self.path, "batches", batch)
            with open(os.path.join(folder, "attempts.json")) as f:
                attempts = json.load(f)
            for a in attempts:
                with open(os.path.join(folder, f"{a}.jsonl"), encoding="utf-8") as lines:
                    out |= {(r["head"], r["rel_type"], r["tail"]): r["rel_name"] for r in map(json.loads, lines)}
        return out
