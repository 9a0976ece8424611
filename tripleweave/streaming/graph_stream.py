"""Incremental import as a stream: each micro-batch is one graph batch."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.edge_store import EdgeStore
from ..operators.graph import write_batch


def import_number(spark: SparkSession, checkpoint: str) -> int:
    """Number of the import that ``checkpoint`` stands for, set when it is first used and kept beside it.

    A checkpoint's batches count from 0 again in every new checkpoint, so they
    need a name of their own; later imports have larger numbers.
    """
    place = f"{checkpoint.rstrip('/')}-import"
    try:
        return spark.read.schema("started long").json(place).first()["started"]
    except AnalysisException:
        started = time.time_ns()
        spark.range(1).selectExpr(f"{started}L as started").write.json(place)
        return started


def import_stream(triples: DataFrame, path: str, checkpoint: str, *order: str, once: bool = False) -> StreamingQuery:
    """Merge a stream of long triples into the stored graph at ``path``.

    A micro-batch that is run again after a failure has the same id and
    replaces its own partition, so the import is exactly-once; another
    checkpoint is another import, whose batches lie beside it. Keep
    ``<checkpoint>-import`` as long as the checkpoint, and remove both
    together. Use ``operators.graph.compact`` when many batches have piled up.
    """
    started = import_number(triples.sparkSession, checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, *order, started=started)

    writer = triples.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def import_stream_to_store(
    triples: DataFrame, store: EdgeStore, checkpoint: str, *order: str, fanout: int = 4, once: bool = False
) -> StreamingQuery:
    """Merge a stream of long triples into an ``EdgeStore``, whose levels are merged as they fill.

    A micro-batch is known to the store by the number of its import and its
    own, so one that is run again after a failure is left alone: the import
    is exactly-once, and a batch costs its own size.
    """
    started = import_number(triples.sparkSession, checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.import_batch(batch, f"import{started}-{batch_id}", *order)
        store.compact(fanout)

    writer = triples.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
