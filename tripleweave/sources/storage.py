"""Stage tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: spark.checkpoint.dir, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/stages"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder in the shared one that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, run: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; cuts lineage.

    Use it behind model calls (they are not repeated when a later task is
    lost) and before a value that must not change between two uses. Without a
    ``run`` the table has a name of its own and lives as long as the folder,
    which belongs to the session. With one it lies at ``<run>/<name>``, and a
    complete table that is there already is read instead of computed; give
    every input its own run name, and end it with ``forget_run``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{run}/{name}" if run else f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not (run and _complete(spark, path)):
        df.write.mode("overwrite").parquet(path)
        if run:
            _mark(spark, path, 1)
    return spark.read.schema(df.schema).parquet(path)


def _mark(spark: SparkSession, path: str, rows: int) -> None:
    """A table of one row beside a complete table; written after it, emptied when it is given up."""
    spark.range(rows).coalesce(1).write.mode("overwrite").json(f"{path}-complete")


def _complete(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.schema("id long").json(f"{path}-complete").count() == 1
    except AnalysisException:
        return False


def forget_run(spark: SparkSession, run: str, *names: str) -> None:
    """Give up the stored tables of a run: they are emptied, and computed anew if they are asked for again."""
    for name in names:
        path = f"{shared_folder(spark)}/{run}/{name}"
        if _complete(spark, path):
            _mark(spark, path, 0)
            schema = spark.read.parquet(path).schema
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
