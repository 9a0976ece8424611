"""Model answers that outlive the run that asked for them.

A ledger is a folder of answers under the key of what was asked. Each task's
answers are put in place when the task ends, not when the job does, so a
driver that is lost in the middle has lost only the calls of its running tasks; the
next run asks for nothing that the ledger holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .inference import Model, infer

#: More tasks are not made of one run; beyond it each has more calls.
MOST_TASKS = 100_000
ANSWER = "key string, response string, failure string, asked_at timestamp"


def request_key(messages: str = "messages", model: str = "") -> Column:
    """Key of a request: a digest of its messages and of the name of the model that is asked; NULL for no messages."""
    asked = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return F.sha2(F.concat(F.lit(model), F.lit("\n"), F.to_json(asked)), 256)


class Ledger:
    """Answers stored under ``path``, by one writer at a time or several.

    Two runs that ask at once may both pay for the same key; either answer is
    right. Of several answers of one key a good one wins over a failure, then
    the latest. ``read`` merges them.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        """All answers as they were written."""
        try:
            return self.spark.read.schema(ANSWER).parquet(f"{self.path}/answers")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ANSWER)

    def read(self) -> DataFrame:
        """One row per key: key, response, failure, tries (answers stored under the key)."""
        late = F.struct(F.col("failure").isNull().alias("good"), "asked_at", "response", "failure")
        best = self.entries().groupBy("key").agg(F.max(late).alias("_best"), F.count("*").alias("tries"))
        return best.select("key", "_best.response", "_best.failure", "tries")

    def append(self, answers: DataFrame) -> None:
        """Add answers; those of a finished task stay, whatever becomes of the job.

        The second version of Hadoop's commit algorithm moves a task's file to
        its place when the task commits. A task that is run again overwrites nothing and is
        known by its keys, so a file that is there twice does no harm.
        """
        writer = answers.select(*[f.split()[0] for f in ANSWER.split(", ")]).write.mode("append")
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{self.path}/answers")

    def compact_to(self, target: str) -> None:
        """Write the merged answers as a new ledger, once many small files have piled up."""
        late = F.struct(F.col("failure").isNull().alias("good"), "asked_at", "response", "failure")
        best = self.entries().groupBy("key").agg(F.max(late).alias("_best"))
        best.select("key", "_best.response", "_best.failure", "_best.asked_at").write.mode("overwrite").parquet(f"{target.rstrip('/')}/answers")


def ask(
    df: DataFrame,
    ledger: Ledger,
    load: Callable[[], Model],
    messages: str = "messages",
    model: str = "",
    calls_per_task: int = 200,
    retry_failures: bool = True,
    **options,
) -> DataFrame:
    """Add ``response`` and ``failure`` from the ledger, after asking for what it lacks.

    Equal requests are asked once, whatever the number of their rows. The
    missing ones are dealt into tasks of about ``calls_per_task`` calls (more beyond ``MOST_TASKS`` tasks) by
    their key, so that is what a lost task may have to ask again. A stored failure
    is asked again unless ``retry_failures`` is off. ``model`` is part of the key: give it
    the name and version of the model. ``options`` are those of ``infer``; with
    ``on_error="raise"`` a failing call ends the run, and what was answered stays.

    Rows without messages get neither. The rows themselves are read twice, so
    store them first if they are costly or not the same on each reading.
    """
    keyed = df.withColumn("_key", request_key(messages, model))
    known = ledger.entries()
    known = (known.where("failure is null") if retry_failures else known).select(F.col("key").alias("_key")).distinct()
    wanted = keyed.where("_key is not null").join(known, "_key", "left_anti").groupBy("_key").agg(F.first(messages).alias("messages"))
    wanted = wanted.withColumnRenamed("_key", "key")
    calls = keyed.where("_key is not null").select("_key").distinct().join(known, "_key", "left_anti").count()
    if calls:
        # a fixed number of tasks: joining small ones would put more calls at risk
        dealt = wanted.repartition(min(MOST_TASKS, -(-calls // calls_per_task)), "key")
        answers = infer(dealt, load, "messages", **options)
        ledger.append(answers.select("key", "response", "failure", F.current_timestamp().alias("asked_at")))
    answers = ledger.read().select(F.col("key").alias("_key"), "response", "failure")
    return keyed.join(answers, "_key", "left").drop("_key")
