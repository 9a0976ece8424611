"""Exact deduplication with the heavy digests split off (Misra-Gries)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_of, stage

SUMMARY = "digest string, weight long"


def reduced(digests: pa.Array, weights: pa.Array, counters: int) -> pa.Table:
    """Misra-Gries summary of weighted digests: add up, then take the (counters + 1)-th weight off all."""
    t = pa.table({"digest": digests, "weight": weights}).group_by("digest").aggregate([("weight", "sum")])
    weight = np.asarray(t["weight_sum"], np.int64)
    if len(weight) > counters:
        weight = weight - np.partition(weight, len(weight) - counters - 1)[len(weight) - counters - 1]
    t = pa.table({"digest": t["digest"], "weight": pa.array(weight)})
    return t.filter(pc.greater(t["weight"], 0))


def summarise(counters: int, kind: pa.DataType = pa.string()):
    """mapInArrow function: the Misra-Gries summary of a partition's (digest, weight) rows, kept batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"digest": pa.array([], kind), "weight": pa.array([], pa.int64())})
        for b in batches:
            t = pa.concat_tables([held, pa.table({"digest": b.column(0).cast(kind), "weight": b.column(1)})])
            held = reduced(t["digest"].combine_chunks(), t["weight"].combine_chunks(), counters)
        yield from held.to_batches()

    return run


def heavy_digests(rows: DataFrame, counters: int) -> DataFrame:
    """Candidates for digests of more than 1 / (counters + 1) of the rows: at most ``counters`` rows, none missing.

    Summaries are merged in two steps, so that the last task reads the
    square root of the number of partitions times ``counters`` rows.
    """
    first = rows.select("digest", F.lit(1).cast("long").alias("weight")).mapInArrow(summarise(counters), SUMMARY)
    middle = max(1, int(partitions_of(rows.sparkSession) ** 0.5))
    second = first.repartition(middle).mapInArrow(summarise(counters), SUMMARY)
    return second.repartition(1).mapInArrow(summarise(counters), SUMMARY).select("digest")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their bytes are equal (SHA-256 of the whole text; null
    counts as empty). Of a group the largest id stays, a null id only where
    the group has no other; rows that repeat id and text share the decision
    except that ``kept`` holds for one of them. An empty table gives no rows;
    further columns of the input are not read.

    Misra-Gries summaries of all digests name the candidates of more than
    1 / ``counters`` of the rows. Those whose exact count confirms it, fewer
    than ``counters``, are broadcast and their rows leave the shuffle; each
    remaining group is small beside the table and is counted with map-side
    combining, then joined to its rows by digest.
    """
    rows = stage(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("digest"),
            F.monotonically_increasing_id().alias("tag"),
        ),
        "exact-digests",
    )

    def groups(df: DataFrame) -> DataFrame:
        return df.groupBy("digest").agg(
            F.count(F.lit(1)).alias("group_size"),
            # nulls come first, so an id wins over none; the tag settles repeated rows
            F.max(F.struct("doc_id", "tag")).alias("best"),
        )

    total = rows.count()
    candidates = F.broadcast(heavy_digests(rows, counters))
    winners = stage(
        groups(rows.join(candidates, "digest", "left_semi")).where(F.col("group_size") * counters > total), "exact-heavy"
    )
    few = F.broadcast(winners)  # fewer than ``counters`` rows: each has more than total / counters
    heavy = rows.join(few, "digest")
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    light = light.join(groups(light), "digest")
    return heavy.unionByName(light).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("tag") == F.col("best.tag")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; of rows that repeat id and text one stays."""
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    stay = exact_groups(docs, id_col, text_col, counters).where("kept").select(
        F.col("keep_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_digest")
    )
    mine = docs.withColumns({"_keep_id": F.col(id_col).cast("long"), "_keep_digest": digest})
    same = mine["_keep_id"].eqNullSafe(stay["_keep_id"]) & (mine["_keep_digest"] == stay["_keep_digest"])
    return mine.join(stay, same, "left_semi").dropDuplicates(["_keep_id", "_keep_digest"]).select(*docs.columns)
