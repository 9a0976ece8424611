"""Connected components and bounded blocks of groups, shared by the pair operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) but the smallest of each component, which names it.

    Alternates large-star and small-star steps: each hangs the neighbours of a
    node onto the smallest among them, so the number of rounds grows with the
    logarithm of the longest path, edges never multiply, and no node's list is
    gathered. Every round is written to the shared folder.
    """
    pair = lambda df, u, v: df.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u != v").distinct()
    print_of = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    held = stage(pair(edges, F.col("a"), F.col("b")), name)
    seen = print_of(held)
    while seen[0]:
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        held = stage(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        now = print_of(held)
        if now == seen:
            break
        seen = now
    return held.select(F.col("u").alias("node"), F.col("v").alias("component"))


def in_blocks(rows: DataFrame, member: str, size: F.Column, most: int) -> DataFrame:
    """Rows with ``i``, ``j``: a group of ``size`` is dealt into parts of about ``most`` and every pair of parts meets once.

    A group within the bound is one block (0, 0). Beyond it each row goes to
    one block per part, so that all members still meet, in tasks of bounded
    memory, and nothing is left out.
    """
    parts = F.ceil(size / most).cast("int")
    own = F.pmod(F.xxhash64(member), F.greatest(parts, F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))
    dealt = rows.withColumn("_own", own).withColumn("_other", other)
    return dealt.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other")}).drop("_own", "_other")
