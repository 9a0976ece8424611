"""Property graph as node and edge tables, with idempotent merges.

Everything is a combine-first aggregation over (head, type, tail): a relation
held by a third of all rows is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions.json import variant_items
from ..functions.order import order_key
from ..functions.relations import sanitize_relation

EDGE_KEY = ["head", "rel_type", "tail"]


def valid_triples(triples: DataFrame) -> DataFrame:
    """Rows with all three parts; malformed triples have NULL parts."""
    return triples.filter("head is not null and rel is not null and tail is not null")


def graph_nodes(triples: DataFrame) -> DataFrame:
    """Distinct head and tail names, not stripped; one scan."""
    names = valid_triples(triples).select(F.explode(F.array("head", "tail")).alias("name"))
    return names.distinct()


def graph_edges(triples: DataFrame, *order: str) -> DataFrame:
    """Distinct edges with the raw relation written last, and their support.

    ``order`` lists the columns that say which row is later. Equal triples
    are merged first, by hash, so that types are made and relations compared
    for distinct triples only.
    """
    rows = valid_triples(triples).select("head", "rel", "tail", order_key(triples, *order).alias("_last"))
    distinct = rows.groupBy("head", "rel", "tail").agg(F.max("_last").alias("_last"), F.count("*").alias("_n"))
    typed = distinct.withColumn("rel_type", sanitize_relation(F.col("rel")))
    return typed.groupBy(*EDGE_KEY).agg(
        F.max_by("rel", F.struct("_last", "rel")).alias("rel_name"), F.sum("_n").alias("support")
    )


def merge_edges(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new edges, the new relation name where both have the edge.

    Merging the same batch again changes nothing.
    """
    columns = [*EDGE_KEY, "rel_name"]
    both = existing.select(*columns, F.lit(0).alias("_batch")).unionByName(
        new.select(*columns, F.lit(1).alias("_batch"))
    )
    return both.groupBy(*EDGE_KEY).agg(F.max_by("rel_name", "_batch").alias("rel_name"))


def new_nodes(existing: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes that are not in the graph yet."""
    return nodes.join(existing.select("name"), "name", "left_anti")


def graph_counts(edges: DataFrame) -> DataFrame:
    """Number of nodes and edges, from one pass over the edges: nodes are their ends.

    Each edge gives its two names and a mark; counting distinct names after a
    merge by name keeps the edges' own number beside them.
    """
    ends = edges.select(F.explode(F.array("head", "tail")).alias("name"))
    per_name = ends.groupBy("name").agg(F.count("*").alias("ends"))
    both = per_name.agg(F.count("*").alias("nodes"), F.coalesce((F.sum("ends") / 2).cast("long"), F.lit(0)).alias("edges"))
    return both.select(F.inline(F.array(*(
        F.struct(F.lit(w).alias("what"), F.col(w).alias("n")) for w in ("nodes", "edges")
    ))))


def labelled(nodes: DataFrame, label: Column | str = L.NODE_LABEL) -> DataFrame:
    """Nodes with a ``label`` column: one name for all, or an expression over the nodes."""
    return nodes.withColumn("label", label if isinstance(label, Column) else F.lit(label))


def graph_labels(nodes: DataFrame, limit: int = 10) -> DataFrame:
    """Distinct labels of a node table (name, label), in order."""
    return nodes.select("label").distinct().orderBy("label").limit(limit)


def graph_sample(edges: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` edges in key order (a top-n, no full sort)."""
    return edges.orderBy(*EDGE_KEY).limit(n)


def import_total(records: DataFrame, triplets: str = "triplets") -> DataFrame:
    """Length of all triple lists, malformed items included; other values count 0."""
    size = F.coalesce(F.size(variant_items(F.col(triplets))), F.lit(0))
    return records.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("total"))


# --- stored graph: append a batch, read the current state ---------------------


def write_batch(triples: DataFrame, path: str, batch: int, *order: str, started: int = 1) -> None:
    """Add one batch of triples to the stored graph.

    ``started`` names the import that the batch belongs to: a positive number
    that rises from import to import, such as the time it was set up. The
    batch goes to a partition of its own under it, replacing an earlier try of
    the same batch, so a repeated run changes nothing, another import's
    batches are never touched, and the cost is that of the batch.
    """
    if started < 1:
        raise ValueError("started must be positive; 0 is the compacted graph")
    edges = graph_edges(triples, *order).drop("support")
    edges.write.mode("overwrite").parquet(f"{path}/edges/started={int(started)}/batch={int(batch)}")


def read_edges(spark, path: str) -> DataFrame:
    """Current edges with the relation name of the latest batch of the latest import."""
    stored = spark.read.option("basePath", f"{path}/edges").parquet(f"{path}/edges")
    late = F.struct(F.col("started").cast("long"), F.col("batch").cast("long"))
    return stored.groupBy(*EDGE_KEY).agg(F.max_by("rel_name", late).alias("rel_name"))


def read_nodes(spark, path: str) -> DataFrame:
    """Current nodes: the ends of all edges."""
    stored = spark.read.parquet(f"{path}/edges")
    return stored.select(F.explode(F.array("head", "tail")).alias("name")).distinct()


def compact(spark, path: str, target: str) -> None:
    """Write the current edges as the beginning of a new stored graph.

    They stand before every import, in a partition that no batch can have.
    """
    read_edges(spark, path).write.mode("overwrite").parquet(f"{target}/edges/started=0/batch=0")


def send_edges(
    edges: DataFrame,
    connect: Callable[[], Callable[[list[dict]], None]],
    batch_size: int = 1000,
    partitions: int | None = None,
) -> None:
    """Hand the merged edges to an external graph store in batches.

    ``connect`` is called once per partition and returns a function that
    merges a list of edge dicts. A partition may be sent again when its task
    is lost, so that function must merge, not insert. With ``partitions`` the
    edges are spread over that many writers by head.
    """

    def send(rows: Iterator[Row]) -> None:
        merge, held = None, []
        for row in rows:
            merge = merge or connect()
            held.append(row.asDict())
            if len(held) >= batch_size:
                merge(held)
                held = []
        if held:
            merge(held)

    (edges.repartition(partitions, "head") if partitions else edges).foreachPartition(send)
