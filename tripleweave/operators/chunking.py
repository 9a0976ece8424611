"""Documents to chunks, chunk numbering, page assembly."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..sources.storage import stage


def assemble_pages(pages: DataFrame, by: str, order: str, text: str = "text") -> DataFrame:
    """Join the page texts of each document in page order; NULL page is ''.

    The result is one cell per document, so a group is as large as the
    document it returns. Partial lists are built before the shuffle.
    """
    joined = F.expr(f"listagg(coalesce({text}, ''), '\n') within group (order by {order})")
    return pages.groupBy(by).agg(joined.alias("text"))


def explode_lines(
    docs: DataFrame,
    key: str,
    drop: tuple[Callable[[Column], Column], ...] = (),
    text: str = "text",
) -> DataFrame:
    """One row per kept line: key, line_no (1-based), line."""
    return docs.select(key, F.posexplode(X.lines(F.col(text), drop)).alias("p", "line")).select(
        key, (F.col("p") + 1).alias("line_no"), "line"
    )


def explode_sentences(docs: DataFrame, key: str, extra: bool = False, text: str = "text") -> DataFrame:
    """One row per sentence of the cleaned text: key, pos (0-based), sentence."""
    parts = X.sentences(X.clean_text(F.col(text), extra))
    return docs.select(key, F.posexplode(parts).alias("pos", "sentence"))


def chunk_documents(
    docs: DataFrame,
    budget: int = X.DEFAULT_BUDGET,
    extra: bool = False,
    text: str = "text",
    sizes: Callable[[Column], Column] = X.length_sizes,
) -> DataFrame:
    """Clean, split and pack every document; no shuffle.

    Keeps the other columns of ``docs`` as provenance and adds ``chunk_index``
    (from 1 per document), ``id`` (the same number) and the chunk ``text``.
    ``sizes`` maps an array of sentences to an array of token counts; pass
    another one to count with a tokenizer.
    """
    keep = [c for c in docs.columns if c != text]
    parts = X.sentences(X.clean_text(F.col(text), extra))
    if sizes is X.length_sizes:
        packed = docs.select(*keep, F.posexplode(X.let(parts, lambda p: X.pack(p, budget))).alias("p", "text"))
    else:
        sized = docs.select(*keep, parts.alias("_parts")).withColumn("_sizes", sizes(F.col("_parts")))
        chunks = X.cut_chunks(F.col("_parts"), X.chunk_starts(F.col("_sizes"), budget))
        packed = sized.select(*keep, F.posexplode(chunks).alias("p", "text"))
    return packed.select(
        *keep, (F.col("p") + 1).alias("chunk_index"), (F.col("p") + 1).cast("bigint").alias("id"), "text"
    )


def tokenizer_sizes(load: Callable[[], Callable[[str], int]]) -> Callable[[Column], Column]:
    """Sentence sizes from a tokenizer; ``load`` runs once per Python worker.

    Returns a function for the ``sizes`` argument of ``chunk_documents``. If
    ``load`` fails, the length estimate is used, as without a tokenizer.
    """

    @F.pandas_udf("array<int>")
    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            count = load()
        except Exception:
            count = lambda s: max(1, len(s) // 2)
        for batch in batches:
            yield pd.Series([[count(s) for s in parts] for parts in batch])

    return sizes


def cl100k_counter() -> Callable[[str], int]:
    """Loader for ``tokenizer_sizes``: length in cl100k_base tokens."""
    import tiktoken

    encoding = tiktoken.get_encoding("cl100k_base")
    return lambda s: len(encoding.encode(s))


def file_offsets(counts: DataFrame, file: Sequence[str]) -> DataFrame:
    """Running total of ``n`` before each row, in ``file`` order.

    ``counts`` has one row per file. A window over all of them would run in
    one task, so they are range-partitioned, summed within each range, and the
    ranges (a few thousand at most) are then offset by their totals. The
    range number is written down first: it must not change between the uses.
    """
    ranged = stage(
        counts.repartitionByRange(*file).sortWithinPartitions(*file).withColumn("_range", F.spark_partition_id()),
        "file_offsets",
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum("n").alias("_n"))
    # one row per range: bounded by the number of shuffle partitions
    bases = totals.select(
        "_range", F.coalesce(F.sum("_n").over(before.orderBy("_range")), F.lit(0)).alias("_base")
    )
    local = F.coalesce(F.sum("n").over(before.partitionBy("_range").orderBy(*file)), F.lit(0))
    return (
        ranged.withColumn("_local", local)
        .join(bases, "_range")
        .select(*file, (F.col("_base") + F.col("_local")).alias("offset"))
    )


def packed_documents(
    docs: DataFrame, budget: int = X.DEFAULT_BUDGET, extra: bool = False, text: str = "text"
) -> DataFrame:
    """Clean, split and pack every document: the other columns, ``chunks`` (list of texts) and their number ``n``."""
    keep = [c for c in docs.columns if c != text]
    parts = X.sentences(X.clean_text(F.col(text), extra))
    packed = docs.select(*keep, X.let(parts, lambda p: X.pack(p, budget)).alias("chunks"))
    return packed.withColumn("n", F.size("chunks").cast("bigint"))


def numbered_chunks(
    docs: DataFrame, *file: str, budget: int = X.DEFAULT_BUDGET, extra: bool = False, text: str = "text"
) -> DataFrame:
    """Chunks of all documents, numbered from 1 over the corpus in the order of ``file``, then of chunks.

    ``file`` names the columns that tell documents apart, such as the whole
    path: names that repeat in two folders are two documents, and documents
    that repeat all of ``file`` are numbered one after another.

    Documents are packed once and stored with their number of chunks. Only
    keys and numbers are shuffled and sorted; each document then gets the
    number its chunks begin at, and chunks are made behind that join.
    """
    tagged = packed_documents(docs, budget, extra, text).withColumn("_row", F.monotonically_increasing_id())
    stored = stage(tagged, "packed_documents")
    offsets = file_offsets(stored.select(*file, "_row", "n"), [*file, "_row"]).select("_row", "offset")
    placed = stored.join(offsets, "_row")
    keep = [c for c in docs.columns if c != text]
    rows = placed.select(*keep, "offset", F.posexplode("chunks").alias("p", "text"))
    return rows.select(*keep, (F.col("p") + 1).alias("chunk_index"), (F.col("offset") + F.col("p") + 1).alias("id"), "text")
