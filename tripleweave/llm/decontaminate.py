"""Benchmark decontamination with word suffix arrays of the training text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranges, runs, shards, stage, text_bytes, words_of

#: Bytes of a word after lower-casing A-Z are 0-9, a-z and all of 128 and more.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

#: Bytes of text in one suffix array, unless a single row is longer; with its temporaries it takes about 20 times as much.
ARRAY = 2 << 20

BITS = np.uint64(24)  # of a place in a shard of at most 2^24 words
LOW = np.uint64((1 << 24) - 1)
#: Set in every word, so that its symbol stands above the one that ends a document.
ABOVE_END = np.uint64(1 << 24)
HITS = "row long, n_words long, spans array<struct<start:int,stop:int>>, items array<string>, longest int, longest_item string, longest_at int"


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``symbols`` in the order of the first ``depth`` symbols that follow, by prefix doubling.

    After a pass over single symbols each pass sorts what is still tied by the
    rank that stands h places further, and doubles h. Symbols are 40-bit.
    """
    n = len(symbols)
    packed = np.sort((symbols << BITS) | np.arange(n, dtype=np.uint64))
    order = (packed & LOW).astype(np.int64)
    starts = runs(packed >> BITS)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.repeat(starts[:-1], np.diff(starts))
    h = 1
    sizes = np.diff(starts)
    begin, sizes = starts[:-1][sizes > 1], sizes[sizes > 1]
    while h < depth and len(begin):
        at = ranges(begin, sizes)
        places = order[at]
        key = (np.repeat(begin, sizes) << 25) | (rank[np.minimum(places + h, n)] + 1)
        by = np.argsort(key)
        key = key[by]
        order[at] = places = places[by]
        cut = runs(key)
        sizes = np.diff(cut)
        rank[places] = np.repeat(at[cut[:-1]], sizes)
        begin, sizes = at[cut[:-1]][sizes > 1], sizes[sizes > 1]
        h *= 2
    return order


class Items:
    """A block of benchmark items as words: hashes, ids, and the length of the window at each word (0: none)."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        data, bounds = text_bytes(pa.array(texts, pa.string()))
        _, _, hashes, first = words_of(data, bounds, IS_WORD)
        self.hashes = hashes | ABOVE_END
        n = np.diff(first)
        self.ids = np.array(ids, object)
        self.item = np.repeat(np.arange(len(ids)), n)
        self.place = np.arange(len(self.hashes)) - np.repeat(first[:-1], n)
        self.left = np.repeat(n, n) - self.place  # words to the end of the item
        size = np.minimum(window, np.repeat(n, n))
        self.size = np.where(self.left >= size, size, 0)
        self.depth = int(n.max()) if len(n) else 0


def bisect(column, array: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray, after: bool) -> np.ndarray:
    """For each query the first place of [lo, hi) whose symbol is not below (after: above) its value."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        seen = column(array[mid])
        right = seen <= value[open_] if after else seen < value[open_]
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]


def search(symbols: np.ndarray, array: np.ndarray, items: Items):
    """Binary search of every item suffix: its range in the array for its window, and its longest match and place.

    All suffixes go down together, one word a step; those with an empty range drop out.
    """
    q = len(items.hashes)
    want = items.hashes >> BITS
    lo, hi = np.zeros(q, np.int64), np.full(q, len(array), np.int64)
    window_lo, window_hi = np.zeros(q, np.int64), np.zeros(q, np.int64)
    longest, where = np.zeros(q, np.int64), np.zeros(q, np.int64)
    live = np.arange(q)
    d = 0
    padded = np.append(symbols, np.zeros(1, np.uint64))
    while len(live):
        value = want[live + d]
        column = lambda places: padded[np.minimum(places + d, len(symbols))]  # noqa: B023, E731
        a = bisect(column, array, lo[live], hi[live], value, False)
        b = bisect(column, array, a, hi[live], value, True)
        found = a < b
        live, a, b = live[found], a[found], b[found]
        lo[live], hi[live] = a, b
        d += 1
        longest[live], where[live] = d, array[a] if len(array) else 0
        full = live[items.size[live] == d]
        window_lo[full], window_hi[full] = lo[full], hi[full]
        live = live[items.left[live] > d]
    return window_lo, window_hi, longest, where


def scan(items: Items):
    """mapInArrow function: one row per document with its words, hit spans, items and longest verbatim match."""

    def shard(batch: pa.RecordBatch):
        data, bounds = text_bytes(batch.column(1))
        _, _, hashes, first = words_of(data, bounds, IS_WORD)
        n_words = np.diff(first)
        docs = len(n_words)
        # one lowest symbol behind each document: no match crosses it
        place = np.arange(len(hashes)) + np.repeat(np.arange(docs), n_words)
        full = np.zeros(len(hashes) + docs, np.uint64)
        full[place] = hashes | ABOVE_END
        symbols = full >> BITS
        start = first[:-1] + np.arange(docs)
        array = suffix_array(symbols, max(1, items.depth))
        lo, hi, longest, where = search(symbols, array, items)
        q = np.flatnonzero(hi > lo)
        at = array[ranges(lo[q], (hi - lo)[q])]
        q = np.repeat(q, (hi - lo)[q])
        size = items.size[q]
        true = np.ones(len(q), bool)
        for d in range(int(size.max()) if len(q) else 0):  # the array holds 40 bits of a word; confirm on all
            check = np.flatnonzero(true & (size > d))
            true[check] = full[at[check] + d] == items.hashes[q[check] + d]
        q, at, size = q[true], at[true], size[true]
        doc = np.searchsorted(start, at, "right") - 1
        spans: list = [[] for _ in range(docs)]
        hit: list = [[] for _ in range(docs)]
        order = np.lexsort((at, doc))
        cut = runs(doc[order])
        for k in range(len(cut) - 1 if len(q) else 0):
            mine = order[cut[k] : cut[k + 1]]
            d = int(doc[mine[0]])
            b, e = at[mine] - start[d], at[mine] + size[mine] - start[d]
            reach = np.maximum.accumulate(e)
            new = np.concatenate(([True], b[1:] > reach[:-1]))
            last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(b) - 1]))
            spans[d] = [{"start": int(x), "stop": int(y)} for x, y in zip(b[new], reach[last])]
            hit[d] = [items.ids[i] for i in np.unique(items.item[q[mine]])]
        best: list = [None] * docs
        some = np.flatnonzero(longest)
        own = np.searchsorted(start, where[some], "right") - 1
        for k in np.argsort(longest[some], kind="stable"):
            d = int(own[k])
            best[d] = (int(longest[some[k]]), items.ids[items.item[some[k]]], int(where[some[k]] - start[d]))
        return pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()), pa.array(n_words, pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
            pa.array(hit, pa.list_(pa.string())),
            pa.array([x and x[0] for x in best], pa.int32()), pa.array([x and x[1] for x in best], pa.string()),
            pa.array([x and x[2] for x in best], pa.int32()),
        ], names=["row", "n_words", "spans", "items", "longest", "longest_item", "longest_at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shards(batch, "text", ARRAY):
                yield shard(part)

    return run


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[Items]:
    """The items in blocks of ``block_bytes`` of text (or one item); each row passes the driver once, none is kept."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), text_col)
    for item, text in rows.toLocalIterator():
        if ids and size + len(text or "") > block_bytes:
            yield Items(ids, texts, window)
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += len(text or "")
    yield Items(ids, texts, window)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 13, block_bytes: int = 2 << 20,
) -> DataFrame:
    """One row per document: words, hit words, items with occurring windows, longest verbatim match.

    Columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    spans (hit word ranges), items, longest, longest_item, longest_at (the
    longest match that some item suffix has in the shard, where it stands in
    this document). ``window`` consecutive item words, or a whole shorter
    item, are hit wherever they stand. Null or wordless texts have no words
    and no hits. A repeated item id counts once, and so do all items whose id
    is null: their windows hit, they are one of the items (null in ``items``),
    and the digest leaves them out. An empty benchmark hits nothing. Repeated documents each get their row.

    Every task builds suffix arrays of its documents, ``ARRAY`` bytes at a time, and
    binary-searches every item suffix in them; nothing is shuffled. The
    benchmark is sent in blocks of ``block_bytes`` of text: one pass over the
    documents for each block, whose hits are put together by document.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = item_blocks(benchmark, item_id, item_text, window, block_bytes)
    items, following = next(blocks), next(blocks, None)
    if following is None:
        return verdicts(rows.mapInArrow(scan(items), HITS).withColumnRenamed("row", "doc_id"))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    parts = None
    while items is not None:
        part = stage(numbered.select("row", "text").mapInArrow(scan(items), HITS), "contamination-pass")
        parts = part if parts is None else parts.unionByName(part)
        items, following = following, next(blocks, None)
    together = parts.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.flatten(F.collect_list("items")).alias("items"),
        F.max(F.struct("longest", "longest_item", "longest_at")).alias("best"),
    ).select("row", "n_words", "spans", "items", "best.*")
    return verdicts(together.join(numbered.select("row", "doc_id"), "row"))


def merged(spans: F.Column) -> F.Column:
    """Number of words that sorted, possibly overlapping spans cover."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(
        F.array_sort(spans), zero,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["reach"], s["start"]))).cast("long").alias("n"),
            F.greatest(a["reach"], s["stop"]).alias("reach"),
        ),
        lambda a: a["n"],
    )


def verdicts(found: DataFrame) -> DataFrame:
    items = F.array_sort(F.array_distinct("items"))
    out = found.withColumn("n_hit", merged(F.col("spans"))).withColumn("items", items)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "spans", "items", "longest", "longest_item", "longest_at",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, without the contaminated ones; rows with a null id stay.

    Contaminated documents are few beside the corpus and only their ids are joined.
    """
    bad = contamination(docs, benchmark, id_col, text_col, **options).where("contaminated").select("doc_id").distinct()
    return docs.join(bad.withColumnRenamed("doc_id", "_bad_id"), F.col(id_col).cast("long") == F.col("_bad_id"), "left_anti")
