"""Near-duplicate documents: fast similarity sketches, banding, verification on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, partitions_of, ranges, runs, shards, stage, text_bytes, words_of
from .graph import components, in_blocks

#: A word is whatever stands between blanks and the control characters 9 to 13.
IS_WORD = np.ones(256, bool)
IS_WORD[32] = IS_WORD[9:14] = False

#: Coordinates of a sketch, coordinates of a band.
WIDTH, ROWS = 128, 4
BANDS = WIDTH // ROWS
SIGNATURE = "doc_id long, n_shingles long, s1 long, s2 long, sketch binary"


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row of fewer words has one shingle of all of them."""
    _, _, h, first = words_of(data, bounds, IS_WORD)
    factor = mixed(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(h) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(words):
        rolled += h[k : k + n] * factor[k]
    rolled = mixed(rolled)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:
            yield mixed((h[a:b] * factor[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """Fast similarity sketch: WIDTH coordinates of 16 bits.

    In round i every element is hashed anew and falls into a random bin (in
    the second WIDTH rounds into bin i - WIDTH, so that none stays empty); a
    bin keeps its smallest value of the first round that reaches it. Rounds
    end once all bins are full. The rounds run a few at a time: one sort by
    bin, round and value brings each bin's winner to the front.
    """
    full = np.zeros(WIDTH, bool)
    out = np.zeros(WIDTH, np.uint64)
    at, step = 0, max(1, 1024 // len(shingles))
    while not full.all() and at < 2 * WIDTH:
        rounds = np.arange(at, min(2 * WIDTH, at + step), dtype=np.uint64)[:, None]
        v = mixed(shingles[None, :] + (rounds + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        chosen = np.where(rounds < WIDTH, v >> np.uint64(57), rounds - np.minimum(rounds, np.uint64(WIDTH)))
        key = np.sort((chosen << np.uint64(57) | rounds << np.uint64(49) | v & np.uint64((1 << 49) - 1)).ravel())
        bins = (key >> np.uint64(57)).astype(np.int64)
        head = runs(bins)[:-1]
        new = head[~full[bins[head]]]
        out[bins[new]] = key[new]
        full[bins[new]] = True
        at += step
    return (mixed(out) & np.uint64(0xFFFF)).astype("<u2")


def signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shards(batch, "text", 1 << 20):
                n, s1, s2, sketches = [], [], [], []
                for s in shingle_sets(*text_bytes(part.column("text")), words):
                    n.append(len(s))
                    s1.append(int(mixed(s).sum().astype(np.int64)))
                    s2.append(int(mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().astype(np.int64)))
                    sketches.append(sketch_of(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sketches, pa.binary())],
                    names=["doc_id", "n_shingles", "s1", "s2", "sketch"],
                )

    return run


def band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rep): the ROWS coordinates of a band are one 64-bit number, mixed with the band's place."""
    salt = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        if len(batch):
            lines = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u8").reshape(-1, BANDS)
            keys = mixed(lines + salt).view(np.int64).ravel()
            reps = np.repeat(batch.column("rep").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(reps)], names=["key", "rep"])


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of consecutive rows with equal keys: many small groups at a time, or one large one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            yield pa.Table.from_batches([*held, batch.slice(0, change[-1])])
            held = [batch.slice(change[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    columns = [table.column(k).to_numpy() for k in keys]
    return np.concatenate(([0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1, [len(table)]))


def edge_batch(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def alike(least: int, small: int = 64):
    """mapInArrow function over buckets: links between sketches that agree in ``least`` coordinates or more.

    Small buckets give all such pairs. In a larger one a search goes from each
    reached sketch to those not reached yet, so it gives a spanning forest of
    the same links and a bucket of near copies costs little more than one pass.
    """
    keys = ["key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, keys):
            rep = table.column("rep").to_numpy()
            lines = np.frombuffer(b"".join(table.column("sketch").to_pylist()), "<u2").reshape(-1, WIDTH)
            starts = group_starts(table, keys)
            sizes = np.diff(starts)
            stop = np.repeat(starts[1:], sizes)
            row = np.arange(len(rep))
            count = np.where(np.repeat(sizes, sizes) <= small, stop - 1 - row, 0)
            left, right = np.repeat(row, count), ranges(row + 1, count)
            for at in range(0, len(left), 50_000):
                l, r = left[at : at + 50_000], right[at : at + 50_000]
                ok = (lines[l] == lines[r]).sum(axis=1) >= least
                yield edge_batch(rep[l[ok]], rep[r[ok]])
            for k in np.flatnonzero(sizes > small):
                own, mine = lines[starts[k] : starts[k + 1]], rep[starts[k] : starts[k + 1]]
                rest, queue, a, b = np.arange(len(mine)), [], [], []
                while len(rest):
                    if not queue:
                        queue, rest = [rest[0]], rest[1:]
                    one = queue.pop()
                    ok = (own[rest] == own[one]).sum(axis=1) >= least
                    a += [mine[one]] * int(ok.sum())
                    b += mine[rest[ok]].tolist()
                    queue += rest[ok].tolist()
                    rest = rest[~ok]
                yield edge_batch(a, b)

    return run


def linked(sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
    """Spanning forest of the sets with 100 * intersection >= percent * union, compared on all their elements.

    Each reached set is compared with every set not reached yet; sets that
    are reached already are connected, so nothing is lost.
    """
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    mark = np.zeros(int(flat.max()) + 1, bool)
    rest, queue, a, b = np.arange(len(sets)), [], [], []
    held, cut = flat, starts[:-1]
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
            held, cut = held[sizes[queue[0]] :], (cut - sizes[queue[0]])[1:]
            if not len(rest):
                break
        one = queue.pop()
        own = flat[starts[one] : starts[one + 1]]
        mark[own] = True
        common = np.add.reduceat(mark[held], cut, dtype=np.int64)
        mark[own] = False
        ok = 100 * common >= percent * (sizes[one] + sizes[rest] - common)
        if ok.any():
            a += [one] * int(ok.sum())
            b += rest[ok].tolist()
            queue += rest[ok].tolist()
            held = held[np.repeat(~ok, sizes[rest])]
            rest = rest[~ok]
            cut = np.concatenate(([0], np.cumsum(sizes[rest])))[:-1]
    return a, b


def verified(words: int, percent: int):
    """mapInArrow function over clusters of candidates: links that hold on the whole shingle sets."""
    keys = ["cluster", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets, reps = None, [], []
        for batch in batches:
            for part in shards(batch, "text", 1 << 20):
                values = zip(*(part.column(k).to_pylist() for k in [*keys, "rep", "s1"]))
                for (*key, rep, s1), s in zip(values, shingle_sets(*text_bytes(part.column("text")), words)):
                    if key != now:
                        if len(sets) > 1:
                            a, b = linked(sets, percent)
                            yield edge_batch([reps[x] for x in a], [reps[x] for x in b])
                        now, sets, reps = key, [], []
                    if int(mixed(s).sum().astype(np.int64)) == s1:  # else another text under the same id
                        sets.append(s)
                        reps.append(rep)
        if len(sets) > 1:
            a, b = linked(sets, percent)
            yield edge_batch([reps[x] for x in a], [reps[x] for x in b])

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75, agree: int = 64,
    bucket_rows: int = 4096, cluster_shingles: int = 2_000_000,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    A document's set are its distinct shingles of ``words`` words (A-Z
    lower-cased; of fewer words, all of them as one). Documents with 100 *
    intersection >= ``percent`` * union are linked; component_id is the
    smallest id that can be reached, kept says that it is the row's own. Null,
    empty and wordless texts have no set and no link. Rows with a null id are
    kept, linked with nothing and have no component. Rows that repeat an id
    are judged each by its text. An empty table gives no rows.

    Equal sets are one node, so groups of copies cost a map-side minimum.
    Sketches of 128 coordinates in 32 bands of 4 name the candidates: a pair
    at 0.75 shares no band once in 190,000 times. Within buckets sketches
    must agree in ``agree`` coordinates (0.75 is expected to give 96, with a
    deviation of 4.9); the links' components are clusters, in which the links
    are confirmed on whole sets. Buckets of more than ``bucket_rows`` rows and
    clusters of more than ``cluster_shingles`` are dealt into parts, all pairs
    of which meet. Only forests of links leave a task.
    """
    spark = docs.sparkSession
    n = partitions_of(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sigs = stage(rows.mapInArrow(signatures(words), SIGNATURE), "near-signatures")
    sets = stage(
        sigs.where("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2")
        .agg(F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("x"))
        .select("s1", "s2", F.col("x.doc_id").alias("rep"), "x.n_shingles", "x.sketch"),
        "near-sets",
    )
    keys = sets.select("rep", "sketch").mapInArrow(band_keys, "key long, rep long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    bucketed = in_blocks(keys.join(shared, "key"), "rep", F.col("rows"), bucket_rows).select("key", "i", "j", "rep")
    buckets = bucketed.join(sets.select("rep", "sketch"), "rep").repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    candidates = buckets.select("key", "i", "j", "rep", "sketch").mapInArrow(alike(agree), "a long, b long")
    clusters = components(candidates, "near-clusters")
    member = stage(
        clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
        .unionByName(clusters.select(F.col("component").alias("rep"), F.col("component").alias("cluster")).distinct())
        .join(sets.select("rep", "n_shingles", "s1"), "rep"),
        "near-members",
    )
    sizes = member.groupBy("cluster").agg(F.sum("n_shingles").alias("size"))
    dealt = in_blocks(member.join(sizes, "cluster"), "rep", F.col("size"), cluster_shingles).select("cluster", "i", "j", "rep", "s1")
    # a merge join at every size: the texts cross the network once, whatever share of them is asked for
    texts = dealt.hint("merge").join(rows.where("doc_id is not null"), dealt["rep"] == rows["doc_id"]).select("cluster", "i", "j", "rep", "s1", "text")
    links = texts.repartition(n, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "rep").mapInArrow(
        verified(words, percent), "a long, b long"
    )
    found = components(links, "near-components")
    named = sets.select("s1", "s2", "rep").join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("s1").alias("_s1"), F.col("s2").alias("_s2"), F.coalesce("component", "rep").alias("component_id")
    )
    mine = (sigs["s1"] == named["_s1"]) & (sigs["s2"] == named["_s2"]) & (sigs["n_shingles"] > 0) & sigs["doc_id"].isNotNull()
    out = sigs.join(named, mine, "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns: of each component that of the smallest id, and all rows with a null id."""
    gone = near_duplicates(docs, id_col, text_col, **options).where("not kept").select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col("_gone_id"), "left_anti")
