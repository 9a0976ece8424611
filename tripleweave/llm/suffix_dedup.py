"""Removal of long byte strings that occur elsewhere, with a logarithmic family of sparse suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, mixed, partitions_of, powers, ranges, runs, stage, text_bytes

#: Bytes whose fingerprint chooses the sampled places.
PRINT = 32
ENTRY = "key long, kind long, row long, at int, back int, upto int"
CONTEXT = "key long, salt int, salts int, row long, doc_id long, first int, lead int, count int, piece binary"
FOUND = "row long, start int, stop int, id long"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def prefix_length(length: int) -> int:
    """Bytes of a suffix that make its key: its first four in order, all of them as a fingerprint.

    Every window around a chosen place covers so many bytes from the place on,
    or so many that end with the place's fingerprint.
    """
    return (length + PRINT) // 2


def sampled(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Sampled suffixes of one text: key, kind, place, first and last start of the windows that each one stands for.

    A window of ``length`` bytes chooses the place of the smallest fingerprint
    that lies wholly in it, the leftmost of equals. It is represented by the
    suffix there, or, where its larger part stands before, by the suffix that
    begins as much earlier as fits. So equal windows are represented by equal
    suffixes at equal offsets, a few suffixes in a hundred stand for all, and
    a key tells more than half of a window. ``kind`` identifies all bytes of
    the windows together.
    """
    p = powers()
    span, reach = length - PRINT + 1, prefix_length(length)
    for begin in range(0, max(0, len(data) - length + 1), BLOCK - length + 1):
        part = data[begin : begin + BLOCK]
        if len(part) < length:
            break
        s = p.sums(part)
        m = len(part) - PRINT + 1
        print_ = mixed((s[PRINT:] - s[:m]) * p.down[:m])
        packed = (print_ & np.uint64(0xFFFFFFFFFF000000)) | np.arange(m, dtype=np.uint64)
        # minimum of every ``span`` neighbours: suffix and prefix minima of blocks of that size
        blocks = np.full(-(-m // span) * span, np.iinfo(np.uint64).max, np.uint64)
        blocks[:m] = packed
        blocks = blocks.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(blocks, axis=1).ravel()
        windows = m - span + 1
        least = np.minimum(ahead[:windows], behind[span - 1 : span - 1 + windows])
        place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        cut = runs(place)
        at, first, last = place[cut[:-1]], cut[:-1], cut[1:] - 1
        # windows that reach ``reach`` bytes from the place on, and those that begin earlier
        turn = at - (length - reach)
        right, left = last >= turn, first < turn
        at, first, last = (
            np.concatenate((at[right], turn[left])), np.concatenate((np.maximum(first, turn)[right], first[left])),
            np.concatenate((last[right], np.minimum(last, turn - 1)[left])),
        )
        four = part[at[:, None] + np.arange(4)].astype(np.uint64)
        lead = four[:, 0] << np.uint64(56) | four[:, 1] << np.uint64(48) | four[:, 2] << np.uint64(40) | four[:, 3] << np.uint64(32)
        whole = mixed((s[at + reach] - s[at]) * p.down[at])
        key = (lead | whole >> np.uint64(32)) ^ np.uint64(1 << 63)  # signed numbers in the order of the bytes
        whole = (s[last + length] - s[first]) * p.down[first]
        kind = mixed(whole + mixed((at - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)))
        yield key.view(np.int64), kind.view(np.int64), at + begin, first + begin, last + begin


def entries(length: int):
    """mapInArrow function: sampled suffixes of (row, text); ``back`` and ``upto`` lead from it to its first and last window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            rows = batch.column("row").to_numpy()
            held, size = [], 0
            for k in np.flatnonzero(np.diff(bounds) >= length):
                for key, kind, at, first, last in sampled(data[bounds[k] : bounds[k + 1]], length):
                    held.append((key, kind, np.full(len(key), rows[k]), at, at - first, at - last))
                    size += len(key)
                    if size > 100_000:
                        yield entry_batch(held)
                        held, size = [], 0
            if held:
                yield entry_batch(held)

    return run


def entry_batch(held: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    arrays = [pa.array(np.concatenate(c), t) for c, t in zip(zip(*held), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "kind", "row", "at", "back", "upto"])


class IndexFamily:
    """Suffix arrays of batches, merged geometrically: (rank, table of key and n, sorted by key in each part).

    ``add`` scans the array of a new batch against every level by merge join
    and keeps the keys found on both sides, and those that the batch has
    twice; then levels of equal rank are merged into one of the next rank,
    so that B batches leave at most log2(B) + 1 levels and each suffix is
    written so many times. Tables lie in the shared folder.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []
        self.touched: DataFrame | None = None

    def _touch(self, keys: DataFrame) -> None:
        self.touched = keys if self.touched is None else self.touched.unionByName(keys)

    def add(self, suffixes: DataFrame) -> None:
        array = stage(suffixes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("key"), "suffix-level")
        self._touch(array.where("n > 1").select("key"))
        for _, level in self.levels:
            self._touch(array.select("key").join(level.select("key"), "key"))
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, other = self.levels.pop()
            merged = array.unionByName(other).groupBy("key").agg(F.sum("n").alias("n"))
            array, rank = stage(merged.sortWithinPartitions("key"), "suffix-level"), rank + 1
        self.levels.append((rank, array))


def contexts(length: int):
    """mapInArrow function over texts with their wanted suffixes: the bytes of the windows around each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                one = batch.slice(k, 1)
                data = text_bytes(one.column("text"))[0].tobytes()
                doc_id, row = one.column("doc_id")[0].as_py(), one.column("row")[0].as_py()
                out = []
                for w in one.column("wanted")[0].as_py():
                    first, last = w["at"] - w["back"], w["at"] - w["upto"]
                    out.append({
                        "key": w["key"], "salt": w["salt"], "salts": w["salts"], "row": row, "doc_id": doc_id, "first": first,
                        "lead": w["back"], "count": last - first + 1, "piece": data[first : last + length],
                    })
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("key", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()),
                    ("first", pa.int32()), ("lead", pa.int32()), ("count", pa.int32()), ("piece", pa.binary()),
                ]))

    return run


def window_ids(pieces: list[bytes], keys: np.ndarray, leads: np.ndarray, counts: np.ndarray, length: int):
    """An identity per window of each piece, made of key, offset of the suffix and all bytes; piece and window number."""
    p = powers()
    ids, owner, number = [], [], []
    at = 0
    while at < len(pieces):
        size, stop = 0, at
        while stop < len(pieces) and (stop == at or size + len(pieces[stop]) <= BLOCK):
            size += len(pieces[stop])
            stop += 1
        s = p.sums(np.frombuffer(b"".join(pieces[at:stop]), np.uint8))
        begin = np.concatenate(([0], np.cumsum([len(x) for x in pieces[at : stop - 1]]))).astype(np.int64)
        mine = np.repeat(np.arange(at, stop), counts[at:stop])
        n = ranges(np.zeros(stop - at, np.int64), counts[at:stop])
        start = begin[mine - at] + n
        bytes_ = mixed((s[start + length] - s[start]) * p.down[start])
        offset = (leads[mine] - n).astype(np.uint64)
        ids.append(mixed(bytes_ ^ mixed(keys[mine].view(np.uint64) + offset * np.uint64(0x9E3779B97F4A7C15))))
        owner.append(mine)
        number.append(n)
        at = stop
    return np.concatenate(ids), np.concatenate(owner), np.concatenate(number)


def compared(length: int):
    """mapInArrow function over contexts sorted by key and salt: windows that another context of the group has too.

    A key that was dealt over several salts also gives what they must still
    compare: its windows unseen so far with an id, and one row without place
    for each id that is decided here.
    """

    def decide(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        first, counts = t["first"].to_numpy(), t["count"].to_numpy().astype(np.int64)
        ids, owner, number = window_ids(t["piece"].to_pylist(), t["key"].to_numpy(), t["lead"].to_numpy(), counts, length)
        order = np.argsort(ids, kind="stable")
        cut = runs(ids[order])
        again = np.zeros(len(ids), bool)
        again[order] = np.repeat(np.diff(cut) > 1, np.diff(cut))
        rows = t["row"].to_numpy()
        start = first[owner] + number
        # neighbouring windows of a context make one span
        hit = np.flatnonzero(again)
        new = np.concatenate(([True], (owner[hit[1:]] != owner[hit[:-1]]) | (hit[1:] != hit[:-1] + 1))) if len(hit) else np.zeros(0, bool)
        head = hit[new]
        tail = hit[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(hit) - 1])).astype(np.int64)] if len(hit) else hit
        salted = (t["salts"].to_numpy() > 1)[owner]
        undecided = np.flatnonzero(salted & ~again)
        witness = np.unique(ids[salted & again])
        n = len(head), len(undecided), len(witness)
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(rows[owner[head]], pa.int64()), pa.array(rows[owner[undecided]], pa.int64()), none(n[2])]),
            pa.array(np.concatenate((start[head], start[undecided], np.zeros(n[2]))).astype(np.int32)),
            pa.array(np.concatenate((start[tail] + length, start[undecided] + length, np.zeros(n[2]))).astype(np.int32)),
            pa.concat_arrays([none(n[0]), pa.array(ids[undecided].view(np.int64)), pa.array(witness.view(np.int64))]),
        ], names=["row", "start", "stop", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            if not len(batch):
                continue
            key, salt = batch.column("key").to_numpy(), batch.column("salt").to_numpy()
            change = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1])) + 1, [len(key)]))
            for a, b in zip(change[:-1], change[1:]):
                if held and (key[a], salt[a]) != last and size >= 2000:
                    yield decide(held)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += b - a
                last = (key[a], salt[a])
        if held:
            yield decide(held)

    return run


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans."""
    for batch in batches:
        for k in range(0, len(batch), 256):
            part = batch.slice(k, 256)
            data, bounds = text_bytes(part.column("text"))
            spans, out = part.column("spans"), []
            for i in range(len(part)):
                own = data[bounds[i] : bounds[i + 1]]
                some = spans[i]
                n = 0
                if some.is_valid and len(some.values):
                    depth = np.zeros(len(own) + 1, np.int32)
                    np.add.at(depth, some.values.field("start").to_numpy(), 1)
                    np.add.at(depth, some.values.field("stop").to_numpy(), -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    n = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
                    left = own[~gone].tobytes()
                else:
                    left = own.tobytes()
                out.append((part.column("doc_id")[i].as_py(), len(own), len(own) - len(left), n, hashlib.sha256(left).hexdigest(), left))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, batches: int = 4, group: int = 8192,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay).

    Texts are UTF-8 bytes, null is empty. A byte goes if it is covered by a
    string of ``length`` bytes that starts anywhere else too, in this or
    another row; strings are judged on the input and never cross rows. All
    places of such a string go, so a repeated row loses all that is at least
    ``length`` long. Shorter texts stay. An empty table gives no rows; the
    input must be a table, whose rows come in the same order each time.

    Two suffixes in about 85 are kept in the index family, chosen by content
    so that equal strings choose alike. Suffixes with a key that the family met
    more than once are gathered; those that share all bytes of their windows
    with another are decided by counting. One of each such kind, and all
    others, are compared window by window within their key. Keys of more than
    ``group`` kinds are dealt over salts, whose undecided windows are counted
    in a last shuffle with map-side combining.
    """
    n = partitions_of(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    long = rows.where(F.octet_length("text") >= length)
    family = IndexFamily()
    for b in range(batches):
        batch = long.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == b)
        family.add(batch.select("row", "text").mapInArrow(entries(length), ENTRY).select("key"))
    met = stage(
        long.select("row", "text").mapInArrow(entries(length), ENTRY).join(family.touched.distinct(), "key", "left_semi"), "suffix-matches"
    )
    kinds = met.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "at", "back", "upto")).alias("one"))
    equal = met.join(kinds.where("n > 1").select("key", "kind"), ["key", "kind"], "left_semi").select(
        "row", (F.col("at") - F.col("back")).alias("start"), (F.col("at") - F.col("upto") + length).alias("stop")
    )
    several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    salts = F.ceil(F.col("kinds") / group).cast("int")
    wanted = kinds.join(several, "key").select(
        "one.row",
        F.struct(
            "key", "one.at", "one.back", "one.upto", F.pmod(F.xxhash64("one.row", "one.at"), salts).cast("int").alias("salt"), salts.alias("salts")
        ).alias("w"),
    ).groupBy("row").agg(F.collect_list("w").alias("wanted"))
    by_row = rows.repartition(n, "row")
    pieces = by_row.join(wanted, "row").select("row", "doc_id", "text", "wanted").mapInArrow(contexts(length), CONTEXT)
    found = pieces.repartition(n, "key", "salt").sortWithinPartitions("key", "salt").mapInArrow(compared(length), FOUND)
    open_ = found.where("id is not null")
    twice = open_.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    across = open_.where("row is not null").join(twice, "id", "left_semi")
    spans = equal.unionByName(found.where("id is null").select("row", "start", "stop")).unionByName(across.select("row", "start", "stop"))
    lists = spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return by_row.join(lists, "row", "left").select("doc_id", "text", "spans").mapInArrow(cut_out, RESULT)
