"""Shared pieces of the corpus operators: tables, stage folder, byte and word kernels for Arrow batches."""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes handled at once by the kernels; their temporaries are a small multiple of it.
BLOCK = 1 << 20
#: Bytes of text that one call of a shard function gets, unless a single row is longer.
SHARD = 8 << 20

A_TO_Z = np.arange(256, dtype=np.uint8)
A_TO_Z[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the folder of spark.checkpoint.dir and read it back; cuts lineage.

    Where neither that setting nor a checkpoint folder is given, the table goes
    to the warehouse, which the driver and all executors share as well.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{folder or spark.conf.get('spark.sql.warehouse.dir') + '/stages'}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_bucket(doc_id: str, modulus: int, bucket: int) -> F.Column:
    """crc32 of the id as text falls into ``bucket``; a null id falls into none."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == bucket, F.lit(False))


def once_per_worker(key: str, make):
    """``make()`` kept for all tasks of a Python worker; functions travel by value, so a module global would not last."""
    kept = sys.__dict__.setdefault("_tripleweave_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array in one piece and the bounds of its rows; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def shards(batch: pa.RecordBatch, column: str, most: int = SHARD):
    """Slices of a batch whose ``column`` holds at most ``most`` bytes, or one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit numbers, so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd multiplier and of its inverse, modulo 2^64, and a random number per byte value."""

    def __init__(self, size: int = BLOCK + 257, base: int = 0x9E3779B97F4A7C15):
        self.base = base
        self.up = np.full(size, base, np.uint64)
        self.up[0] = 1
        np.multiply.accumulate(self.up, out=self.up)
        self.down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        self.down[0] = 1
        np.multiply.accumulate(self.down, out=self.down)
        self.byte = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums s of which (s[e] - s[b]) * down[b] identifies data[b:e]; at most BLOCK bytes."""
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.byte[data] * self.up[: len(data)], out=out[1:])
        return out


def powers() -> Powers:
    return once_per_worker("powers", Powers)


def words_of(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray):
    """Starts, ends and 64-bit hashes of the words of all rows, and the first word of each row (with an end).

    ``is_word`` has a truth value per byte, after lower-casing A-Z. The text is
    worked through in blocks, so that temporaries stay small beside it; a word
    that goes on in the next block gets the same hash as one that does not.
    """
    p = powers()
    starts, ends, sums = [], [], []
    edges = np.zeros(len(data) + 1, bool)
    edges[bounds] = True
    for at in range(0, len(data), BLOCK):
        low = A_TO_Z[data[at : at + BLOCK]]
        inside = is_word[low]
        edge = edges[at : at + len(low) + 1]
        left = np.concatenate(([False], inside[:-1]))
        right = np.concatenate((inside[1:], [False]))
        b = np.flatnonzero(inside & (~left | edge[:-1]))
        e = np.flatnonzero(inside & (~right | edge[1:])) + 1
        s = p.sums(low)
        h = (s[e] - s[b]) * p.down[b]
        if len(b) and b[0] == 0 and not edge[0] and starts and len(ends[-1]) and ends[-1][-1] == at:
            sums[-1][-1:] += h[:1] * np.uint64(pow(p.base, int(at - starts[-1][-1]), 1 << 64))
            ends[-1][-1] = e[0] + at
            b, e, h = b[1:], e[1:], h[1:]
        if len(b):
            starts.append(b + at)
            ends.append(e + at)
            sums.append(h)
    if not starts:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    hashes = mixed(np.concatenate(sums) + (ends - starts).astype(np.uint64))
    return starts, ends, hashes, np.searchsorted(starts, bounds)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, with the length at the end."""
    n = len(sorted_keys)
    if not n:
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [n]))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... counts[0] numbers, then those of starts[1], and so on."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift
