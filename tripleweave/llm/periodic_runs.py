"""Periodic runs of words, found online by catchers over dyadic blocks, and texts without the repetitions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, ranges, shards

RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
#: A prime; hashes are polynomials modulo it, at a fixed point.
PRIME = (1 << 61) - 1
POINT = 0x1B873593CC9E2D51 % PRIME
#: Comparisons held in memory at once.
CELLS = 1 << 21


def reduced(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, both below it, by halves of 32 bits."""
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    al, ah, bl, bh = a & low, a >> half, b & low, b >> half
    lowest, middle, highest = al * bl, ah * bl + al * bh, ah * bh
    total = (lowest & np.uint64(PRIME)) + (lowest >> np.uint64(61)) + (highest << np.uint64(3))
    return reduced(reduced(total) + (middle >> np.uint64(29)) + ((middle & np.uint64((1 << 29) - 1)) << half))


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    k = 1
    while k < n:
        out[k : 2 * k] = product(out[: min(k, n - k)], np.uint64(pow(base, k, PRIME)))
        k *= 2
    return out


def least_prime_factors(n: int) -> np.ndarray:
    out = np.arange(n + 1)
    for k in range(2, int(n**0.5) + 1):
        if out[k] == k:
            part = out[k * k :: k]
            part[part == np.arange(k * k, n + 1, k)] = k
    return out


class Catchers:
    """All squares of a growing sequence of numbers, merged into maximal runs.

    For every power of two L, each completed block of L words that begins at a
    multiple of L keeps a catcher for the periods 2L to 4L-1 (1 to 3 for L =
    1): a square of such a period p holds at least one such block in its first
    half, and the same words p later. As words are appended, each live catcher
    compares its block with the last L words (by hashes of prefixes); equal
    ones are widened to both sides, and if they agree over p words there is a
    square. Squares of one period that go on into each other are one run, and
    a run that reaches the end goes on with the words that come. Only smallest
    periods count: a run with period p/f for a prime factor f of p is left out.

    A catcher is dropped when the last of its periods has passed, so at most
    four of each L are live; words and hashes of prefixes are what stays.
    The runs do not depend on how the words were dealt over the calls.
    """

    def __init__(self, most_period: int | None = None):
        self.most = most_period
        self.n = 0
        self.words = np.zeros(0, np.int64)
        self.sums = np.zeros(1, np.uint64)
        self.up = self.down = np.ones(1, np.uint64)
        self.runs: dict[tuple[int, int], int] = {}
        self.open: list[tuple[int, int]] = []
        self.factors = least_prime_factors(3)

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal for equal stretches of words."""
        s = self.sums
        return product(reduced(s[end] + (np.uint64(PRIME) - s[begin])), self.down[begin])

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from a and b on (a < b), or before them; at most ``most``."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                return low
            mid = (low[todo] + high[todo] + 1) // 2
            x, y = a[todo] - mid * back, b[todo] - mid * back
            same = self.hashes(x, x + mid) == self.hashes(y, y + mid)
            low[todo] = np.where(same, mid, low[todo])
            high[todo] = np.where(same, high[todo], mid - 1)

    def append(self, words: np.ndarray) -> None:
        if not len(words):
            return
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):  # room doubles, so that single words cost the same
            room = max(self.n, 2 * len(self.words))
            self.words = np.concatenate((self.words, np.zeros(room - len(self.words), np.int64)))
            self.sums = np.concatenate((self.sums, np.zeros(room + 1 - len(self.sums), np.uint64)))
            self.up, self.down = powers(POINT, room + 1), powers(pow(POINT, -1, PRIME), room + 1)
            self.factors = least_prime_factors(room)
        self.words[old : self.n] = words
        terms = product(reduced(mixed(np.asarray(words).astype(np.uint64) + np.uint64(1)) >> np.uint64(3)), self.up[old : self.n])
        self.sums[old + 1 : self.n + 1] = self.summed(self.sums[old], terms)
        self.advance(old)
        size = 1
        while size == 1 or 4 * size <= self.n and (self.most is None or 2 * size <= self.most):
            self.catch(size, old)
            size *= 2

    @staticmethod
    def summed(first: np.uint64, terms: np.ndarray) -> np.ndarray:
        """Prefix sums modulo PRIME; 32-bit halves keep the plain sums from overflowing."""
        low = np.cumsum(terms & np.uint64(0xFFFFFFFF))
        high = reduced(np.cumsum(terms >> np.uint64(32)))
        return reduced(reduced(low) + product(high, np.uint64(1 << 32)) + first)

    def advance(self, old: int) -> None:
        """Stretches that reached the old end go on as far as the new words allow."""
        if not self.open:
            return
        period, left = (np.array(x) for x in zip(*self.open))
        right = old - period + self.common(old - period, np.full(len(period), old), np.full(len(period), self.n - old), False)
        self.open = []
        self.put(left, right, period)

    def put(self, left: np.ndarray, right: np.ndarray, period: np.ndarray) -> None:
        """Words from left to right recur ``period`` later: a square if that is a whole period; at the end it may become one."""
        for p, b, r in zip(period.tolist(), left.tolist(), right.tolist()):
            if r + p == self.n:
                self.open.append((p, b))
            if r - b >= p:
                self.runs[p, b] = r + p

    def catch(self, size: int, old: int) -> None:
        """New words meet the live catchers of blocks of one size."""
        low, high = (1, 4) if size == 1 else (2 * size, 4 * size)
        first = max(0, -(-(old - high - size + 2) // size))  # block m ends at m * size + size - 1
        last = (self.n - 1 - low - size + 1) // size
        width = high - low
        step = max(1, CELLS // width)
        for begin in range(first, last + 1, step):
            self.catch_blocks(size, low, width, np.arange(begin, min(last + 1, begin + step)) * size, old)

    def catch_blocks(self, size: int, low: int, width: int, blocks: np.ndarray, old: int) -> None:
        start = int(blocks[0]) + low  # of the first stretch that is compared with the first block
        stop = min(self.n - size, int(blocks[-1]) + low + width - 1)
        at = np.arange(start, stop + 1)
        later = self.hashes(at, at + size)
        own = self.hashes(blocks, blocks + size)
        if len(at) < len(blocks) * size + width:
            later = np.concatenate((later, np.full(len(blocks) * size + width - len(at), PRIME, np.uint64)))
        table = np.lib.stride_tricks.as_strided(later, (len(blocks), width), (size * later.itemsize, later.itemsize), writeable=False)
        m, c = np.nonzero(table == own[:, None])
        begin, period = blocks[m], low + c
        new = begin + period + size > old
        begin, period = begin[new], period[new]
        if len(begin):
            self.merge(size, begin, period)

    def merge(self, size: int, begin: np.ndarray, period: np.ndarray) -> None:
        """Blocks that recur at one distance, side by side, are one stretch; stretches become runs."""
        order = np.lexsort((begin, period))
        begin, period = begin[order], period[order]
        new = np.ones(len(begin), bool)
        new[1:] = (period[1:] != period[:-1]) | (begin[1:] != begin[:-1] + size)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(begin)) - 1
        left, right, period = begin[head], begin[tail] + size, period[head]
        keep = self.whole(left, right, period)
        left, right, period = left[keep], right[keep], period[keep]
        if not len(left):
            return
        left = left - self.common(left, left + period, left, True)
        right = right + self.common(right, right + period, self.n - right - period, False)
        known = set(self.open)
        keep = np.array([x not in known for x in zip(period.tolist(), left.tolist())], bool)
        self.put(left[keep], right[keep], period[keep])

    def whole(self, left: np.ndarray, right: np.ndarray, period: np.ndarray) -> np.ndarray:
        """False where the words from left to right + period have a smaller period that divides it."""
        keep, rest = np.ones(len(left), bool), period.copy()
        while True:
            todo = np.flatnonzero(keep & (rest > 1))
            if not len(todo):
                return keep
            f = self.factors[rest[todo]]
            q = period[todo] // f
            end = right[todo] + period[todo]
            keep[todo] &= self.hashes(left[todo], end - q) != self.hashes(left[todo] + q, end)
            rest[todo] //= f
            while (again := rest[todo] % f == 0).any():
                rest[todo] = np.where(again, rest[todo] // f, rest[todo])

    def found(self, exponent: int, least: int) -> np.ndarray:
        """Rows (start, length, period) of the runs of at least ``least`` words and ``exponent`` periods, by start and period.

        Their ends and their equality word by word are confirmed on the words.
        """
        rows = sorted((b, e - b, p) for (p, b), e in self.runs.items() if e - b >= max(least, exponent * p))
        w = self.words
        for b, k, p in rows:
            e = b + k
            if not (
                np.array_equal(w[b : e - p], w[b + p : e]) and (b == 0 or w[b - 1] != w[b + p - 1]) and (e == self.n or w[e] != w[e - p])
            ):
                raise AssertionError("two different stretches of words have one hash")
        return np.array(rows, np.int64).reshape(-1, 3)


def damaged(doc_id: int | None, words: list) -> list:
    """The words with the periodic stretch that the contract of the query asks for in a tenth of the documents."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * (-(-(n - a) // p)))[: n - a]


def collapsed(words: list, runs: np.ndarray) -> list:
    """The words that no run holds behind its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def find_rows(exponent: int, least: int, damage: bool):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in shards(whole, "text", 1 << 20):
                ids = batch.column("doc_id").to_pylist()
                texts = [t.split() for t in batch.column("text").cast(pa.large_binary()).to_pylist()]  # at the six ASCII blanks
                if damage:
                    texts = list(map(damaged, ids, texts))
                sizes = np.array([len(t) for t in texts], np.int64)
                bounds = np.concatenate(([0], np.cumsum(sizes + 1)))  # a word that is nowhere else ends each text
                known: dict[bytes, int] = {}
                catchers = Catchers(most_period=max(1, int(sizes.max()) // 2))
                stream = np.empty(int(bounds[-1]), np.int64)
                numbers = count()
                for i, t in enumerate(texts):
                    stream[bounds[i] : bounds[i] + len(t)] = list(map(known.setdefault, t, numbers))
                    stream[bounds[i + 1] - 1] = -2 - i
                catchers.append(stream)
                found = catchers.found(exponent, least)
                of = np.searchsorted(bounds, found[:, 0], "right") - 1
                found[:, 0] -= bounds[of]
                per = np.searchsorted(of, np.arange(len(texts) + 1))
                kept = [b" ".join(collapsed(t, found[per[i] : per[i + 1]]) if per[i] < per[i + 1] else t) for i, t in enumerate(texts)]
                runs = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(per, pa.int32()), runs).cast(kind), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=names,
                )

    return run


def periodic_runs(docs: DataFrame, exponent: int = 4, least: int = 6, damage: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period, by start and period) and the collapsed text.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. A run is a stretch with
    smallest period p of at least ``exponent`` periods (2 or more) and
    ``least`` words that no neighbouring word extends. Collapsed are the words that no run
    holds behind its first p words, joined by one blank. Null counts as empty: no
    words, no runs, an empty text. Repeated rows each get a row, an empty table none,
    a null id stays null, further columns are not read. ``damage`` plants the
    periodic stretches of the query's contract first (none where the id is null).

    Nothing is shuffled: texts stream through the catchers where they are
    read, about 1 MB at a time or one longer text, words told apart exactly.
    """
    if exponent < 2:
        raise ValueError("catchers find squares: at least two periods")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(find_rows(exponent, least, damage), RESULT)


def largest(runs: F.Column) -> F.Column:
    """The run with most periods; of equal ones the first, then that of the smaller period (null without runs)."""
    better = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from those of ``periodic_runs``."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = found.withColumn("best", largest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
