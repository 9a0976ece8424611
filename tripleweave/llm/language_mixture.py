"""Language shares of a text: mixture of n-gram models, fitted by expectation-maximisation with a penalty per language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import A_TO_Z, BLOCK, in_bucket, partitions_of, ranges, runs, shards, text_bytes

#: Hashed trigrams of bytes; a model row per language has so many counts.
BUCKETS = 1 << 16
COUNTS = "lang string, counts binary"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>"


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every byte trigram inside a row, A-Z lower-cased, digits and white space as blanks."""
    rows, buckets = [], []
    blank = A_TO_Z.copy()
    blank[:65] = 32
    for at in range(0, len(data), BLOCK):
        low = blank[data[at : at + BLOCK + 2]].astype(np.uint32)
        if len(low) < 3:
            break
        gram = (low[:-2] | low[1:-1] << np.uint32(8) | low[2:] << np.uint32(16)) * np.uint32(2654435761) >> np.uint32(16)
        row = np.searchsorted(bounds, np.arange(at, at + len(gram)), "right") - 1 if len(bounds) > 2 else np.zeros(len(gram), np.int64)
        inside = np.arange(at, at + len(gram)) + 3 <= bounds[row + 1]
        rows.append(row[inside])
        buckets.append(gram[inside].astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(buckets)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of each language in this partition: one row per language."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in shards(batch, "text", BLOCK):
            row, bucket = trigrams(*text_bytes(part.column("text")))
            names, code = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            sums = np.bincount(code[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            for name, s in zip(names, sums):
                held[str(name)] = held.get(str(name), 0) + s
    yield counts_batch(held)


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held[name] = held.get(name, 0) + np.frombuffer(raw, np.int64)
    yield counts_batch(held)


def counts_batch(held: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array([np.asarray(v, np.int64).tobytes() for v in held.values()], pa.binary())],
        names=["lang", "counts"],
    )


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their smoothed trigram probabilities, from all rows with a language.

    Each partition counts for itself; the counts are added up in two steps.
    The driver gets one row of 2^16 counts per language.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    first = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(counted, COUNTS)
    middle = max(1, int(partitions_of(docs.sparkSession) ** 0.5))
    total = first.repartition(middle).mapInArrow(added, COUNTS).repartition(1).mapInArrow(added, COUNTS)
    rows = sorted(total.collect())
    counts = np.array([np.frombuffer(r["counts"], np.int64) for r in rows], float).reshape(len(rows), BUCKETS)
    smooth = counts + 0.5
    return [r["lang"] for r in rows], smooth / smooth.sum(axis=1, keepdims=True)


def mixture(p: np.ndarray, count: np.ndarray, starts: np.ndarray, share: np.ndarray, rounds: int) -> np.ndarray:
    """Shares after EM. p: entries x languages; starts: first entry of each text; share: texts x languages to begin with."""
    sizes = np.diff(starts)
    n = np.add.reduceat(count, starts[:-1])[:, None]
    for _ in range(rounds):
        weighted = p * np.repeat(share, sizes, axis=0)
        weighted *= (count / weighted.sum(axis=1))[:, None]
        share = np.add.reduceat(weighted, starts[:-1], axis=0) / n
    return share


def infer(counts: np.ndarray, starts: np.ndarray, p: np.ndarray, penalty: float, rounds: int) -> np.ndarray:
    """Share of each language in each text (texts x languages).

    Begins with the best single language and adds the one along which the
    likelihood rises fastest, as long as its penalised value grows. The
    likelihood is concave in the shares, so where its slope times the length
    stays under the penalty no larger set can win, and no EM is run.
    """
    texts, languages = len(starts) - 1, p.shape[1]
    sizes = np.diff(starts)
    n = np.add.reduceat(counts, starts[:-1])
    level = np.add.reduceat(np.log(p) * counts[:, None], starts[:-1], axis=0)
    best = level.argmax(axis=1)
    share = np.zeros((texts, languages))
    share[np.arange(texts), best] = 1
    value = level.max(axis=1)
    cost = penalty * np.log(np.maximum(n, 2))
    open_ = np.arange(texts)
    for _ in range(languages - 1):
        at = ranges(starts[open_], sizes[open_])
        cut = np.concatenate(([0], np.cumsum(sizes[open_])))
        pp, cc = p[at], counts[at]
        mix = (pp * np.repeat(share[open_], sizes[open_], axis=0)).sum(axis=1)
        slope = np.add.reduceat(pp * (cc / mix)[:, None], cut[:-1], axis=0) - n[open_][:, None]
        slope[share[open_] > 0] = -np.inf
        go = slope.max(axis=1) > cost[open_]
        if not go.any():
            break
        keep = np.repeat(go, sizes[open_])
        pp, cc, cut = pp[keep], cc[keep], np.concatenate(([0], np.cumsum(sizes[open_[go]])))
        new, open_ = slope[go].argmax(axis=1), open_[go]
        trial = share[open_] * 0.9
        trial[np.arange(len(open_)), new] = 0.1
        trial = mixture(pp, cc, cut, trial, rounds)
        mix = (pp * np.repeat(trial, sizes[open_], axis=0)).sum(axis=1)
        gained = np.add.reduceat(np.log(mix) * cc, cut[:-1])
        better = gained - cost[open_] > value[open_]
        open_ = open_[better]
        if not len(open_):
            break
        share[open_], value[open_] = trial[better], gained[better] - cost[open_]
    return share


def predict(languages: list[str], p: np.ndarray, penalty: float, rounds: int):
    table = np.ascontiguousarray(p.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shards(batch, "text", BLOCK):
                docs = len(part)
                row, bucket = trigrams(*text_bytes(part.column("text")))
                key = np.sort(row * BUCKETS + bucket)
                cut = runs(key)
                counts = np.diff(cut).astype(float)
                key = key[cut[:-1]]
                mine = key // BUCKETS
                share = np.zeros((docs, len(languages)))
                if len(key) and languages:
                    starts = runs(mine)
                    share[mine[starts[:-1]]] = infer(counts, starts, table[key % BUCKETS], penalty, rounds)
                bare = (share.sum(axis=1) == 0) & bool(languages)
                if bare.any():  # shorter than a trigram: nothing tells languages apart
                    share[bare] = 1 / len(languages)
                top = share.argmax(axis=1) if languages else np.zeros(docs, int)
                letters = part.column("has_letter").to_pylist()
                names, scores, lists = [], [], []
                for d in range(docs):
                    if not letters[d] or not languages:
                        names.append("und"), scores.append(0.0), lists.append([])
                        continue
                    some = [k for k in np.argsort(-share[d], kind="stable") if share[d, k] > 0]
                    names.append(languages[top[d]]), scores.append(float(min(1, share[d, top[d]])))
                    lists.append([{"lang": languages[k], "share": float(share[d, k])} for k in some])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                    pa.array(lists, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
                ], names=["doc_id", "held_out", "lang_pred", "score", "languages"])

    return run


def language_mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", modulus: int = 4, bucket: int = 2,
    penalty: float = 1.0, rounds: int = 20,
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, languages (those chosen, with their shares).

    Models are counted over all rows with text and language that are not held
    out (crc32 of the id modulo ``modulus`` is not ``bucket``; a null id is not
    held out). A prediction sees the text alone. ``und`` with score 0 where the
    text is null or has no letter, and everywhere if nothing could be learned;
    a text shorter than a trigram has equal shares. ``penalty`` times the
    logarithm of the number of trigrams is what each further language costs.
    Ties go to the first language by name. Each repeated row gets a row, an
    empty table gives none.
    """
    held = in_bucket(id_col, modulus, bucket)
    languages, p = fit(docs.where(~held), text_col, lang_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"), F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(predict(languages, p, penalty, rounds), RESULT)
