"""Toxicity scores learned from confirmed toxic and unlabelled texts (non-negative positive-unlabelled learning)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import A_TO_Z, BLOCK, in_bucket, mixed, powers, runs, shards, text_bytes

#: Bytes of the beginnings of words that are features, besides the word itself; bits of the hashed feature.
PREFIXES = tuple(range(3, 11))
LOOK = 64
BITS = 20
FEATURES = "id long, toxic boolean, features array<int>"
MODEL = "feature int, weight double"

LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[128:] = True


def stems(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and buckets of the words and of their beginnings, block by block, once for each place.

    A word has letters only; one of more than LOOK bytes counts by its beginnings alone.
    """
    p = powers()
    edges = np.zeros(len(data) + 1, bool)
    edges[bounds] = True
    for at in range(0, len(data), BLOCK):
        low = A_TO_Z[data[at : at + BLOCK + LOOK]]
        letter = LETTER[low]
        edge = edges[at : at + len(low) + 1]
        before = np.concatenate(([at > 0 and bool(LETTER[A_TO_Z[data[at - 1]]])], letter[:-1]))
        begin = np.flatnonzero((letter & (~before | edge[:-1]))[:BLOCK])
        stops = np.flatnonzero(np.append(~letter, True) | edge)
        size = stops[np.searchsorted(stops, begin, "right")] - begin
        row = np.searchsorted(bounds, begin + at, "right") - 1
        s = p.sums(low)
        for k in PREFIXES:
            long = np.flatnonzero(size >= k)
            h = (s[begin[long] + k] - s[begin[long]]) * p.down[begin[long]]
            yield row[long], (mixed(h + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64)
        whole = np.flatnonzero(size <= LOOK)
        h = (s[begin[whole] + size[whole]] - s[begin[whole]]) * p.down[begin[whole]]
        yield row[whole], (mixed(h + np.uint64(1 << 32)) >> np.uint64(64 - BITS)).astype(np.int64)


def once_and_again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and those that come at least twice."""
    keys = np.sort(keys)
    cut = runs(keys)
    first = keys[cut[:-1]]
    return first, first[np.diff(cut) > 1]


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of each text: buckets that it has, and with 2^20 added those that it has twice or more."""
    for batch in batches:
        for i in range(len(batch)):
            one = batch.slice(i, 1)
            data, bounds = text_bytes(pc.utf8_lower(one.column("text").cast(pa.large_string())))
            found = [b for _, b in stems(data, bounds)]
            first, again = once_and_again(np.concatenate(found) if found else np.zeros(0, np.int64))
            seen = np.concatenate((first, again + (1 << BITS))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [one.column("_id"), one.column("toxic"), pa.array([seen], pa.list_(pa.int32()))], names=["id", "toxic", "features"]
            )


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, w: np.ndarray, g: np.ndarray) -> None:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        w -= self.rate * self.m / (1 - 0.9**self.t) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def train_nnpu(positive: np.ndarray, index: np.ndarray, starts: np.ndarray, size: int, prior: float, steps: int, decay: float, rate: float):
    """Weights and bias of a linear scorer with logistic loss under the non-negative PU risk.

    Risk: prior * loss(positives as 1) + max(0, loss(unlabelled as 0) - prior
    * loss(positives as 0)). Where the second part falls below zero, the
    scorer has begun to fit the unlabelled sample's noise, and the step goes
    back up along that part instead.
    """
    w, rows = np.zeros(size + 1), len(starts) - 1
    row = np.repeat(np.arange(rows), np.diff(starts))
    w[size] = np.log(prior / (1 - prior))
    n_p, n_u = positive.sum(), (~positive).sum()
    optimiser = Adam(size + 1, rate)
    for _ in range(steps):
        z = np.bincount(row, w[index], rows) + w[size]
        s = 1 / (1 + np.exp(-z))
        as_zero = np.logaddexp(0, z)
        rest = as_zero[~positive].mean() - prior * as_zero[positive].mean()
        up = np.where(positive, prior * (s - 1) / n_p, 0)
        down = np.where(positive, -prior * s / n_p, s / n_u)
        slope = up + down if rest >= 0 else -down
        g = np.append(np.bincount(index, slope[row], size), slope.sum())
        g[:size] += decay * w[:size]
        optimiser.step(w, g)
    return w[:size], w[size]


def trainer(prior: float, chosen: int, evidence: float, purity: float, steps: int, decay: float, rate: float):
    """mapInArrow function over the bounded sample, in one task: rows of the model; feature -1 is the bias.

    Toxic rows come first. Only what at least three of them have can become a
    feature, so nothing else is kept of the unlabelled rows behind them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {True: np.zeros(2 << BITS, np.int32), False: np.zeros(2 << BITS, np.int32)}
        held: dict[bool, list[np.ndarray]] = {True: [], False: []}
        known = None
        for batch in batches:
            for toxic, row in zip(batch.column("toxic").to_pylist(), batch.column("features")):
                own = row.values.to_numpy()
                if not toxic:
                    if known is None:
                        known = seen[True] >= 3
                        held[True] = [x[known[x]] for x in held[True]]
                    own = own[known[own]]
                seen[toxic][own] += 1
                held[toxic].append(np.array(own))
        n_p, n_u = len(held[True]), len(held[False])
        bias, features_, weights = np.log(prior / (1 - prior)), np.zeros(0, np.int64), np.zeros(0)
        if n_p and n_u:
            # log-likelihood ratio of the counts among the positives against the unlabelled rate
            among, expected = seen[True].astype(float), (seen[False] + 0.5) * (n_p / n_u)
            lift = 2 * (among * np.log(np.maximum(among, 1e-9) / expected) - among + expected)
            lift[(prior * among < purity * expected) | (lift < evidence) | ~known] = 0
            features_ = np.sort(np.argsort(-lift, kind="stable")[:chosen])
            features_ = features_[lift[features_] > 0]
            place = np.full(2 << BITS, -1, np.int32)
            place[features_] = np.arange(len(features_))
            index = [place[x] for x in held[True] + held[False]]
            index = [x[x >= 0] for x in index]
            starts = np.concatenate(([0], np.cumsum([len(x) for x in index])))
            positive = np.arange(n_p + n_u) < n_p
            weights, bias = train_nnpu(positive, np.concatenate(index), starts, len(features_), prior, steps, decay, rate)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(features_, -1), pa.int32()), pa.array(np.append(weights, bias), pa.float64())], names=["feature", "weight"]
        )

    return run


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", modulus: int = 3,
    bucket: int = 1, positives: int = 4000, unlabelled: int = 12000, chosen: int = 4096, evidence: float = 12.0, purity: float = 0.7, steps: int = 800, decay: float = 1e-4, rate: float = 0.05,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, weights and bias, from at most ``positives`` confirmed and ``unlabelled`` other texts.

    The samples are those with the smallest hashes of their ids, which is the
    documented bound of what is learned from; labels of held-out ids are not
    read. The class prior is the share of toxic rows among all readable labels.
    """
    open_labels = labels.where(~in_bucket(id_col, modulus, bucket) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    seen = open_labels.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)), F.lit(0))).first()
    prior = min(0.5, max(1e-3, (seen[1] + 0.5) / (seen[0] + 10)))
    some_ids = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"))

    def smallest(ids: DataFrame, n: int, seed: int) -> DataFrame:
        return ids.orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(n)

    toxic = smallest(open_labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("_id")).distinct(), positives, 1)
    other = smallest(some_ids.where(~in_bucket("_id", modulus, bucket)), unlabelled, 2).distinct()
    ids = toxic.withColumn("toxic", F.lit(True)).unionByName(other.withColumn("toxic", F.lit(False)))
    # at most positives + unlabelled rows of 9 bytes
    sample = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).where("text is not null").join(F.broadcast(ids), "_id")
    found = sample.select("_id", "toxic", "text").mapInArrow(features, FEATURES)
    ordered = found.repartition(1).sortWithinPartitions(F.desc("toxic"), "id")
    rows = ordered.mapInArrow(trainer(prior, chosen, evidence, purity, steps, decay, rate), MODEL).collect()
    bias = next((r["weight"] for r in rows if r["feature"] == -1), float(np.log(prior / (1 - prior))))
    kept = sorted((r["feature"], r["weight"]) for r in rows if r["feature"] >= 0)
    return np.array([b for b, _ in kept], np.int64), np.array([w for _, w in kept], float), bias


def scored(kept: np.ndarray, weights: np.ndarray, bias: float):
    """mapInArrow function: text column to a score column in place of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 2 << BITS
        weight = np.zeros(size)
        weight[kept] = weights
        wanted = np.zeros(1 << BITS, bool)
        wanted[kept & ((1 << BITS) - 1)] = True
        for batch in batches:
            for part in shards(batch, "text"):
                data, bounds = text_bytes(pc.utf8_lower(part.column("text").cast(pa.large_string())))
                keys = [np.zeros(0, np.int64)]
                for row, bucket in stems(data, bounds):
                    some = wanted[bucket]
                    keys.append(row[some] * size + bucket[some])
                first, again = once_and_again(np.concatenate(keys))
                key = np.concatenate((first, again + (1 << BITS)))
                z = np.bincount(key // size, weight[key % size], len(part)) + bias
                score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"])

    return run


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 3, bucket: int = 1,
    threshold: float = 0.7, **options,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Scores see the text alone; a null or empty text gets the score of a text
    without any feature. Without confirmed toxic texts all scores are the class
    prior. Null ids are neither held out nor learned from; repeated rows each
    get a row, an empty table none, further columns are not read.
    """
    model = fit(docs, labels, id_col, text_col, modulus=modulus, bucket=bucket, **options)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), in_bucket(id_col, modulus, bucket).alias("held_out"), F.col(text_col).alias("text")
    )
    out = rows.mapInArrow(scored(*model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that the scorer does not reject.

    The rejected ids are a small share of the rows and alone are joined; rows with a null id stay.
    """
    bad = toxicity(docs, labels, id_col, text_col, **options).where("predicted = 1").select(F.col("doc_id").alias("_bad_id")).distinct()
    return docs.join(bad, F.col(id_col).cast("long") == F.col("_bad_id"), "left_anti")
