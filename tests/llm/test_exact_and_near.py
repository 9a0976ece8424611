"""Exact and near deduplication against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripleweave.llm import exact_dedup, graph, minhash_dedup


def brute_exact(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    return {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}


@pytest.mark.parametrize("counters", [2, 1024])
def test_exact(docs, texts, counters):
    got = {r[0]: tuple(r[1:]) for r in exact_dedup.exact_groups(docs, counters=counters).collect()}
    assert got == brute_exact(texts)


def test_exact_survivors(docs, texts):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, x in brute_exact(texts).items() if x[2])


def test_exact_repeated_rows_nulls_and_empty(table_of):
    df = table_of([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (2, None), (3, "")])
    got = sorted(map(tuple, exact_dedup.exact_groups(df).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert got == sorted(
        [(1, 1, 3, True), (1, 1, 3, False), (None, 1, 3, False), (None, None, 1, True), (2, 3, 2, False), (3, 3, 2, True)], key=str
    ) or got == sorted(
        [(1, 1, 3, False), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True), (2, 3, 2, False), (3, 3, 2, True)], key=str
    )
    assert sorted(map(tuple, exact_dedup.drop_exact_copies(df).collect()), key=str) == sorted([(1, "a"), (None, "b"), (3, "")], key=str)
    empty = table_of([], name="e")
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_exact_copies(empty).count() == 0


def test_misra_gries_keeps_every_heavy_digest(spark):
    rows = spark.range(20_000).selectExpr("case when id % 3 = 0 then 'hot' when id % 10 = 1 then 'warm' else cast(id as string) end as digest").repartition(16)
    names = {r.digest for r in exact_dedup.heavy_digests(rows, 15).collect()}
    assert {"hot", "warm"} <= names and len(names) <= 15


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_near(texts):
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("bounds", [{}, {"bucket_rows": 2, "cluster_shingles": 300}])
def test_near(docs, texts, bounds):
    got = {r[0]: tuple(r[1:]) for r in minhash_dedup.near_duplicates(docs, **bounds).collect()}
    assert got == brute_near(texts)


def test_near_survivors_and_edge_rows(docs, texts, table_of):
    kept = minhash_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, x in brute_near(texts).items() if x[2])
    odd = table_of([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c  d e\nf"), (7, None)])
    got = sorted(map(tuple, minhash_dedup.near_duplicates(odd).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False), (7, 0, 7, True)], key=str)
    assert minhash_dedup.near_duplicates(table_of([], name="e")).count() == 0


def test_sketches_estimate_similarity_and_fill():
    rng = np.random.RandomState(3)
    for n in (1, 2, 7, 90, 700, 5000):
        a = np.unique(rng.randint(0, 2**62, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: max(1, len(a) * 3 // 4)], rng.randint(0, 2**62, max(0, len(a) // 4)).astype(np.uint64))))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = minhash_dedup.sketch_of(a), minhash_dedup.sketch_of(b)
        assert len(x) == minhash_dedup.WIDTH and (x == minhash_dedup.sketch_of(a[::-1])).all()
        assert abs((x == y).mean() - true) < 0.25


def test_components(spark):
    rng = np.random.RandomState(1)
    edges = [(int(a), int(b)) for a, b in rng.randint(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5100)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_forest_of_large_buckets_connects_the_same():
    rng = np.random.RandomState(2)
    sets = [np.unique(rng.randint(0, 60, 40).astype(np.uint64)) for _ in range(80)]
    a, b = minhash_dedup.linked(sets, 60)
    pairs = [(i, j) for i in range(80) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))]

    def classes(edges):
        root = list(range(80))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i, j in edges:
            i, j = find(i), find(j)
            root[max(i, j)] = min(i, j)
        return [find(i) for i in range(80)]

    assert classes(zip(a, b)) == classes(pairs) and len(a) < 80


def test_brute_force_has_all_kinds_of_groups(texts):
    sizes = Counter(x[1] for x in brute_near(texts).values())
    assert max(sizes.values()) > 2 and 1 in sizes.values()
