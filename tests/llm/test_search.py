"""Decontamination, long repeats and shared passages against brute force."""

import hashlib
import itertools
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from .conftest import prose
from tripleweave.llm import chain_dedup, decontaminate, queries, suffix_dedup

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_contamination(texts, items, window=13):
    found = defaultdict(set)
    for i, t in items:
        w = WORD.findall(lowered(t))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            found[tuple(w[k : k + n])].add(str(i))
    out = {}
    for d, t in texts:
        w = WORD.findall(lowered(t))
        hit, names = set(), set()
        for n in {len(x) for x in found}:
            for k in range(len(w) - n + 1):
                some = found.get(tuple(w[k : k + n]))
                if some:
                    hit.update(range(k, k + n))
                    names |= some
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


@pytest.fixture(scope="module")
def items(texts):
    rng = random.Random(3)
    own = {i: t for i, t in texts}
    some = [own[90][:200], own[5], " ".join(own[6].split(" ")[3:30]), "x y", "", None, prose(rng, 50), own[5], own[1].upper() + " é 1"]
    return [*enumerate(some), (10, "w1x w2x"), (11, "unseen words only here")]


@pytest.mark.parametrize("block", [2 << 20, 300])
def test_contamination(spark, docs, texts, items, stored, block):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(stored(docs), bench, block_bytes=block).collect()
    assert {r[0]: tuple(r[1:6]) for r in got} == brute_contamination(texts, items)
    words = {i: WORD.findall(lowered(t)) for i, t in texts}
    by_id = {str(i): WORD.findall(lowered(t)) for i, t in items}
    for r in got:
        if r.longest:
            run = words[r.doc_id][r.longest_at : r.longest_at + r.longest]
            item = by_id[r.longest_item]
            assert any(item[k : k + r.longest] == run for k in range(len(item)))


def test_contamination_drops_and_edges(spark, docs, texts, items, table_of):
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, bench)
    want = brute_contamination(texts, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if not want[i][4])
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(table_of([(1, "a b"), (1, "a b"), (None, None)]), none).collect()
    assert sorted((r.n_words, r.n_hit, r.contaminated) for r in got) == [(0, 0, False), (2, 0, False), (2, 0, False)]
    assert decontaminate.contamination(table_of([], name="e"), bench).count() == 0


def test_contamination_by_items_without_id_equals_the_sql(spark, table_of):
    rng = random.Random(8)
    shared = [prose(rng, 15) for _ in range(3)]
    rows = [(1, f"x {shared[0]} y"), (2, f"{shared[1]} and {shared[2]}"), (3, "k0 short one"), (4, prose(rng, 30)), (5, None), (None, shared[0])]
    items = [(None, shared[0]), (None, shared[1]), (7, shared[2]), (None, "short one"), (8, None), (None, None)]
    df, bench = table_of(rows), table_of(items, "item_id long, text string", "b")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    con.register("benchmark", bench.toArrow())
    want = con.execute(f"select doc_id, n_words, n_hit, n_items, items_sha256, contaminated from ({queries.SQL['op3_decontaminate']}) where doc_id is not null").fetchall()
    for block in (1, 1 << 20):
        got = decontaminate.contamination(df, bench, block_bytes=block).where("doc_id is not null").collect()
        assert {tuple(r[:6]) for r in got} == set(want)
    assert next(r for r in want if r[0] == 1)[2:4] == (15, 1)


ALONE = """
import os, sys
sys.path.insert(0, {root!r})
os.environ["PYTHONPATH"] = {root!r}
from pyspark.sql import SparkSession
from tripleweave.llm import {module}
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
spark.sparkContext.setCheckpointDir({folder!r})
docs = spark.createDataFrame([(1, "a b c d"), (2, None)], "doc_id long, text string")
bench = spark.createDataFrame([(7, "b c")], "item_id long, text string")
print("ROWS", {call}.count())
"""


@pytest.mark.parametrize("module, call", [("decontaminate", "decontaminate.contamination(docs, bench)"), ("periodic_runs", "periodic_runs.periodic_runs(docs)")])
def test_a_module_runs_without_the_entry_points(tmp_path, module, call):
    root = str(Path(__file__).resolve().parent.parent.parent)
    (tmp_path / "alone.py").write_text(ALONE.format(root=root, module=module, call=call, folder=str(tmp_path / "shared")))
    done = subprocess.run([sys.executable, str(tmp_path / "alone.py")], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS 2" in done.stdout, done.stderr[-3000:]


def test_suffix_array_order():
    rng = np.random.RandomState(5)
    for n, kinds in ((1, 1), (50, 2), (300, 3), (300, 200)):
        s = rng.randint(1, kinds + 1, n).astype(np.uint64)
        want = sorted(range(n), key=lambda i: s[i:].tolist())
        assert decontaminate.suffix_array(s, n + 1).tolist() == want


def brute_repeats(texts, length):
    data = {i: (t or "").encode() for i, t in texts}
    seen = Counter(t[k : k + length] for t in data.values() for k in range(len(t) - length + 1))
    out = {}
    for i, t in data.items():
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(t) else 0
        left = bytes(b for b, g in zip(t, gone) if not g)
        out[i] = (len(t), len(t) - len(left), runs, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("group", [8192, 1])
def test_repeats(docs, texts, stored, group):
    few = [x for x in texts if not x[1] or len(x[1]) < 20_000]
    df = stored(docs.where("text is null or length(text) < 20000"))
    got = {r[0]: tuple(r[1:5]) for r in suffix_dedup.remove_repeats(df, group=group, batches=3).collect()}
    assert got == brute_repeats(few, 200)


def test_repeats_of_periodic_and_block_crossing_text(table_of, monkeypatch):
    rng = random.Random(11)
    shared = prose(rng, 300)
    rows = [(1, "a" * 700), (2, prose(rng, 2000) + shared), (3, prose(rng, 1700) + shared + prose(rng, 10)), (4, "abc" * 80), (5, None), (6, "short")]
    got = {r[0]: tuple(r[1:5]) for r in suffix_dedup.remove_repeats(table_of(rows), batches=2).collect()}
    assert got == brute_repeats(rows, 200)
    assert suffix_dedup.remove_repeats(table_of([], name="e")).count() == 0


def test_sampled_windows_are_whole_across_blocks(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    data = np.frombuffer(prose(random.Random(1), 900).encode(), np.uint8)
    covered = np.zeros(len(data), int)
    for _, _, at, first, last in suffix_dedup.sampled(data, 200):
        for a, f, x in zip(at, first, last):
            assert f <= x <= a and a + suffix_dedup.prefix_length(200) <= f + 200
            covered[f : x + 1] += 1
    assert (covered[: len(data) - 199] >= 1).all() and not covered[len(data) - 199 :].any()


def test_windows_at_block_borders_count_once(table_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    rng = random.Random(12)
    clean = prose(rng, 1200)
    data = np.frombuffer(clean.encode(), np.uint8)
    covered = np.zeros(len(data), int)
    for _, _, _, first, last in suffix_dedup.sampled(data, 200):
        for f, x in zip(first, last):
            covered[f : x + 1] += 1
    assert len(data) > 3000 and (covered[: len(data) - 199] == 1).all() and not covered[len(data) - 199 :].any()
    rows = [(1, clean), (2, prose(rng, 500) + clean[1500:2700] + prose(rng, 300)), (3, prose(rng, 900))]
    cloudpickle.register_pickle_by_value(suffix_dedup)  # so that workers get the lowered BLOCK too
    try:
        got = {r[0]: tuple(r[1:5]) for r in suffix_dedup.remove_repeats(table_of(rows), batches=2).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(suffix_dedup)
    assert got == brute_repeats(rows, 200) and got[3][1] == 0


def test_index_family_merges_geometrically(spark):
    family = suffix_dedup.IndexFamily()
    for b in range(5):
        family.add(spark.range(b * 10, b * 10 + 12).select((suffix_dedup.F.col("id")).alias("key")))
    assert [r for r, _ in family.levels] == [2, 0]
    assert {r.key for r in family.touched.collect()} == {k for b in range(1, 5) for k in (b * 10, b * 10 + 1)}
    assert sum(level.agg({"n": "sum"}).first()[0] for _, level in family.levels) == 60


def test_suffix_arrays_are_small(monkeypatch):
    rng = random.Random(27)
    texts = [prose(rng, 60_000) for _ in range(20)]  # about 0.2 MB each
    items = decontaminate.Items(["a"], [" ".join(texts[7].split()[100:120])], 13)
    sizes, build = [], decontaminate.suffix_array
    monkeypatch.setattr(decontaminate, "suffix_array", lambda symbols, depth: sizes.append(len(symbols)) or build(symbols, depth))
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts)], names=["row", "text"])
    got = [x for b in decontaminate.scan(items)(iter([batch])) for x in b.to_pylist()]
    assert [x["row"] for x in got] == list(range(20)) and [x["row"] for x in got if x["items"]] == [7]
    assert sum(sizes) == 20 * 60_001 and max(sizes) <= 60_001 * (2 << 20) / min(map(len, texts)) + 1


def test_shared_passages(docs, texts, stored):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", lowered(t)) for i, t in texts}
    got = chain_dedup.shared_passages(stored(docs)).collect()
    runs = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 49):
            runs[tuple(w[k : k + 50])].add(i)
    exact = {i for g in runs.values() if len(g) > 1 for i in g}
    assert exact <= {r.doc_id for r in got} | {r.other_id for r in got}
    for r in got:
        a, b = words[r.doc_id][r.start : r.stop], words[r.other_id][r.other_start : r.other_stop]
        assert r.doc_id != r.other_id and len(a) == r.stop - r.start >= 50 and len(b) == r.other_stop - r.other_start >= 50
        assert sum((Counter(a) & Counter(b)).values()) >= r.matched >= 0.8 * max(len(a), len(b))


def test_shared_passages_salted_and_edges(docs, stored, table_of, spark):
    df = stored(docs, "all")
    by_words = {r.doc_id: (r.text or "").lower().split() for r in docs.select("doc_id", "text").collect()}
    held = {x for r in chain_dedup.shared_passages(df, counters=4000, salts=3).collect() for x in (r.doc_id, r.other_id)}
    runs = defaultdict(set)
    for i, w in by_words.items():
        for k in range(len(w) - 49):
            runs[tuple(w[k : k + 50])].add(i)
    assert {i for g in runs.values() if len(g) > 1 for i in g} <= held
    long = prose(random.Random(2), 80)
    got = chain_dedup.shared_passages(table_of([(1, long), (1, long), (None, None), (2, "a b")])).collect()
    assert [(r.doc_id, r.other_id, r.start, r.stop) for r in got] == [(1, 1, 0, 80)]
    assert chain_dedup.shared_passages(table_of([], name="e")).count() == 0


@pytest.mark.parametrize("limit", [16, 2])
def test_partners_of_passages_whose_parts_stand_elsewhere(spark, stored, limit):
    rng = random.Random(21)
    fresh = lambda n: " ".join(f"v{rng.randrange(10**9)}" for _ in range(n))
    rows, want = [], set()
    for _ in range(40):
        one, two = fresh(30), fresh(30)
        parts = [one, two, f"{one} {two}"]
        want |= {len(rows) + 2, len(rows) + 5, len(rows) + 8}
        rows += [(len(rows) + i, f"{fresh(20)} {p} {fresh(20)}") for i, p in enumerate(parts * 3)]
    df = stored(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))  # in this order
    got = chain_dedup.shared_passages(df, limit=limit).collect()
    assert {x for r in got for x in (r.doc_id, r.other_id)} == want
    assert all((r.stop - r.start, r.matched) == (60, 60) for r in got)


def test_changed_passages_are_found(table_of):
    rng = random.Random(22)
    fresh = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    rows, want = [], set()
    for n, every in ((60, 10), (60, 8), (100, 8), (60, 6), (100, 6), (66, 5), (101, 5)):
        for _ in range(40):
            words = fresh(n)
            other = [fresh(1)[0] if i % every == every - 1 and i < n - 1 else w for i, w in enumerate(words)]
            i = len(rows)
            rows += [(i, " ".join(fresh(15) + words + fresh(15))), (i + 1, " ".join(fresh(25) + other + fresh(5)))]
            want.add((i, i + 1))
    for share in (0.05, 0.1, 0.15):
        for _ in range(40):
            words = fresh(80)
            other = [w if i in (0, 79) or rng.random() >= share else fresh(1)[0] for i, w in enumerate(words)]
            i = len(rows)
            rows += [(i, " ".join(fresh(15) + words + fresh(15))), (i + 1, " ".join(fresh(25) + other + fresh(5)))]
            if sum(x == y for x, y in zip(words, other)) >= 64:
                want.add((i, i + 1))
    got = {tuple(sorted((r.doc_id, r.other_id))) for r in chain_dedup.shared_passages(table_of(rows)).collect()}
    print("found", len(want & got), "of", len(want))
    assert len(want & got) >= 0.98 * len(want)


@pytest.mark.parametrize("counters, salts", [(1024, 64), (4000, 3)])
def test_changed_passages_of_frequent_seeds_are_found(spark, stored, counters, salts):
    rng = random.Random(25)
    fresh = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    one, two = fresh(30), fresh(30)
    rows, changed = [], []
    for i in range(120):
        words = one if i % 2 else two
        if i % 20 == 10:  # both parts, another word replaced in each such row; the rows before and the first have one part
            words = one + two
            words = [fresh(1)[0] if k == 20 + i // 5 else w for k, w in enumerate(words)]
            changed.append(i)
        rows.append((i, " ".join(fresh(12) + words + fresh(12))))
    df = stored(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    got = chain_dedup.shared_passages(df, counters=counters, salts=salts).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(i, j) for i in changed for j in changed if i > j} and len(got) == 15
    assert all((r.start, r.stop, r.other_start, r.other_stop, r.matched) == (12, 72, 12, 72, 58) for r in got)


def brute_edges(rows):
    out = Counter()
    for i, j in itertools.permutations(rows, 2):
        begin = i[4] != j[4] or not i[4]
        end = i[5] != j[5] or not i[5]
        if i[:2] == j[:2] and i[2] > j[2] and (begin or end) and (i[6] == j[6] == 0 or i[6] != j[6]):
            out[i[2], j[2], i[3], j[3], begin + 2 * end] += 1
    return out


@pytest.mark.parametrize("size, limit, block", [(1, 16, 1 << 20), (7, 2, 8), (1000, 1, 1), (1000, 16, 5), (50, 3, 64)])
def test_edges_of_matches_against_all_pairs(size, limit, block):
    rng = random.Random(size)
    rows = [(*c[:4], rng.randint(0, 2), rng.randint(0, 2), c[2] % 3 if c[1] else 0) for c in sorted({
        (rng.randint(0, 4) ** 2 // 4, rng.randint(0, 1), rng.randint(0, 9), rng.randint(0, 30)) for _ in range(150)
    })]
    names = ["h", "cell", "row", "at", "before", "behind", "side"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names=names) for i in range(0, len(rows), size)]
    got = Counter(tuple(x.values()) for b in chain_dedup.edges(limit, block)(iter(batches)) for x in b.to_pylist())
    assert got == brute_edges(rows)


def test_all_copies_of_a_text_meet(table_of):
    rng = random.Random(26)
    text = prose(rng, 60)
    rows = [(i, text) for i in range(9)] + [(20, f"{prose(rng, 5)} {text}"), (21, None), (22, None), (23, "a b"), (24, "a b")]
    got = chain_dedup.shared_passages(table_of(rows)).collect()
    assert sorted(tuple(sorted((r.doc_id, r.other_id))) for r in got) == list(itertools.combinations([*range(9), 20], 2))
    assert all(r.stop - r.start == r.other_stop - r.other_start == r.matched == 60 for r in got)


def test_bounded_passages_hold_unchanged_ones(docs, texts, stored):
    df = stored(docs)
    both = [{x for r in chain_dedup.shared_passages(df, limit=2, whole=w).collect() for x in (r.doc_id, r.other_id)} for w in (False, True)]
    assert both[0] and both[0] <= both[1]


def test_equal_words_beyond_a_gap_do_not_hide_a_passage(table_of):
    rng = random.Random(24)
    fresh = lambda n: " ".join(f"v{rng.randrange(10**9)}" for _ in range(n))
    shared, few = fresh(50), fresh(12)
    rows = [(i, f"{fresh(9)} {shared} {fresh(35)} {few} {fresh(9)}") for i in range(2)]
    got = chain_dedup.shared_passages(table_of(rows)).collect()
    assert [(r.start, r.stop, r.matched) for r in got] == [(9, 59, 50)]


def test_passages_are_found_without_shuffling_pairs_of_places(docs, stored):
    df = stored(docs)
    got = chain_dedup.shared_passages(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "hashpartitioning(row" not in plan and "hashpartitioning(h" not in plan
    rows = sorted(map(tuple, got.collect()))
    assert rows and rows == sorted(map(tuple, chain_dedup.shared_passages(df, size=2_000).collect()))  # in many blocks


def stretched(texts, k=4, reach=40, least=50, fewest=7, size=10**6):
    """Blocks of stretches of the texts, one for each list of them, without Spark."""
    blobs = []
    for part in texts:
        batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in part]), pa.array([i for i, _ in part]), pa.array([t for _, t in part])], names=["row", "doc_id", "text"])
        blobs += list(chain_dedup.packed(least)(iter([batch])))
    parts = pa.Table.from_batches(chain_dedup.seed_parts(k)(iter(blobs))).sort_by("part")
    bits = defaultdict(list)
    for b in chain_dedup.repeated(iter(parts.to_batches(max_chunksize=7))):
        for x in b.to_pylist():
            bits[x["block"]].append(x)
    both = [pa.RecordBatch.from_pylist([x | {"parts": bits[x["block"]]}]) for b in blobs for x in b.to_pylist()]
    return [x for b in both for out in chain_dedup.kept_stretches(k, reach, least, fewest, size)(iter([b])) for x in out.to_pylist()]


def test_texts_without_repeated_seeds_leave_nothing():
    rng = random.Random(29)
    fresh = lambda n: " ".join(f"v{rng.randrange(10**9)}" for _ in range(n))
    few, shared = fresh(9), fresh(60)
    texts = [(i, f"{fresh(200)} {few} {fresh(200)}") for i in range(30)] + [(30 + i, f"{fresh(300)} {shared} {fresh(300)}") for i in range(2)] + [(40, None), (41, "a b")]
    (block,) = stretched([texts])
    assert np.frombuffer(block["rows"], np.int64).tolist() == [30, 31] and block["ids"] == [30, 31]
    assert np.frombuffer(block["lengths"], np.int32).tolist() == [160, 160] and np.frombuffer(block["starts"], np.int32).tolist() == [250, 250]
    assert len(block["seeds"]) == 4 * 2 * 57


@pytest.mark.parametrize("most", [1, 50, 10**6])
def test_beginnings_against_all_pairs(most):
    rng = random.Random(most)
    words = [f"w{i}" for i in range(3)]
    texts = [[(10 * b + i, " ".join(rng.choice(words[: 1 + i % 3]) for _ in range(rng.randint(50, 70)))) for i in range(6)] for b in range(2)]
    x, y = (chain_dedup.Stretches(b, 4, 50) for b in stretched(texts))
    for u, v in ((x, y), (x, x)):
        same = lambda a, b: (u.words[a : a + 4] == v.words[b : b + 4]).all()  # noqa: E731, B023
        got = Counter((int(a), int(b)) for p, q in chain_dedup.beginnings(u, v, most) for a, b in zip(p, q))
        want = Counter((a, b) for a in u.place.tolist() for b in v.place.tolist() if same(a, b) and not same(a - 1, b - 1))
        assert {c: n for c, n in got.items() if u is not v or c[0] != c[1]} == {c: n for c, n in want.items() if u is not v or c[0] != c[1]}


def test_equal_words_is_a_longest_subsequence():
    rng = np.random.RandomState(6)
    for most in [0, 1, 5, 40, 150] * 60:
        x, y = (rng.randint(0, rng.randint(1, 12), rng.randint(0, most + 1)).astype(np.uint64) << np.uint64(60) for _ in "xy")
        t = np.zeros((len(x) + 1, len(y) + 1), int)
        for i in range(len(x)):
            for j in range(len(y)):
                t[i + 1, j + 1] = t[i, j] + 1 if x[i] == y[j] else max(t[i, j + 1], t[i + 1, j])
        assert chain_dedup.equal_words(x, y) == t[-1, -1]


def test_extended_one_by_one_and_together():
    rng = np.random.RandomState(7)
    for _ in range(300):
        x, y = rng.randint(0, rng.randint(2, 5), (2, rng.randint(0, 60)))
        value = np.cumsum(np.where(x == y, 1, -1))
        low = np.flatnonzero(np.maximum.accumulate(np.append(0, value))[:-1] - value >= 4)
        value = value[: low[0]] if len(low) else value
        end = int(np.argmax(value)) + 1 if len(value) and value.max() > 0 else 0
        want = end, int((x[:end] == y[:end]).sum())
        assert chain_dedup.extended(x, y) == (end, *want)
        for sign, u, v in ((1, x, y), (-1, x[::-1], y[::-1])):
            u, v = (np.concatenate((np.arange(a, a + 60), w, np.arange(a + 60, a + 120))) for a, w in ((10**6, u), (10**7, v)))
            at = np.array([60 if sign == 1 else 59 + len(x)])
            assert tuple(int(z[0]) for z in chain_dedup.extended_all(u, v, at, at, sign, 60)) == want


@pytest.mark.parametrize("step", [1, 3, 16])
def test_equal_run(step):
    rng = np.random.RandomState(step)
    x, y = (np.concatenate((rng.randint(0, 2, 400), np.arange(a, a + 20))) for a in (10, 100))
    y[100:200] = x[50:150]
    p, q = np.concatenate((rng.randint(0, 400, (2, 500)), [[50, 390], [100, 10]]), axis=1)
    want = [next(n for n in range(421) if x[a + n] != y[b + n]) for a, b in zip(p.tolist(), q.tolist())]
    assert chain_dedup.equal_run(x, y, p, q, step).tolist() == want and max(want) >= 100


def test_every_two_blocks_meet_in_a_task_and_passages_are_not_shuffled(spark, table_of):
    rng = random.Random(31)
    shared = prose(rng, 60)
    docs = table_of([(i, f"{prose(rng, 400)} {shared}") for i in range(100)] + [(100, shared), (101, shared)])
    rows = docs.repartition(24, "doc_id").select(F.col("doc_id").alias("row"), "doc_id", "text")
    found = chain_dedup.met(rows, 4, 0.1, 40, 50, 0.8, 7, 2_000, 8)
    assert found.count() == 102 * 101 // 2
    blocks = {r.block for r in spark.read.parquet(*{re.sub("/part-[^/]*$", "", f) for f in found.inputFiles()}).select("block").collect()}
    assert len(blocks) > 10 and found.rdd.getNumPartitions() == len(blocks) ** 2
    got = chain_dedup.shared_passages(docs, size=2_000)
    assert {(max(r.doc_id, r.other_id), min(r.doc_id, r.other_id)) for r in got.collect()} == {(i, j) for i in range(102) for j in range(i)}
    assert "Exchange hashpartitioning(row" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "[row" in plan


def test_chains_of_a_row_come_in_slices(spark, table_of):
    rng = random.Random(23)
    shared = prose(rng, 60)
    docs = table_of([(i, f"{prose(rng, 5)} {shared} {prose(rng, 5)}") for i in range(80)])
    rows = docs.selectExpr("doc_id as row", "doc_id", "text")
    linked = spark.createDataFrame([(i, 0, 5, 5, b"") for i in range(1, 80)], chain_dedup.CHAIN)
    lists = [len(r.wanted) for r in chain_dedup.sliced(linked, rows, 8).collect()]
    assert sum(lists) == 2 * 79 and max(lists) <= 24
    held = {x for r in chain_dedup.shared_passages(docs, most=8).collect() for x in (r.doc_id, r.other_id)}
    assert held == set(range(80))


def brute_neighbours(rows):
    by = defaultdict(list)
    for h, s, r, a in rows:
        by[h, s].append((r, a))
    out = Counter()
    for g in by.values():
        first, places = {}, [r for r, _ in g]
        for r, a in g:
            first.setdefault(r, a)
        order = list(first)
        for r, a in g:
            k = order.index(r)
            for o in {order[0], order[k - 1]} - {r} if k else ():
                out[r, o, a, first[o]] += 1
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_neighbours_carry_over_batches(size):
    rng = random.Random(size)
    rows = sorted({(rng.randint(0, 4), rng.randint(0, 1), rng.randint(0, 6), rng.randint(0, 30)) for _ in range(120)})
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names=["h", "salt", "row", "at"]) for i in range(0, len(rows), size)
    ]
    got = Counter(tuple(x.values()) for b in chain_dedup.neighbours(False)(iter(batches)) for x in b.to_pylist())
    assert got == brute_neighbours(rows)
    firsts = [tuple(x.values()) for b in chain_dedup.neighbours(True)(iter(batches)) for x in b.to_pylist()]
    want = {}
    for h, s, r, a in rows:
        want.setdefault((h, s), (h, r, a))
    assert firsts == list(want.values())


def test_chains_against_quadratic_search():
    rng = np.random.RandomState(4)
    for _ in range(200):
        n = rng.randint(1, 12)
        a, b, w = rng.randint(0, 60, n), rng.randint(0, 60, n), rng.randint(2, 9, n)
        best = np.zeros(n)
        for i in np.argsort(a, kind="stable"):
            options = [best[j] - 0.1 * (a[i] - a[j] - w[j] + b[i] - b[j] - w[j]) for j in range(n) if a[j] + w[j] <= a[i] and b[j] + w[j] <= b[i]]
            best[i] = w[i] + max([0, *options])
        chains = list(chain_dedup.chained(a, b, w, 0.1, 10**6))
        assert sorted(x for c in chains for x in c) == list(range(n))
        first = chains[0]
        value = sum(w[first]) - 0.1 * sum(a[j] - a[i] - w[i] + b[j] - b[i] - w[i] for i, j in zip(first, first[1:]))
        assert abs(value - best.max()) < 1e-9
