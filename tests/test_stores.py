"""JSON arrays read in blocks, the answer ledger, stored graph and index, the all-or-nothing sink, the model ladder."""

import json
import os
import random
import subprocess
import sys
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripleweave.operators import edge_store, graph, index, ledger, stored_index, syntax
from tripleweave.plans import flows, stand_ins
from tripleweave.sources import graph_sink, json_arrays, runs, tables
from tripleweave.streaming.graph_stream import import_stream_to_store


@pytest.fixture(autouse=True, scope="module")
def shared_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


# --- JSON arrays ----------------------------------------------------------------------

NASTY = ["a", "}", "{", '"', "\\", "},{", "é", "中", "\n", " ", "[", "]", ",", ":", "x" * 50, '\\"', "😀"]


def some_value(rng, depth=0):
    kind = rng.random()
    if kind < 0.6 or depth > 2:
        return "".join(rng.choices(NASTY, k=rng.randint(0, 30)))
    if kind < 0.75:
        return [some_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {"".join(rng.choices('ab}{"', k=3)) + str(i): some_value(rng, depth + 1) for i in range(rng.randint(0, 3))}


def some_records(n, seed=1):
    rng = random.Random(seed)
    triplets = lambda i: [[some_value(rng, 3) for _ in range(3)]] if i % 3 else {"error": some_value(rng, 1)}
    return [{"id": i, "text": some_value(rng, 3), "triplets": triplets(i), "n": {"k": some_value(rng, 3)}} for i in range(n)]


SCHEMA = "id bigint, text string, triplets variant, n struct<k:string>"


def shown(df):
    return Counter(map(tuple, df.selectExpr("id", "text", "to_json(triplets)", "n.k").collect()))


@pytest.fixture(scope="module")
def array_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("arrays")
    records = some_records(400)
    (folder / "a.json").write_text(json.dumps(records, ensure_ascii=False, indent=2), encoding="utf-8")
    (folder / "b.json").write_text(json.dumps(records[:77]))
    (folder / "c.json").write_text(json.dumps(records[:5], ensure_ascii=False, separators=(",", ":")), encoding="utf-8")
    (folder / "d.json").write_text("[]")
    (folder / "e.json").write_text("")
    (folder / "f.json").write_text(json.dumps(records[0]))
    (folder / "g.json").write_text('[{"id": 5, "n": {}}, {}]')
    return folder


@pytest.fixture
def split_size(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", size if size == "128m" else "0")  # a file is cut for the cores as well

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size, most", [("128m", 500_000), ("20k", 500_000), ("3k", 500_000), ("3k", 0)])
def test_arrays_read_in_blocks_equal_whole_ones(spark, array_files, split_size, monkeypatch, size, most):
    want = shown(spark.read.schema(SCHEMA).json(str(array_files), multiLine=True))
    split_size(size)
    monkeypatch.setattr(json_arrays, "BLOCKS", most)
    assert shown(json_arrays.read_json_array(spark, str(array_files), SCHEMA)) == want
    texts = json_arrays.record_texts(spark, str(array_files / "a.json"))
    blocks = {r.block for r in texts.collect()}
    assert (len(blocks) > 5) == (size != "128m")
    inside = texts.where("at > 0" if size != "128m" else "true").select(F.spark_partition_id()).distinct().count()
    assert (inside > 5) == (size != "128m")


def test_one_huge_record_over_many_blocks(spark, tmp_path, split_size):
    records = [{"id": 1, "text": "a"}, {"id": 2, "text": '}"{' * 30_000, "n": {"k": "deep"}}, {"id": 3, "text": "{" * 5_000}]
    (tmp_path / "x.json").write_text(json.dumps(records, indent=2))
    split_size("4k")
    rows = json_arrays.read_json_array(spark, str(tmp_path / "x.json"), SCHEMA, keep_place=True).orderBy("file", "block", "at").collect()
    assert [(r.id, r.text) for r in rows] == [(r["id"], r["text"]) for r in records]


def test_strings_with_braces_between_records(spark, tmp_path, split_size):
    (tmp_path / "x.json").write_text('["}{", {"id": 1}, "a\\"{b}", 7, null, {"id": 2, "text": "}"}]')
    for size in ("1m", "9"):
        split_size(size)
        rows = json_arrays.read_json_array(spark, str(tmp_path / "x.json"), "id bigint, text string").collect()
        assert sorted((r.id, r.text) for r in rows) == [(1, None), (2, "}")]


def test_stage_tables_as_arrays(spark, tmp_path):
    records = [{"id": i, "file": f"f{i % 3}", "chunk_index": i, "source": None, "text": f't "{i}" }},{{'} for i in range(500)]
    df = spark.createDataFrame([tuple(r.values()) for r in records], tables.CHUNK_SCHEMA)
    tables.write_table(df.repartition(4), str(tmp_path / "c"), "json_array")
    written = [json.loads(p.read_text()) for p in (tmp_path / "c").glob("part-*")]
    assert sorted((r for part in written for r in part), key=lambda r: r["id"]) == records
    assert sorted(tables.read_chunks(spark, str(tmp_path / "c")).collect()) == sorted(df.collect())
    tables.write_table(df.limit(0), str(tmp_path / "none"), "json_array")
    assert tables.read_chunks(spark, str(tmp_path / "none")).count() == 0
    tables.write_table(df, str(tmp_path / "lines"), "json")
    assert tables.read_chunks(spark, str(tmp_path / "lines"), array=False).count() == 500


# --- ledger ---------------------------------------------------------------------------


def chats(spark, n, same=1):
    rows = [(i, f"text {i // same}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string").select("id", F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("messages"))


def noting(log, fails=None):
    """A model that notes each call in a file and fails on one text while a file is there."""

    def load():
        def answer(messages):
            content = messages[-1]["content"]
            with open(log, "a") as f:
                f.write(content + "\n")
            if fails and content == "text 13" and os.path.exists(fails):
                raise RuntimeError("not now")
            return f"answer to {content}"

        return answer

    return load


def calls(log):
    return Counter(Path(log).read_text().split("\n")[:-1]) if os.path.exists(log) else Counter()


def test_equal_requests_are_asked_once(spark, tmp_path):
    book, log = ledger.Ledger(spark, str(tmp_path / "l")), str(tmp_path / "log")
    assert book.read().count() == 0
    df = chats(spark, 60, same=3).unionByName(spark.createDataFrame([(99, None)], "id long, messages array<struct<role:string,content:string>>"))
    for _ in range(2):
        rows = ledger.ask(df, book, noting(log), calls_per_task=7).collect()
        assert {(r.id, r.response, r.failure) for r in rows} == {(i, f"answer to text {i // 3}", None) for i in range(60)} | {(99, None, None)}
    assert calls(log) == Counter(f"text {i}" for i in range(20))
    assert ledger.ask(df, book, noting(log), model="another").count() == 61
    assert sum(calls(log).values()) == 40
    assert ledger.ask(df.limit(0), book, noting(log)).count() == 0
    book.compact_to(str(tmp_path / "small"))
    again = ledger.Ledger(spark, str(tmp_path / "small"))
    assert sorted(again.read().drop("tries").collect()) == sorted(book.read().drop("tries").collect())


def test_a_failed_run_keeps_the_answers_of_its_finished_tasks(spark, tmp_path):
    book, log, fails = ledger.Ledger(spark, str(tmp_path / "l")), str(tmp_path / "log"), tmp_path / "fails"
    fails.write_text("")
    df = chats(spark, 200)
    with pytest.raises(PySparkException, match="not now"):
        ledger.ask(df, book, noting(log, str(fails)), calls_per_task=2, tries=1, wait=0.0)
    deadline = time.time() + 20  # other tasks of the stage may still be ending
    kept = -1
    while kept != book.read().count() and time.time() < deadline:
        kept = book.read().count()
        time.sleep(1)
    known = {r.response.removeprefix("answer to ") for r in book.read().collect()}
    assert 0 < kept < 200 and len(known) == kept
    before = calls(log)
    fails.unlink()
    rows = ledger.ask(df, book, noting(log, str(fails)), calls_per_task=2, tries=1, wait=0.0).collect()
    assert {(r.id, r.response) for r in rows} == {(i, f"answer to text {i}") for i in range(200)}
    new = calls(log) - before
    assert not known & set(new) and set(new) | known == {f"text {i}" for i in range(200)} and max(new.values()) == 1


def test_failures_are_kept_and_asked_again(spark, tmp_path):
    book, log, fails = ledger.Ledger(spark, str(tmp_path / "l")), str(tmp_path / "log"), tmp_path / "fails"
    fails.write_text("")
    df, options = chats(spark, 20), {"tries": 1, "wait": 0.0, "on_error": "record"}
    rows = {r.id: r for r in ledger.ask(df, book, noting(log, str(fails)), **options).collect()}
    assert rows[13].failure == "not now" and rows[13].response is None and rows[12].failure is None
    assert {r.id: r.failure for r in ledger.ask(df, book, noting(log), retry_failures=False, **options).collect()}[13] == "not now"
    fails.unlink()
    rows = {r.id: r for r in ledger.ask(df, book, noting(log, str(fails)), **options).collect()}
    assert (rows[13].response, rows[13].failure) == ("answer to text 13", None)
    assert calls(log) == Counter([f"text {i}" for i in range(20)] + ["text 13"])
    assert {r.tries for r in book.read().collect()} == {1, 2}


KILLED = """
import os, sys, time
sys.path[:0] = [{root!r}, {root!r} + "/tests"]
from conftest import session
from test_stores import chats
from tripleweave.operators import ledger

def load():
    def answer(messages):
        with open({log!r}, "a") as f:
            f.write(messages[-1]["content"] + "\\n")
        time.sleep(0.05)
        return "answer to " + messages[-1]["content"]
    return answer

spark = session()
ledger.ask(chats(spark, 400), ledger.Ledger(spark, {path!r}), load, calls_per_task=4)
"""


def test_a_killed_driver_loses_running_calls_only(spark, tmp_path):
    path, log = str(tmp_path / "l"), str(tmp_path / "log")
    root = str(Path(__file__).resolve().parent.parent)
    (tmp_path / "killed.py").write_text(KILLED.format(root=root, log=log, path=path))
    run = subprocess.Popen([sys.executable, str(tmp_path / "killed.py")], cwd=tmp_path, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    deadline = time.time() + 120
    while sum(calls(log).values()) < 150 and run.poll() is None and time.time() < deadline:
        time.sleep(0.1)
    run.kill()
    run.wait()
    asked = -1
    while asked != sum(calls(log).values()):  # its engine ends after it
        asked = sum(calls(log).values())
        time.sleep(2)
    book = ledger.Ledger(spark, path)
    known = {r.response.removeprefix("answer to ") for r in book.read().collect()}
    assert 150 <= asked < 400 and asked - len(known) <= 8 * 4
    before = calls(log)
    rows = ledger.ask(chats(spark, 400), book, noting(log), calls_per_task=50).collect()
    assert {(r.id, r.response) for r in rows} == {(i, f"answer to text {i}") for i in range(400)}
    new = calls(log) - before
    assert not known & set(new) and len(new) == 400 - len(known)


def test_model_flow_with_a_ledger(spark, tmp_path):
    docs = spark.createDataFrame([(i, "城市北部规划建设产业园区。") for i in range(5)] + [(9, "发展目标。")], "doc_id long, text string")
    book = ledger.Ledger(spark, str(tmp_path / "l"))
    options = {"ner": stand_ins.entity_model, "extract": stand_ins.triple_model, "tries": 1, "wait": 0.0}
    rows = [flows.model_records(docs, "doc_id", answers=a, **options).select("doc_id", "error", F.to_json("triplets")).collect() for a in (None, book, book)]
    assert sorted(rows[0], key=str) == sorted(rows[1], key=str) == sorted(rows[2], key=str)
    # two entity requests, one triple request that is answered, and one that fails in both runs
    assert sorted((r.tries, r.failure) for r in book.read().collect()) == [(1, None), (1, None), (1, None), (2, "no answer")]


# --- stored graph and index -------------------------------------------------------------


def triples_of(spark, rows):
    return spark.createDataFrame([(i, 0, *r) for i, r in enumerate(rows)], "rec long, pos long, head string, rel string, tail string")


def test_edge_store_against_plain_dicts(spark, tmp_path):
    rng, store, want = random.Random(4), edge_store.EdgeStore(spark, str(tmp_path / "g"), file_rows=40), {}
    assert store.edges().count() == store.nodes().count() == store.neighbours(["a"]).count() == 0
    for k in range(6):
        rows = [(f"h{rng.randrange(9)}", rng.choice(["推进", "推进!", "x y", "x-y", "z"]), f"t{rng.randrange(6)}") for _ in range(rng.choice([0, 30, 60]))]
        df = triples_of(spark, rows)
        assert store.import_batch(df, f"batch{k}", "rec", "pos")
        assert not store.import_batch(triples_of(spark, [("no", "no", "no")]), f"batch{k}", "rec", "pos")
        for r in graph.graph_edges(df, "rec", "pos").collect():
            want[r.head, r.rel_type, r.tail] = r.rel_name
        store.compact(fanout=2)
        assert {(r.head, r.rel_type, r.tail): r.rel_name for r in store.edges().collect()} == want
    assert len(store.runs.runs()) <= 3
    again = edge_store.EdgeStore(spark, str(tmp_path / "g"))
    assert {r.name for r in again.nodes().collect()} == {x for h, _, t in want for x in (h, t)}
    assert {(r.head, r.rel_type, r.tail): r.rel_name for r in again.neighbours(["h3", "none"]).collect()} == {k: v for k, v in want.items() if k[0] == "h3"}
    with pytest.raises(ValueError):
        store.import_batch(triples_of(spark, [("a", "b", "c")]), "no/name", "rec", "pos")


def test_a_run_that_was_not_committed_does_not_exist(spark, tmp_path, monkeypatch):
    store = edge_store.EdgeStore(spark, str(tmp_path / "g"))
    store.import_batch(triples_of(spark, [("a", "推进", "b")]), "one", "rec", "pos")
    with monkeypatch.context() as m:
        m.setattr(runs.RunStore, "commit", lambda self, rows: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.import_batch(triples_of(spark, [("c", "推进", "d")]), "two", "rec", "pos")
    assert {r.head for r in store.edges().collect()} == {"a"}
    assert store.import_batch(triples_of(spark, [("e", "推进", "f")]), "two", "rec", "pos")  # tried again
    assert {r.head for r in store.edges().collect()} == {"a", "e"}


def test_stream_into_the_store_once(spark, tmp_path):
    source, store = str(tmp_path / "s"), edge_store.EdgeStore(spark, str(tmp_path / "g"))
    schema = "rec long, pos long, head string, rel string, tail string"
    for k, rel in enumerate(("x-y", "x y", "z")):
        spark.createDataFrame([(k, 0, "a", rel, "t"), (k, 1, f"h{k}", "推进", "t")], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        import_stream_to_store(stream, store, str(tmp_path / "c"), "rec", "pos", fanout=2, once=True).awaitTermination(120)
    got = {(r.head, r.rel_type, r.tail): r.rel_name for r in store.edges().collect()}
    sanitized = graph.graph_edges(spark.createDataFrame([(0, 0, "a", "推进", "t")], schema), "rec", "pos").first().rel_type
    assert got == {("a", "X_Y", "t"): "x y", ("a", "Z", "t"): "z"} | {(f"h{k}", sanitized, "t"): "推进" for k in range(3)}
    runs_before = store.runs.log().count()
    import_stream_to_store(stream, store, str(tmp_path / "c"), "rec", "pos", once=True).awaitTermination(120)
    assert store.runs.log().count() == runs_before
    # the same files under another checkpoint are another import
    import_stream_to_store(stream, store, str(tmp_path / "c2"), "rec", "pos", once=True).awaitTermination(120)
    assert store.runs.log().count() > runs_before and store.edges().count() == len(got)


def test_stored_index_opens_few_files(spark, tmp_path):
    rows = [(f"e{i % 500:03d}", "推进", f"x{i % 7}") for i in range(4000)] + [("hot", "推进", f"y{i}") for i in range(4000)]
    posted = index.postings(triples_of(spark, rows), "rec")
    stored = stored_index.StoredIndex(spark, str(tmp_path / "i"), "rec", "pos", "role")
    assert stored.lookup("hot") is None and stored.postings() is None
    assert stored.add(posted.where("rec % 5 > 0"), "main", files=24) and not stored.add(posted, "main")
    for k in range(4):
        stored.add(posted.where(F.expr(f"rec % 5 = 0 and (rec div 5) % 4 = {k}")), f"delta{k}", files=3)
    plain = lambda df: Counter(map(tuple, df.select(*posted.columns).collect()))
    for _ in range(2):
        for name in ("e123", "hot"):
            found = stored.lookup(name)
            assert plain(found) == plain(posted.where(F.col("entity") == name))
            opened, files = stored.files_read([name])
            assert found.select(F.input_file_name()).distinct().count() <= opened
            # the hot entity has a quarter of all postings in several files, another one a file of each run, or two at a border
            many = name == "hot"
            assert (4 < opened < files) if many else opened <= 2 * len(stored.runs.runs()), (name, opened, files)
        assert stored.lookup(["zzz"]) is None or stored.lookup(["zzz"]).count() == 0
        wanted = spark.createDataFrame([("e007",), ("e007",), (None,), ("none",), ("hot",)], "entity string")
        assert plain(stored.lookup(wanted)) == plain(posted.where("entity in ('e007', 'hot')")) == plain(stored.runs.lookup_join(wanted, listed=1))
        assert plain(stored.postings()) == plain(posted)
        stored.merge(fanout=3)
    assert [r["level"] for r in stored.runs.runs()].count(1) == 1


# --- sink -------------------------------------------------------------------------------


class Breaking(graph_sink.FolderStore):
    """Fails in the task that meets one head, after it has staged some rows."""

    def stage(self, batch, attempt, rows):
        super().stage(batch, attempt, rows)
        if any(r["head"] == "h13" for r in rows):
            raise RuntimeError("store is gone")


def some_edges(spark, n=100, name="r"):
    return spark.createDataFrame([(f"h{i}", "R", f"t{i}", name) for i in range(n)], "head string, rel_type string, tail string, rel_name string").repartition(8)


def test_a_batch_is_sent_whole(spark, tmp_path):
    store = graph_sink.FolderStore(str(tmp_path / "s"))
    graph_sink.send_batch(some_edges(spark), store, "b1", batch_rows=7)
    graph_sink.send_batch(some_edges(spark, 10, "new"), store, "b2", partitions=2)
    graph_sink.send_batch(some_edges(spark, 10, "late"), store, "b1")  # known by its name
    graph_sink.send_batch(some_edges(spark).limit(0), store, "b3")
    assert store.batches() == ["b1", "b2", "b3"]
    assert store.edges() == {(f"h{i}", "R", f"t{i}"): "new" if i < 10 else "r" for i in range(100)}


def test_a_failing_task_leaves_no_half_batch(spark, tmp_path):
    path = str(tmp_path / "s")
    with pytest.raises(PySparkException, match="store is gone"):
        graph_sink.send_batch(some_edges(spark), Breaking(path), "b1", batch_rows=3)
    store = graph_sink.FolderStore(path)
    assert store.batches() == [] and store.edges() == {}
    graph_sink.send_batch(some_edges(spark), store, "b1")
    assert len(store.edges()) == 100


def test_rows_of_a_lost_attempt_are_not_read(tmp_path):
    store = graph_sink.FolderStore(str(tmp_path))
    edge = lambda h: {"head": h, "rel_type": "R", "tail": "t", "rel_name": "r"}
    store.stage("b", "0-1", [edge("half")])
    store.stage("b", "0-2", [edge("a"), edge("b")])
    store.commit("b", ["0-2"])
    assert {k[0] for k in store.edges()} == {"a", "b"}


# --- model ladder -------------------------------------------------------------------------


def test_the_first_model_that_opens_is_opened_once_in_a_worker(spark, tmp_path):
    log = str(tmp_path / "opened")

    def open_model(name):
        with open(log, "a") as f:
            f.write(f"{os.getpid()} {name}\n")
        if name == "large":
            raise OSError("no such model")
        return lambda text: [{"i": 0, "text": name, "lemma": "", "pos": "", "tag": "", "dep": "", "head_i": 0, "is_space": False}]

    df = spark.createDataFrame([(i, "x") for i in range(64)], "id long, text string").repartition(32)
    rows = syntax.annotate_tokens(df, syntax.model_ladder([None, "large", "small", "never"], open_model))
    for _ in range(2):
        assert {r.tokens[0].text for r in rows.collect()} == {"small"}
    opened = Counter(Path(log).read_text().split("\n")[:-1])
    assert max(opened.values()) == 1 and len(opened) <= 2 * 8
    with pytest.raises(ValueError):
        syntax.model_ladder([None], open_model)


def test_the_last_error_is_raised():
    def open_model(name):
        raise OSError(f"no {name}")

    with pytest.raises(OSError, match="no b") as e:
        syntax.model_ladder(["a", "b"], open_model)()
    assert e.value.__notes__ == ["a: OSError: no a"]


def test_file_ranges_are_found_without_a_sort_of_all_rows(spark, tmp_path):
    """Ends of the files of a run: right with nulls and letters of any script, and no task sorts its rows for them."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "é", "z", "城市", "\U0001f600", "", None, "Z"]) , i) for i in range(300)]
    store = runs.RunStore(spark, str(tmp_path / "runs"), "k", ["n"], file_rows=40)
    plans = []
    keep = store.commit
    store.commit = lambda out: (plans.append(out._jdf.queryExecution().executedPlan().toString()), keep(out))
    assert store.add(spark.createDataFrame(rows, "k string, n long"), "one")
    files = store.files().where("file is not null").collect()
    assert sum(f["rows"] for f in files) == 300 and len(files) >= 7
    for f in files:
        got = [r.k for r in spark.read.parquet(f["file"]).collect() if r.k is not None]
        assert (f["least"], f["most"]) == ((min(got, key=str.encode), max(got, key=str.encode)) if got else (None, None)) and f["rows"] >= len(got)
    scans = [line for line in plans[0].split("== Initial Plan ==")[0].splitlines()]
    below = "\n".join(scans[next(i for i, x in enumerate(scans) if "MapInArrow" in x):])
    assert "Sort" not in below
