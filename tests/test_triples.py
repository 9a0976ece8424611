"""Cleaning, rules, hub, syntax, index and graph on golden rows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tripleweave import lexicon as L
from tripleweave.functions import relations as R
from tripleweave.functions.prompts import core_prompt
from tripleweave.functions import text as X
from tripleweave.operators import chunking, cleaning, graph, index, inference, stats, syntax, tagging, triples
from tripleweave.plans import flows, stand_ins
from tripleweave.sources import storage, tables
from tripleweave.streaming.graph_stream import import_stream

ROWS = [
    ("演示", "三元组", "示例"), ("政府", "推进", "建设"), ("政府", "促进", "建设"), ("a", "推进", "a"), ("a", "推进", "bb"),
    ("！！", "推进", "bb"), ("北", "位于", "城区"), (None, None, None), ("", "推进", "b"),
]
REASONS = ["placeholder", None, None, "head_eq_tail", "invalid_entity", "invalid_entity", "rel_no_keyword", "bad_format", "placeholder"]


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(ROWS)], "rec bigint, pos int, head string, rel string, tail string")


@pytest.fixture(scope="module")
def records(spark):
    full = [list(r) if r[0] is not None else ["x", "y"] for r in ROWS]
    rows = [(1, json.dumps(full)), (2, '{"error":"e","raw":"r"}'), (3, None), (4, '"text"'), (5, "{}"), (6, '[["a ","推进"," b c","more"]]')]
    return spark.createDataFrame(rows, "rec bigint, raw string").withColumn("triplets", F.parse_json("raw"))


def test_ladder(long):
    got = {r.pos: r.reason for r in cleaning.classify(long).collect()}
    assert [got[i] for i in range(len(ROWS))] == REASONS


def test_survivors_and_totals(spark, long):
    assert [tuple(r) for r in cleaning.clean_triples(long).collect()] == [(1, 1, "政府", "推进", "建设")]
    assert tuple(cleaning.clean_totals(long).first()) == (9, 1)
    errors = spark.createDataFrame([(2,)], "rec bigint")
    counts = cleaning.reason_counts(long, errors).collect()
    assert {r.reason: r.n for r in counts} == {
        "placeholder": 2, "invalid_entity": 2, "head_eq_tail": 1, "rel_no_keyword": 1, "bad_format": 1, "dup": 1,
        "llm_parse_error": 1,
    }
    # most frequent first, then first seen: the duplicate is found after the whole ladder
    assert [r.reason for r in sorted(counts, key=lambda r: r.rank)] == [
        "placeholder", "invalid_entity", "head_eq_tail", "rel_no_keyword", "bad_format", "dup", "llm_parse_error"]


def test_record_form_equals_long_form(records):
    cleaned = {r.rec: r for r in cleaning.clean_records(records.select("rec", "triplets")).collect()}
    assert [tuple(t) for t in cleaned[1].triplets] == [("政府", "推进", "建设")]
    assert cleaned[1].removed == {"placeholder": 2, "invalid_entity": 2, "head_eq_tail": 1, "rel_no_keyword": 1, "bad_format": 1, "dup": 1}
    assert cleaned[2].removed == {"llm_parse_error": 1} and cleaned[2].before == 0
    assert cleaned[3].triplets == [] and cleaned[3].before == 0
    assert cleaned[4].removed == {"bad_format": 1} and cleaned[4].before == 1
    assert cleaned[5].before == 0
    assert [tuple(t) for t in cleaned[6].triplets] == []  # one-character head
    for r in cleaned.values():
        lost = sum(n for k, n in r.removed.items() if k != "llm_parse_error")
        assert r.before == len(r.triplets) + lost


def test_cleaning_twice_changes_nothing(spark):
    relations = [*L.RELATION_KEYWORDS, "规划建设", "推动实施"]
    rows = [(1, i, f"h{i % 3}", rel, "tail") for i, rel in enumerate(relations)]
    df = spark.createDataFrame(rows, "rec bigint, pos int, head string, rel string, tail string")
    once = cleaning.clean_triples(df)
    assert sorted(once.collect()) == sorted(cleaning.clean_triples(once).collect())


def test_relation_goldens(spark):
    pairs = {"推动实施": "推进", "完成": "实现", "建设": "发展", "计划": "规划活动", "规划建设": "发展", "采用": "采用", " 位于　": "位于"}
    names = {"supplies": "SUPPLIES", "a-b": "A_B", "--": "REL", "推进": "R_推进", "1st": "R_1ST", "_x_": "X", "": "REL"}
    df = spark.createDataFrame([(k,) for k in [*pairs, *names]], "r string")
    got = {r[0]: (r[1], r[2]) for r in df.select("r", R.normalize_relation(F.col("r")), R.sanitize_relation(F.col("r"))).collect()}
    assert {k: got[k][0] for k in pairs} == pairs
    assert {k: got[k][1] for k in names} == names


def test_valid_entity(spark):
    words = {"北": True, "x": False, "5": False, "ab": True, "！！": False, "½½": True, "　": False, "": False, "东北": True, "__": False}
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert {r[0]: r[1] for r in df.select("w", R.valid_entity(F.col("w"))).collect()} == words


def test_tagging_ways_agree(spark):
    texts = ["城市北部规划建设产业园区。", "建筑设计。", "发展目标。", "该地区功能完善。", "今天天气很好。", "", "区"]
    df = spark.createDataFrame(list(enumerate(texts)), "rec int, text string")
    inline = tagging.tag_entities(df, "rec")
    joined = tagging.tag_by_join(df, tagging.lexicon_table(spark, L.TAG_LEXICON), "rec")
    maps = tagging.explode_entities(tagging.tag_records(df), "rec").select("rec", "category", "entity")
    assert sorted(inline.collect()) == sorted(joined.collect()) == sorted(maps.collect())
    assert {r.rec for r in inline.collect()} == {0, 1, 2, 3, 6}
    long = spark.createDataFrame([(9, "x😀" * 40 + "规" + "é" * 30 + "划城" + "市" * 70)], "rec int, text string")
    table = spark.createDataFrame([("A", "规" + "é" * 30 + "划", "span"), ("B", "城市", "end"), ("C", "划城", "mid"), ("D", "规划", "no")],
                                  "category string, keyword string, entity string")
    assert {r.entity for r in tagging.tag_by_join(long, table, "rec").collect()} == {"span", "end", "mid"}
    wide = spark.createDataFrame([(1, "a" * (tagging.WINDOW - 2) + "xyz" + "b" * tagging.WINDOW + "é"), (2, None), (3, "xy z")], "rec int, text string")
    odd = spark.createDataFrame([("A", "xyz", "cut"), ("B", "é", "last"), ("C", None, "none"), ("D", "xyzz", "no")], "category string, keyword string, entity string")
    for most in (0, 100):
        assert {(r.rec, r.entity) for r in tagging.tag_by_join(wide, odd, "rec", most_sent=most).collect()} == {(1, "cut"), (1, "last")}
    assert tagging.tag_by_join(wide, odd.limit(0), "rec").count() == tagging.tag_by_join(wide.limit(0), odd, "rec").count() == 0


def test_the_rarest_part_of_a_keyword_is_its_anchor(spark):
    words = [("c", f"{a}tion", "e") for a in ("na", "sta", "mo", "por")] + [("c", "ab", "e"), ("c", "nation", "f"), ("c", "", "e")]
    found = tagging.anchored(spark.createDataFrame(words, "category string, keyword string, entity string"), 3)
    anchors = {r.keyword: r.anchor for r in found.collect()}
    assert anchors == {"nation": "nat", "station": "sta", "motion": "mot", "portion": "ort", "ab": "ab", "": ""}
    assert found.count() == len(words)


def test_relation_keywords_from_a_table(spark):
    rels = ["促进", "推进", "完成", "采用", "位于", None, "规划建设", "x", "", "demo"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rels * 3)], "rec int, rel string")
    table = spark.createDataFrame([(k,) for k in L.RELATION_KEYWORDS], "keyword string")
    want = sorted(r.rec for r in df.filter(R.contains_any(F.col("rel"), L.RELATION_KEYWORDS)).collect())
    for most in (0, 100):
        assert sorted(r.rec for r in tagging.relations_with_keyword(df, table, most_sent=most).collect()) == want


def test_a_long_lexicon_gives_the_same_in_every_form(spark):
    texts = ["k17 and k9999, k5", "", None, "nothing", "k1234k77", "k0" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    lexicon = [("Concept", [f"k{i}", f"q{i}"], f"e{i}") for i in range(5000)] + [("Location", ["k17"], "place"), ("Location", [""], "all")]
    inline = [("Concept", f"e{i}", r) for r, t in enumerate(texts) for i in range(5000) if t and f"k{i}" in t]
    inline += [("Location", n, r) for r, t in enumerate(texts) if t is not None for n, w in (("place", "k17"), ("all", "")) if w in t]
    rows = lambda d: sorted((r.category, r.entity, r.doc_id) for r in d.collect())
    assert rows(tagging.tag_entities(df, "doc_id", lexicon=lexicon)) == sorted(inline)
    table = spark.createDataFrame([(c, w, e) for c, words, e in lexicon for w in words], "category string, keyword string, entity string")
    for options in ({}, {"most_sent": 900}, {"most_sent": 0, "longest": 2, "salts": 3}):
        assert rows(tagging.tag_by_join(df, table, "doc_id", **options)) == sorted(inline)
    records = flows.rule_records(df.where("length(text) > 0"), "doc_id", lexicon=lexicon)
    assert rows(tagging.explode_entities(records, "doc_id")) == sorted(x for x in inline if texts[x[2]])


def test_rules(spark):
    df = spark.createDataFrame(list(enumerate(["城市北部规划建设产业园区。", "发展目标。", "建筑设计。"])), "rec int, text string")
    got = {r.rec: [tuple(t) for t in r.triplets] for r in triples.generate_triples(tagging.tag_records(df)).collect()}
    assert got[0] == [("城市地区", "发展建设", "发展目标"), ("城市规划", "实现", "产业功能区"), ("政府", "推进", "发展建设")]
    assert got[1] == [("政府", "推进", "发展建设")]
    assert got[2] == [("演示", "三元组", "示例")]


def test_rule_order_and_repeats(spark):
    df = spark.sql("""select map('Location', array('l1', 'l2'), 'Planned activity', array('a1', 'a2'),
      'Land use function', array('f1'), 'Concept', array('c1', 'c2')) as entities""")
    got = [tuple(t) for t in triples.generate_triples(df).first().triplets]
    assert got == [("l1", "a1", "发展目标"), ("l1", "a2", "发展目标"), ("l2", "a1", "发展目标"), ("l2", "a2", "发展目标"),
                   ("城市规划", "实现", "f1"), ("城市规划", "实现", "f1"), ("政府", "推进", "a1"), ("政府", "推进", "a2")]


def test_hub(spark):
    entities = [{"Concept": ["岭南文化"], "Location": ["南沙区"]}] * 2 + [{"Direction": ["北"]}, {"Location": ["南沙区"]}]
    tails = ["绿色建筑", "本土设计元素", "绿色建筑", "绿色建筑"]
    rows = [(i, e, [("政府", "推广", t)]) for i, (e, t) in enumerate(zip(entities, tails))]
    df = spark.createDataFrame(rows, f"rec int, entities map<string,array<string>>, triplets {triples.TRIPLES}")
    linked = {r.rec: [tuple(t) for t in r.triplets] for r in triples.link_hub(df).collect()}
    assert linked[0][1:] == [("岭南文化", "相关于", "本土设计")]
    assert len(linked[1]) == 1 and len(linked[2]) == 1
    assert linked[3][1:] == [("南沙区", "相关于", "本土设计")]
    rows = triples.explode_triples(df, "rec")
    links = triples.hub_links(rows, tagging.explode_entities(df, "rec"))
    assert {r.rec: tuple(r)[1:] for r in links.collect()} == {0: linked[0][1], 3: linked[3][1]}
    assert {r.rec: r.linked for r in triples.hub_linked(rows).collect()} == {0: False, 1: True, 2: False, 3: False}


TOKENS = [
    (1, 0, "政府", "NOUN", "nsubj", 1, False), (1, 1, "加强", "VERB", "ROOT", 1, False), (1, 2, " ", "SPACE", "dep", 1, True),
    (1, 3, "建设", "NOUN", "dobj", 1, False),
]


def test_syntax_forms_agree(spark):
    long = spark.createDataFrame(TOKENS, "id bigint, i int, text string, pos string, dep string, head_i int, is_space boolean")
    chunks = spark.createDataFrame([(1, "政府加强 建设"), (2, " ")], "id bigint, text string")
    feats = {r.id: r for r in syntax.features_for(chunks, long).collect()}
    assert feats[1].dep == "政府(nsubj) -> 加强(ROOT) -> 建设(dobj)"
    assert feats[1].con_pos == "政府(NOUN) 加强(VERB) 建设(NOUN)"
    assert (feats[2].dep, feats[2].con_pos) == ("", "")
    packed = [dict(i=i, text=t, lemma=t, pos=p, tag=p, dep=d, head_i=h, is_space=s) for _, i, t, p, d, h, s in TOKENS]
    rec = syntax.analyze_syntax(chunks, lambda: lambda text: packed)
    got = {r.id: r.syntax for r in rec.collect()}
    assert (got[1].dep, got[1].con_pos) == (feats[1].dep, feats[1].con_pos)
    assert got[2].tokens == [] and got[2].dep == "" and got[2].dep_triples == []
    pairs = [(1, t.head_i, t.head_text, t.dep, t.child_i, t.child_text) for t in got[1].dep_triples]
    assert sorted(pairs) == sorted(tuple(r) for r in syntax.token_dependencies(long).collect()) and len(pairs) == 3
    assert set(got[1].tokens[0].asDict()) == {"text", "lemma", "pos", "tag", "dep", "i", "head_i", "head_text"}


def test_core_prompt_falls_through_empty_strings(spark):
    df = spark.sql("select 'T' as text, '' as dep, 'D' as dependency, cast(null as string) as con, 'C' as con_pos")
    prompt = df.select(core_prompt(F.col("text"), [F.col("dep"), F.col("dependency")], [F.col("con"), F.col("con_pos")], "核心")).first()[0]
    assert "依存关系：D\n" in prompt and "成分分析：C\n" in prompt and "【核心】" in prompt


def test_index(spark):
    rows = [(1, 0, " a ", "r", "b"), (1, 1, "a", "r", "a"), (5000, 0, "a", "r", " "), (2, 0, None, None, None)]
    df = spark.createDataFrame(rows, "rec bigint, pos int, head string, rel string, tail string")
    posted = index.postings(df, "rec")
    got = sorted((r.entity, r.rec, r.pos, r.role, r.head) for r in posted.collect())
    assert got == [("a", 1, 0, 0, " a "), ("a", 1, 1, 0, "a"), ("a", 1, 1, 1, "a"), ("a", 5000, 0, 0, "a"), ("b", 1, 0, 1, " a ")]
    found = index.inverted_index(posted, "rec", most=3).collect()
    blocks = {(r.entity, r.block): [(p.rec, p.pos, p.role) for p in r.postings] for r in found}
    assert blocks == {("a", 0): [(1, 0, 0), (1, 1, 0), (1, 1, 1)], ("a", 1): [(5000, 0, 0)], ("b", 0): [(1, 0, 1)]}
    wanted = spark.createDataFrame([("b",)], "entity string")
    assert index.lookup(posted, wanted).count() == index.lookup(posted, "b").count() == 1
    assert index.lookup(posted, ["a", "b"]).count() == 5
    texts = spark.createDataFrame([(1, "t")], "rec bigint, text string")
    assert index.with_text(posted, texts, "rec").count() == 4


GRAPH = "rec bigint, pos int, head string, rel string, tail string"


def test_graph(spark, tmp_path):
    first = spark.createDataFrame([(1, 0, "a", "x-y", "b"), (1, 1, "a", "x y", "b"), (2, 0, "a", "z", "b"), (3, 0, None, None, None)], GRAPH)
    edges = graph.graph_edges(first, "rec", "pos")
    assert {(r.rel_type, r.rel_name, r.support) for r in edges.collect()} == {("X_Y", "x y", 2), ("Z", "z", 1)}
    assert {r.name for r in graph.graph_nodes(first).collect()} == {"a", "b"}
    once = graph.merge_edges(edges, edges)
    assert sorted(once.collect()) == sorted(graph.merge_edges(once, edges).collect()) and once.count() == 2
    second = spark.createDataFrame([(9, 0, "a", "x_y", "b"), (9, 1, "c", "z", "a")], GRAPH)
    path = str(tmp_path / "g")
    for _ in range(2):  # a repeated batch changes nothing
        graph.write_batch(first, path, 0, "rec", "pos")
        graph.write_batch(second, path, 1, "rec", "pos")
    got = {tuple(r) for r in graph.read_edges(spark, path).collect()}
    assert got == {("a", "X_Y", "b", "x_y"), ("a", "Z", "b", "z"), ("c", "Z", "a", "z")}
    assert {r.name for r in graph.read_nodes(spark, path).collect()} == {"a", "b", "c"}
    assert [r.name for r in graph.new_nodes(graph.graph_nodes(first), graph.graph_nodes(second)).collect()] == ["c"]
    graph.compact(spark, path, path + "2")
    assert {tuple(r) for r in graph.read_edges(spark, path + "2").collect()} == got


def test_streamed_import_equals_batch_import(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "g")
    for i in range(3):
        rows = [(i, j, f"h{j % 2}", ["x-y", "x y", "x_y"][i], "t") for j in range(4)]
        spark.createDataFrame(rows, GRAPH).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(GRAPH).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):
        import_stream(stream, path, str(tmp_path / "c"), "rec", "pos", once=True).awaitTermination(120)
    got = {(r.head, r.rel_type, r.tail) for r in graph.read_edges(spark, path).collect()}
    assert got == {("h0", "X_Y", "t"), ("h1", "X_Y", "t")}


def collecting_store(folder):
    def connect():
        import os
        import uuid

        def merge(rows):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
                json.dump(rows, out)

        return merge

    return connect


def test_send_edges(spark, tmp_path):
    edges = spark.range(25).selectExpr("concat('h', id) as head", "'R' as rel_type", "'t' as tail", "'r' as rel_name")
    graph.send_edges(edges, collecting_store(str(tmp_path)), batch_size=4, partitions=3)
    sent = [row for f in tmp_path.iterdir() for row in json.loads(f.read_text())]
    assert sorted(r["head"] for r in sent) == sorted(f"h{i}" for i in range(25))


def test_top_relations_breaks_ties_by_first_seen(spark):
    df = spark.createDataFrame([(2, 0, "a", "x", "b"), (1, 1, "a", "y", "b"), (1, 0, "a", "z", "b"), (3, 0, "a", "z", "b")], GRAPH)
    assert [tuple(r) for r in stats.top_relations(df, "rec", "pos").collect()] == [("z", 2), ("y", 1), ("x", 1)]


def test_files_round_trip(spark, tmp_path):
    for name, text in (("10.txt", "一。"), ("9.txt", "a.\nb."), ("x.md", "no")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    docs = tables.read_text_files(spark, str(tmp_path / "*.txt"))
    assert [(r.file, r.text) for r in docs.orderBy("file").collect()] == [("10.txt", "一。"), ("9.txt", "a.\nb.")]
    items = [
        {"id": 1, "text": "t", "triplets": [["a", "推进", "bb"], ["only"]]},
        {"id": 2, "text": None, "triplets": {"error": "parse_error", "raw": "<"}},
    ]
    (tmp_path / "t.json").write_text(json.dumps(items, ensure_ascii=False, indent=2), encoding="utf-8")
    records = tables.with_rec(tables.read_triplet_records(spark, str(tmp_path / "t.json")))
    assert [(r.id, r.rel) for r in cleaning.explode_items(records, "id").orderBy("pos").collect()] == [(1, "推进"), (1, None)]
    assert [tuple(r) for r in cleaning.parse_errors(records, "id").collect()] == [(2, "parse_error")]
    assert graph.import_total(records).first()[0] == 2
    tables.write_table(records.select("id", "text"), str(tmp_path / "out"), "json")
    lines = [json.loads(x) for f in (tmp_path / "out").glob("*.json") for x in f.read_text().splitlines()]
    assert {"id": 2, "text": None} in lines
    staged = storage.stage(records, "t")
    assert staged.count() == 2 and "triplets" in staged.columns
    chunks = [{"id": 1, "file": "a.txt", "chunk_index": 1, "text": "x"}]
    (tmp_path / "c.json").write_text(json.dumps(chunks, indent=2))
    assert tables.read_chunks(spark, str(tmp_path / "c.json")).first().file == "a.txt"
    (tmp_path / "e.json").write_text(json.dumps([{"id": 1, "text": "x", "entities": {"Concept": ["c"]}}]))
    assert tables.read_entities(spark, str(tmp_path / "e.json")).first().entities == {"Concept": ["c"]}


def test_lenient_model_flow_links_to_the_hub(spark):
    docs = spark.createDataFrame([(1, "城市北部规划。"), (2, "x"), (3, "发展目标很好。")], "doc_id int, text string")
    records = flows.model_records(
        docs, "doc_id", ner=stand_ins.entity_model, extract=stand_ins.triple_model, mode="lenient", style="entities", tries=1, wait=0.0
    )
    got = {r.doc_id: [tuple(t) for t in r.triplets] for r in records.collect()}
    assert got == {1: [("政府", "推进", "建设"), ("x", "相关于", "本土设计")], 3: [("x", "相关于", "本土设计")]}


def test_rule_flow_with_syntax(spark):
    docs = spark.createDataFrame([(1, "城市北部规划 建设产业园区。")], "doc_id int, text string")
    rec = flows.rule_records(docs, "doc_id", parser=syntax.whitespace_tagger).first()
    assert rec.syntax.dep.startswith("城市北部规划(ROOT) -> ") and len(rec.triplets) == 3


def test_one_record_of_very_many_triples(spark):
    """Distinct triples of one record are found by hash: ten times the list is not a hundred times the work."""
    import time

    def taken(n):
        df = spark.range(1).selectExpr(
            f"transform(sequence(1, {n}), i -> struct(concat('h', i % 1000, 'a') as head, '推进' as rel, concat(' t', i) as tail)) as triplets"
        )
        start = time.perf_counter()
        assert cleaning.clean_lists(df).selectExpr("size(triplets)").first()[0] == n
        return time.perf_counter() - start

    taken(1000)
    assert taken(200_000) < 30


def test_one_document_of_very_many_chunks(spark):
    sizes = spark.range(1).selectExpr("transform(sequence(1, 300000), i -> cast(1 + i % 400 as int)) as sizes")
    starts = sizes.select(X.chunk_starts(F.col("sizes")).alias("s")).first().s
    want, used = [], 513
    for i in range(1, 300_001):
        size = 1 + i % 400
        if used + size > 512:
            want.append(i)
            used = 0
        used += size
    assert starts == want and len(want) > 100_000


def test_error_objects_are_told_by_their_key(spark):
    raw = ['{"error": null, "raw": "x"}', '{"error": "e"}', '{"error": {"a": 1}}', '{"other": 1}', '[["a","位于"],["b"],["c","推进","d"]]', "null"]
    df = spark.createDataFrame(list(enumerate(raw)), "rec int, raw string").select("rec", F.parse_json("raw").alias("triplets"))
    assert {r.rec: r.error for r in cleaning.parse_errors(df, "rec").collect()} == {0: None, 1: "e", 2: '{"a":1}'}
    removed = {r.rec: r.removed for r in cleaning.clean_records(df).collect()}
    assert removed[0] == removed[1] == removed[2] == {"llm_parse_error": 1} and removed[3] == {"bad_format": 1}
    assert [(r.rec, r.pos, r.rel) for r in stats.relation_list(df, "rec").orderBy("pos").collect()] == [(4, 0, "位于"), (4, 2, "推进")]


def test_failed_entities_stay_and_are_shown_to_the_second_call(spark):
    docs = spark.createDataFrame([(1, "城市北部规划。")], "doc_id int, text string")

    def ner():
        return lambda messages: "no json"

    def echo():
        return lambda messages: json.dumps([["a", "推进", messages[-1]["content"]]])

    rec = flows.model_records(docs, "doc_id", ner=ner, extract=echo, style="entities", tries=1, wait=0.0).first()
    assert rec.entities is None and rec.entities_error and rec.entities_raw == "no json" and rec.error is None
    content = json.loads(str(rec.triplets))[0][2]
    assert '"error": "no JSON in the response", "raw": "no json"' in content and "城市北部" in content


def test_a_named_run_asks_no_model_twice(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"城市北部规划 {i}。") for i in range(6)], "doc_id int, text string")
    calls = str(tmp_path)

    def counted():
        def answer(messages):
            import os
            import uuid

            open(os.path.join(calls, uuid.uuid4().hex), "w").close()
            return '[["a", "推进", "b"]]'

        return answer

    run = f"run-{os.path.basename(calls)}"
    ask = lambda: flows.model_records(docs, "doc_id", ner=counted, extract=counted, tries=1, wait=0.0, run=run).collect()
    first = ask()
    assert len(os.listdir(calls)) == 12
    assert sorted(map(str, ask())) == sorted(map(str, first)) and len(os.listdir(calls)) == 12
    storage.forget_run(spark, run, "entities", "triplets")
    ask()
    assert len(os.listdir(calls)) == 24


def test_calls_run_at_once_in_order(spark):
    import time

    docs = spark.range(12).selectExpr("array(struct('user' as role, cast(id as string) as content)) as messages", "id").coalesce(1)

    def slow():
        def answer(messages):
            time.sleep(0.4)
            if messages[0]["content"] == "7":
                raise RuntimeError("no")
            return "r" + messages[0]["content"]

        return answer

    start = time.perf_counter()
    got = inference.infer(docs, slow, tries=1, wait=0.0, on_error="record", at_once=12).collect()
    assert time.perf_counter() - start < 4
    assert [(r.id, r.response, r.failure) for r in got] == [(i, None if i == 7 else f"r{i}", "no" if i == 7 else None) for i in range(12)]


def test_imports_and_compaction_lose_no_edges(spark, tmp_path):
    path, sources = str(tmp_path / "g"), [str(tmp_path / f"in{i}") for i in range(3)]
    for i, source in enumerate(sources):
        spark.createDataFrame([(i, 0, f"h{i}", "x", "t"), (i, 1, "both", f"y{'-' * i}z", "t")], GRAPH).coalesce(1).write.parquet(source)

    def take(i, target):
        stream = spark.readStream.schema(GRAPH).parquet(sources[i])
        import_stream(stream, target, str(tmp_path / f"c{i}"), "rec", "pos", once=True).awaitTermination(120)

    take(0, path)
    take(1, path)
    edges = lambda p: {(r.head, r.rel_name) for r in graph.read_edges(spark, p).collect()}
    assert {("h0", "x"), ("h1", "x"), ("both", "y-z")} <= edges(path)
    graph.compact(spark, path, path + "2")
    before = edges(path + "2")
    take(2, path + "2")
    take(2, path + "2")
    assert {("h0", "x"), ("h1", "x"), ("h2", "x")} <= edges(path + "2")
    assert {h for h, _ in before} <= {h for h, _ in edges(path + "2")} and ("both", "y--z") in edges(path + "2")


def test_file_names_are_plain(spark, tmp_path):
    names = ["a b.txt", "c%20d.txt", "e+f.txt", "文 件.txt"]
    for n in names:
        (tmp_path / n).write_text(n, encoding="utf-8")
    docs = tables.read_text_files(spark, str(tmp_path) + "/*.txt").orderBy("file").collect()
    assert [(r.file, r.text) for r in docs] == [(n, n) for n in sorted(names)]
    assert {r.source for r in docs} == {str(tmp_path / n) for n in names}


def test_numbering_tells_equal_names_apart(spark):
    docs = spark.createDataFrame([("b/x", "one。" * 3), ("a/x", "two。"), ("a/x", "three。")], "source string, text string")
    got = chunking.numbered_chunks(docs, "source", budget=2).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, len(got) + 1)) and [r.source for r in got][:2] == ["a/x", "a/x"]
    assert [r.chunk_index for r in got if r.source == "b/x"] == list(range(1, len(got) - 1))


@pytest.mark.parametrize("whole", [1 << 16, 600, 0])
def test_index_blocks_under_a_hot_entity(spark, whole):
    rows = spark.range(5000).selectExpr("concat('f', id % 97, '.txt') as file", "cast(id as int) as pos", "'hot' as head", "'推进' as rel", "concat('t', id % 1000) as tail")
    blocks = index.inverted_index(index.postings(rows, "file"), "file", most=64, whole=whole).collect()
    hot = sorted((r for r in blocks if r.entity == "hot"), key=lambda r: r.block)
    assert [r.block for r in hot] == list(range(79)) and all(r.n == 64 for r in hot[:-1]) and sum(r.n for r in hot) == 5000
    flat = [(p.file, p.pos) for r in hot for p in r.postings]
    assert flat == sorted(flat) and sum(r.n for r in blocks) == 10_000


def test_tokens_of_few_texts_exist_at_a_time(spark):
    """A Python worker holds the token dicts of a slice of its batch, never those of all rows."""

    def load():
        live = [0]

        class Answer(list):
            def __init__(self, tokens):
                super().__init__(tokens)
                live[0] += 1
                assert live[0] <= 400, "too many answers are held"

            def __del__(self):
                live[0] -= 1

        parse = syntax.whitespace_tagger()
        return lambda text: Answer(parse(text))

    text = F.when(F.col("id") % 500 == 7, F.lit(None)).when(F.col("id") == 9, F.repeat(F.lit("z "), 200_000)).otherwise(
        F.concat(F.repeat(F.lit("a b "), 128), F.col("id").cast("string")))
    df = spark.range(0, 2000, 1, 1).withColumn("text", text)
    got = {r.id: (r.n, r.last) for r in syntax.annotate_tokens(df, load).select("id", F.size("tokens").alias("n"), F.try_element_at("tokens", F.lit(-1))["text"].alias("last")).collect()}
    assert got == {i: (0, None) if i % 500 == 7 else (200_000, "z") if i == 9 else (257, str(i)) for i in range(2000)}


def test_few_chats_are_held_at_a_time():
    import pyarrow as pa

    from tripleweave.functions.slices import slices

    chats = [[{"role": "user", "content": "x" * n}] * 2 if n is not None else None for n in (5, None, 0, 40, 3, 4, None)] + [[]]
    array = pa.array([None, *chats], pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())])))[1:]
    assert inference.chat_bytes(array).tolist() == [10, 0, 0, 80, 6, 8, 0, 0]
    parts = [p.to_pylist() for p in slices(array, inference.chat_bytes(array), 20)]
    assert [c for p in parts for c in p] == chats and [len(p) for p in parts] == [3, 1, 4]


def test_records_of_a_model_have_the_syntax_of_their_text_and_store_its_tokens_alone(spark, tmp_path):
    docs = spark.createDataFrame([(1, "城市北部规划 建设\n产业园区。"), (2, "x y."), (3, "")], "doc_id int, text string")
    run = f"syntax-{os.path.basename(tmp_path)}-{os.urandom(4).hex()}"
    records = flows.model_records(docs, "doc_id", ner=stand_ins.entity_model, extract=stand_ins.triple_model, tries=1, wait=0.0, run=run)
    assert records.columns[records.columns.index("syntax") + 1 :] == ["triplets", "error", "raw"] and "tokens" not in records.columns
    got = {r.id: r.syntax for r in records.select(F.col("doc_id").alias("id"), "syntax").collect()}
    want = {r.id: r.syntax for r in syntax.analyze_syntax(records.select(F.col("doc_id").alias("id"), "text")).collect()}
    assert got == want and len(got) >= 2
    stored = spark.read.parquet(f"{storage.shared_folder(spark)}/{run}/triplets")
    assert "syntax" not in stored.columns and "tokens" in stored.columns


# --- answers that exist at a time ---------------------------------------------------------


def few_held(most):
    """Loader of a tagger that fails once more than ``most`` of its answers exist."""

    def load():
        live = [0]

        class Answer(list):
            def __init__(self, tokens):
                super().__init__(tokens)
                live[0] += 1
                assert live[0] <= most, "too many answers are held"

            def __del__(self):
                live[0] -= 1

        parse = syntax.whitespace_tagger()
        return lambda text: Answer(parse(text))

    return load


def long_texts(spark):
    """One partition and one Arrow batch of 1,500 texts of about 1 KB each."""
    return spark.range(0, 1500, 1, 1).withColumn("text", F.concat(F.repeat(F.lit("a b "), 256), F.col("id").cast("string")))


def test_a_model_of_a_ladder_holds_few_answers(spark):
    load = few_held(300)

    def open_model(name):
        if name == "large":
            raise OSError(name)
        return load()

    rows = syntax.annotate_tokens(long_texts(spark), syntax.model_ladder(["large", "small"], open_model)).select("id", F.inline("tokens"))
    got = rows.groupBy("id").agg(F.count("*").alias("n"), F.max_by("text", "i").alias("last")).collect()
    assert {(r.id, r.n, r.last) for r in got} == {(i, 513, str(i)) for i in range(1500)}


def test_dependency_lists_need_few_answers(spark):
    rows = syntax.annotate_tokens(long_texts(spark), few_held(300)).select("id", F.inline(syntax.dependency_list(F.col("tokens"))))
    got = rows.groupBy("id").agg(F.count("*").alias("n"), F.max_by("child_text", "child_i").alias("last"), F.max_by("head_text", "child_i").alias("head")).collect()
    assert {(r.id, r.n, r.last, r.head) for r in got} == {(i, 513, str(i), "b") for i in range(1500)}


def test_feature_strings_need_few_answers(spark):
    got = syntax.analyze_syntax(long_texts(spark), few_held(300)).select("id", "syntax.dep", "syntax.con_pos").collect()
    dep = "a(ROOT) -> b(dep)" + " -> a(dep) -> b(dep)" * 255
    pos = " ".join(["a(WORD) b(WORD)"] * 256)
    assert {(r.id, r.dep, r.con_pos) for r in got} == {(i, f"{dep} -> {i}(dep)", f"{pos} {i}(WORD)") for i in range(1500)}
