"""Plans keep the shape they were designed for."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from tripleweave.operators import chunking, cleaning, graph, index, stats, tagging
from tripleweave.plans import catalog, flows
from tripleweave.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df) -> str:
    """Operator tree only, without details."""
    return plan(df).split("\n\n")[0]


def documents(spark):
    return read_table(spark, SF, "documents")


def stored_triples(spark, folder):
    path = f"{folder}/t"
    rows = read_table(spark, SF, "lineitem").selectExpr(
        "l_orderkey as rec", "l_linenumber as pos", "concat('s', l_suppkey) as head", "'推进' as rel", "concat('p', l_partkey) as tail"
    )
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_rules_do_not_shuffle_and_read_two_columns(spark):
    df = flows.rule_records(documents(spark), "doc_id")
    assert "Exchange" not in tree(df) and "Python" not in tree(df)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(df)


def test_tagging_reads_the_text_once(spark):
    df = tagging.tag_entities(documents(spark).filter("lang = 'en'"), "doc_id")
    assert "EqualTo(lang,en)" in plan(df) and "Exchange" not in tree(df)


def test_long_cleaning_hashes_and_shuffles_once(spark, tmp_path):
    text = tree(cleaning.clean_triples(stored_triples(spark, tmp_path)))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2 and "Sort" not in text


def test_counts_use_hash_aggregation(spark, tmp_path):
    rows = stored_triples(spark, tmp_path)
    for df in (cleaning._outcome(rows, "rec"), stats.top_relations(rows, "rec", "pos")):
        assert "SortAggregate" not in tree(df)


def test_edges_merge_triples_by_hash_first(spark, tmp_path):
    text = tree(graph.graph_edges(stored_triples(spark, tmp_path), "rec", "pos"))
    assert text.count("HashAggregate") == 2 and text.rindex("HashAggregate") < text.rindex("Scan")


def test_preview_lists_take_top_rows_only(spark, tmp_path):
    assert "TakeOrderedAndProject" in plan(stats.top_relations(stored_triples(spark, tmp_path), "rec", "pos"))


def test_registered_plans_do_not_spread_their_input(spark):
    for name in ("chunk_documents", "tag_entities", "clean_records", "graph_edges"):
        assert "REPARTITION_BY_NUM" not in plan(catalog.QUERIES[name](spark, SF))


def test_numbering_moves_keys_not_texts(spark):
    text = plan(chunking.numbered_chunks(documents(spark).select("doc_id", "text"), "doc_id"))
    for part in text.split("\n\n"):
        if "Exchange" in part.split("\n")[0] and "Arguments: hashpartitioning" in part:
            assert "text#" not in part


def test_index_files_are_bounded_and_sorted(spark, tmp_path):
    posted = index.postings(stored_triples(spark, tmp_path), "rec")
    index.write_index(posted, "tripleweave_postings", files=8, path=str(tmp_path / "index"))
    try:
        found = index.lookup(spark.table("tripleweave_postings"), "s7")
        assert "EqualTo(entity,s7)" in plan(found)
        files = len(list((tmp_path / "index").glob("*.parquet")))
        assert found.select(F.input_file_name()).distinct().count() <= 2 < files <= 8
        assert found.count() == posted.filter(F.col("entity") == "s7").count() > 0
    finally:
        spark.sql("drop table tripleweave_postings")


def test_lexicon_join_runs_in_the_engine(spark):
    words = tagging.lexicon_table(spark, [("c", ["ing"], "e"), ("c", ["the"], "f")])
    sent = tree(tagging.tag_by_join(documents(spark), words, "doc_id"))
    dealt = tree(tagging.tag_by_join(documents(spark), words, "doc_id", most_sent=0))
    assert "Python" not in sent + dealt and "Arrow" not in sent + dealt and "NestedLoop" not in sent + dealt
    # a sent lexicon meets the substrings before anything is shuffled
    assert "BroadcastHashJoin" in sent
