"""Registered queries against their SQL, and the pipeline against brute force over its own intermediate tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, connect
from tripleweave.llm import queries, toxicity

from .test_exact_and_near import brute_exact, brute_near
from .test_search import brute_contamination
from .test_text_models import digest, tokenizer  # noqa: F401

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_its_sql(spark, name):
    error, rows, *_ = compare(spark, connect(FOLDER), FOLDER, entry.queries()[name], entry.oracle_sql()[name])
    assert error is None and rows > 0


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= names


def test_pipeline_stages(spark, tmp_path, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    for name, apply in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        texts = [(i, r.text) for i, r in before.items()]
        apply(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in out.collect()}
        if name == "toxicity":
            scored = toxicity.toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
            want = {r.doc_id for r in scored if r.score < 0.7}
        elif name == "exact_dedup":
            want = {i for i, x in brute_exact(texts).items() if x[2]}
        elif name == "minhash_dedup":
            want = {i for i, x in brute_near(texts).items() if x[2]}
        elif name == "decontaminate":
            want = {i for i, x in brute_contamination(texts, bench).items() if not x[4]}
        else:
            assert {i: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for i, r in after.items()} == {i: digest(tokenizer, t) for i, t in texts}
            want = set(before)
        assert set(after) == want
        if name != "bpe":
            assert out.columns == docs.columns and all(after[i] == before[i] for i in after)
        docs = out
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).drop("ids").collect())) == sorted(map(tuple, docs.drop("ids").collect()))
