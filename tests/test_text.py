"""Text operators against plain Python on awkward texts."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripleweave.functions import text as X
from tripleweave.operators import chunking

# what a text may contain: words, every kind of whitespace, noise, terminators
PIECES = [
    "a", "bc", "word", "12", "2024", "12345", "٣", "page 3", "PAGE 7 of 9", "Page", "see page 3", "第 5 页", "第5页x",
    "---", "-*_", "--", "。", "！", "？", "!", "?", ".", "...", "3.14", " ", "  ", "\t", "\n", "\n\n", "\r\n", "\r", "\x0b",
    "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", " ", " ", "　", "​", "﻿", "😀", "é", "城市",
]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=25).map("".join)


def py_lines(text):
    return [s for s in (line.strip() for line in text.splitlines()) if s]


def py_clean(text, extra):
    drop = [r"\d{1,4}\Z", r"(?i:page)\s*\d"] + ([r"第\s*\d+\s*页\Z", r"[-*_]{3,}\Z"] if extra else [])
    return "\n".join(s for s in py_lines(text) if not any(re.match(p, s) for p in drop))


def py_sentences(text):
    found, start = [], 0
    for m in re.finditer(r"[。！？!?.]", text):
        found.append(text[start:m.end()].strip())
        start = m.end()
    return [s for s in [*found, text[start:].strip()] if s]


def py_pack(parts, budget):
    out, used = [], 0
    for s in parts:
        size = max(1, len(s) // 2)
        if out and used + size <= budget:
            out[-1] += s
            used += size
        else:
            out.append(s)
            used = size
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(TEXTS, min_size=40, max_size=60))
def test_against_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    t = F.col("text")
    rows = df.select(
        "id",
        X.strip(t).alias("strip"), X.lines(t).alias("lines"), X.clean_text(t).alias("clean"),
        X.clean_text(t, extra=True).alias("extra"), X.sentences(t).alias("raw"),
        X.sentences(X.clean_text(t)).alias("sents"),
        X.let(X.sentences(X.clean_text(t)), lambda p: X.pack(p, 3)).alias("chunks"),
    ).collect()
    for r in rows:
        text = texts[r["id"]]
        assert r["strip"] == text.strip()
        assert r["lines"] == py_lines(text)
        assert r["clean"] == py_clean(text, False)
        assert r["extra"] == py_clean(text, True)
        assert r["raw"] == py_sentences(text)
        assert r["sents"] == py_sentences(r["clean"])
        assert r["chunks"] == py_pack(r["sents"], 3)
        assert "".join(r["chunks"]) == "".join(r["sents"])


def test_sentence_golden(spark):
    df = spark.createDataFrame([("一。二！ 三? 3.14 ...end",)], "t string")
    assert df.select(X.sentences(F.col("t"))).first()[0] == ["一。", "二！", "三?", "3.", "14 .", ".", ".", "end"]


def test_pack_golden(spark):
    parts = ["aaaa.", "bbbb.", "c.", "x" * 20, "d."]
    df = spark.createDataFrame([(parts,)], "p array<string>")
    assert df.select(X.pack(F.col("p"), 4)).first()[0] == ["aaaa.bbbb.", "c.", "x" * 20, "d."]


def test_chunks_with_a_tokenizer(spark):
    docs = spark.createDataFrame([(1, "aaaa. bbbb. c. d."), (2, "")], "doc_id int, text string")
    count = chunking.tokenizer_sizes(lambda: len)
    rows = chunking.chunk_documents(docs, budget=7, sizes=count).collect()
    assert [(r.doc_id, r.chunk_index, r.id, r.text) for r in rows] == [(1, 1, 1, "aaaa."), (1, 2, 2, "bbbb.c."), (1, 3, 3, "d.")]


def test_failing_tokenizer_falls_back(spark):
    def load():
        raise OSError("no vocabulary")

    docs = spark.createDataFrame([(1, "aaaa. bbbb. c. d.")], "doc_id int, text string")
    with_fallback = chunking.chunk_documents(docs, budget=4, sizes=chunking.tokenizer_sizes(load))
    assert with_fallback.collect() == chunking.chunk_documents(docs, budget=4).collect()


def test_numbering_with_a_hot_file(spark):
    rows = [("10.txt", "x. " * 300), ("9.txt", "a. b."), ("1.txt", "c."), ("empty.txt", "")]
    docs = spark.createDataFrame(rows, "file string, text string")
    numbered = chunking.numbered_chunks(docs, "file", budget=2).orderBy("id").collect()
    assert [r.id for r in numbered] == list(range(1, len(numbered) + 1))
    assert [(r.file, r.chunk_index) for r in numbered] == sorted((r.file, r.chunk_index) for r in numbered)
    assert numbered[0].file == "1.txt" and numbered[-1].text == "a.b."


def test_pages(spark):
    pages = spark.createDataFrame([(1, 2, None), (1, 10, "c"), (1, 1, "a"), (2, 1, None)], "doc_id int, page_no int, text string")
    assert dict(chunking.assemble_pages(pages, "doc_id", "page_no").collect()) == {1: "a\n\nc", 2: ""}
