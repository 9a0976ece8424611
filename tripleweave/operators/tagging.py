"""Lexicon tagging of texts.

A lexicon is a list of ``(category, keywords, canonical)``. A text gets the
canonical entity once if any of its keywords occurs in it.

* ``entity_column``/``tag_records``/``tag_entities``: the lexicon travels with
  the plan, no join, no shuffle. A short one is a projection of substring
  tests; a long one, whose projection would read the text once per keyword, is
  an automaton over all keywords, built once per worker. Both give the same.
* ``tag_by_join``: the lexicon is a table of any size; each keyword is joined by
  a rare substring of its own with those of the texts, and verified there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions.relations import contains_any
from ..functions.text import rows_of

Lexicon = Sequence[tuple[str, Sequence[str], str]]
#: Up to so many keywords are tested one by one; beyond, an automaton is quicker. The results are the same.
PROJECTED_KEYWORDS = 256
HITS = "array<struct<category:string,entity:string>>"
#: Lexicon rows that a join by substrings sends to every task (some 200 bytes each); longer lexicons are dealt like the texts.
MOST_SENT = 100_000
#: Characters of a text whose substrings are made at once.
WINDOW = 4096


def keyword_count(lexicon: Lexicon) -> int:
    return sum(len(words) for _, words, _ in lexicon)


def entity_column(
    text: Column, lexicon: Lexicon = L.TAG_LEXICON, categories: Sequence[str] = L.CATEGORIES
) -> Column:
    """Entities of a text as map<category, array<entity>>, all categories present."""
    if keyword_count(lexicon) > PROJECTED_KEYWORDS:
        hits = automaton_hits(lexicon)(text)
        of = lambda c: F.transform(F.filter(hits, lambda h: h["category"] == c), lambda h: h["entity"])
        return F.create_map(*[x for c in categories for x in (F.lit(c), of(c))])

    def found(category: str) -> Column:
        hits = [F.when(contains_any(text, words), F.lit(name)) for cat, words, name in lexicon if cat == category]
        return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")

    pairs = [x for c in categories for x in (F.lit(c), found(c))]
    return F.create_map(*pairs)


def automaton_hits(lexicon: Lexicon):
    """Function of a text column: entries with a keyword in the text, in lexicon order.

    All keywords are searched in one pass over the text (Aho-Corasick).
    """

    @F.pandas_udf(HITS)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        entries: dict[str, set[int]] = {}
        for i, (_, words, _) in enumerate(lexicon):
            for word in words:
                entries.setdefault(word, set()).add(i)
        always = entries.pop("", set())  # the empty keyword is in every text
        machine = ahocorasick.Automaton()
        for word, numbers in entries.items():
            machine.add_word(word, numbers)
        if entries:
            machine.make_automaton()

        def found(text: str | None) -> list[dict] | None:
            if text is None:
                return None
            some = set(always).union(*(numbers for _, numbers in machine.iter(text))) if entries else always
            return [{"category": lexicon[i][0], "entity": lexicon[i][2]} for i in sorted(some)]

        for batch in batches:
            yield batch.map(found, na_action=None)

    return hits


def tag_records(chunks: DataFrame, lexicon: Lexicon = L.TAG_LEXICON, text: str = "text", **options) -> DataFrame:
    """Add the ``entities`` map to every chunk."""
    return chunks.withColumn("entities", entity_column(F.col(text), lexicon, **options))


def explode_entities(records: DataFrame, *keys: str, entities: str = "entities") -> DataFrame:
    """Long form: keys, category, pos (within the category), entity."""
    by_category = records.select(*keys, F.inline(rows_of(F.map_entries(entities)))).toDF(*keys, "category", "names")
    return by_category.select(*keys, "category", F.posexplode("names").alias("pos", "entity"))


def tag_entities(chunks: DataFrame, *keys: str, lexicon: Lexicon = L.TAG_LEXICON, text: str = "text") -> DataFrame:
    """Long form straight from the text: keys, category, entity; no shuffle."""
    if keyword_count(lexicon) > PROJECTED_KEYWORDS:
        return chunks.select(*keys, F.inline(automaton_hits(lexicon)(F.col(text))))
    hits = [
        F.when(
            contains_any(F.col(text), words),
            F.struct(F.lit(category).alias("category"), F.lit(name).alias("entity")),
        )
        for category, words, name in lexicon
    ]
    return chunks.select(*keys, F.inline(F.array_compact(F.array(*hits))))


def lexicon_table(spark: SparkSession, lexicon: Lexicon) -> DataFrame:
    """Lexicon rows: category, keyword, entity.

    Built from literals, so that the optimizer knows how small it is; a large
    lexicon comes from a stored table.
    """
    rows = [
        F.struct(F.lit(category).alias("category"), F.lit(word).alias("keyword"), F.lit(name).alias("entity"))
        for category, words, name in lexicon
        for word in words
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def grams(text: Column, length: int) -> Column:
    """All substrings of ``length`` characters, one for each place."""
    if not length:
        return F.array(F.lit(""))
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{length}}}))"), F.lit(1))


def anchored(lexicon: DataFrame, longest: int) -> DataFrame:
    """Lexicon rows with ``anchor``: the substring of ``longest`` characters (all of a shorter keyword) that the fewest keywords have.

    Counted over all keywords, so an ending that thousands of keywords share
    anchors none of those that have a rarer part.
    """
    words = lexicon.select("keyword").where("keyword is not null").distinct()
    parts = F.when(F.length("keyword") > longest, grams(F.col("keyword"), longest)).otherwise(F.array("keyword"))
    some = words.select("keyword", F.explode(F.array_distinct(parts)).alias("gram"))
    shared = some.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = some.join(shared, "gram").groupBy("keyword").agg(F.min(F.struct("n", "gram")).alias("_rarest"))
    return lexicon.join(rarest, "keyword").select("category", "keyword", "entity", F.col("_rarest.gram").alias("anchor"))


def containing(
    texts: DataFrame, lexicon: DataFrame, *keys: str, text: str = "text", longest: int = 3, salts: int = 16, most_sent: int = MOST_SENT
) -> DataFrame:
    """Pairs of a text and a lexicon row whose keyword it contains: keys, category, keyword, entity, each once.

    Every keyword is joined by its anchor with the substrings of the texts,
    which are cut into windows first, and the lexicon rows that meet a text
    are verified on it. ``keys`` must tell the texts apart.

    The number of lexicon rows is counted first. Up to ``most_sent`` they are sent to
    every task, and only substrings that are an anchor leave it. A longer lexicon is dealt, like the
    substrings, by (anchor, salt), so one that most texts have
    is spread over ``salts`` parts, which a skew join may split further.
    """
    size = lexicon.where("keyword is not null").agg(F.count("*").alias("n"), F.collect_set(F.least(F.length("keyword"), F.lit(longest))).alias("lengths")).first()
    rows = texts.where(F.col(text).isNotNull())
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(WINDOW)))
    windows = rows.select(*keys, text, start.alias("_from")).select(*keys, F.expr(f"substring({text}, _from + 1, {WINDOW + longest - 1})").alias("_window"))
    every = F.flatten(F.array(*[grams(F.col("_window"), n) for n in sorted(size["lengths"])])) if size["lengths"] else F.array().cast("array<string>")
    parts = windows.select(*keys, F.explode(every).alias("anchor"))
    words = anchored(lexicon, longest)
    if size["n"] <= most_sent:
        met = parts.join(F.broadcast(words), "anchor")
    else:
        salt = F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int")
        met = parts.withColumn("salt", salt).join(words.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["anchor", "salt"])
    met = met.groupBy(*keys).agg(F.collect_set(F.struct("category", "keyword", "entity")).alias("_met"))
    found = met.join(rows.select(*keys, text), list(keys))
    return found.select(*keys, F.inline(F.filter("_met", lambda m: F.contains(F.col(text), m["keyword"]))))


def tag_by_join(chunks: DataFrame, lexicon: DataFrame, *keys: str, **options) -> DataFrame:
    """Tag with a lexicon table (category, keyword, entity) of any size: keys, category, entity, each once.

    ``options`` are those of ``containing``. Rows without a keyword, and texts
    that are NULL, give nothing; the empty keyword is in every text.
    """
    return containing(chunks, lexicon, *keys, **options).select(*keys, "category", "entity").distinct()


def relations_with_keyword(triples: DataFrame, keywords: DataFrame, rel: str = "rel", **options) -> DataFrame:
    """Triples whose relation holds one of the keywords in a table (a column ``keyword``) of any size.

    Keywords are searched in the distinct relations; triples are semi-joined with those that have one.
    """
    names = triples.select(F.col(rel).alias("_rel")).where("_rel is not null").distinct()
    lexicon = keywords.select("keyword", F.lit("").alias("category"), F.lit("").alias("entity"))
    good = containing(names.withColumn("_text", F.col("_rel")), lexicon, "_rel", text="_text", **options)
    return triples.join(good.select("_rel").distinct(), F.col(rel) == F.col("_rel"), "left_semi")
