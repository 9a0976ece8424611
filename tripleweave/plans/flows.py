"""Composed flows. Each is one lazy plan over the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions.text import DEFAULT_BUDGET
from ..operators import chunking, cleaning, graph, index, inference, ledger, prompting, syntax, tagging, triples
from ..sources.storage import stage


def rule_records(
    docs: DataFrame,
    *keys: str,
    lexicon: tagging.Lexicon = L.TAG_LEXICON,
    budget: int = DEFAULT_BUDGET,
    parser: Callable | None = None,
) -> DataFrame:
    """Documents to records by the lexicon and the triple rules; no shuffle.

    Returns keys, chunk_index, id, text, entities, triplets, and syntax if a
    parser is given.
    """
    chunks = chunking.chunk_documents(docs.select(*keys, "text"), budget)
    records = triples.generate_triples(tagging.tag_records(chunks, lexicon))
    return syntax.analyze_syntax(records, parser) if parser else records


def rules_to_index(docs: DataFrame, *keys: str, **options) -> DataFrame:
    """Documents to postings by the rules: entity, keys, chunk_index, pos, role, triple."""
    records = rule_records(docs, *keys, **options)
    return index.postings(triples.explode_triples(records, *keys, "chunk_index"), *keys, "chunk_index")


def model_records(
    docs: DataFrame,
    *keys: str,
    ner: Callable,
    extract: Callable,
    parser: Callable = syntax.whitespace_tagger,
    mode: str = "strict",
    style: str = "core",
    hub: str = L.HUB,
    concepts: Sequence[str] = tuple(L.CORE_CONCEPTS),
    budget: int = DEFAULT_BUDGET,
    tries: int = 5,
    wait: float = 1.0,
    at_once: int = 1,
    run: str | None = None,
    answers: ledger.Ledger | None = None,
    model: str = "",
) -> DataFrame:
    """Documents to records by two model calls per chunk.

    ``ner`` and ``extract`` load the models. ``style="core"`` asks with text,
    syntax and core concepts and keeps a failed call as ``error``;
    ``style="entities"`` asks with text and entities. ``mode="lenient"`` skips
    short texts and records without entities, answers empty after a failure,
    and links records to the hub: ``triplets`` is then a list of triples. A
    failed entity answer stays in ``entities_error`` and ``entities_raw``, and
    the second call is shown it in place of the entities.

    The answers are stored after each call; with a ``run`` name under that
    name, and a later call with the same name and folder takes them from
    there, so a new driver asks for nothing twice. With ``answers`` each task's answers
    are kept in that ledger, under their request and the name of the ``model``, as soon as the task ends,
    and no request is made that it holds. ``at_once`` calls run at a time in each worker.
    """
    lenient = mode == "lenient"
    calls = {"tries": tries, "wait": wait, "on_error": "default" if lenient else "raise", "at_once": at_once}

    def asked_for(prompts: DataFrame, load: Callable, name: str, default: str) -> DataFrame:
        if answers is None:
            return stage(inference.infer(prompts, load, default=default, **calls).drop("messages"), name, run)
        prompts = stage(prompts, f"{name}_asked")
        return ledger.ask(prompts, answers, load, model=f"{name} {model}", default=default, **calls).drop("messages")

    chunks = chunking.chunk_documents(docs.select(*keys, "text"), budget)
    if lenient:
        chunks = inference.prefilter_short_text(chunks)
    asked = asked_for(prompting.render_ner(chunks, mode, hub), ner, "entities", "{}")
    tagged = inference.parse_entities(asked.drop("failure"), mode)
    tagged = tagged.drop("response").withColumnsRenamed({"error": "entities_error", "raw": "entities_raw"})
    if lenient:
        tagged = inference.prefilter_has_entities(tagged)
    if style == "core":
        # the answers are stored with the tokens, a third of the size of the syntax that is made of them
        parsed_texts = syntax.annotate_tokens(tagged, parser).withColumn("syntax", syntax.syntax_column(F.col("tokens")))
        prompts = prompting.render_core(parsed_texts, concepts, L.CORE_FORMAT_JSON).drop("syntax")
        calls["on_error"] = "record"
    else:
        prompts = prompting.render_re(tagged, mode, hub)
    answered = asked_for(prompts, extract, "triplets", "[]")
    if style == "core":
        answered = answered.withColumn("tokens", syntax.syntax_column(F.col("tokens"))).withColumnRenamed("tokens", "syntax")
    parsed = inference.parse_triplets(answered, mode)
    records = parsed.withColumn("error", F.coalesce("failure", "error")).drop("failure", "response")
    return link_model_records(records, hub) if lenient else records


def link_model_records(records: DataFrame, hub: str = L.HUB) -> DataFrame:
    """Valid triples of model records as a list, with the hub link added where it is missing."""
    items = cleaning.valid_items(F.col("triplets"))
    return triples.link_hub(records.withColumn("triplets", items), hub)


@dataclass
class Graph:
    nodes: DataFrame
    edges: DataFrame


def clean_to_graph(long: DataFrame, rec: str = "rec") -> Graph:
    """Long triples to a cleaned graph.

    Dedup and edge merge use the same triple, so the cleaned triples are the
    only large shuffle in front of the edges.
    """
    kept = cleaning.clean_triples(long, rec)
    return Graph(graph.graph_nodes(kept), graph.graph_edges(kept, rec, "pos"))


def records_to_graph(records: DataFrame, *keys: str) -> Graph:
    """Records with a ``triplets`` list to a cleaned graph.

    Records are cleaned in place, so the edge aggregation is the only shuffle.
    """
    kept = triples.explode_triples(cleaning.clean_lists(records.select(*keys, "triplets")), *keys)
    return Graph(graph.graph_nodes(kept), graph.graph_edges(kept, *keys, "pos"))
