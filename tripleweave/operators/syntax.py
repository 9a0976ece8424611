"""Syntax features over tokens.

The parser is the user's (``annotate_tokens``). Its answer stays one array per
record, so dependency strings and triples are array expressions without a
shuffle; ``i`` is the position in that array, whitespace tokens included. The
functions on a token table (one row per token) are for tables that already are
long.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.slices import slices

TOKEN = "struct<i:int,text:string,lemma:string,pos:string,tag:string,dep:string,head_i:int,is_space:boolean>"
TOKENS = f"array<{TOKEN}>"
ARROW_TOKENS = pa.list_(pa.struct([
    ("i", pa.int32()), ("text", pa.string()), ("lemma", pa.string()), ("pos", pa.string()), ("tag", pa.string()),
    ("dep", pa.string()), ("head_i", pa.int32()), ("is_space", pa.bool_()),
]))
#: Bytes of text whose tokens exist at a time in a Python worker, unless a single text is longer.
TEXT_AT_ONCE = 1 << 17
TOKEN_ROWS = "array<struct<text:string,lemma:string,pos:string,tag:string,dep:string,i:int,head_i:int,head_text:string>>"
DEP_ROWS = "array<struct<head_i:int,head_text:string,dep:string,child_i:int,child_text:string>>"


def token_arrays(batches: Iterator[pa.Array], parse: Callable[[str], list[dict]], most: int = TEXT_AT_ONCE) -> Iterator[pa.Array]:
    """Tokens of every text, in arrays for slices of at most ``most`` bytes of text, or one row; so few token dicts exist at a time."""
    for batch in batches:
        for part in slices(batch, pc.binary_length(batch), most):
            yield pa.array([parse(t) if t and t.strip() else [] for t in part.to_pylist()], ARROW_TOKENS)


def annotate_tokens(df: DataFrame, load: Callable[[], Callable[[str], list[dict]]], text: str = "text") -> DataFrame:
    """Add ``tokens`` by a user model; ``load`` runs once per Python worker.

    ``load`` returns a function from a text to token dicts with the fields of
    ``TOKEN``. Blank or missing text gets an empty list without a call. A batch of rows
    is answered in slices, as its tokens take some hundred times the memory of its text.
    """

    @F.arrow_udf(TOKENS)
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from token_arrays(batches, load())

    # asked once per row, even if later steps use the tokens twice
    return df.withColumn("tokens", tokens.asNondeterministic()(F.col(text)))


def model_ladder(names: Sequence[str | None], open_model: Callable[[str], Callable[[str], list[dict]]]) -> Callable[[], Callable[[str], list[dict]]]:
    """Loader of the first model that can be opened; ``open_model`` gets one name after the other, None is passed over.

    The model is opened once in a Python worker and kept there for all its
    tasks, as is the choice. If none can be opened, the last error is raised
    with notes of the earlier ones.
    """
    wanted = tuple(n for n in names if n is not None)
    if not wanted:
        raise ValueError("no model is named")

    def load() -> Callable[[str], list[dict]]:
        kept = sys.__dict__.setdefault("_tripleweave_models", {})  # functions travel by value, a module's own globals would not last
        key = (wanted, open_model.__module__, open_model.__qualname__)
        if key not in kept:
            errors: list[Exception] = []
            for name in wanted:
                try:
                    kept[key] = open_model(name)
                    break
                except Exception as e:
                    errors.append(e)
            else:
                for name, e in zip(wanted, errors[:-1]):
                    errors[-1].add_note(f"{name}: {type(e).__name__}: {e}")
                raise errors[-1]
        return kept[key]

    return load


def whitespace_tagger() -> Callable[[str], list[dict]]:
    """Loader of a deterministic stand-in for a parser.

    Words are separated by single blanks, a newline is a whitespace token, the
    first token is the root, and every other one hangs on the token before it.
    """

    def parse(text: str) -> list[dict]:
        out = []
        for i, word in enumerate(w for w in text.replace("\n", " \n ").split(" ") if w):
            space = word == "\n"
            out.append({
                "i": i, "text": word, "lemma": word, "tag": "SP" if space else "W",
                "pos": "SPACE" if space else "PUNCT" if word in (".", ",") else "WORD",
                "dep": "ROOT" if i == 0 else "space" if space else "dep",
                "head_i": max(i - 1, 0), "is_space": space,
            })
        return out

    return parse


def _visible(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t["is_space"])


def dependency_string(tokens: Column) -> Column:
    """``text(dep)`` of every token, joined by an arrow."""
    return F.array_join(F.transform(_visible(tokens), lambda t: F.concat(t["text"], F.lit("("), t["dep"], F.lit(")"))), " -> ")


def pos_string(tokens: Column) -> Column:
    """``text(pos)`` of every token, joined by a blank."""
    return F.array_join(F.transform(_visible(tokens), lambda t: F.concat(t["text"], F.lit("("), t["pos"], F.lit(")"))), " ")


def _head_text(tokens: Column, t: Column) -> Column:
    return F.get(tokens, t["head_i"])["text"]


def dependency_list(tokens: Column) -> Column:
    """Head, label and child of every token; a whitespace head counts."""
    return F.transform(
        _visible(tokens),
        lambda t: F.struct(
            t["head_i"].alias("head_i"), _head_text(tokens, t).alias("head_text"), t["dep"].alias("dep"),
            t["i"].alias("child_i"), t["text"].alias("child_text"),
        ),
    )


def token_list(tokens: Column) -> Column:
    """Tokens without whitespace, index kept, with the text of the head."""
    return F.transform(
        _visible(tokens),
        lambda t: F.struct(
            *[t[c].alias(c) for c in ("text", "lemma", "pos", "tag", "dep", "i", "head_i")],
            _head_text(tokens, t).alias("head_text"),
        ),
    )


def syntax_column(tokens: Column) -> Column:
    """All features of a record; a record without tokens has empty ones.

    Each field is cast for itself, so that a query of some fields does not make the others.
    """
    t = F.coalesce(tokens, F.array().cast(TOKENS))
    return F.struct(
        token_list(t).cast(TOKEN_ROWS).alias("tokens"), dependency_string(t).alias("dep"), pos_string(t).alias("con_pos"),
        dependency_list(t).cast(DEP_ROWS).alias("dep_triples"),
    )


def analyze_syntax(df: DataFrame, load=whitespace_tagger, text: str = "text") -> DataFrame:
    """Annotate and add the ``syntax`` struct."""
    return annotate_tokens(df, load, text).withColumn("syntax", syntax_column(F.col("tokens"))).drop("tokens")


# --- token table: id, i, text, pos, dep, head_i, is_space ------------------------


def token_dependencies(tokens: DataFrame, key: str = "id") -> DataFrame:
    """Equi self-join of children with their heads; whitespace children are dropped."""
    child = tokens.filter("not is_space").select(key, "head_i", "dep", F.col("i").alias("child_i"), F.col("text").alias("child_text"))
    head = tokens.select(key, F.col("i").alias("head_i"), F.col("text").alias("head_text"))
    return child.join(head, [key, "head_i"]).select(key, "head_i", "head_text", "dep", "child_i", "child_text")


def token_features(tokens: DataFrame, key: str = "id") -> DataFrame:
    """Dependency and part-of-speech strings per record of a token table."""
    dep = F.expr("listagg(concat(text, '(', dep, ')'), ' -> ') within group (order by i)")
    con = F.expr("listagg(concat(text, '(', pos, ')'), ' ') within group (order by i)")
    return tokens.filter("not is_space").groupBy(key).agg(dep.alias("dep"), con.alias("con_pos"))


def features_for(chunks: DataFrame, tokens: DataFrame, key: str = "id") -> DataFrame:
    """Strings for every chunk, empty where it has no token."""
    joined = chunks.join(token_features(tokens, key), key, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in ("dep", "con_pos")})
