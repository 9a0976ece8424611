"""Registered queries: one per operator, each with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions import json as J
from ..functions import relations as R
from ..functions import text as X
from ..operators import (
    chunking, cleaning, edge_store, graph, index, inference, ledger, prompting, stats, stored_index, syntax, tagging, triples,
)
from ..sources.json_arrays import write_json_texts
from ..sources.storage import fresh_folder, stage
from ..sources.tables import read_chunks, read_entities, read_table, read_text_files, read_triplet_records, write_table
from . import flows, stand_ins
from . import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            SQL[key] = sql
        return fn

    return register


def big(name: str) -> F.Column:
    return F.col(name).cast("bigint").alias(name)


# --- sources, cleaning, chunking ---------------------------------------------------


@query("select doc_id, text, source from documents")
def src_documents(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", "text", "source")


@query("""select conv_id as doc_id, string_agg(case when turn % 4 = 3 then '' else text end, chr(10) order by turn) as text
from conversations group by conv_id""")
def assemble_pages(spark, sf):
    pages = read_table(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"), "turn", F.when(F.col("turn") % 4 != 3, F.col("text")).alias("text")
    )
    return chunking.assemble_pages(pages, "doc_id", "turn")


@query("""select doc_id // 100 as part, string_agg(text || chr(10), '' order by doc_id) as text from documents group by 1""")
def src_text_files(spark, sf):
    """Text files of a hundred documents each, written and read whole."""
    path = fresh_folder(spark, "text_files")
    docs = read_table(spark, sf, "documents").select("doc_id", F.expr("doc_id div 100").alias("part"), "text")
    docs.repartition("part").sortWithinPartitions("part", "doc_id").select("part", F.col("text").alias("value")).write.partitionBy("part").text(path)
    files = read_text_files(spark, f"{path}/part=*/*.txt")
    return files.select(F.regexp_extract("source", r"/part=(\d+)/[^/]*$", 1).cast("bigint").alias("part"), "text")


@query("select doc_id as id, source || '.txt' as file, cast(n_chars as bigint) as chunk_index, source, text from documents")
def read_chunk_arrays(spark, sf):
    """Chunk tables as JSON arrays, written one a task and read in blocks."""
    path = fresh_folder(spark, "chunk_arrays")
    docs = read_table(spark, sf, "documents")
    chunks = docs.select(
        F.col("doc_id").alias("id"), F.concat("source", F.lit(".txt")).alias("file"), F.col("n_chars").cast("int").alias("chunk_index"), "source", "text"
    )
    write_table(chunks, path, "json_array")
    return read_chunks(spark, path).select("id", "file", big("chunk_index"), "source", "text")


def _lines(*drop) -> Query:
    return lambda spark, sf: chunking.explode_lines(V.noisy(spark, sf), "doc_id", drop).select(
        "doc_id", big("line_no"), "line"
    )


def _lines_sql(drop: str) -> str:
    return f"with {V.SQL_NOISY}, {V.sql_lines('noisy', drop)} select doc_id, line_no, line from lines"


query(_lines_sql("false"), "clean_lines")(_lines())
query(_lines_sql(V.SQL_NUMBER), "drop_page_number_lines")(_lines(X.is_page_number))
query(_lines_sql(V.SQL_HEADER), "drop_page_header_lines")(_lines(X.is_page_header))
query(_lines_sql(V.SQL_EXTRA_NOISE), "clean_lines_extra")(_lines(*X.EXTRA_NOISE))


@query(f"""with {V.SQL_NOISY}, {V.sql_lines('noisy', V.SQL_PAGE_NOISE)}
select doc_id, string_agg(line, chr(10) order by line_no) as text from lines group by doc_id""")
def clean_text(spark, sf):
    cleaned = V.noisy(spark, sf).select("doc_id", X.clean_text(F.col("text")).alias("text"))
    return cleaned.filter("text <> ''")


@query(f"with {V.SQL_NOISY}, {V.sql_sentences('noisy')} select doc_id, pos, sentence from sents")
def split_sentences(spark, sf):
    return chunking.explode_sentences(V.noisy(spark, sf), "doc_id").select("doc_id", big("pos"), "sentence")


@query(f"""with {V.SQL_NOISY}, {V.sql_sentences('noisy')}
select doc_id, pos, greatest(1, length(sentence) // 2) as tokens from sents""")
def estimate_tokens(spark, sf):
    parts = chunking.explode_sentences(V.noisy(spark, sf), "doc_id")
    return parts.select("doc_id", big("pos"), X.estimate_tokens(F.col("sentence")).cast("bigint").alias("tokens"))


@query(f"""with recursive {V.SQL_NOISY}, {V.sql_chunks('noisy')}
select c.doc_id, n.source, cast(c.chunk_index as bigint) as chunk_index, cast(c.chunk_index as bigint) as id, c.text
from chunks c join noisy n using (doc_id)""")
def chunk_documents(spark, sf):
    return chunking.chunk_documents(V.noisy(spark, sf)).select("doc_id", "source", big("chunk_index"), "id", "text")


_FILE = "source || '/' || doc_id || '.txt'"
_NUMBERED = f"""with recursive {V.SQL_NOISY}, {V.sql_chunks('noisy', extra=True)},
numbered as (
  select row_number() over (order by n.{_FILE.replace("doc_id", "n.doc_id")}, c.chunk_index) as id,
    n.{_FILE.replace("doc_id", "n.doc_id")} as file, cast(c.chunk_index as bigint) as chunk_index, c.text
  from chunks c join noisy n using (doc_id))"""


def _numbered(spark, sf):
    file = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    docs = V.noisy(spark, sf).select(file.alias("file"), "text")
    return chunking.numbered_chunks(docs, "file", extra=True)


@query(_NUMBERED + " select id, file, chunk_index, text from numbered")
def global_chunk_ids(spark, sf):
    return _numbered(spark, sf).select("id", "file", big("chunk_index"), "text")


@query(_NUMBERED + " select id, file, chunk_index, length(text) as len from numbered order by id limit 5")
def chunk_inspect(spark, sf):
    return stats.chunk_inspect(_numbered(spark, sf)).select("id", "file", big("chunk_index"), big("len"))


# --- syntax ------------------------------------------------------------------------

_TOKENS = f"""with {V.SQL_NOISY},
split as (select doc_id, list_filter(string_split(replace(text, chr(10), ' ' || chr(10) || ' '), ' '), lambda w: w <> '') as l
  from noisy),
raw_tokens as (select doc_id, generate_subscripts(l, 1) - 1 as i, unnest(l) as text from split),
tokens as (
  select doc_id, i, text, text = chr(10) as is_space,
    case when text = chr(10) then 'SPACE' when text in ('.', ',') then 'PUNCT' else 'WORD' end as pos,
    case when i = 0 then 'ROOT' when text = chr(10) then 'space' else 'dep' end as dep,
    greatest(i - 1, 0) as head_i
  from raw_tokens)"""


def _annotated(spark, sf):
    return syntax.annotate_tokens(V.noisy(spark, sf).select("doc_id", "text"), syntax.whitespace_tagger)


@query(_TOKENS + " select doc_id, i, text, pos, dep, head_i, is_space from tokens")
def annotate_tokens(spark, sf):
    rows = _annotated(spark, sf).select("doc_id", F.inline("tokens"))
    return rows.select("doc_id", big("i"), "text", "pos", "dep", big("head_i"), "is_space")


_DEPS = _TOKENS + """,
deps as (
  select c.doc_id, c.head_i, h.text as head_text, c.dep, c.i as child_i, c.text as child_text, c.pos
  from tokens c join tokens h on h.doc_id = c.doc_id and h.i = c.head_i where not c.is_space)"""


@query(_TOKENS + " select doc_id, i, text, 'small' as tag, dep, head_i from tokens")
def annotate_tokens_ladder(spark, sf):
    """The first of two models cannot be opened."""
    load = syntax.model_ladder([None, "large", "small"], stand_ins.open_tagger)
    rows = syntax.annotate_tokens(V.noisy(spark, sf).select("doc_id", "text"), load).select("doc_id", F.inline("tokens"))
    return rows.select("doc_id", big("i"), "text", "tag", "dep", big("head_i"))


@query(_DEPS + " select doc_id, child_i as i, child_text as text, pos, dep, head_i, head_text from deps")
def syntax_tokens(spark, sf):
    rows = _annotated(spark, sf).select("doc_id", F.inline(syntax.token_list(F.col("tokens"))))
    return rows.select("doc_id", big("i"), "text", "pos", "dep", big("head_i"), "head_text")


@query(_DEPS + " select doc_id, head_i, head_text, dep, child_i, child_text from deps")
def dependency_triples(spark, sf):
    rows = _annotated(spark, sf).select("doc_id", F.inline(syntax.dependency_list(F.col("tokens"))))
    return rows.select("doc_id", big("head_i"), "head_text", "dep", big("child_i"), "child_text")


@query(_TOKENS + """ select doc_id, string_agg(text || '(' || dep || ')', ' -> ' order by i) as dep,
  string_agg(text || '(' || pos || ')', ' ' order by i) as con_pos from tokens where not is_space group by doc_id""")
def syntax_features(spark, sf):
    return syntax.analyze_syntax(V.noisy(spark, sf).select("doc_id", "text")).select(
        "doc_id", "syntax.dep", "syntax.con_pos"
    )


# --- prompts -----------------------------------------------------------------------

_TAG_MAP = f"""with {V.SQL_CHINESE}, {V.sql_tags('chinese', L.TAG_LEXICON)},
docs as (select c.doc_id, c.text, coalesce(max(case when category = 'Location' then entity end), '') as loc,
  coalesce(max(case when category = 'Land use function' then entity end), '') as use,
  coalesce(max(case when category = 'Direction' then entity end), '') as dir,
  coalesce(max(case when category = 'Concept' then entity end), '') as con,
  coalesce(max(case when category = 'Planned activity' then entity end), '') as act
  from chinese c left join tags using (doc_id) group by c.doc_id, c.text)"""


def _sql_filled(template: str, **values: str) -> str:
    out = V.quoted(template)
    for name, value in values.items():
        out = f"replace({out}, '{{{name}}}', {value})"
    return out


def _sql_list_json(name: str) -> str:
    return f"case when {name} = '' then '[]' else '[\"' || {name} || '\"]' end"


_ENTITIES_JSON = "'{' || " + " || ', ' || ".join(
    f"'\"{c}\": ' || {_sql_list_json(n)}" for c, n in zip(L.CATEGORIES, ["loc", "use", "dir", "con", "act"])
) + " || '}'"
_ENTITIES_FLAT = "array_to_string(list_filter([loc, use, dir, con, act], lambda e: e <> ''), ', ')"


def _tagged(spark, sf):
    return tagging.tag_records(V.chinese(spark, sf).select("doc_id", "text"))


def _example(template: str, given: str, answer: dict) -> str:
    import json

    return template.replace("{input}", given).replace("{output}", json.dumps(answer, ensure_ascii=False))


@query(_TAG_MAP + f""" select doc_id, cast(turn as bigint) as turn, role, content from (
  select doc_id, 0 as turn, 'system' as role, {V.quoted(L.NER_SYSTEM)} as content from docs
  union all select doc_id, 1, 'user', {V.quoted(_example(L.NER_EXAMPLE, L.NER_EXAMPLE_INPUT, L.NER_EXAMPLE_OUTPUT))} from docs
  union all select doc_id, 2, 'user', {_sql_filled(L.NER_USER, text='text')} from docs)""")
def render_ner_messages(spark, sf):
    return prompting.explode_messages(prompting.render_ner(_tagged(spark, sf)), "doc_id").withColumn("turn", big("turn"))


@query(_TAG_MAP + f""" select doc_id, cast(turn as bigint) as turn, role, content from (
  select doc_id, 0 as turn, 'system' as role, {V.quoted(L.NER_HUB_SYSTEM.replace('{hub}', L.HUB))} as content from docs
  union all select doc_id, 1, 'user', {V.quoted(_example(L.NER_HUB_EXAMPLE, L.NER_HUB_EXAMPLE_INPUT, L.NER_HUB_EXAMPLE_OUTPUT))} from docs
  union all select doc_id, 2, 'user', {_sql_filled(L.NER_HUB_USER.replace('{hub}', L.HUB), text='text')} from docs)""")
def render_ner_messages_hub(spark, sf):
    chat = prompting.render_ner(_tagged(spark, sf), "lenient")
    return prompting.explode_messages(chat, "doc_id").withColumn("turn", big("turn"))


@query(_TAG_MAP + f""" select doc_id, cast(turn as bigint) as turn, role, content from (
  select doc_id, 0 as turn, 'system' as role, {V.quoted(L.RE_SYSTEM)} as content from docs
  union all select doc_id, 1, 'user', {_sql_filled(L.RE_USER, text='text', entities=_ENTITIES_JSON)} from docs)""")
def render_re_messages(spark, sf):
    return prompting.explode_messages(prompting.render_re(_tagged(spark, sf)), "doc_id").withColumn("turn", big("turn"))


@query(_TAG_MAP + f""" select doc_id, cast(turn as bigint) as turn, role, content from (
  select doc_id, 0 as turn, 'system' as role, {V.quoted(L.RE_HUB_SYSTEM.replace('{hub}', L.HUB))} as content from docs
    where {_ENTITIES_FLAT} <> ''
  union all select doc_id, 1, 'user', {_sql_filled(L.RE_HUB_USER.replace('{hub}', L.HUB), text='text', entities=_ENTITIES_FLAT)}
    from docs where {_ENTITIES_FLAT} <> '')""")
def render_re_messages_hub(spark, sf):
    chat = prompting.render_re(_tagged(spark, sf), "lenient")
    return prompting.explode_messages(chat, "doc_id").withColumn("turn", big("turn"))


@query(_TOKENS + f""", features as (
  select doc_id, string_agg(text || '(' || dep || ')', ' -> ' order by i) as dep,
    string_agg(text || '(' || pos || ')', ' ' order by i) as con from tokens where not is_space group by doc_id)
select doc_id, {_sql_filled(L.CORE_PROMPT.replace('{concepts}', '城市更新, 交通网络').replace('{format}', L.CORE_FORMAT),
  text='n.text', dep="coalesce(f.dep, '')", con="coalesce(f.con, '')")} as content
from noisy n left join features f using (doc_id)""")
def render_core_prompt(spark, sf):
    docs = syntax.analyze_syntax(V.noisy(spark, sf).select("doc_id", "text"))
    prompts = prompting.render_core(docs, ["城市更新", "交通网络"])
    return prompts.select("doc_id", F.get("messages", F.lit(0))["content"].alias("content"))


# --- inference -----------------------------------------------------------------------


@query(f"with {V.SQL_NOISY}, {V.sql_sentences('noisy')} select doc_id, pos from sents where length(sentence) >= 5")
def prefilter_short_text(spark, sf):
    parts = chunking.explode_sentences(V.noisy(spark, sf), "doc_id")
    return inference.prefilter_short_text(parts, "sentence").select("doc_id", big("pos"))


@query(f"""with {V.SQL_CHINESE}, {V.sql_tags('chinese', L.TAG_LEXICON)} select distinct doc_id from tags""")
def prefilter_has_entities(spark, sf):
    return inference.prefilter_has_entities(_tagged(spark, sf)).select("doc_id")


@query(_TAG_MAP + f""" select doc_id, case when contains(text, '今天') then null
    else '{{"chars": ' || length({_sql_filled(L.NER_USER, text='text')}) || '}}' end as response,
  case when contains(text, '今天') then 'no answer' end as failure from docs""")
def infer_stub(spark, sf):
    chat = prompting.render_ner(V.chinese(spark, sf).select("doc_id", "text"))
    answers = inference.infer(chat, stand_ins.counting_model, tries=2, wait=0.0, on_error="record")
    return answers.select("doc_id", "response", "failure")


@query(_TAG_MAP + f""" select doc_id, '{{"chars": ' || length({_sql_filled(L.NER_USER, text='text')}) || '}}' as response,
  cast(null as varchar) as failure, cast(case when contains(text, '今天') then 2 else 1 end as bigint) as tries from docs""")
def infer_ledger(spark, sf):
    """A first run whose model fails on some texts, and a second one that asks for these only."""
    answers = ledger.Ledger(spark, fresh_folder(spark, "ledger"))
    chat = prompting.render_ner(V.chinese(spark, sf).select("doc_id", "text"))
    ledger.ask(chat, answers, stand_ins.counting_model, tries=1, wait=0.0, on_error="record", at_once=4)
    asked = ledger.ask(chat, answers, stand_ins.patient_model, tries=1, wait=0.0, on_error="record", at_once=4)
    keyed = asked.withColumn("key", ledger.request_key())
    return keyed.join(answers.read().select("key", "tries"), "key").select("doc_id", "response", "failure", "tries")


# --- parsing -------------------------------------------------------------------------


@query(f"""with {V.SQL_RESPONSES}
select rec, regexp_replace(regexp_replace(response, '(?m)^```json', '', 'g'), '(?m)^```', '', 'g') as text from responses""")
def strip_code_fences(spark, sf):
    return V.responses(spark, sf).select("rec", J.strip_code_fences(F.col("response")).alias("text"))


def _ladder(*steps: str) -> str:
    tries = " ".join(f"when json_valid({s}) then {s}" for s in steps)
    return f"case {tries} end"


_TRIMMED = "trim(response, ' ' || chr(10))"
_UNFENCED = f"regexp_replace(regexp_replace({_TRIMMED}, '(?m)^```json', '', 'g'), '(?m)^```', '', 'g')"
_OBJECT_END = "regexp_extract(s, '(?s)\\{.*\\}$')"
_OBJECT_ANY = "regexp_extract(s, '(?s)\\{.*\\}')"
_OBJECT_FIRST = "regexp_extract(s, '(?s)\\{.*?\\}')"
_NESTED_END = "regexp_extract(s, '(?s)\\[\\s*\\[.*\\]\\s*\\]$')"
_NESTED = "regexp_extract(s, '(?s)\\[\\s*\\[.*\\]\\s*\\]')"
_FLAT = "regexp_extract(s, '(?s)\\[.*\\]')"
_ENTITY_ROWS = """,
fields as (select rec, unnest(json_keys(j)) as category, j from parsed where json_type(j) = 'OBJECT'),
names as (select rec, category, unnest(from_json(json_extract(j, '$."' || category || '"'), '["VARCHAR"]')) as entity from fields)"""


def _entity_rows(parsed):
    rows = parsed.select("rec", "error", "raw", F.explode_outer("entities").alias("category", "names"))
    return rows.select("rec", "category", F.explode_outer("names").alias("entity"), F.col("error").isNotNull().alias("failed"), "raw")


@query(f"""with {V.SQL_RESPONSES},
parsed as (select rec, response, {_ladder('s', _OBJECT_END, _NESTED_END, _OBJECT_FIRST)} as j
  from (select rec, response, {_TRIMMED} as s from responses)){_ENTITY_ROWS}
select p.rec, f.category, n.entity, p.j is null as failed, case when p.j is null then response end as raw
from parsed p left join fields f on f.rec = p.rec left join names n on n.rec = f.rec and n.category = f.category""")
def parse_entities_strict(spark, sf):
    return _entity_rows(inference.parse_entities(V.responses(spark, sf), "strict"))


_LENIENT_ENTITIES = f"""with {V.SQL_RESPONSES},
parsed as (select rec, response, coalesce({_ladder('s', _OBJECT_ANY)}, '{{}}') as j
  from (select rec, response, {_UNFENCED} as s from responses)){_ENTITY_ROWS}"""


@query(_LENIENT_ENTITIES + """ select rec, category, entity from names""")
def parse_entities_lenient(spark, sf):
    parsed = inference.parse_entities(V.responses(spark, sf), "lenient")
    return parsed.select("rec", F.explode("entities").alias("category", "names")).select(
        "rec", "category", F.explode("names").alias("entity")
    )


@query(_LENIENT_ENTITIES + f""" select rec, category, cast(n as bigint) as n from (
  select rec, unnest({V.sql_list(L.CATEGORIES)}) as category, 0 as n from parsed where j = '{{}}' or json_type(j) <> 'OBJECT'
  union all select f.rec, f.category, count(n.entity) from fields f left join names n on n.rec = f.rec and n.category = f.category
  group by f.rec, f.category)""")
def default_entities(spark, sf):
    parsed = inference.parse_entities(V.responses(spark, sf), "lenient")
    rows = parsed.select("rec", F.explode("entities").alias("category", "names"))
    return rows.select("rec", "category", F.size("names").cast("bigint").alias("n"))


_TRIPLE_ROWS = """,
lists as (select rec, case when json_type(j) = 'ARRAY' then from_json(j, '["JSON"]') else [] end as l from parsed),
items as (select rec, generate_subscripts(l, 1) - 1 as pos, unnest(l) as item from lists),
good as (select rec, pos, item->>'$[0]' as head, item->>'$[1]' as rel, item->>'$[2]' as tail from items
  where json_type(item) = 'ARRAY' and json_array_length(item) >= 3)
select p.rec, g.pos, g.head, g.rel, g.tail, p.j is null as failed
from parsed p left join good g on g.rec = p.rec"""


def _triple_rows(parsed):
    good = F.filter(J.triple_items(F.col("triplets")), lambda t: t["ok"])
    rows = parsed.select("rec", "error", F.explode_outer(good).alias("t"))
    return rows.select(
        "rec", F.col("t.pos").cast("bigint").alias("pos"), "t.head", "t.rel", "t.tail",
        F.col("error").isNotNull().alias("failed"),
    )


@query(f"""with {V.SQL_RESPONSES},
parsed as (select rec, {_ladder('s', _NESTED)} as j from (select rec, {_TRIMMED} as s from responses)){_TRIPLE_ROWS}""")
def parse_triplets_strict(spark, sf):
    return _triple_rows(inference.parse_triplets(V.responses(spark, sf), "strict"))


@query(f"""with {V.SQL_RESPONSES},
laddered as (select rec, s, {_ladder('s', _NESTED)} as j, {_FLAT} as flat from (select rec, {_UNFENCED} as s from responses)),
parsed as (select rec, case when j is not null then j when not json_valid(flat) then '[]'
  when json_array_length(flat) > 0 and json_type(flat, '$[0]') <> 'ARRAY' then '[' || flat || ']' else flat end as j
  from laddered){_TRIPLE_ROWS}""")
def parse_triplets_lenient(spark, sf):
    return _triple_rows(inference.parse_triplets(V.responses(spark, sf), "lenient"))


# --- tagging and rules -----------------------------------------------------------------

_LATIN = f"with {V.sql_tags('documents', V.LATIN_LEXICON)}"


@query(_LATIN + " select doc_id, category, entity from tags")
def tag_entities(spark, sf):
    return tagging.tag_entities(V.documents(spark, sf), "doc_id", lexicon=V.LATIN_LEXICON)


@query(_LATIN + " select doc_id, category, entity from tags")
def tag_entities_join(spark, sf):
    return tagging.tag_by_join(
        V.documents(spark, sf), tagging.lexicon_table(spark, V.LATIN_LEXICON), "doc_id"
    )


@query(f"with {V.SQL_CHINESE}, {V.sql_tags('chinese', L.TAG_LEXICON)} select doc_id, category, entity from tags")
def tag_entities_cjk(spark, sf):
    return tagging.tag_entities(V.chinese(spark, sf), "doc_id")


@query(_LATIN + " select doc_id, category, entity from tags")
def read_entity_arrays(spark, sf):
    """Entity tables as JSON arrays, read in blocks."""
    path = fresh_folder(spark, "entity_arrays")
    records = tagging.tag_records(V.documents(spark, sf).select(F.col("doc_id").alias("id"), "text"), V.LATIN_LEXICON)
    write_table(records, path, "json_array")
    return tagging.explode_entities(read_entities(spark, path), "id").select(F.col("id").alias("doc_id"), "category", "entity")


@query(_LATIN + " select category, count(*) as n from tags group by category")
def entity_type_counts(spark, sf):
    return stats.entity_type_counts(tag_entities(spark, sf))


def _latin_records(spark, sf):
    return tagging.tag_records(V.documents(spark, sf).select("doc_id", "text"), V.LATIN_LEXICON)


def _rule(triples_of) -> Query:
    def run(spark, sf):
        made = _latin_records(spark, sf).select("doc_id", triples_of(F.col("entities")).alias("triplets"))
        return triples.explode_triples(made, "doc_id").withColumn("pos", big("pos"))

    return run


def _rule_sql(cte: str) -> str:
    return f"""{_LATIN}, {V.SQL_RULES}
select doc_id, row_number() over (partition by doc_id order by i, j) - 1 as pos, head, rel, tail from {cte}"""


query(_rule_sql("placed"), "gen_location_activity")(_rule(triples.location_activity))
query(_rule_sql("used"), "gen_function_concept")(_rule(triples.function_concept))
query(_rule_sql("acted"), "gen_activity")(_rule(triples.activity))

_CHINESE_TRIPLES = f"with {V.SQL_CHINESE}, {V.sql_tags('chinese', L.TAG_LEXICON)}, {V.sql_triples('chinese')}"


def _rule_records(spark, sf):
    return triples.generate_triples(_tagged(spark, sf))


@query(_CHINESE_TRIPLES + " select doc_id, pos, head, rel, tail from triples where head = '演示'")
def gen_placeholder(spark, sf):
    rows = triples.explode_triples(_rule_records(spark, sf), "doc_id")
    return rows.filter(F.col("head") == L.PLACEHOLDER_TRIPLE[0]).withColumn("pos", big("pos"))


@query(f"{_LATIN}, {V.sql_triples('documents')} select doc_id, pos, head, rel, tail from triples", "generate_triplets")
def generate_triplets(spark, sf):
    rows = triples.explode_triples(triples.generate_triples(_latin_records(spark, sf)), "doc_id")
    return rows.withColumn("pos", big("pos"))


@query(f"""with {V.SQL_CANDIDATES}
select rec, bool_or(coalesce(contains(head, 'ring'), false) or coalesce(contains(tail, 'ring'), false)) as linked from cand group by rec""")
def hub_linked_records(spark, sf):
    return triples.hub_linked(V.candidates(spark, sf), "ring")


@query(f"""{_LATIN}, {V.sql_triples('documents')},
linked as (select distinct doc_id from triples where contains(head, '{V.HUB}') or contains(tail, '{V.HUB}')),
firsts as (select doc_id, arg_min(entity, case when category = 'Concept' then rank else 100 + rank end) as head
  from tags where category in ('Concept', 'Location') group by doc_id)
select doc_id, pos, head, rel, tail from triples
union all
select doc_id, (select count(*) from triples t where t.doc_id = f.doc_id), head, '{L.HUB_RELATION}', '{V.HUB}'
from firsts f where doc_id not in (select doc_id from linked)""")
def hub_repair(spark, sf):
    linked = triples.link_hub(triples.generate_triples(_latin_records(spark, sf)), V.HUB)
    return triples.explode_triples(linked, "doc_id").withColumn("pos", big("pos"))


@query("""with noted as (
  select doc_id as id, 0 as rec, 'quality ' || quality as name from labels
  union all select doc_id, 1, 'toxic ' || toxic from labels where quality = 0),
last as (select id, arg_max(name, rec) as name from noted group by id)
select d.doc_id as id, case when name is null then null else 'Concept' end as category, name as entity
from documents d left join last on last.id = d.doc_id""")
def attach_entities(spark, sf):
    labels = read_table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    named = lambda rec, name: F.struct(
        F.lit(rec).alias("rec"), F.create_map(F.lit("Concept"), F.array(name)).alias("entities")
    )
    good = named(0, F.concat(F.lit("quality "), F.col("quality").cast("string")))
    bad = F.when(F.col("quality") == 0, named(1, F.concat(F.lit("toxic "), F.col("toxic").cast("string"))))
    noted = labels.select("id", F.inline(F.array_compact(F.array(good, bad))))
    records = read_table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    rows = triples.attach_entities(records, noted).select("id", F.explode_outer("entities").alias("category", "names"))
    return rows.select("id", "category", F.explode_outer("names").alias("entity"))


# --- cleaning ----------------------------------------------------------------------------


@query(f"with {V.SQL_ITEMS} select rec, pos, head, rel, tail from parted")
def explode_triplets(spark, sf):
    return cleaning.explode_items(V.records_json(spark, sf), "rec").withColumn("pos", big("pos"))


@query(f"with {V.SQL_ITEMS} select rec as id, pos, head, rel, tail from parted")
def read_triplet_arrays(spark, sf):
    """Triplet tables, lists and error objects mixed, as JSON arrays, read in blocks."""
    path = fresh_folder(spark, "triplet_arrays")
    texts = F.format_string('{"id": %d, "text": "a {\\"b\\"},{ c", "triplets": %s}', "rec", "raw")
    write_json_texts(V.records_json(spark, sf).select(texts.alias("value")), path)
    return cleaning.explode_items(read_triplet_records(spark, path), "id").withColumn("pos", big("pos"))


@query(f"""with {V.SQL_RECORDS} select rec, raw->>'$.error' as error from records
where json_type(raw) = 'OBJECT' and json_exists(raw, '$.error')""")
def clean_parse_errors(spark, sf):
    return cleaning.parse_errors(V.records_json(spark, sf), "rec")


@query(f"""with {V.SQL_CANDIDATES}, vals as (select head as value from cand union all select tail from cand where tail is not null),
trimmed as (select value, {V.sql_strip('value')} as v from vals)
select value, count(*) as n, bool_and({V.SQL_VALID.format('v')}) as valid from trimmed group by value""")
def valid_entity(spark, sf):
    values = V.candidates(spark, sf).select(F.explode(F.array("head", "tail")).alias("value")).filter("value is not null")
    counted = values.groupBy("value").agg(F.count("*").alias("n"))
    return counted.withColumn("valid", R.valid_entity(F.col("value")))


@query(f"with {V.SQL_CLEAN_CANDIDATES} select rec, pos, rel from cand where {V.sql_keyword('rel')}")
def relation_keywords_join(spark, sf):
    """Relations that hold one of the keywords of a table."""
    words = spark.range(1).select(F.explode(F.array(*map(F.lit, L.RELATION_KEYWORDS))).alias("keyword"))
    return tagging.relations_with_keyword(V.candidates(spark, sf), words).select("rec", "pos", "rel")


@query(f"""with {V.SQL_CANDIDATES}, raw as (select rec, pos, ' ' || rel || chr(12288) as rel from cand),
trimmed as (select rec, pos, rel, {V.sql_strip('rel')} as r from raw)
select rec, pos, rel, {V.SQL_NORM} as rel_norm from trimmed""")
def normalize_relation(spark, sf):
    rows = V.candidates(spark, sf).withColumn("rel", F.concat(F.lit(" "), "rel", F.lit("　")))
    return rows.select("rec", "pos", "rel", R.normalize_relation(F.col("rel")).alias("rel_norm"))


_SANITIZE = """(case when regexp_matches(s, '^[A-Za-z]') then upper(s) else upper('R_' || s) end)"""


def _sanitized(expr: str) -> str:
    return f"""(select rec, pos, head, rel, tail, case when s = '' then 'REL' else s end as s from (
  select *, trim(regexp_replace({expr}, '[^\\p{{L}}\\p{{N}}_]+', '_', 'g'), '_') as s from graph_rows))"""


_GRAPH_ROWS = f"""with {V.SQL_CANDIDATES},
graph_rows as (select rec, pos, supp, head, case (pos // 4000000000000) % 3 when 0 then rel || '-' when 1 then rel else '--' end as rel, tail from cand)"""


def _graph_rows(spark, sf):
    """Candidates with relations of which several give one type."""
    kind = F.expr("pos div 4000000000000") % 3
    rel = F.when(kind == 0, F.concat("rel", F.lit("-"))).when(kind == 1, F.col("rel")).otherwise("--")
    return V.candidates(spark, sf).withColumn("rel", rel)


@query(_GRAPH_ROWS + f" select rec, pos, rel, {_SANITIZE} as rel_type from {_sanitized('rel')}")
def sanitize_relation(spark, sf):
    rows = _graph_rows(spark, sf)
    return rows.select("rec", "pos", "rel", R.sanitize_relation(F.col("rel")).alias("rel_type"))


@query(f"with {V.SQL_CLEAN_CANDIDATES} select rec, pos, h as head, rn as rel_norm, t as tail, reason from judged")
def clean_reasons(spark, sf):
    rows = cleaning.classify(V.candidates(spark, sf))
    return rows.select("rec", "pos", "head", "rel_norm", "tail", "reason")


@query(f"with {V.SQL_CLEAN_CANDIDATES} select rec, pos, head, rel, tail from kept")
def clean_dedup(spark, sf):
    return cleaning.clean_triples(V.candidates(spark, sf))


_CLEAN_RECORDS = f"with {V.SQL_ITEMS},\n" + V.sql_judged("parted")


@query(_CLEAN_RECORDS + """ select rec, cast(count(k.rec) as bigint) as n,
  coalesce(string_agg(head || '|' || rel || '|' || tail, ';' order by pos), '') as triplets
from records left join kept k using (rec) group by rec""")
def clean_records(spark, sf):
    cleaned = cleaning.clean_records(V.records_json(spark, sf).select("rec", "triplets"))
    shown = F.transform("triplets", lambda t: F.concat_ws("|", t["head"], t["rel"], t["tail"]))
    return cleaned.select("rec", F.size("triplets").cast("bigint").alias("n"), F.array_join(shown, ";").alias("triplets"))


_RECORD_REMOVED = _CLEAN_RECORDS + """, removed as (
  select coalesce(reason, 'dup') as reason, count(*) as n from judged where reason is not null or nth > 1 group by 1
  union all select 'llm_parse_error', count(*) from records where json_type(raw) = 'OBJECT')"""


@query(_RECORD_REMOVED + " select reason, n from removed")
def clean_records_removed(spark, sf):
    cleaned = cleaning.clean_records(V.records_json(spark, sf).select("rec", "triplets"))
    return cleaning.removed_totals(cleaned)


@query(f"""with {V.SQL_CLEAN_CANDIDATES},
removed as (
  select coalesce(reason, 'dup') as reason, count(*) as n,
    min(case when reason is null then {{'r': rec, 's': 2, 'p': pos}} else {{'r': rec, 's': 1, 'p': pos}} end) as first
  from judged where reason is not null or nth > 1 group by 1)
select reason, n, row_number() over (order by n desc, first) as rank from removed""")
def clean_reason_counts(spark, sf):
    return cleaning.reason_counts(V.candidates(spark, sf)).withColumn("rank", big("rank"))


@query(f"""with {V.SQL_CLEAN_CANDIDATES} select count(*) as before, count(*) filter (reason is null and nth = 1) as after from judged""")
def clean_totals(spark, sf):
    return cleaning.clean_totals(V.candidates(spark, sf))


# --- index -----------------------------------------------------------------------------

_POSTINGS = f"""with {V.SQL_CLEAN_CANDIDATES},
posted as (
  select {V.sql_strip('head')} as entity, rec, pos, 0 as role, head, rel, tail from kept
  union all select {V.sql_strip('tail')}, rec, pos, 1, head, rel, tail from kept)"""


def _posted(spark, sf):
    return index.postings(cleaning.clean_triples(V.candidates(spark, sf)), "rec")


def _posting_columns(rows):
    return rows.select("entity", "rec", "pos", big("role"), "head", "rel", "tail")


@query(_POSTINGS + " select entity, rec, pos, cast(role as bigint) as role, head, rel, tail from posted where entity <> ''")
def index_postings(spark, sf):
    return _posting_columns(_posted(spark, sf))


def _blocks(most: int, rec: str = "rec") -> str:
    return _POSTINGS + f""", ranked as (
  select *, (row_number() over (partition by entity order by {rec}, pos, role, head, rel, tail) - 1) // {most} as block
  from posted where entity <> '')
select entity, block, count(*) as n,
  string_agg({rec} || ':' || pos || ':' || role || ':' || head || '|' || rel || '|' || tail, ';' order by {rec}, pos, role, head, rel, tail)
    as postings
from ranked group by 1, 2"""


def _shown_blocks(blocks):
    shown = F.transform("postings", lambda p: F.concat_ws(
        ":", p["rec"].cast("string"), p["pos"].cast("string"), p["role"].cast("string"), F.concat_ws("|", p["head"], p["rel"], p["tail"])))
    return blocks.select("entity", "block", big("n"), F.array_join(shown, ";").alias("postings"))


@query(_blocks(100))
def inverted_index(spark, sf):
    return _shown_blocks(index.inverted_index(_posted(spark, sf), "rec", most=100))


@query(_blocks(100, "('order ' || rec)"))
def inverted_index_by_name(spark, sf):
    named = _posted(spark, sf).withColumn("rec", F.concat(F.lit("order "), F.col("rec").cast("string")))
    return _shown_blocks(index.inverted_index(named, "rec", most=100))


@query(_POSTINGS + """ select entity, rec, pos, cast(role as bigint) as role, head, rel, tail, o_orderpriority as text
from posted join orders on o_orderkey = rec where entity <> ''""")
def index_with_text(spark, sf):
    records = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("rec"), F.col("o_orderpriority").alias("text"))
    rows = index.with_text(_posted(spark, sf), records, "rec")
    return rows.select("entity", "rec", "pos", big("role"), "head", "rel", "tail", "text")


@query(_POSTINGS + """ select entity, rec, pos, cast(role as bigint) as role, head, rel, tail
from posted where entity = 'Supplier#000000007'""")
def index_lookup(spark, sf):
    return _posting_columns(index.lookup(_posted(spark, sf), "Supplier#000000007"))


@query(f"""with {V.SQL_SENTENCE_TRIPLES},
posted as (select {V.sql_strip('head')} as entity, rec, pos, 0 as role, head, rel, tail from said
  union all select {V.sql_strip('tail')}, rec, pos, 1, head, rel, tail from said)
select entity, rec, pos, cast(role as bigint) as role, head, rel, tail, true as pruned from posted where entity in ('The', 'Die', 'la')""")
def index_stored_lookup(spark, sf):
    """An index on disk of a main part and three deltas, all merged but one; ``pruned``: not all files were opened."""
    wanted = ["The", "Die", "la"]
    posted = stage(index.postings(V.sentence_triples(spark, sf), "rec"), "postings")
    stored = stored_index.StoredIndex(spark, fresh_folder(spark, "index"), "rec", "pos", "role")
    for k in range(4):
        stored.add(posted.where(F.col("rec") % 16 >= 3) if k == 0 else posted.where(F.col("rec") % 16 == k - 1), f"batch{k}", files=16 if k == 0 else 4, stored=True)
    stored.merge(fanout=3)
    stored.add(posted, "batch1")  # is there already
    opened, files = stored.files_read(wanted)
    return _posting_columns(stored.lookup(wanted)).withColumn("pruned", F.lit(opened < files))


# --- graph -----------------------------------------------------------------------------

_EDGES = _GRAPH_ROWS + f""",
typed as (select rec, pos, head, rel, tail, {_SANITIZE} as rel_type from {_sanitized('rel')} where tail is not null),
edges as (select head, rel_type, tail, arg_max(rel, {{'r': rec, 'p': pos, 'n': rel}}) as rel_name, count(*) as support
  from typed group by head, rel_type, tail)"""


def _edges(spark, sf):
    return graph.graph_edges(_graph_rows(spark, sf), "rec", "pos")


@query(_GRAPH_ROWS + """ select head as name from graph_rows where tail is not null
union select tail from graph_rows where tail is not null""")
def graph_nodes(spark, sf):
    return graph.graph_nodes(_graph_rows(spark, sf))


@query(_EDGES + " select head, rel_type, tail, rel_name, support from edges")
def graph_edges(spark, sf):
    return _edges(spark, sf)


@query(_EDGES + """, halves as (
  select head, rel_type, tail, rec % 2 as batch, arg_max(rel, {'r': rec, 'p': pos, 'n': rel}) as rel_name
  from typed group by 1, 2, 3, 4)
select head, rel_type, tail, arg_max(rel_name, batch) as rel_name from halves group by 1, 2, 3""")
def graph_merge_incremental(spark, sf):
    rows = _graph_rows(spark, sf)
    first, second = (graph.graph_edges(rows.filter(F.col("rec") % 2 == b), "rec", "pos") for b in (0, 1))
    return graph.merge_edges(first, second)


@query(f"with {V.SQL_SENTENCE_TRIPLES}, graph_rows as (select * from said)," + f"""
typed as (select rec, pos, head, rel, tail, {_SANITIZE} as rel_type from {_sanitized('rel')}),
batches as (
  select 1 as batch, * from typed where rec % 2 = 0 union all select 2, * from typed where rec % 2 = 1
  union all select 3, * from typed where rec % 3 = 0),
per_batch as (select head, rel_type, tail, batch, arg_max(rel, {{'r': rec, 'p': pos, 'n': rel}}) as rel_name from batches group by 1, 2, 3, 4)
select head, rel_type, tail, arg_max(rel_name, batch) as rel_name from per_batch group by 1, 2, 3""")
def graph_store_imports(spark, sf):
    """A graph on disk: a batch, the same one again, a second and a third import, merged in between."""
    rows = stage(V.sentence_triples(spark, sf), "graph_rows")
    store = edge_store.EdgeStore(spark, fresh_folder(spark, "graph"))
    first = rows.where(F.col("rec") % 2 == 0)
    store.import_batch(first, "first", "rec", "pos")
    store.import_batch(first, "first", "rec", "pos")
    store.import_batch(rows.where(F.col("rec") % 2 == 1), "second", "rec", "pos")
    store.compact(fanout=2)
    store.import_batch(rows.where(F.col("rec") % 3 == 0), "third", "rec", "pos")
    return store.edges()


@query(_GRAPH_ROWS + """, ends as (
  select distinct supp % 2 as batch, unnest([head, tail]) as name from graph_rows where tail is not null)
select name from ends where batch = 1 and name not in (select name from ends where batch = 0)""")
def graph_new_nodes(spark, sf):
    rows = _graph_rows(spark, sf)
    first, second = (graph.graph_nodes(rows.filter(F.col("supp") % 2 == b)) for b in (0, 1))
    return graph.new_nodes(first, second)


@query(_EDGES + """ select 'edges' as what, count(*) as n from edges
union all select 'nodes', count(distinct name) from (select unnest([head, tail]) as name from edges)""")
def graph_counts(spark, sf):
    return graph.graph_counts(_edges(spark, sf))


@query(_GRAPH_ROWS + """, names as (
  select head as name from graph_rows where tail is not null union select tail from graph_rows where tail is not null)
select distinct left(name, 1) as label from names order by label limit 10""")
def graph_labels(spark, sf):
    nodes = graph.graph_nodes(_graph_rows(spark, sf))
    return graph.graph_labels(graph.labelled(nodes, F.substring("name", 1, 1)))


@query(_EDGES + " select head, rel_type, tail, rel_name, support from edges order by head, rel_type, tail limit 5")
def graph_sample(spark, sf):
    return graph.graph_sample(_edges(spark, sf))


@query(f"with {V.SQL_ITEMS} select cast(sum(len(l)) as bigint) as total from lists")
def import_total(spark, sf):
    return graph.import_total(V.records_json(spark, sf))


# --- statistics ---------------------------------------------------------------------------


@query(f"with {V.SQL_ITEMS} select count(*) as records, cast(sum(len(l)) as bigint) as triplets from lists")
def triplet_stats(spark, sf):
    return stats.triplet_stats(V.records_json(spark, sf), J.variant_items(F.col("triplets")))


@query(f"""with {V.SQL_CANDIDATES}
select rel, n from (select rel, count(*) as n, min({{'r': rec, 'p': pos}}) as first from cand group by rel) order by n desc, first limit 10""")
def top_relations(spark, sf):
    return stats.top_relations(V.candidates(spark, sf), "rec", "pos")


@query(f"""with {V.SQL_ITEMS}, seconds as (
  select rec, pos, case json_type(item, '$[1]') when 'NULL' then 'None'
    when 'BOOLEAN' then upper(left(item->>'$[1]', 1)) || substr(item->>'$[1]', 2) else item->>'$[1]' end as rel
  from items where json_type(item) = 'ARRAY' and json_array_length(item) >= 2)
select rel, n from (select rel, count(*) as n, min({{'r': rec, 'p': pos}}) as first from seconds group by rel) order by n desc, first limit 10""")
def top_relations_items(spark, sf):
    return stats.top_relations(stats.relation_list(V.records_json(spark, sf), "rec"), "rec", "pos")


@query(f"""with {V.SQL_CHINESE}, {V.sql_tags('chinese', L.TAG_LEXICON)}, {V.sql_triples('chinese')}
select c.doc_id, left(replace(c.text, chr(10), ' '), 200) as preview, count(t.pos) as n,
  string_agg(head || '|' || rel || '|' || tail, ';' order by pos) filter (pos < 10) as triplets
from chinese c left join triples t using (doc_id) group by c.doc_id, c.text order by c.doc_id limit 5""")
def triplet_preview(spark, sf):
    rows = stats.triplet_preview(_rule_records(spark, sf), "doc_id", F.col("triplets"))
    shown = F.transform("triplets", lambda t: F.concat_ws("|", t["head"], t["rel"], t["tail"]))
    return rows.select("doc_id", "preview", big("n"), F.array_join(shown, ";").alias("triplets"))


@query(f"""with recursive {V.SQL_CHINESE}, {V.sql_chunks('chinese')}, keyed as (
  select {{'d': doc_id, 'c': chunk_index}} as doc_id, text from chunks),
{V.sql_tags('keyed', L.TAG_LEXICON)}, {V.sql_triples('keyed')}
select (select count(*) from keyed) as chunks, count(*) as triplets,
  (select left(text, 100) from keyed order by doc_id limit 1) as preview,
  (select coalesce(string_agg(category || ':' || entity, ';' order by rank), '') from tags where doc_id = (select min(doc_id) from keyed)) as entities,
  (select coalesce(string_agg(head || '|' || rel || '|' || tail, ';' order by pos), '') from triples
    where pos < 5 and doc_id = (select min(doc_id) from keyed)) as first
from triples""")
def run_summary(spark, sf):
    one = stats.run_summary(flows.rule_records(V.chinese(spark, sf), "doc_id"), "doc_id", "chunk_index")
    by_type = F.flatten(F.transform(F.map_entries("entities"), lambda e: F.transform(e["value"], lambda v: F.concat_ws(":", e["key"], v))))
    triples_ = F.transform("first", lambda t: F.concat_ws("|", t["head"], t["rel"], t["tail"]))
    return one.select("chunks", "triplets", "preview", F.array_join(by_type, ";").alias("entities"), F.array_join(triples_, ";").alias("first"))


# --- composed -----------------------------------------------------------------------------


@query(f"""with recursive {V.SQL_CHINESE}, {V.sql_chunks('chinese')}, keyed as (
  select {{'d': doc_id, 'c': chunk_index}} as doc_id, text from chunks),
{V.sql_tags('keyed', L.TAG_LEXICON)}, {V.sql_triples('keyed')},
posted as (select {V.sql_strip('head')} as entity, doc_id, pos, 0 as role, head, rel, tail from triples
  union all select {V.sql_strip('tail')}, doc_id, pos, 1, head, rel, tail from triples)
select entity, doc_id.d as doc_id, cast(doc_id.c as bigint) as chunk_index, pos, cast(role as bigint) as role, head, rel, tail
from posted where entity <> ''""")
def rules_to_index(spark, sf):
    rows = flows.rules_to_index(V.chinese(spark, sf), "doc_id")
    return rows.select("entity", "doc_id", big("chunk_index"), big("pos"), big("role"), "head", "rel", "tail")


@query(f"""with recursive {V.SQL_CHINESE}, {V.sql_chunks('chinese')},
words as (select doc_id, chunk_index, list_filter(string_split(replace(text, chr(10), ' ' || chr(10) || ' '), ' '), lambda w: w <> '') as l from chunks),
tokens as (select doc_id, chunk_index, generate_subscripts(l, 1) as i, unnest(l) as text from words)
select doc_id, cast(chunk_index as bigint) as chunk_index,
  string_agg(text || case when i = 1 then '(ROOT)' else '(dep)' end, ' -> ' order by i) as dep,
  string_agg(text || case when text in ('.', ',') then '(PUNCT)' else '(WORD)' end, ' ' order by i) as con_pos
from tokens where text <> chr(10) group by 1, 2""")
def rules_with_syntax(spark, sf):
    """Records of the rules with the syntax of their chunk."""
    records = flows.rule_records(V.chinese(spark, sf), "doc_id", parser=syntax.whitespace_tagger)
    return records.select("doc_id", big("chunk_index"), "syntax.dep", "syntax.con_pos")


@query(f"""with recursive {V.SQL_CHINESE}, {V.sql_chunks('chinese')},
asked as (select doc_id, cast(chunk_index as bigint) as chunk_index,
  case when contains(text, '城市北部') then 'good' when contains(text, '建筑设计') then 'bad' when contains(text, '发展目标') then 'fail'
    else 'none' end as kind from chunks)
select doc_id, chunk_index,
  case kind when 'good' then '政府' end as head, case kind when 'good' then '推进' end as rel, case kind when 'good' then '建设' end as tail,
  kind in ('bad', 'fail') as failed from asked""")
def model_to_triplets(spark, sf):
    records = flows.model_records(
        V.chinese(spark, sf), "doc_id", ner=stand_ins.entity_model, extract=stand_ins.triple_model, tries=2, wait=0.0
    )
    good = cleaning.valid_items(F.col("triplets"))
    rows = records.select("doc_id", big("chunk_index"), F.col("error").isNotNull().alias("failed"), F.explode_outer(good).alias("t"))
    return rows.select("doc_id", "chunk_index", "t.head", "t.rel", "t.tail", "failed")


@query(f"""with recursive {V.SQL_CHINESE}, {V.sql_chunks('chinese')},
asked as (select doc_id, cast(chunk_index as bigint) as chunk_index, contains(text, '城市北部') as good from chunks where length(text) >= 5)
select doc_id, chunk_index, '政府' as head, '推进' as rel, '建设' as tail from asked where good
union all select doc_id, chunk_index, 'x', '{L.HUB_RELATION}', '{L.HUB}' from asked""")
def model_to_triplets_hub(spark, sf):
    records = flows.model_records(
        V.chinese(spark, sf), "doc_id", ner=stand_ins.entity_model, extract=stand_ins.triple_model, mode="lenient", style="entities",
        tries=1, wait=0.0, at_once=4,
    )
    rows = records.select("doc_id", big("chunk_index"), F.explode("triplets").alias("t"))
    return rows.select("doc_id", "chunk_index", "t.head", "t.rel", "t.tail")


@query(f"""with {V.SQL_CLEAN_CANDIDATES}, graph_rows as (select rec, pos, head, rel, tail from kept),
typed as (select rec, pos, head, rel, tail, {_SANITIZE} as rel_type from {_sanitized('rel')})
select head, rel_type, tail, arg_max(rel, {{'r': rec, 'p': pos, 'n': rel}}) as rel_name, count(*) as support from typed group by 1, 2, 3""")
def clean_to_graph(spark, sf):
    return flows.clean_to_graph(V.candidates(spark, sf)).edges


@query(f"""with recursive {V.SQL_NOISY}, {V.sql_chunks('noisy')}, keyed as (
  select {{'d': doc_id, 'c': chunk_index}} as doc_id, text from chunks),
{V.sql_tags('keyed', V.LATIN_LEXICON)}, {V.sql_triples('keyed')}, cand as (select doc_id as rec, pos, head, rel, tail from triples),
{V.sql_judged("cand")}, graph_rows as (select rec, pos, head, rel, tail from kept),
typed as (select rec, pos, head, rel, tail, {_SANITIZE} as rel_type from {_sanitized('rel')})
select head, rel_type, tail, arg_max(rel, {{'r': rec, 'p': pos, 'n': rel}}) as rel_name, count(*) as support from typed group by 1, 2, 3""")
def documents_to_graph(spark, sf):
    records = flows.rule_records(V.noisy(spark, sf), "doc_id", lexicon=V.LATIN_LEXICON)
    return flows.records_to_graph(records, "doc_id", "chunk_index").edges
