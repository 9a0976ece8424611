"""Input views of the registered queries, in Spark and in SQL.

The supplied tables hold no Chinese text and no page noise, so whole
documents get one noise line in front or one Chinese sentence behind, and
triples with defects come from whole relational tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunking
from ..sources.tables import read_table

# fixed values: white space as the SQL spells it, apart from the library's own list
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    "[\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)
NOISE = ["12", "12345", "Page 3 of 10", "see page 3", "第 5 页", "-*_-", "--", " \t"]
CHINESE = ["城市北部规划建设产业园区。", "建筑设计。", "发展目标。", "该地区功能完善。", "今天天气很好。"]
LATIN_LEXICON = [
    ("Location", ["eau", "ción"], "south"),
    ("Location", ["sch", "the "], "north"),
    ("Land use function", ["ich", "able"], "housing"),
    ("Direction", ["est", "nord"], "west"),
    ("Concept", ["tion"], "notion"),
    ("Concept", ["ment"], "element"),
    ("Planned activity", ["ing"], "推进 renewal"),
    ("Planned activity", ["ung"], "建设 planung"),
]
HUB = "housing"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over as many partitions as the session asks for in ``tripleweave.input.partitions``; by default as they are read.

    A bench or test on one machine sets it, as a table of one row group is read by one task.
    """
    n = int(df.sparkSession.conf.get("tripleweave.input.partitions", "0"))
    return df.repartition(n, key) if n else df


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read_table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")


def _pick(values: list[str]) -> "F.Column":
    return F.get(F.array(*map(F.lit, values)), (F.col("doc_id") % len(values)).cast("int"))


def noisy(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).withColumn("text", F.concat(_pick(NOISE), F.lit("\n"), "text"))


def chinese(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).withColumn("text", F.concat("text", F.lit("\n"), _pick(CHINESE)))


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier - relation - part triples with every defect: rec, pos, supp, head, rel, tail."""
    items = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = (
        spread(items, "l_orderkey")
        .join(read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey")
        .join(read_table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
        .withColumn("k", (F.col("l_orderkey") * 7 + F.col("l_partkey")) % 16)
    )
    copies = F.explode(F.when(F.col("k") == 8, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0))))
    head = (
        F.when(F.col("k") == 0, F.col("p_name")).when(F.col("k") == 1, "").when(F.col("k") == 2, "x")
        .when(F.col("k") == 3, "北").when(F.col("k") == 4, "！！").otherwise(F.col("s_name"))
    )
    rel = F.when(F.col("copy") == 1, "推动").when(F.col("copy") == 2, "推进").otherwise(
        F.get(F.array(*map(F.lit, RELATIONS)), (F.col("k") % 8).cast("int"))
    )
    return rows.withColumn("copy", copies).select(
        F.col("l_orderkey").alias("rec"),
        ((F.col("l_linenumber") * F.lit(10**12) + F.col("l_partkey")) * 4 + F.col("copy")).alias("pos"),
        F.col("l_suppkey").alias("supp"),
        head.alias("head"), rel.alias("rel"), F.when(F.col("k") != 12, F.col("p_name")).alias("tail"),
    )


def sentence_triples(spark: SparkSession, sf: str) -> DataFrame:
    """A triple of each sentence of the documents, its first and its last word: rec, pos, head, rel, tail."""
    rows = chunking.explode_sentences(documents(spark, sf), "doc_id")
    words = F.split("sentence", " ")
    rel = F.get(F.array(*map(F.lit, SENTENCE_RELATIONS)), ((F.col("doc_id") + F.col("pos")) % len(SENTENCE_RELATIONS)).cast("int"))
    return rows.select(
        F.col("doc_id").alias("rec"), F.col("pos").cast("bigint").alias("pos"), F.get(words, F.lit(0)).alias("head"), rel.alias("rel"),
        F.element_at(words, -1).alias("tail"),
    )


#: Several of them give one relation type.
SENTENCE_RELATIONS = ["part of", "uses", "part-of", "--", "uses!"]
RELATIONS = ["促进", "推进", "完成", "采用", "计划", "demo", "位于", "规划建设"]


def records_json(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON triple field per event, well-formed or broken in some way: rec, raw, triplets."""
    x = F.col("event_type")
    y = F.concat(F.lit("user "), F.col("user_id").cast("string"))
    raw = F.get(F.array(*[_filled(t, x, y) for t in RECORD_JSON]), (F.col("event_id") % len(RECORD_JSON)).cast("int"))
    events = spread(read_table(spark, sf, "events").select("event_id", "event_type", "user_id"), "event_id")
    rows = events.select(F.col("event_id").alias("rec"), raw.alias("raw"))
    return rows.withColumn("triplets", F.parse_json("raw"))


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """One model answer per event, plain or wrapped in some way: rec, response."""
    x, y = F.col("event_type"), F.col("user_id").cast("string")
    raw = F.get(F.array(*[_filled(t, x, y) for t in RESPONSES]), (F.col("event_id") % len(RESPONSES)).cast("int"))
    events = spread(read_table(spark, sf, "events").select("event_id", "event_type", "user_id"), "event_id")
    return events.select(F.col("event_id").alias("rec"), raw.alias("response"))


RECORD_JSON = [
    '[["<x>","推进","<y>"],["<x>","促进","<y>"],["<x>","位于","<y>"]]',
    '{"error":"parse_error","raw":"<x>"}',
    '[["<x>","<y>"],["<x>","完成","<y>","extra"],5]',
    '[["演示","三元组","示例"],["demo <x>","推进","<y>"]]',
    '[["<y>","发展","<y>"],["<x>","采用",null]]',
    "null",
    '[["<x> "," 规划建设"," <y>"],["北","推进","<y>"],["！","推进","<y>"]]',
    '[[1,"推进",true],["<x>","实现",25]]',
    "[]",
    '{"error":null,"raw":"<x>"}',
    '[["<x>","位于"],["<y>"],["<x>","推进","<y>"]]',
    '[[1.0,"实现","<x>"],["<x>","实现",2.5]]',
]
RESPONSES = [
    '[["<x>","推进","<y>"]]',
    '```json\n[["<x>","推进","<y>"]]\n```',
    'Result: ["<x>","推进","<y>"]',
    '{"Location":["<x>"]}',
    'ok {"Location":["<x>"],"Concept":["<y>","c"]} done',
    "no json",
    '```json\n{"Location":["<x>"]}\n```',
    '  [["<x>","推进","<y>"],["<y>","采用","<x>"]] tail',
    '["<x>","推进","<y>"]',
    "{}",
]


def _filled(template: str, x, y) -> "F.Column":
    return F.replace(F.replace(F.lit(template), F.lit("<x>"), x), F.lit("<y>"), y)


# --- the same views in SQL ------------------------------------------------------


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def sql_strip(s: str) -> str:
    return f"trim({s}, {quoted(SPACE_CHARS)})"


SQL_NOISY = (
    f"noisy as (select doc_id, source, {sql_list(NOISE)}[(doc_id % {len(NOISE)}) + 1] || chr(10) || text as text "
    "from documents)"
)
SQL_CHINESE = (
    f"chinese as (select doc_id, source, text || chr(10) || {sql_list(CHINESE)}[(doc_id % {len(CHINESE)}) + 1] as text "
    "from documents)"
)
SQL_LINE_BREAK = quoted(r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]")
SQL_NUMBER = r"regexp_full_match(line, '\p{Nd}{1,4}')"
SQL_HEADER = f"regexp_matches(line, '^(?i:page){SPACE_CLASS}*\\p{{Nd}}')"
SQL_MARK = f"regexp_full_match(line, '第{SPACE_CLASS}*\\p{{Nd}}+{SPACE_CLASS}*页')"
SQL_SEPARATOR = "regexp_full_match(line, '[-*_]{3,}')"
SQL_PAGE_NOISE = f"{SQL_NUMBER} or {SQL_HEADER}"
SQL_EXTRA_NOISE = f"{SQL_PAGE_NOISE} or {SQL_MARK} or {SQL_SEPARATOR}"


def sql_lines(source: str, drop: str = "false") -> str:
    """CTE ``lines``: doc_id, line_no, line of kept lines."""
    return f"""raw_lines as (
  select doc_id, generate_subscripts(l, 1) as n, {sql_strip('unnest(l)')} as line
  from (select doc_id, regexp_split_to_array(text, {SQL_LINE_BREAK}) as l from {source})),
lines as (
  select doc_id, row_number() over (partition by doc_id order by n) as line_no, line
  from raw_lines where line <> '' and not ({drop}))"""


def sql_sentences(source: str, extra: bool = False) -> str:
    """CTE ``sents``: doc_id, pos (0-based), sentence, t of the cleaned text."""
    return sql_lines(source, SQL_EXTRA_NOISE if extra else SQL_PAGE_NOISE) + f""",
cleaned as (select doc_id, string_agg(line, chr(10) order by line_no) as text from lines group by doc_id),
parts as (
  select doc_id, list_filter(string_split(
    regexp_replace(text, '([。！？!?.]){SPACE_CLASS}*', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') as l
  from cleaned),
sents as (
  select doc_id, generate_subscripts(l, 1) - 1 as pos, unnest(l) as sentence from parts)"""


def sql_chunks(source: str, extra: bool = False, budget: int = 512) -> str:
    """CTE ``chunks``: doc_id, chunk_index, text. Needs ``with recursive``."""
    return sql_sentences(source, extra) + f""",
sized as (select doc_id, pos, sentence, greatest(1, length(sentence) // 2) as t from sents),
walk as (
  select doc_id, pos, 1 as chunk_index, t as used from sized where pos = 0
  union all
  select s.doc_id, s.pos,
    case when w.used + s.t > {budget} then w.chunk_index + 1 else w.chunk_index end,
    case when w.used + s.t > {budget} then s.t else w.used + s.t end
  from walk w join sized s on s.doc_id = w.doc_id and s.pos = w.pos + 1),
chunks as (
  select doc_id, chunk_index, string_agg(sentence, '' order by pos) as text
  from walk join sized using (doc_id, pos) group by doc_id, chunk_index)"""


def sql_tags(source: str, lexicon, key: str = "doc_id") -> str:
    """CTE ``tags``: key, category, rank, entity."""
    rows = [(c, w, e, i) for i, (c, words, e) in enumerate(lexicon) for w in words]
    values = ", ".join(f"({quoted(c)}, {quoted(w)}, {quoted(e)}, {i})" for c, w, e, i in rows)
    return f"""lexicon(category, keyword, entity, rank) as (values {values}),
tags as (select distinct {key}, category, entity, rank from {source} join lexicon on contains(text, keyword))"""


SQL_RULES = """placed as (
  select l.doc_id, 1 as rule, l.rank as i, a.rank as j, l.entity as head, a.entity as rel, '发展目标' as tail
  from tags l join tags a using (doc_id) where l.category = 'Location' and a.category = 'Planned activity'),
used as (
  select f.doc_id, 2 as rule, f.rank as i, c.rank as j, '城市规划' as head, '实现' as rel, f.entity as tail
  from tags f join tags c using (doc_id) where f.category = 'Land use function' and c.category = 'Concept'),
acted as (
  select doc_id, 3 as rule, rank as i, 0 as j, '政府' as head, '推进' as rel, entity as tail
  from tags where category = 'Planned activity'),
ruled as (select * from placed union all select * from used union all select * from acted)"""


def sql_triples(source: str) -> str:
    return SQL_RULES + f""",
triples as (
  select doc_id, row_number() over (partition by doc_id order by rule, i, j) - 1 as pos, head, rel, tail from ruled
  union all
  select doc_id, 0, '演示', '三元组', '示例' from {source} where doc_id not in (select doc_id from ruled))"""


SQL_CANDIDATES = f"""base as (
  select l_orderkey as rec, l_linenumber, l_partkey, l_suppkey, s_name, p_name, (l_orderkey * 7 + l_partkey) % 16 as k
  from lineitem join supplier on s_suppkey = l_suppkey join part on p_partkey = l_partkey),
cand as (
  select rec, (l_linenumber * 1000000000000 + l_partkey) * 4 + copy as pos, l_suppkey as supp,
    case k when 0 then p_name when 1 then '' when 2 then 'x' when 3 then '北' when 4 then '！！' else s_name end as head,
    case copy when 1 then '推动' when 2 then '推进' else {sql_list(RELATIONS)}[(k % 8) + 1] end as rel,
    case when k <> 12 then p_name end as tail
  from (select *, unnest(case when k = 8 then [0, 1, 2] else [0] end) as copy from base))"""

SQL_SENTENCE_TRIPLES = sql_sentences("documents") + f""",
said as (
  select doc_id as rec, cast(pos as bigint) as pos, string_split(sentence, ' ')[1] as head,
    {sql_list(SENTENCE_RELATIONS)}[((doc_id + pos) % {len(SENTENCE_RELATIONS)}) + 1] as rel, string_split(sentence, ' ')[-1] as tail
  from sents)"""
SQL_NORM = """case when regexp_matches(r, '推进|促进|推动') then '推进' when regexp_matches(r, '实现|完成') then '实现'
  when regexp_matches(r, '发展|建设') then '发展' when regexp_matches(r, '规划|计划') then '规划活动' else r end"""
SQL_VALID = """((length({0}) <> 1 or {0} in ('北','南','东','西','中','上','下')) and regexp_matches({0}, '[\\p{{L}}\\p{{N}}]'))"""
KEYWORDS = "推进|促进|推动|实现|完成|发展|建设|规划|计划|采用|覆盖|建立|设置|改善|增加|实施"  # fixed values, spelled out for the SQL
SQL_REASON = f"""case
  when h is null or r is null or t is null then 'bad_format'
  when h = '' or r = '' or t = '' or regexp_matches(h || chr(10) || r || chr(10) || t, '演示|示例|三元组|demo') then 'placeholder'
  when h = t then 'head_eq_tail'
  when not ({SQL_VALID.format('h')} and {SQL_VALID.format('t')}) then 'invalid_entity'
  when not regexp_matches(r, '{KEYWORDS}') then 'rel_no_keyword'
  end"""


def sql_keyword(rel: str) -> str:
    return f"regexp_matches({rel}, '{KEYWORDS}')"


def sql_judged(source: str) -> str:
    """CTE ``judged``: rec, pos, h, r, t, reason, dup number; ``kept``: the survivors."""
    return f"""stripped as (select *, {sql_strip('head')} as h, {sql_strip('rel')} as r, {sql_strip('tail')} as t from {source}),
laddered as (select *, {SQL_REASON} as reason, {SQL_NORM} as rn from stripped),
judged as (
  select *, row_number() over (partition by rec, h, rn, t, reason order by pos) as nth from laddered),
kept as (select rec, pos, h as head, rn as rel, t as tail from judged where reason is null and nth = 1)"""


SQL_CLEAN_CANDIDATES = SQL_CANDIDATES + ",\n" + sql_judged("cand")


def sql_filled(templates, expr: str) -> str:
    return f"replace(replace({sql_list(templates)}[({expr} % {len(templates)}) + 1], '<x>', x), '<y>', y)"


SQL_RECORDS = f"""records as (
  select event_id as rec, {sql_filled(RECORD_JSON, 'event_id')} as raw
  from (select event_id, event_type as x, 'user ' || user_id as y from events))"""
SQL_ITEMS = SQL_RECORDS + """,
lists as (select rec, raw, case when json_type(raw) = 'ARRAY' then from_json(raw, '["JSON"]') else [] end as l from records),
items as (
  select rec, generate_subscripts(l, 1) - 1 as pos, unnest(l) as item from lists),
shaped as (
  select rec, pos, json_type(item) = 'ARRAY' and json_array_length(item) >= 3 as ok, item from items),
parted as (
  select rec, pos,
    case when ok then case json_type(item, '$[0]') when 'NULL' then 'None' when 'BOOLEAN' then upper(left(item->>'$[0]', 1)) || substr(item->>'$[0]', 2) else item->>'$[0]' end end as head,
    case when ok then case json_type(item, '$[1]') when 'NULL' then 'None' when 'BOOLEAN' then upper(left(item->>'$[1]', 1)) || substr(item->>'$[1]', 2) else item->>'$[1]' end end as rel,
    case when ok then case json_type(item, '$[2]') when 'NULL' then 'None' when 'BOOLEAN' then upper(left(item->>'$[2]', 1)) || substr(item->>'$[2]', 2) else item->>'$[2]' end end as tail
  from shaped)"""
SQL_RESPONSES = f"""responses as (
  select event_id as rec, {sql_filled(RESPONSES, 'event_id')} as response
  from (select event_id, event_type as x, cast(user_id as varchar) as y from events))"""
