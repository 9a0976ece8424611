"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, chain_dedup, chat_format, conversation_repair, decontaminate, exact_dedup, html_extract, language_mixture, minhash_dedup, periodic_runs,
    suffix_dedup, token_counts, toxicity,
)
from .common import table

#: Vocabulary of op8, by its public names.
VOCABULARY = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
#: Tokenizer of op11.
COUNTED = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_files() -> list[str]:
    import public_tokenizers

    return [public_tokenizers.path(name) for name in VOCABULARY]


def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    shown = chat_format.perspectives(table(spark, sf, "conversations"))
    return shown.select(
        "conv_id", "perspective", "part", "text", chat_format.mask_text().alias("trained"), "n_turns", "n_trained", "trained_chars"
    )


def op2_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf, "documents"))


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op4_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract(table(spark, sf, "pages"))


def op5_chain_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return chain_dedup.shared_passages(table(spark, sf, "documents"))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


def op7_language_mixture(spark: SparkSession, sf: str) -> DataFrame:
    out = language_mixture.language_mixture(table(spark, sf, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score", F.transform("languages", lambda x: x["lang"]).alias("languages"))


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.bpe(table(spark, sf, "documents"), *vocabulary_files()).drop("ids")


def op9_suffix_index(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf, "documents")).drop("kept")


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path(COUNTED))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(table(spark, sf, "documents"), damage=True))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_repair.repaired(table(spark, sf, "conversations"), damage=True)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_minhash_dedup, op3_decontaminate, op4_html_extract, op5_chain_dedup, op6_exact_dedup, op7_language_mixture,
        op8_bpe, op9_suffix_index, op10_toxicity, op11_token_counts, op12_periodic_runs, op13_conversation_repair,
    )
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op2_minhash_dedup": rf"""
with recursive w as (select doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as l from documents),
s as (
  select distinct doc_id, array_to_string(l[k:k + 4], ' ') as shingle
  from (select doc_id, l, unnest(range(1, greatest(len(l) - 4, least(len(l), 1)) + 1)) as k from w)),
c as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as (
  select p.a, p.b from p join c ca on ca.doc_id = p.a join c cb on cb.doc_id = p.b where 100 * p.k >= 75 * (ca.n + cb.n - p.k)),
e as (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a),
m as (select a as doc_id, min(b) as m from reach group by a)
select d.doc_id, coalesce(c.n, 0) as n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) as component_id,
  d.doc_id <= coalesce(m.m, d.doc_id) as kept
from documents d left join c using (doc_id) left join m using (doc_id)
""",
    "op3_decontaminate": rf"""
with w as (select doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as l from documents),
b as (select item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as l from benchmark),
bw as (
  select distinct item_id, n, array_to_string(l[k:k + n - 1], ' ') as win
  from (select item_id, l, least(13, len(l)) as n, unnest(range(1, len(l) - least(13, len(l)) + 2)) as k from b where len(l) > 0)),
sizes as (select distinct n from bw),
dw as (
  select doc_id, n, k, array_to_string(l[k:k + n - 1], ' ') as win
  from (select doc_id, l, n, unnest(range(1, len(l) - n + 2)) as k from w, sizes where len(l) >= n)),
hits as (select dw.doc_id, dw.k, dw.n, bw.item_id from dw join bw using (n, win)),
hw as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from (select distinct doc_id, k, n from hits))
  group by doc_id),
hi as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select w.doc_id, cast(len(l) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(l) as contaminated
from w left join hw using (doc_id) left join hi using (doc_id)
""",
    "op1_chat_format": r"""
with t as (
  select distinct conv_id, cast(coalesce(floor(turn / 1024), 0) as bigint) as part, turn, coalesce(role, '') as speaker, coalesce(text, '') as content
  from conversations
), p as (
  select distinct conv_id, role as perspective from conversations where role is not null and role not in ('', 'system')
), s as (
  select t.conv_id, p.perspective, t.part, t.turn, t.speaker, t.content,
    case when speaker = 'system' then 'system' when speaker = perspective then 'assistant' else 'user' end as role,
    replace(replace(content, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>') as body
  from t join p on t.conv_id is not distinct from p.conv_id
), h as (
  select *, '<|im_start|>' || role || case when role = 'user'
    then ' name=' || coalesce(nullif(regexp_replace(speaker, '[^\p{L}\p{N}_.-]', '_', 'g'), ''), 'unknown') else '' end || chr(10) as head
  from s
), w as (
  select *, coalesce(sum(length(head) + length(body) + 11) over (
    partition by conv_id, perspective, part order by turn nulls first, speaker, content rows between unbounded preceding and 1 preceding), 0) + length(head) as start
  from h
)
select conv_id, perspective, part, string_agg(head || body || '<|im_end|>' || chr(10), '' order by turn nulls first, speaker, content) as text,
  coalesce(string_agg(start || '-' || (start + length(body) + 10), ',' order by turn nulls first, speaker, content) filter (role = 'assistant'), '') as trained,
  count(*) as n_turns, count(*) filter (role = 'assistant') as n_trained,
  cast(coalesce(sum(length(body) + 10) filter (role = 'assistant'), 0) as bigint) as trained_chars
from w group by all
""",
    "op6_exact_dedup": """
with g as (
  select sha256(coalesce(text, '')) as text_sha256, max(doc_id) as keep_id, count(*) as group_size from documents group by 1
)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, g.text_sha256
from documents d join g on sha256(coalesce(d.text, '')) = g.text_sha256
""",
    # paths are kept as text: eight digits of cost, then the audit
    "op13_conversation_repair": r"""
with recursive c as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(
      coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint)),
      lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda d, o: xor(d >> 1, 3988292384 * (d & 1)))) as r
  from conversations
), d as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when kind = 3 then [0, 1] else [0] end) as again
  from (select *, xor(r, 4294967295) % 20 as kind from c) where kind <> 0
), f as (
  select *, row_number() over (partition by conv_id, role, text order by pos) as copy,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as final
  from (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as pos, count(*) over (partition by conv_id) as n from d)
), k as (
  select *, left(role, 1) as i,
    case when final = '' then 'blank' when copy > 1 then 'duplicate' when final not in ('.', '!', '?') then 'truncated' else '' end as fault
  from f
), p as (
  select conv_id, n + 1 as pos, '00000006II' as s, '00000003I' as u, '00000000' as e, '00000000' as a from k group by conv_id, n
  union all
  select conv_id, pos, coalesce(least(s2, printf('%08d', left(u2, 8)::int + 3) || 'I' || u2[9:]), s2), least(u2, printf('%08d', left(a2, 8)::int + 3) || 'I' || a2[9:]),
    least(e2, printf('%08d', left(u2, 8)::int + 3) || 'I' || u2[9:]), least(a2, printf('%08d', left(u2, 8)::int + 3) || 'I' || u2[9:])
  from (
    select conv_id, pos, least(s1, printf('%08d', left(u1, 8)::int + 3) || 'I' || u1[9:]) as s2, least(u1, printf('%08d', left(a1, 8)::int + 3) || 'I' || a1[9:]) as u2,
      least(e1, printf('%08d', left(u1, 8)::int + 3) || 'I' || u1[9:]) as e2, least(a1, printf('%08d', left(u1, 8)::int + 3) || 'I' || u1[9:]) as a2
    from (
      select p.conv_id, k.pos,
        least(printf('%08d', left(p.s, 8)::int + 4) || 'D' || p.s[9:], case when stay then least(ku, ru) end) as s1,
        least(printf('%08d', left(p.u, 8)::int + 4) || 'D' || p.u[9:], case when stay then least(ka, ra) end) as u1,
        least(printf('%08d', left(p.e, 8)::int + 4) || 'D' || p.e[9:], case when stay then least(ku, ru, ks) end) as e1,
        least(printf('%08d', left(p.a, 8)::int + 4) || 'D' || p.a[9:], case when stay then least(ku, ru) end) as a1
      from p join (
        select conv_id, pos, i, fault not in ('blank', 'duplicate') as stay, case when fault = 'truncated' then 3 else 0 end as more from k
      ) k on k.conv_id is not distinct from p.conv_id and k.pos = p.pos - 1,
      lateral (select
        case when i = 'u' then printf('%08d', left(p.u, 8)::int + more) || 'K' || p.u[9:] end as ku,
        case when i = 'a' then printf('%08d', left(p.a, 8)::int + more) || 'K' || p.a[9:] end as ka,
        case when i = 's' then printf('%08d', left(p.s, 8)::int + more) || 'K' || p.s[9:] end as ks,
        printf('%08d', left(p.u, 8)::int + more + 3) || 'R' || p.u[9:] as ru,
        printf('%08d', left(p.a, 8)::int + more + 3) || 'R' || p.a[9:] as ra)
    )
  )
), best as (
  select conv_id, left(e, 8)::bigint as cost, e[9:] as audit from p where pos = 1
), l as (
  select conv_id, audit, unnest(string_split(audit, '')) as letter, unnest(range(1, len(audit) + 1)) as seq from best where audit <> ''
), o as (
  select *, sum((letter <> 'I')::int) over (partition by conv_id order by seq rows unbounded preceding) as pos,
    sum((letter <> 'D')::int) over (partition by conv_id order by seq rows unbounded preceding) as place
  from l
), w as (
  select o.conv_id, seq, letter, place, k.role, case when letter = 'I' then '' else k.text end as text,
    max(case when letter = 'K' and place = 1 and k.i = 's' then 1 else 0 end) over (partition by o.conv_id) as led
  from o left join k on k.conv_id is not distinct from o.conv_id and k.pos = o.pos
), h as (
  select conv_id, sha256(string_agg(case when letter = 'K' then role when (place - led) % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by seq)) as sha
  from w where letter <> 'D' group by conv_id
), m as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || i not in ('su', 'ua', 'au')) as illegal
  from (select *, lag(i) over (partition by conv_id order by pos) as before from k) group by conv_id
)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) a
left join m on m.conv_id is not distinct from a.conv_id
left join best on best.conv_id is not distinct from a.conv_id
left join h on h.conv_id is not distinct from a.conv_id
""",
}
