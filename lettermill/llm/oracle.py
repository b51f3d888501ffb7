"""DuckDB SQL for the queries of this folder that SQL can express, written without their filters."""

from __future__ import annotations

import string

from lettermill.llm.licenses import CONTAINMENT, PHRASES, SEPARATORS, TEMPLATES, template_words


_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _licenses() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    templates = ", ".join(
        f"({t}, {quote(label)}, [{', '.join(map(quote, words))}])"
        for t, ((label, _), words) in enumerate(zip(TEMPLATES, template_words(TEMPLATES)))
    )
    phrases = ", ".join(f"({quote(p)}, {quote(label)}, {len(p.split())})" for p, label in PHRASES.items())
    spaced = f"trim(regexp_replace({_LOWER.replace('text', '{}')}, '{SEPARATORS}', ' ', 'g'))"
    return f"""
with templates(t, label, words) as (values {templates}),
phrases(phrase, label, n) as (values {phrases}),
docs as (select doc_id, text, {spaced.format("text")} as w from documents),
words as (select doc_id, text, case when w = '' then [] else string_split(w, ' ') end as ws from docs),
places as (
  select doc_id, label, i - 1 as place
  from words, phrases, lateral (select unnest(range(1, len(ws) + 1)) as i)
  where ws[i] = split_part(phrase, ' ', 1) and array_to_string(ws[i : i + n - 1], ' ') = phrase
),
base as (select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word from places group by doc_id),
lines as (
  select row, doc_id, i, {spaced.format("line")} as w
  from (select row, doc_id, unnest(range(1, len(ls) + 1)) as i, unnest(ls) as line from (
    select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))
),
numbered as (select *, sum(case when w = '' then 1 else 0 end) over (partition by row order by i) as paragraph from lines),
blocks as (
  select any_value(doc_id) as doc_id, list_distinct(string_split(string_agg(w, ' '), ' ')) as ws
  from numbered where w <> '' group by row, paragraph
),
alike as (
  select doc_id, label, len(list_intersect(ws, words)) / len(words) as share from blocks, templates
  where len(list_intersect(ws, words)) >= {CONTAINMENT} * len(words) - 1e-9
),
best as (select doc_id, max(share) as share from alike group by doc_id),
found as (select doc_id, label, true as base from places union select doc_id, label, false from alike),
named as (
  select doc_id, string_agg(distinct label, ',' order by label) as labels,
    string_agg(distinct label, ',' order by label) filter (where base) as base_labels
  from found group by doc_id
)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  case when n_base > 0 then 1.0 else coalesce(share, 0.0) end as score
from words left join base using (doc_id) left join named using (doc_id) left join best using (doc_id)
"""


_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_LEXICAL = f"""
with rows as (select row_number() over () as row, doc_id, {_TERMS} as terms from documents),
sizes as (select row, doc_id, len(terms) as n from rows where len(terms) > 0),
totals as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes),
counts as (select row, term, count(*) as tf from (select row, unnest(terms) as term from rows) group by row, term),
df as (select term, count(*) as df from counts group by term),
asked as (select distinct item_id, unnest({_TERMS}) as term from benchmark),
weights as (
  select item_id, term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as w
  from asked join df using (term), totals
),
scores as (
  select item_id, row, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms))))) as bigint) as score
  from weights join counts using (term) join sizes using (row), totals
  group by item_id, row, doc_id
),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank, doc_id, score
  from scores where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""

_CRC = "list_reduce(range(8), lambda v, i: case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end, xor(c, b))"
_TRIE = f"""
with digits as (
  select distinct conv_id, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint)) as bytes
  from conversations where conv_id is not null
),
convs as (
  select conv_id, conv_id - conv_id % 5 as base,
    xor(list_reduce(bytes, lambda c, b: {_CRC}, cast(4294967295 as bigint)), 4294967295) % 9 as h
  from digits
),
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as p, hash, size from (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
      md5(coalesce(role, '') || chr(0) || coalesce(text, '')) as hash, strlen(coalesce(text, '')) as size
    from conversations where conv_id is not null)
),
placed as (
  select c.conv_id, 0 as part, p, hash, size from convs c join turns t on t.conv_id = c.base where p < h
  union all
  select conv_id, 1 as part, p, hash, size from convs join turns using (conv_id) where p >= h
),
rebuilt as (select conv_id, row_number() over (partition by conv_id order by part, p) as d, hash, size from placed),
paths as (
  select conv_id, d, size, array_agg(hash) over (partition by conv_id order by d) as path from rebuilt
  union all
  select conv_id, 0, 0, cast([] as varchar[]) from convs
),
lengths as (select conv_id, max(d) as n from paths group by conv_id),
nodes as (
  select path, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
    coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where d = n), '') as ends
  from paths join lengths using (conv_id) group by path, d
),
children as (select path[:-2] as path, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all),
known as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children using (path, d)),
subtrees as (
  select a.path, count(*) filter (where b.n_children = 0) as n_leaves, cast(sum((b.n_convs - 1) * b.size) as bigint) as saved_tokens
  from known a join known b on b.d >= a.d and b.path[:a.d] = a.path group by a.path
)
select known.conv_id, cast(known.d as bigint) as depth, parent.conv_id as parent_conv_id, known.n_convs, known.n_children, n_leaves, saved_tokens,
  sha256(known.ends) as ends_sha256
from known join subtrees using (path) left join known parent on parent.d = known.d - 1 and parent.path = known.path[:-2]
"""

ORACLE: dict[str, str] = {"op6_licenses": _licenses(), "op11_lexical": _LEXICAL, "op12_conversations": _TRIE}
