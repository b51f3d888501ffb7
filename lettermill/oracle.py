"""Independent SQL for the registered queries, run by DuckDB on the same tables.

Written over lists of lines, joins and plain windows, on purpose unlike the
Spark expressions it checks.
"""

from __future__ import annotations

import re

from lettermill import views
from lettermill.functions import fixed_values as fv
from lettermill.operators.significance import LEVEL, REPLICATES, STEPS
from lettermill.operators.signoffs import LEAST, LINES, SHARE
from lettermill.operators.sketches import QUANTILES
from lettermill.queries import BUDGETS, FIRST_PER_SOURCE, LARGE_PER_SOURCE, STREAM_PER_SOURCE, WORDS_KEPT


def _text(value: str) -> str:
    """SQL string literal; line feeds go through chr()."""
    pieces = ["'" + p.replace("'", "''") + "'" for p in value.split("\n")]
    return "(" + " || chr(10) || ".join(pieces) + ")"


def _list(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


LINE_WRAP = r"([^\n]{1,78}|[^ \n]+)(?: +|\n|$)"
SPACE = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
HASH = "('0x' || left(md5({w}), 3))::int"
WORDS = r"regexp_extract_all(lower({t}), '[\pL\pN_]+')"
TOKENS = r"regexp_extract_all({t}, '<\|[a-z]+\|>| ?[\pL\pN_]+|[^\pL\pN_]')"
SIGN_OFF = "(?im)^\\s*(" + "|".join(fv.SIGN_OFFS) + ")[,\\s/].*$"


def _strip(x: str) -> str:
    return f"trim({x}, {SPACE})"


def _n_words(x: str) -> str:
    return f"len(list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> ''))"


def _lines(x: str) -> str:
    return f"string_split({x}, chr(10))"


def _join(x: str) -> str:
    return f"coalesce(array_to_string({x}, chr(10)), '')"


def _until(x: str, stop: str) -> str:
    """Lines before the first one for which ``stop`` holds; its lambda argument is l."""
    found = f"list_position(list_transform({x}, lambda l: {stop}), true)"
    return f"({x})[1:coalesce(nullif({found}, 0), len({x}) + 1) - 1]"


def _without(x: str, drop: str) -> str:
    return f"list_filter({x}, lambda l: not ({drop}))"


_L = _strip("l")
CUT = f"string_split_regex({{t}}, '{SIGN_OFF}')[1]"
DELIMITER = f"{_L} in {_list(fv.DELIMITER_LINES)} or starts_with({_L}, '{fv.DELIMITER_PREFIX}')"
REPLY = (
    f"regexp_matches({_L}, '(?i)^On .+wrote:?$') or regexp_matches({_L}, '(?i)^Op .+schreef.+:?$')"
    f" or regexp_matches({_L}, '(?i)^On \\d+.*at \\d+:')"
)
QUOTED = f"starts_with({_L}, '>') or starts_with({_L}, '|')"
ARTIFACT = f"regexp_full_match({_L}, '[^\\pL\\pN]+') and length({_L}) < {fv.ARTIFACT_BELOW_CHARS}"
LONG = f"length(l) > {fv.LONG_LINE_CHARS}"
PHONE = f"regexp_matches({_L}, '(?i)^({'|'.join(fv.PHONE_LABELS)})[\\s:]+.*[\\d\\s\\+\\(\\)\\-]+$')"


def _normal(x: str) -> str:
    breaks = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return _strip(f"regexp_replace({breaks}, ' {{2,}}', ' ', 'g')")


# The pages at hand have no comment, script or head without an end, no unquoted address and no ``pre``.
_TAGS = [
    ("(?is)<!--.*?-->|<head\\b.*?</head>|<script\\b.*?</script>|<style\\b.*?</style>|<img\\b[^>]*>", ""),
    ("[ \\t\\r\\n\\f]+", " "),
    ("(?i)<a\\b[^>]*?\\bhref\\s*=\\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>", "[\\2](\\1)"),
    ("(?i)</?(?:b|strong)(?:\\s[^>]*)?>", "**"),
    ("(?i)</?(?:i|em)(?:\\s[^>]*)?>", "_"),
    *[(f"(?i)<h{n}\\b[^>]*>", chr(10) + "#" * n + " ") for n in range(1, 7)],
    ("(?i)<li\\b[^>]*>", chr(10) + "\x0f* "),
    (
        "(?i)</?(?:p|div|br|h[1-6]|ul|ol|li|table|tr|td|th|section|article|header|footer|nav|aside|main|hr|form)\\b[^>]*>",
        chr(10),
    ),
    ("<[a-zA-Z/!?][^>]*>", ""),
]
_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "(C)"), ("&middot;", "*"),
    ("&amp;", "&"),
]


def _html(x: str) -> str:
    for pattern, to in _TAGS:
        x = f"regexp_replace({x}, {_text(pattern)}, {_text(to)}, 'g')"
    for entity, to in _ENTITIES:
        x = f"replace({x}, {_text(entity)}, {_text(to)})"
    x = f"regexp_replace({x}, '[ \\t]*\\n[ \\t]*', chr(10), 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return _strip(f"replace({x}, chr(15), '  ')")


def _html_body(x: str) -> str:
    """HTML body, wrapped the way the reader must wrap it."""
    return _strip(f"regexp_replace({_html(x)}, '{LINE_WRAP}', '\\1' || chr(10), 'g')")


def _hits(x: str, needles: list[str]) -> str:
    return " + ".join(
        f"(length({x}) - length(replace({x}, {_text(n)}, ''))) // {len(n)}" for n in needles
    )


def _any(x: str, needles: list[str]) -> str:
    return "(" + " or ".join(f"contains(lower({x}), {_text(n)})" for n in needles) + ")"


def _cut_text(x: str, n: int) -> str:
    return f"case when length({x}) > {n} then left({x}, {n}) || '...' else {x} end"


_UNTIL_STOP = _until("ls", f"{DELIMITER} or {REPLY}")
_KEPT = _without(_UNTIL_STOP, f"({QUOTED}) or ({ARTIFACT}) or ({LONG}) or ({PHONE})")

CTES = {
    "emails": views.EMAILS,
    "parts": views.PARTS,
    "cut": f"select *, {_lines(CUT.format(t='body'))} as ls from emails",
    "cleaned": f"select * exclude (ls), {_normal(_join(_KEPT))} as clean from cut",
    "judged": f"""
        select *, {_n_words('clean')} as n_words,
          case when body is null or body = '' then 'empty'
               when {_n_words('clean')} < {fv.MIN_WORDS} then 'short' else 'ok' end as status
        from cleaned""",
    # language model: shares of hash buckets, per million
    "bucket_counts": f"""
        select lang, {HASH.format(w='word')} as bucket, count(*) as n
        from (select lang, unnest({WORDS.format(t='text')}) as word from documents) group by 1, 2""",
    "model": """
        select lang, bucket, (n * 1000000) // cast(sum(n) over (partition by lang) as bigint) as score
        from bucket_counts""",
    "samples": f"""
        select doc_id, {HASH.format(w='word')} as bucket
        from (select doc_id, unnest({WORDS.format(t=f'left(sample, {fv.LANGUAGE_SAMPLE_CHARS})')}) as word from to_detect)""",
    "scores": """
        select doc_id, lang, cast(sum(score) as bigint) as total
        from samples join model using (bucket) group by 1, 2""",
    "best": """
        select doc_id, lang as lang_detected from scores where total > 0
        qualify row_number() over (partition by doc_id order by total desc, lang) = 1""",
    "ok": f"""
        select e.*, case when lang_detected in {_list(fv.KEPT_LANGUAGES)} then lang_detected
                         else '{fv.UNKNOWN_LANGUAGE}' end as language
        from judged e left join best using (doc_id) where status = 'ok'""",
    "prompts": f"""
        select *, {_text(fv.SUBJECT_PROMPT)} || subject
          || case when to_addr <> '' then {_text(fv.RECIPIENT_PROMPT)} || to_addr else '' end as prompt
        from emails""",
    "splits": """
        select *, case when row_number() over (order by md5('42-' || cast(doc_id as string)), doc_id)
            <= cast(floor(count(*) over () * cast(0.9 as double)) as bigint)
            then 'train' else 'validation' end as split
        from to_split""",
    "turns": views.TURNS,
    "turns_marked": """
        select *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as segment
        from turns""",
    "chats": """
        select conv_id, string_agg(segment, '' order by turn) as chat from turns_marked group by 1""",
    "counts": f"""
        select token, count(*) as n from (select unnest({TOKENS.format(t='text')}) as token from to_count) group by 1""",
    "vocab": """
        select token, n, cast(row_number() over (order by n desc, token) + 256 as int) as token_id
        from counts qualify row_number() over (order by n desc, token) <= 32000""",
    "token_rows": f"""
        select id, unnest(toks) as token, generate_subscripts(toks, 1) as pos
        from (select id, {TOKENS.format(t='text')} as toks from to_encode)""",
    "ids": f"""
        select id, array_to_string((list(code order by pos, k))[1:{fv.MAX_LENGTH}], ' ') as seen, least(count(*), {fv.MAX_LENGTH}) as k
        from (
          select id, pos, unnest(codes) as code, generate_subscripts(codes, 1) as k from (
            select id, pos, case when token_id is not null then [token_id] else list_transform(
              range(0, strlen(token)), lambda b: ('0x' || substr(hex(token), cast(2 * b + 1 as int), 2))::int + 1) end as codes
            from token_rows left join vocab using (token) where pos <= {fv.MAX_LENGTH}))
        group by 1""",
    "sequences": f"""
        select id, trim(coalesce(seen, '') || repeat(' 0', cast({fv.MAX_LENGTH} - coalesce(k, 0) as int))) as input_ids,
          trim(repeat('1 ', cast(coalesce(k, 0) as int)) || repeat('0 ', cast({fv.MAX_LENGTH} - coalesce(k, 0) as int))) as attention_mask
        from to_encode left join ids using (id)""",
}

NEEDS = {
    "cut": ["emails"],
    "cleaned": ["cut"],
    "judged": ["cleaned"],
    "model": ["bucket_counts"],
    "samples": ["to_detect"],
    "scores": ["samples", "model"],
    "best": ["scores"],
    "ok": ["judged", "best"],
    "prompts": ["emails"],
    "splits": ["to_split"],
    "turns_marked": ["turns"],
    "chats": ["turns_marked"],
    "counts": ["to_count"],
    "vocab": ["counts"],
    "token_rows": ["to_encode"],
    "ids": ["token_rows", "vocab"],
    "sequences": ["to_encode", "ids"],
}


def _query(select: str, *ctes: str, **given: str) -> str:
    """Put the named CTEs, and what they need, before ``select``."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for needed in NEEDS.get(name, []):
            add(needed)
        for needed in CTES if name in given else ():
            if re.search(rf"\b(from|join) {needed}\b", given[name]):
                add(needed)
        order.append(name)

    for name in ctes:
        add(name)
    body = ",\n".join(f"{n} as ({given.get(n) or CTES[n]})" for n in order)
    return f"with {body}\n{select}" if order else select


EMAIL_SAMPLES = "select doc_id, clean as sample from judged"
OK_ROWS = {"to_detect": EMAIL_SAMPLES}
SPLIT_OK = {**OK_ROWS, "to_split": "select * from ok"}
DOCUMENT_TOKENS = {"to_count": "select text from documents", "to_encode": "select doc_id as id, text from documents"}
CHAT_TOKENS = {"to_count": "select segment as text from turns_marked", "to_encode": "select conv_id as id, chat as text from chats"}


def _rule(expression: str, source: str = "emails", column: str = "body") -> str:
    rows = f"select doc_id, {_lines(column)} as ls from {source}"
    ctes = ("emails", "rows") if source == "emails" else ("rows",)
    return _query(f"select doc_id, {_join(expression)} as text from rows", *ctes, rows=rows)


def _report(source: str, text: str, *groups: str) -> str:
    """Long-form style report over ``source.text``, optionally by groups."""
    g = "".join(f"{c}, " for c in groups)
    by = f"group by {', '.join(groups)}" if groups else ""
    part = f"partition by {', '.join([*groups, 'section'])}"
    lower = "lower(body)"
    metrics = {
        ("count", "texts"): "texts",
        ("length", "avg_words"): "total_words / texts",
        ("length", "min_words"): "min_words",
        ("length", "max_words"): "max_words",
        ("formality", "contractions"): "contractions",
        ("formality", "formal"): "formal",
        ("formality", "casual"): "casual",
        ("punctuation", "exclamations"): "exclamations",
        ("punctuation", "questions"): "questions",
        ("punctuation", "avg_exclamations"): "exclamations / texts",
        ("punctuation", "avg_questions"): "questions / texts",
        ("language", "dutch"): "dutch",
        ("language", "english"): "english",
        ("language", "dutch_percent"): "dutch / texts * 100.0::double",
        ("language", "english_percent"): "english / texts * 100.0::double",
    }
    scalars = "\nunion all ".join(
        f"select {g}'{s}' as section, '{m}' as item, cast({e} as double) as value from totals"
        for (s, m), e in metrics.items()
    )
    return f"""
    with {'emails as (' + views.EMAILS + '),' if source == 'emails' else ''}
    bodies as (select {g}{_strip(text)} as body from {source} where {_strip(text)} <> ''),
    totals as (
      select {g}cast(count(*) as double) as texts, cast(sum({_n_words('body')}) as double) as total_words,
        min({_n_words('body')}) as min_words, max({_n_words('body')}) as max_words,
        cast(sum({_hits(lower, fv.CONTRACTIONS)}) as double) as contractions,
        cast(sum({_hits(lower, fv.FORMAL_PHRASES)}) as double) as formal,
        cast(sum({_hits(lower, fv.CASUAL_WORDS)}) as double) as casual,
        cast(sum({_hits('body', ['!'])}) as double) as exclamations,
        cast(sum({_hits('body', ['?'])}) as double) as questions,
        cast(count(*) filter ({_any('body', fv.DUTCH_INDICATORS)}) as double) as dutch,
        cast(count(*) filter ({_any('body', fv.ENGLISH_INDICATORS)}) as double) as english
      from bodies {by}),
    items as (
      select {g}'opening' as section, left({_strip('string_split(body, chr(10))[1]')}, 100) as item from bodies
      union all
      select {g}'closing', left({_strip('string_split(body, chr(10))[-1]')}, 100) from bodies
      union all
      select * from (select {g}'word', unnest(list_filter({WORDS.format(t='body')},
        lambda w: regexp_full_match(w, '[a-z]{{3,}}') and w not in {_list(fv.STOP_WORDS)})) as word from bodies)),
    ranked as (
      select {g}section, item, count(*) as n,
        row_number() over ({part} order by count(*) desc, item) as rank
      from items group by {g}section, item having section = 'word' or count(*) > 1)
    {scalars}
    union all
    select {g}'style', case when contractions > formal * 2 then 'CASUAL' when formal > contractions * 2 then 'FORMAL'
      else 'BALANCED' end, cast(1 as double) from totals
    union all
    select {g}section, item, cast(n as double) from ranked
    where rank <= case when section = 'word' then {fv.TOP_WORDS} else {fv.TOP_PHRASES} end
    """


def _top_phrases(line: str) -> str:
    body = _strip("text")
    phrase = f"left({_strip(f'string_split({body}, chr(10))[{line}]')}, {fv.PHRASE_CHARS})"
    return f"""
    with phrases as (select {phrase} as phrase from documents where {_strip('text')} <> '')
    select phrase, count(*) as n, {_cut_text('phrase', fv.PHRASE_DISPLAY_CHARS)} as shown
    from phrases group by phrase having count(*) > 1 order by n desc, phrase limit {fv.TOP_PHRASES}
    """


def _mail(select: str) -> str:
    """The derived mailboxes as the reader must give them back."""
    quoted = "regexp_replace(body, '(?m)^From ', '>From ', 'g')"
    before, after = views.HTML_BODY.split("{}")
    page = f"regexp_replace('{before}' || body || '{after}', '(?m)^From ', '>From ', 'g')"
    mails = f"""
        select *, source || '.mbox' as mailbox, doc_id % 4 as layout, {quoted} as quoted, {page} as page,
          row_number() over (partition by source order by doc_id) - 1 as msg_idx
        from emails"""
    return _query(select, "emails", "mails", mails=mails)


_PART_ROWS = [
    # layout, part number, type, disposition, payload
    ("0", 0, "'text/plain'", "null", "case when body = '' then '' else quoted || chr(10) end"),
    ("1, 2, 3", 0, "'multipart/mixed'", "null", "null"),
    ("1, 2", 1, "'text/html'", "null", "page"),
    ("1", 2, "'text/plain'", "null", "body"),
    ("2", 2, "'text/plain'", "'attachment; filename=a.txt'", "'attached'"),
    ("3", 1, "'text/plain'", "'attachment; filename=a.txt'", "quoted"),
]

_CORPUS = f"""
    with emails as ({views.EMAILS}),
    texts as (
      select doc_id, subject, source, case doc_id % 4 when 0 then regexp_replace(body, '(?m)^From ', '>From ', 'g') when 1 then body
        when 2 then {_html_body("regexp_replace('" + views.HTML_BODY.split("{}")[0] + "' || body || '" + views.HTML_BODY.split("{}")[1] + "', '(?m)^From ', '>From ', 'g')")}
        end as body from emails),
    cut as (select doc_id, subject, source, body, {_lines(CUT.format(t="coalesce(body, '')"))} as ls from texts),
    cleaned as (select doc_id, subject, source, body, {_normal(_join(_KEPT))} as clean from cut),
    judged as (select doc_id, subject, source, clean, {_n_words('clean')} as n_words,
      case when body is null or body = '' then 'empty' when {_n_words('clean')} < {fv.MIN_WORDS} then 'short' else 'ok' end as status
      from cleaned)
"""

_STATS = """
    select count(*) as total, count(*) filter (status = 'ok') as processed,
      count(*) filter (status = 'empty') as skipped_empty, count(*) filter (status = 'short') as skipped_short,
      count(*) filter (status = 'error') as failed,
      cast(coalesce(sum(n_words) filter (status = 'ok'), 0) as bigint) as total_words,
      avg(n_words) filter (status = 'ok') as avg_words
    from judged
"""

_SHARE = "n / cast(sum(n) over ({}) as double) * 100.0::double as percent"

_DELTA = {
    "texts": "count(*)",
    "avg_words": "sum(w) / cast(count(*) as double)",
    "min_words": "min(w)",
    "max_words": "max(w)",
    "contractions": f"sum({_hits('lower(body)', fv.CONTRACTIONS)})",
    "formal": f"sum({_hits('lower(body)', fv.FORMAL_PHRASES)})",
    "casual": f"sum({_hits('lower(body)', fv.CASUAL_WORDS)})",
    "exclamations": f"sum({_hits('body', ['!'])})",
    "questions": f"sum({_hits('body', ['?'])})",
    "avg_exclamations": f"sum({_hits('body', ['!'])}) / cast(count(*) as double)",
    "avg_questions": f"sum({_hits('body', ['?'])}) / cast(count(*) as double)",
    "sentences": "sum(len(regexp_extract_all(body, '[.!?]+')))",
    "avg_sentence_words": "sum(w) / cast(nullif(sum(len(regexp_extract_all(body, '[.!?]+'))), 0) as double)",
    "sign_offs": f"count(*) filter ({CUT.format(t='body')} <> body)",
    "dutch": f"count(*) filter ({_any('body', fv.DUTCH_INDICATORS)})",
    "english": f"count(*) filter ({_any('body', fv.ENGLISH_INDICATORS)})",
    "dutch_percent": f"count(*) filter ({_any('body', fv.DUTCH_INDICATORS)}) / cast(count(*) as double) * 100.0::double",
    "english_percent": f"count(*) filter ({_any('body', fv.ENGLISH_INDICATORS)}) / cast(count(*) as double) * 100.0::double",
}

def _delta() -> str:
    sides = "\nunion all ".join(
        f"select '{m}' as metric, role, cast({e} as double) as value from bodies group by role"
        for m, e in _DELTA.items()
    )
    return f"""
    with bodies as (select role, {_strip('text')} as body, {_n_words('text')} as w from conversations
      where {_strip('text')} <> '' and role in ('user', 'assistant')),
    sides as ({sides})
    select a.metric, a.value as left_value, b.value as right_value, b.value - a.value as delta
    from sides a join sides b on a.metric = b.metric and a.role = 'user' and b.role = 'assistant'
    """


def _significance() -> str:
    low = "lower(body)"
    measures = {
        "n_words": "w", "contractions": _hits(low, fv.CONTRACTIONS), "formal": _hits(low, fv.FORMAL_PHRASES),
        "casual": _hits(low, fv.CASUAL_WORDS), "exclamations": _hits("body", ["!"]), "questions": _hits("body", ["?"]),
        "is_dutch": f"cast({_any(low, fv.DUTCH_INDICATORS)} as int)", "is_english": f"cast({_any(low, fv.ENGLISH_INDICATORS)} as int)",
    }
    steps = ", ".join(map(str, STEPS))
    means = "\nunion all ".join(
        f"select '{m}' as measure, b, cast(sum(k * {m}) filter (where role = 'user') as double) / cast(sum(k) filter (where role = 'user') as double) as l, "
        f"cast(sum(k * {m}) filter (where role = 'assistant') as double) / cast(sum(k) filter (where role = 'assistant') as double) as r from drawn group by b"
        for m in measures
    )
    tail = int(round(REPLICATES * (1 - LEVEL) / 2, 9))
    return f"""
    with bodies as (select conv_id, turn, role, {_strip('text')} as body, {_n_words('text')} as w from conversations
      where {_strip('text')} <> '' and role in ('user', 'assistant')),
    measured as (select role, concat_ws('-', cast(conv_id as varchar), cast(turn as varchar)) as id, {', '.join(f'{e} as {m}' for m, e in measures.items())} from bodies),
    digests as (
      select measured.*, j, md5('{fv.SPLIT_SEED}-' || j || '-' || id) as digest
      from measured, (select unnest(range({-(-REPLICATES // 8)})) as j)
    ),
    bits as (
      select digests.*, j * 8 + i as b, ('0x' || substr(digest, cast(4 * i + 1 as int), 4))::int as u
      from digests, (select unnest(range(8)) as i)
    ),
    drawn as (
      select * exclude (j, digest, u), len(list_filter([{steps}], lambda s: u >= s)) as k from bits where b < {REPLICATES}
      union all
      select measured.*, -1 as b, 1 as k from measured
    ),
    means as ({means}),
    deltas as (select measure, list(r - l order by r - l) filter (where b >= 0 and r - l is not null) as d from means group by measure)
    select measure, l as left_value, r as right_value, r - l as delta, d[{tail + 1}] as low, d[len(d) - {tail}] as high,
      d[{tail + 1}] > 0 or d[len(d) - {tail}] < 0 as different
    from means join deltas using (measure) where b = -1
    """


GROUPED_SPLIT = r"""
with recursive texts as (
  select doc_id, trim(regexp_replace(lower(text), '[^\pL\pN]+', ' ', 'g')) as body,
    trim(regexp_replace(lower(string_split(text, chr(10))[1]), '[^\pL\pN]+', ' ', 'g')) as opening
  from documents
),
keys as (
  select doc_id, 'b' || body as key from texts where body <> ''
  union all
  select doc_id, 'o' || opening from texts where len(string_split(opening, ' ')) >= 5
),
links as (select distinct a.doc_id as a, b.doc_id as b from keys a join keys b using (key) where a.doc_id <> b.doc_id),
reach(id, g) as (
  select doc_id, doc_id from documents union select b, g from reach join links on a = id
),
members as (select id, min(g) as group_id from reach group by id),
sized as (select group_id, count(*) as size from members group by group_id),
classes as (
  select size, count(*) as n, row_number() over (order by size desc) as i from sized group by size
),
totals as (select count(*) as total, cast(floor(count(*) * 0.9) as bigint) as target from documents),
allotted(i, take, taken, passed) as (
  select cast(0 as bigint), cast(0 as bigint), cast(0 as bigint), cast(0 as bigint)
  union all
  select i, take, cast(taken + take * size as bigint), cast(passed + size * n as bigint) from (
    select c.i, c.size, c.n, p.taken, p.passed, greatest(0, least(c.n,
      (2 * (p.passed + c.size * c.n) * target - 2 * p.taken * total + c.size * total) // (2 * c.size * total))) as take
    from allotted p join classes c on c.i = p.i + 1, totals)
),
ranked as (
  select group_id, size, row_number() over (partition by size order by md5('42-' || cast(group_id as string))) as place from sized
)
select id as doc_id, group_id, case when place <= take then 'train' else 'validation' end as split
from members join ranked using (group_id) join classes using (size) join allotted using (i)
"""

ORACLE: dict[str, str] = {
    "usable_emails": _query(
        """select status, language, count(*) as n, cast(sum(n_words) as bigint) as total_words
        from (select j.status, j.n_words, o.language from judged j left join ok o using (doc_id)) group by 1, 2""",
        "ok",
        **OK_ROWS,
    ),
    "mbox_scan": _mail(
        """select mailbox, msg_idx, subject, to_addr, case layout when 0 then 1 when 3 then 2 else 3 end as n_parts,
        cast(null as string) as error from mails"""
    ),
    "mbox_discover": "select distinct source || '.mbox' as mailbox, true as has_mail from documents",
    "jsonl_roundtrip": _query(
        f"""select subject, language, cast(n_words as int) as word_count, 0 as turn, 'system' as role,
          {_text(fv.SYSTEM_PROMPT)} as content from ok
        union all select o.subject, language, cast(n_words as int), 1, 'user', prompt from ok o join prompts using (doc_id)
        union all select subject, language, cast(n_words as int), 2, 'assistant', clean from ok""",
        "ok",
        "prompts",
        **OK_ROWS,
    ),
    "write_by_split": _query(
        "select split, count(*) as examples, cast(sum(n_words) as bigint) as total_words from splits group by 1",
        "splits",
        to_split="select doc_id, n_words from judged where status = 'ok'",
    ),
    "mime_parts": _mail(
        "\nunion all ".join(
            f"select mailbox, msg_idx, {n} as part_no, {kind} as content_type, cast({disposition} as string) as disposition,"
            f" cast({payload} as string) as payload from mails where layout in ({layouts})"
            for layouts, n, kind, disposition, payload in _PART_ROWS
        )
    ),
    "corpus_build": _CORPUS + _STATS,
    "examples_any_shape": """
        select doc_id, case when doc_id % 4 = 0 then lang end as language, case when doc_id % 4 = 0 then 'Subject ' || doc_id end as subject,
          text as content, 2 as n_messages, case when doc_id % 4 = 0 then lang end as tag, case when doc_id % 4 = 0 then doc_id end as mark,
          (select count(*) from documents where doc_id % 4 = 2) as n_rejects
        from documents where doc_id % 4 <> 2""",
    "corpus_update": _CORPUS
    + """, kept as (select * from judged where doc_id % 3 <> 0 or ascii(right(source, 1)) % 2 = 0),
    boxes as (select 'source_' || source as mailbox, count(*) as examples, cast(sum(n_words) as bigint) as words from kept where status = 'ok' group by 1),
    totals as (
      select count(*) as total, count(*) filter (where status = 'ok') as processed,
        cast(sum(n_words) filter (where status = 'ok') as bigint) as total_words from kept),
    grown as (
      select count(distinct source) as rebuilt, cast(0 as bigint) as removed from judged where doc_id % 3 = 0 and ascii(right(source, 1)) % 2 = 0)
    select * from boxes, totals, grown""",
    "corpus_read": _CORPUS
    + "select 'source_' || source as mailbox, subject, clean as content, cast(n_words as int) as word_count from judged where status = 'ok'",
    "header_projection": _query("select doc_id, subject, to_addr from emails", "emails"),
    "drop_attachments": _query(
        """select msg_id, part_no, content_type, disposition, payload from parts
        where not multipart or disposition is null or not contains(disposition, 'attachment')""",
        "parts",
    ),
    "choose_body": _query(
        f"""select d.doc_id as msg_id, content_type as body_type,
          case when content_type = 'text/html' then {_html_body('payload')} else payload end as body
        from documents d left join (
          select * from parts where content_type in ('text/plain', 'text/html')
            and (not multipart or disposition is null or not contains(disposition, 'attachment'))
          qualify row_number() over (partition by msg_id order by content_type = 'text/html', part_no) = 1
        ) p on p.msg_id = d.doc_id""",
        "parts",
    ),
    "decode_utf8": "select doc_id, text || text as text from documents",
    "html_to_text": f"select page_id, {_html('html')} as text from pages",
    "cut_signature": _query(f"select doc_id, {CUT.format(t='body')} as text from emails", "emails"),
    "drop_quoted": _rule(_without("ls", QUOTED)),
    "stop_delimiter": _rule(_until("ls", DELIMITER)),
    "stop_reply_header": _rule(_until("ls", REPLY)),
    "drop_artifacts": _rule(_without("ls", ARTIFACT)),
    "drop_long_lines": _rule(_without("ls", LONG), "documents", "text"),
    "drop_phone_lines": _rule(_without("ls", PHONE)),
    "normalize_whitespace": _query(f"select doc_id, {_normal('body')} as text from emails", "emails"),
    "clean_text": _query("select doc_id, clean as text from cleaned", "cleaned"),
    "learned_sign_offs": _query(
        f"""select doc_id, coalesce(n, 0) as sign_off_lines,
          case when n is null then body else rtrim({_join('ls[:places[len(places) - n + 1] - 1]')}, {SPACE}) end as text
        from ended left join longest using (doc_id)""",
        *("emails", "lined", "ended", "backwards", "blocks", "counted", "endings", "longest"),
        lined=f"select doc_id, source, body, {_lines('body')} as ls from emails",
        ended=f"""select *, list_filter(range(1, len(ls) + 1), lambda i: {_strip('ls[i]')} <> '') as places from lined""",
        backwards=f"""
          select doc_id, source, list_transform(list_reverse(places)[:{LINES + 1}], lambda i: {_strip('ls[i]')}) as tail from ended""",
        blocks="""
          select doc_id, source, d, tail[:d] as block, tail[d + 1] as above
          from (select *, unnest(range(1, len(tail))) as d from backwards)""",
        counted="select source, d, block, count(distinct above) as below from blocks group by all",
        endings="select source, sum(below) as endings from counted where d = 1 group by all",
        longest=f"""
          select doc_id, max(d) as n from blocks join counted using (source, d, block) join endings using (source)
          where below >= {LEAST} and below >= {SHARE} * endings group by all""",
    ),
    "reject_reasons": _query("select doc_id, cast(n_words as int) as n_words, status from judged", "judged"),
    "min_words": _query(
        f"select doc_id, cast(n_words as int) as n_words from judged where body <> '' and n_words >= {fv.MIN_WORDS}", "judged"
    ),
    "head_per_source": f"""
        select source, doc_id, text from documents
        qualify row_number() over (partition by source order by doc_id) <= {FIRST_PER_SOURCE}""",
    "head_per_source_large": f"""
        select case when doc_id % 2 = 0 then source end as source, (doc_id - 500) * 9000000000001 as place, doc_id from documents
        qualify row_number() over (partition by case when doc_id % 2 = 0 then source end order by doc_id) <= {LARGE_PER_SOURCE}""",
    "word_count": f"select doc_id, cast({_n_words('text')} as int) as n_words from documents",
    "lang_profile": f"""
        select lang, word, count(*) as n
        from (select lang, unnest({WORDS.format(t='text')}) as word from documents) group by 1, 2""",
    "detect_language": _query(
        f"""select doc_id, lang, coalesce(lang_detected, '{fv.UNKNOWN_LANGUAGE}') as lang_detected
        from documents left join best using (doc_id)""",
        "best",
        to_detect="select doc_id, text as sample from documents",
    ),
    "map_language": _query("select doc_id, language from ok", "ok", **OK_ROWS),
    "language_indicators": f"""
        with bodies as (select source, {_any('text', fv.DUTCH_INDICATORS)} as d, {_any('text', fv.ENGLISH_INDICATORS)} as e
          from documents where {_strip('text')} <> '')
        select source, count(*) as texts, count(*) filter (d) as dutch, count(*) filter (e) as english,
          count(*) filter (d) / cast(count(*) as double) * 100.0::double as dutch_percent,
          count(*) filter (e) / cast(count(*) as double) * 100.0::double as english_percent
        from bodies group by source""",
    "user_prompt": _query("select doc_id, prompt from prompts", "prompts"),
    "build_examples": _query(
        f"""select doc_id, {_text(fv.SYSTEM_PROMPT)} as system_text, prompt as user_text, clean as assistant_text,
          language, cast(n_words as int) as word_count, o.subject as subject
        from ok o join prompts using (doc_id)""",
        "ok",
        "prompts",
        **OK_ROWS,
    ),
    "assistant_texts": _query("select conv_id, turn, text from turns where role = 'assistant'", "turns"),
    "nested_assistant_texts": _query(
        """select conv_id, cast(n as int) as turn, text from (
          select *, row_number() over (partition by conv_id order by turn) - 1 as n from turns)
        where role = 'assistant'""",
        "turns",
    ),
    "ellipsize": f"""
        select doc_id, {_cut_text('text', fv.PHRASE_DISPLAY_CHARS)} as phrase,
          {_cut_text('text', fv.SAMPLE_DISPLAY_CHARS)} as sample from documents""",
    "processing_stats": _query(_STATS, "judged"),
    "stream_counters": _query(
        f"""select source, count(*) as total, count(*) filter (where status = 'ok') as processed,
          count(*) filter (where status = 'empty') as skipped_empty, count(*) filter (where status = 'short') as skipped_short,
          cast(0 as bigint) as failed, cast(coalesce(sum(n_words) filter (where status = 'ok'), 0) as bigint) as total_words,
          cast(0 as bigint) as late, max(doc_id) as upto
        from (select * from judged qualify row_number() over (partition by source order by doc_id) <= {STREAM_PER_SOURCE})
        group by source""",
        "judged",
    ),
    "language_distribution": _query(
        f"select *, {_SHARE.format('')} from (select language, count(*) as n from ok group by 1)", "ok", **OK_ROWS
    ),
    "split_stats": _query(
        """select split, count(*) as examples, cast(sum(n_words) as bigint) as total_words, avg(n_words) as avg_words
        from splits group by 1""",
        "splits",
        to_split="select doc_id, n_words from judged where status = 'ok'",
    ),
    "split_language_stats": _query(
        f"""select *, {_SHARE.format('partition by split')}
        from (select split, language, count(*) as n from splits group by 1, 2)""",
        "splits",
        **SPLIT_OK,
    ),
    "split_sizes": _query(
        f"""select split, n as examples, {_SHARE.format('')}
        from (select split, count(*) as n from splits group by 1)""",
        "splits",
        to_split="select doc_id from documents",
    ),
    "length_stats": f"""
        select source, count(*) as texts, avg(n) as avg_words, cast(min(n) as int) as min_words, cast(max(n) as int) as max_words
        from (select source, {_n_words('text')} as n from documents where {_strip('text')} <> '') group by 1""",
    "formality_counts": _query(
        f"""select *, case when contractions > formal * 2 then 'CASUAL' when formal > contractions * 2 then 'FORMAL'
          else 'BALANCED' end as label
        from (select cast(sum({_hits('lower(body)', fv.CONTRACTIONS)}) as bigint) as contractions,
          cast(sum({_hits('lower(body)', fv.FORMAL_PHRASES)}) as bigint) as formal,
          cast(sum({_hits('lower(body)', fv.CASUAL_WORDS)}) as bigint) as casual from emails)""",
        "emails",
    ),
    "formality_label": _query(
        f"""select source, case when c > f * 2 then 'CASUAL' when f > c * 2 then 'FORMAL' else 'BALANCED' end as label
        from (select source, sum({_hits('lower(body)', fv.CONTRACTIONS)}) as c,
          sum({_hits('lower(body)', fv.FORMAL_PHRASES)}) as f from emails where {_strip('body')} <> '' group by 1)""",
        "emails",
    ),
    "punctuation_stats": f"""
        select source, cast(sum({_hits('text', ['!'])}) as bigint) as exclamations,
          cast(sum({_hits('text', ['?'])}) as bigint) as questions,
          avg({_hits('text', ['!'])}) as avg_exclamations, avg({_hits('text', ['?'])}) as avg_questions
        from documents where {_strip('text')} <> '' group by 1""",
    "text_counts": f"""
        select role, count(*) as texts, count(*) filter ({_strip('text')} <> '') as non_blank
        from conversations group by 1""",
    "style_report": _report("emails", "body"),
    "full_style_report": f"""
        select * from ({_report("emails", "body")})
        union all select 'count', 'all_texts', cast(count(*) as double) from ({views.EMAILS})
        union all select 'sample', {_cut_text('body', fv.SAMPLE_DISPLAY_CHARS)}, cast(doc_id as double) from (
          select * from (
            select doc_id, {_strip('body')} as body from ({views.EMAILS}) where {_strip('body')} <> ''
            order by doc_id limit {fv.SAMPLE_POOL})
          order by md5('42-' || cast(doc_id as string)), doc_id limit {fv.SAMPLE_SIZE})""",
    "style_report_by_source": _report("documents", "text", "source"),
    "top_openings": _top_phrases("1"),
    "top_closings": _top_phrases("-1"),
    "top_words": f"""
        select word, count(*) as n from (select unnest({WORDS.format(t='text')}) as word from documents)
        where regexp_full_match(word, '[a-z]{{3,}}') and word not in {_list(fv.STOP_WORDS)}
        group by 1 order by n desc, word limit {fv.TOP_WORDS}""",
    "merged_top_words": f"""
        with words as (
          select source, lang, unnest({WORDS.format(t='text')}) as item from documents),
        counts as (
          select source, lang, item, count(*) as n from words
          where regexp_full_match(item, '[a-z]{{3,}}') and item not in {_list(fv.STOP_WORDS)} group by all),
        ranked as (select *, row_number() over (partition by source, lang order by n desc, item) as place from counts),
        slacks as (select source, lang, coalesce(max(n) filter (where place = {WORDS_KEPT + 1}), 0) as slack from ranked group by all),
        whole as (select source, sum(slack) as slack from slacks group by all),
        merged as (
          select source, item, sum(n) as n, any_value(whole.slack) - sum(slacks.slack) as missed
          from ranked join slacks using (source, lang) join whole using (source) where place <= {WORDS_KEPT} group by all),
        again as (select *, row_number() over (partition by source order by n + missed desc, n desc, item) as place from merged),
        outside as (
          select source, greatest(any_value(whole.slack), coalesce(max(n + missed) filter (where place = {WORDS_KEPT + 1}), 0)) as slack
          from again join whole using (source) group by all),
        kept as (select * from again where place <= {WORDS_KEPT}),
        best as (select *, row_number() over (partition by source order by n desc, item) as top from kept)
        select source, item, cast(n as bigint) as lower, cast(n + missed as bigint) as upper,
          (select count(*) from kept where kept.source = best.source and kept.item <> best.item and kept.n + kept.missed > best.n) < {fv.TOP_WORDS}
            and slack <= n as certain
        from best join outside using (source) where top <= {fv.TOP_WORDS}""",
    "length_quantiles": f"""
        select source, count(*) as texts, q as quantile, cast(max(n) filter (where place = greatest(1, ceil(q * total))) as bigint) as n_words
        from (select source, n, row_number() over (partition by source order by n) as place, count(*) over (partition by source) as total
          from (select source, {_n_words('text')} as n from documents where {_strip('text')} <> '')),
          (select unnest([{', '.join(f'cast({q} as double)' for q in QUANTILES)}]) as q)
        group by source, q""",
    "sample_texts": f"""
        select doc_id, {_cut_text('body', fv.SAMPLE_DISPLAY_CHARS)} as sample from (
          select doc_id, {_strip('text')} as body from documents where {_strip('text')} <> ''
          order by doc_id limit {fv.SAMPLE_POOL})
        order by md5('42-' || cast(doc_id as string)), doc_id limit {fv.SAMPLE_SIZE}""",
    "seeded_shuffle": """
        select doc_id, row_number() over (order by md5('42-' || cast(doc_id as string)), doc_id) - 1 as position
        from documents""",
    "grouped_split": GROUPED_SPLIT,
    "train_val_split": _query("select doc_id, split from splits", "splits", to_split="select doc_id from documents"),
    "render_chat": _query(
        "select conv_id, chat, chat || '<|assistant|>' || chr(10) as chat_for_reply from chats",
        "chats",
    ),
    "render_chat_by_role": _query(
        """select conv_id, chat, chat || ' ' as chat_for_reply from (
          select conv_id, '<s>' || string_agg(case role when 'user' then '[INST] ' || text || ' [/INST]'
            when 'assistant' then ' ' || text || '</s>' else '[' || role || '] ' || text || chr(10) end, '' order by turn) as chat
          from turns group by 1)""",
        "turns",
    ),
    "decode_sequences": "select doc_id, text from documents",
    "build_vocab": _query("select token, n, token_id from vocab", "vocab", **DOCUMENT_TOKENS),
    "encode_sequences": _query(
        "select id as doc_id, input_ids, attention_mask, input_ids as labels from sequences", "sequences", **DOCUMENT_TOKENS
    ),
    "encode_splits": _query(
        """select id as conv_id, split, input_ids, attention_mask, input_ids as labels
        from sequences join splits on id = doc_id""",
        "sequences",
        "splits",
        to_split="select distinct conv_id as doc_id from turns",
        **CHAT_TOKENS,
    ),
    "training_budget": "\nunion all ".join(
        f"""select count(distinct conv_id) as examples, {b} as batch_size, {a} as accumulation, {w} as workers, {e} as epochs,
          {b * a * w} as effective_batch, count(distinct conv_id) // {b * a * w} * {e} as steps,
          count(distinct conv_id) // {b * a * w} * {e} * {fv.SECONDS_PER_STEP} / cast(3600 as double) as hours
        from conversations"""
        for b, a, w, e in BUDGETS
    ),
    "prompt_grid": """
        select conv_id, turn, text as prompt,
          '<|user|>' || chr(10) || text || '<|end|>' || chr(10) || '<|assistant|>' || chr(10) as request, variant
        from conversations, (values ('base'), ('tuned')) v(variant) where role = 'user'""",
    "extract_reply": _query(
        f"""select conv_id,
          case when contains(chat, 'assistant') then {_strip("string_split(chat, 'assistant')[-1]")} else chat end as reply
        from chats""",
        "chats",
    ),
    "compare_responses": """
        select u.conv_id, u.turn, u.text as prompt, b.text as base_response, t.text as tuned_response
        from conversations u
        left join conversations b on b.conv_id = u.conv_id and b.turn = u.turn + 1 and b.role = 'assistant'
        left join conversations t on t.conv_id = u.conv_id and t.turn = u.turn + 3 and t.role = 'assistant'
        where u.role = 'user'""",
    "style_delta": _delta(),
    "style_significance": _significance(),
}
