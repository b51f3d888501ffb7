"""HTML to text as a chain of built-in replacements.

Links stay as ``[text](url)``, emphasis as ``**`` and ``_``, headings as ``#``
and list items as ``*``; images, scripts, styles, comments and the head go;
block tags become line breaks. White space of the source is one space outside
``pre``. Entities are decoded last, so that escaped tags never turn into real
ones. A ``<`` that no letter, slash, ``!`` or ``?`` follows is text.

Every pattern is linear: none looks further than the next tag, and what runs
from a mark to its end is only looked for before the last end there is.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill.functions.text import strip

# Marks for what a later step needs; control characters never come from the page.
LINK, LINK_TEXT, LINK_END, PRE, PRE_END, BREAK, ITEM, END, HEADING = (chr(i) for i in (3, 4, 5, 6, 7, 14, 15, 16, 17))
QUOTE_MARK = chr(2)  # begins a quote; before a slash, ends it
CONTROLS = r"[\x01-\x08\x0e-\x1f]"

# --- Fixed values: order matters ------------------------------------------------
HREF = r"(?i)<a\b[^<>]*?\bhref\s*+=\s*+(?:\"([^\"<>]*+)\"|'([^'<>]*+)'|([^\s\"'<>]++))[^<>]*+>"
REWRITES = [
    (HREF, f"{LINK}$1$2$3{LINK_TEXT}"),
    (r"(?i)</a\s*+>", LINK_END),
    (f"{LINK}([^{LINK}-{LINK_END}]*+){LINK_TEXT}([^{LINK}{LINK_END}]*+){LINK_END}", "[$2]($1)"),
    (f"{LINK}[^{LINK_TEXT}]*+{LINK_TEXT}|{LINK_END}", ""),
    (r"(?i)<img\b[^<>]*+>", ""),
    (r"(?i)</?(?:b|strong)(?:\s[^<>]*+)?>", "**"),
    (r"(?i)</?(?:i|em)(?:\s[^<>]*+)?>", "_"),
    (r"(?i)<(/?)blockquote\b[^<>]*+>", f"\n{QUOTE_MARK}$1\n"),
    (r"(?i)<h([1-6])\b[^<>]*+>", f"\n{HEADING}$1"),
    (r"(?i)<li\b[^<>]*+>", f"\n{ITEM}* "),
    (
        r"(?i)</?(?:p|div|br|h[1-6]|ul|ol|li|table|tr|td|th|section|article|header|footer"
        r"|nav|aside|main|pre|hr|form)\b[^<>]*+>",
        "\n",
    ),
    (r"<[a-zA-Z/!?][^<>]*+>", ""),
]
REMOVED = [  # opening, end, what an end without an opening leaves
    ("<!--", "-->", "-->"),
    (r"<script\b", r"(?i)</script\s*+>", ""),
    (r"<style\b", r"(?i)</style\s*+>", ""),
    (r"<head\b", r"(?i)</head\s*+>", ""),
]
PLAIN_ENTITIES = {"nbsp": " ", "copy": "(C)", "middot": "*", "#160": " ", "#xa0": " ", "#xA0": " "}
WRAP_COLUMNS = 78
LINE_WRAP = rf"([^\n]{{1,{WRAP_COLUMNS}}}|[^ \n]+)(?: +|\n|$)"


def entity_texts() -> dict[str, str]:
    """Text of every named entity; the common ones come first."""
    named = {name.rstrip(";"): text for name, text in entities.html5.items() if name.endswith(";")}
    common = {name: named[name] for name in ("amp", "lt", "gt", "quot", "apos", *entities.name2codepoint)}
    return {**common, **named, **PLAIN_ENTITIES}


def _quote_lines(text: Column) -> Column:
    """Put ``> `` before the lines between quote marks, once for every level."""

    def add(done: Column, piece: Column) -> Column:
        first = done["text"].isNull()
        step = F.when(first, 0).when(piece.startswith("/"), -1).otherwise(1)
        depth = F.greatest(done["depth"] + step, F.lit(0))
        mark = F.repeat(F.lit("> "), depth)
        lines = strip(F.when(step == -1, F.substr(piece, F.lit(2))).otherwise(piece))
        quoted = F.concat(F.lit("\n"), mark, F.replace(lines, F.lit("\n"), F.concat(F.lit("\n"), mark)))
        text = F.concat(F.coalesce(done["text"], F.lit("")), F.when(lines == "", "").otherwise(quoted))
        return F.struct(depth.alias("depth"), text.alias("text"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("text"))
    return F.aggregate(F.split(text, QUOTE_MARK), start, add, lambda done: done["text"])


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _without(text: Column, opening: str, end: str, rest: str) -> Column:
    """Remove what lies between ``opening`` and the next ``end``; an opening without an end stays."""

    def cut(marked: Column) -> Column:
        tail = F.substring_index(marked, END, -1)  # behind the last end
        before = F.left(marked, F.length(marked) - F.length(tail))
        without = F.concat(F.regexp_replace(before, f"(?i){opening}[^{END}]*+{END}", ""), tail)
        return F.when(marked.contains(END), without).otherwise(marked)

    return F.replace(_once(F.regexp_replace(text, end, END), cut), F.lit(END), F.lit(rest))


def _collapsed(text: Column) -> Column:
    """White space as one space, but for ``pre``, where line feeds become a mark."""
    one_space = lambda t: F.regexp_replace(t, r"[ \t\r\n\f]++", " ")

    def piece(p: Column, i: Column) -> Column:
        kept = F.substring_index(p, PRE_END, 1)
        after = F.substr(p, F.length(kept) + 1)
        kept = F.replace(F.replace(kept, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(BREAK))
        return F.when((i == 0) | ~p.contains(PRE_END), one_space(p)).otherwise(F.concat(kept, one_space(after)))

    marked = F.regexp_replace(F.regexp_replace(text, r"(?i)<pre\b[^<>]*+>", f"<p>{PRE}"), r"(?i)</pre\s*+>", f"{PRE_END}<p>")
    split = lambda t: F.array_join(F.transform(F.split(t, PRE), piece), "")
    return F.replace(_once(marked, lambda t: F.when(t.contains(PRE), split(t)).otherwise(one_space(t))), F.lit(PRE_END))


def _decoded(text: Column) -> Column:
    """Named and numbered entities as text; what is none stays."""
    pairs = BREAK.join(f"{name}{END}{found}" for name, found in entity_texts().items())
    names = F.str_to_map(F.lit(pairs), F.lit(BREAK), F.lit(END))  # one literal, folded to a map before the job
    number = lambda name: F.when(
        name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)
    ).when(name.startswith("#"), F.substr(name, F.lit(2))).cast("int")

    def character(code: Column) -> Column:
        good = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        code = F.when(good, code).otherwise(F.lit(0xFFFD))
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        code = number(name)
        found = F.when(name == "", F.lit(None)).otherwise(
            F.coalesce(F.try_element_at(names, name), F.when(name.startswith("#"), character(code)))
        )
        return F.coalesce(F.concat(found, F.substr(p, F.length(name) + 2)), F.concat(F.lit("&"), p))

    def all_pieces(t: Column) -> Column:
        parts = F.split(t, "&")
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), piece), ""))

    return _once(text, lambda t: F.when(t.contains("&"), all_pieces(t)).otherwise(t))


def html_to_text(html: Column) -> Column:
    text = F.regexp_replace(html, CONTROLS, "")
    text = reduce(lambda c, r: _without(c, *r), REMOVED, text)
    text = reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), REWRITES, _collapsed(text))
    text = reduce(lambda c, n: F.replace(c, F.lit(f"{HEADING}{n}"), F.lit("#" * n + " ")), range(1, 7), text)
    text = _decoded(text)
    text = F.regexp_replace(text, r"(?<![ \t])[ \t]++(?=\n)", "")
    text = F.regexp_replace(text, r"\n[ \t]++", "\n")
    text = F.regexp_replace(text, r"\n{3,}+", "\n\n")
    text = F.replace(F.replace(text, F.lit(ITEM), F.lit("  ")), F.lit(BREAK), F.lit("\n"))
    return strip(_once(text, lambda t: F.when(t.contains(QUOTE_MARK), _quote_lines(t)).otherwise(t)))


def wrap_lines(text: Column) -> Column:
    """Break lines at 78 columns; a longer word keeps a line of its own.

    Without it the cleaner would take every longer paragraph of an HTML body for
    an artifact and drop it.
    """
    return strip(F.regexp_replace(text, LINE_WRAP, "$1\n"))
