"""Body cleaning: sign-offs, quotes, delimiters, artifacts, white space.

Line rules are written as patterns over the whole text instead of an array of
lines, so cleaning is one codegen projection: no explode, no lambda, no shuffle.
White space inside a line never includes the line feed and is matched
possessively, which keeps every pattern linear in the length of the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import (
    ARTIFACT_BELOW_CHARS,
    DELIMITER_LINES,
    DELIMITER_PREFIX,
    LONG_LINE_CHARS,
    PHONE_LABELS,
    SIGN_OFFS,
)
from lettermill.functions.text import HS, WS, rstrip, strip

_ANY_OF_SIGN_OFFS = "|".join(SIGN_OFFS)
_ANY_OF_DELIMITERS = "|".join(DELIMITER_LINES)
_ANY_OF_PHONES = "|".join(PHONE_LABELS)

# What starts a cut. Each follows the start of a line and its indentation.
_SIGN_OFF = rf"(?:{_ANY_OF_SIGN_OFFS})[,{WS}/]"
_DELIMITER = rf"(?:(?:{_ANY_OF_DELIMITERS}){HS}*+$|{DELIMITER_PREFIX})"
_REPLY_HEADER = (
    rf"(?:On [^\n]+wrote:?{HS}*$"
    rf"|Op [^\n]+schreef[^\n]*[^{WS}]"
    r"|On \p{Nd}++[^\n]*at \p{Nd}+:)"
)

# What makes a whole line go. Each matches from the start of the line to
# its end, without the line feed.
_QUOTED = rf"{HS}*+[>|][^\n]*+"
_ARTIFACT = (
    rf"{HS}*+[^\p{{L}}\p{{N}}{WS}]"
    rf"(?:[^\p{{L}}\p{{N}}\n]{{0,{ARTIFACT_BELOW_CHARS - 3}}}[^\p{{L}}\p{{N}}{WS}])?{HS}*+"
)
_LONG = rf"[^\n]{{{LONG_LINE_CHARS + 1},}}+"
_PHONE = rf"{HS}*+(?:{_ANY_OF_PHONES})[{WS}:&&[^\n]]++[^\n]*[\p{{Nd}}+()\-]{HS}*+"


def _head(text: Column, *starts: str) -> Column:
    """What comes before the first line that begins with one of ``starts``, with its line feed."""
    return F.regexp_replace(text, rf"(?iumdU)^{HS}*+(?:{'|'.join(starts)})(?s:.*)", "")


def _lines_before(text: Column, *starts: str) -> Column:
    head = _head(text, *starts)
    return F.when(head == text, text).otherwise(F.left(head, F.length(head) - 1))


def _kept_lines(text: Column, *lines: str) -> Column:
    """Lines that match none of ``lines`` as a whole, each with a line feed."""
    return F.regexp_replace(F.concat(text, F.lit("\n")), rf"(?iumdU)^(?:{'|'.join(lines)})\n", "")


def _drop_lines(text: Column, *lines: str) -> Column:
    kept = _kept_lines(text, *lines)
    return F.left(kept, F.length(kept) - 1)


def cut_signature(text: Column) -> Column:
    """Cut at the first sign-off line, together with blank lines before it."""
    head = _head(text, _SIGN_OFF)
    body = rstrip(head)
    # the rest of the last written line: its trailing spaces
    tail = F.substring_index(F.substr(head, F.length(body) + 1), "\n", 1)
    return (
        F.when(head == text, text)
        .when(body == "", F.lit(""))
        .otherwise(F.concat(body, tail, F.lit("\n")))
    )


def stop_delimiter(text: Column) -> Column:
    return _lines_before(text, _DELIMITER)


def stop_reply_header(text: Column) -> Column:
    return _lines_before(text, _REPLY_HEADER)


def drop_quoted(text: Column) -> Column:
    return _drop_lines(text, _QUOTED)


def drop_artifacts(text: Column) -> Column:
    return _drop_lines(text, _ARTIFACT)


def drop_long_lines(text: Column) -> Column:
    return _drop_lines(text, _LONG)


def drop_phone_lines(text: Column) -> Column:
    return _drop_lines(text, _PHONE)


def normalize_whitespace(text: Column) -> Column:
    """Three or more line feeds become two, two or more spaces one; stripped."""
    return strip(F.regexp_replace(text, r"(\n\n)\n++|( ) ++", "$1$2"))


def clean_text(text: Column) -> Column:
    """All rules in order; NULL becomes ''.

    The earliest cut wins whichever rule found it, and a line is dropped if any
    rule says so, so the rules fold into one cut and one line filter.
    """
    cut = _head(F.coalesce(text, F.lit("")), _SIGN_OFF, _DELIMITER, _REPLY_HEADER)
    return normalize_whitespace(_kept_lines(cut, _QUOTED, _ARTIFACT, _LONG, _PHONE))
